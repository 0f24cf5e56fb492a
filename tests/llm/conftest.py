"""A small corpus with nulls, empty and long texts, repeated rows, near copies, shared passages, benchmark
passages, toxic texts, and extra columns whose names the operators use themselves."""

import random
import zlib

import pytest

ITEMS = [
    "which copper ferry did the guild master carry over the frozen river before the winter market opened and who paid for its amber lantern",
    "name the botanist whose pressed fern collection proved that northern islands once joined a warmer continent seven thousand years earlier than maps suggest",
    "if eleven bakers share forty nine loaves equally how many whole loaves remain when each baker has taken as many as possible from storage",
]


def prose(r: random.Random, n: int) -> str:
    return " ".join(r.choice(WORDS) + r.choice(["", "", "", ",", "."]) for _ in range(n))


WORDS = sorted({"".join(random.Random(k).choices("abcdefghijklmnoprstuvw", k=2 + k % 8)) for k in range(900)}) + ["été", "größe", "señal", "Straße", "OF", "The"]


@pytest.fixture(scope="session")
def rows():
    r = random.Random(5)
    out = [(k, prose(r, r.randint(60, 160))) for k in range(60)]
    passage, base = prose(r, 120), prose(r, 150)
    out += [(100 + k, f"{prose(r, 30)} {passage} {prose(r, 40)}") for k in range(6)]
    for k in range(6):
        w = base.split()
        w[7 + k * 20] = "changed"
        out.append((200 + k, " ".join(w)))
    out += [(210 + k, base) for k in range(3)]
    out += [(300 + k, f"{prose(r, 40)} {item} {prose(r, 40)}") for k, item in enumerate(ITEMS)]
    out += [(400 + k, f"{prose(r, 25)} you {'vilegrub' if k % 3 else 'v1legrub'} {prose(r, 25)}") for k in range(40)]
    out += [(500, ""), (501, None), (502, "   \n\t "), (503, "one"), (504, "Two words"), (505, "  odd   spaces   here\n\n\nand tabs\t\tend "), (506, prose(r, 20_000)), (507, "x" * 5_000), (508, "日本語のテキスト 🙂 ½ don't I'LL 12345 <|endoftext|>"), (509, "ab " * 900)]
    return out + [out[3], out[3]]


@pytest.fixture(scope="session")
def docs(spark, rows):
    fields = "doc_id bigint, text string, lang string, source string, n_chars bigint, crc string, block string, vertex string, score string, kept string"
    return spark.createDataFrame([(i, t, "en", "web", None if t is None else len(t), *["clash"] * 5) for i, t in rows], fields)


@pytest.fixture(scope="session")
def sf_dir(spark, docs, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("tables"))
    docs.repartition(3).write.parquet(f"{d}/documents.parquet")
    labels = [(k, k % 2, 1 if 400 <= k < 440 else 0) for k in [*range(60), *range(400, 440)]] + [(59, None, None), (None, 1, 1)]
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    spark.createDataFrame([*enumerate(ITEMS), (7, None), (8, "")], "item_id bigint, text string").write.parquet(f"{d}/benchmark.parquet")
    spark.createDataFrame([(k, [float(k % 7), 1.0, float(k)]) for k in range(50)], "vec_id bigint, embedding array<float>").write.parquet(f"{d}/embeddings.parquet")
    return d


@pytest.fixture(scope="session")
def empty_dir(spark, sf_dir, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("empty"))
    for t in ("documents", "labels", "benchmark", "embeddings"):
        spark.read.parquet(f"{sf_dir}/{t}.parquet").limit(0).write.parquet(f"{d}/{t}.parquet")
    return d


def crc(x) -> int:
    return zlib.crc32(str(x).encode())
