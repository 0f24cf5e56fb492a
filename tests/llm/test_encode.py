"""Token files: a block's distinct words are encoded where its texts are, many in a call, as the library does."""

import random

import numpy as np
import pyarrow as pa
from pyspark.sql.readwriter import DataFrameWriter

from cairn.llm import tokenfiles, words


def lib() -> tokenfiles.Library:
    with open(tokenfiles.TOKENIZER, encoding="utf-8") as f:
        return tokenfiles.library(f.read())


def test_texts_are_shuffled_once_and_words_not(spark, tmp_path, monkeypatch):
    plans, write = [], DataFrameWriter.parquet

    def parquet(self, *a, **b):
        plans.append(self._df._jdf.queryExecution().executedPlan().toString())
        return write(self, *a, **b)

    monkeypatch.setattr(DataFrameWriter, "parquet", parquet)
    docs = spark.createDataFrame([(k, f"word{k} and more, more") for k in range(20)], "doc_id bigint, text string")
    shards = tokenfiles.write_shards(docs, str(tmp_path / "shards"))
    assert sum(len(r["doc_ids"]) for r in shards.collect()) == 20
    assert len(plans) == 1 and plans[0].count("Exchange ") == 1 and "CoGroup" not in plans[0]


def test_words_have_the_ids_of_the_library():
    draw = random.Random(5)
    chars = [c for c in map(chr, range(0x21, 0x250)) if not c.isspace()]
    odd = ["", "it's", "'s's", "..'ll", "<|endoftext|>", "a<|startoftext|>b", "<|", "İ", "ǅ", "日本語", "é", "a\u0085b", "a b", "ΣΑΣ", "a\0b", "\x1c", "x" * 3_000]
    made = ["".join(draw.choices(s, k=draw.randint(1, 12))) for s in (chars, "abz019.,!-éè²", [*chars, "'", "́", "Ω"]) for _ in range(4_000)]
    distinct = list(dict.fromkeys([*chars, *(f"a{c}b{c}{c}1" for c in chars), *odd, *made]))
    codes = tokenfiles.encode(pa.array(distinct), lib())
    for k, e in enumerate(lib().whole.encode_batch_fast(distinct, add_special_tokens=False)):
        assert codes.flat[codes.first[k] :][: codes.size[k]].tolist() == e.ids, distinct[k]
    for few in ([], [""], ["日本語"]):
        assert tokenfiles.encode(pa.array(few, pa.string()), lib()).size.tolist() == [len(lib().whole.encode(w).ids) for w in few]


def test_texts_have_the_ids_of_the_library(monkeypatch):
    texts = ["One two, TWO  three.", "", "  été un two ", "Ünder the <|endoftext|> Mark", "\n\n", "three " * 50, "x y 12345 it's", "two"]
    want = [np.array(lib().whole.encode(t, add_special_tokens=False).ids, words.ID).tobytes() for t in texts]
    for slab, many in ((1, 1), (20, 3), (1 << 20, 1 << 20)):
        monkeypatch.setattr(words, "SLAB", slab)
        monkeypatch.setattr(words, "LOOKED_UP", many)
        distinct, places, sizes = tokenfiles.placed(pa.array([t.encode() for t in texts]))
        assert len({*distinct.to_pylist()}) == len(distinct)
        assert words.by_places(places, sizes, tokenfiles.encode(distinct, lib())) == want


def test_the_library_is_called_for_many_words_at_once():
    seen = {"whole": [], "model": []}

    class Counting:
        def __init__(self, name: str, tokenizer):
            self.name, self.tokenizer = name, tokenizer

        def encode_batch_fast(self, texts, **kw):
            seen[self.name].append(len(texts))
            return self.tokenizer.encode_batch_fast(texts, **kw)

    distinct = ["".join(w) for w in np.random.default_rng(3).choice(list("abcdefgh"), (30_000, 7))]
    l = lib()
    tokenfiles.encode(pa.array(list(dict.fromkeys(distinct))), tokenfiles.Library(Counting("whole", l.whole), Counting("model", l.model), l.ends))
    assert not sum(seen["whole"]) and len(seen["model"]) <= 4 and max(seen["model"]) <= tokenfiles._CALL


def test_documents_are_read_by_rules_long_and_short(monkeypatch):
    draw = np.random.default_rng(4)
    ids = np.concatenate([np.tile(draw.integers(0, 9, 70), 40), draw.integers(0, 3, 2_000), np.full(600, 5)])
    starts = np.array([0, 0, 11, 2_800, 2_801, 4_000, len(ids), len(ids)])
    g = tokenfiles.repair(ids, starts)
    assert g.lengths.max() > 64
    for ready in (0, 2, 64, 1 << 20):
        monkeypatch.setattr(tokenfiles, "READY", ready)
        assert [d.tolist() for d in tokenfiles.documents(g)] == [ids[a:b].tolist() for a, b in zip(starts, starts[1:])]
