"""What filing items leaves on disk: shuffle files end with the table they served, and links are written once."""

import random
import time

import pytest
from pyspark.sql import functions as F
from test_upsert import FIELDS, random_batch

from cairn.operators import records, upsert
from cairn.sources import scratch

ITEMS = "pos bigint, url string, title string, year int, kind string, embeds " + records.EMBEDS + ", seasons " + records.SEASONS + ", poster string"


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(k).getName() for k in range(files.size()) if files.apply(k).getName().startswith("shuffle_")}


def test_shuffle_files_end_with_the_table_they_served(spark):
    before, was = shuffle_files(spark), spark.conf.get(scratch._CLEANUP, None)
    out = scratch.saved(spark.range(1000).repartition("id").groupBy((F.col("id") % 7).alias("k")).agg(F.collect_list("id").alias("ids")))
    until = time.time() + 20
    while shuffle_files(spark) - before and time.time() < until:
        time.sleep(0.2)
    assert not shuffle_files(spark) - before and out.count() == 7
    assert spark.conf.get(scratch._CLEANUP, None) == was


def test_only_what_saved_wrote_is_forgotten(spark):
    kept, gone = (scratch.saved(spark.range(5)) for _ in range(2))
    part = gone.where("id > 1")
    scratch.forget(kept.where("true"), spark.range(3), gone)
    assert kept.count() == 5
    with pytest.raises(Exception, match="(?i)does not exist|not_exist"):
        part.collect()


def batch(spark, seeds):
    stored, items = [], []
    for seed in seeds:
        s, it = random_batch(seed)
        stored += [{**x, "id": f"n{seed}-{x['id']}", "title": f"n{seed} {x['title']}", "page_url": x["page_url"].replace("/h/", f"/h/{seed}-"), "pos": x["pos"] + 100 * seed} for x in s]
        items += [{**x, "title": f"n{seed} {x['title']}", "url": x["url"].replace("/x/", f"/x/{seed}-"), "pos": x["pos"] + 100 * seed} for x in it]
    s = spark.createDataFrame([tuple(x.get(c) for c in (*records.COLUMNS, "pos")) for x in stored], FIELDS)
    return s, spark.createDataFrame([tuple(x[c] for c in ("pos", "url", "title", "year", "kind", "embeds", "seasons", "poster")) for x in items], ITEMS)


def test_the_log_alone_equals_the_log_beside_the_catalogue(spark):
    s, it = batch(spark, range(40))
    want = upsert.upsert(s, it, F.lit("2"))[1]
    got = upsert.upsert_log(s, it).select(*want.columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and {r["action"] for r in want.collect()} == {"added", "merged", "unchanged"}


def test_links_are_written_once(spark):
    """A series' flat links follow from its seasons, and the log needs no record put together."""
    seasons = f"CAST(array(named_struct('season', 1, 'episodes', transform(sequence(1, 4), e -> named_struct('episode', e, 'embeds', array(named_struct('quality', 'HD', 'url', concat('link', id, '-', e))))))) AS {records.SEASONS})"
    items = spark.range(20).selectExpr("id AS pos", "concat('https://h/', id) AS url", "concat('n', id DIV 2, ' Season ', id % 2) AS title", "2000 AS year", "'series' AS kind", f"CAST(NULL AS {records.EMBEDS}) AS embeds", f"{seasons} AS seasons", "'' AS poster")
    stored = spark.createDataFrame([], FIELDS)
    links = []

    def save(df):
        out = scratch.saved(df)
        links.append(sum(str(r.asDict(True)).count("link") for r in out.collect()))
        return out

    log = upsert.upsert_log(stored, items, save)
    assert sum(links) == 20 * 4 and log.where("action = 'added'").count() == 10


def test_groups_against_connected_entities(spark):
    r = random.Random(5)
    rows = [(r.random() < 0.6, k, *(r.choice([None, *(f"{c}{r.randrange(40)}" for _ in range(4))]) if c != "p" else f"/p{r.randrange(60)}/" for c in "ipfbg")) for k in range(60)]
    # a chain of which each entity shares an id or a path with the next
    rows += [(True, 100 + k, f"chain{(k + 1) // 2}", f"/chain{k // 2}/", None, f"own{k}", None) for k in range(15)]
    known = spark.createDataFrame(rows, "item boolean, pos bigint, id string, path string, fork_id string, base string, fork_base string")
    group = {(x["item"], x["pos"]): x["group"] for x in upsert.grouped(known, scratch.saved).collect()}
    keys = {(x[0], x[1]): {("id", x[2]), ("path", x[3]), ("id", x[4]), ("base", x[5]), ("base", x[6])} - {("id", None), ("base", None)} for x in rows}
    items = {k for e, of in keys.items() if e[0] for k in of}
    of = {e: e for e in keys}

    def root(e):
        while of[e] != e:
            e = of[e]
        return e

    for a in keys:
        for b in keys:
            if keys[a] & keys[b] & items:
                of[root(a)] = root(b)
    for a in keys:
        for b in keys:
            if root(a) == root(b):
                assert group[a] == group[b]
    assert len(group) == len(rows) and len({group[(True, 100 + k)] for k in range(15)}) == 1 and len(set(group.values())) > 3


def test_news_alone_equal_the_news_beside_merged_links(spark):
    """On sources with episodes without links, seasons without episodes, empty and equal URLs; and nothing is gathered."""
    r = random.Random(9)
    link = lambda: {"quality": r.choice(["1080p", "720p", "HD", None]), "url": r.choice(["", None, *"abcde"])}
    seasons = lambda: [{"season": s, "episodes": r.choice([[], [{"episode": e, "embeds": [link() for _ in range(r.randrange(4))]} for e in r.sample(range(4), r.randrange(4))]])} for s in r.sample(range(3), r.randrange(3))]
    rows = []
    for k in range(300):
        kind = r.choice(["series", "series", "movie"])
        rows += [(k, src, kind, [link() for _ in range(r.randrange(4))], seasons()) for src in sorted(r.sample(range(-1, 9), r.randrange(1, 5)))]
    df = spark.createDataFrame(rows, f"id bigint, src bigint, kind string, embeds {records.EMBEDS}, seasons {records.SEASONS}")
    flat = records.link_rows(df, ["id"], F.col("src"))
    want = records.merged_links(flat, ["id"])[1].collect()
    news = records.link_news(flat, ["id"])
    assert sorted(want) == sorted(news.collect()) and len(want) > 400
    assert "collect_list" not in news._jdf.queryExecution().executedPlan().toString()
