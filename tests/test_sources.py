"""Tables, versions and streams that stop and go on."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from cairn.operators import merge
from cairn.sources import crawl, tables
from cairn.streaming import replay, retries

SCHEMA = "id string, year int"


def test_json_files(spark, tmp_path):
    path = tmp_path / "a.json"
    assert tables.read_json(spark, str(path), SCHEMA).count() == 0
    with pytest.raises(FileNotFoundError):
        tables.read_json(spark, str(path), SCHEMA, required=True)
    path.write_text("[]")
    with pytest.raises(ValueError, match="no records"):
        tables.read_json(spark, str(path), SCHEMA, required=True)
    path.write_text('[{"id": "a", "year": 1}, {"id": "b"}]')
    assert [tuple(r) for r in tables.read_json(spark, str(path), SCHEMA, required=True).orderBy("id").collect()] == [("a", 1), ("b", None)]
    path.write_text("[{")
    with pytest.raises(Exception):  # noqa: B017
        tables.read_json(spark, str(path), SCHEMA).collect()


def test_keyed_states(spark):
    df = spark.sql("SELECT map('u', named_struct('at', 1, 'embeds', 2), 'v', named_struct('at', 3, 'embeds', 4)) AS done")
    assert {tuple(r) for r in tables.keyed_state(df, "done", "url").collect()} == {("u", 1, 2), ("v", 3, 4)}


def test_cursor_and_manifest(spark, tmp_path):
    path = tmp_path / "az.json"
    assert tables.read_cursor(spark, str(path)).first().asDict() == {"letter": "a", "page": 1, "pass": 1}
    path.write_text('{"letter": "c", "page": 4}')
    cursor = tables.read_cursor(spark, str(path))
    assert cursor.first().asDict() == {"letter": "c", "page": 4, "pass": 1}
    tables.write_cursor(cursor, f"{tmp_path}/cursor")
    assert tables.current(spark, f"{tmp_path}/cursor").first()["letter"] == "c"
    manifest = tmp_path / "m.json"
    manifest.write_text(json.dumps(["/a/", {"path": "/b/", "label": "B"}, {"label": "lost"}]))
    assert [tuple(r) for r in tables.read_manifest(spark, str(manifest)).collect()] == [(0, "/a/", None), (1, "/b/", "B")]


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_versions(spark, tmp_path):
    root, one, two = f"{tmp_path}/t", spark.createDataFrame([("a", 1)], SCHEMA), spark.createDataFrame([("b", 2)], SCHEMA)
    assert tables.current(spark, root) is None and tables.last_commit(spark, root) == 0
    first = tables.publish(one, root)
    old = tables.current(spark, root)
    assert tables.publish_if_changed(two.withColumn("changed", F.lit(False)), root) is None and tables.last_commit(spark, root) == first
    tables.publish_if_changed(two.withColumn("changed", F.lit(True)), root)
    assert rows(tables.current(spark, root)) == [("b", 2)] and rows(old) == [("a", 1)]
    tables.publish(one, root)
    assert tables.vacuum(spark, root, 1) == 2 and rows(tables.current(spark, root)) == [("a", 1)]


def test_joint_commits_are_seen_whole(spark, tmp_path, monkeypatch):
    """A writer that dies at any write leaves the commit before it; one that gets through shows all its tables."""
    root, df = f"{tmp_path}/all", lambda n: spark.createDataFrame([(str(n), n)], SCHEMA)
    number, counts = tables.save_all(df(1), df(1), df(1), root, {"rows": F.count("*"), "years": F.sum("year")})
    assert (number, counts) == (1, {"rows": 1, "years": 1})
    writer = type(df(2).write)
    write = writer.parquet
    for fatal in range(3):
        done = []

        def die(self, path, *rest, done=done, fatal=fatal, **more):
            if len(done) == fatal:
                raise OSError("killed")
            done.append(path)
            return write(self, path, *rest, **more)

        monkeypatch.setattr(writer, "parquet", die)
        with pytest.raises(OSError, match="killed"):
            tables.save_all(df(2), df(2), df(2), root)
        monkeypatch.undo()
        assert {n: rows(t) for n, t in tables.snapshot(spark, root).items()} == dict.fromkeys(("records", "index", "state"), [("1", 1)])
    tables.commit({"state": df(3)}, root)  # another writer is not held up, and what it does not name stays
    assert {n: rows(t)[0][1] for n, t in tables.snapshot(spark, root).items()} == {"records": 1, "index": 1, "state": 3}
    assert {n: rows(t)[0][1] for n, t in tables.snapshot(spark, root, 1).items()} == {"records": 1, "index": 1, "state": 1}


def test_two_writers_lose_nothing(spark, tmp_path):
    root = f"{tmp_path}/t"
    df = lambda *r: {"records": spark.createDataFrame(list(r), SCHEMA)}
    unite = lambda ours, theirs: {n: ours[n].unionByName(theirs[n]).distinct() for n in ours}
    base = tables.publish_merged(df(("a", 1)), root, 0, unite)
    tables.publish_merged(df(("a", 1), ("mine", 2)), root, base, unite)
    tables.publish_merged(df(("a", 1), ("yours", 3)), root, base, unite)
    assert rows(tables.snapshot(spark, root)["records"]) == [("a", 1), ("mine", 2), ("yours", 3)]
    with pytest.raises(tables.Conflict):
        tables.commit(df(("b", 1)), root, base)


def test_cursors_of_two_writers(spark):
    ddl = f"k int, {tables.CURSOR}, last_pass_at int, finished_at int"
    ours = spark.createDataFrame([(1, "c", 4, 2, 10, None), (2, "a", 1, 1, None, 5), (3, None, None, None, None, None)], ddl)
    theirs = spark.createDataFrame([(1, "c", 3, 2, 20, 7), (2, "b", 1, 1, 9, None), (3, "a", 2, 1, None, None)], ddl)
    got = {r["k"]: (r["pass"], r["letter"], r["page"], r["last_pass_at"], r["finished_at"]) for r in merge.merge_cursors(ours, theirs, "k").collect()}
    assert got == {1: (2, "c", 4, 20, 7), 2: (1, "b", 1, 9, 5), 3: (1, "a", 2, None, None)}


def test_states_of_two_writers(spark):
    """The newer entry, the earliest miss, and letters of which ours override."""
    ddl = "writer string, letters map<string,int>"
    a, b = spark.createDataFrame([("w", {"a": 1, "b": 2}), ("x", None), ("z", {"q": 1})], ddl), spark.createDataFrame([("w", {"b": 9, "c": 3}), ("x", {"d": 4}), ("y", {"e": 5})], ddl)
    got = {r["writer"]: r["letters"] for r in merge.merge_letters(a, b, "writer", "letters").collect()}
    assert got == {"w": {"a": 1, "b": 2, "c": 3}, "x": {"d": 4}, "y": {"e": 5}, "z": {"q": 1}}


EVENTS = "event_id bigint, user_id bigint, event_type string, ts timestamp"


def event(i, user, kind):
    return i, user, kind, dt.datetime(2024, 1, 1) + dt.timedelta(hours=i)


def test_streams_go_on_where_they_stopped(spark, tmp_path):
    source, root, state = (f"{tmp_path}/{x}" for x in ("in", "state", "checkpoint"))
    write = lambda *r: spark.createDataFrame(list(r), EVENTS).coalesce(1).write.mode("append").parquet(source)
    stream = lambda: spark.readStream.schema(EVENTS).parquet(source)
    write(event(1, 1, "error"), event(2, 1, "error"), event(3, 2, "view"))
    first = replay.replay(stream(), root, state)
    assert {(r["user_id"], r["event_id"]) for r in first.collect()} == {(1, 2), (2, 3)}
    write(event(4, 1, "error"), event(5, 2, "error"), event(6, 3, "error"), event(7, 3, "view"))
    second = replay.replay(stream(), root, state)
    assert {(r["user_id"], r["event_id"], r["event_type"]) for r in second.collect()} == {(1, 4, "error"), (2, 5, "error"), (3, 7, "view")}


def test_retries_fire_as_timers(spark, tmp_path):
    """Rows out of order, over several runs of one checkpoint: each counts at its own time, and timers fire once."""
    source, out, state = (f"{tmp_path}/{x}" for x in ("in", "out", "state"))
    t = lambda h: dt.datetime(2024, 1, 1) + dt.timedelta(hours=h)
    seen = set()

    def run(*rows):
        spark.createDataFrame(list(rows), EVENTS).coalesce(1).write.mode("append").parquet(source)
        retries.run(spark.readStream.schema(EVENTS).parquet(source), out, state, "30 days")
        now = {(r["user_id"], r["reason"], r["failures"], r["event_id"]) for r in spark.read.parquet(out).collect()}
        new = now - seen
        seen.update(now)
        return new

    assert run((5, 1, "error", t(5)), (6, 1, "error", t(6)), (1, 2, "view", t(1)), (1, 2, "view", t(1))) == {(1, "seen", 2, 6), (2, "seen", 0, 1)}
    assert run((4, 1, "view", t(30))) == {(1, "seen", 0, 4)}  # a smaller number, but later
    assert run((7, 1, "error", t(40)), (9, 2, "error", t(3)), (8, 2, "error", t(2))) == {(1, "seen", 1, 7), (2, "seen", 2, 9)}
    assert run((3, 1, "view", t(35)), (10, 2, "view", t(2.5))) == {(2, "seen", 1, 9)}  # between what was known: one failure is left each
    assert run((11, 3, "view", t(24 * 40))) == {(3, "seen", 0, 11), (1, "retry", 1, 7), (2, "retry", 1, 9)}
    assert run((12, 3, "error", t(24 * 100))) == {(3, "seen", 1, 12)}
    spark.createDataFrame([], EVENTS).coalesce(1).write.mode("append").parquet(source)
    before = sorted(map(tuple, spark.read.parquet(out).collect()))
    retries.run(spark.readStream.schema(EVENTS).parquet(source), out, state, "30 days")
    assert sorted(map(tuple, spark.read.parquet(out).collect())) == before


def test_crawl_goes_on_where_it_stopped(spark, tmp_path):
    """The cursor stays on a page that fails three times, moves over one that fails less, and a pass is a run."""
    root = tmp_path / "site"

    def page(letter, n, *attempts):
        folder = root / f"letter={letter}" / f"page={n}"
        folder.mkdir(parents=True, exist_ok=True)
        lines = [{"attempt": k, "status": a, "pos": 0} if isinstance(a, int) else {"attempt": k, "status": 200, "pos": i, "path": p} for k, a in enumerate(attempts, 1) for i, p in enumerate([a] if isinstance(a, int) else a)]
        (folder / "part.json").write_text("\n".join(map(json.dumps, lines)))

    def run(**more):
        got = crawl.crawl(spark, str(root), f"{tmp_path}/out", f"{tmp_path}/check", **more)
        return [(r["pass"], r["letter"], r["page"], r["path"]) for r in got.orderBy("pass", "letter", "page", "pos").collect()], json.loads((root / "_cursor.json").read_text())

    page("a", 1, ["/a1/", "/a2/"])
    page("a", 2, 503, 503, ["/a3/"])
    page("c", 1, 503, 503, 503, ["/c1/"])
    page("z", 1, ["/z1/"])
    first = [(1, "a", 1, "/a1/"), (1, "a", 1, "/a2/"), (1, "a", 2, "/a3/")]
    assert run(pages=1) == (first[:2], {"pass": 1, "letter": "a", "page": 2})
    assert run() == (first, {"pass": 1, "letter": "c", "page": 1})
    assert run() == (first, {"pass": 1, "letter": "c", "page": 1})
    page("c", 1, ["/c1/"])
    whole = [*first, (1, "c", 1, "/c1/"), (1, "z", 1, "/z1/")]
    assert run() == (whole, {"pass": 2, "letter": "a", "page": 1})
    page("b", 1, ["/b1/"])
    again = [(2, *x[1:]) for x in whole]
    assert run() == (whole + again[:3] + [(2, "b", 1, "/b1/")] + again[3:], {"pass": 3, "letter": "a", "page": 1})


def test_a_task_reads_many_pages_and_pages_are_looked_at_once(tmp_path):
    from cairn.sources.crawl import PAGES, Crawler

    for n in range(1, 2 * PAGES + 2):
        (tmp_path / "letter=a" / f"page={n}").mkdir(parents=True)
        bad = '{"attempt": 1, "status": 503}\n{"attempt": 2, "pos": 1, "path": "/x/"}\n'
        (tmp_path / "letter=a" / f"page={n}" / "x.json").write_text(bad if n == 40 else '{"pos": 1, "path": "/p/"}\n')
    reader, seen = Crawler({"root": str(tmp_path)}), []
    rows = reader.rows
    reader.rows = lambda letter, page, attempt: seen.append((letter, page, attempt)) or rows(letter, page, attempt)
    start = reader.initialOffset()
    end = reader.latestOffset()
    parts = reader.partitions(start, end)
    assert end == {"pass": 2, "letter": "a", "page": 1} and [len(p.places) for p in parts] == [PAGES, PAGES, 1]
    assert sum(1 for s in seen if s[:2] == ("a", 7)) == 1
    read = [r for p in parts for r in reader.read(p)]
    assert [r[2] for r in read] == list(range(1, 2 * PAGES + 2)) and read[39][4] == "/x/"
    assert [r[2] for p in Crawler({"root": str(tmp_path)}).partitions({"pass": 1, "letter": "a", "page": 150}, {"pass": 1, "letter": "a", "page": 160}) for r in reader.read(p)] == list(range(150, 160))
