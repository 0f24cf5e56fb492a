"""Listing pages as a stream whose offset is a cursor: pass, letter and page.

The cursor moves on only over pages that could be read. A letter ends at its first missing page; after "z" the pass is over, and
so is the run: the next one begins the next pass. A page that fails is asked for again, and the third failure in a row ends the
run with the cursor on that page, so that no unread page is skipped. What pages hold is read on the executors, PAGES of them a task.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

#: Failures in a row that end a run.
FAILURES = 3
#: Pages that one task reads, and pages that are looked at together when the cursor moves on.
PAGES, AHEAD = 100, 32
ROWS = "pass int, letter string, page int, pos int, path string, label string"
START = {"pass": 1, "letter": "a", "page": 1}
_END = chr(ord("z") + 1)


class Page(InputPartition):
    def __init__(self, pass_: int, places: list[tuple[str, int]]):
        self.pass_, self.places = pass_, places


class Crawler(DataSourceStreamReader):
    """Reads pages below root, each a folder letter=a/page=1 of JSON lines (attempt, status, pos, path, label)."""

    def __init__(self, options: dict):
        self.root, self.most, self.there = options["root"], int(options.get("pages", 0)), set()

    def _store(self):
        from pyarrow import fs

        if "://" in self.root or self.root.startswith("file:"):
            return fs.FileSystem.from_uri(self.root.replace("file:/", "file:///", 1) if self.root.startswith("file:/") and not self.root.startswith("file://") else self.root)
        return fs.LocalFileSystem(), self.root

    def rows(self, letter: str, page: int, attempt: int | None) -> list[dict] | None:
        """What an attempt at a page gave (its last one: None), in order; None without such a page. A later attempt than any that
        is known gives what the last one gave."""
        from pyarrow import fs

        store, root = self._store()
        found = store.get_file_info(fs.FileSelector(f"{root}/letter={letter}/page={page}", allow_not_found=True))
        lines = []
        for f in sorted((f for f in found if f.is_file and f.base_name.endswith(".json")), key=lambda f: f.path):
            with store.open_input_stream(f.path) as s:
                lines += [json.loads(x) for x in s.read().splitlines() if x.strip()]
        if not lines:
            return None
        last = max(x.get("attempt", 1) for x in lines)
        wanted = last if attempt is None else min(attempt, last)
        return sorted((x for x in lines if x.get("attempt", 1) == wanted), key=lambda x: x.get("pos", 0))

    def cursor(self) -> dict:
        store, root = self._store()
        info = store.get_file_info(f"{root}/_cursor.json")
        if not info.is_file:
            return dict(START)
        with store.open_input_stream(info.path) as s:
            return START | json.loads(s.read())

    def initialOffset(self) -> dict:
        return self.cursor()

    def latestOffset(self) -> dict:
        at, failures, pages = self.cursor(), 0, 0
        self.there, first = set(), {}
        while not self.most or pages < self.most:
            if at["letter"] >= _END:
                return {"pass": at["pass"] + 1, "letter": "a", "page": 1}
            place = (at["letter"], at["page"])
            if not failures and place not in first:
                first = self._looked(*place, min(AHEAD, self.most - pages) if self.most else AHEAD)
            rows = self.rows(*place, failures + 1) if failures else first[place]
            if rows is not None:
                self.there.add(place)
            if rows is None:
                at = {**at, "letter": chr(ord(at["letter"]) + 1), "page": 1}
            elif any(x.get("status", 200) != 200 for x in rows):
                failures += 1
                if failures >= FAILURES:
                    break
            else:
                at, failures, pages = {**at, "page": at["page"] + 1}, 0, pages + 1
        return at

    def _looked(self, letter: str, page: int, n: int) -> dict:
        """What the first attempts at n pages of a letter gave, from this page on."""
        places = [(letter, page + i) for i in range(n)]
        with ThreadPoolExecutor(8) as pool:
            return dict(zip(places, pool.map(lambda place: self.rows(*place, 1), places)))

    def partitions(self, start: dict, end: dict) -> list[Page]:
        at, places = dict(start), []
        while at != end and at["letter"] < _END:
            place = (at["letter"], at["page"])
            if place not in self.there and self.rows(*place, None) is None:
                at = {**at, "letter": chr(ord(at["letter"]) + 1), "page": 1}
            else:
                places.append(place)
                at = {**at, "page": at["page"] + 1}
        return [Page(start["pass"], places[i : i + PAGES]) for i in range(0, len(places), PAGES)]

    def read(self, partition: Page) -> Iterator[tuple]:
        for letter, page in partition.places:
            yield from ((partition.pass_, letter, page, x["pos"], x["path"], x.get("label")) for x in self._whole(letter, page) if x.get("path") is not None)

    def _whole(self, letter: str, page: int) -> list[dict]:
        for attempt in range(1, FAILURES + 1):
            rows = self.rows(letter, page, attempt) or []
            if all(x.get("status", 200) == 200 for x in rows):
                return rows
        raise OSError(f"page {letter}/{page} cannot be read any more")

    def commit(self, end: dict) -> None:
        """Keeps the cursor beside the pages, written aside and moved into place."""
        store, root = self._store()
        with store.open_output_stream(f"{root}/_cursor.tmp") as s:
            s.write(json.dumps(end).encode())
        store.move(f"{root}/_cursor.tmp", f"{root}/_cursor.json")


class Crawl(DataSource):
    @classmethod
    def name(cls) -> str:
        return "cairn-crawl"

    def schema(self) -> str:
        return ROWS

    def streamReader(self, schema) -> Crawler:
        return Crawler(self.options)


def crawl(spark: SparkSession, root: str, out: str, checkpoint: str, pages: int = 0) -> DataFrame:
    """One run over the pages below root, at most `pages` of them if positive (R7), added to the files below out; all that has been
    read so far, each page once a pass. A stopped run goes on from its checkpoint and reads no page twice."""
    spark.dataSource.register(Crawl)
    stream = spark.readStream.format("cairn-crawl").option("root", root).option("pages", pages).load()
    query = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    ends = [s["endOffset"] for p in query.recentProgress for s in json.loads(p.json)["sources"] if s.get("endOffset")]
    if ends:  # a run that ends without another batch does not commit its last one to the source
        Crawler({"root": root}).commit(ends[-1] if isinstance(ends[-1], dict) else json.loads(ends[-1]))
    return spark.read.schema(ROWS).parquet(out)
