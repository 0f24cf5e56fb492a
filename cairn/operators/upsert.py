"""Filing walked items into the catalogue: who is who, in the items' order, and the catalogue rewritten whole.

Which record an item belongs to depends on the items before it: one may have made the record, given it a path, or brought the
episodes by which a later one is its twin. Items that share an id, a path or a base title, with each other or through a stored
record, are put into one group by labels that spread along what they share; a group is decided in order in one task, which holds
identities and episode numbers, never links. The links of all groups are merged flat: a row a link, unions by aggregation.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cairn.functions.text import make_id, path_key, twin_base
from cairn.operators.merge import falsy
from cairn.operators.records import COLUMNS, EMBEDS, SEASONS, flat_links, link_news, link_rows, links, merge_seasons, merged_links, unfolded, union_embeds
from cairn.sources.scratch import forget, saved

#: Episodes that twins have in common, at least.
TWIN_EPISODES = 3
_NUMBERS = "array<struct<season:int,episode:int>>"
#: What names a record: whether an item made it, and the pos of that item or of the stored record.
KEY = ["target_item", "target"]


def _numbers(seasons: Column) -> Column:
    each = F.transform(F.coalesce(seasons, F.array().cast(SEASONS)), lambda s: F.transform(F.coalesce(s["episodes"], F.array()), lambda e: F.struct(s["season"].alias("season"), e["episode"].alias("episode"))))
    return F.array_distinct(F.flatten(each)).cast(_NUMBERS)


def _kind(c: str) -> Column:
    return F.when(F.col(c) == "series", "series").otherwise("movie")


def _fork_title(season: Column) -> Column:
    """The title under which an item is filed that meets a record of the other kind. season: the number of its first season."""
    number = F.coalesce(season, F.lit(1))
    return F.when(F.col("kind") == "series", F.concat("title", F.lit(" Season "), F.when(number == 0, 1).otherwise(number).cast("string"))).otherwise(F.concat("title", F.lit(" Movie")))


def entities(stored: DataFrame, items: DataFrame) -> DataFrame:
    """What decides identities, one row a stored record (item false) and item with links: item, pos, id, kind, path, base,
    numbers (season and episode), and where an item goes that meets a record of the other kind: fork_id, fork_base."""
    old = stored.select(F.lit(False).alias("item"), "pos", "id", "title", F.col("year").cast("int").alias("year"), _kind("kind").alias("kind"), path_key(F.col("page_url")).alias("path"), "seasons")
    new = items.select(F.lit(True).alias("item"), "pos", make_id(F.col("title"), F.col("year")).alias("id"), "title", F.col("year").cast("int").alias("year"), _kind("kind").alias("kind"), path_key(F.col("url")).alias("path"), "seasons")
    both = old.unionByName(new)
    both = both.withColumn("fork_title", F.when(F.col("item"), _fork_title(F.get("seasons", F.lit(0))["season"]))).withColumn("fork_id", F.when(F.col("item"), make_id(F.col("fork_title"), F.col("year"))))
    numbers = F.when(F.col("kind") == "series", _numbers(F.col("seasons"))).otherwise(F.array().cast(_NUMBERS))
    return both.select("item", "pos", "id", "kind", "path", twin_base(F.col("title")).alias("base"), numbers.alias("numbers"), "fork_id", F.when(F.col("item"), twin_base(F.col("fork_title"))).alias("fork_base"))


def grouped(known: DataFrame, save: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """known with `group`: the least home of those that shared keys lead to. An entity's home is its base title, or else its id or
    path, so what has one home is together without being looked up. Only homes that share a further key are spread, from one
    to the next until none changes; save writes each round, so that rounds are not computed again."""
    # 61 bits of a key below its kind, bases first: keys that agree by chance put two groups into one, which decides the same
    key = lambda kind, c: F.when(F.col(c).isNotNull(), F.shiftrightunsigned(F.xxhash64(c), 3) + F.lit(kind << 61))
    base, fork = (F.when(F.col(c) != "", key(0, c)) for c in ("base", "fork_base"))
    known = known.withColumn("home", F.coalesce(base, key(1, "id"), key(2, "path")))
    keys = F.array_distinct(F.array_compact(F.array(base, fork, key(1, "id"), key(1, "fork_id"), key(2, "path"))))
    keys = known.select("item", "home", F.explode(keys).alias("key"))
    # only keys that an item has lead anywhere: no item looks for others
    met = keys.groupBy("key").agg(F.min("home").alias("least"), F.max("home").alias("most"), F.max("item").alias("met")).where("met AND least <> most")
    crossed = save(met.select("key", "least"))
    if crossed.isEmpty():
        return known.withColumnRenamed("home", "group")
    ways = keys.join(crossed, "key").where("home <> least").select("home", F.col("least").alias("to")).distinct()
    ways = save(ways.unionByName(ways.select(F.col("to").alias("home"), F.col("home").alias("to"))))
    label = save(ways.groupBy("home").agg(F.least("home", F.min("to")).alias("label")))
    done = False
    while not done:
        heard = ways.join(label.select(F.col("home").alias("to"), "label"), "to").groupBy("home").agg(F.min("label").alias("new"))
        jump = label.select(F.col("home").alias("label"), F.col("label").alias("far"))
        before, label = label, save(label.join(heard, "home").join(jump, "label", "left").select("home", F.least("label", "new", "far").alias("label"), (F.least("new", "far") < F.col("label")).alias("moved")))
        done = label.where("moved").isEmpty()
        label = label.drop("moved")
        forget(before)
    return known.join(label, "home", "left").withColumn("group", F.coalesce("label", "home")).drop("label", "home")


def decide(rows: list[dict]) -> list[dict]:
    """For each item of one group (numbers: pairs of season and episode; fork_base: none if it is the base), in order: the entity it belongs to (target_item, target), whether it made it, the id and
    title, whether it was filed beside a record of the other kind, and whether it joins a record of another kind.

    A record is met by its id, then by its path, the one that stands first; then a series by its twin: the same base title
    and most episodes in common, at least TWIN_EPISODES. What meets a record of the other kind goes to the fork's id.
    """
    by_id: dict[str, dict] = {}
    by_path: dict[str, dict] = {}
    having: dict[tuple, list[dict]] = defaultdict(list)

    def learn(e: dict, numbers: set) -> None:
        for n in numbers - e["numbers"]:
            having[(e["base"], *n)].append(e)
        e["numbers"] |= numbers

    def add(e: dict, numbers: set) -> None:
        by_id.setdefault(e["id"], e)
        by_path.setdefault(e["path"], e)
        e["order"] = len(orders)
        orders.append(e)
        learn(e, numbers)

    orders: list[dict] = []
    out = []
    for r in sorted(rows, key=lambda r: (r["item"], r["pos"])):
        numbers = set(r["numbers"])
        if not r["item"]:
            add({**r, "numbers": set()}, numbers)
            continue
        hit = by_id.get(r["id"]) or by_path.get(r["path"])
        if hit is None and r["kind"] == "series" and r["base"] and len(numbers) >= TWIN_EPISODES:
            shared = Counter(e["order"] for n in numbers for e in having[(r["base"], *n)] if e["kind"] == "series")
            best = max(shared, key=lambda k: (shared[k], -k), default=None)
            hit = orders[best] if best is not None and shared[best] >= TWIN_EPISODES else None
        name, forked = r["id"], hit is not None and hit["kind"] != r["kind"]
        if forked:
            name, hit = r["fork_id"], by_id.get(r["fork_id"])
        made = hit is None
        if made:
            hit = {**r, "id": name, "base": r["base"] if not forked or r["fork_base"] is None else r["fork_base"], "numbers": set()}
            add(hit, numbers)
        else:
            learn(hit, numbers)
        out.append({"pos": r["pos"], "target_item": hit["item"], "target": hit["pos"], "made": made, "id": hit["id"], "forked": forked, "other_kind": hit["kind"] != r["kind"]})
        if r["kind"] == "series":
            hit["kind"] = "series"
    return out


_DECIDED = pa.schema([("pos", pa.int64()), ("target_item", pa.bool_()), ("target", pa.int64()), ("made", pa.bool_()), ("id", pa.string()), ("forked", pa.bool_()), ("other_kind", pa.bool_())])


def _rows(batch: pa.RecordBatch) -> Iterator[dict]:
    """The batch's rows as dicts, numbers as lists of pairs: arrays are read flat, not a dict an episode."""
    lists = [batch.column(c) for c in ("season", "episode")]
    pairs, ends = list(zip(*(x.values.to_pylist() for x in lists))), lists[0].offsets.to_pylist()
    names = [c for c in batch.schema.names if c not in ("season", "episode")]
    for i, r in enumerate(zip(*(batch.column(c).to_pylist() for c in names))):
        yield {**dict(zip(names, r)), "numbers": pairs[ends[i] : ends[i + 1]]}


def identified(known: DataFrame, save: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """pos of each item, with what `decide` says of it. Groups lie whole and one after another in sorted partitions; those
    without an item stay out of Python."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, rows, out = None, [], []
        for b in batches:
            for r in _rows(b):
                if rows and r["group"] != group:
                    out += decide(rows)
                    rows = []
                group = r["group"]
                rows.append(r)
            if len(out) >= 10_000:
                yield pa.RecordBatch.from_pylist(out, schema=_DECIDED)
                out = []
        yield pa.RecordBatch.from_pylist(out + decide(rows), schema=_DECIDED)

    ddl = "pos bigint, target_item boolean, target bigint, made boolean, id string, forked boolean, other_kind boolean"
    # rows move once, without links; a fork's base that is the base itself, and a struct an episode, would only be larger
    rows = grouped(known, save).withColumn("fork_base", F.when(~F.col("fork_base").eqNullSafe(F.col("base")), F.col("fork_base")))
    rows = rows.select("group", "item", "pos", "id", "kind", "path", "base", "fork_id", "fork_base", F.col("numbers.season").alias("season"), F.col("numbers.episode").alias("episode")).repartition("group")
    rows = rows.withColumn("met", F.max("item").over(Window.partitionBy("group"))).where("met").drop("met")
    return rows.sortWithinPartitions("group").mapInArrow(run, ddl)


def _sources(stored: DataFrame, items: DataFrame, save: Callable[[DataFrame], DataFrame]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(items, source, folded): items in their shape; a row a source of links, which are the stored records that items reach (src -1,
    made null) and the items with links (src their pos, made whether they made their record); and the sources of records that
    items of both kinds reach, nested. Links are in `flat`, a text of `flat_links`; stale: a series' flat links do not follow from its seasons."""
    empty, none = F.array().cast(EMBEDS), F.array().cast(SEASONS)
    items = items.select(F.col("pos").cast("long").alias("pos"), "url", "title", F.coalesce(F.col("year"), F.lit(0)).cast("int").alias("year"), _kind("kind").alias("kind"), "embeds", F.coalesce("seasons", none).alias("seasons"), F.coalesce("poster", F.lit("")).alias("poster"))
    items = items.withColumn("embeds", F.when(F.col("kind") == "series", links(F.col("seasons"))).otherwise(F.coalesce("embeds", empty)))
    live = items.where(F.size("embeds") > 0)
    known = save(entities(stored, live))
    who = save(identified(known, save))
    forget(known)
    # written, so that their size is known before a join: the few there are go to the sources, which stay where they are
    mixed = save(who.where("other_kind").select(*KEY).distinct().withColumn("mixed", F.lit(True)))
    mixers = save(who.join(mixed, KEY).select("pos", *KEY))
    step = ("src", "kind", "title", "year", "poster")
    met = who.where("NOT target_item").select(F.col("target").alias("pos")).distinct()
    base = stored.select("pos", F.lit(-1).cast("long").alias("src"), _kind("kind").alias("kind"), "title", F.col("year").cast("int").alias("year"), "poster", F.coalesce("embeds", empty).alias("embeds"), F.coalesce("seasons", none).alias("seasons"))
    stale = (F.col("kind") == "series") & (F.to_json("embeds") != F.to_json(links(F.col("seasons"))))
    at = [F.lit(False).alias("target_item"), F.col("pos").alias("target")]
    old = base.select("pos", *step, flat_links().alias("flat"), F.coalesce(stale, F.lit(False)).alias("stale")).join(met, "pos", "left_semi").select(*at, *step, "flat", "stale")
    steps = live.withColumn("src", F.col("pos"))
    new = steps.select("pos", *step, flat_links().alias("flat"), F.lit(False).alias("stale"), "url").join(who.select("pos", *KEY, "forked", "made", "id"), "pos")
    new = new.select(*KEY, *step, "flat", "stale", "url", "id", "forked", "made", F.when(F.col("forked"), _fork_title(F.get(unfolded(F.col("flat"))["season"], F.lit(0)))).alias("fork_title"))
    source = save(old.unionByName(new, allowMissingColumns=True).join(mixed, KEY, "left").withColumn("mixed", F.coalesce("mixed", F.lit(False))))
    reached = mixed.where("NOT target_item").select(F.col("target").alias("pos"))
    folded = base.join(reached, "pos", "left_semi").select(*at, *step, "embeds", "seasons").unionByName(steps.join(mixers, "pos").select(*KEY, *step, "embeds", "seasons"))
    folded = save(folded)
    forget(who, mixed, mixers)
    return items, source, folded


def _logged(source: DataFrame, folded: DataFrame, news: DataFrame, save: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The log's rows of items with links, and the record each belongs to. news: (src, episodes) of what links brought."""
    plain, none = source.where("NOT mixed"), F.lit(0).alias("episodes")
    # a series' flat links are derived anew by the first item that reaches it
    stale = save(plain.where("stale").select(*KEY))
    first = plain.where("src >= 0").join(stale, KEY, "left_semi").groupBy(*KEY).agg(F.min("src").alias("src")).select("src", none)
    art = plain.where(~falsy(F.col("poster"))).groupBy(*KEY).agg(F.min("src").alias("src")).select("src", none)
    changes = news.select("src", "episodes").unionByName(first).unionByName(art).unionByName(_fold_mixed(folded)[0].select("src", "episodes"))
    log = source.where("made IS NOT NULL").join(changes.where("src >= 0").groupBy("src").agg(F.max("episodes").alias("episodes")), "src", "left")
    action = F.when(F.col("made"), "added").when(F.col("episodes").isNotNull(), "merged").otherwise("unchanged")
    note = F.when(F.col("made") & F.col("forked"), F.concat(F.lit("kept the stored "), F.when(F.col("kind") == "series", "movie").otherwise("series"), F.lit(' · filed as "'), "fork_title", F.lit('"'))).otherwise("")
    log = save(log.select(F.col("src").alias("pos"), "url", "id", action.alias("action"), note.alias("note"), F.coalesce("episodes", F.lit(0)).alias("new_episodes"), *KEY, "forked", "fork_title"))
    forget(stale)
    return log


def _whole_log(log: DataFrame, items: DataFrame) -> DataFrame:
    idle = items.where(F.size("embeds") == 0).select("pos", "url", F.lit(None).cast("string").alias("id"), F.lit("unchanged").alias("action"), F.lit("").alias("note"), F.lit(0).alias("new_episodes"))
    return log.select(*idle.columns).unionByName(idle)


def upsert_log(stored: DataFrame, items: DataFrame, save: Callable[[DataFrame], DataFrame] = saved) -> DataFrame:
    """The log of `upsert` alone: links are compared, but no record is put together from them."""
    items, source, folded = _sources(stored.withColumn("pos", F.col("pos").cast("long")), items, save)
    log = _logged(source, folded, link_news(link_rows(source.where("NOT mixed"), KEY, F.col("src")), KEY), save)
    forget(source, folded)
    return _whole_log(log, items)


def upsert(stored: DataFrame, items: DataFrame, as_of: Column, save: Callable[[DataFrame], DataFrame] = saved) -> tuple[DataFrame, DataFrame]:
    """(catalogue, log): the whole catalogue with the items filed in, and one row an item.

    stored: the columns of a record (see `records`) and pos, its order; items: pos, url, title, year, kind, embeds, seasons, poster.
    Both are read several times, so they should be tables, not long plans.
    The catalogue has the records' columns and place, their order: stored ones first, then new ones in the items' order. What an item makes
    has added_at = as_of; what items change has updated_at = as_of; all other records come back as they were. The log has
    pos, url, id, action (added, merged, unchanged), note and new_episodes; an item without links is unchanged and has no id.
    pos must be unique on either side; columns beyond these are left behind. A record that items of both kinds reach through
    a fork keeps what either brought: links outside seasons stay only until the next series item, as in a fold in order.
    save writes a table and reads it again, in a folder that all executors share.
    """
    empty, key = F.array().cast(EMBEDS), KEY
    stored = stored.withColumn("pos", F.col("pos").cast("long"))
    items, source, folded = _sources(stored, items, save)
    plain = source.where("NOT mixed")
    content, news = merged_links(link_rows(plain, key, F.col("src")), key, save)
    log = _logged(source, folded, news, save)
    fields = plain.groupBy(*key).agg(
        F.min_by("title", "src").alias("title"), F.coalesce(F.min_by("year", F.when(~falsy(F.col("year")), F.col("src"))), F.lit(0)).alias("year"),
        F.coalesce(F.min_by("poster", F.when(~falsy(F.col("poster")), F.col("src"))), F.lit("")).alias("poster"), F.min_by("kind", "src").alias("kind"),
    )
    content = content.select(*key, F.when(F.col("movie"), F.col("embeds")).alias("embeds"), "seasons")
    done = fields.join(content, key, "left").unionByName(_fold_mixed(folded)[1])
    touched = log.groupBy(*key).agg(F.max(F.col("action") == "merged").alias("changed"))
    done = done.join(touched, key)
    # flat links that follow from seasons do not move with them
    done = done.withColumn("embeds", F.coalesce("embeds", F.when(F.col("kind") == "series", links(F.col("seasons"))), empty))
    now = stored.join(done.where("NOT target_item").drop("target_item", "title").withColumnRenamed("target", "pos").select("pos", *(F.col(c).alias(f"n_{c}") for c in ("year", "kind", "poster", "embeds", "seasons", "changed"))), "pos", "left")
    hit = F.col("n_changed").isNotNull()
    is_series = F.col("n_kind") == "series"
    value = {
        "year": F.when(hit, F.col("n_year")).otherwise(F.col("year")).cast("int"), "kind": F.when(hit & is_series, "series").otherwise(F.col("kind")),
        "poster": F.when(hit & falsy(F.col("poster")), F.col("n_poster")).otherwise(F.col("poster")), "embeds": F.when(hit, F.col("n_embeds")).otherwise(F.col("embeds")),
        "seasons": F.when(hit & is_series, F.coalesce("n_seasons", F.array().cast(SEASONS))).otherwise(F.col("seasons")), "updated_at": F.when(F.coalesce("n_changed", F.lit(False)), as_of).otherwise(F.col("updated_at")),
    }
    place = lambda new, pos: F.struct(F.lit(new).alias("new"), F.col(pos).alias("pos")).alias("place")
    old = now.select(*(value.get(c, F.col(c)).alias(c) for c in COLUMNS), place(0, "pos"))
    made = log.where("action = 'added'").select(*key, "id", "url", F.when(F.col("forked"), F.col("fork_title")).alias("fork_name")).join(done.where("target_item"), key)
    types = dict(stored.dtypes)
    fresh = {"id": F.col("id"), "title": F.coalesce("fork_name", "title"), "year": F.col("year"), "kind": F.when(F.col("kind") == "series", "series"), "page_url": F.col("url"), "embeds": F.col("embeds"), "poster": F.col("poster"), "rating": F.lit(0), "tmdb_id": F.lit(0), "imdb_id": F.lit(""), "added_at": as_of, "seasons": F.when(F.col("kind") == "series", F.col("seasons")), "updated_at": F.when(F.col("changed"), as_of)}
    new = made.select(*(fresh.get(c, F.lit(None)).cast(types[c]).alias(c) for c in COLUMNS), place(1, "target"))
    return old.unionByName(new), _whole_log(log, items)


def _fold_mixed(source: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The few records that items of both kinds reach, folded in order by the nested expressions of `records`."""
    key = KEY
    step = F.struct("src", "kind", "title", "year", "poster", "embeds", "seasons")
    state = "struct<kind:string,title:string,year:int,poster:string,embeds:" + EMBEDS + ",seasons:" + SEASONS + ">"
    rows = source.groupBy(*key).agg(F.array_sort(F.collect_list(step)).alias("steps"))
    view = lambda r: F.to_json(F.struct(r["embeds"].alias("e"), r["seasons"].alias("s"), F.coalesce(r["poster"], F.lit("")).alias("p")))
    count = lambda seasons: F.aggregate(seasons, F.lit(0), lambda n, s: n + F.size(s["episodes"]))

    def one(acc: Column, s: Column) -> Column:
        now, series = acc["now"], s["kind"] == "series"
        seasons = F.when(series, merge_seasons(now["seasons"], s["seasons"])).otherwise(now["seasons"])
        embeds = F.when(series, links(seasons)).otherwise(union_embeds(now["embeds"], s["embeds"]))
        new = F.struct(F.when(series, "series").otherwise(now["kind"]).alias("kind"), now["title"].alias("title"), F.when(falsy(now["year"]), s["year"]).otherwise(now["year"]).alias("year"), F.when(falsy(now["poster"]), s["poster"]).otherwise(now["poster"]).alias("poster"), embeds.alias("embeds"), seasons.alias("seasons")).cast(state)
        change = F.when(view(now) != view(new), F.array(F.struct(s["src"].alias("src"), (count(new["seasons"]) - count(now["seasons"])).alias("episodes")))).otherwise(F.array().cast("array<struct<src:bigint,episodes:int>>"))
        return F.struct(new.alias("now"), F.concat(acc["log"], change.cast("array<struct<src:bigint,episodes:int>>")).alias("log"))

    first = F.get("steps", F.lit(0))
    begin = F.struct(F.struct(*(first[c].alias(c) for c in ("kind", "title", "year", "poster", "embeds", "seasons"))).cast(state).alias("now"), F.when(first["src"] >= 0, F.array(F.struct(first["src"].alias("src"), count(first["seasons"]).alias("episodes")))).otherwise(F.array()).cast("array<struct<src:bigint,episodes:int>>").alias("log"))
    done = rows.select(*key, F.aggregate(F.slice("steps", 2, F.greatest(F.size("steps") - 1, F.lit(0))), begin, one).alias("r"))
    log = done.select(*key, F.explode("r.log").alias("x")).select(*key, "x.src", "x.episodes")
    return log, done.select(*key, *(F.col(f"r.now.{c}").alias(c) for c in ("title", "year", "poster", "kind", "embeds", "seasons")))
