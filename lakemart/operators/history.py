"""History of slowly changing rows from feeds that come in any order.

A feed says what its keys looked like on its day. The history of a key is what its
observations say, taken by day: a row from the first day of a run of equal values (NULLs
equal) to the first day of another value, the last row open. It depends on the observations
alone, so feeds that come late, again or in any order give one history; of two feeds of one
day the one loaded later counts. A key that a feed lacks is not observed that day.

To split a row rightly when a late feed falls into it, each row keeps the days it was
``seen`` on: a value seen on days 1 and 3 with another one on day 2 is two rows.

A feed changes at most three rows of a key: the one that covers its day, the one before
(if the new value continues it) and the one behind (if that continues the new value). They
are found by aggregates that combine map-side, never by gathering a key's rows, so a key
with very many rows is no burden to one task. ``store_feed`` keeps the history in parts by
(closed, bucket of the key) and rewrites only parts that a changed row is in: a usual feed
leaves closed rows alone but for the buckets of keys that changed.

A NULL key is one key. A feed that repeats a key gives the row ``dedup`` keeps. An empty feed
changes nothing. Columns of the feed besides key and tracked ones are left out.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.operators.dedup import dedup
from lakemart.operators.scd import IS_CURRENT, VALID_FROM, VALID_TO, _as_of
from lakemart.sources import versions
from lakemart.sources.files import delete_path
from lakemart.sources.versions import Snapshot

SEEN = "seen"
#: Parts a stored history is dealt into: open rows of one part are rewritten together, so
#: about (open rows) / (rows a part should have). Fixed by the first feed.
BUCKETS = 64
PART = ("closed", "bucket")


def _started(feed: DataFrame, key: str, tracked: Sequence[str], day: Column) -> DataFrame:
    return feed.select(
        key, *tracked, day.alias(VALID_FROM), F.lit(None).cast("date").alias(VALID_TO), F.array(day).alias(SEEN)
    )


def feed_edits(history: DataFrame, incoming: DataFrame, key: str, tracked: Sequence[str], as_of) -> DataFrame:
    """What a feed changes: per key, the rows that go (``gone``: their first days, and whether
    they are closed) and those that come (``made``). Keys without a change have no row."""
    day = _as_of(as_of)
    feed = dedup(incoming.select(key, *tracked), [key]).select(
        F.col(key).alias("f_key"), F.struct(*tracked).alias("v")
    )
    met = history.join(feed.select("f_key"), F.col(key).eqNullSafe(F.col("f_key")), "left_semi")
    row = F.struct(VALID_FROM, VALID_TO, SEEN, F.struct(*tracked).alias("v"))

    def chosen(pick, condition: Column) -> Column:
        return pick(F.when(condition, row), F.when(condition, F.col(VALID_FROM)))

    start, end = F.col(VALID_FROM), F.col(VALID_TO)
    near = met.groupBy(F.col(key).alias("h_key")).agg(
        chosen(F.max_by, end == day).alias("p"),
        chosen(F.max_by, (start <= day) & (end.isNull() | (end > day))).alias("c"),
        chosen(F.min_by, start > day).alias("n"),
    )
    x = feed.join(near, F.col("f_key").eqNullSafe(F.col("h_key")), "left").select("f_key", "v", "p", "c", "n")

    there = F.col("c").isNotNull()
    x = x.select(
        "*",
        F.when(there, F.filter("c.seen", lambda s: s < day)).otherwise(F.array().cast("array<date>")).alias("left"),
        F.when(there, F.filter("c.seen", lambda s: s > day)).otherwise(F.array().cast("array<date>")).alias("right"),
        (there & F.col("c.v").eqNullSafe(F.col("v"))).alias("same"),
    )
    x = x.where(~(F.col("same") & F.array_contains("c.seen", day)))
    begins, ends = F.size("left") == 0, F.size("right") == 0
    x = x.select(
        "*",
        (~F.col("same") & there & begins & F.col("p").isNotNull() & F.col("p.v").eqNullSafe(F.col("v"))).alias("join_p"),
        (~F.col("same") & ends & F.col("n").isNotNull() & F.col("n.v").eqNullSafe(F.col("v"))).alias("join_n"),
    )
    none = F.array().cast("array<date>")

    def version(v_from: Column, v_to: Column, seen: Column, values: str) -> Column:
        return F.struct(v_from.alias(VALID_FROM), v_to.alias(VALID_TO), seen.alias(SEEN), F.col(values).alias("v"))

    until = F.when(~ends, F.element_at("right", 1)).when(there, F.col("c.valid_to")).otherwise(F.col("n.valid_from"))
    middle = version(
        F.when(F.col("join_p"), F.col("p.valid_from")).otherwise(day),
        F.when(F.col("join_n"), F.col("n.valid_to")).otherwise(until),
        F.concat(
            F.when(F.col("join_p"), F.col("p.seen")).otherwise(none),
            F.array(day),
            F.when(F.col("join_n"), F.col("n.seen")).otherwise(none),
        ),
        "v",
    )
    once_more = version(
        F.col("c.valid_from"), F.col("c.valid_to"), F.array_sort(F.array_append("c.seen", day)), "v"
    )
    made = F.when(F.col("same"), F.array(once_more)).otherwise(
        F.array_compact(
            F.array(
                F.when(~begins, version(F.col("c.valid_from"), day, F.col("left"), "c.v")),
                middle,
                F.when(~ends, version(F.element_at("right", 1), F.col("c.valid_to"), F.col("right"), "c.v")),
            )
        )
    )

    def goes(name: str, condition: Column) -> Column:
        return F.when(condition, F.struct(F.col(f"{name}.valid_from"), F.col(f"{name}.valid_to").isNotNull().alias("closed")))

    gone = F.array_compact(F.array(goes("p", F.col("join_p")), goes("c", there), goes("n", F.col("join_n"))))
    return x.select(F.col("f_key").alias(key), gone.alias("gone"), made.alias("made"))


def _edited(history: DataFrame, edits: DataFrame, key: str, tracked: Sequence[str]) -> DataFrame:
    gone = edits.select(F.col(key).alias("g_key"), F.explode("gone").alias("g")).select("g_key", F.col("g.valid_from").alias("g_from"))
    columns = [key, *tracked, VALID_FROM, VALID_TO, SEEN]
    stay = history.select(*columns).join(
        gone, F.col(key).eqNullSafe(F.col("g_key")) & (F.col(VALID_FROM) == F.col("g_from")), "left_anti"
    )
    made = edits.select(key, F.explode("made").alias("m")).select(key, "m.v.*", f"m.{VALID_FROM}", f"m.{VALID_TO}", f"m.{SEEN}")
    return stay.unionByName(made)


def merge_feed(history: DataFrame | None, incoming: DataFrame, key: str, tracked: Sequence[str], as_of) -> DataFrame:
    """The whole history after a feed: key, tracked columns, valid_from, valid_to, seen."""
    if history is None:
        return _started(dedup(incoming.select(key, *tracked), [key]), key, tracked, _as_of(as_of))
    return _edited(history, feed_edits(history, incoming, key, tracked, as_of), key, tracked)


def shown(history: DataFrame) -> DataFrame:
    """As SCD-2 readers expect it: without the days seen, with the current flag."""
    extra = [c for c in (SEEN, *PART) if c in history.columns]
    return history.withColumn(IS_CURRENT, F.col(VALID_TO).isNull()).drop(*extra)


def valid_on(history: DataFrame, as_of) -> DataFrame:
    """The rows that held on a day; keys first seen later have none."""
    day = _as_of(as_of)
    return history.where((F.col(VALID_FROM) <= day) & (F.col(VALID_TO).isNull() | (F.col(VALID_TO) > day)))


def _part(key: Column, closed: Column, buckets: int) -> list[Column]:
    return [closed.cast("int").alias("closed"), F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int").alias("bucket")]


def _code(part: str) -> tuple[int, int]:
    closed, bucket = (int(x.partition("=")[2]) for x in part.split("/"))
    return closed, bucket


def store_feed(
    spark: SparkSession, base: str, table: str, incoming: DataFrame, key: str, tracked: Sequence[str], as_of,
    buckets: int = BUCKETS,
) -> Snapshot:
    """Merge a feed into the stored history and publish it as a new version; only parts with a
    row that goes or comes are written. ``buckets`` counts for the first feed only."""
    tracked, name = list(tracked), f"history/{table}"
    with versions.build(spark, base) as stage:
        known = stage.before is not None and name in stage.before.parts
        stage.note.update(stage.before.note if stage.before else {})
        buckets = stage.note.setdefault(f"buckets/{table}", buckets)
        placed = [*_part(F.col(key), F.col(VALID_TO).isNotNull(), buckets)]
        if not known:
            rows = merge_feed(None, incoming, key, tracked, as_of)
            stage.write_parts(rows.select("*", *placed), name, PART)
        else:
            before = stage.before.read("history", table)
            work = f"{stage.base}/work/edits"
            feed_edits(before, incoming, key, tracked, as_of).write.parquet(work)  # read thrice
            edits = spark.read.parquet(work)
            closed = edits.select(key, F.explode(F.concat(
                F.transform("gone", lambda g: g["closed"]), F.transform("made", lambda m: m[VALID_TO].isNotNull())
            )).alias("c"))
            # at most 2 x buckets pairs of numbers
            touched = {tuple(r) for r in closed.select(*_part(F.col(key), F.col("c"), buckets)).distinct().collect()}
            codes = sorted(b * 2 + c for c, b in touched)
            held = before.where((F.col("bucket") * 2 + F.col("closed")).isin(codes))
            rows = _edited(held, edits, key, tracked).select("*", *placed)
            stage.write_parts(rows, name, PART, lambda part: _code(part) in touched)
            delete_path(spark, f"{stage.base}/work")
    return versions.snapshot(spark, base, stage.version)


def stored(snapshot: Snapshot, table: str) -> DataFrame:
    """A stored history as readers see it; ``is_current`` is read from the folder's name, so
    a filter on it prunes folders."""
    rows = snapshot.read("history", table)
    return rows.withColumn(IS_CURRENT, F.col("closed") == 0).drop(SEEN, *PART)
