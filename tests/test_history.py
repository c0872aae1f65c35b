"""Histories from feeds in any order, whole and stored in parts."""

from __future__ import annotations

import datetime as dt
import itertools
import random

from pyspark.sql import functions as F

from lakemart.operators import history as H
from lakemart.sources import versions as V

SCHEMA = "id string, city string, state string"


def day(n):
    return dt.date(2020, 1, 1) + dt.timedelta(days=n)


def runs(feeds):
    """Brute force: observations by key and day (the later feed of a day counts), as runs."""
    seen = {}
    for n, rows in feeds:
        for key, *values in rows:
            seen.setdefault(key, {})[n] = tuple(values)
    out = set()
    for key, by_day in seen.items():
        firsts = []
        for n in sorted(by_day):
            if not firsts or firsts[-1][1] != by_day[n]:
                firsts.append((n, by_day[n]))
        for k, (n, values) in enumerate(firsts):
            end = day(firsts[k + 1][0]) if k + 1 < len(firsts) else None
            out.add((key, *values, day(n), end, end is None))
    return out


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def rows_of(df):
    got = [tuple(r) for r in df.select("id", "city", "state", "valid_from", "valid_to", "is_current").collect()]
    assert len(got) == len(set(got))
    return set(got)


def merged(spark, feeds):
    hist = None
    for n, rows in feeds:
        hist = H.merge_feed(hist, frame(spark, rows), "id", ["city", "state"], day(n))
        hist = spark.createDataFrame(hist.collect(), hist.schema)
    return rows_of(H.shown(hist))


def test_every_order_of_feeds_gives_one_history(spark):
    feeds = [
        (1, [("a", "x", None), ("b", "x", "s"), (None, "x", "s")]),
        (2, [("a", "y", None), ("b", "x", "s"), ("c", "z", "s")]),
        (3, [("a", "x", None), ("b", "w", "s"), (None, None, None)]),
        (4, [("a", "x", None), ("b", "x", "s"), ("c", "z", "s")]),
    ]
    want = runs(feeds)
    assert ("a", "x", None, day(3), None, True) in want
    for order in list(itertools.permutations(feeds))[::3]:
        assert merged(spark, order) == want


def test_late_feed_between_two_days_seen(spark):
    one, two = [("k", "a", "s")], [("k", "b", "s")]
    assert merged(spark, [(1, one), (5, one), (3, two)]) == runs([(1, one), (3, two), (5, one)])
    # and the value in the middle is corrected on its day: one row again
    assert merged(spark, [(1, one), (5, one), (3, two), (3, one)]) == {("k", "a", "s", day(1), None, True)}
    # earlier than all, equal and not
    assert merged(spark, [(5, one), (2, one), (1, two)]) == runs([(1, two), (2, one)])


def test_again_and_empty_feeds_change_nothing(spark, scratch):
    feed = [("k", "a", None), ("k", "a", None), (None, None, None)]
    want = {("k", "a", None, day(1), None, True), (None, None, None, day(1), None, True)}
    assert merged(spark, [(1, feed), (1, feed), (1, [])]) == want
    assert merged(spark, [(1, []), (2, feed[:1])]) == {("k", "a", None, day(2), None, True)}
    H.store_feed(spark, scratch, "t", frame(spark, []), "id", ["city", "state"], day(1))
    snap = H.store_feed(spark, scratch, "t", frame(spark, feed), "id", ["city", "state"], day(1))
    assert rows_of(H.stored(snap, "t")) == want
    snap = H.store_feed(spark, scratch, "t", frame(spark, feed), "id", ["city", "state"], day(1))
    assert rows_of(H.stored(snap, "t")) == want
    assert snap.version not in snap.parts["history/t"].written.values()


def test_random_feeds_stored(spark, scratch):
    rng, feeds = random.Random(3), []
    for n in [4, 1, 6, 3, 4, 2]:
        keys = rng.sample([f"k{i}" for i in range(12)], 8) + [None]
        feeds.append((n, [(k, rng.choice("xy"), rng.choice(["s", None])) for k in keys]))
        wide = frame(spark, feeds[-1][1]).withColumn("seen", F.lit(1)).withColumn("bucket", F.lit("b"))
        snap = H.store_feed(spark, scratch, "t", wide, "id", ["city", "state"], day(n), buckets=4)
        assert rows_of(H.stored(snap, "t")) == runs(feeds)
    on = H.valid_on(H.stored(snap, "t"), day(3)).select("id", "city").collect()
    want = {r[:2] for r in runs(feeds) if r[3] <= day(3) and (r[4] is None or r[4] > day(3))}
    assert {tuple(r) for r in on} == want and len(on) == len(want)


def test_writes_follow_the_feed(spark, scratch):
    many = [(f"k{i}", "x", "s") for i in range(400)]
    H.store_feed(spark, scratch, "t", frame(spark, many), "id", ["city", "state"], day(1), buckets=32)
    snap = H.store_feed(spark, scratch, "t", frame(spark, [("k7", "y", "s")]), "id", ["city", "state"], day(2))
    new = [p for p, v in snap.parts["history/t"].written.items() if v == snap.version]
    assert len(new) == 2 and {p.split("/")[0] for p in new} == {"closed=0", "closed=1"}
    assert snap.note["buckets/t"] == 32
    assert rows_of(H.stored(snap, "t")) == runs([(1, many), (2, [("k7", "y", "s")])])
    # readers of open rows open their folders only
    plan = H.stored(snap, "t").where("is_current")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(closed" in plan
    assert V.retire(spark, scratch, keep=1) == [1]
    assert H.stored(snap, "t").count() == 401


def test_one_key_with_most_rows_meets_in_partial_aggregates(spark):
    hist = spark.range(3000).selectExpr(
        "'hot' as id", "cast(id as string) as city", "'s' as state", "date_add(date '2000-01-01', cast(id as int)) as valid_from",
        "if(id = 2999, null, date_add(date '2000-01-01', cast(id + 1 as int))) as valid_to",
        "array(date_add(date '2000-01-01', cast(id as int))) as seen",
    )
    late = frame(spark, [("hot", "other", "s")])
    edits = H.feed_edits(hist, late, "id", ["city", "state"], "2004-01-01")
    assert "partial_max_by" in edits._jdf.queryExecution().executedPlan().toString()
    out = H.merge_feed(hist, late, "id", ["city", "state"], "2004-01-01")
    assert out.count() == 3000 and out.where("city = 'other'").count() == 1
