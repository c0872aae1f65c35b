"""Aggregates kept by changes: late, repeated, corrected and removed rows; compaction."""

from __future__ import annotations

import datetime as dt
import random
from collections import defaultdict
from decimal import Decimal

from lakemart.streaming.deltas import compact, keep_cube, read_kept

SCHEMA = (
    "order_id long, order_item_id int, seq long, removed boolean, price decimal(18,2), "
    "freight_value decimal(18,2), customer_state string, year int, month int"
)


def expected(rows):
    holds = {}
    for order, item, seq, removed, price, freight, state, year, month in rows:
        if (order, item) not in holds or holds[order, item][0] < seq:
            holds[order, item] = (seq, removed, price + freight, (year, month, state))
    cells, orders = defaultdict(lambda: [Decimal(0), 0]), defaultdict(set)
    for (order, _), (_, removed, revenue, cell) in holds.items():
        if not removed:
            cells[cell][0] += revenue
            cells[cell][1] += 1
            orders[cell].add(order)
    return {cell: (revenue, n, len(orders[cell])) for cell, (revenue, n) in cells.items()}


def kept(spark, cube):
    return {(r.year, r.month, r.customer_state): (r.revenue, r["items"], r.orders) for r in read_kept(spark, cube).collect()}


def versions(n, seed):
    """(order, item, seq) is given once, so which version holds is plain."""
    rng = random.Random(seed)
    rows = {}
    for _ in range(n):
        order = 1 if rng.random() < 0.3 else rng.randint(1, 40)  # a hot order
        key = (order, rng.randint(1, 12), rng.randint(1, 9))
        cell = (rng.choice(["A", "B", None]), 2020, rng.choice([1, 2]))
        rows[key] = (*key, rng.random() < 0.2, Decimal(rng.randint(0, 900)) / 100, Decimal("0.50"), *cell)
    return list(rows.values())


def run(spark, scratch, waves, between=lambda n: None, schema=SCHEMA, **more):
    for n, wave in enumerate(waves):
        spark.createDataFrame(wave, schema).write.mode("append").parquet(f"{scratch}/in")
        stream = spark.readStream.schema(schema).parquet(f"{scratch}/in")
        keep_cube(spark, stream, f"{scratch}/cube", f"{scratch}/ck", **more).awaitTermination()
        between(n)
    return kept(spark, f"{scratch}/cube")


def test_late_repeated_corrected_and_removed(spark, scratch):
    rows = versions(400, 1)
    waves = [rows[:150], rows[150:300] + rows[:40], rows[300:] + rows[100:200]]
    assert run(spark, scratch, waves) == expected(rows)


def test_compaction_and_a_replayed_batch(spark, scratch):
    rows = versions(300, 2)
    waves = [rows[:100], rows[100:200], rows[200:]]
    done = []

    def between(n):
        before = kept(spark, f"{scratch}/cube")
        assert before == expected([r for w in waves[: n + 1] for r in w])
        if n < 2:
            done.append(compact(spark, f"{scratch}/cube"))
            assert kept(spark, f"{scratch}/cube") == before

    assert run(spark, scratch, waves, between) == expected(rows)
    assert done == sorted(done)
    # changes folded in already are not counted again when their batch is written anew
    folder = f"{scratch}/cube/changes/batch={done[0]:09d}"
    before = kept(spark, f"{scratch}/cube")
    spark.createDataFrame([(2020, 1, "A", Decimal("5.00"), 1, 1)], "year int, month int, customer_state string, revenue decimal(20,2), items long, orders long").write.mode("overwrite").parquet(folder)
    assert kept(spark, f"{scratch}/cube") == before


def test_nothing_yet_and_everything_removed(spark, scratch):
    assert kept(spark, f"{scratch}/none") == {}
    row = (1, 1, 1, False, Decimal("2.00"), Decimal("1.00"), "A", 2020, 1)
    gone = (1, 1, 2, True, None, None, None, None, None)
    assert run(spark, scratch, [[row], [gone]]) == {}


def test_watermark_forgets_old_orders(spark, scratch):
    """Past the watermark an order's state goes; rows that late are dropped."""
    schema = SCHEMA + ", event_time timestamp"
    day = lambda d: dt.datetime(2020, 1, 1, tzinfo=dt.timezone.utc) + dt.timedelta(days=d)
    old = (1, 1, 1, False, Decimal("2.00"), Decimal("1.00"), "A", 2020, 1, day(0))
    new = (2, 1, 1, False, Decimal("4.00"), Decimal("1.00"), "A", 2020, 1, day(60))
    late = (1, 1, 2, False, Decimal("9.00"), Decimal("1.00"), "A", 2020, 1, day(1))
    last = (3, 1, 1, False, Decimal("1.00"), Decimal("0.00"), "A", 2020, 1, day(61))
    got = run(spark, scratch, [[old], [new], [late, last]], schema=schema, watermark="10 days")
    assert got == {(2020, 1, "A"): (Decimal("9.00"), 3, 3)}


def test_versions_are_merged_without_calls_to_a_state_store(spark, scratch, monkeypatch):
    """A call an item made a tenth of a gigabyte take too long; a large order and one
    without an id are merged like any other."""
    from lakemart.streaming import deltas

    monkeypatch.setattr(deltas, "OrderCells", None)
    rows = versions(200, 3)
    rows += [(None, i, 1, False, Decimal("1.00"), Decimal("0.50"), "A", 2020, 1) for i in range(150)]
    rows += [(None, i, 2, i % 2 == 0, Decimal("2.00"), Decimal("0.50"), "B", 2020, 2) for i in range(140)]
    waves = [rows[:250], rows[250:] + rows[:50]]
    assert run(spark, scratch, waves) == expected(rows)
    assert compact(spark, f"{scratch}/cube") == 1
    assert run(spark, scratch, [rows[:10]]) == expected(rows)  # older ones change nothing after it


def test_the_last_batch_replayed_after_compaction(spark, scratch):
    rows = versions(200, 4)
    run(spark, scratch, [rows[:100], rows[100:]])
    compact(spark, f"{scratch}/cube")
    from lakemart.sources.files import delete_path

    delete_path(spark, f"{scratch}/ck/commits/1")
    delete_path(spark, f"{scratch}/ck/commits/.1.crc")
    assert run(spark, scratch, [rows[:5]]) == expected(rows)


def test_a_merge_shuffles_items_once(spark, scratch):
    """Five shuffles and a stored copy of what was merged filled the disks at 6 GB."""
    from pyspark.sql import functions as F

    from lakemart.streaming import deltas

    columns = "order_id long, item struct<n: int>, seq long, removed boolean, revenue decimal(20,2), year int, month int, customer_state string"
    for name, rows in (("held", [(1, (1,), 1, False, Decimal(3), 2020, 1, "A")]), ("came", [(1, (1,), 2, False, Decimal(5), 2020, 2, "A"), (2, (1,), 1, False, Decimal(7), 2020, 2, "A")])):
        spark.createDataFrame(rows, columns).write.parquet(f"{scratch}/{name}")
    merged = deltas._merged(spark.read.parquet(f"{scratch}/came"), spark.read.parquet(f"{scratch}/held"))
    both = merged.where("newer").select("order_id", "item", "after.*").unionByName(deltas._cell_changes(merged), allowMissingColumns=True)
    got = both.where(F.col("items").isNotNull()).select(*deltas.CUBE_KEYS, *deltas._SUMS).collect()
    assert sorted(map(tuple, got)) == [(2020, 1, "A", Decimal("-3.00"), -1, -1), (2020, 2, "A", Decimal("12.00"), 2, 2)]
    both.write.parquet(f"{scratch}/both")
    plan = deltas._cell_changes(merged)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("hashpartitioning(order_id") == 1  # items, then sums by order on the same rows
    assert plan.count("Exchange hashpartitioning") == 2  # and the cells' sums


def shuffle_files(spark):
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return {name for name in blocks.getAllFiles().mkString("\n").split("\n") if name.endswith(".data")}


def test_shuffle_files_go_with_their_batch(spark, scratch, monkeypatch):
    """They lay there until the driver happened to collect its garbage; nothing is cached."""
    import time

    def refused(self, *level):
        raise AssertionError("a batch is written, not cached")

    monkeypatch.setattr(type(spark.range(1)), "persist", refused)
    rows = versions(300, 5)
    before, kind = shuffle_files(spark), "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    set_to = spark.conf.get(kind)
    run(spark, scratch, [rows[:150], rows[150:]], lambda n: compact(spark, f"{scratch}/cube"))
    assert spark.conf.get(kind) == set_to
    read = shuffle_files(spark) - before
    for _ in range(50):
        if not (read := shuffle_files(spark) & read):
            break
        time.sleep(0.1)
    assert len(read) <= 1  # of the sums that the test itself collects


def test_versions_written_before_with_items_named_by_json(spark, scratch):
    from pyspark.sql import functions as F

    from lakemart.sources.files import delete_path

    rows = versions(300, 6)

    def as_before(n):
        if n == 0:
            kept_now = spark.read.parquet(f"{scratch}/cube/merged/batch=000000000").where("items IS NULL").drop("items", "orders")
            kept_now.withColumn("item", F.to_json("item")).write.parquet(f"{scratch}/cube/items/batch=000000000")
            delete_path(spark, f"{scratch}/cube/merged")
            compact(spark, f"{scratch}/cube")

    assert run(spark, scratch, [rows[:150], rows[150:] + rows[:50]], as_before) == expected(rows)
    compact(spark, f"{scratch}/cube")
    assert run(spark, scratch, [rows[:20]]) == expected(rows)
