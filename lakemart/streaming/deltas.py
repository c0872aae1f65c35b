"""Continuously kept revenue aggregates, by what changed (no months read again).

Source: a stream of item rows, each a version of one item: ``order_id``, the columns that
name the item within its order (``item_keys``), ``seq`` and, unless ``removed``, ``price,
freight_value, customer_state, year, month``. Of an item's versions the one with the largest ``seq`` holds, whenever it comes; a repeated or
older one changes nothing.

State is the version that holds of each item. What a row replaces is taken back from its
(year, month, state) cell and what it brings is added to its own; an order counts in a cell
from its first item there to its last. Out go changes of (revenue, items, orders) a cell.

Without a watermark state is kept for ever, in tables beside the cube: a micro-batch writes
the versions that came to hold, in a folder named by the batch. The next ones lay theirs and
the held ones out by order, once, and compare before and after by sums there (``_merged``),
so that no item costs a call to a state store. A batch's shuffle files go when it is
written. With a watermark, state is kept per order
(``transformWithState``) and goes when the watermark passes the order's latest event time
(``event_time``); rows that come later than that are dropped by Spark. There the versions
and the counts of cells are map states: a row touches its item and two cells, however many
the order has. Stateful streams of this kind need RocksDB as the session's state store
(``use_rocksdb``).

Each micro-batch's changes are summed per cell and written to a folder named by the batch,
which a replay overwrites with the same rows, so every change counts once. The cube is the
sum over these folders; ``compact`` folds them into a base table under one manifest
(``sources.versions``), and the versions of items likewise. What is written follows the
feed, not the months it touches.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from lakemart.session import DROP_SHUFFLES, shuffles_dropped
from lakemart.sources.files import delete_path, path_exists
from lakemart.sources.versions import _names, build, retire, snapshot
from lakemart.streaming.live import CUBE_KEYS

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
MONEY = "decimal(20,2)"
CHANGES = f"year int, month int, customer_state string, revenue {MONEY}, items long, orders long"
_CELL = "year int, month int, customer_state string"
_ITEM = f"seq long, removed boolean, revenue {MONEY}, {_CELL}"
_SUMS = ("revenue", "items", "orders")
_CHANGE = Row(*CUBE_KEYS, *_SUMS)


def use_rocksdb(spark: SparkSession) -> None:
    """The state store that map states need, where the session names none."""
    if spark.conf.get(PROVIDER, None) != ROCKSDB:
        spark.conf.set(PROVIDER, ROCKSDB)


class OrderCells(StatefulProcessor):
    """Changes of cells from versions of one order's items."""

    def __init__(self, timed: bool = False):
        self.timed = timed

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.items = handle.getMapState("items", "item string", _ITEM)
        self.cells = handle.getMapState("cells", _CELL, "n long")
        self.until = handle.getValueState("until", "at long") if self.timed else None

    def _count(self, cell: tuple, more: int) -> int:
        """Items of the order in a cell after ``more``; the change in orders there."""
        before = self.cells.getValue(cell)[0] if self.cells.containsKey(cell) else 0
        after = before + more
        if after:
            self.cells.updateValue(cell, (after,))
        else:
            self.cells.removeKey(cell)
        return int(after > 0) - int(before > 0)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        changed: dict[tuple, list] = {}

        def add(cell: tuple, revenue: Decimal, sign: int) -> None:
            sums = changed.setdefault(cell, [Decimal(0), 0, 0])
            sums[0] += sign * revenue
            sums[1] += sign
            sums[2] += self._count(cell, sign)

        latest = 0
        for row in rows:
            latest = max(latest, row.at or 0)
            item = (row.item,)
            held = self.items.getValue(item) if self.items.containsKey(item) else None
            if held is not None and held[0] >= row.seq:
                continue  # repeated, or older than what holds
            if held is not None and not held[1]:
                add(tuple(held[3:6]), held[2], -1)
            cell = (row.year, row.month, row.customer_state)
            if not row.removed:
                add(cell, row.revenue, 1)
            self.items.updateValue(item, (row.seq, row.removed, row.revenue, *cell))
        if self.timed:
            self._keep_until(latest)
        for cell, sums in changed.items():
            if any(sums):
                yield _CHANGE(*cell, *sums)

    def _keep_until(self, at: int) -> None:
        before = self.until.get()[0] if self.until.exists() else None
        if before is None or at > before:
            if before is not None:
                self.handle.deleteTimer(before)
            self.handle.registerTimer(at)
            self.until.update((at,))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self.items.clear()
        self.cells.clear()
        self.until.clear()
        return iter(())

    def close(self) -> None:
        pass


def _versions(items: DataFrame, item: Column) -> list[Column]:
    """The columns of an item's version."""
    money = (F.col("price") + F.col("freight_value")).cast(MONEY)
    removed = F.coalesce(F.col("removed"), F.lit(False)) if "removed" in items.columns else F.lit(False)
    return [
        F.col("order_id"),
        item.alias("item"),
        F.col("seq").cast("long").alias("seq"),
        removed.alias("removed"),
        F.coalesce(money, F.lit(0).cast(MONEY)).alias("revenue"),
        F.col("year").cast("int").alias("year"),
        F.col("month").cast("int").alias("month"),
        F.col("customer_state"),
    ]


def changes(items: DataFrame, watermark: str, item_keys: Sequence[str] = ("order_item_id",)) -> DataFrame:
    """A stream of cells' changes from a stream of item versions with a watermark."""
    items = items.withWatermark("event_time", watermark)
    at = [F.col("event_time"), F.unix_millis("event_time").alias("at")]
    return items.select(*_versions(items, F.to_json(F.struct(*item_keys))), *at).groupBy("order_id").transformWithState(
        OrderCells(True), CHANGES, "Update", "EventTime"
    )


_VERSION = ("seq", "removed", "revenue", *CUBE_KEYS)


def _merged(arrived: DataFrame, held: DataFrame | None) -> DataFrame:
    """order_id, item, and the versions that hold ``before`` and ``after`` the rows that
    arrived, of every item. NULL before: an item not seen yet. Rows lie by order, so that
    neither this nor the sums by order shuffle them again."""
    came = arrived.withColumn("came", F.lit(True))
    if held is not None:
        came = came.unionByName(held.withColumn("came", F.lit(False)))
    version = F.struct(*_VERSION)
    # of the versions written of an item, the one with the largest seq holds
    both = came.repartition("order_id").groupBy("order_id", "item").agg(
        F.max(F.when(F.col("came"), version)).alias("new"), F.max(F.when(~F.col("came"), version)).alias("before")
    )
    newer = F.col("new").isNotNull() & (
        F.col("before").isNull() | F.coalesce(F.col("new.seq") > F.col("before.seq"), F.lit(False))
    )
    return both.select("order_id", "item", "before", F.when(newer, F.col("new")).otherwise(F.col("before")).alias("after"), newer.alias("newer"))


def _cell_changes(merged: DataFrame) -> DataFrame:
    """What the cells gain and lose: an order counts once in a cell that holds items of it."""
    sides = F.array(*[F.struct(F.col(side).alias("v"), F.lit(sign).alias("sign")) for side, sign in (("before", -1), ("after", 1))])
    there = merged.select("order_id", F.explode(sides).alias("side")).where("side.v IS NOT NULL AND NOT side.v.removed")
    sign = F.col("side.sign")
    per_order = there.select("order_id", *[F.col(f"side.v.{c}").alias(c) for c in (*CUBE_KEYS, "revenue")], sign.alias("sign")).groupBy("order_id", *CUBE_KEYS).agg(
        F.sum((F.col("revenue") * F.col("sign")).cast(MONEY)).alias("revenue"), F.sum("sign").alias("items"),
        (F.max((F.col("sign") > 0).cast("long")) - F.max((F.col("sign") < 0).cast("long"))).alias("orders"),
    )
    changed = per_order.where("revenue <> 0 OR items <> 0 OR orders <> 0")
    summed = changed.groupBy(*CUBE_KEYS).agg(*[F.sum(c).alias(c) for c in _SUMS])
    return summed.withColumn("revenue", F.col("revenue").cast(MONEY))


def _held(spark: SparkSession, cube: str, below: int | None = None, item: T.DataType | None = None) -> DataFrame | None:
    """Versions of items that the batches numbered ``below`` (all, if None) brought.
    ``item``: the type of what names an item, if known."""
    base = snapshot(spark, f"{cube}/base")
    through = int(base.note["through"]) if base else -1
    parts = []
    for folder, table in (("merged", "versions"), ("items", "items")):  # the latter: written before, items named by JSON
        since = [n for n in _written(spark, cube, folder) if n > through and (below is None or n < below)]
        if since:
            parts.append(spark.read.parquet(*[f"{cube}/{folder}/batch={n:09d}" for n in since]))
        if base is not None and f"cube/{table}" in base.tables:
            parts.append(base.read("cube", table))
    # the rows that have counts are changes of cells
    parts = [(p.where("items IS NULL") if "items" in p.columns else p).select("order_id", "item", *_VERSION) for p in parts]
    item = item or next((p.schema["item"].dataType for p in parts if p.schema["item"].dataType != T.StringType()), None)
    if item is not None:
        parts = [p.withColumn("item", F.from_json("item", item)) if p.schema["item"].dataType == T.StringType() else p for p in parts]
    return reduce(DataFrame.unionByName, parts) if parts else None


def keep_cube(
    spark: SparkSession,
    items: DataFrame,
    cube: str,
    checkpoint: str,
    watermark: str | None = None,
    available_now: bool = True,
    item_keys: Sequence[str] = ("order_item_id",),
) -> StreamingQuery:
    """Keep the cube at ``cube`` current with a stream of item versions. The cube belongs
    to its checkpoint: batches are numbered by it."""

    def sum_batch(batch: DataFrame, batch_id: int) -> None:
        summed = batch.groupBy(*CUBE_KEYS).agg(*[F.sum(c).alias(c) for c in _SUMS])
        summed = summed.withColumn("revenue", F.col("revenue").cast(MONEY))
        summed.write.mode("overwrite").parquet(f"{cube}/changes/batch={batch_id:09d}")

    def merge_batch(batch: DataFrame, batch_id: int) -> None:
        batch.sparkSession.conf.set(DROP_SHUFFLES, "true")  # the stream's own session
        arrived = batch.select(*_versions(batch, F.struct(*item_keys)))
        merged = _merged(arrived, _held(spark, cube, batch_id, arrived.schema["item"].dataType))
        newer = merged.where("newer").select("order_id", "item", "after.*")
        # one write of what holds now and, as rows that have counts, of the change: both
        # come from one shuffle
        both = newer.unionByName(_cell_changes(merged), allowMissingColumns=True)
        both.write.mode("overwrite").option("compression", "zstd").parquet(f"{cube}/merged/batch={batch_id:09d}")
        change = batch.sparkSession.read.parquet(f"{cube}/merged/batch={batch_id:09d}").where("items IS NOT NULL")
        change.select(*CUBE_KEYS, *_SUMS).write.mode("overwrite").parquet(f"{cube}/changes/batch={batch_id:09d}")

    if watermark is None:
        writer = items.writeStream.foreachBatch(merge_batch)
    else:
        use_rocksdb(spark)
        writer = changes(items, watermark, item_keys).writeStream.outputMode("update").foreachBatch(sum_batch)
    writer = writer.option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def _written(spark: SparkSession, cube: str, table: str = "changes") -> list[int]:
    """The batches whose changes (or versions of items) were written in full."""
    folder = f"{cube}/{table}"
    return sorted(int(n.split("=")[1]) for n in _names(spark, folder) if path_exists(spark, f"{folder}/{n}/_SUCCESS"))


def read_kept(spark: SparkSession, cube: str) -> DataFrame:
    """year, month, customer_state, revenue, items, orders: the sum of all changes."""
    base = snapshot(spark, f"{cube}/base")
    through = int(base.note["through"]) if base else -1
    paths = [f"{cube}/changes/batch={b:09d}" for b in _written(spark, cube) if b > through]
    parts = [spark.read.schema(CHANGES).parquet(*paths)] if paths else []
    parts += [base.read("cube", "cells")] if base else []
    if not parts:
        return spark.createDataFrame([], CHANGES)
    stacked = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    summed = stacked.groupBy(*CUBE_KEYS).agg(*[F.sum(c).alias(c) for c in _SUMS])
    return summed.where(F.col("items") > 0).withColumn("revenue", F.col("revenue").cast("decimal(28,2)"))


def compact(spark: SparkSession, cube: str) -> int:
    """Fold the changes written so far into the base; returns the last batch folded in.
    Readers see the old base and the changes, or the new base."""
    done = _written(spark, cube)
    if not done:
        return -1
    kept = read_kept(spark, cube).withColumn("revenue", F.col("revenue").cast(MONEY))
    held = _held(spark, cube, done[-1] + 1)
    with build(spark, f"{cube}/base") as stage, shuffles_dropped(spark):
        kept.write.parquet(f"{stage.base}/cube/cells")
        if held is not None:
            # by order, as merges lay rows out: an order's rows stay together and pack well
            latest = held.repartition("order_id").groupBy("order_id", "item").agg(F.max(F.struct(*_VERSION)).alias("v"))
            latest.select("order_id", "item", "v.*").write.option("compression", "zstd").parquet(f"{stage.base}/cube/versions")
            stage.dropped.add("cube/items")
        stage.note["through"] = done[-1]
    retire(spark, f"{cube}/base")
    for batch in done[:-1]:  # the last one may be replayed
        delete_path(spark, f"{cube}/changes/batch={batch:09d}")
    for batch in done:  # a replay writes its own anew
        for folder in ("merged", "items"):
            delete_path(spark, f"{cube}/{folder}/batch={batch:09d}")
    return done[-1]
