"""Continuously refreshed revenue aggregates (the README's "dynamic tables").

Source: a stream of item-grain star rows (``order_id, price, freight_value,
customer_state, year, month`` at least), e.g. the Parquet folder an
``auto_load`` stream fills.

State kept: a ``(year, month, customer_state)`` cube with revenue, items and
distinct orders, stored partitioned by ``year, month``. Each micro-batch:

1. finds the months it touches (one row per month: a bounded, small set),
2. recomputes those months' cube rows from the landed table, read with a literal
   partition filter on exactly those months (only their folders are listed and
   read),
3. overwrites exactly those month partitions (dynamic partition overwrite).

Distinct order counts stay exact, which a streaming aggregate cannot give
(``count(distinct)`` is not supported there): an order lies in one month and one
state, so orders per month or per state are sums of the cube's cell counts. A
replayed micro-batch recomputes the same months from the same landed files, so
the refresh is idempotent. Late rows for an old month just make that month
"touched" again.

``revenue_trend`` and ``region_distribution`` read the cube (a few rows per
month and state), not the items.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lakemart.functions import scalar as S
from lakemart.params import Params

CUBE_KEYS = ("year", "month", "customer_state")


def cube_of(items: DataFrame) -> DataFrame:
    return items.groupBy(*CUBE_KEYS).agg(
        F.sum(F.col("price") + F.col("freight_value")).alias("revenue"),
        F.count(F.lit(1)).alias("items"),
        F.countDistinct("order_id").alias("orders"),
    )


def touched_months(batch: DataFrame) -> list[tuple[int, int]]:
    """The (year, month) partition keys of a micro-batch.

    This is partition metadata, bounded by the calendar (12 per year of data),
    not data rows; it becomes a literal partition filter, which Spark always
    prunes on (a join with a small key list gets no dynamic pruning).
    """
    keys = [(r.year, r.month) for r in batch.select("year", "month").distinct().collect()]
    return sorted(keys, key=lambda k: (k[0] is None, k[0] or 0, k[1] is None, k[1] or 0))


def months_filter(months: list[tuple[int, int]]):
    by_year: dict[int, list[int]] = {}
    for y, m in months:
        by_year.setdefault(y, []).append(m)
    cond = F.lit(False)
    for y, ms in sorted(by_year.items(), key=lambda kv: (kv[0] is None, kv[0] or 0)):
        year_cond = F.col("year").isNull() if y is None else F.col("year") == F.lit(y)
        known = [m for m in ms if m is not None]
        month_cond = F.col("month").isin(known) if known else F.lit(False)
        if None in ms:
            month_cond = month_cond | F.col("month").isNull()
        cond = cond | (year_cond & month_cond)
    return cond


def refresh_months(spark: SparkSession, batch: DataFrame, landed: str, cube_path: str) -> None:
    """Recompute and overwrite the cube partitions of the months ``batch`` touches."""
    months = touched_months(batch)
    if not months:
        return
    items = spark.read.parquet(landed).where(months_filter(months))
    (
        cube_of(items)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("year", "month")
        .parquet(cube_path)
    )


def start_refresh(
    spark: SparkSession,
    landed_stream: DataFrame,
    landed: str,
    cube_path: str,
    checkpoint: str,
    available_now: bool = True,
) -> StreamingQuery:
    """Keep the cube at ``cube_path`` current with the stream of landed items."""

    def each_batch(batch: DataFrame, batch_id: int) -> None:
        refresh_months(spark, batch, landed, cube_path)

    writer = landed_stream.writeStream.foreachBatch(each_batch).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def revenue_trend(cube: DataFrame) -> DataFrame:
    out = cube.groupBy("year", "month").agg(
        S.as_double(F.sum("revenue")).alias("revenue"),
        F.sum("orders").alias("orders"),
    )
    return out.withColumn("month_label", S.month_label("year", "month")).orderBy("year", "month")


def region_distribution(cube: DataFrame, params: Params = Params()) -> DataFrame:
    """Revenue and orders per state with the share of revenue (window over the
    per-state rows only)."""
    by_state = cube.groupBy("customer_state").agg(
        F.sum("revenue").alias("rev"), F.sum("orders").alias("orders")
    )
    total = F.sum("rev").over(Window.partitionBy())
    return by_state.select(
        "customer_state",
        S.as_double("rev").alias("revenue"),
        "orders",
        F.round(S.safe_pct("rev", total), params.share_digits).alias("revenue_share_pct"),
    )
