"""Incremental file loading with Structured Streaming (auto-load and bulk copy).

A file-source stream remembers which files it has read in its checkpoint, and the
Parquet file sink commits each micro-batch atomically through its metadata log,
so every arriving file is loaded exactly once, also across restarts and lost
executors. ``trigger(availableNow=True)`` processes whatever has arrived (in
rate-limited micro-batches) and stops: the scheduled "copy into" form. Without it
the query keeps running and picks up new files as they land.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery


def auto_load(
    spark: SparkSession,
    src: str,
    dst: str,
    schema: T.StructType,
    checkpoint: str,
    fmt: str = "parquet",
    available_now: bool = True,
    partition_by: Sequence[str] = (),
    max_files_per_trigger: int | None = None,
    **options,
) -> StreamingQuery:
    """Start a stream that copies new files under ``src`` into Parquet at ``dst``.

    With ``partition_by``, rows of one partition value meet before they are written (as in
    ``write_layer``): a batch adds a file or a few to each folder, not one a task, which
    every later reader of the new files would list and open."""
    reader = spark.readStream.schema(schema).format(fmt).options(**options)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    rows = reader.load(src)
    if partition_by:
        rows = rows.hint("rebalance", *partition_by)
    writer = (
        rows.writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
    )
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start(dst)


def copy_into(
    spark: SparkSession,
    stage: str,
    dst: str,
    schema: T.StructType,
    checkpoint: str,
    fmt: str = "parquet",
    **options,
) -> int:
    """Load the staged files not loaded before; returns the number of rows loaded.

    Running it again without new files loads nothing (the checkpoint remembers).
    """
    # a query tells of as many of its last batches as this setting says: here, of all
    kept = "spark.sql.streaming.numRecentProgressUpdates"
    before = spark.conf.get(kept)
    spark.conf.set(kept, str((1 << 31) - 1))
    try:
        q = auto_load(spark, stage, dst, schema, checkpoint, fmt=fmt, available_now=True, **options)
        q.awaitTermination()
        if q.exception() is not None:
            raise q.exception()
        return int(sum(p.get("numInputRows", 0) for p in q.recentProgress))
    finally:
        spark.conf.set(kept, before)


# Raw landing tables of the warehouse load: landing name -> staged table (the keyed star's,
# and gold's where it has no keys).
RAW_LANDING = {
    "raw_dim_customer": "dim_customer",
    "raw_dim_product": "dim_product",
    "raw_dim_seller": "dim_seller",
    "raw_dim_payment": "dim_payment",
    "raw_dim_date": "dim_date",
    "raw_fact_order_items": "fact_order_items",
    "raw_fact_payments": "fact_payments",
    "raw_fact_orders": "fact_orders",
}


def load_raw_landing(
    spark: SparkSession,
    stage: str,
    base: str,
    tables: dict[str, str] | None = None,
) -> dict[str, int]:
    """Bulk-load staged Parquet into the raw landing tables, once per file.

    ``<stage>/<staged table>`` -> ``<base>/raw/<landing table>``; each table keeps its
    own stream checkpoint under ``<base>/_checkpoints/raw/``. Returns rows loaded per
    table (0 when nothing new was staged).
    """
    tables = tables or RAW_LANDING
    loaded = {}
    for landing, staged in tables.items():
        src = f"{stage.rstrip('/')}/{staged}"
        schema = spark.read.parquet(src).schema
        loaded[landing] = copy_into(
            spark, src, f"{base.rstrip('/')}/raw/{landing}", schema,
            f"{base.rstrip('/')}/_checkpoints/raw/{landing}",
        )
    return loaded
