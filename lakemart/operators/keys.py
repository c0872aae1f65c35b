"""Dense surrogate keys (1, 2, 3, ... in natural-key order) without a single task.

``row_number()`` over an unpartitioned window would pull the whole table into one
task. Instead:

1. range-partition on the natural key and sort within partitions, so partition i
   holds a contiguous key range below partition i+1's;
2. checkpoint that layout to the session's shared checkpoint folder, so the
   partition contents stay fixed between the counting job and the numbering job
   (and a lost executor re-reads them instead of re-sampling the ranges);
3. count rows per partition (one small row per partition), turn the counts into
   start offsets with a running sum over those few rows, and broadcast them
   (the offsets table has exactly one row per partition: a proven bound);
4. key = offset of the partition + position in the partition + 1, where the
   position comes from ``monotonically_increasing_id`` (partition id in the
   upper bits, row position in the lower 33 bits).

Ties in the natural key get distinct consecutive numbers, ordered by the other
columns; for a dimension the natural key is unique.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakemart.operators.dedup import orderable
from lakemart.session import checkpoint_dir

_POS_MASK = (1 << 33) - 1


def with_surrogate_key(
    df: DataFrame,
    natural_key: Sequence[str] | str,
    name: str = "sk",
    num_partitions: int | None = None,
) -> DataFrame:
    """Add ``name`` = dense 1-based rank of each row in ``natural_key`` order."""
    keys = [natural_key] if isinstance(natural_key, str) else list(natural_key)
    spark = df.sparkSession
    checkpoint_dir(spark)  # fail early when no shared folder is configured
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    # the other columns break ties, so a repeated key value cannot pile up in one
    # range and equal keys are numbered in a fixed order
    order = keys + [c for c in df.columns if c not in keys and orderable(df.schema[c].dataType)]
    laid_out = df.repartitionByRange(n, *order).sortWithinPartitions(*order).checkpoint(eager=True)

    tagged = laid_out.select(
        "*",
        F.spark_partition_id().alias("_pid"),
        (F.monotonically_increasing_id().bitwiseAND(F.lit(_POS_MASK))).alias("_pos"),
    )
    counts = tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_pid", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    numbered = tagged.join(F.broadcast(offsets), "_pid")  # n rows, one a partition
    return numbered.select(
        *df.columns, (F.col("_off") + F.col("_pos") + F.lit(1)).cast("bigint").alias(name)
    )
