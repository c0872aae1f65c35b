"""Slowly changing dimension, type 2.

``scd2_merge(current, incoming, key, tracked, as_of)`` returns the complete new
history:

- closed rows (``is_current = false``) pass through untouched;
- an open row whose tracked values changed (NULL-safe compare) is closed with
  ``valid_to = as_of``, and a new open row starts at ``as_of``;
- an open row that is unchanged, or missing from the feed, stays as it is
  (the feed is a snapshot of changes, not a delete list);
- a key seen for the first time opens a row at ``as_of``;
- a second feed of the day a row opened corrects that row in place (no row of no
  length), and a feed older than the open row changes nothing of its key.

Re-running the same feed changes nothing (idempotent). One full outer join on
the key (NULL-safe, so a NULL key is one key) reads the history once: closed rows
pass through it, and each joined row emits its old and/or new version through a
two-element array. ``store_merge`` writes a new version and switches a pointer to
it; the folder the current history is read from is never overwritten.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.operators.dedup import dedup
from lakemart.sources.files import path_exists

VALID_FROM, VALID_TO, IS_CURRENT = "valid_from", "valid_to", "is_current"


def _as_of(value) -> Column:
    if isinstance(value, Column):
        return value.cast("date")
    if isinstance(value, (dt.date, dt.datetime)):
        return F.lit(value).cast("date")
    return F.to_date(F.lit(str(value)))


def scd2_initial(incoming: DataFrame, key: str, tracked: Sequence[str], as_of) -> DataFrame:
    """First load: every key opens a row at ``as_of``."""
    feed = dedup(incoming.select(key, *tracked), [key])
    return feed.select(
        key, *tracked,
        _as_of(as_of).alias(VALID_FROM),
        F.lit(None).cast("date").alias(VALID_TO),
        F.lit(True).alias(IS_CURRENT),
    )


def scd2_merge(
    current: DataFrame | None,
    incoming: DataFrame,
    key: str,
    tracked: Sequence[str],
    as_of,
) -> DataFrame:
    """Apply one snapshot feed to an SCD-2 history (see module doc)."""
    tracked = list(tracked)
    if current is None:
        return scd2_initial(incoming, key, tracked, as_of)
    when = _as_of(as_of)
    attrs = [key, *tracked]
    history = current.select(
        *[F.col(c).alias(f"o_{c}") for c in attrs],
        F.col(VALID_FROM).alias("o_from"),
        F.col(VALID_TO).alias("o_to"),
        F.col(IS_CURRENT).alias("o_open"),
        F.lit(True).alias("_o"),
    )
    feed = dedup(incoming.select(*attrs), [key]).select(
        *[F.col(c).alias(f"n_{c}") for c in attrs], F.lit(True).alias("_n")
    )
    # the feed meets open rows only; closed ones pass through the same join
    meets = F.col(f"o_{key}").eqNullSafe(F.col(f"n_{key}")) & (F.col("o_open") == F.col("_n"))
    j = history.join(feed, meets, "full_outer")

    has_o = F.coalesce(F.col("_o"), F.lit(False))
    has_n = F.coalesce(F.col("_n"), F.lit(False))
    same = F.lit(True)
    for c in tracked:
        same = same & F.col(f"o_{c}").eqNullSafe(F.col(f"n_{c}"))
    differs = has_o & has_n & ~same
    changed = differs & (F.col("o_from") < when)  # closed, and followed by a new row
    corrected = differs & (F.col("o_from") == when)  # the day's row takes the new values

    def version(prefix, v_from, v_to, current_flag):
        return F.struct(
            *[F.col(f"{prefix}_{c}").alias(c) for c in attrs],
            v_from.alias(VALID_FROM),
            v_to.alias(VALID_TO),
            current_flag.alias(IS_CURRENT),
        )

    old = F.when(
        has_o & ~corrected,
        version("o", F.col("o_from"), F.when(changed, when).otherwise(F.col("o_to")), F.col("o_open") & ~changed),
    )
    new = F.when(
        has_n & (~has_o | changed | corrected),
        version("n", when, F.lit(None).cast("date"), F.lit(True)),
    )
    emitted = j.select(F.explode(F.array(old, new)).alias("v")).where(F.col("v").isNotNull())
    return emitted.select("v.*")


def stored_history(spark: SparkSession, base: str, table: str) -> DataFrame | None:
    """The version of a stored history that readers are pointed to; None before the first."""
    version = _pointer(spark, base, table)
    return None if version is None else spark.read.parquet(f"{_root(base, table)}/version={version}")


def store_merge(
    spark: SparkSession, base: str, table: str, incoming: DataFrame, key: str, tracked: Sequence[str], as_of
) -> DataFrame:
    """Merge a feed into the stored history: a new version folder is written in full, then
    the pointer is switched to it. A run that fails before leaves readers as they were."""
    now = _pointer(spark, base, table)
    following = 1 if now is None else now + 1
    merged = scd2_merge(stored_history(spark, base, table), incoming, key, tracked, as_of)
    merged.write.mode("overwrite").parquet(f"{_root(base, table)}/version={following}")
    one = spark.createDataFrame([(following,)], "version int").coalesce(1)
    one.write.mode("overwrite").json(f"{_root(base, table)}/pointer/{following:09d}")
    return stored_history(spark, base, table)


def _root(base: str, table: str) -> str:
    return f"{base.rstrip('/')}/history/{table}"


def _pointer(spark: SparkSession, base: str, table: str) -> int | None:
    """The latest pointer that was written in full (its folder has the success marker)."""
    path = f"{_root(base, table)}/pointer"
    if not path_exists(spark, path):
        return None
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = [str(x.getPath().getName()) for x in fs.listStatus(root)]
    done = [int(n) for n in found if path_exists(spark, f"{path}/{n}/_SUCCESS")]
    return max(done, default=None)
