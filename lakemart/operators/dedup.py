"""Deterministic de-duplication.

``dropDuplicates(keys)`` keeps an arbitrary row per key. Here the survivor is the
first row in a total order (``order_by`` columns, then every other column), so
re-runs and the SQL oracle agree.

Plan shape: a grouped ``min(struct(...))`` instead of ``row_number()`` over a
window. The aggregate combines map-side, so a key holding a third of all rows
is collapsed to one row per input partition before the shuffle; a window would
send all of its rows into a single task. A NULL key forms one group (as the
reference's dedup does).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def orderable(dtype: T.DataType) -> bool:
    """Whether Spark can compare values of this type (maps cannot)."""
    if isinstance(dtype, T.MapType):
        return False
    if isinstance(dtype, T.ArrayType):
        return orderable(dtype.elementType)
    if isinstance(dtype, T.StructType):
        return all(orderable(f.dataType) for f in dtype.fields)
    return True


def dedup(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[str] = (), needed: Sequence[str] | None = None
) -> DataFrame:
    """One row per ``keys``: the smallest by ``order_by`` then all other columns.

    ``needed``: the columns to return, if not all. The first columns of the smallest row
    are the smallest of the first columns, so those behind the last needed one are left
    out of the comparison and the shuffle; the rows are the same.

    Ordering is ascending with NULLs first (Spark's struct order). Columns Spark
    cannot order (maps) are carried along with the chosen row.
    """
    keys = list(keys)
    order_by = [c for c in order_by if c not in keys]
    rest = [c for c in df.columns if c not in keys and c not in order_by]
    packed = [c for c in order_by + rest if orderable(df.schema[c].dataType)]
    carried = [c for c in order_by + rest if c not in packed]  # e.g. maps: follow their row
    if needed is not None and not any(c in carried for c in needed):
        last = max((i + 1 for i, c in enumerate(packed) if c in needed), default=0)
        packed, carried = packed[:last], []
    if not packed and not carried:
        return df.select(*keys).distinct()
    # positional field names avoid clashes with the key columns
    fields = [F.col(c).alias(f"_f{i}") for i, c in enumerate(packed)]
    order = F.struct(*fields) if fields else F.lit(0)
    aggs = [F.min(order).alias("_best")]
    if carried:
        extra = F.struct(*[F.col(c).alias(f"_g{i}") for i, c in enumerate(carried)])
        aggs.append(F.min_by(extra, order).alias("_rest"))
    best = df.groupBy(*keys).agg(*aggs)
    out = best.select(
        *keys,
        *[F.col(f"_best._f{i}").alias(c) for i, c in enumerate(packed)],
        *[F.col(f"_rest._g{i}").alias(c) for i, c in enumerate(carried)],
    )
    return out.select(*[c for c in df.columns if needed is None or c in (*keys, *needed)])


def distinct_rows(df: DataFrame) -> DataFrame:
    """Full-row distinct (hash aggregate with map-side combine)."""
    return df.dropDuplicates()
