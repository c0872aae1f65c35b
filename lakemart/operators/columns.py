"""Column-level cleaning operators (projections only; no shuffle)."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakemart.functions.scalar import lenient_timestamp

_TS_TYPES = (T.TimestampType, T.TimestampNTZType)


def normalize_name(name: str) -> str:
    """lower-case, strip, each space -> ``_`` (two spaces give ``__``)."""
    return name.lower().strip().replace(" ", "_")


def standardize_columns(df: DataFrame) -> DataFrame:
    """Rename every column with :func:`normalize_name`; raise on a clash."""
    names = [normalize_name(c) for c in df.columns]
    seen: dict[str, str] = {}
    for old, new in zip(df.columns, names):
        if new in seen:
            raise ValueError(f"columns {seen[new]!r} and {old!r} both normalise to {new!r}")
        seen[new] = old
    return df.toDF(*names)


def _convert(df: DataFrame, name: str, target: T.DataType):
    source = df.schema[name].dataType
    col = F.col(name)
    if isinstance(target, _TS_TYPES):
        if isinstance(source, _TS_TYPES):
            return col
        if isinstance(source, (T.StringType, T.VarcharType, T.CharType)):
            return lenient_timestamp(col)
        return col.try_cast(target)
    if source == target:
        return col
    return col.try_cast(target)


def conform(df: DataFrame, types: Mapping[str, T.DataType | str]) -> DataFrame:
    """Replace the named columns by a lenient conversion to the given type.

    Text that does not parse becomes NULL (``try_cast`` / ``try_to_timestamp``)
    instead of failing the job. Columns already of the target type are kept
    untouched, so typed sources pay nothing. Absent columns are skipped.
    """
    exprs = {}
    for name, target in types.items():
        if name not in df.columns:
            continue
        if isinstance(target, str):
            target = T._parse_datatype_string(target)
        exprs[name] = _convert(df, name, target).alias(name)
    return df.select(*[exprs.get(c, F.col(c)) for c in df.columns])


def filter_non_negative(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Keep rows where every column is ``>= 0``; NULL fails (three-valued logic)."""
    cond = None
    for c in cols:
        term = F.col(c) >= 0
        cond = term if cond is None else cond & term
    return df if cond is None else df.filter(cond)


def drop_null(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    return df.na.drop(subset=list(cols))


def fill_defaults(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """Replace NULLs per column by a default (``coalesce``, type-checked by Spark)."""
    present = {k: v for k, v in defaults.items() if k in df.columns}
    return df.select(
        *[
            F.coalesce(F.col(c), F.lit(present[c])).alias(c) if c in present else F.col(c)
            for c in df.columns
        ]
    )
