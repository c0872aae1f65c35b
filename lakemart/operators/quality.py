"""Data-quality checks that return a tidy table instead of log lines.

Result rows: ``(table, check, column, status, value, pct)``

  rows        row count; FAIL when 0 (the other checks are then dropped)
  columns     column count
  nulls       one WARN row per column holding NULLs (count, % of rows, 2 digits),
              or one PASS row when no column holds any
  key_unique  distinct key values (NULL counts as one value, as the reference's
              ``select(pk).distinct().count()`` does) against rows; WARN with the
              surplus
  min / max   per metric column; FAIL when the minimum is negative; a NULL
              minimum passes; absent metric columns are skipped
  readable    FAIL when the table cannot be read at all

Scale: the reference runs one job per check and table (count, distinct, nulls,
one per metric). ``profile`` computes the row count, every null count and every
metric range in one global aggregate (map-side partials, no key shuffle), plus
the key check as a narrow grouped count. A suite over plans is one union of those;
over stored tables each table is a job of its own, so that a damaged one fails alone.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.functions.scalar import round_ratio

#: Jobs of a suite that run at a time.
SIDE_BY_SIDE = 6
RESULT_SCHEMA = "table string, check string, column string, status string, value double, pct double"


def _row(table: str, check: str, column, status, value, pct=None) -> Column:
    return F.struct(
        F.lit(table).alias("table"),
        F.lit(check).alias("check"),
        (column if isinstance(column, Column) else F.lit(column)).cast("string").alias("column"),
        (status if isinstance(status, Column) else F.lit(status)).alias("status"),
        (value if isinstance(value, Column) else F.lit(value)).cast("double").alias("value"),
        (pct if isinstance(pct, Column) else F.lit(pct)).cast("double").alias("pct"),
    )


def profile(
    df: DataFrame,
    table: str,
    key: str | None = None,
    metrics: Sequence[str] = (),
) -> DataFrame:
    """All checks of one table in a single aggregate pass."""
    cols = df.columns
    metrics = [m for m in metrics if m in cols]
    aggs = [F.count(F.lit(1)).alias("rows")]
    aggs += [F.count_if(F.col(c).isNull()).alias(f"n{i}") for i, c in enumerate(cols)]
    for j, m in enumerate(metrics):
        aggs += [F.min(m).cast("double").alias(f"mn{j}"), F.max(m).cast("double").alias(f"mx{j}")]
    stats = df.agg(*aggs)

    rows = F.col("rows")
    checks = [
        _row(table, "rows", None, F.when(rows > 0, "PASS").otherwise("FAIL"), rows),
        _row(table, "columns", None, "PASS", len(cols)),
    ]
    any_null = F.lit(False)
    for i, c in enumerate(cols):
        n = F.col(f"n{i}")
        any_null = any_null | (n > 0)
        checks.append(
            F.when(n > 0, _row(table, "nulls", c, "WARN", n, round_ratio(n * 100, rows, 2)))
        )
    checks.append(F.when(~any_null, _row(table, "nulls", None, "PASS", 0, 0.0)))
    for j, m in enumerate(metrics):
        mn, mx = F.col(f"mn{j}"), F.col(f"mx{j}")
        checks.append(_row(table, "min", m, F.when(mn < 0, "FAIL").otherwise("PASS"), mn))
        checks.append(_row(table, "max", m, "INFO", mx))

    exploded = stats.select(F.col("rows"), F.explode(F.array(*checks)).alias("r"))
    kept = exploded.where(F.col("r").isNotNull() & ((F.col("rows") > 0) | (F.col("r.check") == "rows")))
    out = kept.select("r.*")
    if key:
        out = out.unionByName(_key_check(df, table, key))
    return out


def _key_check(df: DataFrame, table: str, key: str) -> DataFrame:
    """Distinct key values (a NULL key is one value) against rows.

    Its own narrow branch: rows are grouped by the key alone (map-side combined
    into one count per key and partition), so only ``(key, count)`` pairs are
    shuffled, not the other checks' counters.
    """
    per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("c"))
    totals = per_key.agg(F.count(F.lit(1)).alias("distinct"), F.sum("c").alias("rows"))
    check = _row(
        table, "key_unique", key,
        F.when(F.col("distinct") == F.col("rows"), "PASS").otherwise("WARN"),
        F.col("rows") - F.col("distinct"),
    )
    return totals.where(F.col("rows") > 0).select(check.alias("r")).select("r.*")


def unreadable(table: str, error: Exception) -> tuple:
    """The row of a table that cannot be read; ``column`` says why, in full."""
    return (table, "readable", str(error), "FAIL", None, None)


def check_path(
    spark: SparkSession,
    path: str,
    table: str,
    fmt: str = "parquet",
    key: str | None = None,
    metrics: Sequence[str] = (),
    reader: Callable[[SparkSession, str], DataFrame] | None = None,
) -> list[tuple]:
    """The checks of a stored table, run as a job of its own: a table that is absent or
    damaged gives a FAIL ``readable`` row, and hinders no other. (A few rows a column.)"""
    try:
        df = reader(spark, path) if reader else spark.read.format(fmt).load(path)
        return [tuple(r) for r in profile(df, table, key, metrics).collect()]
    except (PySparkException, Py4JError, ValueError) as exc:
        return [unreadable(table, exc)]


def check_layer(
    spark: SparkSession,
    paths: Mapping[str, str],
    keys: Mapping[str, str | None] | None = None,
    metrics: Mapping[str, Sequence[str]] | None = None,
    readers: Mapping[str, Callable[[SparkSession, str], DataFrame]] | None = None,
) -> DataFrame:
    """Suite over stored tables (name -> path), each one isolated from the others; some
    tables' jobs run side by side."""
    keys, metrics, readers = keys or {}, metrics or {}, readers or {}

    def one(name: str) -> list[tuple]:
        own = (keys.get(name), metrics.get(name, ()), readers.get(name))
        return check_path(spark, paths[name], name, "parquet", *own)

    with ThreadPoolExecutor(SIDE_BY_SIDE) as pool:
        found = [row for rows in pool.map(one, paths) for row in rows]
    return spark.createDataFrame(found, RESULT_SCHEMA)


def validate_tables(
    tables: Mapping[str, DataFrame],
    keys: Mapping[str, str | None] | None = None,
    metrics: Mapping[str, Sequence[str]] | None = None,
) -> DataFrame:
    """Suite over a layer of plans: union of per-table profiles (one Spark job). Stored
    tables that may be damaged are for ``check_layer``."""
    keys = keys or {}
    metrics = metrics or {}
    if not tables:
        return SparkSession.getActiveSession().createDataFrame([], RESULT_SCHEMA)
    out = None
    for name, df in tables.items():
        p = profile(df, name, keys.get(name), metrics.get(name, ()))
        out = p if out is None else out.unionByName(p)
    return out


def validate_silver(silver: Mapping[str, DataFrame]) -> DataFrame:
    from lakemart.sources.schemas import SILVER_KEYS

    return validate_tables(silver, keys=SILVER_KEYS)


def validate_gold(gold: Mapping[str, DataFrame]) -> DataFrame:
    from lakemart.sources.schemas import GOLD_METRICS

    return validate_tables(gold, metrics=GOLD_METRICS)


def validate_stored(spark: SparkSession, base: str, layer: str) -> DataFrame:
    """Suite over a stored layer. Gold: the star's tables, and the marts if there are any."""
    from lakemart.sources.files import GOLD_TABLES, layer_path, path_exists
    from lakemart.sources.schemas import CATALOGUE, GOLD_METRICS, SILVER_KEYS

    if layer == "silver":
        return check_layer(spark, {t: layer_path(base, layer, t) for t in CATALOGUE}, keys=SILVER_KEYS)
    paths = {t: layer_path(base, layer, t) for t in (*GOLD_TABLES, "star")}
    if path_exists(spark, layer_path(base, "marts", "")):
        paths.update({t: layer_path(base, "marts", t) for t in GOLD_METRICS if t not in paths})
    return check_layer(spark, paths, metrics=GOLD_METRICS)


def validate_bronze_files(spark: SparkSession, raw_dir: str, catalogue=None) -> DataFrame:
    """Bronze suite over the raw files of the catalogue (CSV with header).

    A missing or unreadable file gives one FAIL ``readable`` row for its table.
    """
    from lakemart.sources.files import read_csv
    from lakemart.sources.schemas import CATALOGUE

    catalogue = catalogue or CATALOGUE

    def reader(spec):
        return lambda spark, path: read_csv(spark, path, spec.schema, spec.multiline, spec.required, **spec.options)

    return check_layer(
        spark,
        {name: f"{raw_dir.rstrip('/')}/{spec.file}" for name, spec in catalogue.items()},
        readers={name: reader(spec) for name, spec in catalogue.items()},
    )
