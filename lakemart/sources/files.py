"""Scans and sinks of the layered lake (raw CSV, Parquet layers, SQL views).

The lake base is a URI (local path, ``s3a://``, ``hdfs://`` ...); every table is
one directory ``<base>/<layer>/<table>``. Reads use declared schemas, so no
inference pass runs before a job.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakemart.operators.columns import normalize_name, standardize_columns

#: Rows of a CSV file that the lake writes.
CSV_ROWS = 1_000_000
LAYERS = ("bronze", "silver", "gold")


def layer_path(base: str, layer: str, table: str) -> str:
    return f"{base.rstrip('/')}/{layer}/{table}"


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence through the Hadoop file system (local, file:, s3a:, hdfs: ...)."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(hpath))


def delete_path(spark: SparkSession, path: str) -> bool:
    """Remove a table folder through the Hadoop file system; False if there was none."""
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.delete(hpath, True))


def read_raw(spark: SparkSession, path: str, **options) -> DataFrame:
    """CSV with header, every column as text (no inference)."""
    return spark.read.options(header=True, **options).csv(path)


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    multiline: bool = False,
    required: Sequence[str] = (),
    **options,
) -> DataFrame:
    """CSV with header, its columns bound by name to the columns of ``schema``.

    Header names are normalised as column names are. Columns come in the schema's
    order and types (text that does not convert becomes NULL); one that the file
    lacks is NULL, a further one is left out (``header_differences`` tells). A
    missing ``required`` column, two names that normalise alike, or files of one
    folder with different headers raise an error.

    ``multiline=True`` keeps quoted newlines inside one record (review comments);
    it makes each file a single split, so convert such files to Parquet once.
    """
    reader = spark.read.options(header=True, multiLine=multiline, escape='"', **options)
    header = T.StructType([T.StructField(n, T.StringType()) for n in reader.csv(path).columns])
    by_name = standardize_columns(
        reader.options(mode="PERMISSIVE", enforceSchema=False).schema(header).csv(path)
    )
    missing = [c for c in required if c not in by_name.columns]
    if missing:
        raise ValueError(f"{path}: no column {', '.join(missing)}; the header has {', '.join(by_name.columns)}")
    return by_name.select(
        *[
            (F.col(f.name).try_cast(f.dataType) if f.name in by_name.columns else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in schema.fields
        ]
    )


def header_differences(spark: SparkSession, path: str, schema: T.StructType, **options) -> tuple[list[str], list[str]]:
    """The declared columns that a CSV's header lacks, and those it has besides."""
    found = [normalize_name(c) for c in spark.read.options(header=True, **options).csv(path).columns]
    return [c for c in schema.names if c not in found], [c for c in found if c not in schema.names]


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """CSV with header (a folder of part files), quoting embedded newlines. The files are
    compressed, and hold ``CSV_ROWS`` rows at most: each is read by one task."""
    df.write.mode(mode).options(header=True, escape='"', compression="gzip", maxRecordsPerFile=CSV_ROWS).csv(path)
    return path


def read_layer(spark: SparkSession, base: str, layer: str, table: str) -> DataFrame:
    return spark.read.parquet(layer_path(base, layer, table))


def write_layer(
    df: DataFrame,
    base: str,
    layer: str,
    table: str,
    partition_by: Sequence[str] = (),
    mode: str = "overwrite",
    rebalance: bool = True,
) -> str:
    """Parquet sink, one directory per table (full overwrite by default).

    A partitioned write is preceded by a REBALANCE on the partition columns: rows
    of one partition value meet in few tasks, so each task writes few folders
    (without it every task writes a file into every folder: tasks x values small
    files). AQE splits a partition value that is too large across several tasks
    and merges small ones, so a hot value does not become one task. ``rebalance=False`` is
    for rows that lie by these columns already, as read from such a table.
    """
    path = layer_path(base, layer, table)
    if partition_by and rebalance:
        df = df.hint("rebalance", *partition_by)
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return path


def write_tables(
    tables: Mapping[str, DataFrame],
    base: str,
    layer: str,
    partition_by: Mapping[str, Sequence[str]] | None = None,
) -> dict[str, str]:
    """Write several tables; all plans are analysed before the first write.

    Analysis errors (a wrong column name, say) surface before anything is
    written, so a failed build does not leave a half-written layer behind.
    """
    partition_by = partition_by or {}
    for df in tables.values():
        df.schema  # noqa: B018 - forces analysis of every plan first
    return {
        name: write_layer(df, base, layer, name, partition_by.get(name, ()))
        for name, df in tables.items()
    }


def publish(
    spark: SparkSession,
    src: str,
    dst: str,
    fmt: str = "parquet",
    out_fmt: str = "parquet",
    schema: T.StructType | None = None,
    out_options: Mapping[str, object] | None = None,
    **options,
) -> str:
    """Copy a data set to a lake location as a distributed read + write."""
    reader = spark.read.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    reader.load(src).write.mode("overwrite").format(out_fmt).options(**(out_options or {})).save(dst)
    return dst


GOLD_TABLES = ("dim_date", "dim_customers", "dim_products", "dim_sellers", "fact_sales", "fact_orders")


def register_views(tables: Mapping[str, DataFrame]) -> list[str]:
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    return list(tables)


def register_gold(
    spark: SparkSession, base: str, tables: Sequence[str] = GOLD_TABLES, with_star: bool = False
) -> list[str]:
    """Temp views over the stored gold tables, named as the tables.

    ``with_star`` also registers the stored, joined ``star`` (item grain,
    partitioned by year and month) as the analytics-ready view.
    """
    names = list(tables) + (["star"] if with_star else [])
    return register_views({t: read_layer(spark, base, "gold", t) for t in names})


def run_query(spark: SparkSession, sql: str, params: Mapping[str, object] | None = None) -> DataFrame:
    """Run SQL over registered views; values are bound as parameters, never spliced."""
    return spark.sql(sql, args=dict(params) if params else None)


def cached(df: DataFrame) -> DataFrame:
    """Keep a reused result (e.g. the joined star) in executor memory and disk."""
    from pyspark import StorageLevel

    return df.persist(StorageLevel.MEMORY_AND_DISK)
