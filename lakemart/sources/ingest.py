"""Raw -> bronze ingestion over the catalogue.

Each present raw file is read by its header into the declared layout and written to
``<base>/bronze/<table>`` as Parquet. The row count is taken by an observation
on the write job itself (no second scan). A missing file gives a ``skipped`` row,
one whose header lacks a key column (or cannot be read) a ``failed`` row, and the
others go on; columns that a header lacks or has besides are named in the status. The result is a small DataFrame (one row per catalogue
entry, a fixed bound of nine).
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from lakemart.sources.files import header_differences, layer_path, path_exists, read_csv
from lakemart.sources.schemas import CATALOGUE, DatasetSpec

RESULT_SCHEMA = "table string, rows long, status string, path string"


def ingest_raw(
    spark: SparkSession,
    raw: str,
    base: str,
    catalogue: Mapping[str, DatasetSpec] = CATALOGUE,
) -> DataFrame:
    """Raw CSVs -> bronze Parquet; returns (table, rows, status, path)."""
    results = []
    for name, spec in catalogue.items():
        src = f"{raw.rstrip('/')}/{spec.file}"
        if not path_exists(spark, src):
            results.append((name, None, "skipped: file not found", src))
            continue
        dst = layer_path(base, "bronze", name)
        obs = Observation(f"ingest_{name}")
        try:
            df = read_csv(spark, src, spec.schema, spec.multiline, spec.required, **spec.options)
            absent, extra = header_differences(spark, src, spec.schema, **spec.options)
            if spec.multiline:
                # each file is one split, parsed by one task; if there are fewer files than
                # cores, the parsed rows are dealt out, so that the Parquet encoding and the
                # write run on every core
                if len(df.inputFiles()) < spark.sparkContext.defaultParallelism:
                    df = df.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")))
            df.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(dst)
        except (ValueError, PySparkException) as exc:
            results.append((name, None, f"failed: {exc}", src))
            continue
        notes = [f"; {what}: {', '.join(names)}" for what, names in (("absent", absent), ("extra", extra)) if names]
        results.append((name, int(obs.get["rows"]), "written" + "".join(notes), dst))
    return spark.createDataFrame(results, RESULT_SCHEMA)


def read_bronze(spark: SparkSession, base: str, tables=tuple(CATALOGUE)) -> dict[str, DataFrame]:
    out = {}
    for t in tables:
        path = layer_path(base, "bronze", t)
        if path_exists(spark, path):
            out[t] = spark.read.parquet(path)
    return out
