"""Session helper for tests, bench and local runs.

Library functions never create or configure sessions; they take the caller's.
This helper only fills in settings that are unset, so a cluster's own
configuration (shuffle partitions, checkpoint folder, ...) always wins.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

LOCAL_DEFAULTS = {
    "spark.sql.shuffle.partitions": "8",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.driver.memory": "16g",
    # scans of small files are split over the cores, as large ones are by their size
    "spark.sql.files.minPartitionNum": "8",
    "spark.sql.files.openCostInBytes": "65536",
}


#: Whether a query's shuffle files go when it ends, not when the driver collects its garbage.
DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def local_session(master: str | None = None, app: str = "lakemart", **conf: str) -> SparkSession:
    """A local session for tests and bench (UI off, AQE on, UTC)."""
    master = master or os.environ.get("LAKEMART_MASTER", "local[8]")
    builder = SparkSession.builder.master(master).appName(app)
    for key, value in {**LOCAL_DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder; set one only if unset.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used as is. Where
    it is unset, the folder lies in the session's warehouse, which executors share too.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        configured = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_checkpoints"
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of the session (raises when none is set)."""
    current = spark.sparkContext.getCheckpointDir()
    if not current:
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if not configured:
            raise RuntimeError(
                "no checkpoint folder: set spark.checkpoint.dir to a shared folder"
            )
        spark.sparkContext.setCheckpointDir(configured)
        current = spark.sparkContext.getCheckpointDir()
    return current


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what is planned and written within go as soon as it is written."""
    before = spark.conf.get(DROP_SHUFFLES, None)
    spark.conf.set(DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(DROP_SHUFFLES)
        else:
            spark.conf.set(DROP_SHUFFLES, before)


def scratch_root(spark: SparkSession, name: str, source: str) -> str:
    """The folder in the shared checkpoint folder for a query's tables between steps.

    One a query and input: a rerun takes the place of the run before it."""
    from lakemart.sources.files import delete_path

    ensure_checkpoint_dir(spark)
    base = spark.conf.get("spark.checkpoint.dir", None) or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_checkpoints"
    root = f"{base.rstrip('/')}/lakemart-{name}-{zlib.crc32(source.encode()):08x}"
    delete_path(spark, root)
    return root
