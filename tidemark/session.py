"""Session settings and the shared work folder.

Everything in the library is a function from DataFrames to DataFrames; the
session is only configured here (tests, bench, command line).  On a cluster
the session comes from the platform and ``work_dir`` reads the shared folder
the cluster names in ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every job relies on: UTC session zone (timestamps in the sources
# carry no zone), ANSI arithmetic (overflow raises instead of wrapping) and
# adaptive execution (coalesced shuffle partitions, skew-join splitting).
CORE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.compression.codec": "snappy",
}


def build_session(
    master: str = "local[8]",
    shuffle_partitions: int = 8,
    app: str = "tidemark",
    extra: dict | None = None,
) -> SparkSession:
    builder = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "16g")
    )
    for k, v in {**CORE_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    apply_core_conf(spark)
    return spark


def apply_core_conf(spark: SparkSession) -> None:
    """Pin the settings the results depend on (zone, ANSI)."""
    for k, v in CORE_CONF.items():
        spark.conf.set(k, v)


def work_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and written intermediate tables.

    Read from the session; where it names none (local tests) a folder beside
    the session's own warehouse, which a cluster shares too.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        current = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints"
        sc.setCheckpointDir(current)
    elif not sc.getCheckpointDir():
        sc.setCheckpointDir(current)
    return current.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared work folder."""
    base = work_dir(spark)
    return f"{base}/tidemark/{name}-{uuid.uuid4().hex[:12]}"


FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Within it, a statement that ends gives the disk of its shuffles back.

    Otherwise they stay until the driver's garbage collector meets their plans, so a
    job of many steps holds the shuffles of several at once.  For statements that run
    once: one that reads a shuffle again computes it again."""
    before = spark.conf.get(FREE_SHUFFLES, None)
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(FREE_SHUFFLES)
        else:
            spark.conf.set(FREE_SHUFFLES, before)


def local_path(path: str) -> str:
    """Strip a ``file:`` scheme for the few helpers that list local folders."""
    if path.startswith("file:"):
        path = path[len("file:"):]
        while path.startswith("//"):
            path = path[1:]
    return os.path.abspath(path)


def materialize(df, name: str = "stage"):
    """Write ``df`` as Parquet under the shared work folder and read it back.

    Cuts the lineage (later plans start from files, and a lost executor does
    not force recomputation of the whole history) at the cost of one write;
    unlike an RDD checkpoint the plan is computed only once."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)
