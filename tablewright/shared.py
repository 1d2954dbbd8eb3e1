"""Small helpers around the session: durable intermediate tables and size checks."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_RUN_FOLDERS: list[str] = []


def work_folder(spark: SparkSession) -> str:
    """Shared folder for intermediate tables: that of the innermost :func:`intermediate`, else
    ``spark.checkpoint.dir`` or the folder given to ``SparkContext.setCheckpointDir``."""
    if _RUN_FOLDERS:
        return _RUN_FOLDERS[-1]
    configured = spark.conf.get("spark.checkpoint.dir", None)
    configured = configured or spark.sparkContext.getCheckpointDir()
    if not configured:
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    return configured.rstrip("/")


@contextmanager
def intermediate(spark: SparkSession) -> Iterator[str]:
    """Intermediate tables written inside go to one run folder, which is removed at the end;
    so consume results inside."""
    folder = f"{work_folder(spark)}/run-{uuid.uuid4().hex}"
    _RUN_FOLDERS.append(folder)
    try:
        yield folder
    finally:
        _RUN_FOLDERS.remove(folder)
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


_RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(
    df: DataFrame, label: str, release: bool = False, folder: str | None = None
) -> DataFrame:
    """Cut the lineage: write ``df`` to the shared folder (or the given one) and read it back.

    A written table survives the loss of executors, and its known size lets Spark
    choose broadcast or shuffle for the joins that follow.  With ``release`` the shuffle
    files of ``df`` go as soon as it is written, where Spark knows how.
    """
    path = f"{folder or work_folder(df.sparkSession)}/{label}-{uuid.uuid4().hex}"
    conf = df.sparkSession.conf
    release = release and conf.isModifiable(_RELEASE)
    before = conf.get(_RELEASE, None) if release else None
    if release:
        conf.set(_RELEASE, "true")
    try:
        df.write.parquet(path)
    finally:
        if release:
            conf.unset(_RELEASE) if before is None else conf.set(_RELEASE, before)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame, *columns: str) -> DataFrame:
    """Hash rows over all shuffle partitions before costly per-row work.

    Pair tables are small in bytes but heavy in CPU, and adaptive coalescing only
    looks at bytes; an explicit partition count is left alone.
    """
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(partitions, *columns)


def fan_out(scan: DataFrame) -> DataFrame:
    """Spread a plain file scan with fewer splits than cores before costly row work.

    Small files hold a single row group and would keep one core busy; a large input
    already has many splits and is returned unchanged.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(cores) if scan.rdd.getNumPartitions() < cores else scan
