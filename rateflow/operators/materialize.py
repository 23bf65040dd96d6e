"""Store an intermediate frame as a parquet table in the shared checkpoint folder."""

from __future__ import annotations

import atexit
import uuid

from pyspark.sql import DataFrame, SparkSession

from rateflow.session import ensure_checkpoint_dir


# Run folders made by this process and not yet removed.
_OPEN: dict[str, SparkSession] = {}


def new_run_folder(df_or_spark) -> str:
    """A fresh folder for one run's tables under the session's checkpoint folder.

    It lives until ``remove_run_folders`` names it, or until this process
    ends: frames returned to a caller read from it.
    """
    spark = getattr(df_or_spark, "sparkSession", df_or_spark)
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/rateflow-{uuid.uuid4().hex}"
    _OPEN[folder] = spark
    return folder


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder on whatever file system it names."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def remove_run_folders(*folders: str) -> None:
    """Remove the given run folders, or all that this process has open."""
    for folder in folders or list(_OPEN):
        spark = _OPEN.pop(folder, None)
        if spark is not None and spark.sparkContext._jsc is not None:
            remove_folder(spark, folder)


atexit.register(remove_run_folders)


def materialize(df: DataFrame, folder: str, name: str, partition_by: str | None = None) -> DataFrame:
    """Write ``df`` once as parquet under ``folder`` and return a frame reading it back.

    Unlike ``checkpoint()`` on an uncached frame this computes ``df`` once.
    The table lives on the shared storage named by ``spark.checkpoint.dir``,
    so its lineage is cut and a lost executor costs a re-read, not a
    re-derivation; the reader also gives the planner the real table size.
    """
    path = f"{folder}/{name}"
    df.write.mode("overwrite").parquet(path, partitionBy=partition_by)
    return df.sparkSession.read.parquet(path)


def spread_for_compute(df: DataFrame, task_rows: int | None = None) -> DataFrame:
    """Give a compute-heavy consumer (the tree fit) at least one partition per task slot.

    A small stored table may come back as a single partition; a large one
    already has one split per file block and is left as it is, unless its
    rows (of a stored table, whose footers count them) are more than ``task_rows`` a partition.
    """
    wanted = df.sparkSession.sparkContext.defaultParallelism
    if task_rows:
        wanted = max(wanted, -(-df.count() // task_rows))
    if df.rdd.getNumPartitions() < wanted:
        return df.repartition(wanted)
    return df
