"""SparkSession defaults and the shared checkpoint folder."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Settings every plan in this package is written for. They are applied only
# where the session does not already carry a value, so a cluster's own
# configuration always wins.
SESSION_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    # JSON objects with a repeated key keep the last value, as json.loads does.
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    # The JVM compiles no method above 8,000 bytes; rows as wide as the feature matrix give such
    # methods when fused into one, so beyond that Spark is to run the steps one by one.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def build_session(
    master: str = "local[*]",
    shuffle_partitions: int | None = None,
    app_name: str = "rateflow",
    extra: dict | None = None,
) -> SparkSession:
    """Session with the UI off and AQE on.

    The shuffle width is the given one; else 8 for a local master, and Spark's
    or the cluster's own setting for any other.
    """
    if shuffle_partitions is None and master.startswith("local"):
        shuffle_partitions = 8
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
    )
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in {**SESSION_DEFAULTS, **(extra or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    apply_defaults(spark)
    return spark


def apply_defaults(spark: SparkSession) -> None:
    """Set the runtime SQL defaults that are still unset on ``spark``."""
    for key, value in SESSION_DEFAULTS.items():
        if spark.conf.get(key, None) in (None, ""):
            spark.conf.set(key, value)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint folder, taking it from ``spark.checkpoint.dir``.

    On a cluster the folder must be shared storage named by the session; a
    private folder is created only for a local master with nothing configured.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir"
    )
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    if sc.master.startswith("local"):
        folder = tempfile.mkdtemp(prefix="rateflow-ckpt-")
        sc.setCheckpointDir(folder)
        return sc.getCheckpointDir() or folder
    raise RuntimeError(
        "spark.checkpoint.dir is not set; point it at a folder on shared storage"
    )
