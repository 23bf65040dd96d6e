"""Stored tables and the size-checked broadcast."""

from pyspark.sql import functions as F

from rateflow.operators.joins import broadcast_if_small, row_bytes
from rateflow.operators.materialize import materialize, new_run_folder, spread_for_compute


def _is_broadcast_hint(df):
    return "broadcast" in df._jdf.queryExecution().analyzed().toString().lower()


def test_materialize_round_trips_under_the_checkpoint_folder(spark):
    folder = new_run_folder(spark)
    assert folder.startswith(spark.sparkContext.getCheckpointDir().rstrip("/"))
    df = spark.range(100).select((F.col("id") * 2).alias("x"))
    stored = materialize(df, folder, "t")
    assert sorted(r[0] for r in stored.collect()) == list(range(0, 200, 2))


def test_broadcast_only_under_the_size_limit(spark):
    small = spark.range(10)
    assert _is_broadcast_hint(broadcast_if_small(small, max_bytes=10 * row_bytes(small.schema)))
    assert not _is_broadcast_hint(broadcast_if_small(small, max_bytes=row_bytes(small.schema)))


def test_spread_gives_every_slot_a_partition(spark):
    one = spark.range(1000).coalesce(1)
    assert spread_for_compute(one).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism


def test_spread_bounds_the_rows_of_a_partition(spark):
    assert spread_for_compute(spark.range(1000).coalesce(1), task_rows=20).rdd.getNumPartitions() == 50
    assert spread_for_compute(spark.range(0, 1000, 1, 60), task_rows=20).rdd.getNumPartitions() == 60
