"""Lookups over bucketed storage, and the size-checked broadcast in the final plan."""

import tempfile
from collections import Counter

import pytest
from pyspark.sql import functions as F

from helpers import SF_SMALL
from rateflow.operators.bucketed import SALT, Buckets, co_located, hot_keys, repeated, salted
from rateflow.operators.joins import broadcast_if_small, stored_bytes
from rateflow.operators.materialize import materialize, new_run_folder
from rateflow.plans.bucketed import TRAIN, BucketedRows
from rateflow.plans.features import feature_matrix, materialize_dimensions, train_ratings, val_ratings
from rateflow.plans.pipeline import run_pipeline
from rateflow.sources.tables import inputs_from_tables

NO_BROADCAST = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}


@pytest.fixture
def no_broadcast(spark):
    saved = {k: spark.conf.get(k, None) for k in NO_BROADCAST}
    for k, v in NO_BROADCAST.items():
        spark.conf.set(k, v)
    yield
    for k, v in saved.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_lookups_need_no_exchange_and_give_the_same_rows(spark, no_broadcast):
    folder = new_run_folder(spark)
    inp = inputs_from_tables(spark, SF_SMALL, gaps=True, folder=folder)
    dims = materialize_dimensions(inp, folder)
    dims.business, dims.user = spark.read.parquet(f"{folder}/business_dim"), spark.read.parquet(f"{folder}/user_dim")  # no hints
    rows = BucketedRows(train_ratings(inp), val_ratings(inp), dims, folder, 8)
    with co_located(spark):
        for df in (rows.with_business, rows.looked_up(), rows.looked_up().where(TRAIN), rows.looked_up().where(~F.col(TRAIN))):
            df.collect()
            plan = _plan(df)
            assert "SortMergeJoin" in plan and "Exchange" not in plan and "Bucketed: true" in plan
    for train, ratings in ((True, train_ratings(inp)), (False, val_ratings(inp))):
        for features in ("v29", "v8"):
            got = rows.matrix(folder, f"m_{train}_{features}", features, train)
            want = feature_matrix(ratings, dims, features)
            assert Counter(got.select(*want.columns).collect()) == Counter(want.collect())
    names = rows.store.tables
    rows.close()
    assert not any(spark.catalog.tableExists(t) for t in names)


def test_a_hot_key_is_dealt_over_buckets(spark, no_broadcast):
    ratings = [("hot", f"b{i}") for i in range(3000)] + [(f"u{i}", f"b{i % 90}") for i in range(6000)]
    df = spark.createDataFrame(ratings, "user_id string, business_id string")
    dim = spark.createDataFrame([(u, len(u)) for u in {u for u, _ in ratings} | {"alone"}], "user_id string, u_x int")
    hot = materialize(hot_keys(df, "user_id", 16), new_run_folder(spark), "hot")
    assert [r.user_id for r in hot.collect()] == ["hot"]
    store = Buckets(spark, new_run_folder(spark), 16)
    rows = store.write(salted(df, "user_id", "business_id", hot, 16), "rows", "user_id")
    wide = store.write(repeated(dim, "user_id", hot, 16), "dim", "user_id")
    joined = rows.join(wide, ["user_id", SALT], "left").withColumn("p", F.spark_partition_id())
    got = joined.collect()
    assert "Exchange" not in _plan(joined)
    assert Counter((r.user_id, r.business_id, r.u_x) for r in got) == Counter((u, b, len(u)) for u, b in ratings)
    of_bucket = Counter(r.p for r in got if r.user_id == "hot")
    assert len(of_bucket) > 5 and max(of_bucket.values()) < 1500
    store.close()


def test_hot_keys_are_fewer_than_buckets(spark):
    df = spark.range(10_000).select((F.col("id") % 10).cast("string").alias("k"))
    assert hot_keys(df, "k", 8).count() == 0 and hot_keys(df, "k", 11).count() == 10
    assert hot_keys(df.limit(0), "k", 8).count() == 0


def test_job_over_buckets_is_the_same_job(spark):
    inputs = inputs_from_tables(spark, SF_SMALL, gaps=True)
    plain, dealt = (run_pipeline(spark, inputs=inputs, max_iter=2, max_depth=2, bucketed=b) for b in (False, True))
    assert dealt.rmse == pytest.approx(plain.rmse, rel=1e-9) and dealt.n_val == plain.n_val and dealt.histogram == plain.histogram
    plain.close()
    dealt.close()


def test_broadcast_below_the_limit_and_sort_merge_above_it(spark, no_broadcast):
    """The choice is read from the final adaptive plan of the run query."""
    folder = new_run_folder(spark)
    keys = spark.range(20_000).select((F.col("id") % 5000).cast("string").alias("k"), "id")
    dim = materialize(spark.range(5000).select(F.col("id").cast("string").alias("k"), F.rand(1).alias("x")), folder, "dim")
    size = stored_bytes(dim)
    assert 0 < size < 10_000_000 and stored_bytes(spark.range(3)) is None
    results = []
    for limit, wanted, other in ((size * 8, "BroadcastHashJoin", "SortMergeJoin"), (size * 8 - 1, "SortMergeJoin", "BroadcastHashJoin")):
        joined = keys.join(broadcast_if_small(dim, limit), "k", "left")
        results.append(Counter(joined.collect()))
        plan = _plan(joined)
        assert "isFinalPlan=true" in plan and wanted in plan and other not in plan
    assert results[0] == results[1]


def test_stored_size_follows_the_files(spark):
    folder = tempfile.mkdtemp(prefix="rateflow-test-")
    small = materialize(spark.range(10), folder, "a")
    large = materialize(spark.range(100_000).select(F.rand(2)), folder, "b")
    assert stored_bytes(large) > 50 * stored_bytes(small)
