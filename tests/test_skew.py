"""A user holding most of the ratings: shuffle joins with AQE's skew split keep every row."""

from helpers import lines
from rateflow.operators.materialize import materialize, new_run_folder
from rateflow.plans.features import build_dimensions, feature_matrix
from rateflow.sources.csv_ratings import parse_rating_lines, training_rows
from test_defaults import _inputs

FORCED = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
}


def test_hot_user_rows_survive_shuffle_joins(spark):
    hot = [f"u1,b{1 + i % 2},{1 + i % 5}.0" for i in range(3000)]
    cold = [f"u{2 + i % 50},b{i % 3},{1 + i % 5}.0" for i in range(1500)]
    inp = _inputs(spark, hot + cold)
    saved = {k: spark.conf.get(k, None) for k in FORCED}
    try:
        for k, v in FORCED.items():
            spark.conf.set(k, v)
        folder = new_run_folder(spark)  # stored, as the job does: a reduced side cannot be split
        dims = build_dimensions(inp, store=lambda df, name: materialize(df, folder, name))
        ratings = training_rows(parse_rating_lines(inp.train.repartition(8), "user_id,business_id,stars"))  # a partition is split by its writers
        matrix = feature_matrix(ratings, dims)
        rows = matrix.collect()
        plan = matrix._jdf.queryExecution().executedPlan().toString()  # the final one: it has run
    finally:
        for k, v in saved.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
    assert "isFinalPlan=true" in plan and "BroadcastHashJoin" not in plan
    assert "SortMergeJoin(skew=true)" in plan
    hot_rows = [r for r in rows if r["user_id"] == "u1"]
    assert len(hot_rows) == 3000 and len(rows) == 4500
    assert len({(r["user_avg_rating"], r["users_review_count"]) for r in hot_rows}) == 1
