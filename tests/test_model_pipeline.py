"""Model and whole-job checks: rows, no null predictions, repeatable fits, CSV output."""

import os
import tempfile
from collections import Counter
from inspect import signature

import pytest
from pyspark.sql import functions as F

import bench
from helpers import SF_SMALL
from rateflow.__main__ import main
from rateflow.operators.materialize import _OPEN
from rateflow.operators.standardize import standardize
from rateflow.plans import evaluate
from rateflow.plans.features import FEATURES_29, build_dimensions, feature_matrix, train_ratings
from rateflow.plans.model import SEARCH_PAIRS, fit_gbt, gbt, held_out, predict, search
from rateflow.plans.pipeline import run_pipeline
from rateflow.sources.inputs import FILES
from rateflow.sources.tables import inputs_from_tables


@pytest.fixture(scope="module")
def train(spark):
    inp = inputs_from_tables(spark, SF_SMALL)
    matrix = feature_matrix(train_ratings(inp), build_dimensions(inp)).cache()
    scaled, _ = standardize(matrix, None, FEATURES_29)
    return scaled.cache()


def test_fit_is_repeatable_and_beats_the_mean_on_training_rows(train):
    p1 = predict(fit_gbt(train, FEATURES_29, max_iter=5, max_depth=4), train)
    p2 = predict(fit_gbt(train, FEATURES_29, max_iter=5, max_depth=4), train)
    assert p1.count() == train.count()
    assert p1.filter(F.col("prediction").isNull()).count() == 0
    r1 = evaluate.rmse(p1).first()["rmse"]
    assert r1 == pytest.approx(evaluate.rmse(p2).first()["rmse"])
    baseline = evaluate.rmse(evaluate.mean_predictor(train, train)).first()["rmse"]
    assert r1 <= baseline


def test_error_histogram_shows_empty_buckets(spark):
    df = spark.createDataFrame([(1.0, 1.2), (1.0, 2.5)], "label double, prediction double")
    got = [(r["bucket"], r["n"]) for r in evaluate.error_histogram(df).orderBy("bucket").collect()]
    assert got == [(0, 1), (1, 1), (2, 0), (3, 0), (4, 0)]


def _write_inputs(spark, folder):
    """Render the small test inputs as the job's files, header line first."""
    inp = inputs_from_tables(spark, SF_SMALL)
    targets = {**{key: name for key, name in FILES.items()}, "val": "yelp_val.csv"}
    for key, name in targets.items():
        rows = [r[0] for r in getattr(inp, key).collect()]
        if key in ("train", "val"):
            header = inp.train_header
            rows = [header] + [r for r in rows if r != header]
        with open(f"{folder}/{name}", "w", encoding="utf-8") as fh:
            fh.write("\n".join(rows) + "\n")


def test_pipeline_from_files_writes_predictions(spark):
    folder = tempfile.mkdtemp(prefix="rateflow-test-")
    _write_inputs(spark, folder)
    out = f"{folder}/out"
    res = run_pipeline(
        spark, folder, f"{folder}/yelp_val.csv", out, max_iter=3, max_depth=3
    )
    written = spark.read.option("header", True).csv(out)
    assert written.columns == ["user_id", "business_id", "prediction"]
    assert written.count() == res.n_val > 0
    assert sum(n for _, n in res.histogram) == res.n_val
    assert res.rmse > 0
    assert os.path.isdir(out)


def test_all_rounds_are_grown_with_255_bins(train):
    model = fit_gbt(train, FEATURES_29, max_iter=4, max_depth=3)
    assert model.stages[-1].getNumTrees == 4
    assert gbt().getMaxBins() == 255 and gbt(max_bins=32).getMaxBins() == 32


def test_search_takes_the_pair_of_least_error(train):
    found = search(train, FEATURES_29, [(2, 2), (4, 3)])
    assert [(r, d) for r, d, _ in found.tried] == [(2, 2), (4, 3)]
    assert found.best == min(found.tried, key=lambda t: t[2])[:2]
    assert found.model.stages[-1].getNumTrees == found.best[0]


def test_holdout_follows_the_key_and_not_the_partitioning(train):
    one = train.coalesce(1).filter(held_out()).select("user_id", "business_id")
    many = train.repartition(13).filter(held_out()).select("user_id", "business_id")
    assert Counter(one.collect()) == Counter(many.collect())
    assert 0.1 < one.count() / train.count() < 0.3


def test_command_line_writes_predictions_and_removes_its_folder(spark, capsys):
    folder = tempfile.mkdtemp(prefix="rateflow-test-")
    _write_inputs(spark, folder)
    before = set(_OPEN)
    assert main([folder, f"{folder}/yelp_val.csv", f"{folder}/out", "--rounds", "2", "--depth", "2"]) == 0
    assert "RMSE" in capsys.readouterr().out
    assert spark.read.option("header", True).csv(f"{folder}/out").count() > 0
    assert set(_OPEN) == before


def test_run_folder_keeps_only_the_predictions_and_goes_with_close(spark):
    inputs = inputs_from_tables(spark, SF_SMALL)
    res = run_pipeline(spark, inputs=inputs, max_iter=1, max_depth=2, search_pairs=[(1, 1), (1, 2)])
    path = res.folder.removeprefix("file:")
    assert os.listdir(path) == ["predictions"] and len(res.tried) == 2
    res.close()
    assert not os.path.exists(path)


def test_bench_times_the_search(spark):
    assert signature(bench.search_times).parameters["pairs"].default == SEARCH_PAIRS and len(SEARCH_PAIRS) == 5
    got = bench.search_times(spark, inputs_from_tables(spark, SF_SMALL), [(1, 1), (1, 2)])
    assert [t[:2] for t in got["tried"]] == [(1, 1), (1, 2)] and got["seconds"] > 0


def test_bench_reports_each_part(spark, capsys):
    report = {"queries": {}, "unfinished": []}
    bench.part(report, "one", lambda: None)
    with pytest.raises(ZeroDivisionError):
        bench.part(report, "two", lambda: 1 / 0)
    assert report["unfinished"] == ["two"] and list(report["queries"]) == ["one"]
    assert "bench: one" in capsys.readouterr().err
