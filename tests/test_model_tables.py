"""Model tables walked by SQL, staged search, collaborative filtering, ranks, pages, quarantine, previews as read."""

import math
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from helpers import SF_SMALL, lines
from rateflow.operators.interactions import user_rating_pages
from rateflow.operators.materialize import materialize, new_run_folder
from rateflow.operators.ranks import key_index, with_rank
from rateflow.plans import evaluate
from rateflow.plans.collaborative import factors, fit_als, predict_als
from rateflow.plans.features import FEATURES_29, build_dimensions, feature_matrix, train_ratings
from rateflow.plans.model import fit_gbt, held_out, predict, search, staged_search, tree_nodes
from rateflow.sources.json_lines import parse_json_lines, quarantine_json_lines
from rateflow.sources.schemas import REVIEW, REVIEW_KEYS
from rateflow.sources.sink import write_model
from rateflow.sources.tables import inputs_from_tables
from rateflow.sources.text import read_lines


@pytest.fixture(scope="module")
def train(spark):
    inp = inputs_from_tables(spark, SF_SMALL)
    return materialize(feature_matrix(train_ratings(inp), build_dimensions(inp)), new_run_folder(spark), "matrix")


def test_sql_walks_the_stored_trees_to_the_models_predictions(spark, train, tmp_path):
    model = fit_gbt(train, FEATURES_29, max_iter=3, max_depth=4)
    numbered = train.withColumn("row_no", F.monotonically_increasing_id())
    rows = predict(model, numbered)
    rows.write.parquet(str(tmp_path / "rows"))
    write_model(model, str(tmp_path / "nodes"))
    con = duckdb.connect()
    con.execute(f"CREATE TABLE rows AS SELECT * FROM read_parquet('{tmp_path}/rows/*.parquet')")
    con.execute(f"CREATE TABLE nodes AS SELECT * FROM read_parquet('{tmp_path}/nodes/*.parquet')")
    con.execute(f"CREATE TABLE cells AS UNPIVOT rows ON {', '.join(FEATURES_29)} INTO NAME feature VALUE v")
    got = con.execute("""
WITH RECURSIVE walk AS (
  SELECT row_no, tree, 0 AS node FROM rows CROSS JOIN (SELECT DISTINCT tree FROM nodes)
  UNION ALL
  SELECT w.row_no, w.tree, CASE WHEN c.v <= n."threshold" THEN n."left" ELSE n."right" END
  FROM walk w JOIN nodes n ON n.tree = w.tree AND n.node = w.node JOIN cells c ON c.row_no = w.row_no AND c.feature = n.feature
),
summed AS (SELECT row_no, sum(value * weight) AS p FROM walk JOIN nodes USING (tree, node) WHERE feature IS NULL GROUP BY row_no)
SELECT count(*), max(abs(p - prediction)) FROM rows JOIN summed USING (row_no)""").fetchone()
    assert got[0] == train.count() and got[1] < 1e-9
    assert con.execute("SELECT count(DISTINCT tree), min(weight), max(weight) FROM nodes").fetchone() == (3, 0.1, 1.0)


def test_stages_are_the_shorter_models(train):
    grown, tested = train.filter(~held_out()), train.filter(held_out())
    got = staged_search(grown, tested, FEATURES_29, [(4, 2), (1, 2), (2, 3), (2, 2)])
    for rounds, depth, rmse in got:
        alone = evaluate.rmse(predict(fit_gbt(grown, FEATURES_29, rounds, depth), tested)).first()["rmse"]
        assert rmse == pytest.approx(alone, rel=1e-9)
    assert [g[:2] for g in got] == [(4, 2), (1, 2), (2, 3), (2, 2)]


def test_search_fits_each_depth_once(train, monkeypatch):
    fits = []

    def counted(df, features, rounds, depth, *rest):
        fits.append((rounds, depth))
        return fit_gbt(df, features, rounds, depth, *rest)

    monkeypatch.setattr("rateflow.plans.model.fit_gbt", counted)
    found = search(train, FEATURES_29, [(1, 2), (3, 2), (2, 1)])
    assert fits == [(2, 1), (3, 2), found.best]


def _ratings(spark, rows):
    return spark.createDataFrame(rows, "user_id string, business_id string, label double")


def test_factors_solve_the_ridge_equations_and_fill_no_null(spark):
    """After the last half step each user's factors minimise squared error plus the penalty times the user's ratings."""
    rng = np.random.default_rng(5)
    rows = [(f"u{u}", f"b{b}", float(rng.integers(1, 6))) for u in range(40) for b in range(25) if rng.random() < 0.4]
    rows += [rows[0], (rows[0][0], rows[0][1], 1.0)]  # a pair rated three times
    fitted = fit_als(_ratings(spark, rows), new_run_folder(spark), rank=4, iterations=5, regularisation=0.1)
    users = {r.user_id: np.array(r.features) for r in factors(fitted, "user").collect()}
    items = {r.business_id: np.array(r.features) for r in factors(fitted, "business").collect()}
    rated = defaultdict(list)
    for u, b, x in rows:
        rated[u, b].append(x)
    of_user = defaultdict(list)
    for (u, b), xs in rated.items():
        of_user[u].append((items[b], np.mean(xs)))
    for u, seen in of_user.items():
        a, y = np.array([f for f, _ in seen]), np.array([x for _, x in seen])
        want = np.linalg.solve(a.T @ a + 0.1 * len(seen) * np.eye(4), a.T @ y)
        assert np.allclose(users[u], want, atol=1e-3)
    asked = [("u1", "b1", 1.0), ("u1", "new", 2.0), ("new", "b1", 3.0), ("new", "new", 4.0), (None, "b1", 1.0)]
    got = predict_als(fitted, _ratings(spark, asked).withColumn("prediction", F.lit(0.0))).collect()
    by_key = {(r.user_id, r.business_id): r for r in got}
    pairs = [(u, b, np.mean(x)) for (u, b), x in rated.items()]
    assert len(got) == 5 and all(math.isfinite(r.prediction) for r in got)
    assert by_key["u1", "b1"].prediction == pytest.approx(np.clip(users["u1"] @ items["b1"], 1, 5), abs=1e-4)
    assert by_key["u1", "new"].prediction == pytest.approx(np.mean([x for u, _, x in pairs if u == "u1"]))
    assert by_key["new", "b1"].prediction == by_key[None, "b1"].prediction == pytest.approx(np.mean([x for _, b, x in pairs if b == "b1"]))
    assert by_key["new", "new"].prediction == pytest.approx(np.mean([x for *_, x in pairs]))
    assert [by_key[k].origin for k in (("u1", "b1"), ("u1", "new"), ("new", "b1"), ("new", "new"))] == ["factors", "user", "business", "mean"]


def test_collaborative_filtering_beats_the_mean_on_training_rows(spark):
    inp = inputs_from_tables(spark, SF_SMALL, folder=new_run_folder(spark))
    train = train_ratings(inp)
    fitted = fit_als(train, new_run_folder(spark))
    own = evaluate.rmse(predict_als(fitted, train)).first()
    assert own["n"] == train.count()
    assert own["rmse"] <= evaluate.rmse(evaluate.mean_predictor(train, train)).first()["rmse"]


def test_ranks_are_dense_and_a_hot_key_spans_tasks(spark):
    rows = [("hot", f"b{i:05d}") for i in range(4000)] + [(f"k{i:05d}", "b") for i in range(6000)]
    df = spark.createDataFrame(rows, "key string, other string").repartition(8)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        ranked = with_rank(df, ["key", "other"], new_run_folder(spark), "t")
        parts = ranked.withColumn("p", F.spark_partition_id()).where("key = 'hot'").select("p").distinct().count()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    got = [(r.key, r.other) for r in sorted(ranked.collect(), key=lambda r: r["rank"])]
    assert got == sorted(rows) and parts > 1
    index = key_index(df, "key", new_run_folder(spark), "k")
    assert [(r.key, r.idx) for r in sorted(index.collect(), key=lambda r: r.idx)] == [(k, i) for i, k in enumerate(sorted({k for k, _ in rows}))]
    assert with_rank(df.limit(0), ["key"], new_run_folder(spark), "none").count() == 0


def test_pages_hold_each_users_ratings_in_order(spark):
    rows = [("hot", f"b{i % 900:04d}", float(1 + i % 5)) for i in range(3000)] + [(f"u{i % 700}", f"b{i}", 3.0) for i in range(2000)]
    pages = user_rating_pages(spark.createDataFrame(rows, "user_id string, business_id string, rating double").repartition(8), new_run_folder(spark), 64)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        pages = pages.withColumn("p", F.spark_partition_id()).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    of_user = defaultdict(list)
    for r in sorted(pages, key=lambda r: (r.user_id, r.page)):
        assert len(r.ratings) <= 64
        of_user[r.user_id].append([(x.business_id, x.rating) for x in r.ratings])
    want = defaultdict(list)
    for u, b, x in rows:
        want[u].append((b, x))
    assert {u: sum(p, []) for u, p in of_user.items()} == {u: sorted(v) for u, v in want.items()}
    assert all(len(p) == 64 for ps in of_user.values() for p in ps[:-1])
    assert len({r.p for r in pages if r.user_id == "hot"}) > 1


def test_bad_lines_are_set_aside_and_counted(spark):
    good = '{"user_id": "u", "business_id": "b", "stars": "3"}'
    texts = [good, "", "   ", "{", '{"user_id": "u", "stars": "3"}', '{"user_id": "u", "business_id": null, "stars": "3"}', "[1]", good, "'"]
    found = quarantine_json_lines(lines(spark, *texts), REVIEW, new_run_folder(spark), "reviews", REVIEW_KEYS)
    reasons = Counter((r.value, r.reason) for r in found.rejected.collect())
    assert reasons == Counter({("", "blank"): 1, ("   ", "blank"): 1, ("'", "blank"): 1, ("{", "malformed"): 1, ("[1]", "malformed"): 1,
                               ('{"user_id": "u", "stars": "3"}', "no key business_id"): 1})
    assert (found.n_kept, found.n_rejected) == (3, 6) and found.kept.count() == 3
    strict = parse_json_lines(found.kept.select("value"), REVIEW, required=REVIEW_KEYS)
    assert strict.count() == 3  # what is kept passes the strict mode
    for text in reasons:
        with pytest.raises(Exception):
            parse_json_lines(lines(spark, text[0]), REVIEW, required=REVIEW_KEYS).collect()


def test_previews_follow_the_files_as_read(spark, tmp_path):
    for name, values in (("b", ["5", "6"]), ("a", ["1", "2", "3"]), ("c", ["7"])):
        (tmp_path / f"{name}.txt").write_text("\n".join(values) + "\n")
    read = read_lines(spark, f"{tmp_path}/*.txt")
    assert [evaluate.preview_read(read, k).first()["value"] for k in (1, 2, 4)] == ["7", "6", "3"]
    plan = evaluate.preview_read(read, 2)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan and "rangepartitioning" not in plan
