"""Named queries over a scale-factor folder of test tables, one per operator.

Each takes ``(spark, sf_dir)`` and returns a DataFrame over the whole tables;
the lookups and what is built on them (``join_*``, ``fill_defaults``, matrices,
model) read the adapter's variant with missing keys. Most are lazy plans; the feature-matrix and model queries first store the
dimensions (they are read twice: for the defaults and for the lookups) and
read one aggregate row of defaults. ``canonical`` gives every result the
same presentation as the DuckDB oracle: integers as BIGINT, doubles rounded
to 6 places.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rateflow.operators import business as biz
from rateflow.operators import interactions as ix
from rateflow.operators import stats
from rateflow.operators import user as usr
from rateflow.operators.joins import hash_if_bounded, lookup
from rateflow.operators.materialize import materialize, new_run_folder, spread_for_compute
from rateflow.operators.standardize import STORED_COLUMNS, standardize
from rateflow.plans import evaluate
from rateflow.plans.bucketed import BucketedRows
from rateflow.plans.features import (
    FEATURES_29,
    build_dimensions,
    feature_matrix,
    materialize_dimensions,
    train_ratings,
    val_ratings,
)
from rateflow.operators.ranks import key_index
from rateflow.plans.collaborative import fit_als, predict_als
from rateflow.plans.model import fit_gbt, held_out, predict, staged_search, tree_nodes
from rateflow.sources.csv_ratings import drop_header, parse_rating_lines, rated_rows, val_frame
from rateflow.sources.inputs import Inputs
from rateflow.sources.json_lines import parse_json_lines, quarantine_json_lines
from rateflow.sources.schemas import BUSINESS, BUSINESS_KEYS
from rateflow.sources.sink import write_predictions
from rateflow.sources.tables import damaged_business_lines, inputs_from_tables, ordered_files, rating_file
from rateflow.sources.text import read_lines

Query = Callable[[SparkSession, str], DataFrame]

# Small model settings of the queries named *_small and of gbt_check; the job's
# own 200 x 9 and its search pairs run through ``run_pipeline``.
QUERY_ROUNDS = 10
QUERY_DEPTH = 5
# Pairs of depth 1, whose models SQL can compute too.
STUMP_PAIRS = [(1, 1), (2, 1), (3, 1), (5, 1), (8, 1)]
NODE_ROUNDS = 4
# Features of few distinct values: a stump over them has every split as a candidate.
STUMP_FEATURES = ["is_open", "avg_noise", "has_WiFi", "business_price", "avg_weekend_days"]


def _rounded(c: Column) -> Column:
    """``c`` rounded to 6 places; ``round`` works on a decimal, so a value that has no more places is kept as it is."""
    kept = (F.abs(c) < F.lit(1e9)) & (F.rint(c * F.lit(1e6)) / F.lit(1e6) == c)
    return F.when(kept, c).otherwise(F.round(c, 6))


def canonical(df: DataFrame) -> DataFrame:
    """Integers as BIGINT, floating point rounded to 6 places (never -0.0), other types unchanged."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
            c = c.cast("bigint")
        elif isinstance(f.dataType, (T.FloatType, T.DoubleType, T.DecimalType)):
            c = _rounded(c.cast("double")) + F.lit(0.0)  # no negative zero
        cols.append(c.alias(f.name))
    return df.select(*cols)


def _inputs(spark: SparkSession, sf_dir: str, gaps: bool = False) -> Inputs:
    return inputs_from_tables(spark, sf_dir, gaps)


def _business_rows(spark, sf_dir, parity=False):
    return biz.business_rows(_inputs(spark, sf_dir).business, parity)


def _user_rows(spark, sf_dir, parity=False):
    return usr.user_rows(_inputs(spark, sf_dir).user, parity=parity)


# --- sources and sinks -----------------------------------------------------

def _rating_lines(spark, sf_dir, which):
    return read_lines(spark, rating_file(spark, sf_dir, new_run_folder(spark), which))


def src_text_lines(spark, sf_dir):
    return _rating_lines(spark, sf_dir, "train").select("value")


def src_json_parse(spark, sf_dir):
    parsed = parse_json_lines(_inputs(spark, sf_dir).business, BUSINESS, required=BUSINESS_KEYS)
    return parsed.select(
        "business_id", "postal_code", "stars", "review_count", "is_open", "categories",
        F.size("attributes").alias("n_attributes"),
        F.col("hours").isNotNull().alias("has_hours"),
    )


def src_csv_ratings(spark, sf_dir):
    return parse_rating_lines(_rating_lines(spark, sf_dir, "train"))


def q_val_frame(spark, sf_dir):
    return val_frame(_rating_lines(spark, sf_dir, "val"))


def _mean_predictions(spark, sf_dir):
    inp = _inputs(spark, sf_dir)
    return evaluate.mean_predictor(train_ratings(inp), val_ratings(inp))


def sink_predictions(spark, sf_dir):
    path = f"{new_run_folder(spark)}/predictions"
    write_predictions(_mean_predictions(spark, sf_dir), path)
    return spark.read.option("header", True).schema("user_id string, business_id string, prediction double").csv(path)


def preview_limit(spark, sf_dir):
    return evaluate.preview(biz.rivals_per_area(_business_rows(spark, sf_dir)), ["postal_code"], 10)


def src_json_quarantine(spark, sf_dir):
    """Kept and rejected lines of business lines with planted damage."""
    found = quarantine_json_lines(damaged_business_lines(spark, sf_dir), BUSINESS, new_run_folder(spark), "business", BUSINESS_KEYS)
    kept = found.kept.select("business_id", "postal_code", F.lit(None).cast("string").alias("reason"), F.lit(None).cast("string").alias("line"))
    none = F.lit(None).cast("string")
    return kept.unionByName(found.rejected.select(none.alias("business_id"), none.alias("postal_code"), "reason", F.col("value").alias("line")))


def src_json_quarantine_counts(spark, sf_dir):
    """The counts observed while the lines were told apart."""
    found = quarantine_json_lines(damaged_business_lines(spark, sf_dir), BUSINESS, new_run_folder(spark), "business", BUSINESS_KEYS)
    return spark.createDataFrame([(found.n_kept, found.n_rejected)], "n_kept bigint, n_rejected bigint")


def preview_last(spark, sf_dir):
    """The last line of the validation file."""
    lines = drop_header(read_lines(spark, ordered_files(spark, sf_dir, new_run_folder(spark))[0]))
    return val_frame(evaluate.preview_read(lines), header="")


def preview_fifth_last(spark, sf_dir):
    """The 5th-last kept review of the review file."""
    lines = read_lines(spark, ordered_files(spark, sf_dir, new_run_folder(spark))[1])
    return evaluate.preview_read(ix.review_projection(lines, keep_order=True), 5)


def preview_last_pair(spark, sf_dir):
    return evaluate.preview_from_end(_dims(spark, sf_dir).tips, ["user_id", "business_id"])


def preview_fifth_last_pair(spark, sf_dir):
    return evaluate.preview_from_end(_dims(spark, sf_dir).tips, ["user_id", "business_id"], 5)


def preview_key(spark, sf_dir):
    return evaluate.preview_key(biz.business_feature(_business_rows(spark, sf_dir), "stars"), "business_id", "1")


# --- per-line features -----------------------------------------------------

def _business_feature(name):
    def q(spark, sf_dir):
        return biz.business_feature(_business_rows(spark, sf_dir), name)
    return q


def checkin_total(spark, sf_dir):
    return biz.checkin_total(_inputs(spark, sf_dir).checkin)


def review_projection(spark, sf_dir):
    return ix.review_projection(_inputs(spark, sf_dir).review)


def user_account_age(spark, sf_dir):
    return usr.user_dim(_user_rows(spark, sf_dir)).select("user_id", F.col("u_age").alias("age"))


def user_friend_count(spark, sf_dir):
    return usr.user_dim(_user_rows(spark, sf_dir)).select("user_id", F.col("u_friends").alias("friends"))


def open_days_imputed(spark, sf_dir):
    return biz.open_days_imputed(_business_rows(spark, sf_dir))


def user_features(spark, sf_dir):
    return usr.user_features(_user_rows(spark, sf_dir))


def tip_likes(spark, sf_dir):
    return ix.tip_likes(_inputs(spark, sf_dir).tip)


def label_column(spark, sf_dir):
    return train_ratings(_inputs(spark, sf_dir)).select("user_id", "business_id", "label")


# --- aggregates ------------------------------------------------------------

def photo_count(spark, sf_dir):
    return biz.photo_count(_inputs(spark, sf_dir).photo)


def rivals_per_area(spark, sf_dir):
    return biz.rivals_per_area(_business_rows(spark, sf_dir))


def _body_ratings(spark, sf_dir):
    """Every rated line of the training file, ratings of 0.0 included."""
    inp = _inputs(spark, sf_dir)
    return rated_rows(parse_rating_lines(inp.train, inp.train_header))


def rating_var_business(spark, sf_dir):
    return ix.rating_variance(_body_ratings(spark, sf_dir), "business_id")


def rating_var_user(spark, sf_dir):
    return ix.rating_variance(_body_ratings(spark, sf_dir), "user_id")


def rating_mean_group(spark, sf_dir):
    return ix.rating_mean_group(_body_ratings(spark, sf_dir), "business_id")


def review_count_user(spark, sf_dir):
    return ix.review_count_user(ix.review_projection(_inputs(spark, sf_dir).review))


def user_rating_list(spark, sf_dir):
    return ix.user_rating_list(_body_ratings(spark, sf_dir))


def user_rating_pages(spark, sf_dir):
    pages = ix.user_rating_pages(_body_ratings(spark, sf_dir), new_run_folder(spark))
    return pages.select(
        "user_id", "page", F.size("ratings").alias("n"), F.array_join(F.col("ratings.business_id"), ",").alias("businesses"),
        F.array_join(F.transform("ratings", lambda r: r["rating"].cast("string")), ",").alias("stars"),
    )


def feature_domain(spark, sf_dir):
    rows = _business_rows(spark, sf_dir)
    return stats.feature_domain(
        biz.business_feature(rows, "noise"), biz.business_feature(rows, "price")
    )


def _dims(spark, sf_dir, parity=False, gaps=False):
    return build_dimensions(_inputs(spark, sf_dir, gaps), parity=parity)


def user_means(spark, sf_dir):
    return stats.user_means(_dims(spark, sf_dir).user)


def business_means(spark, sf_dir):
    return stats.business_means(_dims(spark, sf_dir).business)


def tip_mean(spark, sf_dir):
    return stats.tip_mean(_dims(spark, sf_dir).tips)


def variance_means(spark, sf_dir):
    train = _body_ratings(spark, sf_dir)
    return stats.variance_means(ix.rating_variance(train, "user_id"), ix.rating_variance(train, "business_id"))


def rivals_mean(spark, sf_dir):
    return stats.rivals_mean(_dims(spark, sf_dir).rivals)


# --- joins -----------------------------------------------------------------

def _joined(spark, sf_dir):
    folder = new_run_folder(spark)
    inp = inputs_from_tables(spark, sf_dir, gaps=True, folder=folder)
    # Stored dimensions: next to a plain shuffle of theirs, a skewed ratings partition can be split.
    dims = build_dimensions(inp, store=lambda df, name: materialize(df, folder, name))
    return lookup(train_ratings(inp).drop("n_fields"), *map(hash_if_bounded, (dims.business, dims.user, dims.tips)))


def join_business(spark, sf_dir):
    cols = ["b_stars", "b_review_count", "b_is_open", "b_noise", "b_wifi", "b_checkins",
            "b_photo", "b_rivals", "b_open_days", "b_price", "b_weekend", "b_attr"]
    return _joined(spark, sf_dir).select("user_id", "business_id", "label", *cols)


def join_user(spark, sf_dir):
    cols = ["u_age", "u_friends", "u_average_stars", "u_review_count", "u_fans", "u_useful",
            "u_compliment_hot"]
    return _joined(spark, sf_dir).select("user_id", "business_id", "label", *cols)


def join_tip(spark, sf_dir):
    return _joined(spark, sf_dir).select("user_id", "business_id", "label", "t_likes")


def join_rivals(spark, sf_dir):
    inp = _inputs(spark, sf_dir, gaps=True)
    return biz.area_lookup(biz.business_rows(inp.business), inp.photo, inp.checkin)


def fill_defaults(spark, sf_dir):
    return _dims(spark, sf_dir, gaps=True).defaults


# --- feature matrix, scaling, evaluation ------------------------------------

def _stored(spark, sf_dir, parity=False):
    """Inputs and dimensions stored once, shared by the train and validation matrices."""
    folder = new_run_folder(spark)
    inp = inputs_from_tables(spark, sf_dir, gaps=True, folder=folder)
    return inp, materialize_dimensions(inp, folder, parity=parity)


def _matrix(stored, features="v29", which="train"):
    inp, dims = stored
    ratings = train_ratings(inp) if which == "train" else val_ratings(inp)
    return feature_matrix(ratings, dims, features)


def q_feature_matrix(spark, sf_dir):
    return _matrix(_stored(spark, sf_dir))


def feature_matrix_bucketed(spark, sf_dir):
    """The matrix by lookups over bucketed storage."""
    folder = new_run_folder(spark)
    inp = inputs_from_tables(spark, sf_dir, gaps=True, folder=folder)
    rows = BucketedRows(train_ratings(inp), val_ratings(inp), materialize_dimensions(inp, folder), folder)
    matrix = rows.matrix(folder, "train_matrix")
    rows.close()
    return matrix


def feature_matrix_v32(spark, sf_dir):
    return _matrix(_stored(spark, sf_dir), "v32")


def _earlier_matrix(features):
    def q(spark, sf_dir):
        return _matrix(_stored(spark, sf_dir), features)
    return q


def feature_matrix_parity(spark, sf_dir):
    return _matrix(_stored(spark, sf_dir, parity=True))


def q_standardize(spark, sf_dir):
    train, _ = standardize(_matrix(_stored(spark, sf_dir)), None, FEATURES_29)
    return train


def standardize_val(spark, sf_dir):
    stored = _stored(spark, sf_dir)
    return standardize(_matrix(stored), _matrix(stored, which="val"), FEATURES_29)[1]


def standardize_val_parity(spark, sf_dir):
    stored = _stored(spark, sf_dir, parity=True)
    return standardize(_matrix(stored), _matrix(stored, which="val"), FEATURES_29, parity=True)[1]


def eval_rmse(spark, sf_dir):
    return evaluate.rmse(_mean_predictions(spark, sf_dir))


def eval_error_hist(spark, sf_dir):
    return evaluate.error_histogram(_mean_predictions(spark, sf_dir))


def _model_frames(spark, sf_dir, features=FEATURES_29):
    """Scaled training and validation matrices, each stored before anything reads it twice."""
    stored, folder = _stored(spark, sf_dir), new_run_folder(spark)
    train = materialize(_matrix(stored, features), folder, "train_matrix")
    val = materialize(_matrix(stored, features, "val"), folder, "val_matrix")
    train, val = standardize(train, val, features, at_once=STORED_COLUMNS)
    return spread_for_compute(train), spread_for_compute(val)


def _small_model(spark, sf_dir):
    train, val = _model_frames(spark, sf_dir)
    return fit_gbt(train, FEATURES_29, max_iter=QUERY_ROUNDS, max_depth=QUERY_DEPTH), train, val


def gbt_predictions_small(spark, sf_dir):
    model, _, val = _small_model(spark, sf_dir)
    return predict(model, val).select("user_id", "business_id", "label", "prediction")


def gbt_error_hist_small(spark, sf_dir):
    model, _, val = _small_model(spark, sf_dir)
    return evaluate.error_histogram(predict(model, val))


def gbt_stump(spark, sf_dir):
    """One round of depth 1: a regression stump, which SQL can compute."""
    stored = _stored(spark, sf_dir)
    train = spread_for_compute(materialize(_matrix(stored, STUMP_FEATURES), new_run_folder(spark), "train_matrix"))
    model = fit_gbt(train, STUMP_FEATURES, max_iter=1, max_depth=1)
    return predict(model, _matrix(stored, STUMP_FEATURES, "val")).select("user_id", "business_id", "label", "prediction")


def gbt_check(spark, sf_dir):
    """One row: predictions made, null ones, the mean predictor's training RMSE, and whether the model's is not above it."""
    model, train, val = _small_model(spark, sf_dir)
    own = evaluate.rmse(predict(model, train)).first()["rmse"]
    mean = evaluate.rmse(evaluate.mean_predictor(train, train)).first()["rmse"]
    return predict(model, val).agg(
        F.count("*").alias("n"), F.count_if(F.col("prediction").isNull()).alias("n_null"),
        F.lit(mean).alias("mean_rmse"), F.lit(own <= mean).alias("not_above_mean"),
    )


def _stump_frames(spark, sf_dir):
    """Training matrix of the stump features, stored; spread over the slots."""
    stored = _stored(spark, sf_dir)
    return spread_for_compute(materialize(_matrix(stored, STUMP_FEATURES), new_run_folder(spark), "train_matrix"))


def gbt_search_small(spark, sf_dir):
    """The staged search over pairs of depth 1: held-out RMSE of each pair and whether it is the best."""
    train = _stump_frames(spark, sf_dir)
    tried = staged_search(train.filter(~held_out()), train.filter(held_out()), STUMP_FEATURES, STUMP_PAIRS)
    best = min(tried, key=lambda t: t[2])
    return spark.createDataFrame([(*t, t == best) for t in tried], "rounds bigint, depth bigint, rmse double, best boolean")


def gbt_nodes(spark, sf_dir):
    """The stored trees of a model of several rounds of depth 1."""
    train = _stump_frames(spark, sf_dir)
    return tree_nodes(fit_gbt(train, STUMP_FEATURES, max_iter=NODE_ROUNDS, max_depth=1), new_run_folder(spark))


# --- collaborative filtering -------------------------------------------------

def user_index(spark, sf_dir):
    """Each user of the training file and its number in the factor model."""
    return key_index(train_ratings(_inputs(spark, sf_dir)), "user_id", new_run_folder(spark), "users")


def _als(spark, sf_dir):
    folder = new_run_folder(spark)
    inp = inputs_from_tables(spark, sf_dir, folder=folder)
    fitted = fit_als(train_ratings(inp), folder)
    return predict_als(fitted, val_ratings(inp))


def als_predictions(spark, sf_dir):
    return _als(spark, sf_dir).select("user_id", "business_id", "label", "prediction")


def als_origins(spark, sf_dir):
    """Where each prediction comes from, and its value where that is a mean."""
    mean = F.when(F.col("origin") != "factors", F.col("prediction"))
    return _als(spark, sf_dir).select("user_id", "business_id", "label", "origin", mean.alias("mean_prediction"))


QUERIES: dict[str, Query] = {
    # sources and sinks
    "src_text_lines": src_text_lines,
    "src_json_parse": src_json_parse,
    "src_csv_ratings": src_csv_ratings,
    "val_frame": q_val_frame,
    "sink_predictions": sink_predictions,
    "preview_limit": preview_limit,
    "preview_last": preview_last,
    "preview_fifth_last": preview_fifth_last,
    "preview_last_pair": preview_last_pair,
    "preview_fifth_last_pair": preview_fifth_last_pair,
    "preview_key": preview_key,
    "src_json_quarantine": src_json_quarantine,
    "src_json_quarantine_counts": src_json_quarantine_counts,
    # per-line features
    "checkin_total": checkin_total,
    "review_projection": review_projection,
    "business_is_open": _business_feature("is_open"),
    "business_attr_score": _business_feature("attr_score"),
    "business_stars": _business_feature("stars"),
    "business_wifi": _business_feature("wifi"),
    "user_account_age": user_account_age,
    "business_open_days": _business_feature("open_days"),
    "business_weekend_days": _business_feature("weekend_days"),
    "open_days_imputed": open_days_imputed,
    "business_noise": _business_feature("noise"),
    "business_review_count": _business_feature("review_count"),
    "user_features": user_features,
    "tip_likes": tip_likes,
    "user_friend_count": user_friend_count,
    "business_price_range": _business_feature("price"),
    "label_column": label_column,
    # joins
    "join_business": join_business,
    "join_user": join_user,
    "join_tip": join_tip,
    "join_rivals": join_rivals,
    "fill_defaults": fill_defaults,
    # aggregates
    "photo_count": photo_count,
    "rivals_per_area": rivals_per_area,
    "rating_var_business": rating_var_business,
    "rating_var_user": rating_var_user,
    "feature_domain": feature_domain,
    "user_means": user_means,
    "business_means": business_means,
    "tip_mean": tip_mean,
    "variance_means": variance_means,
    "rivals_mean": rivals_mean,
    "eval_rmse": eval_rmse,
    "eval_error_hist": eval_error_hist,
    "rating_mean_group": rating_mean_group,
    "review_count_user": review_count_user,
    "user_rating_list": user_rating_list,
    "user_rating_pages": user_rating_pages,
    # features and model
    "feature_matrix": q_feature_matrix,
    "feature_matrix_bucketed": feature_matrix_bucketed,
    "feature_matrix_v32": feature_matrix_v32,
    "feature_matrix_v15": _earlier_matrix("v15"),
    "feature_matrix_v10": _earlier_matrix("v10"),
    "feature_matrix_v9": _earlier_matrix("v9"),
    "feature_matrix_v8": _earlier_matrix("v8"),
    "feature_matrix_parity": feature_matrix_parity,
    "standardize": q_standardize,
    "standardize_val": standardize_val,
    "standardize_val_parity": standardize_val_parity,
    "gbt_stump": gbt_stump,
    "gbt_check": gbt_check,
    "gbt_search_small": gbt_search_small,
    "gbt_predictions_small": gbt_predictions_small,
    "gbt_error_hist_small": gbt_error_hist_small,
    "gbt_nodes": gbt_nodes,
    # collaborative filtering
    "user_index": user_index,
    "als_predictions": als_predictions,
    "als_origins": als_origins,
}
