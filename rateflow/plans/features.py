"""Dimensions, defaults and the feature matrix."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rateflow.functions.user import DEFAULT_AS_OF
from rateflow.operators import business as biz
from rateflow.operators import stats
from rateflow.operators import user as usr
from rateflow.operators.interactions import tip_likes
from rateflow.operators.joins import broadcast_if_small, default_values, fill_defaults, hash_if_bounded, lookup
from rateflow.operators.materialize import materialize
from rateflow.sources.csv_ratings import parse_rating_lines, training_rows
from rateflow.sources.inputs import Inputs

# The job's feature vectors, in its column order.
FEATURES_29 = [
    "user_avg_rating", "users_review_count", "useful", "funny", "cool",
    "business_avg_rating", "reviews", "is_open", "avg_noise", "has_WiFi",
    "checkins", "photo", "avg_user_business_like", "business_score", "fans",
    "avg_friends", "compliment_cool", "compliment_funny", "compliment_list",
    "compliment_note", "compliment_more", "compliment_photo", "compliment_profile",
    "compliment_writer", "user_yelping_age", "business_open", "business_price",
    "avg_weekend_days", "business_attr",
]
FEATURES_32 = [
    "user_avg_rating", "users_review_count", "useful", "funny", "cool",
    "business_avg_rating", "reviews", "is_open", "avg_noise", "has_WiFi",
    "checkins", "photo", "avg_user_business_like", "business_score", "fans",
    "avg_friends", "compliment_cool", "compliment_funny", "compliment_list",
    "compliment_note", "compliment_more", "compliment_photo", "compliment_profile",
    "compliment_writer", "compliment_cute", "compliment_plain", "compliment_hot",
    "user_yelping_age", "business_open", "business_price", "avg_weekend_days",
    "business_attr",
]
# Earlier vectors the job kept as comments.
FEATURE_SETS = {
    "v29": FEATURES_29,
    "v32": FEATURES_32,
    "v10": [
        "user_avg_rating", "users_review_count", "useful", "fans", "business_avg_rating",
        "reviews", "photo", "checkins", "funny", "cool",
    ],
    "v8": [
        "user_avg_rating", "users_review_count", "useful", "funny", "cool",
        "business_avg_rating", "reviews", "is_open",
    ],
    "v9": [
        "user_avg_rating", "users_review_count", "business_avg_rating", "reviews",
        "avg_noise", "has_WiFi", "checkins", "photo", "avg_user_business_like",
    ],
    "v15": [
        "user_avg_rating", "users_review_count", "business_avg_rating", "reviews", "is_open",
        "avg_noise", "has_WiFi", "checkins", "photo", "avg_user_business_like",
        "business_score", "business_open", "business_price", "avg_weekend_days", "business_attr",
    ],
}


def resolve_features(features: str | list[str]) -> list[str]:
    return FEATURE_SETS[features] if isinstance(features, str) else list(features)


@dataclass
class Dimensions:
    """The lookup tables of the job and its one-row defaults."""

    business: DataFrame  # one row per business, b_* columns (b_rivals included)
    user: DataFrame  # one row per user, u_* columns
    tips: DataFrame  # one row per (user, business), t_likes
    rivals: DataFrame  # one row per postal code
    defaults: DataFrame | dict  # one row, d_<feature> (a frame, or its values)


def build_dimensions(
    inputs: Inputs,
    as_of: dt.date | str = DEFAULT_AS_OF,
    parity: bool = False,
    store: Callable[[DataFrame, str], DataFrame] | None = None,
) -> Dimensions:
    """Parse every source once and reduce it to its keyed dimension (one shuffle per key).

    ``store`` (frame, name) -> frame, when given, is applied to each
    dimension as soon as it is built, so later steps read the stored table
    (the areas are stored before the business dimension looks them up), and to
    the business and user lines, whose parsed values are each read many times.
    """
    keep = store or (lambda df, _name: df)
    rows = keep(biz.business_rows(inputs.business, parity), "business_rows")
    rivals = keep(biz.rivals_per_area(rows), "area_dim")
    business = keep(
        biz.business_dim(biz.attach_rivals(rows, rivals, parity), inputs.photo, inputs.checkin),
        "business_dim",
    )
    user = keep(usr.user_dim(keep(usr.user_rows(inputs.user, as_of, parity), "user_rows")), "user_dim")
    tips = keep(tip_likes(inputs.tip), "tip_dim")
    dflt = stats.defaults(
        stats.business_means(business),
        stats.user_means(user),
        stats.tip_mean(tips),
        stats.rivals_mean(rivals, parity),
        parity,
    )
    return Dimensions(business=business, user=user, tips=tips, rivals=rivals, defaults=dflt)


def materialize_dimensions(
    inputs: Inputs, folder: str, as_of: dt.date | str = DEFAULT_AS_OF, parity: bool = False
) -> Dimensions:
    """Build the dimensions, storing each as a table under ``folder``, and size their broadcast.

    The dimensions feed both the training and the validation lookups and the
    defaults; storing them computes each once and cuts its lineage. The
    defaults are then aggregated from the stored tables into one row of
    numbers, and the business and user tables are broadcast only if their
    measured size fits (``broadcast_if_small``), else hashed by a shuffle join
    if a task's share does, as the pairs are (``hash_if_bounded``).
    """
    dims = build_dimensions(inputs, as_of, parity, store=lambda df, name: materialize(df, folder, name))
    return Dimensions(
        business=hash_if_bounded(broadcast_if_small(dims.business)),
        user=hash_if_bounded(broadcast_if_small(dims.user)),
        tips=hash_if_bounded(dims.tips),
        rivals=dims.rivals,
        defaults=default_values(dims.defaults),
    )


def train_ratings(inputs: Inputs) -> DataFrame:
    """Training rows: ratings lines with both features and a label."""
    return training_rows(parse_rating_lines(inputs.train, inputs.train_header))


def val_ratings(inputs: Inputs) -> DataFrame:
    """Validation rows: every line with two fields gets a prediction.

    The label is the third field, the ``original_rating`` the RMSE is taken against.
    """
    ratings = parse_rating_lines(inputs.val, inputs.val_header)
    return ratings.filter(F.col("n_fields") > 1).withColumn("label", F.col("rating"))


def feature_matrix(
    ratings: DataFrame, dims: Dimensions, features: str | list[str] = "v29"
) -> DataFrame:
    """``user_id, business_id, rating, label`` and the feature columns, all doubles."""
    cols = resolve_features(features)
    joined = lookup(ratings.drop("n_fields"), dims.business, dims.user, dims.tips)
    return fill_defaults(joined, dims.defaults, cols)
