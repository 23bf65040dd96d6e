"""Means and defaults: A07-A13, and the per-column defaults of J05.

Every mean is a one-row aggregate over a de-duplicated dimension (one value
per key, as the job's dicts hold), except A08, which is over business.json
lines. Only these one-row results reach the driver, where they become literals of the fill.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rateflow.sources.schemas import USER_COUNTERS

# Rival-count mean as written: the job averages the length of (code, count)
# pairs, which is always 2.
RIVALS_MEAN_AS_WRITTEN = 2.0


def business_means(dim: DataFrame) -> DataFrame:
    """A08 + A10: one row of business means.

    ``mean_open_days_lines`` is over every business.json line (A08), from the
    per-key sums kept in the dimension. ``mean_open_days`` is over businesses
    after a count of 0 is replaced by that line mean (P12), computed in the
    same pass.
    """
    od = F.col("b_open_days")
    listed = F.col("line_count") > 0
    line_mean = F.sum("od_line_sum") / F.sum("line_count")
    imputed_mean = (
        F.coalesce(F.sum(F.when(od != 0, od)), F.lit(0))
        + F.count_if(listed & (od == 0)) * line_mean
    ) / F.count(F.when(listed, od))
    return dim.agg(
        F.avg("b_stars").alias("mean_stars"),
        F.avg("b_review_count").alias("mean_review_count"),
        F.avg("b_attr").alias("mean_attr"),
        line_mean.alias("mean_open_days_lines"),
        imputed_mean.alias("mean_open_days"),
        F.avg("b_wifi").alias("mean_wifi"),
        F.avg("b_noise").alias("mean_noise"),
        F.avg("b_weekend").alias("mean_weekend"),
        F.avg("b_price").alias("mean_price"),
        F.avg("b_checkins").alias("mean_checkins"),
        F.avg("b_photo").alias("mean_photo"),
    )


def user_means(dim: DataFrame) -> DataFrame:
    """One row of user means; counters over users passing P15, age and friends over all users."""
    return dim.agg(
        *[F.avg(f"u_{n}").alias(f"mean_{n}") for n in USER_COUNTERS],
        F.avg("u_age").alias("mean_age"),
        F.avg("u_friends").alias("mean_friends"),
    )


def tip_mean(tips: DataFrame) -> DataFrame:
    """Mean likes over (user, business) pairs."""
    return tips.agg(F.avg("t_likes").alias("mean_likes"))


def rivals_mean(rivals: DataFrame, parity: bool = False) -> DataFrame:
    """Mean rival count over areas (constant 2.0 with ``parity``)."""
    if parity:
        return rivals.agg(F.lit(RIVALS_MEAN_AS_WRITTEN).alias("mean_rivals"))
    return rivals.agg(F.avg("rivals").cast("double").alias("mean_rivals"))


def one_row(*frames: DataFrame) -> DataFrame:
    """Merge one-row frames with distinct columns into one row.

    The rows are stacked (each with NULL for the other frames' columns) and
    folded by one global aggregate; no join is needed.
    """
    stacked = frames[0]
    for f in frames[1:]:
        stacked = stacked.unionByName(f, allowMissingColumns=True)
    cols = [c for f in frames for c in f.columns]
    return stacked.agg(*[F.max(c).alias(c) for c in cols])


def variance_means(user_var: DataFrame, business_var: DataFrame) -> DataFrame:
    """Mean of the per-user and of the per-business rating variances."""
    u = user_var.agg(F.avg("rating_var").alias("mean_user_var"))
    b = business_var.agg(F.avg("rating_var").alias("mean_business_var"))
    return one_row(u, b)


def feature_domain(noise: DataFrame, price: DataFrame) -> DataFrame:
    """The distinct noise levels and price ranges over businesses."""
    n = noise.select(F.lit("noise").alias("feature"), F.col("noise").cast("bigint").alias("value"))
    p = price.select(F.lit("price").alias("feature"), F.col("price").cast("bigint").alias("value"))
    return n.union(p).distinct()


def _default_columns(parity: bool) -> dict[str, Column]:
    """Default value of each feature column, from the raw means."""
    c = F.col
    d = {
        "user_avg_rating": c("mean_average_stars"),
        "users_review_count": c("mean_review_count_u"),
        "useful": c("mean_useful"),
        "funny": c("mean_funny"),
        "cool": c("mean_cool"),
        "business_avg_rating": c("mean_stars"),
        "reviews": c("mean_review_count_b"),
        "is_open": F.lit(1.0),
        "avg_noise": c("mean_noise"),
        "has_WiFi": c("mean_wifi"),
        "checkins": c("mean_checkins"),
        "photo": c("mean_photo"),
        "avg_user_business_like": c("mean_likes"),
        "business_score": c("mean_rivals"),
        "fans": c("mean_fans"),
        "avg_friends": c("mean_friends"),
        "compliment_cool": c("mean_compliment_cool"),
        "compliment_funny": c("mean_compliment_funny"),
        "compliment_list": c("mean_compliment_list"),
        "compliment_note": c("mean_compliment_note"),
        "compliment_more": c("mean_compliment_more"),
        "compliment_photo": c("mean_compliment_photos"),
        "compliment_profile": c("mean_compliment_profile"),
        "compliment_writer": c("mean_compliment_writer"),
        "compliment_cute": c("mean_compliment_cute"),
        "compliment_plain": c("mean_compliment_plain"),
        "compliment_hot": c("mean_compliment_hot"),
        "user_yelping_age": c("mean_age"),
        "business_open": c("mean_open_days"),
        "business_price": c("mean_price"),
        "avg_weekend_days": c("mean_weekend"),
        "business_attr": c("mean_attr"),
    }
    if parity:
        # As written: the two star defaults are swapped (Q4) and three
        # compliment defaults take the mean of the previous counter (Q5).
        d["user_avg_rating"], d["business_avg_rating"] = d["business_avg_rating"], d["user_avg_rating"]
        d["compliment_cool"] = c("mean_cool")
        d["compliment_funny"] = c("mean_compliment_cool")
        d["compliment_list"] = c("mean_compliment_funny")
    return d


def defaults(
    bmeans: DataFrame, umeans: DataFrame, tmean: DataFrame, rmean: DataFrame, parity: bool = False
) -> DataFrame:
    """One row: ``d_<feature>`` for every feature, plus ``d_open_days_lines`` for P12."""
    u = umeans.withColumnRenamed("mean_review_count", "mean_review_count_u")
    b = bmeans.withColumnRenamed("mean_review_count", "mean_review_count_b")
    means = one_row(b, u, tmean, rmean)
    cols = [v.cast("double").alias(f"d_{k}") for k, v in _default_columns(parity).items()]
    return means.select(*cols, F.col("mean_open_days_lines").alias("d_open_days_lines"))
