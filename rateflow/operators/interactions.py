"""Ratings, reviews and tips: P03, P16, A03-A05, A16-A18."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rateflow.functions.missing import as_number, has_text, truthy_number
from rateflow.operators.ranks import with_rank
from rateflow.sources.json_lines import parse_json_lines
from rateflow.sources.schemas import REVIEW, REVIEW_KEYS, TIP, TIP_KEYS
from rateflow.sources.text import SEQ


def review_projection(lines: DataFrame, keep_order: bool = False) -> DataFrame:
    """``business_id, stars`` of reviews whose ids and stars are all truthy (and the place read at)."""
    reviews = parse_json_lines(lines, REVIEW, required=REVIEW_KEYS)
    kept = reviews.filter(
        has_text("business_id") & has_text("user_id") & truthy_number("stars")
    )
    place = [SEQ] if keep_order else []
    return kept.select("business_id", "user_id", as_number("stars").alias("stars"), *place)


def tip_likes(lines: DataFrame) -> DataFrame:
    """P16 + A05: total likes per (user, business); a falsy ``likes`` counts 0.

    ``sum`` is reduced per task before the shuffle, so a hot pair moves one
    partial sum per task.
    """
    tips = parse_json_lines(lines, TIP, required=TIP_KEYS)
    likes = F.coalesce(as_number("likes", "bigint"), F.lit(0))
    return tips.groupBy("user_id", "business_id").agg(F.sum(likes).alias("t_likes"))


def rating_variance(ratings: DataFrame, key: str) -> DataFrame:
    """Population variance of the third field, per business or per user."""
    return ratings.groupBy(key).agg(F.var_pop("rating").alias("rating_var"))


def rating_mean_group(ratings: DataFrame, key: str) -> DataFrame:
    """Mean rating per key."""
    return ratings.groupBy(key).agg(F.avg("rating").alias("rating_mean"))


def review_count_user(reviews: DataFrame) -> DataFrame:
    """Number of kept reviews per user."""
    return reviews.groupBy("user_id").agg(F.count(F.lit(1)).alias("reviews"))


def user_rating_list(ratings: DataFrame) -> DataFrame:
    """Each user's (business, rating) list, in long form and in key order.

    The job gathered each user's ratings into one list. Here the list stays
    one row per rating, range-partitioned and sorted by (user, business):
    the sort samples both keys, so a user with a third of all ratings spans
    several tasks instead of one array in one task.
    """
    return ratings.select("user_id", "business_id", "rating").orderBy("user_id", "business_id", "rating")


#: Ratings of one user in one page.
PAGE = 50


def user_rating_pages(ratings: DataFrame, folder: str, size: int = PAGE) -> DataFrame:
    """Each user's (business, rating) list as pages: ``user_id, page, ratings`` of ``size`` at most.

    Pages follow the order of business and rating. Places come from one range
    sort over (user, business, rating), so a user with a third of all
    ratings is sorted by several tasks, and its pages are gathered by several too.
    """
    order = ["user_id", "business_id", "rating"]
    ranked = with_rank(ratings.select(*order), order, folder, "ratings_by_user")
    first = ranked.groupBy("user_id").agg(F.min("rank").alias("first"))
    placed = ranked.join(first, "user_id").withColumn("place", F.col("rank") - F.col("first"))
    # Without this the pages would be gathered where the join left them: one task per user.
    placed = placed.withColumn("page", F.floor(F.col("place") / size)).repartition("user_id", "page")
    paged = placed.groupBy("user_id", "page").agg(
        F.sort_array(F.collect_list(F.struct("place", "business_id", "rating"))).alias("ratings")
    )
    rows = F.transform("ratings", lambda r: F.struct(r["business_id"].alias("business_id"), r["rating"].alias("rating")))
    return paged.select("user_id", "page", rows.alias("ratings"))
