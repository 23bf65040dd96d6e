"""Business side: per-line features, photo and check-in counts, areas, one business dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rateflow.functions.business import (
    capability_score,
    hours_map,
    is_open_flag,
    noise_level,
    open_days,
    price_range,
    review_count_value,
    weekend_days,
    wifi_level,
)
from rateflow.functions.missing import as_number, has_text
from rateflow.operators.dedupe import last_value, last_wins
from rateflow.operators.materialize import materialize, new_run_folder
from rateflow.sources.json_lines import parse_json_lines
from rateflow.sources.schemas import BUSINESS, BUSINESS_KEYS, CHECKIN, CHECKIN_KEYS, PHOTO, PHOTO_KEYS
from rateflow.sources.text import SEQ

# Per-line business features and the name each takes in the business dimension.
LINE_FEATURES = {
    "line_rivals": "b_rivals",
    "stars": "b_stars",
    "is_open": "b_is_open",
    "attr_score": "b_attr",
    "wifi": "b_wifi",
    "noise": "b_noise",
    "price": "b_price",
    "open_days": "b_open_days",
    "weekend_days": "b_weekend",
}


def business_rows(lines: DataFrame, parity: bool = False) -> DataFrame:
    """One row per business.json line with every per-line feature.

    The file is parsed once; ``hours`` is decoded once per line and shared by
    the open-day and weekend counts.
    """
    parsed = parse_json_lines(lines, BUSINESS, keep_line=True, required=BUSINESS_KEYS)
    staged = parsed.select(
        "business_id",
        "postal_code",
        SEQ,
        F.col("stars").alias("stars_text"),
        "review_count",
        "is_open",
        "attributes",
        "categories",
        "value",
        hours_map("hours").alias("hours_map"),
    )
    return staged.select(
        "business_id",
        "postal_code",
        SEQ,
        F.when(has_text("stars_text"), as_number("stars_text")).alias("stars"),
        review_count_value("review_count").alias("review_count"),
        is_open_flag("is_open").alias("is_open"),
        capability_score("value", "categories").alias("attr_score"),
        wifi_level("attributes", parity).alias("wifi"),
        noise_level("attributes").alias("noise"),
        price_range("attributes").alias("price"),
        open_days(F.col("hours_map")).alias("open_days"),
        weekend_days(F.col("hours_map")).alias("weekend_days"),
    )


def review_count_kept():
    """P14 filter: non-empty business id and a non-zero review count."""
    return has_text("business_id") & F.col("review_count").isNotNull() & (F.col("review_count") != 0)


def business_feature(rows: DataFrame, feature: str) -> DataFrame:
    """The job's dict for one per-line feature: ``business_id, <feature>``, last line wins."""
    if feature == "review_count":
        kept = rows.filter(review_count_kept())
        return last_wins(kept, "business_id", ["review_count"])
    return last_wins(rows, "business_id", [feature])


def photo_count(lines: DataFrame) -> DataFrame:
    """Photos per business."""
    photos = parse_json_lines(lines, PHOTO, required=PHOTO_KEYS)
    return photos.groupBy("business_id").agg(F.count(F.lit(1)).alias("photos"))


def checkin_rows(lines: DataFrame) -> DataFrame:
    """Total of the check-in map per line; lines with an empty map are skipped."""
    parsed = parse_json_lines(lines, CHECKIN, required=CHECKIN_KEYS)
    total = F.aggregate(F.map_values("time"), F.lit(0).cast("bigint"), lambda acc, x: acc + x)
    return parsed.filter(F.size("time") > 0).select("business_id", total.alias("checkins"), SEQ)


def checkin_total(lines: DataFrame) -> DataFrame:
    """P02 dict: ``business_id, checkins``, last line wins."""
    return last_wins(checkin_rows(lines), "business_id", ["checkins"])


def rivals_per_area(rows: DataFrame) -> DataFrame:
    """Distinct businesses per postal code (an empty code is its own area).

    ``count_distinct`` is planned as a partial aggregate on (area, business)
    first, so an area holding a third of all businesses is still spread over
    many tasks before the final count.
    """
    return rows.groupBy("postal_code").agg(F.count_distinct("business_id").alias("rivals"))


def open_days_imputed(rows: DataFrame) -> DataFrame:
    """P12 + A08: open-day count, with 0 replaced by the mean over all lines (zeros included).

    The file is parsed and reduced once: the per-business last value, sum and
    line count are stored, and the mean over lines is one row of that table.
    """
    folder = new_run_folder(rows)
    per_key = rows.groupBy("business_id").agg(
        last_value("open_days").alias("last"), F.sum("open_days").alias("total"), F.count("open_days").alias("n")
    )
    per_key = materialize(per_key, folder, "open_days")
    mean = per_key.agg((F.sum("total") / F.sum("n")).alias("mean")).first()["mean"]
    days = F.col("last").cast("double")
    return per_key.select("business_id", F.when(days == 0, F.lit(mean)).otherwise(days).alias("open_days"))


def area_lookup(rows: DataFrame, photo_lines: DataFrame, checkin_lines: DataFrame) -> DataFrame:
    """``business_id, postal_code, b_rivals`` of every business that any source names.

    business.json is read twice, once for the counts per area and once for the
    lines that look them up; both columns are then reduced together.
    """
    attached = attach_rivals(rows, rivals_per_area(rows)).select("business_id", "postal_code", "line_rivals", SEQ)
    photos = parse_json_lines(photo_lines, PHOTO, required=PHOTO_KEYS).select("business_id")
    checkins = checkin_rows(checkin_lines).select("business_id")
    stacked = attached.unionByName(photos.unionByName(checkins), allowMissingColumns=True)
    return stacked.groupBy("business_id").agg(
        last_value("postal_code").alias("postal_code"), last_value("line_rivals").alias("b_rivals")
    )


def attach_rivals(rows: DataFrame, rivals: DataFrame, parity: bool = False) -> DataFrame:
    """J04 per line: the rival count of the line's area as ``line_rivals``.

    The business dimension then keeps the count of its last line's area, the
    area the job looks the business up in. With ``parity`` the job's own
    lookup is kept: it searches the business id among the postal codes, which
    never matches in practice. ``rivals`` has one row per area.
    """
    r = rivals.select(F.col("postal_code").alias("_area"), F.col("rivals").alias("line_rivals"))
    key = F.col("business_id") if parity else F.col("postal_code")
    return rows.join(r, key.eqNullSafe(F.col("_area")), "left").drop("_area")


def business_dim(rows: DataFrame, photo_lines: DataFrame, checkin_lines: DataFrame) -> DataFrame:
    """All business-keyed values in one frame, built with one wide shuffle on ``business_id``.

    ``rows`` are business.json lines with ``line_rivals`` attached. The three
    sources are stacked and reduced by one ``groupBy``: last-wins for the
    business.json features and the check-in totals, the photos counted before, and
    the per-key sums needed for the mean open days over lines (A08). Every
    value is numeric and reduced by its own ``max_by`` / ``sum`` / ``count``,
    so the reduce is a hash aggregate with a map-side partial step. A key
    absent from a source gets NULL there, which the fill step turns into that
    column's mean. Output is hash-partitioned on ``business_id``.
    """
    biz = rows.select(
        "business_id",
        *[F.col(c).alias(f"_{n}") for c, n in LINE_FEATURES.items()],
        F.col(SEQ).alias("b_seq"),
        F.col("review_count").alias("rc"),
        F.when(review_count_kept(), F.col(SEQ)).alias("rc_seq"),
        F.col("open_days").alias("od_line"),
    )
    # Counted on their own first: a photo line would carry the buffers of every other column through the shuffle.
    photos = photo_count(photo_lines).withColumnRenamed("photos", "ph")
    checkins = checkin_rows(checkin_lines).select(
        "business_id", F.col("checkins").alias("ck"), F.col(SEQ).alias("ck_seq")
    )
    stacked = biz.unionByName(photos, allowMissingColumns=True).unionByName(
        checkins, allowMissingColumns=True
    )
    return stacked.groupBy("business_id").agg(
        *[last_value(f"_{n}", "b_seq").alias(n) for n in LINE_FEATURES.values()],
        last_value("rc", "rc_seq").alias("b_review_count"),
        F.sum("ph").alias("b_photo"),
        last_value("ck", "ck_seq").alias("b_checkins"),
        F.sum("od_line").alias("od_line_sum"),
        F.count("b_seq").alias("line_count"),
    )
