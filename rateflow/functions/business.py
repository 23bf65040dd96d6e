"""Per-line business features."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rateflow.functions.missing import as_number, col, has_text

# Fixed values used by the job.
NOISE_LEVELS = {"quiet": 1, "average": 3, "loud": 4, "very_loud": 5}
NOISE_MISSING = 3
WIFI_LEVELS = {"no": 0, "free": 1, "paid": 2}
WIFI_MISSING = 0
WEEKEND = ["friday", "saturday", "sunday"]
WEEKEND_UNKNOWN = 2
PRICE_MISSING = -1
TRUE_TEXT = "True"


def is_open_flag(is_open: str | Column = "is_open") -> Column:
    """The ``is_open`` value when truthy, else 0 (absent, ``""``, 0); JSON ``true`` is 1."""
    text = col(is_open)
    flag = F.when(text == "true", F.lit("1")).when(text == "false", F.lit("0")).otherwise(text)
    return F.coalesce(as_number(flag, "int"), F.lit(0))


def capability_score(line: str | Column = "value", categories: str | Column = "categories") -> Column:
    """Occurrences of ``True`` in the whole raw line + number of categories."""
    cats = col(categories)
    n_categories = F.when(has_text(cats), F.size(F.split(cats, ","))).otherwise(F.lit(0))
    return F.regexp_count(col(line), F.lit(TRUE_TEXT)).cast("int") + n_categories


def wifi_level(attributes: str | Column = "attributes", parity: bool = False) -> Column:
    """No 0, free 1, paid 2, anything else 0.

    With ``parity`` the job's own test is kept: it looks for a JSON fragment
    among the record's keys, never finds it, and returns 0 for every business.
    """
    if parity:
        return F.lit(WIFI_MISSING)
    value = F.try_element_at(col(attributes), F.lit("WiFi"))
    level = F.lit(WIFI_MISSING)
    for name, code in reversed(list(WIFI_LEVELS.items())):
        level = F.when(value == F.lit(name), F.lit(code)).otherwise(level)
    return level


def hours_map(hours: str | Column = "hours") -> Column:
    """``hours`` (JSON text) as a map; NULL when absent, ``""`` or ``"null"``."""
    h = col(hours)
    return F.when(has_text(h) & (h != F.lit("null")), F.from_json(h, "map<string,string>"))


def open_days(hours: Column) -> Column:
    """P10: number of days in ``hours``; 0 when absent, null or empty."""
    return F.coalesce(F.size(hours), F.lit(0))


def weekend_days(hours: Column) -> Column:
    """Friday-Sunday keys (any case) among the days; 2 when hours is unknown."""
    lowered = F.transform(F.map_keys(hours), lambda k: F.lower(k))
    hits = F.size(F.array_intersect(lowered, F.array(*map(F.lit, WEEKEND))))
    return F.when(F.coalesce(F.size(hours), F.lit(0)) > 0, hits).otherwise(F.lit(WEEKEND_UNKNOWN))


def noise_level(attributes: str | Column = "attributes") -> Column:
    """Quiet 1, average 3, loud 4, very_loud 5; missing 3; unknown stops the job."""
    value = F.try_element_at(col(attributes), F.lit("NoiseLevel"))
    level = F.raise_error(F.concat(F.lit("unknown NoiseLevel: "), value)).cast("int")
    for name, code in reversed(list(NOISE_LEVELS.items())):
        level = F.when(value == F.lit(name), F.lit(code)).otherwise(level)
    return F.when(~has_text(value), F.lit(NOISE_MISSING)).otherwise(level)


def price_range(attributes: str | Column = "attributes") -> Column:
    """``RestaurantsPriceRange2`` as an int, -1 when absent."""
    value = F.try_element_at(col(attributes), F.lit("RestaurantsPriceRange2"))
    return F.when(value.isNull(), F.lit(PRICE_MISSING)).otherwise(as_number(value, "int"))


def review_count_value(review_count: str | Column = "review_count") -> Column:
    """The review count as a number (NULL for ``""``)."""
    return as_number(review_count, "bigint")
