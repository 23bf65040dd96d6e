"""Per-line user features."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from rateflow.functions.missing import as_number, col, has_text, truthy_number
from rateflow.sources.schemas import USER_COUNTERS

# Reference date for account ages; the job read the clock, which made its
# output change from day to day.
DEFAULT_AS_OF = dt.date(2025, 1, 1)


def account_age_years(
    yelping_since: str | Column = "yelping_since", as_of: dt.date | str = DEFAULT_AS_OF
) -> Column:
    """Whole days from ``yelping_since`` to ``as_of``, divided by 365; 0 when absent.

    The date must be exactly ``yyyy-MM-dd``; anything else stops the job.
    """
    since = col(yelping_since)
    days = F.datediff(F.lit(str(as_of)).cast("date"), F.to_date(since, "yyyy-MM-dd"))
    return F.when(since.isNull(), F.lit(0.0)).otherwise(days / F.lit(365.0))


def friend_count(
    friends: str | Column = "friends", user_id: str | Column = "user_id", parity: bool = False
) -> Column:
    """Number of comma-separated friends; 0 for ``"None"`` or absent.

    With ``parity`` the job's own code is kept: it splits the user id, so every
    user with a friends list counts 1.
    """
    f = col(friends)
    counted = col(user_id) if parity else f
    return (
        F.when(f.isNull() | (f == F.lit("None")), F.lit(0))
        .otherwise(F.size(F.split(counted, ",")))
    )


def user_counters_present() -> Column:
    """P15 filter: user id and review count truthy; fans, useful and average_stars not ``""``."""
    return (
        has_text("user_id")
        & truthy_number("review_count")
        & has_text("fans")
        & has_text("useful")
        & has_text("average_stars")
    )


def user_counter_columns(counters: list[str] = USER_COUNTERS) -> list[Column]:
    """P15 values: ``average_stars`` as double, the other counters as bigint."""
    return [
        as_number(name, "double" if name == "average_stars" else "bigint").alias(name)
        for name in counters
    ]
