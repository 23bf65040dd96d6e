"""User side: per-line features and one user dimension."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rateflow.functions.user import (
    DEFAULT_AS_OF,
    account_age_years,
    friend_count,
    user_counter_columns,
    user_counters_present,
)
from rateflow.operators.dedupe import last_value
from rateflow.sources.json_lines import parse_json_lines
from rateflow.sources.schemas import USER, USER_COUNTERS, USER_KEYS
from rateflow.sources.text import SEQ


def user_rows(lines: DataFrame, as_of: dt.date | str = DEFAULT_AS_OF, parity: bool = False) -> DataFrame:
    """One row per user.json line: account age (P08), friends (P17), counters.

    ``counters`` is NULL for lines failing P15's filter; such users keep their
    age and friend count.
    """
    parsed = parse_json_lines(lines, USER, required=USER_KEYS)
    return parsed.select(
        "user_id",
        SEQ,
        account_age_years("yelping_since", as_of).alias("age"),
        friend_count("friends", "user_id", parity).alias("friends"),
        F.when(user_counters_present(), F.struct(*user_counter_columns())).alias("counters"),
    )


def user_dim(rows: DataFrame) -> DataFrame:
    """All user-keyed values in one frame, one shuffle on ``user_id``.

    Age and friends come from the last line of each user; the counters from
    the last line that passes P15's filter. Each value is reduced by its own
    ``max_by`` over the same read position, so all values of a user come from
    one line, and every buffer is numeric: the reduce runs as a hash
    aggregate with a map-side partial step.
    """
    kept = F.col("counters").isNotNull()
    reduced = rows.groupBy("user_id").agg(
        last_value("age").alias("u_age"),
        last_value("friends").alias("u_friends"),
        F.max(kept).alias("u_has_counters"),
        *[last_value(F.col(f"counters.{n}"), keep=kept).alias(f"u_{n}") for n in USER_COUNTERS],
    )
    return reduced


def user_features(rows: DataFrame) -> DataFrame:
    """P15 dict: users passing the filter with their counters, last line wins."""
    dim = user_dim(rows).filter("u_has_counters")
    return dim.select("user_id", *[F.col(f"u_{n}").alias(n) for n in USER_COUNTERS])
