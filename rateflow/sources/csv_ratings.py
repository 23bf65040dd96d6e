"""Ratings CSV lines.

The files are split on plain commas (no quoting); the first line is the header
and every line equal to it is removed, wherever it appears.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rateflow.functions.missing import as_number
from rateflow.sources.text import evaluated_once, first_line


def _resolve_header(lines: DataFrame, header: str | None) -> str | None:
    return first_line(lines) if header is None else header


def _is_body(header: str | None) -> Column:
    return F.lit(True) if header is None else F.col("value") != F.lit(header)


def drop_header(lines: DataFrame, header: str | None = None) -> DataFrame:
    """Remove every line equal to the header (the first line unless given)."""
    return lines.filter(_is_body(_resolve_header(lines, header)))


def _guarded(expr: Column, header: str | None) -> Column:
    # The header test is repeated inside each cast: when the header is a
    # literal row (as in the test adapter) the optimizer may fold the cast
    # before the filter has removed that row.
    return F.when(_is_body(header), expr)


def _n_fields() -> Column:
    return F.length("value") - F.length(F.replace(F.col("value"), F.lit(","), F.lit(""))) + F.lit(1)


def _field(k: int) -> Column:
    """The k-th field, NULL if there are fewer: found in the bytes, without splitting the line."""
    if k == 1:
        return F.substring_index("value", ",", 1)
    field = F.substring_index(F.substring_index("value", ",", k), ",", -1)
    return F.when(_n_fields() >= k, field)


def parse_rating_lines(lines: DataFrame, header: str | None = None) -> DataFrame:
    """Ratings rows: ``user_id, business_id, rating, label, n_fields``.

    ``rating`` is the third field (P20) and ``label`` the last field when the
    line has more than two (P21); both are NULL for shorter lines. Lines with
    fewer than two fields are kept here; ``training_rows`` drops them.
    """
    header = _resolve_header(lines, header)
    n = _n_fields()
    return evaluated_once(
        lines.filter(_is_body(header)),
        _field(1).alias("user_id"),
        _field(2).alias("business_id"),
        _guarded(as_number(_field(3)), header).alias("rating"),
        _guarded(F.when(n > 2, as_number(F.substring_index("value", ",", -1))), header).alias("label"),
        n.alias("n_fields"),
    )


def training_rows(ratings: DataFrame) -> DataFrame:
    """Rows that yield both a feature row and a label.

    A feature row needs two fields and a label needs three; a label of 0.0 is
    falsy in the job and is dropped. Feature row and label are kept together,
    so they can never fall out of step.
    """
    return ratings.filter(
        (F.col("n_fields") > 2) & F.col("label").isNotNull() & (F.col("label") != 0.0)
    )


def rated_rows(ratings: DataFrame) -> DataFrame:
    """Rows with a third field, a rating of 0.0 included: what the variances and means run on."""
    return ratings.filter(F.col("n_fields") > 2)


def val_frame(lines: DataFrame, header: str | None = None) -> DataFrame:
    """``user_id, business_id, original_rating`` for every validation line.

    A line without a third field has no original rating (NULL); it is
    predicted, but counts in no metric.
    """
    header = _resolve_header(lines, header)
    return evaluated_once(
        lines.filter(_is_body(header)),
        _field(1).alias("user_id"),
        _field(2).alias("business_id"),
        _guarded(as_number(_field(3)), header).alias("original_rating"),
    )
