"""Truthiness rules of the job, spelled out as column predicates.

The job treats ``None``, ``""`` and ``0`` alike as "missing" (``if x:``). Read
as STRING, the text ``"0"`` and the number 0 cannot be told apart; both count
as zero.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def blank_to_null(c: str | Column) -> Column:
    """NULL for ``""``, the text otherwise."""
    c = col(c)
    return F.when(c != F.lit(""), c)


def as_number(c: str | Column, dtype: str = "double") -> Column:
    """A STRING field as a number, ``""`` as NULL; whole types take ``10.0`` too.

    A malformed number stops the job, as ``int()`` does, whatever the
    session's ANSI setting is.
    """
    c = col(c)
    # The text is tested only where it gives no number, so that a number costs one cast and little generated code.
    values = [c.try_cast(dtype)]
    if dtype != "double":
        value = c.try_cast("double")
        values.append(F.when(~F.isnan(value), value).try_cast(dtype))
    bad = F.when(c != F.lit(""), F.raise_error(F.concat(F.lit("not a number: "), c)).cast(dtype))
    return F.coalesce(*values, bad)


def has_text(c: str | Column) -> Column:
    """Present and not ``""``."""
    c = col(c)
    return c.isNotNull() & (c != F.lit(""))


def truthy_number(c: str | Column, dtype: str = "double") -> Column:
    """Present, not ``""`` and not zero."""
    n = as_number(c, dtype)
    return n.isNotNull() & (n != F.lit(0))
