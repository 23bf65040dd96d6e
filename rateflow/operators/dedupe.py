"""Last-wins de-duplication, the semantics of building a dict from key/value pairs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rateflow.sources.text import SEQ


def last_value(value: str | Column, seq: str | Column = SEQ, keep: Column | None = None) -> Column:
    """Aggregate: the value of the last row in read order (optionally among ``keep`` rows).

    ``max_by`` skips rows whose ordering is NULL, so rows failing ``keep`` are
    ignored. It is a partial aggregate: each task reduces its rows before the
    shuffle, so a key repeated on a third of all rows still moves one value
    per task.
    """
    order = F.col(seq) if isinstance(seq, str) else seq
    if keep is not None:
        order = F.when(keep, order)
    return F.max_by(value, order)


def last_wins(df: DataFrame, key: str | list[str], value_cols: list[str], seq: str = SEQ) -> DataFrame:
    """One row per key with the value columns of its last row.

    Each column is reduced by its own ``max_by`` over the same read position,
    so all values come from one row; numeric values keep every buffer
    fixed-width and the reduce runs as a hash aggregate.
    """
    keys = [key] if isinstance(key, str) else list(key)
    return df.groupBy(*keys).agg(*[last_value(c, seq).alias(c) for c in value_cols])
