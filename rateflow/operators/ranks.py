"""Distributed positions: a dense rank of sorted rows without a global window.

The rows are range-partitioned and sorted, and stored with their partition and
place; the partitions' sizes, one number each, give the offsets. No task sees
more than its range, and a key that holds a third of all rows spans several
ranges when further columns are sorted by.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rateflow.operators.materialize import materialize

#: Bits of the row number inside a partition in ``monotonically_increasing_id``.
_ROW_BITS = 33


def with_rank(df: DataFrame, by: list[str], folder: str, name: str, rank: str = "rank") -> DataFrame:
    """``df`` with the 0-based position of each row in the order of ``by``; stored under ``folder``.

    Ties take positions in an arbitrary but stored order.
    """
    place = F.monotonically_increasing_id()
    placed = df.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("_place", place)
    stored = materialize(placed, folder, name)
    part = F.shiftright("_place", _ROW_BITS)
    sizes = {r["part"]: r["n"] for r in stored.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).collect()}
    rows, before = [], 0
    for p in sorted(sizes):
        rows.append((p, before))
        before += sizes[p]
    # One row per partition of the range sort: as many as there are tasks.
    offsets = df.sparkSession.createDataFrame(rows, "_part bigint, _before bigint")
    joined = stored.withColumn("_part", part).join(F.broadcast(offsets), "_part")
    return joined.withColumn(rank, F.col("_before") + F.col("_place").bitwiseAND((1 << _ROW_BITS) - 1)).drop("_part", "_place", "_before")


def key_index(df: DataFrame, key: str, folder: str, name: str) -> DataFrame:
    """(key, idx): every distinct non-null key and its rank in key order."""
    return with_rank(df.select(key).where(F.col(key).isNotNull()).distinct(), [key], folder, name, "idx")
