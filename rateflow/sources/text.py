"""Line source."""

from __future__ import annotations

import re
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SEQ = "_seq"
# Widths of the read order's parts in decimal digits: bytes into a file, rows of a split.
_BLOCK_UNIT = Decimal(10**11)
_FILE_UNIT = Decimal(10**26)
# Files of one input whose ranks are inlined; beyond that they are joined as a small table.
_INLINE_FILES = 16


# Local files are listed as file:///a and named file:/a by their rows.
_LOCAL = re.compile("^file:/+")


def _plain(name: str) -> str:
    return _LOCAL.sub("file:/", name)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Every line of the file(s) at ``path`` as ``value STRING``, and its place as ``_seq``.

    One read per file; the caller derives every column from this one frame
    instead of re-reading the file per feature. ``_seq`` orders lines by file
    name, then by place in the file, however Spark packs splits into tasks:
    rank of the file, start of the split, row within the task. It is a
    number, so reduces that keep the last line stay hash aggregates.
    """
    lines = spark.read.text(path)
    files = [_plain(name) for name in sorted(lines.inputFiles())]
    path = F.regexp_replace("_metadata.file_path", _LOCAL.pattern, "file:/")
    place = (
        F.col("_metadata.file_block_start").cast("decimal(38,0)") * F.lit(_BLOCK_UNIT)
        + (F.monotonically_increasing_id() % (1 << 33)).cast("decimal(38,0)")
    ).cast("decimal(38,0)")
    if len(files) <= _INLINE_FILES:
        rank = F.lit(0)
        for i, name in enumerate(files[1:], 1):
            rank = F.when(path == name, F.lit(i)).otherwise(rank)
        order = (rank.cast("decimal(38,0)") * F.lit(_FILE_UNIT)).cast("decimal(38,0)")
        return lines.select("value", (order + place).cast("decimal(38,0)").alias(SEQ))
    ranks = spark.createDataFrame(list(enumerate(files)), "rank bigint, file string")
    placed = lines.select("value", path.alias("file"), place.alias("place"))
    order = (F.col("rank").cast("decimal(38,0)") * F.lit(_FILE_UNIT)).cast("decimal(38,0)")
    # One short row per input file, which the driver has listed anyway.
    joined = placed.join(F.broadcast(ranks), "file")
    return joined.select("value", (order + F.col("place")).cast("decimal(38,0)").alias(SEQ))


def evaluated_once(df: DataFrame, *cols: str | Column) -> DataFrame:
    """``df.select(*cols)`` for parsed columns: a later filter reads their values.

    The optimizer pushes a filter below a plain projection by copying the
    expressions into it, into a join's condition even, and each copy parses the
    line again; it pushes none below a generated row.
    """
    return df.select(F.inline(F.array(F.struct(*cols))))


def read_order(lines: DataFrame) -> Column:
    """Position of a line in read order, used for last-wins de-duplication.

    Lines read from files carry it. For other frames it is
    ``monotonically_increasing_id``, which grows with the partition index and
    the row position inside it.
    """
    place = F.col(SEQ) if SEQ in lines.columns else F.monotonically_increasing_id()
    return place.alias(SEQ)


def first_line(lines: DataFrame) -> str | None:
    """First line: of the first file by name that has one, else of the frame (reads one row)."""
    for name in sorted(lines.inputFiles()) if SEQ in lines.columns else ():
        row = lines.sparkSession.read.text(name).first()
        if row is not None:
            return row[0]
    row = lines.select("value").first()
    return None if row is None else row[0]
