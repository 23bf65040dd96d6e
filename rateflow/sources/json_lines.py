"""JSON-lines parsing."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rateflow.operators.materialize import materialize
from rateflow.sources.text import SEQ, read_order

CORRUPT = "_corrupt_record"


def _checked(field: str) -> Column:
    """A required field of the record; stops the job if its key is absent (a null value is allowed)."""
    value = F.col(f"_rec.{field}")
    present = F.array_contains(F.json_object_keys(F.col("_json")), F.lit(field))
    absent = F.raise_error(F.concat(F.lit(f"no key {field}: "), F.col("_json")))
    # In a branch of its own: the right side of an AND counts as always evaluated, and
    # keys that two fields ask for would be listed, the line parsed again, for every line.
    return F.coalesce(value, F.when(~F.coalesce(present, F.lit(False)), absent)).alias(field)


def _unquoted() -> Column:
    """The line without single quotes, found in its bytes (``translate`` looks up every character)."""
    return F.replace(F.col("value"), F.lit("'"), F.lit(""))


def parse_json_lines(
    lines: DataFrame,
    schema: T.StructType,
    mode: str = "FAILFAST",
    keep_line: bool = False,
    required: tuple[str, ...] = (),
) -> DataFrame:
    """Parse ``value`` lines into the columns of ``schema``.

    Every single quote is deleted from the line before parsing, as the job
    does. ``FAILFAST`` stops the job on a malformed or blank line and on a
    line without a ``required`` key; ``PERMISSIVE`` keeps going and puts the
    bad line in ``_corrupt_record``. ``keep_line`` keeps the raw line
    (``value``) next to the fields; a read-order column ``_seq`` is always
    added for last-wins de-duplication.
    """
    mode = mode.upper()
    options = {"mode": mode}
    if mode == "PERMISSIVE":
        schema = T.StructType(list(schema.fields) + [T.StructField(CORRUPT, T.StringType())])
        options["columnNameOfCorruptRecord"] = CORRUPT
    elif mode != "FAILFAST":
        raise ValueError(f"unsupported mode {mode!r}")
    strict = mode == "FAILFAST"
    staged = lines.select(_unquoted().alias("_json"), "value", read_order(lines))
    if strict:
        blank = F.when(F.trim("_json") == "", F.raise_error(F.lit("blank line")))
        staged = staged.withColumn("_json", blank.otherwise(F.col("_json")))
    parsed = staged.select(F.from_json("_json", schema, options).alias("_rec"), "_json", "value", SEQ)
    extra = ["value"] if keep_line else []
    fields = [_checked(f.name) if strict and f.name in required else F.col(f"_rec.{f.name}") for f in schema.fields]
    return parsed.select(*fields, *extra, SEQ)


@dataclass
class Quarantine:
    """Lines told apart: parsed rows, bad lines with the reason, and how many of each."""

    kept: DataFrame  # the schema's columns, value, _seq
    rejected: DataFrame  # value, reason, _seq
    n_kept: int
    n_rejected: int


def quarantine_json_lines(
    lines: DataFrame, schema: T.StructType, folder: str, name: str, required: tuple[str, ...] = ()
) -> Quarantine:
    """Parse as ``FAILFAST`` would, but set bad lines aside instead of stopping.

    A line is bad if it is ``blank``, ``malformed``, or has ``no key X``: what
    stops the strict mode. Rows are parsed once and stored as one table dealt by
    outcome; the counts are observed while it is written.
    """
    fields = list(schema.fields) + [T.StructField(CORRUPT, T.StringType())]
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    staged = lines.select(_unquoted().alias("_json"), "value", read_order(lines))
    parsed = staged.select(F.from_json("_json", T.StructType(fields), options).alias("_rec"), "_json", "value", SEQ)
    reason = F.when(F.trim("_json") == "", "blank")
    reason = reason.when(F.col("_rec").isNull() | F.col(f"_rec.{CORRUPT}").isNotNull(), "malformed")
    keys = F.json_object_keys(F.col("_json"))
    for field in required:
        absent = ~F.coalesce(F.array_contains(keys, F.lit(field)), F.lit(False))
        reason = reason.when(F.col(f"_rec.{field}").isNull() & absent, f"no key {field}")
    judged = parsed.select(*[F.col(f"_rec.{f.name}") for f in schema.fields], "value", SEQ, reason.alias("reason"))
    kept = F.col("reason").isNull()
    judged = judged.withColumn("_outcome", F.when(kept, "kept").otherwise("rejected"))
    seen = Observation(f"{name}_quarantine")
    counted = judged.observe(seen, F.count_if(kept).alias("kept"), F.count_if(~kept).alias("rejected"))
    stored = materialize(counted, folder, name, partition_by="_outcome")
    return Quarantine(
        stored.where("_outcome = 'kept'").drop("reason", "_outcome"), stored.where("_outcome = 'rejected'").select("value", "reason", SEQ),
        seen.get["kept"], seen.get["rejected"],
    )
