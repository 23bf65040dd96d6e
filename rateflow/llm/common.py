"""What the operators share: shipping the package, stored tables, Arrow text chunks."""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession

from rateflow.operators.materialize import materialize, new_run_folder

__all__ = ["materialize", "new_run_folder"]

#: Id that stands for a null one: above every id that a table may hold.
NULL_ID = np.iinfo(np.int64).max
#: Padding behind a text buffer, so that eight bytes can be read at any of its positions.
PAD = 64


def ship(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it.

    On a cluster whose nodes lack the folder, ship the package with
    ``--py-files`` as any other dependency.
    """
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    known = env.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (root, known) if x)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def free_names(df: DataFrame, *names: str) -> list[str]:
    """Column names like the given ones that ``df`` does not have."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        out.append(name)
    return out


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Just the id and the text, under fixed names; further columns cannot clash."""
    return docs.select(
        docs[id_col].cast("bigint").alias("doc_id"), docs[text_col].cast("string").alias("text")
    )


def squeeze(data: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(data)


def unsqueeze(data: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(data)


def squeeze_ints(values: np.ndarray) -> bytes:
    """Unsigned integers as compressed byte planes: high planes of small values cost nothing."""
    v = np.ascontiguousarray(values, dtype="<u8")
    return squeeze(v.view(np.uint8).reshape(-1, 8).T.tobytes())


def unsqueeze_ints(data: bytes) -> np.ndarray:
    planes = np.frombuffer(unsqueeze(data), dtype=np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view("<u8").ravel()


def arrow_ids(column: pa.Array) -> np.ndarray:
    """Ids as int64; a null id becomes ``NULL_ID``."""
    return np.asarray(column.fill_null(NULL_ID).cast(pa.int64()))


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and the offsets of its rows; nulls are empty."""
    if column.null_count:
        column = column.fill_null("")
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def row_groups(sizes: np.ndarray, limit: int, rows: int | None = None) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive rows of ``limit`` bytes (and ``rows`` rows) at most; a longer row stands alone."""
    lo, held = 0, 0
    for i, n in enumerate(sizes.tolist()):
        if i > lo and (held + n > limit or i - lo == rows):
            yield lo, i
            lo, held = i, 0
        held += n
    if lo < len(sizes):
        yield lo, len(sizes)


def padded(raw: np.ndarray) -> np.ndarray:
    out = np.zeros(len(raw) + PAD, np.uint8)
    out[: len(raw)] = raw
    return out


def text_chunks(
    batch: pa.RecordBatch, limit: int, id_col: str = "doc_id", text_col: str = "text", rows: int | None = None
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(ids, padded bytes, offsets) of runs of whole documents of ``limit`` bytes (and ``rows`` documents) at most."""
    ids = arrow_ids(batch.column(id_col))
    raw, at = text_buffer(batch.column(text_col))
    for lo, hi in row_groups(np.diff(at), limit, rows):
        yield ids[lo:hi], padded(raw[at[lo] : at[hi]]), at[lo : hi + 1] - at[lo]


def null_ids_back(ids: np.ndarray) -> pa.Array:
    return pa.array(ids, pa.int64(), mask=ids == NULL_ID)


def text_strings(batch: pa.RecordBatch, text_col: str = "text", limit: int = 4 << 20) -> Iterator[tuple[int, int, list[str]]]:
    """Row ranges of ``limit`` bytes of text at most, with their texts; nulls are empty."""
    raw, at = text_buffer(batch.column(text_col))
    for lo, hi in row_groups(np.diff(at), limit):
        yield lo, hi, [raw[at[i] : at[i + 1]].tobytes().decode("utf-8") for i in range(lo, hi)]
