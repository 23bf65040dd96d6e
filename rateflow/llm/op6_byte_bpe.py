"""Byte-level BPE with the tiktoken library and a local rank file.

Long texts are cut before encoding at places where no match of the pattern can
span: between an ASCII letter or digit and a following blank or line break
(no alternative of the pattern has white space after another character, and
its one look-ahead only looks past white space). Pieces are encoded one after
another, so the library's working memory follows the piece and not the text;
a text without such a place is encoded in one piece. Decoding joins the raw
bytes of the ids, so ids that end inside a character are no problem.

Null texts are empty texts: no ids. Repeated rows are encoded each.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import public_tokenizers
import tiktoken
from pyspark.sql import DataFrame, SparkSession

from rateflow.llm.common import arrow_ids, id_and_text, null_ids_back, read, ship, text_strings

#: Characters after which a long text is cut at the next safe place.
PIECE = 1 << 16
#: A rank file is sent to the executors once; files beyond this are refused.
MAX_RANK_BYTES = 64 << 20

_SAFE = re.compile(r"(?<=[A-Za-z0-9])[ \n]")


def load_encoding(ranks: bytes, pattern: str) -> tiktoken.Encoding:
    pairs = (line.split() for line in ranks.splitlines() if line)
    return tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks={base64.b64decode(a): int(b) for a, b in pairs}, special_tokens={})


def pieces(text: str, size: int = PIECE) -> Iterator[str]:
    """The text in pieces of about ``size`` characters, cut at safe places only."""
    at = 0
    while len(text) - at > size:
        cut = _SAFE.search(text, at + size)
        if not cut:
            break
        yield text[at : cut.start()]
        at = cut.start()
    yield text[at:] if at else text


def encode_text(encoding: tiktoken.Encoding, text: str, size: int = PIECE) -> np.ndarray:
    return np.concatenate([encoding.encode_to_numpy(piece, disallowed_special=()) for piece in pieces(text, size)])


class Decimals:
    """Ids as decimal text joined by one blank, by table."""

    def __init__(self, n: int):
        self.wide = len(str(max(n - 1, 0))) + 1
        texts = np.array([f"{i} ".encode() for i in range(n)], dtype=f"S{self.wide}")
        self.table = texts.view(np.uint8).reshape(n, self.wide)
        self.size = n

    def join(self, ids: np.ndarray) -> bytes:
        flat = self.table[ids].ravel()
        return flat[flat != 0].tobytes()[:-1]


def _ranks(path: str) -> bytes:
    with open(path, "rb") as f:
        data = f.read(MAX_RANK_BYTES + 1)
    if len(data) > MAX_RANK_BYTES:
        raise ValueError(f"{path}: over {MAX_RANK_BYTES} bytes")
    return data


def _broadcast_loader(spark: SparkSession, path: str, pattern: str):
    data = spark.sparkContext.broadcast(_ranks(path))
    return lambda: load_encoding(data.value, pattern)


def encode(docs: DataFrame, path: str, pattern: str = public_tokenizers.PATTERN, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids array<int>, n_tokens) of each row."""
    ship(docs.sparkSession)
    load = _broadcast_loader(docs.sparkSession, path, pattern)

    def run(batches):
        encoding = load()
        for batch in batches:
            doc_ids = arrow_ids(batch.column("doc_id"))
            for lo, hi, texts in text_strings(batch):
                ids = [encode_text(encoding, t).astype(np.int32) for t in texts]
                yield pa.RecordBatch.from_pydict({
                    "doc_id": null_ids_back(doc_ids[lo:hi]), "ids": pa.array(ids, pa.list_(pa.int32())),
                    "n_tokens": pa.array([len(x) for x in ids], pa.int64()),
                })

    return id_and_text(docs, id_col, text_col).mapInArrow(run, "doc_id bigint, ids array<int>, n_tokens bigint")


def decode(encoded: DataFrame, path: str, pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """(doc_id, decoded binary) of rows with ids; null ids decode to no bytes."""
    ship(encoded.sparkSession)
    load = _broadcast_loader(encoded.sparkSession, path, pattern)

    def run(batches):
        encoding = load()
        for batch in batches:
            data = [encoding.decode_bytes(x or []) for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "decoded": pa.array(data, pa.binary())})

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id bigint, decoded binary")


def round_trip(
    docs: DataFrame, path: str, pattern: str = public_tokenizers.PATTERN, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False
) -> DataFrame:
    """Encode each row and decode its ids again: counts and digests (and the ids)."""
    ship(docs.sparkSession)
    load = _broadcast_loader(docs.sparkSession, path, pattern)

    def run(batches):
        encoding = load()
        decimals = Decimals(encoding.n_vocab)
        for batch in batches:
            doc_ids = arrow_ids(batch.column("doc_id"))
            for lo, hi, texts in text_strings(batch):
                n, ids_sha, decoded_sha, ids = [], [], [], []
                for text in texts:
                    got = encode_text(encoding, text)
                    n.append(len(got))
                    ids_sha.append(hashlib.sha256(decimals.join(got)).hexdigest())
                    decoded_sha.append(hashlib.sha256(encoding.decode_bytes(got.tolist())).hexdigest())
                    ids.append(got.astype(np.int32) if with_ids else None)
                columns = {
                    "doc_id": null_ids_back(doc_ids[lo:hi]), "n_tokens": pa.array(n, pa.int64()),
                    "ids_sha256": ids_sha, "decoded_sha256": decoded_sha,
                }
                if with_ids:
                    columns["ids"] = pa.array(ids, pa.list_(pa.int32()))
                yield pa.RecordBatch.from_pydict(columns)

    schema = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return id_and_text(docs, id_col, text_col).mapInArrow(run, schema + (", ids array<int>" if with_ids else ""))


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text, encoded by the 50k byte-level ranks and decoded again."""
    return round_trip(read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"))
