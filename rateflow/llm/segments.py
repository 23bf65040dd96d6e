"""Find repeated token windows over a whole corpus without moving the corpus.

Shared by the two exact-substring operators. A window of ``window`` tokens
chooses an anchor by its own content (``vec.window_runs``), so equal windows
have equal anchors, and neighbouring windows mostly share one: about 2 in
``window - gram + 2`` positions are anchors.

1. ``pack``: documents are stored once as compressed blocks (a table in the
   shared checkpoint folder).
2. ``anchor_keys``: each block sends every distinct 48-bit anchor key once,
   delta-packed and split into key ranges (buckets); ``common_keys`` keeps the
   keys of two blocks, or those a block has marked as repeated inside it.
   A passage that a third of all documents holds is still one key a block.
3. ``entries``: for the kept keys only, a block sends each distinct text of a
   run of windows once, to the bucket of its key.
4. The operator's own ``resolve`` compares the windows of one bucket exactly
   and answers each block; its ``finish`` applies the answers to the block.

Sizes: ``BLOCK_BYTES`` of text a block, and one bucket for each
``BUCKET_BYTES`` of the corpus, so that neither grows with the input. On very
large inputs raise both together (a block sends one row to each bucket).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rateflow.llm import vec
from rateflow.llm.common import (
    arrow_ids, id_and_text, materialize, new_run_folder, padded, row_groups, ship, squeeze, squeeze_ints, text_buffer, unsqueeze,
    unsqueeze_ints,
)

BLOCK_BYTES = 8 << 20
BUCKET_BYTES = 16 << 20
LEAST_BUCKETS = 24
KEY_BITS = 48

_A, _B, _C = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)


@dataclass(frozen=True)
class Windows:
    """What counts as a token and as a window; ``across``: only repeats in another document count."""

    unit: str  # "byte" or "word"
    window: int
    gram: int
    across: bool


@dataclass
class Block:
    """One block's documents as bytes and as tokens."""

    ids: np.ndarray
    buf: np.ndarray  # padded bytes
    offsets: np.ndarray  # bytes
    tokens: np.ndarray  # a byte or a word hash each
    bounds: np.ndarray  # tokens before each document
    word_at: tuple[np.ndarray, np.ndarray] | None  # first and end byte of each word


def load(kind: Windows, ids: bytes, sizes: bytes, text: bytes) -> Block:
    buf = padded(np.frombuffer(unsqueeze(text), np.uint8))
    offsets = np.concatenate([[0], np.cumsum(unsqueeze_ints(sizes).astype(np.int64))]).astype(np.int64)
    doc_ids = np.frombuffer(ids, np.int64)
    if kind.unit == "byte":
        return Block(doc_ids, buf, offsets, buf, offsets, None)
    starts, ends, bounds = vec.word_bounds(buf, offsets)
    return Block(doc_ids, buf, offsets, vec.word_hashes(buf, starts, ends), bounds.astype(np.int64), (starts, ends))


def _eight(buf: np.ndarray) -> np.ndarray:
    """The eight bytes that start at each position, as one number (a view)."""
    return np.ndarray((len(buf) - 8,), "<u8", buffer=buf, strides=(1,))


def runs(kind: Windows, b: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First and last window of each run, and its anchor's 48-bit key."""
    if kind.unit == "byte":
        eight = _eight(b.buf)
        first, last, at = vec.window_runs(lambda x, y: eight[x:y] * _A, b.bounds, kind.window, kind.gram)
        key = np.zeros(len(at), np.uint64)
        for i in range(0, kind.gram, 8):
            key = key * _C + eight[at + min(i, kind.gram - 8)]
    else:
        t = np.append(b.tokens, np.uint64(0))
        first, last, at = vec.window_runs(lambda x, y: t[x:y] * _A + t[x + 1 : y + 1] * _B, b.bounds, kind.window, kind.gram)
        key = np.zeros(len(at), np.uint64)
        for i in range(kind.gram):
            key = key * _C + b.tokens[at + i]
    return first, last, vec.mix(key) >> np.uint64(64 - KEY_BITS)


def bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Buckets are ranges of the key, in order."""
    return ((keys >> np.uint64(KEY_BITS - 24)) * np.uint64(buckets)) >> np.uint64(24)


# ---- 1. blocks -------------------------------------------------------------

BLOCK_SCHEMA = "block bigint, n_bytes bigint, ids binary, sizes binary, text binary"


def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    context = TaskContext.get()
    block = (context.partitionId() if context else 0) << 32
    for batch in batches:
        ids = arrow_ids(batch.column(0))
        raw, at = text_buffer(batch.column(1))
        for lo, hi in row_groups(np.diff(at), BLOCK_BYTES):
            part = raw[at[lo] : at[hi]]
            yield pa.RecordBatch.from_pydict({
                "block": [block], "n_bytes": [len(part)], "ids": [ids[lo:hi].tobytes()],
                "sizes": [squeeze_ints(np.diff(at[lo : hi + 1]))], "text": [squeeze(part.tobytes())],
            })
            block += 1


# ---- 2. keys ---------------------------------------------------------------

KEY_SCHEMA = "bucket int, block bigint, keys binary, repeated binary"


def key_rows(kind: Windows, buckets: int, block: int, b: Block) -> pd.DataFrame:
    first, _, key = runs(kind, b)
    order = np.argsort(key, kind="stable")
    key, doc = key[order], np.searchsorted(b.bounds, first[order], "right") - 1
    head = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
    distinct = key[head]
    size = np.diff(np.append(head, len(key)))
    if kind.across and len(head):
        owner = b.ids[doc]
        repeated = np.minimum.reduceat(owner, head) != np.maximum.reduceat(owner, head)
    else:
        repeated = size > 1
    bucket = bucket_of(distinct, buckets).astype(np.int64)
    cut = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])) if len(bucket) else np.zeros(0, np.int64)
    ends = np.append(cut[1:], len(bucket))
    return pd.DataFrame({
        "bucket": bucket[cut].astype(np.int32), "block": block,
        "keys": [squeeze_ints(np.diff(distinct[a:e], prepend=np.uint64(0))) for a, e in zip(cut, ends)],
        "repeated": [squeeze(np.packbits(repeated[a:e]).tobytes()) for a, e in zip(cut, ends)],
    })


def _unpack_keys(data: bytes) -> np.ndarray:
    return np.cumsum(unsqueeze_ints(data), dtype=np.uint64)


def common_keys(rows: pd.DataFrame) -> pd.DataFrame:
    """Of one bucket: for each block, which of its keys another block or a second place has too."""
    lists = [_unpack_keys(x) for x in rows["keys"]]
    flags = [np.unpackbits(np.frombuffer(unsqueeze(x), np.uint8), count=len(k)) for x, k in zip(rows["repeated"], lists)]
    all_keys = np.concatenate(lists)
    order = np.argsort(all_keys, kind="stable")
    head = np.flatnonzero(np.append(True, all_keys[order][1:] != all_keys[order][:-1]))
    size = np.diff(np.append(head, len(order)))
    hit = (size > 1) | (np.maximum.reduceat(np.concatenate(flags)[order], head) > 0)
    keep = np.empty(len(order), bool)
    keep[order] = np.repeat(hit, size)
    blocks, out, at = [], [], 0
    for block, keys in zip(rows["block"], lists):
        mine = keys[keep[at : at + len(keys)]]
        at += len(keys)
        if len(mine):
            blocks.append(block)
            out.append(squeeze_ints(np.diff(mine, prepend=np.uint64(0))))
    return pd.DataFrame({"block": np.array(blocks, np.int64), "keys": out})


# ---- 3. entries ------------------------------------------------------------

ENTRY_SCHEMA = "bucket int, block bigint, sizes binary, values binary, tokens binary"


@dataclass
class Entries:
    """The kept runs of a block and their distinct texts.

    ``text[u]`` is a distinct run text, ``value[u]`` the smallest document id
    (repeats across documents) or the number of runs with it. ``uid`` gives
    each run's text; texts are numbered in bucket order, ``bucket`` has theirs.
    """

    first: np.ndarray
    last: np.ndarray
    doc: np.ndarray
    uid: np.ndarray
    text: list[bytes]
    value: np.ndarray
    bucket: np.ndarray


def entries_of(kind: Windows, buckets: int, b: Block, kept_keys: list[bytes]) -> Entries:
    first, last, key = runs(kind, b)
    kept = np.sort(np.concatenate([np.zeros(0, np.uint64), *map(_unpack_keys, kept_keys)]))
    if len(kept):
        at = np.minimum(np.searchsorted(kept, key), len(kept) - 1)
        first, last, key = (x[kept[at] == key] for x in (first, last, key))
    else:
        first, last, key = first[:0], last[:0], key[:0]
    order = np.argsort(bucket_of(key, buckets), kind="stable")
    first, last, key = first[order], last[order], key[order]
    width = 1 if kind.unit == "byte" else 8
    whole = (b.tokens if width == 8 else b.buf).tobytes()
    number: dict[bytes, int] = {}
    uid = np.fromiter(
        (number.setdefault(whole[x:y], len(number)) for x, y in zip((first * width).tolist(), ((last + kind.window) * width).tolist())),
        np.int64, len(first),
    )
    doc = np.searchsorted(b.bounds, first, "right") - 1
    bucket = np.zeros(len(number), np.int64)
    bucket[uid] = bucket_of(key, buckets)
    if kind.across:
        value = np.full(len(number), np.iinfo(np.int64).max)
        np.minimum.at(value, uid, b.ids[doc])
    else:
        value = np.bincount(uid, minlength=len(number)).astype(np.int64)
    return Entries(first, last, doc, uid, list(number), value, bucket)


def entry_rows(kind: Windows, block: int, e: Entries) -> pd.DataFrame:
    cut = np.flatnonzero(np.append(True, e.bucket[1:] != e.bucket[:-1])) if len(e.bucket) else np.zeros(0, np.int64)
    ends = np.append(cut[1:], len(e.bucket))
    width = 1 if kind.unit == "byte" else 8
    return pd.DataFrame({
        "bucket": e.bucket[cut].astype(np.int32), "block": block,
        "sizes": [squeeze_ints(np.array([len(x) // width for x in e.text[a:z]])) for a, z in zip(cut, ends)],
        "values": [squeeze(e.value[a:z].tobytes()) for a, z in zip(cut, ends)],
        "tokens": [squeeze(b"".join(e.text[a:z])) for a, z in zip(cut, ends)],
    })


@dataclass
class Bucket:
    """The distinct run texts of one bucket over all blocks, and who sent them.

    Texts are laid end to end in ``tokens``; ``value`` holds the smallest id
    or the sum of the counts. ``sent`` has a row for each block: its number,
    the texts it sent (in its order) and its own values.
    """

    tokens: np.ndarray
    begin: np.ndarray
    size: np.ndarray
    value: np.ndarray
    sent: list[tuple[int, np.ndarray, np.ndarray]]


def gather(kind: Windows, rows: pd.DataFrame) -> Bucket:
    width = 1 if kind.unit == "byte" else 8
    number: dict[bytes, int] = {}
    sent = []
    for block, sizes, values, tokens in zip(rows["block"], rows["sizes"], rows["values"], rows["tokens"]):
        size = unsqueeze_ints(sizes).astype(np.int64) * width
        ends = np.cumsum(size)
        whole = unsqueeze(tokens)
        uid = np.fromiter((number.setdefault(whole[a:e], len(number)) for a, e in zip((ends - size).tolist(), ends.tolist())), np.int64, len(size))
        sent.append((int(block), uid, np.frombuffer(unsqueeze(values), np.int64)))
    if kind.across:
        value = np.full(len(number), np.iinfo(np.int64).max)
        for _, uid, own in sent:
            np.minimum.at(value, uid, own)
    else:
        value = np.zeros(len(number), np.int64)
        for _, uid, own in sent:
            np.add.at(value, uid, own)
    size = np.fromiter(map(len, number), np.int64, len(number)) // width
    flat = np.frombuffer(b"".join(number), np.uint8)
    return Bucket(flat if width == 1 else flat.view("<u8"), np.cumsum(size) - size, size, value, sent)


REPLY_SCHEMA = "block bigint, bucket int, runs binary"


def pack_reply(text: np.ndarray, start: np.ndarray, count: np.ndarray, value: np.ndarray) -> bytes:
    """Runs of windows of a block's texts (numbered within the bucket) with one answer each."""
    return squeeze(np.array([text, start, count, value], dtype=np.int64).tobytes())


def unpack_reply(data: bytes) -> np.ndarray:
    return np.frombuffer(unsqueeze(data), np.int64).reshape(4, -1)


def replies_of(e: Entries, buckets: list[int], packed: list[bytes]) -> np.ndarray:
    """All answers for a block, with texts numbered as in ``e``; columns text, start, count, value."""
    base = np.searchsorted(e.bucket, np.array(buckets, np.int64)) if buckets else []
    out = [np.zeros((4, 0), np.int64)]
    for at, data in zip(base, packed):
        reply = unpack_reply(data).copy()
        reply[0] += at
        out.append(reply)
    return np.concatenate(out, axis=1)


# ---- the whole exchange ----------------------------------------------------


def exchange(
    docs: DataFrame,
    kind: Windows,
    resolve: Callable[[Bucket], list[tuple[int, bytes]]],
    finish: Callable[[Block, Entries, np.ndarray], pa.RecordBatch],
    schema: str,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Run the four steps; one output batch of ``schema`` for each block."""
    spark = docs.sparkSession
    ship(spark)
    folder = new_run_folder(spark)
    texts = id_and_text(docs, id_col, text_col)
    blocks = materialize(texts.mapInArrow(pack, BLOCK_SCHEMA), folder, "blocks")
    total = blocks.agg(F.coalesce(F.sum("n_bytes"), F.lit(0)).alias("n")).first()["n"]
    buckets = max(LEAST_BUCKETS, -(-total // BUCKET_BYTES))

    def batches_to_blocks(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                row = {name: batch.column(name)[i].as_py() for name in batch.schema.names}
                yield row, load(kind, row["ids"], row["sizes"], row["text"])

    def as_batches(frame: pd.DataFrame) -> Iterator[pa.RecordBatch]:
        if len(frame):
            yield pa.RecordBatch.from_pandas(frame, preserve_index=False)

    def send_keys(batches):
        for row, block in batches_to_blocks(batches):
            yield from as_batches(key_rows(kind, buckets, row["block"], block))

    def send_entries(batches):
        for row, block in batches_to_blocks(batches):
            yield from as_batches(entry_rows(kind, row["block"], entries_of(kind, buckets, block, row["keys"])))

    def answer(rows: pd.DataFrame) -> pd.DataFrame:
        got = resolve(gather(kind, rows))
        return pd.DataFrame({"block": np.array([b for b, _ in got], np.int64), "bucket": np.int32(rows["bucket"].iloc[0]), "runs": [x for _, x in got]})

    def apply(batches):
        for row, block in batches_to_blocks(batches):
            e = entries_of(kind, buckets, block, row["keys"] or [])
            answers = row["answers"] or []
            yield finish(block, e, replies_of(e, [x["bucket"] for x in answers], [x["runs"] for x in answers]))

    keys = blocks.mapInArrow(send_keys, KEY_SCHEMA).groupBy("bucket").applyInPandas(common_keys, "block bigint, keys binary")
    kept = materialize(keys, folder, "keys").groupBy("block").agg(F.collect_list("keys").alias("keys"))
    sent = blocks.join(kept, "block").mapInArrow(send_entries, ENTRY_SCHEMA)
    replies = materialize(sent.groupBy("bucket").applyInPandas(answer, REPLY_SCHEMA), folder, "replies")
    answers = replies.groupBy("block").agg(F.collect_list(F.struct("bucket", "runs")).alias("answers"))
    return blocks.join(kept, "block", "left").join(answers, "block", "left").mapInArrow(apply, schema)
