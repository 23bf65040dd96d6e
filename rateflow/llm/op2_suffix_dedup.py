"""Suffix-array de-duplication on bytes: a depth-limited radix sort of suffixes.

Suffixes are ordered only through ``window`` bytes, by most-significant-digit
passes of eight bytes; groups still equal after the last pass are exactly the
repeated windows. ``segments`` first drops the suffixes whose anchor occurs in
one document only, and sends the others to buckets whose suffixes can be
equal; each bucket is sorted on its own.

Null or empty texts have nothing to remove. A null id counts as larger than
every other id. Rows with equal ids never cause a removal in each other.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from rateflow.llm import segments, vec
from rateflow.llm.common import null_ids_back, padded, read
from rateflow.llm.segments import Block, Bucket, Entries, Windows

WINDOW = 50
GRAM = 24
SCHEMA = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept binary"


def digits(eight: np.ndarray, at: np.ndarray, wide: int) -> np.ndarray:
    """The next ``wide`` bytes (eight at most) of each suffix as a big-endian number."""
    return eight[at].byteswap() >> np.uint64(64 - 8 * wide)


def equal_groups(buf: np.ndarray, at: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Indexes into ``at`` of the suffixes that share their first ``depth`` bytes with another, in groups.

    Returns the indexes in group order and where each group begins. Each pass
    orders by the next digit inside the groups of the pass before; suffixes
    alone in their group leave at once.
    """
    eight = np.ndarray((len(buf) - 8,), "<u8", buffer=buf, strides=(1,))
    index = np.arange(len(at))
    group = np.zeros(len(at), np.int64)
    for done in range(0, depth, 8):
        digit = digits(eight, at[index] + done, min(8, depth - done))
        order = np.lexsort((digit, group)) if done else np.argsort(digit, kind="stable")
        index, digit, group = index[order], digit[order], group[order]
        new = np.ones(len(index) + 1, bool)
        if len(index):
            new[1:-1] = (digit[1:] != digit[:-1]) | (group[1:] != group[:-1])
        with_another = ~(new[:-1] & new[1:])
        group = (np.cumsum(new[:-1]) - 1)[with_another]
        index = index[with_another]
    head = np.flatnonzero(np.append(True, group[1:] != group[:-1])) if len(group) else np.zeros(0, np.int64)
    return index, head


def resolver(window: int):
    def resolve(bucket: Bucket) -> list[tuple[int, bytes]]:
        """For each block: the windows that also start in a document before its own first one."""
        windows = bucket.size - window + 1
        text_of = np.repeat(np.arange(len(windows)), windows)
        at = vec.spans_to_flat(bucket.begin, windows)
        least = bucket.value[text_of]
        index, head = equal_groups(padded(bucket.tokens), at, window)
        if len(head):
            size = np.diff(np.append(head, len(index)))
            least[index] = np.repeat(np.minimum.reduceat(least[index], head), size)
        base = np.cumsum(windows) - windows
        out = []
        for block, uid, own in bucket.sent:
            n = windows[uid]
            flat = vec.spans_to_flat(base[uid], n)
            text, value = np.repeat(np.arange(len(uid)), n), least[flat]
            hit = value < own[text]
            if not hit.any():
                continue
            place = np.arange(len(flat)) - np.repeat(np.cumsum(n) - n, n)
            text, value, place = text[hit], value[hit], place[hit]
            new = np.append(True, (text[1:] != text[:-1]) | (value[1:] != value[:-1]) | (place[1:] != place[:-1] + 1))
            head = np.flatnonzero(new)
            out.append((block, segments.pack_reply(text[head], place[head], np.diff(np.append(head, len(text))), value[head])))
        return out

    return resolve


def removed_mask(b: Block, e: Entries, replies: np.ndarray, window: int) -> np.ndarray:
    """Positions covered by a window that also starts in a document with a smaller id."""
    later = e.value[e.uid] < b.ids[e.doc]  # an earlier document of this block has the same run
    begin, end = [e.first[later]], [e.last[later] + window]
    if replies.shape[1]:
        text, start, count, value = replies
        order = np.argsort(text, kind="stable")
        text, start, count, value = text[order], start[order], count[order], value[order]
        lo, hi = np.searchsorted(text, e.uid, "left"), np.searchsorted(text, e.uid, "right")
        run = np.repeat(np.arange(len(e.uid)), hi - lo)
        reply = vec.spans_to_flat(lo, hi - lo)
        good = value[reply] < b.ids[e.doc[run]]
        run, reply = run[good], reply[good]
        begin.append(e.first[run] + start[reply])
        end.append(begin[-1] + count[reply] - 1 + window)
    return vec.cover(int(b.bounds[-1]), np.concatenate(begin), np.concatenate(end))


def finisher(window: int, with_text: bool):
    def finish(b: Block, e: Entries, replies: np.ndarray) -> pa.RecordBatch:
        gone = removed_mask(b, e, replies, window)
        removed = np.diff(vec.sums_before(gone, b.offsets))
        rise = gone.copy()
        rise[1:] &= ~gone[:-1]
        begins = b.offsets[:-1][np.diff(b.offsets) > 0]
        rise[begins] = gone[begins]
        spans = np.diff(vec.sums_before(rise, b.offsets))
        del rise
        sha, kept = [], []
        for i, n in enumerate(removed.tolist()):
            lo, hi = b.offsets[i], b.offsets[i + 1]
            rest = b.buf[lo:hi][~gone[lo:hi]] if n else b.buf[lo:hi]
            sha.append(hashlib.sha256(rest).hexdigest())
            kept.append(rest.tobytes() if with_text else None)
        return pa.RecordBatch.from_pydict({
            "doc_id": null_ids_back(b.ids), "n_bytes": np.diff(b.offsets), "n_removed": removed,
            "n_spans": spans, "kept_sha256": sha, "kept": pa.array(kept, pa.binary()),
        })

    return finish


def remove_repeats(
    docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text", with_text: bool = True
) -> DataFrame:
    """One row per document: counts, the digest of what is left, and (``with_text``) the bytes left."""
    kind = Windows("byte", window, min(GRAM, window - 8) if window > 32 else 8, across=True)
    out = segments.exchange(docs, kind, resolver(window), finisher(window, with_text), SCHEMA, id_col, text_col)
    return out if with_text else out.drop("kept")


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every byte that a 50-byte string of a document with a smaller id covers goes."""
    return remove_repeats(read(spark, sf_dir, "documents"), with_text=False)
