"""Substring de-duplication on words: an FM-index per shard, searched backwards.

``segments`` drops the windows whose anchor occurs once in the corpus and
deals the others into shards (buckets) so that equal windows meet. Each shard
builds an FM-index of its run texts: the order of their suffixes, the
Burrows-Wheeler sequence in a bit-packed wavelet matrix, and counts. The
runs are then streamed against it: backward search from a window's end extends
the match while two places of the corpus have it (matching statistics), and
intervals of ``window`` words and more are reported.

Words are compared by a 64-bit hash of their bytes. Null or empty texts have
no words. Rows that repeat, ids equal or null, are documents of their own.
"""

from __future__ import annotations

import hashlib
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from rateflow.llm import segments, vec
from rateflow.llm.common import null_ids_back, read
from rateflow.llm.segments import Block, Bucket, Entries, Windows

WINDOW = 35
GRAM = 18
SCHEMA = "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string, kept string"


class WaveletMatrix:
    """Ranks of symbols in a sequence; each bit plane is packed into 64-bit words with running counts."""

    def __init__(self, symbols: np.ndarray, alphabet: int):
        self.levels = max(1, int(alphabet - 1).bit_length())
        self.bits, self.counts, self.zeros = [], [], []
        now = symbols.astype(np.uint32)
        for level in range(self.levels):
            bit = ((now >> np.uint32(self.levels - 1 - level)) & np.uint32(1)).astype(bool)
            packed = np.zeros((len(now) // 64 + 1) * 8, np.uint8)
            some = np.packbits(bit, bitorder="little")
            packed[: len(some)] = some
            words = packed.view("<u8")
            self.bits.append(words)
            self.counts.append(np.concatenate([[0], np.cumsum(np.bitwise_count(words), dtype=np.int64)]))
            self.zeros.append(len(now) - int(bit.sum()))
            now = np.concatenate([now[~bit], now[bit]])
        self.origin = self._down(np.arange(alphabet), np.zeros(alphabet, np.int64))

    def _down(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        for level in range(self.levels):
            word = at >> 6
            below = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
            ones = self.counts[level][word] + np.bitwise_count(self.bits[level][word] & below)
            high = (symbol >> (self.levels - 1 - level)) & 1
            at = np.where(high == 1, self.zeros[level] + ones, at - ones)
        return at

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before its position."""
        return self._down(symbol, at) - self.origin[symbol]


def suffix_order(text: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes in the order of their first ``depth`` symbols at least, by doubling."""
    rank = np.unique(text, return_inverse=True)[1].astype(np.int64)
    order = np.argsort(rank, kind="stable")
    step = 1
    while step < depth:
        key = rank * (len(text) + 2)
        key[: len(text) - step] += rank[step:] + 1
        order = np.argsort(key, kind="stable")
        new = np.append(False, key[order][1:] != key[order][:-1])
        rank = np.empty(len(text), np.int64)
        rank[order] = np.cumsum(new)
        if rank[order[-1]] == len(text) - 1:
            break
        step *= 2
    return order


class FmIndex:
    """Weighted counts of patterns of up to ``depth`` symbols in texts laid end to end.

    Symbols are 1 and up; 0 ends each text, so no match crosses two texts.
    """

    def __init__(self, text: np.ndarray, weight: np.ndarray, alphabet: int, depth: int):
        order = suffix_order(text, depth)
        self.wavelet = WaveletMatrix(text[order - 1], alphabet)
        self.before = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=alphabet))])
        self.weight = np.concatenate([[0], np.cumsum(weight[order])])
        self.size = len(text)

    def extend(self, symbol: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The interval of symbol + pattern, for intervals of patterns."""
        both = np.concatenate([symbol, symbol])
        at = self.wavelet.rank(both, np.concatenate([lo, hi])) + self.before[both]
        return at[: len(lo)], at[len(lo) :]

    def count(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        return self.weight[hi] - self.weight[lo]


def repeated_windows(index: FmIndex, text: np.ndarray, begin: np.ndarray, size: np.ndarray, window: int) -> tuple[np.ndarray, ...]:
    """Stream texts against the index; (text, first window, number of windows) of each repeated interval.

    For each end, the match is extended to the left while its weighted count
    is two at least. Where the extension by one more word fails, no window
    that holds this place and this end repeats, so the next end tried is the
    largest that avoids it.
    """
    end = size - 1  # the last word of the match, inclusive
    live = np.flatnonzero(size >= window)
    found = []
    while len(live):
        left = end[live] + 1
        lo, hi = np.zeros(len(live), np.int64), np.full(len(live), index.size)
        going = np.arange(len(live))
        while len(going):
            lo2, hi2 = index.extend(text[begin[live[going]] + left[going] - 1], lo[going], hi[going])
            more = index.count(lo2, hi2) >= 2
            going = going[more]
            lo[going], hi[going] = lo2[more], hi2[more]
            left[going] -= 1
            going = going[left[going] > 0]
        length = end[live] + 1 - left
        hit = length >= window
        found.append((live[hit], left[hit], length[hit] - window + 1))
        end[live] = np.minimum(end[live] - 1, left + window - 2)
        live = live[(left > 0) & (end[live] >= window - 1)]
    return tuple(np.concatenate(x) for x in zip(*found)) if found else tuple(np.zeros(0, np.int64) for _ in range(3))


def resolver(window: int, depth: int):
    def resolve(bucket: Bucket) -> list[tuple[int, bytes]]:
        words, code = np.unique(bucket.tokens, return_inverse=True)
        texts = len(bucket.size)
        begin = bucket.begin + np.arange(texts)  # a 0 follows each text
        text = np.zeros(len(code) + texts, np.int64)
        text[vec.spans_to_flat(begin, bucket.size)] = code + 1
        weight = np.repeat(bucket.value, bucket.size + 1)
        index = FmIndex(text, weight, len(words) + 1, depth)
        which, start, count = repeated_windows(index, text, begin, bucket.size, window)
        order = np.argsort(which, kind="stable")
        which, start, count = which[order], start[order], count[order]
        out = []
        for block, uid, _ in bucket.sent:
            lo, hi = np.searchsorted(which, uid, "left"), np.searchsorted(which, uid, "right")
            if (hi > lo).any():
                at = vec.spans_to_flat(lo, hi - lo)
                out.append((block, segments.pack_reply(np.repeat(np.arange(len(uid)), hi - lo), start[at], count[at], np.ones(len(at), np.int64))))
        return out

    return resolve


def removed_mask(b: Block, e: Entries, replies: np.ndarray, window: int) -> np.ndarray:
    text, start, count, _ = replies[:, np.argsort(replies[0], kind="stable")]
    lo, hi = np.searchsorted(text, e.uid, "left"), np.searchsorted(text, e.uid, "right")
    run, reply = np.repeat(np.arange(len(e.uid)), hi - lo), vec.spans_to_flat(lo, hi - lo)
    begin = e.first[run] + start[reply]
    return vec.cover(int(b.bounds[-1]), begin, begin + count[reply] - 1 + window)


def finisher(window: int, with_text: bool):
    def finish(b: Block, e: Entries, replies: np.ndarray) -> pa.RecordBatch:
        gone = removed_mask(b, e, replies, window)
        removed = np.diff(vec.sums_before(gone, b.bounds))
        whole = b.buf.tobytes()
        sha, kept = [], []
        for i, n in enumerate(removed.tolist()):
            words = whole[b.offsets[i] : b.offsets[i + 1]].split()
            rest = b" ".join(compress(words, (~gone[b.bounds[i] : b.bounds[i + 1]]).tolist()) if n else words)
            sha.append(hashlib.sha256(rest).hexdigest())
            kept.append(rest.decode("utf-8") if with_text else None)
        return pa.RecordBatch.from_pydict({
            "doc_id": null_ids_back(b.ids), "n_words": np.diff(b.bounds), "n_removed": removed,
            "kept_sha256": sha, "kept": pa.array(kept, pa.string()),
        })

    return finish


def remove_repeats(
    docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text", with_text: bool = True
) -> DataFrame:
    """One row per document: counts, the digest of the words left, and (``with_text``) those words."""
    gram = max(1, min(GRAM, window // 2 + 1))
    kind = Windows("word", window, gram, across=False)
    depth = 2 * window - gram + 1  # the longest run text
    out = segments.exchange(docs, kind, resolver(window, depth), finisher(window, with_text), SCHEMA, id_col, text_col)
    return out if with_text else out.drop("kept")


def op10_fm_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every word that a window of 35 words found elsewhere covers goes."""
    return remove_repeats(read(spark, sf_dir, "documents"), with_text=False)
