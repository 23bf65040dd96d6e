"""Exact substring de-duplication (bytes and words) against brute force."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from rateflow.llm import op2_suffix_dedup as op2
from rateflow.llm import op10_fm_dedup as op10
from rateflow.llm import vec
from rateflow.llm.common import padded
from samples import edge_texts, frame, prose


def brute_bytes(rows, window):
    order = lambda i: (i is None, i or 0)  # noqa: E731  a null id is larger than any other
    least = {}
    for i, t in rows:
        b = (t or "").encode()
        for s in range(len(b) - window + 1):
            x = b[s : s + window]
            least[x] = min(least.get(x, order(i)), order(i))
    out = []
    for i, t in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for s in range(len(b) - window + 1):
            if least[b[s : s + window]] < order(i):
                gone[s : s + window] = b"\1" * window
        kept = bytes(c for c, g in zip(b, gone) if not g)
        spans = sum(1 for k in range(len(b)) if gone[k] and (k == 0 or not gone[k - 1]))
        out.append((i, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return Counter(out)


def brute_words(rows, window):
    count = Counter()
    split = [(i, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in rows]
    for _, w in split:
        for s in range(len(w) - window + 1):
            count[tuple(w[s : s + window])] += 1
    out = []
    for i, w in split:
        gone = [0] * len(w)
        for s in range(len(w) - window + 1):
            if count[tuple(w[s : s + window])] > 1:
                gone[s : s + window] = [1] * window
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out.append((i, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return Counter(out)


def corpus(seed):
    rng = random.Random(seed)
    passages = [prose(rng, 70) for _ in range(4)]
    rows = [(i, prose(rng, rng.randrange(5, 150)) + " " + rng.choice(passages)[rng.randrange(60) :] + " " + prose(rng, 20)) for i in range(60)]
    rows += [(100 + i, rows[i][1]) for i in range(8)]
    rows += [(200, passages[0] + " " + passages[0])]
    return rows


@pytest.mark.parametrize("rows", [corpus(1), edge_texts(random.Random(2)), [(1, "")], []], ids=["corpus", "edges", "one", "none"])
def test_bytes_match_brute_force(spark, rows):
    got = op2.remove_repeats(frame(spark, rows, clash=True), with_text=False).collect()
    assert Counter(tuple(r) for r in got) == brute_bytes(rows, 50)


@pytest.mark.parametrize("rows", [corpus(3), edge_texts(random.Random(4)), []], ids=["corpus", "edges", "none"])
def test_words_match_brute_force(spark, rows):
    got = op10.remove_repeats(frame(spark, rows, clash=True), with_text=False).collect()
    assert Counter(tuple(r) for r in got) == brute_words(rows, 35)


def test_text_left_is_returned(spark):
    rows = [(1, "alpha beta " * 9), (2, "gammo " + "alpha beta " * 9 + "delta")]
    left = {r.doc_id: bytes(r.kept) for r in op2.remove_repeats(frame(spark, rows)).collect()}
    assert left[1] == rows[0][1].encode() and left[2] == b"gammodelta"
    kept = {r.doc_id: r.kept for r in op10.remove_repeats(frame(spark, rows), window=6).collect()}
    assert kept == {1: "", 2: "gammo delta"}


def test_windows_choose_anchors_by_content():
    rng = np.random.default_rng(5)
    data = rng.integers(0, 3, vec.SEGMENT + 5000).astype(np.uint8)  # longer than a segment, many ties
    n = len(data)
    key = np.ndarray((n,), "<u8", buffer=padded(data), strides=(1,)) * np.uint64(0x9E3779B97F4A7C15)
    offsets = np.array([0, 30, 30, 1000, n])
    first, last, anchor = vec.window_runs(lambda a, b: key[a:b], offsets, 50, 24)
    windows = vec.spans_to_flat(first, last - first + 1)
    want = [s for a, b in zip(offsets[:-1], offsets[1:]) for s in range(a, b - 49)]
    assert sorted(windows.tolist()) == want
    place = defaultdict(set)
    for s, p in zip(windows.tolist(), np.repeat(anchor, last - first + 1).tolist()):
        assert s <= p <= s + 26
        place[data[s : s + 50].tobytes()].add(p - s)
    assert all(len(x) == 1 for x in place.values())


def test_radix_groups_are_the_repeated_windows():
    rng = np.random.default_rng(6)
    data = rng.integers(0, 2, 4000).astype(np.uint8)
    at = np.arange(4000 - 12)
    index, head = op2.equal_groups(padded(data), at, 12)
    groups = {frozenset(x.tolist()) for x in np.split(index, head[1:])}
    want = defaultdict(set)
    for s in at.tolist():
        want[data[s : s + 12].tobytes()].add(s)
    assert groups == {frozenset(x) for x in want.values() if len(x) > 1}


def test_wavelet_ranks_and_counts():
    rng = np.random.default_rng(7)
    text = rng.integers(0, 23, 700)
    matrix = op10.WaveletMatrix(text, 23)
    symbol, at = rng.integers(0, 23, 300), rng.integers(0, 701, 300)
    assert matrix.rank(symbol, at).tolist() == [int((text[:p] == s).sum()) for s, p in zip(symbol, at)]
    text = np.append(rng.integers(1, 4, 400), 0)
    index = op10.FmIndex(text, np.ones(401, np.int64), 4, 32)
    for size in (1, 5, 20):
        for s in range(0, 380, 7):
            lo, hi = np.array([0]), np.array([index.size])
            for symbol in text[s : s + size][::-1]:
                lo, hi = index.extend(np.array([symbol]), lo, hi)
            plain = sum((text[k : k + size] == text[s : s + size]).all() for k in range(402 - size))
            assert index.count(lo, hi)[0] == plain


def test_word_hash_follows_bytes_only():
    buf = padded(np.frombuffer("ab cd\x0bab x é".encode(), np.uint8))
    starts, ends, bounds = vec.word_bounds(buf, np.array([0, len(buf) - 64]))
    found = [bytes(buf[a:e]).decode() for a, e in zip(starts, ends)]
    assert found == ["ab", "cd", "ab x", "é"] and bounds.tolist() == [0, 4]
    hashes = vec.word_hashes(buf, np.array([0, 6]), np.array([2, 8]))
    assert hashes[0] == hashes[1]
