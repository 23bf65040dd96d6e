"""Array helpers on UTF-8 buffers: word bounds, word hashes, content-chosen anchors."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

#: Positions handled at once; keeps the working arrays in a core's cache.
SEGMENT = 1 << 17

_C1 = np.uint64(0x9E3779B97F4A7C15)
_C2 = np.uint64(0xC2B2AE3D27D4EB4F)
_C3 = np.uint64(0x165667B19E3779F9)
_C4 = np.uint64(0xD6E8FEB86659FD93)
_S32, _S29 = np.uint64(32), np.uint64(29)


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> _S32)
    x *= _C4
    x ^= x >> _S29
    x *= _C1
    x ^= x >> _S32
    return x


def _random_words(n: int, seed: int) -> np.ndarray:
    return mix(np.arange(1, n + 1, dtype=np.uint64) * _C1 + np.uint64(seed))


_BYTE = _random_words(256, 7)
_BASE = 0xA0761D6478BD642F
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_POWERS: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _POWERS or len(_POWERS[0]) < n:
        size = max(n, SEGMENT * 2) + 1
        made = []
        for base in (_BASE, _BASE_INVERSE):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            made.append(np.cumprod(p, dtype=np.uint64))
        _POWERS[:] = made
    return _POWERS[0], _POWERS[1]


def word_bounds(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of documents laid end to end.

    Returns the first byte and the end byte of each word, and for each
    document (plus the end) the number of words before it. A document bound
    ends a word.
    """
    n = int(offsets[-1])
    raw = buf[:n]
    word = ~((raw == 32) | ((raw - np.uint8(9)) < np.uint8(5)))
    before = np.empty(n + 1, bool)
    before[:1] = False
    before[1:] = word
    first = word & ~before[:n]
    last = word.copy()
    last[: max(n - 1, 0)] &= ~word[1:]
    inner = offsets[1:-1]
    inner = inner[(inner > 0) & (inner < n)]
    first[inner] = word[inner]
    last[inner - 1] = word[inner - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of each word."""
    out = np.empty(len(starts), np.uint64)
    i, n = 0, len(starts)
    while i < n:
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + SEGMENT, "right")))
        lo, hi = int(starts[i]), int(ends[j - 1])
        up, down = _powers(hi - lo + 1)
        sums = np.empty(hi - lo + 1, np.uint64)
        sums[0] = 0
        np.cumsum(_BYTE[buf[lo:hi]] * up[: hi - lo], out=sums[1:])
        a, b = starts[i:j] - lo, ends[i:j] - lo
        out[i:j] = mix((sums[b] - sums[a]) * down[a] + (b - a).astype(np.uint64) * _C2)
        i = j
    return out


def join_hashes(tokens: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of ``size`` consecutive tokens."""
    n = len(tokens) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    acc = tokens[:n].copy()
    for i in range(1, size):
        acc *= _C3
        acc += tokens[i : i + n]
    return mix(acc)


def window_runs(
    order: Callable[[int, int], np.ndarray], offsets: np.ndarray, window: int, gram: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of consecutive windows that choose the same anchor.

    ``order(a, b)`` gives a 64-bit sort key for each token position from a to
    b. A window of ``window`` tokens chooses the position of the least key
    (the leftmost of equal ones) among the starts of its grams of ``gram``
    tokens, so equal windows choose the same place wherever they stand.
    Windows never cross the document bounds ``offsets``. Returns the first
    and the last window start and the anchor of each run. Works through
    segments, so memory does not follow the length of a document.
    """
    choices = window - gram + 1
    total = int(offsets[-1])
    starts = total - window + 1
    low = np.uint64((1 << 20) - 1)
    firsts, lasts, anchors = [], [], []
    bounds = offsets[1:-1]
    for a in range(0, max(starts, 0), SEGMENT):
        b = min(starts, a + SEGMENT)
        m = b - a
        key = (order(a, b + choices - 1) & ~low) | np.arange(m + choices - 1, dtype=np.uint64)
        size = 1
        while size * 2 <= choices:
            key = np.minimum(key[:-size], key[size:])
            size *= 2
        if size < choices:
            rest = choices - size
            key = np.minimum(key[:-rest], key[rest:])
        at = (key & low).astype(np.int64)
        near = bounds[np.searchsorted(bounds, a, "right") : np.searchsorted(bounds, b + window, "left")]
        ok = np.ones(m, bool)
        if len(near):
            mark = np.zeros(m + window + 1, np.int32)
            np.add.at(mark, near - a, 1)
            seen = np.cumsum(mark)
            ok = seen[window - 1 : window - 1 + m] == seen[:m]
        same = np.zeros(m + 1, bool)  # a window that goes on with the run of the one before
        same[1:m] = ok[1:] & ok[:-1] & (at[1:] == at[:-1])
        begin = np.flatnonzero(ok & ~same[:m])
        firsts.append(a + begin)
        lasts.append(a + np.flatnonzero(ok & ~same[1:]))
        anchors.append(a + at[begin])
    if not firsts:
        none = np.zeros(0, np.int64)
        return none, none, none
    return np.concatenate(firsts), np.concatenate(lasts), np.concatenate(anchors)


def spans_to_flat(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The positions start, start + 1, ... of each span, end to end."""
    total = int(counts.sum())
    if not total:
        return np.zeros(0, np.int64)
    out = np.ones(total, np.int64)
    keep = counts > 0
    starts, counts = starts[keep], counts[keep]
    at = np.cumsum(counts) - counts
    out[at] = starts
    out[at[1:]] -= starts[:-1] + counts[:-1] - 1
    return np.cumsum(out)


def cover(size: int, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Mask of the positions inside any of the spans [begin, end)."""
    delta = np.zeros(size + 1, np.int32)
    np.add.at(delta, begin, 1)
    np.subtract.at(delta, end, 1)
    return np.cumsum(delta[:size], out=delta[:size]) > 0


def sums_before(mask: np.ndarray, at: np.ndarray) -> np.ndarray:
    """How many of the mask's positions lie before each of the places ``at``."""
    sums = np.zeros(len(mask) + 1, np.int32)
    np.cumsum(mask, out=sums[1:])
    return sums[at].astype(np.int64)
