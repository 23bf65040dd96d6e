"""Fill-in-middle transformation with a sparse exception index.

A text is cut into units (lines, or code points), two cuts among them are drawn
from a hash of the document's id, and prefix, middle and suffix are written in
one of two orders behind sentinels: ``psm`` (prefix, suffix, middle) or ``spm``
(suffix, prefix, middle). A text stays ``plain`` if it is empty, holds a
sentinel, or its draw says so.

Texts are handled as UTF-8 bytes. ``ExceptionIndex`` records only the multibyte
characters: where each begins and how many bytes it has beyond one. A byte cut
becomes a code-point cut (and the reverse) by one ``searchsorted`` among them
and a subtraction; on ASCII stretches that is plain arithmetic, and an ASCII
text has an empty index. A run of whole documents shares one index.

Null and empty texts are plain, of no units. Rows that repeat are
transformed each; a null id draws as an empty one. A text longer than a chunk
stands alone in its chunk: working memory is a few copies of it and time is linear.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from rateflow.llm.common import id_and_text, read, row_groups, ship, text_buffer

SEED = 7
#: Of 100 draws: how many texts are transformed, and how many of those in the order spm.
TRANSFORMED, SPM = 100, 50
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Bytes of whole documents handled at once.
CHUNK = 4 << 20

PLAIN, PSM, SPM_FORM = "plain", "psm", "spm"


class ExceptionIndex:
    """Places and excess bytes of the multibyte characters of UTF-8 bytes."""

    def __init__(self, raw: np.ndarray):
        self.lead = np.flatnonzero(raw >= 0xC0)
        first = raw[self.lead]
        excess = 1 + (first >= 0xE0).astype(np.int64) + (first >= 0xF0)
        self.before = np.concatenate([[0], np.cumsum(excess)])  # excess bytes before each exception
        self.lead_chars = self.lead - self.before[:-1]

    def chars(self, cuts: np.ndarray) -> np.ndarray:
        """Code points before each byte cut (cuts lie between characters)."""
        return cuts - self.before[np.searchsorted(self.lead, cuts, "left")]

    def bytes(self, cuts: np.ndarray) -> np.ndarray:
        """Bytes before each code-point cut."""
        return cuts + self.before[np.searchsorted(self.lead_chars, cuts, "left")]


def check_sentinels(*marks: str) -> None:
    """Refuse sentinels that text around them could complete: then the first match of one is its own place."""
    for a in marks:
        for b in marks:
            inside = a != b and a in b
            if not a or inside or any(a[-k:] == b[:k] for k in range(1, min(len(a), len(b)))):
                raise ValueError(f"sentinels {a!r} and {b!r} overlap")
    if len(set(marks)) != len(marks):
        raise ValueError("sentinels repeat")


def line_cuts(raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, callable]:
    """Lines of each document, and the byte place after the first k lines of each."""
    ends = np.flatnonzero(raw == 10) + 1
    lo, hi = np.searchsorted(ends, at[:-1], "right"), np.searchsorted(ends, at[1:], "right")
    closed = hi - lo
    last = np.concatenate([[0], ends])[hi] * (closed > 0)  # end of the last closed line
    n = closed + ((at[1:] > at[:-1]) & ((closed == 0) | (last != at[1:])))
    padded = np.concatenate([ends, [0]])

    def place(k: np.ndarray) -> np.ndarray:
        inner = padded[np.clip(lo + k - 1, 0, len(ends))]
        return np.where(k == 0, at[:-1], np.where(k > closed, at[1:], inner))

    return n, place


def char_cuts(index: ExceptionIndex, at: np.ndarray) -> tuple[np.ndarray, callable]:
    """Code points of each document, and the byte place after the first k of each."""
    begin = index.chars(at[:-1])
    return index.chars(at[1:]) - begin, lambda k: index.bytes(begin + k)


def draws(ids: list[int | None], seed: int) -> np.ndarray:
    """Four 32-bit numbers per document, from the hash of seed and id."""
    out = b"".join(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).digest()[:16] for i in ids)
    return np.frombuffer(out, dtype=">u4").reshape(-1, 4).astype(np.int64)


def rebuild(output: bytes, form: str, marks: tuple[bytes, bytes, bytes]) -> bytes:
    """The text that was transformed into ``output``."""
    if form == PLAIN:
        return output
    p, s, m = marks
    first, second = (p, s) if form == PSM else (s, p)
    head, middle = output[len(first) :].split(m, 1)
    a, b = head.split(second, 1)
    return a + middle + b if form == PSM else b + middle + a


def transform(
    docs: DataFrame,
    unit: str = "lines",
    seed: int = SEED,
    transformed: int = TRANSFORMED,
    spm: int = SPM,
    sentinels: tuple[str, str, str] = (PREFIX, SUFFIX, MIDDLE),
    id_col: str = "doc_id",
    text_col: str = "text",
    with_output: bool = False,
) -> DataFrame:
    """One row per document: units, form, code points of prefix and middle, digests (and the output itself)."""
    if unit not in ("lines", "chars"):
        raise ValueError(f"unknown unit {unit!r}")
    check_sentinels(*sentinels)
    ship(docs.sparkSession)
    marks = tuple(x.encode() for x in sentinels)

    def chunk(ids: list, raw: np.ndarray, at: np.ndarray) -> pa.RecordBatch:
        index = ExceptionIndex(raw)
        n, place = line_cuts(raw, at) if unit == "lines" else char_cuts(index, at)
        h = draws(ids, seed)
        one, two = h[:, 0] % (n + 1), h[:, 1] % (n + 1)
        cuts = [at[:-1], place(np.minimum(one, two)), place(np.maximum(one, two)), at[1:]]
        begin, a, b, _ = (index.chars(c) for c in cuts)
        form, outputs, digests, restored = [], [], [], []
        data = raw.tobytes()
        for k, (s, x, y, e) in enumerate(np.stack(cuts, 1).tolist()):
            text = data[s:e]
            if not text or any(mark in text for mark in marks) or h[k, 2] % 100 >= transformed:
                form.append(PLAIN)
                out = text
            else:
                prefix, middle, suffix = data[s:x], data[x:y], data[y:e]
                if h[k, 3] % 100 < spm:
                    form.append(SPM_FORM)
                    out = b"".join((marks[1], suffix, marks[0], prefix, marks[2], middle))
                else:
                    form.append(PSM)
                    out = b"".join((marks[0], prefix, marks[1], suffix, marks[2], middle))
            digests.append(hashlib.sha256(out).hexdigest())
            restored.append(hashlib.sha256(rebuild(out, form[-1], marks)).hexdigest())
            if with_output:
                outputs.append(out.decode("utf-8"))
        plain = np.array([f == PLAIN for f in form], dtype=bool)
        columns = {
            "doc_id": pa.array(ids, pa.int64()), "n": pa.array(n, pa.int64()), "form": pa.array(form, pa.string()),
            "prefix_chars": pa.array(a - begin, pa.int64(), mask=plain), "middle_chars": pa.array(b - a, pa.int64(), mask=plain),
            "output_sha256": pa.array(digests, pa.string()), "restored_sha256": pa.array(restored, pa.string()),
        }
        if with_output:
            columns["output"] = pa.array(outputs, pa.string())
        return pa.RecordBatch.from_pydict(columns)

    def run(batches):
        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            raw, at = text_buffer(batch.column("text"))
            for lo, hi in row_groups(np.diff(at), CHUNK):
                yield chunk(ids[lo:hi], raw[at[lo] : at[hi]], at[lo : hi + 1] - at[lo])

    schema = "doc_id bigint, n bigint, form string, prefix_chars bigint, middle_chars bigint, output_sha256 string, restored_sha256 string"
    return id_and_text(docs, id_col, text_col).mapInArrow(run, schema + (", output string" if with_output else ""))


def restore(transformed: DataFrame, sentinels: tuple[str, str, str] = (PREFIX, SUFFIX, MIDDLE)) -> DataFrame:
    """(doc_id, text) rebuilt from rows with ``output`` and ``form``."""
    ship(transformed.sparkSession)
    marks = tuple(x.encode() for x in sentinels)

    def run(batches):
        for batch in batches:
            rows = zip(batch.column("output").to_pylist(), batch.column("form").to_pylist())
            texts = [rebuild(output.encode(), form, marks).decode() for output, form in rows]
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "text": pa.array(texts, pa.string())})

    return transformed.select("doc_id", "output", "form").mapInArrow(run, "doc_id bigint, text string")


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text of ``documents``, cut at lines."""
    return transform(read(spark, sf_dir, "documents"))
