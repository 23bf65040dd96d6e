"""Secret scan: base patterns plus an assignment-aware lexer.

The base patterns find three kinds (assign, access, hex). The lexer reads
assignments of source and configuration syntax (``name = "literal"``,
``"name": "literal"``, ``name: literal``, ``NAME=literal``, ``name := ...``,
``name => ...``, ``<name>literal</name>``) into name-literal pairs, follows
constants (``key = BASE + "..."``: a name on the right stands for the literals
that were last assigned to it), and scores each literal by how sensitive the most
sensitive name that it reaches is and by its form. The joined value of a chain
is scored as its pieces are (variables without a known value left out), and if
it scores all of them count. Assignments are linked to the ones they
use, and weights, joined values and scores go along the links once, so neither
the length of a chain nor its repetition is limited. Literals that score ``MIN_SCORE`` and lie in no
base span are added as kind ``literal``.

Null and empty texts hold no spans. Spans are in code points, the end
exclusive. Rows that repeat are scanned each. A very long text costs time and
memory in proportion to it and, per sensitive name, to the kinds of characters of its value.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_right
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from rateflow.llm.common import arrow_ids, id_and_text, null_ids_back, read, ship, text_strings

KINDS = ("assign", "access", "hex", "literal")
MIN_ASSIGN, MIN_ACCESS, MIN_HEX, MIN_LITERAL = 8, 16, 32, 8
MIN_SCORE = 1.0

# Letters in either case means ASCII letters: hence the ASCII flag.
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{32,}")  # the maximal runs of 32 and more are the matches of [0-9a-f]+ that stay

# A name, an assignment sign, and where the value begins. A name ends where its run of characters ends, so only
# the first letter of a run is tried: a long word without a sign costs no square.
_TARGET = re.compile(
    r"""(?:(?<![\w.\-])[\d.\-]*+([A-Za-z_][\w.\-]*+)["']?\]?[ \t]*+(?::=|=>|=(?!=)|:(?![:/]))|<([A-Za-z_][\w.\-]*+)>)[ \t]*+""", re.A
)
_QUOTED = re.compile(r"""[rbuf]{0,2}"([^"\n]*)"|[rbuf]{0,2}'([^'\n]*)'""", re.A)
_BARE = re.compile(r"[A-Za-z0-9_+/=.~!@#$%^&*\-]+", re.A)
_PLUS = re.compile(r"[ \t]*(?:\+|\.\.?|&)[ \t]*(?=[\"'A-Za-z_])")
_NAME = re.compile(r"[A-Za-z_][\w.]*+", re.A)
_SPLIT = re.compile(r"[^A-Za-z]+|(?<=[a-z])(?=[A-Z])", re.A)

# Words of a target name and how much each tells of a secret.
SENSITIVE = {
    "password": 1.0, "passwd": 1.0, "pwd": 1.0, "pass": 0.7, "passphrase": 1.0, "secret": 1.0, "token": 0.9, "apikey": 1.0,
    "credential": 0.8, "credentials": 0.8, "auth": 0.6, "authorization": 0.7, "bearer": 0.8, "private": 0.5, "access": 0.4,
    "api": 0.4, "key": 0.5, "signing": 0.4, "encryption": 0.4, "client": 0.2, "cookie": 0.5, "session": 0.4,
}
# Literals that stand for a secret without being one.
PLACEHOLDERS = ("example", "changeme", "change_me", "placeholder", "your", "xxxx", "dummy", "none", "null", "true", "false", "undefined", "redacted")

_HEAD = max(map(len, PLACEHOLDERS))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the base patterns."""
    found = []
    if "=" in text or ":" in text:
        found += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= MIN_ASSIGN]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= MIN_ACCESS]
    found += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return found


def name_weight(name: str) -> float:
    """How sensitive a target name is: the sum over its words, at most 1.5."""
    return min(1.5, sum(SENSITIVE.get(w.lower(), 0.0) for w in _SPLIT.split(name) if w))


def _mixture(counts: Counter[str], length: int) -> float:
    """The entropy and the kinds of characters of a value, from how often it holds each."""
    entropy = -sum(p * math.log2(p) for p in (n / length for n in counts.values()) if p)
    kinds = sum(any(f(c) for c in counts) for f in (str.islower, str.isupper, str.isdigit, lambda c: not c.isalnum()))
    digits = any(c.isdigit() for c in counts)
    return min(1.2, entropy / 4 + 0.15 * (kinds - 1)) if digits or kinds >= 3 else 0.4


def joined_weight(counts: Counter[str], head: str) -> float:
    """Of a value known by its characters and how it begins: 0 for a short one, a placeholder or prose; else up to 1.2."""
    length = sum(counts.values())
    if length < MIN_LITERAL or any(c.isspace() for c in counts) or head.lower().startswith(PLACEHOLDERS) or len(counts) < 4:
        return 0.0
    return _mixture(counts, length)


def scores(weight: float, literal: float) -> bool:
    """Whether a literal of this weight is a secret under a name of that weight."""
    return weight >= 0.5 and weight * literal >= MIN_SCORE - 0.2 * (weight >= 1.0)


#: (start, end, whether its value is known: not a variable in a chain, whether it is bare), or the number of the
#: assignment that a constant stands for.
Operand = tuple[int, int, bool, bool] | int


def assignments(text: str) -> list[tuple[str, list[Operand]]]:
    """(target name, operands) of each assignment; those it uses come before it.

    Values are kept by their places. All bare values that begin in one run of
    characters end where it ends, so the end is looked for once a run.
    """
    found: list[tuple[str, list[Operand]]] = []
    constants: dict[str, int] = {}
    at, run_start, run_end = 0, 0, 0
    while target := _TARGET.search(text, at):
        name, pos = target[1] or target[2], target.end()
        parts: list[Operand] = []
        while True:
            if operand := _QUOTED.match(text, pos):
                group = operand.lastindex
                parts.append((operand.start(group), operand.end(group), True, False))
                pos = operand.end()
            else:
                if not run_start <= pos < run_end:
                    run = _BARE.match(text, pos)
                    if not run:
                        break
                    run_start, run_end = pos, run.end()
                named = _NAME.match(text, pos)
                is_name = named is not None and named.end() == run_end
                if is_name and named[0] in constants:
                    parts.append(constants[named[0]])
                else:
                    parts.append((pos, run_end, not is_name, True))
                pos = run_end
            if not (plus := _PLUS.match(text, pos)):
                break
            pos = plus.end()
        if parts:
            constants[name] = len(found)
            found.append((name, parts))
        at = target.end()  # values may hold further pairs: {"a": {"token": "..."}}
    return found


def lexed_pairs(text: str) -> list[tuple[str, int, int, str]]:
    """(target name, start, end, literal) of each assignment, constants followed.

    A literal used through a constant is reported at its own place, once under
    each assignment that it reaches.
    """
    found = assignments(text)
    pairs = []
    for name, parts in found:
        left, seen = parts[::-1], set()
        while left:
            part = left.pop()
            if part in seen:
                continue
            seen.add(part)
            if isinstance(part, int):
                left += found[part][1][::-1]
            else:
                pairs.append((name, part[0], part[1], text[part[0] : part[1]]))
    return pairs


def letter_counts(text: str, parts: set[tuple[int, int, bool, bool]]) -> dict[tuple[int, int], Counter[str]]:
    """How often each value holds each character; bare values of one end are counted from that end, each character once."""
    counts: dict[tuple[int, int], Counter[str]] = {}
    held, at, end = Counter(), 0, -1
    for start, stop, _, bare in sorted(parts, key=lambda x: (x[1], -x[0])):
        if not bare:
            counts[start, stop] = Counter(text[start:stop])
            continue
        if stop != end:
            held, at, end = Counter(), stop, stop
        held.update(text[start:at])
        at = start
        counts[start, stop] = held.copy()
    return counts


def added_spans(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Literals that score and lie in no base span, as (start, kind number, end)."""
    if not ("=" in text or ":" in text or "</" in text):
        return []
    assigned = assignments(text)
    weights = [name_weight(name) for name, _ in assigned]
    last_use: dict[int, int] = {}
    for n in range(len(assigned) - 1, -1, -1):
        for part in assigned[n][1] if weights[n] >= 0.5 else ():
            if isinstance(part, int):
                weights[part] = max(weights[part], weights[n])
                last_use.setdefault(part, n)
    letters = letter_counts(text, {p for w, (_, parts) in zip(weights, assigned) if w >= 0.5 for p in parts if not isinstance(p, int)})
    found = set()
    whole = [False] * len(assigned)
    joined: dict[int, tuple[Counter[str], str]] = {}
    for n, (_, parts) in enumerate(assigned):
        if weights[n] < 0.5:
            continue
        counts, head = Counter(), ""
        for part in parts:
            if isinstance(part, int):
                counts.update(joined[part][0])
                head = head if len(head) >= _HEAD else head + joined[part][1]
                continue
            start, end, known, _ = part
            begin = text[start : min(end, start + _HEAD)]
            if scores(weights[n], joined_weight(letters[start, end], begin)):
                found.add((start, 3, end))
            if known:
                counts.update(letters[start, end])
                head = head if len(head) >= _HEAD else head + begin
        whole[n] = len(parts) > 1 and scores(weights[n], joined_weight(counts, head))
        if n in last_use:
            joined[n] = counts, head[:_HEAD]
        for part in parts:
            if isinstance(part, int) and last_use[part] == n:
                joined.pop(part, None)
    for n in range(len(assigned) - 1, -1, -1):
        for part in assigned[n][1] if whole[n] else ():
            if isinstance(part, int):
                whole[part] = True
            elif part[2] and part[1] > part[0]:
                found.add((part[0], 3, part[1]))
    return outside(sorted(found), base)


def outside(spans: list[tuple[int, int, int]], base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """The spans that lie in no base span: of the base spans that begin no later, the furthest end decides."""
    starts, ends = [], []
    for start, _, end in sorted(base):
        starts.append(start)
        ends.append(max(end, ends[-1]) if ends else end)
    kept = []
    for span in spans:
        at = bisect_right(starts, span[0])
        if not at or ends[at - 1] < span[2]:
            kept.append(span)
    return kept


def as_text(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{e}" for a, k, e in sorted(spans))


def redacted(text: str, spans: list[tuple[int, int, int]], mark: str = "[SECRET]") -> str:
    """The text with each maximal covered stretch replaced by ``mark``."""
    out, at = [], 0
    for start, _, end in sorted(spans):
        if end <= at:
            continue
        if start >= at or not out:
            out += [text[at : max(start, at)], mark]
        at = max(at, end)
    return "".join([*out, text[at:]])


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", with_text: bool = False) -> DataFrame:
    """One row per document: counts, spans and their digest, and (``with_text``) the redacted text."""
    ship(docs.sparkSession)
    schema = "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, n_literal bigint, base_sha256 string, spans string"

    def run(batches):
        for batch in batches:
            doc_ids = arrow_ids(batch.column("doc_id"))
            for lo, hi, texts in text_strings(batch):
                base = [base_spans(t) for t in texts]
                spans = [b + added_spans(t, b) for t, b in zip(texts, base)]
                columns = {"doc_id": null_ids_back(doc_ids[lo:hi])}
                for k, kind in enumerate(KINDS):
                    columns[f"n_{kind}"] = pa.array([sum(s[1] == k for s in x) for x in spans], pa.int64())
                columns["base_sha256"] = [hashlib.sha256(as_text(b).encode()).hexdigest() for b in base]
                columns["spans"] = [as_text(x) for x in spans]
                if with_text:
                    columns["redacted"] = [redacted(t, x) if x else t for t, x in zip(texts, spans)]
                yield pa.RecordBatch.from_pydict(columns)

    return id_and_text(docs, id_col, text_col).mapInArrow(run, schema + (", redacted string" if with_text else ""))


def redact(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """All columns of every row, with the secrets of the text replaced; a null text stays null."""
    ship(docs.sparkSession)
    at = docs.columns.index(text_col)

    def clean(text: str) -> str:
        base = base_spans(text)
        spans = base + added_spans(text, base)
        return redacted(text, spans) if spans else text

    def run(batches):
        for batch in batches:
            column = batch.column(at)
            texts = [clean(t) for _, _, part in text_strings(pa.RecordBatch.from_arrays([column], ["text"])) for t in part]
            new = pa.array(texts, pa.string(), mask=column.is_null().to_numpy(zero_copy_only=False))
            yield batch.set_column(at, batch.schema.field(at), new.cast(column.type))

    return docs.mapInArrow(run, docs.schema)


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every whole text of ``documents``."""
    return scan(read(spark, sf_dir, "documents"))
