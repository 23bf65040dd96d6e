"""Fill-in-middle against a plain version over code points, and the exception index alone."""

import hashlib
import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from rateflow.llm import op11_fill_in_middle as op
from samples import edge_texts, frame

SENTINEL_TEXTS = [(21, "a <P> b\nc"), (22, "<M>"), (23, "<S\n><P\n<M"), (24, "<<P\n\n>é<\n"), (25, "\n\n\n"), (26, "é\U0001f600\nñ\r\nx\n"), (27, "<P")]


def plain_version(doc_id, text, unit):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text) if unit == "lines" else list(text)
    digest = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * k : 8 * k + 8], 16) for k in range(4))
    a, b = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
    prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 100:
        return doc_id, len(units), "plain", None, None, text
    if h4 % 100 < 50:
        return doc_id, len(units), "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return doc_id, len(units), "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


@pytest.mark.parametrize("unit", ["lines", "chars"])
@pytest.mark.parametrize("chunk", [64, op.CHUNK])
def test_rows_match_a_plain_version(spark, monkeypatch, unit, chunk):
    rng = random.Random(3)
    rows = edge_texts(rng) + SENTINEL_TEXTS
    rows += [(100 + i, "".join(rng.choice("ab é\n\U0001f600<P>SM") for _ in range(rng.randrange(40)))) for i in range(200)]
    monkeypatch.setattr(op, "CHUNK", chunk)
    got = op.transform(frame(spark, rows, clash=True), unit=unit, with_output=True).collect()
    want = [plain_version(i, t, unit) for i, t in rows]
    key = lambda r: tuple((x is None, x or 0) if not isinstance(x, str) else (False, x) for x in r)
    assert sorted(((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in got), key=key) == sorted(want, key=key)
    assert all(r.output_sha256 == hashlib.sha256(r.output.encode()).hexdigest() for r in got)
    assert {f for _, _, f, *_ in want} == {"plain", "psm", "spm"}
    digests = {}
    for i, t in rows:
        digests.setdefault(i, set()).add(hashlib.sha256((t or "").encode()).hexdigest())
    assert all(r.restored_sha256 in digests[r.doc_id] for r in got)


def test_restore_gives_the_texts_back(spark):
    rows = [(i, t) for i, t in edge_texts(random.Random(5)) + SENTINEL_TEXTS if i is not None]
    out = op.restore(op.transform(frame(spark, rows), with_output=True))
    assert sorted(map(tuple, out.collect())) == sorted((i, t or "") for i, t in rows)


def test_empty_table_and_draws(spark):
    assert op.transform(frame(spark, [(1, "x")]).limit(0)).collect() == []
    rows = [(i, f"line\n{i}\nend") for i in range(50)]
    assert {r.form for r in op.transform(frame(spark, rows), transformed=0).collect()} == {"plain"}
    assert {r.form for r in op.transform(frame(spark, rows), spm=100).collect()} == {"spm"}


def test_overlapping_sentinels_and_units_are_refused(spark):
    for bad in (("aa", "ba", "c"), ("<P>", "<P>", "<M>"), ("<", "<S>", "|"), ("", "a", "b")):
        with pytest.raises(ValueError):
            op.check_sentinels(*bad)
    with pytest.raises(ValueError):
        op.transform(frame(spark, [(1, "x")]), unit="words")


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab\néࠀ\U0001f600", max_size=60))
def test_index_converts_every_cut_both_ways(text):
    data = text.encode()
    index = op.ExceptionIndex(np.frombuffer(data, np.uint8))
    at = np.array([len(text[:k].encode()) for k in range(len(text) + 1)], np.int64)
    chars = np.arange(len(text) + 1)
    assert index.chars(at).tolist() == chars.tolist() and index.bytes(chars).tolist() == at.tolist()
    assert len(index.lead) == sum(ord(c) > 127 for c in text)
