"""Personal data against plain Python over the stated patterns, and against the SQL on documents that share entities."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import duckdb
from pyspark.sql import functions as F

from rateflow.llm import op13_pii_sanitize as op
from rateflow.llm.oracle import ORACLE_SQL
from samples import edge_texts, frame, prose

WORD = re.compile(r"[^\W\d_]{3,}")


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = int(d) * (2 if i % 2 else 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def holds(kind, value):
    digits = re.sub("[^0-9]", "", value)
    if kind == "ip":
        return all(int(p) <= 255 for p in value.split("."))
    if kind == "card":
        return 16 <= len(digits) <= 19 and luhn(digits)
    if kind == "phone":
        return 8 <= len(digits) <= 15
    return True


def plain_matches(text):
    """(kind, start, end, entity, terms) of the base spans."""
    out = []
    for kind in op.KINDS:
        found = list(re.finditer(op.PLAIN[kind], text))
        for k, m in enumerate(found):
            if not holds(kind, m.group()):
                continue
            before = text[found[k - 1].end() if k else 0 : m.start()]
            after = text[m.end() : found[k + 1].start() if k + 1 < len(found) else len(text)]
            if len(before) > op.CONTEXT_CHARS:
                before = re.sub(r"^[^\W\d_]+", "", before[-op.CONTEXT_CHARS :])
            if len(after) > op.CONTEXT_CHARS:
                after = re.sub(r"[^\W\d_]+$", "", after[: op.CONTEXT_CHARS])
            b, a = (WORD.findall(re.sub(op.PLAIN["email"], " ", x).lower()) for x in (before, after))
            digits = re.sub("[^0-9]", "", m.group())
            value = m.group().lower() if kind == "email" else digits if kind in ("card", "phone") else m.group()
            out.append((kind, m.start(), m.end(), f"{kind}:{value}", set(b[-op.CONTEXT_WORDS :] + a[: op.CONTEXT_WORDS])))
    return out


def plain_scan(rows, threshold=op.GENERALISE):
    texts = [t or "" for _, t in rows]
    base = [plain_matches(t) for t in texts]
    n_c, texts_c, n_ct, texts_ct, n_t = Counter(), defaultdict(set), Counter(), defaultdict(set), Counter()
    for text, spans in zip(texts, base):
        for c in {s[3] for s in spans}:
            n_c[c] += 1
            texts_c[c].add(text)
        for pair in {(s[3], t) for s in spans for t in s[4]}:
            n_ct[pair] += 1
            texts_ct[pair].add(text)
        n_t.update(set(WORD.findall(re.sub(op.PLAIN["email"], " ", text).lower())))
    total = len(rows)
    risks = {
        (c, t) for (c, t), n in n_ct.items()
        if len(texts_ct[c, t]) > 1 and len(texts_c[c]) > 1 and n_t[t] and n_c[c] < total
        and math.log(total * n / (n_c[c] * n_t[t])) / math.log(total / n_c[c]) >= threshold
    }
    out = []
    for (doc_id, _), text, spans in zip(rows, texts, base):
        risky = {t for s in spans for t in s[4] if (s[3], t) in risks}
        hidden = re.sub(op.PLAIN["email"], lambda m: "." * len(m.group()), text)
        terms = [f"term:{m.start()}:{m.end()}" for m in WORD.finditer(hidden) if m.group().lower() in risky]
        named = [f"{k}:{a}:{b}" for k, a, b, *_ in spans]
        n = Counter(s[0] for s in spans)
        out.append((doc_id, *(n[k] for k in op.KINDS), hashlib.sha256(",".join(named).encode()).hexdigest(), ",".join(named + terms), len(terms)))
    return sorted(out, key=str)


def as_rows(df):
    return sorted(((r.doc_id, r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256, r.spans, r.n_term) for r in df.collect()), key=str)


CASES = [
    (1, "a@b.com_x@c.org a..b@-.- @x.y a@b a@b.c.d.e. ü@x.com"), (2, "1.2.3.4.5.6.7.8 256.1.1.1 0255.001.0.00 1.2.3 1.2.3.x 00999.1.1.1"),
    (3, "4944339490429605 4944 3394-9042 9605 49443394904296050 4944339490429606 1 2 3"), (4, "+1 (988) 555-2485, +12345678 +1234567 ++49 30 12-34-56-7 +1 23456789012345678"),
    (5, "+1 10.0.0.1 x"), (6, "\U0001f600é a.b%c+d-e@mail-1.example.com\n\U0001f600 127.0.0.1\r\n"), (7, "a@b.co" * 40), (8, "1.1.1.1 " * 300 + "x@y.zz " * 700),
]


def shared_documents(rng):
    """Entities that recur in different texts, beside words of their own and common ones."""
    rows = []
    for i in range(240):
        text = prose(rng, 30)
        if i % 8 == 0:
            text += f" Contact Quentin Éowyn <quentin.e@mail.example.org> {prose(rng, 12)} call Quentin at +1 (988) 555-{i:04d}"
        if i % 12 == 0:
            text += f" {prose(rng, 3)} Zaphod Office paid with 4944339490429605 {prose(rng, 4)}, host 10.1.2.3 near Zaphod; {prose(rng, 40)} zaphod"
        rows.append((1000 + i, text))
    copy = "Wanda Unique wrote wanda@copies.example.net twice"
    return rows + [(2000 + i, copy) for i in range(5)] + [(2000, copy), (None, "Quentin Éowyn quentin.e@mail.example.org"), (None, None)]


def test_base_spans_match_plain_python(spark):
    rng = random.Random(1)
    rows = CASES + edge_texts(rng)
    rows += [(300 + i, "".join(rng.choice("a1@.-_+ (") for _ in range(rng.randrange(60)))) for i in range(400)]
    rows += [(800 + i, "".join(rng.choice("0149 -.+") for _ in range(rng.randrange(60)))) for i in range(400)]
    assert as_rows(op.scan(frame(spark, rows, clash=True))) == plain_scan(rows)


def test_terms_match_plain_python_and_sql(spark, tmp_path):
    rows = shared_documents(random.Random(4))
    want = plain_scan(rows)
    assert sum(r[-1] for r in want) > 50 and not any(r[-1] for r in want if 2000 <= (r[0] or 0) < 2005)
    got = as_rows(op.scan(frame(spark, rows)))
    assert got == want
    frame(spark, rows).write.parquet(str(tmp_path / "documents"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents/*.parquet')")
    result = con.execute(ORACLE_SQL["op13_pii_sanitize"])
    names = [c[0] for c in result.description]
    order = [names.index(c) for c in ("doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_term")]
    assert sorted((tuple(r[i] for i in order) for r in result.fetchall()), key=str) == got


def test_sanitised_texts(spark):
    rows = shared_documents(random.Random(4))
    got = {(r.doc_id, r.text) for r in op.sanitise(frame(spark, rows)).collect()}
    texts = " ".join(t for _, t in got if t)
    assert len(got) == len(rows) - 2 + 1 and (None, None) in got  # six copies under five ids
    assert "quentin" not in texts.lower() and "zaphod" not in texts.lower()
    assert "[EMAIL]" in texts and "[CARD]" in texts and "[IP]" in texts and "[PHONE]" in texts
    assert (2001, "Wanda Unique wrote [EMAIL] twice") in got  # one text, however often, is no evidence
    untouched = {(i, t) for i, t in rows if t and not plain_matches(t)}
    assert untouched and untouched <= got
    shaped = op.sanitise(frame(spark, rows), remove=2.0).where(F.col("doc_id").isNull() & F.col("text").isNotNull()).first().text
    assert shaped == "[NAME] [NAME] [EMAIL]"


LONG = {
    "a" * 1_000_000: (0, 0), "1" * 1_000_000: (0, 0), "a.b@" * 200_000: (100_000, 0), "1.2." * 200_000: (0, 100_000),
    "+1 " * 200_000: (0, 0), "1 " * 400_000 + "x": (0, 0), "ab@c.de " * 100_000: (100_000, 0),
}


def test_very_long_texts(spark):
    """A plain search takes square time on most of these, so the numbers are stated."""
    rows = [(i, long) for i, long in enumerate(LONG)] + [(99, "x@y.zz")]
    got = {r.doc_id: r for r in op.scan(frame(spark, rows)).collect()}
    assert got[99].spans == "email:0:6" and all(got[i].n_card == got[i].n_phone == 0 for i, _ in enumerate(LONG))
    assert [(got[i].n_email, got[i].n_ip) for i, _ in enumerate(LONG)] == list(LONG.values())
    assert got[6].spans.endswith("email:799992:799999")


def test_empty_table(spark):
    assert op.scan(frame(spark, [(1, "x")]).limit(0)).collect() == []
    assert op.sanitise(frame(spark, [(1, "x")]).limit(0)).collect() == []
    assert as_rows(op.scan(frame(spark, [(1, None), (2, "")]))) == plain_scan([(1, None), (2, "")])
