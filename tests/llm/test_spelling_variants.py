"""Spelling variants against all pairs of words, and the parts of the method alone."""

import random
import re
import zlib
from collections import Counter
from itertools import combinations

import pytest

from rateflow.llm import op12_spelling_variants as op
from samples import edge_texts, frame


def one_edit(a: str, b: str) -> bool:
    if len(a) > len(b):
        a, b = b, a
    if a == b or len(b) - len(a) > 1:
        return False
    i = 0
    while i < len(a) and a[i] == b[i]:
        i += 1
    return a[i + 1 :] == b[i + 1 :] if len(a) == len(b) else a[i:] == b[i + 1 :]


def plain_counts(rows, noise=97):
    n = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = re.sub("[A-Z]", lambda m: chr(ord(m.group()) + 32), run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{word}".encode())
            if noise and h % noise == 0:
                word = word[: h % len(word)] + word[h % len(word) + 1 :]
            n[word] += 1
    return {w: k for w, k in n.items() if len(w) >= 5}


def plain_groups(counts, min_count=3):
    n = {w: k for w, k in counts.items() if k >= min_count}
    near = {w: [] for w in n}
    for a, b in combinations(n, 2):
        if one_edit(a, b):
            near[a].append(b)
            near[b].append(a)
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None
    rows = []
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        rows.append((w, form[w], root, n[w], len(near[w]), None if form[w] is None else n[form[w]]))
    return sorted(rows, key=str)


def as_rows(df):
    return sorted(((r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()), key=str)


def test_query_form_matches_all_pairs(spark):
    rng = random.Random(11)
    base = ["".join(rng.choice("abcdeé") for _ in range(rng.randrange(5, 9))) for _ in range(40)]
    rows = edge_texts(rng)
    for i in range(300):
        text = " ".join(rng.choice(base) for _ in range(30))
        rows.append((200 + i, text.replace("a", "A") if i % 3 else text))
    counts = plain_counts(rows)
    got = op.variant_groups(op.word_counts(frame(spark, rows, clash=True), noise=97))
    want = plain_groups(counts)
    assert as_rows(got) == want
    assert any(r[1] for r in want)


@pytest.mark.parametrize("letters,longest,long", [("ab", 8, 128), ("a", 30, 128), ("abc", 7, 4), ("aÿ", 7, 4), ("ab", 9, 4)])
def test_pairs_of_words_of_few_letters(spark, monkeypatch, letters, longest, long):
    """Few letters: every bigram ties with others and prefixes are full of repeats; ``long`` 4: all words count as long."""
    monkeypatch.setattr(op, "LONG_WORD", long)
    rng = random.Random(len(letters) + longest)
    words = {"".join(rng.choice(letters) for _ in range(rng.randrange(5, longest + 1))) for _ in range(260)}
    df = spark.createDataFrame([(w,) for w in sorted(words)], "word string").repartition(3)
    got = [tuple(sorted(r)) for r in op.near_pairs(df).collect()]
    assert sorted(got) == sorted(tuple(sorted(p)) for p in combinations(words, 2) if one_edit(*p))


def test_chains_lead_to_their_last_form(spark):
    chain = ["aaaaa" + "b" * k for k in range(12)]
    counts = spark.createDataFrame([(w, 3 * 2**k) for k, w in enumerate(chain)], "word string, n bigint")
    got = {r.word: (r.form, r.root) for r in op.variant_groups(counts).collect()}
    assert got == {w: (chain[k + 1] if k < 11 else None, chain[-1]) for k, w in enumerate(chain)}


def test_ties_take_the_smallest_word(spark):
    counts = spark.createDataFrame([("horse", 3), ("horsé", 6), ("horsa", 6), ("norse", 6)], "word string, n bigint")
    assert {r.word: r.form for r in op.variant_groups(counts).collect()} == {"horse": "horsa", "horsé": None, "horsa": None, "norse": None}


def test_very_long_words_and_texts(spark):
    word = "xy" * 100_000
    rows = [(i, f"{word} {word}Q " + "pieces " * 400_000) for i in range(3)]
    got = {r.word: r for r in op.variant_groups(op.word_counts(frame(spark, rows))).collect()}
    assert got["pieces"].n == 1_200_000 and set(got) == {"pieces", word, word + "q"}
    assert got[word].n_near == 1 and got[word].form is None


def test_empty_table(spark):
    assert op.variant_groups(op.word_counts(frame(spark, [(1, "x")]).limit(0))).collect() == []
    assert op.variant_groups(op.word_counts(frame(spark, [(1, None), (2, ""), (3, "1 2 3")]))).collect() == []


def test_cheapest_disjoint_matches_every_choice():
    rng = random.Random(2)
    for _ in range(300):
        places = sorted(rng.sample(range(9), rng.randrange(3, 7)))
        costs = [rng.randrange(20) for _ in places]
        k = 2
        options = [sum(costs[i] for i in c) for c in combinations(range(len(places)), k) if all(places[y] - places[x] >= 2 for x, y in zip(c, c[1:]))]
        got = op.cheapest_disjoint(places, costs, k)
        assert sum(costs[places.index(x)] for x in got) == min(options) and got[1] - got[0] >= 2


def test_pieces_do_not_cut_words():
    text = "alpha béta  gamma" * 50
    for size in (1, 3, 10, 10_000):
        assert "".join(op.pieces(text, size)) == text
        assert [w for p in op.pieces(text, size) for w in re.findall("[a-zÀ-ÿ]+", p)] == re.findall("[a-zÀ-ÿ]+", text)


def test_no_table_of_words_is_broadcast(spark):
    """A few words, far below every broadcast threshold: still no join sends them through the driver."""
    chain = ["aaaaa" + "b" * k for k in range(6)]
    found = op.variant_groups(spark.createDataFrame([(w, 3 * 2**k) for k, w in enumerate(chain)], "word string, n bigint"))
    words = found.select("word", "n")
    pairs = op.near_pairs(words)
    for df in (found, pairs, op.with_forms(words, pairs)):
        df.collect()
        assert "Broadcast" not in df._jdf.queryExecution().executedPlan().toString()
