"""Quality classifier and benchmark decontamination."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from rateflow.llm import op4_quality_pu as op4
from rateflow.llm import op8_decontaminate as op8
from rateflow.llm.common import padded
from samples import edge_texts, frame, prose

# ---- quality


def junk(rng, n):
    kind = rng.randrange(3)
    if kind == 0:
        return " ".join(w + rng.choice(["&&&", "%%%", "###"]) for w in prose(rng, n).split())
    if kind == 1:
        return " | ".join(prose(rng, n).split())
    return " ".join(w for w in prose(rng, n // 10 + 1).split() for _ in range(10))


@pytest.fixture(scope="module")
def quality_rows():
    rng = random.Random(1)
    good = {i: rng.random() < 0.7 for i in range(900)}
    return [(i, prose(rng, rng.randrange(30, 200)) if good[i] else junk(rng, rng.randrange(30, 200))) for i in good], good


def labels_of(spark, good, rows=None):
    data = rows if rows is not None else [(i, int(q), 0) for i, q in good.items() if i % 2]
    return spark.createDataFrame(data, "doc_id bigint, quality int, toxic int")


def test_held_out_accuracy_and_prior(spark, quality_rows):
    rows, good = quality_rows
    docs = frame(spark, rows, clash=True)
    model = op4.fit(docs, labels_of(spark, good))
    assert abs(model.prior - 0.7) < 0.08
    scored = op4.score(docs, model).withColumn("held", op4.fold(F.col("doc_id")) == 0).collect()
    held = [(r.score >= op4.THRESHOLD) == good[r.doc_id] for r in scored if r.held]
    assert len(held) > 100 and np.mean(held) > 0.95
    assert all(0 <= r.score <= 1 for r in scored)


def test_the_fit_never_sees_held_out_labels(spark, quality_rows):
    rows, good = quality_rows
    docs = frame(spark, rows)
    labels = labels_of(spark, good)
    wrong = labels.withColumn("quality", F.when(op4.fold(F.col("doc_id")) == 0, 1 - F.col("quality")).otherwise(F.col("quality")))
    one, two = op4.fit(docs, labels), op4.fit(docs, wrong)
    assert one.bias == two.bias and (one.triple == two.triple).all()


def test_edges_get_scores(spark, quality_rows):
    rows, good = quality_rows
    model = op4.fit(frame(spark, rows), labels_of(spark, good))
    edges = edge_texts(random.Random(2))
    docs = frame(spark, edges, clash=True)
    got = op4.score(docs, model).collect()
    assert len(got) == len(edges) and all(0 <= r.score <= 1 for r in got)
    empty = {round(r.score, 9) for r in got if r.doc_id in (1, 2)}
    assert len(empty) == 1
    kept = op4.with_scores(docs, model, "__s")
    assert kept.columns == [*docs.columns, "__s"] and kept.count() == len(edges)
    assert op4.score(frame(spark, []), model).count() == 0


@pytest.mark.parametrize("data", [[], [(None, 1, 0), (3, None, 0), (5, 0, 0)], [(4, 1, 0), (4, 0, 0)]])
def test_without_trusted_positives_every_score_is_half(spark, data):
    docs = frame(spark, [(i, f"text {i}") for i in range(9)])
    model = op4.fit(docs, labels_of(spark, {}, data))
    assert model is None and {r.score for r in op4.score(docs, model).collect()} == {0.5}


def test_scores_do_not_depend_on_chunks():
    rng = np.random.default_rng(3)
    text = padded(rng.integers(32, 127, 5000).astype(np.uint8))
    model = op4.Model(0.5, 9.0, 0.1, rng.standard_normal(op4.TABLE), np.ones(len(op4.LAGS)))
    whole = model.scores(text, np.array([0, 1000, 1001, 1001, 5000]))
    apart = [model.scores(padded(text[a:e]), np.array([0, e - a]))[0] for a, e in ((0, 1000), (1000, 1001), (1001, 1001), (1001, 5000))]
    assert np.allclose(whole, apart)


# ---- decontamination

ITEM = "A train with 40 cars leaves the old station near Paris at noon and travels 300 miles in five hours before it stops for water and coal"


def found(spark, rows, items, **more):
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    return {(r.doc_id, r.item_id): r for r in op8.contaminated(frame(spark, rows, clash=True), bench, **more).collect()}


def test_copies_and_reparameterised_questions_are_found(spark):
    rng = random.Random(4)
    other = ITEM.replace("40", "75").replace("Paris", "Old Rome").replace("300", "1,250").replace("five", "12").replace("miles", "km")
    rows = [
        (1, prose(rng, 50) + ". " + ITEM + ". " + prose(rng, 50)), (2, prose(rng, 20) + "\n" + other), (3, prose(rng, 300)),
        (4, ITEM.upper()), (5, None), (6, ""), (7, "the old station near the sea"), (None, ITEM),
    ]
    got = found(spark, rows, [(1, ITEM), (2, prose(rng, 40)), (3, None), (4, ""), (5, "too short")])
    assert set(got) == {(1, 1), (2, 1), (4, 1), (None, 1)}
    assert not got[1, 1].slots_exchanged and got[2, 1].slots_exchanged
    assert got[2, 1].coverage > 0.9


def test_slots_must_pair_one_to_one(spark):
    item = "if 7 red birds and 9 blue birds sit on a wall how many birds sit there when 7 of them fly off again"
    same = item.replace("7", "31").replace("9", "44")
    mixed = item.replace("if 7", "if 31").replace("9", "44").replace("when 7", "when 58")
    got = found(spark, [(1, same), (2, mixed)], [(1, item)])
    assert set(got) == {(1, 1)}


def test_short_items_and_slices(spark, monkeypatch):
    rng = random.Random(5)
    items = [(i, prose(rng, 12 + i % 9)) for i in range(30)] + [(99, "purple monkeys eat yellow bananas")]
    rows = [(i, prose(rng, 30) + " " + items[i][1] + " " + prose(rng, 30)) for i in range(0, 30, 2)] + [(500, "see purple monkeys eat yellow bananas daily")]
    whole = set(found(spark, rows, items))
    assert whole == {(i, i) for i in range(0, 30, 2)} | {(500, 99)}
    monkeypatch.setattr(op8, "SLICE_WINDOWS", 40)
    assert set(found(spark, rows, items)) == whole


def test_windows_match_brute_force(spark):
    rng = random.Random(6)
    items = [(i, prose(rng, 20)) for i in range(12)]
    rows = []
    for d in range(80):
        w = items[d % 12][1].split()
        k = rng.randrange(len(w) + 1)
        rows.append((d, " ".join(prose(rng, 15).split() + w[:k] + ["zz"] + w[k:][: rng.randrange(12)])))
    windows = lambda t: {tuple(w[i : i + 8]) for w in [t.split()] for i in range(len(w) - 7)}
    want = {}
    for d, t in rows:
        for i, x in items:
            share = len(windows(t) & windows(x)) / len(windows(x))
            if share >= op8.MIN_COVERAGE:
                want[d, i] = share
    got = {k: r.coverage for k, r in found(spark, rows, items).items()}
    assert got == pytest.approx(want) and want


def test_empty_tables(spark):
    assert found(spark, [], [(1, ITEM)]) == {} and found(spark, [(1, ITEM)], []) == {}


def test_rows_of_one_id_are_judged_by_their_texts(spark):
    rng = random.Random(7)
    one, two = ITEM.replace("40", "75"), ITEM.replace("40", "81")
    rows = [(None, ITEM), (None, prose(rng, 60)), (8, one), (8, two), (9, prose(rng, 60))]
    bench = spark.createDataFrame([(None, ITEM), (3, ITEM)], "item_id bigint, text string")
    got = op8.contaminated_rows(frame(spark, rows, clash=True), bench).select("doc_id", "item_id", F.hex("node").alias("node")).collect()
    digest = lambda t: hashlib.md5(t.encode()).hexdigest().upper()
    assert {tuple(r) for r in got} == {(i, k, digest(t)) for i, t in (rows[0], *rows[2:4]) for k in (None, 3)} and len(got) == 6
    assert set(found(spark, rows, [(3, ITEM)])) == {(None, 3), (8, 3)}


def test_one_edited_slot_drops_no_verbatim_window(spark):
    item = "if 7 red birds and 9 blue birds sit on a wall near the old mill how many birds are there when 7 of them fly off again and do not come back"
    one, met = item.replace("when 7", "when 5"), item.replace("9", "7")
    far = item.replace("if 7", "if 31").replace("when 7", "when 58")  # 7 became two values: only what is verbatim counts
    got = found(spark, [(1, one), (2, met), (3, far)], [(1, item)])
    n = len(item.split()) - 7
    assert got[1, 1].n_matched == got[2, 1].n_matched == n and got[3, 1].n_matched < n


def test_windows_that_count():
    window = lambda place, *slots: (place, list(slots))
    same, other = (3, 7, 7), (30, 9, 4)
    assert op8.counting([window(0, same), window(25, other)]) == ({0, 25}, True)
    torn = [(k, 7, 50 + k) for k in (3, 30, 60)]
    passage = [window(0, torn[0]), window(25, torn[1]), window(55, torn[2]), window(70, (71, 8, 8)), window(80), *[window(k) for k in range(90, 96)]]
    assert op8.counting(passage) == ({70, *range(90, 96)}, False)


def test_verbatim_passages_and_slot_heavy_items(spark):
    rng = random.Random(8)
    long, middle = prose(rng, 1000).split(), prose(rng, 59).split()
    sums = "What is 12 + 7 * 30 - 4 / 2 + 11 * 6 ?"
    items = [(1, " ".join(long)), (2, " ".join(middle)), (3, sums), (4, "Ann Bob 5 6 " + " ".join(f"{k} km {k + 1}" for k in range(30)))]
    around = lambda t: f"{prose(rng, 30)} {t} {prose(rng, 30)}"
    rows = [(1, around(" ".join(long[300:550]))), (2, around(" ".join(middle[20:39]))), (3, around(sums)), (4, around(sums.replace("30", "31"))),
            (5, around(" ".join(middle[20:29]))), (6, around(" ".join(f"{k} km {k + 1}" for k in range(12, 18))))]
    got = found(spark, rows, items)
    assert set(got) == {(1, 1), (2, 2), (3, 3), (6, 4)}
    assert (got[1, 1].n_matched, got[1, 1].n_windows) == (243, 993) and got[3, 3].coverage == 1
