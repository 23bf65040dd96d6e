"""Near-duplicate documents and vectors, and connected components, against brute force."""

import inspect
import math
import random
from collections import Counter

import numpy as np
import pytest

from rateflow.llm import op5_collision_dedup as op5
from rateflow.llm import op9_bag_minhash as op9
from rateflow.llm.common import new_run_folder, padded
from rateflow.llm.components import components
from samples import edge_texts, frame, prose

VECTORS = "vec_id bigint, embedding array<float>, label int"


def union(nodes, links):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


# ---- components


def test_components_match_union_find(spark):
    rng = random.Random(1)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(1000, 1040)] + [(5, 5)]
    df = spark.createDataFrame(links, "a bigint, b bigint")
    got = {r.node: r.component for r in components(df, new_run_folder(spark)).collect()}
    want = union({x for p in links for x in p}, links)
    assert got == {n: c for n, c in want.items() if n in got}
    assert {n for p in links if p[0] != p[1] for n in p} == set(got)
    assert components(df.limit(0), new_run_folder(spark)).count() == 0


# ---- documents


def multiset(text):
    w = (text or "").split()
    return Counter(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else Counter()


def alike(a, b):
    both = sum((a & b).values())
    return both >= 0.8 * (sum(a.values()) + sum(b.values()) - both) and both > 0


def brute_classes(rows):
    """Class of each row: the least id among rows that links reach; rows without words stand alone."""
    sets = [multiset(t) for _, t in rows]
    links = [(i, j) for i in range(len(rows)) for j in range(i) if alike(sets[i], sets[j])]
    root = union(range(len(rows)), links)
    out = []
    for i, (doc, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if root[j] == root[i] and rows[j][0] is not None]
        out.append((doc, (min(ids) if ids else None) if sets[i] else doc))
    return Counter(out)


def near_corpus(seed):
    rng = random.Random(seed)
    rows = []
    for g in range(12):
        base = prose(rng, rng.randrange(40, 200)).split()
        for _ in range(rng.randrange(1, 7)):
            w = list(base)
            for _ in range(rng.randrange(0, 1 + len(w) // 60)):
                w[rng.randrange(len(w))] = f"new{rng.randrange(10**6)}"
            rows.append((len(rows) * 7 % 1009, " ".join(w)))
    rows += [(2000 + i, "same words " * 40 + f"end{i // 2}") for i in range(6)]
    return rows


@pytest.mark.parametrize("rows", [near_corpus(2), edge_texts(random.Random(3))], ids=["corpus", "edges"])
def test_classes_match_brute_force(spark, rows):
    got = op9.near_classes(frame(spark, rows, clash=True)).collect()
    assert Counter((r.doc_id, r.cluster_id) for r in got) == brute_classes(rows)
    assert all(r.kept == (r.doc_id == r.cluster_id) for r in got)


def test_no_documents(spark):
    assert op9.near_classes(frame(spark, [])).count() == 0
    assert op9.near_classes(frame(spark, [(1, ""), (2, None)])).where("kept").count() == 2


def test_one_row_of_each_class_stays(spark):
    rows = near_corpus(4) + edge_texts(random.Random(5))
    kept = op9.keep_one(frame(spark, rows, clash=True))
    assert "node" in kept.columns and kept.columns == frame(spark, rows, clash=True).columns
    got = Counter((r.doc_id, (r.text or "").strip() != "") for r in kept.collect())
    classes = brute_classes(rows)
    worded = {c for (d, c), _ in classes.items()} - {None}
    assert {d for d, full in got if full} <= worded and all(n == 1 for (d, full), n in got.items() if full)
    # Every worded class keeps exactly one row.
    sets = [multiset(t) for _, t in rows]
    root = union(range(len(rows)), [(i, j) for i in range(len(rows)) for j in range(i) if alike(sets[i], sets[j])])
    assert sum(n for (_, full), n in got.items() if full) == len({root[i] for i in range(len(rows)) if sets[i]})


def test_a_hub_whose_copies_differ_is_one_class(spark):
    """Copies of one base that are alike to it but not to each other: found in any order of pivots."""
    rng = random.Random(6)
    base = prose(rng, 300).split()
    rows = [(500, " ".join(base))]
    for i in range(60):
        w = list(base)
        for k in range(5):
            w[(i * 37 + k * 59) % 300] = f"only{i}-{k}"
        rows.append((i, " ".join(w)))
    got = op9.near_classes(frame(spark, rows)).collect()
    assert Counter((r.doc_id, r.cluster_id) for r in got) == brute_classes(rows)


def block_rows(rng):
    """Buckets of a large class and strangers, of many single classes, and of one class: (key, node, n, component), and the nodes' elements."""
    rows, els = [], {}

    def add(key, node, component, own):
        els.setdefault(node, sorted(set(own)))
        rows.append((key, node, len(els[node]), component))

    common = list(range(1000, 1060))
    for i in range(60):  # a class over several blocks, in two buckets
        for key in (1, 2):
            add(key, b"a%03d" % i, b"a000", common + [i])
    for i in range(40):  # strangers: some are near a member of the large class, some near each other, some near none
        own = common[: 60 - i % 20] if i % 2 else [rng.randrange(50) + 5000 for _ in range(30)]
        add(1, b"s%03d" % i, b"s%03d" % i, own)
        add(3, b"s%03d" % i, b"s%03d" % i, own)
    add(4, b"long0", b"long0", range(9000))
    add(4, b"long1", b"long1", range(1000, 10000))
    return rows, els


@pytest.mark.parametrize("size", [(256, 1 << 18), (7, 1 << 18), (256, 300), (2, 100)])
def test_blocks_join_the_classes_that_brute_force_joins(spark, size):
    rows, els = block_rows(random.Random(8))
    found = spark.createDataFrame(rows, "key bigint, node binary, n bigint, component binary").repartition(4)
    sets = spark.createDataFrame(list(els.items()), "node binary, els array<int>")
    got = [(bytes(r.ca), bytes(r.cb)) for r in op9.block_links(found, sets, 0.8, *size).collect()]
    want = set()
    for key, a, _, ca in rows:
        for other, b, _, cb in rows:
            x, y = set(els[a]), set(els[b])
            if key == other and ca < cb and len(x & y) >= 0.8 * len(x | y):
                want.add((ca, cb))
    assert {(min(p), max(p)) for p in got} <= want
    names = sorted({r[3] for r in rows})
    assert union(names, got) == union(names, want)
    assert want
    if size == (256, 1 << 18):  # a bucket is one block here, and a block joins its classes by fewer links than it has rows
        assert len(got) < len(rows)


def test_blocks_of_no_rows(spark):
    found = spark.createDataFrame([], "key bigint, node binary, n bigint, component binary")
    sets = spark.createDataFrame([], "node binary, els array<int>")
    assert op9.block_links(found, sets, 0.8).collect() == []


def test_signature_agreement_is_unbiased():
    rng = np.random.default_rng(7)
    hashes = rng.integers(0, 2**63, 150).astype(np.uint64)
    a, b = rng.integers(1, 12, 150), rng.integers(1, 12, 150)
    zero = np.zeros(150, np.int64)
    one, two = (op9.signatures(hashes, zero, w, 1, 8192) for w in (a, b))
    true = np.minimum(a, b).sum() / np.maximum(a, b).sum()
    assert abs((one == two).mean() - true) < 4 * np.sqrt(true * (1 - true) / 8192)


def test_shingles_and_multisets():
    texts = [b"a b c d e f", b"", b"x y", b"a b c d e f"]
    offsets = np.cumsum([0, *map(len, texts)])
    hashes, doc, weight = op9.weighted(*op9.shingles(padded(np.frombuffer(b"".join(texts), np.uint8)), offsets))
    assert np.bincount(doc, minlength=4).tolist() == [2, 0, 1, 2]
    assert sorted(hashes[doc == 0]) == sorted(hashes[doc == 3]) and (weight == 1).all()
    assert len(set(op9.elements(np.array([5, 9], np.uint64), np.array([3, 1])).tolist())) == 4


# ---- vectors


def brute_links(rows, threshold=op5.THRESHOLD):
    fine = [e is not None and label is not None and all(x is not None and np.isfinite(x) for x in e) and any(e) for _, e, label in rows]
    links = []
    for i, (_, a, la) in enumerate(rows):
        for j in range(i):
            _, b, lb = rows[j]
            if fine[i] and fine[j] and la == lb and len(a) == len(b):
                x, y = np.array(a, np.float64), np.array(b, np.float64)
                if x @ y / np.sqrt(x @ x) / np.sqrt(y @ y) >= threshold:
                    links.append((i, j))
    root = union(range(len(rows)), links)
    degree = Counter(x for p in links for x in p)
    out = []
    for i, (v, _, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if root[j] == root[i] and rows[j][0] is not None]
        out.append((v, degree[i], min(ids) if ids else None))
    return Counter(out)


def vectors(seed, n=160, dim=16):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        if rows and rng.random() < 0.5:
            old = rows[rng.integers(len(rows))]
            v = np.array(old[1]) + rng.standard_normal(dim) * rng.choice([0.0, 0.01, 0.03, 0.2])
            rows.append((i, v.astype(np.float32).tolist(), old[2]))
        else:
            rows.append((i, rng.standard_normal(dim).astype(np.float32).tolist(), int(rng.integers(3))))
    return rows


EDGES = [
    (1, None, 1), (2, [], 1), (3, [0.0, 0.0], 1), (4, [1.0, None], 1), (5, [float("nan"), 1.0], 1), (6, [float("inf"), 1.0], 1),
    (7, [1.0, 2.0], None), (8, [1.0, 2.0], 1), (9, [2.0, 4.0], 1), (9, [2.0, 4.0], 1), (None, [1.0, 2.0], 1), (10, [1.0, 2.0], 2),
    (11, [1.0, 2.0, 0.0], 1), (12, [-1.0, -2.0], 1), (13, [1e30, 2e30], 1), (14, [1e-30, 2e-30], 1), (15, [-0.0, 1.0], 3), (16, [0.0, 1.0], 3),
]


@pytest.mark.parametrize("rows", [vectors(1), EDGES], ids=["random", "edges"])
def test_links_match_brute_force(spark, rows):
    df = spark.createDataFrame(rows, VECTORS).selectExpr("*", "label AS node", "label AS cell", "label AS copies")
    got = op5.link_vectors(df).collect()
    assert Counter((r.vec_id, r.n_links, r.component_id) for r in got) == brute_links(rows)
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)


def test_chunks_and_grids_lose_no_link(spark):
    rows = vectors(2, 400)
    df = spark.createDataFrame(rows, VECTORS)
    want = brute_links(rows)
    chunked = op5.link_vectors(df, block=16).collect()
    assert Counter((r.vec_id, r.n_links, r.component_id) for r in chunked) == want
    gridded = op5.link_vectors(df, recall=0.9999, cell_target=20, block=16).collect()
    found, total = sum(r.n_links for r in gridded), sum(k[1] * n for k, n in want.items())
    assert total >= found >= 0.98 * total and total > 100


def test_no_vectors(spark):
    assert op5.link_vectors(spark.createDataFrame([], VECTORS)).count() == 0


def test_calibrated_count_keeps_recall():
    k = op5.calibrated_count(op5.THRESHOLD, op5.PROJECTIONS, op5.WIDTH, op5.RECALL)
    rng = np.random.default_rng(3)
    gaps = np.abs(rng.standard_normal((20_000, op5.PROJECTIONS)) * np.sqrt(2 * (1 - op5.THRESHOLD)))
    assert ((gaps <= op5.WIDTH).sum(axis=1) >= k).mean() > op5.RECALL - 0.002
    assert op5.cell_plan(100, 0.98, 0.99) == (0, 1) and op5.cell_plan(10**8, 0.98, 0.99)[0] >= 5


def test_the_sieve_loses_fewer_pairs_than_the_bands():
    slots, p = 2 * op9.BANDS * op9.ROWS, (1 - op9.THRESHOLD) * 3 / 4
    at_most = op9.most_different(slots, op9.THRESHOLD)
    lost = sum(math.comb(slots, k) * p**k * (1 - p) ** (slots - k) for k in range(at_most + 1, slots + 1))
    assert lost < 1e-5 < (1 - op9.THRESHOLD**op9.ROWS) ** op9.BANDS < 3e-4


@pytest.mark.parametrize("upper", [True, False])
def test_collisions_are_the_pairs_in_enough_windows(upper):
    rng = np.random.default_rng(4)
    pa = np.round(rng.standard_normal((300, 5)), 1)  # ties on every line
    pb = pa if upper else np.round(rng.standard_normal((170, 5)), 1)
    found = [pair for x, y in op5.collisions(pa, pb, 0.35, 2, upper) for pair in zip(x.tolist(), y.tolist())]
    counts = (np.abs(pa[:, None, :] - pb[None, :, :]) <= 0.35).sum(axis=2)
    wanted = {(i, j) for i, j in zip(*np.nonzero(counts >= 2)) if not upper or i < j}
    assert len(found) == len(set(found)) and set(found) == wanted
    assert list(op5.collisions(pa[:0], pb, 0.35, 2, False)) == []


def test_a_label_of_any_size_is_one_cell(spark):
    assert op5.cell_plan(10**9, op5.THRESHOLD, op5.RECALL, None) == (0, 1)
    assert inspect.signature(op5.link_vectors).parameters["cell_target"].default is None
    rows = vectors(5, 300)
    got = op5.link_vectors(spark.createDataFrame(rows, VECTORS), block=32).collect()
    assert Counter((r.vec_id, r.n_links, r.component_id) for r in got) == brute_links(rows)
