"""Embedding near-duplicates by collision-counting projections.

Vectors are compared with those of the same label only. Each is scaled to
length one and projected on ``PROJECTIONS`` random lines. Inside a block every
line is sorted, and around each query a window of ``WIDTH`` to either
side is found on every line by binary search; the vectors in the windows are
counted per pair, and a pair met at least
``calibrated_count`` times is verified by cosine in double precision. The
count is the largest that a pair at the threshold still reaches with ``RECALL``.

Equal vectors of a label are one node with a count, so a vector that a third
of all rows share is one row. A label is one cell, whatever its size, so whether a pair is
found depends on its two vectors alone. Cells of more than ``BLOCK`` nodes are
dealt into chunks and every pair of chunks is one block, so no task ever holds
more than two chunks, and nothing is left out; the work grows with the square of a label's nodes.

A caller who prefers less work to all links names a ``cell_target``: labels of more nodes are
then cut into cells by a grid on further lines, several grids with random offsets, so many that
a pair at the threshold shares a cell with ``RECALL``; a pair is counted in
its first common grid only. The query does not use it.

Null vectors, zero vectors, vectors with null or non-finite components and
rows without a label link with nothing: n_links 0, component_id their own id.
Vectors of different lengths are never compared. Repeated rows are vectors of
their own that link with each other.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rateflow.llm.common import materialize, new_run_folder, read, ship
from rateflow.llm.components import components

THRESHOLD = 0.98
RECALL = 0.998
PROJECTIONS = 16
WIDTH = 0.25
BLOCK = 2048
CELL_WIDTH = 1.0
#: Queries whose collisions are counted at once.
TILE = 64
SEED = 20


def _phi(x: float) -> float:
    return 0.5 * (1 + math.erf(x / math.sqrt(2)))


def window_chance(threshold: float, width: float) -> float:
    """Chance that a pair at the threshold collides on one line: its gap is normal with its distance as deviation."""
    return 2 * _phi(width / math.sqrt(2 * (1 - threshold))) - 1 if threshold < 1 else 1.0


def calibrated_count(threshold: float, projections: int, width: float, recall: float) -> int:
    """The largest count that a pair at the threshold reaches with the wanted recall."""
    p = window_chance(threshold, width)
    reached = 0.0
    for k in range(projections, -1, -1):
        reached += math.comb(projections, k) * p**k * (1 - p) ** (projections - k)
        if reached >= recall:
            return k
    return 0


def cell_plan(nodes: int, threshold: float, recall: float, target: int | None = 1 << 16) -> tuple[int, int]:
    """(lines of the grid, number of grids) for a label of so many nodes; (0, 1): one cell, as always without a target."""
    if target is None or nodes <= target:
        return 0, 1
    share = sum((_phi((k + 1) * CELL_WIDTH) - _phi(k * CELL_WIDTH)) ** 2 for k in range(-6, 6))  # of unrelated pairs that meet on a line
    lines = math.ceil(math.log(nodes / target) / -math.log(share))
    meet = (1 - math.sqrt(2 * (1 - threshold)) * math.sqrt(2 / math.pi) / CELL_WIDTH) ** lines
    return lines, math.ceil(math.log(1 - recall) / math.log(1 - meet))


def directions(dim: int, count: int, seed: int) -> np.ndarray:
    return np.random.default_rng([seed, dim]).standard_normal((dim, count))


def cells_of(unit: np.ndarray, lines: int, grids: int) -> np.ndarray:
    """For each vector and grid a number that names its cell."""
    if not lines:
        return np.zeros((len(unit), 1), np.int64)
    out = np.empty((len(unit), grids), np.int64)
    for g in range(grids):
        shift = np.random.default_rng([SEED, g]).random(lines)
        at = np.floor(unit @ directions(unit.shape[1], lines, SEED + 1 + g) / CELL_WIDTH + shift).astype(np.int64)
        key = np.zeros(len(unit), np.uint64)
        for k in range(lines):
            key = (key ^ at[:, k].view(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
            key ^= key >> np.uint64(31)
        out[:, g] = key.view(np.int64)
    return out


def collisions(pa: np.ndarray, pb: np.ndarray, width: float, least: int, upper: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (row of pa, row of pb) that lie in a window of each other on ``least`` lines or more; with ``upper`` the first below the second only.

    Every line of pb is sorted, and a query's window on it is the run between
    two binary searches. Only what stands in a window is counted, so the work follows
    the collisions; the queries go in tiles, which bounds what is counted at once.
    """
    order = np.argsort(pb, axis=0, kind="stable")
    ordered = np.take_along_axis(pb, order, axis=0)
    for t in range(0, len(pa), TILE):
        query = np.arange(t, min(t + TILE, len(pa)))
        met = []
        for k in range(pa.shape[1]):
            lo = np.searchsorted(ordered[:, k], pa[query, k] - width, "left")
            n = np.searchsorted(ordered[:, k], pa[query, k] + width, "right") - lo
            x = np.repeat(query, n)
            y = order[np.arange(len(x)) + np.repeat(lo - (np.cumsum(n) - n), n), k]
            if upper:
                x, y = x[x < y], y[x < y]
            met.append(x * len(pb) + y)
        pair, count = np.unique(np.concatenate(met), return_counts=True)
        yield np.divmod(pair[count >= least], max(len(pb), 1))


def block_links(unit_a: np.ndarray, unit_b: np.ndarray | None, threshold: float, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Verified pairs (index in a, index in b); inside a alone (i < j) where b is None."""
    lines = directions(unit_a.shape[1], PROJECTIONS, SEED)
    other = unit_a if unit_b is None else unit_b
    none = np.zeros(0, np.int64)
    left, right = [none], [none]
    for x, y in collisions(unit_a @ lines, other @ lines, WIDTH, least, unit_b is None):
        good = np.einsum("ij,ij->i", unit_a[x], other[y]) >= threshold
        left.append(x[good])
        right.append(y[good])
    return np.concatenate(left), np.concatenate(right)


def _roots(n: int, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The least index reachable from each index over the links."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[x], root[y])
        new = root.copy()
        np.minimum.at(new, x, low)
        np.minimum.at(new, y, low)
        new = np.minimum(new, new[new])
        if (new == root).all():
            return root
        root = new


def link_vectors(
    vectors: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
    cell_target: int | None = None, block: int = BLOCK,
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row."""
    spark = vectors.sparkSession
    ship(spark)
    folder = new_run_folder(spark)
    rows = vectors.select(
        vectors[id_col].cast("bigint").alias("vec_id"), vectors[vector_col].cast("array<double>").alias("v"), vectors[label_col].cast("string").alias("label")
    )
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    usable = F.coalesce(F.col("label").isNotNull() & fine, F.lit(False))
    node = F.concat(F.hex(F.xxhash64("label", "v")), F.lit("-"), F.hex(F.xxhash64(F.lit(SEED), "v", "label")))
    keyed = materialize(rows.withColumn("node", F.when(usable, node)), folder, "keyed")
    nodes = materialize(
        keyed.where("node IS NOT NULL").groupBy("node").agg(
            F.min("vec_id").alias("least_id"), F.count("*").alias("copies"), F.first("label").alias("label"), F.first("v").alias("v")
        ), folder, "nodes",
    )
    grouped = nodes.withColumn("dim", F.size("v"))
    sizes = grouped.groupBy("label", "dim").agg(F.count("*").alias("n"))
    least = calibrated_count(threshold, PROJECTIONS, WIDTH, recall)

    def place(batches):
        for frame in batches:
            for (n, dim), part in frame.groupby(["n", "dim"]):
                lines, grids = cell_plan(int(n), threshold, recall, cell_target)
                x = np.vstack(part["v"].to_numpy())
                x = x / np.abs(x).max(axis=1, keepdims=True)
                unit = x / np.sqrt((x * x).sum(axis=1, keepdims=True))
                out = part[["node", "label", "dim", "copies"]].copy()
                out["unit"], out["cells"] = list(unit), list(cells_of(unit, lines, grids))
                yield out

    placed = grouped.join(sizes, ["label", "dim"]).select("node", "label", "dim", "copies", "v", "n")
    placed = materialize(placed.mapInPandas(place, "node string, label string, dim int, copies bigint, unit array<double>, cells array<bigint>"), folder, "placed")
    cell = ["label", "dim", "grid", "cell"]
    spread = placed.select("*", F.posexplode("cells").alias("grid", "cell"))
    chunks = spread.groupBy(*cell).agg(F.ceil(F.count("*") / block).cast("int").alias("chunks"), F.count("*").alias("here")).where("here > 1").drop("here")
    dealt = spread.join(chunks, cell).withColumn("own", F.pmod(F.xxhash64("node", "grid"), F.col("chunks")).cast("int"))
    pairs = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))).withColumns(
        {"i": F.least("own", "other"), "j": F.greatest("own", "other")}
    )

    def count_block(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("node", ignore_index=True)
        unit, own, grid = np.vstack(frame["unit"].to_numpy()), frame["own"].to_numpy(), int(frame["grid"].iloc[0])
        if frame["i"].iloc[0] == frame["j"].iloc[0]:
            x, y = block_links(unit, None, threshold, least)
        else:
            a, b = np.flatnonzero(own == frame["i"].iloc[0]), np.flatnonzero(own == frame["j"].iloc[0])
            x, y = block_links(unit[a], unit[b], threshold, least) if len(a) and len(b) else (a[:0], b[:0])
            x, y = a[x], b[y]
        if grid:
            cells = np.vstack(frame["cells"].to_numpy())[:, :grid]
            new = (cells[x] != cells[y]).all(axis=1)  # else an earlier grid has this pair
            x, y = x[new], y[new]
        copies = frame["copies"].to_numpy()
        links = np.bincount(x, weights=copies[y], minlength=len(frame)) + np.bincount(y, weights=copies[x], minlength=len(frame))
        root = _roots(len(frame), x, y)
        hit = np.flatnonzero(links > 0)
        names = frame["node"].to_numpy()
        return pd.DataFrame({"node": names[hit], "links": links[hit].astype(np.int64), "root": names[root[hit]]})

    found = pairs.groupBy(*cell, "i", "j").applyInPandas(count_block, "node string, links bigint, root string")
    found = materialize(found, folder, "found")
    joined = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")), f"{folder}/components")
    counted = found.groupBy("node").agg(F.sum("links").alias("links"))
    named = nodes.select("node", "least_id", "copies").join(joined, "node", "left").withColumn("component", F.coalesce("component", "node"))
    named = named.join(named.groupBy("component").agg(F.min("least_id").alias("component_id")), "component").join(counted, "node", "left")
    label = named.select("node", "component_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    out = keyed.select("vec_id", "node").join(label, "node", "left")
    own = F.when(F.col("node").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"), own.alias("component_id")).withColumn(
        "kept", F.col("vec_id").eqNullSafe(F.col("component_id"))
    )


def op5_collision_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all vectors of ``embeddings``."""
    return link_vectors(read(spark, sf_dir, "embeddings"))
