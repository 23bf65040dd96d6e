"""Connected components of a link table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rateflow.llm.common import materialize


def _least(edges: DataFrame) -> DataFrame:
    """(u, v, m): each edge with the least node next to its u, u itself included."""
    least = edges.groupBy("u").agg(F.min("v").alias("w")).select("u", F.least("u", "w").alias("m"))
    return edges.join(least, "u")


def _is_stars(edges: DataFrame) -> bool:
    """Whether each u has one edge and no v is a u: then every edge names its component."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
        edges.select(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down"))
    )
    return ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where("up > 1 OR (up = 1 AND down = 1)").isEmpty()


def stored_edges(links: DataFrame, folder: str, a: str = "a", b: str = "b") -> DataFrame:
    """(u, v) with u > v: the different links, written once; they may be none."""
    return materialize(links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u != v").distinct(), folder, "edges-0")


def components(links: DataFrame, folder: str, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node of ``links``; a component is named by its least node."""
    return components_of(stored_edges(links, folder, a, b), folder)


def components_of(edges: DataFrame, folder: str) -> DataFrame:
    """``components`` of edges that ``stored_edges`` wrote to the folder.

    The steps end when the edges are stars around the least node of each
    component. Each step is two grouped minima (map-side combined) and joins with one row
    per node, so a node with very many links can be split. The edge table
    is written after each step: lineage stays short and a lost executor costs a re-read.
    """
    step = 0
    while not _is_stars(edges):
        both = edges.select(F.explode(F.array(F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v")))).alias("e")).select("e.u", "e.v")
        large = _least(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()
        near = _least(large)  # u > v on every row, so m is the least of v
        ends = F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))
        small = near.select(F.explode(ends).alias("e")).select("e.u", "e.v").where("u != v").distinct()
        step += 1
        edges = materialize(small, folder, f"edges-{step}")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
