"""Small documents for the tests of the corpus operators."""

from __future__ import annotations

import random

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
#: Columns whose names an operator might use itself.
CLASH = ["n", "node", "bands", "component", "score", "kept", "cluster_id", "block", "bucket", "keys"]


def words(rng: random.Random, n: int, vocabulary: int = 400) -> list[str]:
    return [f"w{rng.randrange(vocabulary):x}é"[: 2 + rng.randrange(4)] for _ in range(n)]


def prose(rng: random.Random, n: int) -> str:
    return " ".join(words(rng, n))


def frame(spark, rows, clash: bool = False, parts: int = 3):
    """Rows of (doc_id, text) as documents, over several partitions; with ``clash`` further columns."""
    full = [(i, t, "en", "src0", None if t is None else len(t)) for i, t in rows]
    df = spark.createDataFrame(full, SCHEMA).repartition(parts)
    if clash:
        for name in CLASH:
            df = df.withColumn(name, df["lang"])
    return df


def edge_texts(rng: random.Random) -> list[tuple[int | None, str | None]]:
    """Null, empty and blank texts, a null id, ties, repeated rows, a very long text."""
    shared = prose(rng, 90)
    return [
        (1, None), (2, ""), (3, " \t\n"), (None, shared), (4, shared), (4, shared), (5, "x" + shared + "\n" + shared),
        (6, "a" * 300), (7, "a" * 49), (8, "a" * 50), (9, prose(rng, 40_000)), (10, "One."), (11, "One."),
        (12, "ünï códe \U0001f600 " * 30), (None, None), (-3, shared[:200]),
    ]
