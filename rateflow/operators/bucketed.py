"""Bucketed tables: rows dealt by key once, so that joins on the key need no shuffle.

A key that holds more rows than an average bucket is hot. Its rows are dealt
over salts by a second key, and its one dimension row is repeated for each
salt, so no bucket takes a hot key whole. There are at most as many hot keys as
buckets, whatever the data; only those are broadcast.
"""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SALT = "_salt"
# A join on more columns than the buckets' is still co-located.
_SUBSET_KEYS = "spark.sql.requireAllClusterKeysForCoPartition"


def hot_keys(df: DataFrame, key: str, buckets: int) -> DataFrame:
    """(key): the keys of more rows than an average bucket; fewer than ``buckets`` of them."""
    counts = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n")).first()[0] or 0
    return counts.where(F.col("n") > total / buckets).select(key)


def _is_hot(df: DataFrame, key: str, hot: DataFrame) -> tuple[DataFrame, Column]:
    marked = hot.select(F.col(key).alias("_hot"))
    return df.join(F.broadcast(marked), df[key] == F.col("_hot"), "left"), F.col("_hot").isNotNull()


def salted(df: DataFrame, key: str, by: str, hot: DataFrame, buckets: int) -> DataFrame:
    """``df`` with the salt of each row: by the hash of ``by`` for hot keys, else 0."""
    joined, is_hot = _is_hot(df, key, hot)
    return joined.withColumn(SALT, F.when(is_hot, F.pmod(F.xxhash64(by), F.lit(buckets))).otherwise(0).cast("int")).drop("_hot")


def repeated(dimension: DataFrame, key: str, hot: DataFrame, buckets: int) -> DataFrame:
    """A dimension with one row per key and salt."""
    joined, is_hot = _is_hot(dimension, key, hot)
    salts = F.when(is_hot, F.sequence(F.lit(0), F.lit(buckets - 1))).otherwise(F.array(F.lit(0)))
    return joined.withColumn(SALT, F.explode(salts)).drop("_hot")


class Buckets:
    """Bucketed tables of one run, under its folder; ``close`` forgets their names (the folder holds the files)."""

    def __init__(self, spark: SparkSession, folder: str, buckets: int | None = None):
        self.spark, self.folder = spark, folder
        self.n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.tables: list[str] = []

    def write(self, df: DataFrame, name: str, key: str) -> DataFrame:
        """Store ``df``, which has a salt, dealt by key and salt: one shuffle, one file per bucket."""
        table = f"rateflow_{uuid.uuid4().hex}_{name}"
        dealt = df.repartition(self.n, key, SALT)
        dealt.write.bucketBy(self.n, key, SALT).sortBy(key, SALT).option("path", f"{self.folder}/{name}").format("parquet").saveAsTable(table)
        self.tables.append(table)
        return self.spark.table(table)

    def close(self) -> None:
        for table in self.tables:
            self.spark.sql(f"DROP TABLE IF EXISTS {table}")
        self.tables = []


@contextmanager
def co_located(spark: SparkSession):
    """Plan joins on more keys than the buckets' without dealing rows again (until the frames inside have run)."""
    before = spark.conf.get(_SUBSET_KEYS)
    spark.conf.set(_SUBSET_KEYS, "false")
    try:
        yield
    finally:
        spark.conf.set(_SUBSET_KEYS, before)
