"""The corpus pipeline: documents to token ids in five stages.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor
kept; its result is written as Parquet and read again as the next one's docs.
All but the last return the columns of ``documents``. Null and empty texts
pass every stage that does not judge words: the classifier scores them as any
other text, they have no near duplicates, leaks or secrets, and encode to no ids.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rateflow.llm import op4_quality_pu, op6_byte_bpe, op7_secret_scan, op8_decontaminate, op9_bag_minhash
from rateflow.llm.common import free_names, materialize, new_run_folder, read


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject."""
    model = op4_quality_pu.fit(docs, read(spark, sf_dir, "labels"))
    (score,) = free_names(docs, "score")
    scored = op4_quality_pu.with_scores(docs, model, score)
    return scored.where(F.col(score) >= op4_quality_pu.THRESHOLD).drop(score)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates."""
    return op9_bag_minhash.keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of the benchmark."""
    found = op8_decontaminate.contaminated_rows(docs, read(spark, sf_dir, "benchmark"))
    found = found.select("doc_id", "node").distinct()
    found = materialize(found, new_run_folder(spark), "contaminated")
    same = docs["doc_id"].cast("bigint").eqNullSafe(found["doc_id"]) & (op8_decontaminate.text_digest(docs["text"]) == found["node"])
    return docs.join(found, same, "left_anti")


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, its secrets replaced by a mark and n_chars counted anew where the text changed."""
    clean = op7_secret_scan.redact(docs)
    kept = docs.schema["n_chars"].dataType
    changed = F.col("text").contains("[SECRET]")
    return clean.withColumn("n_chars", F.when(changed, F.length("text").cast(kept)).otherwise(F.col("n_chars")))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with the digests of ids and decoded bytes."""
    return op6_byte_bpe.round_trip(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), with_ids=True)


STAGES = [
    ("quality", quality),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("secrets", redact_secrets),
    ("byte_bpe", encode),
]

#: SQL expresses neither the classifier nor the signatures; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    folder = new_run_folder(spark)
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), folder, name)
    return docs
