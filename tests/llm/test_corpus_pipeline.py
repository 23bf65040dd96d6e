"""The pipeline on planted documents against a brute-force version of its decisions."""

import hashlib
import random

import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from helpers import SF_SMALL
from rateflow.llm import op6_byte_bpe, op7_secret_scan
from samples import CLASH, SCHEMA, frame, prose
from test_duplicates import brute_classes
from test_models import junk

KEY = "04dbebab91ab85687d33eeaaf9ac699e1188f962"


@pytest.fixture(scope="module")
def corpus(tmp_path_factory, spark):
    rng = random.Random(1)
    items = [(i, prose(rng, 25)) for i in range(10)]
    rows, bad = [], set()
    for i in range(800):
        if i % 4 == 3:
            rows.append((i, junk(rng, 120)))
            bad.add(i)
        else:
            rows.append((i, prose(rng, rng.randrange(80, 160))))
    rows += [(1000 + i, rows[4 * i][1]) for i in range(10)]  # exact copies
    rows += [(1100 + i, rows[4 * i + 1][1] + " tail") for i in range(10)]  # near copies
    rows += [(1200 + i, prose(rng, 60) + " " + items[i][1] + " " + prose(rng, 60)) for i in range(10)]
    rows += [(1300 + i, prose(rng, 60) + f' token = "{KEY[i:]}{KEY[:i]}" ' + prose(rng, 60)) for i in range(5)]
    rows += [(1400, None), (1401, "")]
    folder = str(tmp_path_factory.mktemp("corpus"))
    frame(spark, rows).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(f"{folder}/benchmark.parquet")
    labels = [(i, int(i not in bad), 0) for i in range(0, 800) if i % 3]
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return folder, rows, bad


def test_stages_decide_as_brute_force_does(spark, corpus):
    folder, rows, bad = corpus
    text = dict(rows)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "near_dedup", "decontaminate", "secrets", "byte_bpe"]
    out = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = spark.createDataFrame(stage(spark, docs, folder).collect(), None if name == "byte_bpe" else SCHEMA)
        out[name] = {r.doc_id: r for r in docs.collect()}
        if name != "byte_bpe":
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    clean = set(text) - bad - {1400, 1401}
    kept = set(out["quality"])
    assert len(clean - kept) <= 0.02 * len(clean) and len(kept & bad) <= 0.15 * len(bad)
    classes = brute_classes([(i, text[i]) for i in kept])
    assert set(out["near_dedup"]) == {c for (_, c) in classes}
    assert set(out["decontaminate"]) == {i for i in out["near_dedup"] if not 1200 <= i < 1210}
    for i, r in out["secrets"].items():
        spans = op7_secret_scan.base_spans(text[i] or "")
        assert (KEY[:20] not in (r.text or "")) and (("[SECRET]" in (r.text or "")) == bool(spans))
        assert r.n_chars == (None if r.text is None else len(r.text))
    assert set(out["byte_bpe"]) == set(out["secrets"])
    encoding = op6_byte_bpe.load_encoding(op6_byte_bpe._ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")), public_tokenizers.PATTERN)
    for i, r in out["byte_bpe"].items():
        final = out["secrets"][i].text or ""
        assert list(r.ids) == encoding.encode_ordinary(final) and r.decoded_sha256 == hashlib.sha256(final.encode()).hexdigest()


def test_run_returns_the_last_stage(spark, corpus):
    folder, rows, _ = corpus
    got = corpus_pipeline.run(spark, folder)
    assert got.columns[:2] == ["doc_id", "n_tokens"] and 0 < got.count() < len(rows)


def test_empty_documents_table(spark, corpus, tmp_path):
    folder, _, _ = corpus
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    for table in ("benchmark", "labels"):
        spark.read.parquet(f"{folder}/{table}.parquet").write.parquet(f"{tmp_path}/{table}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_decontaminate_keeps_clean_rows_of_a_leaked_id(spark, tmp_path):
    rng = random.Random(2)
    item = prose(rng, 25)
    spark.createDataFrame([(1, item)], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    clean = [(None, prose(rng, 60)), (None, None), (5, prose(rng, 60)), (6, prose(rng, 60))]
    docs = frame(spark, [*clean, (None, "so " + item), (5, item)])
    got = corpus_pipeline.decontaminate(spark, docs, str(tmp_path)).collect()
    assert sorted(((r.doc_id, r.text) for r in got), key=str) == sorted(clean, key=str)


def test_stages_keep_columns_whose_names_they_use_themselves(spark):
    rng = random.Random(6)
    text = prose(rng, 60)
    rows = [(1, text), (1, text), (2, text + " end"), (3, prose(rng, 60)), (None, None)]
    docs = frame(spark, rows, clash=True).withColumn("__score", F.lit("x")).withColumn("__own", F.lit("y")).withColumn("own", F.lit("z"))
    docs = docs.withColumn("__id", F.lit(7)).withColumn("id", F.lit(8)).withColumn("place", F.lit(9))
    docs = docs.withColumn("lang", F.when(F.col("doc_id") == 1, F.concat(F.lit("l"), F.monotonically_increasing_id().cast("string"))).otherwise(F.col("lang")))
    docs = docs.cache()
    kept = corpus_pipeline.near_dedup(spark, docs, SF_SMALL)
    assert kept.columns == docs.columns
    got = {r.doc_id: r for r in kept.collect()}
    assert set(got) == {1, 3, None} and all((r["__own"], r.own, r["__id"], r.id, r.place) == ("y", "z", 7, 8, 9) for r in got.values())
    assert got[1].lang == min(r.lang for r in docs.where("doc_id = 1").collect())
    for stage in (corpus_pipeline.quality, corpus_pipeline.decontaminate, corpus_pipeline.redact_secrets):
        out = stage(spark, docs, SF_SMALL)
        assert out.columns == docs.columns
        assert all(r["__score"] == "x" and r[CLASH[0]] == "en" for r in out.where("doc_id = 3").collect())
