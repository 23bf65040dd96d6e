"""Quality classifier by positive-unlabelled learning.

Trusted positives are the documents whose labels all say quality 1;
unlabelled ones are drawn from the whole table. A linear model over
character-class trigrams and word repetition minimises the non-negative
unbiased risk

    prior * E_P[loss(z)] + max(0, E_U[loss(-z)] - prior * E_P[loss(-z)])

with the logistic loss. The class prior is estimated first: a plain
positive-against-unlabelled model scores each half of the sample by the other
half, and the prior is the least ratio of the unlabelled to the positive share
above a score, since the unlabelled share is at least prior x the positive one.

The fit reads a bounded sample (``MAX_POSITIVES`` + ``MAX_UNLABELLED``
documents, the first by a hash of the id); scoring covers every whole text. Labels,
language, source and id are never inputs of a score.

Null and empty texts get the score of a text without features. A null id is
never in a fold or in the sample. Without any trusted positive every score is 0.5.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from rateflow.llm import vec
from rateflow.llm.common import id_and_text, null_ids_back, padded, read, row_groups, ship, text_buffer, text_chunks

#: Documents in the fit's sample at most.
MAX_POSITIVES, MAX_UNLABELLED = 4000, 6000
#: Features kept for the fit: those that tell most between positives and unlabelled documents.
MAX_FEATURES = 512
FOLDS = 5
THRESHOLD = 0.3
TABLE = 4096
#: A word that equals the one so many words before it counts as repetition.
LAGS = (1, 2, 3)
CHUNK = 1 << 20
WIDTH = TABLE + len(LAGS)


def _classes() -> np.ndarray:
    """16 classes of bytes: letters by case, digits, blanks, line breaks, bytes of other letters, kinds of signs."""
    c = np.zeros(256, np.uint16)
    groups = (b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" ", b"\t\n\r\x0b\x0c", bytes(range(128, 256)),
              b".,;:", b"!?", b"'\"()[]{}<>", b"|/\\-_", b"#", b"$", b"%", b"&", b"*+=@^~`")
    for k, group in enumerate(groups, 1):
        c[list(group)] = k
    return c


_CLASS = _classes()


def codes(buf: np.ndarray, n: int) -> np.ndarray:
    """The trigram of character classes at each position (padding is read past the end)."""
    kind = _CLASS[buf[: n + 2]]
    return (kind[:n] * 256 + kind[1 : n + 1] * 16 + kind[2 : n + 2]).astype(np.int64)


def repetition(buf: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """For each document and lag, the root of the share of words that equal the one ``lag`` words before."""
    starts, ends, bounds = vec.word_bounds(buf, offsets)
    words = vec.word_hashes(buf, starts, ends)
    out = np.zeros((len(offsets) - 1, len(LAGS)))
    for k, lag in enumerate(LAGS):
        same = np.zeros(len(words), bool)
        same[lag:] = words[lag:] == words[:-lag]
        room = np.minimum(bounds[:-1] + lag, bounds[1:])
        share = (vec.sums_before(same, bounds[1:]) - vec.sums_before(same, room)) / np.maximum(bounds[1:] - room, 1)
        out[:, k] = np.sqrt(share)
    return out


def frequencies(buf: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Dense rows of features, one per document: frequencies, then repetition."""
    triple = codes(buf, int(offsets[-1]))
    out = np.zeros((len(offsets) - 1, WIDTH), np.float32)
    out[:, TABLE:] = repetition(buf, offsets)
    for i, (a, e) in enumerate(zip(offsets[:-1], offsets[1:] - 2)):
        if e > a:
            out[i, :TABLE] = np.bincount(triple[a:e], minlength=TABLE) / (e - a)
    return out


@dataclass(frozen=True)
class Model:
    """Score of a text: logistic(bias + mean weight of its class trigrams + weights of its repetition).

    The mean weight counts ``cap`` at most, which half of the trusted positives
    reach: an odd mixture of trigrams cannot outweigh repetition.
    """

    prior: float
    cap: float
    bias: float
    triple: np.ndarray
    lags: np.ndarray

    def scores(self, buf: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        n = int(offsets[-1])
        sums = np.zeros(n + 1)
        for a in range(0, n, CHUNK):
            b = min(n, a + CHUNK)
            np.cumsum(self.triple[codes(buf[a : b + 2], b - a)], out=sums[a + 1 : b + 1])
            sums[a + 1 : b + 1] += sums[a]
        ends = np.maximum(offsets[1:] - 2, offsets[:-1])
        count = ends - offsets[:-1]
        mean = (sums[ends] - sums[offsets[:-1]]) / np.maximum(count, 1)
        return logistic(self.bias + np.minimum(mean, self.cap) + repetition(buf, offsets) @ self.lags)


def logistic(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -30, 30)))


def _descend(p: np.ndarray, u: np.ndarray, prior: float | None, steps: int = 200, rate: float = 0.1, decay: float = 1e-4) -> np.ndarray:
    """Adam on the non-negative risk (``prior`` None: plain P against U); the last weight is the bias."""
    w = np.zeros(p.shape[1] + 1)
    m, v = np.zeros_like(w), np.zeros_like(w)

    def gradient(x: np.ndarray, slope: np.ndarray) -> np.ndarray:
        return np.append(slope @ x, slope.sum()) / max(len(x), 1)

    for t in range(1, steps + 1):
        zp, zu = p @ w[:-1] + w[-1], u @ w[:-1] + w[-1]
        up = gradient(p, -logistic(-zp))  # loss(z) of the positives
        down_u, down_p = gradient(u, logistic(zu)), gradient(p, logistic(zp))  # loss(-z)
        if prior is None:
            g = up + down_u
        else:
            negative = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
            g = prior * up + down_u - prior * down_p if negative >= 0 else prior * down_p - down_u
        g[:-1] += decay * w[:-1]
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w = w - rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return w


def estimate_prior(p: np.ndarray, u: np.ndarray) -> float:
    """Share of positives among the unlabelled, from scores of each half by the other half's model."""
    score_p, score_u = np.empty(len(p)), np.empty(len(u))
    for half in (0, 1):
        w = _descend(p[half::2], u[half::2], None, steps=120)
        score_p[1 - half :: 2] = p[1 - half :: 2] @ w[:-1] + w[-1]
        score_u[1 - half :: 2] = u[1 - half :: 2] @ w[:-1] + w[-1]
    levels = np.quantile(score_p, np.linspace(0, 0.5, 51))  # above each level lies half of the positives at least
    above_p = np.array([(score_p >= x).mean() for x in levels])
    above_u = np.array([(score_u >= x).mean() for x in levels])
    return float(np.clip((above_u / above_p).min(), 0.01, 0.99))


Sparse = list[tuple[np.ndarray, np.ndarray]]


def _moments(rows: Sparse) -> tuple[np.ndarray, np.ndarray]:
    """Mean and deviation of every feature."""
    total, square = np.zeros(WIDTH), np.zeros(WIDTH)
    for at, value in rows:
        total[at] += value
        square[at] += value.astype(np.float64) ** 2
    mean = total / len(rows)
    return mean, np.sqrt(np.maximum(square / len(rows) - mean**2, 0))


def _dense(rows: Sparse, used: np.ndarray) -> np.ndarray:
    """The used features as a matrix; only these few columns are ever dense."""
    column = np.full(WIDTH, -1)
    column[used] = np.arange(len(used))
    out = np.zeros((len(rows), len(used)))
    for i, (at, value) in enumerate(rows):
        here = column[at] >= 0
        out[i, column[at[here]]] = value[here]
    return out


def fit_rows(p: Sparse, u: Sparse) -> Model:
    """Fit on the features (positions and values) of positives and unlabelled documents."""
    mean, sd = _moments(u)
    sd += 1e-4
    told = np.abs(_moments(p)[0] - mean) / sd
    used = np.sort(np.argsort(-told, kind="stable")[:MAX_FEATURES])
    mean, sd = mean[used], sd[used]
    plain = [_dense(x, used) for x in (p, u)]
    scaled = [np.clip((x - mean) / sd, -8, 8) for x in plain]
    prior = estimate_prior(*scaled)
    w = _descend(*scaled, prior)
    tables = np.zeros(WIDTH)
    tables[used] = w[:-1] / sd
    cap = float(np.quantile(plain[0][:, used < TABLE] @ tables[used[used < TABLE]], 0.5))
    return Model(prior, cap, float(w[-1] - (w[:-1] * mean / sd).sum()), tables[:TABLE], tables[TABLE:])


def fold(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % FOLDS


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", quality_col: str = "quality", max_positives: int = MAX_POSITIVES, max_unlabelled: int = MAX_UNLABELLED) -> Model | None:
    """The model, from rows outside the held-out fold; None without a trusted positive."""
    spark = docs.sparkSession
    ship(spark)
    texts = id_and_text(docs, id_col, text_col)
    drawn = F.xxhash64("doc_id", F.lit("quality"))
    own = labels.select(labels[id_col].cast("bigint").alias("doc_id"), labels[quality_col].cast("int").alias("quality"))
    trusted = (
        own.where(fold(F.col("doc_id")) != 0).groupBy("doc_id").agg(F.min("quality").alias("least"), F.count("quality").alias("n"), F.count("*").alias("of"))
        .where("least = 1 AND n = of").select("doc_id", drawn.alias("draw")).orderBy("draw", "doc_id").limit(max_positives)
    )
    anyone = texts.where(fold(F.col("doc_id")) != 0).select("doc_id", drawn.alias("draw")).orderBy("draw", "doc_id").limit(max_unlabelled)
    sample = trusted.select("doc_id", F.lit(1).alias("p"), F.lit(0).alias("u")).unionByName(anyone.select("doc_id", F.lit(0).alias("p"), F.lit(1).alias("u")))
    sample = sample.groupBy("doc_id").agg(F.max("p").alias("p"), F.max("u").alias("u"))  # max_positives + max_unlabelled rows at most

    def run(batches):
        for batch in batches:
            at = 0
            for ids, buf, offsets in text_chunks(batch, CHUNK):
                rows = frequencies(buf, offsets)
                hits = [np.flatnonzero(r).astype(np.uint16) for r in rows]
                yield pa.RecordBatch.from_pydict({
                    "doc_id": ids, "p": batch.column("p")[at : at + len(ids)], "u": batch.column("u")[at : at + len(ids)],
                    "feature": [h.tobytes() for h in hits], "value": [r[h].tobytes() for r, h in zip(rows, hits)],
                })
                at += len(ids)

    got = (
        texts.join(F.broadcast(sample), "doc_id").select("doc_id", "text", "p", "u")
        .mapInArrow(run, "doc_id bigint, p int, u int, feature binary, value binary")
        .orderBy(F.xxhash64("doc_id", F.lit("quality")), "doc_id", F.xxhash64("feature", "value")).limit(2 * (max_positives + max_unlabelled)).collect()
    )
    p, u = ([(np.frombuffer(r["feature"], np.uint16), np.frombuffer(r["value"], np.float32)) for r in got if r[c]] for c in ("p", "u"))
    return fit_rows(p, u) if p and u else None


def score(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score) of every row."""
    ship(docs.sparkSession)

    def run(batches):
        for batch in batches:
            for ids, buf, offsets in text_chunks(batch, CHUNK):
                value = model.scores(buf, offsets) if model else np.full(len(ids), 0.5)
                yield pa.RecordBatch.from_pydict({"doc_id": null_ids_back(ids), "score": value})

    return id_and_text(docs, id_col, text_col).mapInArrow(run, "doc_id bigint, score double")


def with_scores(docs: DataFrame, model: Model | None, name: str, text_col: str = "text") -> DataFrame:
    """All columns of every row, and its score as the column ``name``."""
    ship(docs.sparkSession)
    text_at = docs.columns.index(text_col)

    def run(batches):
        for batch in batches:
            raw, at = text_buffer(batch.column(text_at))
            value = [np.zeros(0)]
            for lo, hi in row_groups(np.diff(at), CHUNK):
                value.append(model.scores(padded(raw[at[lo] : at[hi]]), at[lo : hi + 1] - at[lo]) if model else np.full(hi - lo, 0.5))
            yield batch.append_column(name, pa.array(np.concatenate(value), pa.float64()))

    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField(name, DoubleType())]))


def op4_quality_pu(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A quality score of every whole text, learnt outside the fold that is held out."""
    docs = read(spark, sf_dir, "documents")
    scored = score(docs, fit(docs, read(spark, sf_dir, "labels")))
    return scored.select(
        "doc_id", F.coalesce(fold(F.col("doc_id")) == 0, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
