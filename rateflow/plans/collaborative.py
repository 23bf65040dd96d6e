"""Collaborative filtering by alternating least squares, means for keys it does not know."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rateflow.operators.materialize import materialize
from rateflow.operators.ranks import key_index
from rateflow.plans.model import SEED

RANK = 10
ITERATIONS = 10
REGULARISATION = 0.1
CHECKPOINT_INTERVAL = 2
# The solver's ids are 32-bit.
MAX_KEYS = 2**31 - 1


@dataclass
class Collaborative:
    """A fitted factor model, the indices of its keys, and the means for the others."""

    model: ALSModel
    users: DataFrame  # user_id, user_idx, user_mean
    businesses: DataFrame  # business_id, business_idx, business_mean
    mean: float
    least: float
    most: float


def _known(ratings: DataFrame, key: str, short: str, folder: str) -> DataFrame:
    """(key, idx, mean) of the training keys: stored, one row each."""
    index = key_index(ratings, key, folder, f"{short}_keys").withColumnRenamed("idx", f"{short}_idx")
    means = ratings.groupBy(key).agg(F.avg("label").alias(f"{short}_mean"))
    return materialize(index.join(means, key), folder, f"{short}_index")


def fit_als(
    train: DataFrame,
    folder: str,
    rank: int = RANK,
    iterations: int = ITERATIONS,
    regularisation: float = REGULARISATION,
    seed: int = SEED,
    blocks: int | None = None,
) -> Collaborative:
    """Fit on ``user_id, business_id, label``; a pair rated several times counts once, at its mean.

    Keys become dense numbers through a stored, range-sorted index that is
    joined back; nothing the size of the key set reaches the driver. A hot
    user's ratings lie in one block of the solver, but only as (number,
    rating) pairs; ``blocks`` sets how many blocks either side has.
    """
    pairs = materialize(train.groupBy("user_id", "business_id").agg(F.avg("label").alias("label")), folder, "als_pairs")
    users, businesses = _known(pairs, "user_id", "user", folder), _known(pairs, "business_id", "business", folder)
    for known in (users, businesses):
        n = known.count()
        if n > MAX_KEYS:
            raise ValueError(f"{n} keys, but the solver takes {MAX_KEYS}")
    numbered = pairs.join(users, "user_id").join(businesses, "business_id").select(
        F.col("user_idx").cast("int"), F.col("business_idx").cast("int"), F.col("label").cast("float").alias("label")
    )
    numbered = materialize(numbered, folder, "als_numbered")
    als = ALS(
        rank=rank, maxIter=iterations, regParam=regularisation, seed=seed, userCol="user_idx", itemCol="business_idx", ratingCol="label",
        coldStartStrategy="nan", checkpointInterval=CHECKPOINT_INTERVAL,
    )
    if blocks:
        als = als.setNumUserBlocks(blocks).setNumItemBlocks(blocks)
    totals = pairs.agg(F.avg("label").alias("mean"), F.min("label").alias("least"), F.max("label").alias("most")).first()
    return Collaborative(als.fit(numbered), users, businesses, totals["mean"], totals["least"], totals["most"])


def factors(fitted: Collaborative, side: str) -> DataFrame:
    """(user_id or business_id, features) of the fitted model."""
    known, key = (fitted.users, "user") if side == "user" else (fitted.businesses, "business")
    table = fitted.model.userFactors if side == "user" else fitted.model.itemFactors
    return known.join(table, known[f"{key}_idx"] == table["id"]).select(f"{key}_id", "features")


def predict_als(fitted: Collaborative, ratings: DataFrame) -> DataFrame:
    """Each ratings row with ``prediction`` and its ``origin``.

    Both keys known: the product of their factors, kept within the
    training labels' range (``factors``). Else the known key's mean (``user``
    or ``business``), else the mean of all pairs (``mean``).
    """
    joined = ratings.join(fitted.users, "user_id", "left").join(fitted.businesses, "business_id", "left")
    # Unknown keys get a number that no factor has.
    numbers = {c: F.coalesce(F.col(c).cast("int"), F.lit(-1)) for c in ("user_idx", "business_idx")}
    scored = fitted.model.transform(joined.drop("prediction").withColumns(numbers))
    raw = F.col("prediction").cast("double")
    found = raw.isNotNull() & ~F.isnan(raw)
    origin = (
        F.when(found, "factors").when(F.col("user_mean").isNotNull(), "user").when(F.col("business_mean").isNotNull(), "business").otherwise("mean")
    )
    value = F.when(found, F.greatest(F.least(raw, F.lit(fitted.most)), F.lit(fitted.least))).otherwise(
        F.coalesce("user_mean", "business_mean", F.lit(fitted.mean))
    )
    keep = [c for c in ratings.columns if c != "prediction"]
    return scored.select(*keep, value.alias("prediction"), origin.alias("origin"))
