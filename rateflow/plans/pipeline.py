"""The whole job: inputs -> dimensions -> feature matrices -> model -> RMSE, histogram, CSV."""

from __future__ import annotations

import datetime as dt
import time
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from rateflow.functions.user import DEFAULT_AS_OF
from rateflow.operators.standardize import standardize
from rateflow.plans.bucketed import BucketedRows
from rateflow.plans.evaluate import error_histogram, rmse
from rateflow.plans.features import (
    feature_matrix,
    materialize_dimensions,
    resolve_features,
    train_ratings,
    val_ratings,
)
from rateflow.plans.model import DEPTH, MAX_BINS, ROUNDS, SEED, fit_gbt, predict, search
from rateflow.operators.materialize import materialize, new_run_folder, remove_folder, remove_run_folders, spread_for_compute
from rateflow.sources.inputs import Inputs, inputs_from_folder
from rateflow.sources.sink import write_predictions


# Tables under the run's folder that only this run reads.
TABLES = ("business_rows", "user_rows", "area_dim", "business_dim", "user_dim", "tip_dim", "train_matrix", "val_matrix",
          "rated_rows", "hot_user_id", "hot_business_id", "buckets")


@dataclass
class PipelineResult:
    rmse: float
    n_val: int
    histogram: list[tuple[int, int]]
    predictions: DataFrame
    model: object
    seconds: float
    stages: dict[str, float] = field(default_factory=dict)
    trees: int = 0
    tried: list[tuple[int, int, float]] = field(default_factory=list)
    folder: str = ""

    def close(self) -> None:
        """Remove the run's folder; ``predictions`` can no longer be read."""
        remove_run_folders(self.folder)


def run_pipeline(
    spark: SparkSession,
    input_dir: str | None = None,
    val_path: str | None = None,
    out_path: str | None = None,
    *,
    inputs: Inputs | None = None,
    as_of: dt.date | str = DEFAULT_AS_OF,
    parity: bool = False,
    features: str | list[str] = "v29",
    max_iter: int = ROUNDS,
    max_depth: int = DEPTH,
    seed: int = SEED,
    max_bins: int = MAX_BINS,
    search_pairs: list[tuple[int, int]] | None = None,
    keep_tables: bool = False,
    bucketed: bool = False,
) -> PipelineResult:
    """Run the job end to end and return its metrics.

    ``inputs`` replaces ``input_dir``/``val_path`` (e.g. the test-table
    adapter). With ``search_pairs`` (``model.SEARCH_PAIRS`` are the job's) the
    best (rounds, depth) pair is used instead of ``max_iter`` and ``max_depth``.
    The dimensions and matrices are removed at the end unless ``keep_tables``;
    the predictions stay until ``close()`` or the end of the process.
    With ``bucketed`` the lookups run over bucketed storage (``plans.bucketed``),
    which pays where the dimensions are too large to broadcast.
    Only the RMSE row and the five histogram rows reach the driver;
    predictions are written by the executors.
    """
    start = time.time()
    stages: dict[str, float] = {}
    folder = new_run_folder(spark)
    if inputs is None:
        if input_dir is None or val_path is None:
            raise ValueError("give input_dir and val_path, or inputs")
        inputs = inputs_from_folder(spark, input_dir, val_path)
    cols = resolve_features(features)

    dims = materialize_dimensions(inputs, folder, as_of, parity)
    stages["dimensions"] = time.time() - start

    if bucketed:
        rows = BucketedRows(train_ratings(inputs), val_ratings(inputs), dims, folder)
        train, val = rows.matrix(folder, "train_matrix", cols), rows.matrix(folder, "val_matrix", cols, train=False)
        rows.close()
    else:
        train = materialize(feature_matrix(train_ratings(inputs), dims, cols), folder, "train_matrix")
        val = materialize(feature_matrix(val_ratings(inputs), dims, cols), folder, "val_matrix")
    train, val = standardize(spread_for_compute(train), spread_for_compute(val), cols, parity)
    stages["features"] = time.time() - start - sum(stages.values())

    tried: list[tuple[int, int, float]] = []
    if search_pairs:
        found = search(train, cols, search_pairs, seed, max_bins)
        model, tried = found.model, found.tried
    else:
        model = fit_gbt(train, cols, max_iter, max_depth, seed, max_bins)
    stages["fit"] = time.time() - start - sum(stages.values())

    predictions = materialize(predict(model, val), folder, "predictions")
    metrics = rmse(predictions).first()
    hist = [(r["bucket"], r["n"]) for r in error_histogram(predictions).orderBy("bucket").collect()]
    if out_path:
        write_predictions(predictions, out_path)
    stages["evaluate"] = time.time() - start - sum(stages.values())
    if not keep_tables:
        for name in TABLES:
            remove_folder(spark, f"{folder}/{name}")
    return PipelineResult(
        rmse=float(metrics["rmse"]) if metrics["rmse"] is not None else float("nan"),
        n_val=int(metrics["n"]),
        histogram=hist,
        predictions=predictions,
        model=model,
        seconds=time.time() - start,
        stages=stages,
        trees=model.stages[-1].getNumTrees,
        tried=tried,
        folder=folder,
    )
