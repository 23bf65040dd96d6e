"""Prediction and model sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rateflow.operators.materialize import new_run_folder, remove_run_folders
from rateflow.plans.model import tree_nodes


def prediction_frame(predictions: DataFrame, prediction_col: str = "prediction") -> DataFrame:
    """Keep ``user_id, business_id`` and the prediction, named ``prediction``."""
    return predictions.select(
        "user_id", "business_id", F.col(prediction_col).cast("double").alias("prediction")
    )


def write_predictions(
    predictions: DataFrame, path: str, prediction_col: str = "prediction", mode: str = "overwrite"
) -> None:
    """Write a comma-separated, UTF-8 CSV folder with a header and no index.

    Spark writes one part file per task; no single task or the driver gathers
    the whole output.
    """
    (
        prediction_frame(predictions, prediction_col)
        .write.mode(mode)
        .option("header", True)
        .option("encoding", "UTF-8")
        .csv(path)
    )


def write_model(model, path: str, mode: str = "overwrite") -> None:
    """A fitted boosted model as a parquet table of tree nodes (see ``tree_nodes``), which any engine can walk."""
    folder = new_run_folder(SparkSession.active())
    tree_nodes(model, folder).write.mode(mode).parquet(path)
    remove_run_folders(folder)
