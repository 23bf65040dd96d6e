"""The job's inputs as line frames, from a folder of files or from the test tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from rateflow.sources.text import read_lines

# File names inside the input folder.
FILES = {
    "business": "business.json",
    "user": "user.json",
    "photo": "photo.json",
    "checkin": "checkin.json",
    "tip": "tip.json",
    "review": "review_train.json",
    "train": "yelp_train.csv",
}


@dataclass
class Inputs:
    """Raw ``value STRING`` line frames, one per input file."""

    business: DataFrame
    user: DataFrame
    photo: DataFrame
    checkin: DataFrame
    tip: DataFrame
    review: DataFrame
    train: DataFrame
    val: DataFrame
    # Header of the ratings files; None means "take the first line".
    train_header: str | None = None
    val_header: str | None = None


def inputs_from_folder(spark: SparkSession, input_dir: str, val_path: str) -> Inputs:
    """Line frames for the files of ``input_dir`` plus the validation CSV."""
    base = input_dir.rstrip("/")
    frames = {key: read_lines(spark, f"{base}/{name}") for key, name in FILES.items()}
    return Inputs(val=read_lines(spark, val_path), **frames)
