"""J01-J03 over bucketed storage: training and validation rows are dealt by business once and by user once.

The plain lookups deal the rows of each matrix by business, by user and by
pair. Here both files' rows travel together: dealt by business they meet the
business dimension, dealt by user the user and the pair dimension. What
is stored then serves every feature vector, for both files, without a shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rateflow.operators.bucketed import SALT, Buckets, co_located, hot_keys, repeated, salted
from rateflow.operators.joins import fill_defaults
from rateflow.operators.materialize import materialize
from rateflow.plans.features import Dimensions, resolve_features

TRAIN = "_train"


class BucketedRows:
    """Rows of both ratings files and the dimensions, co-located by user."""

    def __init__(self, train: DataFrame, val: DataFrame, dims: Dimensions, folder: str, buckets: int | None = None):
        self.dims = dims
        self.store = store = Buckets(train.sparkSession, f"{folder}/buckets", buckets)
        cols = ["user_id", "business_id", "rating", "label"]
        rows = train.select(*cols, F.lit(True).alias(TRAIN)).unionByName(val.select(*cols, F.lit(False).alias(TRAIN)))
        rows = materialize(rows, folder, "rated_rows")
        hot_b, hot_u = (materialize(hot_keys(rows, k, store.n), folder, f"hot_{k}") for k in ("business_id", "user_id"))
        dealt = store.write(salted(rows, "business_id", "user_id", hot_b, store.n), "rows_by_business", "business_id")
        business = store.write(repeated(dims.business.drop("od_line_sum", "line_count"), "business_id", hot_b, store.n), "business", "business_id")
        self.with_business = dealt.join(business, ["business_id", SALT], "left").drop(SALT)
        self.rows = store.write(salted(self.with_business, "user_id", "business_id", hot_u, store.n), "rows_by_user", "user_id")
        self.user = store.write(repeated(dims.user.drop("u_has_counters"), "user_id", hot_u, store.n), "user", "user_id")
        self.tips = store.write(salted(dims.tips, "user_id", "business_id", hot_u, store.n), "tips", "user_id")

    def looked_up(self) -> DataFrame:
        """Every row with the values of its business, user and pair; plan it inside ``co_located``."""
        joined = self.rows.join(self.user, ["user_id", SALT], "left")
        return joined.join(self.tips, ["user_id", SALT, "business_id"], "left").drop(SALT)

    def matrix(self, folder: str, name: str, features: str | list[str] = "v29", train: bool = True) -> DataFrame:
        """The stored feature matrix of one file."""
        rows = self.looked_up().where(F.col(TRAIN) if train else ~F.col(TRAIN))
        with co_located(rows.sparkSession):
            return materialize(fill_defaults(rows, self.dims.defaults, resolve_features(features)), folder, name)

    def close(self) -> None:
        self.store.close()
