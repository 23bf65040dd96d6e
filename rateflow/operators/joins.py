"""Left lookups by business, user and pair, with per-column mean defaults."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Largest dimension broadcast to every task, in memory.
BROADCAST_MAX_BYTES = 128 * 1024 * 1024
# Largest share of a dimension that one task hashes, in memory.
HASH_MAX_BYTES = 128 * 1024 * 1024
# Bytes in memory per byte of a stored (compressed, encoded) table.
EXPANSION = 8

# Feature column -> dimension column it is looked up from.
LOOKUPS = {
    "user_avg_rating": "u_average_stars",
    "users_review_count": "u_review_count",
    "useful": "u_useful",
    "funny": "u_funny",
    "cool": "u_cool",
    "business_avg_rating": "b_stars",
    "reviews": "b_review_count",
    "is_open": "b_is_open",
    "avg_noise": "b_noise",
    "has_WiFi": "b_wifi",
    "checkins": "b_checkins",
    "photo": "b_photo",
    "avg_user_business_like": "t_likes",
    "business_score": "b_rivals",
    "fans": "u_fans",
    "avg_friends": "u_friends",
    "compliment_cool": "u_compliment_cool",
    "compliment_funny": "u_compliment_funny",
    "compliment_list": "u_compliment_list",
    "compliment_note": "u_compliment_note",
    "compliment_more": "u_compliment_more",
    "compliment_photo": "u_compliment_photos",
    "compliment_profile": "u_compliment_profile",
    "compliment_writer": "u_compliment_writer",
    "compliment_cute": "u_compliment_cute",
    "compliment_plain": "u_compliment_plain",
    "compliment_hot": "u_compliment_hot",
    "user_yelping_age": "u_age",
    "business_open": "b_open_days",
    "business_price": "b_price",
    "avg_weekend_days": "b_weekend",
    "business_attr": "b_attr",
}


# Bytes per value in an unsafe row; strings are taken at a generous 48 bytes.
_WIDTH = {
    T.BooleanType: 8, T.ByteType: 8, T.ShortType: 8, T.IntegerType: 8, T.LongType: 8,
    T.FloatType: 8, T.DoubleType: 8, T.DateType: 8, T.TimestampType: 8,
    T.TimestampNTZType: 8, T.StringType: 56,
}


def row_bytes(schema: T.StructType) -> int:
    """Rough in-memory width of one row: null bitmap plus each field's slot."""
    return 8 + sum(_WIDTH.get(type(f.dataType), 128) for f in schema.fields)


def path_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of a file, or of the files of a folder."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(at).getLength()


def stored_bytes(df: DataFrame) -> int | None:
    """Bytes of the files that a stored table is read from; None for other frames."""
    folders = {name.rsplit("/", 1)[0] for name in df.inputFiles()}
    return sum(path_bytes(df.sparkSession, folder) for folder in folders) if folders else None


def broadcast_if_small(df: DataFrame, max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """Broadcast ``df`` only when it fits; else leave it to a shuffle join.

    A stored table is sized by its own files, times what its columns grow to
    in memory (``EXPANSION``); any other frame by its counted rows at an
    estimated width. Without this check the planner still broadcasts a side only when AQE measures its
    shuffle output under ``spark.sql.adaptive.autoBroadcastJoinThreshold``;
    above it the join is a sort-merge join with skewed partitions split.
    """
    files = stored_bytes(df)
    size = df.count() * row_bytes(df.schema) if files is None else files * EXPANSION
    if size <= max_bytes:
        return F.broadcast(df)
    return df


def hash_if_bounded(df: DataFrame, files: int | None = None) -> DataFrame:
    """Have ``df``, one row per key, hashed by a shuffle join where a task's share of it is bounded.

    Neither side is sorted then. Only for a table (of ``files`` bytes, else as stored) that is
    too large to broadcast; one whose share of a shuffle partition exceeds
    ``HASH_MAX_BYTES`` is left to a sort-merge join, which can spill. Keys are
    unique, so shares are even; the other side may be skewed, and AQE splits it.
    """
    files = stored_bytes(df) if files is None else files
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if files is not None and BROADCAST_MAX_BYTES < files * EXPANSION <= HASH_MAX_BYTES * partitions:
        return df.hint("shuffle_hash")
    return df


def lookup(ratings: DataFrame, business: DataFrame, user: DataFrame, tips: DataFrame) -> DataFrame:
    """Each ratings row with the matching business, user and pair values (NULL if absent).

    Every dimension has one row per key, so no ratings row is duplicated or
    lost, whatever the order. The pair join adds one column and the user join
    the most, so they run first and last: rows are dealt while they are narrow.
    """
    b = business.drop("od_line_sum", "line_count")
    u = user.drop("u_has_counters")
    joined = ratings.join(tips, ["user_id", "business_id"], "left").join(b, "business_id", "left").join(u, "user_id", "left")
    last = [c for c in tips.columns if c not in ("user_id", "business_id")]
    return joined.select("user_id", "business_id", *[c for c in joined.columns if c not in ("user_id", "business_id", *last)], *last)


def default_values(defaults: DataFrame | dict) -> dict:
    """The one-row defaults frame as a dict (one number per feature)."""
    if isinstance(defaults, dict):
        return defaults
    row = defaults.first()
    return row.asDict() if row is not None else {}


def fill_defaults(joined: DataFrame, defaults: DataFrame | dict, features: list[str]) -> DataFrame:
    """Each feature is its looked-up value, or its default when the key was not found.

    ``business_open`` also applies P12: a count of 0 becomes the mean over
    business.json lines. The defaults are one aggregate row; they are
    inlined as literals, so the fill is a plain projection inside the join's
    generated code rather than a join against a one-row table.
    """
    d = default_values(defaults)
    out = []
    for name in features:
        value = F.col(LOOKUPS[name]).cast("double")
        if name == "business_open":
            value = F.when(value == 0, F.lit(d["d_open_days_lines"])).otherwise(value)
        out.append(F.coalesce(value, F.lit(d[f"d_{name}"]).cast("double")).alias(name))
    keep = [c for c in ("user_id", "business_id", "rating", "label") if c in joined.columns]
    return joined.select(*keep, *out)
