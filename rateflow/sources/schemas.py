"""Schemas of the JSON-lines inputs.

Scalars are read as STRING: the job tests several of them against ``""`` and
accepts ``"null"`` for ``hours``, and a typed FAILFAST schema rejects both.
Each value is cast after its emptiness test (see ``rateflow.functions.missing``).
"""

from pyspark.sql import types as T

S = T.StringType()


def _strings(*names: str) -> list[T.StructField]:
    return [T.StructField(n, S) for n in names]


# The user counters the job reads, in the order of its 17-value
# tuple (the first 14 form the older tuple).
USER_COUNTERS = [
    "review_count", "fans", "useful", "average_stars", "funny", "cool",
    "compliment_cool", "compliment_funny", "compliment_list", "compliment_note",
    "compliment_more", "compliment_photos", "compliment_profile", "compliment_writer",
    "compliment_cute", "compliment_plain", "compliment_hot",
]

BUSINESS = T.StructType(
    _strings("business_id", "postal_code", "stars", "review_count", "is_open")
    + [T.StructField("attributes", T.MapType(S, S))]
    + _strings("categories", "hours")
)

USER = T.StructType(_strings("user_id", *USER_COUNTERS, "yelping_since", "friends"))

PHOTO = T.StructType(_strings("business_id"))

CHECKIN = T.StructType(
    _strings("business_id") + [T.StructField("time", T.MapType(S, T.IntegerType()))]
)

TIP = T.StructType(_strings("user_id", "business_id", "likes"))

REVIEW = T.StructType(_strings("user_id", "business_id", "stars"))

# Keys that every line must have. The job also indexes stars, postal_code,
# review_count and attributes of a business line directly, each for its own feature only; a
# line without them is kept here with null, since one parse serves all features.
BUSINESS_KEYS = ("business_id",)
USER_KEYS = ("user_id",)
PHOTO_KEYS = ("business_id",)
CHECKIN_KEYS = ("business_id", "time")
TIP_KEYS = ("user_id", "business_id")
REVIEW_KEYS = ("user_id", "business_id", "stars")

# Header line of the ratings CSV files written by the test adapter.
RATINGS_HEADER = "user_id,business_id,stars"
