"""Test-table adapter: the parquet tables of a scale-factor folder as the job's inputs.

No ratings dataset ships with the tests, so each input file is derived from
the TPC-H-like tables with Spark and rendered as the same JSON / CSV lines the
job reads. Everything downstream then runs the real parsing path.

Mapping (mirrored by the DuckDB oracle in ``oracle_sql.py``):

- ratings: one row per ``lineitem ⋈ orders``; user = ``o_custkey``, business =
  ``l_partkey``, stars = ``1 + l_quantity % 5``. Orders dated before
  ``SPLIT_DATE`` form the training file, the rest the validation file.
- business.json: one line per part; area = ``p_brand``.
- user.json: one line per customer; ``yelping_since`` = date of the
  customer's first order.
- photo.json: one line per line item.
- checkin.json: per part, counts of its line items by ship weekday and line number.
- tip.json: one line per line item, likes = ``l_linenumber % 3``.
- review_train.json: the training ratings as JSON.

With ``gaps`` some keys are missing, for the queries whose feature is the
lookup with defaults: parts larger than ``LISTED_MAX_SIZE`` and customers with
a negative balance have no line, and only returned line items
(``l_returnflag = 'R'``) a photo.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rateflow.operators.joins import hash_if_bounded, path_bytes
from rateflow.operators.materialize import materialize, spread_for_compute
from rateflow.sources.inputs import Inputs
from rateflow.sources.schemas import RATINGS_HEADER
from rateflow.sources.text import SEQ

# Fixed values of the adapter (the oracle SQL repeats them).
SPLIT_DATE = "2000-01-01"
LISTED_MAX_SIZE = 47
WEEK = ["Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday"]
OPEN_HOURS = "9:0-17:0"
NOISE_BY_TYPE = {
    "ECONOMY": "quiet",
    "PROMO": "loud",
    "LARGE": "very_loud",
    "MEDIUM": "average",
    "STANDARD": "average",
}  # SMALL parts have no NoiseLevel attribute
WIFI_BY_SIZE_MOD3 = ["no", "free", "paid"]
# User counters: value = floor(c_acctbal) % modulus.
USER_COUNTER_MODULI = {
    "review_count": 50, "useful": 97, "funny": 31, "cool": 37,
    "compliment_cool": 29, "compliment_funny": 41, "compliment_list": 3,
    "compliment_note": 23, "compliment_more": 5, "compliment_photos": 17,
    "compliment_profile": 7, "compliment_writer": 13, "compliment_cute": 9,
    "compliment_plain": 19, "compliment_hot": 11,
}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _json_lines(df: DataFrame, *cols: Column, nulls: bool = False) -> DataFrame:
    """One JSON line per row; with ``nulls`` a null field is written as null instead of left out."""
    options = {"ignoreNullFields": "false"} if nulls else {}
    place = [SEQ] if SEQ in df.columns else []
    return df.select(F.to_json(F.struct(*cols), options).alias("value"), *place)


def _placed(df: DataFrame) -> DataFrame:
    """The rows dealt over the task slots, for lines that cost much to render and parse, with the place they were read at."""
    return spread_for_compute(df.withColumn(SEQ, F.monotonically_increasing_id()))


def _rated_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    # A small test table is one row group and so one task: deal its rows over the slots.
    li = spread_for_compute(
        _table(spark, sf_dir, "lineitem").select(
            "l_orderkey", "l_partkey", "l_quantity", "l_linenumber"
        )
    )
    orders = _table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    orders = hash_if_bounded(orders, path_bytes(spark, f"{sf_dir.rstrip('/')}/orders.parquet"))
    return li.join(orders, li.l_orderkey == orders.o_orderkey).select(
        F.col("o_custkey").cast("string").alias("user_id"),
        F.col("l_partkey").cast("string").alias("business_id"),
        (F.lit(1.0) + F.col("l_quantity").cast("bigint") % 5).alias("stars"),
        F.col("l_linenumber"),
        (F.col("o_orderdate") < F.lit(SPLIT_DATE).cast("timestamp_ntz")).alias("is_train"),
    )


def _rating_lines(spark: SparkSession, rated: DataFrame) -> DataFrame:
    header = spark.range(1).select(F.lit(RATINGS_HEADER).alias("value"))
    body = rated.select(
        F.concat_ws(",", "user_id", "business_id", F.col("stars").cast("string")).alias("value")
    )
    return header.union(body)


def business_lines(spark: SparkSession, sf_dir: str, gaps: bool = False) -> DataFrame:
    part = _placed(_table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size"))
    if gaps:
        part = part.filter(F.col("p_size") <= LISTED_MAX_SIZE)
    size = F.col("p_size")
    noise = F.lit(None).cast("string")
    for p_type, level in reversed(list(NOISE_BY_TYPE.items())):
        noise = F.when(F.col("p_type") == p_type, F.lit(level)).otherwise(noise)
    attributes = F.when(size % 7 == 0, F.lit(None)).otherwise(
        F.map_filter(
            F.create_map(
                F.lit("RestaurantsPriceRange2"), (size % 4 + 1).cast("string"),
                F.lit("NoiseLevel"), noise,
                F.lit("GoodForKids"), F.when(size % 2 == 0, "True").otherwise("False"),
                F.lit("WiFi"), F.element_at(F.array(*map(F.lit, WIFI_BY_SIZE_MOD3)), size % 3 + 1),
            ),
            lambda k, v: v.isNotNull(),
        )
    )
    n_days = size % 7 + 1
    hours = F.when(size % 5 == 0, F.lit(None)).otherwise(
        F.map_from_arrays(
            F.slice(F.array(*map(F.lit, WEEK)), F.lit(1), n_days),
            F.array_repeat(F.lit(OPEN_HOURS), n_days),
        )
    )
    return _json_lines(
        part,
        F.col("p_partkey").cast("string").alias("business_id"),
        F.col("p_brand").alias("postal_code"),
        (F.lit(1.0) + (F.col("p_partkey") % 9) * 0.5).alias("stars"),
        ((size * 7) % 20).alias("review_count"),
        F.when(size % 11 == 0, F.lit(None)).otherwise(F.when(size % 3 > 0, 1).otherwise(0)).alias("is_open"),
        attributes.alias("attributes"),
        F.when(size % 6 == 0, F.lit(None)).otherwise(F.regexp_replace("p_name", " ", ", ")).alias("categories"),
        hours.alias("hours"),
        nulls=True,
    )


def user_lines(spark: SparkSession, sf_dir: str, gaps: bool = False) -> DataFrame:
    customer = _placed(_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_acctbal"))
    if gaps:
        customer = customer.filter(F.col("c_acctbal") >= 0)
    first_order = (
        _table(spark, sf_dir, "orders")
        .groupBy("o_custkey")
        .agg(F.min("o_orderdate").alias("first_order"))
    )
    users = customer.join(first_order, customer.c_custkey == first_order.o_custkey, "left")
    base = F.floor("c_acctbal").cast("bigint")
    nation = F.col("c_nationkey")
    n_friends = nation % 5 + 1
    friends = F.when(nation % 4 == 0, F.lit("None")).otherwise(
        F.concat_ws(
            ", ",
            F.transform(F.sequence(F.lit(1), n_friends), lambda k: (F.col("c_custkey") + k).cast("string")),
        )
    )
    counters = [F.pmod(base, F.lit(m)).alias(name) for name, m in USER_COUNTER_MODULI.items()]
    return _json_lines(
        users,
        F.col("c_custkey").cast("string").alias("user_id"),
        *counters,
        F.when(nation % 6 == 5, F.lit("")).otherwise(nation.cast("string")).alias("fans"),
        ((F.lit(100) + F.pmod(base, F.lit(400))) / 100.0).alias("average_stars"),
        F.date_format("first_order", "yyyy-MM-dd").alias("yelping_since"),
        friends.alias("friends"),
    )


def photo_lines(spark: SparkSession, sf_dir: str, gaps: bool = False) -> DataFrame:
    li = _table(spark, sf_dir, "lineitem")
    if gaps:
        li = li.filter(F.col("l_returnflag") == "R")
    li = spread_for_compute(li.select("l_orderkey", "l_linenumber", "l_partkey"))
    return _json_lines(
        li,
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("photo_id"),
        F.col("l_partkey").cast("string").alias("business_id"),
    )


def checkin_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = spread_for_compute(_table(spark, sf_dir, "lineitem").select("l_partkey", "l_shipdate", "l_linenumber"))
    # Counted by numbers; the slot is named once per group.
    counts = li.groupBy("l_partkey", F.dayofweek("l_shipdate").alias("day"), "l_linenumber").agg(F.count(F.lit(1)).cast("int").alias("n"))
    # At most 7 weekdays x 7 line numbers per part, so each map is bounded, and the counts are
    # dealt by part as numbers: lists gathered before the shuffle would hold a few slots each.
    per_part = counts.repartition("l_partkey").groupBy("l_partkey").agg(F.collect_list(F.struct("day", "l_linenumber", "n")).alias("slots"))
    day = F.array(*[F.lit(name[:3]) for name in WEEK])
    time = F.transform("slots", lambda s: F.struct(F.concat(F.element_at(day, s["day"]), F.lit("-"), s["l_linenumber"]).alias("slot"), s["n"].alias("n")))
    return _json_lines(per_part, F.map_from_entries(time).alias("time"), F.col("l_partkey").cast("string").alias("business_id"))


def inputs_from_tables(spark: SparkSession, sf_dir: str, gaps: bool = False, folder: str | None = None) -> Inputs:
    """All inputs of the job derived from the tables in ``sf_dir``.

    With ``folder`` the joined rating rows, which four inputs are rendered
    from, are stored there once; without it each input is a plan of its own.
    """
    rated = _rated_items(spark, sf_dir)
    if folder is not None:
        rated = materialize(rated, folder, "rated")
    train, val = rated.filter("is_train"), rated.filter(~F.col("is_train"))
    return Inputs(
        business=business_lines(spark, sf_dir, gaps),
        user=user_lines(spark, sf_dir, gaps),
        photo=photo_lines(spark, sf_dir, gaps),
        checkin=checkin_lines(spark, sf_dir),
        tip=_json_lines(rated, "user_id", "business_id", (F.col("l_linenumber") % 3).alias("likes")),
        review=_json_lines(train, "user_id", "business_id", "stars"),
        train=_rating_lines(spark, train),
        val=_rating_lines(spark, val),
        train_header=RATINGS_HEADER,
        val_header=RATINGS_HEADER,
    )


def ordered_files(spark: SparkSession, sf_dir: str, folder: str) -> tuple[str, str]:
    """Validation file and review file, their lines in the order of order key and line number: the paths to read them by."""
    li = _table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity", "l_linenumber")
    orders = _table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    rated = li.join(orders, li.l_orderkey == orders.o_orderkey).select(
        "l_orderkey", "l_linenumber", F.col("o_custkey").cast("string").alias("user_id"), F.col("l_partkey").cast("string").alias("business_id"),
        (F.lit(1.0) + F.col("l_quantity").cast("bigint") % 5).alias("stars"),
        (F.col("o_orderdate") < F.lit(SPLIT_DATE).cast("timestamp_ntz")).alias("is_train"),
    )
    rated = rated.orderBy("l_orderkey", "l_linenumber", "user_id", "business_id", "stars")
    val = rated.filter(~F.col("is_train")).select(F.concat_ws(",", "user_id", "business_id", F.col("stars").cast("string")).alias("value"))
    spark.range(1).select(F.lit(RATINGS_HEADER).alias("value")).write.text(f"{folder}/val/0-header")
    val.write.text(f"{folder}/val/1-body")
    _json_lines(rated.filter("is_train"), "user_id", "business_id", "stars").write.text(f"{folder}/review")
    return f"{folder}/val/*", f"{folder}/review"


def damaged_business_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The business lines with planted damage by part key: cut off, blank, and without an id."""
    lines = business_lines(spark, sf_dir).withColumn("id", F.get_json_object("value", "$.business_id"))
    kind = F.col("id").cast("bigint") % 10
    cut = F.concat(F.lit('{"business_id":"'), "id", F.lit('"'))
    return lines.select(
        F.when(kind == 3, cut).when(kind == 5, "  ").when(kind == 7, F.concat(F.lit('{"name":"'), "id", F.lit('"}'))).otherwise(F.col("value")).alias("value")
    )


def rating_file(spark: SparkSession, sf_dir: str, folder: str, which: str = "train") -> str:
    """Write the rating lines as text files, the header in the first; the path to read them by."""
    rated = _rated_items(spark, sf_dir)
    body = rated.filter("is_train" if which == "train" else ~F.col("is_train"))
    lines = body.select(F.concat_ws(",", "user_id", "business_id", F.col("stars").cast("string")).alias("value"))
    spark.range(1).select(F.lit(RATINGS_HEADER).alias("value")).write.text(f"{folder}/{which}/0-header")
    lines.write.text(f"{folder}/{which}/1-body")
    return f"{folder}/{which}/*"
