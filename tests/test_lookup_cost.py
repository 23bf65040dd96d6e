"""What the lookups do per row: one parse of a line, narrow rows dealt first, no method too large to compile."""

import math

from pyspark.sql import functions as F

from helpers import SF_SMALL, lines
from rateflow.operators.interactions import tip_likes
from rateflow.operators.joins import BROADCAST_MAX_BYTES, EXPANSION, HASH_MAX_BYTES, hash_if_bounded, lookup
from rateflow.operators.materialize import materialize, new_run_folder
from rateflow.plans.features import build_dimensions
from rateflow.plans.queries import QUERIES, _rounded, canonical
from rateflow.sources.tables import checkin_lines
from test_defaults import _inputs


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_keys_are_listed_only_for_a_missing_value(spark):
    plan = _plan(tip_likes(lines(spark, '{"user_id":"u","business_id":"b","likes":1}')))
    # The right side of an AND would be taken for always evaluated and shared by both fields.
    assert "AND NOT coalesce(array_contains" not in plan and "jsonObjectKeys" in plan
    assert "translate(" not in plan


def test_single_quotes_are_deleted_and_a_null_key_is_allowed(spark):
    rows = tip_likes(lines(spark, '{"user_id":"o\'u","business_id":null,"likes":2}', "{'\"user_id\":\"ou\",\"business_id\":null,\"likes\":3}")).collect()
    assert [tuple(r) for r in rows] == [("ou", None, 5)]


def test_methods_stay_below_what_the_jvm_compiles(spark):
    assert int(spark.conf.get("spark.sql.codegen.hugeMethodLimit")) <= 8000


def test_lookups_deal_narrow_rows_first(spark):
    ratings = spark.createDataFrame([("u", "b", 1.0, 1.0), ("v", None, 2.0, 2.0)], "user_id string, business_id string, rating double, label double")
    business = spark.createDataFrame([("b", 3, 1, 1)], "business_id string, b_x int, od_line_sum int, line_count int")
    user = spark.createDataFrame([("u", 4, True)], "user_id string, u_x int, u_has_counters boolean")
    tips = spark.createDataFrame([("u", "b", 5)], "user_id string, business_id string, t_likes int")
    joined = lookup(ratings, business, user, tips)
    assert joined.columns == ["user_id", "business_id", "rating", "label", "b_x", "u_x", "t_likes"]
    assert sorted(tuple(r) for r in joined.collect()) == [("u", "b", 1.0, 1.0, 3, 4, 5), ("v", None, 2.0, 2.0, None, None, None)]
    conditions = [x for x in _plan(joined).splitlines() if "Join LeftOuter" in x]
    assert " AND " in conditions[-1] and not any(" AND " in x for x in conditions[:-1])  # the pair join is the innermost


def test_join_queries_read_the_rated_rows_from_a_table(spark):
    assert "l_orderkey" not in _plan(QUERIES["join_tip"](spark, SF_SMALL))


def test_rounding_keeps_what_has_six_places(spark):
    values = [0.0, -0.0, 1.0, -3.0, 0.1, 2.675, 1 / 3, -2 / 3, 1e-7, 5e-7, 1.5e-6, 2.0000005, 24.994521, 123456789.123456, 999999999.9999995,
              1e9, 4294967296.1234567, 9007199254740993.0, 1e23, 1e300, math.inf, -math.inf, math.nan, None]
    values += [i / 365.0 for i in range(400)] + [i / 1000000.0 for i in range(0, 5000000, 12345)]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    wrong = df.select("x", _rounded(F.col("x")).alias("a"), F.round("x", 6).alias("b")).filter("NOT a <=> b").collect()
    assert wrong == []
    zeros = canonical(spark.createDataFrame([(-0.0,)], "x double")).first()["x"]
    assert math.copysign(1, zeros) == 1


def test_only_a_table_of_bounded_shares_is_hashed(spark):
    hashed = lambda files: "shuffle_hash" in hash_if_bounded(spark.range(10), files)._jdf.queryExecution().analyzed().toString()
    most = HASH_MAX_BYTES * int(spark.conf.get("spark.sql.shuffle.partitions")) // EXPANSION
    assert [hashed(n) for n in (None, BROADCAST_MAX_BYTES // EXPANSION, BROADCAST_MAX_BYTES // EXPANSION + 1, most, most + 1)] == [False, False, True, True, False]


def test_business_and_user_lines_are_parsed_into_a_table(spark):
    folder, names = new_run_folder(spark), []

    def store(df, name):
        names.append(name)
        return materialize(df, folder, name)

    dims = build_dimensions(_inputs(spark, ["u1,b1,3.0"]), store=store)
    assert names.index("business_rows") < names.index("area_dim") and names.index("user_rows") < names.index("user_dim")
    assert dims.business.count() and dims.user.count()


def test_photos_are_counted_before_the_wide_reduce(spark):
    assert "count(1) AS ph" in _plan(build_dimensions(_inputs(spark, ["u1,b1,3.0"])).business)


def test_checkin_slots_are_dealt_by_part_as_numbers(spark):
    assert "RepartitionByExpression [l_partkey" in _plan(checkin_lines(spark, SF_SMALL))
