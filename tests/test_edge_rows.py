"""Hand-made input lines with the values the job produces for them."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from helpers import lines
from rateflow.operators import business as biz
from rateflow.operators import interactions as ix
from rateflow.operators import user as usr
from rateflow.operators.standardize import standardize
from rateflow.sources.csv_ratings import parse_rating_lines, training_rows
from rateflow.sources.json_lines import parse_json_lines
from rateflow.sources.schemas import BUSINESS


def _biz(spark, *texts, parity=False):
    rows = biz.business_rows(lines(spark, *texts), parity)
    return {r["business_id"]: r for r in rows.collect()}


def test_capability_score_counts_true_in_raw_line_and_categories(spark):
    line = (
        '{"business_id":"b1","attributes":{"BikeParking":"True",'
        '"BusinessParking":"{\'garage\': False, \'lot\': True}"},'
        '"categories":"Hair, Men\'s Clothing, True Bar"}'
    )
    got = _biz(spark, line, '{"business_id":"b2","attributes":null,"categories":null}')
    assert got["b1"]["attr_score"] == 6
    assert got["b2"]["attr_score"] == 0


def test_open_and_weekend_days(spark):
    got = _biz(
        spark,
        '{"business_id":"null_h","hours":null}',
        '{"business_id":"empty_h","hours":{}}',
        '{"business_id":"absent_h"}',
        '{"business_id":"text_null","hours":"null"}',
        '{"business_id":"fri_mon","hours":{"Friday":"9-5","Monday":"9-5"}}',
    )
    for key in ("null_h", "empty_h", "absent_h", "text_null"):
        assert got[key]["open_days"] == 0
    assert got["fri_mon"]["open_days"] == 2
    assert got["fri_mon"]["weekend_days"] == 1
    assert got["null_h"]["weekend_days"] == 2
    assert got["empty_h"]["weekend_days"] == 2


def test_open_days_zero_becomes_line_mean(spark):
    rows = biz.business_rows(
        lines(
            spark,
            '{"business_id":"a","hours":{"Monday":"1"}}',
            '{"business_id":"b","hours":{"Monday":"1","Tuesday":"1","Friday":"1"}}',
            '{"business_id":"c"}',
        )
    )
    got = {r["business_id"]: r["open_days"] for r in biz.open_days_imputed(rows).collect()}
    assert got == {"a": 1.0, "b": 3.0, "c": pytest.approx(4 / 3)}


def test_price_noise_wifi(spark):
    got = _biz(
        spark,
        '{"business_id":"p","attributes":{"RestaurantsPriceRange2":"2","NoiseLevel":"very_loud","WiFi":"free"}}',
        '{"business_id":"q","attributes":{"WiFi":"paid"}}',
        '{"business_id":"r","attributes":{"WiFi":"no","NoiseLevel":"quiet"}}',
        '{"business_id":"s","attributes":null}',
    )
    assert [got[k]["price"] for k in "pqrs"] == [2, -1, -1, -1]
    assert [got[k]["noise"] for k in "pqrs"] == [5, 3, 1, 3]
    assert [got[k]["wifi"] for k in "pqrs"] == [1, 2, 0, 0]
    as_written = _biz(spark, '{"business_id":"p","attributes":{"WiFi":"free"}}', parity=True)
    assert as_written["p"]["wifi"] == 0


def test_unknown_noise_level_stops_the_job(spark):
    rows = biz.business_rows(lines(spark, '{"business_id":"x","attributes":{"NoiseLevel":"deafening"}}'))
    with pytest.raises(Exception, match="NoiseLevel"):
        rows.collect()


def test_is_open_and_review_count(spark):
    got = _biz(
        spark,
        '{"business_id":"o1","is_open":1,"review_count":0}',
        '{"business_id":"o0","is_open":0,"review_count":""}',
        '{"business_id":"oa","review_count":12}',
    )
    assert [got[k]["is_open"] for k in ("o1", "o0", "oa")] == [1, 0, 0]
    rows = biz.business_rows(
        lines(
            spark,
            '{"business_id":"o1","review_count":0}',
            '{"business_id":"oa","review_count":12}',
        )
    )
    kept = {r["business_id"]: r["review_count"] for r in biz.business_feature(rows, "review_count").collect()}
    assert kept == {"oa": 12}


def test_checkin_totals_skip_empty_maps(spark):
    got = biz.checkin_total(
        lines(
            spark,
            '{"business_id":"c1","time":{"Sat-6":1,"Sun-22":3}}',
            '{"business_id":"c2","time":{}}',
        )
    ).collect()
    assert {r["business_id"]: r["checkins"] for r in got} == {"c1": 4}


def test_rivals_count_distinct_businesses(spark):
    rows = biz.business_rows(
        lines(
            spark,
            '{"business_id":"a","postal_code":"123"}',
            '{"business_id":"b","postal_code":"123"}',
            '{"business_id":"a","postal_code":"123"}',
            '{"business_id":"c","postal_code":""}',
        )
    )
    got = {r["postal_code"]: r["rivals"] for r in biz.rivals_per_area(rows).collect()}
    assert got == {"123": 2, "": 1}


def test_last_line_wins(spark):
    rows = biz.business_rows(
        lines(
            spark,
            '{"business_id":"a","stars":2.0}',
            '{"business_id":"a","stars":4.5}',
        )
    )
    got = biz.business_feature(rows, "stars").collect()
    assert [(r["business_id"], r["stars"]) for r in got] == [("a", 4.5)]


def _users(spark, *texts, as_of=dt.date(2017, 1, 1), parity=False):
    dim = usr.user_dim(usr.user_rows(lines(spark, *texts), as_of, parity))
    return {r["user_id"]: r for r in dim.collect()}


def test_user_filter_keeps_age_and_friends(spark):
    full = (
        '{"user_id":"u1","review_count":3,"fans":2,"useful":1,"average_stars":4.5,'
        '"yelping_since":"2016-01-01","friends":"a, b, c"}'
    )
    no_fans = '{"user_id":"u2","review_count":3,"fans":"","useful":1,"average_stars":4.5,"friends":"None"}'
    zero_reviews = '{"user_id":"u3","review_count":0,"fans":1,"useful":1,"average_stars":4.5}'
    got = _users(spark, full, no_fans, zero_reviews)
    assert got["u1"]["u_has_counters"] and got["u1"]["u_fans"] == 2
    assert not got["u2"]["u_has_counters"] and got["u2"]["u_fans"] is None
    assert not got["u3"]["u_has_counters"]
    assert got["u1"]["u_age"] == pytest.approx(366 / 365)
    assert got["u2"]["u_age"] == 0.0
    assert [got[k]["u_friends"] for k in ("u1", "u2", "u3")] == [3, 0, 0]
    as_written = _users(spark, full, parity=True)
    assert as_written["u1"]["u_friends"] == 1


def test_tip_likes_sum_with_missing(spark):
    got = ix.tip_likes(
        lines(
            spark,
            '{"user_id":"u","business_id":"b","likes":2}',
            '{"user_id":"u","business_id":"b","likes":null}',
            '{"user_id":"u","business_id":"b","likes":1}',
        )
    ).collect()
    assert [(r["user_id"], r["business_id"], r["t_likes"]) for r in got] == [("u", "b", 3)]


def test_population_variance(spark):
    ratings = parse_rating_lines(
        lines(spark, "user_id,business_id,stars", "u,b,1", "v,b,2", "w,b,4"), None
    )
    got = ix.rating_variance(ratings, "business_id").first()["rating_var"]
    assert got == pytest.approx(14 / 9)


def test_repeated_header_lines_are_all_dropped(spark):
    ratings = parse_rating_lines(
        lines(spark, "user_id,business_id,stars", "u,b,3.0", "user_id,business_id,stars", "v,c,0.0", "w")
    )
    rows = ratings.collect()
    assert [r["user_id"] for r in rows] == ["u", "v", "w"]
    assert [r["user_id"] for r in training_rows(ratings).collect()] == ["u"]


def test_standardize_constant_column(spark):
    df = spark.createDataFrame([(5.0, 1.0), (5.0, 2.0), (5.0, 4.0)], "a double, b double")
    out, _ = standardize(df, None, ["a", "b"])
    got = out.collect()
    assert [r["a"] for r in got] == [0.0, 0.0, 0.0]
    assert sum(r["b"] for r in got) == pytest.approx(0.0)
    # population sd of 1, 2, 4 is sqrt(14/9)
    assert got[0]["b"] == pytest.approx((1 - 7 / 3) / (14 / 9) ** 0.5)


def test_malformed_json_fails_fast_and_permissive_keeps_it(spark):
    bad = lines(spark, '{"business_id":"a"}', "bad")
    with pytest.raises(Exception, match="MALFORMED"):
        parse_json_lines(bad, BUSINESS).collect()
    kept = parse_json_lines(bad, BUSINESS, mode="PERMISSIVE").select("_corrupt_record").collect()
    assert [r[0] for r in kept] == [None, "bad"]


def test_single_quotes_are_deleted_before_parsing(spark):
    got = parse_json_lines(lines(spark, '{"business_id":"it\'s","categories":"Men\'s"}'), BUSINESS)
    row = got.first()
    assert (row["business_id"], row["categories"]) == ("its", "Mens")
    assert got.select(F.col("_seq")).first()[0] == 0
