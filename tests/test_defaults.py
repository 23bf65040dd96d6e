"""Lookups with mean defaults (J01-J05) and the as-written switches (Q1-Q6)."""

import pytest

from helpers import lines
from rateflow.plans.features import FEATURES_29, FEATURES_32, build_dimensions, feature_matrix
from rateflow.sources.csv_ratings import parse_rating_lines, training_rows
from rateflow.sources.inputs import Inputs

BUSINESS = [
    '{"business_id":"b1","postal_code":"z1","stars":4.0,"review_count":10,"is_open":0,'
    '"attributes":{"NoiseLevel":"loud","WiFi":"free","RestaurantsPriceRange2":"3"},'
    '"categories":"A, B","hours":{"Friday":"1","Saturday":"1"}}',
    '{"business_id":"b2","postal_code":"z1","stars":2.0,"review_count":0,"is_open":1}',
]
USERS = [
    '{"user_id":"u1","review_count":5,"fans":1,"useful":2,"average_stars":3.0,"funny":1,"cool":2,'
    '"compliment_cool":3,"compliment_funny":4,"compliment_list":5,"compliment_note":6,'
    '"compliment_more":7,"compliment_photos":8,"compliment_profile":9,"compliment_writer":10,'
    '"compliment_cute":11,"compliment_plain":12,"compliment_hot":13,'
    '"yelping_since":"2020-01-01","friends":"x, y"}',
    '{"user_id":"u2","review_count":1,"fans":3,"useful":4,"average_stars":5.0,"funny":3,"cool":4,'
    '"compliment_cool":5,"compliment_funny":6,"compliment_list":7,"compliment_note":8,'
    '"compliment_more":9,"compliment_photos":10,"compliment_profile":11,"compliment_writer":12,'
    '"compliment_cute":13,"compliment_plain":14,"compliment_hot":15,'
    '"yelping_since":"2021-01-01","friends":"None"}',
]


def _inputs(spark, ratings):
    return Inputs(
        business=lines(spark, *BUSINESS),
        user=lines(spark, *USERS),
        photo=lines(spark, '{"business_id":"b1"}', '{"business_id":"b1"}'),
        checkin=lines(spark, '{"business_id":"b1","time":{"Fri-1":2}}'),
        tip=lines(spark, '{"user_id":"u1","business_id":"b1","likes":4}'),
        review=lines(spark, '{"user_id":"u1","business_id":"b1","stars":4}'),
        train=lines(spark, "user_id,business_id,stars", *ratings),
        val=lines(spark, "user_id,business_id,stars"),
    )


def _matrix(spark, ratings, parity=False, features=FEATURES_29):
    inp = _inputs(spark, ratings)
    dims = build_dimensions(inp, parity=parity)
    rows = training_rows(parse_rating_lines(inp.train))
    return {(r["user_id"], r["business_id"]): r for r in feature_matrix(rows, dims, features).collect()}


def test_known_keys_take_their_values(spark):
    got = _matrix(spark, ["u1,b1,4.0"])[("u1", "b1")]
    assert got["user_avg_rating"] == 3.0
    assert got["business_avg_rating"] == 4.0
    assert got["reviews"] == 10.0
    assert got["is_open"] == 0.0
    assert got["avg_noise"] == 4.0 and got["has_WiFi"] == 1.0 and got["business_price"] == 3.0
    assert got["checkins"] == 2.0 and got["photo"] == 2.0 and got["avg_user_business_like"] == 4.0
    assert got["business_score"] == 2.0  # two businesses in area z1
    assert got["avg_friends"] == 2.0
    assert got["avg_weekend_days"] == 2.0 and got["business_open"] == 2.0


def test_unknown_keys_take_means(spark):
    got = _matrix(spark, ["u9,b9,4.0"])[("u9", "b9")]
    assert got["user_avg_rating"] == pytest.approx(4.0)  # mean user average_stars
    assert got["business_avg_rating"] == pytest.approx(3.0)  # mean business stars
    assert got["is_open"] == 1.0
    assert got["reviews"] == 10.0  # b2's zero count is left out of the mean
    assert got["avg_user_business_like"] == 4.0
    assert got["business_score"] == 2.0  # one area with 2 businesses
    assert got["compliment_cool"] == pytest.approx(4.0)
    assert got["avg_friends"] == pytest.approx(1.0)
    # open days: b1 has 2, b2 has 0 -> line mean 1.0 replaces b2's 0 -> key mean 1.5
    assert got["business_open"] == pytest.approx(1.5)


def test_zero_open_days_take_the_line_mean(spark):
    got = _matrix(spark, ["u1,b2,4.0"])[("u1", "b2")]
    assert got["business_open"] == pytest.approx(1.0)
    assert got["reviews"] == 10.0  # review count 0 is not in the dict: default mean


def test_as_written_defaults(spark):
    got = _matrix(spark, ["u9,b9,4.0"], parity=True, features=FEATURES_32)[("u9", "b9")]
    assert got["user_avg_rating"] == pytest.approx(3.0)  # mean business stars (Q4)
    assert got["business_avg_rating"] == pytest.approx(4.0)  # mean user stars (Q4)
    assert got["compliment_cool"] == pytest.approx(3.0)  # mean cool (Q5)
    assert got["compliment_funny"] == pytest.approx(4.0)  # mean compliment_cool (Q5)
    assert got["compliment_list"] == pytest.approx(5.0)  # mean compliment_funny (Q5)
    assert got["compliment_hot"] == pytest.approx(14.0)
    assert got["business_score"] == 2.0  # constant (Q2)
    known = _matrix(spark, ["u1,b1,4.0"], parity=True)[("u1", "b1")]
    assert known["has_WiFi"] == 0.0  # Q1
    assert known["business_score"] == 2.0  # lookup never matches (Q2)
    assert known["avg_friends"] == 1.0  # Q3
