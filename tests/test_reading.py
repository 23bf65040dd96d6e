"""File order, headers, strict parsing, and which rows count: on files and hand-made lines."""

import pytest
from pyspark.sql import functions as F

from helpers import lines
from rateflow.functions.business import is_open_flag, review_count_value
from rateflow.functions.missing import as_number
from rateflow.operators.dedupe import last_wins
from rateflow.operators.interactions import rating_mean_group, rating_variance
from rateflow.plans.evaluate import error_histogram, preview_from_end, preview_key, rmse
from rateflow.sources.csv_ratings import parse_rating_lines, rated_rows, training_rows, val_frame
from rateflow.sources.json_lines import parse_json_lines
from rateflow.sources.schemas import BUSINESS, BUSINESS_KEYS, PHOTO, PHOTO_KEYS
from rateflow.sources.text import SEQ, first_line, read_lines


def _folder(tmp_path, *parts):
    for i, text in enumerate(parts):
        (tmp_path / f"part-{i:05d}").write_text(text, encoding="utf-8")
    return str(tmp_path)


@pytest.mark.parametrize("more", [0, 20])
def test_order_follows_file_names_not_sizes(spark, tmp_path, more):
    """A small file first by name and a large one behind it; with ``more``, many files."""
    parts = ['{"business_id":"b","stars":"1"}\n', "".join('{"business_id":"b","stars":"%d"}\n' % i for i in range(2, 53))]
    parts += ['{"business_id":"b","stars":"%d"}\n' % (100 + i) for i in range(more)]
    read = read_lines(spark, _folder(tmp_path, *parts))
    assert first_line(read) == '{"business_id":"b","stars":"1"}'
    parsed = parse_json_lines(read, BUSINESS)
    last = last_wins(parsed, "business_id", ["stars"]).first()["stars"]
    assert last == str(100 + more - 1 if more else 52)
    assert [r["stars"] for r in parsed.orderBy(SEQ).limit(3).collect()] == ["1", "2", "3"]


def test_header_of_several_files_is_the_first_line_of_the_first(spark, tmp_path):
    folder = _folder(tmp_path, "", "u,b,s\n", "".join(f"u{i},b,3.0\n" for i in range(40)) + "u,b,s\n")
    rows = parse_rating_lines(read_lines(spark, folder))
    assert rows.count() == 40 and rows.filter("user_id = 'u'").count() == 0


def test_a_rating_of_zero_counts_in_variance_and_mean(spark):
    body = parse_rating_lines(lines(spark, "u,b,s", "u,b,0", "v,b,4", "w,b"), "u,b,s")
    assert rating_variance(rated_rows(body), "business_id").first()["rating_var"] == 4.0
    assert rating_mean_group(rated_rows(body), "business_id").first()["rating_mean"] == 2.0
    assert training_rows(body).count() == 1


@pytest.fixture(params=["true", "false"])
def ansi(spark, request):
    """Strictness must not depend on the session's ANSI setting."""
    was = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", request.param)
    yield
    spark.conf.set("spark.sql.ansi.enabled", was)


@pytest.mark.parametrize("bad", ["", "   ", '{"photo_id":"x"}'])
def test_blank_lines_and_missing_keys_stop_the_job(spark, ansi, bad):
    df = parse_json_lines(lines(spark, '{"business_id":"b"}', bad), PHOTO, required=PHOTO_KEYS)
    with pytest.raises(Exception, match="blank line|no key business_id"):
        df.collect()


def test_a_null_value_of_a_required_key_is_allowed(spark):
    df = parse_json_lines(lines(spark, '{"business_id":null,"stars":3}'), BUSINESS, required=BUSINESS_KEYS)
    assert [r["business_id"] for r in df.collect()] == [None]


def test_permissive_keeps_blank_lines(spark):
    assert parse_json_lines(lines(spark, "", '{"business_id":"b"}'), PHOTO, mode="PERMISSIVE").count() == 2


def test_whole_numbers_as_decimals_and_flags_as_booleans(spark, ansi):
    df = lines(spark, '{"review_count":10.0,"is_open":true}', '{"review_count":"7","is_open":false}', '{"review_count":"","is_open":1}')
    rows = parse_json_lines(df, BUSINESS).select(review_count_value().alias("n"), is_open_flag().alias("o")).collect()
    assert [tuple(r) for r in rows] == [(10, 1), (7, 0), (None, 1)]


@pytest.mark.parametrize("dtype", ["double", "bigint", "int"])
def test_a_malformed_number_stops_the_job(spark, ansi, dtype):
    df = spark.createDataFrame([("1",), ("",), (None,)], "x string")
    assert [r[0] for r in df.select(as_number("x", dtype)).collect()] == [1, None, None]
    with pytest.raises(Exception, match="not a number"):
        spark.createDataFrame([("1x",)], "x string").select(as_number("x", dtype)).collect()


def test_rmse_counts_labelled_rows_only(spark):
    frame = val_frame(lines(spark, "h", "u,b,3.0", "v,b"), "h")
    assert [tuple(r) for r in frame.orderBy("user_id").collect()] == [("u", "b", 3.0), ("v", "b", None)]
    pred = frame.withColumn("label", F.col("original_rating")).withColumn("prediction", F.lit(2.0))
    row = rmse(pred).first()
    assert (row["rmse"], row["n"]) == (1.0, 1)
    assert sum(r["n"] for r in error_histogram(pred).collect()) == 1


def test_previews_from_the_end_and_by_key(spark):
    df = spark.range(20).withColumn("x", F.col("id") * 2)
    assert preview_from_end(df, ["id"]).first()["id"] == 19
    assert preview_from_end(df, ["id"], 5).first()["id"] == 15
    assert preview_key(df, "id", 7).first()["x"] == 14


def test_rating_filters_do_not_render_or_parse_the_line_again(spark):
    made = spark.range(4).select(F.concat_ws(",", F.col("id").cast("string"), F.lit("b"), F.col("id").cast("string")).alias("value"))
    kept = training_rows(parse_rating_lines(made, "user_id,business_id,stars"))
    assert kept._jdf.queryExecution().optimizedPlan().toString().count("concat_ws") <= 2
    assert sorted(r["user_id"] for r in kept.collect()) == ["1", "2", "3"]
