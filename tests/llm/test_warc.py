"""WARC archives: records, index, coalesced reads."""

import base64
import hashlib
from collections import Counter

import pytest

from rateflow.llm import op3_warc as op3
from rateflow.llm.common import new_run_folder

SCHEMA = "page_id bigint, url string, html string"


def digest(html):
    return base64.b32encode(hashlib.sha1((html or "").encode()).digest()).decode()


def brute(rows, least=0):
    out = []
    for i, _, html in rows:
        same = [j for j, _, h in rows if (h or "") == (html or "") and j is not None]
        keeper = max(same) if same and len((html or "").encode()) >= least else None
        revisit = keeper is not None and (i is None or i < keeper)
        out.append((i, len((html or "").encode()), digest(html), "revisit" if revisit else "response", keeper if revisit else None))
    return Counter(out)


ROWS = [
    (1, "http://a/1", "<p>one</p>"), (2, "http://a/2", "<p>two</p>\r\n\r\nx"), (3, None, "<p>one</p>"), (4, "http://a/ \n4", None), (5, "http://a/5", ""),
    (7, "http://a/7", "<p>one</p>"), (7, "http://a/7", "<p>one</p>"), (None, "http://n", "<p>one</p>"), (None, "http://n", "alone"),
    (9, "http://a/9", "é" * 200_000), (10, "http://a/10", "WARC/1.1\r\nContent-Length: 3\r\n\r\n\x00\x1f\x8b"),
]


@pytest.mark.parametrize("least", [0, 5])
def test_round_trip_matches_brute_force(spark, least):
    pages = spark.createDataFrame(ROWS, SCHEMA).selectExpr("*", "url AS file", "page_id AS key", "page_id AS offset")
    folder = new_run_folder(spark)
    index = op3.write_archives(op3.mark_revisits(pages, min_revisit=least), folder)
    got = op3.read_records(index, folder).collect()
    assert Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got) == brute(ROWS, least)
    held = Counter((r.page_id, bytes(r.payload).decode()) for r in got if r.record_type == "response")
    assert held == Counter((i, h or "") for (i, _, h) in ROWS for k, n in brute(ROWS, least).items() if k[0] == i and k[2] == digest(h) and k[3] == "response")


def test_selected_records_only(spark):
    folder = new_run_folder(spark)
    index = op3.write_archives(op3.mark_revisits(spark.createDataFrame(ROWS, SCHEMA)), folder)
    assert index.count() == len(ROWS) and set(index.columns) >= {"offset", "length", "url", "digest"}
    got = op3.read_records(index.where("page_id IN (2, 9)"), folder).collect()
    assert sorted((r.page_id, r.payload_digest) for r in got) == [(2, digest(ROWS[1][2])), (9, digest(ROWS[9][2]))]


def test_no_pages(spark):
    folder = new_run_folder(spark)
    index = op3.write_archives(op3.mark_revisits(spark.createDataFrame([], SCHEMA)), folder)
    assert index.count() == 0 and op3.read_records(index, folder).count() == 0


def test_neighbouring_places_are_one_read():
    places = [("a", 0, 10), ("a", 10, 5), ("a", 20, 5), ("a", 20 + op3.GAP + 6, 5), ("b", 0, 3), ("b", 3, op3.READ_BYTES), ("b", 3 + op3.READ_BYTES, 1)]
    got = list(op3.ranges(places))
    assert [(f, b, e, len(i)) for f, b, e, i in got] == [
        ("a", 0, 25, 3), ("a", 26 + op3.GAP, 31 + op3.GAP, 1), ("b", 0, 3, 1), ("b", 3, 3 + op3.READ_BYTES, 1), ("b", 3 + op3.READ_BYTES, 4 + op3.READ_BYTES, 1),
    ]
    assert list(op3.ranges([])) == []


def test_a_damaged_record_is_refused():
    good = op3.make_record(1, "http://a", b"payload", digest("payload"), None, False)
    assert op3.parse_record(good)["payload"] == b"payload"
    bad = op3.make_record(1, "http://a", b"payload", digest("other"), None, False)
    with pytest.raises(ValueError):
        op3.parse_record(bad)
