"""The test-table adapter reads whole tables, and the plans that were reworked for fewer scans."""

from helpers import SF_SMALL
from rateflow.operators import business as biz
from rateflow.plans.queries import QUERIES
from rateflow.sources.tables import inputs_from_tables


def test_every_part_and_customer_has_a_line(spark):
    full, gaps = inputs_from_tables(spark, SF_SMALL), inputs_from_tables(spark, SF_SMALL, gaps=True)
    read = lambda name: spark.read.parquet(f"{SF_SMALL}/{name}.parquet").count()
    assert full.business.count() == read("part") > gaps.business.count()
    assert full.user.count() == read("customer") > gaps.user.count()
    assert full.photo.count() == read("lineitem") > gaps.photo.count()


def test_area_lookup_scans_part_twice_and_imputed_days_once(spark):
    inp = inputs_from_tables(spark, SF_SMALL, gaps=True)
    plan = biz.area_lookup(biz.business_rows(inp.business), inp.photo, inp.checkin)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("p_brand") and sum("Relation" in line and "p_partkey" in line for line in plan.splitlines()) <= 2
    days = QUERIES["open_days_imputed"](spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert "p_partkey" not in days  # read from the one reduced table
