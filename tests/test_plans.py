"""What plans write, and what they leave behind."""

import os

import pytest
from pyspark.sql import functions as F

from curbstar import fixed_values as fv
from curbstar.plans import catalog, enforcement
from curbstar.plans.trade import Trade
from curbstar.sources.store import Store

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no trade tables")


def written(store):
    return sorted(os.path.join(layer, t) for layer in os.listdir(store.root) for t in os.listdir(f"{store.root}/{layer}"))


@pytest.mark.parametrize("name", ["dim_location", "dim_type", "dim_stop"])
def test_planning_twice_gives_two_valid_results(spark, name):
    t = Trade(spark, SF_DIR)
    first, second = t.plan(name), t.plan(name)
    assert sorted(first.collect()) == sorted(second.collect())
    assert written(t.store) == []


def test_a_report_writes_no_staging(spark):
    t = Trade(spark, SF_DIR)
    t.series("dim_location", "location_key", "dim_location")
    assert written(t.store) == ["marts/dim_location"]


def test_totals_write_nothing(spark):
    e = catalog.enforcement_plan(spark, SF_DIR)
    assert e.total_complaints().count() == e.total_violations().count() == 1
    assert written(e.store) == []


def test_helpers_stay_out_of_the_catalog(spark):
    store = Store(spark, catalog=True)
    before = {d.name for d in spark.catalog.listDatabases()}
    Trade(spark, SF_DIR, store).plan("dim_type")
    assert {d.name for d in spark.catalog.listDatabases()} == before


@pytest.mark.parametrize("in_catalog", [False, True])
def test_an_opened_warehouse_reports_without_extracts(spark, tmp_path, in_catalog):
    store = Store(spark, catalog=True) if in_catalog else Store(spark, str(tmp_path))
    feeds = catalog.enforcement_plan(spark, SF_DIR).sources
    built = enforcement.Enforcement(store, feeds)
    built.build()
    opened = enforcement.Enforcement.open(store)
    for name in ("by_borough", "by_year", "type_share_by_borough", "total_complaints"):
        found = getattr(opened, name)().collect()
        assert found and found == getattr(built, name)().collect()


def test_the_calendar_window_is_a_parameter(spark):
    feeds = dict(catalog.enforcement_plan(spark, SF_DIR).sources)
    name, late = "source_nyc_311_traffic", F.lit("2026-12-31T10:00:00")
    feeds[name] = feeds[name].withColumn("created_date", late)

    def complaints(**window):
        e = enforcement.Enforcement(Store.scratch(spark), feeds)
        for option, value in window.items():
            setattr(e, option, value)
        return e.total_complaints().first()[0], [
            r.event_count
            for r in e.by_date("month", "day").where("month = 12 and day = 31").collect()
            if r.series == fv.COMPLAINT_SERIES
        ]

    total, lost = complaints()
    assert total and not lost
    total, found = complaints(calendar_start="2026-01-01 00:00:00", calendar_hours=8759)
    assert found == [total]
