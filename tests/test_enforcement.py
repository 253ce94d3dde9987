"""The complaints-versus-cameras pipeline on hand-built extracts."""

from datetime import datetime

import pytest

from curbstar.operators.quality import run_checks
from curbstar.plans.enforcement import CHECKS, Enforcement

COMPLAINT = {
    "created_date": "2025-03-14T08:59:59.000",
    "agency": "NYPD",
    "complaint_type": "Illegal Parking",
    "descriptor": "Blocked Hydrant",
    "status": "Open",
    "borough": "Bronx",
    "incident_zip": "10451",
    "community_board": "01 BRONX",
    "council_district": "8",
    "latitude": "40.8",
    "longitude": "-73.9",
}
COMPLAINTS = [
    {"unique_key": "1"},
    {"unique_key": "abc"},
    {"unique_key": "2", "created_date": "not a date"},
    {"unique_key": "3", "closed_date": "bad"},
    {"unique_key": "4", "borough": None},
    {"unique_key": "5", "complaint_type": "Noise"},
    {"unique_key": "6", "complaint_type": "illegal parking"},
    {"unique_key": "7", "council_district": "x", "latitude": ""},
    # An open version and a later closed one.
    {"unique_key": "8"},
    {"unique_key": "8", "closed_date": "2025-03-15T00:00:00", "status": "Closed"},
    # The newer version is invalid, so the older one stays.
    {"unique_key": "9", "status": "Open"},
    {"unique_key": "9", "status": "Closed", "created_date": "2025/03/20", "closed_date": "2025-03-21"},
    # Same location as the camera events of the borough.
    {"unique_key": "10", "incident_zip": None, "community_board": None, "council_district": None},
    {"unique_key": "11", "descriptor": None, "agency": None},
    {"unique_key": "12", "created_date": "2026-12-31T12:00:00"},
    *[{"unique_key": str(20 + i), "complaint_type": t} for i, t in enumerate(
        ["Blocked Driveway", "Double Parked Blocking Vehicle", "Double Parked Blocking Traffic",
         "Blocked Bike Lane", "Posted Parking Sign Violation"])],
]
VIOLATION = {
    "first_occurrence": "2025-03-14T10:00:00.000",
    "last_occurrence": "2025-03-14T10:01:59.000",
    "violation_type": "MOBILE BUS STOP",
    "violation_status": "VIOLATION ISSUED",
    "bus_route_id": "Bx12",
    "stop_id": "100",
    "stop_name": "A ST",
    "bus_stop_latitude": "40.5",
}
VIOLATIONS = [
    {"violation_id": "a"},
    {"violation_id": None},
    {"violation_id": "b", "bus_route_id": None},
    {"violation_id": "c", "first_occurrence": "bad"},
    {"violation_id": "d", "last_occurrence": None},
    {"violation_id": "d", "last_occurrence": "2025-03-14T11:00:00"},
    {"violation_id": "e", "stop_id": None},
    {"violation_id": "f", "stop_name": "B ST", "bus_stop_latitude": None},
    {"violation_id": "g", "violation_status": None, "bus_route_id": "BxM1"},
    {"violation_id": "h", "last_occurrence": None, "bus_route_id": "X27"},
    {"violation_id": "i", "last_occurrence": "2025-03-14T09:58:30", "bus_route_id": ""},
    {"violation_id": "j", "violation_type": "MOBILE BUS LANE"},
]


@pytest.fixture(scope="module")
def plan(spark):
    from curbstar.sources.schemas import RAW_TABLES, all_text
    from curbstar.sources.store import Store

    def extract(table, rows, default):
        columns = RAW_TABLES[table]
        return spark.createDataFrame([tuple({**default, **r}.get(c) for c in columns) for r in rows], all_text(columns))

    sources = {
        "source_nyc_311_traffic": extract("source_nyc_311_traffic", COMPLAINTS, COMPLAINT),
        "source_mta_ace_violations": extract("source_mta_ace_violations", VIOLATIONS, VIOLATION),
    }
    return Enforcement(Store.scratch(spark), sources)


def by(df, key):
    return {r[key]: r for r in df.collect()}


def test_staged_complaints(plan):
    staged = by(plan.table("stg_311"), "complaint_id")
    assert set(staged) == {1, 3, 7, 8, 9, 10, 11, 12, 20, 21, 22, 23, 24}
    assert staged[1].borough == "BRONX" and staged[1].created_at == datetime(2025, 3, 14, 8, 59, 59)
    assert staged[3].closed_at is None
    assert staged[7].council_district is None and staged[7].latitude is None
    assert staged[8].status == "Closed" and staged[9].status == "Open"
    assert plan.table("stg_311").columns == (
        "complaint_id created_at closed_at agency complaint_type problem_detail status borough zip_code "
        "neighborhood council_district latitude longitude".split()
    )


def test_staged_violations(plan):
    staged = by(plan.table("stg_ace"), "violation_id")
    assert set(staged) == set("adefghij")
    boroughs = {k: r.borough for k, r in staged.items()}
    assert (boroughs["a"], boroughs["g"], boroughs["h"], boroughs["i"]) == ("BRONX", "BRONX", "EXPRESS", "UNKNOWN")
    assert staged["d"].last_occurrence == datetime(2025, 3, 14, 11)
    assert plan.table("stg_ace").columns == (
        "violation_id first_occurrence last_occurrence violation_category violation_status bus_route_id stop_id "
        "stop_name violation_latitude violation_longitude bus_stop_latitude bus_stop_longitude borough zip_code "
        "neighborhood council_district".split()
    )


def test_dimensions(plan):
    locations = plan.table("dim_location").orderBy("location_key").collect()
    assert [r.location_key for r in locations] == list(range(1, len(locations) + 1))
    assert tuple(locations[0]) == (1, "BRONX", None, None, None)
    stop = plan.table("dim_bus_stop").collect()
    assert [tuple(r) for r in stop] == [(1, "100", "A ST", 40.5, None)]
    assert {r.agency_name for r in plan.table("dim_bus_route").collect()} == {"MTA"}
    kinds = plan.table("dim_ace_violation_type").orderBy("violation_type_key").collect()
    assert [r.violation_status for r in kinds] == ["VIOLATION ISSUED", None, "VIOLATION ISSUED"]


def test_fact_complaints(plan):
    fact = by(plan.table("fact_311_complaints"), "unique_key")
    assert len(fact) == plan.table("stg_311").count() == plan.table("fact_311_complaints").count()
    assert fact[1].date_key == 2025031408
    assert all(r.location_key and r.problem_key for r in fact.values())
    assert fact[10].location_key == 1
    assert plan.table("fact_311_complaints").columns == (
        "unique_key date_key location_key problem_key latitude longitude status created_date".split()
    )


def test_fact_violations(plan):
    fact = by(plan.table("fact_ace_violations"), "violation_id")
    assert {k: r.duration_minutes for k, r in fact.items()} == {
        "a": 1, "d": 60, "e": 1, "f": 1, "g": 1, "h": None, "i": -1, "j": 1,
    }
    assert fact["e"].bus_stop_key is None and fact["a"].bus_stop_key == 1
    assert fact["g"].violation_type_key is not None
    assert fact["a"].location_key == 1
    assert plan.table("fact_ace_violations").columns == (
        "violation_id date_key location_key violation_type_key route_key bus_stop_key violation_latitude "
        "violation_longitude first_occurrence last_occurrence duration_minutes".split()
    )


def test_reports(plan):
    boroughs = [tuple(r) for r in plan.by_borough().collect()]
    assert boroughs == [
        ("BRONX", "311 Complaints", 13),
        ("BRONX", "ACE Violations", 6),
        ("EXPRESS", "ACE Violations", 1),
        ("UNKNOWN", "ACE Violations", 1),
    ]
    # The complaint after the calendar's end drops out of the date reports.
    assert [tuple(r) for r in plan.by_year().collect()] == [(2025, "311 Complaints", 12), (2025, "ACE Violations", 8)]
    assert [str(r.month_start) for r in plan.by_month().collect()] == ["2025-03-01", "2025-03-01"]
    assert {r.day_of_week for r in plan.by_weekday().collect()} == {"Friday"}
    assert {r.peak_period for r in plan.by_date("peak_period").collect()} == {"AM_PEAK", "MIDDAY"}
    shares = plan.type_share_by_borough().collect()
    assert [tuple(r) for r in shares][:2] == [
        ("BRONX", "MOBILE BUS STOP", 5, 83.33), ("BRONX", "MOBILE BUS LANE", 1, 16.67),
    ]
    assert plan.total_violations().first().total_ace_violations == 8
    assert plan.total_complaints().first().total_311_complaints == 13


def test_reports_do_not_need_written_facts(plan):
    fresh = Enforcement(plan.store.scratch(plan.store.spark), plan.sources)
    assert fresh.by_borough().collect() == plan.by_borough().collect()
    assert not any(name.startswith("fact") for name in fresh._built)


def test_checks(plan):
    report = run_checks(plan.build(), CHECKS)
    failing = {(r.table_name, r.column_name, r.check_name): r.failures for r in report.collect() if r.failures}
    assert report.count() == 43
    assert failing == {("fact_311_complaints", "date_key", "relationships"): 1}
