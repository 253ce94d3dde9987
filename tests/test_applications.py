"""The requests-versus-applications pipeline on hand-built extracts."""

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException

from curbstar.operators.lookup import Lookup, lookup_fk, natural
from curbstar.operators.quality import run_checks
from curbstar.plans.applications import SOURCE_CHECKS, Applications
from curbstar.sources.store import Store

REQUEST = {
    "created_date": "2024-06-30T10:00:00",
    "agency": "DOT",
    "complaint_type": "Street Condition",
    "descriptor": "Pothole",
    "borough": "MANHATTAN",
    "incident_zip": "10001",
    "latitude": "40.7",
    "status": "Open",
    "address_type": "ADDRESS",
    "landmark": "PARK",
}
REQUESTS = [
    {"unique_key": "1"},
    {"unique_key": "2", "agency": "X", "agency_name": "Department of Transportation"},
    {"unique_key": "3", "agency": "X", "agency_name": "Parks"},
    {"unique_key": "4", "created_date": "2018-01-01T00:00:00"},
    {"unique_key": "5", "borough": None},
    {"unique_key": "6", "borough": " kings county "},
    {"unique_key": "7", "borough": "Citywide", "incident_zip": "N/A"},
    {"unique_key": "8", "status": " closed ", "closed_date": "2024-07-03T01:00:00"},
    {"unique_key": "9", "status": None, "created_date": "2024-07-03T09:00:00"},
    {"unique_key": "10", "complaint_type": None},
    {"unique_key": "11", "complaint_type": "Noise", "descriptor": None, "closed_date": "2024-07-20T00:00:00"},
    {"unique_key": "12", "borough": "  "},
    # The same type with a NULL and a blank descriptor.
    {"unique_key": "13", "complaint_type": "Ferry Complaint", "descriptor": None},
    {"unique_key": "14", "complaint_type": "Ferry Complaint", "descriptor": ""},
    # Republished with a later date.
    {"unique_key": "15", "descriptor": "old"},
    {"unique_key": "15", "created_date": "2024-07-01T00:00:00", "descriptor": "new"},
    {"unique_key": None},
    {"unique_key": "16", "created_date": None},
]
APPLICATION = {
    "time_of_submission": "2024-07-01 08:00:00",
    "restaurant_name": "Cafe",
    "business_address": "1 Main St",
    "food_service_establishment": "P1",
    "borough": "BROOKLYN",
    "zip": "11201",
    "seating_interest_sidewalk": "both",
    "approved_for_sidewalk_seating": "yes",
    "approved_for_roadway_seating": "yes",
    "sidewalk_dimensions_length": "2.5",
    "sidewalk_dimensions_width": "-2.5",
    "sidewalk_dimensions_area": "10",
    "latitude": "40.1",
    "qualify_alcohol": "yes",
    "street": "Main St",
    "globalid": "g",
}
APPLICATIONS = [
    {"objectid": "1"},
    {"objectid": "2", "restaurant_name": "Diner", "latitude": "40.2", "approved_for_roadway_seating": "no"},
    {"objectid": None},
    {"objectid": "3", "restaurant_name": "old"},
    {"objectid": "3", "restaurant_name": "new", "time_of_submission": "2024-07-02 00:00:00"},
    {"objectid": "4", "borough": None, "food_service_establishment": None, "qualify_alcohol": "Yes"},
    {"objectid": "5", "food_service_establishment": None, "business_address": None, "qualify_alcohol": None},
    {"objectid": "6", "seating_interest_sidewalk": None},
    {"objectid": "7", "seating_interest_sidewalk": "openstreets"},
    {"objectid": "8", "seating_interest_sidewalk": "sidewalk", "approved_for_roadway_seating": None},
    {"objectid": "9", "seating_interest_sidewalk": "roadway", "approved_for_sidewalk_seating": "no"},
]


def extract(spark, table, rows, default):
    from curbstar.sources.schemas import RAW_TABLES, all_text

    columns = RAW_TABLES[table]
    return spark.createDataFrame([tuple({**default, **r}.get(c) for c in columns) for r in rows], all_text(columns))


def make(spark, requests=REQUESTS, applications=APPLICATIONS):
    sources = {
        "source_dot_service_requests_history": extract(
            spark, "source_dot_service_requests_history", requests, REQUEST
        ),
        "source_nyc_open_restaurant_apps": extract(
            spark, "source_nyc_open_restaurant_apps", applications, APPLICATION
        ),
    }
    plan = Applications(Store.scratch(spark), sources)
    plan.as_of = date(2026, 8, 1)
    return plan


@pytest.fixture(scope="module")
def plan(spark):
    return make(spark)


def by(df, key):
    return {r[key]: r for r in df.collect()}


def test_staged_requests(plan):
    df = plan.table("stg_nyc_311_dot")
    staged = by(df, "request_id")
    assert set(staged) == {str(i) for i in (1, 2, 6, 7, 8, 9, 10, 11, 12, 13, 14, 15)}
    assert staged["6"].borough == "Brooklyn" and staged["12"].borough == "UNKNOWN or CITYWIDE"
    assert staged["7"].incident_zip is None and staged["8"].status == "CLOSED"
    assert staged["1"].latitude == Decimal("40.700000000") and staged["1"].landmark == "PARK"
    assert staged["15"].descriptor == "new"
    assert len(df.columns) == 21 + 18 and df.columns[21:23] == ["request_id", "created_date"]
    assert df.columns[-2:] == ["method_of_submission", "_stg_loaded_at"]


def test_malformed_request_fails_the_job(spark):
    broken = make(spark, requests=[{"unique_key": "1", "latitude": "oops"}])
    with pytest.raises(PySparkException, match="cannot cast"):
        broken.table("stg_nyc_311_dot")


def test_staged_applications(plan):
    df = plan.table("stg_nyc_open_restaurant_apps")
    staged = by(df, "application_id")
    assert set(staged) == {str(i) for i in range(1, 10)}
    assert staged["3"].restaurant_name == "new" and staged["4"].borough == "UNKNOWN or CITYWIDE"
    assert df.columns[:4] == ["globalid", "street", "application_id", "time_of_submission"]
    assert df.columns[-2:] == ["nta", "_stg_loaded_at"] and len(df.columns) == 2 + 34


def test_extra_raw_columns_pass_through(spark):
    from pyspark.sql import functions as F

    from curbstar.plans.applications import stg_nyc_open_restaurant_apps

    raw = extract(spark, "source_nyc_open_restaurant_apps", APPLICATIONS, APPLICATION)
    staged = stg_nyc_open_restaurant_apps(raw.withColumn("added", F.lit(1)))
    assert staged.columns[2] == "added"


def test_dimensions(plan):
    days = by(plan.table("dim_date_assignment"), "full_date")
    assert set(map(str, days)) == {"2024-06-30", "2024-07-01", "2024-07-02", "2024-07-03"}
    types = {(r.complaint_type, r.descriptor): r.complaint_category for r in plan.table("dim_complaint_type").collect()}
    assert types == {
        ("Street Condition", "Pothole"): "Street Issues",
        ("Street Condition", "new"): "Street Issues",
        ("Noise", None): "Other",
        ("Ferry Complaint", None): "Ferry Issues",
        ("Ferry Complaint", ""): "Ferry Issues",
    }
    restaurants = {
        (r.food_service_establishment_permit, r.full_address): r for r in plan.table("dim_restaurant").collect()
    }
    assert set(restaurants) == {("P1", "1 Main St"), (None, "1 Main St")}
    shared = restaurants["P1", "1 Main St"]
    assert shared.restaurant_name == "new"
    assert shared.latitude == Decimal("40.114285714") and shared.longitude is None
    seating = {
        r.seating_interest: (r.approved_for_sidewalk, r.approved_for_roadway)
        for r in plan.table("dim_seating_type").collect()
    }
    assert seating == {
        "both": (True, True), "openstreets": (True, True), "sidewalk": (True, False), "roadway": (False, True),
    }
    places = {(r.borough, r.zip_code) for r in plan.table("dim_location_assignment").collect()}
    assert ("UNKNOWN or CITYWIDE", None) in places and ("Brooklyn", "11201") in places


def test_fact_requests(plan):
    df = plan.table("fact_311_dot_requests")
    rows = {}
    for r in df.collect():
        rows.setdefault(r.request_id, []).append(r)
    assert {k for k, v in rows.items() if len(v) == 2} == {"13", "14"}
    one = {k: v[0] for k, v in rows.items()}
    assert one["8"].days_to_close == 3 and one["8"].is_closed and one["8"].closed_date_key is not None
    assert one["1"].days_to_close is None and not one["1"].is_closed and not one["9"].is_closed
    assert one["11"].closed_date_key is None and one["11"].created_date_key is not None
    assert one["10"].complaint_type_key is None and one["11"].complaint_type_key is not None
    assert one["7"].location_key is None and one["1"].location_key is not None
    assert df.columns == (
        "request_key request_id request_created_at request_closed_at created_date_key closed_date_key location_key "
        "complaint_type_key incident_address address_type street_name cross_street_1 cross_street_2 latitude "
        "longitude days_to_close is_closed status channel_type resolution_description".split()
    )


def test_fact_applications(plan):
    df = plan.table("fact_restaurant_applications")
    fact = by(df, "objectid")
    assert fact["1"].application_submitted == datetime(2024, 7, 1, 8)
    keyed = {k for k, r in fact.items() if r.seating_type_key is not None}
    assert keyed == {"1", "3", "4", "5", "7", "8", "9"}
    assert {k for k, r in fact.items() if r.restaurant_key is None} == {"4", "5"}
    assert (fact["1"].sidewalk_length_ft, fact["1"].sidewalk_width_ft, fact["1"].sidewalk_area_sqft) == (3, -3, 10)
    assert [fact[k].qualify_alcohol for k in "145"] == [True, False, False]
    assert df.columns == (
        "application_key objectid application_submitted submission_date_key location_key restaurant_key "
        "seating_type_key business_address street building_number latitude longitude sidewalk_length_ft "
        "sidewalk_width_ft sidewalk_area_sqft qualify_alcohol is_landmark_location "
        "health_compliance_terms_accepted sla_serial_number sla_license_type".split()
    )


def test_keys_computed_on_the_spot_equal_a_lookup(plan):
    """Location and restaurant keys need no join, because their dimensions hold every combination."""
    applications = plan.table("stg_nyc_open_restaurant_apps")
    fact = by(plan.table("fact_restaurant_applications"), "objectid")
    by_place = Lookup(
        plan.table("dim_location_assignment"), "location_key", {"borough": "borough", "zip_code": "zip"}
    )
    by_permit = Lookup(
        plan.table("dim_restaurant"),
        "restaurant_key",
        natural("food_service_establishment_permit", "full_address"),
    )
    joined = by(lookup_fk(lookup_fk(applications, by_place), by_permit), "application_id")
    assert {k: (r.location_key, r.restaurant_key) for k, r in fact.items()} == {
        k: (r.location_key, r.restaurant_key) for k, r in joined.items()
    }
    requests = plan.table("stg_nyc_311_dot")
    on = {"borough": "borough", "zip_code": "incident_zip"}
    looked_up = lookup_fk(requests, Lookup(plan.table("dim_location_assignment"), "location_key", on))
    expected = {r.request_id: r.location_key for r in looked_up.collect()}
    assert expected == {r.request_id: r.location_key for r in plan.table("fact_311_dot_requests").collect()}


def test_sample_and_source_checks(plan):
    assert plan.table("test_311_sample").columns == ["unique_key", "created_date", "complaint_type", "borough"]
    report = run_checks(plan.sources, SOURCE_CHECKS)
    found = {(r.column_name, r.check_name): r.failures for r in report.collect()}
    assert found == {
        ("unique_key", "unique"): 1, ("unique_key", "not_null"): 1,
        ("objectid", "unique"): 1, ("objectid", "not_null"): 1,
    }
