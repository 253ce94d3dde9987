"""A report moves the versions of each extract once, and only as many of their columns as it takes."""

from itertools import product

import pytest
from pyspark.sql import functions as F

from curbstar.plans import enforcement
from curbstar.plans.enforcement import LOCATION, VIOLATION_TYPE, Enforcement, complaint_staging, violation_staging
from curbstar.sources.store import Store

COMPLAINTS, VIOLATIONS = "source_nyc_311_traffic", "source_mta_ace_violations"
EARLY, LATE = "2025-03-14T08:00:00", "2025-03-14T09:00:00"


@pytest.fixture
def extracts(raw):
    """Many versions of few records, most of them equal in time and first columns."""
    complaints = [
        {"unique_key": str(i % 7), "created_date": t, "borough": b, "incident_zip": z, "council_district": c,
         "descriptor": d, "latitude": n, "complaint_type": "Illegal Parking"}
        for i, (t, b, z, c, d, n) in enumerate(
            product((EARLY, LATE), ("queens", "Bronx", None), ("10001", None), ("1", "x"), ("d", None), ("40.5", None))
        )
    ]
    violations = [
        {"violation_id": f"v{i % 11}" if i % 13 else None, "first_occurrence": EARLY, "last_occurrence": t,
         "violation_type": k, "violation_status": s, "bus_route_id": r, "stop_id": p, "stop_name": n,
         "bus_stop_latitude": n}
        for i, (t, k, s, r, p, n) in enumerate(
            product((None, EARLY), ("LANE", "STOP"), ("EXEMPT", None), ("Bx12", "m1", None), ("1", None), ("40.5", "7", None))
        )
    ]
    return {COMPLAINTS: raw(COMPLAINTS, complaints), VIOLATIONS: raw(VIOLATIONS, violations)}


def ordered(df):
    return sorted(map(repr, df.collect()))


@pytest.mark.parametrize(
    "source, staging, only",
    [
        (COMPLAINTS, complaint_staging, LOCATION),
        (COMPLAINTS, complaint_staging, ["problem_detail", "complaint_id"]),
        (COMPLAINTS, complaint_staging, ["longitude"]),
        (VIOLATIONS, violation_staging, [*LOCATION, *VIOLATION_TYPE]),
        (VIOLATIONS, violation_staging, VIOLATION_TYPE),
        (VIOLATIONS, violation_staging, ["violation_id", "stop_name"]),
        (VIOLATIONS, violation_staging, ["zip_code"]),
    ],
)
def test_some_columns_are_those_of_the_whole_table(extracts, source, staging, only):
    whole = staging().plan(extracts[source])
    some = staging().plan(extracts[source], only)
    assert some.columns == only
    assert some.schema == whole.select(*only).schema
    assert ordered(some) == ordered(whole.select(*only))


def test_versions_compete_by_no_column_after_the_last_one_read():
    staging = violation_staging()

    def deciding(*columns):
        return staging.deciding({c: staging.columns[c] for c in columns})

    assert deciding(*VIOLATION_TYPE)[-1] == "violation_status"
    # read off the route
    assert deciding("borough")[-1] == "bus_route_id"
    assert deciding("zip_code") == []
    assert deciding(*staging.columns) == staging.tiebreak


@pytest.fixture
def staged(monkeypatch):
    """The extracts that are staged, one entry for each time."""
    seen = []
    for name in ("stg_311", "stg_ace"):
        plain = getattr(enforcement, name)

        def counted(*args, name=name, plain=plain):
            seen.append(name)
            return plain(*args)

        monkeypatch.setattr(enforcement, name, counted)
    return seen


def test_the_share_report_stages_each_extract_once(spark, extracts, staged):
    plan = Enforcement(Store.scratch(spark), extracts)
    # what is counted, from the staged violations alone
    whole = violation_staging().plan(extracts[VIOLATIONS])
    expected = whole.groupBy("borough", "violation_category").count().collect()
    found = plan.type_share_by_borough()
    assert sorted(staged) == ["stg_311", "stg_ace"]
    assert sorted((r.borough, r.violation_category, r.violation_count) for r in found.collect()) == sorted(map(tuple, expected))
    assert sorted(staged) == ["stg_311", "stg_ace"]


def test_what_a_report_has_gathered_serves_no_one_who_reads_more(spark, extracts):
    plan, fresh = (Enforcement(Store.scratch(spark), extracts) for _ in range(2))
    shares = plan.type_share_by_borough().collect()
    for report in ("by_borough", "by_year", "total_violations"):
        assert getattr(plan, report)().collect() == getattr(fresh, report)().collect()
    assert ordered(plan.table("dim_bus_stop")) == ordered(fresh.table("dim_bus_stop"))
    built = plan.build()
    assert built["stg_ace"].columns == list(violation_staging().columns)
    assert built["fact_ace_violations"].filter(F.col("bus_stop_key").isNotNull()).count()
    assert plan.type_share_by_borough().collect() == shares
