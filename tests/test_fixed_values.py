"""The SQL states the fixed values itself: a changed one in the Spark code turns a query's row red."""

import os

import pytest

from curbstar import fixed_values as fv
from curbstar.plans.catalog import QUERIES
from curbstar.plans.oracle import SQL

# large enough for every value of the feeds to occur
SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
duckdb = pytest.importorskip("duckdb")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no trade tables")

CHANGES = [
    *[("model_stg_311", "CURB_COMPLAINT_TYPES", [t for t in fv.CURB_COMPLAINT_TYPES if t != gone])
      for gone in (fv.CURB_COMPLAINT_TYPES[0], fv.CURB_COMPLAINT_TYPES[-1])],
    ("model_stg_311", "CURB_COMPLAINT_TYPES", [*fv.CURB_COMPLAINT_TYPES, "illegal parking"]),
    ("model_stg_ace", "ROUTE_PREFIX_BOROUGHS", fv.ROUTE_PREFIX_BOROUGHS[1:]),
    ("model_stg_ace", "UNKNOWN_ROUTE_BOROUGH", "OTHER"),
    ("model_stg_nyc_311_dot", "BOROUGH_SYNONYMS", {**fv.BOROUGH_SYNONYMS, "Queens": ["QUEENS", "QUEENS COUNTY"]}),
    ("model_stg_nyc_311_dot", "ZIP_MISSING", ["N/A"]),
    ("model_stg_nyc_311_dot", "REQUEST_YEARS", 6),
    ("model_dim_complaint_type", "COMPLAINT_CATEGORIES", fv.COMPLAINT_CATEGORIES[1:]),
    ("model_dim_seating_type", "SIDEWALK_INTERESTS", ["sidewalk", "both"]),
]


@pytest.mark.parametrize(("query", "name", "value"), CHANGES, ids=[f"{q}-{n}" for q, n, _ in CHANGES])
def test_a_changed_value_shows(spark, monkeypatch, query, name, value):
    connection = duckdb.connect()
    for file in os.listdir(SF_DIR):
        connection.execute(f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM '{SF_DIR}/{file}'")
    result = connection.execute(SQL[query])
    columns = [d[0] for d in result.description]
    expected = sorted(map(str, result.fetchall()))

    def found():
        return sorted(str(tuple(r)) for r in QUERIES[query](spark, SF_DIR).select(*columns).collect())

    assert found() == expected
    monkeypatch.setattr(fv, name, value)
    assert found() != expected
