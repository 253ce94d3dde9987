"""Every registered query against its SQL counterpart in DuckDB, and what its plan may contain."""

import datetime
import os

import pytest

from __spark_entry__ import entry
from curbstar.operators import lookup
from curbstar.plans.catalog import QUERIES
from curbstar.plans.oracle import SQL

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
duckdb = pytest.importorskip("duckdb")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no trade tables")

DUCKDB_TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "string": "VARCHAR",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
}


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for file in os.listdir(SF_DIR):
        name = file.removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{file}'")
    return connection


def comparable(rows):
    return sorted(rows, key=lambda row: [(v is None, str(v)) for v in row])


def spark_rows(df, columns):
    return comparable([tuple(row[c] for c in columns) for row in df.collect()])


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, database, name):
    df = QUERIES[name](spark, SF_DIR)
    columns = sorted(df.columns)
    result = database.execute(SQL[name])
    names, types = zip(*[(d[0], str(d[1]).upper()) for d in result.description])
    assert sorted(names) == columns
    expected = comparable([tuple(row[names.index(c)] for c in columns) for row in result.fetchall()])
    assert expected, "a comparison of nothing proves nothing"
    assert spark_rows(df, columns) == expected
    for c in columns:
        if c in ("quarter", "month", "year"):
            continue
        value = next((r[columns.index(c)] for r in expected if r[columns.index(c)] is not None), None)
        if not isinstance(value, (type(None), datetime.datetime)):
            assert DUCKDB_TYPES[dict(df.dtypes)[c]] in (types[names.index(c)], "BIGINT")
    plan = df._jdf.queryExecution().executedPlan().toString()
    for slow in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert slow not in plan


def test_entry(spark):
    assert entry(spark).count() == 10


@pytest.mark.parametrize("name", ["q1_region_series", "dim_location_conformed", "model_fact_ace_violations"])
def test_result_does_not_depend_on_partitions_or_zone(spark, conf, name):
    columns = sorted(QUERIES[name](spark, SF_DIR).columns)
    before = spark_rows(QUERIES[name](spark, SF_DIR), columns)
    conf("spark.sql.shuffle.partitions", "13")
    conf("spark.sql.adaptive.coalescePartitions.enabled", "false")
    conf("spark.sql.session.timeZone", "America/New_York")
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    assert spark_rows(QUERIES[name](spark, SF_DIR), columns) == before


LOOKUPS = ["fact_orders", "fact_requests", "q5_type_share", "role_playing_dates", "model_fact_ace_violations"]


@pytest.mark.parametrize("name", LOOKUPS)
def test_large_dimensions_give_the_same_result(spark, monkeypatch, name):
    """With no room to broadcast, every lookup takes the shuffle route with its hot keys apart."""
    columns = sorted(QUERIES[name](spark, SF_DIR).columns)
    before = spark_rows(QUERIES[name](spark, SF_DIR), columns)
    monkeypatch.setattr(lookup, "BROADCAST_BYTES", -1)
    monkeypatch.setattr(lookup, "HOT_ROWS", 40)
    df = QUERIES[name](spark, SF_DIR)
    assert "_piece" in df._jdf.queryExecution().executedPlan().toString()
    assert spark_rows(df, columns) == before


def test_scans_read_only_what_they_need(spark):
    plan = QUERIES["or_like_filter"](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<p_partkey:bigint,p_name:string,p_type:string>" in plan
    plan = QUERIES["required_fields_filter"](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [" in plan and "In(o_orderpriority" in plan
    plan = QUERIES["hour_key_events"](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz>" in plan
