"""Extract rows are dealt to tasks by the memory they take, and staged once in each build."""

import pytest
from pyspark.sql import functions as F

from curbstar.plans import catalog, enforcement, raw_feeds
from curbstar.sources import readers
from curbstar.sources.schemas import RAW_TABLES

ROWS = 400
DAY = "timestamp_ntz'1999-03-01 00:00:00' + make_dt_interval(cast(id % 300 as int))"


@pytest.fixture
def tables(spark, tmp_path):
    """A folder with the tables that extracts are derived from, each in one file."""
    columns = {
        "orders": [
            "id AS o_orderkey", "id % 90 AS o_custkey", "element_at(array('F', 'O', 'P'), cast(id % 3 as int) + 1) AS o_orderstatus",
            "'1-URGENT' AS o_orderpriority", f"{DAY} AS o_orderdate",
        ],
        "lineitem": [
            "id AS l_orderkey", "id % 50 + 1 AS l_partkey", "id % 30 + 1 AS l_suppkey", "1 AS l_linenumber",
            "cast(id % 40 as double) AS l_quantity", "'N' AS l_returnflag", "'F' AS l_linestatus", f"{DAY} AS l_shipdate",
        ],
        "events": [
            "id AS event_id", "id % 70 AS user_id", "'view' AS event_type", "'{}' AS props", f"{DAY} AS ts",
        ],
    }
    for table, values in columns.items():
        spark.range(ROWS).selectExpr(*values).coalesce(1).write.parquet(f"{tmp_path}/{table}.parquet")
    return str(tmp_path)


def most_in_a_task(df):
    return max(r["n"] for r in df.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect())


def same_rows(a, b):
    return sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


@pytest.mark.parametrize(
    "feed, versions",
    [
        (raw_feeds.complaints, 2),
        (raw_feeds.camera_violations, 1),
        (raw_feeds.service_requests, 2),
        (raw_feeds.seating_applications, 1),
    ],
)
def test_an_extract_is_derived_in_tasks_of_bounded_size(spark, tables, monkeypatch, feed, versions):
    usual = feed(spark, tables)
    cells = readers.CELL_BYTES * len(usual.columns)
    monkeypatch.setattr(readers, "TASK_BYTES", 20 * cells)
    spread = feed(spark, tables)
    assert spread.rdd.getNumPartitions() == ROWS * versions // 20
    assert most_in_a_task(spread) <= 80 < most_in_a_task(usual)
    assert same_rows(usual, spread)


def test_a_scanned_extract_is_dealt_to_tasks_of_bounded_size(spark, raw, tmp_path, monkeypatch):
    name = "source_dot_service_requests_history"
    rows = [{"unique_key": str(i) if i % 2 else None, "agency": "DOT"} for i in range(ROWS)]
    raw(name, rows).withColumn("further", F.col("unique_key")).coalesce(1).write.parquet(f"{tmp_path}/raw")
    usual = readers.read_raw(spark, name, f"{tmp_path}/raw")
    monkeypatch.setattr(readers, "TASK_BYTES", 20 * readers.CELL_BYTES * (len(RAW_TABLES[name]) + 1))
    spread = readers.read_raw(spark, name, f"{tmp_path}/raw")
    assert usual.rdd.getNumPartitions() == 1
    assert spread.rdd.getNumPartitions() == ROWS // 20
    assert spread.columns == usual.columns
    assert same_rows(usual, spread)


def test_tasks_grow_with_the_rows():
    per_task = readers.TASK_BYTES // (32 * readers.CELL_BYTES)
    assert [readers.text_tasks(n, 32) for n in (0, 1, per_task, per_task + 1)] == [1, 1, 1, 2]
    for rows in (10**6, 10**8, 10**10):
        assert rows * 32 * readers.CELL_BYTES / readers.text_tasks(rows, 32) <= 4.1 * readers.TASK_BYTES


def test_a_broken_build_has_staged_each_extract_once(spark, tables, monkeypatch):
    staged = []
    for name in ("stg_311", "stg_ace"):
        plain = getattr(enforcement, name)
        monkeypatch.setattr(enforcement, name, lambda raw, name=name, plain=plain: staged.append(name) or plain(raw))
    catalog.report_beside_broken_build(spark, tables).collect()
    # by the published build and by the later one
    assert sorted(staged) == ["stg_311"] * 2 + ["stg_ace"] * 2
