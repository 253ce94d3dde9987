from datetime import datetime

import hashlib

from pyspark.sql import functions as F

from curbstar import fixed_values as fv
from curbstar.functions import calendar as cal
from curbstar.functions.keys import hash_fk, hash_key
from curbstar.operators.dims import date_dim_from, hour_dim, hour_dim_spanning
from curbstar.operators.lookup import lookup_role


def test_hour_dim_covers_the_whole_window(spark):
    hours = hour_dim(spark)
    bounds = hours.agg(F.count("*"), F.countDistinct("date_key"), F.min("full_datetime"), F.max("full_datetime"))
    assert tuple(bounds.first()) == (70081, 70081, datetime(2019, 1, 1), datetime(2026, 12, 30))


def test_hour_dim_attributes(spark):
    day = hour_dim(spark, "2025-03-15 00:00:00", 48).orderBy("date_key").collect()
    periods = {r.hour: r.peak_period for r in day}
    expected = {6: "OVERNIGHT", 7: "AM_PEAK", 9: "AM_PEAK", 10: "MIDDAY", 15: "MIDDAY", 16: "PM_PEAK"}
    expected |= {19: "PM_PEAK", 20: "EVENING", 23: "EVENING", 0: "OVERNIGHT"}
    assert {h: periods[h] for h in expected} == expected
    saturday, monday = day[8], day[-1]
    assert (saturday.date_key, saturday.day_of_week, saturday.weekday_or_weekend) == (2025031508, "Saturday", "Weekend")
    assert (monday.date_key, monday.day_of_week, monday.weekday_or_weekend) == (2025031700, "Monday", "Weekday")


def test_hour_dim_spanning(spark):
    events = spark.createDataFrame([("2024-02-28 22:40:00",), ("2024-02-29 01:10:00",)], "t string")
    hours = hour_dim_spanning(events.select(F.col("t").cast("timestamp_ntz").alias("ts")), "ts")
    assert sorted(r.date_key for r in hours.collect()) == [2024022822, 2024022823, 2024022900, 2024022901]


def test_clock_changes_of_the_session_zone_do_not_matter(spark, conf):
    """In this zone the hour from 02:00 does not exist on that day; the data's clock has it."""
    conf("spark.sql.session.timeZone", "America/New_York")
    rows = spark.sql("SELECT timestamp_ntz'2026-03-08 02:30:00' AS a, timestamp_ntz'2026-03-08 04:29:59' AS b")
    assert rows.select(cal.minutes_between("a", "b"), cal.minutes_between("b", "a")).first()[:] == (119, -119)
    assert [r.date_key for r in hour_dim_spanning(rows.select(F.col("a").alias("t")), "t").collect()] == [2026030802]
    day = hour_dim(spark, "2026-03-08 00:00:00", 23)
    assert day.select("hour").distinct().count() == 24 and day.filter("day_of_week = 'Sunday'").count() == 24


def test_hour_key_is_stable_across_zones(spark, conf):
    conf("spark.sql.session.timeZone", "America/New_York")
    row = spark.sql("SELECT timestamp_ntz'2025-03-14 08:59:59' AS ts")
    assert row.select(cal.hour_key("ts")).first()[0] == 2025031408


def test_day_dim_and_roles(spark):
    source = spark.sql(
        """SELECT * FROM VALUES (1, timestamp_ntz'2024-06-30 23:00:00', timestamp_ntz'2024-07-01 01:00:00'),
           (2, timestamp_ntz'2024-07-01 05:00:00', timestamp_ntz'2024-08-01 00:00:00'),
           (3, timestamp_ntz'2024-06-30 10:00:00', NULL) AS t(id, created, closed)"""
    )
    days = date_dim_from([(source, "created")])
    found = {str(r.full_date): (r.fiscal_year, r.quarter, r.day_of_week, r.is_weekend) for r in days.collect()}
    assert found == {"2024-06-30": (2024, 2, 1, True), "2024-07-01": (2025, 3, 2, False)}
    keyed = lookup_role(source, days, {"created": "created_key", "closed": "closed_key"})
    rows = {r.id: r for r in keyed.collect()}
    july = hashlib.md5(b"2024-07-01").hexdigest()
    assert rows[1].closed_key == rows[2].created_key == july
    assert rows[2].closed_key is None and rows[3].closed_key is None


def test_durations(spark):
    rows = spark.sql(
        """SELECT * FROM VALUES
           (0, timestamp_ntz'2025-01-01 10:00:00', timestamp_ntz'2025-01-01 10:01:59'),
           (1, timestamp_ntz'2025-01-01 10:01:59', timestamp_ntz'2025-01-01 10:00:00'),
           (2, timestamp_ntz'2025-01-01 23:59:59', timestamp_ntz'2025-01-04 00:00:01'),
           (3, timestamp_ntz'2025-01-01 10:00:00', NULL) AS t(i, a, b)"""
    ).select("i", cal.minutes_between("a", "b").alias("m"), cal.days_between("a", "b").alias("d"))
    assert [(r.m, r.d) for r in rows.orderBy("i").collect()] == [(1, 0), (-1, 0), (2880, 3), (None, None)]


def test_hash_key(spark):
    row = spark.sql("SELECT 'a' AS x, CAST(NULL AS STRING) AS y, true AS z, 7L AS n")
    found = row.select(
        hash_key("x", "y", "z", "n"), hash_fk("x", "n"), hash_fk("x", "y"), hash_fk("x", "y", required=["x"])
    ).first()
    assert found[0] == hashlib.md5(f"a-{fv.HASH_KEY_NULL}-true-7".encode()).hexdigest()
    assert found[1] == hashlib.md5(b"a-7").hexdigest()
    assert found[2] is None
    assert found[3] == hashlib.md5(f"a-{fv.HASH_KEY_NULL}".encode()).hexdigest()
