from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from curbstar import fixed_values as fv
from curbstar.functions import clean


def apply(spark, values, fn, schema="c string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, {schema}")
    return [r.out for r in rows.select("i", fn(F.col("c")).alias("out")).orderBy("i").collect()]


def test_safe_cast_long(spark):
    values = ["12", " 12 ", "abc", "", None, "1.5", "99999999999999999999"]
    expected = [12, 12, None, None, None, None, None]
    assert apply(spark, values, lambda c: clean.safe_cast(c, "bigint")) == expected


def test_safe_cast_double(spark):
    values = ["40.7", "-1e3", "x", "", None, "1.5f", "2D", "inf"]
    expected = [40.7, -1000.0, None, None, None, None, None, float("inf")]
    assert apply(spark, values, lambda c: clean.safe_cast(c, "double")) == expected


TIMES = {
    "2025-03-14T08:59:59.000": datetime(2025, 3, 14, 8, 59, 59),
    "2025-03-14 08:59:59": datetime(2025, 3, 14, 8, 59, 59),
    "2025-03-14": datetime(2025, 3, 14),
    "2025-3-4 1:02:03": datetime(2025, 3, 4, 1, 2, 3),
    "2025-03-14T08:00:00Z": datetime(2025, 3, 14, 8),
    "2025-03-14 08:00:00+02:00": datetime(2025, 3, 14, 6),
    "2025-03-14 08:00:00-05:00": datetime(2025, 3, 14, 13),
    "2025-07-14 08:00:00 America/New_York": datetime(2025, 7, 14, 12),
    "2025": None,
    "01/05/2024 10:00:00 AM": None,
    "not a date": None,
    "2025-13-01": None,
    "": None,
    None: None,
}


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_safe_timestamp_ignores_session_zone(spark, conf, zone):
    conf("spark.sql.session.timeZone", zone)
    assert apply(spark, list(TIMES), clean.safe_timestamp) == list(TIMES.values())


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_casts_ignore_ansi_setting(spark, conf, ansi):
    conf("spark.sql.ansi.enabled", ansi)
    assert apply(spark, ["x", "7"], lambda c: clean.safe_cast(c, "bigint")) == [None, 7]
    exact = apply(spark, ["40.7", None], lambda c: clean.strict_cast(c, fv.NUMERIC))
    assert exact == [Decimal("40.700000000"), None]
    with pytest.raises(PySparkException, match="cannot cast"):
        apply(spark, ["oops"], lambda c: clean.strict_cast(c, fv.NUMERIC))
    with pytest.raises(PySparkException, match="cannot cast"):
        apply(spark, ["oops"], lambda c: clean.strict_cast(c, "timestamp"))


def test_classify_prefix(spark):
    expected = {
        "Bx12": "BRONX",
        "BXM1": "BRONX",
        "BM2": "EXPRESS",
        "QM5": "EXPRESS",
        "X27": "EXPRESS",
        "M15": "MANHATTAN",
        "b46": "BROOKLYN",
        "Q44": "QUEENS",
        "S79": "STATEN ISLAND",
        "SIM1": "STATEN ISLAND",
        "Z9": "UNKNOWN",
        "": "UNKNOWN",
        None: "UNKNOWN",
    }
    found = apply(
        spark,
        list(expected),
        lambda c: clean.classify_prefix(c, fv.ROUTE_PREFIX_BOROUGHS, fv.UNKNOWN_ROUTE_BOROUGH),
    )
    assert found == list(expected.values())


def test_standardize_borough(spark):
    expected = {
        "MANHATTAN": "Manhattan",
        " new york county ": "Manhattan",
        "the bronx": "Bronx",
        "\tkings county\n": "Brooklyn",
        "QUEEN": "Queens",
        "Richmond County": "Staten Island",
        "Citywide": "UNKNOWN or CITYWIDE",
        "  ": "UNKNOWN or CITYWIDE",
        None: "UNKNOWN or CITYWIDE",
    }
    found = apply(
        spark, list(expected), lambda c: clean.standardize(c, fv.BOROUGH_SYNONYMS, fv.UNKNOWN_BOROUGH)
    )
    assert found == list(expected.values())


def test_categorize_first_keyword_wins(spark):
    expected = {
        "Street Sidewalk": "Street Issues",
        "Bike Parking": "Bike Issues",
        "TRAFFIC signal": "Traffic Issues",
        "Ferry Complaint": "Ferry Issues",
        "Noise": "Other",
    }
    found = apply(
        spark, list(expected), lambda c: clean.categorize(c, fv.COMPLAINT_CATEGORIES, fv.OTHER_CATEGORY)
    )
    assert found == list(expected.values())


def test_clean_zip(spark):
    expected = {
        "N/A": None,
        " na ": None,
        " NA": None,
        "anonymous": "Anonymous",
        "10001": "10001",
        "ABCDE": "ABCDE",
        "100011234": "100011234",
        "10001-1234": "10001-1234",
        "10001x1234": None,
        "1001": None,
        " 1001": " 1001",
        None: None,
    }
    assert apply(spark, list(expected), clean.clean_zip) == list(expected.values())


def test_flags_treat_null_as_false(spark):
    assert apply(spark, ["yes", "Yes", None], lambda c: clean.flag_eq(c, "yes")) == [True, False, False]
    assert apply(spark, ["both", "x", None], lambda c: clean.flag_in(c, ["both"])) == [True, False, False]


def test_round_to_long_rounds_halves_away_from_zero(spark):
    values = [Decimal("2.5"), Decimal("-2.5"), Decimal("2.49"), None]
    assert apply(spark, values, clean.round_to_long, f"c {fv.NUMERIC}") == [3, -3, 2, None]


def test_within_years_keeps_the_first_day(spark):
    days = [date(2019, 8, 1), date(2019, 7, 31), date(2026, 8, 1)]
    inside = lambda c: clean.within_years(c, 7, F.lit(date(2026, 8, 1)))
    assert apply(spark, days, inside, "c date") == [True, False, True]
    leap = lambda c: clean.within_years(c, 1, F.lit(date(2024, 2, 29)))
    assert apply(spark, [date(2023, 2, 28), date(2023, 2, 27)], leap, "c date") == [True, False]
