"""All-text raw extracts derived from the trade tables, with the flaws real extracts have.

Each extract covers its whole source table. Malformed numbers and dates, odd spellings, missing
values and republished records are derived from the keys, so every rule of the staging layer has
rows to act on, and the extracts grow with the tables. Dates move forward by 25 years, into the
range of the hour-grain calendar.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from curbstar.sources.readers import text_tasks
from curbstar.sources.schemas import (
    CAMERA_VIOLATIONS,
    COMPLAINTS,
    SEATING_APPLICATIONS,
    SERVICE_REQUESTS,
)

DAYS_FORWARD = 9131
DAY = 86_400

BOROUGH_SPELLINGS = [
    "MANHATTAN",
    " new york county ",
    "The Bronx",
    "bronx",
    "BROOKLYN",
    " kings county\t",
    "QUEEN",
    "Queens County",
    "STATEN ISLAND",
    "Citywide",
]
ZIP_SPELLINGS = [
    "N/A",
    " na  ",
    "anonymous",
    "10001",
    "ABCDE",
    "100011234",
    "10001-1234",
    "10001x1234",
    "1001",
]
REQUEST_TYPES = [
    "STREET condition",
    "Traffic Signal Condition",
    "Sidewalk Condition",
    "Bike Rack Condition",
    "Broken Parking Meter",
    "Ferry Complaint",
    "Noise",
]
ROUTE_PREFIXES = ["M", "B", "Bx", "BxM", "BM", "QM", "X", "Q", "S", "SIM", "m", "Z"]


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def _source(
    spark: SparkSession, sf_dir: str, table: str, columns: Sequence[str], versions: int = 1
) -> DataFrame:
    """The table, spread over all cores and over as many tasks as its extract needs.

    Each row becomes ``versions`` extract rows of ``columns``, which take far more memory, so rows are
    spread while they are narrow.
    """
    df, cores = read(spark, sf_dir, table), spark.sparkContext.defaultParallelism
    tasks = max(cores, text_tasks(df.count() * versions, len(columns)))
    few = df.rdd.getNumPartitions() < tasks
    return df.repartition(tasks, df.columns[0]) if few else df


def _pick(n: Column, values: list[str]) -> Column:
    """The n-th value; NULL past the end."""
    return F.get(F.array(*[F.lit(v) for v in values]), n.cast("int"))


def _text(ts: Column) -> Column:
    """Date and time of day to the second."""
    return F.substring(ts.cast("string"), 1, 19)


def _iso(ts: Column) -> Column:
    return F.concat(F.translate(_text(ts), " ", "T"), F.lit(".000"))


def _moved(ts: Column, days: Column | int, seconds: Column | int = 0) -> Column:
    return F.timestamp_add("SECOND", (days * F.lit(DAY) + seconds).cast("bigint"), ts)


def _decimals(whole: str, n: Column) -> Column:
    return F.concat(F.lit(whole + "."), F.lpad((n % 10000).cast("string"), 4, "0"))


def _select(df: DataFrame, names: list[str], columns: dict[str, Column]) -> DataFrame:
    return df.select(*[columns[c].cast("string").alias(c) for c in names])


def complaints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Curb complaints from ``orders``: each is published open, then again with its outcome."""
    rows = _source(spark, sf_dir, "orders", COMPLAINTS, 2)
    orders = rows.withColumn("snapshot", F.explode(F.array(F.lit(1), F.lit(2))))
    key, cust, status = F.col("o_orderkey"), F.col("o_custkey"), F.col("o_orderstatus")
    again = F.col("snapshot") == 2
    clock = (cust % 24) * 3600 + key % 3600
    start = _moved(F.col("o_orderdate"), F.lit(DAYS_FORWARD), clock)
    end = _moved(F.col("o_orderdate"), key % 9 + DAYS_FORWARD, clock + cust % DAY)
    text = key.cast("string")
    return _select(
        orders,
        COMPLAINTS,
        {
            "unique_key": F.when((status == "P") & (cust % 50 == 7), F.concat(F.lit("K"), text)).otherwise(text),
            "created_date": F.when(again & (cust % 41 == 0), F.lit("not a date")).otherwise(_text(start)),
            "closed_date": F.when(again & (status == "F"), _text(end)).when(again & (status == "P"), F.lit("pending")),
            "agency": F.when(cust % 4 == 0, F.lit("DOT")).when(cust % 4 > 1, F.lit("NYPD")),
            "complaint_type": F.when(cust % 43 == 5, F.lit("illegal parking"))
            .when(cust % 43 == 6, F.lit("Abandoned Vehicle"))
            .when(F.col("o_orderpriority") == "1-URGENT", F.lit("Illegal Parking"))
            .when(F.col("o_orderpriority") == "2-HIGH", F.lit("Blocked Driveway"))
            .when(F.col("o_orderpriority") == "3-MEDIUM", F.lit("Double Parked Blocking Vehicle"))
            .when(F.col("o_orderpriority") == "5-LOW", F.lit("Posted Parking Sign Violation"))
            .when(status == "F", F.lit("Blocked Bike Lane"))
            .when(status == "O", F.lit("Double Parked Blocking Traffic"))
            .otherwise(F.lit("Noise")),
            "descriptor": F.when(cust % 7 > 0, F.concat(F.lit("Detail "), cust % 7)),
            "status": F.when(again & (status == "F"), F.lit("Closed"))
            .when(again & (status == "O"), F.lit("In Progress"))
            .otherwise(F.lit("Open")),
            "borough": F.coalesce(
                _pick(cust % 6, ["Bronx", "BROOKLYN", "Manhattan", "QUEENS", "Staten Island"]),
                F.when(key % 2 == 1, F.lit("Unspecified")),
            ),
            "incident_zip": F.when(cust % 10 > 0, F.concat(F.lit("10"), F.lpad((cust % 300).cast("string"), 3, "0"))),
            "community_board": F.when(
                cust % 5 > 0, F.concat(F.lpad((cust % 18).cast("string"), 2, "0"), F.lit(" BOARD"))
            ),
            "council_district": F.when(cust % 20 == 1, F.lit("x")).when(
                cust % 20 > 0, (cust % 51).cast("string")
            ),
            "latitude": F.when(cust % 30 == 0, F.lit("")).otherwise(_decimals("40", key)),
            "longitude": _decimals("-73", key),
        },
    )


def camera_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Camera violations from ``lineitem``, whose repeated line numbers act as republished ones."""
    key, part, supp, line = (F.col(c) for c in ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"))
    kind, state = F.col("l_returnflag"), F.col("l_linestatus")
    clock = (part % 1440) * 60 + key % 60
    lasted = (F.col("l_quantity") * 37 - 60).cast("bigint")
    start = _moved(F.col("l_shipdate"), F.lit(DAYS_FORWARD), clock)
    end = _moved(F.col("l_shipdate"), F.lit(DAYS_FORWARD), clock + lasted)
    return _select(
        _source(spark, sf_dir, "lineitem", CAMERA_VIOLATIONS),
        CAMERA_VIOLATIONS,
        {
            "violation_id": F.when(part % 67 > 0, F.concat(F.lit("V"), key, F.lit("-"), line)),
            "first_occurrence": F.when(supp % 61 == 0, F.lit("bad")).otherwise(_iso(start)),
            "last_occurrence": F.when((kind != "R") | (state != "O"), _iso(end)),
            "violation_type": F.when(kind == "A", F.lit("MOBILE BUS STOP"))
            .when(kind == "N", F.lit("MOBILE BUS LANE"))
            .otherwise(F.lit("MOBILE DOUBLE PARKED")),
            "violation_status": F.when(state == "F", F.lit("VIOLATION ISSUED")).when(
                part % 3 > 0, F.lit("EXEMPT")
            ),
            "bus_route_id": F.concat(_pick(supp % 13, ROUTE_PREFIXES), supp % 40),
            "stop_id": F.when(part % 23 > 0, F.concat(F.lit("S"), part)),
            "stop_name": F.concat(F.lit("STOP "), part, F.lit("/"), line % 2),
            "violation_latitude": F.when(key % 50 == 0, F.lit("n/a")).otherwise(_decimals("40", key)),
            "violation_longitude": _decimals("-73", key),
            "bus_stop_latitude": _decimals("40", part),
            "bus_stop_longitude": _decimals("-73", part),
        },
    )


def service_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Street requests from ``events``: each is published open, then again with its outcome."""
    rows = _source(spark, sf_dir, "events", SERVICE_REQUESTS, 2)
    events = rows.withColumn("snapshot", F.explode(F.array(F.lit(1), F.lit(2))))
    key, user, kind = F.col("event_id"), F.col("user_id"), F.col("event_type")
    done = (F.col("snapshot") == 2) & kind.isin("click", "purchase", "view")
    start = _moved(F.col("ts"), (user % 10) * -365)
    end = _moved(F.col("ts"), (user % 10) * -365 + key % 40)
    columns = {
        "unique_key": F.when(user % 53 > 0, key),
        "created_date": F.when(user % 59 > 0, _text(start)),
        "closed_date": F.when(done, _text(end)),
        "agency": F.when(kind == "error", F.lit("XYZ"))
        .when((kind == "signup") & (user % 2 == 0), F.lit("DOB"))
        .otherwise(F.lit("DOT")),
        "agency_name": F.when((kind == "signup") & (user % 2 == 0), F.lit("Department of Buildings")).otherwise(
            F.lit("Department of Transportation")
        ),
        "complaint_type": _pick(user % 8, REQUEST_TYPES),
        "descriptor": F.when(kind == "view", F.lit("Pothole"))
        .when((kind == "purchase") & (user % 8 == 0), F.lit(""))
        .when(kind == "error", F.lit("Cave-in")),
        "incident_zip": F.coalesce(
            _pick(user % 12, ZIP_SPELLINGS), F.concat(F.lit("10"), F.lpad((user % 200).cast("string"), 3, "0"))
        ),
        "incident_address": F.concat(user, F.lit(" Main St")),
        "latitude": F.when(user % 13 > 0, _decimals("40", key)),
        "longitude": F.when(user % 13 > 0, _decimals("-73", key)),
        "address_type": F.when(key % 2 == 0, F.lit("ADDRESS")).otherwise(F.lit("INTERSECTION")),
        "borough": _pick(user % 11, BOROUGH_SPELLINGS),
        "open_data_channel_type": _pick(key % 3, ["ONLINE", "PHONE", "MOBILE"]),
        "resolution_description": F.when(done, F.col("props")),
        "status": F.when(done, F.lit(" closed ")).when(
            (F.col("snapshot") == 1) | (kind != "error"), F.lit("In Progress")
        ),
    }
    plain = {
        c: F.concat(F.lit(c + " "), user % 3) for c in SERVICE_REQUESTS if c not in columns
    }
    return _select(events, SERVICE_REQUESTS, {**columns, **plain})


def seating_applications(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applications from ``orders``: every order of a customer resubmits the application."""
    key, cust, status = F.col("o_orderkey"), F.col("o_custkey"), F.col("o_orderstatus")
    site = F.floor(cust / 3)
    submitted = _moved(F.col("o_orderdate"), F.lit(DAYS_FORWARD), key % DAY)
    answer = F.when(status == "F", F.lit("yes")).when(status == "O", F.lit("Yes"))
    half = F.concat(cust % 20, F.lit(".5"))
    columns = {
        "objectid": F.when((status != "P") | (cust % 37 > 0), cust),
        "globalid": F.concat(F.lit("G-"), key),
        "time_of_submission": _text(submitted),
        "restaurant_name": F.concat(F.lit("Cafe "), cust),
        "legal_business_name": F.concat(F.lit("Legal "), cust % 100),
        "doing_business_as_dba": F.concat(F.lit("DBA "), cust % 70),
        "bulding_number": cust % 500,
        "street": F.concat(F.lit("Street "), cust % 80),
        "borough": _pick(cust % 11, BOROUGH_SPELLINGS),
        "zip": F.coalesce(
            _pick(cust % 12, ZIP_SPELLINGS), F.concat(F.lit("10"), F.lpad((cust % 200).cast("string"), 3, "0"))
        ),
        "business_address": F.when(cust % 29 > 0, F.concat(site, F.lit(" Main St"))),
        "latitude": F.when(cust % 17 > 0, _decimals("40", cust)),
        "longitude": F.when(cust % 17 > 0, _decimals("-73", cust)),
        "seating_interest_sidewalk": _pick(cust % 5, ["sidewalk", "roadway", "both", "openstreets"]),
        "approved_for_sidewalk_seating": F.when(status == "P", F.lit("no")).otherwise(F.lit("yes")),
        "approved_for_roadway_seating": F.when(status == "F", F.lit("yes")).when(status == "O", F.lit("no")),
        "sidewalk_dimensions_length": F.when(cust % 19 > 0, half),
        "sidewalk_dimensions_width": cust % 9,
        "sidewalk_dimensions_area": F.concat(cust % 300, F.lit(".49")),
        "roadway_dimensions_length": half,
        "roadway_dimensions_width": F.concat(F.lit("-"), cust % 9, F.lit(".25")),
        "roadway_dimensions_area": F.when(cust % 19 > 0, cust % 400),
        "qualify_alcohol": answer,
        "landmark_district_or_building": F.when(cust % 2 == 0, answer),
        "healthcompliance_terms": F.when(cust % 3 == 0, F.lit("yes")).otherwise(F.lit("no")),
        "food_service_establishment": F.when(cust % 31 > 0, F.concat(F.lit("P"), site)),
    }
    plain = {
        c: F.concat(F.lit(c + " "), cust % 3) for c in SEATING_APPLICATIONS if c not in columns
    }
    orders = _source(spark, sf_dir, "orders", SEATING_APPLICATIONS)
    return _select(orders, SEATING_APPLICATIONS, {**columns, **plain})
