"""The registered queries in plain SQL for DuckDB, written apart from the Spark code.

``TABLES`` are named building blocks; a query lists the blocks it needs, in order of use.
"""

from __future__ import annotations

from curbstar.sources.schemas import SEATING_APPLICATIONS, SERVICE_REQUESTS

TABLES: dict[str, str] = {}
SQL: dict[str, str] = {}


# --- fixed values --------------------------------------------------------------------------------
# Stated here once more, so that a wrong value or rule in the Spark code shows as a difference.

_CURB_TYPES = """('Illegal Parking', 'Blocked Driveway', 'Double Parked Blocking Vehicle',
    'Double Parked Blocking Traffic', 'Blocked Bike Lane', 'Posted Parking Sign Violation')"""


def _route_borough(route: str) -> str:
    return f"""CASE WHEN upper({route}) LIKE 'BX%' THEN 'BRONX'
    WHEN upper({route}) LIKE 'BM%' OR upper({route}) LIKE 'QM%' OR upper({route}) LIKE 'X%' THEN 'EXPRESS'
    WHEN upper({route}) LIKE 'M%' THEN 'MANHATTAN'
    WHEN upper({route}) LIKE 'B%' THEN 'BROOKLYN'
    WHEN upper({route}) LIKE 'Q%' THEN 'QUEENS'
    WHEN upper({route}) LIKE 'S%' THEN 'STATEN ISLAND'
    ELSE 'UNKNOWN' END"""


def _trim(text: str) -> str:
    return f"trim({text}, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))"


def _standard_borough(borough: str) -> str:
    spelled = f"upper({_trim(borough)})"
    return f"""CASE WHEN {spelled} IN ('MANHATTAN', 'NEW YORK COUNTY') THEN 'Manhattan'
    WHEN {spelled} IN ('BRONX', 'THE BRONX') THEN 'Bronx'
    WHEN {spelled} IN ('BROOKLYN', 'KINGS COUNTY') THEN 'Brooklyn'
    WHEN {spelled} IN ('QUEENS', 'QUEEN', 'QUEENS COUNTY') THEN 'Queens'
    WHEN {spelled} IN ('STATEN ISLAND', 'RICHMOND COUNTY') THEN 'Staten Island'
    ELSE 'UNKNOWN or CITYWIDE' END"""


def _clean_zip(zip_code: str) -> str:
    return rf"""CASE WHEN upper({_trim(zip_code)}) IN ('N/A', 'NA') THEN NULL
    WHEN upper({_trim(zip_code)}) = 'ANONYMOUS' THEN 'Anonymous'
    WHEN length({zip_code}) = 5 OR length({zip_code}) = 9 THEN {zip_code}
    WHEN length({zip_code}) = 10 AND regexp_matches({zip_code}, '^\d{{5}}-\d{{4}}') THEN {zip_code} END"""


_COMPLAINT_CATEGORY = """CASE WHEN lower(complaint_type) LIKE '%street%' THEN 'Street Issues'
    WHEN lower(complaint_type) LIKE '%traffic%' THEN 'Traffic Issues'
    WHEN lower(complaint_type) LIKE '%sidewalk%' THEN 'Sidewalk Issues'
    WHEN lower(complaint_type) LIKE '%bike%' THEN 'Bike Issues'
    WHEN lower(complaint_type) LIKE '%parking%' THEN 'Parking Issues'
    WHEN lower(complaint_type) LIKE '%ferry%' THEN 'Ferry Issues'
    ELSE 'Other' END"""
_SIDEWALK = "('sidewalk', 'both', 'openstreets')"
_ROADWAY = "('roadway', 'both', 'openstreets')"
_FIRST_REQUEST_DAY = "DATE '2026-08-01' - INTERVAL 7 YEAR"


def _with(blocks: str, select: str) -> str:
    named = ",\n".join(f"{b} AS (\n{TABLES[b]}\n)" for b in blocks.split())
    return f"WITH {named}\n{select}" if named else select


def _md5(*columns: str) -> str:
    parts = [f"coalesce(CAST({c} AS VARCHAR), '_dbt_utils_surrogate_key_null_')" for c in columns]
    return "md5(" + " || '-' || ".join(parts) + ")"


def _number(order: str) -> str:
    columns = ", ".join(f"{c} NULLS FIRST" for c in order.split())
    return f"row_number() OVER (ORDER BY {columns})"


def _hour_key(ts: str) -> str:
    return f"CAST(strftime({ts}, '%Y%m%d%H') AS BIGINT)"


HOUR_COLUMNS = f"""
  {_hour_key("h")} AS date_key, h AS full_datetime,
  year(h) AS year, month(h) AS month, day(h) AS day, hour(h) AS hour, dayname(h) AS day_of_week,
  CASE WHEN isodow(h) > 5 THEN 'Weekend' ELSE 'Weekday' END AS weekday_or_weekend,
  CASE WHEN hour(h) < 7 THEN 'OVERNIGHT' WHEN hour(h) < 10 THEN 'AM_PEAK' WHEN hour(h) < 16 THEN 'MIDDAY'
       WHEN hour(h) < 20 THEN 'PM_PEAK' ELSE 'EVENING' END AS peak_period"""

DAY_COLUMNS = f"""
  {_md5("full_date")} AS date_key, full_date, year(full_date) AS year, quarter(full_date) AS quarter,
  month(full_date) AS month, monthname(full_date) AS month_name, day(full_date) AS day_of_month,
  dayofweek(full_date) + 1 AS day_of_week, dayname(full_date) AS day_name,
  isodow(full_date) > 5 AS is_weekend, year(full_date + INTERVAL 6 MONTH) AS fiscal_year"""

# --- trade tables --------------------------------------------------------------------------------

TABLES["nations"] = "SELECT * FROM nation JOIN region ON n_regionkey = r_regionkey"

TABLES["stg_orders"] = """
SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderdate AS created_at,
  o_orderstatus AS status, nullif(o_orderpriority, '4-NOT SPECIFIED') AS priority,
  o_totalprice AS total_price, upper(r_name) AS borough, nullif(c_mktsegment, 'BUILDING') AS zip_code,
  n_name AS neighborhood, CAST(n_nationkey AS BIGINT) AS council_district
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nations ON c_nationkey = n_nationkey"""

TABLES["stg_shipments"] = """
SELECT l_orderkey || '-' || l_linenumber AS shipment_id, l_orderkey AS order_id, l_shipdate AS shipped_at,
  l_returnflag AS category, l_linestatus AS ship_status, l_suppkey AS route_id, l_partkey AS stop_id,
  l_quantity AS quantity, upper(r_name) AS borough, CAST(NULL AS VARCHAR) AS zip_code,
  CAST(NULL AS VARCHAR) AS neighborhood, CAST(NULL AS BIGINT) AS council_district
FROM (SELECT DISTINCT ON (l_orderkey, l_linenumber) * FROM lineitem
      ORDER BY l_orderkey, l_linenumber, l_shipdate DESC, l_partkey, l_suppkey, l_quantity, l_returnflag,
        l_linestatus)
JOIN supplier ON l_suppkey = s_suppkey JOIN nations ON s_nationkey = n_nationkey"""

TABLES["stg_requests"] = """
SELECT s.shipment_id AS request_id, o.created_at,
  CASE WHEN o.status = 'F' THEN s.shipped_at END AS closed_at, s.shipped_at, o.status, o.priority,
  s.borough, o.zip_code
FROM stg_shipments s JOIN stg_orders o ON s.order_id = o.order_id"""

TABLES["dim_hour"] = f"""
SELECT {HOUR_COLUMNS}
FROM (SELECT unnest(generate_series(date_trunc('hour', min(ts)), max(ts), INTERVAL 1 HOUR)) AS h
      FROM (SELECT created_at AS ts FROM stg_orders UNION ALL SELECT shipped_at FROM stg_shipments))"""

TABLES["dim_day"] = f"""
SELECT {DAY_COLUMNS}
FROM (SELECT CAST(o_orderdate AS DATE) AS full_date FROM orders
      UNION SELECT CAST(l_shipdate AS DATE) FROM lineitem)"""

TABLES["dim_location"] = f"""
SELECT {_number("borough zip_code neighborhood council_district")} AS location_key, *
FROM (SELECT borough, zip_code, neighborhood, council_district FROM stg_orders
      UNION SELECT borough, zip_code, neighborhood, council_district FROM stg_shipments)"""

TABLES["dim_location_hashed"] = f"""
SELECT {_md5("borough", "zip_code")} AS location_key, borough, zip_code
FROM (SELECT borough, zip_code FROM stg_orders UNION SELECT borough, zip_code FROM stg_shipments)
WHERE borough IS NOT NULL"""

TABLES["dim_problem"] = f"""
SELECT {_number("status priority")} AS problem_key, *
FROM (SELECT status, priority FROM stg_orders GROUP BY ALL)"""

TABLES["dim_problem_hashed"] = f"""
SELECT {_md5("status", "priority")} AS problem_key, status, priority FROM stg_orders
WHERE status IS NOT NULL GROUP BY ALL"""

TABLES["dim_type"] = f"""
SELECT {_number("category ship_status")} AS type_key, *
FROM (SELECT category, ship_status FROM stg_shipments GROUP BY ALL)"""

TABLES["dim_route"] = f"""
SELECT {_number("route_id")} AS route_key, route_id, 'CARRIER' AS agency_name
FROM (SELECT route_id FROM stg_shipments WHERE route_id IS NOT NULL GROUP BY ALL)"""

TABLES["dim_stop"] = f"""
SELECT {_number("stop_id")} AS stop_key, *
FROM (SELECT stop_id, min(category) AS category, min(quantity) AS quantity FROM stg_shipments
      WHERE stop_id IS NOT NULL GROUP BY stop_id)"""

TABLES["fact_orders"] = f"""
SELECT s.order_id, s.customer_id, {_hour_key("s.created_at")} AS date_key, l.location_key,
  p.problem_key, s.total_price, s.status, s.created_at
FROM stg_orders s
LEFT JOIN dim_location l ON s.borough = l.borough AND s.zip_code IS NOT DISTINCT FROM l.zip_code
  AND s.neighborhood = l.neighborhood AND s.council_district = l.council_district
LEFT JOIN dim_problem p ON s.status = p.status AND s.priority IS NOT DISTINCT FROM p.priority"""

TABLES["fact_shipments"] = f"""
SELECT s.shipment_id, {_hour_key("s.shipped_at")} AS date_key, l.location_key, t.type_key, r.route_key,
  d.stop_key, s.quantity, s.shipped_at
FROM stg_shipments s
LEFT JOIN dim_location l ON s.borough = l.borough AND l.zip_code IS NULL AND l.neighborhood IS NULL
  AND l.council_district IS NULL
LEFT JOIN dim_type t USING (category, ship_status)
LEFT JOIN dim_route r USING (route_id)
LEFT JOIN dim_stop d USING (stop_id)"""

TABLES["trade_facts"] = """
SELECT 'Orders' AS series, date_key, location_key FROM fact_orders
UNION ALL SELECT 'Shipments', date_key, location_key FROM fact_shipments"""

_STAGED = "nations stg_orders stg_shipments "
_STARS = _STAGED + "dim_location dim_problem dim_type dim_route dim_stop fact_orders fact_shipments "

SQL["safe_cast_types"] = """
SELECT o_orderkey AS order_id,
  CASE WHEN regexp_full_match(t, '[+-]?[0-9]+') THEN TRY_CAST(t AS BIGINT) END AS as_long,
  TRY_CAST(t AS DOUBLE) AS as_double,
  CASE WHEN t LIKE '____-__-__%' THEN TRY_CAST(t AS TIMESTAMP) END AS as_timestamp
FROM (SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')
        WHEN o_orderstatus = 'O' THEN CAST(o_orderkey AS VARCHAR)
        WHEN o_orderpriority = '5-LOW' THEN CAST(o_totalprice AS VARCHAR)
        ELSE o_orderpriority END AS t FROM orders)"""

SQL["strict_casts_reported"] = "\nUNION ALL ".join(
    f"""SELECT '{name}' AS column_name, count(*) AS bad_rows, min(t) AS least_text, max(t) AS greatest_text
FROM ({SQL["safe_cast_types"].replace("SELECT o_orderkey AS order_id,", "SELECT t,", 1)})
WHERE t IS NOT NULL AND {name} IS NULL"""
    for name in ("as_long", "as_double", "as_timestamp")
)

SQL["strict_cast_star_except"] = """
SELECT * EXCLUDE (c_custkey, c_acctbal), CAST(c_custkey AS VARCHAR) AS customer_id,
  CAST(CAST(CAST(c_acctbal AS VARCHAR) AS DECIMAL(38, 9)) AS DOUBLE) AS balance FROM customer"""

SQL["required_fields_filter"] = """
SELECT o_orderkey AS order_id, o_orderstatus AS status, o_orderpriority AS priority FROM orders
WHERE o_orderkey IS NOT NULL AND nullif(o_orderstatus, 'P') IS NOT NULL
  AND o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM')"""

SQL["or_like_filter"] = """
SELECT p_partkey, p_name, p_type FROM part WHERE p_type = 'PROMO' OR p_name LIKE '%ring%'"""

SQL["rolling_window_filter"] = """
SELECT o_orderkey, o_orderdate FROM orders
WHERE CAST(o_orderdate AS DATE) >= DATE '2001-08-01' - INTERVAL 2 YEAR"""

SQL["dedup_latest_lineitem"] = """
SELECT DISTINCT ON (l_orderkey, l_linenumber) l_orderkey, l_linenumber,
  CASE WHEN l_returnflag <> 'R' THEN l_shipdate END AS closed_at, l_shipdate AS created_at,
  l_partkey, l_suppkey
FROM lineitem
ORDER BY l_orderkey, l_linenumber, l_shipdate DESC, l_partkey, l_suppkey, closed_at NULLS FIRST"""

SQL["dedup_latest_landed"] = SQL["dedup_latest_lineitem"]

SQL["dedup_latest_simple"] = """
SELECT user_id, max(ts) AS ts, arg_min(event_id, (-epoch_us(ts), event_id)) AS event_id,
  arg_min(event_type, (-epoch_us(ts), event_id)) AS event_type FROM events GROUP BY user_id"""

SQL["prefix_classify_nation"] = _with(
    "nations",
    """
SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN 'UNKNOWN'
  WHEN starts_with(n_name, 'NATION_1') THEN 'ONE'
  WHEN starts_with(n_name, 'NATION_2') OR starts_with(n_name, 'NATION_3') THEN 'TWO OR THREE'
  ELSE 'REST' END AS nation_group
FROM customer JOIN nations ON c_nationkey = n_nationkey""",
)

SQL["standardize_region"] = _with(
    "nations",
    """
SELECT c_custkey, CASE r_name WHEN 'AFRICA' THEN 'Africa' WHEN 'AMERICA' THEN 'Americas'
  WHEN 'ASIA' THEN 'Asia-Pacific' WHEN 'EUROPE' THEN 'Europe' ELSE 'UNKNOWN' END AS region
FROM customer JOIN nations ON c_nationkey = n_nationkey""",
)

SQL["keyword_category_part"] = """
SELECT p_partkey, p_name, CASE WHEN contains(p_name, 'ring') THEN 'Rings'
  WHEN contains(p_name, 'widget') THEN 'Widgets' WHEN contains(p_name, 'bolt') THEN 'Bolts'
  WHEN contains(p_name, 'gear') THEN 'Gears' ELSE 'Other' END AS category FROM part"""

SQL["zip_clean"] = f"""
SELECT c_custkey, raw_zip, {_clean_zip("raw_zip")} AS zip_code
FROM (SELECT c_custkey, [d[5:9], d, d[1:5] || '-' || d[6:9], d || 'x', 'n/a', ' NA ', 'anonymous',
        d[6:9]][c_custkey % 8 + 1] AS raw_zip
      FROM (SELECT c_custkey, lpad(CAST(c_custkey AS VARCHAR), 9, '1') AS d FROM customer))"""

SQL["status_flags"] = """
SELECT o_orderkey, o_orderstatus = 'F' AS is_closed,
  o_orderpriority IN ('1-URGENT', '2-HIGH') AS is_high FROM orders"""

SQL["numeric_round_cast"] = """
SELECT p_partkey, sign * (p_size + 1) AS rounded, sign * (p_size + 0.5::DOUBLE) AS as_double,
  round(p_retailprice / 3.0::DOUBLE, 2) AS third_of_price
FROM (SELECT *, CASE WHEN p_partkey % 2 = 0 THEN -1 ELSE 1 END::BIGINT AS sign FROM part)"""

SQL["hash_surrogate_key"] = f"""
SELECT o_orderkey, {_md5("o_orderkey")} AS order_hash,
  {_md5("p", "CAST(o_orderdate AS DATE)", "o_orderstatus = 'F'")} AS attribute_hash,
  CASE WHEN p IS NOT NULL THEN md5(p || '-' || o_orderstatus) END AS problem_hash
FROM (SELECT *, nullif(o_orderpriority, '4-NOT SPECIFIED') AS p FROM orders)"""

SQL["hour_key_events"] = f"SELECT event_id, {_hour_key('ts')} AS date_key FROM events"

SQL["dim_date_hour"] = f"""
SELECT d.*, coalesce(n, 0) AS n_events
FROM (SELECT {HOUR_COLUMNS}
      FROM (SELECT unnest(generate_series(date_trunc('hour', min(ts)), max(ts), INTERVAL 1 HOUR)) AS h
            FROM events)) d
LEFT JOIN (SELECT date_trunc('hour', ts) AS h, count(*) AS n FROM events GROUP BY 1) e
  ON d.full_datetime = e.h"""

SQL["dim_date_observed"] = _with("dim_day", "SELECT * FROM dim_day")
SQL["dim_location_conformed"] = _with(_STAGED + "dim_location", "SELECT * FROM dim_location")
SQL["dim_location_hashed"] = _with(_STAGED + "dim_location_hashed", "SELECT * FROM dim_location_hashed")
SQL["dim_problem"] = _with("nations stg_orders dim_problem", "SELECT * FROM dim_problem")
SQL["dim_type"] = _with("nations stg_shipments dim_type", "SELECT * FROM dim_type")
SQL["dim_route"] = _with("nations stg_shipments dim_route", "SELECT * FROM dim_route")
SQL["dim_stop_any_value"] = _with("nations stg_shipments dim_stop", "SELECT * FROM dim_stop")

SQL["any_value_of_group"] = """
SELECT c_nationkey, count(*) AS n_customers, true AS is_member FROM customer GROUP BY c_nationkey"""
SQL["dim_grouped_max_avg"] = """
SELECT c_nationkey, segment, max(c_name) AS name, round(sum(balance) / count(balance), 6) AS balance
FROM (SELECT c_nationkey, nullif(c_mktsegment, 'BUILDING') AS segment, c_name,
        CAST(c_acctbal AS DECIMAL(18, 2)) AS balance FROM customer)
WHERE c_nationkey IS NOT NULL OR segment IS NOT NULL GROUP BY c_nationkey, segment"""

SQL["fk_lookup_null_safe"] = _with(
    _STAGED + "dim_location dim_problem fact_orders",
    "SELECT order_id, location_key, problem_key FROM fact_orders",
)
SQL["fk_lookup_strict"] = _with(
    "nations stg_orders",
    f"""SELECT order_id, CASE WHEN zip_code IS NOT NULL THEN {_md5("borough", "zip_code")} END AS location_key
FROM stg_orders""",
)
SQL["fk_lookup_mixed"] = _with(
    "nations stg_orders", f"SELECT order_id, {_md5('status', 'priority')} AS problem_key FROM stg_orders"
)
SQL["fk_lookup_large_dim"] = """
SELECT o_orderkey, o_custkey, md5(CAST(c_custkey AS VARCHAR)) AS customer_key
FROM orders LEFT JOIN customer ON o_custkey = c_custkey"""
SQL["role_playing_dates"] = _with(
    _STAGED + "stg_requests",
    """SELECT request_id, md5(CAST(CAST(created_at AS DATE) AS VARCHAR)) AS order_date_key,
  md5(CAST(CAST(shipped_at AS DATE) AS VARCHAR)) AS ship_date_key FROM stg_requests""",
)
SQL["fk_lookup_derived_flags"] = _with(
    "nations stg_orders",
    """
SELECT order_id, CASE WHEN (priority IN ('1-URGENT', '2-HIGH')) = (status = 'F')
    AND (priority IN ('1-URGENT', '5-LOW')) = (status <> 'P')
  THEN md5(priority || '-' || (status = 'F') || '-' || (status <> 'P')) END AS kind_key
FROM stg_orders""",
)

for _name in ("fact_orders", "fact_shipments"):
    SQL[_name] = _with(_STARS, f"SELECT * FROM {_name}")

SQL["fact_requests"] = _with(
    _STAGED + "stg_requests dim_day",
    f"""
SELECT md5(request_id) AS request_key, request_id, created_at, closed_at, a.date_key AS created_date_key,
  b.date_key AS closed_date_key, CAST(NULL AS VARCHAR) AS none_key,
  CASE WHEN r.zip_code IS NOT NULL AND EXISTS (SELECT 1 FROM stg_orders o
         WHERE o.borough = r.borough AND o.zip_code = r.zip_code)
       THEN {_md5("r.borough", "r.zip_code")} END AS location_key,
  {_md5("status", "priority")} AS problem_key,
  CAST(closed_at AS DATE) - CAST(created_at AS DATE) AS days_to_close,
  status = 'F' AS is_closed, status
FROM stg_requests r LEFT JOIN dim_day a ON a.full_date = CAST(created_at AS DATE)
LEFT JOIN dim_day b ON b.full_date = CAST(closed_at AS DATE)""",
).replace(" CAST(NULL AS VARCHAR) AS none_key,", "")

SQL["duration_minutes"] = """
SELECT user_id, m AS duration_minutes, -m AS backward_minutes
FROM (SELECT user_id, (epoch_us(max(ts)) - epoch_us(min(ts))) // 60000000 AS m FROM events GROUP BY user_id)"""

SQL["days_to_close"] = _with(
    _STAGED + "stg_requests",
    "SELECT request_id, CAST(closed_at AS DATE) - CAST(created_at AS DATE) AS days_to_close FROM stg_requests",
)


def _series(by: str, join: str, facts: str, blocks: str) -> str:
    return _with(
        blocks,
        f"""SELECT {by}, series, count(*) AS event_count FROM {facts} f JOIN {join}
GROUP BY ALL ORDER BY ALL""",
    )


_BY_PLACE = "dim_location USING (location_key)"
SQL["q1_region_series"] = _series("borough", _BY_PLACE, "trade_facts", _STARS + "trade_facts")
SQL["drilldown_location"] = _series(
    "borough, neighborhood, zip_code", _BY_PLACE, "trade_facts", _STARS + "trade_facts"
)
for _name, _by in (
    ("q2_year_series", "year"),
    ("q3_month_series", "CAST(date_trunc('month', full_datetime) AS DATE) AS month_start"),
    ("q4_weekday_series", "day_of_week"),
):
    SQL[_name] = _series(_by, "dim_hour USING (date_key)", "trade_facts", _STARS + "dim_hour trade_facts")

SQL["q5_type_share"] = _with(
    "nations stg_shipments",
    """
SELECT borough, category, n AS violation_count, round(n * 100.0::DOUBLE / sum(n) OVER (PARTITION BY borough), 2)
  AS borough_share
FROM (SELECT borough, category, count(*) AS n FROM stg_shipments GROUP BY ALL)""",
)
SQL["scorecards"] = """
SELECT 'total_orders' AS metric, count(*) AS value FROM orders
UNION ALL SELECT 'total_shipments', count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)"""
SQL["peak_period_series"] = """
SELECT CASE WHEN hour(ts) < 7 THEN 'OVERNIGHT' WHEN hour(ts) < 10 THEN 'AM_PEAK' WHEN hour(ts) < 16
  THEN 'MIDDAY' WHEN hour(ts) < 20 THEN 'PM_PEAK' ELSE 'EVENING' END AS peak_period,
  event_type AS series, count(*) AS event_count FROM events GROUP BY ALL"""

# --- quality -------------------------------------------------------------------------------------


def _check(kind: str, table: str, column: str, failures: str) -> str:
    return f"SELECT '{table}' AS table_name, '{column}' AS column_name, '{kind}' AS check_name, ({failures}) AS failures"


def not_null(table: str, column: str) -> str:
    return _check("not_null", table, column, f"SELECT count(*) - count({column}) FROM {table}")


def unique(table: str, column: str) -> str:
    twice = f"SELECT {column} FROM {table} WHERE {column} IS NOT NULL GROUP BY 1 HAVING count(*) > 1"
    return _check("unique", table, column, f"SELECT count(*) FROM ({twice})")


def accepted(table: str, column: str, *values: str) -> str:
    listed = ", ".join(f"'{v}'" for v in values)
    return _check(
        "accepted_values", table, column, f"SELECT count(*) FROM {table} WHERE {column} NOT IN ({listed})"
    )


def related(table: str, column: str, parent: str, parent_column: str) -> str:
    known = f"SELECT {parent_column} FROM {parent} WHERE {parent_column} IS NOT NULL"
    return _check(
        "relationships", table, column, f"SELECT count(*) FROM {table} WHERE {column} NOT IN ({known})"
    )


def _suite(blocks: str, *checks: str) -> str:
    return _with(blocks, "\nUNION ALL ".join(checks))


SQL["dq_not_null"] = _suite(
    _STAGED,
    not_null("stg_orders", "order_id"),
    not_null("stg_orders", "zip_code"),
    not_null("stg_orders", "priority"),
    not_null("stg_shipments", "shipment_id"),
    not_null("stg_shipments", "neighborhood"),
)
SQL["dq_unique"] = _suite(
    _STAGED,
    unique("stg_orders", "order_id"),
    unique("stg_orders", "customer_id"),
    unique("stg_shipments", "shipment_id"),
    _check(
        "unique",
        "lineitem",
        "line_id",
        "SELECT count(*) FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)",
    ),
)
SQL["dq_accepted_values"] = _suite(
    _STAGED,
    accepted("stg_orders", "priority", "1-URGENT", "2-HIGH", "3-MEDIUM", "5-LOW"),
    accepted("stg_orders", "status", "F", "O"),
)
SQL["dq_relationships"] = _suite(
    _STAGED,
    related("stg_shipments", "order_id", "stg_orders", "order_id"),
    related("stg_orders", "customer_id", "supplier", "s_suppkey"),
    related("events", "user_id", "customer", "c_custkey"),
)
SQL["dq_report"] = _suite(
    _STARS + "dim_hour",
    unique("dim_location", "location_key"),
    not_null("dim_location", "location_key"),
    unique("fact_orders", "order_id"),
    unique("fact_shipments", "shipment_id"),
    not_null("fact_orders", "location_key"),
    not_null("fact_shipments", "stop_key"),
    related("fact_orders", "location_key", "dim_location", "location_key"),
    related("fact_orders", "date_key", "dim_hour", "date_key"),
    related("fact_shipments", "type_key", "dim_type", "type_key"),
    related("fact_shipments", "route_key", "dim_route", "route_key"),
    related("fact_shipments", "stop_key", "dim_stop", "stop_key"),
)

# --- raw feeds -----------------------------------------------------------------------------------

_BOROUGHS = (
    "['MANHATTAN', ' new york county ', 'The Bronx', 'bronx', 'BROOKLYN', ' kings county' || chr(9), "
    "'QUEEN', 'Queens County', 'STATEN ISLAND', 'Citywide']"
)
_ZIPS = "['N/A', ' na  ', 'anonymous', '10001', 'ABCDE', '100011234', '10001-1234', '10001x1234', '1001']"
_TYPES = (
    "['STREET condition', 'Traffic Signal Condition', 'Sidewalk Condition', 'Bike Rack Condition', "
    "'Broken Parking Meter', 'Ferry Complaint', 'Noise']"
)
_ROUTES = "['M', 'B', 'Bx', 'BxM', 'BM', 'QM', 'X', 'Q', 'S', 'SIM', 'm', 'Z']"


def _four(n: str) -> str:
    return f"lpad(CAST({n} % 10000 AS VARCHAR), 4, '0')"


def _three(n: str) -> str:
    return f"lpad(CAST({n} AS VARCHAR), 3, '0')"


def _plain(columns: list[str], derived: str, n: str) -> str:
    """The columns that ``derived`` does not define, each with a value that names it."""
    named = {line.rsplit(" AS ", 1)[1].strip() for line in derived.strip().splitlines()}
    return ",\n  ".join(f"'{c} ' || {n} % 3 AS {c}" for c in columns if c not in named)


def _list(derived: str) -> str:
    return ",\n  ".join(line.strip() for line in derived.strip().splitlines())


TABLES["raw_311"] = f"""
SELECT CASE WHEN o_orderstatus = 'P' AND c % 50 = 7 THEN 'K' ELSE '' END || k AS unique_key,
  CASE WHEN again AND c % 41 = 0 THEN 'not a date' ELSE strftime(t, '%Y-%m-%d %H:%M:%S') END AS created_date,
  CASE WHEN again AND o_orderstatus = 'F'
       THEN strftime(t + to_days(CAST(k % 9 AS INT)) + to_seconds(c % 86400), '%Y-%m-%d %H:%M:%S')
       WHEN again AND o_orderstatus = 'P' THEN 'pending' END AS closed_date,
  ['DOT', NULL, 'NYPD', 'NYPD'][c % 4 + 1] AS agency,
  CASE WHEN c % 43 = 5 THEN 'illegal parking' WHEN c % 43 = 6 THEN 'Abandoned Vehicle' ELSE
  CASE left(o_orderpriority, 1) WHEN '1' THEN 'Illegal Parking' WHEN '2' THEN 'Blocked Driveway'
    WHEN '3' THEN 'Double Parked Blocking Vehicle' WHEN '5' THEN 'Posted Parking Sign Violation'
    ELSE CASE o_orderstatus WHEN 'F' THEN 'Blocked Bike Lane' WHEN 'O' THEN 'Double Parked Blocking Traffic'
      ELSE 'Noise' END END END AS complaint_type,
  CASE WHEN c % 7 <> 0 THEN 'Detail ' || c % 7 END AS descriptor,
  CASE WHEN NOT again THEN 'Open' WHEN o_orderstatus = 'F' THEN 'Closed'
    WHEN o_orderstatus = 'O' THEN 'In Progress' ELSE 'Open' END AS status,
  ['Bronx', 'BROOKLYN', 'Manhattan', 'QUEENS', 'Staten Island',
   CASE WHEN k % 2 = 1 THEN 'Unspecified' END][c % 6 + 1] AS borough,
  CASE WHEN c % 10 <> 0 THEN '10' || {_three("c % 300")} END AS incident_zip,
  CASE WHEN c % 5 <> 0 THEN lpad(CAST(c % 18 AS VARCHAR), 2, '0') || ' BOARD' END AS community_board,
  CASE c % 20 WHEN 0 THEN NULL WHEN 1 THEN 'x' ELSE CAST(c % 51 AS VARCHAR) END AS council_district,
  CASE WHEN c % 30 = 0 THEN '' ELSE '40.' || {_four("k")} END AS latitude,
  '-73.' || {_four("k")} AS longitude
FROM (SELECT *, o_orderkey AS k, o_custkey AS c, unnest([false, true]) AS again,
        o_orderdate + to_days(9131) + to_hours(o_custkey % 24) + to_seconds(o_orderkey % 3600) AS t
      FROM orders)"""

TABLES["raw_ace"] = f"""
SELECT CASE WHEN p % 67 <> 0 THEN 'V' || k || '-' || l_linenumber END AS violation_id,
  CASE WHEN l_suppkey % 61 = 0 THEN 'bad' ELSE strftime(t, '%Y-%m-%dT%H:%M:%S') || '.000' END AS first_occurrence,
  CASE WHEN NOT (l_returnflag = 'R' AND l_linestatus = 'O')
       THEN strftime(t + to_seconds(CAST(trunc(l_quantity * 37 - 60) AS BIGINT)), '%Y-%m-%dT%H:%M:%S') || '.000'
       END AS last_occurrence,
  CASE l_returnflag WHEN 'A' THEN 'MOBILE BUS STOP' WHEN 'N' THEN 'MOBILE BUS LANE'
    ELSE 'MOBILE DOUBLE PARKED' END AS violation_type,
  CASE WHEN l_linestatus = 'F' THEN 'VIOLATION ISSUED' WHEN p % 3 <> 0 THEN 'EXEMPT' END AS violation_status,
  {_ROUTES}[l_suppkey % 13 + 1] || l_suppkey % 40 AS bus_route_id,
  CASE WHEN p % 23 <> 0 THEN 'S' || p END AS stop_id,
  'STOP ' || p || '/' || l_linenumber % 2 AS stop_name,
  CASE WHEN k % 50 = 0 THEN 'n/a' ELSE '40.' || {_four("k")} END AS violation_latitude,
  '-73.' || {_four("k")} AS violation_longitude,
  '40.' || {_four("p")} AS bus_stop_latitude, '-73.' || {_four("p")} AS bus_stop_longitude
FROM (SELECT *, l_orderkey AS k, l_partkey AS p,
        l_shipdate + to_days(9131) + to_minutes(l_partkey % 1440) + to_seconds(l_orderkey % 60) AS t
      FROM lineitem)"""

_REQUEST = f"""
  CASE WHEN u % 53 <> 0 THEN CAST(k AS VARCHAR) END AS unique_key
  CASE WHEN u % 59 <> 0 THEN strftime(t, '%Y-%m-%d %H:%M:%S') END AS created_date
  CASE WHEN done THEN strftime(t + to_days(CAST(k % 40 AS INT)), '%Y-%m-%d %H:%M:%S') END AS closed_date
  CASE WHEN event_type = 'error' THEN 'XYZ' WHEN housing THEN 'DOB' ELSE 'DOT' END AS agency
  'Department of ' || CASE WHEN housing THEN 'Buildings' ELSE 'Transportation' END AS agency_name
  {_TYPES}[u % 8 + 1] AS complaint_type
  CASE event_type WHEN 'view' THEN 'Pothole' WHEN 'error' THEN 'Cave-in' WHEN 'purchase' THEN CASE WHEN u % 8 = 0 THEN '' END END AS descriptor
  coalesce({_ZIPS}[u % 12 + 1], '10' || {_three("u % 200")}) AS incident_zip
  u || ' Main St' AS incident_address
  CASE WHEN u % 13 <> 0 THEN '40.' || {_four("k")} END AS latitude
  CASE WHEN u % 13 <> 0 THEN '-73.' || {_four("k")} END AS longitude
  CASE WHEN k % 2 = 0 THEN 'ADDRESS' ELSE 'INTERSECTION' END AS address_type
  {_BOROUGHS}[u % 11 + 1] AS borough
  ['ONLINE', 'PHONE', 'MOBILE'][k % 3 + 1] AS open_data_channel_type
  CASE WHEN done THEN props END AS resolution_description
  CASE WHEN done THEN ' closed ' WHEN NOT (again AND event_type = 'error') THEN 'In Progress' END AS status
"""
TABLES["raw_dot"] = f"""
SELECT {_list(_REQUEST)},
  {_plain(SERVICE_REQUESTS, _REQUEST, "u")}
FROM (SELECT *, again AND event_type IN ('click', 'purchase', 'view') AS done,
        event_type = 'signup' AND u % 2 = 0 AS housing
      FROM (SELECT *, event_id AS k, user_id AS u, unnest([false, true]) AS again,
              ts - to_days(CAST(365 * (user_id % 10) AS INT)) AS t FROM events))"""

_ANSWER = "CASE o_orderstatus WHEN 'F' THEN 'yes' WHEN 'O' THEN 'Yes' END"
_APPLICATION = f"""
  CASE WHEN NOT (o_orderstatus = 'P' AND c % 37 = 0) THEN CAST(c AS VARCHAR) END AS objectid
  'G-' || k AS globalid
  strftime(o_orderdate + to_days(9131) + to_seconds(k % 86400), '%Y-%m-%d %H:%M:%S') AS time_of_submission
  'Cafe ' || c AS restaurant_name
  'Legal ' || c % 100 AS legal_business_name
  'DBA ' || c % 70 AS doing_business_as_dba
  CAST(c % 500 AS VARCHAR) AS bulding_number
  'Street ' || c % 80 AS street
  {_BOROUGHS}[c % 11 + 1] AS borough
  coalesce({_ZIPS}[c % 12 + 1], '10' || {_three("c % 200")}) AS zip
  CASE WHEN c % 29 <> 0 THEN c // 3 || ' Main St' END AS business_address
  CASE WHEN c % 17 <> 0 THEN '40.' || {_four("c")} END AS latitude
  CASE WHEN c % 17 <> 0 THEN '-73.' || {_four("c")} END AS longitude
  ['sidewalk', 'roadway', 'both', 'openstreets'][c % 5 + 1] AS seating_interest_sidewalk
  CASE o_orderstatus WHEN 'P' THEN 'no' ELSE 'yes' END AS approved_for_sidewalk_seating
  CASE o_orderstatus WHEN 'F' THEN 'yes' WHEN 'O' THEN 'no' END AS approved_for_roadway_seating
  CASE WHEN c % 19 <> 0 THEN c % 20 || '.5' END AS sidewalk_dimensions_length
  CAST(c % 9 AS VARCHAR) AS sidewalk_dimensions_width
  c % 300 || '.49' AS sidewalk_dimensions_area
  c % 20 || '.5' AS roadway_dimensions_length
  '-' || c % 9 || '.25' AS roadway_dimensions_width
  CASE WHEN c % 19 <> 0 THEN CAST(c % 400 AS VARCHAR) END AS roadway_dimensions_area
  {_ANSWER} AS qualify_alcohol
  CASE WHEN c % 2 = 0 THEN {_ANSWER} END AS landmark_district_or_building
  CASE WHEN c % 3 = 0 THEN 'yes' ELSE 'no' END AS healthcompliance_terms
  CASE WHEN c % 31 <> 0 THEN 'P' || c // 3 END AS food_service_establishment
"""
TABLES["raw_apps"] = f"""
SELECT {_list(_APPLICATION)},
  {_plain(SEATING_APPLICATIONS, _APPLICATION, "c")}
FROM (SELECT *, o_orderkey AS k, o_custkey AS c FROM orders)"""

# --- complaints and camera violations ------------------------------------------------------------

TABLES["s311"] = f"""
SELECT DISTINCT ON (complaint_id) * FROM (
  SELECT TRY_CAST(unique_key AS BIGINT) AS complaint_id, TRY_CAST(created_date AS TIMESTAMP) AS created_at,
    TRY_CAST(closed_date AS TIMESTAMP) AS closed_at, agency, complaint_type, descriptor AS problem_detail,
    status, upper(borough) AS borough, incident_zip AS zip_code, community_board AS neighborhood,
    TRY_CAST(council_district AS BIGINT) AS council_district, TRY_CAST(latitude AS DOUBLE) AS latitude,
    TRY_CAST(longitude AS DOUBLE) AS longitude
  FROM raw_311 WHERE complaint_type IN {_CURB_TYPES})
WHERE complaint_id + epoch_us(created_at) IS NOT NULL AND borough IS NOT NULL
ORDER BY complaint_id, coalesce(closed_at, created_at) DESC, created_at, closed_at NULLS FIRST, status"""

TABLES["sace"] = f"""
SELECT DISTINCT ON (violation_id) * FROM (
  SELECT violation_id, TRY_CAST(first_occurrence AS TIMESTAMP) AS first_occurrence,
    TRY_CAST(last_occurrence AS TIMESTAMP) AS last_occurrence, violation_type AS violation_category,
    violation_status, bus_route_id, stop_id, stop_name,
    TRY_CAST(violation_latitude AS DOUBLE) AS violation_latitude,
    TRY_CAST(violation_longitude AS DOUBLE) AS violation_longitude,
    TRY_CAST(bus_stop_latitude AS DOUBLE) AS bus_stop_latitude,
    TRY_CAST(bus_stop_longitude AS DOUBLE) AS bus_stop_longitude,
    {_route_borough("bus_route_id")} AS borough,
    CAST(NULL AS VARCHAR) AS zip_code, CAST(NULL AS VARCHAR) AS neighborhood,
    CAST(NULL AS BIGINT) AS council_district
  FROM raw_ace WHERE violation_id IS NOT NULL AND bus_route_id IS NOT NULL)
WHERE first_occurrence IS NOT NULL
ORDER BY violation_id, coalesce(last_occurrence, first_occurrence) DESC, first_occurrence NULLS FIRST,
  last_occurrence NULLS FIRST, violation_category, violation_status NULLS FIRST, bus_route_id,
  stop_id NULLS FIRST, stop_name, bus_stop_latitude, bus_stop_longitude"""

TABLES["hours"] = f"""
SELECT {HOUR_COLUMNS}
FROM (SELECT TIMESTAMP '2019-01-01' + to_hours(range) AS h FROM range(70081))"""

TABLES["locations"] = f"""
SELECT {_number("borough zip_code neighborhood council_district")} AS location_key, *
FROM (SELECT borough, zip_code, neighborhood, council_district FROM s311
      UNION SELECT borough, zip_code, neighborhood, council_district FROM sace)"""
TABLES["problems"] = f"""
SELECT {_number("agency complaint_type problem_detail")} AS problem_key, *
FROM (SELECT agency, complaint_type, problem_detail FROM s311 GROUP BY ALL)"""
TABLES["kinds"] = f"""
SELECT {_number("violation_category violation_status")} AS violation_type_key, *
FROM (SELECT violation_category, violation_status FROM sace GROUP BY ALL)"""
TABLES["routes"] = f"""
SELECT {_number("bus_route_id")} AS route_key, bus_route_id, 'MTA' AS agency_name
FROM (SELECT bus_route_id FROM sace GROUP BY ALL)"""
TABLES["stops"] = f"""
SELECT {_number("stop_id")} AS bus_stop_key, *
FROM (SELECT stop_id, min(stop_name) AS stop_name, min(bus_stop_latitude) AS bus_stop_latitude,
        min(bus_stop_longitude) AS bus_stop_longitude FROM sace WHERE stop_id IS NOT NULL GROUP BY stop_id)"""

_SAME_PLACE = " AND ".join(
    f"s.{c} IS NOT DISTINCT FROM l.{c}" for c in ("borough", "zip_code", "neighborhood", "council_district")
)
TABLES["f311"] = f"""
SELECT complaint_id AS unique_key, {_hour_key("created_at")} AS date_key, location_key, problem_key, latitude,
  longitude, status, created_at AS created_date
FROM s311 s LEFT JOIN locations l ON {_SAME_PLACE}
LEFT JOIN problems p ON s.agency IS NOT DISTINCT FROM p.agency AND s.complaint_type = p.complaint_type
  AND s.problem_detail IS NOT DISTINCT FROM p.problem_detail"""
TABLES["face"] = f"""
SELECT violation_id, {_hour_key("first_occurrence")} AS date_key, location_key, violation_type_key, route_key,
  bus_stop_key, violation_latitude, violation_longitude, first_occurrence, last_occurrence,
  CAST(trunc((epoch_us(last_occurrence) - epoch_us(first_occurrence)) / 60000000) AS BIGINT) AS duration_minutes
FROM sace s LEFT JOIN locations l ON {_SAME_PLACE}
LEFT JOIN kinds k ON s.violation_category = k.violation_category
  AND s.violation_status IS NOT DISTINCT FROM k.violation_status
LEFT JOIN routes r ON s.bus_route_id = r.bus_route_id LEFT JOIN stops b ON s.stop_id = b.stop_id"""
TABLES["marts"] = """
SELECT 'ACE Violations' AS series, date_key, location_key FROM face
UNION ALL SELECT '311 Complaints', date_key, location_key FROM f311"""

_CURB_STAGED = "raw_311 raw_ace s311 sace "
_CURB = _CURB_STAGED + "locations problems kinds routes stops f311 face "

for _name, _block in (
    ("stg_311", "s311"),
    ("stg_ace", "sace"),
    ("dim_location", "locations"),
    ("dim_311_problem", "problems"),
    ("dim_ace_violation_type", "kinds"),
    ("dim_bus_route", "routes"),
    ("dim_bus_stop", "stops"),
    ("fact_311_complaints", "f311"),
    ("fact_ace_violations", "face"),
):
    SQL[f"model_{_name}"] = _with(_CURB, f"SELECT * FROM {_block}")

SQL["model_dim_date"] = _with(
    _CURB_STAGED + "hours",
    """
SELECT h.*, coalesce(c.n, 0) AS complaints, coalesce(v.n, 0) AS violations FROM hours h
LEFT JOIN (SELECT date_trunc('hour', created_at) AS t, count(*) AS n FROM s311 GROUP BY 1) c ON c.t = full_datetime
LEFT JOIN (SELECT date_trunc('hour', first_occurrence) AS t, count(*) AS n FROM sace GROUP BY 1) v
  ON v.t = full_datetime""",
)
SQL["report_by_borough"] = _series("borough", "locations USING (location_key)", "marts", _CURB + "marts")
for _name, _by in (
    ("year", "year"),
    ("month", "CAST(date_trunc('month', full_datetime) AS DATE) AS month_start"),
    ("weekday", "day_of_week"),
):
    SQL[f"report_by_{_name}"] = _series(_by, "hours USING (date_key)", "marts", _CURB + "hours marts")
SQL["report_type_share_by_borough"] = _with(
    "raw_ace sace",
    """
SELECT borough, violation_category, n AS violation_count,
  round(n * 100.0::DOUBLE / sum(n) OVER (PARTITION BY borough), 2) AS borough_share
FROM (SELECT borough, violation_category, count(*) AS n FROM sace GROUP BY ALL)""",
)
SQL["report_total_violations"] = _with("raw_ace sace", "SELECT count(*) AS total_ace_violations FROM sace")
SQL["report_total_complaints"] = _with("raw_311 s311", "SELECT count(*) AS total_311_complaints FROM s311")

_MODEL_BLOCKS = {
    "stg_311": "s311",
    "stg_ace": "sace",
    "dim_date": "hours",
    "dim_location": "locations",
    "dim_311_problem": "problems",
    "dim_ace_violation_type": "kinds",
    "dim_bus_route": "routes",
    "dim_bus_stop": "stops",
    "fact_311_complaints": "f311",
    "fact_ace_violations": "face",
}


def _key(table: str, column: str) -> list[str]:
    return [not_null(table, column), unique(table, column)]


TABLES |= {name: f"SELECT * FROM {block}" for name, block in _MODEL_BLOCKS.items() if name != "dim_location"}
_RENAMED = " ".join(name for name in _MODEL_BLOCKS if name != "dim_location")
SQL["checks_enforcement"] = _suite(
    _CURB + "hours " + _RENAMED,
    *_key("stg_311", "complaint_id"),
    not_null("stg_311", "created_at"),
    not_null("stg_311", "borough"),
    not_null("stg_311", "complaint_type"),
    *_key("stg_ace", "violation_id"),
    not_null("stg_ace", "first_occurrence"),
    not_null("stg_ace", "bus_route_id"),
    not_null("stg_ace", "borough"),
    *_key("dim_date", "date_key"),
    not_null("dim_date", "full_datetime"),
    accepted("dim_date", "peak_period", "AM_PEAK", "MIDDAY", "PM_PEAK", "EVENING", "OVERNIGHT"),
    *_key("locations", "location_key"),
    not_null("locations", "borough"),
    *_key("dim_311_problem", "problem_key"),
    *_key("fact_311_complaints", "unique_key"),
    not_null("fact_311_complaints", "date_key"),
    related("fact_311_complaints", "date_key", "dim_date", "date_key"),
    related("fact_311_complaints", "location_key", "locations", "location_key"),
    related("fact_311_complaints", "problem_key", "dim_311_problem", "problem_key"),
    *_key("dim_ace_violation_type", "violation_type_key"),
    *_key("dim_bus_route", "route_key"),
    *_key("dim_bus_route", "bus_route_id"),
    *_key("dim_bus_stop", "bus_stop_key"),
    *_key("dim_bus_stop", "stop_id"),
    *_key("fact_ace_violations", "violation_id"),
    not_null("fact_ace_violations", "date_key"),
    related("fact_ace_violations", "date_key", "dim_date", "date_key"),
    related("fact_ace_violations", "location_key", "locations", "location_key"),
    related("fact_ace_violations", "violation_type_key", "dim_ace_violation_type", "violation_type_key"),
    related("fact_ace_violations", "route_key", "dim_bus_route", "route_key"),
    related("fact_ace_violations", "bus_stop_key", "dim_bus_stop", "bus_stop_key"),
).replace("'locations' AS table_name", "'dim_location' AS table_name")

# --- requests and seating applications -----------------------------------------------------------


def _exact(column: str) -> str:
    return f"CAST({column} AS DECIMAL(38, 9)) AS {column}"


TABLES["sdot"] = f"""
SELECT * EXCLUDE (unique_key, created_date, closed_date, agency, agency_name, complaint_type, descriptor,
    status, incident_zip, borough, incident_address, street_name, cross_street_1, cross_street_2, latitude,
    longitude, open_data_channel_type),
  unique_key AS request_id, CAST(created_date AS TIMESTAMP) AS created_date,
  CAST(closed_date AS TIMESTAMP) AS closed_date, agency, agency_name, complaint_type, descriptor,
  upper(trim(status)) AS status, {_clean_zip("incident_zip")} AS incident_zip, {_standard_borough("borough")} AS borough,
  incident_address, street_name, cross_street_1, cross_street_2, {_exact("latitude")}, {_exact("longitude")},
  open_data_channel_type AS method_of_submission
FROM (SELECT DISTINCT ON (unique_key) * FROM raw_dot
      WHERE (agency = 'DOT' OR contains(agency_name, 'Transportation')) AND unique_key IS NOT NULL
        AND CAST(created_date AS DATE) >= {_FIRST_REQUEST_DAY} AND borough IS NOT NULL
      ORDER BY unique_key, created_date DESC, closed_date DESC NULLS LAST, status NULLS FIRST)"""

TABLES["sapps"] = f"""
SELECT globalid, street, objectid AS application_id, CAST(time_of_submission AS TIMESTAMP) AS time_of_submission,
  restaurant_name, legal_business_name, doing_business_as_dba AS doing_business_as,
  bulding_number AS building_number, business_address AS full_address, {_clean_zip("zip")} AS zip,
  {_standard_borough("borough")} AS borough, food_service_establishment AS food_service_establishment_permit,
  seating_interest_sidewalk AS seating_interest, approved_for_sidewalk_seating, approved_for_roadway_seating,
  {_exact("sidewalk_dimensions_length")}, {_exact("sidewalk_dimensions_width")},
  {_exact("sidewalk_dimensions_area")}, {_exact("roadway_dimensions_length")},
  {_exact("roadway_dimensions_width")}, {_exact("roadway_dimensions_area")}, {_exact("latitude")},
  {_exact("longitude")}, qualify_alcohol AS alcohol_qualified, sla_serial_number, sla_license_type,
  landmark_district_or_building AS landmark_status, landmarkdistrict_terms AS landmark_terms,
  healthcompliance_terms AS health_compliance_terms, community_board, council_district, census_tract, bin,
  bbl, nta
FROM (SELECT DISTINCT ON (objectid) * FROM raw_apps WHERE objectid IS NOT NULL
      ORDER BY objectid, time_of_submission DESC, globalid)"""

TABLES["days"] = f"""
SELECT {DAY_COLUMNS}
FROM (SELECT CAST(created_date AS DATE) AS full_date FROM sdot
      UNION SELECT CAST(time_of_submission AS DATE) FROM sapps)"""
TABLES["places"] = f"""
SELECT {_md5("borough", "zip_code")} AS location_key, *
FROM (SELECT borough, incident_zip AS zip_code FROM sdot UNION SELECT borough, zip FROM sapps)"""
TABLES["types"] = f"""
SELECT {_md5("complaint_type", "descriptor")} AS complaint_type_key, complaint_type, descriptor,
  {_COMPLAINT_CATEGORY} AS complaint_category
FROM sdot WHERE complaint_type IS NOT NULL GROUP BY ALL"""
TABLES["restaurants"] = f"""
SELECT {_md5("food_service_establishment_permit", "full_address")} AS restaurant_key,
  max(restaurant_name) AS restaurant_name, max(legal_business_name) AS legal_business_name,
  max(doing_business_as) AS doing_business_as, full_address, round(avg(latitude), 9) AS latitude,
  round(avg(longitude), 9) AS longitude, food_service_establishment_permit
FROM sapps WHERE coalesce(food_service_establishment_permit, full_address) IS NOT NULL
GROUP BY food_service_establishment_permit, full_address"""
TABLES["seatings"] = f"""
SELECT md5(seating_interest || '-' || approved_for_sidewalk || '-' || approved_for_roadway) AS seating_type_key, *
FROM (SELECT DISTINCT seating_interest, seating_interest IN {_SIDEWALK} AS approved_for_sidewalk,
        seating_interest IN {_ROADWAY} AS approved_for_roadway
      FROM sapps WHERE seating_interest IS NOT NULL)"""
TABLES["fdot"] = """
SELECT md5(request_id) AS request_key, request_id, created_date AS request_created_at,
  closed_date AS request_closed_at, a.date_key AS created_date_key, b.date_key AS closed_date_key,
  location_key, complaint_type_key, incident_address, address_type, street_name, cross_street_1,
  cross_street_2, latitude, longitude, CAST(closed_date AS DATE) - CAST(created_date AS DATE) AS days_to_close,
  status IS NOT DISTINCT FROM 'CLOSED' AS is_closed, status, method_of_submission AS channel_type,
  resolution_description
FROM sdot r LEFT JOIN days a ON a.full_date = CAST(created_date AS DATE)
LEFT JOIN days b ON b.full_date = CAST(closed_date AS DATE)
LEFT JOIN places p ON p.borough = r.borough AND p.zip_code = r.incident_zip
LEFT JOIN types t ON t.complaint_type = r.complaint_type
  AND ifnull(t.descriptor, '') = ifnull(r.descriptor, '')"""
TABLES["fapps"] = """
SELECT md5(application_id) AS application_key, application_id AS objectid,
  time_of_submission AS application_submitted, date_key AS submission_date_key, location_key, restaurant_key,
  seating_type_key, r.full_address AS business_address, street, building_number,
  CAST(r.latitude AS DOUBLE) AS latitude, CAST(r.longitude AS DOUBLE) AS longitude,
  CAST(round(sidewalk_dimensions_length) AS BIGINT) AS sidewalk_length_ft,
  CAST(round(sidewalk_dimensions_width) AS BIGINT) AS sidewalk_width_ft,
  CAST(round(sidewalk_dimensions_area) AS BIGINT) AS sidewalk_area_sqft,
  alcohol_qualified IS NOT DISTINCT FROM 'yes' AS qualify_alcohol,
  landmark_status IS NOT DISTINCT FROM 'yes' AS is_landmark_location,
  health_compliance_terms IS NOT DISTINCT FROM 'yes' AS health_compliance_terms_accepted,
  sla_serial_number, sla_license_type
FROM sapps r LEFT JOIN days d ON d.full_date = CAST(time_of_submission AS DATE)
LEFT JOIN places p ON p.borough = r.borough AND p.zip_code = r.zip
LEFT JOIN restaurants e ON e.food_service_establishment_permit = r.food_service_establishment_permit
  AND e.full_address = r.full_address
LEFT JOIN seatings s ON s.seating_interest = r.seating_interest
  AND s.approved_for_sidewalk = (r.approved_for_sidewalk_seating IS NOT DISTINCT FROM 'yes')
  AND s.approved_for_roadway = (r.approved_for_roadway_seating IS NOT DISTINCT FROM 'yes')"""

_STREET = "raw_dot raw_apps sdot sapps days places types restaurants seatings fdot fapps"
for _name, _block in (
    ("stg_nyc_311_dot", "sdot"),
    ("stg_nyc_open_restaurant_apps", "sapps"),
    ("dim_date_assignment", "days"),
    ("dim_location_assignment", "places"),
    ("dim_complaint_type", "types"),
    ("dim_restaurant", "restaurants"),
    ("dim_seating_type", "seatings"),
    ("fact_311_dot_requests", "fdot"),
    ("fact_restaurant_applications", "fapps"),
):
    SQL[f"model_{_name}"] = _with(_STREET, f"SELECT * FROM {_block}")
_DECIMALS = {
    "stg_nyc_311_dot": ["latitude", "longitude"],
    "fact_311_dot_requests": ["latitude", "longitude"],
    "stg_nyc_open_restaurant_apps": [
        *[f"{a}_dimensions_{b}" for a in ("sidewalk", "roadway") for b in ("length", "width", "area")],
        "latitude",
        "longitude",
    ],
}
for _name, _columns in _DECIMALS.items():
    _as_double = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in _columns)
    SQL[f"model_{_name}"] = f"SELECT * REPLACE ({_as_double}) FROM ({SQL[f'model_{_name}']})"

# Files with a further column: the typed models leave it out, the others pass it through.
for _name in ("stg_311", "stg_ace"):
    SQL[f"scan_{_name}"] = SQL[f"model_{_name}"]
    SQL[f"view_{_name}"] = SQL[f"model_{_name}"]
for _name in ("stg_nyc_311_dot", "stg_nyc_open_restaurant_apps"):
    SQL[f"scan_{_name}"] = f"SELECT *, 'kept' AS undeclared FROM ({SQL[f'model_{_name}']})"
# Reports over marts written before.
for _name in ("report_by_borough", "report_by_year"):
    SQL[f"opened_{_name}"] = SQL[_name]
SQL["opened_report_beside_broken_build"] = SQL["report_by_year"]
for _name in ("by_borough", "by_month", "type_share_by_borough", "total_complaints"):
    SQL[f"summary_{_name}"] = SQL[f"report_{_name}"]
SQL["summary_drill_down"] = _with(
    _CURB + "hours",
    """
SELECT borough, violation_category, peak_period, 'ACE Violations' AS series, count(*) AS event_count
FROM face JOIN locations USING (location_key) JOIN kinds USING (violation_type_key) JOIN hours USING (date_key)
WHERE year = 2023 GROUP BY ALL""",
)
SQL["opened_report_one_year"] = _series(
    "month, peak_period", "(SELECT * FROM hours WHERE year = 2023) h USING (date_key)", "marts", _CURB + "hours marts"
)

SQL["model_test_311_sample"] = _with(
    "raw_dot", "SELECT unique_key, created_date, complaint_type, borough FROM raw_dot"
)
SQL["checks_sources"] = _suite(
    "raw_dot raw_apps",
    *_key("raw_dot", "unique_key"),
    *_key("raw_apps", "objectid"),
).replace("'raw_dot' AS", "'source_dot_service_requests_history' AS").replace(
    "'raw_apps' AS", "'source_nyc_open_restaurant_apps' AS"
)
