"""Registered queries: every operator on the trade tables, every model on the raw feeds."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from curbstar import fixed_values as fv
from curbstar.functions import calendar as cal
from curbstar.functions.clean import (
    categorize,
    classify_prefix,
    clean_zip,
    flag_eq,
    flag_in,
    round_to_long,
    standardize,
    strict_cast,
    within_years,
)
from curbstar.functions.keys import hash_fk, hash_key
from curbstar.operators.dedup import dedup_latest
from curbstar.operators.dims import distinct_dim, grouped_dim, hour_dim_spanning, representative
from curbstar.operators.lookup import Lookup, build_fact, lookup_fk, lookup_role, natural
from curbstar.operators.project import CheckedCasts, require, safe_project, strict_project
from curbstar.operators.quality import run_checks
from curbstar.operators.reports import Series, scorecards, series_counts, share_within
from curbstar.plans import applications, enforcement, raw_feeds, trade
from curbstar.plans.base import Plan
from curbstar.plans.raw_feeds import read
from curbstar.sources.readers import read_raw
from curbstar.sources.store import Store, Warehouse

Query = Callable[[SparkSession, str], DataFrame]

AS_OF = date(2026, 8, 1)
REPORT_YEAR = 2023
REGION_SYNONYMS = {
    "Africa": ["AFRICA"],
    "Americas": ["AMERICA", "THE AMERICAS"],
    "Asia-Pacific": ["ASIA", "PACIFIC"],
    "Europe": ["EUROPE"],
}
NATION_PREFIXES = [(["NATION_1"], "ONE"), (["NATION_2", "NATION_3"], "TWO OR THREE"), (["NATION_"], "REST")]
PRODUCT_KEYWORDS = [("ring", "Rings"), ("widget", "Widgets"), ("bolt", "Bolts"), ("gear", "Gears")]
HIGH, OUTER = ["1-URGENT", "2-HIGH"], ["1-URGENT", "5-LOW"]


# --- staging operators ---------------------------------------------------------------------------


def mixed_texts(spark: SparkSession, sf: str) -> DataFrame:
    """Numbers, times and words in one text column."""
    status = F.col("o_orderstatus")
    mixed = (
        F.when(status == "F", F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"))
        .when(status == "O", F.col("o_orderkey").cast("string"))
        .when(F.col("o_orderpriority") == "5-LOW", F.col("o_totalprice").cast("string"))
        .otherwise(F.col("o_orderpriority"))
    )
    return read(spark, sf, "orders").select(F.col("o_orderkey"), mixed.alias("text"))


def safe_cast_types(spark: SparkSession, sf: str) -> DataFrame:
    return safe_project(
        mixed_texts(spark, sf),
        {
            "order_id": "o_orderkey",
            "as_long": ("text", "bigint"),
            "as_double": ("text", "double"),
            "as_timestamp": ("text", "timestamp"),
        },
    )


def strict_casts_reported(spark: SparkSession, sf: str) -> DataFrame:
    """What strict casts of mixed texts would fail on, gathered by the job that writes the table."""
    casts = CheckedCasts(
        {"as_long": ("text", "bigint"), "as_double": ("text", "double"), "as_timestamp": ("text", "timestamp")}
    )
    Store.scratch(spark).table("staging", "cast", casts.project(mixed_texts(spark, sf), ["text"]))
    rows = [
        F.struct(
            F.lit(name).alias("column_name"),
            F.lit(bad.rows).cast("bigint").alias("bad_rows"),
            F.lit(bad.least).cast("string").alias("least_text"),
            F.lit(bad.greatest).cast("string").alias("greatest_text"),
        )
        for name, bad in casts.report().items()
    ]
    return spark.range(1).select(F.inline(F.array(*rows)))


def strict_cast_star_except(spark: SparkSession, sf: str) -> DataFrame:
    customer = read(spark, sf, "customer").withColumn("balance_text", F.col("c_acctbal").cast("string"))
    projected = strict_project(
        customer,
        ["c_custkey", "c_acctbal", "balance_text"],
        {
            "customer_id": strict_cast("c_custkey", "string"),
            "balance": strict_cast("balance_text", fv.NUMERIC),
        },
    )
    return plain(projected)


def required_fields_filter(spark: SparkSession, sf: str) -> DataFrame:
    orders = read(spark, sf, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.nullif("o_orderstatus", F.lit("P")).alias("status"),
        F.col("o_orderpriority").alias("priority"),
    )
    return require(orders, ["order_id", "status"], {"priority": ["1-URGENT", "2-HIGH", "3-MEDIUM"]})


def or_like_filter(spark: SparkSession, sf: str) -> DataFrame:
    part = read(spark, sf, "part")
    return part.filter((F.col("p_type") == "PROMO") | F.col("p_name").contains("ring")).select(
        "p_partkey", "p_name", "p_type"
    )


def rolling_window_filter(spark: SparkSession, sf: str) -> DataFrame:
    orders = read(spark, sf, "orders")
    return orders.filter(within_years("o_orderdate", 2, F.lit(date(2001, 8, 1)))).select(
        "o_orderkey", "o_orderdate"
    )


def line_versions(spark: SparkSession, sf: str) -> DataFrame:
    return read(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.when(F.col("l_returnflag") != "R", F.col("l_shipdate")).alias("closed_at"),
        F.col("l_shipdate").alias("created_at"),
        "l_partkey",
        "l_suppkey",
    )


def latest_lines(lines: DataFrame) -> DataFrame:
    latest = F.coalesce("closed_at", "created_at")
    return dedup_latest(
        lines, ["l_orderkey", "l_linenumber"], latest, ["l_partkey", "l_suppkey", "closed_at"]
    )


def dedup_latest_lineitem(spark: SparkSession, sf: str) -> DataFrame:
    """Latest by ship date, or by the order's epoch where a returned line has none."""
    return latest_lines(line_versions(spark, sf))


def dedup_latest_landed(spark: SparkSession, sf: str) -> DataFrame:
    """The same from a landing in buckets of the record key, without a shuffle."""
    lines = line_versions(spark, sf)
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    landed = Store.scratch(spark).land("raw", "lines", lines, ["l_orderkey", "l_linenumber"], buckets)
    return latest_lines(landed)


def dedup_latest_simple(spark: SparkSession, sf: str) -> DataFrame:
    events = read(spark, sf, "events").select("user_id", "ts", "event_id", "event_type")
    return dedup_latest(events, ["user_id"], F.col("ts"), ["event_id"])


def prefix_classify_nation(spark: SparkSession, sf: str) -> DataFrame:
    text = F.when(F.col("c_mktsegment") != "BUILDING", F.lower("n_name")).otherwise(F.col("c_mktsegment"))
    return trade.located(spark, sf, "customer", "c_nationkey").select(
        "c_custkey", classify_prefix(text, NATION_PREFIXES, "UNKNOWN").alias("nation_group")
    )


def standardize_region(spark: SparkSession, sf: str) -> DataFrame:
    padded = F.concat(F.lit(" "), F.lower("r_name"), F.lit("\t"))
    return trade.located(spark, sf, "customer", "c_nationkey").select(
        "c_custkey", standardize(padded, REGION_SYNONYMS, "UNKNOWN").alias("region")
    )


def keyword_category_part(spark: SparkSession, sf: str) -> DataFrame:
    part = read(spark, sf, "part")
    category = categorize(F.upper("p_name"), PRODUCT_KEYWORDS, "Other")
    return part.select("p_partkey", "p_name", category.alias("category"))


def zip_clean(spark: SparkSession, sf: str) -> DataFrame:
    key = F.col("c_custkey")
    digits = F.lpad(key.cast("string"), 9, "1")
    spelled = [
        F.substring(digits, 5, 5),
        digits,
        F.concat(F.substring(digits, 1, 5), F.lit("-"), F.substring(digits, 6, 4)),
        F.concat(digits, F.lit("x")),
        F.lit("n/a"),
        F.lit(" NA "),
        F.lit("anonymous"),
        F.substring(digits, 6, 4),
    ]
    raw = F.get(F.array(*spelled), (key % 8).cast("int"))
    return read(spark, sf, "customer").select(
        "c_custkey", raw.alias("raw_zip"), clean_zip(raw).alias("zip_code")
    )


def status_flags(spark: SparkSession, sf: str) -> DataFrame:
    priority = F.nullif("o_orderpriority", F.lit("4-NOT SPECIFIED"))
    return read(spark, sf, "orders").select(
        "o_orderkey",
        flag_eq(F.nullif("o_orderstatus", F.lit("P")), "F").alias("is_closed"),
        flag_in(priority, HIGH).alias("is_high"),
    )


def numeric_round_cast(spark: SparkSession, sf: str) -> DataFrame:
    sign = F.when(F.col("p_partkey") % 2 == 0, F.lit("-")).otherwise(F.lit(""))
    text = F.concat(sign, F.col("p_size"), F.lit(".5"))
    exact = strict_cast(text, fv.NUMERIC)
    return read(spark, sf, "part").select(
        "p_partkey",
        round_to_long(exact).alias("rounded"),
        exact.cast("double").alias("as_double"),
        F.round(F.col("p_retailprice") / F.lit(3.0), 2).alias("third_of_price"),
    )


def hash_surrogate_key(spark: SparkSession, sf: str) -> DataFrame:
    priority = F.nullif("o_orderpriority", F.lit("4-NOT SPECIFIED"))
    day, final = F.to_date("o_orderdate"), F.col("o_orderstatus") == "F"
    return read(spark, sf, "orders").select(
        "o_orderkey",
        hash_key("o_orderkey").alias("order_hash"),
        hash_key(priority, day, final).alias("attribute_hash"),
        hash_fk(priority, "o_orderstatus").alias("problem_hash"),
    )


def hour_key_events(spark: SparkSession, sf: str) -> DataFrame:
    return read(spark, sf, "events").select("event_id", cal.hour_key("ts").alias("date_key"))


# --- dimensions ----------------------------------------------------------------------------------


def dim_date_hour(spark: SparkSession, sf: str) -> DataFrame:
    """Every hour between the first and the last event, with its number of events."""
    events = read(spark, sf, "events").select("ts")
    counts = events.groupBy(cal.hour_key("ts").alias("date_key")).agg(F.count("*").alias("n_events"))
    hours = hour_dim_spanning(events, "ts").join(counts, "date_key", "left")
    return hours.fillna(0, ["n_events"])


def trade_table(name: str) -> Query:
    return lambda spark, sf: trade.Trade(spark, sf).plan(name)


def any_value_of_group(spark: SparkSession, sf: str) -> DataFrame:
    """Any segment of each nation's customers, which must be one of theirs."""
    customers = read(spark, sf, "customer").select("c_nationkey", "c_mktsegment")
    any_one = representative("c_mktsegment", deterministic=False)
    picked = grouped_dim(
        customers, ["c_nationkey"], {"c_mktsegment": any_one, "n_customers": F.count("*")}
    )
    members = customers.distinct().withColumn("is_member", F.lit(True))
    found = picked.join(members, ["c_nationkey", "c_mktsegment"], "left")
    return found.fillna(False, ["is_member"]).drop("c_mktsegment")


def dim_grouped_max_avg(spark: SparkSession, sf: str) -> DataFrame:
    customers = read(spark, sf, "customer").select(
        "c_nationkey",
        F.nullif("c_mktsegment", F.lit("BUILDING")).alias("segment"),
        "c_name",
        F.col("c_acctbal").cast(fv.NUMERIC).alias("balance"),
    )
    identified = customers.filter(F.col("c_nationkey").isNotNull() | F.col("segment").isNotNull())
    grouped = grouped_dim(
        identified,
        ["c_nationkey", "segment"],
        {"name": F.max("c_name"), "balance": F.avg("balance").cast(fv.NUMERIC)},
    )
    return grouped.withColumn("balance", F.round(F.col("balance").cast("double"), 6))


# --- foreign keys and measures -------------------------------------------------------------------


def fk_lookup_null_safe(spark: SparkSession, sf: str) -> DataFrame:
    t = trade.Trade(spark, sf)
    orders, place, problem = t.together("stg_orders", "dim_location", "dim_problem")
    by_place = Lookup(place, "location_key", natural(*trade.LOCATION), null_safe=True)
    by_problem = Lookup(problem, "problem_key", natural(*trade.PROBLEM), null_safe={"priority"})
    return build_fact(orders, [by_place, by_problem], ["order_id", "location_key", "problem_key"])


def fk_lookup_strict(spark: SparkSession, sf: str) -> DataFrame:
    t = trade.Trade(spark, sf)
    by_place = Lookup(t.table("dim_location_hashed"), "location_key", natural(*trade.HASHED_LOCATION))
    return lookup_fk(t.table("stg_orders"), by_place).select("order_id", "location_key")


def fk_lookup_mixed(spark: SparkSession, sf: str) -> DataFrame:
    t = trade.Trade(spark, sf)
    by_problem = Lookup(
        t.table("dim_problem_hashed"), "problem_key", natural(*trade.PROBLEM), null_as={"priority": ""}
    )
    return lookup_fk(t.table("stg_orders"), by_problem).select("order_id", "problem_key")


def fk_lookup_large_dim(spark: SparkSession, sf: str) -> DataFrame:
    """Orders to the customer dimension by the shuffle route, with hot customers apart."""
    dim = read(spark, sf, "customer").select("c_custkey", hash_key("c_custkey").alias("customer_key"))
    orders = read(spark, sf, "orders").select("o_orderkey", "o_custkey")
    lookup = Lookup(dim, "customer_key", {"c_custkey": "o_custkey"})
    return lookup_fk(orders, lookup, small=False, spread_by=["o_orderkey"], hot_rows=20)


def role_playing_dates(spark: SparkSession, sf: str) -> DataFrame:
    requests, days = trade.Trade(spark, sf).together("stg_requests", "dim_day")
    roles = {"created_at": "order_date_key", "shipped_at": "ship_date_key"}
    return lookup_role(requests, days, roles).select(
        "request_id", "order_date_key", "ship_date_key"
    )


def fk_lookup_derived_flags(spark: SparkSession, sf: str) -> DataFrame:
    """The dimension derives its flags from the priority, the fact from the status."""
    t = trade.Trade(spark, sf)
    orders, priority = t.table("stg_orders"), F.col("priority")
    columns = [
        priority,
        flag_in(priority, HIGH).alias("is_high"),
        flag_in(priority, OUTER).alias("is_outer"),
    ]
    kinds = distinct_dim(orders, columns, not_null=["priority"])
    dim = t.store.table("marts", "dim_kind", kinds.select(hash_key(*kinds.columns).alias("kind_key"), "*"))
    on = {
        "priority": "priority",
        "is_high": flag_eq("status", "F"),
        "is_outer": flag_in("status", ["F", "O"]),
    }
    return lookup_fk(orders, Lookup(dim, "kind_key", on)).select("order_id", "kind_key")


def duration_minutes(spark: SparkSession, sf: str) -> DataFrame:
    spans = read(spark, sf, "events").groupBy("user_id").agg(F.min("ts").alias("a"), F.max("ts").alias("b"))
    return spans.select(
        "user_id",
        cal.minutes_between("a", "b").alias("duration_minutes"),
        cal.minutes_between("b", "a").alias("backward_minutes"),
    )


def days_to_close(spark: SparkSession, sf: str) -> DataFrame:
    requests = trade.Trade(spark, sf).plan("stg_requests")
    return requests.select("request_id", cal.days_between("created_at", "closed_at").alias("days_to_close"))


# --- reports -------------------------------------------------------------------------------------


def q1_region_series(spark: SparkSession, sf: str) -> DataFrame:
    return _by_location(spark, sf, "borough")


def _by_location(spark: SparkSession, sf: str, *by: str) -> DataFrame:
    series = trade.Trade(spark, sf).series("dim_location", "location_key", "dim_location")
    return series_counts(series, natural(*by))


def _by_date(spark: SparkSession, sf: str, **by) -> DataFrame:
    return series_counts(trade.Trade(spark, sf).series("dim_hour", "date_key"), by)


def q2_year_series(spark: SparkSession, sf: str) -> DataFrame:
    return _by_date(spark, sf, year="year")


def q3_month_series(spark: SparkSession, sf: str) -> DataFrame:
    return _by_date(spark, sf, month_start=cal.month_start("full_datetime"))


def q4_weekday_series(spark: SparkSession, sf: str) -> DataFrame:
    return _by_date(spark, sf, day_of_week="day_of_week")


def q5_type_share(spark: SparkSession, sf: str) -> DataFrame:
    t = trade.Trade(spark, sf)
    return share_within(
        t.fact("fact_shipments", "dim_location", "dim_type"),
        (t.table("dim_location"), "location_key", "borough"),
        (t.table("dim_type"), "type_key", "category"),
        "violation_count",
        "borough_share",
    )


def scorecard_totals(spark: SparkSession, sf: str) -> DataFrame:
    t = trade.Trade(spark, sf)
    facts = {"total_orders": t.plan("stg_orders"), "total_shipments": t.plan("stg_shipments")}
    return scorecards(facts)


def peak_period_series(spark: SparkSession, sf: str) -> DataFrame:
    events = read(spark, sf, "events").select(cal.hour_key("ts").alias("date_key"), "event_type", "ts")
    series = Series(F.col("event_type"), events, hour_dim_spanning(events, "ts"), "date_key")
    return series_counts([series], natural("peak_period"))


def drilldown_location(spark: SparkSession, sf: str) -> DataFrame:
    return _by_location(spark, sf, "borough", "neighborhood", "zip_code")


# --- quality -------------------------------------------------------------------------------------


def quality(*names: str, checks: list) -> Query:
    """The checks over the trade plan's tables and the raw trade tables they name."""

    def query(spark: SparkSession, sf: str) -> DataFrame:
        t = trade.Trade(spark, sf)
        built = [name for name in names if name in t.tables]
        tables = dict(zip(built, t.together(*built)))
        tables |= {name: read(spark, sf, name) for name in names if name not in built}
        if "lineitem" in tables:
            line_id = F.concat(F.col("l_orderkey"), F.lit("-"), F.col("l_linenumber"))
            tables["lineitem"] = tables["lineitem"].select(line_id.alias("line_id"))
        return run_checks(tables, checks)

    return query


# --- models on the raw feeds ---------------------------------------------------------------------


Routes = Mapping[str, Callable[[DataFrame], DataFrame]]


def routed(feeds: Mapping[str, DataFrame], routes: Routes) -> dict[str, DataFrame]:
    """The feeds, some of them by another route."""
    return {name: routes[name](feed) if name in routes else feed for name, feed in feeds.items()}


def enforcement_plan(spark: SparkSession, sf: str, routes: Routes = {}) -> enforcement.Enforcement:
    feeds = {
        "source_nyc_311_traffic": raw_feeds.complaints(spark, sf),
        "source_mta_ace_violations": raw_feeds.camera_violations(spark, sf),
    }
    return enforcement.Enforcement(Store.scratch(spark), routed(feeds, routes))


def applications_plan(spark: SparkSession, sf: str, routes: Routes = {}) -> applications.Applications:
    feeds = {
        "source_dot_service_requests_history": raw_feeds.service_requests(spark, sf),
        "source_nyc_open_restaurant_apps": raw_feeds.seating_applications(spark, sf),
    }
    plan = applications.Applications(Store.scratch(spark), routed(feeds, routes))
    plan.as_of = AS_OF
    return plan


def enforcement_model(name: str) -> Query:
    return lambda spark, sf: enforcement_plan(spark, sf).plan(name)


def enforcement_report(name: str) -> Query:
    return lambda spark, sf: getattr(enforcement_plan(spark, sf), name)()


def applications_model(name: str) -> Query:
    return lambda spark, sf: plain(applications_plan(spark, sf).plan(name))


def calendar_use(spark: SparkSession, sf: str) -> DataFrame:
    """The generated hour calendar with the number of complaints and violations in each hour."""
    e = enforcement_plan(spark, sf)
    days = e.plan("dim_date")
    for fact, ts, name in (
        ("stg_311", "created_at", "complaints"),
        ("stg_ace", "first_occurrence", "violations"),
    ):
        (rows,) = e.staged(fact)
        counts = rows.groupBy(cal.hour_key(ts).alias("date_key")).agg(F.count("*").alias(name))
        days = days.join(counts, "date_key", "left")
    return days.fillna(0, ["complaints", "violations"])


def scanned(spark: SparkSession, name: str, feed: DataFrame) -> DataFrame:
    """The feed by way of files, with a column that its schema does not declare."""
    path = f"{Store.scratch(spark).root}/{name}"
    feed.withColumn("undeclared", F.lit("kept")).write.parquet(path)
    return read_raw(spark, name, path)


def scan_model(plan: Callable[..., Plan], source: str, name: str) -> Query:
    """A staging model of files that the reader scans."""

    def query(spark: SparkSession, sf: str) -> DataFrame:
        made = plan(spark, sf, {source: lambda feed: scanned(spark, source, feed)})
        return plain(made.plan(name))

    return query


def view_of_staging(source: str, name: str) -> Query:
    """A staging model as a catalog view over the extract's files."""

    def query(spark: SparkSession, sf: str) -> DataFrame:
        store = Store.scratch(spark)
        feed = enforcement_plan(spark, sf).sources[source]
        store.table("raw", source, feed)
        return enforcement.publish_staging(store, {source: f"parquet.`{store.path('raw', source)}`"})[name]

    return query


def published(spark: SparkSession, sf: str, summarize: bool = False) -> enforcement.Enforcement:
    """A plan that has built and published a warehouse."""
    plan = enforcement_plan(spark, sf)
    plan.store = Warehouse(spark, plan.store.root)
    plan.build(summarize=summarize)
    return plan


def opened(spark: SparkSession, plan: enforcement.Enforcement) -> enforcement.Enforcement:
    """The same warehouse as another session finds it."""
    return enforcement.Enforcement.open(Warehouse(spark, plan.store.root))


def opened_report(
    name: str, *attributes: str, where: str | None = None, summarize: bool = False
) -> Query:
    """A report over marts that another plan has published, from its facts or from the summary."""

    def query(spark: SparkSession, sf: str) -> DataFrame:
        report = getattr(opened(spark, published(spark, sf, summarize)), name)
        return report(*attributes, where=F.expr(where)) if where else report(*attributes)

    return query


def report_beside_broken_build(spark: SparkSession, sf: str) -> DataFrame:
    """A report over published marts while a later build, of half the extracts, has ended half-way."""
    plan = published(spark, sf)
    halves = {name: feed.filter(F.xxhash64(*feed.columns) % 2 == 0) for name, feed in plan.sources.items()}
    later = enforcement.Enforcement(Warehouse(spark, plan.store.root), halves)
    later.together("stg_311", "stg_ace")
    later.together("dim_location", "dim_date", "fact_311_complaints")
    return opened(spark, plan).by_year()


def enforcement_checks(spark: SparkSession, sf: str) -> DataFrame:
    """All checks of a build, those on single rows counted while its tables are written."""
    return enforcement_plan(spark, sf).build_checked(enforcement.CHECKS)


def source_checks(spark: SparkSession, sf: str) -> DataFrame:
    return run_checks(applications_plan(spark, sf).sources, applications.SOURCE_CHECKS)


def plain(df: DataFrame) -> DataFrame:
    """Without the load time, and exact numbers as doubles, for comparison with other engines."""
    out = []
    for f in df.schema.fields:
        if f.name == "_stg_loaded_at":
            continue
        exact = isinstance(f.dataType, T.DecimalType)
        out.append(F.col(f.name).cast("double").alias(f.name) if exact else F.col(f.name))
    return df.select(*out)


QUERIES: dict[str, Query] = {
    "safe_cast_types": safe_cast_types,
    "strict_cast_star_except": strict_cast_star_except,
    "strict_casts_reported": strict_casts_reported,
    "required_fields_filter": required_fields_filter,
    "or_like_filter": or_like_filter,
    "rolling_window_filter": rolling_window_filter,
    "dedup_latest_lineitem": dedup_latest_lineitem,
    "dedup_latest_landed": dedup_latest_landed,
    "dedup_latest_simple": dedup_latest_simple,
    "prefix_classify_nation": prefix_classify_nation,
    "standardize_region": standardize_region,
    "keyword_category_part": keyword_category_part,
    "zip_clean": zip_clean,
    "status_flags": status_flags,
    "numeric_round_cast": numeric_round_cast,
    "hash_surrogate_key": hash_surrogate_key,
    "hour_key_events": hour_key_events,
    "dim_date_hour": dim_date_hour,
    "dim_date_observed": trade_table("dim_day"),
    "dim_location_conformed": trade_table("dim_location"),
    "dim_location_hashed": trade_table("dim_location_hashed"),
    "dim_problem": trade_table("dim_problem"),
    "dim_type": trade_table("dim_type"),
    "dim_route": trade_table("dim_route"),
    "dim_stop_any_value": trade_table("dim_stop"),
    "dim_grouped_max_avg": dim_grouped_max_avg,
    "any_value_of_group": any_value_of_group,
    "fk_lookup_null_safe": fk_lookup_null_safe,
    "fk_lookup_strict": fk_lookup_strict,
    "fk_lookup_mixed": fk_lookup_mixed,
    "fk_lookup_large_dim": fk_lookup_large_dim,
    "role_playing_dates": role_playing_dates,
    "fk_lookup_derived_flags": fk_lookup_derived_flags,
    "fact_orders": trade_table("fact_orders"),
    "fact_shipments": trade_table("fact_shipments"),
    "fact_requests": trade_table("fact_requests"),
    "duration_minutes": duration_minutes,
    "days_to_close": days_to_close,
    "q1_region_series": q1_region_series,
    "q2_year_series": q2_year_series,
    "q3_month_series": q3_month_series,
    "q4_weekday_series": q4_weekday_series,
    "q5_type_share": q5_type_share,
    "scorecards": scorecard_totals,
    "peak_period_series": peak_period_series,
    "drilldown_location": drilldown_location,
    "dq_not_null": quality("stg_orders", "stg_shipments", checks=trade.NOT_NULL_CHECKS),
    "dq_unique": quality("stg_orders", "stg_shipments", "lineitem", checks=trade.UNIQUE_CHECKS),
    "dq_accepted_values": quality("stg_orders", checks=trade.ACCEPTED_CHECKS),
    "dq_relationships": quality(
        "stg_orders", "stg_shipments", "supplier", "events", "customer", checks=trade.RELATED_CHECKS
    ),
    "dq_report": quality(
        "dim_location",
        "dim_hour",
        "dim_type",
        "dim_route",
        "dim_stop",
        "fact_orders",
        "fact_shipments",
        checks=trade.STAR_CHECKS,
    ),
    # The generated calendar alone would be fixed data, so it is joined with what it is for.
    "model_dim_date": calendar_use,
    **{
        f"model_{name}": enforcement_model(name)
        for name in enforcement.Enforcement.tables
        if name != "dim_date"
    },
    "report_by_borough": enforcement_report("by_borough"),
    "report_by_year": enforcement_report("by_year"),
    "report_by_month": enforcement_report("by_month"),
    "report_by_weekday": enforcement_report("by_weekday"),
    "report_type_share_by_borough": enforcement_report("type_share_by_borough"),
    "report_total_violations": enforcement_report("total_violations"),
    "report_total_complaints": enforcement_report("total_complaints"),
    "opened_report_by_borough": opened_report("by_borough"),
    "opened_report_by_year": opened_report("by_year"),
    "opened_report_one_year": opened_report("by_date", "month", "peak_period", where=f"year = {REPORT_YEAR}"),
    "opened_report_beside_broken_build": report_beside_broken_build,
    **{
        f"summary_{name}": opened_report(name, summarize=True)
        for name in ("by_borough", "by_month", "type_share_by_borough", "total_complaints")
    },
    "summary_drill_down": opened_report(
        "drill_down", "borough", "violation_category", "peak_period",
        where=f"year = {REPORT_YEAR}", summarize=True,
    ),
    "scan_stg_311": scan_model(enforcement_plan, "source_nyc_311_traffic", "stg_311"),
    "scan_stg_ace": scan_model(enforcement_plan, "source_mta_ace_violations", "stg_ace"),
    "view_stg_311": view_of_staging("source_nyc_311_traffic", "stg_311"),
    "view_stg_ace": view_of_staging("source_mta_ace_violations", "stg_ace"),
    "scan_stg_nyc_311_dot": scan_model(
        applications_plan, "source_dot_service_requests_history", "stg_nyc_311_dot"
    ),
    "scan_stg_nyc_open_restaurant_apps": scan_model(
        applications_plan, "source_nyc_open_restaurant_apps", "stg_nyc_open_restaurant_apps"
    ),
    "checks_enforcement": enforcement_checks,
    **{f"model_{name}": applications_model(name) for name in applications.Applications.tables},
    "checks_sources": source_checks,
}
