"""The same star-schema operators on the trade tables: orders versus shipments.

Orders know their full location, shipments only a region, as complaints and camera events do.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curbstar.functions import calendar as cal
from curbstar.functions.clean import flag_eq
from curbstar.functions.keys import hash_key
from curbstar.operators.dedup import dedup_latest
from curbstar.operators.dims import (
    conformed_dim,
    date_dim_from,
    distinct_dim,
    grouped_dim,
    hour_dim_spanning,
    representative,
    sequence_key,
)
from curbstar.operators.lookup import (
    Lookup,
    build_fact,
    lookup_columns,
    lookup_role,
    natural,
    star_lookups,
)
from curbstar.operators.quality import Accepted, NotNull, Related, Unique
from curbstar.operators.reports import Series
from curbstar.plans.base import Plan
from curbstar.plans.raw_feeds import read
from curbstar.sources.store import Store

LOCATION = ["borough", "zip_code", "neighborhood", "council_district"]
HASHED_LOCATION = ["borough", "zip_code"]
PROBLEM = ["status", "priority"]
TYPE = ["category", "ship_status"]

# Foreign keys by dimension: key, natural key, NULL matches NULL.
ORDER_KEYS = {
    "dim_location": ("location_key", LOCATION, True),
    "dim_problem": ("problem_key", PROBLEM, True),
}
SHIPMENT_KEYS = {
    "dim_location": ("location_key", LOCATION, True),
    "dim_type": ("type_key", TYPE, True),
    "dim_route": ("route_key", ["route_id"], False),
    "dim_stop": ("stop_key", ["stop_id"], False),
}
PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "5-LOW")


def regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations with the name of their region."""
    nation, region = read(spark, sf_dir, "nation"), read(spark, sf_dir, "region")
    return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"))


def located(spark: SparkSession, sf_dir: str, table: str, nation_key: str) -> DataFrame:
    """Customers or suppliers with their nation and region."""
    nations = regions(spark, sf_dir)
    return read(spark, sf_dir, table).join(nations, F.col(nation_key) == F.col("n_nationkey"))


def stg_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = lookup_columns(
        read(spark, sf_dir, "orders"),
        located(spark, sf_dir, "customer", "c_nationkey"),
        {"c_custkey": "o_custkey"},
        ["c_mktsegment", "n_nationkey", "n_name", "r_name"],
        spread_by=["o_orderkey"],
    )
    return placed.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").alias("created_at"),
        F.col("o_orderstatus").alias("status"),
        F.nullif("o_orderpriority", F.lit("4-NOT SPECIFIED")).alias("priority"),
        F.col("o_totalprice").alias("total_price"),
        F.upper("r_name").alias("borough"),
        F.nullif("c_mktsegment", F.lit("BUILDING")).alias("zip_code"),
        F.col("n_name").alias("neighborhood"),
        F.col("n_nationkey").cast("bigint").alias("council_district"),
    )


def latest_lineitem(lineitem: DataFrame) -> DataFrame:
    """The latest version of every order line; all other columns, in order, settle ties."""
    keys = ["l_orderkey", "l_linenumber"]
    tiebreak = [c for c in lineitem.columns if c not in (*keys, "l_shipdate")]
    return dedup_latest(lineitem, keys, F.col("l_shipdate"), tiebreak)


def stg_shipments(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = "l_orderkey l_linenumber l_shipdate l_partkey l_suppkey l_quantity l_returnflag l_linestatus"
    lines = read(spark, sf_dir, "lineitem").select(*columns.split())
    shipped = lookup_columns(
        latest_lineitem(lines),
        located(spark, sf_dir, "supplier", "s_nationkey"),
        {"s_suppkey": "l_suppkey"},
        ["r_name"],
        spread_by=["l_orderkey", "l_linenumber"],
        hot_from=lines,
    )
    return shipped.select(
        F.concat(F.col("l_orderkey"), F.lit("-"), F.col("l_linenumber")).alias("shipment_id"),
        F.col("l_orderkey").alias("order_id"),
        F.col("l_shipdate").alias("shipped_at"),
        F.col("l_returnflag").alias("category"),
        F.col("l_linestatus").alias("ship_status"),
        F.col("l_suppkey").alias("route_id"),
        F.col("l_partkey").alias("stop_id"),
        F.col("l_quantity").alias("quantity"),
        F.upper("r_name").alias("borough"),
        F.lit(None).cast("string").alias("zip_code"),
        F.lit(None).cast("string").alias("neighborhood"),
        F.lit(None).cast("bigint").alias("council_district"),
    )


def stg_requests(shipments: DataFrame, orders: DataFrame) -> DataFrame:
    """Shipments as requests: opened by the order, closed by shipping where the order is final."""
    requests = lookup_columns(
        shipments.select("shipment_id", "order_id", "shipped_at", "borough"),
        orders,
        natural("order_id"),
        ["created_at", "status", "priority", "zip_code"],
        spread_by=["shipment_id"],
    )
    return requests.select(
        F.col("shipment_id").alias("request_id"),
        "created_at",
        F.when(F.col("status") == "F", F.col("shipped_at")).alias("closed_at"),
        F.col("shipped_at"),
        "status",
        "priority",
        "borough",
        "zip_code",
    )


def fact_orders(orders: DataFrame, dims: Mapping[str, DataFrame]) -> DataFrame:
    lookups = star_lookups(dims, ORDER_KEYS)
    return build_fact(
        orders,
        lookups,
        [
            "order_id",
            "customer_id",
            cal.hour_key("created_at").alias("date_key"),
            *[lookup.key for lookup in lookups],
            "total_price",
            "status",
            "created_at",
        ],
    )


def fact_shipments(shipments: DataFrame, dims: Mapping[str, DataFrame]) -> DataFrame:
    lookups = star_lookups(dims, SHIPMENT_KEYS)
    return build_fact(
        shipments,
        lookups,
        [
            "shipment_id",
            cal.hour_key("shipped_at").alias("date_key"),
            *[lookup.key for lookup in lookups],
            "quantity",
            "shipped_at",
        ],
    )


def fact_requests(requests: DataFrame, dims: Mapping[str, DataFrame]) -> DataFrame:
    roles = {"created_at": "created_date_key", "closed_at": "closed_date_key"}
    by_place = Lookup(dims["dim_location_hashed"], "location_key", natural(*HASHED_LOCATION))
    by_problem = Lookup(
        dims["dim_problem_hashed"], "problem_key", natural(*PROBLEM), null_as={"priority": ""}
    )
    return build_fact(
        lookup_role(requests, dims["dim_day"], roles),
        [by_place, by_problem],
        [
            hash_key("request_id").alias("request_key"),
            "request_id",
            "created_at",
            "closed_at",
            "created_date_key",
            "closed_date_key",
            "location_key",
            "problem_key",
            cal.days_between("created_at", "closed_at").alias("days_to_close"),
            flag_eq("status", "F").alias("is_closed"),
            "status",
        ],
        counted_in=requests,
    )


class Trade(Plan):
    """Both stars, with integer and with hashed keys."""

    tables = [
        "stg_orders",
        "stg_shipments",
        "stg_requests",
        "dim_hour",
        "dim_day",
        "dim_location",
        "dim_location_hashed",
        "dim_problem",
        "dim_problem_hashed",
        "dim_type",
        "dim_route",
        "dim_stop",
        "fact_orders",
        "fact_shipments",
        "fact_requests",
    ]
    facts = {
        "fact_orders": ("stg_orders", fact_orders, list(ORDER_KEYS)),
        "fact_shipments": ("stg_shipments", fact_shipments, list(SHIPMENT_KEYS)),
        "fact_requests": (
            "stg_requests",
            fact_requests,
            ["dim_day", "dim_location_hashed", "dim_problem_hashed"],
        ),
    }

    def __init__(self, spark: SparkSession, sf_dir: str, store: Store | None = None):
        super().__init__(store or Store.scratch(spark), sources={})
        self.spark = spark
        self.sf_dir = sf_dir

    def layer(self, name: str) -> str:
        return "staging" if name.startswith("stg_") else "marts"

    def plan_other(self, name: str) -> DataFrame:
        return getattr(self, f"_{name}")()

    def _stg_orders(self) -> DataFrame:
        return stg_orders(self.spark, self.sf_dir)

    def _stg_shipments(self) -> DataFrame:
        return stg_shipments(self.spark, self.sf_dir)

    def _stg_requests(self) -> DataFrame:
        return stg_requests(*self.together("stg_shipments", "stg_orders"))

    def _dim_hour(self) -> DataFrame:
        orders, shipments = self.staged("stg_orders", "stg_shipments")
        moments = orders.select(F.col("created_at").alias("ts"))
        return hour_dim_spanning(moments.union(shipments.select("shipped_at")), "ts")

    def _dim_day(self) -> DataFrame:
        orders = read(self.spark, self.sf_dir, "orders")
        lines = read(self.spark, self.sf_dir, "lineitem")
        return date_dim_from([(orders, "o_orderdate"), (lines, "l_shipdate")])

    def _dim_location(self) -> DataFrame:
        staged = self.staged("stg_orders", "stg_shipments")
        sources = [df.select(*LOCATION) for df in staged]
        return sequence_key(conformed_dim(sources), LOCATION, "location_key", self.store)

    def _dim_location_hashed(self) -> DataFrame:
        staged = self.staged("stg_orders", "stg_shipments")
        sources = [df.select(*HASHED_LOCATION) for df in staged]
        places = conformed_dim(sources, not_null=["borough"])
        return places.select(hash_key(*HASHED_LOCATION).alias("location_key"), *HASHED_LOCATION)

    def _dim_problem(self) -> DataFrame:
        problems = distinct_dim(*self.staged("stg_orders"), PROBLEM)
        return sequence_key(problems, PROBLEM, "problem_key", self.store)

    def _dim_problem_hashed(self) -> DataFrame:
        problems = distinct_dim(*self.staged("stg_orders"), PROBLEM, not_null=["status"])
        return problems.select(hash_key(*PROBLEM).alias("problem_key"), *PROBLEM)

    def _dim_type(self) -> DataFrame:
        types = distinct_dim(*self.staged("stg_shipments"), TYPE)
        return sequence_key(types, TYPE, "type_key", self.store)

    def _dim_route(self) -> DataFrame:
        routes = distinct_dim(*self.staged("stg_shipments"), ["route_id"], not_null=["route_id"])
        keyed = sequence_key(routes, ["route_id"], "route_key", self.store)
        return keyed.withColumn("agency_name", F.lit("CARRIER"))

    def _dim_stop(self) -> DataFrame:
        (shipments,) = self.staged("stg_shipments")
        attributes = {c: representative(c) for c in ("category", "quantity")}
        stops = grouped_dim(shipments.filter(F.col("stop_id").isNotNull()), ["stop_id"], attributes)
        return sequence_key(stops, ["stop_id"], "stop_key", self.store)

    def series(self, dim: str, key: str, *lookups: str) -> list[Series]:
        """Both facts, for counting through ``dim``; ``lookups`` are the keys that this takes."""
        through = self.table(dim)
        orders, shipments = self.fact("fact_orders", *lookups), self.fact("fact_shipments", *lookups)
        return [Series("Orders", orders, through, key), Series("Shipments", shipments, through, key)]


NOT_NULL_CHECKS = [
    NotNull("stg_orders", "order_id"),
    NotNull("stg_orders", "zip_code"),
    NotNull("stg_orders", "priority"),
    NotNull("stg_shipments", "shipment_id"),
    NotNull("stg_shipments", "neighborhood"),
]
UNIQUE_CHECKS = [
    Unique("stg_orders", "order_id"),
    Unique("stg_orders", "customer_id"),
    Unique("stg_shipments", "shipment_id"),
    Unique("lineitem", "line_id"),
]
ACCEPTED_CHECKS = [
    Accepted("stg_orders", "priority", PRIORITIES),
    Accepted("stg_orders", "status", ("F", "O")),
]
RELATED_CHECKS = [
    Related("stg_shipments", "order_id", "stg_orders", "order_id"),
    Related("stg_orders", "customer_id", "supplier", "s_suppkey"),
    Related("events", "user_id", "customer", "c_custkey"),
]
STAR_CHECKS = [
    Unique("dim_location", "location_key"),
    NotNull("dim_location", "location_key"),
    Unique("fact_orders", "order_id"),
    Unique("fact_shipments", "shipment_id"),
    NotNull("fact_orders", "location_key"),
    NotNull("fact_shipments", "stop_key"),
    Related("fact_orders", "location_key", "dim_location", "location_key"),
    Related("fact_orders", "date_key", "dim_hour", "date_key"),
    Related("fact_shipments", "type_key", "dim_type", "type_key"),
    Related("fact_shipments", "route_key", "dim_route", "route_key"),
    Related("fact_shipments", "stop_key", "dim_stop", "stop_key"),
]
