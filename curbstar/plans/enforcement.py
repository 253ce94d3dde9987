"""Curb complaints versus camera enforcement: two facts on shared hour and location dimensions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curbstar import fixed_values as fv
from curbstar.functions import calendar as cal
from curbstar.operators.dims import (
    conformed_dim,
    distinct_dim,
    grouped_dim,
    hour_dim,
    representative,
    sequence_key,
)
from curbstar.operators.lookup import (
    BROADCAST_BYTES,
    build_fact,
    measured_bytes,
    natural,
    star_lookups,
)
from curbstar.operators.quality import Accepted, NotNull, Related, Unique
from curbstar.operators.reports import (
    Series,
    drill_down,
    series_counts,
    share_within,
    summarize,
    total,
)
from curbstar.operators.views import Sql, Staging, classify_prefix_sql
from curbstar.plans.base import Plan
from curbstar.sources.store import Store

LOCATION = ["borough", "zip_code", "neighborhood", "council_district"]
PROBLEM = ["agency", "complaint_type", "problem_detail"]
VIOLATION_TYPE = ["violation_category", "violation_status"]

# Foreign keys by dimension: key, natural key, NULL matches NULL.
COMPLAINT_KEYS = {
    "dim_location": ("location_key", LOCATION, True),
    "dim_311_problem": ("problem_key", PROBLEM, True),
}
VIOLATION_KEYS = {
    "dim_location": ("location_key", LOCATION, True),
    "dim_ace_violation_type": ("violation_type_key", VIOLATION_TYPE, True),
    "dim_bus_route": ("route_key", ["bus_route_id"], False),
    "dim_bus_stop": ("bus_stop_key", ["stop_id"], False),
}


_COMPLAINT_TEXTS = {
    "agency": "agency",
    "complaint_type": "complaint_type",
    "problem_detail": "descriptor",
    "status": "status",
    "borough": Sql("upper(borough)"),
    "zip_code": "incident_zip",
    "neighborhood": "community_board",
}


_VIOLATION_TEXTS = ["violation_category", "violation_status", "bus_route_id", "stop_id", "stop_name"]
_COORDINATES = ["violation_latitude", "violation_longitude", "bus_stop_latitude", "bus_stop_longitude"]


def complaint_staging() -> Staging:
    """Curb-related complaints."""
    return Staging(
        versions={
            "complaint_id": ("unique_key", "bigint"),
            "created_at": ("created_date", "timestamp"),
            "closed_at": ("closed_date", "timestamp"),
            **_COMPLAINT_TEXTS,
            "council_district": "council_district",
            "latitude": "latitude",
            "longitude": "longitude",
        },
        required=["complaint_id", "created_at", "borough"],
        allowed={"complaint_type": fv.CURB_COMPLAINT_TYPES},
        key="complaint_id",
        latest="coalesce(closed_at, created_at)",
        columns={
            **{c: c for c in ("complaint_id", "created_at", "closed_at", *_COMPLAINT_TEXTS)},
            "council_district": ("council_district", "bigint"),
            "latitude": ("latitude", "double"),
            "longitude": ("longitude", "double"),
        },
    )


def violation_staging() -> Staging:
    """Camera violations, with a borough read off the route."""
    return Staging(
        versions={
            "violation_id": "violation_id",
            "first_occurrence": ("first_occurrence", "timestamp"),
            "last_occurrence": ("last_occurrence", "timestamp"),
            "violation_category": "violation_type",
            **{c: c for c in (*_VIOLATION_TEXTS[1:], *_COORDINATES)},
        },
        required=["violation_id", "first_occurrence", "bus_route_id"],
        key="violation_id",
        latest="coalesce(last_occurrence, first_occurrence)",
        columns={
            **{c: c for c in ("violation_id", "first_occurrence", "last_occurrence", *_VIOLATION_TEXTS)},
            **{c: (c, "double") for c in _COORDINATES},
            "borough": Sql(
                classify_prefix_sql("bus_route_id", fv.ROUTE_PREFIX_BOROUGHS, fv.UNKNOWN_ROUTE_BOROUGH)
            ),
            "zip_code": Sql("CAST(NULL AS string)"),
            "neighborhood": Sql("CAST(NULL AS string)"),
            "council_district": Sql("CAST(NULL AS bigint)"),
        },
    )


def stg_311(raw: DataFrame, only: Sequence[str] | None = None) -> DataFrame:
    """Typed, curb-related complaints, the latest version of each."""
    return complaint_staging().plan(raw, only)


def stg_ace(raw: DataFrame, only: Sequence[str] | None = None) -> DataFrame:
    """Typed camera violations with a borough read off the route, the latest version of each."""
    return violation_staging().plan(raw, only)


# Staging tables: the raw extract and what is made of it.
STAGING = {
    "stg_311": ("source_nyc_311_traffic", complaint_staging),
    "stg_ace": ("source_mta_ace_violations", violation_staging),
}


def publish_staging(store: Store, sources: Mapping[str, str]) -> dict[str, DataFrame]:
    """The staging layer as catalog views, over raw extracts that are named as in SQL.

    Nothing is computed, and any session that shares the catalog reads the views.
    """
    return {
        name: store.persistent_view("staging", name, staging().sql(sources[source]))
        for name, (source, staging) in STAGING.items()
        if source in sources
    }


def dim_location(complaints: DataFrame, violations: DataFrame, store: Store) -> DataFrame:
    places = conformed_dim([complaints.select(*LOCATION), violations.select(*LOCATION)])
    return sequence_key(places, LOCATION, "location_key", store)


def dim_311_problem(complaints: DataFrame, store: Store) -> DataFrame:
    return sequence_key(distinct_dim(complaints, PROBLEM), PROBLEM, "problem_key", store)


def dim_ace_violation_type(violations: DataFrame, store: Store) -> DataFrame:
    types = distinct_dim(violations, VIOLATION_TYPE)
    return sequence_key(types, VIOLATION_TYPE, "violation_type_key", store)


def dim_bus_route(violations: DataFrame, store: Store) -> DataFrame:
    routes = distinct_dim(violations, ["bus_route_id"], not_null=["bus_route_id"])
    keyed = sequence_key(routes, ["bus_route_id"], "route_key", store)
    return keyed.withColumn("agency_name", F.lit(fv.ROUTE_AGENCY))


def dim_bus_stop(violations: DataFrame, store: Store) -> DataFrame:
    attributes = ["stop_name", "bus_stop_latitude", "bus_stop_longitude"]
    stops = grouped_dim(
        violations.filter(F.col("stop_id").isNotNull()),
        ["stop_id"],
        {c: representative(c) for c in attributes},
    )
    return sequence_key(stops, ["stop_id"], "bus_stop_key", store)


def fact_311_complaints(complaints: DataFrame, dims: Mapping[str, DataFrame]) -> DataFrame:
    lookups = star_lookups(dims, COMPLAINT_KEYS)
    return build_fact(
        complaints,
        lookups,
        [
            F.col("complaint_id").alias("unique_key"),
            cal.hour_key("created_at").alias("date_key"),
            *[lookup.key for lookup in lookups],
            "latitude",
            "longitude",
            "status",
            F.col("created_at").alias("created_date"),
        ],
    )


def fact_ace_violations(
    violations: DataFrame, dims: Mapping[str, DataFrame], keys_only: bool = False
) -> DataFrame:
    """With ``keys_only``, the fact has its keys to ``dims`` alone, and no more is read than they take."""
    lookups = star_lookups(dims, VIOLATION_KEYS)
    if keys_only:
        return build_fact(violations, lookups, [lookup.key for lookup in lookups])
    return build_fact(
        violations,
        lookups,
        [
            "violation_id",
            cal.hour_key("first_occurrence").alias("date_key"),
            *[lookup.key for lookup in lookups],
            "violation_latitude",
            "violation_longitude",
            "first_occurrence",
            "last_occurrence",
            cal.minutes_between("first_occurrence", "last_occurrence").alias("duration_minutes"),
        ],
    )


class Enforcement(Plan):
    """The whole pipeline on ``source_nyc_311_traffic`` and ``source_mta_ace_violations``."""

    tables = [
        "stg_311",
        "stg_ace",
        "dim_date",
        "dim_location",
        "dim_311_problem",
        "dim_ace_violation_type",
        "dim_bus_route",
        "dim_bus_stop",
        "fact_311_complaints",
        "fact_ace_violations",
    ]
    facts = {
        "fact_311_complaints": ("stg_311", fact_311_complaints, list(COMPLAINT_KEYS)),
        "fact_ace_violations": ("stg_ace", fact_ace_violations, list(VIOLATION_KEYS)),
    }

    # Hour keys are YYYYMMDDHH.
    partitions = {
        name: ("date_year", "date_key div 1000000")
        for name in ("fact_311_complaints", "fact_ace_violations", "event_summary")
    }
    summary = "event_summary"
    # What the summary is kept by: key and dimension.
    summary_keys = {
        "date_key": "dim_date",
        "location_key": "dim_location",
        "violation_type_key": "dim_ace_violation_type",
        "problem_key": "dim_311_problem",
    }

    # The hour calendar: its first hour and how many follow. Records outside it have no date; the
    # checks count them.
    calendar_start: str = fv.CALENDAR_START
    calendar_hours: int = fv.CALENDAR_HOURS

    def layer(self, name: str) -> str:
        return "staging" if name.startswith("stg_") else "marts_core"

    def plan_other(self, name: str) -> DataFrame:
        t, store = self.table, self.store
        match name:
            case "stg_311":
                return stg_311(t("source_nyc_311_traffic"))
            case "stg_ace":
                return stg_ace(t("source_mta_ace_violations"))
            case "dim_date":
                return hour_dim(store.spark, self.calendar_start, self.calendar_hours)
            case "dim_location":
                return dim_location(*self.staged("stg_311", "stg_ace", columns=LOCATION), store)
            case "dim_311_problem":
                return dim_311_problem(*self.staged("stg_311"), store)
            case "dim_ace_violation_type":
                return dim_ace_violation_type(*self.staged("stg_ace", columns=VIOLATION_TYPE), store)
            case "dim_bus_route":
                return dim_bus_route(*self.staged("stg_ace"), store)
            case "dim_bus_stop":
                return dim_bus_stop(*self.staged("stg_ace"), store)
            case "event_summary":
                violations, complaints = self.together("fact_ace_violations", "fact_311_complaints")
                facts = {fv.CAMERA_SERIES: violations, fv.COMPLAINT_SERIES: complaints}
                return summarize(facts, list(self.summary_keys))
        raise KeyError(name)

    def plan_columns(self, name: str, columns: Sequence[str]) -> DataFrame:
        match name:
            case "stg_311":
                return stg_311(self.table("source_nyc_311_traffic"), columns)
            case "stg_ace":
                return stg_ace(self.table("source_mta_ace_violations"), columns)
        return super().plan_columns(name, columns)

    def series(self, dim: str, key: str, *lookups: str) -> list[Series]:
        """Both facts, for counting through ``dim``; ``lookups`` are the keys that this takes."""
        through = self.table(dim)
        if self.summarized:
            return [Series(F.col("series"), self.table(self.summary), through, key, count="event_count")]
        violations = self.fact("fact_ace_violations", *lookups)
        complaints = self.fact("fact_311_complaints", *lookups)
        return [
            Series(fv.CAMERA_SERIES, violations, through, key),
            Series(fv.COMPLAINT_SERIES, complaints, through, key),
        ]

    def by_location(self, *attributes: str) -> DataFrame:
        """Both series by any location attributes."""
        return series_counts(
            self.series("dim_location", "location_key", "dim_location"), natural(*attributes)
        )

    def by_date(self, *attributes: str, where: Column | None = None) -> DataFrame:
        """Both series by any calendar attributes, in the hours that ``where`` keeps.

        Of written facts, only the years with such hours are read.
        """
        if where is None:
            return series_counts(self.series("dim_date", "date_key"), natural(*attributes))
        series = []
        for label, name in self.counted():
            fact, also = self.partitioned(name)
            through = self.hours(where, also)
            count = "event_count" if name == self.summary else None
            series.append(Series(label, fact, through, "date_key", also, count))
        return series_counts(series, natural(*attributes))

    def counted(self) -> list[tuple[str | Column, str]]:
        """Label and name of the tables that reports count: the summary if there is one."""
        if self.summarized:
            return [(F.col("series"), self.summary)]
        return [(fv.CAMERA_SERIES, "fact_ace_violations"), (fv.COMPLAINT_SERIES, "fact_311_complaints")]

    def hours(self, where: Column | None, also: Sequence[str]) -> DataFrame:
        """The calendar's hours that ``where`` keeps, with the partition column of the facts."""
        hours = self.table("dim_date")
        if where is not None:
            hours = hours.filter(where)
        hours = hours.withColumns({c: F.expr(self.partitions[self.summary][1]) for c in also})
        return F.broadcast(hours) if measured_bytes([hours])[0] <= BROADCAST_BYTES else hours

    def drill_down(self, *attributes: str, where: Column | None = None) -> DataFrame:
        """Events by any attributes of calendar, location, violation type and problem, from the
        summary alone; ``where`` is a condition on the calendar."""
        summary, also = self.partitioned(self.summary)
        dims = []
        for key, name in self.summary_keys.items():
            if name == "dim_date":
                dims.append((self.hours(where, also), ("date_key", *also)))
            else:
                dims.append((self.table(name), (key,)))
        return drill_down(summary, dims, attributes)

    def by_borough(self) -> DataFrame:
        return self.by_location("borough")

    def by_year(self) -> DataFrame:
        return self.by_date("year")

    def by_month(self) -> DataFrame:
        month = {"month_start": cal.month_start("full_datetime")}
        return series_counts(self.series("dim_date", "date_key"), month)

    def by_weekday(self) -> DataFrame:
        return self.by_date("day_of_week")

    def type_share_by_borough(self) -> DataFrame:
        location, kind = "dim_location", "dim_ace_violation_type"
        if self.summarized:
            violations, events = self.events(fv.CAMERA_SERIES, "fact_ace_violations")
        else:
            violations, events = self.violation_keys(location, kind), None
        return share_within(
            violations,
            (self.table(location), "location_key", "borough"),
            (self.table(kind), "violation_type_key", "violation_category"),
            "violation_count",
            "borough_share",
            events,
        )

    def violation_keys(self, *dims: str) -> DataFrame:
        """The written violations; before they are written, a plan of these dimensions' keys alone.

        The keys and their dimensions read the same staged columns, so these are gathered first.
        """
        if "fact_ace_violations" in self._built:
            return self._built["fact_ace_violations"]
        columns = [c for dim in dims for c in VIOLATION_KEYS[dim][1]]
        self.gather("stg_ace", columns)
        (rows,) = self.staged("stg_ace", columns=columns)
        return fact_ace_violations(rows, dict(zip(dims, self.together(*dims))), keys_only=True)

    def events(self, series: str, fact: str) -> tuple[DataFrame, str | None]:
        """One series, from the summary if there is one, and its column with the number of events."""
        if self.summarized:
            return self.table(self.summary).filter(F.col("series") == series), "event_count"
        return self.fact(fact), None

    def total_violations(self) -> DataFrame:
        rows, events = self.events(fv.CAMERA_SERIES, "fact_ace_violations")
        return total(rows, "total_ace_violations", events)

    def total_complaints(self) -> DataFrame:
        rows, events = self.events(fv.COMPLAINT_SERIES, "fact_311_complaints")
        return total(rows, "total_311_complaints", events)


def _key(table: str, column: str) -> list[NotNull | Unique]:
    return [NotNull(table, column), Unique(table, column)]


CHECKS = [
    *_key("stg_311", "complaint_id"),
    NotNull("stg_311", "created_at"),
    NotNull("stg_311", "borough"),
    NotNull("stg_311", "complaint_type"),
    *_key("stg_ace", "violation_id"),
    NotNull("stg_ace", "first_occurrence"),
    NotNull("stg_ace", "bus_route_id"),
    NotNull("stg_ace", "borough"),
    *_key("dim_date", "date_key"),
    NotNull("dim_date", "full_datetime"),
    Accepted("dim_date", "peak_period", (*[p for _, _, p in fv.PEAK_PERIODS], fv.OFF_PEAK)),
    *_key("dim_location", "location_key"),
    NotNull("dim_location", "borough"),
    *_key("dim_311_problem", "problem_key"),
    *_key("fact_311_complaints", "unique_key"),
    NotNull("fact_311_complaints", "date_key"),
    Related("fact_311_complaints", "date_key", "dim_date", "date_key"),
    Related("fact_311_complaints", "location_key", "dim_location", "location_key"),
    Related("fact_311_complaints", "problem_key", "dim_311_problem", "problem_key"),
    *_key("dim_ace_violation_type", "violation_type_key"),
    *_key("dim_bus_route", "route_key"),
    *_key("dim_bus_route", "bus_route_id"),
    *_key("dim_bus_stop", "bus_stop_key"),
    *_key("dim_bus_stop", "stop_id"),
    *_key("fact_ace_violations", "violation_id"),
    NotNull("fact_ace_violations", "date_key"),
    Related("fact_ace_violations", "date_key", "dim_date", "date_key"),
    Related("fact_ace_violations", "location_key", "dim_location", "location_key"),
    Related("fact_ace_violations", "violation_type_key", "dim_ace_violation_type", "violation_type_key"),
    Related("fact_ace_violations", "route_key", "dim_bus_route", "route_key"),
    Related("fact_ace_violations", "bus_stop_key", "dim_bus_stop", "bus_stop_key"),
]
