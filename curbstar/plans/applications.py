"""Street service requests versus outdoor-seating applications, on hashed keys."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curbstar import fixed_values as fv
from curbstar.functions import calendar as cal
from curbstar.functions.clean import (
    categorize,
    clean_zip,
    flag_eq,
    flag_in,
    round_to_long,
    standardize,
    strict_cast,
    trim_all,
    within_years,
)
from curbstar.functions.keys import hash_fk, hash_key
from curbstar.operators.dedup import dedup_latest
from curbstar.operators.dims import conformed_dim, date_dim_from, distinct_dim, grouped_dim
from curbstar.operators.lookup import Lookup, build_fact, lookup_role
from curbstar.operators.project import require, strict_project
from curbstar.operators.quality import NotNull, Unique
from curbstar.plans.base import Plan
from curbstar.sources.schemas import SEATING_APPLICATIONS
from curbstar.sources.store import Store

# Derived columns in output order, by raw column: text copies, exact numbers.
REQUEST_TEXTS = ["agency", "agency_name", "complaint_type", "descriptor"]
REQUEST_PLACES = ["incident_address", "street_name", "cross_street_1", "cross_street_2"]
APPLICATION_NUMBERS = [
    "sidewalk_dimensions_length",
    "sidewalk_dimensions_width",
    "sidewalk_dimensions_area",
    "roadway_dimensions_length",
    "roadway_dimensions_width",
    "roadway_dimensions_area",
    "latitude",
    "longitude",
]


def standard_borough(c: str) -> Column:
    return standardize(c, fv.BOROUGH_SYNONYMS, fv.UNKNOWN_BOROUGH)


def stg_nyc_311_dot(raw: DataFrame, as_of: date | None = None) -> DataFrame:
    """Recent street requests, the latest version of each; malformed values fail the job."""
    now = F.convert_timezone(None, F.lit("UTC"), F.current_timestamp().cast("timestamp_ntz"))
    today = F.to_date(now) if as_of is None else F.lit(as_of)
    street = (F.col("agency") == fv.REQUEST_AGENCY) | F.col("agency_name").contains(
        fv.REQUEST_AGENCY_NAME_PART
    )
    created = strict_cast("created_date", "timestamp")
    valid = require(raw.filter(street), ["unique_key", "created_date", "borough"]).filter(
        within_years(created, fv.REQUEST_YEARS, today)
    )
    others = [c for c in raw.columns if c not in ("unique_key", "created_date", "closed_date")]
    latest = dedup_latest(
        valid, ["unique_key"], created, [F.col("closed_date").desc_nulls_last(), *others]
    )
    derived = {
        "request_id": F.col("unique_key"),
        "created_date": created,
        "closed_date": strict_cast("closed_date", "timestamp"),
        **{c: F.col(c) for c in REQUEST_TEXTS},
        "status": F.upper(trim_all("status")),
        "incident_zip": clean_zip("incident_zip"),
        "borough": standard_borough("borough"),
        **{c: F.col(c) for c in REQUEST_PLACES},
        "latitude": strict_cast("latitude", fv.NUMERIC),
        "longitude": strict_cast("longitude", fv.NUMERIC),
        "method_of_submission": F.col("open_data_channel_type"),
        "_stg_loaded_at": F.current_timestamp(),
    }
    return strict_project(latest, [*derived, "unique_key", "open_data_channel_type"], derived)


def stg_nyc_open_restaurant_apps(raw: DataFrame) -> DataFrame:
    """Seating applications, the latest submission of each; malformed values fail the job."""
    submitted = strict_cast("time_of_submission", "timestamp")
    others = [c for c in raw.columns if c not in ("objectid", "time_of_submission")]
    latest = dedup_latest(require(raw, ["objectid"]), ["objectid"], submitted, others)
    renamed = {
        "sla_serial_number": "sla_serial_number",
        "sla_license_type": "sla_license_type",
        "landmark_status": "landmark_district_or_building",
        "landmark_terms": "landmarkdistrict_terms",
        "health_compliance_terms": "healthcompliance_terms",
        "community_board": "community_board",
        "council_district": "council_district",
        "census_tract": "census_tract",
        "bin": "bin",
        "bbl": "bbl",
        "nta": "nta",
    }
    derived = {
        "application_id": F.col("objectid"),
        "time_of_submission": submitted,
        "restaurant_name": F.col("restaurant_name"),
        "legal_business_name": F.col("legal_business_name"),
        "doing_business_as": F.col("doing_business_as_dba"),
        "building_number": F.col("bulding_number"),
        "full_address": F.col("business_address"),
        "zip": clean_zip("zip"),
        "borough": standard_borough("borough"),
        "food_service_establishment_permit": F.col("food_service_establishment"),
        "seating_interest": F.col("seating_interest_sidewalk"),
        "approved_for_sidewalk_seating": F.col("approved_for_sidewalk_seating"),
        "approved_for_roadway_seating": F.col("approved_for_roadway_seating"),
        **{c: strict_cast(c, fv.NUMERIC) for c in APPLICATION_NUMBERS},
        "alcohol_qualified": F.col("qualify_alcohol"),
        **{new: F.col(old) for new, old in renamed.items()},
        "_stg_loaded_at": F.current_timestamp(),
    }
    passed_through = ["globalid", "street"]
    replaced = [c for c in SEATING_APPLICATIONS if c not in passed_through]
    return strict_project(latest, replaced, derived)


def sample(raw_requests: DataFrame) -> DataFrame:
    """Four raw columns of the service requests."""
    return raw_requests.select("unique_key", "created_date", "complaint_type", "borough")


def dim_date(requests: DataFrame, applications: DataFrame) -> DataFrame:
    return date_dim_from([(requests, "created_date"), (applications, "time_of_submission")])


def dim_location(requests: DataFrame, applications: DataFrame) -> DataFrame:
    places = conformed_dim(
        [
            requests.select("borough", F.col("incident_zip").alias("zip_code")),
            applications.select("borough", F.col("zip").alias("zip_code")),
        ],
        not_null=["borough"],
    )
    return places.select(hash_key("borough", "zip_code").alias("location_key"), "borough", "zip_code")


def dim_complaint_type(requests: DataFrame) -> DataFrame:
    types = distinct_dim(requests, ["complaint_type", "descriptor"], not_null=["complaint_type"])
    category = categorize("complaint_type", fv.COMPLAINT_CATEGORIES, fv.OTHER_CATEGORY)
    return types.select(
        hash_key("complaint_type", "descriptor").alias("complaint_type_key"),
        "complaint_type",
        "descriptor",
        category.alias("complaint_category"),
    )


def dim_restaurant(applications: DataFrame) -> DataFrame:
    identified = F.col("food_service_establishment_permit").isNotNull() | F.col("full_address").isNotNull()
    names = ["restaurant_name", "legal_business_name", "doing_business_as"]
    restaurants = grouped_dim(
        applications.filter(identified),
        ["food_service_establishment_permit", "full_address"],
        {
            **{c: F.max(c) for c in names},
            **{c: F.avg(c).cast(fv.NUMERIC) for c in ("latitude", "longitude")},
        },
    )
    return restaurants.select(
        hash_key("food_service_establishment_permit", "full_address").alias("restaurant_key"),
        *names,
        "full_address",
        "latitude",
        "longitude",
        "food_service_establishment_permit",
    )


def dim_seating_type(applications: DataFrame) -> DataFrame:
    interest = F.col("seating_interest")
    types = distinct_dim(
        applications,
        [
            interest,
            flag_in(interest, fv.SIDEWALK_INTERESTS).alias("approved_for_sidewalk"),
            flag_in(interest, fv.ROADWAY_INTERESTS).alias("approved_for_roadway"),
        ],
        not_null=["seating_interest"],
    )
    return types.select(hash_key(*types.columns).alias("seating_type_key"), *types.columns)


def fact_311_dot_requests(requests: DataFrame, dims: Mapping[str, DataFrame]) -> DataFrame:
    """One row per request.

    The location dimension holds every location of the requests, so its hashed key is computed
    on the spot. A complaint type that occurs both with a NULL and a blank descriptor has two
    dimension rows, and its requests get one fact row for each.
    """
    roles = {"created_date": "created_date_key", "closed_date": "closed_date_key"}
    dated = lookup_role(requests, dims["dim_date_assignment"], roles)
    by_type = Lookup(
        dims["dim_complaint_type"],
        "complaint_type_key",
        {"complaint_type": "complaint_type", "descriptor": "descriptor"},
        null_as={"descriptor": ""},
    )
    return build_fact(
        dated,
        [by_type],
        [
            hash_key("request_id").alias("request_key"),
            "request_id",
            F.col("created_date").alias("request_created_at"),
            F.col("closed_date").alias("request_closed_at"),
            "created_date_key",
            "closed_date_key",
            hash_fk("borough", "incident_zip").alias("location_key"),
            "complaint_type_key",
            "incident_address",
            "address_type",
            "street_name",
            "cross_street_1",
            "cross_street_2",
            "latitude",
            "longitude",
            cal.days_between("created_date", "closed_date").alias("days_to_close"),
            flag_eq(F.upper("status"), fv.CLOSED_STATUS).alias("is_closed"),
            "status",
            F.col("method_of_submission").alias("channel_type"),
            "resolution_description",
        ],
        counted_in=requests,
    )


def fact_restaurant_applications(
    applications: DataFrame, dims: Mapping[str, DataFrame]
) -> DataFrame:
    """One row per application; location and restaurant keys are computed on the spot."""
    dated = lookup_role(
        applications, dims["dim_date_assignment"], {"time_of_submission": "submission_date_key"}
    )
    by_seating = Lookup(
        dims["dim_seating_type"],
        "seating_type_key",
        {
            "seating_interest": "seating_interest",
            "approved_for_sidewalk": flag_eq("approved_for_sidewalk_seating", fv.YES),
            "approved_for_roadway": flag_eq("approved_for_roadway_seating", fv.YES),
        },
    )
    return build_fact(
        dated,
        [by_seating],
        [
            hash_key("application_id").alias("application_key"),
            F.col("application_id").alias("objectid"),
            F.col("time_of_submission").alias("application_submitted"),
            "submission_date_key",
            hash_fk("borough", "zip").alias("location_key"),
            hash_fk("food_service_establishment_permit", "full_address").alias("restaurant_key"),
            "seating_type_key",
            F.col("full_address").alias("business_address"),
            "street",
            "building_number",
            F.col("latitude").cast("double").alias("latitude"),
            F.col("longitude").cast("double").alias("longitude"),
            round_to_long("sidewalk_dimensions_length").alias("sidewalk_length_ft"),
            round_to_long("sidewalk_dimensions_width").alias("sidewalk_width_ft"),
            round_to_long("sidewalk_dimensions_area").alias("sidewalk_area_sqft"),
            flag_eq("alcohol_qualified", fv.YES).alias("qualify_alcohol"),
            flag_eq("landmark_status", fv.YES).alias("is_landmark_location"),
            flag_eq("health_compliance_terms", fv.YES).alias("health_compliance_terms_accepted"),
            "sla_serial_number",
            "sla_license_type",
        ],
        counted_in=applications,
    )


class Applications(Plan):
    """The whole pipeline on ``source_dot_service_requests_history`` and
    ``source_nyc_open_restaurant_apps``."""

    tables = [
        "stg_nyc_311_dot",
        "stg_nyc_open_restaurant_apps",
        "test_311_sample",
        "dim_date_assignment",
        "dim_location_assignment",
        "dim_complaint_type",
        "dim_restaurant",
        "dim_seating_type",
        "fact_311_dot_requests",
        "fact_restaurant_applications",
    ]
    facts = {
        "fact_311_dot_requests": (
            "stg_nyc_311_dot",
            fact_311_dot_requests,
            ["dim_date_assignment", "dim_complaint_type"],
        ),
        "fact_restaurant_applications": (
            "stg_nyc_open_restaurant_apps",
            fact_restaurant_applications,
            ["dim_date_assignment", "dim_seating_type"],
        ),
    }

    # The day the request window ends; today if not set.
    as_of: date | None = None

    def layer(self, name: str) -> str:
        staged = name.startswith("stg_") or name == "test_311_sample"
        return "nyc_transit_restaurants_staging" if staged else "nyc_transit_restaurants_marts"

    def plan_other(self, name: str) -> DataFrame:
        requests, applications = "stg_nyc_311_dot", "stg_nyc_open_restaurant_apps"
        match name:
            case "stg_nyc_311_dot":
                return stg_nyc_311_dot(self.table("source_dot_service_requests_history"), self.as_of)
            case "stg_nyc_open_restaurant_apps":
                return stg_nyc_open_restaurant_apps(self.table("source_nyc_open_restaurant_apps"))
            case "test_311_sample":
                return sample(self.table("source_dot_service_requests_history"))
            case "dim_date_assignment":
                return dim_date(*self.staged(requests, applications))
            case "dim_location_assignment":
                return dim_location(*self.staged(requests, applications))
            case "dim_complaint_type":
                return dim_complaint_type(*self.staged(requests))
            case "dim_restaurant":
                return dim_restaurant(*self.staged(applications))
            case "dim_seating_type":
                return dim_seating_type(*self.staged(applications))
        raise KeyError(name)


# Checks on the raw extracts. Raw extracts hold republished records, which staging removes, so a
# failing "unique" here is a warning.
SOURCE_CHECKS = [
    Unique("source_dot_service_requests_history", "unique_key"),
    NotNull("source_dot_service_requests_history", "unique_key"),
    Unique("source_nyc_open_restaurant_apps", "objectid"),
    NotNull("source_nyc_open_restaurant_apps", "objectid"),
]
