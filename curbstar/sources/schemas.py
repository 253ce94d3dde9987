"""Raw extracts: every column is text, so a malformed value never fails the read."""

from __future__ import annotations

from pyspark.sql import types as T

# Column names of the four raw extracts.
COMPLAINTS = [
    "unique_key", "created_date", "closed_date", "agency",
    "complaint_type", "descriptor", "status", "borough",
    "incident_zip", "community_board", "council_district", "latitude",
    "longitude",
]

CAMERA_VIOLATIONS = [
    "violation_id", "first_occurrence", "last_occurrence", "violation_type",
    "violation_status", "bus_route_id", "stop_id", "stop_name",
    "violation_latitude", "violation_longitude", "bus_stop_latitude", "bus_stop_longitude",
]

SERVICE_REQUESTS = [
    "unique_key", "created_date", "closed_date", "agency",
    "agency_name", "complaint_type", "descriptor", "descriptor_2",
    "location_type", "incident_zip", "incident_address", "latitude",
    "longitude", "address_type", "bbl", "borough",
    "bridge_highway_direction", "bridge_highway_name", "bridge_highway_segment", "city",
    "community_board", "cross_street_1", "cross_street_2", "due_date",
    "facility_type", "intersection_street_1", "intersection_street_2", "open_data_channel_type",
    "park_borough", "park_facility_name", "resolution_action_updated_date", "resolution_description",
    "road_ramp", "status", "street_name", "x_coordinate_state_plane",
    "y_coordinate_state_plane", "landmark",
]

SEATING_APPLICATIONS = [
    "objectid", "globalid", "time_of_submission", "restaurant_name",
    "legal_business_name", "doing_business_as_dba", "bulding_number", "street",
    "borough", "zip", "business_address", "latitude",
    "longitude", "seating_interest_sidewalk", "approved_for_sidewalk_seating", "approved_for_roadway_seating",
    "sidewalk_dimensions_length", "sidewalk_dimensions_width", "sidewalk_dimensions_area", "roadway_dimensions_length",
    "roadway_dimensions_width", "roadway_dimensions_area", "qualify_alcohol", "sla_serial_number",
    "sla_license_type", "landmark_district_or_building", "landmarkdistrict_terms", "healthcompliance_terms",
    "community_board", "council_district", "census_tract", "bin",
    "bbl", "nta", "food_service_establishment",
]

RAW_TABLES = {
    "source_nyc_311_traffic": COMPLAINTS,
    "source_mta_ace_violations": CAMERA_VIOLATIONS,
    "source_dot_service_requests_history": SERVICE_REQUESTS,
    "source_nyc_open_restaurant_apps": SEATING_APPLICATIONS,
}


def all_text(columns: list[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])
