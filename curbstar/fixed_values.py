"""Lists, labels and formats that results must match exactly."""

# Complaint types kept by the curb-complaint staging table (case-sensitive).
CURB_COMPLAINT_TYPES = [
    "Illegal Parking",
    "Blocked Driveway",
    "Double Parked Blocking Vehicle",
    "Double Parked Blocking Traffic",
    "Blocked Bike Lane",
    "Posted Parking Sign Violation",
]

# Route-id prefixes to borough, in matching order; anything else is UNKNOWN.
ROUTE_PREFIX_BOROUGHS = [
    (["BX"], "BRONX"),
    (["BM", "QM", "X"], "EXPRESS"),
    (["M"], "MANHATTAN"),
    (["B"], "BROOKLYN"),
    (["Q"], "QUEENS"),
    (["S"], "STATEN ISLAND"),
]
UNKNOWN_ROUTE_BOROUGH = "UNKNOWN"
ROUTE_AGENCY = "MTA"

# Hour-grain calendar: first hour, number of hours after it, peak buckets (hours inclusive).
CALENDAR_START = "2019-01-01 00:00:00"
CALENDAR_HOURS = 24 * 365 * 8
PEAK_PERIODS = [
    (7, 9, "AM_PEAK"),
    (10, 15, "MIDDAY"),
    (16, 19, "PM_PEAK"),
    (20, 23, "EVENING"),
]
OFF_PEAK = "OVERNIGHT"

# Borough spellings (after trim + upper) to the standard name.
BOROUGH_SYNONYMS = {
    "Manhattan": ["MANHATTAN", "NEW YORK COUNTY"],
    "Bronx": ["BRONX", "THE BRONX"],
    "Brooklyn": ["BROOKLYN", "KINGS COUNTY"],
    "Queens": ["QUEENS", "QUEEN", "QUEENS COUNTY"],
    "Staten Island": ["STATEN ISLAND", "RICHMOND COUNTY"],
}
UNKNOWN_BOROUGH = "UNKNOWN or CITYWIDE"

# ZIP spellings.
ZIP_MISSING = ["N/A", "NA"]
ZIP_ANONYMOUS = "Anonymous"
ZIP_PLUS_FOUR = r"^\d{5}-\d{4}"

# Keywords (in lower-cased complaint type) to category, in matching order.
COMPLAINT_CATEGORIES = [
    ("street", "Street Issues"),
    ("traffic", "Traffic Issues"),
    ("sidewalk", "Sidewalk Issues"),
    ("bike", "Bike Issues"),
    ("parking", "Parking Issues"),
    ("ferry", "Ferry Issues"),
]
OTHER_CATEGORY = "Other"

# Service requests: agency code, agency-name text, years kept, status of a finished request.
REQUEST_AGENCY = "DOT"
REQUEST_AGENCY_NAME_PART = "Transportation"
REQUEST_YEARS = 7
CLOSED_STATUS = "CLOSED"

# Seating interests that imply a sidewalk or roadway setup; text of an affirmative answer.
SIDEWALK_INTERESTS = ["sidewalk", "both", "openstreets"]
ROADWAY_INTERESTS = ["roadway", "both", "openstreets"]
YES = "yes"

# First month of the fiscal year.
FISCAL_START_MONTH = 7

# Hashed surrogate keys: text standing for NULL and the column separator.
HASH_KEY_NULL = "_dbt_utils_surrogate_key_null_"
HASH_KEY_SEPARATOR = "-"

# Series labels of the cross-mart reports.
CAMERA_SERIES = "ACE Violations"
COMPLAINT_SERIES = "311 Complaints"

# Exact numeric type of coordinates and measurements.
NUMERIC = "decimal(38,9)"

# Characters removed by trimming (all Unicode white space).
WHITE_SPACE = (
    " \t\n\x0b\f\r\x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
