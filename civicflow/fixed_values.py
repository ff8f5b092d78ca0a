"""Fixed values.

These must equal the values the source pipeline uses, otherwise results
differ.  They are stated here once, plainly and in their natural order.
"""

# --- Fixed values: string normalisation ------------------------------------
# Word delimiters of the warehouse's INITCAP (its documented default set):
# whitespace ! ? @ " ^ # $ & ~ _ , . : ; + - * % / | \ [ ] ( ) { } < >
INITCAP_DELIMITERS = r'''\s!?@"^#$&~_,.:;+\-*%/|\\\[\](){}<>'''

# Borough placeholders that mean "no borough" (compared after upper(trim(x))).
BOROUGH_PLACEHOLDERS = ("UNSPECIFIED", "", "NA", "N/A")

# Coordinate bounds applied to both latitude and longitude (inclusive).
LATITUDE_BOUNDS = (40, 41)
LONGITUDE_BOUNDS = (40, 41)

# --- Fixed values: status flags ---------------------------------------------
RESOLVED_STATUSES = ("Closed", "Resolved")
OPEN_STATUSES = ("Open", "Pending", "Started", "In Progress", "Assigned")

# --- Fixed values: age buckets (upper bound in days, inclusive; label) -------
AGE_BUCKETS = ((0, "Same Day"), (7, "Same Week"), (30, "Within Month"), (90, "Within Quarter"))
AGE_BUCKET_ELSE = "Over Quarter"

# --- Fixed values: dimensions --------------------------------------------------
UNKNOWN = "Unknown"
UNKNOWN_BOROUGH_CODE = "UN"
DEFAULT_CATEGORY = "Other"

# Surrogate keys: md5 over '-'-joined string casts, NULL replaced by this token.
SURROGATE_NULL_TOKEN = "_dbt_utils_surrogate_key_null_"
SURROGATE_SEPARATOR = "-"

# --- Fixed values: loading and incremental state -----------------------------
SOURCE_TAG = "S3"
DEFAULT_WATERMARK = "1900-01-01 00:00:00"
PAGE_SIZE = 1000

# History (type-2) tracked columns, in order.
HISTORY_CHECK_COLUMNS = ("status", "closed_at", "resolution_description",
                         "resolution_updated_at", "agency_code")

# Source freshness thresholds in hours.
FRESHNESS_WARN_HOURS = 24
FRESHNESS_ERROR_HOURS = 48

# --- Fixed values: accepted values lists --------------------------------------
STAGING_STATUSES = ("Open", "Closed", "In Progress", "Assigned", "Pending", "Started", "Unspecified")
ENRICHED_STATUSES = ("Open", "Pending", "Started", "In Progress", "Assigned", "Closed", "Resolved", "Unspecified")
BOROUGH_NAMES = ("Manhattan", "Brooklyn", "Queens", "Bronx", "Staten Island")
AGE_BUCKET_LABELS = ("Same Day", "Same Week", "Within Month", "Within Quarter", "Over Quarter")

# Keys consumed from each landed record, in source order.
RECORD_KEYS = ("unique_key", "created_date", "closed_date", "resolution_action_updated_date",
               "agency", "agency_name", "complaint_type", "descriptor", "status",
               "resolution_description", "incident_zip", "incident_address", "street_name",
               "city", "borough", "community_board", "council_district", "latitude",
               "longitude", "open_data_channel_type")
