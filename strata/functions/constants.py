"""Values that outputs must reproduce exactly.

Fixed values (formats, labels, defaults, thresholds and table names of the event model):
"""

# --- fixed values -----------------------------------------------------------
EVENT_TIME_PATTERN = "yyyy-MM-dd'T'HH:mm:ssXXX"
EVENT_TIME_PATTERN_FRACTION = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"
ISO_OUTPUT_PATTERN = "yyyy-MM-dd'T'HH:mm:ssxxx"
SENTINEL_DATE = "1970-01-01"
EVENT_TYPE = "SOCIAL_INTERACTION"
DEFAULT_REGION = "UNKNOWN"
PAYLOAD_VERSION = 1
ANON_PREFIX = "anon-"
UNKNOWN_QUESTION = "unknown"
RETURNING_USER = "Returning_user"
ONE_TIME_USER = "One_time_user"
TIER_LOW = "Low"
TIER_MEDIUM = "Medium"
TIER_HIGH = "High"
TIER_LOW_BELOW = 50
TIER_HIGH_ABOVE = 200
EMAIL_MASK = "***@"
TOP_QUESTIONS_K = 10
TOP_TOTALS_N = 20
RECENT_PARTITIONS_N = 5
TABLES = {
    "bronze": "bronze.raw_event_table",
    "silver": "silver.raw_event_table",
    "clean_silver": "silver.cleaned_silver_table",
    "answer_rate": "gold.answer_rate_daily",
    "returning_users": "gold.returning_vs_new_user",
    "score_distribution": "gold.score_distributions",
    "fact": "gold.behavioral_fact_table",
    "question_dimension": "gold.question_dimension_table",
    "user_dimension": "gold.user_dimension_table",
}
# ---------------------------------------------------------------------------

# Our own choices for the driver-table adapter (not reference values).
SOURCE_NAME = "qa_api"
QUESTION_LINK_PREFIX = "/questions/"
QUESTION_TITLE_PREFIX = "Question "
