"""Fixed values that results depend on: labels, patterns, column lists and model settings."""

# ---- Fixed values: labels ------------------------------------------------------------------
MISSING_LABEL = "NOT_PROVIDED"
NOT_APPLICABLE = "NOT_APPLICABLE"
UNKNOWN_KEY = 0
RECORD_STATUS = "VALID"
TRUE_SPELLINGS = ("yes", "y", "true", "1")
FALSE_SPELLINGS = ("no", "n", "false", "0")
YES, NO = "YES", "NO"
TRAIN, VALIDATION, TEST = "TRAIN", "VALIDATION", "TEST"
SPLITS = (TRAIN, VALIDATION, TEST)

# ---- Fixed values: date patterns, tried in this order ----------------------------------------
SILVER_DATE_PATTERNS = (
    "MM/dd/yyyy",
    "M/d/yyyy",
    "MM/dd/yy",
    "M/d/yy",
    "yyyy-MM-dd",
    "yyyy-MM-dd HH:mm:ss",
)
PROFILE_DATE_PATTERNS = ("MM/dd/yyyy", "M/d/yyyy", "yyyy-MM-dd")
QUALITY_DATE_PATTERNS = (
    "yyyy-MM-dd'T'HH:mm:ss.SSSX",
    "yyyy-MM-dd'T'HH:mm:ssX",
    "MM/dd/yyyy",
    "M/d/yyyy",
    "yyyy-MM-dd",
)
ZIP_PATTERN = r"^[0-9]{5}(-[0-9]{4})?$"

# ---- Fixed values: column lists --------------------------------------------------------------
ID = "complaint_id"
DATE_COLUMNS = ("date_received", "date_sent_to_company")
FLAG_COLUMNS = ("timely_response", "consumer_disputed")
BLANK_PROFILE_COLUMNS = (
    "complaint_id",
    "date_received",
    "product",
    "sub_product",
    "issue",
    "sub_issue",
    "company",
    "state",
    "zip_code",
    "submitted_via",
    "company_response_to_consumer",
    "timely_response",
)
DISTINCT_PROFILE_COLUMNS = (
    "product",
    "sub_product",
    "issue",
    "sub_issue",
    "company",
    "state",
    "zip_code",
    "submitted_via",
    "company_response_to_consumer",
    "timely_response",
)
SILVER_BLANK_COLUMNS = (
    "product",
    "sub_product",
    "issue",
    "sub_issue",
    "company",
    "state",
    "zip_code",
    "submitted_via",
    "company_response_to_consumer",
    "timely_response",
)
RAW_MISSING_COLUMNS = (
    "date_received",
    "product",
    "issue",
    "company",
    "state",
    "submitted_via",
)
SILVER_NULL_COLUMNS = (
    "complaint_id",
    "date_received",
    "product",
    "issue",
    "company",
    "state",
)
GROUP_MISSING_COLUMNS = ("product", "issue", "company", "state")
FACT_KEYS = (
    "received_date_key",
    "sent_date_key",
    "product_key",
    "company_key",
    "state_key",
)
CATEGORICAL_COLUMNS = (
    "product",
    "sub_product",
    "company",
    "state",
    "issue",
    "sub_issue",
    "submitted_via",
    "zip_code_prefix3",
    "received_month_name",
    "received_day_name",
)
NUMERIC_COLUMNS = (
    "complaint_received_year",
    "complaint_received_quarter",
    "complaint_received_month",
    "complaint_received_day",
    "complaint_received_day_of_week",
    "received_is_weekend",
    "has_consumer_narrative",
    "has_tags",
)
REPORT_COLUMNS = (
    "complaint_id",
    "product",
    "sub_product",
    "company",
    "state",
    "issue",
    "sub_issue",
    "submitted_via",
    "complaint_received_date",
)
LABEL = "label_untimely_response"
SPLIT = "dataset_split"
WEIGHT = "class_weight"
ENCODED_SUFFIX = "_indexed"

# ---- Fixed values: learning settings ---------------------------------------------------------
SPLIT_BUCKETS = 100
TRAIN_BELOW = 70
VALIDATION_BELOW = 85
SMOOTHING = 20
FOLDS = 5
TOP_FEATURES = 10
SAMPLE_CAP = 500_000
SEED = 42
RECALL_FLOOR = 0.75
DEFAULT_THRESHOLD = 0.5
SELECTOR_PARAMS = {"numTrees": 60, "maxDepth": 8, "minInstancesPerNode": 25}
TREE_PARAMS = {"maxDepth": 8, "minInstancesPerNode": 50}
FOREST_PARAMS = {"numTrees": 80, "maxDepth": 10, "minInstancesPerNode": 25}
BOOSTED_PARAMS = {"maxIter": 120, "maxDepth": 8, "stepSize": 0.1, "subsamplingRate": 0.8,
                  "featureSubsetStrategy": "0.8"}
TREE_GRID = {"maxDepth": [6, 8, 10], "minInstancesPerNode": [25, 50, 100]}
FOREST_GRID = {"numTrees": [50, 80, 120], "maxDepth": [8, 10, 12]}
BOOSTED_GRID = {"maxDepth": [6, 8, 10], "stepSize": [0.05, 0.1, 0.2]}
TUNING_FOLDS = 3


def encoded_name(column: str) -> str:
    return column + ENCODED_SUFFIX


MODEL_INPUTS = tuple(encoded_name(c) for c in CATEGORICAL_COLUMNS) + NUMERIC_COLUMNS
