"""DuckDB text of the layers, used as the head of the checking SQL of each query."""

from __future__ import annotations

from lakeops.constants import CATEGORICAL_COLUMNS
from lakeops.plans.fixtures import RAW_COLUMNS, RAW_SQL, SCORED_SQL, duckdb_sql

M = "'NOT_PROVIDED'"


def parse(c: str, default: bool = True, two_digit: bool = True, time: bool = True) -> str:
    """Timestamp of a text, guarded by shape because DuckDB's formats accept more than Spark's."""
    parts = []
    if default:
        parts.append(f"CASE WHEN regexp_matches({c}, '^[0-9]{{4}}-[0-9]{{1,2}}-[0-9]{{1,2}}') THEN try_cast({c} AS TIMESTAMP) END")
    parts.append(f"CASE WHEN regexp_full_match({c}, '[0-9]{{1,2}}/[0-9]{{1,2}}/[0-9]{{4}}') THEN try_strptime({c}, '%m/%d/%Y') END")
    if two_digit:
        parts.append(f"CASE WHEN regexp_full_match({c}, '[0-9]{{1,2}}/[0-9]{{1,2}}/[0-9]{{2}}') THEN try_strptime({c}, '%m/%d/%y') END")
    parts.append(f"CASE WHEN regexp_full_match({c}, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}') THEN try_strptime({c}, '%Y-%m-%d') END")
    if time:
        parts.append(f"CASE WHEN regexp_full_match({c}, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}} [0-9]{{2}}:[0-9]{{2}}:[0-9]{{2}}') THEN try_strptime({c}, '%Y-%m-%d %H:%M:%S') END")
    return "coalesce(" + ", ".join(parts) + ")"


def parse_listed(c: str) -> str:
    """The month-first and ISO day patterns without the default parse."""
    return parse(c, default=False, two_digit=False, time=False)


def flag(c: str) -> str:
    return (
        f"CASE WHEN lower(trim({c})) IN ('yes','y','true','1') THEN 'YES' "
        f"WHEN lower(trim({c})) IN ('no','n','false','0') THEN 'NO' ELSE upper({c}) END"
    )


def missing(c: str) -> str:
    return f"(trim(coalesce({c}, '')) = '')"


def count_if(cond: str) -> str:
    return f"CAST(count(*) FILTER (WHERE {cond}) AS BIGINT)"


def md5_bucket(c: str, buckets: int, salt: str = "") -> str:
    return f"(CAST(concat('0x', substr(md5('{salt}' || CAST({c} AS VARCHAR)), 1, 8)) AS BIGINT) % {buckets})"


_LINEAGE = "_ingestion_date, _ingested_at, nullif(trim(_source_zip_path), '') AS _source_zip_path, nullif(trim(_source_csv_name), '') AS _source_csv_name, _ln, _pk, _sk, _px"
_TYPED = {
    "complaint_id": "CASE WHEN regexp_full_match(complaint_id, '[0-9]+') THEN try_cast(complaint_id AS BIGINT) END",
    "date_received": parse("date_received"),
    "date_sent_to_company": parse("date_sent_to_company"),
    "state": "upper(state)",
    "timely_response": flag("timely_response"),
}

RAW = f"WITH complaints_raw AS ({duckdb_sql(RAW_SQL)})"
TRIMMED = (
    RAW
    + ",\ntrimmed AS (SELECT "
    + ", ".join(f"nullif(trim({c}), '') AS {c}" for c in RAW_COLUMNS)
    + f", {_LINEAGE} FROM complaints_raw)"
)
TYPED = (
    TRIMMED
    + ",\ntyped AS (SELECT "
    + ", ".join(f"{_TYPED.get(c, c)} AS {c}" for c in RAW_COLUMNS)
    + ", _ingestion_date, _ingested_at, _source_zip_path, _source_csv_name, _ln, _pk, _sk, _px FROM trimmed)"
)
SILVER = (
    TYPED
    + """,
silver AS (
  SELECT *, 'VALID' AS _silver_record_status FROM typed WHERE complaint_id IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY complaint_id ORDER BY _ingested_at DESC NULLS LAST,
    _ingestion_date DESC NULLS LAST, _ln DESC, _pk DESC, _sk DESC, _px DESC) = 1)"""
)


def _dim(name: str, columns: list[str]) -> str:
    order = ", ".join([f"coalesce({c}, {M})" for c in columns] + [f"{c} NULLS FIRST" for c in columns])
    listed = ", ".join(columns)
    labels = ", ".join([M] * len(columns))
    return (
        f",\ndim_{name} AS (SELECT 0 AS {name}_key, " + ", ".join(f"{M} AS {c}" for c in columns)
        + f" UNION ALL SELECT CAST(row_number() OVER (ORDER BY {order}) AS INTEGER), {listed}"
        + f" FROM (SELECT DISTINCT {listed} FROM silver))"
    )


DIMS = (
    SILVER
    + """,
dim_date AS (
  SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, d AS full_date,
    CAST(year(d) AS INTEGER) AS calendar_year, CAST(quarter(d) AS INTEGER) AS calendar_quarter,
    CAST(month(d) AS INTEGER) AS calendar_month, strftime(d, '%B') AS calendar_month_name,
    CAST(day(d) AS INTEGER) AS calendar_day, CAST(dayofweek(d) + 1 AS INTEGER) AS day_of_week,
    strftime(d, '%A') AS day_name, dayofweek(d) IN (0, 6) AS is_weekend
  FROM (SELECT CAST(date_received AS DATE) AS d FROM silver
        UNION SELECT CAST(date_sent_to_company AS DATE) FROM silver) WHERE d IS NOT NULL
  UNION ALL SELECT 0, NULL, NULL, NULL, NULL, 'NOT_PROVIDED', NULL, NULL, 'NOT_PROVIDED', NULL)"""
    + _dim("product", ["product", "sub_product"])
    + _dim("company", ["company"])
    + _dim("state", ["state"])
)
GOLD = (
    DIMS
    + """,
fact AS (
  SELECT s.complaint_id, coalesce(dr.date_key, 0) AS received_date_key,
    coalesce(ds.date_key, 0) AS sent_date_key, coalesce(p.product_key, 0) AS product_key,
    coalesce(c.company_key, 0) AS company_key, coalesce(st.state_key, 0) AS state_key,
    s.issue, s.sub_issue, s.zip_code, s.tags, s.submitted_via, s.company_response_to_consumer,
    s.timely_response, s.consumer_complaint_narrative IS NOT NULL AS has_consumer_narrative,
    s.tags IS NOT NULL AS has_tags, s.date_sent_to_company IS NOT NULL AS has_company_response_date,
    s._ingestion_date, s._ingested_at, s._source_zip_path, s._source_csv_name, s._silver_record_status
  FROM silver s
  LEFT JOIN dim_product p ON p.product_key <> 0 AND s.product IS NOT DISTINCT FROM p.product
    AND s.sub_product IS NOT DISTINCT FROM p.sub_product
  LEFT JOIN dim_company c ON c.company_key <> 0 AND s.company IS NOT DISTINCT FROM c.company
  LEFT JOIN dim_state st ON st.state_key <> 0 AND s.state IS NOT DISTINCT FROM st.state
  LEFT JOIN dim_date dr ON CAST(s.date_received AS DATE) = dr.full_date
  LEFT JOIN dim_date ds ON CAST(s.date_sent_to_company AS DATE) = ds.full_date)"""
)
BASE = (
    GOLD
    + """,
base AS (
  SELECT f.*, dd.full_date AS received_full_date, dd.calendar_year AS received_year,
    dd.calendar_quarter AS received_quarter, dd.calendar_month AS received_month,
    dd.calendar_month_name AS received_month_name, dd.calendar_day AS received_day,
    dd.day_of_week AS received_day_of_week, dd.day_name AS received_day_name,
    dd.is_weekend AS received_is_weekend, p.product, p.sub_product, c.company, st.state
  FROM fact f LEFT JOIN dim_date dd ON f.received_date_key = dd.date_key
  LEFT JOIN dim_product p ON f.product_key = p.product_key
  LEFT JOIN dim_company c ON f.company_key = c.company_key
  LEFT JOIN dim_state st ON f.state_key = st.state_key)"""
)
FEATURES = (
    BASE
    + f""",
features AS (
  SELECT complaint_id, CASE WHEN timely_response = 'NO' THEN 1 ELSE 0 END AS label_untimely_response,
    timely_response, received_full_date AS complaint_received_date,
    coalesce(received_year, 0) AS complaint_received_year,
    coalesce(received_quarter, 0) AS complaint_received_quarter,
    coalesce(received_month, 0) AS complaint_received_month,
    coalesce(received_day, 0) AS complaint_received_day,
    coalesce(received_day_of_week, 0) AS complaint_received_day_of_week,
    coalesce(received_month_name, {M}) AS received_month_name,
    coalesce(received_day_name, {M}) AS received_day_name,
    coalesce(CAST(received_is_weekend AS INTEGER), 0) AS received_is_weekend,
    coalesce(product, {M}) AS product, coalesce(sub_product, {M}) AS sub_product,
    coalesce(company, {M}) AS company, coalesce(state, {M}) AS state, coalesce(issue, {M}) AS issue,
    coalesce(sub_issue, {M}) AS sub_issue, coalesce(submitted_via, {M}) AS submitted_via,
    CASE WHEN zip_code IS NULL THEN {M} ELSE substr(zip_code, 1, 3) END AS zip_code_prefix3,
    CAST(has_consumer_narrative AS INTEGER) AS has_consumer_narrative,
    CAST(has_tags AS INTEGER) AS has_tags,
    CASE WHEN {md5_bucket('complaint_id', 100)} < 70 THEN 'TRAIN'
         WHEN {md5_bucket('complaint_id', 100)} < 85 THEN 'VALIDATION' ELSE 'TEST' END AS dataset_split,
    {md5_bucket('complaint_id', 100)} AS split_bucket,
    _ingestion_date, _ingested_at, _source_zip_path, _source_csv_name
  FROM base WHERE timely_response IN ('YES', 'NO'))"""
)
_LONG = " UNION ALL ".join(
    f"SELECT '{c}' AS feature, {c} AS category, label_untimely_response AS y, "
    f"{md5_bucket('complaint_id', 5, 'fold:')} AS fold FROM features WHERE dataset_split = 'TRAIN'"
    for c in CATEGORICAL_COLUMNS
)
ENCODED = (
    FEATURES
    + f""",
rate AS (SELECT avg(label_untimely_response) AS g FROM features WHERE dataset_split = 'TRAIN'),
long AS ({_LONG}),
enc AS (SELECT feature, category, CAST(count(*) AS BIGINT) AS n, CAST(sum(y) AS BIGINT) AS positives,
  (sum(y) + 20 * any_value(g)) / (count(*) + 20.0) AS rate FROM long, rate GROUP BY ALL),
folds AS (SELECT feature, category, fold, count(*) AS n, sum(y) AS p FROM long GROUP BY ALL),
oof AS (SELECT feature, category, fold,
  (sum(p) OVER w - p + 20 * g) / (sum(n) OVER w - n + 20.0) AS rate
  FROM folds, rate WINDOW w AS (PARTITION BY feature, category))"""
)
SCORED = f"WITH scored AS ({duckdb_sql(SCORED_SQL)})"
CURVE = (
    SCORED
    + """,
scores AS (SELECT model_name, dataset_split, probability AS score, count(*) AS n, sum(label) AS pos
  FROM scored GROUP BY ALL),
cum AS (SELECT *, sum(n) OVER w AS cum_n, sum(pos) OVER w AS cum_pos,
  sum(n) OVER g AS total_n, sum(pos) OVER g AS total_pos FROM scores
  WINDOW w AS (PARTITION BY model_name, dataset_split ORDER BY score DESC),
         g AS (PARTITION BY model_name, dataset_split)),
curve AS (SELECT model_name, dataset_split, score AS threshold,
  CAST(cum_pos AS DOUBLE) / cum_n AS precision, CAST(cum_pos AS DOUBLE) / total_pos AS recall FROM cum),
picked AS (SELECT model_name, threshold FROM curve WHERE dataset_split = 'VALIDATION' AND recall >= 0.75
  QUALIFY row_number() OVER (PARTITION BY model_name ORDER BY precision DESC, threshold) = 1)"""
)
