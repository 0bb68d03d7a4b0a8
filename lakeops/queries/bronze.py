"""Queries over the raw layer: cleaning functions, profiles and quality reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeops import constants as K
from lakeops.functions import dates, text
from lakeops.operators import clean, profile
from lakeops.plans.fixtures import RAW_COLUMNS
from lakeops.queries.oracle import (
    RAW,
    SILVER,
    TRIMMED,
    TYPED,
    count_if,
    flag,
    missing,
    parse,
    parse_listed,
)
from lakeops.queries.registry import add
from lakeops.sources import delimited

R = "FROM complaints_raw"

# ---- scanning and naming -----------------------------------------------------------------------
add(
    "scan_table",
    lambda L: L.bronze.drop("_px"),
    RAW + f" SELECT * EXCLUDE (_px) {R}",
)

_HEADERS = {
    "complaint_id": "Complaint ID",
    "date_received": " Date received ",
    "sub_product": "Sub-product",
    "zip_code": "ZIP code",
    "timely_response": "Timely response?",
    "company_response_to_consumer": "Company response (to consumer)",
}
add(
    "normalise_columns",
    lambda L: delimited.normalise_columns(
        L.bronze.select(*[F.col(c).alias(h) for c, h in _HEADERS.items()])
    ),
    RAW + f" SELECT {', '.join(_HEADERS)} {R}",
)
add(
    "add_lineage",
    lambda L: delimited.add_lineage(
        L.bronze.select("complaint_id", "_ln"),
        "2026-07-30",
        "landing/records.zip",
        F.concat(F.col("_ln").cast("string"), F.lit(".csv")),
    ).drop("_ingested_at"),
    RAW
    + " SELECT complaint_id, _ln, DATE '2026-07-30' AS _ingestion_date, 'landing/records.zip' AS _source_zip_path,"
    + f" _source_csv_name {R}",
)

# ---- cleaning projections ----------------------------------------------------------------------
add(
    "clean_strings",
    lambda L: clean.clean_strings(L.bronze.select(*RAW_COLUMNS)),
    TRIMMED + f" SELECT {', '.join(RAW_COLUMNS)} FROM trimmed",
)


def _parsed(L, patterns, default):
    cols = {f"{c}_ts": dates.parse_timestamp(F.col(c), patterns, default) for c in K.DATE_COLUMNS}
    return L.bronze.select("_ln", *K.DATE_COLUMNS, *[v.alias(k) for k, v in cols.items()])


def _parsed_sql(fn) -> str:
    cols = ", ".join(f"{fn(c)} AS {c}_ts" for c in K.DATE_COLUMNS)
    return RAW + f" SELECT _ln, {', '.join(K.DATE_COLUMNS)}, {cols} {R}"


add("parse_timestamps", lambda L: _parsed(L, K.SILVER_DATE_PATTERNS, True), _parsed_sql(parse))
add("parse_timestamps_profile", lambda L: _parsed(L, K.PROFILE_DATE_PATTERNS, False), _parsed_sql(parse_listed))
add("parse_timestamps_quality", lambda L: _parsed(L, K.QUALITY_DATE_PATTERNS, False), _parsed_sql(parse_listed))
add(
    "numeric_key",
    lambda L: clean.cast_numeric_key(clean.clean_strings(L.bronze.select("complaint_id", "_ln"))),
    TYPED + " SELECT complaint_id, _ln FROM typed",
)
add(
    "uppercase",
    lambda L: clean.uppercase(L.bronze.select("state", "_ln"), "state"),
    RAW + f" SELECT upper(state) AS state, _ln {R}",
)
add(
    "standardise_flag",
    lambda L: clean.standardise_flag(L.bronze.select("timely_response", "_ln"), "timely_response"),
    RAW + f" SELECT {flag('timely_response')} AS timely_response, _ln {R}",
)
add(
    "drop_invalid_keys",
    lambda L: clean.drop_invalid_keys(
        clean.cast_numeric_key(clean.clean_strings(L.bronze.select("complaint_id", "_ln", "_pk")))
    ),
    TYPED + " SELECT complaint_id, _ln, _pk FROM typed WHERE complaint_id IS NOT NULL",
)
add(
    "filter_valid_ids",
    lambda L: clean.filter_valid_ids(L.bronze.select("complaint_id", "_ln", "_pk")),
    RAW + f" SELECT complaint_id, _ln, _pk {R} WHERE regexp_full_match(trim(complaint_id), '[0-9]+')",
)
add(
    "audit_columns",
    lambda L: clean.audit_columns(
        L.bronze.select("complaint_id", "_ln"), "_silver_processed_at", "_silver_record_status"
    ).select("complaint_id", "_ln", "_silver_record_status",
             F.col("_silver_processed_at").isNotNull().alias("is_stamped")),
    RAW + f" SELECT complaint_id, _ln, 'VALID' AS _silver_record_status, true AS is_stamped {R}",
)
add(
    "count_parseable",
    lambda L: clean.count_parseable(L.bronze),
    RAW
    + " SELECT "
    + ", ".join(f"{count_if(parse(c) + ' IS NOT NULL')} AS parseable_{c}_count" for c in K.DATE_COLUMNS)
    + f" {R}",
)
add(
    "prefix",
    lambda L: L.bronze.select("zip_code", "_ln", text.prefix(F.col("zip_code")).alias("zip_code_prefix3")),
    RAW + f" SELECT zip_code, _ln, coalesce(substr(zip_code, 1, 3), 'NOT_PROVIDED') AS zip_code_prefix3 {R}",
)
add(
    "presence_flag",
    lambda L: L.bronze.select("_ln", "tags", text.presence_flag(F.col("tags")).alias("has_tags")),
    RAW + f" SELECT _ln, tags, tags IS NOT NULL AS has_tags {R}",
)

# ---- profiles ----------------------------------------------------------------------------------
add(
    "table_footprint",
    lambda L: profile.table_footprint(L.bronze),
    RAW
    + " SELECT count(*) AS row_count, count(DISTINCT complaint_id) AS distinct_complaint_id_count,"
    + " count(DISTINCT _ingestion_date) AS ingestion_date_count, min(_ingestion_date) AS min_ingestion_date,"
    + f" max(_ingestion_date) AS max_ingestion_date {R}",
)


def _blank_row(c: str) -> str:
    return (
        f"SELECT '{c}' AS column_name, count(*) AS total_rows, {count_if(c + ' IS NULL')} AS null_count,"
        f" round(100.0 * count(*) FILTER (WHERE {c} IS NULL) / nullif(count(*), 0), 2) AS null_pct,"
        f" {count_if(missing(c))} AS blank_or_whitespace_count,"
        f" round(100.0 * count(*) FILTER (WHERE {missing(c)}) / nullif(count(*), 0), 2)"
        f" AS blank_or_whitespace_pct {R}"
    )


add(
    "null_blank_profile",
    lambda L: profile.null_blank_profile(L.bronze, K.BLANK_PROFILE_COLUMNS),
    RAW + " " + " UNION ALL ".join(_blank_row(c) for c in K.BLANK_PROFILE_COLUMNS),
)
add(
    "distinct_profile",
    lambda L: profile.distinct_profile(L.bronze, K.DISTINCT_PROFILE_COLUMNS),
    RAW
    + " "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(DISTINCT {c}) AS distinct_value_count {R}"
        for c in K.DISTINCT_PROFILE_COLUMNS
    ),
)
_DUPES = (
    RAW
    + ", dupes AS (SELECT complaint_id, count(*) AS row_count, min(_ingested_at) AS earliest_ingested_at,"
    + f" max(_ingested_at) AS latest_ingested_at {R} WHERE complaint_id IS NOT NULL GROUP BY 1 HAVING count(*) > 1)"
)
add(
    "duplicate_summary",
    lambda L: profile.duplicate_summary(L.bronze),
    _DUPES
    + " SELECT count(*) AS duplicate_complaint_id_count, CAST(coalesce(sum(row_count), 0) AS BIGINT) AS duplicate_row_count,"
    + " CAST(coalesce(sum(row_count) - count(*), 0) AS BIGINT) AS rows_above_unique_grain,"
    + " min(earliest_ingested_at) AS first_duplicate_seen_at, max(latest_ingested_at) AS last_duplicate_seen_at FROM dupes",
)
add(
    "duplicate_sample",
    lambda L: profile.duplicate_sample(L.bronze, 50),
    _DUPES + " SELECT * FROM dupes ORDER BY row_count DESC, latest_ingested_at DESC, complaint_id LIMIT 50",
)
add(
    "duplicate_sample_quality",
    lambda L: profile.duplicate_sample(L.bronze, 100, count_name="duplicate_count"),
    _DUPES
    + " SELECT complaint_id, row_count AS duplicate_count, earliest_ingested_at, latest_ingested_at FROM dupes"
    + " ORDER BY row_count DESC, latest_ingested_at DESC, complaint_id LIMIT 100",
)
add(
    "duplicate_groups",
    lambda L: profile.duplicate_groups(L.bronze),
    RAW
    + f" SELECT count(*) AS duplicate_complaint_id_groups FROM (SELECT complaint_id {R} GROUP BY 1 HAVING count(*) > 1)",
)


def _frequency(column: str, n: int | None) -> None:
    limit = f" LIMIT {n}" if n else ""
    add(
        f"frequency_{column}",
        lambda L: profile.frequency(L.bronze, column, n),
        RAW
        + f" SELECT {column}, count(*) AS row_count {R} GROUP BY 1 ORDER BY 2 DESC, 1 ASC NULLS FIRST{limit}",
    )


for _column, _n in (
    ("product", 50),
    ("state", 60),
    ("submitted_via", 30),
    ("company_response_to_consumer", 30),
    ("timely_response", None),
):
    _frequency(_column, _n)

add(
    "top_k",
    lambda L: profile.frequency(L.bronze, "company", 25),
    RAW + f" SELECT company, count(*) AS row_count {R} GROUP BY 1 ORDER BY 2 DESC, 1 ASC NULLS FIRST LIMIT 25",
)


def _range_sql() -> str:
    parts = []
    for c in K.DATE_COLUMNS:
        p = parse_listed(c)
        parts += [
            f"min({p}) AS min_{c}_ts",
            f"max({p}) AS max_{c}_ts",
            f"{count_if(f'{c} IS NOT NULL AND {p} IS NULL')} AS unparseable_{c}_count",
        ]
    return RAW + f" SELECT {', '.join(parts)} {R}"


add(
    "date_range_profile",
    lambda L: profile.date_range_profile(L.bronze, K.DATE_COLUMNS, K.PROFILE_DATE_PATTERNS),
    _range_sql(),
)

# ---- quality reports ---------------------------------------------------------------------------
add(
    "id_quality",
    lambda L: profile.id_quality(L.bronze),
    RAW
    + f" SELECT count(*) AS total_rows, {count_if('complaint_id IS NULL')} AS null_complaint_id_count,"
    + f" {count_if(missing('complaint_id'))} AS blank_complaint_id_count,"
    + f""" {count_if("complaint_id IS NOT NULL AND NOT regexp_full_match(trim(complaint_id), '[0-9]+')")}"""
    + f" AS non_numeric_complaint_id_count {R}",
)
add(
    "missing_counts",
    lambda L: profile.missing_counts(L.bronze, K.RAW_MISSING_COLUMNS),
    RAW
    + " SELECT "
    + ", ".join(f"{count_if(missing(c))} AS missing_{c}_count" for c in K.RAW_MISSING_COLUMNS)
    + f" {R}",
)


def blanks_sql(head: str, table: str, columns, name: str) -> str:
    return (
        head
        + " "
        + " UNION ALL ".join(
            f"SELECT '{c}' AS column_name, count(*) AS {name} FROM {table} WHERE {c} IS NOT NULL AND trim({c}) = ''"
            for c in columns
        )
    )


add(
    "whitespace_only_counts",
    lambda L: profile.whitespace_only_counts(L.bronze, K.SILVER_BLANK_COLUMNS),
    blanks_sql(RAW, "complaints_raw", K.SILVER_BLANK_COLUMNS, "whitespace_only_count"),
)
_FOLDS = {"product": "lower", "company": "lower", "state": "upper", "submitted_via": "lower", "timely_response": "upper"}
add(
    "case_fragmentation",
    lambda L: profile.case_fragmentation(L.bronze, _FOLDS),
    RAW
    + " "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(DISTINCT {c}) AS raw_distinct_count,"
        f" count(DISTINCT {how}(trim({c}))) AS normalised_distinct_count {R} WHERE {c} IS NOT NULL"
        for c, how in _FOLDS.items()
    ),
)
add(
    "unparseable_counts",
    lambda L: profile.unparseable_counts(L.bronze, K.DATE_COLUMNS, K.QUALITY_DATE_PATTERNS),
    RAW
    + " SELECT "
    + ", ".join(
        f"{count_if(f'{c} IS NOT NULL AND {parse_listed(c)} IS NULL')} AS invalid_{c}_count" for c in K.DATE_COLUMNS
    )
    + f" {R}",
)
_BAD = " OR ".join(f"({c} IS NOT NULL AND parsed_{c} IS NULL)" for c in K.DATE_COLUMNS)
add(
    "unparseable_sample",
    lambda L: profile.unparseable_sample(L.bronze, K.DATE_COLUMNS, K.QUALITY_DATE_PATTERNS),
    RAW
    + f" SELECT * FROM (SELECT {', '.join(K.DATE_COLUMNS)}, "
    + ", ".join(f"{parse_listed(c)} AS parsed_{c}" for c in K.DATE_COLUMNS)
    + f" {R}) WHERE {_BAD} ORDER BY date_received NULLS FIRST, date_sent_to_company NULLS FIRST LIMIT 50",
)
add(
    "invalid_flag_values",
    lambda L: profile.invalid_flag_values(L.bronze, "timely_response"),
    RAW
    + f" SELECT 'timely_response' AS column_name, timely_response AS raw_value, count(*) AS row_count {R}"
    + " WHERE timely_response IS NOT NULL AND upper(trim(timely_response)) NOT IN ('YES', 'NO') GROUP BY 2",
)
add(
    "suspicious_pattern",
    lambda L: profile.suspicious_pattern(L.bronze, "zip_code"),
    RAW
    + f" SELECT zip_code, count(*) AS row_count {R} WHERE zip_code IS NOT NULL AND trim(zip_code) <> ''"
    + " AND NOT regexp_full_match(trim(zip_code), '[0-9]{5}(-[0-9]{4})?') GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 100",
)
add(
    "missing_by_group",
    lambda L: profile.missing_by_group(L.bronze, ["_ingestion_date", "_source_csv_name"], K.GROUP_MISSING_COLUMNS),
    RAW
    + " SELECT _source_csv_name, _ingestion_date, count(*) AS row_count, "
    + ", ".join(f"{count_if(missing(c))} AS missing_{c}_count" for c in K.GROUP_MISSING_COLUMNS)
    + f" {R} GROUP BY 1, 2",
)
add(
    "layer_counts",
    lambda L: profile.layer_counts(
        L.bronze, L.silver, ("bronze_row_count", "silver_row_count"), "rows_removed_in_silver"
    ),
    SILVER
    + " SELECT b AS bronze_row_count, s AS silver_row_count, b - s AS rows_removed_in_silver"
    + f" FROM (SELECT (SELECT count(*) {R}) AS b, (SELECT count(*) FROM silver) AS s)",
)
add(
    "id_preservation",
    lambda L: profile.id_preservation(L.bronze, L.silver),
    SILVER
    + " SELECT * FROM (SELECT count(*) AS bronze_valid_complaint_id_rows,"
    + f" count(DISTINCT trim(complaint_id)) AS bronze_valid_distinct_complaint_ids {R}"
    + " WHERE regexp_full_match(trim(complaint_id), '[0-9]+')),"
    + " (SELECT count(*) AS silver_rows, count(DISTINCT complaint_id) AS silver_distinct_complaint_ids FROM silver)",
)
