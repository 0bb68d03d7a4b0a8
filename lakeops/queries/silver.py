"""Queries over the clean layer."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeops import constants as K
from lakeops.operators import profile, quality, star
from lakeops.plans.fixtures import RAW_COLUMNS, TIE_BREAKS
from lakeops.plans.layers import silver_layer
from lakeops.queries.bronze import blanks_sql
from lakeops.queries.oracle import SILVER, count_if, parse
from lakeops.queries.registry import add

_LINEAGE = ("_ingestion_date", "_ingested_at", "_source_zip_path", "_source_csv_name", "_silver_record_status")

add(
    "dedupe_latest",
    lambda L: silver_layer(L.bronze, TIE_BREAKS).select(*RAW_COLUMNS, *_LINEAGE),
    SILVER + f" SELECT {', '.join(RAW_COLUMNS + _LINEAGE)} FROM silver",
)
add(
    "silver_missing_counts",
    lambda L: profile.null_counts(L.silver, K.SILVER_NULL_COLUMNS, "silver_row_count"),
    SILVER
    + " SELECT count(*) AS silver_row_count, "
    + ", ".join(f"{count_if(c + ' IS NULL')} AS null_{c}_count" for c in K.SILVER_NULL_COLUMNS)
    + " FROM silver",
)
add(
    "silver_remaining_blanks",
    lambda L: profile.whitespace_only_counts(L.silver, K.SILVER_BLANK_COLUMNS, "remaining_blank_count"),
    blanks_sql(SILVER, "silver", K.SILVER_BLANK_COLUMNS, "remaining_blank_count"),
)
add(
    "silver_duplicate_groups",
    lambda L: profile.duplicate_groups(L.silver),
    SILVER
    + " SELECT count(*) AS duplicate_complaint_id_groups FROM"
    + " (SELECT complaint_id FROM silver GROUP BY 1 HAVING count(*) > 1)",
)
add(
    "non_uppercase_count",
    lambda L: profile.non_uppercase_count(L.silver),
    SILVER + f" SELECT {count_if('state IS NOT NULL AND state <> upper(trim(state))')} AS non_uppercase_state_count FROM silver",
)
add(
    "silver_flag_values",
    lambda L: profile.value_counts(L.silver, "timely_response"),
    SILVER
    + " SELECT 'timely_response' AS column_name, timely_response AS value, count(*) AS row_count FROM silver"
    + " WHERE timely_response IS NOT NULL GROUP BY 2",
)
add(
    "silver_date_ranges",
    lambda L: profile.timestamp_ranges(L.silver, K.DATE_COLUMNS),
    SILVER
    + " SELECT "
    + ", ".join(
        f"min({c}) AS min_{c}_ts, max({c}) AS max_{c}_ts, count({c}) AS populated_{c}_count" for c in K.DATE_COLUMNS
    )
    + " FROM silver",
)


def scorecard_sql(head: str, table: str, metrics: dict[str, str]) -> str:
    return head + " " + " UNION ALL ".join(
        f"SELECT '{n}' AS metric_name, CAST({e} AS VARCHAR) AS metric_value FROM {table}" for n, e in metrics.items()
    )


add(
    "silver_scorecard",
    lambda L: profile.scorecard(profile.silver_metrics(L.silver)),
    scorecard_sql(
        SILVER,
        "silver",
        {
            "silver_row_count": "count(*)",
            "distinct_complaint_id_count": "count(DISTINCT complaint_id)",
            "null_complaint_id_count": count_if("complaint_id IS NULL"),
            "null_date_received_count": count_if("date_received IS NULL"),
            "non_uppercase_state_count": count_if("state IS NOT NULL AND state <> upper(trim(state))"),
            "non_standard_timely_response_count": count_if(
                "timely_response IS NOT NULL AND timely_response NOT IN ('YES', 'NO')"
            ),
            "non_valid_record_status_count": count_if("_silver_record_status <> 'VALID'"),
        },
    ),
)
_SAMPLE = (
    "complaint_id", "date_received", "product", "sub_product", "issue", "sub_issue", "company", "state",
    "zip_code", "submitted_via", "company_response_to_consumer", "timely_response", "_ingestion_date",
    "_ingested_at", "_source_zip_path", "_source_csv_name", "_silver_record_status",
)
# All rows of one build share _silver_processed_at, so the id decides; the stamp itself cannot be compared.
add(
    "silver_sample_rows",
    lambda L: star.sample_rows(L.silver, _SAMPLE, "_silver_processed_at"),
    SILVER + f" SELECT {', '.join(_SAMPLE)} FROM silver ORDER BY complaint_id LIMIT 50",
)
add(
    "union_all",
    lambda L: L.silver.select(F.lit("received").alias("role"), F.to_date("date_received").alias("full_date")).unionByName(
        L.silver.select(F.lit("sent").alias("role"), F.to_date("date_sent_to_company").alias("full_date"))
    ),
    SILVER
    + " SELECT 'received' AS role, CAST(date_received AS DATE) AS full_date FROM silver"
    + " UNION ALL SELECT 'sent', CAST(date_sent_to_company AS DATE) FROM silver",
)
add(
    "distinct",
    lambda L: L.silver.select("product", "sub_product").distinct(),
    SILVER + " SELECT DISTINCT product, sub_product FROM silver",
)


def checks_sql(head: str, source: str, checks: dict[str, str]) -> str:
    return head + " " + " UNION ALL ".join(
        f"SELECT '{n}' AS check_name, v AS violations, v = 0 AS passed FROM (SELECT CAST({e} AS BIGINT) AS v {source} LIMIT 1)"
        for n, e in checks.items()
    )


EMPTY = "CASE WHEN count(*) = 0 THEN 1 ELSE 0 END"


def repeated(table: str) -> str:
    return f"(SELECT count(*) FROM (SELECT complaint_id FROM {table} GROUP BY 1 HAVING count(*) > 1))"


_OWED = (
    "(SELECT count(*) FROM (SELECT CAST(trim(complaint_id) AS BIGINT) AS id FROM complaints_raw"
    " WHERE regexp_full_match(trim(complaint_id), '[0-9]+')"
    f" GROUP BY 1 HAVING bool_and({parse('trim(date_received)')} IS NOT NULL)))"
)
add(
    "bronze_gate",
    lambda L: quality.bronze_gate(L.bronze),
    checks_sql(SILVER, "FROM complaints_raw", {"has_rows": EMPTY}),
)
add(
    "silver_gate",
    lambda L: quality.silver_gate(L.silver, L.bronze),
    checks_sql(
        SILVER,
        "FROM silver",
        {
            "has_rows": EMPTY,
            "unique_complaint_id": repeated("silver"),
            "null_complaint_id": count_if("complaint_id IS NULL"),
            "rows_above_source": "greatest(count(*) - (SELECT count(*) FROM complaints_raw), 0)",
            "lost_dates": f"greatest({_OWED} - count(date_received), 0)",
        },
    ),
)
add(
    "expect",
    lambda L: quality.expect(
        L.bronze,
        {
            "null_id": F.col("complaint_id").isNull(),
            "blank_company": F.trim(F.coalesce("company", F.lit(""))) == "",
        },
        unique="complaint_id",
    ),
    checks_sql(
        SILVER,
        "FROM complaints_raw",
        {
            "has_rows": EMPTY,
            "unique_complaint_id": repeated("complaints_raw"),
            "null_id": count_if("complaint_id IS NULL"),
            "blank_company": count_if("trim(coalesce(company, '')) = ''"),
        },
    ),
)
