"""Queries over the star schema."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeops import constants as K
from lakeops.operators import dims, profile, quality, star
from lakeops.operators.scan import ordered_key
from lakeops.queries.oracle import BASE, DIMS, GOLD, SILVER, count_if
from lakeops.queries.registry import add
from lakeops.queries.silver import EMPTY, checks_sql, repeated, scorecard_sql

_FACT = (
    "complaint_id", *K.FACT_KEYS, "issue", "sub_issue", "zip_code", "tags", "submitted_via",
    "company_response_to_consumer", "timely_response", "has_consumer_narrative", "has_tags",
    "has_company_response_date", "_ingestion_date", "_ingested_at", "_source_zip_path", "_source_csv_name",
    "_silver_record_status",
)
_DIM_KEYS = {
    "received_date_key": ("date", "date_key"),
    "sent_date_key": ("date", "date_key"),
    "product_key": ("product", "product_key"),
    "company_key": ("company", "company_key"),
    "state_key": ("state", "state_key"),
}


def _short(key: str) -> str:
    return key.removesuffix("_key")


# ---- dimensions ----------------------------------------------------------------------------------
add("build_date_dim", lambda L: dims.build_date_dim(L.silver), DIMS + " SELECT * FROM dim_date")
add(
    "build_dim_product",
    lambda L: dims.build_dim(L.silver, ["product", "sub_product"], "product_key"),
    DIMS + " SELECT * FROM dim_product",
)
add(
    "build_dim_company",
    lambda L: dims.build_dim(L.silver, ["company"], "company_key"),
    DIMS + " SELECT * FROM dim_company",
)
add(
    "build_dim_state",
    lambda L: dims.build_dim(L.silver, ["state"], "state_key"),
    DIMS + " SELECT * FROM dim_state",
)
add(
    "ordered_key",
    lambda L: ordered_key(
        L.silver.select("complaint_id", "state"),
        [F.col("state").asc_nulls_first(), F.col("complaint_id").desc()],
        "row_key",
    ),
    SILVER
    + " SELECT complaint_id, state, CAST(row_number() OVER (ORDER BY state NULLS FIRST, complaint_id DESC) AS INTEGER)"
    + " AS row_key FROM silver",
)
add(
    "unknown_member",
    lambda L: dims.with_unknown_member(L.dim("product").filter("product_key <> 0"), "product_key", ["product", "sub_product"]),
    DIMS + " SELECT * FROM dim_product",
)

# ---- lookups and the fact ------------------------------------------------------------------------
add(
    "lookup_key_nullsafe",
    lambda L: star.lookup_key_nullsafe(
        L.silver.select("complaint_id", "product", "sub_product"), L.dim("product"), ["product", "sub_product"], "product_key"
    ),
    DIMS
    + " SELECT s.complaint_id, s.product, s.sub_product, coalesce(p.product_key, 0) AS product_key FROM silver s"
    + " LEFT JOIN dim_product p ON p.product_key <> 0 AND s.product IS NOT DISTINCT FROM p.product"
    + " AND s.sub_product IS NOT DISTINCT FROM p.sub_product",
)


def _dates(L):
    df = L.silver.select("complaint_id", *K.DATE_COLUMNS)
    df = star.lookup_date_key(df, L.dim("date"), "date_received", "received_date_key")
    return star.lookup_date_key(df, L.dim("date"), "date_sent_to_company", "sent_date_key")


add(
    "lookup_date_key",
    _dates,
    GOLD
    + " SELECT complaint_id, s.date_received, s.date_sent_to_company, received_date_key, sent_date_key"
    + " FROM fact JOIN silver s USING (complaint_id)",
)
add(
    "build_fact",
    lambda L: star.build_fact(L.silver, L.dims).select(*_FACT),
    GOLD + f" SELECT {', '.join(_FACT)} FROM fact",
)
_BASE = (
    *_FACT, "received_full_date", "received_year", "received_quarter", "received_month", "received_month_name",
    "received_day", "received_day_of_week", "received_day_name", "received_is_weekend", "product", "sub_product",
    "company", "state",
)
add(
    "denormalise",
    lambda L: star.denormalise(L.fact, L.dims).select(*_BASE),
    BASE + f" SELECT {', '.join(_BASE)} FROM base",
)
add(
    "orphan_counts",
    lambda L: star.orphan_counts(L.fact, {k: (L.dim(d), c) for k, (d, c) in _DIM_KEYS.items()}),
    GOLD
    + " SELECT "
    + ", ".join(
        f"{count_if(f'{k} NOT IN (SELECT {c} FROM dim_{d})')} AS orphan_{k}s" for k, (d, c) in _DIM_KEYS.items()
    )
    + " FROM fact",
)


def _with_missing_members(L):
    """The same report against dimensions that lost members: Sundays, and states A to F."""
    some_dates = L.dim("date").filter("day_of_week IS NULL OR day_of_week <> 1")
    some_states = L.dim("state").filter("state IS NULL OR state > 'F'")
    return star.orphan_counts(
        L.fact,
        {
            "received_date_key": (some_dates, "date_key"),
            "sent_date_key": (some_dates, "date_key"),
            "state_key": (some_states, "state_key"),
        },
    )


_SOME_DATES = "(SELECT date_key FROM dim_date WHERE day_of_week IS NULL OR day_of_week <> 1)"
_SOME_STATES = "(SELECT state_key FROM dim_state WHERE state IS NULL OR state > 'F')"
add(
    "orphan_counts_missing_members",
    _with_missing_members,
    GOLD
    + f" SELECT {count_if(f'received_date_key NOT IN {_SOME_DATES}')} AS orphan_received_date_keys,"
    + f" {count_if(f'sent_date_key NOT IN {_SOME_DATES}')} AS orphan_sent_date_keys,"
    + f" {count_if(f'state_key NOT IN {_SOME_STATES}')} AS orphan_state_keys FROM fact",
)

# ---- reports ---------------------------------------------------------------------------------------
add(
    "cross_stats",
    lambda L: profile.layer_counts(L.silver, L.fact, ("silver_row_count", "gold_fact_row_count"), "row_difference"),
    GOLD
    + " SELECT a AS silver_row_count, b AS gold_fact_row_count, a - b AS row_difference FROM"
    + " (SELECT (SELECT count(*) FROM silver) AS a, (SELECT count(*) FROM fact) AS b)",
)
add(
    "gold_row_counts",
    lambda L: profile.row_counts({**{f"dim_{n}": d for n, d in L.dims.items()}, "fact": L.fact}),
    GOLD
    + " "
    + " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}"
        for t in ("dim_date", "dim_product", "dim_company", "dim_state", "fact")
    ),
)
add(
    "gold_duplicate_groups",
    lambda L: profile.duplicate_groups(L.fact),
    GOLD + f" SELECT {repeated('fact')} AS duplicate_complaint_id_groups",
)
add(
    "null_key_counts",
    lambda L: profile.null_counts(L.fact, (K.ID, *K.FACT_KEYS), "fact_row_count"),
    GOLD
    + " SELECT count(*) AS fact_row_count, "
    + ", ".join(f"{count_if(c + ' IS NULL')} AS null_{c}_count" for c in (K.ID, *K.FACT_KEYS))
    + " FROM fact",
)
add(
    "unknown_key_counts",
    lambda L: profile.unknown_key_counts(L.fact, K.FACT_KEYS),
    GOLD + " SELECT " + ", ".join(f"{count_if(k + ' = 0')} AS unknown_{_short(k)}_rows" for k in K.FACT_KEYS) + " FROM fact",
)
add(
    "date_dim_profile",
    lambda L: profile.date_dim_profile(L.dim("date")),
    DIMS
    + " SELECT min(full_date) AS min_full_date, max(full_date) AS max_full_date, count(*) AS total_dim_date_rows,"
    + f" {count_if('date_key = 0')} AS unknown_date_rows FROM dim_date",
)


def _dim_profile(name: str, labels: list[str]) -> None:
    add(
        f"dim_profile_{name}",
        lambda L: profile.dim_profile(L.dim(name), name, labels),
        DIMS
        + f" SELECT count(*) AS total_{name}_members, {count_if(f'{name}_key = 0')} AS unknown_{name}_members, "
        + ", ".join(f"{count_if(c + ' IS NULL')} AS null_{c}_labels" for c in labels)
        + f" FROM dim_{name}",
    )


_dim_profile("product", ["product", "sub_product"])
_dim_profile("company", ["company"])
_dim_profile("state", ["state"])

add(
    "top_products",
    lambda L: star.join_report(L.fact, L.dim("product"), "product_key", ["product", "sub_product"]),
    GOLD
    + " SELECT p.product, p.sub_product, count(*) AS complaint_count FROM fact f LEFT JOIN dim_product p"
    + " ON f.product_key = p.product_key GROUP BY 1, 2 ORDER BY 3 DESC, 1 NULLS FIRST, 2 NULLS FIRST LIMIT 25",
)
add(
    "volume_by_state",
    lambda L: star.join_report(L.fact, L.dim("state"), "state_key", ["state"]),
    GOLD
    + " SELECT s.state, count(*) AS complaint_count FROM fact f LEFT JOIN dim_state s"
    + " ON f.state_key = s.state_key GROUP BY 1 ORDER BY 2 DESC, 1 NULLS FIRST LIMIT 25",
)
add(
    "join_report",
    lambda L: star.join_report(L.fact, L.dim("company"), "company_key", ["company"], None),
    GOLD
    + " SELECT c.company, count(*) AS complaint_count FROM fact f LEFT JOIN dim_company c"
    + " ON f.company_key = c.company_key GROUP BY 1",
)
add(
    "gold_scorecard",
    lambda L: profile.scorecard(profile.gold_metrics(L.fact, K.FACT_KEYS)),
    scorecard_sql(
        GOLD,
        "fact",
        {
            "fact_row_count": "count(*)",
            "distinct_complaint_id_count": "count(DISTINCT complaint_id)",
            "null_complaint_id_count": count_if("complaint_id IS NULL"),
            **{f"null_{k}_count": count_if(f"{k} IS NULL") for k in K.FACT_KEYS},
            **{f"unknown_{_short(k)}_rows": count_if(f"{k} = 0") for k in K.FACT_KEYS},
        },
    ),
)
_SAMPLE = tuple(c for c in _FACT if c != "tags")
add(
    "fact_sample_rows",
    lambda L: star.sample_rows(L.fact, _SAMPLE, "_gold_processed_at"),
    GOLD + f" SELECT {', '.join(_SAMPLE)} FROM fact ORDER BY complaint_id LIMIT 50",
)


def _sample_dims(L):
    na = F.lit(K.NOT_APPLICABLE)
    samples = [
        star.sample_dim(L.dim("product"), "dim_product", "product_key", F.col("product"), F.col("sub_product")),
        star.sample_dim(L.dim("company"), "dim_company", "company_key", F.col("company"), na),
        star.sample_dim(L.dim("state"), "dim_state", "state_key", F.col("state"), na),
        star.sample_dim(
            L.dim("date"), "dim_date", "date_key",
            F.coalesce(F.col("full_date").cast("string"), F.lit(K.MISSING_LABEL)), F.col("calendar_month_name"),
        ),
    ]
    result = samples[0]
    for s in samples[1:]:
        result = result.unionByName(s)
    return result


def _sample_sql(name: str, first: str, second: str) -> str:
    return (
        f"(SELECT 'dim_{name}' AS dimension_name, CAST({name}_key AS VARCHAR) AS key_value, {first} AS attribute_1,"
        f" {second} AS attribute_2 FROM dim_{name} WHERE {name}_key <> 0 ORDER BY {name}_key LIMIT 20)"
    )


add(
    "sample_dims",
    _sample_dims,
    DIMS
    + " "
    + " UNION ALL ".join(
        [
            _sample_sql("product", "product", "sub_product"),
            _sample_sql("company", "company", "'NOT_APPLICABLE'"),
            _sample_sql("state", "state", "'NOT_APPLICABLE'"),
            _sample_sql("date", "coalesce(CAST(full_date AS VARCHAR), 'NOT_PROVIDED')", "calendar_month_name"),
        ]
    ),
)
add(
    "gold_gate",
    lambda L: quality.gold_gate(L.fact, L.silver, L.dims),
    checks_sql(
        GOLD,
        "FROM fact",
        {
            "has_rows": EMPTY,
            "unique_complaint_id": repeated("fact"),
            "null_keys": count_if(" OR ".join(f"{k} IS NULL" for k in K.FACT_KEYS)),
            "grain_difference": "abs(count(*) - (SELECT count(*) FROM silver))",
            **{
                f"empty_dim_{d}": f"(SELECT CASE WHEN count(*) = 0 THEN 1 ELSE 0 END FROM dim_{d})"
                for d in ("date", "product", "company", "state")
            },
        },
    ),
)
