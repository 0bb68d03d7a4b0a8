"""Fact table, surrogate-key lookups and reports over the star schema.

No join here carries a broadcast hint. Dimensions are read from written tables, so the optimizer
knows their size and broadcasts those below ``spark.sql.autoBroadcastJoinThreshold``; a larger
one is joined by shuffle, where adaptive execution splits hot keys of the fact side.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.constants import ID, UNKNOWN_KEY
from lakeops.functions.text import presence_flag


def lookup_key_nullsafe(df: DataFrame, dim: DataFrame, columns: Iterable[str], key: str) -> DataFrame:
    """Add the surrogate key of the member equal to ``columns``, null matching null; miss -> 0.

    The unknown member is left out of the lookup, or a source value equal to its label would
    match two members.
    """
    columns = list(columns)
    members = dim.filter(F.col(key) != UNKNOWN_KEY).select(
        F.col(key).alias("_key"), *[F.col(c).alias(f"_m_{c}") for c in columns]
    )
    match = F.lit(True)
    for c in columns:
        match = match & F.col(c).eqNullSafe(F.col(f"_m_{c}"))
    joined = df.join(members, match, "left")
    return joined.select(*df.columns, F.coalesce(F.col("_key"), F.lit(UNKNOWN_KEY)).alias(key))


def lookup_date_key(df: DataFrame, dim_date: DataFrame, column: str, key: str) -> DataFrame:
    """Add the key of the calendar date of a timestamp under the role name ``key``; miss -> 0."""
    days = dim_date.filter(F.col("date_key") != UNKNOWN_KEY).select(
        F.col("date_key").alias("_key"), F.col("full_date").alias("_day")
    )
    joined = df.join(days, F.to_date(F.col(column)) == F.col("_day"), "left")
    return joined.select(*df.columns, F.coalesce(F.col("_key"), F.lit(UNKNOWN_KEY)).alias(key))


def build_fact(silver: DataFrame, dims: Mapping[str, DataFrame]) -> DataFrame:
    """One row per clean record: keys, degenerate attributes, presence flags and lineage."""
    df = lookup_key_nullsafe(silver, dims["product"], ["product", "sub_product"], "product_key")
    df = lookup_key_nullsafe(df, dims["company"], ["company"], "company_key")
    df = lookup_key_nullsafe(df, dims["state"], ["state"], "state_key")
    df = lookup_date_key(df, dims["date"], "date_received", "received_date_key")
    df = lookup_date_key(df, dims["date"], "date_sent_to_company", "sent_date_key")
    return df.select(
        ID,
        "received_date_key",
        "sent_date_key",
        "product_key",
        "company_key",
        "state_key",
        "issue",
        "sub_issue",
        "zip_code",
        "tags",
        "submitted_via",
        "company_response_to_consumer",
        "timely_response",
        presence_flag(F.col("consumer_complaint_narrative")).alias("has_consumer_narrative"),
        presence_flag(F.col("tags")).alias("has_tags"),
        presence_flag(F.col("date_sent_to_company")).alias("has_company_response_date"),
        "_ingestion_date",
        "_ingested_at",
        "_source_zip_path",
        "_source_csv_name",
        "_silver_processed_at",
        "_silver_record_status",
        F.current_timestamp().alias("_gold_processed_at"),
    )


def received_date_role(dim_date: DataFrame) -> DataFrame:
    """The date dimension under the names of its received-date role."""
    return dim_date.select(
        F.col("date_key").alias("received_date_key"),
        F.col("full_date").alias("received_full_date"),
        F.col("calendar_year").alias("received_year"),
        F.col("calendar_quarter").alias("received_quarter"),
        F.col("calendar_month").alias("received_month"),
        F.col("calendar_month_name").alias("received_month_name"),
        F.col("calendar_day").alias("received_day"),
        F.col("day_of_week").alias("received_day_of_week"),
        F.col("day_name").alias("received_day_name"),
        F.col("is_weekend").alias("received_is_weekend"),
    )


def denormalise(fact: DataFrame, dims: Mapping[str, DataFrame]) -> DataFrame:
    """The fact with the labels of its four dimensions."""
    return (
        fact.join(received_date_role(dims["date"]), "received_date_key", "left")
        .join(dims["product"], "product_key", "left")
        .join(dims["company"], "company_key", "left")
        .join(dims["state"], "state_key", "left")
    )


def orphan_counts(fact: DataFrame, dim_keys: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """Fact rows per foreign key whose dimension row is missing, in one row.

    ``dim_keys`` maps a fact key to (dimension, key column). The fact is scanned once and counted
    per (role, key) before anything is joined, so a hot key is a single row by then.
    """
    roles = F.array(
        *[F.struct(F.lit(k).alias("role"), F.col(k).alias("key")) for k in dim_keys]
    )
    used = fact.select(F.inline(roles)).groupBy("role", "key").agg(F.count("*").alias("n"))
    known = None
    for fact_key, (dim, dim_key) in dim_keys.items():
        part = dim.select(F.lit(fact_key).alias("role"), F.col(dim_key).alias("key"))
        known = part if known is None else known.unionByName(part)
    missing = used.join(known, ["role", "key"], "left_anti")

    def count_of(role: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("role") == role, F.col("n"))), F.lit(0))

    return missing.agg(*[count_of(k).alias(f"orphan_{k}s") for k in dim_keys])


def join_report(
    fact: DataFrame, dim: DataFrame, key: str, labels: Iterable[str], n: int | None = 25
) -> DataFrame:
    """Fact rows per dimension label, most first.

    Counted per key before the join: what is joined has one row per member, not per fact row.
    """
    labels = list(labels)
    per_key = fact.groupBy(key).agg(F.count("*").alias("_n"))
    ranked = (
        per_key.join(dim.select(key, *labels), key, "left")
        .groupBy(*labels)
        .agg(F.sum("_n").alias("complaint_count"))
        .orderBy(F.desc("complaint_count"), *[F.asc_nulls_first(c) for c in labels])
    )
    return ranked if n is None else ranked.limit(n)


def sample_rows(df: DataFrame, columns: Iterable[str], newest: str, id_column: str = ID, n: int = 50) -> DataFrame:
    """The ``n`` newest rows, ties by id."""
    return df.orderBy(F.desc(newest), F.asc(id_column)).limit(n).select(*columns)


def sample_dim(
    dim: DataFrame, name: str, key: str, first: Column, second: Column, n: int = 20
) -> DataFrame:
    """The first ``n`` real members of a dimension in a shape all dimensions share."""
    return (
        dim.filter(F.col(key) != UNKNOWN_KEY)
        .orderBy(key)
        .limit(n)
        .select(
            F.lit(name).alias("dimension_name"),
            F.col(key).cast("string").alias("key_value"),
            first.alias("attribute_1"),
            second.alias("attribute_2"),
        )
    )
