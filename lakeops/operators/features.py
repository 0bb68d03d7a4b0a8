"""Labelled feature table with deterministic splits."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeops.constants import ID, LABEL, MISSING_LABEL, NO, SAMPLE_CAP, SEED, SPLIT, TRAIN, YES
from lakeops.functions.hashing import hash_bucket, hash_split, md5_text
from lakeops.functions.text import fill, prefix
from lakeops.operators.scan import ordered_rank

_FILLED_TEXT = (
    "product",
    "sub_product",
    "company",
    "state",
    "issue",
    "sub_issue",
    "submitted_via",
    "received_month_name",
    "received_day_name",
)
_CALENDAR_INTS = ("year", "quarter", "month", "day", "day_of_week")


def label_binary(df: DataFrame, flag: str = "timely_response", label: str = LABEL) -> DataFrame:
    """Keep YES/NO rows and label NO as 1."""
    kept = df.filter(F.col(flag).isin(YES, NO))
    return kept.withColumn(label, (F.col(flag) == NO).cast("int"))


def fill_missing(df: DataFrame, values: dict[str, object]) -> DataFrame:
    """Replace nulls by a constant per column, in one projection."""
    return df.withColumns({c: fill(F.col(c), v) for c, v in values.items()})


def bool_to_int(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("int") for c in columns})


def feature_table(base: DataFrame, split_method: str = "xxhash64") -> DataFrame:
    """One labelled row per id from the denormalised fact, in a single projection."""
    bucket, split = hash_split(F.col(ID), split_method)
    filled = {c: fill(F.col(c), MISSING_LABEL).alias(c) for c in _FILLED_TEXT}
    return label_binary(base).select(
        ID,
        LABEL,
        "timely_response",
        F.col("received_full_date").alias("complaint_received_date"),
        *[fill(F.col(f"received_{p}"), 0).alias(f"complaint_received_{p}") for p in _CALENDAR_INTS],
        filled["received_month_name"],
        filled["received_day_name"],
        fill(F.col("received_is_weekend").cast("int"), 0).alias("received_is_weekend"),
        *[filled[c] for c in _FILLED_TEXT if not c.startswith("received_")],
        prefix(F.col("zip_code")).alias("zip_code_prefix3"),
        F.col("has_consumer_narrative").cast("int").alias("has_consumer_narrative"),
        F.col("has_tags").cast("int").alias("has_tags"),
        split.alias(SPLIT),
        bucket.alias("split_bucket"),
        "_ingestion_date",
        "_ingested_at",
        "_source_zip_path",
        "_source_csv_name",
        "_silver_processed_at",
        "_gold_processed_at",
        F.current_timestamp().alias("_feature_processed_at"),
    )


def cap_sample(df: DataFrame, n: int = SAMPLE_CAP, split: str = SPLIT, seed: int = SEED) -> DataFrame:
    """Bernoulli sample of about ``n`` training rows if there are more; the other splits, which measure, stay whole.

    Sampling is the operator's purpose here; nothing in the training job calls it by default.
    """
    size = df.filter(F.col(split) == TRAIN).count()
    others = df.filter(~F.col(split).eqNullSafe(F.lit(TRAIN)))
    return df.filter(F.col(split) == TRAIN).sample(min(1.0, n / max(size, 1)), seed).unionByName(others)


def stratified_halves(
    df: DataFrame, label: str = LABEL, id_column: str = ID, exact: bool = False, method: str = "md5"
) -> DataFrame:
    """Add ``half`` 1 or 2, balanced within every label.

    The default is a hash bit of the id: no shuffle and about even halves. ``exact=True`` ranks the rows of a
    label by their hash and halves the ranking, so sizes differ by at most one; the ranking goes over range
    partitions, because a label may hold nearly all rows.
    """
    if not exact:
        return df.withColumn("half", (hash_bucket(F.col(id_column), 2, "half:", method) + 1).cast("int"))
    hashed = df.withColumn("_hash", md5_text(F.col(id_column), "half:"))
    ranked = ordered_rank(hashed, [F.col("_hash").asc(), F.col(id_column).asc()], "_rank", [label], size="_size")
    first = F.col("_rank") <= F.ceil(F.col("_size") / 2)
    return ranked.select(*df.columns, F.when(first, 1).otherwise(2).alias("half"))
