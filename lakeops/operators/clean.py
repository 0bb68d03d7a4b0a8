"""Cleaning and typing of raw text rows."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops.constants import (
    DATE_COLUMNS,
    FLAG_COLUMNS,
    ID,
    RECORD_STATUS,
    SILVER_DATE_PATTERNS,
)
from lakeops.functions.dates import parse_timestamp
from lakeops.functions.text import blank_to_null, is_numeric_id, numeric_key, standard_flag


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def clean_strings(df: DataFrame) -> DataFrame:
    """Trim every string column and turn blanks into nulls, in one projection."""
    return df.withColumns({c: blank_to_null(F.col(c)) for c in string_columns(df)})


def parse_timestamps(
    df: DataFrame,
    columns: Iterable[str] = DATE_COLUMNS,
    patterns: Iterable[str] = SILVER_DATE_PATTERNS,
    default: bool = True,
    lenient: bool = False,
) -> DataFrame:
    """Replace text columns by timestamps; text that parses under no pattern becomes null."""
    patterns = tuple(patterns)
    return df.withColumns(
        {c: parse_timestamp(F.col(c), patterns, default, lenient) for c in columns if c in df.columns}
    )


def cast_numeric_key(df: DataFrame, column: str = ID) -> DataFrame:
    return df.withColumn(column, numeric_key(F.col(column)))


def uppercase(df: DataFrame, column: str) -> DataFrame:
    """Upper-case a column when the table has it."""
    return df.withColumn(column, F.upper(column)) if column in df.columns else df


def standardise_flag(df: DataFrame, column: str) -> DataFrame:
    """Normalise a yes/no column when the table has it."""
    return df.withColumn(column, standard_flag(F.col(column))) if column in df.columns else df


def drop_invalid_keys(df: DataFrame, column: str = ID) -> DataFrame:
    return df.filter(F.col(column).isNotNull())


def filter_valid_ids(df: DataFrame, column: str = ID) -> DataFrame:
    """Raw rows whose id is digits-only once trimmed."""
    return df.filter(is_numeric_id(F.col(column)))


def audit_columns(df: DataFrame, processed_at: str, status: str | None = None) -> DataFrame:
    """Stamp the processing time and, when named, a constant record status."""
    stamped = df.withColumn(processed_at, F.current_timestamp())
    return stamped.withColumn(status, F.lit(RECORD_STATUS)) if status else stamped


def count_parseable(df: DataFrame, columns: Iterable[str] = DATE_COLUMNS) -> DataFrame:
    """Per column, the rows whose non-null text parses; one pass for all columns."""
    return df.agg(
        *[
            F.count_if(F.col(c).isNotNull() & parse_timestamp(F.col(c)).isNotNull()).alias(
                f"parseable_{c}_count"
            )
            for c in columns
        ]
    )


def silver_rows(raw: DataFrame) -> DataFrame:
    """Clean, type and filter raw rows; duplicates of an id are still there."""
    df = clean_strings(raw)
    df = parse_timestamps(df)
    df = cast_numeric_key(df)
    df = uppercase(df, "state")
    for flag in FLAG_COLUMNS:
        df = standardise_flag(df, flag)
    df = drop_invalid_keys(df)
    return audit_columns(df, "_silver_processed_at", "_silver_record_status")
