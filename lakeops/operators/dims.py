"""Dimension tables with dense ordered surrogate keys and an unknown member."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops.constants import DATE_COLUMNS, MISSING_LABEL, UNKNOWN_KEY
from lakeops.functions.dates import calendar_attributes, date_key
from lakeops.operators.scan import ordered_key


def unknown_member(members: DataFrame, key: str, labels: Iterable[str]) -> DataFrame:
    """One row in the schema of ``members``: key 0, text labels ``NOT_PROVIDED``, rest null."""
    labels = set(labels)
    columns = []
    for field in members.schema.fields:
        if field.name == key:
            value = F.lit(UNKNOWN_KEY)
        elif field.name in labels:
            value = F.lit(MISSING_LABEL)
        else:
            value = F.lit(None)
        columns.append(value.cast(field.dataType).alias(field.name))
    return members.sparkSession.range(1).select(*columns)


def with_unknown_member(members: DataFrame, key: str, labels: Iterable[str]) -> DataFrame:
    return unknown_member(members, key, labels).unionByName(members)


def distinct_members(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Distinct combinations, keeping real nulls as members of their own."""
    return df.select(*columns).distinct()


def build_dim(df: DataFrame, columns: Iterable[str], key: str) -> DataFrame:
    """Members numbered 1..N in label order, plus the unknown member 0.

    Nulls sort as the missing label and before a literal one, so every member has one place.
    Labels keep their nulls: the null-safe lookup has to find them.
    """
    columns = list(columns)
    order = [F.coalesce(F.col(c), F.lit(MISSING_LABEL)).asc() for c in columns]
    order += [F.col(c).asc_nulls_first() for c in columns]
    members = ordered_key(distinct_members(df, columns), order, key).select(key, *columns)
    return with_unknown_member(members, key, columns)


def build_date_dim(df: DataFrame, columns: Iterable[str] = DATE_COLUMNS) -> DataFrame:
    """Every calendar date found in the columns, plus the unknown date 0; one scan for all columns."""
    days = F.array(*[F.to_date(F.col(c)) for c in columns])
    dates = df.select(F.explode(days).alias("full_date")).filter("full_date IS NOT NULL").distinct()
    day = F.col("full_date")
    members = dates.select(
        date_key(day).cast(T.IntegerType()).alias("date_key"),
        "full_date",
        *[c.alias(n) for n, c in calendar_attributes(day).items()],
    )
    return with_unknown_member(members, "date_key", ["calendar_month_name", "day_name"])
