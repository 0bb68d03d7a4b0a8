"""Text cleaning, flags and keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lakeops.constants import FALSE_SPELLINGS, MISSING_LABEL, NO, TRUE_SPELLINGS, YES


def blank_to_null(c: Column) -> Column:
    """Trim spaces; a value with nothing left becomes null. Only U+0020 is trimmed."""
    return F.nullif(F.trim(c), F.lit(""))


def is_missing(c: Column) -> Column:
    """Null, empty or spaces only."""
    return F.trim(F.coalesce(c, F.lit(""))) == ""


def is_blank(c: Column) -> Column:
    """Present, but empty or spaces only."""
    return c.isNotNull() & (F.trim(c) == "")


def numeric_key(c: Column) -> Column:
    """Digits-only text as ``bigint``, anything else (also a value too long for it) as null."""
    return F.when(c.rlike(r"\A[0-9]+\z"), c.try_cast("bigint"))


def is_numeric_id(c: Column) -> Column:
    """Raw text that is a digits-only id once trimmed."""
    return F.coalesce(F.trim(c).rlike(r"\A[0-9]+\z"), F.lit(False))


def standard_flag(c: Column) -> Column:
    """Yes/no spellings to YES/NO; other text is upper-cased, null stays null."""
    folded = F.lower(F.trim(c))
    return (
        F.when(folded.isin(*TRUE_SPELLINGS), F.lit(YES))
        .when(folded.isin(*FALSE_SPELLINGS), F.lit(NO))
        .otherwise(F.upper(c))
    )


def prefix(c: Column, n: int = 3, missing: str = MISSING_LABEL) -> Column:
    """The first ``n`` characters, or the missing label."""
    return F.coalesce(F.substring(c, 1, n), F.lit(missing))


def presence_flag(c: Column) -> Column:
    return c.isNotNull()


def fill(c: Column, value: object) -> Column:
    return F.coalesce(c, F.lit(value))
