"""Tolerant timestamp parsing and calendar attributes."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from lakeops.constants import SILVER_DATE_PATTERNS


_FIELD_SHAPES = {"yyyy": r"(?:[0-9]{4}|\+[0-9]{5,})", "X": r"(?:Z|z|[+-].+)"}


def _shape(pattern: str) -> str:
    """Regular expression every value that parses under ``pattern`` matches.

    A repeated letter is a field of exactly that many digits, a single one has at least one digit;
    a year of more than four digits needs a plus sign.
    """

    def field(m: re.Match) -> str:
        literal, letters = m.group(1), m.group(2)
        if literal is not None:
            return re.escape(literal)
        if letters is None:
            return re.escape(m.group(0))
        return _FIELD_SHAPES.get(letters, "[0-9]+" if len(letters) == 1 else f"[0-9]{{{len(letters)}}}")

    body = re.sub(r"'([^']*)'|(([A-Za-z])\3*)|.", field, pattern)
    return rf"(?i)\A{body}\z"


def parse_timestamp(
    c: Column,
    patterns: Iterable[str] = SILVER_DATE_PATTERNS,
    default: bool = True,
    lenient: bool = False,
) -> Column:
    """First successful parse of ``c``, or null.

    A failed parse with an explicit pattern raises and catches an exception inside Spark, which
    costs far more than a parse, so a pattern is tried only on values of its shape; that
    condition is necessary for a match and changes no result. The default parse runs only on values that start with a
    full ISO date, its month and day padded or not, because it also takes partial and clock-dependent values (``today``,
    ``12:30``, ``2026``); ``lenient=True`` lets it see everything.
    """
    attempts = []
    if default:
        parsed = F.try_to_timestamp(c)
        attempts.append(parsed if lenient else F.when(c.rlike(r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}([ T]|$)"), parsed))
    for pattern in patterns:
        attempts.append(F.when(c.rlike(_shape(pattern)), F.try_to_timestamp(c, F.lit(pattern))))
    return F.coalesce(*attempts)


def date_key(d: Column) -> Column:
    """``yyyyMMdd`` of a date as an integer."""
    return F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)


def calendar_attributes(d: Column) -> dict[str, Column]:
    """The attributes of a calendar date, weeks starting on Sunday (1)."""
    weekday = F.dayofweek(d)
    return {
        "calendar_year": F.year(d),
        "calendar_quarter": F.quarter(d),
        "calendar_month": F.month(d),
        "calendar_month_name": F.date_format(d, "MMMM"),
        "calendar_day": F.dayofmonth(d),
        "day_of_week": weekday,
        "day_name": F.date_format(d, "EEEE"),
        "is_weekend": weekday.isin(1, 7),
    }
