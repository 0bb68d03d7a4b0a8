"""Cleaning, typing and parsing on hand-written edge values."""

import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lakeops import constants as K
from lakeops.functions import dates, text
from lakeops.operators import clean


def values(spark, items, expr):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(items)], "i int, v string")
    return [r[0] for r in df.orderBy("i").select(expr(F.col("v"))).collect()]


def test_blank_to_null_trims_spaces_only(spark):
    got = values(spark, ["  a ", "", "   ", None, "\t", "a\t "], text.blank_to_null)
    assert got == ["a", None, None, None, "\t", "a\t"]


def test_numeric_key_takes_whole_digit_texts_that_fit(spark):
    items = ["7", "007", "12345678901234567890", "7\n", "-7", "7.0", "٣", None]
    assert values(spark, items, text.numeric_key) == [7, 7, None, None, None, None, None, None]


def test_flag_spellings(spark):
    items = ["Yes", " y ", "TRUE", "1", "no", "N", "False", "0", "maybe", None]
    assert values(spark, items, text.standard_flag) == [
        "YES", "YES", "YES", "YES", "NO", "NO", "NO", "NO", "MAYBE", None,
    ]


def day(y, m, d, *rest):
    return dt.datetime(y, m, d, *rest)


PARSED = {
    "07/30/2026": day(2026, 7, 30),
    "7/3/2026": day(2026, 7, 3),
    "07/30/26": day(2026, 7, 30),
    "7/3/26": day(2026, 7, 3),
    "2026-07-30": day(2026, 7, 30),
    "2026-07-30 01:02:03": day(2026, 7, 30, 1, 2, 3),
    "2026-07-30T01:02:03Z": day(2026, 7, 30, 1, 2, 3),
    "13/01/2026": None,
    "2026": None,
    "2026-7": None,
    "12:30": None,
    "today": None,
    "": None,
    None: None,
}


def test_silver_patterns(spark):
    assert values(spark, list(PARSED), dates.parse_timestamp) == list(PARSED.values())


def test_lenient_default_parse_takes_partial_dates(spark):
    got = values(spark, ["2026", "2026-7"], lambda c: dates.parse_timestamp(c, lenient=True))
    assert got == [day(2026, 1, 1), day(2026, 7, 1)]


def test_quality_patterns_need_the_zone(spark):
    got = values(
        spark,
        ["2026-07-30T01:02:03.004Z", "2026-07-30T01:02:03+02", "2026-07-30T01:02:03", "07/30/2026", "07/30/26"],
        lambda c: dates.parse_timestamp(c, K.QUALITY_DATE_PATTERNS, default=False),
    )
    assert got == [day(2026, 7, 30, 1, 2, 3, 4000), day(2026, 7, 29, 23, 2, 3), None, day(2026, 7, 30), None]


def unguarded(patterns):
    return lambda c: F.coalesce(*[F.try_to_timestamp(c, F.lit(p)) for p in patterns]).cast("string")


def guarded(patterns):
    return lambda c: dates.parse_timestamp(c, patterns, default=False).cast("string")


ODD = [
    "1-2-2026", "1/2", "2026/01/02", "2026-01-02T03:04:05.006Z", "2026-01-02t03:04:05z", "2026-01-02T03:04:05+0230",
    "2026-01-02T03:04:05.006+02:30", "a/b/c", "07/30/2026 ", " 07/30/2026", "007/030/2026", "7/3/02026", "7/3/+12026",
    "+12026-01-02", "02026-01-02", "-7/3/2026", "7/-3/2026", "7/3/126", "2/29/2025", "2/29/2024", "00/10/2026",
    "12/31/9999", "1/1/0000", "0000-01-01", "2026-01-02 24:00:00", "2026-01-02 3:04:05", "２/3/2026", "7/3/2026\n",
]


@pytest.mark.parametrize("patterns", [K.SILVER_DATE_PATTERNS, K.PROFILE_DATE_PATTERNS, K.QUALITY_DATE_PATTERNS])
def test_shape_guards_change_no_result(spark, patterns):
    items = [v for v in PARSED if v] + ODD
    assert values(spark, items, guarded(patterns)) == values(spark, items, unguarded(patterns))


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.from_regex(r"\A[-+]?[0-9]{1,5}[/-][0-9]{1,3}[/-][0-9]{1,5}([ T][0-9]{1,2}:[0-9]{2}:[0-9]{2})?(Z|\.[0-9]{3}Z)?\Z"),
                min_size=60, max_size=60))
def test_shape_guards_change_no_result_on_date_like_text(spark, items):
    for patterns in (K.SILVER_DATE_PATTERNS, K.QUALITY_DATE_PATTERNS):
        assert values(spark, items, guarded(patterns)) == values(spark, items, unguarded(patterns))


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(st.none(), st.text(alphabet=" \tyYnNoes01true", max_size=6)), min_size=1, max_size=12))
def test_cleaning_twice_is_cleaning_once(spark, items):
    def once(c):
        return text.standard_flag(text.blank_to_null(c))

    assert values(spark, items, once) == values(spark, items, lambda c: once(once(c)))


def test_silver_rows_drop_invalid_ids_and_skip_absent_columns(spark):
    df = spark.createDataFrame(
        [(" 5 ", "7/3/2026", None, "ny ", "y"), ("x5", "7/3/2026", None, "ca", "no"), (None, None, None, None, None)],
        "complaint_id string, date_received string, date_sent_to_company string, state string, timely_response string",
    )
    rows = clean.silver_rows(df).collect()
    assert [(r.complaint_id, r.state, r.timely_response, r._silver_record_status) for r in rows] == [
        (5, "NY", "YES", "VALID")
    ]
    assert "consumer_disputed" not in rows[0].asDict()
