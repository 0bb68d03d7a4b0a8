"""Encoding tables too big to broadcast: a value on two thirds of the rows goes to no task alone."""

import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from lakeops.operators import encode

ROWS = 6000


@pytest.fixture
def rows(spark):
    values = [("hot" if i % 3 else None if i % 31 == 0 else f"v{i * 7919 % 900}") for i in range(ROWS)]
    return spark.createDataFrame([(i, v, int(i % 7 == 0)) for i, v in enumerate(values)], "complaint_id long, company string, label_untimely_response int")


@pytest.fixture
def no_broadcast(spark):
    names = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "16", "spark.sql.adaptive.enabled": "false"}
    before = {n: spark.conf.get(n, None) for n in names}

    def start():
        for n, v in names.items():
            spark.conf.set(n, v)

    yield start
    for n, v in before.items():
        spark.conf.unset(n) if v is None else spark.conf.set(n, v)


def encoded(rows):
    table = encode.target_encode_fit(rows, ["company"])
    table = encode.stage(table.where("category != 'v7'"), "encodings", "feature")  # an unseen one as well
    return encode.target_encode_apply(rows, table, F.lit(0.25), ["company"])


def values(df):
    return sorted((r["complaint_id"], round(r["company_indexed"], 12)) for r in df.collect())


def test_both_ways_give_the_same_rates(rows, no_broadcast):
    plain = encoded(rows)
    assert "SortMergeJoin" not in plan_of(plain)
    want = values(plain)
    no_broadcast()
    parted = encoded(rows)
    assert plan_of(parted).count("SortMergeJoin") == 1 and plan_of(parted).count("BroadcastHashJoin") == 1
    assert values(parted) == want and len(want) == ROWS


def test_the_largest_task_has_no_more_than_its_share(rows, no_broadcast):
    no_broadcast()
    sizes = [r["count"] for r in encoded(rows).groupBy(F.spark_partition_id().alias("p")).count().collect()]
    assert sum(sizes) == ROWS and len(sizes) == 16
    assert max(sizes) < 2 * ROWS / 16


def test_out_of_fold_both_ways(rows, no_broadcast):
    want = values(encode.target_encode_oof(rows, ["company"]))
    no_broadcast()
    parted = encode.target_encode_oof(rows, ["company"])
    assert "SortMergeJoin" in plan_of(parted) and values(parted) == want
    sizes = [r["count"] for r in parted.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    assert max(sizes) < 2 * ROWS / 16


def test_hot_rows_of_a_table_are_bounded(spark, monkeypatch, no_broadcast):
    """However the counts lie, what is broadcast is at most HOT_CATEGORIES rows."""
    monkeypatch.setattr(encode, "HOT_CATEGORIES", 10)
    for counts in ([1] * 100, list(range(1, 101)), [10_000] + [1] * 99):
        total = sum(counts)
        assert sum(n * 10 >= total for n in counts) <= 10
    no_broadcast()
    table = encode.stage(spark.createDataFrame([(f"c{i}", 1 + i, i / 100) for i in range(100)], "category string, n long, rate double"), "many")
    rows = spark.createDataFrame([(f"c{i % 120}",) for i in range(600)], "c string")
    found = encode.rate_join(rows, table, F.col("c"), "r")
    assert {(r["c"], r["r"]) for r in found.collect()} == {(f"c{i}", i / 100 if i < 100 else None) for i in range(120)}
