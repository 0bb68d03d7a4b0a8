"""Ranks along a global order with one exchange of the rows."""

import random

import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from lakeops.operators.features import stratified_halves
from lakeops.operators.scan import ordered_key, ordered_parts, ordered_rank


@pytest.fixture
def rows(spark):
    r = random.Random(4)
    keys = r.sample(range(10_000), 3000)
    # one group holds two thirds of the rows
    return spark.createDataFrame([(None if k % 7 == 0 else ("big" if k % 3 else "small"), k) for k in keys], "g string, k int").repartition(7)


def test_ranks_within_groups(spark, rows):
    held = {}
    for g, k in rows.collect():
        held.setdefault(g, []).append(k)
    place = {g: {k: i for i, k in enumerate(sorted(ks), 1)} for g, ks in held.items()}
    ranked = ordered_rank(rows, [F.col("k")], "r", ["g"], size="n").collect()
    assert len(ranked) == 3000
    assert all(x["r"] == place[x["g"]][x["k"]] and x["n"] == len(held[x["g"]]) for x in ranked)


def test_keys_follow_the_order(rows):
    keyed = ordered_key(rows, [F.col("k").desc()], "key").orderBy("key").collect()
    assert [x["key"] for x in keyed] == list(range(1, 3001))
    assert [x["k"] for x in keyed] == sorted((x["k"] for x in keyed), reverse=True)


def test_one_exchange_and_no_window_over_rows(spark, rows):
    plan = plan_of(ordered_parts(spark.range(1000).select("id"), [F.col("id")])).split("== Initial Plan ==")[0]
    assert plan.count("Exchange rangepartitioning") == 1 and plan.count("Exchange") == 1 and "Window" not in plan
    after = plan_of(ordered_rank(rows, [F.col("k")], "r"))
    assert "Exchange hashpartitioning" not in after.split("== Initial Plan ==")[0] and "Window" not in after


def test_halves_differ_by_at_most_one(spark):
    df = spark.createDataFrame([(i, int(i % 11 == 0)) for i in range(1501)], "complaint_id long, label_untimely_response int")
    counts = stratified_halves(df, exact=True).groupBy("label_untimely_response").pivot("half", [1, 2]).count().collect()
    assert all(r["1"] - r["2"] in (0, 1) for r in counts)


def test_empty(spark):
    assert ordered_rank(spark.createDataFrame([], "k int"), [F.col("k")], "r").collect() == []
