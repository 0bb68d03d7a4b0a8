"""Deduplication, dense keys, prefix scans and lookups under different partitionings and skew."""

import pytest
from pyspark.sql import functions as F

from conftest import plan_of
from lakeops.operators.dedupe import dedupe_latest
from lakeops.operators.dims import build_date_dim, build_dim
from lakeops.operators.scan import ordered_key, prefix_scan
from lakeops.operators.star import lookup_key_nullsafe, orphan_counts


@pytest.mark.parametrize("parts", [1, 4, 13])
def test_dedupe_has_one_winner_for_ties(spark, parts):
    rows = [(i % 50, (i * 7) % 3, f"v{(i * 31) % 97:02d}") for i in range(1000)]
    best = {}
    for k, t, v in rows:
        best[k] = max(best.get(k, (-1, "")), (t, v))
    df = spark.createDataFrame(rows[::-1], "id int, at int, v string").repartition(parts)
    got = {r.id: (r.at, r.v) for r in dedupe_latest(df, ["id"], ["at"]).collect()}
    assert got == best


def test_dedupe_combines_a_hot_key_before_the_shuffle(spark):
    df = spark.range(3000).select((F.col("id") % 3).alias("id"), F.col("id").alias("at"))
    plan = plan_of(dedupe_latest(df, ["id"], ["at"]))
    assert plan.index("max(struct") < plan.index("Exchange hashpartitioning") < plan.index("partial_max")


def test_dedupe_orders_nulls_last_and_carries_maps(spark):
    df = spark.sql(
        "SELECT * FROM VALUES (1, null, map('a', 1)), (1, 3, map('b', 2)), (1, 2, map('c', 3)), (2, null, null) AS t(id, at, m)"
    )
    assert {(r.id, r.at, str(r.m)) for r in dedupe_latest(df, ["id"], ["at"]).collect()} == {
        (1, 3, "{'b': 2}"), (2, None, "None"),
    }


@pytest.mark.parametrize("parts", [1, 4, 50])
def test_ordered_key_equals_the_global_rank(spark, parts):
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(5000).select(
            F.when(F.col("id") % 11 == 0, None).otherwise(F.md5(F.col("id").cast("string"))).alias("s"), "id"
        )
        keyed = ordered_key(df, [F.col("s").asc_nulls_first(), F.col("id").asc()], "k")
        rows = keyed.orderBy("k").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert [r.k for r in rows] == list(range(1, 5001))
    assert [(r.s or "", r.id) for r in rows] == sorted((r.s or "", r.id) for r in rows)


def test_prefix_scan_groups_and_totals(spark):
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        # one group holds most rows, another has a null name
        df = spark.range(4000).select(
            F.when(F.col("id") < 3000, "a").when(F.col("id") < 3900, "b").alias("g"),
            F.col("id").alias("o"),
            (F.col("id") % 5).alias("v"),
        )
        got = prefix_scan(df, [F.col("o").desc()], {"run": "v"}, ["g"], {"total": "run"}).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    for g, ids in (("a", range(3000)), ("b", range(3000, 3900)), (None, range(3900, 4000))):
        rows = sorted((r for r in got if r.g == g), key=lambda r: -r.o)
        running, expected = 0, []
        for i in sorted(ids, reverse=True):
            running += i % 5
            expected.append((i, running, sum(j % 5 for j in ids)))
        assert [(r.o, r.run, r.total) for r in rows] == expected


def test_ranking_never_gathers_the_rows_in_one_task(spark):
    df = spark.range(1000).select(F.col("id").alias("a"))
    assert "SinglePartition" not in plan_of(ordered_key(df, [F.col("a").asc()], "k"))


def test_dim_puts_null_before_its_literal_label(spark):
    df = spark.createDataFrame([("b",), (None,), ("NOT_PROVIDED",), ("b",), ("Z",)], "company string")
    got = {(r.company_key, r.company) for r in build_dim(df, ["company"], "company_key").collect()}
    assert got == {(0, "NOT_PROVIDED"), (1, None), (2, "NOT_PROVIDED"), (3, "Z"), (4, "b")}


def test_lookup_is_null_safe_and_skips_the_unknown_member(spark):
    df = spark.createDataFrame([(1, None), (2, "NOT_PROVIDED"), (3, "b"), (4, "new")], "id int, company string")
    dim = build_dim(df.filter("id < 4"), ["company"], "company_key")
    got = {r.id: r.company_key for r in lookup_key_nullsafe(df, dim, ["company"], "company_key").collect()}
    assert got == {1: 1, 2: 2, 3: 3, 4: 0}


def test_lookup_splits_a_hot_key_when_the_dimension_is_too_big_to_broadcast(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
        "spark.sql.shuffle.partitions": "8",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        df = spark.range(0, 60000, 1, 6).select(
            "id", F.when(F.col("id") % 3 > 0, F.lit(None)).otherwise(F.concat(F.lit("c"), F.col("id") % 2000)).alias("company")
        )
        members = df.select("company").distinct()
        dim = members.select(F.abs(F.hash("company")).alias("company_key"), "company").filter("company_key <> 0")
        looked = lookup_key_nullsafe(df, dim, ["company"], "company_key")
        assert looked.count() == 60000
        assert looked.filter("company_key = 0").count() == 0
        looked.collect()
        assert "skew=true" in plan_of(looked)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_date_dim_attributes(spark):
    df = spark.sql("SELECT timestamp'2026-08-02 10:00:00' AS a, cast(null AS timestamp) AS b")
    rows = {r.date_key: r for r in build_date_dim(df, ["a", "b"]).collect()}
    assert set(rows) == {0, 20260802}
    sunday = rows[20260802]
    assert (sunday.calendar_quarter, sunday.calendar_month_name, sunday.day_of_week, sunday.day_name, sunday.is_weekend) == (
        3, "August", 1, "Sunday", True,
    )
    assert (rows[0].full_date, rows[0].day_name, rows[0].is_weekend) == (None, "NOT_PROVIDED", None)


def test_orphans_are_counted_per_role(spark):
    fact = spark.createDataFrame([(1, 1), (1, 9), (8, 2), (8, 9)], "a_key int, b_key int")
    dim = spark.createDataFrame([(1,), (2,)], "k int")
    got = orphan_counts(fact, {"a_key": (dim, "k"), "b_key": (dim, "k")}).first()
    assert (got.orphan_a_keys, got.orphan_b_keys) == (2, 2)
