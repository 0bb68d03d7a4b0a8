"""Gates raise on what they should, and profiles stay single-pass."""

import pytest
from pyspark.sql import functions as F

from conftest import scans
from lakeops.operators import profile, quality


@pytest.fixture(scope="module")
def table(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("t") / "rows")
    spark.range(1000).select(
        F.when(F.col("id") % 10 == 0, None).otherwise(F.col("id") % 300).alias("complaint_id"),
        F.when(F.col("id") % 4 == 0, "  ").otherwise("x").alias("company"),
        F.col("id").cast("string").alias("state"),
    ).write.parquet(path)
    return spark.read.parquet(path)


def test_expect_counts_every_rule_in_one_scan(spark, table):
    checks = quality.expect(
        table, {"null_id": F.col("complaint_id").isNull(), "blank": F.trim("company") == ""}, unique="complaint_id"
    )
    got = {r.check_name: (r.violations, r.passed) for r in checks.collect()}
    ids = [i % 300 for i in range(1000) if i % 10]
    groups = sum(1 for k in set(ids) if ids.count(k) > 1) + 1
    assert got == {"has_rows": (0, True), "unique_complaint_id": (groups, False), "null_id": (100, False), "blank": (250, False)}
    assert scans(checks) == 1
    with pytest.raises(quality.ExpectationError, match="null_id=100"):
        quality.enforce(checks)


def test_empty_table_fails_has_rows(spark, table):
    checks = quality.expect(table.limit(0), {"null_id": F.col("complaint_id").isNull()}, unique="complaint_id")
    assert {r.check_name: r.violations for r in checks.collect()} == {"has_rows": 1, "unique_complaint_id": 0, "null_id": 0}


def test_require_table(spark):
    with pytest.raises(quality.ExpectationError, match="does not exist"):
        quality.require_table(spark, "no_such_table")
    spark.range(0).createOrReplaceTempView("empty_rows")
    with pytest.raises(quality.ExpectationError, match="is empty"):
        quality.require_table(spark, "empty_rows")


def silver(spark, rows):
    return spark.createDataFrame(rows, "complaint_id long, date_received timestamp")


def raw(spark, rows):
    return spark.createDataFrame(rows, "complaint_id string, date_received string")


def failed(checks):
    return {r.check_name for r in checks.filter("NOT passed").collect()}


def test_silver_gate_accepts_several_snapshots_of_one_id(spark):
    source = raw(spark, [(" 1", "2026-01-01"), ("1", "1/1/2026"), ("2", "bad"), ("x", "2026-01-01")])
    clean = spark.sql("SELECT * FROM VALUES (1L, timestamp'2026-01-01'), (2L, null) AS t(complaint_id, date_received)")
    assert failed(quality.silver_gate(clean, source)) == set()


def test_silver_gate_notices_lost_dates_and_extra_rows(spark):
    source = raw(spark, [("1", "2026-01-01"), ("2", "2026-01-02")])
    clean = silver(spark, [(1, None), (2, None), (2, None), (None, None)])
    assert failed(quality.silver_gate(clean, source)) == {
        "unique_complaint_id", "null_complaint_id", "rows_above_source", "lost_dates",
    }


def test_feature_gate_needs_all_splits_and_binary_labels(spark):
    rows = spark.createDataFrame(
        [(1, 0, "TRAIN"), (2, 2, "TEST"), (2, 1, "TEST")],
        "complaint_id long, label_untimely_response int, dataset_split string",
    )
    fact = spark.range(5)
    assert failed(quality.feature_gate(rows, fact)) == {"unique_complaint_id", "invalid_label", "split_VALIDATION_present"}
    assert failed(quality.train_input_gate(rows)) == {"split_VALIDATION_present"}
    assert failed(quality.both_classes_gate(rows.filter("dataset_split = 'TRAIN'"))) == {"label_1_present"}


def test_monitoring_gate(spark):
    metrics = spark.createDataFrame([("a",), ("a",), ("b",)], "model_name string")
    assert failed(quality.monitoring_gate(metrics, spark.range(0), ["a", "b", "c"])) == {
        "metric_rows", "model_c_present", "predictions_present",
    }


def test_column_profiles_scan_once(spark, table):
    for report in (
        profile.null_blank_profile(table.select(F.col("state").alias("a"), F.col("company").alias("b")), ["a", "b"]),
        profile.distinct_profile(table, ["company", "state"]),
        profile.case_fragmentation(table, {"company": "lower", "state": "upper"}),
        profile.correlation_matrix(table.select(F.col("complaint_id").alias("x"), F.col("state").cast("int").alias("y")), ["x", "y"]),
    ):
        report.collect()
        assert scans(report) == 1, report.columns


def test_distinct_profile_modes_agree_on_few_values(spark, table):
    exact = profile.distinct_profile(table, ["company"]).collect()
    assert exact == profile.distinct_profile(table, ["company"], approximate=True).collect()


def test_correlation_of_a_constant_is_null(spark):
    df = spark.range(100).select(F.col("id").alias("x"), (-2 * F.col("id")).alias("y"), F.lit(1).alias("c"))
    got = {r.feature_name: r for r in profile.correlation_matrix(df, ["x", "y", "c"]).collect()}
    assert got["x"].y == pytest.approx(-1.0) and got["y"].x == pytest.approx(-1.0) and got["x"].x == pytest.approx(1.0)
    assert got["c"].x is None and got["c"].c is None and got["x"].c is None
