"""Target encoding, splits and weights."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import plan_of
from lakeops import constants as K
from lakeops.functions.hashing import hash_bucket, hash_split
from lakeops.operators import encode, features


def train_rows(spark, rows):
    return spark.createDataFrame(rows, "complaint_id long, company string, label_untimely_response int")


def test_smoothing_pulls_categories_to_the_global_rate(spark):
    df = train_rows(spark, [(i, "A" if i < 3 else "B", int(i < 3)) for i in range(6)])
    rates = {r.category: r.rate for r in encode.target_encode_fit(df, ["company"]).collect()}
    assert rates["A"] == pytest.approx((3 * 1 + 20 * 0.5) / 23)
    assert rates["B"] == pytest.approx((0 + 20 * 0.5) / 23)


def test_unseen_and_null_categories_get_exactly_the_fallback(spark):
    df = train_rows(spark, [(1, "A", 1), (2, "A", 1)])
    table = encode.target_encode_fit(df, ["company"])
    asked = spark.createDataFrame([("NEVER SEEN",), (None,)], "company string")
    got = encode.target_encode_apply(asked, table, F.lit(0.42), ["company"]).collect()
    assert [r.company_indexed for r in got] == [0.42, 0.42]


def brute_out_of_fold(rows, folds):
    g = sum(y for _, _, y in rows) / len(rows)
    out = {}
    for i, c, _ in rows:
        others = [y for j, d, y in rows if d == c and folds[j] != folds[i]]
        out[i] = (sum(others) + 20 * g) / (len(others) + 20)
    return out


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from("abc"), st.integers(0, 1)), min_size=2, max_size=40))
def test_out_of_fold_equals_brute_force_and_ignores_the_rows_own_label(spark, items):
    rows = [(i, c, y) for i, (c, y) in enumerate(items)]
    df = train_rows(spark, rows)
    folds = {r[0]: r[1] for r in df.select("complaint_id", encode.fold_of(method="md5")).collect()}
    got = {r.complaint_id: r.company_indexed for r in encode.target_encode_oof(df, ["company"], method="md5").collect()}
    assert got == pytest.approx(brute_out_of_fold(rows, folds), abs=1e-12)


def test_a_category_of_one_row_gets_the_global_rate(spark):
    rows = [(i, f"only-{i}", i % 2) for i in range(60)]
    got = encode.target_encode_oof(train_rows(spark, rows), ["company"]).collect()
    assert all(r.company_indexed == pytest.approx(0.5) for r in got)


def test_hot_category_is_counted_before_the_shuffle(spark):
    df = train_rows(spark, [(i, "hot" if i % 3 else f"c{i}", i % 2) for i in range(300)])
    plan = plan_of(encode.encoding_counts(df, ["company"]))
    assert plan.index("partial_count") > plan.index("Exchange hashpartitioning(feature")


def test_encode_splits_uses_other_folds_for_train_and_all_of_train_elsewhere(spark):
    columns = K.CATEGORICAL_COLUMNS
    df = spark.range(200).select(
        F.col("id").alias("complaint_id"),
        *[F.concat(F.lit("v"), F.col("id") % (i + 2)).alias(c) for i, c in enumerate(columns)],
        (F.col("id") % 7 == 0).cast("int").alias(K.LABEL),
        F.when(F.col("id") < 150, K.TRAIN).when(F.col("id") < 175, K.VALIDATION).otherwise(K.TEST).alias(K.SPLIT),
    )
    rows, table, rate = encode.encode_splits(df, method="md5")
    got = {r.complaint_id: r for r in rows.collect()}
    g = rate.first()[0]
    assert g == pytest.approx(len([i for i in range(150) if i % 7 == 0]) / 150)
    folds = {r[0]: r[1] for r in df.select("complaint_id", encode.fold_of(method="md5")).collect()}
    train = [(i, f"v{i % 2}", int(i % 7 == 0)) for i in range(150)]
    expected = brute_out_of_fold(train, folds)
    for i in range(150):
        assert got[i].product_indexed == pytest.approx(expected[i])
    for i in range(150, 200):
        same = [y for _, c, y in train if c == f"v{i % 2}"]
        assert got[i].product_indexed == pytest.approx((sum(same) + 20 * g) / (len(same) + 20))
    assert {r.feature for r in table.select("feature").distinct().collect()} == set(columns)


def test_class_weight_balances_train_and_applies_everywhere(spark):
    rows = [(i, int(i % 5 == 0), K.TRAIN if i < 50 else K.TEST) for i in range(60)]
    df = spark.createDataFrame(rows, "complaint_id long, label_untimely_response int, dataset_split string")
    got = {(r.label_untimely_response, r.class_weight) for r in encode.class_weight(df).collect()}
    assert got == {(0, 1.0), (1, 4.0)}


@pytest.mark.parametrize("method", ["xxhash64", "md5"])
def test_splits_are_stable_and_near_their_shares(spark, method):
    df = spark.range(20000)
    bucket, split = hash_split(F.col("id"), method)
    rows = df.select("id", bucket.alias("b"), split.alias("s"))
    again = df.repartition(7).select("id", bucket.alias("b"), split.alias("s"))
    assert rows.exceptAll(again).isEmpty()
    counts = {r.s: r["count"] for r in rows.groupBy("s").count().collect()}
    assert counts[K.TRAIN] == pytest.approx(14000, abs=300)
    assert counts[K.VALIDATION] == pytest.approx(3000, abs=300)
    assert rows.agg(F.min("b"), F.max("b")).first()[:] == (0, 99)


def test_folds_do_not_follow_the_split(spark):
    df = spark.range(20000).select(hash_bucket(F.col("id"), 100).alias("b"), encode.fold_of("id").alias("f"))
    shares = df.filter("b < 70").groupBy("f").count().collect()
    assert all(r["count"] == pytest.approx(2800, abs=250) for r in shares) and len(shares) == 5


@pytest.mark.parametrize("exact", [True, False])
def test_halves_are_balanced_within_labels(spark, exact):
    df = spark.range(4001).select(F.col("id").alias("complaint_id"), (F.col("id") % 20 == 0).cast("int").alias(K.LABEL))
    counts = {
        (r[K.LABEL], r.half): r["count"]
        for r in features.stratified_halves(df, exact=exact).groupBy(K.LABEL, "half").count().collect()
    }
    if exact:
        assert counts == {(0, 1): 1900, (0, 2): 1900, (1, 1): 101, (1, 2): 100}
    else:
        assert counts[0, 1] == pytest.approx(1900, abs=150) and counts[1, 1] == pytest.approx(100, abs=40)


def test_cap_sample_keeps_small_splits_whole(spark):
    df = spark.range(10000).select("id", F.when(F.col("id") < 9000, K.TRAIN).otherwise(K.TEST).alias(K.SPLIT))
    got = {r[K.SPLIT]: r["count"] for r in features.cap_sample(df, 2000).groupBy(K.SPLIT).count().collect()}
    assert got[K.TEST] == 1000 and got[K.TRAIN] == pytest.approx(2000, abs=250)
