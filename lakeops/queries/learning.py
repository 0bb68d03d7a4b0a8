"""Queries over the feature table: features, splits, encoding, curves and metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeops import constants as K
from lakeops.functions.hashing import hash_split
from lakeops.operators import curves, encode, features, profile, quality
from lakeops.plans import fixtures
from lakeops.queries.oracle import BASE, CURVE, ENCODED, FEATURES, GOLD, SCORED, count_if, md5_bucket
from lakeops.queries.registry import add
from lakeops.queries.silver import EMPTY, checks_sql, repeated
from lakeops.sources.staging import stage

DIGITS = 9
_FEATURES = (
    "complaint_id", "label_untimely_response", "timely_response", "complaint_received_date",
    "complaint_received_year", "complaint_received_quarter", "complaint_received_month", "complaint_received_day",
    "complaint_received_day_of_week", "received_month_name", "received_day_name", "received_is_weekend", "product",
    "sub_product", "company", "state", "issue", "sub_issue", "submitted_via", "zip_code_prefix3",
    "has_consumer_narrative", "has_tags", "dataset_split", "split_bucket", "_ingestion_date", "_ingested_at",
    "_source_zip_path", "_source_csv_name",
)


def rounded(df, *columns: str, digits: int = DIGITS):
    """Doubles to nine decimals: their last digits depend on the order of summation."""
    return df.withColumns({c: F.round(F.col(c), digits) for c in columns})


def _feats(L):
    return L.features("md5")


def _train(L):
    return _feats(L).filter(F.col(K.SPLIT) == K.TRAIN)


# ---- feature preparation -------------------------------------------------------------------------
add(
    "label_binary",
    lambda L: features.label_binary(L.fact).select("complaint_id", "timely_response", K.LABEL),
    GOLD
    + " SELECT complaint_id, timely_response, CAST(timely_response = 'NO' AS INTEGER) AS label_untimely_response"
    + " FROM fact WHERE timely_response IN ('YES', 'NO')",
)
_FILLS = {"product": K.MISSING_LABEL, "sub_product": K.MISSING_LABEL, "company": K.MISSING_LABEL, "received_year": 0}
add(
    "fill_missing",
    lambda L: features.fill_missing(L.base.select("complaint_id", *_FILLS), _FILLS),
    BASE
    + " SELECT complaint_id, coalesce(product, 'NOT_PROVIDED') AS product, coalesce(sub_product, 'NOT_PROVIDED') AS sub_product,"
    + " coalesce(company, 'NOT_PROVIDED') AS company, coalesce(received_year, 0) AS received_year FROM base",
)
add(
    "bool_to_int",
    lambda L: features.bool_to_int(
        L.fact.select("complaint_id", "has_consumer_narrative", "has_tags"), ["has_consumer_narrative", "has_tags"]
    ),
    GOLD
    + " SELECT complaint_id, CAST(has_consumer_narrative AS INTEGER) AS has_consumer_narrative,"
    + " CAST(has_tags AS INTEGER) AS has_tags FROM fact",
)
add(
    "feature_table",
    lambda L: features.feature_table(L.base, "md5").select(*_FEATURES),
    FEATURES + f" SELECT {', '.join(_FEATURES)} FROM features",
)
add(
    "feature_null_summary",
    lambda L: profile.null_counts(
        _feats(L), ("product", "sub_product", "company", "state", "issue", "submitted_via"), "row_count"
    ),
    FEATURES
    + " SELECT count(*) AS row_count, "
    + ", ".join(
        f"{count_if(c + ' IS NULL')} AS null_{c}_count"
        for c in ("product", "sub_product", "company", "state", "issue", "submitted_via")
    )
    + " FROM features",
)
add(
    "target_profile",
    lambda L: profile.target_profile(L.fact).withColumnRenamed("count", "row_count"),
    GOLD
    + " SELECT timely_response, count(*) AS row_count, round(count(*) / sum(count(*)) OVER () * 100, 4) AS pct_of_rows"
    + " FROM fact GROUP BY 1",
)
add(
    "pct_of_total",
    lambda L: profile.pct_of_total(L.fact.groupBy("submitted_via").agg(F.count("*").alias("row_count")), "row_count"),
    GOLD
    + " SELECT submitted_via, count(*) AS row_count, round(count(*) / sum(count(*)) OVER () * 100, 4) AS pct_of_rows"
    + " FROM fact GROUP BY 1",
)
for _c, _n in (("product", 20), ("state", 20), ("submitted_via", None)):
    add(
        f"feature_frequency_{_c}",
        lambda L, c=_c, n=_n: profile.frequency(L.base, c, n),
        BASE
        + f" SELECT {_c}, count(*) AS row_count FROM base GROUP BY 1 ORDER BY 2 DESC, 1 NULLS FIRST"
        + (f" LIMIT {_n}" if _n else ""),
    )
_LATE = "timely_response = 'NO'"
add(
    "rate_by_group",
    lambda L: profile.rate_by_group(L.base),
    BASE
    + f" SELECT product, count(*) AS row_count, {count_if(_LATE)} AS untimely_count,"
    + " round(count(*) FILTER (WHERE timely_response = 'NO') / count(*) * 100, 4) AS untimely_rate_pct FROM base"
    + " WHERE timely_response IN ('YES', 'NO') GROUP BY 1 ORDER BY 4 DESC, 2 DESC, 1 NULLS FIRST LIMIT 25",
)
for _name, _groups in (
    ("split_balance", (K.SPLIT, K.LABEL)),
    ("split_sizes", (K.SPLIT,)),
    ("label_balance", (K.LABEL,)),
):
    add(
        _name,
        lambda L, g=_groups: profile.group_counts(_feats(L), *g),
        FEATURES + f" SELECT {', '.join(_groups)}, count(*) AS row_count FROM features GROUP BY ALL",
    )

_CORR = (*K.NUMERIC_COLUMNS, K.LABEL)


def _corr_cell(a: str, b: str) -> str:
    return f"round(CASE WHEN isnan(corr({a}, {b})) THEN NULL ELSE corr({a}, {b}) END, {DIGITS}) AS {b}"


add(
    "correlation_matrix",
    lambda L: rounded(profile.correlation_matrix(_feats(L), _CORR), *_CORR),
    FEATURES
    + " "
    + " UNION ALL ".join(
        f"SELECT '{a}' AS feature_name, " + ", ".join(_corr_cell(a, b) for b in _CORR) + " FROM features" for a in _CORR
    ),
)
add(
    "feature_gate",
    lambda L: quality.feature_gate(_feats(L), L.fact),
    checks_sql(
        FEATURES,
        "FROM features",
        {
            "has_rows": EMPTY,
            "unique_complaint_id": repeated("features"),
            "null_complaint_id": count_if("complaint_id IS NULL"),
            "invalid_label": count_if("label_untimely_response NOT IN (0, 1)"),
            "rows_above_source": "greatest(count(*) - (SELECT count(*) FROM fact), 0)",
            **{
                f"split_{s}_present": f"CASE WHEN count(*) FILTER (WHERE dataset_split = '{s}') = 0 THEN 1 ELSE 0 END"
                for s in K.SPLITS
            },
        },
    ),
)
add(
    "train_input_gate",
    lambda L: quality.train_input_gate(_feats(L)),
    checks_sql(
        FEATURES,
        "FROM features",
        {
            "has_rows": EMPTY,
            **{
                f"split_{s}_present": f"CASE WHEN count(*) FILTER (WHERE dataset_split = '{s}') = 0 THEN 1 ELSE 0 END"
                for s in K.SPLITS
            },
        },
    ),
)
add(
    "both_classes_gate",
    lambda L: quality.both_classes_gate(_train(L)),
    checks_sql(
        FEATURES,
        "FROM features WHERE dataset_split = 'TRAIN'",
        {
            "has_rows": EMPTY,
            **{
                f"label_{v}_present": f"CASE WHEN count(*) FILTER (WHERE label_untimely_response = {v}) = 0 THEN 1 ELSE 0 END"
                for v in (0, 1)
            },
        },
    ),
)

# ---- splits, weights, encoding -------------------------------------------------------------------


def _hash_split_md5(L):
    bucket, split = hash_split(F.col("complaint_id"), "md5")
    return L.silver.select("complaint_id", bucket.alias("split_bucket"), split.alias("dataset_split"))


add(
    "hash_split_md5",
    _hash_split_md5,
    GOLD
    + f" SELECT complaint_id, {md5_bucket('complaint_id', 100)} AS split_bucket,"
    + f" CASE WHEN {md5_bucket('complaint_id', 100)} < 70 THEN 'TRAIN' WHEN {md5_bucket('complaint_id', 100)} < 85"
    + " THEN 'VALIDATION' ELSE 'TEST' END AS dataset_split FROM silver",
)


def _hash_split(L):
    """Invariants of the default hash: every id in one split, bucket in range, expected shares."""
    bucket, split = hash_split(F.col("complaint_id"))
    rows = L.bronze.selectExpr("try_cast(trim(complaint_id) AS BIGINT) AS complaint_id").filter("complaint_id IS NOT NULL")
    per_id = (
        rows.select("complaint_id", bucket.alias("b"), split.alias("s"))
        .groupBy("complaint_id")
        .agg(F.min("s").alias("s"), (F.min("s") == F.max("s")).alias("one"), F.min("b").alias("lo"), F.max("b").alias("hi"))
    )
    share = {s: F.count_if(F.col("s") == s) / F.count("*") for s in K.SPLITS}
    return per_id.agg(
        F.count("*").alias("ids"),
        F.count_if(~F.col("one")).alias("ids_in_two_splits"),
        ((F.min("lo") >= 0) & (F.max("hi") < 100)).alias("buckets_in_range"),
        *[
            (F.abs(share[s] - want) < 0.05).alias(f"{s.lower()}_share_ok")
            for s, want in ((K.TRAIN, 0.70), (K.VALIDATION, 0.15), (K.TEST, 0.15))
        ],
    )


add(
    "hash_split",
    _hash_split,
    GOLD
    + " SELECT count(DISTINCT trim(complaint_id)) AS ids, CAST(0 AS BIGINT) AS ids_in_two_splits, true AS buckets_in_range,"
    + " true AS train_share_ok, true AS validation_share_ok, true AS test_share_ok FROM complaints_raw"
    + " WHERE regexp_full_match(trim(complaint_id), '[0-9]+')",
)


def _cap_sample(L):
    """Sampling is random by design: check that the training rows shrink to size and the other splits stay whole."""
    feats = _feats(L)
    cap = 2 * feats.filter(F.col(K.SPLIT) == K.TEST).count()
    capped = features.cap_sample(feats, cap)
    before = feats.groupBy(K.SPLIT).agg(F.count("*").alias("before"))
    after = capped.groupBy(K.SPLIT).agg(F.count("*").alias("after"))
    near = F.abs(F.col("after") - cap) < 6 * F.sqrt(F.lit(float(cap)))
    return before.join(after, K.SPLIT).select(
        K.SPLIT,
        F.col("before").alias("rows_before"),
        (F.when((F.col("before") <= cap) | (F.col(K.SPLIT) != K.TRAIN), F.col("after") == F.col("before")).otherwise(near)).alias("size_ok"),
    )


add(
    "cap_sample",
    _cap_sample,
    FEATURES + " SELECT dataset_split, count(*) AS rows_before, true AS size_ok FROM features GROUP BY 1",
)
add(
    "class_weight",
    lambda L: rounded(encode.class_weight(_feats(L)).select("complaint_id", K.LABEL, K.WEIGHT), K.WEIGHT),
    FEATURES
    + ", w AS (SELECT count(*) FILTER (WHERE label_untimely_response = 0) / count(*) FILTER (WHERE label_untimely_response = 1)"
    + " AS w FROM features WHERE dataset_split = 'TRAIN')"
    + " SELECT complaint_id, label_untimely_response, round(CASE WHEN label_untimely_response = 1 THEN w ELSE 1.0 END, 9)"
    + " AS class_weight FROM features, w",
)
add(
    "target_rate",
    lambda L: rounded(encode.target_rate(_train(L)), "target_rate"),
    ENCODED + " SELECT round(g, 9) AS target_rate FROM rate",
)
add(
    "target_encode_fit",
    lambda L: rounded(encode.target_encode_fit(_train(L)), "rate"),
    ENCODED + " SELECT feature, category, n, positives, round(rate, 9) AS rate FROM enc",
)
_INDEXED = tuple(K.encoded_name(c) for c in K.CATEGORICAL_COLUMNS)


def _apply(L):
    train = _train(L)
    encodings = stage(encode.target_encode_fit(train), "encodings", "feature")
    held_out = _feats(L).filter(F.col(K.SPLIT) != K.TRAIN)
    rate = encode.target_rate(train).scalar()
    return rounded(encode.target_encode_apply(held_out, encodings, rate).select("complaint_id", *_INDEXED), *_INDEXED)


def _joined(table: str, on_fold: bool) -> str:
    cols, joins = [], []
    for i, c in enumerate(K.CATEGORICAL_COLUMNS):
        cols.append(f"round(coalesce(e{i}.rate, g), 9) AS {K.encoded_name(c)}")
        fold = f" AND e{i}.fold = {md5_bucket('f.complaint_id', 5, 'fold:')}" if on_fold else ""
        joins.append(f"LEFT JOIN {table} e{i} ON e{i}.feature = '{c}' AND e{i}.category = f.{c}{fold}")
    return f" SELECT complaint_id, {', '.join(cols)} FROM features f CROSS JOIN rate {' '.join(joins)}"


add("target_encode_apply", _apply, ENCODED + _joined("enc", False) + " WHERE f.dataset_split <> 'TRAIN'")
add(
    "target_encode_oof",
    lambda L: rounded(
        encode.target_encode_oof(_train(L), method="md5").select("complaint_id", *_INDEXED), *_INDEXED
    ),
    ENCODED + _joined("oof", True) + " WHERE f.dataset_split = 'TRAIN'",
)
_VALID = "SELECT complaint_id, label_untimely_response, md5('half:' || CAST(complaint_id AS VARCHAR)) AS h FROM features WHERE dataset_split = 'VALIDATION'"


def _validation(L):
    return _feats(L).filter(F.col(K.SPLIT) == K.VALIDATION).select("complaint_id", K.LABEL)


add(
    "stratified_halves",
    lambda L: features.stratified_halves(_validation(L), exact=True),
    FEATURES
    + " SELECT complaint_id, label_untimely_response,"
    + " CAST(ntile(2) OVER (PARTITION BY label_untimely_response ORDER BY h, complaint_id) AS INTEGER) AS half"
    + f" FROM ({_VALID})",
)
add(
    "stratified_halves_by_hash",
    lambda L: features.stratified_halves(_validation(L)),
    FEATURES
    + f" SELECT complaint_id, label_untimely_response, CAST({md5_bucket('complaint_id', 2, 'half:')} + 1 AS INTEGER) AS half"
    + f" FROM ({_VALID})",
)

# ---- curves and metrics over scored rows -----------------------------------------------------------


def _cumulative(L):
    return curves.cumulative_scores(curves.score_table(fixtures.scored(L.spark, L.sf_dir)))


def _thresholds(cumulative):
    validation = curves.pr_curve(cumulative).filter(F.col("dataset_split") == K.VALIDATION)
    return curves.threshold_for_recall(validation)


add(
    "pr_curve",
    lambda L: rounded(curves.pr_curve(_cumulative(L)), "precision", "recall"),
    CURVE
    + " SELECT model_name, dataset_split, threshold, round(precision, 9) AS precision, round(recall, 9) AS recall FROM curve",
)
add("threshold_for_recall", lambda L: _thresholds(_cumulative(L)), CURVE + " SELECT model_name, threshold FROM picked")
_AP = "sum(CAST(pos AS DOUBLE) / total_pos * cum_pos / cum_n)"
_AUC = (
    "sum(CAST(pos AS DOUBLE) * ((total_n - total_pos) - (cum_n - cum_pos) + (n - pos) / 2.0))"
    " / max(CAST(total_pos AS DOUBLE) * (total_n - total_pos))"
)
add(
    "average_precision",
    lambda L: rounded(curves.average_precision(_cumulative(L)), "average_precision"),
    CURVE + f" SELECT model_name, dataset_split, round({_AP}, 9) AS average_precision FROM cum GROUP BY 1, 2",
)
add(
    "roc_auc",
    lambda L: rounded(curves.roc_auc(_cumulative(L)), "roc_auc"),
    CURVE + f" SELECT model_name, dataset_split, round({_AUC}, 9) AS roc_auc FROM cum GROUP BY 1, 2",
)
_TP, _FP = count_if("probability >= threshold AND label = 1"), count_if("probability >= threshold AND label = 0")
_TN, _FN = count_if("probability < threshold AND label = 0"), count_if("probability < threshold AND label = 1")
_COUNTS = (
    f"{_TP} AS true_positive_count, {_FP} AS false_positive_count, {_TN} AS true_negative_count,"
    f" {_FN} AS false_negative_count"
)


def _confusion(L):
    scores = curves.score_table(fixtures.scored(L.spark, L.sf_dir))
    return curves.confusion_counts(scores, _thresholds(curves.cumulative_scores(scores)))


add(
    "confusion_counts",
    _confusion,
    CURVE + f" SELECT model_name, dataset_split, {_COUNTS} FROM scored JOIN picked USING (model_name) GROUP BY 1, 2",
)
_RATIOS = ("auc_roc", "auc_pr", "precision", "recall", "f2_score", "positive_label_rate", "predicted_positive_rate")


def _metrics(L):
    cumulative = stage(_cumulative(L), "cumulative")
    return rounded(curves.binary_metrics(cumulative, _thresholds(cumulative), ["a", "b"]), *_RATIOS)


add(
    "binary_metrics",
    _metrics,
    CURVE
    + f", counts AS (SELECT model_name, dataset_split, count(*) AS row_count, {_COUNTS}, max(threshold) AS selected_threshold,"
    + " avg(label) AS positive_label_rate FROM scored JOIN picked USING (model_name) GROUP BY 1, 2),"
    + f" areas AS (SELECT model_name, dataset_split, {_AP} AS auc_pr, {_AUC} AS auc_roc FROM cum GROUP BY 1, 2)"
    + " SELECT model_name, dataset_split, row_count, round(auc_roc, 9) AS auc_roc, round(auc_pr, 9) AS auc_pr,"
    + " round(coalesce(CAST(true_positive_count AS DOUBLE) / nullif(true_positive_count + false_positive_count, 0), 0), 9) AS precision,"
    + " round(coalesce(CAST(true_positive_count AS DOUBLE) / nullif(true_positive_count + false_negative_count, 0), 0), 9) AS recall,"
    + " round(coalesce(5.0 * true_positive_count / nullif(5.0 * true_positive_count + 4.0 * false_negative_count"
    + " + false_positive_count, 0), 0), 9) AS f2_score, selected_threshold, true_positive_count, false_positive_count,"
    + " true_negative_count, false_negative_count, round(positive_label_rate, 9) AS positive_label_rate,"
    + " round(CAST(true_positive_count + false_positive_count AS DOUBLE) / row_count, 9) AS predicted_positive_rate,"
    + " 2 AS feature_count, 1 AS label_column_count, 'a, b' AS selected_features"
    + " FROM counts JOIN areas USING (model_name, dataset_split)",
)
# Scores have three decimals, so a mean over 128 rows can end exactly on half a unit of the ninth.
_QS = ", ".join(str(i / 10) for i in range(1, 10))
add(
    "reliability_bins",
    lambda L: rounded(curves.reliability_bins(_cumulative(L)), "mean_predicted", "fraction_positive", digits=11),
    SCORED
    + f", edges AS (SELECT model_name, dataset_split, quantile_cont(probability, [{_QS}]) AS e FROM scored GROUP BY 1, 2)"
    + " SELECT model_name, dataset_split, CAST(len(list_filter(e, lambda x: x < probability)) AS INTEGER) AS bin,"
    + " count(*) AS row_count, round(avg(probability), 11) AS mean_predicted, round(avg(label), 11) AS fraction_positive"
    + " FROM scored JOIN edges USING (model_name, dataset_split) GROUP BY 1, 2, 3",
)
