"""Queries that fit, evaluate, promote and serve models.

Fitted trees have no SQL counterpart. Where a property of the result does (which rows come out,
what the gates say, the optimum a fit must reach), the checking SQL states that property.
The training split is the md5 one, so that SQL can repeat it.
"""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from lakeops import constants as K
from lakeops.operators import curves, encode, models, quality, serving
from lakeops.plans import fixtures, training
from lakeops.queries.learning import _joined, rounded
from lakeops.queries.oracle import ENCODED, FEATURES, SCORED
from lakeops.queries.registry import add
from lakeops.sources.staging import fresh_path, stage


def encoded_layer(L) -> training.Encoded:
    return L.keep("encoded", lambda: training.encode(L.features("md5")))


def _train_rows(L):
    return encoded_layer(L).rows.filter(F.col(K.SPLIT) == K.TRAIN)


def _importances(L):
    return L.keep("importances", lambda: models.select_features(_train_rows(L)))


LEARNERS = (models.TREE, models.FOREST, models.BOOSTED)
_NAMES = ", ".join(f"('{n}')" for n in LEARNERS)


def _fit(L, name: str) -> models.ScoredModel:
    def fit():
        return models.fit_and_calibrate(name, models.estimators()[name], encoded_layer(L).rows, models.top_features(_importances(L)))

    return L.keep(f"fit-{name}", fit)


def _trained(L) -> training.Trained:
    def train():
        importances = _importances(L)
        fitted = training.side_by_side(lambda n: _fit(L, n), LEARNERS, _train_rows(L))
        return training.train(encoded_layer(L), LEARNERS, importances=importances, fitted=fitted)

    return L.keep("trained", train)


# ---- inputs and fits -----------------------------------------------------------------------------


def _assemble(L):
    train = L.features("md5").filter(F.col(K.SPLIT) == K.TRAIN)
    vectors = models.assemble(encode.target_encode_oof(train, method="md5"))
    values = vector_to_array("features")
    total = F.aggregate(values, F.lit(0.0), lambda a, x: a + x)
    return rounded(vectors.select("complaint_id", F.size(values).alias("inputs"), total.alias("total")), "total")


_TOTAL = " + ".join([*map(K.encoded_name, K.CATEGORICAL_COLUMNS), *K.NUMERIC_COLUMNS])
add(
    "assemble",
    _assemble,
    ENCODED
    + ", indexed AS ("
    + _joined("oof", True).replace("SELECT complaint_id,", f"SELECT complaint_id, {', '.join(K.NUMERIC_COLUMNS)},").replace(", 9)", ", 15)")
    + f" WHERE f.dataset_split = 'TRAIN') SELECT complaint_id, {len(K.MODEL_INPUTS)} AS inputs, round({_TOTAL}, 9) AS total FROM indexed",
)


def _sound(score: str, rows):
    """Importances lie in [0, 1] and add up to 1: a model that splits nothing has none."""
    total = rows.agg(F.sum(score)).scalar()
    return F.col(score).between(0.0, 1.0).alias("in_range"), (F.abs(total - 1) < 1e-9).alias("total_valid")


def _selected(L):
    ranked = _importances(L)
    higher = ranked.select(F.col("selected_feature_rank").alias("r"), F.col("importance_score").alias("s"))
    below = F.count(F.when(F.col("s") < F.col("importance_score"), 1))
    rank = F.col("selected_feature_rank")
    checked = ranked.join(higher, F.col("r") < rank, "left").groupBy("feature_name", rank, "importance_score").agg(
        (F.count("r") == rank - 1).alias("rank_is_dense"), (below == 0).alias("rank_follows_importance")
    )
    return checked.select("feature_name", *_sound("importance_score", ranked), "rank_is_dense", "rank_follows_importance")


add(
    "select_features",
    _selected,
    "SELECT f AS feature_name, true AS in_range, true AS total_valid, true AS rank_is_dense, true AS rank_follows_importance"
    f" FROM (VALUES {', '.join(f"('{c}')" for c in K.MODEL_INPUTS)}) v(f)",
)


def _fitted(name: str):
    def build(L):
        selected = models.top_features(_importances(L))
        rows = models.model_importances([_fit(L, name)], selected)
        place = F.array_position(F.lit(selected), F.col("feature_name")).cast("int")
        return rows.select("model_name", place.alias("position"), *_sound("importance_score", rows))

    return build


for _query, _name in (("fit_tree", models.TREE), ("fit_forest", models.FOREST), ("fit_gbt", models.BOOSTED)):
    add(
        _query,
        _fitted(_name),
        f"SELECT '{_name}' AS model_name, CAST(i AS INTEGER) AS position, true AS in_range, true AS total_valid FROM range(1, {K.TOP_FEATURES + 1}) r(i)",
    )


def _tuned(name: str, columns: dict[str, str]):
    def build(L):
        estimator, grid = models.estimators()[name], models.grids()[name]
        _, table = models.tune(estimator, grid, _train_rows(L), models.top_features(_importances(L)))
        points = [F.col("params")[parameter].alias(column) for parameter, column in columns.items()]
        return table.select(*points, F.col("average_precision").between(0.0, 1.0).alias("score_in_range"))

    return build


add(
    "tune",
    _tuned(models.TREE, {"maxDepth": "max_depth", "minInstancesPerNode": "min_leaf"}),
    "SELECT CAST(d AS DOUBLE) AS max_depth, CAST(m AS DOUBLE) AS min_leaf, true AS score_in_range"
    " FROM (VALUES (6), (8), (10)) a(d), (VALUES (25), (50), (100)) b(m)",
)
add(
    "tune_forest",
    _tuned(models.FOREST, {"numTrees": "trees", "maxDepth": "max_depth"}),
    "SELECT CAST(t AS DOUBLE) AS trees, CAST(d AS DOUBLE) AS max_depth, true AS score_in_range"
    " FROM (VALUES (50), (80), (120)) a(t), (VALUES (8), (10), (12)) b(d)",
)

# ---- calibration ---------------------------------------------------------------------------------


def _platt(L):
    """At the fitted sigmoid both derivatives of the weighted log loss vanish."""
    parts = []
    scored = fixtures.scored(L.spark, L.sf_dir)
    for name in ("m1", "m2"):
        rows = scored.filter(F.col("model_name") == name)
        sigmoid = models.platt_calibrate(rows, "probability", "label")
        slope, intercept = float(sigmoid.coefficients[0]), float(sigmoid.intercept)
        weighted = models.platt_rows(rows, "probability", "label")
        fitted = 1 / (1 + F.exp(-(F.lit(slope) * F.col("score") + F.lit(intercept))))
        gap = F.col("platt_weight") * (F.col("platt_label") - fitted)
        total = F.sum("platt_weight")
        parts.append(
            weighted.agg(
                F.lit(name).alias("model_name"),
                F.round(total).cast("bigint").alias("row_count"),
                (F.abs(F.sum(gap) / total) < 1e-6).alias("level_fits"),
                (F.abs(F.sum(gap * F.col("score")) / total) < 1e-6).alias("slope_fits"),
            )
        )
    return parts[0].unionByName(parts[1])


add(
    "platt_calibrate",
    _platt,
    SCORED + " SELECT model_name, count(*) AS row_count, true AS level_fits, true AS slope_fits FROM scored GROUP BY 1",
)

# ---- evaluation ----------------------------------------------------------------------------------
_REPORT = ", ".join(c for c in K.REPORT_COLUMNS)


def _predictions(L):
    t = _trained(L)
    joined = t.predictions.join(t.thresholds, "model_name")
    decision = (F.col("predicted_probability_untimely") >= F.col("threshold")).cast("int")
    return joined.select(
        "model_name",
        *K.REPORT_COLUMNS,
        K.LABEL,
        K.SPLIT,
        F.col("predicted_probability_untimely").between(0.0, 1.0).alias("probability_in_range"),
        (F.col("prediction") == decision).alias("decision_follows_threshold"),
    )


add(
    "predictions_table",
    _predictions,
    FEATURES
    + f" SELECT m AS model_name, {_REPORT}, label_untimely_response, dataset_split, true AS probability_in_range,"
    + f" true AS decision_follows_threshold FROM features, (VALUES {_NAMES}) v(m)"
    + " WHERE dataset_split = 'TEST'",
)


def _model_metrics(L):
    """The metrics of fitted models, reduced to what their row sets determine."""
    m = _trained(L).metrics
    counted = sum((F.col(f"{k}_count") for k in ("true_positive", "false_positive", "true_negative", "false_negative")), F.lit(0))
    return m.select(
        "model_name",
        "dataset_split",
        "row_count",
        F.round("positive_label_rate", 9).alias("positive_label_rate"),
        (counted == F.col("row_count")).alias("counts_add_up"),
        "feature_count",
    )


add(
    "model_metrics",
    _model_metrics,
    FEATURES
    + " SELECT m AS model_name, dataset_split, count(*) AS row_count, round(avg(label_untimely_response), 9)"
    + f" AS positive_label_rate, true AS counts_add_up, {K.TOP_FEATURES} AS feature_count"
    + f" FROM features, (VALUES {_NAMES}) v(m) WHERE dataset_split <> 'TRAIN' GROUP BY 1, 2",
)


#: A label that can be learnt: it follows a month or a category but for every tenth row. The given labels are close to noise.
_PLANTED = "CASE WHEN (complaint_received_month <= 3 OR submitted_via = 'BUILDING') AND complaint_id % 10 <> 0 THEN 1 WHEN complaint_id % 25 = 1 THEN 1 ELSE 0 END"


def _skill(L):
    """Learners on a planted label: average precision on VALIDATION against the share of positives, which a model that knows nothing reaches."""
    rows = training.encode(stage(L.features("md5").withColumn(K.LABEL, F.expr(_PLANTED)), "planted")).rows
    train, held = (rows.filter(F.col(K.SPLIT) == split) for split in (K.TRAIN, K.VALIDATION))
    chosen = models.top_features(models.select_features(train))
    parts = []
    for name in (models.TREE, models.FOREST):
        model = models.fit(models.estimators()[name], train, chosen)
        scored = stage(model.transform(held).select(models.score_column().alias("probability"), F.col(K.LABEL).alias("label")), "skill")
        precision = curves.average_precision(curves.cumulative_scores(curves.score_table(scored, ()), ()), ())
        base = scored.agg(F.avg("label").alias("base_rate"), F.count("*").alias("row_count"))
        parts.append(
            precision.crossJoin(base).select(  # a row each
                F.lit(name).alias("model_name"), "row_count", F.round("base_rate", 9).alias("base_rate"),
                (F.col("average_precision") > 1.5 * F.col("base_rate")).alias("beats_base_rate"),
                F.lit({"complaint_received_month", "submitted_via_indexed"} <= set(chosen)).alias("signal_selected"),
            )
        )
    return parts[0].unionByName(parts[1])


add(
    "model_skill",
    _skill,
    FEATURES
    + f" SELECT m AS model_name, count(*) AS row_count, round(avg({_PLANTED}), 9) AS base_rate, true AS beats_base_rate, true AS signal_selected"
    + f" FROM features, (VALUES ('{models.TREE}'), ('{models.FOREST}')) v(m) WHERE dataset_split = 'VALIDATION' GROUP BY 1",
)


def _floor_met(L):
    """Recall at the chosen threshold, on the half of VALIDATION it was chosen on."""
    t = _trained(L)
    rows = t.scored.filter((F.col(K.SPLIT) == K.VALIDATION) & (F.col("half") == 2))
    scores = curves.score_table(rows, label=K.LABEL)
    counts = curves.confusion_counts(scores, t.thresholds)
    tp, fn = F.col("true_positive_count"), F.col("false_negative_count")
    return counts.select("model_name", (curves.ratio(tp, tp + fn) >= K.RECALL_FLOOR).alias("recall_floor_met"))


add(
    "recall_floor",
    _floor_met,
    f"SELECT m AS model_name, true AS recall_floor_met FROM (VALUES {_NAMES}) v(m)",
)
add(
    "monitoring_gate",
    lambda L: quality.monitoring_gate(
        _trained(L).metrics, _trained(L).predictions, [m.name for m in _trained(L).models]
    ),
    "SELECT n AS check_name, CAST(0 AS BIGINT) AS violations, true AS passed FROM (VALUES ('has_rows'), ('metric_rows'),"
    " ('model_decision_tree_present'), ('model_random_forest_present'), ('model_gradient_boosted_present'),"
    " ('predictions_present')) v(n)",
)

# ---- promotion and serving -----------------------------------------------------------------------


def _promoted(L) -> str:
    def promote() -> str:
        root, t = fresh_path(L.spark, "champion"), _trained(L)
        serving.promote_champion(root, t.models, t.metrics, t.encoded.encodings, t.encoded.rate, t.selected)
        return root

    return L.keep("champion", promote)


def _champion(L):
    _, metadata, _ = serving.load_champion(L.spark, _promoted(L))
    return metadata



def _promotion(L):
    """The promoted row against the maximum of the metrics, found by sorting."""
    best = _trained(L).metrics.where(F.col("dataset_split") == K.VALIDATION).orderBy(F.desc("auc_pr"), F.desc("model_name")).limit(1)
    best = best.select(F.col("model_name").alias("best"), F.col("auc_pr").alias("score"), F.col("selected_threshold").alias("threshold"))
    same = F.col("model_name") == F.col("best")
    return _champion(L).join(best, same, "left").select(
        F.coalesce(same, F.lit(False)).alias("best_promoted"),
        (F.col("validation_auc_pr") == F.col("score")).alias("same_score"),
        (F.col("selected_threshold") == F.col("threshold")).alias("same_threshold"),
        F.round("global_positive_rate", 9).alias("fallback_rate"),
    )


add(
    "promote_champion",
    _promotion,
    ENCODED + " SELECT true AS best_promoted, true AS same_score, true AS same_threshold, round(g, 9) AS fallback_rate FROM rate",
)


def _calibration_reliability(L):
    """Reliability bins of raw and of calibrated probabilities on TEST, reduced to what their row sets determine."""
    bins = models.calibration_reliability(_trained(L).scored.where(F.col(K.SPLIT) == K.TEST))
    positives = F.sum(F.col("fraction_positive") * F.col("row_count"))
    return bins.groupBy("model_name", "kind").agg(
        F.sum("row_count").alias("row_count"),
        F.round(positives).cast("bigint").alias("positives"),
        F.min(F.col("mean_predicted").between(0.0, 1.0)).alias("in_range"),
    )


add(
    "calibration_reliability",
    _calibration_reliability,
    FEATURES
    + " SELECT m AS model_name, k AS kind, count(*) AS row_count, CAST(sum(label_untimely_response) AS BIGINT) AS positives, true AS in_range"
    + f" FROM features, (VALUES {_NAMES}) v(m), (VALUES ('raw'), ('calibrated')) w(k) WHERE dataset_split = 'TEST' GROUP BY 1, 2",
)


def _contract(L):
    model, metadata, _ = serving.load_champion(L.spark, _promoted(L))
    promised = metadata.select(F.posexplode("selected_feature_columns").alias("position", "feature_name"))
    reads = L.spark.createDataFrame(list(enumerate(serving.model_inputs(model))), "position int, model_reads string")
    return promised.join(reads, "position", "full").select(
        "position", (F.col("feature_name") == F.col("model_reads")).alias("same")
    )


add(
    "serving_contract_gate",
    _contract,
    f"SELECT CAST(i AS INTEGER) AS position, true AS same FROM range({K.TOP_FEATURES}) r(i)",
)


def _request_rows(L, split: str, columns):
    body = F.to_json(F.struct(*columns)).alias("value")
    return L.features("md5").filter(F.col(K.SPLIT) == split).select("complaint_id", body)


def _served(L):
    """TEST rows sent through the request path must score as they did in the evaluation."""
    t = _trained(L)
    requests = _request_rows(L, K.TEST, [*K.CATEGORICAL_COLUMNS, *K.NUMERIC_COLUMNS])
    served = serving.score_with_champion(requests, _promoted(L))
    champion = _champion(L).select("model_name")
    evaluated = t.predictions.join(champion, "model_name").select(
        "complaint_id", F.col("predicted_probability_untimely").alias("p"), F.col("prediction").alias("d")
    )
    close = F.abs(F.col("predicted_probability_untimely") - F.col("p")) < 1e-9
    return served.join(evaluated, "complaint_id").select(
        "complaint_id", close.alias("same_probability"), (F.col("prediction") == F.col("d")).alias("same_decision")
    )


add(
    "score_with_champion",
    _served,
    FEATURES
    + " SELECT complaint_id, true AS same_probability, true AS same_decision FROM features WHERE dataset_split = 'TEST'",
)

_LINEAR_INPUTS = ("company_indexed", "state_indexed", "complaint_received_month", "has_tags")


def _linear(df):
    """A fixed scorer over four inputs, in place of a fitted model."""
    z = (
        F.col("company_indexed") * 8 + F.col("state_indexed") * 5
        + F.col("complaint_received_month") / 12.0 + F.col("has_tags") * 0.5 - 2.0
    )
    return df.withColumn("probability", 1 / (1 + F.exp(-z)))


def _score_requests(L):
    train = L.features("md5").filter(F.col(K.SPLIT) == K.TRAIN)
    encodings = stage(encode.target_encode_fit(train), "encodings", "feature")
    rate = encode.target_rate(train).scalar()
    month = F.col("complaint_received_month").cast("string")
    fields = [
        F.when(F.col("complaint_id") % 7 == 0, F.lit("never seen")).otherwise(F.col("company")).alias("company"),
        F.when(F.col("complaint_id") % 5 != 0, F.col("state")).alias("state"),
        F.when(F.col("complaint_id") % 11 == 0, F.lit("")).when(F.col("complaint_id") % 13 == 0, F.lit("July"))
        .otherwise(month).alias("complaint_received_month"),
        "has_tags",
    ]
    scored = serving.score_requests(
        _request_rows(L, K.TEST, fields), _linear, encodings, rate, F.lit(0.35), _LINEAR_INPUTS
    )
    return rounded(scored.drop("value"), "predicted_probability_untimely")


add(
    "score_requests",
    _score_requests,
    ENCODED
    + """, requests AS (
  SELECT complaint_id, CASE WHEN complaint_id % 7 = 0 THEN 'never seen' ELSE company END AS company,
    CASE WHEN complaint_id % 5 <> 0 THEN state ELSE 'NOT_PROVIDED' END AS state,
    CASE WHEN complaint_id % 11 = 0 THEN 0 WHEN complaint_id % 13 = 0 THEN NULL
         ELSE complaint_received_month END AS m, has_tags
  FROM features WHERE dataset_split = 'TEST'),
p AS (
  SELECT r.complaint_id, m IS NULL AS bad,
    1 / (1 + exp(-(coalesce(c.rate, g) * 8 + coalesce(s.rate, g) * 5 + m / 12.0 + has_tags * 0.5 - 2.0))) AS p
  FROM requests r CROSS JOIN rate
  LEFT JOIN enc c ON c.feature = 'company' AND c.category = r.company
  LEFT JOIN enc s ON s.feature = 'state' AND s.category = r.state)
SELECT complaint_id, round(p, 9) AS predicted_probability_untimely, CAST(p >= 0.35 AS INTEGER) AS prediction,
  CASE WHEN p >= 0.35 THEN 'untimely' WHEN p < 0.35 THEN 'timely' END AS prediction_label,
  CAST(0.35 AS DOUBLE) AS threshold_used,
  CASE WHEN bad THEN 'not a number: complaint_received_month' END AS _error FROM p""",
)
_SHARES = " UNION ALL ".join(
    [
        f"SELECT '{c}' AS feature, {c} AS category, dataset_split FROM features WHERE dataset_split IN ('TRAIN', 'TEST')"
        for c in K.CATEGORICAL_COLUMNS
    ]
    + [
        "SELECT 'label_untimely_response', CASE WHEN label_untimely_response = 1 THEN 'positive' ELSE 'negative' END,"
        " dataset_split FROM features WHERE dataset_split IN ('TRAIN', 'TEST')"
    ]
)
add(
    "drift_check",
    lambda L: rounded(
        serving.drift_check(
            L.features("md5").filter(F.col(K.SPLIT) == K.TRAIN), L.features("md5").filter(F.col(K.SPLIT) == K.TEST)
        ),
        "baseline_share", "current_share", "difference",
    ),
    FEATURES
    + f", long AS ({_SHARES}), totals AS (SELECT count(*) FILTER (WHERE dataset_split = 'TRAIN') AS a,"
    + " count(*) FILTER (WHERE dataset_split = 'TEST') AS b FROM features),"
    + " shares AS (SELECT feature, category, CAST(count(*) FILTER (WHERE dataset_split = 'TRAIN') AS DOUBLE) / any_value(a) AS x,"
    + " CAST(count(*) FILTER (WHERE dataset_split = 'TEST') AS DOUBLE) / any_value(b) AS y FROM long, totals GROUP BY 1, 2)"
    + " SELECT feature, category, round(x, 9) AS baseline_share, round(y, 9) AS current_share, round(y - x, 9) AS difference,"
    + " abs(y - x) > 0.05 AS drifted FROM shares",
)
