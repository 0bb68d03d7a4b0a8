"""Promoting a champion and scoring requests with it."""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops.constants import (
    CATEGORICAL_COLUMNS,
    ENCODED_SUFFIX,
    MISSING_LABEL,
    NUMERIC_COLUMNS,
    VALIDATION,
    encoded_name,
)
from lakeops.operators.encode import target_encode_apply
from lakeops.operators.models import ScoredModel, predict
from lakeops.operators.quality import ExpectationError

# ---- promotion -----------------------------------------------------------------------------------


def champion_of(metrics: DataFrame) -> DataFrame:
    """The model with the best average precision on VALIDATION, one row; ties by name."""
    held = metrics.filter(F.col("dataset_split") == VALIDATION)
    best = F.max_by(
        F.struct("model_name", "auc_pr", "selected_threshold"), F.struct(F.col("auc_pr"), F.col("model_name"))
    )
    return held.agg(best.alias("best")).select("best.*")


def serving_metadata(
    champion: DataFrame, rate: DataFrame, selected: Iterable[str]
) -> DataFrame:
    """One row: champion, threshold, column lists and fallback rate."""
    return champion.select(
        "model_name",
        F.col("auc_pr").alias("validation_auc_pr"),
        "selected_threshold",
        F.lit(list(selected)).alias("selected_feature_columns"),
        F.lit(list(CATEGORICAL_COLUMNS)).alias("categorical_feature_columns"),
        F.lit(list(NUMERIC_COLUMNS)).alias("numeric_feature_columns"),
        rate.scalar().alias("global_positive_rate"),
    )


def promote_champion(
    root: str,
    models: Iterable[ScoredModel],
    metrics: DataFrame,
    encodings: DataFrame,
    rate: DataFrame,
    selected: Iterable[str],
) -> DataFrame:
    """Write the best model with its own metadata and encodings, then point to them.

    Everything of a run goes to its own directory. The pointer is a table to which the run
    appends one row as the very last step, so a reader sees a complete run or the previous one.
    Returns the pointer row.
    """
    spark = metrics.sparkSession
    selected = list(selected)
    best = champion_of(metrics)
    name = best.first()["model_name"]
    model = next(m.model for m in models if m.name == name)
    run_id = uuid.uuid4().hex
    run = f"{root.rstrip('/')}/run={run_id}"
    model.write().overwrite().save(f"{run}/model")
    encodings.write.partitionBy("feature").parquet(f"{run}/encodings")
    serving_metadata(best, rate, selected).write.parquet(f"{run}/metadata")
    serving_contract_gate(model, spark.read.parquet(f"{run}/metadata"))
    pointer = spark.range(1).select(
        F.lit(run_id).alias("run_id"),
        F.lit(name).alias("model_name"),
        F.lit(run).alias("path"),
        F.current_timestamp().alias("promoted_at"),
    )
    pointer.write.mode("append").parquet(f"{root.rstrip('/')}/promotions")
    return spark.read.parquet(f"{root.rstrip('/')}/promotions").filter(F.col("run_id") == run_id)


def model_inputs(model: PipelineModel) -> list[str]:
    """The columns a model's assembler reads, in order."""
    return list(model.stages[0].getInputCols())


def serving_contract_gate(model: PipelineModel, metadata: DataFrame) -> None:
    """The model's inputs must be the metadata's selected columns, in the same order."""
    promised = list(metadata.select("selected_feature_columns").first()[0])
    if model_inputs(model) != promised:
        raise ExpectationError(f"model reads {model_inputs(model)}, metadata promises {promised}")


def load_champion(spark: SparkSession, root: str) -> tuple[PipelineModel, DataFrame, DataFrame]:
    """``(model, metadata, encodings)`` of the latest promotion."""
    latest = (
        spark.read.parquet(f"{root.rstrip('/')}/promotions")
        .agg(F.max_by("path", F.struct("promoted_at", "run_id")))
        .first()[0]
    )
    metadata = spark.read.parquet(f"{latest}/metadata")
    model = PipelineModel.load(f"{latest}/model")
    serving_contract_gate(model, metadata)
    return model, metadata, spark.read.parquet(f"{latest}/encodings")


# ---- requests ------------------------------------------------------------------------------------


def request_fields(selected: Iterable[str], categorical: Iterable[str] = CATEGORICAL_COLUMNS) -> list[dict[str, str]]:
    """Raw fields a caller supplies: encoded inputs under their raw name, the rest as numbers."""
    categorical = set(categorical)
    fields = []
    for column in selected:
        raw = column.removesuffix(ENCODED_SUFFIX)
        if column.endswith(ENCODED_SUFFIX) and raw in categorical:
            fields.append({"name": raw, "type": "categorical"})
        else:
            fields.append({"name": column, "type": "numeric"})
    return fields


def request_schema(selected: Iterable[str]) -> T.StructType:
    """Request schema: every field as text, so that any JSON scalar can be read."""
    return T.StructType([T.StructField(f["name"], T.StringType()) for f in request_fields(selected)])


def _number(c: Column) -> Column:
    folded = F.lower(F.trim(c))
    return (
        F.when(c.isNull() | (c == ""), F.lit(0.0))
        .when(folded == "true", F.lit(1.0))
        .when(folded == "false", F.lit(0.0))
        .otherwise(folded.try_cast("double"))
    )


def encode_requests(
    requests: DataFrame,
    encodings: DataFrame,
    rate: Column,
    selected: Iterable[str],
    body: str = "value",
    missing: str = MISSING_LABEL,
) -> DataFrame:
    """Parse JSON bodies and add exactly the selected model inputs, in order, and ``_error``.

    A body that is no JSON object counts as one without fields. A missing category takes
    the training label for missing values (or ``missing=''`` for the fallback rate), an unseen one
    the fallback rate. A missing or empty number is 0; text that is no number is named in ``_error``.
    """
    selected = list(selected)
    fields = request_fields(selected)
    parsed = requests.withColumn("_request", F.from_json(F.col(body), request_schema(selected)))
    raw = {f["name"]: F.col("_request")[f["name"]] for f in fields}
    texts = [f["name"] for f in fields if f["type"] == "categorical"]
    numbers = [f["name"] for f in fields if f["type"] == "numeric"]
    bad = [F.when(_number(raw[n]).isNull(), F.lit(n)) for n in numbers]
    error = F.array_compact(F.array(*bad)) if bad else F.array().cast("array<string>")
    kept = requests.columns
    df = parsed.select(
        *kept,
        *[F.coalesce(raw[n], F.lit(missing)).alias(n) for n in texts],
        *[F.coalesce(_number(raw[n]), F.lit(0.0)).alias(n) for n in numbers],
        F.when(F.size(error) > 0, F.concat(F.lit("not a number: "), F.array_join(error, ", "))).alias("_error"),
    )
    encoded = target_encode_apply(df, encodings, rate, texts)
    return encoded.select(*kept, *selected, "_error")


def score_requests(
    requests: DataFrame,
    model,
    encodings: DataFrame,
    rate: Column,
    threshold: Column,
    selected: Iterable[str],
    body: str = "value",
    missing: str = MISSING_LABEL,
) -> DataFrame:
    """Score JSON request bodies: probability, decision (at or above the threshold), label.

    Every step is per row except the joins with the small encoding table, so a streaming
    ``requests`` works as well. Rows with an ``_error`` get no score.
    """
    encoded = encode_requests(requests, encodings, rate, selected, body, missing)
    scored = predict(model, encoded)
    ok = F.col("_error").isNull()
    probability = F.when(ok, F.col("probability"))
    decision = F.when(ok, (F.col("probability") >= threshold).cast("int"))
    return scored.select(
        *requests.columns,
        probability.alias("predicted_probability_untimely"),
        decision.alias("prediction"),
        F.when(decision == 1, "untimely").when(decision == 0, "timely").alias("prediction_label"),
        threshold.alias("threshold_used"),
        "_error",
    )


def score_with_champion(requests: DataFrame, root: str, body: str = "value") -> DataFrame:
    """Score requests with the promoted model of ``root``."""
    model, metadata, encodings = load_champion(requests.sparkSession, root)
    row = metadata.first()
    return score_requests(
        requests,
        model,
        encodings,
        F.lit(row["global_positive_rate"]),
        F.lit(row["selected_threshold"]),
        row["selected_feature_columns"],
        body,
    )


# ---- drift ---------------------------------------------------------------------------------------


def drift_check(
    baseline: DataFrame,
    current: DataFrame,
    columns: Iterable[str] = CATEGORICAL_COLUMNS,
    label: str = "label_untimely_response",
    limit: float = 0.05,
) -> DataFrame:
    """Shares of every category, and the positive rate, in two row sets and whether they moved.

    One scan per side counts (feature, category); the sides meet in a full join of counts.
    """
    columns = list(columns)

    def shares(df: DataFrame, name: str) -> DataFrame:
        pairs = [F.struct(F.lit(c).alias("feature"), F.col(c).alias("category")) for c in columns]
        positive = F.when(F.col(label) == 1, F.lit("positive")).otherwise(F.lit("negative"))
        pairs.append(F.struct(F.lit(label).alias("feature"), positive.alias("category")))
        counts = df.select(F.inline(F.array(*pairs))).groupBy("feature", "category").agg(F.count("*").alias("n"))
        total = df.agg(F.count("*").cast("double").alias("total")).scalar()
        return counts.select("feature", "category", (F.col("n") / total).alias(name))

    a, b = shares(baseline, "baseline_share"), shares(current, "current_share")
    b = b.select(F.col("feature").alias("_f"), F.col("category").alias("_c"), "current_share")
    same = (F.col("feature") == F.col("_f")) & F.col("category").eqNullSafe(F.col("_c"))
    both = a.join(b, same, "full").select(
        F.coalesce("feature", "_f").alias("feature"),
        F.coalesce("category", "_c").alias("category"),
        F.coalesce("baseline_share", F.lit(0.0)).alias("baseline_share"),
        F.coalesce("current_share", F.lit(0.0)).alias("current_share"),
    )
    difference = F.col("current_share") - F.col("baseline_share")
    return both.withColumns({"difference": difference, "drifted": F.abs(difference) > limit})
