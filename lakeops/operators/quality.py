"""Data-quality gates: all rules of a table in one aggregate."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.constants import FACT_KEYS, ID, LABEL, SPLIT, SPLITS
from lakeops.functions.dates import parse_timestamp
from lakeops.functions.text import is_numeric_id
from lakeops.operators.profile import stack_measures


class ExpectationError(RuntimeError):
    """A table broke at least one rule."""


def expect(
    df: DataFrame,
    row_rules: Mapping[str, Column] | None = None,
    unique: str | None = None,
    measures: Mapping[str, Column] | None = None,
    table_rules: Mapping[str, Column] | None = None,
) -> DataFrame:
    """``(check_name, violations, passed)`` of every rule, from one pass over ``df``.

    The table must hold rows. ``row_rules`` maps a rule to the condition a bad row meets.
    ``unique`` names a key that must not repeat. ``measures`` counts rows meeting a condition
    without judging them; ``table_rules`` maps a rule to a violation count written in terms of
    the measures, ``_rows`` (the row count) and scalar subqueries over other tables.
    With ``unique`` everything is first counted per key, so one shuffle serves all rules and a
    repeated key combines before it.
    """
    row_rules, table_rules = dict(row_rules or {}), dict(table_rules or {})
    counted = {**row_rules, **dict(measures or {})}
    flags = [F.count_if(F.coalesce(cond, F.lit(False))).alias(name) for name, cond in counted.items()]
    if unique:
        per_key = df.groupBy(F.col(unique).alias("_key")).agg(F.count("*").alias("_n"), *flags)
        summed = per_key.agg(
            F.coalesce(F.sum("_n"), F.lit(0)).alias("_rows"),
            F.count_if(F.col("_n") > 1).alias("_repeated"),
            *[F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in counted],
        )
    else:
        summed = df.agg(F.count("*").alias("_rows"), *flags)
    violations: dict[str, Column] = {"has_rows": none_of("_rows")}
    if unique:
        violations[f"unique_{unique}"] = F.col("_repeated")
    violations.update({name: F.col(name) for name in row_rules})
    violations.update(table_rules)
    rows = {name: {"violations": c.cast("bigint")} for name, c in violations.items()}
    checks = stack_measures(summed, rows, name="check_name")
    return checks.withColumn("passed", F.col("violations") == 0)


def none_of(measure: str | Column) -> Column:
    """One violation when a count is zero."""
    c = F.col(measure) if isinstance(measure, str) else measure
    return F.when(c == 0, 1).otherwise(0)


def excess(larger: Column, smaller: Column) -> Column:
    """How far ``larger`` exceeds ``smaller``, at least zero."""
    return F.greatest(larger - smaller, F.lit(0))


def enforce(checks: DataFrame) -> None:
    """Raise when a rule of an ``expect`` result (a handful of rows) is broken."""
    broken = [f"{r['check_name']}={r['violations']}" for r in checks.filter("NOT passed").collect()]
    if broken:
        raise ExpectationError("broken rules: " + ", ".join(sorted(broken)))


def row_total(df: DataFrame) -> Column:
    """Row count of another table as a scalar subquery."""
    return df.agg(F.count("*").alias("n")).scalar()


def require_table(spark, name: str) -> DataFrame:
    """The named table, which must exist and hold a row (looked for, not counted)."""
    if not spark.catalog.tableExists(name):
        raise ExpectationError(f"table {name} does not exist")
    df = spark.table(name)
    if df.isEmpty():
        raise ExpectationError(f"table {name} is empty")
    return df


def bronze_gate(snapshot: DataFrame) -> DataFrame:
    """A landed snapshot must hold rows."""
    return expect(snapshot)


def silver_gate(silver: DataFrame, raw: DataFrame) -> DataFrame:
    """Rows, unique non-null ids, no more rows than the source, no lost dates.

    Ids whose every raw row has a parseable date must come out dated, whichever of their rows
    won the deduplication.
    """
    text = F.trim(F.col(ID))
    raw_ids = (
        raw.filter(is_numeric_id(F.col(ID)))
        .select(
            text.try_cast("bigint").alias(ID),
            parse_timestamp(F.trim(F.col("date_received"))).isNotNull().alias("ok"),
        )
        .filter(F.col(ID).isNotNull())
        .groupBy(ID)
        .agg(F.every("ok").alias("all_ok"))
    )
    owed = raw_ids.agg(F.count_if("all_ok").alias("n")).scalar()
    return expect(
        silver,
        {f"null_{ID}": F.col(ID).isNull()},
        unique=ID,
        measures={"dated": F.col("date_received").isNotNull()},
        table_rules={
            "rows_above_source": excess(F.col("_rows"), row_total(raw)),
            "lost_dates": excess(owed, F.col("dated")),
        },
    )


def gold_gate(fact: DataFrame, silver: DataFrame, dims: Mapping[str, DataFrame]) -> DataFrame:
    """Dimensions hold rows; the fact has the clean layer's grain and no null key."""
    null_key = F.lit(False)
    for k in FACT_KEYS:
        null_key = null_key | F.col(k).isNull()
    empty = {f"empty_dim_{name}": none_of(row_total(dim)) for name, dim in dims.items()}
    return expect(
        fact,
        {"null_keys": null_key},
        unique=ID,
        table_rules={"grain_difference": F.abs(F.col("_rows") - row_total(silver)), **empty},
    )


def _split_measures() -> dict[str, Column]:
    return {f"in_{s}": F.col(SPLIT) == s for s in SPLITS}


def _split_rules() -> dict[str, Column]:
    return {f"split_{s}_present": none_of(f"in_{s}") for s in SPLITS}


def feature_gate(features: DataFrame, fact: DataFrame) -> DataFrame:
    """One row per id, a 0/1 label, all three splits, no more rows than the fact."""
    label = F.col(LABEL)
    return expect(
        features,
        {f"null_{ID}": F.col(ID).isNull(), "invalid_label": label.isNull() | ~label.isin(0, 1)},
        unique=ID,
        measures=_split_measures(),
        table_rules={"rows_above_source": excess(F.col("_rows"), row_total(fact)), **_split_rules()},
    )


def train_input_gate(features: DataFrame) -> DataFrame:
    """All three splits hold rows."""
    return expect(features, measures=_split_measures(), table_rules=_split_rules())


def both_classes_gate(train: DataFrame) -> DataFrame:
    """Both labels occur among the training rows."""
    return expect(
        train,
        measures={f"label_{v}": F.col(LABEL) == v for v in (0, 1)},
        table_rules={f"label_{v}_present": none_of(f"label_{v}") for v in (0, 1)},
    )


def monitoring_gate(metrics: DataFrame, predictions: DataFrame, models: Iterable[str]) -> DataFrame:
    """Two metric rows per model, every model present, some predictions."""
    models = list(models)
    return expect(
        metrics,
        measures={f"of_{m}": F.col("model_name") == m for m in models},
        table_rules={
            "metric_rows": F.when(F.col("_rows") < 2 * len(models), 1).otherwise(0),
            **{f"model_{m}_present": none_of(f"of_{m}") for m in models},
            "predictions_present": none_of(row_total(predictions)),
        },
    )
