"""Smoothed target encoding, in-sample, held-out and out-of-fold.

The table grain is (feature, category[, fold]); rows are only ever counted into it with partial
aggregates, so a category with most of the rows costs no more than any other. Encoded values come
back by left joins on the category, whose small side the optimizer broadcasts when its written
size allows it. Where it doesn't, rows of frequent categories are matched apart and spread over the shuffle (``rate_join``).
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeops.constants import (
    CATEGORICAL_COLUMNS,
    FOLDS,
    ID,
    LABEL,
    SMOOTHING,
    SPLIT,
    TRAIN,
    WEIGHT,
    encoded_name,
)
from lakeops.functions.hashing import hash_bucket
from lakeops.sources.staging import stage


def target_rate(train: DataFrame, label: str = LABEL) -> DataFrame:
    """Positive share of the training rows, one row."""
    return train.agg((F.sum(label).cast("double") / F.count(label)).alias("target_rate"))


def class_weight(df: DataFrame, label: str = LABEL, split: str = SPLIT) -> DataFrame:
    """Weight positives by negatives/positives of TRAIN, negatives by 1."""
    train = df.filter(F.col(split) == TRAIN)
    negatives, positives = F.count_if(F.col(label) == 0), F.count_if(F.col(label) == 1)
    ratio = train.agg((negatives.cast("double") / positives).alias("w")).scalar()
    return df.withColumn(WEIGHT, F.when(F.col(label) == 1, ratio).otherwise(F.lit(1.0)))


def fold_of(id_column: str = ID, folds: int = FOLDS, method: str = "xxhash64") -> Column:
    """Fold of a row: a hash of its id, independent of the split hash."""
    return hash_bucket(F.col(id_column), folds, "fold:", method)


def encoding_counts(
    train: DataFrame,
    columns: Iterable[str] = CATEGORICAL_COLUMNS,
    label: str = LABEL,
    fold: Column | None = None,
) -> DataFrame:
    """Rows and positives per (feature, category, fold), all features in one scan."""
    pairs = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).alias("category")) for c in columns])
    fold = (F.lit(0) if fold is None else fold).cast("int")
    long = train.select(fold.alias("fold"), F.col(label).alias("_y"), F.inline(pairs))
    return long.groupBy("feature", "category", "fold").agg(
        F.count("*").alias("n"), F.sum("_y").cast("bigint").alias("positives")
    )


def smoothed(positives: Column, n: Column, rate: Column, smoothing: float = SMOOTHING) -> Column:
    return (positives + F.lit(float(smoothing)) * rate) / (n + F.lit(float(smoothing)))


def rate_of(counts: DataFrame) -> DataFrame:
    """Positive share of the training rows from their counts: any one feature holds every row."""
    one = counts.agg(F.min("feature").alias("f")).scalar()
    rows = counts.filter(F.col("feature") == one)
    return rows.agg((F.sum("positives").cast("double") / F.sum("n")).alias("target_rate"))


def encoding_table(counts: DataFrame, rate: Column, smoothing: float = SMOOTHING) -> DataFrame:
    """``(feature, category, n, positives, rate)``: the category's rate pulled to the global one.

    Null categories are left out; applying the table gives them the global rate.
    """
    whole = counts.filter(F.col("category").isNotNull()).groupBy("feature", "category").agg(
        F.sum("n").alias("n"), F.sum("positives").alias("positives")
    )
    return whole.withColumn("rate", smoothed(F.col("positives"), F.col("n"), rate, smoothing))


def target_encode_fit(
    train: DataFrame,
    columns: Iterable[str] = CATEGORICAL_COLUMNS,
    label: str = LABEL,
    smoothing: float = SMOOTHING,
) -> DataFrame:
    """The encoding table of labelled training rows."""
    counts = encoding_counts(train.filter(F.col(label).isNotNull()), columns, label)
    return encoding_table(counts, target_rate(train, label).scalar(), smoothing)


#: Rows of an encoding table that are matched without a shuffle where the whole table is too big for that.
HOT_CATEGORIES = 4096
#: Shares into which rows that the shuffled part of the table can't match are dealt.
SALTS = 1 << 14


def beyond_broadcast(table: DataFrame) -> bool:
    """Whether the written size of a table is above the session's limit for broadcasts."""
    limit = table.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    return int(str(table._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) > limit


def rate_join(df: DataFrame, table: DataFrame, value: Column, name: str, fold: Column | None = None) -> DataFrame:
    """Add ``name``, the rate of ``value`` in a table (category[, fold], n, rate), null where there is none.

    A table above the broadcast limit is parted, if it has the counts ``n``. Of its rows, those with at least one in ``HOT_CATEGORIES`` of all counts are no more than that many, so
    they can always be broadcast. The others go through a shuffle, where no category they hold has many rows; the rows that were matched already, or have no
    value, are dealt evenly over it by a salt that matches nothing, so that no task gets a frequent value.
    """
    on = ["category"] + (["fold"] if fold is not None else [])
    sides = [value] + ([fold] if fold is not None else [])

    # 0, but no literal: a comparison with a literal would be taken out of the join's key
    unsalted = F.when(F.col("n") >= 0, 0).otherwise(-1)

    def joined(rows: DataFrame, part: DataFrame, rate_name: str, more: Column | None = None) -> DataFrame:
        part = part.select(*[F.col(c).alias(f"_of_{c}") for c in on], *([unsalted.alias("_of_salt")] if more is not None else []), F.col("rate").alias(rate_name))
        condition = F.lit(True) if more is None else more == F.col("_of_salt")
        for c, side in zip(on, sides):
            condition = condition & (side == F.col(f"_of_{c}"))
        return rows.join(part, condition, "left").drop(*[f"_of_{c}" for c in on], "_of_salt")

    if "n" not in table.columns or not beyond_broadcast(table):
        return joined(df, table, name)
    total = table.agg(F.sum("n")).scalar()
    hot = F.col("n") * HOT_CATEGORIES >= total
    df = joined(df, F.broadcast(table.where(hot)), "_hot_rate")
    apart = F.col("_hot_rate").isNotNull() | value.isNull()
    spread = F.pmod(F.xxhash64(*df.columns), F.lit(SALTS)) + 1
    df = df.withColumn("_salt", F.when(apart, spread).otherwise(F.lit(0)).cast("int"))
    df = joined(df, table.where(~hot), "_tail_rate", F.col("_salt"))
    return df.withColumn(name, F.coalesce("_hot_rate", "_tail_rate")).drop("_hot_rate", "_tail_rate", "_salt")


def target_encode_apply(
    df: DataFrame, encodings: DataFrame, rate: Column, columns: Iterable[str] = CATEGORICAL_COLUMNS
) -> DataFrame:
    """Add ``<column>_indexed`` from the fitted table; an unseen category gets ``rate``."""
    kept = df.columns
    added = []
    for c in columns:
        df = rate_join(df, encodings.filter(F.col("feature") == c), F.col(c), f"_rate_{c}")
        added.append(F.coalesce(F.col(f"_rate_{c}"), rate).alias(encoded_name(c)))
    return df.select(*kept, *added)


def out_of_fold_rates(counts: DataFrame, rate: Column, smoothing: float = SMOOTHING) -> DataFrame:
    """``(feature, category, fold, n, rate)`` with the rows of the category in all folds, where a fold's rate uses only the other folds' rows.

    The prior is the global rate of all training rows, not of the other folds. A category has one
    counted row per fold, so the window below never sees more than that.
    """
    same = Window.partitionBy("feature", "category")
    other_n = F.sum("n").over(same) - F.col("n")
    other_p = F.sum("positives").over(same) - F.col("positives")
    return counts.filter(F.col("category").isNotNull()).select(
        "feature", "category", "fold", F.sum("n").over(same).alias("n"), smoothed(other_p, other_n, rate, smoothing).alias("rate")
    )


def apply_by_fold(
    df: DataFrame,
    table: DataFrame,
    rate: Column,
    fold: Column,
    columns: Iterable[str] = CATEGORICAL_COLUMNS,
) -> DataFrame:
    """Add ``<column>_indexed`` from a (feature, category, fold) table."""
    kept, added = df.columns, []
    df = df.withColumn("_fold", fold.cast("int"))
    for c in columns:
        df = rate_join(df, table.filter(F.col("feature") == c), F.col(c), f"_rate_{c}", F.col("_fold"))
        added.append(F.coalesce(F.col(f"_rate_{c}"), rate).alias(encoded_name(c)))
    return df.select(*kept, *added)


def target_encode_oof(
    train: DataFrame,
    columns: Iterable[str] = CATEGORICAL_COLUMNS,
    label: str = LABEL,
    id_column: str = ID,
    folds: int = FOLDS,
    smoothing: float = SMOOTHING,
    method: str = "xxhash64",
) -> DataFrame:
    """Encode training rows so that no row's own label takes part in its value."""
    columns = list(columns)
    fold = fold_of(id_column, folds, method)
    labelled = train.filter(F.col(label).isNotNull())
    counts = stage(encoding_counts(labelled, columns, label, fold), "fold-counts")
    rate = rate_of(counts).scalar()
    table = stage(out_of_fold_rates(counts, rate, smoothing), "fold-rates", "feature")
    return apply_by_fold(train, table, rate, fold, columns)


HELD_OUT_FOLD = -1


def encode_splits(
    features: DataFrame,
    columns: Iterable[str] = CATEGORICAL_COLUMNS,
    method: str = "xxhash64",
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(encoded rows, encoding table, one-row target rate)`` of a feature table.

    TRAIN is encoded out of fold, the held-out splits with the full TRAIN rates, which are kept as
    one more fold, so that all splits are encoded by the same joins in one scan. Another scan, of
    TRAIN, counts everything; the rate and both tables derive from the counts. They are written
    per feature: the file sizes are what decides between a broadcast and a shuffle join.
    """
    columns = list(columns)
    in_train = F.col(SPLIT) == TRAIN
    fold = fold_of(method=method).cast("int")
    counts = stage(encoding_counts(features.filter(in_train), columns, LABEL, fold), "fold-counts")
    rate = stage(rate_of(counts), "target-rate")
    encodings = stage(encoding_table(counts, rate.scalar()), "encodings", "feature")
    whole = encodings.select("feature", "category", F.lit(HELD_OUT_FOLD).alias("fold"), "n", "rate")
    by_fold = stage(out_of_fold_rates(counts, rate.scalar()).unionByName(whole), "fold-rates", "feature")
    row_fold = F.when(in_train, fold).otherwise(F.lit(HELD_OUT_FOLD))
    return apply_by_fold(features, by_fold, rate.scalar(), row_fold, columns), encodings, rate
