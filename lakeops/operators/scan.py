"""Running totals and dense ranks over a global order, without a single-task window."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeops.sources.staging import stage


def prefix_scan(
    df: DataFrame,
    order: Iterable[Column],
    sums: Mapping[str, Column | str],
    groups: Iterable[str] = (),
    totals: Mapping[str, str] | None = None,
) -> DataFrame:
    """Add inclusive running sums along ``order`` within ``groups``.

    ``sums`` maps a new column to the expression it accumulates; ``totals`` maps a new column to
    the key of ``sums`` whose group total it holds. The order must be total within a group.

    Rows are range-partitioned by (groups, order), so the partitions follow one another in the
    global order. They are written once with their partition number: the bounds are sampled per
    execution, so the two passes below must not compute them twice. Pass one sums each partition
    and accumulates these sums over the partition numbers (at most one row per partition and
    group); pass two adds them to running sums inside each partition. No task ever sees more than
    one partition of rows. The offsets are written too, so that their file size tells the
    optimizer whether they may be broadcast.
    """
    groups, order = list(groups), list(order)
    totals = dict(totals or {})
    parts = (
        df.withColumns({f"_v_{k}": F.col(v) if isinstance(v, str) else v for k, v in sums.items()})
        .repartitionByRange(*[F.col(g) for g in groups], *order)
        .withColumn("_part", F.spark_partition_id())
    )
    held = stage(parts, "scan")

    before = Window.partitionBy(*groups).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*groups)
    offsets = held.groupBy(*groups, "_part").agg(*[F.sum(f"_v_{k}").alias(f"_s_{k}") for k in sums])
    offsets = offsets.select(
        *[F.col(g).alias(f"_g_{g}") for g in groups],
        F.col("_part").alias("_p"),
        *[F.sum(f"_s_{k}").over(before).alias(f"_o_{k}") for k in sums],
        *[F.sum(f"_s_{k}").over(whole).alias(name) for name, k in totals.items()],
    )
    offsets = stage(offsets, "scan-offsets")

    inside = (
        Window.partitionBy(*groups, "_part")
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    running = held.withColumns({f"_r_{k}": F.sum(f"_v_{k}").over(inside) for k in sums})
    same_part = F.col("_part") == F.col("_p")
    for g in groups:
        same_part = same_part & F.col(g).eqNullSafe(F.col(f"_g_{g}"))
    return running.join(offsets, same_part, "left").select(
        *df.columns,
        *[(F.col(f"_r_{k}") + F.coalesce(F.col(f"_o_{k}"), F.lit(0))).alias(k) for k in sums],
        *totals,
    )


_PLACE_BITS = 33  # of monotonically_increasing_id: the partition above, the place in it below


def ordered_parts(df: DataFrame, order: Iterable[Column]) -> DataFrame:
    """Rows in global order with ``_part`` and their place in it, ``_place``: one exchange, no window."""
    order = list(order)
    rows = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_id", F.monotonically_increasing_id())
    return rows.withColumns({"_part": F.shiftright("_id", _PLACE_BITS), "_place": F.col("_id").bitwiseAND((1 << _PLACE_BITS) - 1)}).drop("_id")


def ordered_rank(df: DataFrame, order: Iterable[Column], name: str, groups: Iterable[str] = (), size: str | None = None) -> DataFrame:
    """Add the rank 1..N along a total order within ``groups``, and optionally the ``size`` of the group.

    Unlike other sums, the running count needs no second exchange of the rows: a row's place in its range partition is known when it is
    sorted there, and is written with it. What is added to it derives from the rows per partition and group.
    """
    groups = list(groups)
    held = stage(ordered_parts(df, [*(F.col(g) for g in groups), *order]), "ordered")
    counts = held.groupBy(*groups, "_part").agg(F.count("*").alias("_n"), F.min("_place").alias("_first"))
    whole = Window.partitionBy(*groups)
    before = whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        *[F.col(g).alias(f"_g_{g}") for g in groups],
        F.col("_part").alias("_p"),
        (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first") + 1).alias("_offset"),
        F.sum("_n").over(whole).alias("_size"),
    )
    offsets = stage(offsets, "ordered-offsets")
    same = F.col("_part") == F.col("_p")
    for g in groups:
        same = same & F.col(g).eqNullSafe(F.col(f"_g_{g}"))
    sized = [F.col("_size").alias(size)] if size else []
    return held.join(offsets, same, "left").select(*df.columns, (F.col("_place") + F.col("_offset")).alias(name), *sized)


def ordered_key(df: DataFrame, order: Iterable[Column], name: str) -> DataFrame:
    """Dense key 1..N along a total order of the rows."""
    ranked = ordered_rank(df, order, name)
    return ranked.withColumn(name, F.col(name).cast("int"))
