"""Keeping one row per key."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _orderable(dtype: T.DataType) -> bool:
    if isinstance(dtype, T.ArrayType):
        return _orderable(dtype.elementType)
    if isinstance(dtype, T.StructType):
        return all(_orderable(f.dataType) for f in dtype.fields)
    return not isinstance(dtype, (T.MapType, T.VariantType))


def dedupe_latest(df: DataFrame, keys: Iterable[str], latest: Iterable[str]) -> DataFrame:
    """The row of every key that is largest by the columns ``latest``, nulls smallest.

    All other comparable columns follow as the last part of the comparison, so ties have one
    winner whatever the row order or partitioning. The row is the maximum of a struct: a map task keeps
    one row per key before the shuffle, so a key with any number of copies sends at most one row
    per task, and rows are sorted by the key alone, not by the whole order as a window would.
    """
    keys, latest = list(keys), list(latest)
    types = {f.name: f.dataType for f in df.schema.fields}
    rest = [c for c in df.columns if c not in keys and c not in latest]
    compared = latest + [c for c in rest if _orderable(types[c])]
    carried = [c for c in rest if not _orderable(types[c])]
    order = F.struct(*[F.col(f"`{c}`") for c in compared])
    if carried:
        winner = F.max_by(F.struct(*[F.col(f"`{c}`") for c in compared + carried]), order)
    else:
        winner = F.max(order)
    kept = df.groupBy(*keys).agg(winner.alias("_row"))
    return kept.select(*[F.col(f"`{c}`") if c in keys else F.col("_row")[c].alias(c) for c in df.columns])
