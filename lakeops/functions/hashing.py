"""Deterministic pseudo-random buckets: the same id gets the same bucket in every run,
whatever the row order or the partitioning."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lakeops.constants import SPLIT_BUCKETS, TEST, TRAIN, TRAIN_BELOW, VALIDATION, VALIDATION_BELOW


def hash_bucket(c: Column, buckets: int, salt: str = "", method: str = "xxhash64") -> Column:
    """Bucket number ``0 .. buckets-1``. ``md5`` is slower, but other engines can repeat it."""
    if method == "xxhash64":
        hashed = F.xxhash64(c, F.lit(salt)) if salt else F.xxhash64(c)
        return F.pmod(hashed, F.lit(buckets).cast("bigint"))
    if method == "md5":
        return F.conv(F.substring(md5_text(c, salt), 1, 8), 16, 10).cast("bigint") % buckets
    raise ValueError(f"unknown hash method {method!r}")


def md5_text(c: Column, salt: str = "") -> Column:
    text = c.cast("string")
    return F.md5(F.concat(F.lit(salt), text) if salt else text)


def split_of(bucket: Column) -> Column:
    """TRAIN / VALIDATION / TEST of a bucket in 0..99."""
    return (
        F.when(bucket < TRAIN_BELOW, F.lit(TRAIN))
        .when(bucket < VALIDATION_BELOW, F.lit(VALIDATION))
        .otherwise(F.lit(TEST))
    )


def hash_split(id_col: Column, method: str = "xxhash64") -> tuple[Column, Column]:
    """``(bucket, split)`` of an id."""
    bucket = hash_bucket(id_col, SPLIT_BUCKETS, method=method)
    return bucket, split_of(bucket)
