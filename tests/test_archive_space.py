"""Source files, archives and unpacked files hold the same text; none stays beside the next."""

import os

import pytest
from pyspark.sql import functions as F

from lakeops.plans.layers import Layers
from lakeops.queries import storage
from lakeops.sources.staging import shared_dir


def held(spark, *endings):
    found = [os.path.join(at, f) for at, _, files in os.walk(shared_dir(spark)) for f in files if f.endswith(endings)]
    return set(found)


@pytest.fixture
def layers(spark, monkeypatch):
    rows = spark.range(60).select(F.col("id").cast("string").alias("complaint_id"), *[F.concat(F.lit(f"{c} "), "id").alias(c) for c in storage.RAW_COLUMNS[1:]],
                                  (F.col("id") % 4).cast("int").alias("_ln"), F.lit(2).alias("_pk"))
    monkeypatch.setattr("lakeops.plans.layers.complaints_raw", lambda spark, folder: rows)
    return Layers(spark, "nowhere")


def test_unpacked_files_alone_are_left(spark, layers):
    """The source and the archives stayed too."""
    before = held(spark, ".csv", ".zip")
    rows = storage._unpack(layers)
    left = held(spark, ".csv", ".zip") - before
    assert left and not [f for f in left if "/unpacked-" not in f]
    assert rows.count() == 60 and rows.select("complaint_id").distinct().count() == 60


def test_the_landing_chain_leaves_its_table(spark, layers):
    before = held(spark, ".csv", ".zip")
    rows = storage._bronze_chain(layers)
    assert held(spark, ".csv", ".zip") == before
    assert rows.where("origin_named").count() == 60 and rows.where("extra_note IS NOT NULL").count() == 30
