"""The jobs: land, clean, model as a star, derive features, train.

Every job writes first, gates what it wrote, and then makes it visible: a broken rule leaves the
published tables as they were. Tables that belong together, the star and the reports of a training, are switched as one by a manifest
(``lake.star``, ``lake.reports``). What a job staged is removed when it ends, also by an error. Tables live under ``root`` and are published as views of
``schema``.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.operators import models, quality, serving
from lakeops.operators.features import feature_table
from lakeops.operators.star import build_fact, denormalise
from lakeops.plans import training
from lakeops.plans.layers import dimensions, silver_layer
from lakeops.sources import archives, delimited, tables
from lakeops.sources.staging import fresh_path, stage, tidied


_FILE = "_file"


@dataclass(frozen=True)
class Lake:
    spark: SparkSession
    root: str
    schema: str = "lake"

    def path(self, table: str) -> str:
        return f"{self.root.rstrip('/')}/{table}"

    def view(self, table: str) -> str:
        return f"{self.schema}.{table}"

    def read(self, table: str) -> DataFrame:
        return quality.require_table(self.spark, self.view(table))

    def publish(self, name: str, versions: Mapping[str, str]) -> tables.TableSet:
        """Switch the versions of a set of tables as one."""
        views = {table: self.view(table) for table in versions}
        return tables.publish_set(self.spark, self.path(name), self.view(name), versions, views)

    def pin(self, name: str) -> tables.TableSet:
        """A published set as it is now, whatever is published later."""
        quality.require_table(self.spark, self.view(name))
        return tables.pinned_set(self.spark, self.view(name))


def _tidy(job: Callable) -> Callable:
    @functools.wraps(job)
    def run(lake: Lake, *args, **kwargs):
        with tidied(lake.spark):
            return job(lake, *args, **kwargs)

    return run


@_tidy
def bronze_job(
    lake: Lake,
    sources: Iterable[str] | DataFrame,
    ingestion_date: str,
    members: str = "all",
    multiline: bool = True,
) -> DataFrame:
    """Unpack archives, read their rows as text and replace the snapshot of ``ingestion_date``.

    Files are read header by header and their columns matched by name, so neither another order nor another set of
    columns moves values; what a file lacks is null. ``members="first"`` accepts that further members of an archive are skipped.
    """
    spark = lake.spark
    tables.ensure_schema(spark, lake.schema)
    folder = fresh_path(spark, "unpacked")
    files = archives.unpack_archives(spark, sources, folder, members)
    accepted = ("ok", "skipped") if members == "first" else ("ok",)
    quality.enforce(quality.expect(files, {"unusable_archive": ~F.col("status").isin(*accepted)}))

    files = files.filter(F.col("status") == "ok")
    groups: dict[tuple, list[str]] = {}
    for path, header in archives.headers(files).collect():  # a row per file; the reader needs the paths by name anyway
        groups.setdefault(tuple(header), []).append(path)
    read = []
    for _, paths in sorted(groups.items()):
        rows = delimited.read_raw_csv(spark, paths, multiline, split=True, file_column=_FILE)
        rows = delimited.add_lineage(delimited.normalise_columns(rows, [_FILE]), ingestion_date, F.col(_FILE), F.lit(None).cast("string"))
        read.append(rows.drop(_FILE))
    rows = functools.reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), read)

    def origin(path: str) -> Column:
        """The folder of an unpacked file, which stands for its member."""
        return F.substring_index(F.substring_index(path, "/", -2), "/", 1)

    archive_of = files.select(
        origin("path").alias("_origin"),
        F.col("archive").alias("_archive"),
        F.regexp_extract("member", "[^/]*$", 0).alias("_member"),
    )
    rows = (
        rows.withColumn("_origin", origin("_source_zip_path"))
        .join(archive_of, "_origin", "left")
        .withColumn("_source_zip_path", F.col("_archive"))
        .withColumn("_source_csv_name", F.col("_member"))
        .drop("_origin", "_archive", "_member")
    )
    snapshot = stage(rows, "snapshot")
    quality.enforce(quality.bronze_gate(snapshot))
    tables.write_snapshot(snapshot, lake.path("bronze"))
    tables.show_version(spark, lake.view("bronze"), lake.path("bronze"), merge=True)
    return lake.read("bronze")


@_tidy
def silver_job(lake: Lake) -> DataFrame:
    """Clean, type and deduplicate all snapshots."""
    bronze = lake.read("bronze")
    return tables.publish(
        silver_layer(bronze), lake.path("silver"), lake.view("silver"), lambda w: quality.silver_gate(w, bronze)
    )


@_tidy
def gold_job(lake: Lake) -> dict[str, DataFrame]:
    """Dimensions and fact; all five tables are switched as one after the gate over all of them.

    The fact is keyed from the written dimensions, so that both hold the same keys.
    """
    silver = lake.read("silver")
    paths, dims = {}, {}
    for name, dim in dimensions(silver).items():
        paths[f"dim_{name}"], dims[name] = tables.write_version(dim, lake.path(f"dim_{name}"))
    paths["fact"], fact = tables.write_version(
        build_fact(silver, dims), lake.path("fact"), lambda w: quality.gold_gate(w, silver, dims)
    )
    lake.publish("star", paths)
    return {**{f"dim_{n}": d for n, d in dims.items()}, "fact": fact}


@_tidy
def features_job(lake: Lake) -> DataFrame:
    """The labelled feature table, of one published star from the first read to the gate."""
    star = lake.pin("star")
    fact = star.table("fact")
    dims = {n: star.table(f"dim_{n}") for n in ("date", "product", "company", "state")}
    return tables.publish(
        feature_table(denormalise(fact, dims)),
        lake.path("features"),
        lake.view("features"),
        lambda w: quality.feature_gate(w, fact),
    )


@_tidy
def train_job(
    lake: Lake, names: Iterable[str] = (models.TREE, models.FOREST, models.BOOSTED), tuned: bool = False
) -> DataFrame:
    """Train, publish metrics and predictions, and promote the champion."""
    trained = training.train(training.encode(lake.read("features")), names, tuned)
    metrics_path, metrics = tables.write_version(trained.metrics, lake.path("model_metrics"))
    predictions_path, _ = tables.write_version(
        trained.predictions,
        lake.path("test_predictions"),
        lambda w: quality.monitoring_gate(metrics, w, [m.name for m in trained.models]),
    )
    lake.publish("reports", {"model_metrics": metrics_path, "test_predictions": predictions_path})
    return serving.promote_champion(
        lake.path("champion"),
        trained.models,
        metrics,
        trained.encoded.encodings,
        trained.encoded.rate,
        trained.selected,
    )
