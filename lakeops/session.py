"""Session helper used by the bench, the jobs and the tests."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def get_spark(app_name: str = "lakeops", master: str | None = None, **conf: str) -> SparkSession:
    """Get or create a session in UTC with adaptive execution; ``conf`` entries win."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    settings.update(conf)
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
        settings.setdefault("spark.driver.memory", os.environ.get("LAKEOPS_DRIVER_MEMORY", "12g"))
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def pin_semantics(spark: SparkSession) -> SparkSession:
    """Fix the runtime settings that results depend on: UTC timestamps and ANSI errors."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.ansi.enabled", "true")
    return spark
