"""Scoring requests as they arrive."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from lakeops.operators.serving import score_with_champion


def score_stream(
    spark: SparkSession, source: str, champion_root: str, target: str, checkpoint: str, **trigger
) -> StreamingQuery:
    """Score every request file (one JSON body per line) that lands in ``source``.

    Scoring keeps no state, so there is nothing to bound by a watermark; the query's checkpoint
    records which files are done. The model is the one promoted when the query starts.
    """
    requests = spark.readStream.text(source)
    scored = score_with_champion(requests, champion_root)
    return (
        scored.writeStream.format("parquet")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
