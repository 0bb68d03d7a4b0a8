"""Raw delimited files: reading, column names and lineage."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops.sources.records import read_records

# How the delimited source is written.
CSV_OPTIONS = {
    "header": "true",
    "inferSchema": "false",
    "quote": '"',
    "escape": '"',
    "encoding": "UTF-8",
    "mode": "PERMISSIVE",
}


def read_raw_csv(
    spark: SparkSession,
    paths: str | Iterable[str],
    multiline: bool = True,
    schema: str | None = None,
    split: bool = False,
    file_column: str | None = None,
) -> DataFrame:
    """All-text rows of delimited files with a header.

    A quoted field may hold line breaks. Spark's own reader then gives a file to one task; ``split=True`` reads its byte ranges in
    parallel (``records.py``), for the same rows, at the price of a second pass over the text. ``multiline=False`` reads splits in parallel in one pass, for
    sources without embedded line breaks. Giving the ``schema`` saves the job that reads the header. ``file_column`` adds the path of a row's file.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    reader = spark.read.options(**CSV_OPTIONS).option("multiLine", str(multiline).lower())
    if schema:
        reader = reader.schema(schema)
    if split and multiline:
        columns = T.StructType.fromDDL(schema).names if schema else reader.csv(paths).columns
        return read_records(spark, paths, columns, CSV_OPTIONS, file_column)
    rows = reader.csv(paths)
    return rows.select("*", F.col("_metadata.file_path").alias(file_column)) if file_column else rows


def normal_name(header: str) -> str:
    """Lower case, runs of other characters than letters and digits as one underscore."""
    return "_".join(re.findall(r"[a-z0-9]+", header.lower()))


def normalise_columns(df: DataFrame, keep: Iterable[str] = ()) -> DataFrame:
    """Give every column, but for those to ``keep``, its normal name; two headers with the same one are an error."""
    kept = set(keep)
    names = [c if c in kept else normal_name(c) for c in df.columns]
    clashes = sorted(n for n, k in Counter(names).items() if k > 1 or not n)
    if clashes:
        raise ValueError(f"headers without a name of their own: {clashes}")
    return df.toDF(*names)


def add_lineage(
    df: DataFrame,
    ingestion_date: str,
    source_path: str | Column | None = None,
    source_name: str | Column | None = None,
) -> DataFrame:
    """Add the snapshot date, the ingestion time and the source of every row.

    Without ``source_path`` / ``source_name`` they are the path and name of the file a row was
    read from, so ``df`` must come from files then.
    """

    def source(value: str | Column | None, default: str) -> Column:
        if value is None:
            return F.col(default)
        return F.lit(value) if isinstance(value, str) else value

    return df.withColumns(
        {
            "_ingestion_date": F.lit(ingestion_date).cast("date"),
            "_ingested_at": F.current_timestamp(),
            "_source_zip_path": source(source_path, "_metadata.file_path"),
            "_source_csv_name": source(source_name, "_metadata.file_name"),
        }
    )


def landing_key(ingestion_date: str, dataset: str, file_name: str) -> str:
    """Landing path of a dated source file."""
    if not re.fullmatch(r"\d{4}-\d{2}-\d{2}", ingestion_date):
        raise ValueError(f"not an ISO date: {ingestion_date!r}")
    return f"raw/{dataset}/ingestion_date={ingestion_date}/{file_name}"
