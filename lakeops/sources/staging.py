"""Intermediate tables in the cluster's shared folder.

An intermediate result that several steps read, or whose partition layout must not change
between two passes, is written once as Parquet under ``spark.checkpoint.dir``. Unlike a cached
or checkpointed RDD it keeps columnar pruning, filter pushdown and file-size statistics (which
is what lets the optimizer decide for or against a broadcast join), and it survives the loss of
any executor.
"""

from __future__ import annotations

import contextlib
import contextvars
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

_local_default: dict[str, str] = {}
#: The paths handed out in the innermost ``tidied`` block of this thread.
_made: contextvars.ContextVar[list[str] | None] = contextvars.ContextVar("made", default=None)


def shared_dir(spark: SparkSession) -> str:
    """The shared scratch folder of this application.

    Taken from ``spark.checkpoint.dir``. Only a local session without that setting gets a
    temporary folder of its own; on a cluster a missing setting is an error, because a
    machine-local folder would not be visible to the other machines.
    """
    app = spark.sparkContext.applicationId
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = _local_default.get(app)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        base = _local_default.setdefault(app, tempfile.mkdtemp(prefix="lakeops-"))
    return f"{base.rstrip('/')}/lakeops/{app}"


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no other step has used."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    if (made := _made.get()) is not None:
        made.append(path)
    return path


@contextlib.contextmanager
def tidied(spark: SparkSession) -> Iterator[None]:
    """Remove on leaving, also by an error, what the block wrote to fresh paths; its results must not read from there."""
    made: list[str] = []
    token = _made.set(made)
    try:
        yield
    finally:
        _made.reset(token)
        for path in made:
            target = spark._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def stage(df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder and return the written table.

    ``partition_by`` makes one directory per value of a column with few values; a reader of one
    value then knows the size of just that part.
    """
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.parquet(path, partitionBy=partition_by)
    return spark.read.schema(df.schema).parquet(path).select(*df.columns)


@contextlib.contextmanager
def split_at(spark: SparkSession, size: str) -> Iterator[None]:
    """Within the block, tasks that read files get at most so many bytes each, or the session's limit if that is less."""
    name = "spark.sql.files.maxPartitionBytes"
    before, wanted = (int(spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(x)) for x in (spark.conf.get(name), size))
    was = spark.conf.get(name)
    spark.conf.set(name, str(min(before, wanted)))
    try:
        yield
    finally:
        spark.conf.set(name, was)
