"""What keeps the layers' shuffles and sorts in proportion to their rows."""

import datetime

import pytest
from pyspark.sql import functions as F

from lakeops.plans import fixtures, layers
from lakeops.queries import storage
from lakeops.sources.staging import split_at


@pytest.fixture(scope="module")
def given(spark, tmp_path_factory):
    """Tables of 400 orders of three lines, whose parts, suppliers and customers lie apart."""
    root = tmp_path_factory.mktemp("given")
    day = F.lit(datetime.datetime(2024, 1, 31))
    orders = spark.range(400).select(
        F.col("id").alias("o_orderkey"), (F.col("id") % 37).alias("o_custkey"), day.alias("o_orderdate"), F.lit("1-URGENT").alias("o_orderpriority")
    )
    lines = spark.range(1200).select(
        (F.col("id") % 400).alias("l_orderkey"), (F.col("id") / 400).cast("int").alias("l_linenumber"), (F.col("id") % 23).alias("l_partkey"),
        (F.col("id") % 11).alias("l_suppkey"), F.lit(1.5).alias("l_extendedprice"), F.lit("R").alias("l_returnflag"), day.alias("l_shipdate"),
    )
    tables = {
        "orders": orders,
        "lineitem": lines,
        "customer": spark.range(37).select(F.col("id").alias("c_custkey"), F.lit(0).alias("c_nationkey"), F.lit("BUILDING").alias("c_mktsegment")),
        "nation": spark.range(1).select(F.col("id").cast("int").alias("n_nationkey"), F.lit("PERU").alias("n_name")),
        "part": spark.range(23).select(F.col("id").alias("p_partkey"), F.lit("b").alias("p_brand"), F.lit("t").alias("p_type"), F.lit("n").alias("p_name")),
        "supplier": spark.range(11).select(F.col("id").alias("s_suppkey"), F.lit("s").alias("s_name")),
    }
    for name, df in tables.items():
        df.coalesce(1).write.parquet(f"{root}/{name}.parquet")
    return str(root)


@pytest.fixture
def no_broadcast(spark):
    names = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "16"}
    before = {n: spark.conf.get(n) for n in names}
    for n, v in names.items():
        spark.conf.set(n, v)
    yield
    for n, v in before.items():
        spark.conf.set(n, v)


def test_raw_rows_of_an_order_lie_together_in_as_many_parts_as_the_session_has(spark, given, no_broadcast):
    held = fixtures.complaints_raw(spark, given).select("_ln", "_pk", "complaint_id", F.spark_partition_id().alias("part")).where("trim(complaint_id) != ''").collect()
    ids = {r["complaint_id"] for r in held}
    assert len({(r["complaint_id"], r["part"]) for r in held}) == len(ids)
    assert len({r["part"] for r in held}) > 8  # a fixed number of eight before


def test_raw_rows_are_those_of_the_join_as_it_is_written(spark, given):
    written = spark.sql(fixtures.RAW_SQL, **{n: spark.read.parquet(f"{given}/{n}.parquet") for n in fixtures.TABLES})
    made = fixtures.complaints_raw(spark, given)
    assert made.schema == written.schema
    assert made.exceptAll(written).isEmpty() and written.exceptAll(made).isEmpty() and made.count() == 1200


def test_silver_is_sorted_in_small_tasks(spark, given, monkeypatch):
    whole = layers.Layers(spark, given)
    seen, wanted = [], layers.stage
    monkeypatch.setattr(layers, "stage", lambda df, name, *more: (seen.append((name, spark.conf.get("spark.sql.files.maxPartitionBytes"))), wanted(df, name, *more))[1])
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    assert whole.silver.count() == len({r[0] for r in whole.silver.select("complaint_id").collect()})
    assert dict(seen)["silver"] == str(16 << 20)
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == before


def test_split_at_keeps_a_smaller_limit_and_restores_it(spark):
    name = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(name)
    spark.conf.set(name, "1m")
    try:
        with pytest.raises(KeyError), split_at(spark, "2m"):
            assert spark.conf.get(name) == str(1 << 20)
            raise KeyError
        assert spark.conf.get(name) == "1m"
    finally:
        spark.conf.set(name, before)


def test_split_csv_reads_more_rows_in_more_files_and_no_more_ranges(spark, given, monkeypatch):
    """Ranges of a fixed 128 KB made their number grow with the rows, and one task wrote them all."""
    found = layers.Layers(spark, given)
    whole = storage._split_csv(found).count()
    sizes, files = [], []
    monkeypatch.setattr(storage, "FILE_ROWS", 300)
    monkeypatch.setattr(storage, "LEAST_RANGE", 1024)
    monkeypatch.setattr(storage, "RANGES", 4)
    limit, read = storage.split_at, storage.delimited.read_raw_csv
    monkeypatch.setattr(storage, "split_at", lambda s, size: (sizes.append(int(size)), limit(s, size))[1])
    monkeypatch.setattr(storage.delimited, "read_raw_csv", lambda s, path, **k: (files.append(s.read.text(path).inputFiles()), read(s, path, **k))[1])
    monkeypatch.setattr(storage, "_source_rows", lambda L, rows=storage._source_rows: rows(L).repartition(8))
    assert storage._split_csv(found).count() == whole == 1200
    assert sizes[0] > 1024 and len(files[0]) == 4
