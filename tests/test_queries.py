"""The registered queries: a sample of every group against its SQL, on the smallest given tables."""

import math
import os

import pytest

import __spark_entry__ as entry

DATA = "/root/testdata/sf0.001"
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")
SAMPLE = (
    "parse_timestamps", "null_blank_profile", "case_fragmentation", "duplicate_sample", "dedupe_latest", "silver_gate",
    "build_dim_product", "build_fact", "orphan_counts_missing_members", "feature_table", "correlation_matrix",
    "target_encode_oof", "stratified_halves", "binary_metrics", "reliability_bins", "score_requests", "unpack_archives",
)

given = pytest.mark.skipif(not os.path.isdir(DATA), reason="needs the given tables")


def test_every_checking_sql_belongs_to_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    unchecked = {q for q in set(entry.queries()) - set(entry.oracle_sql()) if q != "pipeline" and not q.startswith("op")}
    assert unchecked == set()


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return con


def rows(columns, data):
    place = sorted(range(len(columns)), key=lambda i: columns[i])

    def cell(v):
        return "nan" if isinstance(v, float) and math.isnan(v) else repr(v)

    return sorted(tuple(cell(r[i]) for i in place) for r in data)


@given
@pytest.mark.parametrize("name", SAMPLE)
def test_query_equals_its_sql(spark, duck, name):
    df = entry.queries()[name](spark, DATA)
    result = duck.execute(entry.oracle_sql()[name])
    columns = [c[0] for c in result.description]
    assert sorted(df.columns) == sorted(columns)
    assert rows(df.columns, df.collect()) == rows(columns, result.fetchall())


@given
def test_flagship_query_runs(spark):
    df = entry.entry(spark)
    assert df.columns == ["state", "complaint_count"] and df.count() == 25
