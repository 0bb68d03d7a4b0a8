"""Files in and out: delimited sources, archives, snapshots, gated publication."""

import zipfile

import pytest
from pyspark.sql import functions as F

from lakeops.operators.quality import ExpectationError, expect
from lakeops.sources import archives, delimited, staging, tables

TEXT = (
    "Complaint ID,Timely response?,Sub-product,Narrative\n"
    '1,Yes,,"said ""no"",\nthen left"\n'
    "2,No,\"\",plain\n"
    "3,No\n"
    "4,Yes,x,y,extra\n"
)


def test_raw_csv_is_text_with_quotes_line_breaks_and_ragged_rows(spark, tmp_path):
    (tmp_path / "a.csv").write_text(TEXT)
    df = delimited.normalise_columns(delimited.read_raw_csv(spark, str(tmp_path)))
    assert df.dtypes == [(c, "string") for c in ("complaint_id", "timely_response", "sub_product", "narrative")]
    assert [tuple(r) for r in df.orderBy("complaint_id").collect()] == [
        ("1", "Yes", None, 'said "no",\nthen left'),
        ("2", "No", None, "plain"),
        ("3", "No", None, None),
        ("4", "Yes", "x", "y"),
    ]


@pytest.mark.parametrize(
    "header, name",
    [("Timely response?", "timely_response"), (" ZIP code ", "zip_code"), ("A -- b", "a_b"), ("__x__", "x"), ("Q1 (%)", "q1")],
)
def test_normal_names(header, name):
    assert delimited.normal_name(header) == name


def test_clashing_headers_are_an_error(spark):
    with pytest.raises(ValueError, match="zip_code"):
        delimited.normalise_columns(spark.createDataFrame([("a", "b")], ["ZIP code", "zip-code"]))


def test_lineage_names_the_file_of_every_row(spark, tmp_path):
    for name in ("a.csv", "b.csv"):
        (tmp_path / name).write_text("k\n1\n")
    df = delimited.add_lineage(delimited.read_raw_csv(spark, str(tmp_path)), "2026-07-30")
    rows = df.collect()
    assert {r._source_csv_name for r in rows} == {"a.csv", "b.csv"}
    assert {str(r._ingestion_date) for r in rows} == {"2026-07-30"}
    assert all(r._source_zip_path.endswith(r._source_csv_name) for r in rows)


def test_landing_key():
    assert delimited.landing_key("2026-07-30", "records", "r.zip") == "raw/records/ingestion_date=2026-07-30/r.zip"
    with pytest.raises(ValueError):
        delimited.landing_key("30/07/2026", "records", "r.zip")


@pytest.fixture
def zips(tmp_path):
    with zipfile.ZipFile(tmp_path / "two.zip", "w") as z:
        z.writestr("readme.txt", "x")
        z.writestr("in/First.CSV", "k\n1\n")
        z.writestr("in/second.csv", "k\n2\n")
    with zipfile.ZipFile(tmp_path / "none.zip", "w") as z:
        z.writestr("readme.txt", "x")
    (tmp_path / "empty.zip").write_bytes(b"")
    (tmp_path / "text.zip").write_text("not an archive")
    return tmp_path


def unpack(spark, zips, members):
    names = ["two.zip", "none.zip", "empty.zip", "text.zip", "gone.zip"]
    paths = [str(zips / n) for n in names]
    target = str(zips / f"out-{members}")
    rows = archives.unpack_archives(spark, paths, target, members).collect()
    return rows, target


@pytest.mark.parametrize("members, expected", [("first", ["1"]), ("all", ["1", "2"])])
def test_unpack_members_and_name_unusable_archives(spark, zips, members, expected):
    rows, target = unpack(spark, zips, members)
    statuses = {r.archive.rsplit("/", 1)[1]: r.status for r in rows if r.status != "skipped"}
    assert [r.status for r in rows].count("skipped") == (1 if members == "first" else 0)
    assert statuses == {
        "two.zip": "ok", "none.zip": "no csv member", "empty.zip": "empty", "text.zip": "not a zip", "gone.zip": "missing",
    }
    assert all(r.bytes == 4 for r in rows if r.status == "ok")
    got = delimited.read_raw_csv(spark, f"{target}/*").collect()
    assert sorted(r.k for r in got) == expected


def test_snapshot_rerun_replaces_only_its_date(spark, tmp_path):
    path = str(tmp_path / "snap")

    def rows(day, values):
        return spark.createDataFrame([(v,) for v in values], "v int").withColumn("_ingestion_date", F.lit(day).cast("date"))

    tables.write_snapshot(rows("2026-01-01", [1, 2]), path)
    tables.write_snapshot(rows("2026-01-02", [3]), path)
    for _ in range(2):
        tables.write_snapshot(rows("2026-01-01", [9]), path)
    got = {(str(r._ingestion_date), r.v) for r in spark.read.parquet(path).collect()}
    assert got == {("2026-01-01", 9), ("2026-01-02", 3)}


def test_full_refresh_replaces_table_and_schema(spark):
    tables.ensure_schema(spark, "refresh_db", "it's a test")
    tables.write_full_refresh(spark.range(3), "refresh_db.t")
    tables.write_full_refresh(spark.range(2).select(F.lit("x").alias("name")), "refresh_db.t")
    assert tables.scan_table(spark, "refresh_db.t").columns == ["name"]
    assert tables.scan_table(spark, "refresh_db.t").count() == 2


def test_broken_rules_leave_the_published_version(spark, tmp_path):
    tables.ensure_schema(spark, "pub")
    gate = lambda w: expect(w, {"negative": F.col("id") < 0})
    tables.publish(spark.range(3), str(tmp_path / "t"), "pub.t", gate)
    with pytest.raises(ExpectationError, match="negative=1"):
        tables.publish(spark.range(-1, 2), str(tmp_path / "t"), "pub.t", gate)
    assert spark.table("pub.t").count() == 3
    tables.publish(spark.range(5).withColumn("more", F.lit(1)), str(tmp_path / "t"), "pub.t", gate)
    assert (spark.table("pub.t").count(), spark.table("pub.t").columns) == (5, ["id", "more"])


def test_staged_tables_go_to_the_shared_folder(spark):
    staged = staging.stage(spark.range(4), "probe")
    assert staged.count() == 4
    assert spark.conf.get("spark.checkpoint.dir") in staged.inputFiles()[0]
