"""The whole chain from archives to a promoted model, and a rerun of it."""

import os
import zipfile

import pytest
from pyspark.sql import functions as F

from lakeops.operators import models as M
from lakeops.operators.quality import ExpectationError
from lakeops.plans import jobs
from lakeops.sources import staging

HEADER = (
    "Date received,Product,Sub-product,Issue,Sub-issue,Consumer complaint narrative,Company,State,ZIP code,Tags,"
    "Submitted via,Date sent to company,Company response to consumer,Timely response?,Complaint ID\n"
)


def row(i, flag):
    return (
        f'{i % 12 + 1}/{i % 28 + 1}/2025,Product {i % 4},{"" if i % 3 else f"Sub {i % 5}"},Issue {i % 6},,'
        f'"told ""them""\nline {i}",Company {i % 9},{["ny", "CA", " tx ", ""][i % 4]},{10000 + i % 300},'
        f'{"Older American" if i % 6 == 0 else ""},Web,2025-0{i % 9 + 1}-11,Closed,{flag},{i}\n'
    )


def archive(path, ids, late):
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("rows.csv", HEADER + "".join(row(i, "No" if late(i) else "Yes") for i in ids))


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("lake")
    lake = jobs.Lake(spark, str(root), "chain")
    archive(root / "a.zip", range(0, 1500), lambda i: i % 9 == 2)
    archive(root / "b.zip", range(1000, 2400), lambda i: i % 9 == 2)
    jobs.bronze_job(lake, [str(root / "a.zip"), str(root / "b.zip")], "2026-01-01")
    jobs.silver_job(lake)
    jobs.gold_job(lake)
    jobs.features_job(lake)
    return lake


def test_layers_have_the_expected_grain(lake):
    assert lake.read("bronze").count() == 2900
    assert lake.read("silver").count() == 2400
    fact = lake.read("fact")
    assert fact.count() == 2400
    assert fact.filter("product_key = 0 OR received_date_key = 0").count() == 0
    origins = {r[0].rsplit("/", 1)[1] for r in lake.read("bronze").select("_source_zip_path").distinct().collect()}
    assert origins == {"a.zip", "b.zip"}


def test_missing_states_have_their_own_member(lake):
    states = {r.state: r.state_key for r in lake.read("dim_state").collect()}
    assert states == {"NOT_PROVIDED": 0, "CA": 1, None: 2, "NY": 3, "TX": 4}


def test_a_second_snapshot_wins_and_a_rerun_changes_nothing(spark, lake, tmp_path):
    archive(tmp_path / "c.zip", range(0, 50), lambda i: True)
    for _ in range(2):
        jobs.bronze_job(lake, [str(tmp_path / "c.zip")], "2026-01-02")
        jobs.silver_job(lake)
        assert lake.read("bronze").count() == 2950
        silver = lake.read("silver")
        assert silver.count() == 2400
        assert silver.filter("complaint_id < 50 AND timely_response = 'NO'").count() == 50


def test_an_unusable_archive_leaves_the_tables_alone(lake, tmp_path):
    (tmp_path / "bad.zip").write_text("no archive")
    before = lake.read("bronze").count()
    with pytest.raises(ExpectationError, match="unusable_archive=1"):
        jobs.bronze_job(lake, [str(tmp_path / "bad.zip")], "2026-01-03")
    assert lake.read("bronze").count() == before


def test_training_publishes_reports_and_a_champion(lake):
    pointer = jobs.train_job(lake, (M.TREE,)).first()
    assert pointer.model_name == M.TREE
    metrics = lake.read("model_metrics")
    assert {r.dataset_split for r in metrics.collect()} == {"VALIDATION", "TEST"}
    tests = lake.read("features").filter(F.col("dataset_split") == "TEST").count()
    assert lake.read("test_predictions").count() == tests


def test_headers_match_by_name_and_new_columns_stay(spark, tmp_path):
    lake = jobs.Lake(spark, str(tmp_path / "lake"), "landing")
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("in/a.csv", "Complaint ID,State,Product,Date received\n1,TX,Loan,1/2/2025\n")
        z.writestr("b.csv", "Complaint ID,Product,State,Date received\n2,Mortgage,CA,1/3/2025\n")
    with zipfile.ZipFile(tmp_path / "c.zip", "w") as z:
        z.writestr("c.csv", "Complaint ID,State,Product,Date received,Extra\n3,NY,Card,1/4/2025,new\n")
    try:
        jobs.bronze_job(lake, [str(tmp_path / "a.zip")], "2026-01-01")
        jobs.bronze_job(lake, [str(tmp_path / "c.zip")], "2026-01-02")
    except ExpectationError as broken:
        pytest.fail(str(broken))
    rows = lake.read("bronze").select("complaint_id", "state", "product", "_source_csv_name", "extra").collect()
    assert sorted(map(tuple, rows)) == [
        ("1", "TX", "Loan", "a.csv", None),
        ("2", "CA", "Mortgage", "b.csv", None),
        ("3", "NY", "Card", "c.csv", "new"),
    ]


def test_staged_data_is_removed_also_after_an_error(spark):
    with staging.tidied(spark):
        kept = staging.fresh_path(spark, "seen")
        spark.range(3).write.parquet(kept)
        assert spark.read.parquet(kept).count() == 3
    with pytest.raises(ValueError):
        with staging.tidied(spark):
            failed = staging.fresh_path(spark, "failed")
            spark.range(3).write.parquet(failed)
            raise ValueError
    assert not os.path.exists(kept) and not os.path.exists(failed)
