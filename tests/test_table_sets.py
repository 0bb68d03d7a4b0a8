"""Tables that are switched as one: no reader ever sees parts of two publications."""

import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from lakeops.operators.quality import ExpectationError
from lakeops.plans import jobs
from lakeops.sources import tables

NAMES = ("fact", "dim_a", "dim_b")


@pytest.fixture
def lake(spark, tmp_path):
    lake = jobs.Lake(spark, str(tmp_path / "lake"), f"set_{tmp_path.name.replace('-', '_')}")
    tables.ensure_schema(spark, lake.schema)
    return lake


def write(lake, value, extra=None):
    """A version of each table whose rows all hold ``value``."""
    paths = {}
    for name in NAMES:
        df = lake.spark.range(3).withColumn("value", F.lit(value))
        if extra:
            df = df.withColumn(extra[0], F.lit(extra[1]))
        paths[name], _ = tables.write_version(df, lake.path(name))
    return paths


def seen(lake):
    return {name: {r["value"] for r in lake.read(name).collect()} for name in NAMES}


def whole(value):
    return {name: {value} for name in NAMES}


def test_one_switch_shows_all_tables(lake):
    for value in ("v1", "v2", "v3"):
        lake.publish("star", write(lake, value))
        assert seen(lake) == whole(value)


@pytest.mark.parametrize("extra", [None, ("more", 7)])
def test_an_error_at_any_step_leaves_one_whole_set(lake, monkeypatch, extra):
    """Every catalog operation and manifest fails once; readers see the old set before the switch and the new one after it."""
    lake.publish("star", write(lake, "old"))
    real_view, real_member, real_manifest = tables.show_version, tables._show_member, tables._write_manifest
    outcomes = []
    for fail_at in range(12):
        steps = iter(range(100))

        def step(real):
            def run(*args, **kwargs):
                if next(steps) == fail_at:
                    raise OSError("injected")
                return real(*args, **kwargs)

            return run

        monkeypatch.setattr(tables, "show_version", step(real_view))
        monkeypatch.setattr(tables, "_show_member", step(real_member))
        monkeypatch.setattr(tables, "_write_manifest", step(real_manifest))
        failed = False
        try:
            lake.publish("star", write(lake, f"new{fail_at}", extra))
        except OSError:
            failed = True
        for name, real in (("show_version", real_view), ("_show_member", real_member), ("_write_manifest", real_manifest)):
            monkeypatch.setattr(tables, name, real)
        found = seen(lake)
        values = set().union(*found.values())
        assert len(values) == 1, found
        if not failed:
            assert values == {f"new{fail_at}"}
            break
        outcomes.append(values.pop())
        lake.publish("star", write(lake, "old"))
    else:
        pytest.fail("the publication never ended")
    assert "old" in outcomes
    assert extra is None or any(o.startswith("new") for o in outcomes)  # narrowing comes after the switch


def test_columns_may_come_go_and_keep_their_place(lake):
    lake.publish("star", write(lake, "v1"))
    lake.publish("star", write(lake, "v2", ("more", 7)))
    assert lake.read("fact").columns == ["id", "value", "more"]
    lake.publish("star", write(lake, "v3"))
    assert lake.read("fact").columns == ["id", "value"] and seen(lake) == whole("v3")


def test_a_type_that_changes_is_refused_before_the_switch(lake):
    lake.publish("star", write(lake, "v1"))
    with pytest.raises(ValueError, match="value"):
        lake.publish("star", write(lake, 5))
    assert seen(lake) == whole("v1")


def test_a_pinned_set_stays(lake):
    lake.publish("star", write(lake, "v1"))
    pinned = lake.pin("star")
    lake.publish("star", write(lake, "v2", ("more", 7)))
    assert {n: {r["value"] for r in pinned.table(n).collect()} for n in NAMES} == whole("v1")
    pinned.register("pinned_")
    assert lake.spark.sql("SELECT DISTINCT f.value || a.value FROM pinned_fact f JOIN pinned_dim_a a USING (id)").first()[0] == "v1v1"


def test_other_versions_are_not_read(lake):
    for value in ("v1", "v2", "v3"):
        lake.publish("star", write(lake, value))
    rows = lake.spark.table(lake.view("fact"))
    assert "PartitionFilters: [" in plan_of(rows) and "version" in plan_of(rows).split("PartitionFilters: [")[1].split("]")[0]
    versions = rows.select(F.regexp_extract(F.input_file_name(), "version=([^/]*)", 1)).distinct().collect()
    assert [r[0] for r in versions] == [lake.pin("star").paths["fact"].rsplit("=", 1)[1]]


def test_nothing_published_is_an_error(lake):
    with pytest.raises(ExpectationError, match="star"):
        lake.pin("star")
    with pytest.raises(ExpectationError, match="fact"):
        lake.read("fact")
