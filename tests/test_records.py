"""One file with line breaks in its fields, read by many tasks, against the reader that takes a file whole."""

import random

import pytest
from pyspark.sql import functions as F

from lakeops.sources import delimited, records

HEAD = "a,b,c"


@pytest.fixture
def ranges_of(spark):
    """Sets the bytes of a range for a test."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {n: spark.conf.get(n) for n in names}

    def use(size):
        spark.conf.set(names[0], str(size))
        spark.conf.set(names[1], "0")

    yield use
    for n, v in before.items():
        spark.conf.set(n, v)


def both(spark, path):
    split = delimited.read_raw_csv(spark, str(path), split=True)
    whole = delimited.read_raw_csv(spark, str(path))
    assert split.dtypes == whole.dtypes
    return sorted(map(str, split.collect())), sorted(map(str, whole.collect()))


def messy(seed, eol):
    """Records with quotes, breaks and delimiters inside fields, some of the wrong number of fields."""
    r = random.Random(seed)

    def field():
        kind = r.random()
        if kind < 0.3:
            return "".join(r.choice("ab ç") for _ in range(r.randint(0, 6)))
        if kind < 0.4:
            return r.choice(['x"', 'a"b', '5" p', 'p""q', ' "z"', ""])
        return '"' + "".join(r.choice(["a", "b,", '""', eol, eol * 2, " ", "ccccccc"]) for _ in range(r.randint(0, r.choice([3, 8, 60])))) + '"'

    lines = [HEAD, *(",".join(field() for _ in range(r.choice([3, 3, 3, 2, 4]))) for _ in range(60)), "", "   "]
    return eol.join(lines) + (eol if seed % 2 else "")


@pytest.mark.parametrize("size", [97, 400, 5000])
@pytest.mark.parametrize("eol", ["\n", "\r\n"])
def test_messy_files_in_ranges_of_any_size(spark, tmp_path, ranges_of, size, eol):
    for seed in range(2):
        (tmp_path / f"{seed}.csv").write_bytes(("﻿" * seed + messy(seed, eol)).encode())
    ranges_of(size)
    assert records.lines_of(spark, [str(tmp_path)], ",", '"', False).rdd.getNumPartitions() >= min(10, 8000 // size)
    split, whole = both(spark, tmp_path)
    assert split == whole and len(whole) > 50


def test_breaks_at_every_place_of_a_range_edge(spark, tmp_path, ranges_of):
    """A field of line breaks longer than several ranges, shifted by one byte from file to file, and records that end at an edge."""
    for shift in range(0, 40, 3):
        (tmp_path / f"{shift}.csv").write_text(f'{HEAD}\n{"x" * shift},"1\n""2""\n{"long " * 60}\n\n3",z\n4,"5\n",6\n7,8,9\n')
    ranges_of(90)
    split, whole = both(spark, tmp_path)
    assert split == whole and len(whole) == 3 * 14


def test_header_over_several_ranges(spark, tmp_path, ranges_of):
    (tmp_path / "a.csv").write_text('a,"b\n' + "name " * 60 + '\nend",c\n1,"2\n2",3\n4,5,6\n')
    ranges_of(64)
    split, whole = both(spark, tmp_path)
    assert split == whole and len(whole) == 2


@pytest.mark.parametrize("text", ["", HEAD, f"{HEAD}\n", f"{HEAD}\n\n\n", f'{HEAD}\n1,"open\nto the end,2'])
def test_small_and_unfinished_files(spark, tmp_path, text):
    (tmp_path / "a.csv").write_text(text)
    (tmp_path / "b.csv").write_text(f"{HEAD}\n1,2,3\n")
    schema = "a string, b string, c string"
    split = delimited.read_raw_csv(spark, str(tmp_path), schema=schema, split=True).collect()
    assert sorted(map(str, split)) == sorted(map(str, delimited.read_raw_csv(spark, str(tmp_path), schema=schema).collect()))


def test_file_of_every_row(spark, tmp_path, ranges_of):
    for name in ("a", "b"):
        (tmp_path / f"{name}.csv").write_text(f"{HEAD}\n" + f'{name},"x\n{"y" * 50}\n",{name}\n' * 30)
    ranges_of(200)
    rows = delimited.read_raw_csv(spark, str(tmp_path), split=True, file_column="_file").collect()
    assert len(rows) == 60 and all(r["_file"].endswith(f"/{r['a']}.csv") for r in rows)


def test_no_row_is_shuffled(spark, tmp_path, ranges_of):
    """Only what lies at range edges is grouped; the rows themselves stay with the task that read them."""
    (tmp_path / "a.csv").write_text(f"{HEAD}\n" + '1,"x\ny",3\n' * 500)
    ranges_of(500)
    rows = records.read_records(spark, str(tmp_path), ["a", "b", "c"], delimited.CSV_OPTIONS)
    plan = rows._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    scan = plan.index("FileScan text")
    within = plan[:scan].rsplit("\n:", 1)[0] if "\n:" in plan[:scan] else plan[:scan]
    assert "Exchange" not in within.split("Union")[-1] and rows.count() == 500


def test_other_quoting_is_refused(spark, tmp_path):
    with pytest.raises(ValueError, match="doubled quote"):
        records.read_records(spark, str(tmp_path), ["a"], {"quote": '"', "escape": "\\"})


def test_end_of_line_from_both_starts(spark):
    cases = {
        "": (0, 1), "a,b": (0, 1), '"a",b': (0, 0), 'a,"b': (1, 0), '"': (1, 0), '""': (0, 1), '"""': (1, 0), 'a"b': (0, 0), 'x" y",z': (0, 0),
        '",': (1, 0), '","': (0, 1), 'a,""': (0, 1), 'end",more': (0, 0), '"",""': (0, 1),
    }
    lines = spark.createDataFrame([(c,) for c in cases], "line string")
    found = lines.select("line", *[records.ends_quoted(F.col("line"), s, ",", '"') for s in (records._FIELD, records._QUOTED)]).collect()
    assert {r[0]: (r[1], r[2]) for r in found} == cases
