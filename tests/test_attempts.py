"""A member that is copied by two attempts: one whole file and one row are left."""

import subprocess
import sys
import zipfile
from pathlib import Path

from lakeops.sources import archives

SCRIPT = """
import sys, time
sys.path.insert(0, {repo!r})
from pyspark import TaskContext
from pyspark.sql import SparkSession
from lakeops.sources import archives, delimited

# two tries for a task, and a second one beside any that is slow
spark = (SparkSession.builder.master("local[3,3]").config("spark.ui.enabled", "false").config("spark.checkpoint.dir", {shared!r})
    .config("spark.sql.shuffle.partitions", "2").getOrCreate())

def copy(archive, member, target):
    if TaskContext.get().attemptNumber() == 0:
        with archives._open(archives.member_folder(target, archive, member) + "/a0-half.csv", "w") as sink:
            sink.write(b"k\\n99")  # an attempt that dies half way
        if member.endswith("1.csv"):
            archives.copy_member(archive, member, target)  # or after it was done, before its row was committed
        raise OSError("executor lost")
    return archives.copy_member(archive, member, target)

listing = archives.unpack_archives(spark, [{archive!r}], {target!r}, copy=copy)
rows = listing.collect()
values = delimited.read_raw_csv(spark, [r.path for r in rows]).collect()
print("ROWS", len(rows), sorted(v.k for v in values), listing.collect() == rows)
spark.stop()
"""


def test_failed_attempts_leave_nothing(tmp_path):
    archive = tmp_path / "in.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for i in range(4):
            z.writestr(f"{i}.csv", f"k\n{i}\n")
    target = tmp_path / "out"
    script = SCRIPT.format(repo=str(Path(__file__).resolve().parents[1]), shared=str(tmp_path / "shared"), archive=str(archive), target=str(target))
    done = subprocess.run([sys.executable, "-c", script], capture_output=True, text=True, timeout=200)
    assert "ROWS 4 ['0', '1', '2', '3'] True" in done.stdout, done.stderr[-2000:]
    assert len([f for f in target.rglob("*") if f.is_file()]) == 4


def test_two_attempts_at_once_write_two_files(tmp_path):
    archive = tmp_path / "in.zip"
    with zipfile.ZipFile(archive, "w") as z:
        z.writestr("a b.csv", "k\n1\n")
    (first, n), (second, m) = (archives.copy_member(str(archive), "a b.csv", str(tmp_path / "out")) for _ in range(2))
    assert first != second and n == m == 4 and Path(first).read_text() == Path(second).read_text() == "k\n1\n"
    assert archives.remove_others(second) == 1
    assert not Path(first).exists() and Path(second).exists()
