"""Unpacking ZIP archives in parallel, one archive member per task.

A task may run twice: again after a lost executor, or beside a slow one. So no two attempts write the same file: each has its own name. Which attempt
counts is decided where Spark decides it for every table, when the listing of the unpacked files is written and its tasks commit; readers go by
the listing. Files of other attempts are removed afterwards.
"""

from __future__ import annotations

import hashlib
import posixpath
import re
import uuid
from collections.abc import Callable, Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.sources.staging import stage

CHUNK_BYTES = 16 * 1024 * 1024
_LISTED = "archive string, member string, status string"
_COPIED = "archive string, member string, path string, bytes bigint, status string"


def _filesystem(path: str):
    """The file system of a path, of those pyarrow knows (local, hdfs, s3, ...), and the path in it."""
    from pyarrow import fs

    if path.startswith("file:"):
        path = "/" + path.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def _open(path: str, mode: str):
    filesystem, inner = _filesystem(path)
    if mode == "r":
        return filesystem.open_input_file(inner)
    filesystem.create_dir(posixpath.dirname(inner), recursive=True)
    return filesystem.open_output_stream(inner)


def member_folder(target: str, archive: str, member: str) -> str:
    """The folder of a member's attempts, kept apart from others by a digest of its origin."""
    digest = hashlib.sha256(f"{archive}\n{member}".encode()).hexdigest()[:16]
    return f"{target.rstrip('/')}/{digest}"


def copy_member(archive: str, member: str, target: str) -> tuple[str, int]:
    """Copy one member to a file that no other attempt has; its path and size. Nothing but a returned path says that a file is whole."""
    import shutil
    import zipfile

    name = re.sub(r"[^A-Za-z0-9.-]+", "-", posixpath.basename(member))
    path = f"{member_folder(target, archive, member)}/a{uuid.uuid4().hex}-{name}"
    with _open(archive, "r") as source, zipfile.ZipFile(source) as packed:
        with packed.open(member) as data, _open(path, "w") as sink:
            shutil.copyfileobj(data, sink, length=CHUNK_BYTES)
        return path, packed.getinfo(member).file_size


def remove_others(path: str) -> int:
    """Remove what other attempts left beside a committed file; how many files."""
    from pyarrow import fs

    filesystem, inner = _filesystem(path)
    beside = filesystem.get_file_info(fs.FileSelector(posixpath.dirname(inner), allow_not_found=True))
    others = [f.path for f in beside if f.is_file and posixpath.basename(f.path) != posixpath.basename(inner)]
    for other in others:
        filesystem.delete_file(other)
    return len(others)


def list_members(archives: DataFrame, members: str = "all") -> DataFrame:
    """``(archive, member, status)`` of the delimited members of every archive path.

    ``members`` is ``all``, or ``first`` (by position in the archive), which lists the others as ``skipped``. An archive that cannot be used
    gives one row saying why: ``missing``, ``empty``, ``not a zip`` or ``no csv member``.
    """
    if members not in ("first", "all"):
        raise ValueError("members must be 'first' or 'all'")

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import zipfile

        for batch in batches:
            out = []
            for path in batch["archive"]:
                try:
                    with _open(path, "r") as source:
                        if source.size() == 0:
                            out.append((path, None, "empty"))
                            continue
                        names = zipfile.ZipFile(source).namelist()
                except FileNotFoundError:
                    out.append((path, None, "missing"))
                    continue
                except (zipfile.BadZipFile, ValueError):  # ValueError: too short to look for the directory
                    out.append((path, None, "not a zip"))
                    continue
                found = [n for n in names if n.lower().endswith(".csv")]
                last = 1 if members == "first" else len(found)
                out += [(path, n, "ok" if k < last else "skipped") for k, n in enumerate(found)] or [(path, None, "no csv member")]
            yield pd.DataFrame(out, columns=["archive", "member", "status"])

    return archives.select("archive").mapInPandas(rows, _LISTED)


def unpack_archives(
    spark: SparkSession,
    archives: Iterable[str] | DataFrame,
    target: str,
    members: str = "all",
    parallelism: int | None = None,
    copy: Callable[[str, str, str], tuple[str, int]] = copy_member,
) -> DataFrame:
    """Copy archive members to ``target``; ``(archive, member, path, bytes, status)`` per member, as a written table.

    A member cannot be split, so the unit of work is one member, streamed in 16 MB chunks: no
    task holds more than a chunk. Read the paths of the listing, not the folder: an attempt that is still running
    may leave a file there that no listing names.
    """
    if not isinstance(archives, DataFrame):
        archives = spark.createDataFrame([(a,) for a in archives], "archive string")
    slots = parallelism or spark.sparkContext.defaultParallelism
    listed = list_members(archives.repartition(slots, "archive"), members)
    listed = listed.repartition(slots, F.col("archive"), F.col("member"))

    def copied(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for archive, member, status in batch[["archive", "member", "status"]].itertuples(index=False):
                if status != "ok":
                    out.append((archive, member if status == "skipped" else None, None, None, status))
                    continue
                out.append((archive, member, *copy(archive, member, target), status))
            frame = pd.DataFrame(out, columns=["archive", "member", "path", "bytes", "status"])
            frame["bytes"] = frame["bytes"].astype("Int64")
            yield frame

    def swept(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"removed": [remove_others(path) for path in batch["path"]]})

    committed = stage(listed.mapInPandas(copied, _COPIED), "unpacked-files")
    stage(committed.where("status = 'ok'").select("path").mapInPandas(swept, "removed long"), "removed-attempts")
    return committed


def headers(files: DataFrame) -> DataFrame:
    """``(path, header)``: the names in the first record of every unpacked file, in order."""

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import csv
        import io

        for batch in batches:
            out = []
            for path in batch["path"]:
                with _open(path, "r") as source:
                    lines = io.TextIOWrapper(source, encoding="utf-8-sig", newline="")
                    out.append((path, next(csv.reader(lines), [])))
            yield pd.DataFrame(out, columns=["path", "header"])

    return files.select("path").mapInPandas(rows, "path string, header array<string>")
