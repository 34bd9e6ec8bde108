"""Commits: which folders a table consists of, version by version.

The folders of a table are written once and never changed. A commit is a small
file ``<root>/<table>/_commits/<number>.json`` that names the folder of every
partition (of the whole table, where it has none), and the last batch of each
stream that is stored in it. Commits are numbered without gaps and a file is
created only where there is none, so of two writers that start from one version
one commits and the other gets ``CommitConflict``; that needs a file system
whose create-if-absent is atomic, as HDFS's is. The catalog follows: it is
brought to the last commit after it and, if a writer died between the two, by
the next writer.
"""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import asdict, dataclass, field
from urllib.parse import unquote

from pyspark.errors import PySparkException
from pyspark.sql import SparkSession

DEFAULT_PARTITION = "__HIVE_DEFAULT_PARTITION__"  # fixed value: folder name of a null partition


class CommitConflict(RuntimeError):
    """Another writer has committed since the version this one started from."""


@dataclass(frozen=True)
class TableState:
    """A version of a table: folders under its root by partition path, ``""`` where it has no partitions."""

    version: int
    folders: dict[str, str]
    batches: dict[str, int] = field(default_factory=dict)


def _hadoop(spark: SparkSession, path: str):
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), folder


def create_text(spark: SparkSession, path: str, text: str) -> bool:
    """Write a new small file; False if there is one already."""
    fs, file = _hadoop(spark, path)
    if fs.exists(file):
        return False
    try:
        out = fs.create(file, False)
    except Exception as e:  # the JVM's error for a file that came in between
        if "FileAlreadyExists" in str(e) or "already exists" in str(e):
            return False
        raise
    out.write(bytearray(text.encode()))
    out.close()
    return True


def read_text(spark: SparkSession, path: str) -> str:
    fs, file = _hadoop(spark, path)
    stream = fs.open(file)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def names_in(spark: SparkSession, path: str) -> list[str]:
    """Names of the files and folders in a folder, in order; none where it does not exist."""
    fs, folder = _hadoop(spark, path)
    if not fs.exists(folder):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(folder))


def partition_folders(spark: SparkSession, path: str, depth: int) -> list[str]:
    """Partition paths such as ``a=1/b=2`` that a partitioned write has left under a folder."""
    found = [""]
    for _ in range(depth):
        found = [f"{p}/{n}".lstrip("/") for p in found for n in names_in(spark, f"{path}/{p}".rstrip("/")) if "=" in n]
    return found


def partition_values(label: str) -> list[tuple[str, str | None]]:
    """Column and value text of each level of a partition path; None for null."""
    pairs = [level.split("=", 1) for level in label.split("/")]
    return [(unquote(k), None if v == DEFAULT_PARTITION else unquote(v)) for k, v in pairs]


def _commits(root: str) -> str:
    return f"{root}/_commits"


def numbers(spark: SparkSession, root: str) -> list[int]:
    names = names_in(spark, _commits(root))
    return [int(n.removesuffix(".json")) for n in names if n.endswith(".json") and n[:-5].isdigit()]


def read_commit(spark: SparkSession, root: str, number: int) -> TableState | None:
    """A commit, or None if its writer died while writing it."""
    try:
        return TableState(**json.loads(read_text(spark, f"{_commits(root)}/{number:012d}.json")))
    except (ValueError, TypeError, PySparkException):
        return None


def last_commit(spark: SparkSession, root: str) -> tuple[TableState | None, int]:
    """The last whole commit, and the number that the next one will have."""
    found = numbers(spark, root)
    for number in reversed(found):
        state = read_commit(spark, root, number)
        if state is not None:
            return state, found[-1] + 1
    return None, found[-1] + 1 if found else 0


def write_commit(spark: SparkSession, root: str, number: int, state: TableState) -> None:
    """Commit a state under the number that its writer expects to be next."""
    if not create_text(spark, f"{_commits(root)}/{number:012d}.json", json.dumps(asdict(state))):
        raise CommitConflict(f"{root}: version {number} was written by another writer")


def remove_commit(spark: SparkSession, root: str, number: int) -> None:
    fs, file = _hadoop(spark, f"{_commits(root)}/{number:012d}.json")
    fs.delete(file, False)


def remove_folder(spark: SparkSession, path: str) -> bool:
    fs, folder = _hadoop(spark, path)
    return fs.delete(folder, True)


def stream_tag(batch: tuple[str, int] | None, state: TableState) -> Mapping[str, int]:
    """The batches of a state with one more stored."""
    return state.batches if batch is None else {**state.batches, batch[0]: batch[1]}
