"""The commit log of a sharded table.

A logged table is a set of parts, folders that are written in full before a small file
named after them enters the log. Readers take the parts that the log names and nothing
else, so that a part shows on all shards at once or not at all. The name tells all a
reader needs; what the file holds (rows, content digest) is for checks.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterable
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

LOG = "_commits"
_NAME = re.compile(r"([^~/]*)~(\d+)~(\d+)~(\d+)~([^~/]*)\.json")


class CommitConflict(RuntimeError):
    """Another writer has committed in between."""


@dataclass(frozen=True, order=True)
class Commit:
    """A part of a table. Of a ``stream`` only the last ``generation`` counts, and in
    it the last ``attempt`` of each ``batch``. Parts that no stream wrote have no name."""

    stream: str
    generation: int
    batch: int
    attempt: int = 0
    writer: str = ""

    @property
    def file(self) -> str:
        return f"{self.stream}~{self.generation:06d}~{self.batch:012d}~{self.attempt:04d}~{self.writer}.json"

    @property
    def folder(self) -> str:
        """The part's folder below the table's, on every shard."""
        if not self.stream:
            return f"version={self.generation}.{self.batch}"
        return f"stream={self.stream}/batch={self.batch}/try={self.generation}.{self.attempt}"


#: Folder columns that name a part and no rows.
HIDDEN = ("version", "try")


def parse_commit(name: str) -> Commit | None:
    found = _NAME.fullmatch(name)
    if not found:
        return None
    stream, generation, batch, attempt, writer = found.groups()
    return Commit(stream, int(generation), int(batch), int(attempt), writer)


def current(commits: Iterable[Commit]) -> list[Commit]:
    """The parts that make up the table."""
    commits = sorted(commits)
    last = {c.stream: c.generation for c in commits}
    parts = {(c.stream, c.batch): c for c in commits if c.generation == last[c.stream]}
    return [parts[k] for k in sorted(parts)]


def list_names(spark: SparkSession, folder: str) -> list[str] | None:
    """Names in a folder, or None if there is no such folder."""
    path, files = _opened(spark, folder)
    jvm = spark._jvm
    try:
        if not files.exists(path):
            return None
    except Py4JJavaError as e:
        if "ParentNotDirectory" in e.java_exception.getClass().getName():
            return None  # below a file
        raise
    paths = jvm.org.apache.hadoop.fs.FileUtil.stat2Paths(files.listStatus(path))
    # one text for all names: asking for them one by one is slow
    text = jvm.org.apache.commons.lang3.ArrayUtils.toString(paths)[1:-1]
    return [p.rpartition("/")[2] for p in text.split(",")] if text else []


def read_log(spark: SparkSession, base: str) -> list[Commit] | None:
    """All commits of the table at ``base``; None if it isn't logged."""
    names = list_names(spark, f"{base}/{LOG}")
    if names is None:
        return None
    return [c for c in map(parse_commit, names) if c is not None]


def commit(spark: SparkSession, base: str, entry: Commit, facts: dict) -> None:
    """Enter a part in the log: a file of another name is renamed, which either happens
    or doesn't, and fails where the entry exists."""
    jvm = spark._jvm
    draft, files = _opened(spark, f"{base}/{LOG}/.draft-{uuid.uuid4().hex}")
    out = files.create(draft, False)
    try:
        out.write(bytearray(json.dumps(facts).encode()))
    finally:
        out.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        files.getUri(), spark._jsc.hadoopConfiguration()
    )
    plain = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    target = jvm.org.apache.hadoop.fs.Path(f"{base}/{LOG}/{entry.file}")
    try:
        context.rename(draft, target, plain)
    except Exception as e:
        files.delete(draft, False)
        if "FileAlreadyExists" in str(e):
            raise CommitConflict(f"{entry.file} was committed by another writer") from e
        raise


def read_facts(spark: SparkSession, base: str, entry: Commit) -> dict:
    """What a commit tells about its part."""
    path, files = _opened(spark, f"{base}/{LOG}/{entry.file}")
    stream = files.open(path)
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def forget(spark: SparkSession, base: str, entry: Commit) -> None:
    path, files = _opened(spark, f"{base}/{LOG}/{entry.file}")
    files.delete(path, False)


def holds_plain_files(spark: SparkSession, base: str) -> bool:
    """Whether a folder has rows that no log names."""
    names = list_names(spark, base) or []
    return any(n.startswith("_shard=") or not n.startswith(("_", ".", "version=")) for n in names)


def _opened(spark: SparkSession, path: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())
