"""Streams written to shards, one part of the table per micro-batch."""

from __future__ import annotations

import json
import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from shardsync.operators.commits import Commit, commit, current, read_log
from shardsync.operators.digest import WriteDigest
from shardsync.operators.routing import SEGMENT, SHARD
from shardsync.operators.staging import remove
from shardsync.sinks.shards import write_sharded
from shardsync.sources.shards import ShardSpec, all_jdbc, file_cluster, read_logged, table_folders

BATCH = "batch"
STREAM = "stream"


def write_stream_sharded(
    stream: DataFrame,
    target: str | Sequence[ShardSpec],
    table: str,
    checkpoint: str,
    *,
    name: str,
    n_shards: int | None = None,
    segment_column: str = SEGMENT,
    keyed: bool = True,
    trigger: dict | None = None,
    **write_options,
) -> StreamingQuery:
    """Write every micro-batch to the shards.

    A directory ``target`` with ``n_shards`` gets
    ``<table>/stream=<name>/batch=<id>/try=<n>/_shard=<i>``, and every directory shard
    ``<table>/stream=<name>/batch=<id>/try=<n>``. Once a batch is written to all shards, an
    entry in the table's commit log makes it visible, so readers see whole batches only.
    A micro-batch that runs again is written beside the first attempt and takes its
    place when it is committed: rows arrive exactly once. Streams of different names
    never touch each other's. A stream that starts anew under a name in use (with a new
    checkpoint) takes the place of what that name wrote when its first batch is
    committed; what the run before that wrote is removed then, so that readers of the
    replaced run can end. A run that was replaced fails when it is resumed. JDBC shards
    are appended to and get rows at least once.
    """
    if not re.fullmatch(r"[\w.-]+", name):
        raise ValueError("a stream's name has letters, digits, '_', '.' and '-' only")
    if isinstance(target, str) and n_shards is None:
        raise ValueError("a directory target needs the number of shards")
    shards = _shards(target, n_shards)
    jdbc = all_jdbc(shards)

    def write(rows: DataFrame, batch_id: int) -> None:
        common = dict(segment_column=segment_column, keyed=keyed, **write_options)
        if jdbc:
            write_sharded(rows, shards, table, mode="append", **common)
            return
        spark = rows.sparkSession
        folders, targets = table_folders(shards, table)
        log = read_log(spark, folders[0]) or []
        if any(not c.stream for c in log):
            raise ValueError(f"{table} was published; a stream can't write to it")
        own = [c for c in log if c.stream == name]
        entry = next_attempt(own, name, batch_id, _query_id(spark, checkpoint))
        digest = WriteDigest(len(shards))
        write_sharded(rows, targets, entry.folder, mode="overwrite", digest=digest, **common)
        facts = {"n_shards": len(shards), "fmt": write_options.get("fmt", "parquet"), **digest.value.to_json()}
        commit(spark, folders[0], entry, facts)
        if all(c.generation < entry.generation for c in own):
            for old in (c for c in own if c.generation < entry.generation - 1):
                for folder in folders:
                    remove(spark, f"{folder}/{old.folder}")

    return (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def _shards(target: str | Sequence[ShardSpec], n_shards: int | None) -> Sequence[ShardSpec]:
    return file_cluster(target, n_shards) if isinstance(target, str) else target


def next_attempt(own: Sequence[Commit], name: str, batch: int, writer: str) -> Commit:
    """The entry a batch gets: a new generation for a query the log doesn't know, a
    further attempt for a batch it knows."""
    last = max((c.generation for c in own), default=-1)
    generations = {c.generation for c in own if c.writer == writer}
    if generations and max(generations) < last:
        raise ValueError(f"stream {name!r} was started anew by another query")
    generation = max(generations) if generations else last + 1
    tries = [c.attempt for c in own if (c.generation, c.batch) == (generation, batch)]
    return Commit(name, generation, batch, max(tries, default=-1) + 1, writer)


def _query_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that a streaming query keeps as long as its checkpoint."""
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{checkpoint.rstrip('/')}/metadata")
    stream = path.getFileSystem(spark._jsc.hadoopConfiguration()).open(path)
    try:
        return json.loads(jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))["id"]
    finally:
        stream.close()


def read_stream_sink(
    spark: SparkSession,
    target: str | Sequence[ShardSpec],
    table: str,
    fmt: str = "parquet",
    schema: T.StructType | str | None = None,
) -> DataFrame:
    """The batches that :func:`write_stream_sharded` has committed to directories, with
    the columns ``stream``, ``batch`` and ``_shard``. Lines need their ``schema``.

    The log is read once, when this is called: the rows are those committed then, while
    streams go on."""
    if fmt == "lines" and schema is None:
        raise ValueError("lines are read with a declared schema")
    folders = [f"{target.rstrip('/')}/{table}"] if isinstance(target, str) else table_folders(target, table)[0]
    return read_logged(spark, folders, fmt, schema, keep=(STREAM, BATCH, SHARD))


def stream_commits(
    spark: SparkSession, target: str | Sequence[ShardSpec], table: str
) -> DataFrame:
    """The batches readers see: ``stream``, ``generation``, ``batch``, ``attempt``, and the
    ``writer``, the id of the streaming query."""
    base = f"{target.rstrip('/')}/{table}" if isinstance(target, str) else table_folders(target, table)[0][0]
    rows = [(c.stream, c.generation, c.batch, c.attempt, c.writer) for c in current(read_log(spark, base) or [])]
    return spark.createDataFrame(rows, "stream string, generation int, batch long, attempt int, writer string")
