"""Writes that show on all shards at once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from shardsync.operators.commits import (
    LOG,
    Commit,
    commit,
    current,
    forget,
    holds_plain_files,
    list_names,
    read_facts,
    read_log,
)
from shardsync.operators.digest import Digest, WriteDigest, check_digest, content_digest
from shardsync.operators.routing import SHARD
from shardsync.operators.staging import remove
from shardsync.sinks.shards import write_sharded
from shardsync.sources.shards import ShardSpec, all_jdbc, read_sharded, table_folders

MODES = ("append", "overwrite")


def publish_sharded(
    df: DataFrame, shards: Sequence[ShardSpec], table: str, *, mode: str = "overwrite", **write_options
) -> Digest:
    """Write ``df`` to directory shards so that readers see all of it or nothing.

    Every shard first gets its rows in a folder of their own. Once all are written, one
    entry in the log beside the first shard makes them part of the table; with
    ``overwrite`` it also ends what was there before. A shard that fails leaves all
    shards as they were, and the folders are removed. ``read_sharded`` follows the log.
    A writer that commits in between makes the later one fail with ``CommitConflict``.

    The options are those of :func:`write_sharded`. The digest of what was written is
    returned and kept in the log, for :func:`verify_published`."""
    if mode not in MODES:
        raise ValueError(f"mode must be one of {', '.join(MODES)}, not {mode!r}")
    if all_jdbc(shards):
        raise ValueError("only directory shards can be published")
    spark = df.sparkSession
    folders, targets = table_folders(shards, table)
    log = read_log(spark, folders[0])
    if log is None and mode == "append" and any(holds_plain_files(spark, f) for f in folders):
        raise ValueError(f"{table} has rows that were not published; publish it with mode='overwrite'")
    if any(c.stream for c in log or ()):
        raise ValueError(f"{table} is written by a stream")
    entry = next_version(log or [], mode)
    digest = WriteDigest(len(shards))
    try:
        write_sharded(df, targets, entry.folder, mode="overwrite", digest=digest, **write_options)
        facts = {"n_shards": len(shards), "fmt": write_options.get("fmt", "parquet"), **digest.value.to_json()}
        commit(spark, folders[0], entry, facts)
    except BaseException:
        if entry not in (read_log(spark, folders[0]) or ()):
            for folder in folders:
                remove(spark, f"{folder}/{entry.folder}")
        raise
    return digest.value


def next_version(log: Sequence[Commit], mode: str) -> Commit:
    if not log:
        return Commit("", 0, 0)
    last = max(log)
    if mode == "overwrite":
        return Commit("", last.generation + 1, 0)
    return Commit("", last.generation, last.batch + 1)


def verify_published(
    spark: SparkSession, shards: Sequence[ShardSpec], table: str, schema, fmt: str = "parquet"
) -> Digest:
    """Read a published table and compare it, shard by shard, with what the log says
    was written; ``ContentMismatch`` tells the shards that differ."""
    folders, _ = table_folders(shards, table)
    facts = [read_facts(spark, folders[0], c) for c in current(read_log(spark, folders[0]) or [])]
    if not facts:
        raise ValueError(f"{table} was not published")
    written = _sum([Digest.from_json(f) for f in facts])
    df = read_sharded(spark, shards, table, schema=schema, fmt=fmt, shard_column=SHARD)
    found = content_digest(df, len(shards), SHARD, fmt)
    check_digest(written, found, table)
    return found


def _sum(digests: Sequence[Digest]) -> Digest:
    def combined(parts):
        xor = 0
        for _, x in parts:
            xor ^= x
        return sum(n for n, _ in parts), xor

    sums = tuple(map(sum, zip(*(d.sums for d in digests), strict=True)))
    shards = tuple(map(combined, zip(*(d.shards for d in digests), strict=True)))
    return Digest(sum(d.rows for d in digests), sums, shards)


def remove_replaced(spark: SparkSession, shards: Sequence[ShardSpec], table: str) -> int:
    """Delete the folders and entries of parts that later ones have replaced, and return
    their number. Readers that began before the replacement must have ended."""
    folders, _ = table_folders(shards, table)
    log = read_log(spark, folders[0]) or []
    live = set(current(log))
    old = [c for c in log if c not in live]
    for c in old:
        for folder in folders:
            remove(spark, f"{folder}/{c.folder}")
        forget(spark, folders[0], c)
    for name in list_names(spark, f"{folders[0]}/{LOG}") or []:
        if name.startswith(".draft-"):
            remove(spark, f"{folders[0]}/{LOG}/{name}")
    return len(old)

