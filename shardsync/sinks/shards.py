"""Writing a table to its shards."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor, as_completed
from threading import Event

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shardsync.operators.digest import HASH, WriteDigest, with_row_hash
from shardsync.operators.routing import SEGMENT, SHARD, route
from shardsync.operators.schema import check_sink_schema, column
from shardsync.operators.staging import staged_once
from shardsync.operators.tables import encode_row, encode_table
from shardsync.sources.named_query import is_named_query
from shardsync.sources.shards import FORMATS, ShardSpec, all_jdbc, common_root

DEFAULT_BATCH = 100_000
LAYOUTS = ("rebalance", "direct")


def write_sharded(
    df: DataFrame,
    shards: Sequence[ShardSpec],
    table: str,
    *,
    columns: Sequence[str] | None = None,
    mode: str = "append",
    segment_column: str = SEGMENT,
    keyed: bool = True,
    fmt: str = "parquet",
    layout: str = "rebalance",
    batch_size: int | None = None,
    max_writers: int | None = None,
    shards_at_once: int = 8,
    options: dict | None = None,
    digest: WriteDigest | None = None,
) -> None:
    """Send every row to the shard of its segment.

    Shards below one directory are written in a single pass, others from a staged
    copy cut by shard, so the input is computed once. ``layout`` says how rows
    reach the files: ``rebalance`` gathers a shard's rows first and lets adaptive
    execution split a large shard over many tasks, and needs adaptive execution;
    ``direct`` writes rows where they are, without a shuffle, in up to one file per
    task and shard. ``max_writers`` caps the tasks that write to one shard at a time:
    rows are dealt to that many tasks per shard after they were read and encoded. 0
    means as many as the cluster has slots.

    Shards below one directory are committed as a whole. Separate shards are
    committed one by one: after the first that fails, running ones are cancelled, no
    further one starts, and its error is raised. A JDBC append commits per task and is
    at-least-once: a task that is run again may repeat its rows. ``publish_sharded``
    commits separate shards together. A ``digest`` is taken in the pass that writes.
    """
    if is_named_query(table):
        raise ValueError("a named query cannot be written to")
    jdbc = all_jdbc(shards)
    if fmt not in FORMATS:
        raise ValueError(f"format must be one of {', '.join(FORMATS)}, not {fmt!r}")
    if layout not in LAYOUTS:
        raise ValueError(f"layout must be one of {', '.join(LAYOUTS)}, not {layout!r}")
    if max_writers is not None and max_writers < 1:
        max_writers = df.sparkSession.sparkContext.defaultParallelism
    size = None if batch_size is None else batch_size_or_error(batch_size)
    names = list(columns) if columns is not None else df.columns
    if SHARD in names:
        raise ValueError(f"the column name {SHARD} is taken by the shard number")
    check_sink_schema(df.select(*map(column, names)).schema)
    # routed before the projection: the segment column need not be written
    routed = route(df, len(shards), segment_column, keyed)
    routed = routed.select(*map(column, names), SHARD)
    beside = (SHARD,)
    if digest is not None:
        routed, beside = with_row_hash(routed, names, fmt), (SHARD, HASH)

    if fmt == "lines" and not jdbc:
        routed = encode_row(routed, keep=beside)
    routed = _laid_out(routed, layout, keyed, max_writers, len(shards))
    if digest is not None:
        routed = digest.on(routed).drop(HASH)
    if jdbc:
        _write_jdbc(routed, shards, table, mode, size, max_writers, shards_at_once, options)
        return
    root = common_root(shards, table)
    if root is not None:
        _files(routed, fmt, mode, size, options).partitionBy(SHARD).save(root)
        return

    def write(i: int, rows: DataFrame) -> None:
        _files(_dealt(rows, max_writers), fmt, mode, size, options).save(shards[i].location(table))

    _per_shard(routed, len(shards), shards_at_once, write)


def _laid_out(
    routed: DataFrame, layout: str, keyed: bool, max_writers: int | None, n_shards: int
) -> DataFrame:
    if max_writers is not None:
        lane = F.pmod(F.monotonically_increasing_id(), F.lit(max_writers))
        lane = (F.col(SHARD) * max_writers + lane).cast("int")
        return routed.repartitionById(n_shards * max_writers, lane)
    if layout == "direct" or not keyed:
        return routed
    # only adaptive execution splits a large shard; without it, gathering would
    # leave the shard to one task
    if routed.sparkSession.conf.get("spark.sql.adaptive.enabled") != "true":
        raise ValueError("layout 'rebalance' needs spark.sql.adaptive.enabled")
    return routed.hint("rebalance", SHARD)


def _dealt(rows: DataFrame, max_writers: int | None) -> DataFrame:
    """At most that many tasks, by a shuffle, so that reading stays parallel."""
    return rows if max_writers is None else rows.repartition(max_writers)


def _files(df: DataFrame, fmt: str, mode: str, size: int | None, options: dict | None):
    writer = df.write.mode(mode).format("text" if fmt == "lines" else fmt)
    if size is not None:
        writer = writer.option("maxRecordsPerFile", size)
    return writer.options(**(options or {}))


def batch_size_or_error(size: int) -> int:
    """0 means 1, a negative size is an error."""
    if size < 0:
        raise ValueError(f"batch size must not be negative, it is {size}")
    return size or 1


def jdbc_write_options(
    batch_size: int | None, max_writers: int | None, options: dict | None
) -> dict[str, str]:
    """JDBC write options: rows per flush and writers per shard."""
    merged = {"batchsize": batch_size or DEFAULT_BATCH, **(options or {})}
    if max_writers is not None:
        merged["numPartitions"] = max_writers
    return {k: str(v) for k, v in merged.items()}


def _write_jdbc(routed, shards, table, mode, size, max_writers, at_once, options) -> None:
    # Spark binds no array to a JDBC column: arrays travel as the shard's literals
    flat = encode_table(routed, sink=True)
    properties = jdbc_write_options(size, max_writers, options)

    def write(i: int, rows: DataFrame) -> None:
        rows.write.jdbc(shards[i].primary, table, mode=mode, properties=properties)

    _per_shard(flat, len(shards), at_once, write)


def _per_shard(routed: DataFrame, n: int, at_once: int, write) -> None:
    """Run one write per shard, each reading only its own part of a staged copy."""
    if n == 1:
        write(0, routed.drop(SHARD))
        return
    with staged_once(routed, "routed", SHARD) as staged:

        def one(i: int) -> None:
            write(i, staged.where(F.col(SHARD) == i).drop(SHARD))

        spark = routed.sparkSession
        tag = f"shards-{uuid.uuid4().hex}"
        failed = Event()

        def one_tagged(i: int) -> None:
            if failed.is_set():
                return
            spark.addTag(tag)
            try:
                one(i)
            except BaseException:
                failed.set()
                raise
            finally:
                spark.removeTag(tag)

        with ThreadPoolExecutor(max_workers=max(1, min(n, at_once))) as pool:
            target = inheritable_thread_target(spark)(one_tagged)
            jobs = [pool.submit(target, i) for i in range(n)]
            try:
                for job in as_completed(jobs):
                    job.result()
            except BaseException:
                pool.shutdown(wait=False, cancel_futures=True)
                spark.interruptTag(tag)
                raise
