"""Table-to-table sync."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame

from shardsync.operators.digest import WriteDigest, check_digest, content_digest
from shardsync.operators.routing import SEGMENT, SHARD, assign_segment
from shardsync.sinks.publish import publish_sharded, verify_published
from shardsync.sinks.shards import write_sharded
from shardsync.sources.shards import ShardSpec, read_sharded


def sync_table(
    source: DataFrame,
    shards: Sequence[ShardSpec],
    table: str,
    *,
    keys: Sequence[str],
    n_segments: int,
    where: Column | None = None,
    method: str = "xxhash64",
    fmt: str = "parquet",
    mode: str = "overwrite",
    shard_column: str | None = None,
    verify: bool = False,
    publish: bool = False,
    **write_options,
) -> DataFrame:
    """Filter, assign segments, route, write, and return the table read back from
    its shards with the types it had.

    With ``publish``, all shards show the new rows at once or none does. With ``verify``,
    the table is read back in full and compared, shard by shard, with a digest of its
    rows that was taken while they were written; ``ContentMismatch`` is raised if rows
    are missing, doubled or changed. That needs ``mode='overwrite'``, as rows that were
    there before are in no digest of this write (a published table has theirs in its
    log, see :func:`verify_published`)."""
    if verify and mode != "overwrite" and not publish:
        raise ValueError("verify needs mode='overwrite' or publish=True")
    rows = source if where is None else source.where(where)
    rows = assign_segment(rows, keys, n_segments, method=method)
    rows = rows.select(SEGMENT, *[c for c in rows.columns if c != SEGMENT])
    spark, digest = source.sparkSession, WriteDigest(len(shards)) if verify else None
    if publish:
        publish_sharded(rows, shards, table, mode=mode, fmt=fmt, **write_options)
    else:
        write_sharded(rows, shards, table, mode=mode, fmt=fmt, digest=digest, **write_options)
    if verify and publish:
        verify_published(spark, shards, table, rows.schema, fmt)
    elif verify:
        found = read_sharded(spark, shards, table, schema=rows.schema, fmt=fmt, shard_column=SHARD)
        check_digest(digest.value, content_digest(found, len(shards), SHARD, fmt), table)
    return read_sharded(spark, shards, table, schema=rows.schema, fmt=fmt, shard_column=shard_column)
