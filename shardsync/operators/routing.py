"""Hash segments and the shard a row goes to."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shardsync.functions.types import INTEGERS
from shardsync.operators.schema import column

SEGMENT = "segment_id"
SHARD = "_shard"


def segment_number(keys: Sequence[Column], n: int, method: str = "xxhash64") -> Column:
    """Hash bucket 0..n-1 of the keys.

    ``xxhash64`` is the fast one. ``md5`` takes the first 32 bits of the digest of
    the text of a single key, which any other engine can compute as well.
    """
    if n < 1:
        raise ValueError("the number of segments must be at least 1")
    if method == "xxhash64":
        return F.pmod(F.xxhash64(*keys), F.lit(n)).cast("int")
    if method == "md5":
        if len(keys) != 1:
            raise ValueError("md5 takes a single key")
        digest = F.md5(F.coalesce(keys[0].cast("string"), F.lit("")).cast("binary"))
        prefix = F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")
        return F.pmod(prefix, F.lit(n)).cast("int")
    raise ValueError(f"unknown hash method {method!r}")


def assign_segment(
    df: DataFrame,
    keys: Sequence[str],
    n_segments: int,
    out: str = SEGMENT,
    method: str = "xxhash64",
) -> DataFrame:
    number = segment_number([column(k) for k in keys], n_segments, method)
    return df.withColumn(out, number)


def route(
    df: DataFrame,
    n_shards: int,
    column_name: str = SEGMENT,
    keyed: bool = True,
    out: str = SHARD,
) -> DataFrame:
    """Add the shard of every row: the segment modulo the number of shards.

    A NULL segment raises when the job runs. Not ``keyed``, a task sends all its
    rows to one shard. One shard needs no segment column.
    """
    if n_shards < 1:
        raise ValueError("there must be at least one shard")
    if n_shards == 1:
        return df.withColumn(out, F.lit(0))
    if not keyed:
        return df.withColumn(out, F.pmod(F.spark_partition_id(), F.lit(n_shards)))
    if column_name not in df.columns:
        raise ValueError(f"no segment column {column_name!r}")
    if not isinstance(df.schema[column_name].dataType, INTEGERS):
        raise ValueError(f"segment column {column_name!r} is not an integer")
    c = column(column_name)
    missing = F.raise_error(F.lit(f"NULL in segment column {column_name}"))
    shard = F.when(c.isNotNull(), F.pmod(c, F.lit(n_shards)).cast("int"))
    return df.withColumn(out, shard.otherwise(missing.cast("int")))
