"""The queries of ``__spark_entry__`` and the SQL each must agree with."""

from __future__ import annotations

import tempfile
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shardsync import ShardSpec, read_sharded
from shardsync.operators import staging

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def check(sql: str | None = None, name: str | None = None):
    """Register a query under its function name."""

    def register(query: Query) -> Query:
        key = name or query.__name__
        QUERIES[key] = query
        if sql is not None:
            ORACLE[key] = sql
        return query

    return register


def shards_of(sf_dir: str) -> list[ShardSpec]:
    """The test folder as a cluster of one shard."""
    return [ShardSpec((f"{sf_dir}/{{table}}.parquet",))]


def table(spark: SparkSession, sf_dir: str, name: str, **options) -> DataFrame:
    return read_sharded(spark, shards_of(sf_dir), name, **options)


def fresh_dir(spark: SparkSession, label: str) -> str:
    """A new folder for the tables a check writes. A session of one process that names
    no shared folder gets one of its own."""
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not named and (context.master == "local" or context.master.startswith("local[")):
        context.setCheckpointDir(tempfile.mkdtemp(prefix="shardsync-checks-"))
    return staging.fresh_dir(spark, label)


def money(c: Column) -> Column:
    """Sum that does not depend on the order of the rows: added up as decimals."""
    return F.sum(c.cast("decimal(18,2)")).cast("double")
