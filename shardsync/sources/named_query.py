"""Saved SELECT statements as sources."""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from shardsync.operators.fragments import assign_fragment
from shardsync.plans.fragments import FragmentSpec
from shardsync.sources.shards import ShardSpec, read_sharded

PREFIX = "query:"


def is_named_query(source: str) -> bool:
    return source.startswith(PREFIX)


def query_name(source: str) -> str:
    """``query:<name>`` or a bare name to the checked name."""
    name = source.removeprefix(PREFIX)
    if not name.strip():
        raise ValueError(f"no query name in {source!r}")
    if "/" in name or "\\" in name:
        raise ValueError(f"a query name is not a path: {name!r}")
    return name


def query_text(spark: SparkSession, directory: str, source: str) -> str:
    """Text of ``<directory>/<name>.sql`` without its closing semicolons."""
    path = f"{directory.rstrip('/')}/{query_name(source)}.sql"
    if "://" in path:
        rows = spark.read.text(path, wholetext=True).take(1)
        text = rows[0][0] if rows else ""
    else:  # a folder of the driver, which executors need not see
        text = Path(path).read_text(encoding="utf-8")
    if not text.strip():
        raise ValueError(f"query file {path} is empty")
    return re.sub(r"[;\s]+\Z", "", text)


def read_named_query(
    spark: SparkSession,
    directory: str,
    source: str,
    *,
    views: Mapping[str, DataFrame] | None = None,
    jdbc: Sequence[ShardSpec] | None = None,
    spec: FragmentSpec | None = None,
    fragment_column: str | None = None,
    **read_options,
) -> DataFrame:
    """Run a saved query over ``views`` in Spark, or on every ``jdbc`` shard.

    With ``spec`` the result is fragmented: remotely one task per fragment, in
    Spark through ``fragment_column``. The names of ``views`` are the query's alone: the
    session's own views of these names are back once the query is planned.
    """
    text = query_text(spark, directory, source)
    if jdbc is not None:
        return read_sharded(
            spark,
            jdbc,
            f"({text}) named_query",
            plan=spec,
            fragment_column=fragment_column,
            **read_options,
        )
    with _visible(spark, views or {}):
        df = spark.sql(text)
    return df if fragment_column is None else assign_fragment(df, spec, fragment_column)


@contextmanager
def _visible(spark: SparkSession, views: Mapping[str, DataFrame]) -> Iterator[None]:
    catalog = spark.catalog
    own = {n: spark.table(n) for n in views if catalog.tableExists(n) and catalog.getTable(n).isTemporary}
    try:
        for name, view in views.items():
            view.createOrReplaceTempView(name)
        yield
    finally:
        for name in views:
            if name in own:
                own[name].createOrReplaceTempView(name)
            else:
                catalog.dropTempView(name)
