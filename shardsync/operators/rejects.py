"""Lines that don't fit their table, beside those that do."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shardsync.functions.arrays import bad_elements
from shardsync.functions.text import NULL_MARK
from shardsync.functions.types import TEXT, as_schema
from shardsync.operators.schema import column
from shardsync.operators.staging import remove
from shardsync.operators.tables import CELLS, LINE, split_lines, parsed_cell, raw_cell

REASON = "_reason"
REJECTED = "_rejected"
FILE = "_file"


class TooManyRejects(RuntimeError):
    """More lines were rejected than the limit allows."""


def decode_row_checked(
    df: DataFrame,
    schema: T.StructType | str,
    null: str = NULL_MARK,
    escape: bool = True,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Lines decoded as by ``decode_row``, with the line itself in ``value`` and what is wrong
    with it in ``_reason`` (NULL, if nothing is): another number of cells, a cell that
    isn't of its column's type, an array that is no literal or has such an element. All that
    is wrong is told, in the order of the columns. A line is split once and each cell parsed
    once."""
    fields = list(as_schema(schema))
    names = {LINE, REASON, REJECTED, FILE} & {f.name for f in fields}
    if names:
        raise ValueError(f"column names taken by rejected lines: {', '.join(sorted(names))}")
    split = split_lines(df, (LINE, *keep))
    cells = split.select(
        *(raw_cell(i, f, null, escape).alias(f"_raw{i}") for i, f in enumerate(fields)),
        F.size(CELLS).alias("_size"), LINE, *map(column, keep),
    )
    parsed = cells.select(
        *(parsed_cell(F.col(f"_raw{i}"), f.dataType).alias(f.name) for i, f in enumerate(fields)),
        *(f"_raw{i}" for i in range(len(fields))), "_size", LINE, *map(column, keep),
    )
    size = F.format_string(f"%d cells, {len(fields)} expected", "_size")
    wrong = [F.when(F.col("_size") != len(fields), size)]
    wrong += [_wrong(F.col(f"_raw{i}"), column(f.name), f) for i, f in enumerate(fields)]
    reason = F.nullif(F.concat_ws("; ", *(w for w in wrong if w is not None)), F.lit(""))
    return parsed.select(*(column(f.name) for f in fields), LINE, reason.alias(REASON), *map(column, keep))


def _wrong(raw: Column, value: Column, field: T.StructField) -> Column | None:
    t = field.dataType
    if isinstance(t, TEXT):
        return None
    bad = raw.isNotNull() & value.isNull()
    if isinstance(t, T.ArrayType):
        elements = F.when(bad_elements(raw, t.elementType), F.lit(f"{field.name}: an element is no {t.elementType.simpleString()}"))
        return F.when(bad, F.lit(f"{field.name}: no array literal")).otherwise(elements)
    return F.when(bad, F.lit(f"{field.name}: no {t.simpleString()}"))


@dataclass(frozen=True)
class Loaded:
    """The rows of a load, the lines it rejected (``line``, ``reason``, ``file``), and how
    many of each there are."""

    rows: DataFrame
    rejects: DataFrame
    n_rows: int
    n_rejects: int


def load_lines(
    spark: SparkSession,
    paths: str | Sequence[str],
    schema: T.StructType | str,
    target: str,
    *,
    limit: int | float | None = None,
    null: str = NULL_MARK,
    escape: bool = True,
) -> Loaded:
    """Decode files of lines once into ``target``, rows to one part of it and rejected lines
    with their reasons and files to another, and return both.

    ``limit`` is how many lines may be rejected, or with a fraction which share of them;
    with more, ``TooManyRejects`` is raised and the target removed. The target must not
    exist. Both parts are written in the pass that decodes; which lines are bad doesn't
    depend on how the files are cut."""
    schema = as_schema(schema)
    paths = [paths] if isinstance(paths, str) else list(paths)
    text = spark.read.option("lineSep", "\n").text(paths).select(LINE, F.col("_metadata.file_path").alias(FILE))
    checked = decode_row_checked(text, schema, null, escape, keep=(FILE,))
    bad = F.col(REASON).isNotNull()
    one = checked.select(
        # a rejected line is kept as it came, a good one isn't kept twice
        *(F.when(~bad, column(f.name)).alias(f.name) for f in schema),
        F.when(bad, F.col(LINE)).alias(LINE), REASON, F.when(bad, F.col(FILE)).alias(FILE),
        bad.cast("int").alias(REJECTED),
    )
    counts = Observation()
    observed = one.observe(counts, F.count("*").alias("n"), F.sum(REJECTED).alias("bad"))
    observed.write.mode("error").partitionBy(REJECTED).parquet(target)
    n, rejected = counts.get["n"] or 0, counts.get["bad"] or 0
    whole = T.StructType([*schema, *(T.StructField(c, T.StringType()) for c in (LINE, REASON, FILE))])
    parts = spark.read.schema(T.StructType([*whole, T.StructField(REJECTED, T.IntegerType())])).parquet(target)
    rejects = parts.where(F.col(REJECTED) == 1).select(
        F.col(LINE).alias("line"), F.col(REASON).alias("reason"), F.col(FILE).alias("file")
    )
    allowed = None if limit is None else limit * n if isinstance(limit, float) else limit
    if allowed is not None and rejected > allowed:
        some = "; ".join(f"{r.file}: {r.reason}" for r in rejects.limit(3).collect())
        remove(spark, target)
        raise TooManyRejects(f"{rejected} of {n} lines are rejected, the limit is {limit} ({some})")
    return Loaded(parts.where(F.col(REJECTED) == 0).select(*map(column, schema.names)), rejects, n - rejected, rejected)
