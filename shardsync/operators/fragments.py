"""Fragment numbers of rows, and fragment plans as tables."""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Sequence
from dataclasses import replace
from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shardsync.functions.types import INTEGERS
from shardsync.plans.dialects import quote_ident, render_literal
from shardsync.plans.fragments import Fragment, FragmentSpec, fragments_cuts

PLAN_SCHEMA = (
    "fragment_no int, kind string, lo string, hi string, predicate string, shard_no int"
)


#: Shares of a balanced plan are off by less than one in this many rows.
ACCURACY = 10_000


def fragment_number(
    spec: FragmentSpec, column: Column | None = None, data_type: T.DataType | None = None
) -> Column:
    """Fragment number of a row, without a join, in constant time (listed bounds: in the
    logarithm of their number). Listed values are read as ``data_type``; one that isn't of
    that type, or two that are the same in it, are an error."""
    c = F.col(quote_ident(spec.column, "spark")) if column is None else column
    last = F.lit(spec.null_number)
    if spec.kind == "enum":
        return F.when(c.isNull(), last).otherwise(_listed_number(spec, c, data_type))
    if spec.kind == "cuts":
        below = _bounds_below(spec.bounds, c)
        number = F.when(below == len(spec.bounds), 1).when(below == 0, 0).otherwise(below + 1)
        return F.when(c.isNull(), last).otherwise(number)
    if spec.kind == "date":
        c = c.cast("date")
        step = _date_step(spec, c)
    else:
        # the distance of two 64-bit bounds may need 65 bits
        wide = "bigint" if spec.end - spec.start < 2**63 else "decimal(20,0)"
        distance = F.floor(c).cast(wide) - F.lit(spec.start).cast(wide)
        step = _div(distance, spec.step)
    return (
        F.when(c.isNull(), last)
        .when(c < F.lit(spec.start), F.lit(0))
        .when(c >= F.lit(spec.end), F.lit(1))
        .otherwise((step + 2).cast("int"))
    )


def _listed_number(spec: FragmentSpec, c: Column, data_type: T.DataType | None) -> Column:
    """Values stand in a table of as many cells as there are values, by the hash of their
    text in the column's type, so that a row is compared with one or two of them."""
    kind = (data_type or T.StringType()).json()
    cells: list[dict[str, int]] = [{} for _ in spec.values]
    for number, (text, cell) in enumerate(_spelled(spec.values, kind)):
        cells[cell][text] = number
    # one literal, whatever the number of values; it is parsed when the plan is made
    table = F.from_json(F.lit(json.dumps(cells)), "array<map<string,int>>")
    text = c.cast("string")
    cell = F.pmod(F.xxhash64(text), F.lit(len(cells))).cast("int")
    return F.coalesce(F.try_element_at(F.get(table, cell), text), F.lit(spec.steps))


@lru_cache(maxsize=256)
def _spelled(values: tuple[str, ...], kind: str) -> list[tuple[str, int]]:
    """The values as texts of a type, and the cells of a table that hold them."""
    spark = SparkSession.active()
    data_type = T.DataType.fromJson(json.loads(kind)) if kind.startswith("{") else _simple(kind)
    listed = spark.createDataFrame(list(enumerate(values)), "n int, v string")
    text = F.col("v").cast(data_type).cast("string")
    cell = F.pmod(F.xxhash64(text), F.lit(len(values))).cast("int")
    found = listed.select("n", text.alias("text"), cell.alias("cell")).orderBy("n").collect()
    texts = [r.text for r in found]
    twice = {t for t in texts if texts.count(t) > 1} if len(set(texts)) < len(texts) else set()
    if twice:
        raise ValueError(f"RANGE lists a value twice, its rows would be read twice: {', '.join(sorted(twice))}")
    return [(r.text, r.cell) for r in found]


def _simple(kind: str) -> T.DataType:
    return T.DataType.fromDDL(json.loads(kind))


def _one_of(number: Column, chosen: Sequence[int]) -> Column:
    """Whether a number is chosen, in constant time: the chosen ones stand in as many cells
    of one literal, by their remainder."""
    cells: list[list[int]] = [[] for _ in chosen]
    for n in chosen:
        cells[n % len(chosen)].append(n)
    table = F.from_json(F.lit(json.dumps(cells)), "array<array<int>>")
    return F.array_contains(F.get(table, number % len(chosen)), number)


def _bounds_below(bounds: Sequence, c: Column) -> Column:
    """How many of the rising bounds a value has reached, by halving."""
    listed = F.array(*map(F.lit, bounds))
    width = 1 << (len(bounds).bit_length() - 1)
    steps = F.array(*(F.lit(width >> k) for k in range(width.bit_length())))

    def move(at: Column, step: Column) -> Column:
        return F.when(F.get(listed, at + step - 1) <= c, at + step).otherwise(at)

    return F.aggregate(steps, F.lit(0), move)


def fragments_balanced(
    df: DataFrame, column: str, n: int, accuracy: int = ACCURACY
) -> FragmentSpec:
    """A plan of ``n`` ranges that hold about as many rows each, by one pass over an integer
    or date column: bounds are quantiles from Spark's mergeable sketch, which is off by
    less than one in ``accuracy`` rows. A value that fills more than a range is a range by
    itself; there may be fewer or a few more than ``n`` then. NULLs are a fragment of
    their own."""
    if n < 2:
        raise ValueError(f"a balanced plan has at least 2 ranges, not {n}")
    name = quote_ident(column, "spark")
    kind = df.select(name).schema[0].dataType
    if not isinstance(kind, (*INTEGERS, T.DateType)):
        raise ValueError(f"column {column} is neither an integer nor a date")
    shares = [k / n for k in range(1, n)]
    row = df.agg(F.percentile_approx(name, shares, accuracy).alias("q"), F.max(name).alias("most")).first()
    if row.q is None:
        raise ValueError(f"column {column} has no value")
    one = dt.timedelta(days=1) if isinstance(kind, T.DateType) else 1
    filled = {q for q, next_ in zip(row.q, row.q[1:], strict=False) if q == next_}
    bounds = set(row.q) | {q + one for q in filled if q < row.most}
    return fragments_cuts(column, sorted(bounds))


def _date_step(spec: FragmentSpec, day: Column) -> Column:
    start = F.lit(spec.start)
    if spec.unit == "day":
        return _div(F.datediff(day, start), spec.step)
    months = spec.step * (12 if spec.unit == "year" else 1)
    first = spec.start.year * 12 + spec.start.month
    guess = _div(F.year(day) * 12 + F.month(day) - first, months)
    # bound number ``guess`` lies in the month of the day or before it, so the
    # day is in that step or, when it comes before the bound, in the one below
    bound = F.get(F.array(*map(F.lit, spec.bounds)), guess.cast("int"))
    return guess - F.when(day < bound, 1).otherwise(0)


def _div(c: Column, n: int) -> Column:
    return F.call_function("div", c, F.lit(n))


def assign_fragment(
    df: DataFrame, spec: FragmentSpec, out: str = "fragment_id"
) -> DataFrame:
    """Add the fragment number of every row."""
    return df.withColumn(out, fragment_number(spec, data_type=_type_of(df, spec)))


def _type_of(df: DataFrame, spec: FragmentSpec) -> T.DataType:
    return df.select(quote_ident(spec.column, "spark")).schema[0].dataType


def fragment_plan(
    spark: SparkSession, n_shards: int, spec: FragmentSpec, dialect: str = "ansi"
) -> DataFrame:
    """Every fragment of every shard as a row. The rows of an int plan are computed by
    Spark; date and enum plans have no more rows than their bounds and values."""
    if n_shards < 1:
        raise ValueError("a plan needs at least one shard")
    schema = PLAN_SCHEMA.rsplit(",", 1)[0]
    shards = F.explode(F.sequence(F.lit(0), F.lit(n_shards - 1)))
    edges = spec.fragments() if spec.kind != "int" else map(spec.fragment, (0, 1, spec.null_number))
    rows = [
        (f.number, f.kind, _text(f.lo), _text(f.hi), f.to_predicate(dialect)) for f in edges
    ]
    plan = spark.createDataFrame(rows, schema)
    if spec.kind == "int":
        plan = plan.unionAll(_int_steps(spark, spec, dialect))
    return plan.withColumn("shard_no", shards)


def _int_steps(spark: SparkSession, spec: FragmentSpec, dialect: str) -> DataFrame:
    if spec.steps >= 2**31 - 2:
        raise ValueError(f"a plan has fewer than 2**31 fragments, not {len(spec)}")
    wide = "decimal(38,0)"
    lo = F.lit(spec.start).cast(wide) + F.col("id").cast("decimal(11,0)") * F.lit(spec.step).cast("decimal(19,0)")
    lo = lo.cast("bigint")
    hi = F.least(lo.cast(wide) + F.lit(spec.step).cast(wide), F.lit(spec.end).cast(wide)).cast("bigint")
    name = F.lit(quote_ident(spec.column, dialect))
    predicate = F.concat(
        name, F.lit(" >= "), lo.cast("string"), F.lit(" AND "), name, F.lit(" < "), hi.cast("string")
    )
    return spark.range(spec.steps).select(
        (F.col("id") + 2).cast("int").alias("fragment_no"), F.lit("range").alias("kind"),
        lo.cast("string").alias("lo"), hi.cast("string").alias("hi"), predicate.alias("predicate"),
    )


def keep_fragments(
    df: DataFrame, spec: FragmentSpec, numbers: Sequence[int]
) -> DataFrame:
    """Rows of the chosen fragments, as a filter the scan can push down. Neighbouring
    ranges are one; of several that are apart the scan gets the outer bounds, and each
    row's number tells."""
    picked: list[Fragment] = []
    kind = _type_of(df, spec)
    chosen = sorted(set(numbers))
    listed = [spec.values[n] for n in chosen if n < spec.steps] if spec.kind == "enum" else []
    if spec.kind == "enum":
        _spelled(spec.values, kind.json())  # bad and repeated values are an error here too
    for f in map(spec.fragment, chosen[len(listed) :]):
        if picked and f.kind == picked[-1].kind == "range" and picked[-1].hi == f.lo:
            f = replace(picked.pop(), hi=f.hi)  # neighbours make one range
        picked.append(f)
    ranges = [f for f in picked if f.kind == "range"]
    parts = [f.to_column(kind) for f in picked if f.kind != "range"]
    if listed:
        # one text for all values: making a column for each is slow
        values = (f"CAST({render_literal(v, 'spark')} AS {kind.simpleString()})" for v in listed)
        parts.append(F.expr(f"{quote_ident(spec.column, 'spark')} IN ({', '.join(values)})"))
    if ranges:
        inside = replace(ranges[0], hi=ranges[-1].hi).to_column()
        if len(ranges) > 1:
            steps = [n for n in chosen if 1 < n < spec.null_number]
            inside = inside & _one_of(fragment_number(spec), steps)
        parts.append(inside)
    return df.where(_any(parts))


def _any(parts: list[Column]) -> Column:
    """A balanced OR; false for no part."""
    if len(parts) < 2:
        return parts[0] if parts else F.lit(False)
    half = len(parts) // 2
    return _any(parts[:half]) | _any(parts[half:])


def _text(bound) -> str | None:
    return None if bound is None else str(bound)
