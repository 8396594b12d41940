"""Fragment plans: one column cut into disjoint pieces that cover every row.

A plan is driver-side metadata. The same fragment is available as a SQL string
(for a remote store, ``spark.read.jdbc(predicates=...)``) and as a ``Column``
(for files), and ``shardsync.operators.assign_fragment`` computes the fragment
number of a row with arithmetic, never with a range join.

Numbering: ranges are 0 = below the start, 1 = end and above, 2.. = the steps;
enums are 0.. = the listed values, then everything else; NULL always comes last. Ranges
have even steps, or their bounds are listed (``cuts``).
"""

from __future__ import annotations

import bisect
import calendar
import datetime as dt
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property, reduce
from operator import and_

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shardsync.plans.dialects import quote_ident, render_literal

KINDS = ("int", "date", "enum")
UNITS = ("day", "month", "year")
INT64 = range(-(2**63), 2**63)
INT32 = range(-(2**31), 2**31)


@dataclass(frozen=True)
class Fragment:
    """One piece. ``kind`` is low, high, range, value, rest or null."""

    number: int
    kind: str
    column: str
    lo: object = None
    hi: object = None
    values: tuple[str, ...] = ()

    def to_column(self, data_type: T.DataType | None = None) -> Column:
        """The rows of the fragment. Listed values are read as the column's type, so
        that a scan can compare them; a value that isn't of that type is an error."""
        c = F.col(quote_ident(self.column, "spark"))
        if self.kind == "null":
            return c.isNull()
        if self.kind == "value":
            return c == typed(self.values[0], data_type)
        if self.kind == "rest":
            return ~c.isin([typed(v, data_type) for v in self.values])
        bounds = []
        if self.lo is not None:
            bounds.append(c >= F.lit(self.lo))
        if self.hi is not None:
            bounds.append(c < F.lit(self.hi))
        return reduce(and_, bounds)

    def to_predicate(self, dialect: str = "ansi", quote: bool = True) -> str:
        c = quote_ident(self.column, dialect) if quote else self.column
        if self.kind == "null":
            return f"{c} IS NULL"
        if self.kind == "value":
            return f"{c} = {render_literal(self.values[0], dialect)}"
        if self.kind == "rest":
            parts = (f"{c} <> {render_literal(v, dialect)}" for v in self.values)
            return f"( {' AND '.join(parts)} )"
        bounds = []
        if self.lo is not None:
            bounds.append(f"{c} >= {render_literal(self.lo, dialect)}")
        if self.hi is not None:
            bounds.append(f"{c} < {render_literal(self.hi, dialect)}")
        return " AND ".join(bounds)


def typed(value: str, data_type: T.DataType | None) -> Column:
    """A listed value in the column's type; as text, where that isn't known."""
    return F.lit(value) if data_type is None else F.lit(value).cast(data_type)


@dataclass(frozen=True)
class FragmentSpec:
    """How to cut ``column``; build one with the functions below."""

    column: str
    kind: str
    start: object = None
    end: object = None
    step: int = 1
    unit: str | None = None
    values: tuple = ()

    @cached_property
    def bounds(self) -> list:
        """Step bounds of a date spec or listed bounds, start and end included."""
        if self.kind == "cuts":
            return list(self.values)
        return date_bounds(self.start, self.end, self.step, self.unit)

    @property
    def outer(self) -> tuple:
        """The start of the first step and the end of the last one."""
        if self.kind == "enum":
            raise ValueError("listed values have no bounds")
        return (self.values[0], self.values[-1]) if self.kind == "cuts" else (self.start, self.end)

    def step_of(self, value) -> int:
        """The step, from 0, that holds a value between the outer bounds."""
        if self.kind == "int":
            return int((value - self.start) // self.step)
        return bisect.bisect_right(self.bounds, value) - 1

    def lower(self, step: int):
        """The lower bound of a step."""
        return self.start + step * self.step if self.kind == "int" else self.bounds[step]

    @property
    def steps(self) -> int:
        """Number of pieces between the start and the end, or of listed values."""
        if self.kind == "int":
            return -((self.start - self.end) // self.step)
        return len(self.values) if self.kind == "enum" else len(self.bounds) - 1

    @property
    def null_number(self) -> int:
        return self.steps + (1 if self.kind == "enum" else 2)

    def __len__(self) -> int:
        return self.null_number + 1

    def fragment(self, number: int) -> Fragment:
        if not 0 <= number <= self.null_number:
            raise ValueError(f"the plan has fragments 0..{self.null_number}, not {number}")
        if number == self.null_number:
            return Fragment(number, "null", self.column)
        if self.kind == "enum":
            if number == self.steps:
                return Fragment(number, "rest", self.column, values=self.values)
            return Fragment(number, "value", self.column, values=(self.values[number],))
        if number == 0:
            return Fragment(number, "low", self.column, hi=self.outer[0])
        if number == 1:
            return Fragment(number, "high", self.column, lo=self.outer[1])
        if self.kind == "int":
            lo = self.start + (number - 2) * self.step
            return Fragment(number, "range", self.column, lo, min(lo + self.step, self.end))
        lo, hi = self.bounds[number - 2 : number]
        return Fragment(number, "range", self.column, lo, hi)

    def fragments(self) -> Iterator[Fragment]:
        return map(self.fragment, range(len(self)))


def fragments_int(column: str, start: int, end: int, step: int) -> FragmentSpec:
    if start not in INT64 or end not in INT64:
        raise ValueError("RANGE bounds must fit a 64-bit integer")
    return _checked(FragmentSpec(column, "int", start, end, step))


def fragments_date(
    column: str, start: dt.date, end: dt.date, step: int, unit: str
) -> FragmentSpec:
    if unit not in UNITS:
        raise ValueError(f"INTERVAL unit must be one of {', '.join(UNITS)}, not {unit!r}")
    return _checked(FragmentSpec(column, "date", start, end, step, unit))


def fragments_enum(column: str, values) -> FragmentSpec:
    values = tuple(values)
    if not values:
        raise ValueError("RANGE lists no value")
    if len(set(values)) != len(values):
        raise ValueError("RANGE lists a value twice, its rows would be read twice")
    return FragmentSpec(_named(column), "enum", values=values)


def fragments_cuts(column: str, bounds) -> FragmentSpec:
    """Ranges between listed bounds: below the first, from the last on, and the steps
    between neighbours."""
    bounds = tuple(bounds)
    if not bounds:
        raise ValueError("at least one bound is needed")
    if any(not a < b for a, b in zip(bounds, bounds[1:], strict=False)):
        raise ValueError("bounds must rise")
    return FragmentSpec(_named(column), "cuts", values=bounds)


def parse_fragment_spec(
    partition_by: str, range_: str | None, interval: str | None = None
) -> FragmentSpec:
    """Read the option texts ``column:kind``, ``a:b`` and ``n`` or ``n:unit``."""
    head = _parts(partition_by or "")
    if len(head) < 2:
        raise ValueError("PARTITION_BY must be '<column>:{int|date|enum}'")
    column, kind = _named(head[0]), head[1].lower()
    if kind not in KINDS:
        raise ValueError(f"PARTITION_BY kind must be one of {', '.join(KINDS)}, not {kind!r}")
    if not (range_ or "").strip():
        raise ValueError(f"RANGE is required for a partition of kind {kind}")
    if kind == "enum":
        return fragments_enum(column, _parts(range_))
    if not (interval or "").strip():
        raise ValueError(f"INTERVAL is required for a partition of kind {kind}")
    ends = _parts(range_)
    if len(ends) != 2:
        raise ValueError("RANGE must be '<start>:<end>'")
    if kind == "int":
        start, end = (_integer(e, "RANGE", INT64) for e in ends)
        return fragments_int(column, start, end, _integer(interval, "INTERVAL", INT64))
    step = _parts(interval)
    if len(step) != 2:
        raise ValueError("INTERVAL must be '<n>:{day|month|year}'")
    start, end = map(_date, ends)
    return fragments_date(
        column, start, end, _integer(step[0], "INTERVAL", INT32), step[1].lower()
    )


def date_bounds(start: dt.date, end: dt.date, step: int, unit: str) -> list[dt.date]:
    """Bounds by repeated addition: once a month is too short for the day, later
    bounds keep the shorter day (01-31, 02-28, 03-28, ...)."""
    bounds = [start]
    while bounds[-1] < end:
        bounds.append(min(_advance(bounds[-1], step, unit), end))
    return bounds


def _advance(day: dt.date, step: int, unit: str) -> dt.date:
    try:
        if unit == "day":
            return day + dt.timedelta(days=step)
        months = step if unit == "month" else 12 * step
        year, month = divmod(day.year * 12 + day.month - 1 + months, 12)
        last = calendar.monthrange(year, month + 1)[1]
        return dt.date(year, month + 1, min(day.day, last))
    except (OverflowError, ValueError, IndexError):
        return dt.date.max  # past the calendar: the caller cuts it to the end


def _checked(spec: FragmentSpec) -> FragmentSpec:
    _named(spec.column)
    if not spec.start < spec.end:
        raise ValueError(f"RANGE end {spec.end} must be larger than its start {spec.start}")
    if spec.step < 1:
        raise ValueError(f"INTERVAL must be at least 1, not {spec.step}")
    return spec


def _named(column: str) -> str:
    if not column.strip():
        raise ValueError("PARTITION_BY needs a column name")
    return column


def _parts(text: str) -> list[str]:
    return text.rstrip(":").split(":") if text.strip(":") else []


def _integer(text: str, option: str, allowed: range) -> int:
    if not re.fullmatch(r"[+-]?[0-9]+", text) or int(text) not in allowed:
        raise ValueError(f"{option} holds no integer: {text!r}")
    return int(text)


def _date(text: str) -> dt.date:
    if not re.fullmatch(r"\d{4}-\d{2}-\d{2}", text):
        raise ValueError(f"RANGE holds no yyyy-mm-dd date: {text!r}")
    return dt.date.fromisoformat(text)
