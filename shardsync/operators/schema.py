"""Tables brought to a declared schema."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shardsync.functions.arrays import decode_literal
from shardsync.functions.text import parse_scalar
from shardsync.functions.types import ELEMENTS, SCALARS, TEXT, as_schema
from shardsync.plans.dialects import quote_ident


def column(name: str) -> Column:
    return F.col(quote_ident(name, "spark"))


def align_schema(
    df: DataFrame,
    schema: T.StructType | str,
    projected: Iterable[str] | None = None,
    lenient: bool = False,
) -> DataFrame:
    """Columns by name, in declared order and type.

    Columns outside ``projected`` stay in the result as typed NULLs and are not
    read. A cast that fails raises, or gives NULL when ``lenient``.
    """
    schema = as_schema(schema)
    wanted = set(schema.names if projected is None else projected)
    unknown = wanted - set(schema.names)
    if unknown:
        raise ValueError(f"columns not in the schema: {', '.join(sorted(unknown))}")
    missing = wanted - set(df.columns)
    if missing:
        raise ValueError(f"columns not in the source: {', '.join(sorted(missing))}")
    return df.select(
        *(
            (
                _coerced(column(f.name), df.schema[f.name].dataType, f.dataType, lenient)
                if f.name in wanted
                else F.lit(None).cast(f.dataType)
            ).alias(f.name)
            for f in schema
        )
    )


def _coerced(c: Column, have: T.DataType, want: T.DataType, lenient: bool) -> Column:
    if have.simpleString() == want.simpleString():
        return c
    if isinstance(have, TEXT):
        if isinstance(want, T.ArrayType):
            return decode_literal(c, want.elementType)
        if isinstance(want, T.BinaryType):
            return c.cast(want)
        if lenient:
            return parse_scalar(c, want)
    if isinstance(want, T.ArrayType):
        want = T.ArrayType(want.elementType)
    return c.try_cast(want) if lenient else c.cast(want)


def check_sink_schema(schema: T.StructType) -> T.StructType:
    """Raise for a column type that no sink can hold."""
    for f in schema:
        t = f.dataType
        ok = (
            isinstance(t.elementType, ELEMENTS)
            if isinstance(t, T.ArrayType)
            else isinstance(t, SCALARS)
        )
        if not ok:
            raise ValueError(f"column {f.name}: type {t.simpleString()} is not supported")
    return schema
