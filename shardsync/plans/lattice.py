"""The type that holds the values of several types without losing a digit."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import types as T

from shardsync.functions.types import INTEGERS, TEXT

# Decimal digits that the largest value of a type needs.
DIGITS = {"tinyint": 3, "smallint": 5, "int": 10, "bigint": 19}
MOST_DIGITS = 38


class NoCommonType(ValueError):
    """Values of these types fit no type without losing digits."""


def common_type(a: T.DataType, b: T.DataType) -> T.DataType:
    """The least type that both sides' values fit exactly.

    Integers widen to the larger one, and with decimals to a decimal of enough digits;
    integers of at most 32 bits and floats widen to double, dates to timestamps without a
    zone. Everything but bytes and containers widens to text, where the other side is
    text. A pair that would lose digits (a bigint or a decimal with a double, more than 38
    digits) or has nothing in common raises ``NoCommonType``."""
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(common_type(a.elementType, b.elementType))
    if a.simpleString() == b.simpleString():
        return a
    for x, y in ((a, b), (b, a)):
        found = _widened(x, y)
        if found is not None:
            return found
    raise NoCommonType(f"{a.simpleString()} and {b.simpleString()} have no type that keeps all digits")


def _widened(a: T.DataType, b: T.DataType) -> T.DataType | None:
    """``b`` or a type above both, if ``a`` widens that way."""
    if isinstance(a, T.NullType):
        return b
    if isinstance(b, TEXT):
        return None if isinstance(a, (T.BinaryType, T.ArrayType, T.MapType, T.StructType)) else T.StringType()
    if isinstance(a, INTEGERS):
        digits = DIGITS[a.simpleString()]
        if isinstance(b, INTEGERS):
            return b if digits < DIGITS[b.simpleString()] else None
        if isinstance(b, T.DecimalType):
            return _decimal(max(digits, b.precision - b.scale), b.scale)
        if isinstance(b, T.FloatType):
            # 24 bits hold a smallint, not an int
            return b if digits <= 5 else T.DoubleType() if digits <= 10 else None
        return b if isinstance(b, T.DoubleType) and digits <= 10 else None
    if isinstance(a, T.DecimalType) and isinstance(b, T.DecimalType):
        whole = max(a.precision - a.scale, b.precision - b.scale)
        return _decimal(whole, max(a.scale, b.scale))
    if isinstance(a, T.FloatType) and isinstance(b, T.DoubleType):
        return b
    if isinstance(a, T.DateType) and isinstance(b, T.TimestampNTZType):
        return b
    return None


def _decimal(whole: int, scale: int) -> T.DecimalType | None:
    return T.DecimalType(whole + scale, scale) if whole + scale <= MOST_DIGITS else None


def common_schema(schemas: Sequence[T.StructType]) -> T.StructType:
    """The columns of the first schema in types that hold the values of all. All must
    have the same columns, so that none goes missing."""
    first = schemas[0]
    kinds = {f.name: f.dataType for f in first}
    for i, schema in enumerate(schemas[1:], 1):
        odd = set(schema.names) ^ set(first.names)
        if odd:
            raise ValueError(
                f"shard {i} differs from the first in the columns {', '.join(sorted(odd))}; declare a schema"
            )
        for f in schema:
            try:
                kinds[f.name] = common_type(kinds[f.name], f.dataType)
            except NoCommonType as e:
                raise NoCommonType(f"column {f.name} of shard {i}: {e}; declare a schema") from e
    return T.StructType([T.StructField(n, t) for n, t in kinds.items()])
