"""Type helpers shared by the codecs."""

from __future__ import annotations

from pyspark.sql import types as T

TEXT = (T.StringType, T.CharType, T.VarcharType)
TIMES = (T.TimestampType, T.TimestampNTZType)
INTEGERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
NUMBERS = INTEGERS + (T.FloatType, T.DoubleType, T.DecimalType)
SCALARS = TEXT + TIMES + NUMBERS + (T.BooleanType, T.BinaryType, T.DateType)
ELEMENTS = TEXT + TIMES + NUMBERS + (T.BooleanType, T.DateType)


def as_type(t: T.DataType | str) -> T.DataType:
    return t if isinstance(t, T.DataType) else T.DataType.fromDDL(t)


def as_schema(s: T.StructType | str) -> T.StructType:
    return s if isinstance(s, T.StructType) else T.StructType.fromDDL(s)


def element_type(t: T.DataType | str) -> T.DataType:
    """Check that ``t`` may be an array element and return it as a type."""
    t = as_type(t)
    if not isinstance(t, ELEMENTS):
        raise ValueError(f"arrays of {t.simpleString()} are not supported")
    return t
