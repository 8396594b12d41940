"""Scalar values as text cells, and back. All native expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shardsync.functions.types import TEXT, TIMES, as_type

# The null marker and the escaped characters of a text line.
NULL_MARK = "\\N"
ESCAPES = {"\t": "\\t", "\n": "\\n", "\r": "\\r"}
# Escapes that other writers of such lines use as well.
READ_ESCAPES = {**ESCAPES, "\b": "\\b", "\f": "\\f", "\0": "\\0"}


def escape_text(c: Column) -> Column:
    """Backslash, tab, newline and carriage return as two-character escapes."""
    c = F.replace(c, F.lit("\\"), F.lit("\\\\"))
    for char, code in ESCAPES.items():
        c = F.replace(c, F.lit(char), F.lit(code))
    return c


def unescape_text(c: Column) -> Column:
    """Inverse of :func:`escape_text`; also drops the backslash before a quote."""

    def piece(p: Column) -> Column:
        for char, code in READ_ESCAPES.items():
            p = F.replace(p, F.lit(code), F.lit(char))
        return F.replace(p, F.lit("\\"), F.lit(""))

    # an escaped backslash splits the text into pieces that hold only other escapes
    pieces = F.split(c, r"\\\\")
    return F.when(
        F.contains(c, F.lit("\\")), F.array_join(F.transform(pieces, piece), "\\")
    ).otherwise(c)


def null_text(c: Column) -> Column:
    """The word null, in any case, becomes NULL."""
    return F.when(F.lower(c) != "null", c)


def time_text(c: Column) -> Column:
    """Timestamp text with at least one fraction digit and no trailing zeros."""
    text = c.cast("string")
    return F.when(F.contains(text, F.lit(".")), text).otherwise(F.concat(text, F.lit(".0")))


def bool_text(c: Column) -> Column:
    return c.cast("tinyint").cast("string")


def bytes_text(c: Column) -> Column:
    return F.concat(F.lit("\\x"), F.lower(F.hex(c)))


def scalar_text(c: Column, data_type: T.DataType | str) -> Column:
    """Unescaped text of a scalar column."""
    t = as_type(data_type)
    if isinstance(t, T.BooleanType):
        return bool_text(c)
    if isinstance(t, TIMES):
        return time_text(c)
    if isinstance(t, T.BinaryType):
        return bytes_text(c)
    return c.cast("string")


def parse_scalar(c: Column, data_type: T.DataType | str) -> Column:
    """Text to a typed scalar; text that does not parse becomes NULL."""
    t = as_type(data_type)
    if isinstance(t, TEXT):
        return c
    if isinstance(t, T.BinaryType):
        return F.try_to_binary(F.substring(c, 3, 2147483647), F.lit("hex"))
    return c.try_cast(t)
