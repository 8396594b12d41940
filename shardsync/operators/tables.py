"""Whole tables in text form, and back."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shardsync.functions.arrays import (
    decode_sink_array,
    encode_array,
    encode_sink_array,
)
from shardsync.functions.json import json_text, parse_json_text
from shardsync.functions.text import (
    NULL_MARK,
    escape_text,
    null_text,
    parse_scalar,
    scalar_text,
    unescape_text,
)
from shardsync.functions.types import TEXT, as_schema
from shardsync.operators.schema import align_schema, check_sink_schema, column

LINE = "value"

CELLS = "_cells"


def encode_table(
    df: DataFrame, empty_as_null: bool = True, sink: bool = False
) -> DataFrame:
    """Array columns as host literals (or ``sink`` literals), all others unchanged."""
    check_sink_schema(df.schema)
    encode = encode_sink_array if sink else encode_array
    return df.select(
        *(
            encode(column(f.name), f.dataType.elementType, empty_as_null).alias(f.name)
            if isinstance(f.dataType, T.ArrayType)
            else column(f.name)
            for f in df.schema
        )
    )


def decode_table(df: DataFrame, schema: T.StructType | str) -> DataFrame:
    """Literals of either spelling and other text to the declared types; bad values
    become NULL."""
    return align_schema(df, schema, lenient=True)


def encode_row(
    df: DataFrame,
    null: str = NULL_MARK,
    null_text_as_null: bool = True,
    escape: bool = True,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Every row as one tab-separated line in the column ``value``.

    ``keep`` names columns carried beside the line and left out of it. With
    ``escape=False`` text goes out as it is, so a tab or newline breaks the line.
    """
    fields = [f for f in check_sink_schema(df.schema) if f.name not in keep]

    def cell(f: T.StructField):
        c, t = column(f.name), f.dataType
        if isinstance(t, T.ArrayType):
            text = encode_sink_array(c, t.elementType)
        else:
            if isinstance(t, TEXT) and null_text_as_null:
                c = null_text(c)
            text = scalar_text(c, t)
            if escape and isinstance(t, TEXT + (T.BinaryType,)):
                text = escape_text(text)
        return F.coalesce(text, F.lit(null))

    line = F.concat_ws("\t", *map(cell, fields)).alias(LINE)
    return df.select(line, *map(column, keep))


def decode_row(
    df: DataFrame,
    schema: T.StructType | str,
    null: str = NULL_MARK,
    escape: bool = True,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Inverse of :func:`encode_row`; ``schema`` is that of the line. Cells that don't parse
    or are missing become NULL and cells beyond the schema are left out;
    ``decode_row_checked`` and ``load_lines`` tell such lines."""
    fields = check_sink_schema(as_schema(schema))
    return split_lines(df, keep).select(
        *(
            parsed_cell(raw_cell(i, f, null, escape), f.dataType).alias(f.name)
            for i, f in enumerate(fields)
        ),
        *map(column, keep),
    )


def split_lines(df: DataFrame, keep: Sequence[str]) -> DataFrame:
    # a column of its own, so that a line is split once and not once per cell
    return df.select(F.split(F.col(LINE), "\t").alias(CELLS), *map(column, keep))


def raw_cell(i: int, f: T.StructField, null: str, escape: bool) -> Column:
    """Text of a cell; NULL for the null marker and where the line has no such cell."""
    c = F.nullif(F.get(F.col(CELLS), F.lit(i)), F.lit(null))
    escaped = escape and isinstance(f.dataType, TEXT + (T.BinaryType,))
    return unescape_text(c) if escaped else c


def parsed_cell(c: Column, t: T.DataType) -> Column:
    return decode_sink_array(c, t.elementType) if isinstance(t, T.ArrayType) else parse_scalar(c, t)


def json_column(
    df: DataFrame, col: str, schema: T.DataType | str, out: str
) -> DataFrame:
    """Add the JSON text (or UTF-8 bytes) of ``col`` as a map, array, struct or
    variant; empty or malformed text gives NULL."""
    return df.withColumn(out, parse_json_text(column(col).cast("string"), schema))


def json_pack(
    df: DataFrame, cols: list[str], out: str, as_bytes: bool = False
) -> DataFrame:
    """Add the columns ``cols`` as one JSON object, text or UTF-8 bytes."""
    text = json_text(df.schema, cols)
    return df.withColumn(out, F.encode(text, "UTF-8") if as_bytes else text)
