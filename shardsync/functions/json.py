"""JSON text to typed columns and back."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shardsync.functions.types import as_type
from shardsync.plans.dialects import quote_ident

# Fixed value: how dates and times are written in JSON.
JSON_TIME = "yyyy-MM-dd HH:mm:ss.SSS"

_BAD = "_corrupt_record"


def parse_json_text(c: Column, data_type: T.DataType | str) -> Column:
    """JSON text to a map, array, struct or variant; empty or malformed text gives
    NULL."""
    t = as_type(data_type)
    if isinstance(t, T.VariantType):
        return F.try_parse_json(F.nullif(c, F.lit("")))
    if not isinstance(t, T.StructType):
        return F.from_json(c, t)
    # a struct parse would hide malformed text behind a row of NULL fields; the one
    # element of an array holds the parsed row, so that it is parsed once
    wide = T.StructType(t.fields + [T.StructField(_BAD, T.StringType())])
    rows = F.array(F.from_json(c, wide, {"columnNameOfCorruptRecord": _BAD}))

    def fields(row: Column) -> Column:
        made = F.struct(*(row[n].alias(n) for n in t.names))
        return F.when(row.isNotNull() & row[_BAD].isNull(), made)

    return F.when(c != "", F.get(F.transform(rows, fields), F.lit(0)))


def _dates_as_times(t: T.DataType) -> T.DataType:
    """The type with timestamps in place of dates, at every depth."""
    if isinstance(t, T.DateType):
        return T.TimestampNTZType()
    if isinstance(t, T.ArrayType):
        return T.ArrayType(_dates_as_times(t.elementType), t.containsNull)
    if isinstance(t, T.MapType):
        return T.MapType(t.keyType, _dates_as_times(t.valueType), t.valueContainsNull)
    if isinstance(t, T.StructType):
        return T.StructType(
            [T.StructField(f.name, _dates_as_times(f.dataType), f.nullable) for f in t]
        )
    return t


def json_text(schema: T.StructType, cols: list[str]) -> Column:
    """Columns of a DataFrame with this schema as one JSON object text, NULL
    fields kept."""
    fields = [
        F.col(quote_ident(n, "spark")).cast(_dates_as_times(schema[n].dataType)).alias(n) for n in cols
    ]
    options = {
        "ignoreNullFields": "false",
        "timestampFormat": JSON_TIME,
        "timestampNTZFormat": JSON_TIME,
    }
    return F.to_json(F.struct(*fields), options)
