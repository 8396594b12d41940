"""Arrays as text literals.

Two spellings are handled. The *host* literal ``{a,"b,c",NULL}`` is what a typed
array is read as; the *sink* literal ``['a','b,c',NULL]`` is what a shard takes
in a text line. Every function returns a native expression.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shardsync.functions.text import escape_text, time_text, unescape_text
from shardsync.functions.types import NUMBERS, TEXT, TIMES, element_type

# One element: a quoted run or everything up to the next comma. The possessive
# ``*+`` makes the regex engine loop instead of recurse and backtrack, so element
# length is not limited by the thread stack.
_QUOTED = {
    '"': r'(?s)"[^"\\]*+(?:\\.[^"\\]*+)*+"',
    "'": r"(?s)'[^'\\]*+(?:\\.[^'\\]*+)*+'",
}
_HOST_TOKEN = r'(?s)\s*+"[^"\\]*+(?:\\.[^"\\]*+)*+"|[^,]+'
_SINK_TOKEN = r"(?s)\s*+'[^'\\]*+(?:\\.[^'\\]*+)*+'|[^,]+"


def encode_array(
    c: Column, elem_type: T.DataType | str, empty_as_null: bool = True
) -> Column:
    """Typed array to host literal."""
    t = element_type(elem_type)
    if isinstance(t, T.BooleanType):
        c = c.cast("array<tinyint>")
    if isinstance(t, TEXT):
        items = F.transform(c, lambda x: _quoted(_host_escape(x), '"'))
    elif isinstance(t, TIMES):
        items = F.transform(c, lambda x: _quoted(time_text(x), '"'))
    else:
        items = c.cast("array<string>")
    return _wrapped(c, items, "{", "}", empty_as_null)


def decode_array(
    c: Column, elem_type: T.DataType | str, empty_as_null: bool = False, strict: bool = False
) -> Column:
    """Host literal to typed array; an element that does not parse becomes NULL. Text
    that is no literal (brackets, quotes or commas out of place, arrays in arrays) gives
    NULL, or an error when ``strict``."""
    t = element_type(elem_type)
    items = _host_items(c) if isinstance(t, TEXT) else _plain_items(c, '"', t)
    return _where_good(c, items, '"', "{", "}", empty_as_null, strict)


def encode_sink_array(
    c: Column, elem_type: T.DataType | str, empty_as_null: bool = True
) -> Column:
    """Typed array to sink literal, without going through the host literal."""
    t = element_type(elem_type)
    if isinstance(t, T.BooleanType):
        c = c.cast("array<tinyint>")
    if isinstance(t, TEXT):
        items = F.transform(c, lambda x: _quoted(_sink_escape(x), "'"))
    elif isinstance(t, TIMES):
        items = F.transform(c, lambda x: _quoted(time_text(x), "'"))
    elif isinstance(t, T.DateType):
        items = F.transform(c, lambda x: _quoted(x.cast("string"), "'"))
    else:
        items = c.cast("array<string>")
    return _wrapped(c, items, "[", "]", empty_as_null)


def decode_sink_array(
    c: Column, elem_type: T.DataType | str, empty_as_null: bool = False, strict: bool = False
) -> Column:
    """Sink literal to typed array; text that is no literal as in :func:`decode_array`."""
    t = element_type(elem_type)
    if isinstance(t, TEXT):
        items = F.transform(_tokens(c, _SINK_TOKEN), lambda x: _item(x, "'", unescape_text))
    else:
        items = _plain_items(c, "'", t)
    return _where_good(c, items, "'", "[", "]", empty_as_null, strict)


def bad_elements(c: Column, elem_type: T.DataType | str) -> Column:
    """Whether a sink literal has an element that is neither NULL nor of the type."""
    t = element_type(elem_type)
    if isinstance(t, TEXT):
        return F.lit(False)
    return F.exists(_bare_texts(c, "'"), lambda x: (F.upper(x) != "NULL") & x.try_cast(t).isNull())


def decode_literal(c: Column, elem_type: T.DataType | str) -> Column:
    """Typed array from either spelling, told apart by the opening bracket."""
    return F.when(F.startswith(c, F.lit("[")), decode_sink_array(c, elem_type)).otherwise(
        decode_array(c, elem_type)
    )


def to_sink_array(c: Column, elem_type: T.DataType | str) -> Column:
    """Host literal to sink literal; ``{}`` and text that is no literal become NULL."""
    t = element_type(elem_type)
    good = _good(c, '"', "{", "}") & (c != "{}")
    if isinstance(t, NUMBERS):
        plain = F.array_join(_bare_texts(c, '"'), ",")
        return F.when(good, F.concat(F.lit("["), plain, F.lit("]")))
    if isinstance(t, TEXT):
        items = F.transform(_host_items(c), lambda x: _quoted(_sink_escape(x), "'"))
    elif isinstance(t, T.BooleanType):
        flags = _plain_items(c, '"', t)
        items = flags.cast("array<tinyint>").cast("array<string>")
    else:
        items = F.transform(_plain_items(c, '"', "string"), lambda x: _quoted(x, "'"))
    text = F.concat(F.lit("["), F.array_join(items, ",", "NULL"), F.lit("]"))
    return F.when(good, text)


def _body(c: Column) -> Column:
    return F.substring(c, F.lit(2), F.length(c) - 2)


def _tokens(c: Column, token: str) -> Column:
    found = F.regexp_extract_all(_body(c), F.lit(token), F.lit(0))
    return F.filter(found, lambda x: F.trim(x) != "")


def _host_items(c: Column) -> Column:
    return F.transform(_tokens(c, _HOST_TOKEN), lambda x: _item(x, '"', _host_unescape))


def _good(c: Column, quote: str, left: str, right: str) -> Column:
    """Whether ``c`` is a well-formed literal. Literals without quotes need two searches for
    brackets. In others each quoted run is replaced by a pair of quotes, so that quotes that
    are left over, brackets, and text beside a run show."""
    whole = (F.length(c) >= 2) & F.startswith(c, F.lit(left)) & F.endswith(c, F.lit(right))
    plain = (F.locate(left, c, 2) == 0) & (F.locate(right, c) == F.length(c))
    q, b, e = quote, f"\\{left}", f"\\{right}"
    odd = rf"(?s)(?<!\A){b}|{e}(?!\z)|(?<!{q}){q}(?!{q})|[^,\s{b}{q}]\s*+{q}{q}|{q}{q}\s*+[^,\s{e}]"
    runs = F.regexp_replace(c, _QUOTED[quote], quote * 2)
    return whole & F.when(F.contains(c, F.lit(quote)), ~runs.rlike(odd)).otherwise(plain)


def _where_good(
    c: Column, items: Column, quote: str, left: str, right: str, empty_as_null: bool, strict: bool
) -> Column:
    good = _good(c, quote, left, right)
    found = F.when(F.length(c) > 2, items) if empty_as_null else items
    if not strict:
        return F.when(good, found)
    text = F.concat(F.lit("no array literal: "), F.substring(c, 1, 100))
    bad = F.raise_error(text).cast(T.StringType())
    # an error has no type of its own: it stands where the length is compared
    return F.when(good | c.isNull() | (F.length(bad) < 0), found)


def _item(x: Column, quote: str, unescape) -> Column:
    x = F.trim(x)
    inner = F.substring(x, F.lit(2), F.length(x) - 2)
    return F.when(F.startswith(x, F.lit(quote)), unescape(inner)).otherwise(_not_null_word(x))


def _not_null_word(x: Column) -> Column:
    return F.when(F.upper(x) != "NULL", x)


def _plain_items(c: Column, quote: str, data_type: T.DataType | str) -> Column:
    """Elements of a literal whose texts hold no comma and no quote.

    The word NULL is taken out before the cast, as text that does not parse costs an
    exception."""
    return F.transform(_bare_texts(c, quote), lambda x: _not_null_word(x).try_cast(data_type))


def _bare_texts(c: Column, quote: str) -> Column:
    bare = F.replace(_body(c), F.lit(quote), F.lit(""))
    return F.array_remove(F.transform(F.split(bare, ","), lambda x: F.trim(x)), "")


def _wrapped(
    c: Column, items: Column, left: str, right: str, empty_as_null: bool
) -> Column:
    text = F.concat(F.lit(left), F.array_join(items, ",", "NULL"), F.lit(right))
    return F.when(F.size(c) > 0, text) if empty_as_null else text


def _quoted(x: Column, quote: str) -> Column:
    return F.concat(F.lit(quote), x, F.lit(quote))


def _host_escape(x: Column) -> Column:
    x = F.replace(x, F.lit("\\"), F.lit("\\\\"))
    return F.replace(x, F.lit('"'), F.lit('\\"'))


def _host_unescape(x: Column) -> Column:
    plain = F.regexp_replace(x, r"(?s)\\(.)", "$1")
    return F.when(F.contains(x, F.lit("\\")), plain).otherwise(x)


def _sink_escape(x: Column) -> Column:
    return F.replace(escape_text(x), F.lit("'"), F.lit("\\'"))


__all__ = [
    "bad_elements",
    "decode_array",
    "decode_literal",
    "decode_sink_array",
    "encode_array",
    "encode_sink_array",
    "to_sink_array",
]
