from shardsync.functions.arrays import (
    decode_array,
    decode_literal,
    decode_sink_array,
    encode_array,
    encode_sink_array,
    to_sink_array,
)
from shardsync.functions.json import json_text, parse_json_text
from shardsync.functions.text import (
    NULL_MARK,
    bool_text,
    bytes_text,
    escape_text,
    null_text,
    parse_scalar,
    scalar_text,
    time_text,
    unescape_text,
)

__all__ = [
    "NULL_MARK",
    "bool_text",
    "bytes_text",
    "decode_array",
    "decode_literal",
    "decode_sink_array",
    "encode_array",
    "encode_sink_array",
    "escape_text",
    "json_text",
    "null_text",
    "parse_json_text",
    "parse_scalar",
    "scalar_text",
    "time_text",
    "to_sink_array",
    "unescape_text",
]
