from shardsync.operators.fragments import (
    assign_fragment,
    fragment_number,
    fragment_plan,
    fragments_balanced,
    keep_fragments,
)
from shardsync.operators.rejects import Loaded, TooManyRejects, decode_row_checked, load_lines
from shardsync.operators.routing import assign_segment, route
from shardsync.operators.schema import align_schema, check_sink_schema
from shardsync.operators.tables import (
    decode_row,
    decode_table,
    encode_row,
    encode_table,
    json_column,
    json_pack,
)

__all__ = [
    "Loaded",
    "TooManyRejects",
    "decode_row_checked",
    "load_lines",
    "align_schema",
    "assign_fragment",
    "assign_segment",
    "check_sink_schema",
    "decode_row",
    "decode_table",
    "encode_row",
    "encode_table",
    "fragment_number",
    "fragment_plan",
    "fragments_balanced",
    "json_column",
    "json_pack",
    "keep_fragments",
    "route",
]
