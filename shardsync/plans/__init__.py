from shardsync.plans.dialects import (
    DIALECTS,
    dialect_for,
    quote_ident,
    render_literal,
)
from shardsync.plans.domains import (
    Domain,
    among,
    between,
    compare,
    is_not_null,
    is_null,
    prune_fragments,
)
from shardsync.plans.fragments import (
    Fragment,
    FragmentSpec,
    date_bounds,
    fragments_cuts,
    fragments_date,
    fragments_enum,
    fragments_int,
    parse_fragment_spec,
)
from shardsync.plans.lattice import NoCommonType, common_schema, common_type

__all__ = [
    "Domain",
    "among",
    "between",
    "compare",
    "fragments_cuts",
    "is_not_null",
    "is_null",
    "prune_fragments",
    "NoCommonType",
    "common_schema",
    "common_type",
    "DIALECTS",
    "Fragment",
    "FragmentSpec",
    "date_bounds",
    "dialect_for",
    "fragments_date",
    "fragments_enum",
    "fragments_int",
    "parse_fragment_spec",
    "quote_ident",
    "render_literal",
]
