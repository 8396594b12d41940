"""How a database spells literals and identifiers.

Only predicate strings handed to a remote store need this; everything that runs
inside Spark is a ``Column``.
"""

from __future__ import annotations

import datetime as dt
import decimal

# Literal spellings, one entry per database family.
DATE_LITERALS = {
    "ansi": "date'{}'",
    "mysql": "DATE('{}')",
    "oracle": "to_date('{}', 'YYYY-MM-DD')",
    "s3select": "TO_TIMESTAMP('{}')",
    "spark": "date'{}'",
    "sqlserver": "'{}'",
}
TIMESTAMP_LITERALS = {
    "ansi": "'{}'",
    "mysql": "'{}'",
    "oracle": "to_timestamp('{}', 'YYYY-MM-DD HH24:MI:SS.FF')",
    "s3select": "TO_TIMESTAMP('{}')",
    "spark": "timestamp_ntz'{}'",
    "sqlserver": "'{}'",
}
# The word in a product name or JDBC URL that tells the family.
PRODUCT_WORDS = {
    "MICROSOFT": "sqlserver",
    "MYSQL": "mysql",
    "ORACLE": "oracle",
    "S3 SELECT": "s3select",
    "SQLSERVER": "sqlserver",
}
DIALECTS = tuple(DATE_LITERALS)

_BACKTICK = {"mysql", "spark"}  # quote identifiers with ` and read \ as an escape


def dialect_for(product: str) -> str:
    """Family of a database product name or URL; ``ansi`` when no word is known."""
    upper = product.upper()
    return next((d for word, d in PRODUCT_WORDS.items() if word in upper), "ansi")


def render_literal(value, dialect: str = "ansi") -> str:
    """SQL text of one Python value."""
    if dialect not in DIALECTS:
        raise ValueError(f"unknown dialect {dialect!r}; one of {', '.join(DIALECTS)}")
    if isinstance(value, bool):
        return "true" if value else "false"
    if isinstance(value, (int, float)):
        return repr(value)
    if isinstance(value, dt.datetime):
        return TIMESTAMP_LITERALS[dialect].format(value.isoformat(sep=" "))
    if isinstance(value, dt.date):
        return DATE_LITERALS[dialect].format(value.isoformat())
    if isinstance(value, str):
        if dialect in _BACKTICK:
            value = value.replace("\\", "\\\\")
        return "'" + value.replace("'", "''") + "'"
    if isinstance(value, decimal.Decimal):
        return str(value)
    raise ValueError(f"no literal for a {type(value).__name__}")


def quote_ident(name: str, dialect: str = "ansi") -> str:
    mark = "`" if dialect in _BACKTICK else '"'
    return mark + name.replace(mark, mark * 2) + mark
