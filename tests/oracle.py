"""Compare a Spark result with DuckDB's, as bags of typed rows."""

from __future__ import annotations

from collections import Counter
from pathlib import Path

import duckdb


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def spark_rows(df):
    names = sorted(df.columns)
    return names, Counter(map(tuple, df.select(*names).collect()))


def duck_rows(con, sql):
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    order = sorted(range(len(columns)), key=columns.__getitem__)
    rows = Counter(tuple(r[i] for i in order) for r in result.fetchall())
    return [columns[i] for i in order], rows


def kinds(df, con, sql):
    """Column types of both sides in one spelling."""
    spell = {
        "INTEGER": "int",
        "BIGINT": "bigint",
        "SMALLINT": "smallint",
        "VARCHAR": "string",
        "DOUBLE": "double",
        "FLOAT": "float",
        "BOOLEAN": "boolean",
        "DATE": "date",
        "TIMESTAMP": "timestamp_ntz",
    }
    duck = {r[0]: r[1] for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    duck = {k: spell.get(v, v.lower()) for k, v in duck.items()}
    return dict(df.dtypes), duck
