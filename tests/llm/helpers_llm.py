"""Small tables with awkward rows."""

from __future__ import annotations

import re

import pyarrow.parquet as pq

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"
LOWER = {c: c + 32 for c in range(65, 91)}
LONG = "alpha beta gamma delta epsilon zeta eta theta " * 20_000


def documents(spark, rows, extra=False):
    """(doc_id, text[, lang, source]) rows; ``extra`` adds columns that clash with
    names the operators use themselves."""
    full = [(*r, *(None,) * (4 - len(r)), len(r[1] or "")) for r in rows]
    df = spark.createDataFrame(full, DOCUMENTS)
    if extra:
        for name in ("at", "digest", "keep", "n", "score", "piece", "node", "b", "words", "h", "fold"):
            df = df.selectExpr("*", f"'x' AS `{name}`")
    return df


AWKWARD = [
    (1, None),
    (2, ""),
    (3, "   \n\t "),
    (4, "word"),
    (5, "The MIT License and the mit  license."),
    (6, "the mit license AND the MIT  license."),
    (6, "the mit license AND the MIT  license."),
    (None, "no id here at all, but six words"),
    (8, LONG),
    (9, "ÀÉÎ straße 数据 \U0001f600 <|endoftext|> x"),
    (10, "\u0000   odd blanks"),
]


def read(sf_dir, table, *columns):
    rows = pq.read_table(f"{sf_dir}/{table}.parquet", columns=list(columns)).to_pylist()
    return [tuple(r[c] for c in columns) for r in rows]


def fold(text):
    return (text or "").translate(LOWER)


def words(text, separators):
    return re.findall(f"[^{separators}]+", fold(text))
