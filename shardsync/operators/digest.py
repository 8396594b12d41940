"""Content digests that don't depend on the order of rows."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shardsync.functions.text import null_text
from shardsync.functions.types import TEXT
from shardsync.operators.routing import SHARD
from shardsync.operators.schema import column

HASH = "_row_hash"
#: A row hash is added up in three pieces, so that no sum of fewer than 2 ** 41 rows
#: leaves a long.
_BITS = 22


class ContentMismatch(RuntimeError):
    """What is read back is not what was written."""


@dataclass(frozen=True)
class Digest:
    """Rows, sums of pieces of the row hashes, and rows and combined hash by shard."""

    rows: int
    sums: tuple[int, ...]
    shards: tuple[tuple[int, int], ...]

    def differs(self, other: Digest) -> list[int]:
        """Shards whose rows differ. Sums also tell rows that are gone in pairs, which
        combined hashes don't; then all shards count."""
        odd = [i for i, (a, b) in enumerate(zip(self.shards, other.shards, strict=True)) if a != b]
        same = (self.rows, self.sums) == (other.rows, other.sums)
        return odd or ([] if same else list(range(len(self.shards))))

    def to_json(self) -> dict:
        return {"rows": self.rows, "sums": list(self.sums), "shards": [list(s) for s in self.shards]}

    @staticmethod
    def from_json(made: dict) -> Digest:
        return Digest(made["rows"], tuple(made["sums"]), tuple(tuple(s) for s in made["shards"]))


def with_row_hash(df: DataFrame, names: Sequence[str], fmt: str, keep: Sequence[str] = ()) -> DataFrame:
    """Add the hash of a row's values as they come back from a shard: lines have NULL
    for empty arrays and for texts that read null."""
    values = [_as_read(column(n), df.schema[n].dataType, fmt) for n in names]
    return df.withColumn(HASH, F.xxhash64(*values) if values else F.lit(0).cast("long"))


def _as_read(c: Column, t: T.DataType, fmt: str) -> Column:
    if fmt != "lines":
        return c
    if isinstance(t, T.ArrayType):
        return F.when(F.size(c) > 0, c)
    return null_text(c) if isinstance(t, TEXT) else c


def _aggregates(n_shards: int, shard: str) -> list[Column]:
    h = F.col(HASH)
    pieces = [F.shiftrightunsigned(h, _BITS * k).bitwiseAND(F.lit((1 << _BITS) - 1)) for k in range(3)]
    sums = [F.sum(p).alias(f"s{k}") for k, p in enumerate(pieces)]
    own = [F.when(F.col(shard) == i, h) for i in range(n_shards)]
    return [
        F.count("*").alias("n"), *sums,
        *(F.count(c).alias(f"n{i}") for i, c in enumerate(own)),
        *(F.bit_xor(c).alias(f"x{i}") for i, c in enumerate(own)),
    ]


def _digest(values: dict, n_shards: int) -> Digest:
    def of(name: str) -> int:
        return int(values.get(name) or 0)

    shards = tuple((of(f"n{i}"), of(f"x{i}")) for i in range(n_shards))
    return Digest(of("n"), tuple(of(f"s{k}") for k in range(3)), shards)


class WriteDigest:
    """The digest of what one write sends to its shards, taken in the pass that writes.

    It is taken after the last shuffle: there a task that runs again counts once, which
    Spark doesn't promise before it. Costs two comparisons for each shard and row."""

    def __init__(self, n_shards: int):
        self.n_shards = n_shards
        self._observed = Observation()
        self._used = False

    def on(self, df: DataFrame, shard: str = SHARD) -> DataFrame:
        self._used = True
        return df.observe(self._observed, *_aggregates(self.n_shards, shard))

    @property
    def value(self) -> Digest:
        if not self._used:
            raise ValueError("no write has taken this digest")
        return _digest(self._observed.get, self.n_shards)


def content_digest(df: DataFrame, n_shards: int, shard: str = SHARD, fmt: str = "parquet") -> Digest:
    """The digest of a table with a shard column, from a scan of all its columns."""
    names = [n for n in df.columns if n != shard]
    rows = with_row_hash(df, names, fmt).select(HASH, shard)
    return _digest(rows.agg(*_aggregates(n_shards, shard)).first().asDict(), n_shards)


def check_digest(written: Digest, found: Digest, table: str) -> None:
    """Raise for every shard that doesn't hold what was sent to it."""
    odd = written.differs(found)
    if odd:
        told = ", ".join(
            f"shard {i}: {written.shards[i][0]} rows written, {found.shards[i][0]} found" for i in odd
        )
        raise ContentMismatch(f"{table} is not what was written ({told})")
