"""Exact top-k by inner product: branch and bound over vertical blocks."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shardsync.llm.common import written

#: Dimensions that are added up before candidates are dropped.
DIMENSIONS = 16
#: Candidates that share a vertical block.
VECTORS = 1024
#: Queries that meet a vertical block at once.
QUERIES = 512
_MOST = (1 << 63) - 1


def usable_vectors(vectors: DataFrame, scale: int = 1024) -> DataFrame:
    """``vec_id`` and ``v``, the whole numbers floor(``scale`` * x) of each component as
    doubles. Null ids, null or empty vectors and those with null, NaN or infinite
    components are left out; what exceeds a long counts as the nearest long. Rows that repeat a ``vec_id`` are one: the largest
    vector counts."""
    whole = F.transform("embedding", lambda x: F.floor(x.cast("double") * scale).cast("double"))
    bad = F.exists(
        "embedding",
        lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf")),
    )
    good = vectors.where(F.col("vec_id").isNotNull() & (F.size("embedding") > 0)).where(~bad)
    rows = good.select(F.col("vec_id").cast("long").alias("vec_id"), whole.alias("v"))
    return rows.groupBy("vec_id").agg(F.max("v").alias("v"))


class Best:
    """The k best (score, smaller id first) of each query so far."""

    def __init__(self, queries: int, k: int):
        self.k = k
        self.score = np.full((queries, k), -np.inf)
        self.id = np.full((queries, k), np.iinfo(np.int64).max)

    @property
    def worst(self) -> np.ndarray:
        return self.score[:, -1]

    def add(self, query: int, scores: np.ndarray, ids: np.ndarray) -> None:
        score = np.concatenate([self.score[query], scores])
        known = np.concatenate([self.id[query], ids])
        order = np.lexsort((known, -score))[: self.k]
        self.score[query], self.id[query] = score[order], known[order]


def search_block(
    queries: np.ndarray, query_ids: np.ndarray, block: np.ndarray, ids: np.ndarray, best: Best
) -> None:
    """Score one vertical block, one row for each dimension, against all queries.

    Scores grow by ``DIMENSIONS`` dimensions at a time. What the other dimensions can
    still add is at most the product of the remaining norms; candidates that can't
    reach a query's k-th best score any more are dropped, and the survivors are
    packed together for the next step. All sums are whole numbers below 2 ** 53, so
    they are exact; norms are rounded up."""
    size = block.shape[0]
    cuts = list(range(0, size, DIMENSIONS))
    mine = [_rest(queries[:, c:], 1) for c in cuts[1:]] + [np.zeros(len(queries))]
    theirs = [_rest(block[c:], 0) for c in cuts[1:]] + [np.zeros(block.shape[1])]
    first = queries[:, :DIMENSIONS] @ block[:DIMENSIONS]
    reach = first + mine[0][:, None] * theirs[0] * (1 + 1e-9) >= best.worst[:, None]
    reach &= query_ids[:, None] != ids
    for q in np.flatnonzero(reach.any(axis=1)):
        left = np.flatnonzero(reach[q])
        score = first[q, left]
        for step, c in enumerate(cuts[1:], 1):
            score = score + queries[q, c : c + DIMENSIONS] @ block[c : c + DIMENSIONS, left]
            fit = score + mine[step][q] * theirs[step][left] * (1 + 1e-9) >= best.worst[q]
            left, score = left[fit], score[fit]
            if not len(left):
                break
        if len(left):
            best.add(q, score, ids[left])


def _rest(part: np.ndarray, axis: int) -> np.ndarray:
    return np.sqrt((part * part).sum(axis=axis))


def search(
    query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, vectors: np.ndarray, k: int
) -> list[tuple[int, int, int]]:
    """(query, candidate, score) of each query's k best among the vectors."""
    most = np.abs(queries).max() * np.abs(vectors).max() * queries.shape[1]
    if most >= 1 << 53:
        return _search_any_size(query_ids, queries, ids, vectors, k)
    energy = (queries * queries).sum(axis=0) * (vectors * vectors).sum(axis=0)
    order = np.argsort(-energy, kind="stable")
    queries = np.ascontiguousarray(queries[:, order])
    blocks = [
        (np.ascontiguousarray(vectors[at : at + VECTORS, order].T), ids[at : at + VECTORS])
        for at in range(0, len(ids), VECTORS)
    ]
    out = []
    for at in range(0, len(queries), QUERIES):
        some, own = queries[at : at + QUERIES], query_ids[at : at + QUERIES]
        best = Best(len(some), k)
        for block, names in blocks:
            search_block(some, own, block, names, best)
        out += [
            (int(q), int(i), int(s))
            for q, row, scores in zip(own, best.id, best.score, strict=True)
            for i, s in zip(row, scores, strict=True)
            if s > -math.inf
        ]
    return out


def _search_any_size(query_ids, queries, ids, vectors, k):
    """The same for components beyond exact doubles, with Python's whole numbers; a
    score beyond a long is given as the nearest long."""
    whole = [[int(x) for x in v] for v in vectors]
    out = []
    for q, v in zip(query_ids.tolist(), queries, strict=True):
        own = [int(x) for x in v]
        scores = (
            (-max(-_MOST - 1, min(_MOST, sum(a * b for a, b in zip(own, w, strict=True)))), i)
            for i, w in zip(ids.tolist(), whole, strict=True)
            if i != q
        )
        out += [(q, i, -s) for s, i in sorted(scores)[:k]]
    return out


def top_k(
    vectors: DataFrame, queries: Column, k: int = 10, scale: int = 1024,
    group_rows: int = 8_192, query_rows: int = 65_536,
) -> DataFrame:
    """For each row for which ``queries`` (on ``vec_id``) holds, the ``k`` largest
    inner products with all other rows: ``query_id``, ``rank`` from 1, ``vec_id``,
    ``score``. Ties go to the smaller id; with fewer candidates there are fewer rows.

    See ``usable_vectors`` for rows that take no part. Vectors are compared with those
    of their own length only. An empty table, or one without queries, gives no rows;
    further columns are ignored.

    Candidates are dealt by id into groups of about ``group_rows`` and queries into
    groups of about ``query_rows``; a task holds one of each, so memory is bounded
    whatever the numbers. Candidates are sent once for each group of queries, queries
    once for each group of candidates. Only a task's k best leave it."""
    every = written(usable_vectors(vectors, scale).withColumn("size", F.size("v")), "vectors")
    chosen = every.where(queries)
    n_groups = max(1, -(-every.count() // group_rows))
    n_queries = max(1, -(-chosen.count() // query_rows))
    dealt = F.pmod(F.xxhash64("vec_id"), F.lit(n_groups)).cast("int")
    asked = F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(n_queries)).cast("int")

    def all_of(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    keys = ["size", "group", "part"]
    left = every.select("size", dealt.alias("group"), all_of(n_queries).alias("part"), "vec_id", "v")
    right = chosen.select("size", all_of(n_groups).alias("group"), asked.alias("part"), "vec_id", "v")

    def run(candidates: pa.Table, given: pa.Table) -> pa.Table:
        found = []
        if candidates.num_rows and given.num_rows:
            (ids, block), (names, own) = map(_matrix, (candidates, given))
            found = search(names, own, ids, block, k)
        cols = list(zip(*found, strict=True)) or [(), (), ()]
        return pa.table(
            {n: pa.array(c, pa.int64()) for n, c in zip(("query_id", "vec_id", "score"), cols, strict=True)}
        )

    def _matrix(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        table = table.sort_by("vec_id").combine_chunks()
        flat = table["v"].combine_chunks()
        flat = (flat.chunk(0) if isinstance(flat, pa.ChunkedArray) else flat).flatten()
        return np.asarray(table["vec_id"]), np.asarray(flat).reshape(table.num_rows, -1)

    found = (
        left.groupBy(*keys).cogroup(right.groupBy(*keys))
        .applyInArrow(run, "query_id long, vec_id long, score long")
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
