"""Hard negatives: angles to reference directions bound scores before they are made."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shardsync.llm.common import written

#: Reference directions.
DIRECTIONS = 16
#: Rows, at most, that every task searches first so that it knows good scores to beat.
SEEDS = 512
#: Candidates in a window, and anchors that meet it at once.
WINDOW, ANCHORS = 256, 512
#: Added to angles, and relative to the norms, before a score is ruled out.
SLACK = 1e-6
#: Products of two norms up to this square are exact in doubles.
EXACT_NORM = float(1 << 26)
_MOST = (1 << 63) - 1


def usable_rows(vectors: DataFrame, scale: int = 256) -> DataFrame:
    """``vec_id``, ``label``, ``v``: floor(``scale`` * x) of each component, as doubles.
    Rows with a null id, label or vector, an empty vector or a null, NaN or infinite
    component are left out; what exceeds a long counts as the nearest long. Of rows
    that repeat an id, the one with the largest vector, then label, counts."""
    whole = F.transform("embedding", lambda x: F.floor(x.cast("double") * scale).cast("double"))
    bad = F.exists(
        "embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf"))
    )
    good = vectors.where(
        F.col("vec_id").isNotNull() & F.col("label").isNotNull() & (F.size("embedding") > 0)
    ).where(~bad)
    rows = good.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.struct(whole.alias("v"), F.col("label").cast("long").alias("label")).alias("row"),
    )
    return rows.groupBy("vec_id").agg(F.max("row").alias("row")).select("vec_id", "row.label", "row.v")


@dataclass
class Rows:
    """Vectors with what is stored about them."""

    ids: np.ndarray
    labels: np.ndarray
    v: np.ndarray
    norms: np.ndarray
    angles: np.ndarray

    @staticmethod
    def of(table: pa.Table) -> Rows:
        def matrix(name: str) -> np.ndarray:
            column = table[name].combine_chunks()
            column = column.chunk(0) if isinstance(column, pa.ChunkedArray) else column
            return np.asarray(column.flatten()).reshape(table.num_rows, -1)

        flat = [np.asarray(table[name]) for name in ("vec_id", "label", "norm")]
        return Rows(flat[0], flat[1], matrix("v"), flat[2], matrix("angles"))

    def take(self, at: np.ndarray | slice) -> Rows:
        return Rows(self.ids[at], self.labels[at], self.v[at], self.norms[at], self.angles[at])

    def windows(self) -> Iterator[Rows]:
        """Pieces of the rows nearest to one direction, by their angle to it."""
        cell = self.angles.argmin(axis=1)
        angle = self.angles[np.arange(len(cell)), cell]
        for c in np.unique(cell):
            own = np.flatnonzero(cell == c)
            own = own[np.lexsort((self.ids[own], angle[own]))]
            for at in range(0, len(own), WINDOW):
                yield self.take(own[at : at + WINDOW])


@dataclass
class Wanted:
    """For each search: its anchor's place, the scores it takes, and whether its label
    must be the anchor's or another."""

    owner: np.ndarray
    low: np.ndarray
    high: np.ndarray
    same: bool


@lru_cache(maxsize=64)
def _by_rule(size: int) -> np.ndarray:
    made = np.random.default_rng(size).normal(size=(DIRECTIONS, size))
    return made / np.linalg.norm(made, axis=1)[:, None]


def measured(v: np.ndarray, directions: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Norms, and angles to the directions; a zero vector's are right angles."""
    norms = np.sqrt((v * v).sum(axis=1))
    cosines = (v / np.where(norms > 0, norms, 1)[:, None]) @ directions.T
    return norms, np.arccos(np.clip(cosines, -1, 1))


def score_bounds(anchors: Rows, window: Rows) -> tuple[np.ndarray, np.ndarray]:
    """No inner product of an anchor with a row of the window lies below the first or
    above the second. The angle between two vectors is at least the difference of
    their angles to any direction, and at most their sum, or what that lacks to a full
    turn; norms make scores of cosines."""
    near, far = window.angles.min(axis=0), window.angles.max(axis=0)
    mine = anchors.angles
    least = np.maximum(0, np.maximum(near - mine, mine - far).max(axis=1)) - SLACK
    most = np.minimum(mine + far, 2 * np.pi - mine - near).min(axis=1) + SLACK
    high, low = np.cos(np.clip(least, 0, np.pi)), np.cos(np.clip(most, 0, np.pi))
    small, large = window.norms.min(), window.norms.max()
    slack = SLACK * anchors.norms * large + SLACK
    top = anchors.norms * high * np.where(high > 0, large, small) + slack
    bottom = anchors.norms * low * np.where(low > 0, small, large) - slack
    return bottom, top


class Best:
    """The k best (score, smaller id first) of each search so far. ``floor`` is what the
    k-th best of all rows reaches at least."""

    def __init__(self, searches: int, k: int, floor: np.ndarray | None = None):
        self.k = k
        self.score = np.full((searches, k), -np.inf)
        self.id = np.full((searches, k), np.iinfo(np.int64).max)
        self.floor = np.full(searches, -np.inf) if floor is None else floor

    @property
    def bar(self) -> np.ndarray:
        return np.maximum(self.floor, self.score[:, -1])

    def add(self, at: int, scores: np.ndarray, ids: np.ndarray) -> None:
        score = np.concatenate([self.score[at], scores])
        known = np.concatenate([self.id[at], ids])
        order = np.lexsort((known, -score))[: self.k]
        self.score[at], self.id[at] = score[order], known[order]


def _search(anchors: Rows, wanted: Wanted, windows: list[Rows], best: Best) -> None:
    for window in windows:
        bottom, top = score_bounds(anchors, window)
        own = wanted.owner
        reach = (top[own] >= np.maximum(wanted.low, best.bar)) & (bottom[own] <= wanted.high)
        live = np.flatnonzero(reach)
        if not len(live):
            continue
        used, place = np.unique(own[live], return_inverse=True)
        scores = (anchors.v[used] @ window.v.T)[place]
        names, labels = anchors.ids[own[live]], anchors.labels[own[live]]
        fit = (scores >= np.maximum(wanted.low[live], best.bar[live])[:, None]) & (
            scores <= wanted.high[live][:, None]
        )
        fit &= (labels[:, None] == window.labels) == wanted.same
        fit &= names[:, None] != window.ids
        for i in np.flatnonzero(fit.any(axis=1)):
            best.add(live[i], scores[i, fit[i]], window.ids[fit[i]])


def _search_large(anchors: Rows, wanted: Wanted, limits: list, rows: Rows, k: int) -> list[tuple]:
    """(search, candidate, score) with Python's whole numbers, for pairs in which either
    vector is beyond exact doubles. A score beyond a long is the nearest long."""
    large = rows.norms > EXACT_NORM
    found = []
    for search, own in enumerate(wanted.owner):
        at = np.arange(len(rows.ids)) if anchors.norms[own] > EXACT_NORM else np.flatnonzero(large)
        if not len(at):
            continue
        low, high = limits[search]
        v = [int(x) for x in anchors.v[own]]
        good = []
        for c in at[(rows.labels[at] == anchors.labels[own]) == wanted.same]:
            if rows.ids[c] != anchors.ids[own]:
                score = sum(a * int(b) for a, b in zip(v, rows.v[c], strict=True))
                score = max(-_MOST - 1, min(_MOST, score))
                if low is None or low <= score <= high:
                    good.append((-score, int(rows.ids[c])))
        found += [(search, i, -s) for s, i in sorted(good)[:k]]
    return found


def search(
    anchors: Rows, owner: np.ndarray, limits: list, same: bool, rows: Rows, seeds: Rows | None, k: int
) -> list[tuple[int, int, int]]:
    """(search, candidate, score): for each search the ``k`` best of ``rows`` within its
    limits. A task's first rows are the seeds; their k-th best is what others must
    reach, and they are not results themselves."""
    spare = [(-np.inf, np.inf) if a is None else (float(a), float(b)) for a, b in limits]
    low, high = np.array(spare).reshape(-1, 2).T
    out = []
    windows = list(rows.take(rows.norms <= EXACT_NORM).windows())
    small = np.flatnonzero(anchors.norms[owner] <= EXACT_NORM)
    for at in range(0, len(small), ANCHORS):
        chosen = small[at : at + ANCHORS]
        wanted = Wanted(owner[chosen], low[chosen], high[chosen], same)
        floor = None
        if seeds is not None:
            first = Best(len(chosen), k)
            _search(anchors, wanted, [seeds.take(seeds.norms <= EXACT_NORM)], first)
            floor = first.bar
        best = Best(len(chosen), k, floor)
        _search(anchors, wanted, windows, best)
        at_place = np.argwhere(best.score > -np.inf)
        out += [(int(chosen[i]), int(best.id[i, j]), int(best.score[i, j])) for i, j in at_place]
    return out + _search_large(anchors, Wanted(owner, low, high, same), limits, rows, k)


def _dealt(rows: DataFrame, anchors: DataFrame, group_rows: int, anchor_rows: int):
    """Candidates and anchors in groups of bounded size, each group once for each group
    of the other side."""
    groups = max(1, -(-rows.count() // group_rows))
    parts = max(1, -(-anchors.count() // anchor_rows))

    def all_of(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    group = F.pmod(F.xxhash64("vec_id"), F.lit(groups)).cast("int")
    part = F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(parts)).cast("int")
    left = rows.withColumn("group", group).withColumn("part", all_of(parts))
    right = anchors.withColumn("part", part).withColumn("group", all_of(groups))
    keys = ["size", "group", "part"]
    return left.groupBy(*keys).cogroup(right.groupBy(*keys))


def hard_negatives(
    vectors: DataFrame, anchors: Column, positives: int = 5, negatives: int = 10, low: int = 30,
    high: int = 90, scale: int = 256, group_rows: int = 32_768, anchor_rows: int = 8_192,
) -> DataFrame:
    """For each row for which ``anchors`` (on ``vec_id``) holds, and each of its
    ``positives`` best rows of the same label, the ``negatives`` best rows of other
    labels that score between ``low`` and ``high`` percent of the positive: ``anchor_id``,
    ``positive_id``, ``rank`` from 1, ``negative_id``, ``positive_score``,
    ``negative_score``.

    A score is the inner product of ``usable_rows``, which says which rows take part;
    ties go to the smaller id. Fewer rows come out where there are fewer, none for an
    anchor without positives or whose window is empty (as for negative positives).
    Vectors are compared with those of their own length. An empty table gives no rows;
    further columns are ignored.

    Every row is stored with its norm and its angles to ``DIRECTIONS`` directions: rows
    drawn by hash, or directions made by a rule for vectors of a less usual length. A
    task holds a group of candidates and a group of anchors, whatever the labels, in
    windows of rows near one direction, by angle. The angles bound each window's scores
    with each anchor; a window that can't reach a score that counts is not scored. Sums
    of whole numbers below 2 ** 53 are exact in doubles; larger vectors are compared
    with Python's whole numbers, theirs alone."""
    rows = written(usable_rows(vectors, scale).withColumn("size", F.size("v")), "rows")
    usual = rows.groupBy("size").count().orderBy(F.desc("count"), "size").limit(1)
    first = rows.join(F.broadcast(usual.select("size")), "size")
    drawn = first.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SEEDS).toArrow()
    seeds = None
    sizes: dict[int, np.ndarray] = {}
    if drawn.num_rows:
        v = np.array(drawn["v"].to_pylist(), float)
        unit = v / np.maximum(np.sqrt((v * v).sum(axis=1)), 1e-300)[:, None]
        sizes[v.shape[1]] = unit[:DIRECTIONS]
        seeds = Rows(np.array(drawn["vec_id"]), np.array(drawn["label"]), v, *measured(v, unit[:DIRECTIONS]))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            norms, angles = np.empty(batch.num_rows), [None] * batch.num_rows
            flat, ends = np.asarray(batch.column("v").flatten()), np.cumsum(np.asarray(batch.column("size")))
            for size in np.unique(np.asarray(batch.column("size"))):
                at = np.flatnonzero(np.asarray(batch.column("size")) == size)
                v = flat[(ends[at] - size)[:, None] + np.arange(size)]
                directions = sizes.get(int(size))
                norm, angle = measured(v, _by_rule(int(size)) if directions is None else directions)
                norms[at] = norm
                for i, a in zip(at, angle, strict=True):
                    angles[i] = a
            extra = [pa.array(norms), pa.array(angles, pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *extra], [*batch.schema.names, "norm", "angles"])

    kept = rows.select("size", "vec_id", "label", "v")
    stored = written(
        kept.mapInArrow(
            measure, "size int, vec_id long, label long, v array<double>, norm double, angles array<double>"
        ),
        "stored",
    )
    asked = stored.where(anchors)

    def one_size(given: Rows) -> Rows | None:
        return seeds if seeds is not None and seeds.v.shape[1] == given.v.shape[1] else None

    def best_of_label(candidates: pa.Table, given: pa.Table) -> pa.Table:
        found, own = [], None
        if candidates.num_rows and given.num_rows:
            own = Rows.of(given)
            owner = np.arange(len(own.ids))
            limits = [(None, None)] * len(owner)
            found = search(own, owner, limits, True, Rows.of(candidates), one_size(own), positives)
        return _table([(int(own.ids[s]), i, x) for s, i, x in found], "anchor_id", "positive_id", "score")

    by_score = Window.partitionBy("anchor_id").orderBy(F.desc("score"), "positive_id")
    good = (
        _dealt(stored, asked, group_rows, anchor_rows)
        .applyInArrow(best_of_label, "anchor_id long, positive_id long, score long")
        .withColumn("rank", F.row_number().over(by_score))
        .where(F.col("rank") <= positives)
    )
    good = written(good.select("anchor_id", "positive_id", "score"), "positives")
    pairs = good.groupBy("anchor_id").agg(
        F.collect_list("positive_id").alias("positives"), F.collect_list("score").alias("scores")
    )
    asked = written(asked.join(pairs, F.col("vec_id") == F.col("anchor_id")).drop("anchor_id"), "anchors")

    def best_of_others(candidates: pa.Table, given: pa.Table) -> pa.Table:
        found, searches = [], []
        if candidates.num_rows and given.num_rows:
            own = Rows.of(given)
            owner, limits = [], []
            lists = zip(given["positives"].to_pylist(), given["scores"].to_pylist(), strict=True)
            for a, (names, scores) in enumerate(lists):
                for name, score in zip(names, scores, strict=True):
                    searches.append((int(own.ids[a]), name, score))
                    owner.append(a)
                    limits.append((-((-low * score) // 100), high * score // 100))
            found = search(
                own, np.array(owner, int), limits, False, Rows.of(candidates), one_size(own), negatives
            )
        return _table(
            [(*searches[s], i, x) for s, i, x in found],
            "anchor_id", "positive_id", "positive_score", "negative_id", "negative_score",
        )

    in_window = Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("negative_score"), "negative_id")
    return (
        _dealt(stored, asked, group_rows, anchor_rows)
        .applyInArrow(
            best_of_others,
            "anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long",
        )
        .withColumn("rank", F.row_number().over(in_window))
        .where(F.col("rank") <= negatives)
        .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    )


def _table(rows: list[tuple], *names: str) -> pa.Table:
    columns = list(zip(*rows, strict=True)) or [()] * len(names)
    return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(names, columns, strict=True)})
