"""Toxicity scores: gradient-boosted trees over dense features, calibrated."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace
from functools import lru_cache, reduce
from operator import add

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shardsync.llm.common import held_out, written

FOLDS = 3
#: A key that weighs less is in no lexicon.
LEAST_WEIGHT = 1.0
PREFIXES = (4, 5, 6, 7)
#: Words that speak to the reader, in English, French, German and Spanish.
SECOND_PERSON = frozenset(
    "you your yours yourself u ur tu te toi ton ta tes vous votre vos du dich dir dein deine "
    "deiner euch ihr sie tú ti tuyo usted ustedes vosotros".split()
)
#: Signs and digits that stand in for letters.
_LOOKALIKES = str.maketrans("013457@$!|", "oieastasii")
_KNOWN = 200_000
#: Longer tokens are known by their digest, and their form isn't remembered.
_LONG = 256
#: Signs at the end of a plain word.
_ENDS = frozenset(".,;:?!")
#: Words that a sign joins to one token.
_JOINED = re.compile(r"(?<=[^\W\d_])[,/\\_\-\u2013\u2014;:|]+(?=[^\W\d_])")
#: Tokens whose form is remembered; only speed depends on it.
_FORMS = 1 << 16
#: Facts about one token; each is summed over a text.
TOKEN = ("n", "word", "prefix", "hit", "near_hit", "you", "shout", "upper", "chars", "marks", "bangs", "masked")
FEATURES = (
    "hit_density", "hits", "near_density", "near_hits", "word_weight", "prefix_weight", "addressed",
    "shouting", "capitals", "marks", "bangs", "masked", "length", "repeats",
)


def words_of(token: str) -> list[str]:
    """A token, or the words of two letters and more that signs join to it."""
    if token.isalpha():
        return [token]
    parts = _JOINED.split(token)
    return parts if len(parts) > 1 and min(map(len, parts)) > 1 else [token]


@lru_cache(maxsize=_FORMS)
def canonical(token: str) -> str:
    """Lower case, look-alikes turned back between letters, other signs removed."""
    bare = token.lower().strip("!|.,;:?\"'()[]{}*#%&$-_")
    if any(map(str.isalpha, bare)) and not bare.isalpha():
        bare = "".join(filter(str.isalpha, bare.translate(_LOOKALIKES)))
    return bare


@lru_cache(maxsize=_FORMS)
def keys_of(word: str) -> tuple[str, ...]:
    """What the lexicon may know a word by: itself, and its beginnings."""
    return (word, *(word[:k] + "+" for k in PREFIXES if len(word) >= k))


@lru_cache(maxsize=_FORMS)
def form_of(token: str) -> tuple[float, ...]:
    """The facts about a token that need no lexicon."""
    word = canonical(token)
    letters = sum(map(str.isalpha, token))
    upper = sum(map(str.isupper, token))
    marks = len(token) - sum(map(str.isalnum, token))
    inner = token.strip("!|.,;:?\"'()[]{}*#%&$-_")
    masked = letters and not inner.isalpha() and word != "".join(filter(str.isalpha, token.lower()))
    return (
        word in SECOND_PERSON, letters > 1 and upper == letters, upper, len(token), marks,
        token.count("!"), bool(masked),
    )


def _form(made: Callable, token: str):
    """What a cached function makes of a token; long ones don't fill its cache."""
    return made(token) if len(token) <= _LONG else made.__wrapped__(token)


@dataclass
class Lexicon:
    """How much likelier a word, or a beginning of words, makes a text toxic: the log
    of the odds ratio, for those above 1."""

    weights: dict[str, float]

    def facts(self, token: str) -> tuple[float, ...]:
        """Facts about a whole token; of words joined in it, those that weigh most. A
        plain word, with a first capital or a sign at its end perhaps, takes the fast way."""
        marks = token[-1] in _ENDS
        word = token[:-1] if marks else token
        upper = not word.islower() and word[1:].islower()
        low = word.lower() if upper else word
        if len(word) > 1 and word.isalpha() and low.islower() and low.isalpha() and len(word) <= _LONG:
            known, start = self._weigh(low)
            you = low in SECOND_PERSON
            return (
                1.0, known, start, known >= 3.0, start >= 1.5, you, False, upper, len(token), marks,
                token[-1] == "!", False,
            )
        return self._any_facts(token)

    def _weigh(self, word: str) -> tuple[float, float]:
        get, size = self.weights.get, len(word)
        start = max((get(word[:k] + "+", 0.0) for k in PREFIXES if size >= k), default=0.0)
        return get(word, 0.0), start

    def _any_facts(self, token: str) -> tuple[float, ...]:
        known = start = 0.0
        for part in words_of(token):
            own = self._weigh(_form(canonical, part))
            known, start = max(known, own[0]), max(start, own[1])
        return (1.0, known, start, known >= 3.0, start >= 1.5, *_form(form_of, token))


class Reader:
    """Features of whole texts. Facts about tokens met before are looked up."""

    def __init__(self, lexicon: Lexicon):
        self._lexicon = lexicon
        self._reset()

    def _reset(self) -> None:
        self._number: dict[str, int] = {}
        self._table = np.zeros((1 << 12, len(TOKEN)), np.float32)

    def _numbers(self, tokens: list[str]) -> np.ndarray:
        number = self._number
        if len(number) > _KNOWN:
            self._reset()
            number = self._number
        names = tokens
        if max(map(len, tokens)) > _LONG:
            names = [t if len(t) <= _LONG else xxhash.xxh3_128_digest(t.encode()) for t in tokens]
        new = {n: t for n, t in zip(names, tokens, strict=True) if n not in number}
        if new:
            at = len(number)
            while at + len(new) > len(self._table):
                self._table = np.concatenate([self._table, np.zeros_like(self._table)])
            facts = list(map(self._lexicon.facts, new.values()))
            self._table[at : at + len(new)] = np.array(facts, np.float32)
            number.update(zip(new, range(at, at + len(new)), strict=True))
        return np.fromiter(map(number.__getitem__, names), np.int64, len(tokens))

    def read(self, text: str | None) -> list[float]:
        tokens = (text or "").split()
        if not tokens:
            return [0.0] * len(FEATURES)
        found = self._numbers(tokens)
        total = np.zeros(len(TOKEN))
        for at in range(0, len(found), 1 << 16):
            total += self._table[found[at : at + (1 << 16)]].sum(axis=0, dtype=np.float64)
        x = dict(zip(TOKEN, total.tolist(), strict=True))
        n, chars = x["n"], x["chars"]
        addressed = 0.0
        if x["you"] and x["hit"]:
            hits, you = (np.flatnonzero(self._table[found, TOKEN.index(c)]) for c in ("hit", "you"))
            after = np.searchsorted(you, hits)
            left = hits - you[np.maximum(after - 1, 0)]
            right = you[np.minimum(after, len(you) - 1)] - hits
            addressed = float(((np.abs(left) <= 5) | (np.abs(right) <= 5)).sum())
        return [
            x["hit"] / n, math.log1p(x["hit"]), x["near_hit"] / n, math.log1p(x["near_hit"]),
            x["word"] / n, x["prefix"] / n, addressed / n, x["shout"] / n, x["upper"] / chars,
            x["marks"] / chars, x["bangs"] / n, x["masked"] / n, math.log1p(n),
            float((found[1:] == found[:-1]).mean()) if n > 1 else 0.0,
        ]


def training_rows(docs: DataFrame, labels: DataFrame, rows: int = 20_000) -> DataFrame:
    """About ``rows`` labelled documents at most (all, if there are fewer), by the
    digests of their ids: ``text``, ``label``, ``fold``. An id that repeats gives one row,
    the one with the greatest text, so that the bound holds for any table. Held-out rows, rows without
    text, id or label, and labels that contradict each other are not learned from."""
    marks = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg(
        F.min("toxic").alias("label"), F.max("toxic").alias("most")
    ).where("label = most").select("doc_id", F.col("label").cast("double").alias("label"))
    marks = written(marks.where(~held_out(F.col("doc_id"))), "toxic-marks")
    scale = 1 << 40
    share = int(min(1.0, rows / max(1, marks.count())) * scale)
    marks = marks.where(F.pmod(F.xxhash64("doc_id"), F.lit(scale)) <= share)
    fold = F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(FOLDS)).cast("int").alias("fold")
    joined = docs.select("doc_id", "text").where("text IS NOT NULL").join(marks, "doc_id")
    joined = joined.groupBy("doc_id", "label").agg(F.max("text").alias("text"))
    return written(joined.select("text", "label", fold), "toxic-rows")


def learn_lexicons(rows: DataFrame) -> list[Lexicon]:
    """One lexicon for each fold, learned from the other folds, and one from all.

    A key counts once for each document; the odds are shrunk by five documents of the
    overall kind. All keys in three toxic documents or more are weighed, in Spark, and
    those that weigh enough make the lexicons: their number is bounded by the sample."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: Counter = Counter()
            for text, label, fold in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                parts = {w for t in set((text or "").split()) for w in words_of(t)}
                words = {_form(canonical, w) for w in parts} - {""}
                seen.update((k, fold, label) for k in {k for w in words for k in _form(keys_of, w)} if len(k) <= _LONG)
            cols = list(zip(*((*k, n) for k, n in seen.items()), strict=True)) or [()] * 4
            kinds = (pa.string(), pa.int32(), pa.float64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], ["key", "fold", "label", "n"]
            )

    size = {(r.fold, r.label): r["count"] for r in rows.groupBy("fold", "label").count().collect()}
    seen = rows.select("text", "label", "fold").mapInArrow(count, "key string, fold int, label double, n long")
    columns = [
        F.sum(F.when((F.col("fold") == f) & (F.col("label") == v), F.col("n")).otherwise(0)).alias(f"n{f}_{v}")
        for f in range(FOLDS) for v in (0, 1)
    ]
    toxic = sum((F.col(f"n{f}_1") for f in range(1, FOLDS)), F.col("n0_1"))
    every = list(range(FOLDS))
    learned_from = [*([g for g in every if g != f] for f in every), every]
    weights = [_weight(folds, size).alias(f"w{i}") for i, folds in enumerate(learned_from)]
    heavy = F.greatest(*(f"w{i}" for i in range(len(learned_from)))) > LEAST_WEIGHT
    table = seen.groupBy("key").agg(*columns).where(toxic >= 3).select("key", *weights).where(heavy).collect()
    return [Lexicon({r.key: r[f"w{i}"] for r in table if r[f"w{i}"] > LEAST_WEIGHT}) for i in range(len(learned_from))]


def _weight(folds: list[int], size: dict) -> Column:
    """The log of a key's odds ratio by the documents of some folds."""
    bad, good = (sum(size.get((f, float(v)), 0) for f in folds) for v in (1, 0))
    if not bad or not good:
        return F.lit(0.0)
    prior = bad / (bad + good)
    toxic, clean = (reduce(add, (F.col(f"n{f}_{v}") for f in folds)) for v in (1, 0))
    rate = (toxic + 5 * prior) / (toxic + clean + 5)
    return F.log(rate / (1 - rate)) - math.log(prior / (1 - prior))


def _per_text(
    rows: DataFrame,
    lexicons: list[Lexicon],
    keep: tuple[str, ...],
    finish: Callable[[np.ndarray], list[np.ndarray]],
    names: tuple[str, ...],
    by: str | None = None,
) -> DataFrame:
    """``keep`` and the columns ``names``, which ``finish`` makes of the features of a
    batch. The column ``by`` names each row's lexicon; without it the last one is used."""
    shared = rows.sparkSession.sparkContext.broadcast(lexicons)
    given = rows.select(*keep, "text")
    fold = keep.index(by) if by else None

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        readers = [Reader(x) for x in shared.value]
        for batch in batches:
            folds = [-1] * batch.num_rows if fold is None else batch.column(fold).to_pylist()
            texts = batch.column(len(keep))
            made = np.array(
                [readers[f].read(texts[k].as_py()) for k, f in enumerate(folds)], np.float64
            ).reshape(-1, len(FEATURES))
            columns = [pa.array(np.ascontiguousarray(c), pa.float64()) for c in finish(made)]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], *columns], [*keep, *names])

    kind = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in given.schema[: len(keep)])
    return given.mapInArrow(read, ", ".join([kind, *(f"{c} double" for c in names)]))


@dataclass
class Trees:
    """Boosted trees of equal depth. Node ``k`` of a tree has the children ``2k + 1``
    (at most the cut) and ``2k + 2``; the last level are the leaves."""

    start: float
    features: np.ndarray
    cuts: np.ndarray
    leaves: np.ndarray

    def margin(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.start)
        row = np.arange(len(x))
        for feature, cut, leaf in zip(self.features, self.cuts, self.leaves, strict=True):
            node = np.zeros(len(x), np.int64)
            while len(x) and node[0] < len(feature):
                node = 2 * node + 1 + (x[row, feature[node]] > cut[node])
            total += leaf[node - len(feature)]
        return total


def grow_trees(
    x: np.ndarray, y: np.ndarray, trees: int = 30, depth: int = 3, step: float = 0.2,
    bins: int = 64, smallest: int = 5,
) -> Trees:
    """Gradient boosting of the log loss. Each node takes the cut of the largest gain,
    by sums of first and second derivatives over the bins of each feature; no side of
    a cut has fewer than ``smallest`` rows."""
    share = np.linspace(0, 1, bins // 2 + 1)[:-1]
    edges = [np.unique(np.quantile(c, share)) for c in x.T]
    edges = [np.unique(np.r_[e, np.quantile(np.unique(c), share)]) for e, c in zip(edges, x.T, strict=True)]
    n_bins = max(map(len, edges)) + 1
    found = np.stack([np.searchsorted(e, c) for e, c in zip(edges, x.T, strict=True)], axis=1)
    cut_of = np.full((x.shape[1], n_bins), np.inf)
    for at, e in enumerate(edges):
        cut_of[at, : len(e)] = e
    rate = y.mean()
    start = math.log(rate / (1 - rate))
    total, row = np.full(len(x), start), np.arange(len(x))
    inner = 2**depth - 1
    features, cuts = np.zeros((trees, inner), np.int64), np.full((trees, inner), np.inf)
    leaves = np.zeros((trees, inner + 1))
    width = x.shape[1] * n_bins
    for tree in range(trees):
        p = 1 / (1 + np.exp(-total))
        slope, bend = y - p, p * (1 - p)
        node = np.zeros(len(x), np.int64)
        for level in range(depth):
            first, many = 2**level - 1, 2**level
            place = ((node - first)[:, None] * width + np.arange(x.shape[1]) * n_bins + found).ravel()
            g, h, n = (
                np.bincount(place, np.repeat(w, x.shape[1]), many * width)
                .reshape(many, x.shape[1], n_bins).cumsum(axis=2)
                for w in (slope, bend, np.ones(len(x)))
            )
            rest = [s[:, :, -1:] - s for s in (g, h, n)]
            gain = g**2 / (h + 1) + rest[0] ** 2 / (rest[1] + 1) - g[:, :, -1:] ** 2 / (h[:, :, -1:] + 1)
            gain[(n < smallest) | (rest[2] < smallest)] = 0.0
            best = gain.reshape(many, width).argmax(axis=1)
            useful = gain.reshape(many, width)[np.arange(many), best] > 1e-9
            feature, bin_ = best // n_bins, best % n_bins
            features[tree, first : first + many] = feature
            cuts[tree, first : first + many] = np.where(useful, cut_of[feature, bin_], np.inf)
            node = 2 * node + 1 + (x[row, features[tree][node]] > cuts[tree][node])
        leaf = node - inner
        g, h = (np.bincount(leaf, w, inner + 1) for w in (slope, bend))
        leaves[tree] = step * g / (h + 1)
        total += leaves[tree][leaf]
    return Trees(start, features, cuts, leaves)


def isotonic(raw: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ends and heights of the steps of the best rising fit of ``y`` to ``raw``:
    neighbours that fall are pooled. Between steps one interpolates."""
    at, group = np.unique(raw, return_inverse=True)
    steps: list[list[float]] = []
    for x, s, n in zip(at, np.bincount(group, y), np.bincount(group), strict=True):
        steps.append([x, x, s, n])
        while len(steps) > 1 and steps[-2][2] * steps[-1][3] >= steps[-1][2] * steps[-2][3]:
            _, last, s1, n1 = steps.pop()
            steps[-1][1:] = [last, steps[-1][2] + s1, steps[-1][3] + n1]
    ends = np.array([s[:2] for s in steps]).ravel()
    return ends, np.repeat([s[2] / s[3] for s in steps], 2)


@dataclass
class Scorer:
    lexicon: Lexicon
    trees: Trees
    ends: np.ndarray
    heights: np.ndarray

    def scores(self, features: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(self.trees.margin(features), self.ends, self.heights), 0.0, 1.0)


def fit(docs: DataFrame, labels: DataFrame, rows: int = 20_000, trees: int = 30) -> Scorer | None:
    """A scorer, or None where the labelled rows aren't of both kinds.

    Spark chooses the sample, counts the lexicon and reads the features. Trees and
    calibration are fitted to the sample's features alone, ``rows`` times
    ``FEATURES`` numbers whatever the size of the corpus.

    Lexicon features of a training row come from the other folds' rows. Trees are
    grown on all folds but the last, on whose rows the calibration is fitted; if that
    lacks a kind, on all rows both."""
    learn = training_rows(docs, labels, rows)
    if {r.label for r in learn.select("label").distinct().collect()} != {0.0, 1.0}:
        return None
    lexicons = learn_lexicons(learn)
    read = _per_text(learn, lexicons, ("label", "fold"), lambda made: list(made.T), FEATURES, by="fold")
    table = np.array([tuple(r) for r in read.collect()], np.float64)
    table = table[np.lexsort(table.T)]  # sums don't depend on the order of tasks
    y, last, x = table[:, 0], table[:, 1] == FOLDS - 1, table[:, 2:]
    apart = all(len(set(y[part])) == 2 for part in (last, ~last))
    grow, check = (~last, last) if apart else (slice(None), slice(None))
    model = grow_trees(x[grow], y[grow], trees)
    return Scorer(lexicons[-1], model, *isotonic(model.margin(x[check]), y[check]))


def score_toxicity(
    docs: DataFrame, scorer: Scorer | None, keep: tuple[str, ...] = ("doc_id",), threshold: float = 0.7
) -> DataFrame:
    """``keep``, ``score`` (0 to 1) and ``predicted`` for each row of ``docs``, by the
    whole ``text`` alone. Null and empty texts have all features 0 and get that score.
    Without a scorer all scores are 0. Rows that repeat come out as often as they came
    in; an empty table gives no rows."""
    if scorer is None:
        scored = docs.select(*keep, F.lit(0.0).alias("score"))
    else:
        bare = replace(scorer, lexicon=Lexicon({}))  # the words go by broadcast
        scored = _per_text(docs, [scorer.lexicon], keep, lambda made: [bare.scores(made)], ("score",))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
