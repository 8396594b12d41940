"""Language of texts by prediction by partial matching over bytes."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shardsync.llm.common import encoders_freed, held_out, pieces_of
from shardsync.llm.words import FOLD

UNKNOWN = "und"
_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)
_LETTER = np.zeros(256, bool)
_LETTER[0x41:0x5B] = _LETTER[0x61:0x7B] = True


class Lookup:
    """Rows of floats by 64-bit key, with vectorised open addressing."""

    def __init__(self, keys: np.ndarray, rows: np.ndarray):
        self._bits = max(4, int(2 * len(keys)).bit_length())
        self._keys = np.full(1 << self._bits, _EMPTY, np.uint64)
        self._at = np.zeros(1 << self._bits, np.int32)
        self.rows = rows
        left, slot = np.arange(len(keys)), self._slot(keys)
        while len(left):
            free = self._keys[slot] == _EMPTY
            self._keys[slot[free]] = keys[left[free]]
            mine = self._keys[slot] == keys[left]
            self._at[slot[mine]] = left[mine]
            left, slot = left[~mine], (slot[~mine] + 1) & (len(self._keys) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (keys * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - self._bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The row number of each key, -1 where there is none."""
        slot = self._slot(keys)
        seen = self._keys[slot]
        out = np.where(seen == keys, self._at[slot], -1)
        left = np.flatnonzero((seen != keys) & (seen != _EMPTY))
        while len(left):
            slot[left] = (slot[left] + 1) & (len(self._keys) - 1)
            seen = self._keys[slot[left]]
            hit = seen == keys[left]
            out[left[hit]] = self._at[slot[left[hit]]]
            left = left[~hit & (seen != _EMPTY)]
        return out


@dataclass
class Model:
    """Frozen statistics of all languages. ``coded[k]`` has the bits of a byte that
    was seen after a context of ``k`` bytes, ``escaped[k]`` those of leaving that
    context; one float for each language."""

    names: list[str]
    order: int
    coded: list[Lookup]
    escaped: list[Lookup]
    nothing: np.ndarray

    def bits(self, data: np.ndarray, offsets: np.ndarray, window: int = 1 << 19) -> np.ndarray:
        """Code length in bits of each text under each language. Bytes are coded a window
        at a time, each with the bytes before it, so memory doesn't grow with a text."""
        out = np.zeros((len(offsets) - 1, len(self.names)))
        for at in range(0, len(data), window):
            end, lo = min(len(data), at + window), max(0, at - self.order)
            grams = _grams(data[lo:end], np.clip(offsets, lo, end) - lo, self.order)[at - lo :]
            sums = np.zeros((end - at + 1, len(self.names)))
            np.cumsum(self._coded(grams), axis=0, dtype=np.float64, out=sums[1:])
            places = np.clip(offsets, at, end) - at
            out += sums[places[1:]] - sums[places[:-1]]
        return out

    def _coded(self, grams: np.ndarray) -> np.ndarray:
        """The bits of each byte under each language."""
        row = self.coded[self.order].find(grams)
        total = self.coded[self.order].rows.take(row, axis=0, mode="wrap")
        left = np.flatnonzero(row < 0)
        total[left] = 0
        left = self._escape(total, left, grams[left] >> np.uint64(8), self.order)
        for size in range(self.order - 1, -1, -1):
            mask = np.uint64((1 << (8 * (size + 1))) - 1)
            keys = grams[left] & mask
            row = self.coded[size].find(keys)
            hit = row >= 0
            total[left[hit]] += self.coded[size].rows[row[hit]]
            left, keys = left[~hit], keys[~hit]
            if not len(left):
                break
            left = self._escape(total, left, keys >> np.uint64(8), size)
        total[left] += self.nothing
        return total

    def _escape(self, total: np.ndarray, left: np.ndarray, contexts: np.ndarray, size: int):
        row = self.escaped[size].find(contexts)
        out = row >= 0
        total[left[out]] += self.escaped[size].rows[row[out]]
        return left


def _grams(data: np.ndarray, offsets: np.ndarray, order: int) -> np.ndarray:
    """For each byte, itself and the ``order`` bytes before it, as one number. Before
    a text stand line ends."""
    width = order + 1
    out = data.astype(np.uint64)
    first = np.repeat(offsets[:-1], np.diff(offsets))
    place = np.arange(len(data)) - first
    for back in range(1, width):
        before = np.full(len(data), 10, np.uint64)
        inside = place >= back
        before[inside] = data[np.flatnonzero(inside) - back]
        out |= before << np.uint64(8 * back)
    return out


def fit(texts: list[tuple[str, str]], order: int = 4) -> Model:
    """A model from (language, text) pairs.

    Method C with exclusion: after a context seen N times with q different bytes, a
    byte seen n times has n of N + q parts and the escape q; in the next shorter
    context the bytes of the longer one no longer count. Below the empty context all
    bytes not yet seen are alike. The lengths are exact: in every context the
    probabilities of the 256 bytes add up to 1."""
    raw: dict[str, list[bytes]] = {}
    for lang, text in texts:
        if text:
            raw.setdefault(lang, []).append(text.encode("utf-8", "replace"))
    names = sorted(raw)
    levels = range(order + 1)
    counts = {name: _counts(raw[name], order) for name in names}
    grams = [_union(counts[name][k][0] for name in names) for k in levels]
    contexts = [_union(counts[name][k][0] >> np.uint64(8) for name in names) for k in levels]
    coded = [np.zeros((len(g), len(names)), np.float32) for g in grams]
    escaped = [np.zeros((len(c), len(names)), np.float32) for c in contexts]
    nothing = np.zeros(len(names), np.float32)
    for lang, name in enumerate(names):
        nothing[lang] = np.log2(max(1, 256 - len(counts[name][0][0])))
        shorter = None
        for k in levels:
            keys, n = counts[name][k]
            own, start = np.unique(keys >> np.uint64(8), return_index=True)
            kinds = np.diff(np.append(start, len(keys)))
            parts = np.add.reduceat(n, start) + kinds
            leave = np.log2(parts / kinds)
            if shorter:
                short_keys, short_n, short_own, short_parts = shorter
                seen = short_n[np.searchsorted(short_keys, keys & _mask(k))]
                whole = short_parts[np.searchsorted(short_own, own & _mask(k - 1))]
                leave += np.log2((whole - np.add.reduceat(seen, start)) / whole)
                bits = coded[k - 1][np.searchsorted(grams[k - 1], grams[k] & _mask(k)), lang]
            else:
                bits = np.full(len(grams[k]), nothing[lang])
            escaped[k][np.searchsorted(contexts[k], own), lang] = leave
            bits = bits + escaped[k][np.searchsorted(contexts[k], grams[k] >> np.uint64(8)), lang]
            bits[np.searchsorted(grams[k], keys)] = np.log2(np.repeat(parts, kinds) / n)
            coded[k][:, lang] = bits
            shorter = keys, n, own, parts
    return Model(
        names,
        order,
        [Lookup(k, r) for k, r in zip(grams, coded, strict=True)],
        [Lookup(k, r) for k, r in zip(contexts, escaped, strict=True)],
        nothing,
    )


def fold(data: np.ndarray) -> np.ndarray:
    """UTF-8 bytes with A-Z and the capital Latin letters of U+00C0 to U+00DE in
    lower case, so that texts in capitals read like the others."""
    data = FOLD[data]
    after = np.flatnonzero(data[:-1] == 0xC3) + 1
    capital = (data[after] >= 0x80) & (data[after] <= 0x9E) & (data[after] != 0x97)
    data[after[capital]] += np.uint8(32)
    return data


def _mask(size: int) -> np.uint64:
    return np.uint64((1 << (8 * size)) - 1)


def _counts(raw: list[bytes], order: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Sorted distinct runs of k + 1 bytes and how often each occurs, for each k."""
    grams = _grams(fold(np.frombuffer(b"".join(raw), np.uint8)), np.cumsum([0, *map(len, raw)]), order)
    return [np.unique(grams & _mask(k + 1), return_counts=True) for k in range(order + 1)]


def _union(keys: Iterator[np.ndarray]) -> np.ndarray:
    keys = list(keys)
    return np.unique(np.concatenate(keys)) if keys else np.empty(0, np.uint64)


def training_sample(
    docs: DataFrame, rows: int = 2000, most_bytes: int = 16_384, languages: int = 256
) -> list[tuple[str, str]]:
    """At most about ``rows`` (language, text) pairs, as many of each language as there are
    rows for it, one at least. Held-out rows are never learned from.

    Rows are drawn within their language by a hash of id and text, and rows that are equal
    in both count once, so no language, id or copy crowds out others. Of a longer text
    four windows spread over all of it are learned, ``most_bytes`` characters together.
    ``languages`` bounds how many are learned: those with the most texts (about; ties by name)."""
    scale, quarter = 1 << 40, most_bytes // 4
    n = F.length("text")
    starts = [F.floor((n - quarter) * k / 3).cast("int") + 1 for k in range(4)]
    windows = F.concat(*(F.substring("text", s, F.lit(quarter)) for s in starts))
    learn = docs.where(
        ~held_out(F.col("doc_id")) & F.col("lang").isNotNull() & (F.octet_length("text") > 0)
    ).select(
        F.col("lang").cast("string").alias("lang"),
        F.when(n > most_bytes, windows).otherwise(F.col("text")).alias("text"),
        F.xxhash64("doc_id", "text").alias("h"),
    )
    # bounded by the number of languages that are learned
    different = F.approx_count_distinct("h", 0.02).alias("texts")
    sizes = learn.groupBy("lang").agg(different).orderBy(F.desc("texts"), "lang").limit(languages).collect()
    if not sizes:
        return []
    each = max(1, rows // len(sizes))
    # twice the share, so that chance rarely leaves a language short; then exactly
    shares = docs.sparkSession.createDataFrame(
        [(r.lang, int(min(1, (2 * each + 20) / max(1, r.texts)) * scale)) for r in sizes], "lang string, share long"
    )
    lucky = F.pmod(F.xxhash64("h"), F.lit(scale))
    drawn = learn.join(F.broadcast(shares), "lang").where(lucky <= F.col("share")).dropDuplicates(["lang", "h"])
    order = Window.partitionBy("lang").orderBy(lucky, "h")
    taken = drawn.withColumn("n", F.row_number().over(order)).where(F.col("n") <= each)
    return [(r.lang, r.text) for r in taken.orderBy("lang", "n").select("lang", "text").collect()]


def usual_bits(docs: DataFrame, model: Model, share: float = 0.99, least: int = 200) -> float | None:
    """Bits a byte that all but 1 - ``share`` of the held-out labelled texts need at most, from
    all of those of ``least`` bytes or more; None, if there are fewer than 50. Rows that are
    equal in id and text count once. The rank is right to one in 100,000 rows."""
    known = docs.where(held_out(F.col("doc_id")) & F.col("lang").isin(model.names) & (F.octet_length("text") >= least))
    known = known.select("text", F.xxhash64("doc_id", "text").alias("h"))
    found = predict_language(known, model, keep=("h",)).dropDuplicates(["h"]).agg(
        F.percentile_approx("bits_per_byte", share, 100_000).alias("bits"), F.count("bits_per_byte").alias("n")
    ).first()
    return found.bits if found.n >= 50 else None


def predict_language(
    docs: DataFrame, model: Model, evidence: int = 64, keep: tuple[str | Column, ...] = ("doc_id",)
) -> DataFrame:
    """``keep`` with ``lang_pred``, ``score`` and ``bits_per_byte`` (of the best
    language's code; null for no bytes), one row for each row of ``docs``.

    Only the whole ``text`` decides. Null texts, texts without a letter, and every
    text if nothing was learned, are ``und`` with score 0. Otherwise the language
    with the shortest code wins (ties: the first by name); the score is its share if
    the code lengths, brought down to ``evidence`` bytes, are taken for
    probabilities. Rows that repeat come out as often as they came in."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(*keep)
    n_keep = len(rows.columns)
    if "text" in rows.columns:
        at = rows.columns.index("text")
    else:
        rows, at = docs.select(*keep, "text"), n_keep
    kind = T.StructType(
        [
            *rows.schema[:n_keep],
            T.StructField("lang_pred", T.StringType()),
            T.StructField("score", T.DoubleType()),
            T.StructField("bits_per_byte", T.DoubleType()),
        ]
    )

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoders_freed()
        model = shared.value
        for batch in batches:
            texts = batch.column(at)
            made = [_judge(model, evidence, texts[lo:hi], d, o) for lo, hi, d, o in pieces_of(texts, 1 << 19)]
            lang, score, each = (
                [x for part in made for x in part[k]] for k in range(3)
            )
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[:n_keep],
                    pa.array(lang, pa.string()),
                    pa.array(score, pa.float64()),
                    pa.array(each, pa.float64()),
                ],
                names=kind.names,
            )

    return rows.mapInArrow(predict, kind)


def _judge(
    model: Model, evidence: int, texts: pa.Array, data: np.ndarray, offsets: np.ndarray
) -> tuple[list, list, list]:
    n = np.diff(offsets)
    if not model.names or not len(data):
        return [UNKNOWN] * len(n), [0.0] * len(n), [None] * len(n)
    bits = model.bits(fold(data), offsets)
    best = bits.argmin(axis=1)
    least = bits[np.arange(len(n)), best]
    scale = np.minimum(1, evidence / np.maximum(n, 1))
    score = 1 / np.exp2(-(bits - least[:, None]) * scale[:, None]).sum(axis=1)
    letter = np.concatenate([[0], np.cumsum(_LETTER[data])])
    has = letter[offsets[1:]] > letter[offsets[:-1]]
    for i in np.flatnonzero(~has & (n > 0)):
        has[i] = any(map(str.isalpha, texts[int(i)].as_py()))
    lang = [model.names[b] if h else UNKNOWN for b, h in zip(best, has, strict=True)]
    each = [x / k if k else None for x, k in zip(least.tolist(), n.tolist(), strict=True)]
    return lang, np.where(has, score, 0.0).tolist(), each


def identify(docs: DataFrame, keep: tuple[str | Column, ...] = ("doc_id",), **sample) -> DataFrame:
    """Learn from the rows of ``docs`` that are not held out and predict them all.
    A table without labelled rows is ``und`` throughout."""
    return predict_language(docs, fit(training_sample(docs, **sample)), keep=keep)
