"""Mixing sources by temperature: weights, budgets, and the rows that meet them."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shardsync.llm.common import file_backed, located, written

#: Sources that the driver weighs at most; more are an error, not a cut.
MOST_SOURCES = 100_000
#: Bytes of the table of sources, at most, that every executor gets a copy of.
MOST_BROADCAST = 8 << 20


@dataclass(frozen=True)
class Mix:
    """Tokens to take from each source, and the exponent that led to them."""

    exponent: float
    budgets: dict[str | None, int]


def solve(
    tokens: dict[str | None, int],
    repeats: float | None = None,
    entropy: float | None = None,
    budget: int | None = None,
) -> Mix:
    """Weights are token shares to the power of an exponent from 0 (all alike) to 1
    (as they are), brought to a sum of 1.

    The exponent is found by bisection: the smallest that takes no source's tokens
    more than ``repeats`` times, or the largest whose weights have an entropy (in
    nats) of ``entropy`` at least. What no exponent reaches gives the nearest end.
    Without a ``budget`` the whole is as large as it takes for every source to be
    taken at least once. Sources without tokens have weight 0."""
    known = {s: n for s, n in tokens.items() if n > 0}
    if not known:
        return Mix(1.0, dict.fromkeys(tokens, 0))
    most = max(known.values())

    def parts(a: float) -> dict[str | None, float]:
        raw = {s: (n / most) ** a for s, n in known.items()}
        if budget is None:
            return {s: most * r for s, r in raw.items()}
        whole = math.fsum(raw.values())
        return {s: budget * r / whole for s, r in raw.items()}

    def even_enough(a: float) -> bool:
        whole = math.fsum(found := list(parts(a).values()))
        return -math.fsum(p / whole * math.log(p / whole) for p in found if p) >= entropy

    def rare_enough(a: float) -> bool:
        return all(p <= repeats * known[s] for s, p in parts(a).items())

    if (repeats is None) == (entropy is None):
        raise ValueError("give either a repetition limit or a target entropy")
    good, ends = (rare_enough, (0.0, 1.0)) if repeats is not None else (even_enough, (1.0, 0.0))
    near, far = ends  # the wanted end, and the one that is surely allowed
    if good(near):
        far = near
    for _ in range(100):
        middle = (near + far) / 2
        near, far = (near, middle) if good(middle) else (middle, far)
    return Mix(far, {s: round(parts(far)[s]) if s in known else 0 for s in tokens})


def count_words(text: Column) -> Column:
    """Runs of non-blanks; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def _number(*parts: Column) -> Column:
    """60 bits of a digest of the parts."""
    text = F.concat_ws(":", *parts)
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("long")


def plan_mix(
    docs: DataFrame,
    repeats: float | None = None,
    entropy: float | None = None,
    budget: int | None = None,
    n_tokens: Column | None = None,
    seed: int = 0,
    block_rows: int = 1000,
) -> DataFrame:
    """The rows to take, one for each time a document is taken: ``at`` (its file and
    row), ``doc_id``, ``source``, ``epoch`` from 0, ``n_tokens``, ``block``, ``start``
    (tokens of the source before it) and the source's ``budget``.

    ``n_tokens`` counts a document's tokens (words, if not given); ``solve`` turns the
    sources' sums into budgets. A source's documents are dealt into blocks of about
    ``block_rows`` by their ids' digests. An epoch is all blocks in an order of its
    own; epochs follow each other, and a document is taken while it ends within the
    budget, so no budget is exceeded and the last epoch is cut between documents.

    Positions are sums over blocks first and within blocks then: no task sorts a whole
    source. Null is a source of its own; null and empty texts have no tokens and come
    with every epoch up to the budget's end; a source of such texts only comes once.
    Rows that repeat are taken alike; an empty table gives no rows."""
    tokens = count_words(F.col("text")) if n_tokens is None else n_tokens
    name = F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit(""))
    rows = located(docs, tokens.alias("n_tokens"), "doc_id", "source")
    number = _number(F.lit(str(seed)), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    rows = written(
        rows.select("at", "doc_id", "source", name.alias("name"), "n_tokens", number.alias("h")),
        "mix-rows",
    )
    totals = rows.groupBy("name").agg(
        F.sum("n_tokens").alias("tokens"), F.count("*").alias("rows"), F.first("source").alias("source")
    ).limit(MOST_SOURCES + 1).collect()
    if len(totals) > MOST_SOURCES:
        raise ValueError(f"more than {MOST_SOURCES} sources")
    mix = solve({r.name: r.tokens for r in totals}, repeats, entropy, budget)
    facts = docs.sparkSession.createDataFrame(
        [
            (r.name, r.tokens, mix.budgets[r.name], -(-r.rows // block_rows),
             mix.budgets[r.name] // r.tokens if r.tokens else 0)
            for r in totals
        ],
        "name string, tokens long, budget long, blocks long, passes long",
    )
    if sum(len(r.name.encode()) + 64 for r in totals) <= MOST_BROADCAST:
        facts = F.broadcast(facts)  # else a source's rows meet in the join
    dealt = rows.join(facts.select("name", "blocks"), "name").withColumn(
        "block", F.col("h") % F.col("blocks")
    )
    inside = Window.partitionBy("name", "block").orderBy("h", "doc_id", "n_tokens")
    dealt = written(
        dealt.withColumn(
            "before",
            F.sum("n_tokens").over(inside.rowsBetween(Window.unboundedPreceding, 0)) - F.col("n_tokens"),
        ).drop("blocks", "h"),
        "mix-dealt",
    )
    epochs = (
        dealt.groupBy("name", "block").agg(F.sum("n_tokens").alias("block_tokens"))
        .join(facts, "name")
        .withColumn("epoch", F.explode(F.sequence(F.lit(0).cast("long"), F.col("passes"))))
        .withColumn("turn", _number(F.lit(str(seed)), *(F.col(c).cast("string") for c in ("epoch", "name", "block"))))
    )
    order = Window.partitionBy("name", "epoch").orderBy("turn", "block")
    first = F.sum("block_tokens").over(order.rowsBetween(Window.unboundedPreceding, 0))
    epochs = epochs.select(
        "name", "block", "epoch", "budget",
        (first - F.col("block_tokens") + F.col("epoch") * F.col("tokens")).alias("first"),
    ).where("first <= budget")
    epochs = written(epochs, "mix-epochs")
    start = F.col("first") + F.col("before")
    return (
        dealt.join(epochs, ["name", "block"])
        .where(start + F.col("n_tokens") <= F.col("budget"))
        .select(
            "at", "doc_id", "source", F.col("epoch").cast("int").alias("epoch"), "n_tokens",
            "block", start.alias("start"), "budget",
        )
    )


def mix_documents(docs: DataFrame, **options) -> DataFrame:
    """The documents that ``plan_mix`` takes, with all their columns, each as often as
    it is taken."""
    docs = file_backed(docs)
    taken = plan_mix(docs, **options).groupBy("at").agg(F.count("*").cast("int").alias("times"))
    names = [f"c{k}" for k in range(len(docs.columns))]
    rows = located(docs.toDF(*names), *names).join(taken, "at")
    again = rows.withColumn("n", F.explode(F.sequence(F.lit(1), F.col("times"))))
    return again.select(*names).toDF(*docs.columns)
