"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shardsync.llm.common import written


def components(links: DataFrame) -> DataFrame:
    """The smallest node that each node of ``links`` (``a``, ``b``) reaches: ``node``,
    ``comp``.

    Each round a node takes the smallest label among its neighbours' and then its
    label's own label, so long chains halve. Rounds are written tables; the joins
    read both sides from tables, so that adaptive execution can split a node with
    very many links. No row leaves the executors."""
    pairs = links.select("a", "b").unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    pairs = written(pairs.where("a <> b").distinct(), "links")
    labels = written(
        pairs.groupBy("a").agg(F.min("b").alias("b")).select(
            F.col("a").alias("node"), F.least("a", "b").alias("comp")
        ),
        "labels",
    )
    while True:
        near = (
            pairs.join(labels, pairs["b"] == labels["node"])
            .groupBy("a")
            .agg(F.min("comp").alias("near"))
        )
        met = written(
            labels.join(near, labels["node"] == near["a"]).select(
                "node", F.col("comp").alias("old"), F.least("comp", "near").alias("comp")
            ),
            "labels",
        )
        own = met.select(F.col("node").alias("of"), F.col("comp").alias("next"))
        jumped = written(
            met.join(own, met["comp"] == own["of"]).select(
                "node", F.least("comp", "next").alias("comp"), "old"
            ),
            "labels",
        )
        labels = jumped.select("node", "comp")
        if jumped.where("comp <> old").isEmpty():
            return labels
