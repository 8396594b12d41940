"""License scans by diagonal voting over word k-grams."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shardsync.llm.common import lower_ascii

#: Bytes of template grams, at most, that every executor gets a copy of.
MOST_BROADCAST = 8 << 20
#: What separates words in a text with A-Z in lower case.
_SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


@dataclass(frozen=True)
class Template:
    """A text to look for. ``k`` is the length of its grams; diagonals up to ``slack``
    words apart are one span; a span counts if it covers ``cover`` of the words.
    ``base`` phrases are those whose places are counted."""

    name: str
    label: str
    text: str
    k: int = 4
    slack: int = 8
    cover: float = 0.6
    base: bool = False

    @property
    def words(self) -> list[str]:
        return [w for w in re.split(_SEPARATORS, self.text.lower()) if w]


def phrase(label: str, text: str) -> Template:
    return Template(text, label, text, k=2, slack=0, cover=1.0, base=True)


# The phrases that are counted, and wordings that licenses prescribe.
PHRASES = (
    phrase("mit", "mit license"),
    phrase("apache", "apache license"),
    phrase("gpl", "general public license"),
)
NOTICES = (
    Template(
        "mit grant", "mit-text",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        "software and associated documentation files (the Software), to deal in the Software "
        "without restriction",
    ),
    Template(
        "mit release", "mit-notice", "This project is released under the MIT License.",
        cover=0.8, slack=3,
    ),
    Template(
        "apache notice", "apache-2.0-notice",
        "Licensed under the Apache License, Version 2.0",
        cover=0.8, slack=3,
    ),
    Template(
        "gpl notice", "gpl-notice",
        "This program is free software: you can redistribute it and/or modify it under the terms "
        "of the GNU General Public License as published by the Free Software Foundation",
    ),
    Template(
        "bsd conditions", "bsd-text",
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met",
    ),
    Template(
        "mpl notice", "mpl-2.0-notice",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
    ),
    Template(
        "creative commons", "cc-notice",
        "This work is licensed under a Creative Commons Attribution 4.0 International License",
    ),
)


def split_words(text: Column) -> Column:
    """The words of a text, null as empty: runs of letters, digits and everything
    beyond ASCII, A-Z in lower case."""
    return F.array_remove(F.split(lower_ascii(F.coalesce(text, F.lit(""))), _SEPARATORS), "")


def _grams(words: Column, k: int) -> Column:
    """Every run of ``k`` words with the place of its first."""
    places = F.when(F.size(words) >= k, F.sequence(F.lit(0), F.size(words) - k))
    gram = lambda i: F.struct(
        i.cast("long").alias("pos"), F.concat_ws(" ", F.slice(words, i + 1, F.lit(k))).alias("gram")
    )
    return F.coalesce(F.transform(places, gram), F.array().cast("array<struct<pos:bigint,gram:string>>"))


def template_grams(spark: SparkSession, templates: tuple[Template, ...]) -> DataFrame:
    """One row for each gram of each template: ``h``, ``gram``, ``t`` (its place)."""
    rows = []
    for number, x in enumerate(templates):
        if len(x.words) < x.k:
            raise ValueError(f"template {x.name!r} is shorter than its grams")
        rows += [(number, t, " ".join(x.words[t : t + x.k])) for t in range(len(x.words) - x.k + 1)]
    made = spark.createDataFrame(rows, "template int, t int, gram string")
    made = made.withColumn("h", F.xxhash64("gram"))
    size = sum(len(gram.encode()) + 64 for _, _, gram in rows)
    return F.broadcast(made) if size <= MOST_BROADCAST else made


def find_spans(docs: DataFrame, templates: tuple[Template, ...] = PHRASES + NOTICES) -> DataFrame:
    """Spans that agree with a template: ``doc_id``, ``fp``, ``template`` (its number),
    ``first`` and ``last`` word, ``covered`` (share of the template's words); and for
    each text a row without template whose ``first`` is its number of words and
    ``copies`` how often the row repeats.

    All rolling grams of all texts are joined, by hash and then word for word, to the
    grams of the templates. A match votes for the diagonal its two places lie on.
    Neighbouring diagonals make one span, so an inserted or missing word doesn't break
    it; the template words under its votes, all of them compared, must be enough, and
    the span at most twice as long as the template. Votes meet by document; a hot
    template spreads over its documents. All executors get the template table if it is
    within ``MOST_BROADCAST``, else both sides are shuffled."""
    spark = docs.sparkSession
    words = F.col("words")
    grams = [_grams(words, k) for k in sorted({x.k for x in templates})]
    end = F.array(F.struct(F.size(words).cast("long").alias("pos"), F.lit(None).cast("string").alias("gram")))
    rows = docs.select("doc_id", F.xxhash64("text").alias("fp"), split_words(F.col("text")).alias("words"))
    rows = rows.select("doc_id", "fp", F.inline(F.concat(*grams, end)))
    rows = rows.withColumn("h", F.xxhash64("gram"))
    known = template_grams(spark, templates).withColumnRenamed("gram", "known")
    votes = rows.join(known, (rows["h"] == known["h"]) & (rows["gram"] == known["known"]), "left")
    votes = votes.where(F.col("template").isNotNull() | F.col("gram").isNull()).select(
        "doc_id", "fp", "template", "t", "pos", (F.col("pos") - F.col("t")).alias("diagonal")
    )
    votes = votes.repartition("doc_id", "fp")

    def fact(values: list) -> Column:
        return F.get(F.array(*map(F.lit, values)), F.col("template"))

    lines = votes.groupBy("doc_id", "fp", "template", "diagonal").agg(
        F.collect_set("t").alias("ts"), F.min("pos").alias("first"), F.max("pos").alias("last"),
        F.count("*").alias("copies"),
    )
    by_template = Window.partitionBy("doc_id", "fp", "template").orderBy("diagonal")
    apart = F.col("diagonal") - F.lag("diagonal").over(by_template) > fact([x.slack for x in templates])
    lines = lines.withColumn("span", F.sum(F.coalesce(apart.cast("int"), F.lit(0))).over(by_template))
    spans = lines.groupBy("doc_id", "fp", "template", "span").agg(
        F.array_distinct(F.flatten(F.collect_list("ts"))).alias("ts"), F.min("first").alias("first"),
        F.max("last").alias("last"), F.max("copies").alias("copies"),
    )
    k, size = fact([x.k for x in templates]), fact([len(x.words) for x in templates])
    under = F.array_distinct(F.flatten(F.transform("ts", lambda t: F.sequence(t, t + k - 1))))
    covered = F.size(under) / size
    good = (covered >= fact([x.cover for x in templates])) & (F.col("last") + k - F.col("first") <= 2 * size)
    return spans.where(F.col("template").isNull() | good).select(
        "doc_id", "fp", "template", "first", (F.col("last") + k - 1).alias("last"),
        covered.alias("covered"), "copies",
    )


def scan_licenses(docs: DataFrame, templates: tuple[Template, ...] = PHRASES + NOTICES) -> DataFrame:
    """What license texts each document holds: ``doc_id``, ``n_words``, ``n_base``,
    ``first_word``, ``last_word``, ``base_labels``, ``labels``, ``score`` (share of the
    best verified template, 0 without one).

    Null and empty texts have no words, empty label strings and score 0. Rows that
    repeat come out as often as they came in; rows of one ``doc_id`` with different
    texts, and of a null one, each go by their own text. Further columns are ignored;
    an empty table gives no rows."""
    spans = find_spans(docs, templates)

    def fact(values: list) -> Column:
        return F.get(F.array(*map(F.lit, values)), F.col("template"))

    base = fact([x.base for x in templates])
    label = fact([x.label for x in templates])
    whole = F.col("template").isNull()
    found = spans.groupBy("doc_id", "fp").agg(
        F.max(F.when(whole, F.col("first"))).alias("n_words"),
        F.max(F.when(whole, F.col("copies"))).cast("int").alias("copies"),
        F.count(F.when(base, 1)).alias("n_base"),
        F.min(F.when(base, F.col("first"))).alias("first_word"),
        F.max(F.when(base, F.col("first"))).alias("last_word"),
        F.array_join(F.array_sort(F.collect_set(F.when(base, label))), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.collect_set(label)), ",").alias("labels"),
        F.coalesce(F.max("covered"), F.lit(0.0)).alias("score"),
    )
    return found.withColumn("copy", F.explode(F.sequence(F.lit(1), "copies"))).drop("copy", "copies", "fp")
