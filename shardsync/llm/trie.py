"""The prefix trie of conversations: SQL ROLLUP over positional turn columns."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shardsync.llm.common import written

#: Turn columns of a block, that is, the prefixes one ROLLUP row set reaches.
COLUMNS = 8
#: Blocks of a conversation whose running values are made in one window.
CHUNK = 1024
#: Ids that are joined to one piece of text before it is hashed.
PIECE = 8192

_T = [f"t{j}" for j in range(COLUMNS)]
_KEY = ["depth", "a", "b"]


def number_turns(conversations: DataFrame) -> DataFrame:
    """Every turn with its place: ``conv_id``, ``pos`` (from 0), ``digest`` (16 bytes of
    the SHA-256 of role and text), ``words``, ``part`` (rows of a conversation that
    were numbered together).

    Turns go by ``turn``, null first; equal ones by ``digest``, and rows that are equal
    throughout all count. Null role or text is empty; rows without ``conv_id`` take no
    part. Rows are sorted by range, numbered in their range and moved on by the
    conversation's rows in earlier ranges, so that a conversation of any length is
    numbered by many tasks. Texts are not shuffled."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    said = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    rows = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        "turn",
        F.unhex(F.substring(F.sha2(said, 256), 1, 32)).alias("digest"),
        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("words"),
        F.monotonically_increasing_id().alias("tie"),
    )
    order = [F.asc_nulls_first("turn"), F.asc("digest"), F.asc("tie")]
    dealt = rows.repartitionByRange("conv_id", *order).withColumn("part", F.spark_partition_id())
    dealt = written(dealt, "turns")
    runs = dealt.groupBy("conv_id", "part").agg(F.count("*").alias("rows"))
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select("conv_id", "part", F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("before"))
    own = Window.partitionBy("conv_id", "part").orderBy(*order)
    numbered = dealt.withColumn("pos", F.row_number().over(own) - 1).join(runs, ["conv_id", "part"])
    place = (F.col("pos") + F.col("before")).alias("pos")
    return written(numbered.select("conv_id", place, "digest", "words", "part"), "numbered")


def splice_heads(turns: DataFrame, head: Column, source: Column, longest: int) -> DataFrame:
    """Conversations with borrowed beginnings: the first ``head`` turns (at most
    ``longest``) of the conversation ``source`` stand before a conversation's own turns
    after its first ``head``. Both are expressions on ``conv_id``. A shorter source
    gives what it has, an absent one nothing."""
    sizes = turns.groupBy("conv_id").agg(F.count("*").alias("n"))
    asked = sizes.select("conv_id", head.cast("long").alias("head"), source.alias("source"))
    given = asked.join(sizes.select(F.col("conv_id").alias("source"), "n"), "source", "left")
    given = given.withColumn("taken", F.least("head", F.coalesce("n", F.lit(0))))
    given = written(given.select("conv_id", "source", "head", "taken"), "heads")
    first = turns.where(F.col("pos") < longest).withColumnRenamed("conv_id", "source")
    heads = first.join(given.where("taken > 0"), "source").where("pos < taken")
    # the shift meets each numbered run once, so that a long conversation's rows don't meet in one task
    runs = turns.select("conv_id", "part").distinct()
    moved = runs.join(given, "conv_id").select("conv_id", "part", "head", "taken")
    tails = turns.join(moved, ["conv_id", "part"]).where("pos >= head")
    columns = ("digest", "words")
    return heads.select("conv_id", "pos", *columns).unionAll(
        tails.select("conv_id", (F.col("pos") - F.col("head") + F.col("taken")).alias("pos"), *columns)
    )


def _half(hexed: Column, at: int) -> Column:
    return F.conv(F.substring(hexed, at, 15), 16, 10).cast("long")


def _paths(turns: DataFrame) -> DataFrame:
    """One row for each block of ``COLUMNS`` turns: ``conv_id``, ``block``, the turns
    ``t0``.. (``a``, ``b``, ``words``), the sums of the block, and of all earlier ones
    (``before_a``, ``before_b``, ``before_words``)."""
    hexed = F.sha2(F.concat(F.col("digest"), F.col("pos").cast("string").cast("binary")), 256)
    placed = turns.select(
        "conv_id",
        F.floor(F.col("pos") / COLUMNS).alias("block"),
        (F.col("pos") % COLUMNS).alias("j"),
        hexed.alias("hexed"),
        "words",
    ).select("conv_id", "block", "j", _half(F.col("hexed"), 1).alias("a"), _half(F.col("hexed"), 16).alias("b"), "words")
    fields = ("a", "b", "words")
    gathered = placed.groupBy("conv_id", "block").agg(
        *(F.expr(f"max({c}) FILTER (WHERE j = {j}) AS {c}{j}") for j in range(COLUMNS) for c in fields),
        F.bit_xor("a").alias("a"), F.bit_xor("b").alias("b"),
        F.sum("words").alias("words"), F.count("*").alias("turns"),
    )
    turn = [
        F.expr(f"if(a{j} IS NULL, NULL, struct(a{j} AS a, b{j} AS b, words{j} AS words)) AS t{j}")
        for j in range(COLUMNS)
    ]
    chunk = F.floor(F.col("block") / CHUNK).alias("chunk")
    blocks = written(gathered.select("conv_id", "block", chunk, *turn, *fields, "turns"), "blocks")

    def running(window) -> list[Column]:
        made = zip(fields, (F.bit_xor, F.bit_xor, F.sum), strict=True)
        return [F.coalesce(f(c).over(window), F.lit(0)).alias(f"before_{c}") for c, f in made]

    earlier = (Window.unboundedPreceding, -1)
    chunks = blocks.groupBy("conv_id", "chunk").agg(
        F.bit_xor("a").alias("a"), F.bit_xor("b").alias("b"), F.sum("words").alias("words")
    )
    over = Window.partitionBy("conv_id").orderBy("chunk").rowsBetween(*earlier)
    chunks = chunks.select("conv_id", "chunk", *running(over)).select(
        "conv_id", "chunk", *(F.col(f"before_{c}").alias(f"chunk_{c}") for c in fields)
    )
    inside = Window.partitionBy("conv_id", "chunk").orderBy("block").rowsBetween(*earlier)
    met = blocks.select("*", *running(inside)).join(chunks, ["conv_id", "chunk"])
    return met.select(
        "conv_id", "block", *_T, *fields, "turns",
        F.col("before_a").bitwiseXOR(F.col("chunk_a")).alias("before_a"),
        F.col("before_b").bitwiseXOR(F.col("chunk_b")).alias("before_b"),
        (F.col("before_words") + F.col("chunk_words")).alias("before_words"),
    )


def _nodes(paths: DataFrame, aggregates: dict[str, str]) -> DataFrame:
    """One ROLLUP for all prefixes in all blocks. A block is keyed by the node where
    the block before it ended; grouping_id tells how many of its turns a row keeps.
    Rows that keep turns which a conversation hasn't are dropped before they are
    grouped, as that looks at grouping columns alone."""
    names = ", ".join(_T)
    made = ", ".join(f"{value} AS {name}" for name, value in aggregates.items())

    def upto(c: str, turns: str, add: str) -> str:
        parts = [f"before_{c}", *(f"if({turns} > {j}, {t}.{c}, 0)" for j, t in enumerate(_T))]
        return add.join(parts)

    real = " ".join(f"WHEN {j + 1} THEN {t} IS NOT NULL" for j, t in enumerate(_T))
    last = " ".join(f"WHEN {j + 1} THEN {t}.words" for j, t in enumerate(_T))
    return paths.sparkSession.sql(
        f"""
        SELECT {COLUMNS} * block + kept AS depth, {upto("a", "kept", " ^ ")} AS a, {upto("b", "kept", " ^ ")} AS b,
               {upto("a", "kept - 1", " ^ ")} AS parent_a, {upto("b", "kept - 1", " ^ ")} AS parent_b,
               CASE kept WHEN 0 THEN 0L {last} END AS words,
               if(kept = 0, 0L, {upto("words", "kept - 1", " + ")}) AS words_above,
               {", ".join(aggregates)}
        FROM (SELECT block, before_a, before_b, before_words, {names},
                     {COLUMNS} - bit_count(grouping_id()) AS kept, {made}
              FROM {{paths}}
              GROUP BY block, before_a, before_b, before_words, ROLLUP({names}))
        WHERE CASE kept WHEN 0 THEN block = 0 {real} END
        """,
        paths=paths,
    )


def _ends_digest(ends: DataFrame) -> DataFrame:
    """For each key of ``ends`` (``depth``, ``a``, ``b``, ``conv_id``) the SHA-256 of
    its ids, ascending and joined by commas: ``ends_sha256``.

    Ids are sorted by range over all tasks and joined to pieces; then the pieces of a
    key are hashed one after the other. What one key sends to its task is its text in
    pieces, and no task holds more than one of them."""

    def piece(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, ids = None, []

        def out(rows):
            cols = zip(*rows, strict=True)
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string())
            arrays = [pa.array(c, t) for c, t in zip(cols, kinds, strict=True)]
            return pa.RecordBatch.from_arrays(arrays, [*_KEY, "first", "ids"])

        for batch in batches:
            done = []
            for *k, i in zip(*(batch.column(n).to_pylist() for n in range(4)), strict=True):
                if ids and (k != key or len(ids) == PIECE):
                    done.append((*key, ids[0], ",".join(map(str, ids))))
                    ids = []
                key = k
                ids.append(i)
            if done:
                yield out(done)
        if ids:
            yield out([(*key, ids[0], ",".join(map(str, ids)))])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, sha = None, None

        def out(rows):
            cols = zip(*rows, strict=True)
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string())
            arrays = [pa.array(c, t) for c, t in zip(cols, kinds, strict=True)]
            return pa.RecordBatch.from_arrays(arrays, [*_KEY, "ends_sha256"])

        for batch in batches:
            done = []
            for *k, ids in zip(*(batch.column(n).to_pylist() for n in range(4)), strict=True):
                if k == key:
                    sha.update(b",")
                else:
                    if key is not None:
                        done.append((*key, sha.hexdigest()))
                    key, sha = k, hashlib.sha256()
                sha.update(ids.encode())
            if done:
                yield out(done)
        if key is not None:
            yield out([(*key, sha.hexdigest())])

    kinds = "depth long, a long, b long"
    ordered = ends.select(*_KEY, "conv_id").repartitionByRange(*_KEY, "conv_id")
    pieces = ordered.sortWithinPartitions(*_KEY, "conv_id").mapInArrow(piece, f"{kinds}, first long, ids string")
    together = pieces.repartition(*_KEY).sortWithinPartitions(*_KEY, "first")
    return together.select(*_KEY, "ids").mapInArrow(digest, f"{kinds}, ends_sha256 string")


def prefix_trie(turns: DataFrame, conversations: DataFrame) -> DataFrame:
    """The trie of all prefixes: ``conv_id`` (its smallest member), ``depth``,
    ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves``, ``saved_tokens``,
    ``ends_sha256``. One row for each distinct sequence of first turns; the root has
    depth 0 and a null parent. No conversations give no rows.

    ``turns`` (``conv_id``, ``pos`` from 0 without gaps, ``digest``, ``words``) are as
    ``number_turns`` makes them; ``conversations`` names every ``conv_id``, also those
    without turns, which are members of the root. Columns beyond these are ignored.

    1. Turns go to blocks of ``COLUMNS`` positional columns. A block's key is the node
       where the block before it ends: two exclusive ors of 60 hash bits for each turn
       and position, made as running values over a conversation's blocks. So all
       blocks of all lengths are grouped by one ROLLUP, and the number of jobs doesn't
       grow with the longest conversation.
    2. A conversation stands for the nodes of which it is the smallest member. These
       end its path, so their number and words tell where they begin, and whether its
       last node is a leaf.
    3. Leaves and saved words then are sums over a node's members, by a second ROLLUP:
       every member but the smallest saves the words from the node to where it begins
       to stand for nodes itself.

    Sums are partial before they are shuffled, so a first turn that many conversations
    share costs no more than others. Distinct sequences are told apart by 120 bits."""
    paths = _paths(turns)
    everyone = conversations.where("conv_id IS NOT NULL").select(F.col("conv_id").cast("long").alias("conv_id"))
    paths = written(paths, "paths")
    totals = paths.groupBy("conv_id").agg(
        F.sum("turns").alias("depth"), F.bit_xor("a").alias("a"), F.bit_xor("b").alias("b"),
        F.sum("words").alias("all_words"),
    )
    zero = F.lit(0).cast("long")
    totals = written(
        everyone.distinct().join(totals, "conv_id", "left").select(
            "conv_id", *(F.coalesce(c, zero).alias(c) for c in (*_KEY, "all_words"))
        ),
        "totals",
    )
    turnless = totals.where("depth = 0").select("conv_id")
    paths = paths.unionByName(
        turnless.select("conv_id", *(zero.alias(c) for c in ("block", "before_a", "before_b", "before_words"))),
        allowMissingColumns=True,
    )
    nodes = written(_nodes(paths, {"conv_id": "min(conv_id)"}), "nodes")
    children = (
        nodes.where("depth > 0")
        .groupBy((F.col("depth") - 1).alias("depth"), F.col("parent_a").alias("a"), F.col("parent_b").alias("b"))
        .agg(F.count("*").alias("n_children"))
    )
    children = written(children, "children")
    own = (
        nodes.join(children, _KEY, "left")
        .groupBy("conv_id")
        .agg(
            F.count("*").alias("nodes"), F.sum("words").alias("own_words"),
            F.max(F.col("n_children").isNull().cast("long")).alias("leaf"),
        )
    )
    members = written(
        totals.join(own, "conv_id", "left").select(
            "conv_id",
            (F.col("all_words") - F.coalesce("own_words", zero)).alias("shared"),
            (F.col("depth") + 1 - F.coalesce("nodes", zero)).alias("since"),
            F.coalesce("leaf", zero).alias("leaf"),
        ),
        "members",
    )
    sums = {
        "n_convs": "count(*)", "conv_id": "min(conv_id)", "n_leaves": "sum(leaf)", "shared": "sum(shared)",
        "first_shared": "min_by(shared, conv_id)", "since": "min_by(since, conv_id)",
    }
    full = _nodes(paths.join(members, "conv_id"), sums)
    full = full.join(children, _KEY, "left").join(_ends_digest(totals), _KEY, "left")
    saved = F.col("shared") - F.col("first_shared") - (F.col("n_convs") - 1) * F.col("words_above")
    full = written(
        full.select(
            "conv_id", "depth", "since", "parent_a", "parent_b", "n_convs",
            F.coalesce("n_children", zero).alias("n_children"), "n_leaves",
            saved.alias("saved_tokens"),
            F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"),
        ),
        "trie",
    )
    # only a conversation's first own node has a parent of another name
    begins = (F.col("depth") == F.col("since")) & (F.col("depth") > 0)
    parents = nodes.select(
        (F.col("depth") + 1).alias("depth"), F.col("a").alias("parent_a"), F.col("b").alias("parent_b"),
        F.col("conv_id").alias("parent_conv_id"),
    )
    asking = full.where(begins).join(parents, ["depth", "parent_a", "parent_b"])
    others = full.where(~begins).withColumn("parent_conv_id", F.when(F.col("depth") > 0, F.col("conv_id")))
    out = (
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256",
    )
    return asking.select(*out).unionAll(others.select(*out))


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """The trie of conversations whose beginnings are borrowed: conversation c starts
    with the first h turns of c - c % 20, where h is crc32 of c in decimals, modulo 4.

    Rows without ``conv_id`` take no part; see ``number_turns`` for nulls, ties and
    repeated rows, and ``prefix_trie`` for the result."""
    turns = number_turns(conversations)
    head = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 4
    spliced = splice_heads(turns, head, F.col("conv_id") - F.col("conv_id") % 20, 3)
    return prefix_trie(spliced, turns.select("conv_id"))
