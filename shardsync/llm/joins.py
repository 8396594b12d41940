"""Links between alike sets: buckets dealt to tiles, checked on full sets.

What the operators on sets of shingles share. Sets that have a key in common form a bucket.
A bucket is compared in tiles of bounded size; a tile's own estimate says which pairs may be
alike, and full sets decide. Links that keys and estimates miss are found by the rarest
shingles of the sets, without any chance of a miss."""

from __future__ import annotations

from collections import deque
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shardsync.llm.common import encoders_freed, file_backed, located, pieces_of, written
from shardsync.llm.graph import components
from shardsync.llm.words import BLANKS, mix, shingles, words

#: Sets, and shingles of sets, that a tile holds about.
TILE, TILE_SHINGLES = 512, 1 << 21
#: Times that a bucket of more than one tile is split by further keys, and keys each time.
LEVELS, PATHS = 3, 2
#: Bits of the table that tells which rows' texts are read again.
WANTED_BITS = 1 << 25
#: Bits of the signature of the smallest and the largest sets.
FEWEST_BITS, MOST_BITS = 256, 1 << 15
#: Rows that tell which shingles are frequent, how many of them have such a shingle, and
#: how many shingles are kept. They only set the order in which shingles are tried.
SEEN_ROWS, SEEN_OFTEN, SEEN_MOST = 16_384, 3, 1 << 18


def bits_for(size: int) -> int:
    """Width of the signature of sets of ``size`` shingles."""
    return min(MOST_BITS, max(FEWEST_BITS, 1 << (2 * size - 1).bit_length()))


def signature(found: np.ndarray, bits: int) -> np.ndarray:
    """One parity bit for each cell that shingles are hashed to, as 64-bit words."""
    cell = (mix(found) & np.uint64(bits - 1)).astype(np.int64)
    return np.packbits(np.bincount(cell, minlength=bits) & 1, bitorder="little").view(np.uint64)


def bits_apart(a: bytes, b: bytes) -> int:
    """Bits in which two signatures differ, the wider one folded to the width of the other:
    at most as many as shingles that only one of the sets has."""
    low, high = sorted((a, b), key=len)
    wide, width = int.from_bytes(high, "little"), 8 * len(high)
    while width > 8 * len(low):
        width //= 2
        wide = (wide >> width) ^ (wide & ((1 << width) - 1))
    return (wide ^ int.from_bytes(low, "little")).bit_count()


def rarest(found: np.ndarray, frequent: np.ndarray, percent: int) -> np.ndarray:
    """The first shingles of a set, in an order that is the same for all sets (frequent ones
    last, then by hash), as many as two sets can't be alike without sharing one."""
    at = np.searchsorted(frequent, found)
    often = frequent[np.minimum(at, len(frequent) - 1)] == found if len(frequent) else np.zeros(len(found), bool)
    ordered = np.concatenate([found[~often], found[often]])
    return ordered[: len(found) + 1 - -(-percent * len(found) // 100)]


def set_id(found: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(found.tobytes())


def text_sets(texts: pa.Array, size: int) -> Iterator[np.ndarray]:
    """The shingle set of each text, as sorted hashes."""
    for _, _, data, offsets in pieces_of(texts):
        starts, _, hashes = words(data, offsets, BLANKS)
        cuts = np.searchsorted(starts, offsets)
        for a, b in zip(cuts, cuts[1:], strict=False):
            yield shingles(hashes[a:b], size)


class Tile:
    """Sets of a bucket: nodes, components, sizes, sketches, maybe the sets, and which of
    them must meet the others (null: all)."""

    def __init__(self, table: pa.Table, percent: int):
        table = table.combine_chunks()
        self.percent = percent
        self.nodes = table["node"].to_pylist()
        self.comps = np.unique(np.array(table["comp"].to_pylist(), object), return_inverse=True)[1]
        self.n = np.asarray(table["n"])
        self.bits = table["bits"].to_pylist()
        self.minor = np.asarray(table["minor"].fill_null(True))
        self.sets = None
        if "found" in table.column_names:
            column = table["found"].combine_chunks()
            column = column.chunk(0) if isinstance(column, pa.ChunkedArray) else column
            flat, at = np.asarray(column.values).view(np.uint64), np.asarray(column.offsets)
            self.sets = [flat[a:b] for a, b in zip(at, at[1:], strict=False)]

    def close(self) -> np.ndarray:
        """Pairs of different components that may be alike."""
        out = self.may_be_alike()
        out &= self.comps[:, None] != self.comps
        return out & (self.minor[:, None] | self.minor)

    def may_be_alike(self) -> np.ndarray:
        """All pairs that the sketches don't rule out."""
        raise NotImplementedError

    def alike(self, i: int, j: int) -> bool:
        a, b = self.sets[i], self.sets[j]
        at = np.searchsorted(a, b)
        at[at == len(a)] = 0
        both = int((a[at] == b).sum())
        return 100 * both >= self.percent * (len(a) + len(b) - both)

    def forest(self) -> list[tuple[bytes, bytes]]:
        """Pairs that would join all that may be alike. Searches start at the smallest nodes,
        so that tiles which hold the same sets mostly give the same pairs."""
        close = self.close()
        left, out = close.any(axis=1), []
        for start in np.argsort(np.array(self.nodes, object), kind="stable"):
            queue = deque([start] if left[start] else [])
            left[start] = False
            while queue:
                i = queue.popleft()
                met = np.flatnonzero(close[i] & left)
                left[met] = False
                queue += met.tolist()
                out += [(self.nodes[i], self.nodes[j]) for j in met]
        return out

    def near(self) -> list[bytes]:
        return [self.nodes[i] for i in np.flatnonzero(self.close().any(axis=1))]

    def links(self) -> list[tuple[bytes, bytes]]:
        """Links between components, as many as join all that are alike."""
        root = list(range(int(self.comps.max()) + 1))

        def of(c: int) -> int:
            while root[c] != c:
                root[c] = c = root[root[c]]
            return c

        out, close = [], np.triu(self.close())
        alike = self._alike_of_many(close)
        for i, j in np.argwhere(close if alike is None else close & alike):
            a, b = of(int(self.comps[i])), of(int(self.comps[j]))
            if a != b and (alike is not None or self.alike(i, j)):
                root[a] = b
                out.append((self.nodes[i], self.nodes[j]))
        return out

    def _alike_of_many(self, close: np.ndarray) -> np.ndarray | None:
        """Which sets are alike, by products of 0/1 tables of sets and shingles; None, where
        it costs less to intersect pair by pair. Counts below 2 ** 24 are exact."""
        used = np.flatnonzero(close.any(axis=1) | close.any(axis=0))
        pairs, total = int(close.sum()), int(self.n[used].sum())
        if pairs < 256 or total >= 1 << 24:
            return None
        names, at = np.unique(np.concatenate([self.sets[i] for i in used]), return_inverse=True)
        # nanoseconds, about: a product's cells, and the steps of one intersection
        if len(used) ** 2 * len(names) / 10 > pairs * (10_000 + 40 * total / len(used)):
            return None
        owner = np.repeat(np.arange(len(used)), self.n[used])
        order = np.argsort(at, kind="stable")
        at, owner = at[order], owner[order]
        both = np.zeros((len(used), len(used)), np.int64)
        for lo in range(0, len(names), 4096):
            a, b = np.searchsorted(at, (lo, lo + 4096))
            table = np.zeros((len(used), 4096), np.float32)
            table[owner[a:b], at[a:b] - lo] = 1
            both += (table @ table.T).astype(np.int64)
        size = self.n[used]
        out = np.zeros_like(close)
        union = size[:, None] + size - both
        out[np.ix_(used, used)] = 100 * both >= self.percent * union
        return out


class PairTile(Tile):
    """A tile whose pairs are all intersected."""

    def may_be_alike(self) -> np.ndarray:
        return np.ones((len(self.n), len(self.n)), bool)


def _by_tile(
    rows: DataFrame, made: Callable[[pa.Table], Tile], look: Callable[[Tile], list[tuple]], kinds: str
) -> DataFrame:
    """What ``look`` finds in each tile of ``rows`` (``tile``, ``node``, ``comp``,
    ``minor``, ``n``, ``bits``, maybe ``found``). A tile's rows follow each other in a
    partition; a task holds one tile and one batch."""
    names = [k.split()[0] for k in kinds.split(", ")]
    types = [pa.int64() if "long" in k else pa.binary() for k in kinds.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoders_freed()
        held: list[pa.Table] = []

        def ended() -> list[tuple]:
            table = pa.concat_tables(held)
            held.clear()
            if table.num_rows < 2:
                return []
            key = table["tile"][0].as_py()
            return [(key, *x) if "tile" in names else x for x in look(made(table))]

        def out(found: list[tuple]) -> pa.RecordBatch:
            columns = zip(*found, strict=True)
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names
            )

        for batch in batches:
            table, found = pa.Table.from_batches([batch]), []
            key = np.asarray(table["tile"])
            cuts = [0, *(np.flatnonzero(key[1:] != key[:-1]) + 1), len(key)]
            for a, b in zip(cuts, cuts[1:], strict=False):
                if held and b > a and held[0]["tile"][0].as_py() != key[a]:
                    found += ended()
                if b > a:
                    held.append(table.slice(a, b - a))
            if found:
                yield out(found)
        if held and (found := ended()):
            yield out(found)

    return rows.repartition("tile").sortWithinPartitions("tile", "node").mapInArrow(run, kinds)


class _Join:
    """What the steps of one join share: the sets' facts, and the components found so far."""

    def __init__(self, docs: DataFrame, nodes: DataFrame, size: int, made: Callable[[pa.Table], Tile]):
        self.docs, self.nodes, self.size, self.made = docs, nodes, size, made
        self.labels: DataFrame | None = None

    def add(self, links: DataFrame) -> None:
        """Components with further ``links``. Those known become the nodes that new links
        join, so that no link is gone through twice."""
        if links.isEmpty():
            return
        if self.labels is None:
            self.labels = components(links)
            return
        first = self.labelled(links.select(F.col("a").alias("node"), "b"))
        both = self.labelled(first.select(F.col("comp").alias("a"), F.col("b").alias("node")))
        joined = components(both.select("a", F.col("comp").alias("b")))
        moved = joined.select(F.col("node").alias("comp"), F.col("comp").alias("least"))
        old = self.labels.join(moved, "comp", "left").select("node", F.coalesce("least", "comp").alias("comp"))
        new = joined.join(self.labels.select("node"), "node", "left_anti")
        self.labels = written(old.unionByName(new), "labels")

    def labelled(self, members: DataFrame) -> DataFrame:
        members = members.drop("comp")
        if self.labels is None:
            return members.withColumn("comp", F.col("node"))
        return members.join(self.labels, "node", "left").withColumn("comp", F.coalesce("comp", "node"))

    def sets_of(self, wanted: DataFrame) -> DataFrame:
        """``node``, ``found``: the sets of the nodes in ``wanted``. Only their texts, and
        those of a few rows with equal table cells, are shuffled: a table of bits of
        fixed size is sent to the tasks that read the documents."""
        wanted = written(wanted.select("node").distinct().join(self.nodes.select("node", "row_key"), "node"), "wanted")
        table = _bit_table(wanted, "row_key")
        size = self.size

        def among(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                hit = _in_table(table, np.asarray(batch.column("row_key")))
                if hit.any():
                    yield batch.filter(pa.array(hit))

        def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for lo in range(0, batch.num_rows, 64):
                    part = batch.slice(lo, 64)
                    found = list(text_sets(part.column("text"), size))
                    own = [set_id(x) == k for x, k in zip(found, part.column("node").to_pylist(), strict=True)]
                    at = pa.array(np.cumsum([0, *map(len, found)]), pa.int32())
                    flat = pa.array(np.concatenate(found).view(np.int64))
                    made = pa.RecordBatch.from_arrays(
                        [part.column("node"), pa.ListArray.from_arrays(at, flat)], ["node", "found"]
                    )
                    yield made.filter(pa.array(own))

        rows = self.docs.select("row_key", "text").mapInArrow(among, "row_key long, text string")
        rows = rows.hint("merge").join(wanted, "row_key")
        return written(rows.select("text", "node").mapInArrow(build, "node binary, found array<long>"), "sets")

    def compare(self, tiles: DataFrame, guess: bool) -> None:
        """Find all links between components in ``tiles`` (``tile``, ``node``, ``minor``).
        With ``guess``, first check pairs that would join all that may be alike: after
        that, few pairs of different components are left to be compared in full."""
        facts = self.nodes.select("node", "n", "bits")
        if guess:
            rows = self.labelled(tiles).join(facts, "node")
            pairs = _by_tile(rows, self.made, Tile.forest, "a binary, b binary")
            pairs = written(pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "pairs")
            sets = self.sets_of(pairs.select(F.col("a").alias("node")).unionAll(pairs.select("b")))
            self.add(self._checked(pairs, sets))
        rows = self.labelled(tiles).join(facts, "node")
        near = _by_tile(rows, self.made, lambda t: [(x,) for x in t.near()], "tile long, node binary")
        near = written(near, "near")
        if near.isEmpty():
            return
        rows = self.labelled(tiles.join(near, ["tile", "node"])).join(facts, "node").join(self.sets_of(near), "node")
        self.add(written(_by_tile(rows, self.made, Tile.links, "a binary, b binary"), "links"))

    def _checked(self, pairs: DataFrame, sets: DataFrame, made: Callable[[pa.Table], Tile] | None = None) -> DataFrame:
        """Those of ``pairs`` that are alike, as tiles of two."""
        numbered = pairs.withColumn("tile", F.xxhash64("a", "b"))
        both = numbered.select("tile", F.col("a").alias("node")).unionAll(
            numbered.select("tile", F.col("b").alias("node"))
        )
        rows = (
            both.withColumn("comp", F.concat("node", F.encode(F.col("tile").cast("string"), "utf-8")))
            .withColumn("minor", F.lit(True))
            .join(self.nodes.select("node", "n", "bits"), "node").join(sets, "node")
        )
        return written(_by_tile(rows, made or self.made, Tile.links, "a binary, b binary"), "links")


    def rest(self, percent: int) -> None:
        """Add all links between components that are left, with no chance of a miss.

        Two alike sets share one of the ``rarest`` shingles of each. Those that sets of
        several components have bring pairs together, all but those within a shingle's
        largest component; places in the order, the number of such shingles from there on
        and signatures bound the overlap from above, and full sets decide."""
        placed, frequent, size = self.labelled(self.nodes.select("node", "row_key", "n")), self._frequent(), self.size

        def firsts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for lo in range(0, batch.num_rows, 256):
                    part = batch.slice(lo, 256)
                    found = list(text_sets(part.column("text"), size))
                    rare = [rarest(x, frequent, percent) for x in found]
                    at = pa.array(np.cumsum([0, *map(len, rare)]), pa.int32())
                    made = pa.RecordBatch.from_arrays(
                        [
                            part.column("row_key"), pa.array([set_id(x) for x in found], pa.binary()),
                            pa.ListArray.from_arrays(at, pa.array(np.concatenate(rare).view(np.int64))),
                            pa.array([signature(x, bits_for(len(x))).tobytes() for x in found], pa.binary()),
                        ],
                        ["row_key", "node", "rare", "sign"],
                    )
                    yield made.filter(pa.array([len(x) > 0 for x in found]))

        kind = "row_key long, node binary, rare array<long>, sign binary"
        rows = self.docs.select("row_key", "text").mapInArrow(firsts, kind)
        placed = written(placed.join(rows, ["row_key", "node"]).drop("row_key"), "rarest")
        each = placed.select(F.xxhash64("comp").alias("c"), F.explode("rare").alias("s"))
        ends = each.groupBy("s").agg(F.min("c").alias("low"), F.max("c").alias("high"))
        mixed = written(ends.where("low < high").select("s"), "mixed")
        if mixed.isEmpty():
            return
        pairs = written(_meeting(_members(placed, mixed), percent).distinct(), "meeting")
        signs = placed.select("node", "sign")
        both = pairs.join(signs.toDF("a", "sign_a"), "a").join(signs.toDF("b", "sign_b"), "b")

        def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                total, a, b = (batch.column(c).to_pylist() for c in ("total", "sign_a", "sign_b"))
                most = [(t - bits_apart(x, y)) // 2 for t, x, y in zip(total, a, b, strict=True)]
                hit = [m * (100 + percent) >= percent * t for m, t in zip(most, total, strict=True)]
                yield batch.select(["a", "b"]).filter(pa.array(hit, pa.bool_()))

        close = written(both.select("a", "b", "total", "sign_a", "sign_b").mapInArrow(near, "a binary, b binary"), "close")
        if not close.isEmpty():
            sets = self.sets_of(close.select(F.col("a").alias("node")).unionAll(close.select("b")))
            self.add(self._checked(close, sets, lambda t: PairTile(t, percent)))

    def _frequent(self) -> np.ndarray:
        """Shingles that many texts have, sorted: found in some rows, which is enough to put
        them last. Which these are changes the time that :meth:`rest` takes, no link."""
        size, scale = self.size, 1 << 30
        share = int(min(1, SEEN_ROWS / max(1, self.nodes.count())) * scale)
        some = self.docs.where(F.pmod(F.xxhash64("row_key"), F.lit(scale)) < share)

        def flat(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for found in text_sets(batch.column("text"), size):
                    yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64))], ["s"])

        counted = some.select("text").mapInArrow(flat, "s long").groupBy("s").count().where(F.col("count") >= SEEN_OFTEN)
        # at most SEEN_MOST rows, whatever the number of documents
        most = counted.orderBy(F.desc("count"), "s").limit(SEEN_MOST).select("s").toArrow()
        return np.sort(np.asarray(most["s"]).view(np.uint64))


def _bit_table(rows: DataFrame, number: str) -> np.ndarray:
    """A table of WANTED_BITS bits; those of the numbers are set."""
    cell = F.pmod(number, F.lit(WANTED_BITS))
    words_ = rows.groupBy(F.floor(cell / 32).alias("word")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), (cell % 32).cast("int"))).alias("bits")
    )
    # at most WANTED_BITS / 32 rows, whatever the number of documents
    table, got = np.zeros(WANTED_BITS // 32, np.uint32), words_.toArrow()
    table[np.asarray(got["word"])] = np.asarray(got["bits"])
    return table


def _in_table(table: np.ndarray, numbers: np.ndarray) -> np.ndarray:
    at = np.mod(numbers, WANTED_BITS)
    return ((table[at // 32] >> (at % 32).astype(np.uint32)) & 1).astype(bool)


def _members(placed: DataFrame, mixed: DataFrame) -> DataFrame:
    """``s``, ``i``, ``node``, ``n``, ``comp``: the sets that have the shingles in ``mixed``
    among their rarest, and the shingles' places there. ``prev`` is the one in ``mixed`` before
    it, and ``most`` bounds what of the set, from this place on, a set of another component
    can share whose rarest shingles reach as far. Cells of the table of bits that are set by
    others make both weaker, not wrong."""
    table = _bit_table(mixed, "s")

    def among(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rare, size = batch.column("rare"), np.asarray(batch.column("n"))
            s, n = np.asarray(rare.flatten()), np.asarray(rare.value_lengths())
            hit = np.flatnonzero(_in_table(table, s))
            row = np.repeat(np.arange(len(n)), n)[hit]
            place = hit - (np.cumsum(n) - n)[row]
            first = np.concatenate([[True], row[1:] != row[:-1]])[: len(row)]
            prev = np.concatenate([[0], s[hit[:-1]]])[: len(row)]
            after = np.searchsorted(row, row, "right") - np.arange(len(row))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(s[hit]), pa.array(place), pa.array(prev, pa.int64(), mask=first),
                    pa.array(after + (size - n)[row]), *(batch.column(c).take(pa.array(row)) for c in ("node", "n", "comp")),
                ],
                ["s", "i", "prev", "most", "node", "n", "comp"],
            )

    kind = "s long, i long, prev long, most long, node binary, n long, comp binary"
    rows = placed.select("node", "n", "comp", "rare").mapInArrow(among, kind)
    return written(rows.join(mixed, "s"), "members")


def _meeting(members: DataFrame, percent: int) -> DataFrame:
    """``a``, ``b``, ``total``: pairs of different components that may be alike by a shingle
    that they share in ``members``, and the sum of their sizes; hardly any pair comes twice.

    The bounds are those of the first shingle that both have; if both have the same one
    before it, it is not the first. So a pair meets there and hardly ever again, however
    many shingles of a passage it shares, and not at all where too few are left."""
    by_comp = members.groupBy("s", "comp").agg(F.count("*").alias("sets"))
    major = by_comp.groupBy("s").agg(F.max(F.struct("sets", "comp"))["comp"].alias("major"))
    rows = members.join(major, "s").withColumn("minor", F.col("comp") != F.col("major")).drop("major")
    rows = written(rows, "facing")
    names = ("node", "comp", "n", "i", "prev", "most", "minor")
    x, y = (rows.select("s", *(F.col(c).alias(f"{c}_{k}") for c in names)) for k in "xy")
    total, small = F.col("n_x") + F.col("n_y"), F.least("n_x", "n_y")
    # after the first shingle that both have; after the last of the one's rarest that ends first
    left = F.least(F.col("n_x") - F.col("i_x"), F.col("n_y") - F.col("i_y"), F.greatest("most_x", "most_y"))
    both = x.where("minor_x").join(y, "s").where(
        "comp_x <> comp_y AND (NOT minor_y OR node_x < node_y) AND NOT coalesce(prev_x = prev_y, false)"
    ).where((100 * small >= percent * F.greatest("n_x", "n_y")) & ((100 + percent) * left >= percent * total))
    return both.select(F.least("node_x", "node_y").alias("a"), F.greatest("node_x", "node_y").alias("b"), total.alias("total"))


def _tiles_needed() -> Column:
    return F.greatest(F.ceil(F.count("*") / TILE), F.ceil(F.sum("n") / TILE_SHINGLES))


def keyed_documents(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``text``, and ``row_key``, a hash of the row's place in its file."""
    rows = located(file_backed(docs), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.select("doc_id", "text", F.xxhash64("at.file", "at.row").alias("row_key"))


def linked_rows(
    docs: DataFrame, sketched: DataFrame, size: int, made: Callable[[pa.Table], Tile], n_keys: int, percent: int
) -> DataFrame:
    """Every row of ``sketched`` (``doc_id``, ``row_key``, ``n``; for sets with shingles ``node``,
    ``keys``, ``bits``) with ``comp``, the component of its set; null for empty sets.

    ``docs`` is as ``keyed_documents`` makes it. 1. Equal sets go on as one. 2. Sets that share
    a key meet in tiles of bounded size; first, pairs that would join all that may be alike
    are checked on full sets, then all pairs that are left in different components. 3. A key
    with more sets than a tile holds is dealt over several tiles by hash. If that leaves it in
    several components, it is split by pairs of further keys, in which unlike sets fall
    apart, and at last its minor components meet all its sets, block by block. 4. Sets that
    share no key, that a split took apart or that an estimate turned away meet by their
    rarest shingles (``_Join.rest``), so that no link is left out. No bucket is cut off, and a
    tile yields one row a set at most."""
    firsts = [F.first(c).alias(c) for c in ("n", "keys", "bits")]
    nodes = written(
        sketched.where("n > 0").groupBy("node").agg(F.min("row_key").alias("row_key"), *firsts), "nodes"
    )
    join = _Join(docs, nodes, size, made)
    every = nodes.select("node", "n", F.posexplode("keys").alias("i", "key"))
    shared = every.groupBy("key").agg(F.count("*").alias("sets"), _tiles_needed().alias("tiles")).where("sets > 1")
    members = written(every.join(shared.drop("sets"), "key"), "members")
    join.compare(_dealt(members, 0), True)
    large = members.where("tiles > 1")
    for level in range(1, LEVELS + 1):
        large = _mixed(join, large)
        if large.isEmpty():
            break
        large = _split(large, nodes, level, n_keys)
        join.compare(_dealt(large, level), False)
        large = large.where("tiles > 1")
    else:
        large = _mixed(join, large)
        if not large.isEmpty():
            join.compare(_facing(large), False)
    join.rest(percent)
    of = written(join.labelled(nodes.select("node")), "classes")
    return sketched.join(of, "node", "left")


def named_classes(rows: DataFrame) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id``: components named by their smallest id."""
    names = rows.where("n > 0").groupBy("comp").agg(F.min("doc_id").alias("component_id"))
    found = rows.select("doc_id", "n", "comp").join(written(names, "names"), "comp", "left")
    component = F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    return found.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"))


def _dealt(members: DataFrame, level: int) -> DataFrame:
    """Members (``key``, ``tiles``) in their tiles; a key of several deals by hash."""
    part = F.pmod(F.xxhash64("node", "key", F.lit(level)), F.col("tiles"))
    return members.select(F.xxhash64("key", part).alias("tile"), "node", F.lit(True).alias("minor"))


def _mixed(join: _Join, members: DataFrame) -> DataFrame:
    """Members of keys whose sets are in several components."""
    placed = written(join.labelled(members), "placed")
    mixed = placed.groupBy("key").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).where("low < high")
    return written(placed.join(mixed.select("key"), "key"), "mixed")


def _split(members: DataFrame, nodes: DataFrame, level: int, n_keys: int) -> DataFrame:
    """Members by pairs of their key and one of ``PATHS`` further keys, where these are
    shared by sets of several components."""
    steps = F.array(*(F.lit((level - 1) * PATHS + p + 1) for p in range(PATHS)))
    paths = members.withColumn("step", F.explode(steps)).join(nodes.select("node", "keys"), "node")
    other = F.element_at("keys", (F.pmod(F.col("i") + F.col("step"), F.lit(n_keys)) + 1).cast("int"))
    rows = written(
        paths.select(F.xxhash64("key", "step", other).alias("key"), "i", "node", "n", "comp"), "split"
    )
    sizes = rows.groupBy("key").agg(
        F.min("comp").alias("low"), F.max("comp").alias("high"), _tiles_needed().alias("tiles")
    )
    return written(rows.join(sizes.where("low < high").select("key", "tiles"), "key"), "split")


def _facing(members: DataFrame) -> DataFrame:
    """Tiles of half the size of blocks: sets outside their key's largest component, a
    block of them with each block of all sets of the key."""
    by_comp = members.groupBy("key", "comp").agg(F.count("*").alias("sets"))
    major = by_comp.groupBy("key").agg(F.max(F.struct("sets", "comp"))["comp"].alias("major"))
    placed = members.join(major, "key").withColumn("minor", F.col("comp") != F.col("major"))
    sizes = placed.groupBy("key").agg(
        (2 * _tiles_needed()).alias("all_blocks"),
        (2 * F.greatest(F.ceil(F.sum(F.col("minor").cast("int")) / TILE),
                        F.ceil(F.sum(F.when(F.col("minor"), F.col("n"))) / TILE_SHINGLES))).alias("minor_blocks"),
    )
    placed = written(placed.join(sizes, "key"), "facing")
    h = F.xxhash64("node", "key", F.lit(-1))

    def all_of(c: str):
        return F.explode(F.sequence(F.lit(0).cast("long"), F.col(c) - 1))

    few = placed.where("minor").select(
        "key", "node", F.lit(True).alias("minor"), F.pmod(h, F.col("minor_blocks")).alias("x"),
        all_of("all_blocks").alias("y"),
    )
    rest = placed.select(
        "key", "node", F.lit(False).alias("minor"), all_of("minor_blocks").alias("x"),
        F.pmod(h, F.col("all_blocks")).alias("y"),
    )
    rows = few.unionAll(rest).groupBy("key", "x", "y", "node").agg(F.max("minor").alias("minor"))
    return rows.select(F.xxhash64("key", "x", "y").alias("tile"), "node", "minor")
