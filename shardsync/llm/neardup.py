"""Near duplicates by MinHash bands and odd sketches, confirmed on full sets."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shardsync.llm.common import encoders_freed, file_backed, located, quoted, written
from shardsync.llm.joins import Tile, keyed_documents, linked_rows, named_classes, set_id, text_sets
from shardsync.llm.words import mix

BANDS, ROWS = 32, 4
SKETCH_BITS = 1024
#: Set bits in the exclusive or of two sketches, at most, for a pair to go on. At a
#: similarity of 0.75 they number 60 on average with a deviation of 9.
MOST_DIFFERENT = 113

_k = np.arange(BANDS * ROWS, dtype=np.uint64)
_FACTORS = mix(_k * np.uint64(2) + np.uint64(1)) | np.uint64(1)
_SHIFTS = mix(_k * np.uint64(2) + np.uint64(2))
_BAND_SEEDS = mix(np.arange(1000, 1000 + BANDS, dtype=np.uint64))


def minhash(found: np.ndarray) -> np.ndarray:
    """The smallest hash of a set under each of the functions."""
    least = np.full(BANDS * ROWS, np.uint64(0xFFFFFFFFFFFFFFFF))
    for at in range(0, len(found), 2048):
        part = found[at : at + 2048]
        np.minimum(least, (_FACTORS[:, None] * part + _SHIFTS[:, None]).min(axis=1), out=least)
    return least


def bands(least: np.ndarray) -> np.ndarray:
    """One number for each band; equal only if its minima are, and never between
    different bands."""
    out = _BAND_SEEDS.copy()
    for row in least.reshape(BANDS, ROWS).T:
        out = mix(out ^ row)
    return out


def odd_sketch(least: np.ndarray) -> bytes:
    """Each (function, minimum) flips one bit. Shared ones cancel out in the exclusive
    or of two sketches, so its set bits count the others."""
    bit = (mix(least + _SHIFTS) >> np.uint64(54)).astype(np.int64)
    return np.packbits(np.bincount(bit, minlength=SKETCH_BITS) & 1).tobytes()


def estimate(different: float) -> float:
    """The similarity that a number of set bits in the exclusive or stands for."""
    inside = max(1e-9, 1 - 2 * different / SKETCH_BITS)
    return 1 + SKETCH_BITS / 2 * np.log(inside) / (2 * BANDS * ROWS)


def sketch_documents(rows: DataFrame, size: int = 5) -> DataFrame:
    """``doc_id``, ``row_key``, ``n`` (shingles); for sets with shingles ``node`` (their
    digest), ``keys`` (band numbers) and ``bits`` (the odd sketch)."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoders_freed()
        for batch in batches:
            n, nodes, keys, bits = [], [], [], []
            for found in text_sets(batch.column("text"), size):
                n.append(len(found))
                least = minhash(found) if len(found) else None
                nodes.append(set_id(found) if len(found) else None)
                keys.append(bands(least).view(np.int64) if len(found) else None)
                bits.append(odd_sketch(least) if len(found) else None)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), batch.column("row_key"), pa.array(n, pa.int64()),
                    pa.array(nodes, pa.binary()), pa.array(keys, pa.list_(pa.int64())), pa.array(bits, pa.binary()),
                ],
                ["doc_id", "row_key", "n", "node", "keys", "bits"],
            )

    return rows.mapInArrow(
        sketch, "doc_id long, row_key long, n long, node binary, keys array<long>, bits binary"
    )


class SketchTile(Tile):
    """A tile that compares odd sketches."""

    def may_be_alike(self) -> np.ndarray:
        """Pairs whose sizes fit and whose sketches differ in few enough bits."""
        odd = np.frombuffer(b"".join(self.bits), np.uint64).reshape(len(self.n), SKETCH_BITS // 64)
        out = np.empty((len(odd), len(odd)), bool)
        for at in range(0, len(odd), 64):
            rows = slice(at, at + 64)
            apart = np.bitwise_count(odd[rows, None] ^ odd[None]).sum(axis=2, dtype=np.int64)
            small = np.minimum(self.n[rows, None], self.n)
            large = np.maximum(self.n[rows, None], self.n)
            out[rows] = (apart <= MOST_DIFFERENT) & (100 * small >= self.percent * large)
        return out


def near_links(docs: DataFrame, size: int = 5, percent: int = 75) -> DataFrame:
    """Every row with its class: ``doc_id``, ``row_key`` (a hash of its place), ``n``
    (shingles), ``comp`` (null for empty sets); see :func:`near_dedup`."""
    docs = keyed_documents(docs)
    sketched = written(sketch_documents(docs, size), "sketches")
    rows = linked_rows(docs, sketched, size, lambda t: SketchTile(t, percent), BANDS, percent)
    return rows.select("doc_id", "row_key", "n", "comp")


def near_dedup(docs: DataFrame, size: int = 5, percent: int = 75) -> DataFrame:
    """Classes of near duplicates: ``doc_id``, ``n_shingles``, ``component_id``,
    ``kept``.

    Documents are linked if their sets of distinct ``size``-word shingles share at
    least ``percent`` of their union; a component is all that links reach, named
    after its smallest ``doc_id``, and the document of that id stays. Words are runs
    of non-blanks with A-Z in lower case. A text with fewer words is one shingle; null
    or blank texts have an empty set and stand alone. Every row comes out, repeated
    ones too. Rows that repeat a ``doc_id`` go by their own texts, and are all kept if it
    names their component. A null ``doc_id`` takes part by its text and is no name; its
    component is null if it has no other. Further columns are ignored; an empty table
    gives no rows.

    Each text gives its set's size, a digest, band numbers and an odd sketch of its
    MinHash sample. Sets that share a band number meet in tiles of bounded size
    (``linked_rows``), where the sketches' exclusive or says which pairs may be alike;
    full sets decide. Of documents at the limit, 5 pairs of a million share no band, and a
    sketch turns away one in 10 ** 9; these, and all that the tiles of a large bucket take
    apart, meet by their rarest shingles, where no link can be missed."""
    found = named_classes(near_links(docs, size, percent))
    kept = F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("component_id").isNull())
    return found.withColumn("kept", kept)


def without_near_copies(docs: DataFrame, size: int = 5, percent: int = 75) -> DataFrame:
    """``docs`` with one row of each class: of the smallest ``doc_id`` (null last), and of
    rows that share it, that with the smallest hash of its place. Rows without words all
    stay. Columns come out as they are, whatever their names."""
    docs = file_backed(docs)
    rows = near_links(docs, size, percent).where("n > 0")
    order = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "row_key")
    rows = written(rows.select("comp", order.alias("place")), "places")
    first = rows.groupBy("comp").agg(F.min("place").alias("first"))
    gone = rows.join(first, "comp").where(F.col("place") != F.col("first"))
    gone = gone.select(F.col("place.row_key").alias("k"), F.col("place.doc_id").alias("d"))
    whole = located(docs, F.struct(*(F.col(quoted(c)) for c in docs.columns)).alias("row"), F.col("doc_id").cast("long").alias("d"))
    whole = whole.withColumn("k", F.xxhash64("at.file", "at.row"))
    same = (whole["k"] == gone["k"]) & whole["d"].eqNullSafe(gone["d"])
    return whole.join(gone, same, "left_anti").select("row.*")
