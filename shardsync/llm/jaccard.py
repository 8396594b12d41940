"""Exact Jaccard join of word-shingle sets: size-banded tiles and bitmap signatures."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from shardsync.llm.common import written
from shardsync.llm.joins import (
    Tile, bits_for, keyed_documents, linked_rows, named_classes, set_id, signature, text_sets,
)
from shardsync.llm.words import mix

#: Keys of a set, and minima that make one key.
KEYS, ROWS = 32, 3

_k = np.arange(KEYS * ROWS, dtype=np.uint64)
_FACTORS = mix(_k * np.uint64(2) + np.uint64(501)) | np.uint64(1)
_SHIFTS = mix(_k * np.uint64(2) + np.uint64(502))
_SEEDS = mix(np.arange(5000, 5000 + KEYS, dtype=np.uint64))


def size_bands(most: int, percent: int) -> np.ndarray:
    """Lower bounds of bands of set sizes, up to ``most``. Sets can only be alike within
    a band or between neighbouring ones: whatever is two bands up is larger by more
    than ``percent`` allows."""
    bounds = [1]
    while bounds[-1] <= most:
        bounds.append(bounds[-1] * 100 // percent + 1)
    return np.array(bounds)


def folded(signatures: np.ndarray, words_: int) -> np.ndarray:
    """Signatures of fewer 64-bit words: a cell's parity is that of the cells it joins."""
    while signatures.shape[1] > words_:
        half = signatures.shape[1] // 2
        signatures = signatures[:, :half] ^ signatures[:, half:]
    return signatures


def set_keys(found: np.ndarray) -> np.ndarray:
    """The keys of a set: each is made of ``ROWS`` minima of its shingles' hashes."""
    least = np.full(KEYS * ROWS, np.uint64(0xFFFFFFFFFFFFFFFF))
    for at in range(0, len(found), 2048):
        part = found[at : at + 2048]
        np.minimum(least, (_FACTORS[:, None] * part + _SHIFTS[:, None]).min(axis=1), out=least)
    out = _SEEDS.copy()
    for row in least.reshape(KEYS, ROWS).T:
        out = mix(out ^ row)
    return out


def _sketches(rows: DataFrame, size: int, percent: int) -> DataFrame:
    """``doc_id``, ``row_key``, ``n``; for sets with shingles ``node``, ``keys``, ``bits``."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, nodes, keys, bits = [], [], [], []
            for found in text_sets(batch.column("text"), size):
                n.append(len(found))
                some = len(found) > 0
                bounds = size_bands(len(found), percent)
                low = int(bounds[np.searchsorted(bounds, len(found), "right") - 1]) if some else 0
                nodes.append(set_id(found) if some else None)
                keys.append(set_keys(found).view(np.int64) if some else None)
                bits.append(signature(found, bits_for(low)).tobytes() if some else None)
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


class BandedTile(Tile):
    """A tile that compares neighbouring size bands by their signatures."""

    def may_be_alike(self) -> np.ndarray:
        """Pairs that may be alike. Differing signature bits are
        at most as many as shingles that only one of two sets has, so they bound the
        overlap from above."""
        size = len(self.n)
        out = np.zeros((size, size), bool)
        bounds = size_bands(int(self.n.max()), self.percent)
        band = np.searchsorted(bounds, self.n, "right") - 1
        members = {b: np.flatnonzero(band == b) for b in np.unique(band)}
        signatures = {
            b: np.frombuffer(b"".join(self.bits[i] for i in at), np.uint64).reshape(len(at), -1)
            for b, at in members.items()
        }
        for b, own in members.items():
            for other in (b, b - 1):
                if other in members:
                    theirs = signatures[other]
                    mine = folded(signatures[b], theirs.shape[1])
                    step = max(1, (1 << 20) // theirs.size)
                    for at in range(0, len(own), step):
                        rows = own[at : at + step]
                        fit = self._fit(rows, mine[at : at + step], members[other], theirs)
                        out[np.ix_(rows, members[other])] |= fit
                        out[np.ix_(members[other], rows)] |= fit.T
        return out

    def _fit(self, a: np.ndarray, mine: np.ndarray, b: np.ndarray, theirs: np.ndarray) -> np.ndarray:
        apart = np.bitwise_count(mine[:, None] ^ theirs[None]).sum(axis=2, dtype=np.int64)
        total = self.n[a][:, None] + self.n[b]
        both = np.minimum((total - apart) // 2, np.minimum(self.n[a][:, None], self.n[b]))
        return 100 * both >= self.percent * (total - both)



def jaccard_classes(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """Classes of documents whose shingle sets are alike: ``doc_id``, ``n_shingles``,
    ``component_id``.

    Two documents are linked if their sets of distinct ``size``-word shingles share at
    least ``percent`` of their union; a component is all that links reach, named after
    its smallest ``doc_id``. Words are runs of non-blanks with A-Z in lower case. A text
    with fewer words is one shingle; null or blank texts have an empty set and stand
    alone. Every row comes out. Rows that repeat a ``doc_id`` go by their own texts; a
    null ``doc_id`` takes part by its text and is no name (null, if its component has no
    other). Further columns are ignored; an empty table gives no rows.

    1. Each text gives its set's size, digest, keys (minima of its shingles' hashes) and
       a bitmap signature whose width goes by its size band. Equal sets go on as one.
    2. Sets that share a key meet in tiles of bounded size. A tile compares neighbouring
       size bands: signature bits bound the overlap from above, and pairs that pass are
       intersected exactly, as sorted arrays. Pairs already in one component are left out.
    3. A key with more sets than a tile holds is dealt over several tiles. If these
       leave it in several components, it is split by pairs of further keys, in which
       unlike sets fall apart, and at last its minor components meet all its sets, block
       by block. No bucket is cut off, and a tile yields one row a set at most.
    4. Two sets at the limit share no key in one of 10 ** 10 cases, and a split can take
       two sets apart; these meet by their rarest shingles, where no link can be missed.

    Signatures and intersections are exact."""
    docs = keyed_documents(docs)
    sketched = written(_sketches(docs, size, percent), "sketches")
    return named_classes(linked_rows(docs, sketched, size, lambda t: BandedTile(t, percent), KEYS, percent))
