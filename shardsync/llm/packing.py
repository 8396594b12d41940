"""Best-fit packing of token sequences with a bounded number of open bins."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shardsync.llm.common import pieces_of, written
from shardsync.llm.tokens import TOKENIZER, encoder

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


class OpenBins:
    """At most ``limit`` open bins of ``size``. Bit f of a bitset says that some
    bin has f left, so the best fit is the lowest set bit not below the need. When
    a bin too many opens, the fullest one closes."""

    def __init__(self, size: int, limit: int):
        self.size, self.limit = size, limit
        self._bits = 0
        self._by_free: list[list[int]] = [[] for _ in range(size + 1)]
        self._open = self.opened = 0

    def place(self, need: int) -> tuple[int, int]:
        """The bin that takes ``need`` and the place in it."""
        fits = self._bits >> need
        if fits:
            free = need + (fits & -fits).bit_length() - 1
            number = self._take(free)
        else:
            free, number = self.size, self.opened
            self.opened += 1
            if need < self.size and self._open == self.limit:
                self._take((self._bits & -self._bits).bit_length() - 1)
        left = free - need
        if left:
            self._by_free[left].append(number)
            self._bits |= 1 << left
            self._open += 1
        return number, self.size - free

    def _take(self, free: int) -> int:
        bins = self._by_free[free]
        number = bins.pop()
        if not bins:
            self._bits ^= 1 << free
        self._open -= 1
        return number


def cut_pieces(
    docs: DataFrame, size: int = 2048, end_id: int = 0, tokenizer: str = TOKENIZER,
    with_ids: bool = False,
) -> DataFrame:
    """Token pieces of at most ``size``, without a shuffle.

    A document is the ids of its whole text (null: empty) and ``end_id``. A longer
    one is cut so that all but its first piece are full. ``with_ids`` adds the ids."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        end = np.array([end_id], "<u4").tobytes()
        for batch in batches:
            texts, names = batch.column(1), batch.column(0)
            for lo, hi, _, _ in pieces_of(texts):
                rows = texts[lo:hi].to_pylist()
                out = []
                ids = encoder(tokenizer).encode([t or "" for t in rows])
                for name, doc in zip(names[lo:hi].to_pylist(), ids, strict=True):
                    doc += end
                    n = len(doc) // 4
                    first = n % size or size
                    bounds = [0, *range(min(first, n), n + 1, size)]
                    for k, (a, b) in enumerate(zip(bounds, bounds[1:], strict=False)):
                        part = doc[4 * a : 4 * b]
                        out.append((name, k, a, b - a, zlib.crc32(part), part))
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
                cols = list(zip(*out, strict=True))
                made = [pa.array(c, t) for c, t in zip(cols, kinds, strict=False)]
                labels = ["doc_id", "piece", "start", "length", "ids_crc32"]
                if with_ids:
                    flat = pa.array(np.frombuffer(b"".join(cols[5]), "<u4").astype(np.int32))
                    ends = np.cumsum([0, *cols[3]]).astype(np.int32)
                    made.append(pa.ListArray.from_arrays(pa.array(ends), flat))
                    labels.append("ids")
                yield pa.RecordBatch.from_arrays(made, labels)

    schema = PIECES + (", ids array<int>" if with_ids else "")
    return docs.select(F.col("doc_id").cast("long"), F.col("text")).mapInArrow(cut, schema)


def pack_pieces(
    pieces: DataFrame, size: int = 2048, open_bins: int = 4096
) -> DataFrame:
    """Give every piece a sequence and a gapless place in it. Each task packs its
    own rows batch by batch, a batch's longest first; what a task leaves unfilled is
    at most its open bins."""
    at = pieces.columns.index("length")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins = OpenBins(size, open_bins)
        base = TaskContext.get().partitionId() << 40
        for batch in batches:
            batch = batch.take(np.argsort(-np.asarray(batch.column(at)), kind="stable"))
            placed = [bins.place(n) for n in batch.column(at).to_pylist()]
            made = [pa.array([x[k] for x in placed], pa.int64()) for k in (0, 1)]
            made[0] = pa.array(np.asarray(made[0]) + base, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *made], [*batch.schema.names, "sequence_id", "offset"]
            )

    kind = T.StructType(
        [*pieces.schema, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())]
    )
    return pieces.mapInArrow(pack, kind)


def pack_documents(
    docs: DataFrame, size: int = 2048, end_id: int = 0, open_bins: int = 4096,
    tokenizer: str = TOKENIZER, with_ids: bool = False, task_rows: int = 500_000,
) -> DataFrame:
    """Pack whole documents (``doc_id``, ``text``) into sequences of ``size`` tokens.

    Bounded-space online best fit: see ``OpenBins``. The pieces are written once;
    their narrow rows are packed about ``task_rows`` to a task, so the number of
    part-filled sequences does not depend on how the input was split.

    Null text is empty and still has its end id. Rows that repeat come out as often
    as they came in; a null ``doc_id`` stays null; further columns are ignored; an
    empty table gives no rows. Pieces of a text of any length are cut in one pass."""
    pieces = written(cut_pieces(docs, size, end_id, tokenizer, with_ids), "pieces")
    tasks = max(1, -(-pieces.count() // task_rows))
    return pack_pieces(pieces.coalesce(tasks), size, open_bins)
