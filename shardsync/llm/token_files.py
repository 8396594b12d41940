"""Flat token files without an index: writing them, and finding their documents
by a scan for end-of-document ids."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shardsync.llm.common import pieces_of, tidy, work_dir, written
from shardsync.llm.tokens import TOKENIZER, encoder

#: The id that byte_bpe_50k reserves for the end of a document.
END_ID = 50256
_MANIFEST = "doc_id long, file string, ordinal long"
_FOUND = "file string, block long, at array<long>, tokens long"


def open_store(uri: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """The file system Arrow has for a URI, and the path in it."""
    if ":" not in uri.split("/", 1)[0]:
        uri = "file://" + uri
    elif uri.startswith("file:/") and not uri.startswith("file:///"):
        uri = "file:///" + uri.removeprefix("file:").lstrip("/")
    return pyarrow.fs.FileSystem.from_uri(uri)


def write_token_files(
    docs: DataFrame, folder: str, end_id: int = END_ID, dtype: str = "<u2",
    tokenizer: str = TOKENIZER,
) -> DataFrame:
    """Append the ids of whole texts, each followed by ``end_id``, to flat files, one
    for each task, and return a written manifest: ``doc_id``, ``file`` and the
    document's place among those of its file.

    A task that runs again writes a file of its own; the manifest names only the
    files of tasks that ended well, so the others are never read. An id that
    ``dtype`` can't hold, or that equals ``end_id`` inside a text, is an error."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        file = f"{folder}/tokens-{task.partitionId():05d}-{uuid.uuid4().hex}.bin"
        store, path = open_store(file)
        most = np.iinfo(dtype).max
        n = 0
        with store.open_output_stream(path) as out:
            for batch in batches:
                for lo, hi, _, _ in pieces_of(batch.column(1)):
                    rows = batch.column(1)[lo:hi].to_pylist()
                    for ids in encoder(tokenizer, special=False).encode([t or "" for t in rows]):
                        ids = np.frombuffer(ids, "<u4")
                        if len(ids) and (ids.max() > most or (ids == end_id).any()):
                            raise ValueError("a text's ids don't fit the token file")
                        out.write(np.append(ids, np.uint32(end_id)).astype(dtype).tobytes())
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column(0)[lo:hi],
                            pa.array([file] * (hi - lo)),
                            pa.array(range(n, n + hi - lo), pa.int64()),
                        ],
                        ["doc_id", "file", "ordinal"],
                    )
                    n += hi - lo

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text"))
    return written(rows.mapInArrow(write, _MANIFEST), "token-manifest")


def file_sizes(spark: SparkSession, files: DataFrame) -> DataFrame:
    """``file`` and ``n_bytes`` for a table of distinct file names."""

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.column(0).to_pylist()
            sizes = [(s := open_store(x))[0].get_file_info(s[1]).size for x in names]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64())], ["file", "n_bytes"]
            )

    return files.select("file").mapInArrow(look, "file string, n_bytes long")


def scan_separators(
    files: DataFrame, end_id: int = END_ID, dtype: str = "<u2", block_tokens: int = 1 << 22
) -> DataFrame:
    """The documents of flat token files (``file``, ``n_bytes``), one row each:
    ``file``, ``ordinal`` from 0, ``start`` (tokens before it), ``n_tokens`` without
    the end id, ``closed``.

    Blocks of ``block_tokens`` are read by range and searched with one vector
    comparison each; a task holds one block. A running sum and maximum over the
    blocks' summaries give each block its first ordinal and the start of the document
    that reaches into it, so documents may span any number of blocks. Tokens behind
    the last end id are a document that is not ``closed``. Empty files have no rows;
    a last byte that is no whole token is ignored."""
    width = np.dtype(dtype).itemsize

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                store, path = open_store(row["file"])
                first = row["block"] * block_tokens
                n = min(block_tokens, row["n_bytes"] // width - first)
                with store.open_input_file(path) as source:
                    source.seek(first * width)
                    ids = np.frombuffer(source.read(n * width), dtype)
                at = np.flatnonzero(ids == end_id) + first
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row["file"]]),
                        pa.array([row["block"]], pa.int64()),
                        pa.array([at], pa.list_(pa.int64())),
                        pa.array([n], pa.int64()),
                    ],
                    ["file", "block", "at", "tokens"],
                )

    last = F.expr(f"(n_bytes div {width} - 1) div {block_tokens}")
    blocks = (
        files.where(F.col("n_bytes") >= width)
        .select("file", "n_bytes", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("block"))
        .repartition("file", "block")
    )
    found = written(blocks.mapInArrow(search, _FOUND), "separators")
    before = Window.partitionBy("file").orderBy("block").rowsBetween(
        Window.unboundedPreceding, -1
    )
    whole = Window.partitionBy("file")
    summary = found.select(
        "file", "block", F.size("at").cast("long").alias("n"), F.try_element_at("at", F.lit(-1)).alias("end"),
        "tokens",
    )
    carried = summary.select(
        "file",
        "block",
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"),
        F.coalesce(F.max("end").over(before) + 1, F.lit(0)).alias("open_from"),
        (F.max("block").over(whole) == F.col("block")).alias("is_last"),
        F.sum("tokens").over(whole).alias("file_tokens"),
    )
    joined = found.join(carried, ["file", "block"])
    ends = F.when(
        F.col("is_last") & (F.coalesce(F.try_element_at("at", F.lit(-1)), F.col("open_from") - 1) + 1
                            < F.col("file_tokens")),
        F.concat("at", F.array("file_tokens")),
    ).otherwise(F.col("at"))
    rows = joined.select(
        "file", "first", "open_from", "file_tokens", "at", F.posexplode(ends).alias("k", "end")
    )
    start = F.when(F.col("k") == 0, F.col("open_from")).otherwise(
        F.get("at", F.col("k") - 1) + 1
    )
    return rows.select(
        "file",
        (F.col("first") + F.col("k")).alias("ordinal"),
        start.alias("start"),
        (F.col("end") - start).alias("n_tokens"),
        (F.col("end") < F.col("file_tokens")).alias("closed"),
    )


def count_tokens(docs: DataFrame, tokenizer: str = TOKENIZER) -> DataFrame:
    """Tokens of whole documents as their flat files show them: ``doc_id``, ``file``,
    ``ordinal``, ``start``, ``n_tokens``.

    Null and empty texts have 0 tokens. Rows that repeat come out as often as they
    came in; a null ``doc_id`` stays null; further columns are ignored."""
    spark = docs.sparkSession
    manifest = write_token_files(docs, work_dir(spark, "token-files"), tokenizer=tokenizer)
    files = file_sizes(spark, manifest.select("file").distinct())
    with tidy(spark):
        found = scan_separators(files)
    return manifest.join(found.drop("closed"), ["file", "ordinal"])
