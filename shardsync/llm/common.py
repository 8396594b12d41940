"""What the operators share: the shared folder, text helpers, Arrow batches."""

from __future__ import annotations

import shutil
import string
import sys
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Within a written step, a finished query's shuffle files go at once, and batches of long texts
#: that Python gets are this large at most: they are held several times, in the JVM and in Python.
STEP_CONF = {
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(8 << 20),
}
_shipped: dict[str, str] = {}


@lru_cache(maxsize=1)
def _own_dir() -> str:
    return tempfile.mkdtemp(prefix="shardsync-llm-")


def work_dir(spark: SparkSession, label: str) -> str:
    """A new folder name below ``spark.checkpoint.dir``. It is deleted when the
    driver ends, as results may read from it until then. Without that setting,
    only a session without executors of its own gets a local folder."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.conf.get("spark.master", "")
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        base = _own_dir()
    path = f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(folder)
    files.deleteOnExit(folder)
    return path


@contextmanager
def tidy(spark: SparkSession) -> Iterator[None]:
    """Within the block, ``STEP_CONF`` holds."""
    before = {key: spark.conf.get(key, None) for key in STEP_CONF}
    for key, value in STEP_CONF.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a table in the shared folder: lineage ends there, and lost
    executors cost nothing before it."""
    spark = df.sparkSession
    path = f"{work_dir(spark, label)}/table"
    with tidy(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _place() -> Column:
    return F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))


def file_backed(docs: DataFrame) -> DataFrame:
    """``docs`` if its rows have places in files, else a written copy of it."""
    try:
        docs.select(_place())
        return docs
    except AnalysisException:
        return written(docs, "located")


def located(docs: DataFrame, *columns: Column | str) -> DataFrame:
    """``columns`` and the content locator ``at``: file and row in it. A table that is
    no file scan, and so has no places of its own, is written first."""
    return file_backed(docs).select(*columns, _place().alias("at"))


def quoted(name: str) -> str:
    """A column's name as it is, whatever signs are in it."""
    return "`" + name.replace("`", "``") + "`"


def lower_ascii(c: Column) -> Column:
    """A-Z in lower case, other letters as they are. Plain ASCII takes the fast way."""
    ascii_only = F.octet_length(c) == F.char_length(c)
    return F.when(ascii_only, F.lower(c)).otherwise(
        F.translate(c, string.ascii_uppercase, string.ascii_lowercase)
    )


def held_out(doc_id: Column) -> Column:
    """Rows that no model learns from: crc32 of the id as text, modulo 3, is 1.
    A null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 3 == 1


def pieces_of(
    texts: pa.Array | pa.ChunkedArray, limit: int = 1 << 20
) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Rows ``lo:hi`` of a text column with their UTF-8 bytes and offsets, about
    ``limit`` bytes at a time; a longer text comes alone. Null reads as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    n = len(texts)
    if not n:
        return
    buffers = texts.buffers()
    offsets = np.frombuffer(buffers[1], np.int64, n + 1, 8 * texts.offset)
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] else np.empty(0, np.uint8)
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1)
        hi = min(hi, n)
        yield lo, hi, data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
        lo = hi


def encoders_freed() -> None:
    """In a Python worker that goes on with other work than token ids: the memory of the
    encoders and the pieces they remember is given back. Workers serve many stages."""
    tokens = sys.modules.get("shardsync.llm.tokens")
    if tokens:
        tokens.encoder.cache_clear()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, once for each Spark context, for sessions
    that were started without it."""
    context = spark.sparkContext
    if _shipped.get("to") != context.applicationId:
        root = Path(__file__).resolve().parents[2]
        base = f"{tempfile.mkdtemp(prefix='shardsync-code-')}/shardsync"
        context.addPyFile(shutil.make_archive(base, "zip", root, "shardsync"))
        _shipped["to"] = context.applicationId
