"""Exact copies by a stream over digests with state that never expires.

Only DataFrame and SQL functions are used."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shardsync.llm.common import located, lower_ascii, tidy, work_dir, written

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Without space set aside beforehand, and with one bound for all stores of an executor.
ROCKSDB_SETTINGS = {
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "256",
}
PARTITIONS = "spark.sql.shuffle.partitions"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"


def sha256(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def normal_text(text: Column) -> Column:
    """What is compared: A-Z in lower case, null as empty."""
    return lower_ascii(F.coalesce(text, F.lit("")))


def retain(feed: DataFrame, checkpoint: str):
    """Start a stream over ``digest``, ``doc_id`` and ``at``. For each digest the
    state keeps, on disk and without expiry, the row with the largest ``doc_id``
    (ties: the larger locator; null ids come last) and the number of rows seen. A
    restart from ``checkpoint`` goes on where the last one ended, each row counting
    once."""
    entry = F.struct("doc_id", "at")
    state = feed.groupBy("digest").agg(F.max(entry).alias("keep"), F.count("*").alias("n"))
    stream = state.writeStream.format("noop").outputMode("update")
    return stream.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def retained(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The state of ``retain``: ``digest``, ``keep`` and ``n``."""
    state = spark.read.format("statestore").load(checkpoint)
    value = state.schema["value"].dataType.names
    return state.select(
        F.col("key.digest").alias("digest"),
        F.col("value").getField(value[0]).alias("keep"),
        F.col("value").getField(value[1]).alias("n"),
    )


def exact_dedup(
    docs: DataFrame, digest: Callable[[Column], Column] = sha256, files_at_once: int | None = None
) -> DataFrame:
    """Classes of equal texts: ``doc_id``, ``keep_id``, ``group_size``, ``kept``,
    ``text_sha256``, and the locators ``at`` (of the row) and ``keep_at``.

    Texts are equal if the same after ``normal_text``. Of each class the row with the
    largest ``doc_id`` stays; a null id counts as the smallest, and among rows that
    repeat an id the one with the larger locator stays, so exactly one row of a class
    is kept. Null texts are one class with empty ones. Every row comes out, repeated
    ones too; an empty table gives none; further columns are ignored.

    1. Digests, ids and locators go to a table, which is streamed into keyed state
       in RocksDB (``retain``; ``files_at_once`` bounds a batch).
    2. A digest that was met again is a hit. Among the rows of hits, the locator of
       the retained one finds its text, which is compared byte by byte with every
       other text of that digest. The texts meet the hits in one merge join: hits grow
       with the data, so they are never sent to all executors.
    3. Texts that differ in spite of equal digests are classed by the full text.

    Copies of one text meet in partial aggregates first. The comparison joins them on
    the digest, where adaptive execution splits the rows of a hot one."""
    spark = docs.sparkSession
    normal = normal_text(F.col("text"))
    rows = located(docs, F.col("doc_id").cast("long").alias("doc_id"), normal.alias("normal"))
    keyed = rows.select("*", digest(F.col("normal")).alias("digest"))

    feed, checkpoint = (work_dir(spark, f"dedup-{x}") for x in ("feed", "state"))
    with tidy(spark):
        keyed.select("digest", "doc_id", "at").write.mode("append").parquet(feed)
    hits = _hits(spark, feed, checkpoint, files_at_once)

    text = F.when(F.col("n").isNotNull(), F.col("normal")).alias("text")
    sha = sha256(F.col("normal")).alias("text_sha256")
    placed = keyed.hint("merge").join(hits, "digest", "left")
    placed = written(
        placed.select("doc_id", "at", "digest", sha, "keep", "n", text), "dedup-placed"
    )
    kept = placed.where(F.col("keep")["at"] == F.col("at"))
    kept = written(kept.select("digest", F.col("text").alias("kept_text")), "dedup-texts")
    same = F.coalesce(F.col("kept_text") == F.col("text"), F.lit(True)).alias("same")
    columns = ["doc_id", "at", "digest", "text_sha256", "keep", "n"]
    again = placed.where("n IS NOT NULL").join(kept, "digest").select(*columns, same)
    alone = placed.where("n IS NULL").select(*columns, F.lit(True).alias("same"))
    found = written(alone.unionByName(again), "dedup-found")
    differ = found.where(~F.col("same")).select("digest").distinct()
    if not differ.isEmpty():
        found = _by_text(found, rows, written(differ, "dedup-differ"))
    keep_at = F.coalesce(F.col("keep")["at"], F.col("at"))
    return found.select(
        "doc_id",
        F.when(F.col("keep").isNull(), F.col("doc_id")).otherwise(F.col("keep")["doc_id"]).alias("keep_id"),
        F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
        (keep_at == F.col("at")).alias("kept"),
        "text_sha256",
        "at",
        keep_at.alias("keep_at"),
    )


def _hits(spark: SparkSession, feed: str, checkpoint: str, files_at_once: int | None) -> DataFrame:
    """Run the feed through the state; the entries of digests that came again."""
    session = spark.newSession()
    session.conf.set(PROVIDER, ROCKSDB)
    for name, value in ROCKSDB_SETTINGS.items():
        session.conf.set(name, value)
    session.conf.set(PARTITIONS, spark.conf.get(PARTITIONS))
    stream = session.readStream.schema(session.read.parquet(feed).schema)
    if files_at_once:
        stream = stream.option("maxFilesPerTrigger", files_at_once)
    retain(stream.parquet(feed), checkpoint).awaitTermination()
    path = f"{work_dir(spark, 'dedup-hits')}/table"
    state = retained(session, checkpoint).where("n > 1")
    state.write.parquet(path)
    return spark.read.schema(state.schema).parquet(path)


def _by_text(found: DataFrame, rows: DataFrame, digests: DataFrame) -> DataFrame:
    """Class the rows of ``digests`` by their full texts; the rest stays as found."""
    mixed = found.join(digests, "digest", "left_semi").drop("keep", "n")
    texts = written(mixed.join(rows.select("at", "normal"), "at"), "dedup-mixed")
    classes = texts.groupBy("normal").agg(
        F.max(F.struct("doc_id", "at")).alias("keep"), F.count("*").alias("n")
    )
    again = texts.join(written(classes, "dedup-classes"), "normal").select(found.columns)
    return found.join(digests, "digest", "left_anti").select(found.columns).unionAll(again)
