"""The corpus pipeline: documents in, packed training sequences out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shardsync.llm.common import file_backed, located, quoted, ship_package, written
from shardsync.llm.dedup import exact_dedup
from shardsync.llm.language import UNKNOWN, fit, predict_language, training_sample, usual_bits
from shardsync.llm.mixing import mix_documents
from shardsync.llm.neardup import without_near_copies
from shardsync.llm.packing import pack_documents

#: Texts whose code is this many times longer than usual are in no learned language.
MOST_OF_USUAL = 2.0
#: Shorter texts, in bytes, are not judged by the length of their code.
LEAST_BYTES = 200
#: No source is taken more often than this.
MOST_REPEATS = 2.0


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that was learned; ``lang`` stays where it is known and is
    predicted where it is null.

    Documents without a letter go (null and empty texts among them), and those of
    ``LEAST_BYTES`` or more whose best code needs ``MOST_OF_USUAL`` times the bits a byte that
    99 of 100 held-out labelled texts need. If nothing was learned, or there are too few held-out
    texts, that rule rejects none. Rows that repeat stay or go together, null ids are judged
    like others, and columns come out as they are, whatever their names; an empty table
    gives no rows."""
    ship_package(spark)
    model = fit(training_sample(docs))
    if not model.names:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    limit = usual_bits(docs, model)
    names = [f"c{k}" for k in range(len(docs.columns))]
    text, lang = (names[docs.columns.index(c)] for c in ("text", "lang"))
    plain = docs.toDF(*names)
    found = predict_language(plain.withColumnRenamed(text, "text"), model, keep=tuple("text" if n == text else n for n in names))
    good = F.col("lang_pred") != UNKNOWN
    if limit is not None:
        usual = F.col("bits_per_byte") <= MOST_OF_USUAL * limit
        good = good & (usual | (F.octet_length("text") < LEAST_BYTES))
    kept = found.where(good).withColumn(lang, F.coalesce(lang, "lang_pred"))
    return kept.withColumnRenamed("text", text).select(*names).toDF(*docs.columns)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts (A-Z in lower case, null as empty), the row with the largest id; of
    rows that share that id, the last by place. A null id is smaller than any other.
    Columns come out as they are, whatever their names; an empty table gives no rows."""
    ship_package(spark)
    docs = file_backed(docs)
    gone = exact_dedup(docs).where(~F.col("kept")).select("at")
    row = F.struct(*(F.col(quoted(c)) for c in docs.columns)).alias("row")
    return located(docs, row).join(gone, "at", "left_anti").select("row.*")


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates, the document with the smallest id, and one of the rows
    that share it. Null ids come last; texts without words all stay. Columns come out as
    they are, whatever their names; an empty table gives no rows."""
    ship_package(spark)
    return without_near_copies(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document at least once; those of small sources again, up to
    ``MOST_REPEATS`` times. A null source is a source of its own; texts without words count
    no tokens. Rows that repeat are taken alike. Columns come out as they are, whatever
    their names; an empty table gives no rows."""
    ship_package(spark)
    return mix_documents(docs, repeats=MOST_REPEATS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token pieces of the documents and their places in sequences. A null text is
    empty and has its end id; rows that repeat are packed as often; null ids stay null;
    further columns are left out; an empty table gives no rows."""
    ship_package(spark)
    return pack_documents(docs)


STAGES = [
    ("language_id", language_id),
    ("exact_copies", exact_copies),
    ("near_copies", near_copies),
    ("source_mix", source_mix),
    ("pack", pack),
]

#: Language models, shingle graphs and byte-pair ids are beyond SQL; the tests hold
#: the rows against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
