from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from helpers_llm import AWKWARD, documents, fold
from shardsync.llm.common import work_dir
from shardsync.llm.dedup import exact_dedup, retain, retained, sha256


def check(rows, docs):
    groups = defaultdict(list)
    for i, t in docs:
        groups[fold(t)].append(i)
    assert len(rows) == len(docs)
    size = {i: len(g) for g in groups.values() for i in g}
    keep = {i: max(g, key=lambda x: (x is not None, x)) for g in groups.values() for i in g}
    assert all(r.group_size == size[r.doc_id] and r.keep_id == keep[r.doc_id] for r in rows)
    assert sum(r.kept for r in rows) == len(groups)
    assert all(r.doc_id == r.keep_id for r in rows if r.kept)


@pytest.mark.parametrize("digest", [sha256, lambda t: F.crc32(t.cast("binary")) % 2])
def test_awkward_rows_and_colliding_digests(spark, digest):
    docs = [*AWKWARD, (30, "WORD"), (31, "Word"), (32, "wörd"), (33, "WÖRD")]
    check(exact_dedup(documents(spark, docs, extra=True), digest).collect(), docs)


def test_files_are_not_copied(spark, tmp_path):
    documents(spark, AWKWARD).repartition(3).write.parquet(str(tmp_path / "d"))
    docs = spark.read.parquet(str(tmp_path / "d"))
    rows = exact_dedup(docs, files_at_once=1).collect()
    check(rows, AWKWARD)
    assert all(r.at.file.startswith("file:") for r in rows)


def test_empty_table(spark):
    assert exact_dedup(documents(spark, AWKWARD).limit(0)).count() == 0


def test_state_goes_on_after_a_restart(spark, tmp_path):
    feed, checkpoint = str(tmp_path / "feed"), work_dir(spark, "state") + "/checkpoint"

    def add(*rows):
        made = [(d, i, ("f", k)) for k, (d, i) in enumerate(rows)]
        kind = "digest string, doc_id long, at struct<file:string,row:long>"
        spark.createDataFrame(made, kind).write.mode("append").parquet(feed)
        stream = spark.readStream.schema(kind).parquet(feed)
        retain(stream, checkpoint).awaitTermination()
        return {r.digest: (r.keep.doc_id, r.n) for r in retained(spark, checkpoint).collect()}

    assert add(("a", 1), ("a", 5), ("b", 2)) == {"a": (5, 2), "b": (2, 1)}
    assert add(("a", 3), ("b", 9), ("c", None)) == {"a": (5, 3), "b": (9, 2), "c": (None, 1)}
