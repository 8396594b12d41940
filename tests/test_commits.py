"""Commit log, published tables, content digests, committed views of streams."""

import shutil
from collections import Counter
from pathlib import Path

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from shardsync import (
    CommitConflict,
    ContentMismatch,
    ShardSpec,
    WriteDigest,
    content_digest,
    file_cluster,
    publish_sharded,
    read_sharded,
    read_stream_sink,
    remove_replaced,
    stream_commits,
    sync_table,
    verify_published,
    write_sharded,
    write_stream_sharded,
)
from shardsync.operators.commits import Commit, commit, current, parse_commit, read_facts, read_log
from shardsync.operators.digest import Digest
from shardsync.sinks.publish import next_version
from shardsync.streaming.sink import next_attempt


def rows(spark, n=300, start=0):
    return spark.range(start, start + n).select(
        (F.col("id") % 8).cast("int").alias("segment_id"), "id", F.concat(F.lit("n"), "id").alias("name")
    )


def ids(df):
    return sorted(r.id for r in df.select("id").collect())


def apart(tmp_path, n=3):
    return [ShardSpec((str(tmp_path / f"s{i}"),)) for i in range(n)]


def dead(tmp_path, shards):
    (tmp_path / "file").write_text("no folder")
    return [shards[0], ShardSpec((str(tmp_path / "file" / "x"),)), *shards[2:]]


def test_entry_names():
    for c in (Commit("", 3, 4), Commit("a.b-c", 0, 10**9, 2, "0f3e")):
        assert parse_commit(c.file) == c
    assert parse_commit("_SUCCESS") is None and parse_commit(".draft-1") is None


def test_current_parts():
    log = [Commit("a", 0, 0), Commit("a", 0, 1), Commit("a", 1, 0), Commit("a", 1, 0, 1), Commit("a", 1, 2), Commit("b", 0, 7)]
    assert current(reversed(log)) == [Commit("a", 1, 0, 1), Commit("a", 1, 2), Commit("b", 0, 7)]
    assert current([]) == []


def test_next_entries():
    assert next_version([], "append") == Commit("", 0, 0)
    assert next_version([Commit("", 0, 0), Commit("", 0, 1)], "append") == Commit("", 0, 2)
    assert next_version([Commit("", 0, 0), Commit("", 0, 1)], "overwrite") == Commit("", 1, 0)
    own = [Commit("a", 0, 0, 0, "q"), Commit("a", 0, 1, 0, "q")]
    assert next_attempt([], "a", 0, "q") == Commit("a", 0, 0, 0, "q")
    assert next_attempt(own, "a", 2, "q") == Commit("a", 0, 2, 0, "q")
    assert next_attempt(own, "a", 1, "q") == Commit("a", 0, 1, 1, "q")
    assert next_attempt(own, "a", 0, "r") == Commit("a", 1, 0, 0, "r")
    with pytest.raises(ValueError, match="started anew"):
        next_attempt([*own, Commit("a", 1, 0, 0, "r")], "a", 2, "q")


def test_an_entry_is_made_once(spark, tmp_path):
    base = str(tmp_path)
    assert read_log(spark, base) is None
    commit(spark, base, Commit("", 0, 0), {"rows": 1})
    with pytest.raises(CommitConflict):
        commit(spark, base, Commit("", 0, 0), {"rows": 2})
    assert read_log(spark, base) == [Commit("", 0, 0)]
    assert read_facts(spark, base, Commit("", 0, 0)) == {"rows": 1}
    assert [p.name for p in (tmp_path / "_commits").glob(".draft*")] == []


@pytest.mark.parametrize("fmt", ["parquet", "lines"])
@pytest.mark.parametrize("place", ["apart", "root"])
def test_published_versions(spark, tmp_path, place, fmt):
    shards = apart(tmp_path) if place == "apart" else file_cluster(str(tmp_path), 3)
    schema = rows(spark).schema
    read = lambda: read_sharded(spark, shards, "t", schema=schema, fmt=fmt, shard_column="at")
    digest = publish_sharded(rows(spark, 100), shards, "t", fmt=fmt)
    assert digest.rows == 100 and sum(n for n, _ in digest.shards) == 100
    publish_sharded(rows(spark, 50, 100), shards, "t", mode="append", fmt=fmt)
    assert ids(read()) == list(range(150)) and read().where("at <> segment_id % 3").isEmpty()
    assert verify_published(spark, shards, "t", schema, fmt).rows == 150
    before = read()
    publish_sharded(rows(spark, 10), shards, "t", fmt=fmt)
    assert ids(read()) == list(range(10))
    assert before.count() == 150  # whoever read the log before still reads what it named
    assert remove_replaced(spark, shards, "t") == 2
    assert ids(read()) == list(range(10)) and remove_replaced(spark, shards, "t") == 0
    publish_sharded(rows(spark, 0), shards, "t", fmt=fmt)
    assert read().count() == 0 and verify_published(spark, shards, "t", schema, fmt).rows == 0


def test_a_failing_shard_leaves_all_as_they_were(spark, tmp_path):
    shards = apart(tmp_path)
    publish_sharded(rows(spark, 100), shards, "t")
    files = sorted(tmp_path.glob("s*/t/**/*.parquet"))
    for mode in ("overwrite", "append"):
        with pytest.raises(Py4JJavaError):
            publish_sharded(rows(spark, 999), dead(tmp_path, shards), "t", mode=mode)
    assert ids(read_sharded(spark, shards, "t")) == list(range(100))
    assert sorted(tmp_path.glob("s*/t/**/*.parquet")) == files


def test_two_writers_cannot_publish_the_same_version(spark, tmp_path, monkeypatch):
    from shardsync.sinks import publish

    shards = apart(tmp_path)
    publish_sharded(rows(spark, 5), shards, "t")
    stale = read_log(spark, shards[0].location("t"))
    publish_sharded(rows(spark, 6), shards, "t")
    real, calls = publish.read_log, []

    def late(spark, base):
        calls.append(base)
        return stale if len(calls) == 1 else real(spark, base)

    monkeypatch.setattr(publish, "read_log", late)
    with pytest.raises(CommitConflict):
        publish_sharded(rows(spark, 7), shards, "t")


def test_what_cannot_be_published(spark, tmp_path):
    shards = apart(tmp_path)
    write_sharded(rows(spark, 5), shards, "t")
    with pytest.raises(ValueError, match="not published"):
        publish_sharded(rows(spark, 5), shards, "t", mode="append")
    publish_sharded(rows(spark, 4), shards, "t")
    assert read_sharded(spark, shards, "t").count() == 4
    for bad in (dict(mode="ignore"), dict(shards=[ShardSpec(("jdbc:x://h/db",))])):
        with pytest.raises(ValueError):
            publish_sharded(rows(spark, 5), **{"shards": shards, "table": "t", **bad})
    with pytest.raises(ValueError, match="3 shards, 2 are listed"):
        read_sharded(spark, shards[:2], "t")
    with pytest.raises(ValueError, match="not published"):
        verify_published(spark, shards, "other", rows(spark).schema)


def test_digest_of_a_write_is_that_of_what_is_read(spark, tmp_path):
    for fmt in ("parquet", "lines"):
        for shards in (file_cluster(str(tmp_path / fmt), 3), apart(tmp_path / f"{fmt}-apart")):
            df = rows(spark).withColumn("a", F.when(F.col("id") % 3 > 0, F.array_repeat("name", 2)))
            df = df.withColumn("b", F.when(F.col("id") % 2 > 0, F.array().cast("array<int>")))
            df = df.withColumn("c", F.when(F.col("id") % 5 > 0, F.lit("NULL"))).withColumn("d", F.col("id") / 7)
            digest = WriteDigest(3)
            write_sharded(df, shards, "t", fmt=fmt, digest=digest)
            back = read_sharded(spark, shards, "t", schema=df.schema, fmt=fmt, shard_column="_shard")
            assert content_digest(back, 3, "_shard", fmt) == digest.value
    with pytest.raises(ValueError):
        WriteDigest(2).value


def test_digest_tells_what_changed(spark):
    df = rows(spark).withColumn("_shard", F.col("segment_id") % 3)
    whole = content_digest(df, 3)
    assert content_digest(df.orderBy(F.desc("id")).repartition(7), 3) == whole
    assert whole.differs(content_digest(df.where("id <> 5"), 3)) == [2]
    assert whole.differs(content_digest(df.withColumn("name", F.when(F.col("id") != 4, F.col("name"))), 3)) == [1]
    moved = df.withColumn("_shard", F.when(F.col("id") == 0, 1).otherwise(F.col("_shard")))
    assert whole.differs(content_digest(moved, 3)) == [0, 1]
    # two rows in place of two others whose hashes cancel out alike
    a, b = Digest(2, (5, 0, 0), ((2, 0),)), Digest(2, (9, 0, 0), ((2, 0),))
    assert a.differs(b) == [0] and Digest.from_json(a.to_json()) == a


@pytest.mark.parametrize("publish", [False, True])
def test_sync_proves_what_it_wrote(spark, tmp_path, monkeypatch, publish):
    shards = apart(tmp_path)
    options = dict(keys=["id"], n_segments=6, verify=True, publish=publish)
    df = rows(spark).drop("segment_id")
    assert ids(sync_table(df, shards, "t", **options)) == list(range(300))
    from shardsync.sinks import publish as publishing
    from shardsync.sinks import sync

    module = publishing if publish else sync

    def lossy(found, *args):
        return content_digest(found.where("id <> 17"), *args)

    monkeypatch.setattr(module, "content_digest", lossy)
    with pytest.raises(ContentMismatch, match="rows written"):
        sync_table(df, shards, "t", **options)
    with pytest.raises(ValueError):
        sync_table(df, shards, "t", keys=["id"], n_segments=6, verify=True, mode="append")


def test_a_removed_file_is_found_out(spark, tmp_path):
    shards = apart(tmp_path)
    publish_sharded(rows(spark), shards, "t")
    lost = next(p for p in (tmp_path / "s1").glob("t/version=*/*.parquet"))
    n = spark.read.parquet(str(lost)).count()
    shutil.move(lost, tmp_path / "lost")
    with pytest.raises(ContentMismatch, match="shard 1") as told:
        verify_published(spark, shards, "t", rows(spark).schema)
    assert n and "shard 0" not in str(told.value) and "shard 2" not in str(told.value)


def stream(spark, source, target, checkpoint, **options):
    made = spark.readStream.schema(rows(spark).schema).option("maxFilesPerTrigger", 1).parquet(str(source))
    query = write_stream_sharded(made, target, "t", str(checkpoint), name="a", **options)
    query.awaitTermination()


@pytest.mark.parametrize("place", ["apart", "root"])
def test_readers_see_committed_batches_only(spark, tmp_path, place):
    source, shards = tmp_path / "in", apart(tmp_path)
    rows(spark).repartition(2).write.parquet(str(source))
    target, options = (shards, {}) if place == "apart" else (str(tmp_path / "root"), {"n_shards": 3})
    stream(spark, source, target, tmp_path / "c", **options)
    log = stream_commits(spark, target, "t").collect()
    assert Counter((r.generation, r.batch, r.attempt) for r in log) == {(0, 0, 0): 1, (0, 1, 0): 1}
    base = tmp_path / "s0" / "t" if place == "apart" else tmp_path / "root" / "t"
    # a batch that is half replaced: files of a further attempt without an entry
    part = base / "stream=a" / "batch=1"
    shutil.copytree(part / "try=0.0", part / "try=0.1")
    shutil.copytree(part / "try=0.0", base / "stream=a" / "batch=7" / "try=0.0")
    assert ids(read_stream_sink(spark, target, "t")) == list(range(300))
    if place == "apart":
        assert ids(read_sharded(spark, shards, "t")) == list(range(300))
        with pytest.raises(StreamingQueryException):
            stream(spark, source, dead(tmp_path, shards), tmp_path / "d")
        assert ids(read_stream_sink(spark, target, "t")) == list(range(300))


def test_a_batch_that_runs_again_takes_the_place_of_the_first(spark, tmp_path):
    source, shards = tmp_path / "in", apart(tmp_path)
    rows(spark).repartition(2).write.parquet(str(source))
    stream(spark, source, shards, tmp_path / "c")
    for name in ("1", ".1.crc"):  # the query died before it noted its last batch
        (tmp_path / "c" / "commits" / name).unlink()
    stream(spark, source, shards, tmp_path / "c")
    assert [(r.batch, r.attempt) for r in stream_commits(spark, shards, "t").orderBy("batch").collect()] == [(0, 0), (1, 1)]
    assert ids(read_stream_sink(spark, shards, "t")) == list(range(300))
    assert remove_replaced(spark, shards, "t") == 1
    assert ids(read_stream_sink(spark, shards, "t")) == list(range(300))


def test_runs_under_one_name(spark, tmp_path):
    source, shards = tmp_path / "in", apart(tmp_path)
    rows(spark).repartition(2).write.parquet(str(source))
    for run in ("c", "d", "e"):
        stream(spark, source, shards, tmp_path / run)
        assert ids(read_stream_sink(spark, shards, "t")) == list(range(300))
    # the run before the last is kept for its readers, the one before that isn't
    tries = {p.name for p in Path(tmp_path).glob("s0/t/stream=a/batch=*/try=*")}
    assert tries == {"try=1.0", "try=2.0"}
    rows(spark, 10, 300).write.mode("append").parquet(str(source))
    with pytest.raises(StreamingQueryException, match="started anew"):
        stream(spark, source, shards, tmp_path / "c")
    stream(spark, source, shards, tmp_path / "e")
    assert ids(read_stream_sink(spark, shards, "t")) == list(range(310))
    with pytest.raises(ValueError, match="written by a stream"):
        publish_sharded(rows(spark), shards, "t")
    with pytest.raises(ValueError, match="no commit log"):
        read_stream_sink(spark, shards, "other")
