from collections import Counter
from pathlib import Path

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import DataFrameReader, DataFrameWriter
from pyspark.sql import functions as F

from shardsync.sinks.shards import _laid_out
from shardsync import (
    ShardSpec,
    align_schema,
    common_root,
    file_cluster,
    jdbc_options,
    jdbc_predicates,
    jdbc_write_options,
    parse_fragment_spec,
    parse_shards,
    query_text,
    read_named_query,
    read_sharded,
    read_stream_sink,
    route,
    sync_table,
    write_sharded,
    write_stream_sharded,
)


def bag(df):
    return Counter(
        tuple(tuple(v) if isinstance(v, list) else v for v in row) for row in df.collect()
    )


def rows(spark, n=1000):
    return spark.range(n).select(
        (F.col("id") % 8).cast("int").alias("segment_id"),
        "id",
        F.concat(F.lit("n\t"), "id").alias("name"),
        F.array("id", F.lit(None)).alias("a"),
    )


def test_shard_lists():
    text = "jdbc:x://h1:1,h2:2/db?u=1&p=2;/data/a, /data/b;s3://bucket/c"
    one, two, three = parse_shards(text)
    assert one.replicas == ("jdbc:x://h1:1/db?u=1&p=2", "jdbc:x://h2:2/db?u=1&p=2")
    assert one.is_jdbc and one.primary == "jdbc:x://h1:1/db?u=1&p=2"
    assert two.replicas == ("/data/a", "/data/b") and two.location("t") == "/data/a/t"
    assert three.location("t") == "s3://bucket/c/t" and not three.is_jdbc
    for bad in ("", " ", "a;;b"):
        with pytest.raises(ValueError):
            parse_shards(bad)


def test_common_root():
    shards = file_cluster("/x", 3)
    assert common_root(shards, "t") == "/x/t"
    assert common_root(shards[1:], "t") is None
    assert common_root([ShardSpec(("/a",)), ShardSpec(("/b",))], "t") is None


@pytest.mark.parametrize("layout", ["direct", "rebalance"])
@pytest.mark.parametrize("fmt", ["parquet", "orc", "lines"])
def test_one_pass_write_and_read(spark, tmp_path, layout, fmt):
    df, shards = rows(spark), file_cluster(str(tmp_path), 3)
    write_sharded(df, shards, "t", layout=layout, fmt=fmt)
    back = read_sharded(spark, shards, "t", schema=df.schema, fmt=fmt, shard_column="at")
    assert bag(back.drop("at")) == bag(df)
    assert back.where("at <> segment_id % 3").isEmpty()
    write_sharded(df, shards, "t", layout=layout, fmt=fmt)
    assert read_sharded(spark, shards, "t", schema=df.schema, fmt=fmt).count() == 2000
    write_sharded(df, shards, "t", layout=layout, fmt=fmt, mode="overwrite")
    assert read_sharded(spark, shards, "t", schema=df.schema, fmt=fmt).count() == 1000


def test_shards_in_separate_places(spark, tmp_path):
    df = rows(spark)
    shards = [ShardSpec((str(tmp_path / place),)) for place in ("a", "b", "c", "d")]
    write_sharded(df, shards, "t", columns=["id", "segment_id"])
    for i, shard in enumerate(shards):
        own = spark.read.parquet(shard.location("t"))
        assert own.columns == ["id", "segment_id"]
        assert own.where(f"segment_id % 4 <> {i}").isEmpty() and own.count() == 250
    back = read_sharded(spark, shards, "t", shard_column="at", columns=["id"])
    assert back.columns == ["id", "at"] and back.count() == 1000


def test_hot_shard_is_split_over_tasks(spark, tmp_path):
    df = spark.range(200_000, numPartitions=8).select(
        F.when(F.col("id") % 3 < 2, 1).otherwise((F.col("id") % 20).cast("int")).alias("segment_id"),
        F.sha2(F.col("id").cast("string"), 256).alias("payload"),
    )
    shards = file_cluster(str(tmp_path), 20)
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(key, "1m")
    try:
        write_sharded(df, shards, "t")
    finally:
        spark.conf.unset(key)
    hot = len(list(Path(shards[1].location("t")).glob("*.parquet")))
    cold = len(list(Path(shards[2].location("t")).glob("*.parquet")))
    assert hot > 3 and cold <= 2
    assert read_sharded(spark, shards, "t").count() == 200_000


def test_rows_per_file(spark, tmp_path):
    shards = file_cluster(str(tmp_path), 1)
    write_sharded(rows(spark).coalesce(1), shards, "t", batch_size=300)
    assert len(list(Path(shards[0].location("t")).glob("*.parquet"))) == 4


@pytest.mark.parametrize("cap", [1, 2, 0])
def test_writers_of_a_shard_are_capped(spark, tmp_path, cap):
    shards = file_cluster(str(tmp_path), 3)
    write_sharded(rows(spark).repartition(64), shards, "t", max_writers=cap)
    most = cap or spark.sparkContext.defaultParallelism
    found = [len(list(Path(s.location("t")).glob("*.parquet"))) for s in shards]
    assert all(0 < n <= most for n in found)
    assert read_sharded(spark, shards, "t").count() == 1000


def test_a_cap_leaves_the_input_parallel(spark):
    routed = route(spark.range(1000, numPartitions=64).withColumnRenamed("id", "segment_id"), 3)
    capped = _laid_out(routed, "rebalance", True, 2, 3)
    assert capped.rdd.getNumPartitions() == 6
    assert "Range (0, 1000, step=1, splits=64)" in capped._jdf.queryExecution().toString()


def test_gathering_needs_adaptive_execution(spark, tmp_path):
    shards = file_cluster(str(tmp_path), 3)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        with pytest.raises(ValueError):
            write_sharded(rows(spark), shards, "t")
        write_sharded(rows(spark).repartition(6), shards, "t", layout="direct")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(list(Path(shards[0].location("t")).glob("*.parquet"))) == 6


def test_no_shard_starts_after_the_first_error(spark, monkeypatch):
    started = []

    def jdbc(self, url, table, mode=None, properties=None):
        started.append(url)
        raise RuntimeError("shard down")

    monkeypatch.setattr(DataFrameWriter, "jdbc", jdbc)
    shards = parse_shards(";".join(f"jdbc:x://h{i}/db" for i in range(6)))
    before = set(Path(spark.conf.get("spark.checkpoint.dir")).glob("routed-*"))
    with pytest.raises(RuntimeError, match="shard down"):
        write_sharded(rows(spark, 60), shards, "t", shards_at_once=1)
    assert started == ["jdbc:x://h0/db"]
    assert set(Path(spark.conf.get("spark.checkpoint.dir")).glob("routed-*")) == before


def test_columns_of_later_shards_do_not_vanish(spark, tmp_path):
    for i in range(2):
        frame = spark.range(3).withColumn(f"c{i}", F.lit(i))
        frame.write.parquet(str(tmp_path / f"s{i}" / "t"))
        frame.write.parquet(str(tmp_path / "root" / "t" / f"_shard={i}"))
    apart = [ShardSpec((str(tmp_path / f"s{i}"),)) for i in range(2)]
    with pytest.raises(ValueError, match="declare a schema"):
        read_sharded(spark, apart, "t")
    together = read_sharded(spark, file_cluster(str(tmp_path / "root"), 2), "t")
    assert sorted(together.columns) == ["c0", "c1", "id"]


def test_a_shorter_shard_list_is_an_error(spark, tmp_path):
    write_sharded(rows(spark), file_cluster(str(tmp_path), 5), "t")
    with pytest.raises(ValueError, match="not listed"):
        read_sharded(spark, file_cluster(str(tmp_path), 3), "t")


def test_staged_copies_are_removed(spark, tmp_path):
    shared = Path(spark.conf.get("spark.checkpoint.dir"))
    before = set(shared.glob("routed-*"))
    shards = [ShardSpec((str(tmp_path / place),)) for place in ("a", "b")]
    write_sharded(rows(spark), shards, "t")
    assert set(shared.glob("routed-*")) == before


def test_shards_are_matched_by_name_and_cast(spark, tmp_path):
    a, b = ShardSpec((str(tmp_path / "a"),)), ShardSpec((str(tmp_path / "b"),))
    spark.sql("SELECT 1 AS id, 'x' AS name").write.parquet(a.location("t"))
    spark.sql("SELECT 'y' AS name, 2L AS id, 0 AS extra").write.parquet(b.location("t"))
    df = read_sharded(spark, [a, b], "t", schema="id bigint, name string")
    assert df.dtypes == [("id", "bigint"), ("name", "string")]
    assert bag(df) == Counter([(1, "x"), (2, "y")])
    with pytest.raises(ValueError):
        read_sharded(spark, [a, b], "t", schema="id bigint, absent string")


def test_unread_columns_are_null_and_not_scanned(spark, tmp_path):
    path = str(tmp_path / "t")
    rows(spark).write.parquet(path)
    df = align_schema(spark.read.parquet(path), rows(spark).schema, projected=["id"])
    assert df.columns == ["segment_id", "id", "name", "a"]
    assert df.where("name IS NOT NULL OR segment_id IS NOT NULL OR id IS NULL").isEmpty()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<id:bigint>" in plan
    with pytest.raises(ValueError):
        align_schema(df, "id bigint", projected=["nope"])


def test_strict_and_lenient_casts(spark):
    df = spark.createDataFrame([("1", "x")], "a string, b string")
    assert tuple(align_schema(df, "a int, b int", lenient=True).first()) == (1, None)
    with pytest.raises(PySparkException):
        align_schema(df, "a int, b int").collect()


def test_empty_tables(spark, tmp_path):
    df = rows(spark).where("id < 0")
    for fmt in ("parquet", "lines"):
        back = sync_table(
            df,
            file_cluster(str(tmp_path / fmt), 3),
            "t",
            keys=["id"],
            n_segments=8,
            fmt=fmt,
        )
        assert back.count() == 0 and back.columns == df.columns


@pytest.mark.parametrize("fmt", ["parquet", "lines"])
def test_sync(spark, tmp_path, fmt):
    df = rows(spark).drop("segment_id")
    back = sync_table(
        df,
        file_cluster(str(tmp_path), 3),
        "t",
        keys=["id"],
        n_segments=8,
        where=F.size("a") > 0,
        fmt=fmt,
        shard_column="at",
    )
    assert bag(back.select(*df.columns)) == bag(df)
    assert back.where("at <> segment_id % 3").isEmpty()


def test_rows_with_items_reach_their_shards_as_lines(spark, tmp_path):
    kept = [(f"port{k}", [None if j == 1 else f"crane,{k}'{j}" for j in range(1 + k % 3)]) for k in range(9)]
    source = spark.createDataFrame([*kept, ("idle", []), ("gone", None)], "port string, cranes array<string>")
    shards = file_cluster(str(tmp_path), 3)
    back = sync_table(
        source, shards, "yards", keys=["port"], n_segments=6, where=F.size("cranes") > 0, fmt="lines"
    )
    assert bag(back.drop("segment_id")) == Counter((p, tuple(c)) for p, c in kept)
    lines = spark.read.text(f"{tmp_path}/yards").select(F.split("value", "\t")[2]).collect()
    assert "['crane,2\\'0',NULL,'crane,2\\'2']" in {r[0] for r in lines}


@pytest.mark.parametrize(
    "bad",
    [
        dict(table="query:x"),
        dict(fmt="csv"),
        dict(layout="odd"),
        dict(batch_size=-1),
        dict(segment_column="absent"),
        dict(columns=["id", "_shard"]),
        dict(shards=[]),
    ],
)
def test_bad_write_arguments(spark, tmp_path, bad):
    args = {"shards": file_cluster(str(tmp_path), 3), "table": "t", **bad}
    with pytest.raises(ValueError):
        write_sharded(rows(spark), **args)


def test_bad_read_arguments(spark, tmp_path):
    shards = file_cluster(str(tmp_path), 3)
    for bad in (dict(fmt="csv"), dict(fragments=[1]), dict(fragment_column="f")):
        with pytest.raises(ValueError):
            read_sharded(spark, shards, "t", **bad)
    with pytest.raises(ValueError):
        read_sharded(spark, [], "t")


def test_a_failing_row_fails_the_write_and_commits_nothing(spark, tmp_path):
    shards = file_cluster(str(tmp_path), 3)
    df = rows(spark).withColumn("segment_id", F.when(F.col("id") != 999, F.col("segment_id")))
    with pytest.raises(PySparkException):
        write_sharded(df, shards, "t")
    assert not list(tmp_path.glob("t/_shard=*/*.parquet"))


# The JDBC path is tested up to the Spark call: no database is started here.


def test_jdbc_read_is_one_task_per_fragment(spark, monkeypatch):
    calls = []

    def jdbc(self, url, table, predicates=None, properties=None):
        calls.append((url, table, predicates, properties))
        return spark.createDataFrame([(len(calls), 5)], "k int, v int")

    monkeypatch.setattr(DataFrameReader, "jdbc", jdbc)
    spec = parse_fragment_spec("k:int", "0:10", "5")
    shards = parse_shards("jdbc:x://a/db;jdbc:x://b,c/db")
    df = read_sharded(
        spark,
        shards,
        "t",
        plan=spec,
        fragment_column="f",
        shard_column="s",
        options={"fetchsize": 10, "queryTimeout": 30},
    )
    assert bag(df) == Counter([(1, 5, 0, 2), (2, 5, 1, 2)])
    assert [c[0] for c in calls] == ["jdbc:x://a/db", "jdbc:x://b/db"]
    assert calls[0][2] == [f.to_predicate() for f in spec.fragments()]
    assert calls[0][3]["fetchsize"] == "10" and calls[0][3]["queryTimeout"] == "30"
    read_sharded(spark, shards, "t", plan=spec, fragments=[0, 4], quote=False)
    assert calls[-1][2] == ["k < 0", "k IS NULL"]
    read_sharded(spark, shards, "t")
    assert calls[-1][2] is None
    read_sharded(spark, parse_shards("jdbc:mysql://a/db"), "t", plan=spec, fragments=[4])
    assert calls[-1][2] == ["`k` IS NULL"]
    read_sharded(spark, parse_shards("jdbc:x://mysql-host/db"), "t", plan=spec, fragments=[4])
    assert calls[-1][2] == ['"k" IS NULL']
    for mixed in (read_sharded, lambda s, *a: write_sharded(rows(s), *a)):
        with pytest.raises(ValueError):
            mixed(spark, [*shards, ShardSpec(("/x",))], "t")


def test_jdbc_write_sends_each_shard_its_rows_as_literals(spark, monkeypatch):
    got = {}

    def jdbc(self, url, table, mode=None, properties=None):
        got[url] = (self._df.collect(), self._df.dtypes, table, mode, properties)

    monkeypatch.setattr(DataFrameWriter, "jdbc", jdbc)
    shards = parse_shards("jdbc:x://a/db;jdbc:x://b/db;jdbc:x://c/db")
    write_sharded(rows(spark, 60), shards, "t", batch_size=0, max_writers=4)
    assert sum(len(v[0]) for v in got.values()) == 60
    for i, shard in enumerate(shards):
        sent, dtypes, table, mode, properties = got[shard.primary]
        assert all(r.segment_id % 3 == i and r.a == f"[{r.id},NULL]" for r in sent)
        assert dict(dtypes)["a"] == "string" and "_shard" not in dict(dtypes)
        assert (table, mode) == ("t", "append")
        assert properties == {"batchsize": "1", "numPartitions": "4"}


def test_jdbc_write_error_is_raised(spark, monkeypatch):
    def jdbc(self, url, table, mode=None, properties=None):
        if "b/db" in url:
            raise RuntimeError("shard down")

    monkeypatch.setattr(DataFrameWriter, "jdbc", jdbc)
    with pytest.raises(RuntimeError, match="shard down"):
        write_sharded(rows(spark, 60), parse_shards("jdbc:x://a/db;jdbc:x://b/db"), "t")


def test_jdbc_options():
    assert jdbc_options()["fetchsize"] == "100000"
    assert jdbc_options()["preferTimestampNTZ"] == "true"
    assert jdbc_write_options(None, None, None) == {"batchsize": "100000"}
    for bad in ({"fetchsize": -1}, {"queryTimeout": "-5"}, {"queryTimeout": "x"}):
        with pytest.raises(ValueError):
            jdbc_options(bad)
    assert jdbc_predicates(None) is None


def test_named_query(spark, tmp_path, monkeypatch):
    (tmp_path / "q.sql").write_text("SELECT id AS k FROM numbers ;\n ; \n")
    (tmp_path / "blank.sql").write_text(" \n")
    assert query_text(spark, str(tmp_path), "query:q") == "SELECT id AS k FROM numbers"
    assert query_text(spark, f"file://{tmp_path}", "q") == "SELECT id AS k FROM numbers"
    df = read_named_query(
        spark,
        str(tmp_path),
        "query:q",
        views={"numbers": spark.range(10)},
        spec=parse_fragment_spec("k:int", "0:10", "5"),
        fragment_column="f",
    )
    assert bag(df.groupBy("f").count()) == Counter([(2, 5), (3, 5)])
    for bad in ("query:", "query: ", "query:../q", "query:blank"):
        with pytest.raises(ValueError):
            query_text(spark, str(tmp_path), bad)
    with pytest.raises(FileNotFoundError):
        query_text(spark, str(tmp_path), "absent")

    calls = []

    def jdbc(self, url, table, predicates=None, properties=None):
        calls.append((table, predicates))
        return spark.range(1).withColumnRenamed("id", "k")

    monkeypatch.setattr(DataFrameReader, "jdbc", jdbc)
    spec = parse_fragment_spec("k:enum", "a")
    read_named_query(spark, str(tmp_path), "q", jdbc=parse_shards("jdbc:x://a/d"), spec=spec)
    assert calls == [
        ("(SELECT id AS k FROM numbers) named_query", [f.to_predicate() for f in spec.fragments()])
    ]


def stream_of(spark, path):
    return spark.readStream.schema(rows(spark).schema).option("maxFilesPerTrigger", 1).parquet(path)


def test_stream_arrives_once_even_when_replayed(spark, tmp_path):
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    rows(spark).repartition(3).write.parquet(source)
    for checkpoint in ("c1", "c1", "c2"):
        query = write_stream_sharded(
            stream_of(spark, source), target, "t", str(tmp_path / checkpoint), name="a", n_shards=3
        )
        query.awaitTermination()
        back = read_stream_sink(spark, target, "t")
        assert back.select("batch").distinct().count() == 3
        assert bag(back.drop("stream", "batch", "_shard")) == bag(rows(spark))
        assert back.where("_shard <> segment_id % 3").isEmpty()


def test_stream_of_lines(spark, tmp_path):
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    rows(spark).write.parquet(source)
    write_stream_sharded(
        stream_of(spark, source), target, "t", str(tmp_path / "c"), name="a", n_shards=3, fmt="lines"
    ).awaitTermination()
    back = read_stream_sink(spark, target, "t", "lines", rows(spark).schema)
    assert bag(back.drop("stream", "batch", "_shard")) == bag(rows(spark))
    assert back.where("_shard <> segment_id % 3").isEmpty()
    with pytest.raises(ValueError):
        read_stream_sink(spark, target, "t", "lines")


def test_stream_to_separate_shards(spark, tmp_path):
    source = str(tmp_path / "in")
    rows(spark).write.parquet(source)
    shards = [ShardSpec((str(tmp_path / place),)) for place in ("a", "b")]
    for checkpoint in ("c", "d"):  # the second one starts the same stream anew
        write_stream_sharded(
            stream_of(spark, source), shards, "t", str(tmp_path / checkpoint), name="a"
        ).awaitTermination()
        assert bag(read_sharded(spark, shards, "t", schema=rows(spark).schema)) == bag(rows(spark))
    with pytest.raises(ValueError):
        write_stream_sharded(stream_of(spark, source), str(tmp_path), "t", "c", name="a")
    with pytest.raises(ValueError):
        write_stream_sharded(stream_of(spark, source), shards, "t", "c", name="a/b")


def test_two_streams_share_a_target(spark, tmp_path):
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    rows(spark, 50).write.parquet(source)
    for name in ("a", "b"):
        write_stream_sharded(
            stream_of(spark, source), target, "t", str(tmp_path / name), name=name, n_shards=2
        ).awaitTermination()
    assert read_stream_sink(spark, target, "t").count() == 100
