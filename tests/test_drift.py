"""Types of shards that drifted apart, and replicas that answer."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shardsync import (
    NoCommonType,
    NoReplica,
    ShardSpec,
    choose_replicas,
    common_schema,
    common_type,
    file_cluster,
    publish_sharded,
    read_sharded,
)


def kind(text):
    return T.DataType.fromDDL(text)


@pytest.mark.parametrize(
    ("a", "b", "out"),
    [
        ("tinyint", "smallint", "smallint"),
        ("int", "bigint", "bigint"),
        ("int", "decimal(12,2)", "decimal(12,2)"),
        ("bigint", "decimal(12,2)", "decimal(21,2)"),
        ("decimal(12,2)", "decimal(10,5)", "decimal(15,5)"),
        ("smallint", "float", "float"),
        ("int", "float", "double"),
        ("int", "double", "double"),
        ("float", "double", "double"),
        ("date", "timestamp_ntz", "timestamp_ntz"),
        ("bigint", "string", "string"),
        ("boolean", "varchar(3)", "string"),
        ("decimal(38,2)", "string", "string"),
        ("array<int>", "array<bigint>", "array<bigint>"),
        ("binary", "binary", "binary"),
    ],
)
def test_least_common_types(a, b, out):
    assert common_type(kind(a), kind(b)).simpleString() == out
    assert common_type(kind(b), kind(a)).simpleString() == out


@pytest.mark.parametrize(
    ("a", "b"),
    [
        ("bigint", "double"), ("bigint", "float"), ("decimal(10,2)", "double"), ("decimal(38,2)", "decimal(38,10)"),
        ("boolean", "int"), ("binary", "string"), ("array<int>", "string"), ("array<bigint>", "array<double>"),
        ("date", "int"), ("timestamp", "timestamp_ntz"), ("map<int,int>", "string"),
    ],
)
def test_pairs_that_would_lose_digits(a, b):
    for x, y in ((a, b), (b, a)):
        with pytest.raises(NoCommonType):
            common_type(kind(x), kind(y))


def test_schema_errors_name_the_column_and_the_shard():
    with pytest.raises(NoCommonType, match="column v of shard 2"):
        common_schema([kind("v bigint"), kind("v int"), kind("v double")])
    with pytest.raises(ValueError, match="shard 1 differs .* in the columns w"):
        common_schema([kind("v bigint"), kind("v bigint, w int")])


VALUES = [("int", "7"), ("decimal(5,2)", "7.75"), ("bigint", "9007199254740993")]


@pytest.mark.parametrize("fmt", ["parquet", "orc"])
@pytest.mark.parametrize("place", ["apart", "root"])
def test_later_shards_keep_their_digits(spark, tmp_path, place, fmt):
    shards = file_cluster(str(tmp_path), 3) if place == "root" else [ShardSpec((str(tmp_path / f"s{i}"),)) for i in range(3)]
    for shard, (t, text) in zip(shards, VALUES, strict=True):
        df = spark.range(1).select(F.lit(text).cast(t).alias("v"), F.lit("x").alias("w"))
        df.write.format(fmt).save(shard.location("t"))
    back = read_sharded(spark, shards, "t", fmt=fmt, shard_column="at")
    assert back.schema["v"].dataType == T.DecimalType(21, 2)
    assert sorted((r["at"], str(r["v"])) for r in back.collect()) == [
        (0, "7.00"), (1, "7.75"), (2, "9007199254740993.00")
    ]
    assert read_sharded(spark, shards, "t", fmt=fmt).columns == ["v", "w"]


def test_declared_schemas_and_lossy_pairs(spark, tmp_path):
    shards = [ShardSpec((str(tmp_path / f"s{i}"),)) for i in range(2)]
    spark.range(2**53, 2**53 + 2).toDF("v").write.parquet(shards[0].location("t"))
    spark.range(1).select(F.lit(7.75).alias("v")).write.parquet(shards[1].location("t"))
    with pytest.raises(NoCommonType, match="column v of shard 1"):
        read_sharded(spark, shards, "t")
    found = read_sharded(spark, shards, "t", schema="v string").collect()
    assert sorted(r.v for r in found) == ["7.75", str(2**53), str(2**53 + 1)]


def write(spark, folder, n):
    spark.range(n).write.parquet(str(folder / "t"))


def test_the_first_replica_that_answers(spark, tmp_path):
    write(spark, tmp_path / "a1", 5)
    write(spark, tmp_path / "b0", 3)
    (tmp_path / "c0" / "t").mkdir(parents=True)
    write(spark, tmp_path / "c1", 2)
    shards = [ShardSpec((str(tmp_path / f"{s}0"), str(tmp_path / f"{s}1"))) for s in "abc"]
    df = read_sharded(spark, shards, "t", replica_column="replica")
    assert df.columns == ["id", "replica"]
    assert {r.replica: r["count"] for r in df.groupBy("replica").count().collect()} == {
        str(tmp_path / name): n for name, n in (("a1", 5), ("b0", 3), ("c1", 2))
    }
    both = read_sharded(spark, shards, "t", columns=["id"], replica_column="r", shard_column="s")
    assert both.columns == ["id", "s", "r"]
    with pytest.raises(NoReplica, match="shard 0 .*doesn't exist.*x1.*doesn't exist"):
        read_sharded(spark, [ShardSpec((str(tmp_path / "x0"), str(tmp_path / "x1")))], "t")


def test_choices_are_recorded():
    shards = [ShardSpec(("a", "b", "c")), ShardSpec(("d",))]
    asked = []

    def probe(replica):
        asked.append(replica)
        return "down" if replica in "ab" else None

    one, two = choose_replicas(shards, probe)
    assert (one.replica, one.passed) == ("c", (("a", "down"), ("b", "down")))
    assert (two.replica, two.passed) == ("d", ())
    assert asked == ["a", "b", "c", "d"]


def test_jdbc_replicas_are_asked_by_a_probe(spark, monkeypatch):
    from pyspark.sql import DataFrameReader

    urls = []

    def jdbc(self, url, table, predicates=None, properties=None):
        urls.append(url)
        return spark.range(1)

    monkeypatch.setattr(DataFrameReader, "jdbc", jdbc)
    shards = [ShardSpec(("jdbc:x://a/db", "jdbc:x://b/db"))]
    read_sharded(spark, shards, "t")
    read_sharded(spark, shards, "t", probe=lambda url: "refused" if "//a" in url else None)
    assert urls == ["jdbc:x://a/db", "jdbc:x://b/db"]


def test_a_published_table_is_read_from_the_second_replica(spark, tmp_path):
    shards = [ShardSpec((str(tmp_path / f"s{i}"),)) for i in range(2)]
    df = spark.range(10).withColumn("segment_id", F.col("id"))
    publish_sharded(df, shards, "t")
    publish_sharded(df.where("id < 4"), shards, "t")
    with_dead = [ShardSpec((str(tmp_path / f"gone{i}"), str(tmp_path / f"s{i}"))) for i in range(2)]
    assert read_sharded(spark, with_dead, "t").count() == 4
