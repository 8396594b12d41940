
import pytest
from pyspark.sql import functions as F

from shardsync import assign_segment, route


def segments(spark, values, kind="int"):
    return spark.createDataFrame([(v,) for v in values], f"segment_id {kind}")


def test_shard_is_segment_modulo_shards(spark):
    rows = route(segments(spark, [*range(8), -1, -3, -4]), 3).collect()
    assert all(r._shard == r.segment_id % 3 for r in rows)


def test_null_segment_fails_the_job(spark):
    with pytest.raises(Exception, match="NULL in segment column"):
        route(segments(spark, [1, None]), 3).collect()


def test_segment_column_is_checked(spark):
    df = segments(spark, [5])
    with pytest.raises(ValueError):
        route(df, 3, "other")
    with pytest.raises(ValueError):
        route(segments(spark, ["5"], "string"), 3)
    with pytest.raises(ValueError):
        route(df, 0)
    assert route(df, 1, "other").first()._shard == 0
    assert route(df.withColumnRenamed("segment_id", "s"), 3, "s").first()._shard == 2


def test_unkeyed_task_has_one_shard(spark):
    df = route(spark.range(1000, numPartitions=5), 3, keyed=False)
    rows = df.groupBy(F.spark_partition_id().alias("p")).agg(
        F.count_distinct("_shard").alias("n"), F.first("_shard").alias("s")
    )
    assert all(r.n == 1 and r.s == r.p % 3 for r in rows.collect())


def test_segments_cover_the_range_and_depend_on_the_key_only(spark):
    df = spark.range(5000).select(F.col("id") % 1000, F.col("id").alias("i")).toDF("k", "i")
    for method in ("xxhash64", "md5"):
        out = assign_segment(df, ["k"], 8, method=method)
        per_key = out.groupBy("k").agg(F.count_distinct("segment_id").alias("n"))
        assert per_key.where("n <> 1").isEmpty()
        assert sorted(r[0] for r in out.select("segment_id").distinct().collect()) == [*range(8)]
    assert assign_segment(df, ["k", "i"], 4).where("segment_id is null").isEmpty()
    for bad in (dict(n_segments=0), dict(n_segments=2, method="crc")):
        with pytest.raises(ValueError):
            assign_segment(df, ["k"], **bad)
    with pytest.raises(ValueError):
        assign_segment(df, ["k", "i"], 2, method="md5")


def test_null_keys_have_a_segment(spark):
    df = spark.createDataFrame([(None,)], "k string")
    for method in ("xxhash64", "md5"):
        assert assign_segment(df, ["k"], 8, method=method).first().segment_id is not None
