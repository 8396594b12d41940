"""Committed views, all-or-nothing writes, proofs of content, drifted and dead shards."""

from contextlib import suppress

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException, StreamingQueryException
from pyspark.sql import functions as F

from checks.registry import check, fresh_dir, table
from shardsync import (
    ShardSpec,
    file_cluster,
    publish_sharded,
    read_sharded,
    read_stream_sink,
    sync_table,
    verify_published,
    write_stream_sharded,
)


def apart(base, n=3):
    return [ShardSpec((f"{base}/shard{i}",)) for i in range(n)]


def with_dead_shard(spark, base, shards):
    """The same shards, but the second one can't be written: its folder lies below a file."""
    path = f"{base}/a-file"
    spark.range(1).coalesce(1).write.parquet(path)
    file = spark.read.parquet(path).inputFiles()[0]
    return [shards[0], ShardSpec((f"{file}/shard1",)), *shards[2:]]


@check("SELECT event_id, user_id, event_type, CAST((user_id % 8) % 3 AS INTEGER) AS _shard FROM events")
def stream_snapshot(spark, sf_dir):
    """A stream is started anew and dies after it has written some of its shards: readers
    see what was committed before."""
    base = fresh_dir(spark, "snapshot")
    events = table(spark, sf_dir, "events", columns=["event_id", "user_id", "event_type"])
    events = events.withColumn("segment_id", F.col("user_id") % 8)
    events.repartition(3).write.parquet(f"{base}/in")
    shards = apart(base)
    places = {"first": shards, "second": with_dead_shard(spark, base, shards)}
    for checkpoint, target in places.items():
        stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1)
        with suppress(StreamingQueryException):
            write_stream_sharded(
                stream.parquet(f"{base}/in"), target, "events", f"{base}/{checkpoint}", name="a"
            ).awaitTermination()
    return read_stream_sink(spark, shards, "events").select("event_id", "user_id", "event_type", "_shard")


@check(
    """
    SELECT o_orderkey, o_totalprice, CAST(o_custkey % 8 AS BIGINT) AS segment_id,
           CAST((o_custkey % 8) % 3 AS INTEGER) AS shard_no
    FROM orders
    """
)
def publish_all_shards(spark, sf_dir):
    """Published, published in vain over a dead shard, and appended to."""
    base = fresh_dir(spark, "publish")
    orders = table(spark, sf_dir, "orders", columns=["o_orderkey", "o_totalprice", "o_custkey"])
    orders = orders.withColumn("segment_id", F.col("o_custkey") % 8)
    names = ["o_orderkey", "o_totalprice", "segment_id"]
    shards = apart(base)
    publish_sharded(orders.where("o_orderkey % 2 = 0"), shards, "orders", columns=names)
    with suppress(PySparkException, Py4JJavaError):
        publish_sharded(orders, with_dead_shard(spark, base, shards), "orders", columns=names)
    publish_sharded(orders.where("o_orderkey % 2 = 1"), shards, "orders", columns=names, mode="append")
    return read_sharded(spark, shards, "orders", shard_column="shard_no")


@check(
    """
    SELECT place, count(*) AS n_rows, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total
    FROM orders, (VALUES ('root'), ('apart'), ('published')) p(place) GROUP BY place
    """
)
def sync_verify(spark, sf_dir):
    """Synced with proof: below one root, to separate shards as lines, and published."""
    base = fresh_dir(spark, "verify")
    orders = table(spark, sf_dir, "orders", columns=["o_orderkey", "o_totalprice", "o_orderpriority", "o_orderdate"])
    made = {
        "root": sync_table(orders, file_cluster(f"{base}/root", 3), "o", keys=["o_orderkey"], n_segments=8, verify=True),
        "apart": sync_table(
            orders, apart(f"{base}/apart"), "o", keys=["o_orderkey"], n_segments=8, fmt="lines", verify=True
        ),
        "published": sync_table(
            orders, apart(f"{base}/published"), "o", keys=["o_orderkey"], n_segments=8, publish=True, verify=True
        ),
    }
    verify_published(spark, apart(f"{base}/published"), "o", made["published"].schema)
    frames = [df.select(F.lit(place).alias("place"), "o_totalprice") for place, df in made.items()]
    both = frames[0].unionAll(frames[1]).unionAll(frames[2])
    total = F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("total")
    return both.groupBy("place").agg(F.count("*").alias("n_rows"), total)


@check(
    """
    SELECT o_orderkey, CAST(o_totalprice AS DECIMAL(18,2))::DOUBLE AS price, o_custkey::VARCHAR AS customer,
           'bigint decimal(18,4) string timestamp_ntz' AS kinds,
           CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day
    FROM orders
    """
)
def shard_union_widened(spark, sf_dir):
    """Three shards whose columns have drifted apart, read without a declared schema."""
    base = fresh_dir(spark, "drift")
    orders = table(spark, sf_dir, "orders")
    drifted = [
        ("int", "decimal(12,2)", "bigint", "date"),
        ("bigint", "decimal(16,4)", "string", "timestamp_ntz"),
        ("int", "decimal(16,2)", "int", "date"),
    ]
    for i, (key, price, customer, day) in enumerate(drifted):
        orders.where(F.col("o_orderkey") % 3 == i).select(
            F.col("o_orderkey").cast(key).alias("o_orderkey"),
            F.col("o_totalprice").cast("decimal(16,2)").cast(price).alias("price"),
            F.col("o_custkey").cast(customer).alias("customer"),
            F.to_date("o_orderdate").cast(day).alias("day"),
        ).write.parquet(f"{base}/t/_shard={i}")
    df = read_sharded(spark, file_cluster(base, 3), "t")
    return df.select(
        "o_orderkey", F.col("price").cast("double").alias("price"), "customer",
        F.lit(" ".join(t for _, t in df.dtypes)).alias("kinds"),
        F.to_date("day").cast("string").alias("day"),
    )


@check(
    """
    SELECT o_orderkey, CASE o_orderkey % 3 WHEN 2 THEN 'first' ELSE 'second' END AS replica,
           CAST(o_orderkey % 3 AS INTEGER) AS shard_no
    FROM orders
    """
)
def replica_scan(spark, sf_dir):
    """Of three shards, one's first replica is gone and another's is empty."""
    base = fresh_dir(spark, "replicas")
    orders = table(spark, sf_dir, "orders", columns=["o_orderkey"])
    shards = [ShardSpec((f"{base}/{i}/first", f"{base}/{i}/second")) for i in range(3)]
    for i, place in enumerate(("second", "second", "first")):
        orders.where(F.col("o_orderkey") % 3 == i).write.parquet(f"{base}/{i}/{place}/orders")
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{base}/1/first/orders")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(path)
    df = read_sharded(spark, shards, "orders", shard_column="shard_no", replica_column="replica")
    return df.withColumn("replica", F.substring_index("replica", "/", -1))
