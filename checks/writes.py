"""Segments, routing, batches, sinks, streams and the whole sync."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from checks.registry import check, fresh_dir, money, table
from checks.scans import cluster
from shardsync import (
    ShardSpec,
    assign_segment,
    read_sharded,
    read_stream_sink,
    route,
    sync_table,
    write_sharded,
    write_stream_sharded,
)


@check(
    """
    SELECT c_custkey, CAST(('0x' || substr(md5(c_name), 1, 8))::BIGINT % 8 AS INTEGER)
             AS segment_id
    FROM customer
    """
)
def segment_assign(spark, sf_dir):
    df = table(spark, sf_dir, "customer")
    return assign_segment(df, ["c_name"], 8, method="md5").select("c_custkey", "segment_id")


@check(
    """
    WITH o AS (SELECT *, (o_custkey % 8) - 2 AS segment_id FROM orders)
    SELECT segment_id, CAST(((segment_id % 3) + 3) % 3 AS INTEGER) AS shard_no,
           count(*) AS n_rows
    FROM o GROUP BY 1, 2
    """
)
def route_by_segment(spark, sf_dir):
    df = table(spark, sf_dir, "orders").withColumn("segment_id", F.col("o_custkey") % 8 - 2)
    return (
        route(df, 3, out="shard_no")
        .groupBy("segment_id", "shard_no")
        .agg(F.count("*").alias("n_rows"))
    )


ORDER_TOTALS = """
    SELECT count(*) AS n_rows,
           CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total
    FROM orders
"""


@check(ORDER_TOTALS)
def route_by_task(spark, sf_dir):
    # which shard a row gets depends on the layout, the union does not
    shards = cluster(spark, "by-task")
    write_sharded(table(spark, sf_dir, "orders"), shards, "orders", keyed=False)
    return read_sharded(spark, shards, "orders").agg(
        F.count("*").alias("n_rows"), money(F.col("o_totalprice")).alias("total")
    )


def batch_oracle(key: str) -> str:
    return f"""
    SELECT event_id, {key},
           CAST((row_number() OVER (PARTITION BY {key} ORDER BY event_id) - 1) // 50 AS BIGINT)
             AS batch_id
    FROM events
    """


def batches(events, key, size=50, block=1000):
    """Numbers of batches of ``size`` events of a key. Ranks are counted over blocks of
    ids first and within blocks then, so no task holds all rows of a key."""
    rows = events.withColumn("block", F.expr(f"event_id div {block}"))
    inside = Window.partitionBy(key, "block").orderBy("event_id")
    counted = rows.groupBy(key, "block").agg(F.count("*").alias("n"))
    ahead = Window.partitionBy(key).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    before = counted.select(key, "block", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("before"))
    ranked = rows.withColumn("place", F.row_number().over(inside) - 1).join(before, [key, "block"])
    return ranked.select("event_id", key, F.expr(f"(before + place) div {size}").alias("batch_id"))


@check(batch_oracle("user_id"))
def batch_plan(spark, sf_dir):
    return batches(table(spark, sf_dir, "events", columns=["event_id", "user_id"]), "user_id")


@check(batch_oracle("event_type"))
def batch_plan_hot_keys(spark, sf_dir):
    df = table(spark, sf_dir, "events", columns=["event_id", "event_type"])
    return batches(df, "event_type")


@check(
    """
    SELECT o_orderkey, CAST(o_orderkey % 8 AS BIGINT) AS segment_id,
           CAST((o_orderkey % 8) % 3 AS INTEGER) AS shard_no, o_totalprice, o_orderdate,
           o_orderpriority
    FROM orders
    """
)
def sink_roundtrip(spark, sf_dir):
    df = table(spark, sf_dir, "orders").withColumn("segment_id", F.col("o_orderkey") % 8)
    names = ["segment_id", "o_orderkey", "o_totalprice", "o_orderdate", "o_orderpriority"]
    shards = cluster(spark, "sink")
    write_sharded(df, shards, "orders", columns=names, layout="rebalance")
    return read_sharded(spark, shards, "orders", shard_column="shard_no")


@check(
    """
    SELECT event_id, ts, user_id, CAST((user_id % 8) % 3 AS INTEGER) AS _shard FROM events
    """
)
def stream_sink(spark, sf_dir):
    source = f"{sf_dir}/events.parquet"
    stream = (
        spark.readStream.schema(spark.read.parquet(source).schema)
        .parquet(f"{sf_dir}/event[s].parquet")  # a pattern: the table may be one file
        .withColumn("segment_id", F.col("user_id") % 8)
    )
    target = fresh_dir(spark, "stream")
    query = write_stream_sharded(
        stream, f"{target}/data", "events", f"{target}/checkpoint", name="events", n_shards=3
    )
    query.awaitTermination()
    df = read_stream_sink(spark, f"{target}/data", "events")
    return df.select("event_id", "ts", "user_id", "_shard")


@check(
    """
    WITH d AS (
      SELECT doc_id, lang, text, string_split(text, chr(10)) AS lines, n_chars,
             CAST(('0x' || substr(md5(doc_id::VARCHAR), 1, 8))::BIGINT % 8 AS INTEGER) AS segment_id
      FROM documents WHERE lang <> 'de')
    SELECT doc_id, segment_id, segment_id % 3 AS shard_no, lang, md5(text) AS text_md5,
           CAST(len(lines) AS INTEGER) AS n_lines, n_chars > 1000 AS is_long
    FROM d
    """
)
def sync_end_to_end(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(
        "doc_id",
        "lang",
        F.split("text", "\n").alias("lines"),
        F.array(F.col("n_chars") > 1000, F.lit(None)).alias("flags"),
    )
    synced = sync_table(
        docs,
        cluster(spark, "sync"),
        "documents",
        keys=["doc_id"],
        n_segments=8,
        where=(F.size("lines") > 0) & (F.col("lang") != "de"),
        method="md5",
        fmt="lines",
        shard_column="shard_no",
    )
    return synced.select(
        "doc_id",
        "segment_id",
        "shard_no",
        "lang",
        F.md5(F.array_join("lines", "\n")).alias("text_md5"),
        F.size("lines").alias("n_lines"),
        F.col("flags")[0].alias("is_long"),
    )


@check("SELECT count(*) AS n_rows, 0::BIGINT AS over FROM orders")
def batch_write(spark, sf_dir):
    """Batches are the files: no file holds more rows than a batch."""
    shards = cluster(spark, "batches")
    orders = table(spark, sf_dir, "orders").withColumn("segment_id", F.col("o_custkey") % 8)
    write_sharded(orders, shards, "orders", batch_size=500)
    back = spark.read.parquet(*(s.location("orders") for s in shards))
    files = back.groupBy(F.input_file_name().alias("file")).agg(F.count("*").alias("n"))
    over = F.count(F.when(F.col("n") > 500, 1)).alias("over")
    return files.agg(F.sum("n").alias("n_rows"), over)


@check(
    """
    SELECT event_id, user_id, place, stream
    FROM events, (VALUES ('root'), ('apart')) p(place), (VALUES ('a'), ('b')) s(stream)
    """
)
def stream_replay(spark, sf_dir):
    """Two streams in several micro-batches into one target, the first one replayed with
    its own checkpoint and started anew with another; below one root and in separate
    folders."""
    base = fresh_dir(spark, "replay")
    events = table(spark, sf_dir, "events", columns=["event_id", "user_id"])
    events = events.withColumn("segment_id", F.col("user_id") % 8)
    events.repartition(4).write.parquet(f"{base}/in")
    places = {"root": f"{base}/root", "apart": [ShardSpec((f"{base}/shard{i}",)) for i in range(3)]}
    for place, target in places.items():
        for name, checkpoint in (("a", "a1"), ("b", "b1"), ("a", "a1"), ("a", "a2")):
            stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1)
            write_stream_sharded(
                stream.parquet(f"{base}/in"), target, "events", f"{base}/{place}-{checkpoint}",
                name=name, n_shards=3 if place == "root" else None,
            ).awaitTermination()
    columns = ["event_id", "user_id", "stream"]
    root = read_stream_sink(spark, places["root"], "events").select(*columns, F.lit("root").alias("place"))
    apart = read_sharded(spark, places["apart"], "events").select(*columns, F.lit("apart").alias("place"))
    return root.unionByName(apart)
