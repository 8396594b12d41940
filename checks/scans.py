"""Sharded and fragmented scans, named queries, projection."""

from pathlib import Path

from pyspark.sql import functions as F

from checks.registry import check, fresh_dir, money, table
from shardsync import (
    ShardSpec,
    align_schema,
    assign_fragment,
    decode_row,
    encode_row,
    file_cluster,
    fragment_plan,
    keep_fragments,
    parse_fragment_spec,
    read_named_query,
    read_sharded,
    route,
    write_sharded,
)

SAVED = str(Path(__file__).parent / "saved_queries")


def cluster(spark, label, n=3):
    return file_cluster(fresh_dir(spark, label), n)


def per_fragment(df):
    return df.groupBy("fragment_id").agg(
        F.count("*").alias("n_rows"), money(F.col("o_totalprice")).alias("total")
    )


def fragmented_orders(spark, sf_dir, spec):
    df = table(
        spark,
        sf_dir,
        "orders",
        plan=spec,
        fragment_column="fragment_id",
        columns=["o_totalprice"],
    )
    return per_fragment(df)


@check(
    """
    SELECT ((o_custkey % 3) + 3) % 3 AS shard_no, o_orderstatus, count(*) AS n_rows,
           CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total
    FROM orders GROUP BY ALL
    """
)
def shard_union_scan(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").withColumn("segment_id", F.col("o_custkey"))
    shards = cluster(spark, "union")
    write_sharded(orders, shards, "orders")
    df = read_sharded(spark, shards, "orders", shard_column="shard_no")
    return df.groupBy(F.col("shard_no").cast("bigint").alias("shard_no"), "o_orderstatus").agg(
        F.count("*").alias("n_rows"), money(F.col("o_totalprice")).alias("total")
    )


@check(
    """
    WITH f AS (
      SELECT CASE WHEN o_orderkey IS NULL THEN 7 WHEN o_orderkey < 1000 THEN 0
                  WHEN o_orderkey >= 12000 THEN 1
                  ELSE 2 + (o_orderkey - 1000) // 2500 END AS fragment_id,
             CAST(o_totalprice AS DECIMAL(18,2)) AS p
      FROM orders)
    SELECT CAST(fragment_id AS INTEGER) AS fragment_id, count(*) AS n_rows,
           CAST(sum(p) AS DOUBLE) AS total
    FROM f GROUP BY 1
    """
)
def fragment_int_scan(spark, sf_dir):
    return fragmented_orders(
        spark, sf_dir, parse_fragment_spec("o_orderkey:int", "1000:12000", "2500")
    )


def date_oracle(start: str, end: str, step: str) -> str:
    return f"""
    WITH RECURSIVE b(i, d) AS (
      SELECT 0, DATE '{start}'
      UNION ALL
      SELECT i + 1, least(CAST(d + INTERVAL {step} AS DATE), DATE '{end}')
      FROM b WHERE d < DATE '{end}'),
    o AS (SELECT CAST(o_orderdate AS DATE) AS od, CAST(o_totalprice AS DECIMAL(18,2)) AS p
          FROM orders),
    f AS (
      SELECT CASE WHEN o.od < DATE '{start}' THEN 0 WHEN o.od >= DATE '{end}' THEN 1
                  ELSE 2 + b.i END AS fragment_id, o.p
      FROM o ASOF LEFT JOIN b ON o.od >= b.d)
    SELECT CAST(fragment_id AS INTEGER) AS fragment_id, count(*) AS n_rows,
           CAST(sum(p) AS DOUBLE) AS total
    FROM f GROUP BY 1
    """


@check(date_oracle("1996-01-01", "1999-12-31", "30 DAY"))
def fragment_date_day_scan(spark, sf_dir):
    spec = parse_fragment_spec("o_orderdate:date", "1996-01-01:1999-12-31", "30:day")
    return fragmented_orders(spark, sf_dir, spec)


@check(date_oracle("1995-01-31", "1999-07-01", "1 MONTH"))
def fragment_date_month_scan(spark, sf_dir):
    spec = parse_fragment_spec("o_orderdate:date", "1995-01-31:1999-07-01", "1:month")
    return fragmented_orders(spark, sf_dir, spec)


@check(date_oracle("1996-02-29", "2000-12-31", "1 YEAR"))
def fragment_date_year_scan(spark, sf_dir):
    spec = parse_fragment_spec("o_orderdate:date", "1996-02-29:2000-12-31", "1:year")
    return fragmented_orders(spark, sf_dir, spec)


@check(
    """
    SELECT CASE o_orderpriority WHEN '1-URGENT' THEN 0 WHEN '2-HIGH' THEN 1 ELSE 2 END
             AS fragment_id,
           count(*) AS n_rows,
           CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total
    FROM orders GROUP BY 1
    """
)
def fragment_enum_scan(spark, sf_dir):
    return fragmented_orders(
        spark, sf_dir, parse_fragment_spec("o_orderpriority:enum", "1-URGENT:2-HIGH")
    )


@check(
    """
    WITH e AS (SELECT nullif(user_id % 7, 0) AS k, event_id FROM events)
    SELECT CAST(CASE WHEN k IS NULL THEN 4 WHEN k < 1 THEN 0 WHEN k >= 5 THEN 1
                     ELSE 2 + (k - 1) // 2 END AS INTEGER) AS fragment_id,
           count(*) AS n_rows, min(event_id) AS first_event, max(event_id) AS last_event
    FROM e WHERE k IS NULL OR k >= 5 GROUP BY 1
    """
)
def fragment_null_scan(spark, sf_dir):
    spec = parse_fragment_spec("k:int", "1:5", "2")
    df = table(spark, sf_dir, "events").select(
        F.nullif(F.col("user_id") % 7, F.lit(0)).alias("k"), "event_id"
    )
    df = assign_fragment(keep_fragments(df, spec, [1, spec.null_number]), spec)
    return df.groupBy("fragment_id").agg(
        F.count("*").alias("n_rows"),
        F.min("event_id").alias("first_event"),
        F.max("event_id").alias("last_event"),
    )


@check(
    """
    WITH frag AS (
      SELECT 0 AS fragment_no, 'low' AS kind, '"o_orderkey" < 1000' AS predicate
      UNION ALL SELECT 1, 'high', '"o_orderkey" >= 12000'
      UNION ALL SELECT CAST(2 + i AS INTEGER), 'range',
        '"o_orderkey" >= ' || (1000 + 2500 * i) || ' AND "o_orderkey" < '
        || least(1000 + 2500 * (i + 1), 12000) FROM range(5) t(i)
      UNION ALL SELECT 7, 'null', '"o_orderkey" IS NULL'),
    plan AS (SELECT fragment_no, kind, predicate, CAST(s AS INTEGER) AS shard_no
             FROM frag CROSS JOIN range(3) t(s)),
    n AS (
      SELECT CAST((o_custkey % 8) % 3 AS INTEGER) AS shard_no,
             CASE WHEN o_orderkey < 1000 THEN 0 WHEN o_orderkey >= 12000 THEN 1
                  ELSE 2 + (o_orderkey - 1000) // 2500 END AS fragment_no,
             count(*) AS n_rows
      FROM orders GROUP BY 1, 2)
    SELECT p.shard_no, p.fragment_no, p.kind, p.predicate, coalesce(n.n_rows, 0) AS n_rows
    FROM plan p LEFT JOIN n USING (shard_no, fragment_no)
    """,
    name="fragment_plan",
)
def planned_rows(spark, sf_dir):
    spec = parse_fragment_spec("o_orderkey:int", "1000:12000", "2500")
    orders = table(spark, sf_dir, "orders", columns=["o_orderkey", "o_custkey"])
    rows = route(orders.withColumn("segment_id", F.col("o_custkey") % 8), 3, out="shard_no")
    counts = (
        assign_fragment(rows, spec, "fragment_no")
        .groupBy("shard_no", "fragment_no")
        .agg(F.count("*").alias("n_rows"))
    )
    plan = fragment_plan(spark, 3, spec)
    return plan.join(counts, ["shard_no", "fragment_no"], "left").select(
        "shard_no",
        "fragment_no",
        "kind",
        "predicate",
        F.coalesce("n_rows", F.lit(0)).alias("n_rows"),
    )


def customer_nation(spark, sf_dir, **options):
    views = {n: table(spark, sf_dir, n) for n in ("customer", "nation")}
    return read_named_query(spark, SAVED, "query:customer_nation", views=views, **options)


@check(
    """
    SELECT n_name, count(*) AS n_rows,
           CAST(sum(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE) AS balance
    FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_acctbal > 0 GROUP BY 1
    """
)
def named_query_scan(spark, sf_dir):
    return customer_nation(spark, sf_dir).groupBy("n_name").agg(
        F.count("*").alias("n_rows"), money(F.col("c_acctbal")).alias("balance")
    )


@check(
    """
    SELECT CAST(CASE WHEN c_custkey < 100 THEN 0 WHEN c_custkey >= 1000 THEN 1
                     ELSE 2 + (c_custkey - 100) // 300 END AS INTEGER) AS fragment_id,
           count(*) AS n_rows,
           CAST(sum(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE) AS balance
    FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_acctbal > 0 GROUP BY 1
    """
)
def named_query_fragment_scan(spark, sf_dir):
    spec = parse_fragment_spec("c_custkey:int", "100:1000", "300")
    df = customer_nation(spark, sf_dir, spec=spec, fragment_column="fragment_id")
    return df.groupBy("fragment_id").agg(
        F.count("*").alias("n_rows"), money(F.col("c_acctbal")).alias("balance")
    )


@check(
    """
    SELECT doc_id, lang, md5(text) AS text_md5,
           CAST(len(string_split(text, chr(10))) AS INTEGER) AS n_lines,
           coalesce(nullif(n_chars % 5, 0), -1) AS mark
    FROM documents
    """
)
def tsv_decode(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(
        "doc_id",
        "lang",
        "text",
        F.split("text", "\n").alias("lines"),
        F.nullif(F.col("n_chars") % 5, F.lit(0)).alias("mark"),
    )
    path = fresh_dir(spark, "lines")
    encode_row(docs).write.text(path)
    df = decode_row(spark.read.text(path, lineSep="\n"), docs.schema)
    return df.select(
        "doc_id",
        "lang",
        F.md5("text").alias("text_md5"),
        F.size("lines").alias("n_lines"),
        F.coalesce("mark", F.lit(-1)).alias("mark"),
    )


@check(
    """
    SELECT l_returnflag, CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS qty
    FROM lineitem GROUP BY 1
    """
)
def project_prune(spark, sf_dir):
    df = table(spark, sf_dir, "lineitem", columns=["l_returnflag", "l_quantity"])
    return df.groupBy("l_returnflag").agg(money(F.col("l_quantity")).alias("qty"))


@check(
    """
    SELECT o_orderkey, o_orderstatus, 4 AS n_unread FROM orders
    """
)
def project_null_fill(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    df = align_schema(orders, orders.schema, projected=["o_orderkey", "o_orderstatus"])
    unread = [F.isnull(c).cast("int") for c in df.columns]
    return df.select("o_orderkey", "o_orderstatus", sum(unread, F.lit(0)).alias("n_unread"))


DECLARED = """
    l_linenumber smallint, l_orderkey int, l_partkey bigint, l_quantity float,
    l_extendedprice double, l_discount decimal(12,2), odd boolean, l_returnflag varchar(10),
    l_linestatus char(1), l_suppkey string, raw binary, l_shipdate date, at timestamp_ntz
"""


@check(
    """
    SELECT CAST(l_linenumber AS SMALLINT) AS l_linenumber,
           CAST(l_orderkey AS INTEGER) AS l_orderkey, l_partkey,
           CAST(l_quantity AS REAL) AS l_quantity, l_extendedprice,
           CAST(CAST(l_discount AS DECIMAL(12,2)) AS VARCHAR) AS l_discount,
           l_linenumber % 2 = 1 AS odd, l_returnflag, l_linestatus,
           CAST(l_suppkey AS VARCHAR) AS l_suppkey, md5(l_returnflag) AS raw_md5,
           CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS l_shipdate, l_shipdate AS at
    FROM lineitem
    """
)
def type_coerce(spark, sf_dir):
    df = table(spark, sf_dir, "lineitem").select(
        "*",
        (F.col("l_linenumber") % 2).alias("odd"),
        F.col("l_returnflag").alias("raw"),
        F.col("l_shipdate").cast("string").alias("at"),
    )
    # dates, decimals and bytes are shown as text, which every engine spells alike
    shown = {"l_shipdate": F.col("l_shipdate").cast("string"), "raw": F.md5("raw")}
    shown["l_discount"] = F.col("l_discount").cast("string")
    return align_schema(df, DECLARED).withColumns(shown).withColumnRenamed("raw", "raw_md5")


@check("SELECT n_nationkey, n_name, n_regionkey::BIGINT AS n_regionkey FROM nation")
def shard_union_separate(spark, sf_dir):
    """Shards in unrelated folders, with their columns in other orders and types."""
    base = fresh_dir(spark, "separate")
    nation = table(spark, sf_dir, "nation")
    part = lambda i: nation.where(F.col("n_nationkey") % 3 == i)
    frames = [
        part(0),
        part(1).select("n_regionkey", "n_name", "n_nationkey"),
        part(2).select("n_name", F.col("n_nationkey").cast("long"), F.col("n_regionkey").cast("string")),
    ]
    for i, frame in enumerate(frames):
        frame.write.parquet(f"{base}/place{i}/nation")
    shards = [ShardSpec((f"{base}/place{i}",)) for i in range(3)]
    schema = "n_nationkey int, n_name string, n_regionkey bigint"
    return read_sharded(spark, shards, "nation", schema=schema)


@check(
    """
    SELECT CASE WHEN p_size = 7 THEN 0 WHEN p_size = 15 THEN 1 WHEN p_size = 49 THEN 2 ELSE 3 END
             AS fragment_id, count(*) AS n_rows
    FROM part WHERE p_size <> 7 GROUP BY 1
    """
)
def fragment_enum_numeric(spark, sf_dir):
    """Listed values of a number column, spelled with a leading zero, as filters of the scan."""
    spec = parse_fragment_spec("p_size:enum", "07:15:49")
    parts = table(
        spark, sf_dir, "part", plan=spec, fragments=[1, 2, 3], fragment_column="fragment_id",
        columns=["p_size"],
    )
    return parts.groupBy("fragment_id").agg(F.count("*").alias("n_rows"))
