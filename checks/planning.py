"""Balanced plans, plans pruned by a filter, long lists of values, rejected lines."""

from pyspark.sql import functions as F

from checks.registry import check, fresh_dir, money, table
from shardsync import (
    among,
    assign_fragment,
    between,
    compare,
    encode_row,
    fragments_balanced,
    fragments_enum,
    is_null,
    load_lines,
    parse_fragment_spec,
)


@check(
    """
    SELECT count(*) AS n_rows, true AS even, 9 AS plan_size,
           CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS quantity
    FROM lineitem
    """,
    name="fragments_balanced",
)
def balanced_lineitem(spark, sf_dir):
    """Eight ranges of a skewed column; all within a tenth of their share."""
    lines = table(spark, sf_dir, "lineitem", columns=["l_orderkey", "l_linenumber", "l_quantity"])
    # most keys are small: an even step would give the first range nearly all rows
    lines = lines.withColumn("k", F.expr("l_orderkey * l_orderkey"))
    spec = fragments_balanced(lines, "k", 8)
    sizes = assign_fragment(lines, spec).groupBy("fragment_id").agg(
        F.count("*").alias("n"), money(F.col("l_quantity")).alias("quantity")
    )
    even = (F.min("n") * 8 >= 0.9 * F.sum("n")) & (F.max("n") * 8 <= 1.1 * F.sum("n")) & (F.count("*") == 8)
    total = F.sum(F.col("quantity").cast("decimal(18,2)")).cast("double").alias("quantity")
    return sizes.agg(F.sum("n").alias("n_rows"), even.alias("even"), F.lit(len(spec)).alias("plan_size"), total)


@check(
    """
    SELECT o_orderkey, CAST(CASE WHEN o_orderkey < 0 THEN 0 WHEN o_orderkey >= 12000 THEN 1
             ELSE 2 + o_orderkey // 500 END AS INTEGER) AS fragment_id
    FROM orders
    WHERE (o_orderkey >= 700 AND o_orderkey < 1500 OR o_orderkey IN (4001, 9000) OR o_orderkey IS NULL)
      AND NOT (o_orderkey = 9000 OR o_orderkey > 11000)
    """
)
def fragment_prune(spark, sf_dir):
    """Only the fragments that a condition can meet are planned."""
    spec = parse_fragment_spec("o_orderkey:int", "0:12000", "500")
    wanted = (between(700, 1500) | among([4001, 9000]) | is_null()) & ~(compare("=", 9000) | compare(">", 11000))
    return table(
        spark, sf_dir, "orders", plan=spec, within=wanted, fragment_column="fragment_id", columns=["o_orderkey"]
    )


@check(
    """
    SELECT size, CAST(CASE WHEN k IS NULL THEN size + 1 WHEN k % 3 = 0 AND k < 3 * size THEN k // 3 ELSE size END
             AS INTEGER) AS fragment_id, count(*) AS n_rows
    FROM (SELECT nullif(o_custkey, 5) AS k FROM orders), (VALUES (2), (60), (10000)) s(size) GROUP BY ALL
    """
)
def fragment_enum_sizes(spark, sf_dir):
    """Two, sixty and ten thousand listed numbers, spelled with a leading zero."""
    orders = table(spark, sf_dir, "orders", columns=["o_custkey"])
    orders = orders.select(F.nullif("o_custkey", F.lit(5)).alias("_value"))
    frames = [
        assign_fragment(orders, fragments_enum("_value", [f"0{3 * k}" for k in range(size)]), "_number")
        .groupBy(F.col("_number").alias("fragment_id")).agg(F.count("*").alias("n_rows"))
        .withColumn("size", F.lit(size))
        for size in (2, 60, 10_000)
    ]
    return frames[0].unionByName(frames[1]).unionByName(frames[2])


@check(
    """
    WITH d AS (SELECT doc_id, n_chars, lang, len(string_split(text, chr(10))) AS n_lines FROM documents)
    SELECT doc_id, CASE WHEN doc_id % 5 > 0 THEN n_lines END::INTEGER AS n_lines,
           nullif(concat_ws('; ',
             CASE doc_id % 7 WHEN 1 THEN '6 cells, 5 expected' WHEN 2 THEN '4 cells, 5 expected' END,
             CASE WHEN doc_id % 11 = 3 THEN 'n_chars: no int' END,
             CASE WHEN doc_id % 5 = 0 THEN 'lines: no array literal' END,
             CASE WHEN doc_id % 13 = 4 AND doc_id % 7 <> 2 THEN 'sizes: an element is no int' END), '') AS reason
    FROM d
    """
)
def tsv_rejects(spark, sf_dir):
    """Documents as lines, damaged by rule, and loaded in one pass."""
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", F.col("n_chars").cast("int").alias("n_chars"), "lang", F.split("text", "\n").alias("lines"),
        F.array(F.col("n_chars").cast("int"), F.lit(None)).alias("sizes"),
    )
    cells = F.split("value", "\t")
    at = lambda k: F.get(cells, k)
    n = at(0).cast("long")
    damaged = F.concat_ws(
        "\t", at(0),
        F.when(n % 11 == 3, "12x").otherwise(at(1)),
        at(2),
        F.when(n % 5 == 0, F.concat(at(3), F.lit("]"))).otherwise(at(3)),
        F.when(n % 7 != 2, F.when(n % 13 == 4, "[1,2.5.6,NULL]").otherwise(at(4))),
        F.when(n % 7 == 1, "more"),
    )
    base = fresh_dir(spark, "rejects")
    encode_row(docs).select(damaged.alias("value")).write.text(f"{base}/in")
    found = load_lines(spark, f"{base}/in", docs.schema, f"{base}/out", limit=0.9)
    good = found.rows.select("doc_id", F.size("lines").alias("n_lines"), F.lit(None).cast("string").alias("reason"))
    cells = F.split("line", "\t")
    n_lines = F.size(F.split(F.get(cells, 3), "','"))
    bad = found.rejects.select(
        F.get(cells, 0).cast("long").alias("doc_id"), n_lines.alias("n_lines"), "reason"
    )
    return good.unionByName(bad).withColumn("n_lines", F.when(F.col("doc_id") % 5 > 0, F.col("n_lines")))
