"""Filters: each is a plain ``where`` that the scan takes in."""

from pyspark.sql import functions as F

from checks.registry import check, money, table
from shardsync import parse_fragment_spec


def summary(df, price):
    return df.agg(F.count("*").alias("n_rows"), money(F.col(price)).alias("total"))


def line_sql(where: str) -> str:
    return f"""
    SELECT count(*) AS n_rows,
           CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS total
    FROM lineitem WHERE {where}
    """


@check(
    line_sql(
        "l_quantity > 5 AND l_quantity <= 40 AND l_discount >= 0.02 AND l_orderkey < 90000000 "
        "AND l_returnflag = 'A' AND l_linestatus <> 'F'"
    )
)
def filter_compare(spark, sf_dir):
    c = F.col
    df = table(spark, sf_dir, "lineitem").where(
        (c("l_quantity") > 5)
        & (c("l_quantity") <= 40)
        & (c("l_discount") >= 0.02)
        & (c("l_orderkey") < 90000000)
        & (c("l_returnflag") == "A")
        & (c("l_linestatus") != "F")
    )
    return summary(df, "l_extendedprice")


@check(
    """
    SELECT p_brand, count(*) AS n_rows FROM part
    WHERE p_name LIKE '%ring%' OR p_type LIKE 'ECO%' OR p_name LIKE 's_all%' GROUP BY 1
    """
)
def filter_like(spark, sf_dir):
    df = table(spark, sf_dir, "part").where(
        F.col("p_name").like("%ring%")
        | F.col("p_type").like("ECO%")
        | F.col("p_name").like("s_all%")
    )
    return df.groupBy("p_brand").agg(F.count("*").alias("n_rows"))


@check(
    """
    WITH d AS (SELECT nullif(lang, 'de') AS lang, nullif(source, 'src3') AS source, n_chars
               FROM documents)
    SELECT lang IS NULL AS no_lang, count(*) AS n_rows, CAST(sum(n_chars) AS BIGINT) AS chars
    FROM d WHERE (lang IS NULL AND source IS NOT NULL) OR source IS NULL GROUP BY 1
    """
)
def filter_null(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(
        F.nullif("lang", F.lit("de")).alias("lang"),
        F.nullif("source", F.lit("src3")).alias("source"),
        "n_chars",
    )
    df = docs.where(
        (F.col("lang").isNull() & F.col("source").isNotNull()) | F.col("source").isNull()
    )
    return df.groupBy(F.isnull("lang").alias("no_lang")).agg(
        F.count("*").alias("n_rows"), F.sum("n_chars").alias("chars")
    )


@check(
    line_sql(
        "NOT (l_returnflag = 'R' OR l_linestatus = 'O') "
        "OR (l_tax > 0.05 AND NOT l_discount < 0.03)"
    )
)
def filter_bool_tree(spark, sf_dir):
    c = F.col
    df = table(spark, sf_dir, "lineitem").where(
        ~((c("l_returnflag") == "R") | (c("l_linestatus") == "O"))
        | ((c("l_tax") > 0.05) & ~(c("l_discount") < 0.03))
    )
    return summary(df, "l_extendedprice")


@check(line_sql("l_linenumber IN (1, 3, 7) AND l_returnflag IN ('A', 'N')"))
def filter_in(spark, sf_dir):
    df = table(spark, sf_dir, "lineitem").where(
        F.col("l_linenumber").isin(1, 3, 7) & F.col("l_returnflag").isin("A", "N")
    )
    return summary(df, "l_extendedprice")


@check(
    """
    SELECT event_type, count(*) AS n_rows FROM events
    WHERE ts >= TIMESTAMP '2024-01-05 12:30:00.5' AND ts < DATE '2024-01-20' GROUP BY 1
    """
)
def filter_date_ts(spark, sf_dir):
    df = table(spark, sf_dir, "events").where(
        "ts >= timestamp_ntz'2024-01-05 12:30:00.5' AND ts < date'2024-01-20'"
    )
    return df.groupBy("event_type").agg(F.count("*").alias("n_rows"))


@check(
    line_sql(
        "CAST(l_extendedprice AS DECIMAL(12,2)) > CAST(50000.01 AS DECIMAL(12,2)) "
        "AND l_quantity > 10"
    )
)
def filter_residual(spark, sf_dir):
    # the decimal comparison cannot be pushed, the other one still is
    df = table(spark, sf_dir, "lineitem").where(
        "cast(l_extendedprice AS decimal(12,2)) > 50000.01 AND l_quantity > 10"
    )
    return summary(df, "l_extendedprice")


@check(
    """
    SELECT CAST(2 + (o_orderkey - 1000) // 2500 AS INTEGER) AS fragment_id, count(*) AS n_rows,
           CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total
    FROM orders
    WHERE o_orderstatus = 'F' AND o_orderkey >= 3500 AND o_orderkey < 8500 GROUP BY 1
    """
)
def filter_in_fragment(spark, sf_dir):
    df = table(
        spark,
        sf_dir,
        "orders",
        plan=parse_fragment_spec("o_orderkey:int", "1000:12000", "2500"),
        fragments=[3, 4],
        fragment_column="fragment_id",
    ).where(F.col("o_orderstatus") == "F")
    return df.groupBy("fragment_id").agg(
        F.count("*").alias("n_rows"), money(F.col("o_totalprice")).alias("total")
    )


@check(
    """
    WITH d AS (
      SELECT doc_id, list_filter(string_split(text, chr(10)), lambda x: length(x) > 200) AS a
      FROM documents)
    SELECT doc_id, CAST(len(a) AS INTEGER) AS n_long FROM d WHERE len(a) > 0
    """
)
def filter_nonempty_array(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", F.filter(F.split("text", "\n"), lambda x: F.length(x) > 200).alias("a")
    )
    return docs.where(F.size("a") > 0).select("doc_id", F.size("a").alias("n_long"))
