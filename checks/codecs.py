"""Array literals, text lines and JSON over whole tables."""

from pyspark.sql import functions as F

from checks.registry import check, table
from shardsync import (
    decode_array,
    decode_row,
    decode_table,
    encode_array,
    encode_row,
    encode_table,
    json_column,
    json_pack,
    to_sink_array,
)

# Arrays are built inside a row, from its own columns or text: no grouping, so
# no key can gather more than its row holds.


def html_pieces(spark, sf_dir):
    """Every page cut at '>', with backslashes, quotes and a NULL at the end."""
    pieces = F.split(F.replace("html", F.lit("/"), F.lit("\\")), ">")
    return table(spark, sf_dir, "pages").select(
        "page_id", F.array_append(pieces, F.lit(None)).alias("a")
    )


HTML_LITERAL = r"""
    WITH p AS (
      SELECT page_id, '{' || array_to_string(list_transform(
               string_split(replace(html, '/', '\'), '>'),
               lambda x: '"' || replace(replace(x, '\', '\\'), '"', '\"') || '"'), ',')
             || ',NULL}' AS lit
      FROM pages)
"""
HTML_SINK = r"""
    WITH p AS (
      SELECT page_id, '[' || array_to_string(list_transform(
               string_split(replace(html, '/', '\'), '>'),
               lambda x: '''' || replace(replace(replace(replace(replace(
                 x, '\', '\\'), chr(9), '\t'), chr(10), '\n'), chr(13), '\r'), '''', '\''')
               || ''''), ',')
             || ',NULL]' AS lit
      FROM pages)
"""
LITERAL_DIGEST = "SELECT page_id, length(lit) AS n_chars, md5(lit) AS lit_md5 FROM p"


def digest(df, key, c):
    return df.select(
        key, F.length(c).cast("bigint").alias("n_chars"), F.md5(c).alias("lit_md5")
    )


def ints(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.array(
            "l_orderkey", "l_partkey", F.nullif(F.col("l_linenumber"), F.lit(1)).cast("bigint")
        ).alias("a"),
    )


def dates(spark, sf_dir):
    day = F.col("l_shipdate").cast("date")
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.array(day, F.date_add(day, 30), F.when(F.col("l_linenumber") > 1, day)).alias("a"),
    )


def times(spark, sf_dir):
    second = F.date_trunc("second", "ts").cast("timestamp_ntz")
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.array("ts", second, F.when(F.col("user_id") % 3 > 0, F.col("ts"))).alias("a"),
    )


def flags(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.array(
            F.col("l_returnflag") == "R", F.col("l_linestatus") == "O", F.lit(None)
        ).alias("a"),
    )


def prices(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.array(
            F.col("l_extendedprice").cast("decimal(18,6)"),
            F.lit(None).cast("decimal(18,6)"),
            F.col("l_discount").cast("decimal(18,6)"),
        ).alias("a"),
    )


def through_text(df):
    """Encode the arrays of a table and decode them again."""
    return decode_table(encode_table(df), df.schema)


INT_PARTS = "l_orderkey || ',' || l_partkey || ',' || coalesce(nullif(l_linenumber, 1)::VARCHAR, 'NULL')"


@check(
    f"SELECT l_orderkey, l_linenumber, '{{' || {INT_PARTS} || '}}' AS literal FROM lineitem"
)
def array_encode_int(spark, sf_dir):
    return encode_table(ints(spark, sf_dir)).withColumnRenamed("a", "literal")


@check(HTML_LITERAL + LITERAL_DIGEST)
def array_encode_text(spark, sf_dir):
    return digest(encode_table(html_pieces(spark, sf_dir)), "page_id", F.col("a"))


@check(
    """
    WITH d AS (SELECT *, CAST(l_shipdate AS DATE) AS d FROM lineitem)
    SELECT l_orderkey, l_linenumber,
           '{' || d || ',' || CAST(d + INTERVAL 30 DAY AS DATE) || ','
           || CASE WHEN l_linenumber > 1 THEN d::VARCHAR ELSE 'NULL' END || '}' AS literal
    FROM d
    """
)
def array_encode_date(spark, sf_dir):
    return encode_table(dates(spark, sf_dir)).withColumnRenamed("a", "literal")


TIME_PARTS = """
    WITH e AS (
      SELECT event_id, user_id,
             CASE WHEN contains(ts::VARCHAR, '.') THEN ts::VARCHAR ELSE ts || '.0' END AS t,
             date_trunc('second', ts) || '.0' AS s
      FROM events)
"""


@check(
    TIME_PARTS
    + """
    SELECT event_id, '{"' || t || '","' || s || '",'
           || CASE WHEN user_id % 3 > 0 THEN '"' || t || '"' ELSE 'NULL' END || '}' AS literal
    FROM e
    """
)
def array_encode_ts(spark, sf_dir):
    return encode_table(times(spark, sf_dir)).withColumnRenamed("a", "literal")


@check(
    """
    WITH d AS (
      SELECT doc_id, list_filter(string_split(text, chr(10)), lambda x: length(x) > 200) AS a
      FROM documents)
    SELECT doc_id, len(a) = 0 AS is_null FROM d
    """
)
def array_empty_null(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", F.filter(F.split("text", "\n"), lambda x: F.length(x) > 200).alias("a")
    )
    return encode_table(docs).select("doc_id", F.isnull("a").alias("is_null"))


@check(
    r"""
    SELECT page_id, CAST(len(string_split(html, '>')) + 1 AS INTEGER) AS n,
           md5(replace(html, '/', '\')) AS joined_md5
    FROM pages
    """
)
def array_decode_text(spark, sf_dir):
    df = through_text(html_pieces(spark, sf_dir))
    return df.select(
        "page_id", F.size("a").alias("n"), F.md5(F.array_join("a", ">")).alias("joined_md5")
    )


@check(
    """
    SELECT l_orderkey, l_linenumber, l_orderkey AS e0, l_partkey AS e1,
           coalesce(nullif(l_linenumber, 1), -1)::BIGINT AS e2, 3 AS n
    FROM lineitem
    """
)
def array_decode_int(spark, sf_dir):
    a = F.col("a")
    return through_text(ints(spark, sf_dir)).select(
        "l_orderkey",
        "l_linenumber",
        a[0].alias("e0"),
        a[1].alias("e1"),
        F.coalesce(a[2], F.lit(-1)).cast("bigint").alias("e2"),
        F.size(a).alias("n"),
    )


@check(
    """
    SELECT l_orderkey, l_linenumber, CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS e0,
           CAST(CAST(CAST(l_shipdate AS DATE) + INTERVAL 30 DAY AS DATE) AS VARCHAR) AS e1,
           l_linenumber = 1 AS no_e2
    FROM lineitem
    """
)
def array_decode_date(spark, sf_dir):
    a = F.col("a")
    return through_text(dates(spark, sf_dir)).select(
        "l_orderkey",
        "l_linenumber",
        a[0].cast("string").alias("e0"),
        a[1].cast("string").alias("e1"),
        a[2].isNull().alias("no_e2"),
    )


@check(
    """
    SELECT event_id, ts AS e0, date_trunc('second', ts) AS e1, user_id % 3 = 0 AS no_e2
    FROM events
    """
)
def array_decode_ts(spark, sf_dir):
    a = F.col("a")
    return through_text(times(spark, sf_dir)).select(
        "event_id", a[0].alias("e0"), a[1].alias("e1"), a[2].isNull().alias("no_e2")
    )


BOOL_LITERAL = """
    WITH l AS (
      SELECT l_orderkey, l_linenumber, l_returnflag = 'R' AS r, l_linestatus = 'O' AS o
      FROM lineitem)
"""


@check(
    BOOL_LITERAL
    + """
    SELECT l_orderkey, l_linenumber, r AS e0, r AS e1, o AS e2, true AS no_e3, 4 AS n FROM l
    """
)
def array_decode_bool(spark, sf_dir):
    # the spellings 1/0 and t/f in one literal
    r, o = F.col("l_returnflag") == "R", F.col("l_linestatus") == "O"
    spelled = [
        r.cast("int").cast("string"),
        F.when(r, "t").otherwise("f"),
        F.when(o, "t").otherwise("f"),
        F.lit("NULL"),
    ]
    literal = F.concat(F.lit("{"), F.concat_ws(",", *spelled), F.lit("}"))
    a = F.col("a")
    return (
        table(spark, sf_dir, "lineitem")
        .withColumn("a", decode_array(literal, "boolean"))
        .select(
            "l_orderkey",
            "l_linenumber",
            a[0].alias("e0"),
            a[1].alias("e1"),
            a[2].alias("e2"),
            a[3].isNull().alias("no_e3"),
            F.size(a).alias("n"),
        )
    )


@check(
    """
    SELECT l_orderkey, l_linenumber,
           CAST(CAST(l_extendedprice AS DECIMAL(18,6)) AS VARCHAR) AS e0,
           true AS no_e1, CAST(CAST(l_discount AS DECIMAL(18,6)) AS VARCHAR) AS e2
    FROM lineitem
    """
)
def array_decode_decimal(spark, sf_dir):
    a = F.col("a")
    return through_text(prices(spark, sf_dir)).select(
        "l_orderkey",
        "l_linenumber",
        a[0].cast("string").alias("e0"),
        a[1].isNull().alias("no_e1"),
        a[2].cast("string").alias("e2"),
    )


@check(
    """
    SELECT vec_id, CAST(i AS INTEGER) AS pos, CAST(embedding[i + 1] AS DOUBLE) AS val
    FROM embeddings, range(64) t(i)
    """
)
def array_decode_float(spark, sf_dir):
    df = through_text(table(spark, sf_dir, "embeddings", columns=["vec_id", "embedding"]))
    return df.select("vec_id", F.posexplode("embedding").alias("pos", "val")).withColumn(
        "val", F.col("val").cast("double")
    )


@check(
    """
    SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k0,
           true AS no_e1, event_type AS type2
    FROM events
    """
)
def array_decode_json(spark, sf_dir):
    made = F.to_json(F.struct("event_type"))
    events = table(spark, sf_dir, "events").select(
        "event_id", F.array("props", F.lit(None), made).alias("a")
    )
    a = F.col("a")
    return through_text(events).select(
        "event_id",
        F.get_json_object(a[0], "$.k").cast("int").alias("k0"),
        a[1].isNull().alias("no_e1"),
        F.get_json_object(a[2], "$.event_type").alias("type2"),
    )


def as_sink(df, elem_type):
    """Typed arrays to host literals to sink literals."""
    host = encode_array(F.col("a"), elem_type)
    return df.withColumn("a", host).withColumn("a", to_sink_array(F.col("a"), elem_type))


@check(
    f"SELECT l_orderkey, l_linenumber, '[' || {INT_PARTS} || ']' AS literal FROM lineitem"
)
def sink_array_num(spark, sf_dir):
    return as_sink(ints(spark, sf_dir), "bigint").withColumnRenamed("a", "literal")


@check(
    TIME_PARTS
    + """
    SELECT event_id, '[''' || t || ''',''' || s || ''','
           || CASE WHEN user_id % 3 > 0 THEN '''' || t || '''' ELSE 'NULL' END || ']' AS literal
    FROM e
    """
)
def sink_array_ts(spark, sf_dir):
    return as_sink(times(spark, sf_dir), "timestamp_ntz").withColumnRenamed("a", "literal")


@check(
    """
    WITH d AS (SELECT *, CAST(l_shipdate AS DATE) AS d FROM lineitem)
    SELECT l_orderkey, l_linenumber,
           '[''' || d || ''',''' || CAST(d + INTERVAL 30 DAY AS DATE) || ''','
           || CASE WHEN l_linenumber > 1 THEN '''' || d || '''' ELSE 'NULL' END || ']' AS literal
    FROM d
    """
)
def sink_array_date(spark, sf_dir):
    return as_sink(dates(spark, sf_dir), "date").withColumnRenamed("a", "literal")


@check(
    BOOL_LITERAL
    + """
    SELECT l_orderkey, l_linenumber,
           '[' || r::INT || ',' || o::INT || ',NULL]' AS literal FROM l
    """
)
def sink_array_bool(spark, sf_dir):
    return as_sink(flags(spark, sf_dir), "boolean").withColumnRenamed("a", "literal")


@check(HTML_SINK + LITERAL_DIGEST)
def sink_array_text(spark, sf_dir):
    return digest(as_sink(html_pieces(spark, sf_dir), "string"), "page_id", F.col("a"))


ESCAPED = r"replace(replace(replace(replace(text, '\', '\\'), chr(9), '\t'), chr(10), '\n'), chr(13), '\r')"


@check(
    rf"""
    SELECT doc_id AS id, md5(concat_ws(chr(9), doc_id, {ESCAPED}, lang,
             coalesce(CAST(nullif(n_chars % 5, 0) AS VARCHAR), '\N'))) AS line_md5
    FROM documents
    """
)
def tsv_encode(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(
        "doc_id",
        "text",
        "lang",
        F.nullif(F.col("n_chars") % 5, F.lit(0)).alias("mark"),
        F.col("doc_id").alias("id"),
    )
    return encode_row(docs, keep=("id",)).select("id", F.md5("value").alias("line_md5"))


@check(
    r"""
    SELECT CASE WHEN user_id % 5 <= 2 THEN '\N' ELSE event_type END AS value,
           count(*) AS n_rows
    FROM events GROUP BY 1
    """
)
def null_text(spark, sf_dir):
    case = F.col("user_id") % 5
    text = (
        F.when(case == 0, "NULL")
        .when(case == 1, "null")
        .when(case == 2, "Null")
        .otherwise(F.col("event_type"))
    )
    lines = encode_row(table(spark, sf_dir, "events").select(text.alias("event_type")))
    return lines.groupBy("value").agg(F.count("*").alias("n_rows"))


@check(
    r"""
    SELECT CAST((o_totalprice > 200000)::INT AS VARCHAR) || chr(9)
           || CASE o_orderstatus WHEN 'P' THEN '\N' WHEN 'F' THEN '1' ELSE '0' END AS value,
           count(*) AS n_rows
    FROM orders GROUP BY 1
    """
)
def bool_encode(spark, sf_dir):
    status = F.col("o_orderstatus")
    lines = encode_row(
        table(spark, sf_dir, "orders").select(
            (F.col("o_totalprice") > 200000).alias("big"),
            F.when(status != "P", status == "F").alias("final"),
        )
    )
    return lines.groupBy("value").agg(F.count("*").alias("n_rows"))


@check("SELECT event_id, props, '\\x3a30' || hex(user_id) AS bitmap FROM events")
def opaque_passthrough(spark, sf_dir):
    # text of JSON and bitmap columns goes through lines untouched
    events = table(spark, sf_dir, "events").select(
        "event_id",
        "props",
        F.concat(F.lit("\\x3a30"), F.hex("user_id")).alias("bitmap"),
    )
    return decode_row(encode_row(events), events.schema)


JSON_TEXT = """
    WITH e AS (
      SELECT event_id, event_type,
             CASE user_id % 6 WHEN 0 THEN '' WHEN 1 THEN '{broken' ELSE props END AS j
      FROM events)
"""


def json_events(spark, sf_dir):
    case = F.col("user_id") % 6
    text = F.when(case == 0, "").when(case == 1, "{broken").otherwise(F.col("props"))
    return table(spark, sf_dir, "events").select("event_id", "event_type", text.alias("j"))


@check(
    JSON_TEXT
    + """
    SELECT event_id, coalesce(CASE WHEN json_valid(j) THEN json_extract_string(j, '$.k') END,
                              'none') AS k
    FROM e
    """
)
def json_to_map(spark, sf_dir):
    df = json_column(json_events(spark, sf_dir), "j", "map<string,string>", "m")
    return df.select("event_id", F.coalesce(F.col("m")["k"], F.lit("none")).alias("k"))


@check(
    JSON_TEXT
    + """
    SELECT event_id, NOT json_valid(j) AS is_null,
           coalesce(CASE WHEN json_valid(j) THEN json_extract_string(j, '$.k')::INT END, -1) AS k
    FROM e
    """
)
def json_to_struct(spark, sf_dir):
    df = json_column(json_events(spark, sf_dir), "j", "struct<k:int>", "s")
    return df.select(
        "event_id", F.isnull("s").alias("is_null"), F.coalesce("s.k", F.lit(-1)).alias("k")
    )


@check(
    """
    SELECT event_id, 2 AS n, json_extract_string(props, '$.k') AS k0, event_type AS type1
    FROM events
    """
)
def json_to_map_array(spark, sf_dir):
    second = F.to_json(F.struct("event_type"))
    text = F.concat(F.lit("["), "props", F.lit(", "), second, F.lit("]"))
    df = table(spark, sf_dir, "events").withColumn("j", text)
    a = F.col("a")
    return json_column(df, "j", "array<map<string,string>>", "a").select(
        "event_id",
        F.size(a).alias("n"),
        a[0]["k"].alias("k0"),
        a[1]["event_type"].alias("type1"),
    )


@check(
    JSON_TEXT
    + """
    SELECT event_id, coalesce(CASE WHEN json_valid(j) THEN json_extract_string(j, '$.k')::INT END,
                              -1) AS k
    FROM e
    """
)
def json_get(spark, sf_dir):
    df = json_column(json_events(spark, sf_dir), "j", "variant", "v")
    k = F.try_variant_get("v", "$.k", "int")
    return df.select("event_id", F.coalesce(k, F.lit(-1)).alias("k"))


@check(
    """
    SELECT event_id, '{"event_id":' || event_id || ',"ts":"'
           || strftime(ts, '%Y-%m-%d %H:%M:%S.') || right('00' || (millisecond(ts) % 1000), 3)
           || '","user_id":' || coalesce(nullif(user_id, 3)::VARCHAR, 'null')
           || ',"event_type":"' || event_type || '"}' AS doc
    FROM events
    """
)
def json_encode(spark, sf_dir):
    events = table(spark, sf_dir, "events").withColumn(
        "user_id", F.nullif("user_id", F.lit(3))
    )
    packed = json_pack(events, ["event_id", "ts", "user_id", "event_type"], "doc")
    return packed.select("event_id", "doc")


@check(
    """
    SELECT doc_id, CASE WHEN doc_id % 7 = 0 THEN 3 END::INTEGER AS n_items,
           CASE WHEN doc_id % 7 = 0 THEN lang END AS first
    FROM documents
    """
)
def array_decode_malformed(spark, sf_dir):
    """Literals made from the rows, six of seven damaged, each in another way."""
    lang, text = F.col("lang"), F.regexp_replace("text", r"[\\\\\"{}]", "")
    good = F.concat(F.lit("{"), lang, F.lit(',"'), text, F.lit('",NULL}'))
    damaged = [
        F.concat(F.lit("{"), lang, F.lit(',"'), text, F.lit('"')),
        F.concat(F.lit("{"), lang, F.lit(',"'), text, F.lit("}")),
        F.concat(F.lit('{"'), text, F.lit('"'), lang, F.lit("}")),
        F.concat(F.lit("{{"), lang, F.lit("},{"), lang, F.lit("}}")),
        F.concat(lang, F.lit(",NULL")),
        F.concat(F.lit("["), lang, F.lit(",NULL]")),
    ]
    literal = good
    for k, other in enumerate(damaged, 1):
        literal = F.when(F.col("doc_id") % 7 == k, other).otherwise(literal)
    docs = table(spark, sf_dir, "documents").select("doc_id", literal.alias("v"))
    items = decode_array(F.col("v"), "string")
    size = F.when(items.isNotNull(), F.size(items)).alias("n_items")
    return docs.select("doc_id", size, F.get(items, F.lit(0)).alias("first"))
