import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from shardsync import (
    check_sink_schema,
    decode_array,
    decode_row,
    decode_sink_array,
    decode_table,
    encode_array,
    encode_row,
    encode_sink_array,
    encode_table,
    escape_text,
    json_column,
    json_pack,
    to_sink_array,
    unescape_text,
)

WINDY = '{"title":"Gale \\"Ida\\"","sea":[4,7]}'


def one(spark, value, data_type, build):
    return spark.createDataFrame([(value,)], f"v {data_type}").select(build(F.col("v"))).first()[0]


@pytest.mark.parametrize(
    ("literal", "elements"),
    [
        ("{north,south west,NULL}", ["north", "south west", None]),
        ("{}", []),
        ("{null,Null,nULL}", [None, None, None]),
        ('{"", "x,y" ,z}', ["", "x,y", "z"]),
        (r'{"tide \"high\"",NULL,""}', ['tide "high"', None, ""]),
        (
            '{"' + WINDY.replace("\\", "\\\\").replace('"', r"\"") + '",NULL,"[]"}',
            [WINDY, None, "[]"],
        ),
        ('{"{",  "}", "[,]"}', ["{", "}", "[,]"]),
        ('{"NULL",NULL}', ["NULL", None]),
        (r'{"ends in \\","next"}', ["ends in \\", "next"]),
        ("{a,,b}", ["a", "b"]),
        ("{it's}", ["it's"]),
        (None, None),
    ],
)
def test_decode_text(spark, literal, elements):
    assert one(spark, literal, "string", lambda c: decode_array(c, "string")) == elements


@pytest.mark.parametrize(
    ("literal", "elem_type", "elements"),
    [
        ("{12,-40,9000000000}", "bigint", [12, -40, 9_000_000_000]),
        ("{8, 9,NULL,x}", "int", [8, 9, None, None]),
        ("{t,f,1,0,NULL}", "boolean", [True, False, True, False, None]),
        ("{1999-12-31,NULL}", "date", [dt.date(1999, 12, 31), None]),
        (
            '{"1987-03-04 05:06:07.25",NULL,"2031-12-31 23:59:59"}',
            "timestamp_ntz",
            [
                dt.datetime(1987, 3, 4, 5, 6, 7, 250000),
                None,
                dt.datetime(2031, 12, 31, 23, 59, 59),
            ],
        ),
    ],
)
def test_decode_typed(spark, literal, elem_type, elements):
    assert one(spark, literal, "string", lambda c: decode_array(c, elem_type)) == elements


def test_decode_empty_as_null(spark):
    assert one(spark, "{}", "string", lambda c: decode_array(c, "int", True)) is None


@pytest.mark.parametrize(
    ("elements", "elem_type", "literal"),
    [
        ([234243, None], "bigint", "{234243,NULL}"),
        ([True, False, None], "boolean", "{1,0,NULL}"),
        (["aa,f", None, 'c"cc', "a\\"], "string", r'{"aa,f",NULL,"c\"cc","a\\"}'),
        ([dt.date(2019, 1, 1), None], "date", "{2019-01-01,NULL}"),
        (
            [dt.datetime(2019, 1, 1, 0, 0, 0, 456000), None, dt.datetime(2019, 1, 3)],
            "timestamp_ntz",
            '{"2019-01-01 00:00:00.456",NULL,"2019-01-03 00:00:00.0"}',
        ),
        ([1.5, None], "double", "{1.5,NULL}"),
        ([], "string", None),
        ([], "int", None),
        (None, "date", None),
    ],
)
def test_encode(spark, elements, elem_type, literal):
    assert one(spark, elements, f"array<{elem_type}>", lambda c: encode_array(c, elem_type)) == literal


def test_encode_keeps_empty_on_request(spark):
    assert one(spark, [], "array<int>", lambda c: encode_array(c, "int", False)) == "{}"


@pytest.mark.parametrize(
    ("literal", "elem_type", "sink"),
    [
        ("{1,2,NULL}", "int", "[1,2,NULL]"),
        ("{1.50,NULL}", "decimal(9,2)", "[1.50,NULL]"),
        ("{t,f,NULL}", "boolean", "[1,0,NULL]"),
        ("{2019-01-01,NULL}", "date", "['2019-01-01',NULL]"),
        ('{"2019-01-01 00:00:00.456",NULL}', "timestamp", "['2019-01-01 00:00:00.456',NULL]"),
        ('{"aa,f",NULL,cc,"it\'s"}', "string", r"['aa,f',NULL,'cc','it\'s']"),
        (r'{"a\"b","c\\"}', "string", r"""['a"b','c\\']"""),
        ('{"NULL"}', "string", "['NULL']"),
        ("{}", "string", None),
        ("{}", "int", None),
        ("{}", "date", None),
    ],
)
def test_sink_literal(spark, literal, elem_type, sink):
    assert one(spark, literal, "string", lambda c: to_sink_array(c, elem_type)) == sink


@pytest.mark.parametrize("build", [encode_array, decode_array, to_sink_array, encode_sink_array])
@pytest.mark.parametrize("elem_type", ["interval day", "map<string,int>", "binary"])
def test_unknown_elements_raise(spark, build, elem_type):
    with pytest.raises(ValueError):
        build(F.col("v"), elem_type)


PIECES = ['"', "\\", ",", "{", "}", "\n", "\t", "\r", "'", "NULL", "n", "t", "é", "漢", "", " "]


def random_text(rng):
    return "".join(rng.choice(PIECES) for _ in range(rng.randint(0, 8)))


def test_text_arrays_survive_both_spellings(spark):
    rng = random.Random(1)
    rows = [
        ([rng.choice([None, random_text(rng), random_text(rng)]) for _ in range(rng.randint(1, 6))],)
        for _ in range(3000)
    ]
    df = spark.createDataFrame(rows, "v array<string>")
    host = encode_array(F.col("v"), "string")
    result = df.select(
        "v",
        decode_array(host, "string").alias("d"),
        decode_sink_array(to_sink_array(host, "string"), "string").alias("s"),
        decode_sink_array(encode_sink_array(F.col("v"), "string"), "string").alias("e"),
        F.contains(to_sink_array(host, "string"), F.lit("\n")).alias("broken"),
    )
    assert all(r.v == r.d == r.s == r.e and not r.broken for r in result.collect())


def test_long_elements_do_not_exhaust_the_stack(spark):
    text = 'x"y\\' * 200_000
    df = spark.createDataFrame([([text, None, text],)], "v array<string>")
    host, sink = encode_array(F.col("v"), "string"), encode_sink_array(F.col("v"), "string")
    row = df.select(
        F.expr("v[0]").alias("t"),
        decode_array(host, "string")[2].alias("d"),
        decode_sink_array(sink, "string")[0].alias("s"),
    ).first()
    assert row.t == row.d == row.s == text


def test_text_cells_survive(spark):
    rng = random.Random(2)
    df = spark.createDataFrame([(random_text(rng),) for _ in range(2000)], "v string")
    cell = escape_text(F.col("v"))
    rows = df.select("v", unescape_text(cell).alias("u"), cell.rlike(r"[\t\n\r]").alias("raw"))
    assert all(r.v == r.u and not r.raw for r in rows.collect())


def test_escapes_of_other_writers(spark):
    cell = r"a\bb\fc\0d\'e\\\n\\n"
    assert one(spark, cell, "string", unescape_text) == "a\bb\fc\0d'e\\\n\\n"


EVERYTHING = """
    b byte, h short, i int, l bigint, f float, d double, n decimal(20,6), t string, o boolean,
    day date, at timestamp_ntz, raw binary, ai array<int>, at2 array<timestamp_ntz>,
    ad array<date>, ab array<boolean>, an array<decimal(18,6)>, af array<double>, ax array<string>
"""


def everything(spark):
    from decimal import Decimal as D

    at = dt.datetime(2024, 2, 29, 23, 59, 59, 120)
    full = (
        1, -2, 3, -4, 1.5, 1e300, D("12.345678"), "a\tb\nc\\d\r", True,
        dt.date(2024, 2, 29), at, bytearray(b"\x00\\\xff"), [1, None], [at, None],
        [dt.date(2024, 2, 29), None], [True, False, None], [D("1.500000"), None],
        [0.1, -1e-9, None], ["x\ty", "it's", None, "", "NULL"],
    )
    return spark.createDataFrame([full, (None,) * len(full)], EVERYTHING)


def test_a_table_survives_lines(spark):
    df = everything(spark)
    lines = encode_row(df)
    assert [f.name for f in lines.schema] == ["value"]
    assert decode_row(lines, df.schema).collect() == df.collect()


@pytest.mark.parametrize("sink", [False, True])
def test_a_table_survives_literals(spark, sink):
    df = everything(spark)
    text = encode_table(df, sink=sink)
    assert dict(text.dtypes)["ax"] == "string"
    assert decode_table(text, df.schema).collect() == df.collect()


def test_line_cells(spark):
    df = spark.createDataFrame(
        [("Null", True, "a\tb", bytearray(b"\xde\xad"), [])],
        "w string, o boolean, t string, raw binary, a array<int>",
    )
    assert encode_row(df).first().value == "\\N\t1\ta\\tb\t\\\\xdead\t\\N"
    raw = encode_row(df.select("w", "t"), null="?", null_text_as_null=False, escape=False)
    assert raw.first().value == "Null\ta\tb"


def test_a_line_with_every_kind_of_array(spark):
    schema = """
        harbour array<string>, seen array<timestamp_ntz>, day array<date>, open array<boolean>,
        depth array<bigint>, fee array<decimal(12,3)>, drift array<double>, berth byte
    """
    cells = [
        "['quay \\'A\\'',NULL,'x,y']",
        "['2003-04-05 06:07:08.9']",
        "[NULL,'2004-02-29']",
        "[0,NULL,1]",
        "[-7,12]",
        "[10.125,NULL]",
        "[0.5]",
        "\\N",
    ]
    row = decode_row(spark.createDataFrame([("\t".join(cells),)], "value string"), schema).first()
    assert row.harbour == ["quay 'A'", None, "x,y"]
    assert row.seen == [dt.datetime(2003, 4, 5, 6, 7, 8, 900000)]
    assert row.day == [None, dt.date(2004, 2, 29)] and row.open == [False, None, True]
    assert row.depth == [-7, 12] and [str(x) for x in row.fee] == ["10.125", "None"]
    assert row.drift == [0.5] and row.berth is None


DAMAGED = [
    "abc", "x1,2,3y", "{a,b", '{"a,b}', "{{1,2},{3,4}}", "", "{", "}", "{a}b}", '{"a"b}', '{a"b"}',
    '{"a""b"}', '{"a" "b"}', '{"a\\"}', "[1,2]",
]


@pytest.mark.parametrize("literal", DAMAGED)
def test_text_that_is_no_literal(spark, literal):
    for kind in ("string", "int", "timestamp_ntz"):
        assert one(spark, literal, "string", lambda c, k=kind: decode_array(c, k)) is None
        assert one(spark, literal, "string", lambda c, k=kind: to_sink_array(c, k)) is None
        with pytest.raises(Exception, match="no array literal"):
            one(spark, literal, "string", lambda c, k=kind: decode_array(c, k, strict=True))
    sink = literal.translate(str.maketrans("{}[]\"", "[]{}'"))
    assert one(spark, sink, "string", lambda c: decode_sink_array(c, "string")) is None


def test_empty_pieces_count_for_no_type(spark):
    for kind, items in (("string", ["1", "2"]), ("int", [1, 2])):
        assert one(spark, "{1,,2}", "string", lambda c, k=kind: decode_array(c, k)) == items
    assert one(spark, "{1,,2}", "string", lambda c: to_sink_array(c, "int")) == "[1,2]"
    assert one(spark, "{a,,b}", "string", lambda c: to_sink_array(c, "string")) == "['a','b']"


def test_very_long_literals_are_checked(spark):
    long = "a,\\\\" * 300_000
    df = spark.createDataFrame([('{"' + long + '","x"}',), ("{" + "7," * 500_000 + "7}",)], "v string")
    found = [r[0] for r in df.select(F.size(decode_array(F.col("v"), "string"))).collect()]
    assert found == [2, 500_001]


@pytest.mark.parametrize("bad", ["m map<string,int>", "s struct<a:int>", "x array<binary>"])
def test_unsupported_columns_raise(spark, bad):
    df = spark.createDataFrame([], f"k int, {bad}")
    for job in (encode_row, encode_table, lambda d: check_sink_schema(d.schema)):
        with pytest.raises(ValueError):
            job(df)


def test_json(spark):
    texts = ['{"a":1,"b":"x"}', "{broken", "", None, '{"a":"no number"}']
    df = spark.createDataFrame([(t,) for t in texts], "j string")
    rows = json_column(df, "j", "struct<a:int,b:string>", "s").select("s").collect()
    assert rows[0].s.a == 1 and [r.s for r in rows[1:]] == [None] * 4
    maps = json_column(df, "j", "map<string,string>", "m").select("m").collect()
    assert maps[0].m == {"a": "1", "b": "x"} and [r.m for r in maps[1:4]] == [None] * 3
    tree = json_column(df, "j", "variant", "v").select(F.isnull("v")).collect()
    assert [r[0] for r in tree] == [False, True, True, True, False]
    many = spark.createDataFrame([('[{"a":"1"},{"b":"2"}]',), ("x",)], "j string")
    lists = json_column(many, "j", "array<map<string,string>>", "l").select("l").collect()
    assert lists[0].l == [{"a": "1"}, {"b": "2"}] and lists[1].l is None


def test_json_bytes(spark):
    df = spark.createDataFrame([(bytearray('{"b":1,"a":"é"}'.encode()),)], "j binary")
    parsed = json_column(df, "j", "map<string,string>", "m")
    entries = parsed.select(F.map_entries("m")).first()[0]
    assert [tuple(e) for e in entries] == [("b", "1"), ("a", "é")]


def test_json_pack(spark):
    df = spark.sql(
        "SELECT date'2020-01-02' AS d, timestamp_ntz'2020-01-02 03:04:05.6' AS t, "
        "cast(NULL AS int) AS n, 'q\"' AS s"
    )
    expected = (
        '{"d":"2020-01-02 00:00:00.000","t":"2020-01-02 03:04:05.600","n":null,"s":"q\\""}'
    )
    row = json_pack(json_pack(df, df.columns, "x"), df.columns, "y", as_bytes=True).first()
    assert row.x == expected and bytes(row.y) == expected.encode()


def test_json_is_parsed_once(spark):
    df = spark.createDataFrame([('{"a":1,"b":"x"}',)], "j string")
    made = json_column(df, "j", "struct<a:int,b:string>", "s").select("s.a", "s.b")
    plan = made._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1 and made.first() == (1, "x")


def test_json_of_odd_names_and_nested_dates(spark):
    df = spark.sql("SELECT 1 AS `a.b`, array(struct(date'2020-02-03' AS d)) AS l")
    assert json_pack(df, df.columns, "x").first().x == '{"a.b":1,"l":[{"d":"2020-02-03 00:00:00.000"}]}'
    text = spark.createDataFrame([('[{"a-b":3}]',)], "j string")
    kind = "array<struct<`a-b`:int>>"
    assert json_column(text, "j", kind, "l").first().l[0]["a-b"] == 3
