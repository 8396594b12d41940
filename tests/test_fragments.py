import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from shardsync import (
    assign_fragment,
    date_bounds,
    dialect_for,
    fragment_plan,
    jdbc_predicates,
    fragments_date,
    fragments_enum,
    fragments_int,
    keep_fragments,
    parse_fragment_spec,
    quote_ident,
    render_literal,
)

DAY = dt.date.fromisoformat


def predicates(spec, dialect="ansi"):
    return [f.to_predicate(dialect) for f in spec.fragments()]


def test_int_plan():
    spec = parse_fragment_spec("k:int", "0:10", "4")
    assert predicates(spec) == [
        '"k" < 0',
        '"k" >= 10',
        '"k" >= 0 AND "k" < 4',
        '"k" >= 4 AND "k" < 8',
        '"k" >= 8 AND "k" < 10',
        '"k" IS NULL',
    ]
    assert len(spec) == 6 and spec.null_number == 5


def test_day_plan():
    spec = parse_fragment_spec("d:date", "2024-01-01:2024-01-31", "7:day")
    texts = predicates(spec)
    assert len(texts) == len(spec) == 8
    assert texts[6] == "\"d\" >= date'2024-01-29' AND \"d\" < date'2024-01-31'"


def test_month_bounds_keep_the_shorter_day():
    bounds = date_bounds(DAY("1995-01-31"), DAY("1995-07-01"), 1, "month")
    assert [b.isoformat() for b in bounds] == [
        "1995-01-31",
        "1995-02-28",
        "1995-03-28",
        "1995-04-28",
        "1995-05-28",
        "1995-06-28",
        "1995-07-01",
    ]


def test_leap_day_and_the_end_of_the_calendar():
    years = date_bounds(DAY("2020-02-29"), DAY("2022-06-01"), 1, "year")
    assert [b.isoformat() for b in years[1:3]] == ["2021-02-28", "2022-02-28"]
    for unit in ("day", "month", "year"):
        assert date_bounds(DAY("2020-01-01"), DAY("9999-12-31"), 10**8, unit) == [
            DAY("2020-01-01"),
            DAY("9999-12-31"),
        ]


def test_year_plan_counts():
    spec = parse_fragment_spec("d:DATE", "1995-01-01:2001-12-31", "1:YEAR")
    assert spec.steps == 7


def test_one_fragment_of_a_huge_plan():
    spec = fragments_int("k", 0, 2**62, 1)
    assert spec.fragment(2**61).to_predicate() == f'"k" >= {2**61 - 2} AND "k" < {2**61 - 1}'
    with pytest.raises(ValueError):
        spec.fragment(-1)


def test_enum_plan():
    spec = parse_fragment_spec("p:enum", "1-URGENT:2-HIGH")
    assert predicates(spec) == [
        "\"p\" = '1-URGENT'",
        "\"p\" = '2-HIGH'",
        "( \"p\" <> '1-URGENT' AND \"p\" <> '2-HIGH' )",
        '"p" IS NULL',
    ]
    assert "'it''s'" in predicates(fragments_enum("p", ["it's"]))[0]


@pytest.mark.parametrize(
    "args",
    [
        ("col", "0:1", "1"),
        (":int", "0:1", "1"),
        (" :int", "0:1", "1"),
        ("", "0:1", "1"),
        ("col:foo", "0:1", "1"),
        ("col:int", None, "1"),
        ("col:int", "  ", "1"),
        ("col:int", "1:", "1"),
        ("col:int", ":1", "1"),
        ("col:int", "1:2:3", "1"),
        ("col:int", "5:1", "1"),
        ("col:int", "5:5", "1"),
        ("col:int", "a:b", "1"),
        ("col:int", "0:99999999999999999999", "1"),
        ("col:int", "0:5", "0"),
        ("col:int", "0:5", "-1"),
        ("col:int", "0:5", ""),
        ("col:int", "0:5", None),
        ("col:int", "0:5", "x"),
        ("col:date", "2024-01-01:2024-02-01", "3"),
        ("col:date", "2024-01-01:2024-02-01", "3:week"),
        ("col:date", "2024-01-01:2024-02-01", "0:day"),
        ("col:date", "2024-1-1:2024-02-01", "3:day"),
        ("col:date", "2024-02-30:2024-03-01", "3:day"),
        ("col:date", "2024-02-01:2024-01-01", "3:day"),
        ("col:enum", ":", None),
        ("col:enum", "a:a", None),
    ],
)
def test_bad_options_raise(args):
    with pytest.raises(ValueError):
        parse_fragment_spec(*args)


def test_trailing_colons_are_dropped():
    assert parse_fragment_spec("c:int:x", "1:2:", "1") == fragments_int("c", 1, 2, 1)


def sample(kind, rng):
    if kind == "int":
        return [None, *(rng.randint(-60, 60) for _ in range(300))]
    if kind == "date":
        return [None, *(DAY("1995-01-01") + dt.timedelta(rng.randint(0, 2500)) for _ in range(400))]
    return [None, *(rng.choice("abcdef'\\") for _ in range(100))]


SPECS = [
    fragments_int("k", -20, 31, 7),
    fragments_int("k", -(2**63), 2**63 - 1, 2**62),
    fragments_date("k", DAY("1996-01-15"), DAY("1999-03-02"), 17, "day"),
    fragments_date("k", DAY("1996-01-31"), DAY("1999-03-02"), 1, "month"),
    fragments_date("k", DAY("1995-12-30"), DAY("1999-03-02"), 5, "month"),
    fragments_date("k", DAY("1996-02-29"), DAY("2000-03-02"), 1, "year"),
    fragments_date("k", DAY("1996-02-29"), DAY("1996-03-02"), 3, "year"),
    fragments_enum("k", ["b", "e", "'", "\\"]),
]


@pytest.mark.parametrize("spec", SPECS, ids=str)
def test_every_row_is_in_exactly_one_fragment(spark, spec):
    rng = random.Random(7)
    kind = {"int": "bigint", "date": "date", "enum": "string"}[spec.kind]
    values = [(v,) for v in sample(spec.kind, rng)]
    df = assign_fragment(spark.createDataFrame(values, f"k {kind}"), spec)
    as_column = [F.when(f.to_column(), F.lit(f.number)) for f in spec.fragments()]
    as_text = [
        F.expr(f"CASE WHEN {f.to_predicate('spark')} THEN {f.number} END")
        for f in spec.fragments()
    ]
    rows = df.select(
        "fragment_id",
        F.array_compact(F.array(*as_column)).alias("c"),
        F.array_compact(F.array(*as_text)).alias("s"),
    ).collect()
    assert len(rows) == len(values)
    assert all(r.c == r.s == [r.fragment_id] for r in rows)


def test_timestamps_and_fractions_fall_like_their_predicates(spark):
    df = spark.sql(
        "SELECT timestamp_ntz'1996-02-28 23:59:59.999' AS k UNION ALL "
        "SELECT timestamp_ntz'1996-02-29 00:00:00'"
    )
    spec = fragments_date("k", DAY("1996-01-31"), DAY("1997-01-01"), 1, "month")
    assert [r.fragment_id for r in assign_fragment(df, spec).orderBy("k").collect()] == [2, 3]
    df = spark.createDataFrame([(-0.5,), (3.9,)], "k double")
    spec = fragments_int("k", -10, 10, 5)
    assert [r.fragment_id for r in assign_fragment(df, spec).orderBy("k").collect()] == [3, 4]


def test_plan_is_shards_times_fragments(spark):
    spec = fragments_int("k", 0, 10, 4)
    rows = fragment_plan(spark, 3, spec).collect()
    assert len(rows) == 3 * len(spec)
    assert {r.shard_no for r in rows} == {0, 1, 2}
    with pytest.raises(ValueError):
        fragment_plan(spark, 0, spec)


def test_keep_fragments(spark):
    df = spark.range(20).withColumnRenamed("id", "k")
    spec = fragments_int("k", 0, 10, 4)
    assert sorted(r.k for r in keep_fragments(df, spec, [1, 2]).collect()) == [
        *range(4),
        *range(10, 20),
    ]
    fine = fragments_int("k", 0, 20_000, 1)
    many = keep_fragments(df, fine, [0, *range(2, 8), *range(10, 15_000), len(fine) - 1])
    assert sorted(r.k for r in many.collect()) == [*range(6), *range(8, 20)]
    with pytest.raises(ValueError):
        keep_fragments(df, spec, [9])


@pytest.mark.parametrize(
    ("dialect", "day", "time"),
    [
        ("ansi", "date'2024-01-02'", "'2024-01-02 03:04:05'"),
        ("mysql", "DATE('2024-01-02')", "'2024-01-02 03:04:05'"),
        (
            "oracle",
            "to_date('2024-01-02', 'YYYY-MM-DD')",
            "to_timestamp('2024-01-02 03:04:05', 'YYYY-MM-DD HH24:MI:SS.FF')",
        ),
        ("s3select", "TO_TIMESTAMP('2024-01-02')", "TO_TIMESTAMP('2024-01-02 03:04:05')"),
        ("sqlserver", "'2024-01-02'", "'2024-01-02 03:04:05'"),
    ],
)
def test_literals(dialect, day, time):
    assert render_literal(DAY("2024-01-02"), dialect) == day
    assert render_literal(dt.datetime(2024, 1, 2, 3, 4, 5), dialect) == time


def test_more_literals_and_names():
    assert render_literal("o'clock") == "'o''clock'"
    assert render_literal(True) == "true" and render_literal(3) == "3"
    with pytest.raises(ValueError):
        render_literal(object())
    with pytest.raises(ValueError):
        render_literal(1, "nosuch")
    assert quote_ident('a"b') == '"a""b"' and quote_ident("a`b", "mysql") == "`a``b`"
    assert dialect_for("Microsoft SQL Server") == "sqlserver"
    assert dialect_for("Oracle") == "oracle" and dialect_for("MySQL") == "mysql"
    assert dialect_for("S3 Select") == "s3select" and dialect_for("anything") == "ansi"


@pytest.mark.parametrize(
    ("kind", "values", "rows"),
    [
        ("bigint", ["1", "007"], [1, 7, 3, None]),
        ("decimal(9,2)", ["1.5", "2"], ["1.50", "2.00", "3.00", None]),
        ("date", ["2024-02-29"], ["2024-02-29", "2024-03-01", None]),
        ("boolean", ["true"], ["true", "false", None]),
        ("string", ["a", "b:"], ["a", "b:", "c", None]),
    ],
)
def test_listed_values_are_read_as_the_columns_type(spark, kind, values, rows):
    spec = fragments_enum("c", values)
    df = spark.createDataFrame([(None if r is None else str(r),) for r in rows], "c string")
    df = df.select(F.col("c").cast(kind).alias("c"))
    numbered = assign_fragment(df, spec, "f").collect()
    expected = [i for i, _ in enumerate(values)] if len(rows) - 2 == len(values) else [0]
    assert [r.f for r in numbered] == [*expected, len(values), len(values) + 1]
    for n in range(len(spec)):
        assert keep_fragments(df, spec, [n]).count() == sum(r.f == n for r in numbered)
        predicate = spec.fragment(n).to_predicate("spark")
        assert df.where(predicate).count() == sum(r.f == n for r in numbered)


def test_very_many_values_and_ranges(spark):
    df = spark.range(30_000)
    spec = fragments_enum("id", [str(2 * k) for k in range(10_000)])
    assert keep_fragments(df, spec, range(0, 10_000, 2)).count() == 5_000
    assert keep_fragments(df, spec, [10_000]).count() == 20_000
    numbers = assign_fragment(df, spec, "f").groupBy("f").count()
    assert numbers.count() == 10_001 and numbers.where("f = 10000").first()["count"] == 20_000
    spec = fragments_int("id", 0, 30_000, 1)
    kept = keep_fragments(df, spec, [0, 1, *range(2, 20_002, 2)])
    assert kept.count() == 10_000 and kept.where("id % 2 = 1").isEmpty()


def test_a_large_plan_is_not_built_on_the_driver(spark):
    spec = fragments_int("k", -5, 10**9, 1)
    plan = fragment_plan(spark, 1, spec)
    last = plan.where(f"fragment_no = {len(spec) - 2}").first()
    assert (last.lo, last.hi) == (str(10**9 - 1), str(10**9))
    assert last.predicate == spec.fragment(len(spec) - 2).to_predicate()
    with pytest.raises(ValueError):
        jdbc_predicates(spec)
