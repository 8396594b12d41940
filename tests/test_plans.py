"""The physical plans: no Python, no nested loops, filters and columns at the scan."""

import pytest

import __spark_entry__ as contract
from checks.registry import QUERIES, table
from pyspark.sql import functions as F
from shardsync import (
    assign_fragment,
    file_cluster,
    keep_fragments,
    parse_fragment_spec,
    read_sharded,
    write_sharded,
)

NEVER = ("BroadcastNestedLoopJoin", "CartesianProduct", "Python", "Pandas", "Arrow")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan_stays_native(spark, sf_dir, name):
    plan = plan_of(contract.queries()[name](spark, sf_dir))
    assert not [word for word in NEVER if word in plan]


@pytest.mark.parametrize(
    ("name", "pushed"),
    [
        ("filter_compare", "GreaterThan(l_quantity,5.0)"),
        ("filter_in", "In(l_linenumber, [1,3,7])"),
        ("filter_date_ts", "GreaterThanOrEqual(ts,2024-01-05T12:30:00.500)"),
        ("filter_in_fragment", "EqualTo(o_orderstatus,F)"),
        ("filter_residual", "GreaterThan(l_quantity,10.0)"),
    ],
)
def test_filters_reach_the_scan(spark, sf_dir, name, pushed):
    df = contract.queries()[name](spark, sf_dir)
    scans = df._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
    assert pushed in scans


def test_only_needed_columns_are_read(spark, sf_dir):
    plan = plan_of(contract.queries()["project_prune"](spark, sf_dir))
    assert "ReadSchema: struct<l_quantity:double,l_returnflag:string>" in plan
    plan = plan_of(contract.queries()["fragment_date_month_scan"](spark, sf_dir))
    assert "ReadSchema: struct<o_totalprice:double,o_orderdate:timestamp_ntz>" in plan


def test_shards_and_filters_prune_the_scan(spark, sf_dir, tmp_path):
    shards = file_cluster(str(tmp_path), 3)
    orders = table(spark, sf_dir, "orders").withColumn("segment_id", F.col("o_custkey"))
    write_sharded(orders, shards, "t")
    df = read_sharded(spark, shards, "t", shard_column="at").where("at = 1 AND o_orderkey = 5")
    plan = plan_of(df)
    assert "_shard#" in plan.split("PartitionFilters:")[1] and " = 1)" in plan
    assert "EqualTo(o_orderkey,5)" in plan


def test_fragment_numbers_need_no_shuffle(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    for spec in (
        parse_fragment_spec("o_orderkey:int", "0:1000", "10"),
        parse_fragment_spec("o_orderdate:date", "1995-01-31:1999-07-01", "1:month"),
        parse_fragment_spec("o_orderpriority:enum", "1-URGENT"),
    ):
        df = assign_fragment(keep_fragments(orders, spec, [1, 2]), spec)
        assert "Exchange" not in plan_of(df) and "Join" not in plan_of(df)


def test_group_counts_combine_before_the_shuffle(spark, sf_dir):
    df = assign_fragment(
        table(spark, sf_dir, "orders"), parse_fragment_spec("o_orderkey:int", "0:1000", "10")
    )
    assert "partial_count" in plan_of(df.groupBy("fragment_id").agg(F.count("*")))
