"""Physical plans: filters that reach the scan, joins that hold without broadcasting."""

import re

from tablewright.plans.catalog import REGISTRY

SF = "/root/testdata/sf0.001"


def plan_of(df) -> str:
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


def test_range_filter_is_pushed_down(spark):
    text = plan_of(REGISTRY["filter_date_range"].run(spark, SF))
    pushed = re.search(r"PushedFilters: \[(.*?)\]\n", text).group(1)
    assert "GreaterThanOrEqual(o_orderdate" in pushed and "LessThan(o_orderdate" in pushed
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderdate:timestamp_ntz>" in text


def test_scalar_maximum_is_pushed_down(spark):
    assert "EqualTo(p_size,ScalarSubquery" in plan_of(REGISTRY["rank_ties_first"].run(spark, SF))


def test_not_in_is_no_broadcast_null_aware_join(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan_of(REGISTRY["anti_join_not_in"].run(spark, SF))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin LeftAnti" in text and "Broadcast" not in text


def test_count_scans_no_column(spark):
    assert "ReadSchema: struct<>" in plan_of(REGISTRY["count_rows"].run(spark, SF))


def test_semi_join_right_side_is_combined_before_the_shuffle(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan_of(REGISTRY["semi_join_in"].run(spark, SF))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    scan, join = text.index("Scan parquet"), text.index("SortMergeJoin LeftSemi")
    assert text.count("HashAggregate (") >= 2 and join < text.rindex("HashAggregate (") and scan > join


def test_whole_first_row_query_shuffles_once(spark):
    tree = plan_of(REGISTRY["row_number_first_per_key"].run(spark, SF)).split("\n\n")[0]
    assert tree.count("Exchange (") == 1
