"""The physical plans are the intended ones, and a frequent key is split."""

from __future__ import annotations

from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

import __spark_entry__  # noqa: F401  (registers the queries)
from tests.helpers import spark_bag
from tremor.operators import bags, grouping
from tremor.plans import feeds
from tremor.plans.registry import QUERIES

SF = "/root/testdata/sf0.001"
BATCH = sorted(k for k in QUERIES if not k.startswith("st_"))


def initial_plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", BATCH)
def test_no_cross_join_and_no_python(spark, key):
    plan = initial_plan(QUERIES[key](spark, SF))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "EvalPython", "InPandas"):
        assert operator not in plan


def test_scans_read_only_what_is_used(spark):
    plan = initial_plan(QUERIES["topk_locations"](spark, SF))
    assert "ReadSchema: struct<user_id:bigint>" in plan
    assert "ReadSchema: struct<c_custkey:bigint,c_nationkey:int>" in plan
    plan = initial_plan(QUERIES["agg_global_sum"](spark, SF))
    assert "ReadSchema: struct<l_quantity:double,l_extendedprice:double,l_discount:double,l_tax:double>" in plan


def test_filters_reach_the_scan(spark):
    assert "GreaterThan(l_quantity,30.0)" in initial_plan(QUERIES["filter_numeric"](spark, SF))
    assert "StringContains(p_name,ring)" in initial_plan(QUERIES["filter_contains"](spark, SF))
    assert "EqualTo(n_name,NATION_7)" in initial_plan(QUERIES["filter_point_lookup"](spark, SF))


def test_lines_are_split_once(spark):
    for key, lines in {"agg_cancelled_total": 1, "join_inner_products": 2, "header_drop": 1}.items():
        assert initial_plan(QUERIES[key](spark, SF)).count("split(") == lines


def test_sales_are_summed_before_the_join_and_leave_no_view(spark):
    plan = initial_plan(QUERIES["sql_sum_by_country"](spark, SF))
    assert plan.index("Join") < plan.index("keys=[o_custkey")
    assert not [t for t in spark.catalog.listTables() if t.isTemporary]


def test_point_lookup_drops_other_users_before_counting(spark):
    plan = initial_plan(QUERIES["filter_point_lookup"](spark, SF))
    assert plan.index("HashAggregate") < plan.index("Join")
    assert "keys=[user_id" not in plan


@pytest.mark.parametrize("key", ["topk_locations", "topk_largest", "topk_smallest", "limit_preview"])
def test_top_k_is_not_a_full_sort(spark, key):
    assert "TakeOrderedAndProject" in initial_plan(QUERIES[key](spark, SF))


def test_city_dimension_is_broadcast_by_its_size(spark):
    plan = initial_plan(QUERIES["dim_city_match"](spark, SF))
    join = plan[plan.index("BroadcastHashJoin [_fact") :]
    assert "BuildRight" in join.splitlines()[0]


def test_intersection_needs_one_shuffle(spark):
    assert initial_plan(QUERIES["set_intersect"](spark, SF)).count("Exchange hashpartitioning") == 1


@pytest.fixture(scope="module")
def hot_user_data(spark, tmp_path_factory):
    """Events of which a third belong to one user."""
    folder = str(tmp_path_factory.mktemp("hot"))
    row = F.col("id")
    user = F.when(row % 3 == 0, 7).otherwise(F.pmod(F.xxhash64("id"), F.lit(5000)))
    events = spark.range(0, 300_000, 1, 8).select(row.alias("event_id"), user.alias("user_id"))
    customer = spark.range(0, 5000).select(
        row.alias("c_custkey"), (row % 25).cast("int").alias("c_nationkey"), F.lit("BUILDING").alias("c_mktsegment")
    )
    nation = spark.range(0, 25).select(
        row.cast("int").alias("n_nationkey"), F.concat(F.lit("N"), row.cast("string")).alias("n_name")
    )
    for name, rows in {"events": events, "customer": customer, "nation": nation}.items():
        rows.write.parquet(f"{folder}/{name}.parquet")
    return folder


SKEW = {
    "spark__sql__autoBroadcastJoinThreshold": "-1",
    "spark__sql__adaptive__autoBroadcastJoinThreshold": "-1",
    "spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes": "5k",
    "spark__sql__adaptive__skewJoin__skewedPartitionFactor": "1.5",
    "spark__sql__adaptive__advisoryPartitionSizeInBytes": "20k",
}


@contextmanager
def skew_settings(spark):
    names = {k.replace("__", "."): v for k, v in SKEW.items()}
    before = {k: spark.conf.get(k, None) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def executed_with(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_join_splits_a_frequent_user(spark, hot_user_data):
    with skew_settings(spark):
        counts = feeds.place_rows(spark, hot_user_data).groupBy("location").count()
        assert "SortMergeJoin(skew=true)" in executed_with(counts)
        by_row = {r.location: r["count"] for r in counts.collect()}
        merged = {r.location: r.location_count for r in feeds.place_counts(spark, hot_user_data).collect()}
    assert by_row == merged and sum(merged.values()) == 300_000


def test_subtract_splits_a_frequent_value(spark, hot_user_data):
    with skew_settings(spark):
        events = spark.read.parquet(f"{hot_user_data}/events.parquet").select("user_id")
        gone = spark.range(4000, 5000).select(F.col("id").alias("user_id"))
        rest = bags.bag_subtract(events, gone).agg(F.count(F.lit(1)).alias("n"))
        assert "SortMergeJoin(skew=true)" in executed_with(rest)
        assert rest.first().n == events.where("user_id < 4000").count()


def test_grouped_values_of_a_frequent_key_use_many_tasks(spark, hot_user_data):
    with skew_settings(spark):
        events = spark.read.parquet(f"{hot_user_data}/events.parquet")
        grouped = grouping.grouped_values(events, "user_id", "event_id", F.xxhash64("event_id"), max_values=1000)
        assert "SortMergeJoin(skew=true)" in executed_with(grouped)
        sizes = grouped.select("user_id", F.size("values").alias("n"), F.spark_partition_id().alias("task"))
        hot = sizes.where("user_id = 7").collect()
    assert sum(r.n for r in hot) >= 100_000 and max(r.n for r in hot) < 1300
    assert len({r.task for r in hot}) > 1


def test_results_do_not_depend_on_broadcasting(spark):
    for key in ("topk_locations", "dim_city_match", "join_broadcast_lookup", "set_subtract_bag", "agg_group_list"):
        expected = spark_bag(QUERIES[key](spark, SF))
        with skew_settings(spark):
            assert spark_bag(QUERIES[key](spark, SF)) == expected
