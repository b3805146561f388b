"""Properties of the physical plans."""

import pytest

from fareloom.plans import registry
from fareloom.plans import inputs

QUERIES = registry.queries()
WRITING = ("stream_", "version_", "schema_evolution", "sorted_layout", "partitioned_layout")
READ_ONLY = [n for n in sorted(QUERIES) if not n.startswith(WRITING)]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", READ_ONLY)
def test_no_cross_join_and_no_python(spark, sf_dir, name):
    plan = plan_of(QUERIES[name](spark, sf_dir))
    for banned in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "EvalPython", "MapInPandas"):
        assert banned not in plan


def test_cleaning_filter_reaches_the_scan(spark, sf_dir):
    plan = plan_of(inputs.trips(spark, sf_dir))
    assert "PushedFilters: [IsNotNull(l_extendedprice)" in plan


def test_two_column_query_reads_few_columns(spark, sf_dir):
    runs = QUERIES["status_tally"](spark, sf_dir)
    assert "ReadSchema: struct<event_type:string>" in plan_of(runs)


def test_star_counts_sum_before_the_calendar_join(spark, sf_dir):
    plan = plan_of(QUERIES["star_daily"](spark, sf_dir))
    # The plan is printed from the top: the count by date key lies below the join.
    assert plan.index("BroadcastHashJoin") < plan.index("HashAggregate(keys=[date_key")


def test_one_partition_folder_is_read(spark, sf_dir):
    plan = plan_of(QUERIES["partitioned_layout"](spark, sf_dir))
    assert "PartitionFilters: [isnotnull(event_type" in plan


def test_alarms_read_the_points_once(spark, sf_dir):
    assert plan_of(QUERIES["alarm_windows"](spark, sf_dir)).count("FileScan") == 1
