"""What Spark makes of the reports: pushed filters, pruned columns, cut windows."""

import re

import pytest

from clicklens import plans
from clicklens.operators import filtered_actions, page_visits
from clicklens.session import shared_dir
from clicklens.sources import Condition
from clicklens.sources.schemas import CITY_INFO, PRODUCT_INFO, USER_INFO, USER_VISIT_ACTION

CONDITION = Condition(startDate="2019-03-20", endDate="2019-03-25", startAge=20, endAge=50)


@pytest.fixture(scope="module")
def stored(spark):
    place = shared_dir(spark, "plans")
    tables = {}
    for name, schema in (("log", USER_VISIT_ACTION), ("users", USER_INFO), ("cities", CITY_INFO),
                         ("products", PRODUCT_INFO)):
        spark.createDataFrame([], schema).write.parquet(f"{place}/{name}")
        tables[name] = spark.read.schema(schema).parquet(f"{place}/{name}")
    return tables


@pytest.fixture
def large(spark):
    """No table is taken for small."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def columns_read(plan, table):
    found = [re.search(r"ReadSchema: struct<(.*?)>\s*$", line).group(1)
             for line in plan.splitlines() if "FileScan" in line and f"/{table}]" in line]
    return [{field.split(":")[0] for field in schema.split(",")} for schema in found]


def test_filters_and_columns_reach_the_scans(stored):
    selected = filtered_actions(stored["log"], stored["users"], CONDITION)
    plan = plan_of(plans.category_top(selected, "t"))
    assert "GreaterThanOrEqual(date,2019-03-20)" in plan
    assert "LessThanOrEqual(age,50)" in plan
    assert columns_read(plan, "log") == [
        {"date", "user_id", "click_category_id", "order_category_ids", "pay_category_ids"}]
    assert columns_read(plan, "users") == [{"user_id", "age"}]
    assert "TakeOrderedAndProject" in plan and plan.count("Exchange hashpartitioning") == 1


def test_page_ids_reach_the_scan(stored):
    plan = plan_of(page_visits(stored["log"], "1,2,3"))
    assert "In(page_id, [1,2,3])" in plan
    assert columns_read(plan, "log") == [{"page_id"}]


def test_groups_are_cut_before_they_meet(stored):
    selected = filtered_actions(stored["log"], stored["users"], CONDITION)
    top = plans.category_top(selected, "t")
    plan = plan_of(plans.category_top_sessions(selected, top, "t"))
    assert re.search(r"WindowGroupLimit .*row_number\(\), 10, Partial", plan)
    area = plan_of(plans.area_product_top(stored["log"], stored["cities"], stored["products"]))
    assert re.search(r"WindowGroupLimit .*rank\(click_count.*\), 3, Partial", area)
    assert re.search(r"WindowGroupLimit .*row_number\(\), 3, Partial", area)
    assert columns_read(area, "log") == [{"click_product_id", "city_id"}]


def test_sums_come_before_joins(stored, large):
    plan = plan_of(plans.area_product_top(stored["log"], stored["cities"], stored["products"]))
    scan = next(i for i, line in enumerate(plan.splitlines()) if "/log]" in line)
    above = plan.splitlines()[:scan]
    first_sum = max(i for i, line in enumerate(above) if "partial_count" in line)
    last_join = max(i for i, line in enumerate(above) if "SortMergeJoin" in line)
    assert last_join < first_sum


def test_log_is_scanned_once_for_visits_and_jumps(stored):
    plan = plan_of(plans.page_conversion(stored["log"], "1,2,3", "t"))
    assert columns_read(plan, "log") == [{"session_id", "page_id", "action_time"}]
    assert "BroadcastExchange" not in plan


def test_no_pairing_of_all_rows_and_no_python(stored, large):
    selected = filtered_actions(stored["log"], stored["users"], CONDITION)
    top = plans.category_top(selected, "t")
    for frame in (
        selected,
        plans.category_top_sessions(selected, top, "t"),
        plans.page_conversion(selected, "1,2,3", "t"),
        plans.area_product_top(stored["log"], stored["cities"], stored["products"]),
    ):
        plan = plan_of(frame)
        for bad in ("CartesianProduct", "NestedLoop", "Python"):
            assert bad not in plan
        # Only the lists with a fixed bound are still broadcast.
        assert plan.count("BroadcastExchange") <= 1
