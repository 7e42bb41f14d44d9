"""All batch reports in one run."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession

from clicklens.operators import filtered_actions
from clicklens.plans.reports import (
    area_product_top,
    category_top,
    category_top_sessions,
    page_conversion,
)
from clicklens.session import shared_dir
from clicklens.sources.condition import Condition

# Names the reports are stored under.
REPORTS = (
    "category_top10",
    "category_top10_session_count",
    "page_conversion_rate",
    "area_click_top10",
)


def run_reports(
    spark: SparkSession,
    tables: Mapping[str, DataFrame],
    condition: Condition,
    write: Callable[[DataFrame, str], None],
    task_id: str | None = None,
    extra: bool = False,
) -> str:
    """Compute the reports and hand each to ``write(rows, name)``; returns the task id.

    The first three look at the actions the condition selects. These are not
    cached: each report reads just the few columns it needs, and at scale that
    is less than writing and reading back all of them. The top categories are
    stored once, since the session report starts from them.
    """
    task_id = task_id or str(uuid.uuid4())
    actions = tables["user_visit_action"]
    selected = filtered_actions(actions, tables["user_info"], condition, extra)

    stored = shared_dir(spark, "category-top")
    category_top(selected, task_id).write.parquet(stored)
    top = spark.read.parquet(stored)
    write(top, "category_top10")
    write(category_top_sessions(selected, top, task_id), "category_top10_session_count")

    if condition.targetPageFlow:
        rates = page_conversion(selected, condition.targetPageFlow, task_id)
        write(rates, "page_conversion_rate")

    area = area_product_top(actions, tables["city_info"], tables["product_info"])
    write(area, "area_click_top10")
    return task_id
