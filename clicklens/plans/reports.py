"""The batch reports: DataFrames in, one lazy DataFrame out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clicklens.functions import percent
from clicklens.functions.fixed import RATE_PATTERN
from clicklens.operators import (
    category_action_counts,
    clicks_only,
    flow_steps,
    rank_within,
    share_remark,
    top_rows,
    top_shares,
    top_within,
)


def _task(task_id: str) -> Column:
    return F.lit(task_id).alias("taskId")


def category_top(actions: DataFrame, task_id: str, k: int = 10) -> DataFrame:
    """The ``k`` categories with the most clicks, then orders, then payments."""
    order = [F.desc("clickCount"), F.desc("orderCount"), F.desc("payCount"), F.asc("categoryId")]
    return top_rows(category_action_counts(actions), order, k).select(
        _task(task_id), "categoryId", "clickCount", "orderCount", "payCount"
    )


def category_session_counts(actions: DataFrame, categories: DataFrame) -> DataFrame:
    """Clicks of each session in each of the given categories.

    ``categories`` is a top list: as many rows as its limit, so it is broadcast.
    """
    wanted = F.broadcast(categories.select("categoryId"))
    return (
        actions.select(
            F.col("click_category_id").cast("string").alias("categoryId"),
            F.col("session_id").alias("sessionId"),
        )
        .join(wanted, "categoryId", "left_semi")
        .groupBy("categoryId", "sessionId").agg(F.count("*").alias("clickCount"))
    )


def category_top_sessions(
    actions: DataFrame, categories: DataFrame, task_id: str, k: int = 10
) -> DataFrame:
    """The ``k`` sessions with the most clicks in each of the given categories."""
    counts = category_session_counts(actions, categories)
    order = [F.desc("clickCount"), F.asc("sessionId")]
    return top_within(counts, ["categoryId"], order, k).select(
        _task(task_id), "categoryId", "sessionId", "clickCount"
    )


def page_conversion(actions: DataFrame, flow: str, task_id: str) -> DataFrame:
    """Share of a page's visits that went straight on to the flow's next page.

    Visits and jumps are counted in the same pass over the log. A pair that no
    session took has no row.
    """
    visits = F.sum("n").over(Window.partitionBy("page_id"))
    return (
        flow_steps(actions, flow)
        .withColumn("visits", visits)
        .where(F.col("next_page").isNotNull())
        .select(
            _task(task_id),
            F.concat_ws("-", "page_id", "next_page").alias("pageFlow"),
            percent(F.col("n"), F.col("visits"), RATE_PATTERN).alias("conversionRate"),
        )
    )


def clicks_per_city(actions: DataFrame, cities: DataFrame) -> DataFrame:
    """(area, city_name, click_product_id, clicks) for each city id with clicks.

    Clicks are summed per city id and product before they meet the city table,
    so the join and all that follows see only those sums.
    """
    sums = clicks_only(actions).groupBy("city_id", "click_product_id").agg(
        F.count("*").alias("clicks")
    )
    return cities.select("city_id", "city_name", "area").join(sums, "city_id").select(
        "area", "city_name", "click_product_id", "clicks"
    )


def area_product_top(
    actions: DataFrame, cities: DataFrame, products: DataFrame, k: int = 3
) -> DataFrame:
    """Products of rank 1 to ``k`` by clicks in each area, with their cities' shares.

    Ranks are given before the product table is looked at: a product it lacks
    leaves a gap.
    """
    shares = top_shares(
        clicks_per_city(actions, cities), ["area", "click_product_id"], "city_name",
        weight="clicks", total="click_count",
    )
    ranked = rank_within(shares, ["area"], [F.desc("click_count")], k)
    return ranked.join(
        products.select("product_id", "product_name"),
        F.col("click_product_id") == F.col("product_id"),
    ).select(
        "area",
        "product_name",
        "click_count",
        share_remark(F.col("top"), F.col("click_count")).alias("remark"),
        "rank",
    )
