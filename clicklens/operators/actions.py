"""What an action did to which categories."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clicklens.functions import split_list
from clicklens.functions.fixed import NO_CLICK


def tag_actions(actions: DataFrame) -> DataFrame:
    """One row (kind, category_id) per category an action touched.

    An action is a click if it clicked a category, else an order if it has
    ordered categories, else a payment if it has paid ones, else nothing. An
    order or payment counts once for each of its categories.
    """
    clicked = F.col("click_category_id") != NO_CLICK
    ordered = F.col("order_category_ids").isNotNull()
    paid = F.col("pay_category_ids").isNotNull()
    kind = F.when(clicked, "click").when(ordered, "order").when(paid, "pay")
    categories = (
        F.when(clicked, F.array(F.col("click_category_id").cast("string")))
        .when(ordered, split_list(F.col("order_category_ids")))
        .when(paid, split_list(F.col("pay_category_ids")))
    )
    return actions.where(clicked | ordered | paid).select(
        kind.alias("kind"), F.explode(categories).alias("category_id")
    )


def category_action_counts(actions: DataFrame) -> DataFrame:
    """Clicks, orders and payments of each category, in one pass over the log."""
    return tag_actions(actions).groupBy(F.col("category_id").alias("categoryId")).agg(
        F.count_if(F.col("kind") == "click").alias("clickCount"),
        F.count_if(F.col("kind") == "order").alias("orderCount"),
        F.count_if(F.col("kind") == "pay").alias("payCount"),
    )
