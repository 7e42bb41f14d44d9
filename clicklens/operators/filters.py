"""Row filters over the action log and the ad clicks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clicklens.functions.fixed import NO_CLICK
from clicklens.sources.condition import Condition


def _keep(rows: DataFrame, predicates: list[Column]) -> DataFrame:
    return rows.where(reduce(Column.__and__, predicates)) if predicates else rows


def date_predicates(condition: Condition) -> list[Column]:
    """Both bounds are inclusive; dates are compared as text."""
    found = []
    if condition.startDate:
        found.append(F.col("date") >= condition.startDate)
    if condition.endDate:
        found.append(F.col("date") <= condition.endDate)
    return found


def age_predicates(condition: Condition) -> list[Column]:
    found = []
    if condition.startAge:
        found.append(F.col("age") >= condition.startAge)
    if condition.endAge:
        found.append(F.col("age") <= condition.endAge)
    return found


def extra_predicates(condition: Condition) -> tuple[list[Column], list[Column]]:
    """Membership in the condition's lists: (on actions, on users)."""

    def members(pairs: dict[str, str]) -> list[Column]:
        return [
            F.col(column).cast("string").isin(values.split(","))
            for column, values in pairs.items()
            if values
        ]

    on_actions = members({
        "city_id": condition.city,
        "search_keyword": condition.keywords,
        "click_category_id": condition.categoryIds,
    })
    on_users = members({
        "professional": condition.professionals,
        "gender": condition.gender,
    })
    return on_actions, on_users


def filtered_actions(
    actions: DataFrame, users: DataFrame, condition: Condition, extra: bool = False
) -> DataFrame:
    """Actions inside the condition's dates by users inside its ages.

    Only the condition's dates and ages count unless ``extra`` is set. The join
    is left to Spark: it broadcasts the users when they are small, and splits a
    user with very many actions otherwise.
    """
    on_actions, on_users = date_predicates(condition), age_predicates(condition)
    if extra:
        more_on_actions, more_on_users = extra_predicates(condition)
        on_actions += more_on_actions
        on_users += more_on_users
    wanted = _keep(users, on_users).select("user_id")
    return _keep(actions, on_actions).join(wanted, "user_id").select(*actions.columns)


def clicks_only(actions: DataFrame) -> DataFrame:
    """Actions that clicked a product."""
    return actions.where(F.col("click_product_id") > NO_CLICK)


def without_listed(clicks: DataFrame, listed: DataFrame) -> DataFrame:
    """Clicks of users who are not listed."""
    return clicks.join(listed.select("user_id"), "user_id", "left_anti").select(*clicks.columns)
