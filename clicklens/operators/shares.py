"""A group's leading items, and the text that names them with their shares."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clicklens.functions import remark_text
from clicklens.functions.fixed import OTHER_LABEL
from clicklens.operators.topk import top_within


def top_shares(
    rows: DataFrame,
    groups: Sequence[str],
    item: str,
    weight: str | None = None,
    k: int = 2,
    total: str = "total",
    top: str = "top",
) -> DataFrame:
    """One row per group: its total, and its ``k`` items with the most, equals by name.

    ``rows`` are counted, or their ``weight`` summed.

    Items and group totals come out of one aggregate (grouping sets). A group's
    total row is placed ahead of its items, and only ``k + 1`` rows of a group
    are kept before the group meets in one task, however many items it has.
    """
    if weight is None:
        # Counted before rows are doubled for the totals.
        weight = "_n"
        rows = rows.groupBy(*groups, item).agg(F.count("*").alias(weight))
    amount = F.sum(weight)
    sums = rows.groupingSets([[*groups, item], [*groups]], *groups, item).agg(
        amount.alias("_n"), F.grouping(item).alias("_is_total")
    )
    leading = top_within(
        sums, groups, [F.desc("_is_total"), F.desc("_n"), F.asc_nulls_first(item)], k + 1, "_at"
    )
    is_total = F.col("_is_total") == 1
    item_row = F.when(
        ~is_total, F.struct(F.col("_at"), F.col(item).cast("string").alias("item"), F.col("_n").alias("n"))
    )
    return leading.groupBy(*groups).agg(
        F.max(F.when(is_total, F.col("_n"))).alias(total),
        F.array_sort(F.collect_list(item_row)).alias(top),
    )


def share_remark(top: Column, total: Column, other: str = OTHER_LABEL) -> Column:
    """``A:50.00%, B:25.00%, <other>:25.00%``; what is left over is always named."""
    listed = F.aggregate(top, F.lit(0).cast("bigint"), lambda sofar, row: sofar + row["n"])
    return F.concat_ws(
        ", ",
        F.transform(top, lambda row: remark_text(row["item"], row["n"], total)),
        remark_text(F.lit(other), total - listed, total),
    )


def top_share_remark(
    rows: DataFrame,
    groups: Sequence[str],
    item: str,
    weight: str | None = None,
    k: int = 2,
    other: str = OTHER_LABEL,
) -> DataFrame:
    """(groups, total, remark): each group's total and the text of its leading items."""
    return top_shares(rows, groups, item, weight, k).select(
        *groups, "total", share_remark(F.col("top"), F.col("total"), other).alias("remark")
    )
