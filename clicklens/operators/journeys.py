"""Page sequences of sessions.

A session is usually a handful of rows, but one session id (a crawler, a
missing id) may hold a large part of the log. All sessions are therefore cut
into slices of time: successors are found inside the slices first, and then
only the first and last row of each slice are put in order per session.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Slices are as long as a text of the action time cut to so many characters says.
HOUR, SECOND = len("yyyy-MM-dd HH"), len("yyyy-MM-dd HH:mm:ss")


def _is_id(text: str) -> bool:
    return text.removeprefix("-").isdecimal() and str(int(text)) == text


def flow_pages(flow: str) -> list[int]:
    """Page ids of a flow "1,2,3"; a text that no id prints as matches no page."""
    return list(dict.fromkeys(int(page) for page in flow.split(",") if _is_id(page)))


def flow_pairs(flow: str) -> list[tuple[int, int]]:
    """Neighbours in the flow, each pair once."""
    pages = flow.split(",")
    pairs = [(a, b) for a, b in zip(pages, pages[1:]) if _is_id(a) and _is_id(b)]
    return list(dict.fromkeys((int(a), int(b)) for a, b in pairs))


def page_visits(actions: DataFrame, flow: str) -> DataFrame:
    """Visits of each page of the flow."""
    return (
        actions.where(F.col("page_id").isin(flow_pages(flow)))
        .groupBy("page_id").agg(F.count("*").alias("visits"))
    )


def flow_steps(actions: DataFrame, flow: str, slice_by: int = HOUR) -> DataFrame:
    """(page_id, next_page, n) for the pages of the flow, from one pass over the log.

    ``n`` counts the visits of a page after which the session's next action was
    on ``next_page``; visits that were not followed by a pair of the flow have
    ``next_page`` null. Next is by ``action_time``, equal times by ``page_id``.

    One task holds a slice of a session, then its slices' edges; how long
    slices are (``slice_by``) changes the work, never the result.
    """
    pages, pairs = flow_pages(flow), flow_pairs(flow)

    def in_flow(following: Column) -> Column:
        # The pair's second page where the pair is in the flow, else null.
        step = F.struct(F.col("page_id").alias("a"), following.alias("b"))
        wanted = [
            F.struct(F.lit(a).cast("bigint").alias("a"), F.lit(b).cast("bigint").alias("b"))
            for a, b in pairs
        ]
        return F.when(step.isin(*wanted), following) if wanted else F.lit(None).cast("bigint")

    sliced = actions.select(
        "session_id", "action_time", "page_id",
        F.substring("action_time", 1, slice_by).alias("slice"),
    )
    in_slice = Window.partitionBy("session_id", "slice").orderBy("action_time", "page_id")
    followed = sliced.select(
        "session_id", "action_time", "page_id",
        F.lead("page_id").over(in_slice).alias("following"),
        F.lead(F.lit(True)).over(in_slice).isNull().alias("is_last"),
        (F.row_number().over(in_slice) == 1).alias("is_first"),
    )

    # Rows inside a slice are counted by pair at once; the slices' edges stay rows.
    is_edge = F.col("is_first") | F.col("is_last")
    counted = (
        followed.where(F.col("page_id").isin(pages) | is_edge)
        .groupBy(
            is_edge.alias("is_edge"),
            F.when(is_edge, F.col("session_id")).alias("session_id"),
            F.when(is_edge, F.col("action_time")).alias("action_time"),
            "page_id",
            (is_edge & F.col("is_last")).alias("is_open"),
            in_flow(F.col("following")).alias("next_page"),
        )
        .agg(F.count("*").alias("n"))
    )
    over_slices = (
        Window.partitionBy("is_edge", "session_id").orderBy("action_time", "page_id", "is_open")
    )
    return (
        counted.withColumn("following", F.lead("page_id").over(over_slices))
        .where(F.col("page_id").isin(pages))
        .groupBy(
            "page_id",
            F.when(F.col("is_open"), in_flow(F.col("following")))
            .otherwise(F.col("next_page")).alias("next_page"),
        )
        .agg(F.sum("n").alias("n"))
    )


def page_jumps(actions: DataFrame, flow: str, slice_by: int = HOUR) -> DataFrame:
    """How often a session went from a page straight to the next one of the flow."""
    return flow_steps(actions, flow, slice_by).where(F.col("next_page").isNotNull()).select(
        "page_id", "next_page", F.col("n").alias("jumps")
    )
