from clicklens.operators.actions import category_action_counts, tag_actions
from clicklens.operators.filters import (
    clicks_only,
    extra_predicates,
    filtered_actions,
    without_listed,
)
from clicklens.operators.journeys import (
    flow_pages,
    flow_pairs,
    flow_steps,
    page_jumps,
    page_visits,
)
from clicklens.operators.shares import share_remark, top_share_remark, top_shares
from clicklens.operators.topk import rank_within, top_rows, top_within

__all__ = [
    "category_action_counts",
    "clicks_only",
    "extra_predicates",
    "filtered_actions",
    "flow_pages",
    "flow_pairs",
    "flow_steps",
    "page_jumps",
    "page_visits",
    "rank_within",
    "share_remark",
    "tag_actions",
    "top_rows",
    "top_share_remark",
    "top_shares",
    "top_within",
    "without_listed",
]
