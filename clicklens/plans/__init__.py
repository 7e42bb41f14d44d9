from clicklens.plans.ads import (
    ad_clicks_per_area_city,
    ad_totals_per_area,
    area_top_ads,
    count_fields,
    user_ad_clicks,
    users_to_list,
)
from clicklens.plans.daily import run_reports
from clicklens.plans.reports import (
    area_product_top,
    category_session_counts,
    category_top,
    category_top_sessions,
    page_conversion,
)

__all__ = [
    "ad_clicks_per_area_city",
    "ad_totals_per_area",
    "area_product_top",
    "area_top_ads",
    "category_session_counts",
    "category_top",
    "category_top_sessions",
    "count_fields",
    "page_conversion",
    "run_reports",
    "user_ad_clicks",
    "users_to_list",
]
