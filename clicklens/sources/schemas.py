"""Columns of the input tables, the ad clicks and the tables kept from them."""

from __future__ import annotations

from pyspark.sql import types as T


def _schema(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


_LONG, _INT, _TEXT = T.LongType(), T.IntegerType(), T.StringType()

USER_INFO = _schema(
    user_id=_LONG, username=_TEXT, name=_TEXT, age=_INT, professional=_TEXT, gender=_TEXT
)

CITY_INFO = _schema(city_id=_LONG, city_name=_TEXT, area=_TEXT)

PRODUCT_INFO = _schema(product_id=_LONG, product_name=_TEXT, extend_info=_TEXT)

# ``date`` and ``action_time`` are zero-padded ISO text, so text order is time order.
USER_VISIT_ACTION = _schema(
    date=_TEXT, user_id=_LONG, session_id=_TEXT, page_id=_LONG, action_time=_TEXT,
    search_keyword=_TEXT, click_category_id=_LONG, click_product_id=_LONG,
    order_category_ids=_TEXT, order_product_ids=_TEXT,
    pay_category_ids=_TEXT, pay_product_ids=_TEXT, city_id=_LONG,
)

AD_CLICK = _schema(
    ts=_LONG, area=_TEXT, city=_TEXT, user_id=_TEXT, ads_id=_TEXT, day=_TEXT
)

USER_CLICKS = _schema(user_id=_TEXT, day=_TEXT, ads_id=_TEXT, clicks=_LONG)

BLACKLIST = _schema(user_id=_TEXT)

CITY_CLICKS = _schema(day=_TEXT, area=_TEXT, city=_TEXT, ads_id=_TEXT, clicks=_LONG)

AREA_TOP_ADS = _schema(
    day=_TEXT, area=_TEXT, top=T.ArrayType(_schema(ads_id=_TEXT, clicks=_LONG)), top3_json=_TEXT
)

TABLES = {
    "user_info": USER_INFO,
    "city_info": CITY_INFO,
    "product_info": PRODUCT_INFO,
    "user_visit_action": USER_VISIT_ACTION,
}
