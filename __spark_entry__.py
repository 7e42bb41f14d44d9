"""

Every query reads the whole tables of the given folder, through the views of
``clicklens.sources.shop_views`` (``_VIEWS`` states the same views in SQL).
"""

from __future__ import annotations

import functools
import importlib.util
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clicklens import operators, plans
from clicklens.functions import register_sql_functions
from clicklens.operators.journeys import SECOND
from clicklens.plans import ads
from clicklens.plans.reports import clicks_per_city
from clicklens.session import apply_settings, shared_dir
from clicklens.sinks import save_table
from clicklens.sources import (
    Condition,
    load_tables,
    parse_clicks,
    read_lines,
    rejected_lines,
    shop_views,
)
from clicklens.streaming import AdJobs, CityCounts, StatefulGuard, StateOptions

CONDITION = Condition.from_dict({
    "startDate": "2024-01-05",
    "endDate": "2024-01-25",
    "startAge": "25",
    "endAge": "50",
    "targetPageFlow": "1,2,3,4,5",
})
EXTRA = Condition.from_dict({
    "startDate": "2024-01-05",
    "professionals": "BUILDING,MACHINERY",
    "gender": "F",
    "city": "1,2,3,4,5,6,7,8,9,10,11,12",
    "categoryIds": "1,2,3,5,8,13",
})
TASK = "task-1"
CLICKS_TO_LIST = 2
# First days of the second and third stretch of clicks that are streamed.
STRETCHES = ("2024-01-11", "2024-01-21")


# The operators on training data are a part that may be left out as a whole.
def _is_there(module: str) -> bool:
    spec = importlib.util.find_spec(module)
    return spec is not None and spec.origin is not None


_LLM = _is_there("clicklens.llm") and _is_there("corpus_pipeline")
if _LLM:
    import corpus_pipeline
    from clicklens.llm import queries as llm_queries
    from clicklens.llm import sql as llm_sql


def entry(spark: SparkSession) -> DataFrame:
    """Top products of each area, on the smallest tables."""
    return _area_product_top3(spark, "/root/testdata/sf0.001")


# --- batch ---------------------------------------------------------------------------


def _query(make: Callable[[SparkSession, str], DataFrame]):
    @functools.wraps(make)
    def query(spark: SparkSession, folder: str) -> DataFrame:
        apply_settings(spark)
        return make(spark, folder)

    return query


def _actions(spark: SparkSession, folder: str) -> DataFrame:
    return shop_views.user_visit_action(spark, folder)


def _selected(spark: SparkSession, folder: str) -> DataFrame:
    users = shop_views.user_info(spark, folder)
    return operators.filtered_actions(_actions(spark, folder), users, CONDITION)


def _selected_extra(spark: SparkSession, folder: str) -> DataFrame:
    users = shop_views.user_info(spark, folder)
    return operators.filtered_actions(_actions(spark, folder), users, EXTRA, extra=True)


def _top_categories(spark: SparkSession, folder: str) -> DataFrame:
    return plans.category_top(_selected(spark, folder), TASK)


def _category_action_counts(spark, folder):
    return operators.category_action_counts(_selected(spark, folder))


def _category_session_counts(spark, folder):
    return plans.category_session_counts(_selected(spark, folder), _top_categories(spark, folder))


def _category_top10_sessions(spark, folder):
    return plans.category_top_sessions(
        _selected(spark, folder), _top_categories(spark, folder), TASK
    )


def _page_visits(spark, folder):
    return operators.page_visits(_selected(spark, folder), CONDITION.targetPageFlow)


def _page_jumps(spark, folder):
    return operators.page_jumps(_selected(spark, folder), CONDITION.targetPageFlow)


def _page_jumps_sliced(spark, folder):
    """The same with slices of a second: their length changes nothing."""
    return operators.page_jumps(_selected(spark, folder), CONDITION.targetPageFlow, SECOND)


def _page_conversion(spark, folder):
    return plans.page_conversion(_selected(spark, folder), CONDITION.targetPageFlow, TASK)


def _clicks_per_city(spark, folder):
    return clicks_per_city(_actions(spark, folder), shop_views.city_info(spark, folder))


def _city_remark(spark, folder):
    return operators.top_share_remark(
        _clicks_per_city(spark, folder), ["click_product_id"], "city_name", weight="clicks"
    )


def _city_remark_rows(spark, folder):
    """The same from single clicks instead of sums."""
    clicks = operators.clicks_only(_actions(spark, folder))
    located = clicks.join(shop_views.city_info(spark, folder), "city_id")
    return operators.top_share_remark(located, ["area", "click_product_id"], "city_name")


def _city_remark_sql(spark, folder):
    register_sql_functions(spark)
    for name, table in shop_views.shop_tables(spark, folder).items():
        table.createOrReplaceTempView(name)
    return spark.sql("""
        WITH per_city AS (
          SELECT area, city_name, click_product_id AS product_id, count(*) AS n
          FROM user_visit_action JOIN city_info USING (city_id)
          WHERE click_product_id > -1 GROUP BY ALL),
        ranked AS (
          SELECT area, product_id, sum(n) AS click_count,
                 rank() OVER (PARTITION BY area ORDER BY sum(n) DESC) AS rank
          FROM per_city GROUP BY area, product_id),
        leading AS (
          SELECT c.*, click_count, rank, row_number() OVER (
                   PARTITION BY area, product_id ORDER BY n DESC, city_name) AS place
          FROM per_city c JOIN ranked USING (area, product_id) WHERE rank <= 3)
        SELECT area, product_name, click_count,
               city_remark(collect_list(struct(city_name, n)), click_count) AS remark, rank
        FROM leading JOIN product_info USING (product_id) WHERE place <= 2
        GROUP BY area, product_id, product_name, click_count, rank
    """)


def _area_product_rank(spark, folder):
    counts = _clicks_per_city(spark, folder).groupBy("area", "click_product_id").agg(
        F.sum("clicks").alias("click_count")
    )
    return operators.rank_within(counts, ["area"], [F.desc("click_count")], 3)


def _area_product_top3(spark, folder):
    return plans.area_product_top(
        _actions(spark, folder),
        shop_views.city_info(spark, folder),
        shop_views.product_info(spark, folder),
    )


def _stored_tables(spark, folder):
    """The log and the users as catalog tables, read back by name and filtered."""
    place = shared_dir(spark, "tables")
    database = f"clicklens_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{place}/database'")
    for name, table in shop_views.shop_tables(spark, folder).items():
        days = ["date"] if name == "user_visit_action" else []
        save_table(table, f"{database}.{name}", partition_by=days, path=f"{place}/{name}")
    found = load_tables(spark, database=database, register=False)
    return operators.filtered_actions(found["user_visit_action"], found["user_info"], CONDITION)


def _reports_run(spark, folder):
    """All reports in one run, written by the executors; gives the rows of each."""
    place = shared_dir(spark, "reports")
    tables = shop_views.shop_tables(spark, folder)
    plans.run_reports(
        spark, tables, CONDITION, lambda rows, name: rows.write.parquet(f"{place}/{name}"), TASK
    )
    stored = [
        spark.read.parquet(f"{place}/{name}").select(
            F.lit(name).alias("report"), F.concat_ws("|", *columns).alias("line")
        )
        for name, columns in {
            "category_top10": ["taskId", "categoryId", "clickCount", "orderCount", "payCount"],
            "category_top10_session_count": ["taskId", "categoryId", "sessionId", "clickCount"],
            "page_conversion_rate": ["taskId", "pageFlow", "conversionRate"],
            "area_click_top10": ["area", "product_name", "click_count", "remark", "rank"],
        }.items()
    ]
    return functools.reduce(DataFrame.unionByName, stored)


# --- ad clicks -----------------------------------------------------------------------


def _ad_click_parse(spark, folder):
    return parse_clicks(shop_views.ad_click_lines(spark, folder).select("value"))


def _ad_lines_rejected(spark, folder):
    return rejected_lines(shop_views.mixed_lines(spark, folder))


def _ad_lines_accepted(spark, folder):
    return parse_clicks(shop_views.mixed_lines(spark, folder))


def _ad_user_clicks(spark, folder):
    return ads.user_ad_clicks(_ad_click_parse(spark, folder))


def _city_counts(spark, folder):
    return ads.ad_clicks_per_area_city(_ad_click_parse(spark, folder))


def _area_totals(spark, folder):
    return ads.ad_totals_per_area(_city_counts(spark, folder))


def _area_top_ads(spark, folder):
    return ads.area_top_ads(_area_totals(spark, folder)).select("day", "area", "top3_json")


def _count_fields(spark, folder):
    return ads.count_fields(_city_counts(spark, folder))


def _state_options(spark: SparkSession, keep_days: int | None = None) -> StateOptions:
    """One process needs no more state partitions than it has cores; a cluster's session says."""
    context = spark.sparkContext
    cores = context.defaultParallelism if context.master.startswith("local") else None
    return StateOptions(partitions=cores, keep_days=keep_days)


def _stream(spark: SparkSession, folder: str, counters: bool) -> AdJobs:
    """All click lines through the streaming jobs, as three micro-batches in day order.

    The jobs are stopped after each stretch of days and started again from their
    checkpoints for the next.
    """
    place = shared_dir(spark, "ads")
    jobs = AdJobs(spark, f"{place}/jobs", CLICKS_TO_LIST, _state_options(spark))
    lines = shop_views.ad_click_lines(spark, folder)
    second, third = STRETCHES
    day = F.col("day")
    for stretch in (day < second, (day >= second) & (day < third), day >= third):
        lines.where(stretch).select("value").write.mode("append").text(f"{place}/lines")
        jobs.run_available(read_lines(spark, "text", path=f"{place}/lines"), counters)
    return jobs


def _ad_blacklist(spark, folder):
    return _stream(spark, folder, counters=False).guard.listed()


def _ad_clicks_clean(spark, folder):
    return _stream(spark, folder, counters=False).guard.clean_clicks()


def _ad_user_clicks_streamed(spark, folder):
    return _stream(spark, folder, counters=False).guard.user_clicks()


def _area_city_ads_per_day(spark, folder):
    return _stream(spark, folder, counters=True).city_counts.read()


def _area_ads_top3(spark, folder):
    return _stream(spark, folder, counters=True).area_top.read()


def _guarded(spark: SparkSession, folder: str) -> StatefulGuard:
    """All click lines through the one-operator blacklist, stretch by stretch."""
    place = shared_dir(spark, "guard")
    lines = shop_views.ad_click_lines(spark, folder)
    second, third = STRETCHES
    day = F.col("day")
    for stretch in (day < second, (day >= second) & (day < third), day >= third):
        guard = StatefulGuard(spark, f"{place}/guard", CLICKS_TO_LIST, _state_options(spark))
        lines.where(stretch).select("value").write.mode("append").text(f"{place}/lines")
        guard.run_available(read_lines(spark, "text", path=f"{place}/lines"))
    return guard


def _ad_blacklist_stateful(spark, folder):
    return _guarded(spark, folder).listed()


def _ad_clicks_clean_stateful(spark, folder):
    return _guarded(spark, folder).clean_clicks()


def _ad_user_clicks_stateful(spark, folder):
    return _guarded(spark, folder).user_clicks()


def _city_counts_late(spark, folder):
    """Counts whose state keeps five days: most clicks of the third batch come later than that."""
    place = shared_dir(spark, "late")
    counts = CityCounts(spark, f"{place}/counts", _state_options(spark, keep_days=5))
    lines = shop_views.ad_click_lines(spark, folder)
    first, last = F.col("day") < STRETCHES[0], F.col("day") >= STRETCHES[1]
    chosen = F.crc32("value") % 3 == 0
    for part in (first & chosen, last & chosen, ~(chosen & (first | last))):
        lines.where(part).select("value").write.mode("append").text(f"{place}/lines")
        clicks = parse_clicks(read_lines(spark, "text", path=f"{place}/lines"))
        counts.start(clicks, availableNow=True).awaitTermination()
    return counts.read()


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """Name -> (spark, folder of the tables) -> result."""
    return {
        **({**llm_queries.QUERIES, "pipeline": corpus_pipeline.run} if _LLM else {}),
        **_shop_queries(),
    }


def _shop_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        name: _query(make)
        for name, make in {
            "actions_filtered": _selected,
            "actions_filtered_extra": _selected_extra,
            "category_action_counts": _category_action_counts,
            "category_top10": _top_categories,
            "category_session_counts": _category_session_counts,
            "category_top10_sessions": _category_top10_sessions,
            "page_visits": _page_visits,
            "page_jumps": _page_jumps,
            "page_jumps_sliced": _page_jumps_sliced,
            "page_conversion": _page_conversion,
            "clicks_per_city": _clicks_per_city,
            "city_remark": _city_remark,
            "city_remark_rows": _city_remark_rows,
            "city_remark_sql": _city_remark_sql,
            "area_product_rank": _area_product_rank,
            "area_product_top3": _area_product_top3,
            "stored_tables": _stored_tables,
            "reports_run": _reports_run,
            "ad_click_parse": _ad_click_parse,
            "ad_lines_accepted": _ad_lines_accepted,
            "ad_lines_rejected": _ad_lines_rejected,
            "ad_user_clicks": _ad_user_clicks,
            "ad_city_counts": _city_counts,
            "ad_area_totals": _area_totals,
            "ad_area_top3": _area_top_ads,
            "ad_count_fields": _count_fields,
            "ad_blacklist_streamed": _ad_blacklist,
            "ad_clicks_clean_streamed": _ad_clicks_clean,
            "ad_user_clicks_streamed": _ad_user_clicks_streamed,
            "area_city_ads_per_day_streamed": _area_city_ads_per_day,
            "area_ads_top3_streamed": _area_ads_top3,
            "ad_blacklist_stateful": _ad_blacklist_stateful,
            "ad_clicks_clean_stateful": _ad_clicks_clean_stateful,
            "ad_user_clicks_stateful": _ad_user_clicks_stateful,
            "area_city_ads_per_day_late": _city_counts_late,
        }.items()
    }


# --- the same in SQL -----------------------------------------------------------------

_VIEWS = """
user_info AS (
  SELECT c_custkey AS user_id, c_name AS username, c_name AS name,
         CAST(20 + c_custkey % 41 AS INTEGER) AS age, c_mktsegment AS professional,
         CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS gender
  FROM customer),
city_info AS (
  SELECT CAST(n_nationkey AS BIGINT) AS city_id, n_name AS city_name, r_name AS area
  FROM nation JOIN region ON n_regionkey = r_regionkey),
product_info AS (
  SELECT p_partkey AS product_id, p_name AS product_name, p_brand AS extend_info FROM part),
home_events AS (
  SELECT e.*, CAST(props->>'$.k' AS BIGINT) AS k, CAST(c_nationkey AS BIGINT) AS city_id,
         strftime(ts, '%Y-%m-%d') AS day
  FROM events e JOIN customer ON user_id = c_custkey),
user_visit_action AS (
  SELECT day AS date, user_id, user_id || '_' || day AS session_id, k % 5 + 1 AS page_id,
         strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS action_time,
         CASE WHEN event_type = 'view' THEN 'word_' || (k % 6) END AS search_keyword,
         CASE WHEN event_type = 'click' THEN k % 20 + 1 ELSE -1 END AS click_category_id,
         CASE WHEN event_type = 'click' THEN k % 50 ELSE -1 END AS click_product_id,
         CASE WHEN event_type = 'purchase'
              THEN (k % 20 + 1) || ',' || ((k + 7) % 20 + 1) END AS order_category_ids,
         CASE WHEN event_type = 'purchase'
              THEN (k % 50) || ',' || ((k + 11) % 50) END AS order_product_ids,
         CASE WHEN event_type = 'signup'
              THEN (k % 20 + 1) || ',' || ((k + 3) % 20 + 1) END AS pay_category_ids,
         CASE WHEN event_type = 'signup'
              THEN (k % 50) || ',' || ((k + 13) % 50) END AS pay_product_ids,
         city_id
  FROM home_events),
ad_click AS (
  SELECT epoch_us(ts) // 1000 AS ts, area, city_name AS city, CAST(user_id AS VARCHAR) AS user_id,
         CAST(k % 5 + 1 AS VARCHAR) AS ads_id, day
  FROM home_events JOIN city_info USING (city_id) WHERE event_type = 'click')"""

_SELECTED = f"""
selected AS (
  SELECT * FROM user_visit_action JOIN (
    SELECT user_id FROM user_info
    WHERE age BETWEEN {CONDITION.startAge} AND {CONDITION.endAge}) USING (user_id)
  WHERE date BETWEEN '{CONDITION.startDate}' AND '{CONDITION.endDate}')"""

_CATEGORIES = f"""
touched AS (
  SELECT CAST(click_category_id AS VARCHAR) AS category_id, 'click' AS kind
  FROM selected WHERE click_category_id <> -1
  UNION ALL
  SELECT unnest(string_split(order_category_ids, ',')), 'order' FROM selected
  WHERE click_category_id = -1 AND order_category_ids IS NOT NULL
  UNION ALL
  SELECT unnest(string_split(pay_category_ids, ',')), 'pay' FROM selected
  WHERE click_category_id = -1 AND order_category_ids IS NULL AND pay_category_ids IS NOT NULL),
category_counts AS (
  SELECT category_id AS "categoryId",
         count(*) FILTER (WHERE kind = 'click') AS "clickCount",
         count(*) FILTER (WHERE kind = 'order') AS "orderCount",
         count(*) FILTER (WHERE kind = 'pay') AS "payCount"
  FROM touched GROUP BY category_id),
top_categories AS (
  SELECT '{TASK}' AS "taskId", * FROM category_counts
  ORDER BY "clickCount" DESC, "orderCount" DESC, "payCount" DESC, "categoryId" LIMIT 10),
session_counts AS (
  SELECT CAST(click_category_id AS VARCHAR) AS "categoryId", session_id AS "sessionId",
         count(*) AS "clickCount"
  FROM selected
  WHERE CAST(click_category_id AS VARCHAR) IN (SELECT "categoryId" FROM top_categories)
  GROUP BY ALL),
top_sessions AS (
  SELECT '{TASK}' AS "taskId", * FROM session_counts
  QUALIFY row_number() OVER (
    PARTITION BY "categoryId" ORDER BY "clickCount" DESC, "sessionId") <= 10)"""

_JOURNEYS = f"""
visits AS (
  SELECT page_id, count(*) AS visits FROM selected WHERE page_id IN (1, 2, 3, 4, 5)
  GROUP BY page_id),
steps AS (
  SELECT page_id, lead(page_id) OVER (
    PARTITION BY session_id ORDER BY action_time, page_id) AS next_page
  FROM selected),
jumps AS (
  SELECT page_id, next_page, count(*) AS jumps FROM steps
  WHERE (page_id, next_page) IN ((1, 2), (2, 3), (3, 4), (4, 5)) GROUP BY page_id, next_page),
conversion AS (
  SELECT '{TASK}' AS "taskId", page_id || '-' || next_page AS "pageFlow",
         regexp_replace(printf('%.2f%%', CAST(jumps AS DOUBLE) / visits * 100), '^0\\.', '.')
           AS "conversionRate"
  FROM jumps JOIN visits USING (page_id))"""


def _remark(source: str, groups: str) -> str:
    """SQL of (groups, total, remark) over counts ``n`` per city name."""
    share = "printf('%.2f%%', CAST({} AS DOUBLE) / max(total) * 100)"
    return f"""
  SELECT {groups}, CAST(max(total) AS BIGINT) AS total,
         string_agg(city_name || ':' || printf('%.2f%%', CAST(n AS DOUBLE) / total * 100), ', '
                    ORDER BY pos) FILTER (WHERE pos <= 2)
         || ', 其他:' || {share.format("max(total) - sum(n) FILTER (WHERE pos <= 2)")} AS remark
  FROM (
    SELECT *, sum(n) OVER (PARTITION BY {groups}) AS total,
           row_number() OVER (PARTITION BY {groups} ORDER BY n DESC, city_name) AS pos
    FROM (SELECT {groups}, city_name, sum(clicks) AS n FROM {source} GROUP BY {groups}, city_name))
  GROUP BY {groups}"""


_AREAS = f"""
city_clicks AS (
  SELECT area, city_name, click_product_id, count(*) AS clicks
  FROM user_visit_action JOIN city_info USING (city_id)
  WHERE click_product_id > -1 GROUP BY city_id, area, city_name, click_product_id),
area_remarks AS ({_remark("city_clicks", "area, click_product_id")}),
area_ranks AS (
  SELECT *, CAST(rank() OVER (PARTITION BY area ORDER BY total DESC) AS INTEGER) AS rank
  FROM area_remarks QUALIFY rank <= 3),
area_top AS (
  SELECT area, product_name, total AS click_count, remark, rank
  FROM area_ranks JOIN product_info ON click_product_id = product_id)"""


def _stretch(column: str) -> str:
    return (
        f"(CASE WHEN {column} < '{STRETCHES[0]}' THEN 0 WHEN {column} < '{STRETCHES[1]}' THEN 1 "
        "ELSE 2 END)"
    )


# A day lies in one stretch, so a user is listed after the first stretch with a
# day on which one ad got enough of the user's clicks.
_LISTED = f"""
listed AS (
  SELECT user_id, min({_stretch("day")}) AS since FROM (
    SELECT user_id, day FROM ad_click GROUP BY user_id, day, ads_id
    HAVING count(*) >= {CLICKS_TO_LIST}) GROUP BY user_id),
clean AS (
  SELECT c.* FROM ad_click c LEFT JOIN listed l ON c.user_id = l.user_id
  WHERE l.since IS NULL OR {_stretch("c.day")} <= l.since)"""

_MIXED = """
mixed AS (
  SELECT event_type, user_id, epoch_us(ts) // 1000 AS ms, area, city_name AS city, k % 5 + 1 AS ad, day
  FROM home_events JOIN city_info USING (city_id)),
mixed_lines AS (
  SELECT *, CASE event_type
      WHEN 'view' THEN concat_ws(',', ms, area, city, user_id)
      WHEN 'error' THEN concat_ws(',', 't' || ms, area, city, user_id, ad)
      WHEN 'signup' THEN concat_ws(',', ms, area, city, user_id, '')
      WHEN 'purchase' THEN concat_ws(',', ms, area, city, user_id, ad, 'more')
      ELSE concat_ws(',', ms, area, city, user_id, ad) END AS value
  FROM mixed)"""


def _counts(source: str, keys: str) -> str:
    return f"SELECT {keys}, count(*) AS clicks FROM {source} GROUP BY {keys}"


def _top_json(source: str) -> str:
    return f"""
  SELECT day, area,
         '[' || string_agg('{{"' || ads_id || '":' || clicks || '}}', ','
                           ORDER BY clicks DESC, ads_id) || ']' AS top3_json
  FROM (
    SELECT *, row_number() OVER (PARTITION BY day, area ORDER BY clicks DESC, ads_id) AS pos
    FROM ({_counts(source, "day, area, ads_id")}))
  WHERE pos <= 3 GROUP BY day, area"""


def _with(select: str, *parts: str) -> str:
    return "WITH " + ",".join([_VIEWS, *parts]) + "\n" + select


def oracle_sql() -> dict[str, str]:
    """Name -> SQL over the same tables."""
    area_city = "day, area, city, ads_id"
    user_ad = "user_id, day, ads_id"
    remarks = _remark("city_clicks", "click_product_id")
    extra_cities = ", ".join(f"'{c}'" for c in EXTRA.city.split(","))
    extra_categories = ", ".join(f"'{c}'" for c in EXTRA.categoryIds.split(","))
    extra_jobs = ", ".join(f"'{p}'" for p in EXTRA.professionals.split(","))
    return {
        **(llm_sql.ORACLE_SQL if _LLM else {}),
        "actions_filtered": _with("SELECT * FROM selected", _SELECTED),
        "actions_filtered_extra": _with(f"""
            SELECT * FROM user_visit_action JOIN (
              SELECT user_id FROM user_info
              WHERE gender = '{EXTRA.gender}' AND professional IN ({extra_jobs})) USING (user_id)
            WHERE date >= '{EXTRA.startDate}'
              AND CAST(city_id AS VARCHAR) IN ({extra_cities})
              AND CAST(click_category_id AS VARCHAR) IN ({extra_categories})"""),
        "category_action_counts": _with("SELECT * FROM category_counts", _SELECTED, _CATEGORIES),
        "category_top10": _with("SELECT * FROM top_categories", _SELECTED, _CATEGORIES),
        "category_session_counts": _with("SELECT * FROM session_counts", _SELECTED, _CATEGORIES),
        "category_top10_sessions": _with("SELECT * FROM top_sessions", _SELECTED, _CATEGORIES),
        "page_visits": _with("SELECT * FROM visits", _SELECTED, _JOURNEYS),
        "page_jumps": _with("SELECT * FROM jumps", _SELECTED, _JOURNEYS),
        "page_jumps_sliced": _with("SELECT * FROM jumps", _SELECTED, _JOURNEYS),
        "page_conversion": _with("SELECT * FROM conversion", _SELECTED, _JOURNEYS),
        "clicks_per_city": _with("SELECT * FROM city_clicks", _AREAS),
        "city_remark": _with(remarks, _AREAS),
        "city_remark_rows": _with("SELECT * FROM area_remarks", _AREAS),
        "city_remark_sql": _with("SELECT * FROM area_top", _AREAS),
        "area_product_rank": _with(
            "SELECT area, click_product_id, total AS click_count, rank FROM area_ranks", _AREAS),
        "area_product_top3": _with("SELECT * FROM area_top", _AREAS),
        "stored_tables": _with("SELECT * FROM selected", _SELECTED),
        "reports_run": _with("""
            SELECT 'category_top10' AS report, concat_ws('|', "taskId", "categoryId",
              "clickCount", "orderCount", "payCount") AS line FROM top_categories
            UNION ALL SELECT 'category_top10_session_count', concat_ws('|', "taskId",
              "categoryId", "sessionId", "clickCount") FROM top_sessions
            UNION ALL SELECT 'page_conversion_rate', concat_ws('|', "taskId", "pageFlow",
              "conversionRate") FROM conversion
            UNION ALL SELECT 'area_click_top10', concat_ws('|', area, product_name,
              click_count, remark, rank) FROM area_top""",
            _SELECTED, _CATEGORIES, _JOURNEYS, _AREAS),
        "ad_click_parse": _with("SELECT * FROM ad_click"),
        "ad_lines_accepted": _with("""
            SELECT ms AS ts, area, city, CAST(user_id AS VARCHAR) AS user_id,
                   CAST(ad AS VARCHAR) AS ads_id, day
            FROM mixed WHERE event_type IN ('click', 'purchase')""", _MIXED),
        "ad_lines_rejected": _with("""
            SELECT value FROM mixed_lines WHERE event_type NOT IN ('click', 'purchase')""",
            _MIXED),
        "ad_user_clicks": _with(_counts("ad_click", user_ad)),
        "ad_city_counts": _with(_counts("ad_click", area_city)),
        "ad_area_totals": _with(_counts("ad_click", "day, area, ads_id")),
        "ad_area_top3": _with(_top_json("ad_click")),
        "ad_count_fields": _with(f"""
            SELECT concat_ws(':', {area_city}) AS field, CAST(count(*) AS VARCHAR) AS value
            FROM ad_click GROUP BY {area_city}"""),
        "ad_blacklist_streamed": _with("SELECT user_id FROM listed", _LISTED),
        "ad_clicks_clean_streamed": _with("SELECT * FROM clean", _LISTED),
        "ad_user_clicks_streamed": _with(_counts("clean", user_ad), _LISTED),
        "area_city_ads_per_day_streamed": _with(_counts("clean", area_city), _LISTED),
        "area_ads_top3_streamed": _with(_top_json("clean"), _LISTED),
        "ad_blacklist_stateful": _with("SELECT user_id FROM listed", _LISTED),
        "ad_clicks_clean_stateful": _with("SELECT * FROM clean", _LISTED),
        "ad_user_clicks_stateful": _with(_counts("clean", user_ad), _LISTED),
        "area_city_ads_per_day_late": _with(_counts("ad_click", area_city)),
    }
