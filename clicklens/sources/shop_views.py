"""The input tables of the reports, derived from a star schema with an event log.

Every view reads its whole source tables. Ids are derived from the number k in
an event's ``props`` ({"k": 17}).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CATEGORIES, PRODUCTS, PAGES, ADS, WORDS = 20, 50, 5, 5, 6


# The columns used; stating them saves looking into the files for them.
SOURCES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_brand string",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, props string",
}


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(SOURCES[name]).parquet(f"{folder}/{name}.parquet")


def user_info(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("c_custkey")
    return _table(spark, folder, "customer").select(
        key.alias("user_id"),
        F.col("c_name").alias("username"),
        F.col("c_name").alias("name"),
        (F.lit(20) + key % 41).cast("int").alias("age"),
        F.col("c_mktsegment").alias("professional"),
        F.when(key % 2 == 0, "F").otherwise("M").alias("gender"),
    )


def city_info(spark: SparkSession, folder: str) -> DataFrame:
    return (
        _table(spark, folder, "nation")
        .join(_table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.col("n_nationkey").cast("bigint").alias("city_id"),
            F.col("n_name").alias("city_name"),
            F.col("r_name").alias("area"),
        )
    )


def product_info(spark: SparkSession, folder: str) -> DataFrame:
    return _table(spark, folder, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_brand").alias("extend_info"),
    )


def _events(spark: SparkSession, folder: str) -> DataFrame:
    homes = _table(spark, folder, "customer").select(
        F.col("c_custkey").alias("user_id"), F.col("c_nationkey").cast("bigint").alias("city_id")
    )
    return (
        _table(spark, folder, "events")
        .withColumn("k", F.get_json_object("props", "$.k").cast("bigint"))
        .join(homes, "user_id")
    )


def _id_list(*ids: Column) -> Column:
    return F.concat_ws(",", *ids)


def user_visit_action(spark: SparkSession, folder: str) -> DataFrame:
    k, kind = F.col("k"), F.col("event_type")
    day = F.date_format("ts", "yyyy-MM-dd")

    def category(shift: int) -> Column:
        return (k + shift) % CATEGORIES + 1

    def product(shift: int) -> Column:
        return (k + shift) % PRODUCTS

    return _events(spark, folder).select(
        day.alias("date"),
        "user_id",
        F.concat_ws("_", "user_id", day).alias("session_id"),
        (k % PAGES + 1).alias("page_id"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("action_time"),
        F.when(kind == "view", F.concat(F.lit("word_"), k % WORDS)).alias("search_keyword"),
        F.when(kind == "click", category(0)).otherwise(-1).alias("click_category_id"),
        F.when(kind == "click", product(0)).otherwise(-1).alias("click_product_id"),
        F.when(kind == "purchase", _id_list(category(0), category(7))).alias("order_category_ids"),
        F.when(kind == "purchase", _id_list(product(0), product(11))).alias("order_product_ids"),
        F.when(kind == "signup", _id_list(category(0), category(3))).alias("pay_category_ids"),
        F.when(kind == "signup", _id_list(product(0), product(13))).alias("pay_product_ids"),
        "city_id",
    )


def ad_clicks(spark: SparkSession, folder: str) -> DataFrame:
    """(ts in epoch ms, area, city, user_id, ads_id, day) of each click event."""
    millis = F.expr("timestampdiff(MILLISECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts)")
    return (
        _events(spark, folder).where(F.col("event_type") == "click")
        .join(city_info(spark, folder), "city_id")
        .select(
            millis.alias("ts"),
            "area",
            F.col("city_name").alias("city"),
            F.col("user_id").cast("string").alias("user_id"),
            (F.col("k") % ADS + 1).cast("string").alias("ads_id"),
            F.date_format("ts", "yyyy-MM-dd").alias("day"),
        )
    )


def ad_click_lines(spark: SparkSession, folder: str) -> DataFrame:
    """The clicks as message text, with their day for splitting them into batches."""
    return ad_clicks(spark, folder).select(
        F.concat_ws(",", "ts", "area", "city", "user_id", "ads_id").alias("value"), "day"
    )


def mixed_lines(spark: SparkSession, folder: str) -> DataFrame:
    """A line per event, whatever it is; only clicks and purchases give valid click lines."""
    millis = F.expr("timestampdiff(MILLISECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts)")
    place, user, ad = ["area", "city_name"], F.col("user_id"), F.col("k") % ADS + 1
    line = (
        F.when(F.col("event_type") == "view", F.concat_ws(",", millis, *place, user))
        .when(
            F.col("event_type") == "error",
            F.concat_ws(",", F.concat(F.lit("t"), millis), *place, user, ad),
        )
        .when(F.col("event_type") == "signup", F.concat_ws(",", millis, *place, user, F.lit("")))
        .when(
            F.col("event_type") == "purchase",
            F.concat_ws(",", millis, *place, user, ad, F.lit("more")),
        )
        .otherwise(F.concat_ws(",", millis, *place, user, ad))
    )
    return (
        _events(spark, folder).join(city_info(spark, folder), "city_id")
        .select(line.alias("value"))
    )


def shop_tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return {
        "user_info": user_info(spark, folder),
        "city_info": city_info(spark, folder),
        "product_info": product_info(spark, folder),
        "user_visit_action": user_visit_action(spark, folder),
    }
