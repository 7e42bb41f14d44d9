"""Ad-click sums and lists, for stored clicks and inside the streaming jobs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clicklens.functions import pairs_json
from clicklens.functions.fixed import BLACKLIST_THRESHOLD
from clicklens.operators import top_within

USER_KEYS = ["user_id", "day", "ads_id"]
CITY_KEYS = ["day", "area", "city", "ads_id"]
AREA_KEYS = ["day", "area", "ads_id"]


def user_ad_clicks(clicks: DataFrame) -> DataFrame:
    """Clicks of each user on each ad per day."""
    return clicks.groupBy(*USER_KEYS).agg(F.count("*").alias("clicks"))


def users_to_list(counts: DataFrame, threshold: int = BLACKLIST_THRESHOLD) -> DataFrame:
    """Users with at least ``threshold`` clicks on one ad on one day."""
    return counts.where(F.col("clicks") >= threshold).select("user_id").distinct()


def ad_clicks_per_area_city(clicks: DataFrame) -> DataFrame:
    """Clicks per day, area, city and ad."""
    return clicks.groupBy(*CITY_KEYS).agg(F.count("*").alias("clicks"))


def ad_totals_per_area(city_counts: DataFrame) -> DataFrame:
    """Clicks per day, area and ad, from the counts per city."""
    return city_counts.groupBy(*AREA_KEYS).agg(F.sum("clicks").alias("clicks"))


def area_top_ads(area_counts: DataFrame, k: int = 3, *also: Column) -> DataFrame:
    """(day, area, top, top3_json): at most ``k`` ads with the most clicks, in order.

    ``also`` are further aggregates over these ads.
    """
    order = [F.desc("clicks"), F.asc("ads_id")]
    in_order = F.array_sort(F.collect_list(F.struct("position", "ads_id", "clicks")))
    ads = F.transform(in_order, lambda ad: F.struct(ad["ads_id"], ad["clicks"]))
    return (
        top_within(area_counts, ["day", "area"], order, k)
        .groupBy("day", "area").agg(ads.alias("top"), *also)
        .withColumn("top3_json", pairs_json(F.col("top"), "ads_id", "clicks"))
    )


def count_fields(counts: DataFrame, keys: Sequence[str] = CITY_KEYS) -> DataFrame:
    """Counts as (field, value) texts, the field's parts joined by ":"."""
    return counts.select(
        F.concat_ws(":", *keys).alias("field"), F.col("clicks").cast("string").alias("value")
    )
