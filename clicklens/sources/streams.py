"""Ad-click lines as a stream, and their parsing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clicklens.functions import day_of_millis, split_list
from clicklens.functions.fixed import CLICK_GROUP, CLICK_TOPIC
from clicklens.sources.schemas import AD_CLICK


def read_lines(spark: SparkSession, format: str, **options: str) -> DataFrame:
    """A stream with one text column ``value`` from any built-in source."""
    return (
        spark.readStream.format(format).options(**options).load()
        .select(F.col("value").cast("string").alias("value"))
    )


def read_kafka_lines(
    spark: SparkSession,
    servers: str,
    topic: str = CLICK_TOPIC,
    group_prefix: str = CLICK_GROUP,
    starting_offsets: str = "latest",
    **options: str,
) -> DataFrame:
    """Click lines of a Kafka topic (needs the Kafka connector on the class path).

    Offsets live in each query's checkpoint, not with the broker, so a restart
    continues where the last committed batch ended. Every query gets a group
    of its own: queries that share one may each read only a part of the topic.
    """
    return read_lines(
        spark,
        "kafka",
        **{
            "kafka.bootstrap.servers": servers,
            "subscribe": topic,
            "groupIdPrefix": group_prefix,
            "startingOffsets": starting_offsets,
            **options,
        },
    )


def _fields() -> Column:
    return split_list(F.col("value"))


def _millis() -> Column:
    """The first field, if it is a whole number that fits 64 bits."""
    text = F.get(_fields(), F.lit(0))
    return F.when(text.rlike(r"^[+-]?[0-9]+$"), text.try_cast("bigint"))


def parse_clicks(lines: DataFrame) -> DataFrame:
    """Clicks from lines ``epoch_ms,area,city,user,ad``; more fields are ignored.

    Lines that are no clicks are left out here; ``rejected_lines`` has them.
    """
    fields = F.col("fields")
    return (
        lines.select(_fields().alias("fields"), _millis().alias("ts"))
        .where(F.col("ts").isNotNull() & (F.size(fields) >= 5))
        .select(
            "ts",
            fields[1].alias("area"),
            fields[2].alias("city"),
            fields[3].alias("user_id"),
            fields[4].alias("ads_id"),
            day_of_millis(F.col("ts")).alias("day"),
        )
    )


def rejected_lines(lines: DataFrame) -> DataFrame:
    """Exactly the lines that ``parse_clicks`` leaves out."""
    is_click = _millis().isNotNull() & (F.size(_fields()) >= 5)
    return lines.where(~F.coalesce(is_click, F.lit(False))).select("value")


def read_clicks(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """A stream over stored clicks (columns of ``AD_CLICK``) in a folder's sub-folders."""
    return (
        spark.readStream.schema(AD_CLICK).option("recursiveFileLookup", "true").options(**options)
        .parquet(path)
    )
