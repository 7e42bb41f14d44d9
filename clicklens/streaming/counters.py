"""Running counts of the clicks that passed the blacklist, and the top ads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from clicklens.plans.ads import AREA_KEYS, CITY_KEYS, ad_clicks_per_area_city, area_top_ads
from clicklens.sinks import KeyedTable, SharedFolder, SummedTable
from clicklens.sinks.keyed import values_of, with_values
from clicklens.sources.schemas import AREA_TOP_ADS, CITY_CLICKS
from clicklens.streaming.retention import drop_read
from clicklens.streaming.running import (
    StateOptions,
    running_counts,
    running_sums,
    start_counting,
)

COMPACT_EVERY = 200
DROP_EVERY = 20  # batches after which folders that are read are removed


class CityCounts:
    """Clicks per day, area, city and ad.

    With ``state.keep_days`` a first query sums each batch's clicks and parts the sums: those of
    days still open are counted on in Spark's state, by a second query with a watermark; those
    of days that are closed, or are no dates, are added to the stored counts, once per batch. A
    day is closed by what earlier batches have seen, so the state never finds a sum late.
    """

    def __init__(self, spark: SparkSession, folder: str, state: StateOptions = StateOptions()):
        self._spark = spark
        self._folder = folder
        self._state = state
        self._table = KeyedTable(
            spark, f"{folder}/counts", CITY_CLICKS, CITY_KEYS, COMPACT_EVERY, "day")
        self.parting: StreamingQuery | None = None
        if state.keep_days is not None:
            self._late = SummedTable(
                spark, f"{folder}/late", CITY_CLICKS, CITY_KEYS, COMPACT_EVERY, "day")
            self._open = SharedFolder(spark, f"{folder}/open")
            self._newest = SharedFolder(spark, f"{folder}/newest")

    @property
    def checkpoint(self) -> str:
        """Of the query that reads the clicks."""
        return f"{self._folder}/checkpoints/{'counts' if self._state.keep_days is None else 'parting'}"

    def read(self) -> DataFrame:
        if self._state.keep_days is None:
            return self._table.read()
        return (
            self._table.read().unionByName(self._late.read())
            .groupBy(*CITY_KEYS).agg(F.sum("clicks").alias("clicks"))
        )

    def start(
        self, clicks: DataFrame, output_mode: str = "update", **trigger
    ) -> StreamingQuery:
        """Keep the table; in mode "complete" each batch stores every key anew.

        With ``keep_days`` ``parting`` is the query that reads the clicks; with a trigger that
        ends by itself, it is waited for first. The mode is then always "update".
        """
        counts = running_counts(clicks, CITY_KEYS)
        if self._state.keep_days is not None:
            self.parting = (
                clicks.writeStream.foreachBatch(self._part)
                .option("checkpointLocation", self.checkpoint).trigger(**trigger).start()
            )
            if trigger.get("availableNow") or trigger.get("once"):
                self.parting.awaitTermination()
            sums = (
                self._spark.readStream.schema(CITY_CLICKS)
                .option("recursiveFileLookup", "true").parquet(self._open.path)
            )
            counts = running_sums(sums, CITY_KEYS, self._state.keep_days)
            output_mode = "update"
        return start_counting(
            counts, self._store, f"{self._folder}/checkpoints/counts", self._state, output_mode,
            trigger,
        )

    def _store(self, changed: DataFrame, batch_id: int) -> None:
        self._table.put(changed, batch_id)
        if self._state.keep_days is not None and batch_id % DROP_EVERY == 0:
            drop_read(
                self._spark, self._open, self.checkpoint, [f"{self._folder}/checkpoints/counts"])

    def _part(self, batch: DataFrame, batch_id: int) -> None:
        """Sums of open days go to a folder of the batch, the others to the stored counts."""
        if self._open.has(batch_id):
            return
        earlier = [number for number in self._newest.numbers() if number < batch_id]
        before = None
        if earlier:
            before = self._spark.read.schema("day date").parquet(
                self._newest.part(earlier[-1])).first().day
        sums = ad_clicks_per_area_city(batch).persist()
        try:
            date = F.try_to_timestamp("day", F.lit("yyyy-MM-dd")).cast("date")
            is_open = date.isNotNull()
            if before is not None:
                is_open &= date >= F.date_sub(F.lit(before), self._state.keep_days)
            is_open = F.coalesce(is_open, F.lit(False))
            late = sums.where(~is_open)
            if not late.isEmpty():
                self._late.put(late, batch_id)
            newest = sums.agg(F.max(date).alias("day"))
            self._newest.publish(
                newest.select(F.greatest("day", F.lit(before).cast("date")).alias("day")), batch_id)
            for number in earlier[:-1]:
                self._newest.drop(number)
            self._open.publish(sums.where(is_open), batch_id)
        finally:
            sums.unpersist()


class AreaTopAds:
    """The ads with the most clicks of each day and area, as JSON text.

    A running count only grows, so an area's new top ads are among its former
    top ads and those whose count this batch changed. Each batch therefore
    looks at these alone, never at all counts.
    """

    def __init__(
        self, spark: SparkSession, folder: str, k: int = 3, state: StateOptions = StateOptions()
    ):
        self._folder = folder
        self._k = k
        self._state = state
        self._table = KeyedTable(
            spark, f"{folder}/top", AREA_TOP_ADS, ["day", "area"], COMPACT_EVERY, "day"
        )

    @property
    def checkpoint(self) -> str:
        return f"{self._folder}/checkpoints/top"

    def read(self) -> DataFrame:
        return self._table.read().select("day", "area", "top3_json")

    def start(self, clicks: DataFrame, **trigger) -> StreamingQuery:
        return start_counting(
            running_counts(clicks, AREA_KEYS), self._merge, self.checkpoint, self._state,
            trigger=trigger,
        )

    def _merge(self, changed: DataFrame, batch_id: int) -> None:
        if self._table.has(batch_id):
            return
        touched = changed.select("day", "area").distinct()
        # Only the touched days of the stored table are read.
        stored = with_values(self._table.read(), "day", values_of(touched, "day"))
        former = stored.join(touched, ["day", "area"], "left_semi").select(
            "day", "area", F.inline("top"), F.lit(False).alias("is_new")
        )
        candidates = (
            former.unionByName(changed.withColumn("is_new", F.lit(True)))
            .groupBy(*AREA_KEYS)
            .agg(F.max("clicks").alias("clicks"), F.max("is_new").alias("is_new"))
        )
        # Where no new count is among the top, the top is as it was.
        top = area_top_ads(candidates, self._k, F.max("is_new").alias("is_new"))
        self._table.put(top.where("is_new"), batch_id)
