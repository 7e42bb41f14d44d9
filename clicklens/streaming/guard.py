"""Click-fraud blacklist: drop listed users' clicks, and list more users.

Two queries work hand in hand. The filter query drops the clicks of users
listed so far and stores the others, one folder per micro-batch. The growth
query streams over these folders, counts per user, day and ad in Spark's state,
and lists users at the threshold. Before each batch the filter waits until
growth is through with all earlier ones, so a user who reaches the threshold in
one batch is dropped from the next batch on, and the rest of that first batch
still passes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from clicklens.functions.fixed import BLACKLIST_THRESHOLD
from clicklens.operators import without_listed
from clicklens.plans.ads import USER_KEYS, users_to_list
from clicklens.sinks import KeyedTable, SharedFolder
from clicklens.sources import parse_clicks, read_clicks, rejected_lines
from clicklens.sources.schemas import AD_CLICK, BLACKLIST, USER_CLICKS
from clicklens.streaming.retention import drop_read
from clicklens.streaming.running import StateOptions, running_counts, start_counting


class ClickGuard:
    """The blacklist's tables under one folder, and the queries that keep them."""

    def __init__(
        self,
        spark: SparkSession,
        folder: str,
        threshold: int = BLACKLIST_THRESHOLD,
        state: StateOptions = StateOptions(),
    ):
        self._spark = spark
        self._folder = folder
        self._threshold = threshold
        self._state = state
        self._clean = SharedFolder(spark, f"{folder}/clean")
        self._rejected = SharedFolder(spark, f"{folder}/rejected")
        self._listed = KeyedTable(spark, f"{folder}/blacklist", BLACKLIST, ["user_id"], 200)
        self._counts = KeyedTable(
            spark, f"{folder}/user_clicks", USER_CLICKS, USER_KEYS, 1000, "day")

    def listed(self) -> DataFrame:
        """The users on the blacklist."""
        return self._listed.read()

    def user_clicks(self) -> DataFrame:
        """Clicks per user, day and ad, of the clicks that passed."""
        return self._counts.read()

    def clean_clicks(self) -> DataFrame:
        """The clicks that passed, as a batch."""
        return (
            self._spark.read.schema(AD_CLICK).option("recursiveFileLookup", "true")
            .parquet(self._clean.path)
        )

    def clean_stream(self) -> DataFrame:
        """The clicks that passed, as a stream."""
        return read_clicks(self._spark, self._clean.path)

    def rejected(self) -> DataFrame:
        """Lines that are no clicks, as text."""
        return (
            self._spark.read.schema("value string").option("recursiveFileLookup", "true")
            .parquet(self._rejected.path)
        )

    def start_growth(self, **trigger) -> StreamingQuery:
        """Count the clicks that passed and list users; by default as soon as there are any."""
        return start_counting(
            running_counts(self.clean_stream(), USER_KEYS), self._grow, f"{self._folder}/checkpoints/growth",
            self._state, trigger=trigger,
        )

    def start_filter(self, lines: DataFrame, growth: StreamingQuery, **trigger) -> StreamingQuery:
        """Parse the lines and store the clicks of users not listed."""

        def pass_on(batch: DataFrame, batch_id: int) -> None:
            if self._clean.has(batch_id):
                return
            growth.processAllAvailable()
            batch.persist()
            try:
                rejected = rejected_lines(batch)
                if not rejected.isEmpty():
                    self._rejected.publish(rejected, batch_id)
                clean = without_listed(parse_clicks(batch), self.listed())
                self._clean.publish(clean, batch_id)
            finally:
                batch.unpersist()

        return (
            lines.writeStream.foreachBatch(pass_on)
            .option("checkpointLocation", f"{self._folder}/checkpoints/filter")
            .trigger(**trigger)
            .start()
        )

    def drop_clean_read(self, *readers: str) -> None:
        """Remove stored clicks that growth and the other ``readers`` (checkpoints) are through with."""
        checkpoints = f"{self._folder}/checkpoints"
        drop_read(
            self._spark, self._clean, f"{checkpoints}/filter", [f"{checkpoints}/growth", *readers])

    def drop_clean_before(self, batch_id: int) -> None:
        """Remove stored clicks of earlier batches, once all queries are through with them."""
        for number in self._clean.numbers():
            if number < batch_id:
                self._clean.drop(number)

    def _grow(self, changed: DataFrame, batch_id: int) -> None:
        self._counts.put(changed, batch_id)
        found = users_to_list(changed, self._threshold)
        if not found.isEmpty():
            self._listed.put(found, batch_id)
