"""The ad-click jobs together: blacklist, counts per city, top ads per area."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from clicklens.functions.fixed import BATCH_INTERVAL, BLACKLIST_THRESHOLD
from clicklens.streaming.counters import AreaTopAds, CityCounts
from clicklens.streaming.guard import ClickGuard
from clicklens.streaming.running import StateOptions
from clicklens.streaming.supervisor import Supervisor


class AdJobs:
    """All jobs' tables and checkpoints under one folder that every executor can reach.

    Starting them again on the same folder continues where they stopped.
    """

    def __init__(
        self,
        spark: SparkSession,
        folder: str,
        threshold: int = BLACKLIST_THRESHOLD,
        state: StateOptions = StateOptions(),
    ):
        self._spark = spark
        self.guard = ClickGuard(spark, f"{folder}/guard", threshold, state)
        self.city_counts = CityCounts(spark, f"{folder}/city", state)
        self.area_top = AreaTopAds(spark, f"{folder}/area", state=state)

    def start(self, lines: DataFrame, interval: str = BATCH_INTERVAL) -> list[StreamingQuery]:
        """Run for good, with a micro-batch per interval."""
        growth = self.guard.start_growth(processingTime=interval)
        return [
            growth,
            self.guard.start_filter(lines, growth, processingTime=interval),
            self.city_counts.start(self.guard.clean_stream(), processingTime=interval),
            self.area_top.start(self.guard.clean_stream(), processingTime=interval),
        ]

    def supervisor(
        self, lines: DataFrame, interval: str = BATCH_INTERVAL, max_restarts: int = 3,
        pause: float = 5.0,
    ) -> Supervisor:
        """Runs the jobs for good; if a query fails, all are stopped and started again."""
        names = ("growth", "filter", "city", "area")

        def start() -> dict[str, StreamingQuery]:
            queries = dict(zip(names, self.start(lines, interval)))
            if self.city_counts.parting is not None:
                queries["parting"] = self.city_counts.parting
            return queries

        return Supervisor(self._spark, start, max_restarts, pause)

    def wait(self, timeout: float | None = None) -> None:
        """Until a query ends or fails, or for ``timeout`` seconds."""
        self._spark.streams.awaitAnyTermination(timeout)

    def drop_clean_read(self) -> None:
        """Remove the stored clicks that all jobs are through with; safe while they run."""
        self.guard.drop_clean_read(self.city_counts.checkpoint, self.area_top.checkpoint)

    def run_available(self, lines: DataFrame, counters: bool = True) -> None:
        """Work off all lines there are, then stop."""
        self.filter_available(lines)
        if counters:
            clean = self.guard.clean_stream
            for query in (
                self.city_counts.start(clean(), availableNow=True),
                self.area_top.start(clean(), availableNow=True),
            ):
                query.awaitTermination()

    def filter_available(self, lines: DataFrame) -> None:
        """Only the blacklist's part of ``run_available``."""
        growth = self.guard.start_growth()
        try:
            self.guard.start_filter(lines, growth, availableNow=True).awaitTermination()
            growth.processAllAvailable()
        finally:
            growth.stop()
