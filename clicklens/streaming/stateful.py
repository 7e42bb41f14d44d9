"""Click-fraud blacklist in one stateful operator: no query waits for another.

A user's state is whether the user is listed, and the clicks per day and ad so far. Spark calls
the operator once per user and micro-batch, with the state as the batch before left it. So the
clicks of a user who was listed then are dropped, and a user who reaches the threshold is
dropped from the next batch on, the rest of this one still passing.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from clicklens.functions.fixed import BLACKLIST_THRESHOLD
from clicklens.plans.ads import USER_KEYS
from clicklens.session import STATE_SETTINGS, changed_settings
from clicklens.sinks import KeyedTable, SharedFolder
from clicklens.sources import parse_clicks, read_clicks, rejected_lines
from clicklens.sources.schemas import AD_CLICK, BLACKLIST, USER_CLICKS
from clicklens.streaming.running import StateOptions

CLICK, COUNT, LISTED, REJECTED = "click", "count", "listed", "rejected"

# One stream of four kinds of rows.
FOUND = T.StructType(
    [T.StructField("kind", T.StringType()), *AD_CLICK.fields,
     T.StructField("clicks", T.LongType()), T.StructField("value", T.StringType())]
)
DAY_MILLIS = 24 * 60 * 60 * 1000


class UserJudge(StatefulProcessor):
    """Passes a user's clicks on, counts them, and lists the user at the threshold.

    Counts that no click has changed for ``keep_days`` days of running time are forgotten, and
    all of them once the user is listed.
    """

    def __init__(self, threshold: int, keep_days: int | None = None):
        self._threshold = threshold
        self._ttl = keep_days * DAY_MILLIS if keep_days is not None else None

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._listed = handle.getValueState("listed", "since_ts bigint")
        self._counts = handle.getMapState(
            "counts", "day string, ads_id string", "clicks bigint", self._ttl)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        if self._listed.exists():
            for _ in rows:
                pass
            return
        user, found, newest = key[0], Counter(), 0
        # Most users have a handful of rows, and what costs is the number of frames: the last
        # clicks, the counts and the listing go on in one.
        out: list[tuple] = []
        for clicks in rows:
            if out:
                yield self._frame(out)
            columns = [clicks[name].tolist() for name in AD_CLICK.names]
            by_name = dict(zip(AD_CLICK.names, columns))
            found.update(zip(by_name["day"], by_name["ads_id"]))
            newest = max(newest, *by_name["ts"])
            out = [(CLICK, *click, None, None) for click in zip(*columns)]
        # A user without counts is asked for none of them: every question is a message.
        known = self._counts.exists()
        for ad, clicks in found.items():
            before = self._counts.getValue(ad) if known else None
            found[ad] = clicks + (before[0] if before else 0)
            out.append(_row(COUNT, user_id=user, day=ad[0], ads_id=ad[1], clicks=found[ad]))
        if max(found.values()) >= self._threshold:
            self._listed.update((newest,))
            if known:
                self._counts.clear()
            out.append(_row(LISTED, user_id=user))
        else:
            for ad, clicks in found.items():
                self._counts.updateValue(ad, (clicks,))
        yield self._frame(out)

    def close(self) -> None:
        pass

    @staticmethod
    def _frame(rows: list[tuple]) -> pd.DataFrame:
        # As objects, so that whole numbers beside nulls stay whole numbers.
        return pd.DataFrame(np.array(rows, dtype=object), columns=FOUND.names)


def _row(kind: str, **values) -> tuple:
    return (kind, *map(values.get, FOUND.names[1:]))


class StatefulGuard:
    """The blacklist's tables under one folder, and the query that keeps them all."""

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

    @property
    def checkpoint(self) -> str:
        return f"{self._folder}/checkpoints/guard"

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

    def judged(self, lines: DataFrame) -> DataFrame:
        """Clicks that pass, changed counts, newly listed users and rejected lines, by ``kind``."""
        found = parse_clicks(lines).groupBy("user_id").transformWithStateInPandas(
            UserJudge(self._threshold, self._state.keep_days), FOUND, "Append",
            "None" if self._state.keep_days is None else "ProcessingTime")
        rejected = rejected_lines(lines)
        nothing = [
            F.lit(None).cast(field.dataType).alias(field.name) for field in FOUND.fields[1:-1]
        ]
        return found.unionByName(rejected.select(F.lit(REJECTED).alias("kind"), *nothing, "value"))

    def start(self, lines: DataFrame, **trigger) -> StreamingQuery:
        """Judge the lines and keep the tables."""
        writer = (
            self.judged(lines).writeStream.foreachBatch(self._store)
            .option("checkpointLocation", self.checkpoint).outputMode("append").trigger(**trigger)
        )
        # Running time alone would make batch after batch, and no run would come to its end.
        settings = {**STATE_SETTINGS, "spark.sql.streaming.noDataMicroBatches.enabled": "false"}
        if self._state.partitions:
            settings["spark.sql.shuffle.partitions"] = str(self._state.partitions)
        with changed_settings(self._spark, settings):
            return writer.start()

    def run_available(self, lines: DataFrame) -> None:
        """Work off all lines there are, then stop."""
        self.start(lines, availableNow=True).awaitTermination()

    def _store(self, batch: DataFrame, batch_id: int) -> None:
        # Every partition has to be worked off, for its state to go on, even if all is stored.
        batch.persist()
        try:
            kinds = {row.kind for row in batch.select("kind").distinct().collect()}

            def of(kind: str) -> DataFrame:
                return batch.where(F.col("kind") == kind)

            if REJECTED in kinds:
                self._rejected.publish(of(REJECTED).select("value"), batch_id)
            if COUNT in kinds:
                self._counts.put(of(COUNT), batch_id)
            if LISTED in kinds:
                self._listed.put(of(LISTED), batch_id)
            self._clean.publish(of(CLICK).select(*AD_CLICK.names), batch_id)
        finally:
            batch.unpersist()
