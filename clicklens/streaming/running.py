"""Running counts kept in Spark's streaming state."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from clicklens.session import STATE_SETTINGS, changed_settings


@dataclass(frozen=True)
class StateOptions:
    """How running counts are kept. A late click always adds to its own day.

    With ``keep_days`` counts leave Spark's state once their day is more than so many days
    older than the newest one; clicks that come still later are added to the stored counts.
    Without, all counts are kept in the state for ever.

    ``partitions`` is the number of state partitions, else the session's number
    of shuffle partitions. It is fixed by a query's first batch for good, so
    choose it for the keys to come: a few per core of the cluster.
    """

    partitions: int | None = None
    keep_days: int | None = None


def running_counts(clicks: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Clicks per key over all batches so far."""
    return clicks.groupBy(*keys).agg(F.count("*").alias("clicks"))


def running_sums(sums: DataFrame, keys: Sequence[str], keep_days: int) -> DataFrame:
    """Sums of ``clicks`` per key so far, of days up to ``keep_days`` before the newest one.

    The watermark is a day behind that: Spark counts what equals it as late.
    """
    day = F.to_timestamp("day", "yyyy-MM-dd")
    return (
        sums.withColumn("at", day).withWatermark("at", f"{keep_days + 1} days")
        .groupBy("at", *keys).agg(F.sum("clicks").alias("clicks")).select(*keys, "clicks")
    )


def start_counting(
    counts: DataFrame,
    store: Callable[[DataFrame, int], None],
    checkpoint: str,
    state: StateOptions,
    output_mode: str = "update",
    trigger: dict | None = None,
) -> StreamingQuery:
    """Keep running counts and give each batch's changed ones to ``store(counts, batch_id)``."""

    def store_whole(batch: DataFrame, batch_id: int) -> None:
        with _whole(batch) as changed:
            store(changed, batch_id)

    writer = (
        counts.writeStream.outputMode(output_mode)
        .foreachBatch(store_whole)
        .option("checkpointLocation", checkpoint)
    )
    if trigger:
        writer = writer.trigger(**trigger)
    settings = dict(STATE_SETTINGS)
    if state.partitions:
        settings["spark.sql.shuffle.partitions"] = str(state.partitions)
    # A query takes its settings from the session when it starts.
    with changed_settings(counts.sparkSession, settings):
        return writer.start()


@contextmanager
def _whole(batch: DataFrame) -> Iterator[DataFrame]:
    """A batch of running counts, to be used any number of times.

    Only partitions that are computed carry their counts forward, so all of
    them are, even if the batch turns out to be stored already.
    """
    batch.persist()
    batch.write.format("noop").mode("overwrite").save()
    try:
        yield batch
    finally:
        batch.unpersist()
