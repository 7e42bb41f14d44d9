"""Stored batches of clicks: which of them every query that reads them is through with."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from clicklens.sinks import SharedFolder


def committed(spark: SparkSession, checkpoint: str) -> int | None:
    """The last micro-batch a query has committed; None if there is none."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{checkpoint}/commits")
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(path):
        return None
    names = [status.getPath().getName() for status in files.listStatus(path)]
    return max((int(name) for name in names if name.isdigit()), default=None)


def read_up_to(spark: SparkSession, checkpoint: str, label: str) -> int | None:
    """The last sub-folder ``<label>=<number>`` that a query's committed batches have read.

    The query has one file source, whose log of files lies in its checkpoint.
    """
    last = committed(spark, checkpoint)
    if last is None:
        return None
    entry = F.from_json("value", "path string, batchId bigint")
    number = F.regexp_extract(F.col("entry.path"), rf"{label}=(\d+)/", 1)
    return (
        spark.read.text(f"{checkpoint}/sources/0").select(entry.alias("entry"))
        .where((F.col("entry.batchId") <= last) & (number != ""))
        .agg(F.max(number.cast("bigint"))).first()[0]
    )


def drop_read(
    spark: SparkSession, folder: SharedFolder, writer: str, readers: Sequence[str]
) -> None:
    """Remove the sub-folders that all ``readers`` (checkpoints) have read and committed.

    The newest of them stays, and so does what the ``writer`` has not committed: it may write
    that batch once more after a failure, and finds by the folder that it is there.
    """
    ends = [committed(spark, writer), *(read_up_to(spark, r, folder.label) for r in readers)]
    if None in ends:
        return
    for number in folder.numbers():
        if number < min(ends):
            folder.drop(number)
