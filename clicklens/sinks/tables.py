"""Catalog tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clicklens.sinks.shared import SharedFolder


def save_table(
    rows: DataFrame,
    name: str,
    partition_by: Sequence[str] = (),
    bucket_by: str | None = None,
    buckets: int = 0,
    format: str = "parquet",
    path: str | None = None,
) -> None:
    """Replace a catalog table, definition included.

    Partition the action log by ``date`` so that date bounds prune it. Bucket
    only by a key of which no value has much more than its share of the rows:
    one task reads a whole bucket, which Spark cannot split, so not the log by
    user where some users are hot.
    With a ``path`` the files lie there instead of in the warehouse.

    Rows of a partition or bucket are brought together first, so that there are
    few files, and Spark splits a very large one among several tasks.
    """
    together = [bucket_by] if bucket_by else list(partition_by)
    if together:
        rows = rows.hint("rebalance", *[F.col(column) for column in together])
    writer = rows.write.mode("overwrite").format(format)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if bucket_by:
        writer = writer.bucketBy(buckets, bucket_by).sortBy(bucket_by)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)


def swap_table(
    rows: DataFrame, name: str, path: str, partition_by: Sequence[str] = ()
) -> None:
    """Replace an external Parquet table so that it is there, old or new, at any time.

    The rows are written to a new version folder under ``path``; only then is the table told to
    look there. If writing fails, the table is as it was. Readers under way finish on the old
    version, which stays until the next replacement. With other columns than before, and with
    partitions, which the catalog lists one by one, the definition itself has to be replaced
    and is missing for a moment.
    """
    spark = rows.sparkSession
    columns = [c for c in rows.columns if c not in partition_by] + list(partition_by)
    rows = rows.select(*columns)
    if partition_by:
        rows = rows.hint("rebalance", *[F.col(column) for column in partition_by])
    versions = SharedFolder(spark, path, "version")
    number = (versions.numbers() or [-1])[-1] + 1
    versions.publish(rows, number, list(partition_by) or None)
    place = versions.part(number).replace("'", "\\'")
    if not partition_by and spark.catalog.tableExists(name) and _defined_as(rows, name):
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{place}'")
    else:
        fields = ", ".join(
            f"`{field.name}` {field.dataType.simpleString()}" for field in rows.schema.fields)
        by = f"PARTITIONED BY ({', '.join(f'`{c}`' for c in partition_by)})" if partition_by else ""
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        spark.sql(f"CREATE TABLE {name} ({fields}) USING parquet {by} LOCATION '{place}'")
        if partition_by:
            spark.catalog.recoverPartitions(name)
    for old in versions.numbers()[:-2]:
        versions.drop(old)


def _defined_as(rows: DataFrame, name: str) -> bool:
    found = rows.sparkSession.catalog.listColumns(name)
    wanted = [(field.name, field.dataType.simpleString()) for field in rows.schema.fields]
    return [(c.name, c.dataType) for c in found] == wanted and not any(c.isPartition for c in found)
