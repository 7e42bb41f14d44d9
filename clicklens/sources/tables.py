"""The four input tables, by name from a catalog or by path from a folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from clicklens.sources.schemas import TABLES


def load_tables(
    spark: SparkSession,
    folder: str | None = None,
    database: str | None = None,
    format: str = "parquet",
    register: bool = True,
) -> dict[str, DataFrame]:
    """Read the input tables; with ``register`` they also become temp views.

    ``folder`` holds one directory per table (a log partitioned by ``date``
    lets date bounds prune it); otherwise the tables are looked up by name.
    """
    tables = {}
    for name, schema in TABLES.items():
        if folder is not None:
            table = spark.read.schema(schema).format(format).load(f"{folder}/{name}")
        else:
            table = spark.table(f"{database}.{name}" if database else name)
        tables[name] = table.select(*schema.names)
        if register:
            tables[name].createOrReplaceTempView(name)
    return tables
