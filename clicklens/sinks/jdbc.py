"""Database tables, written by the executors."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession


def replace_jdbc_table(
    rows: DataFrame, url: str, table: str, properties: Mapping[str, str] | None = None
) -> None:
    """Drop the table if it is there, create it from the rows' columns, and load it."""
    rows.write.mode("overwrite").jdbc(url, table, properties=dict(properties or {}))


def truncate_and_load(
    rows: DataFrame, url: str, table: str, properties: Mapping[str, str] | None = None
) -> None:
    """Empty the table, keeping its definition, and load it in batches."""
    (
        rows.write.mode("overwrite").option("truncate", "true")
        .jdbc(url, table, properties=dict(properties or {}))
    )


def swap_statements(url: str, table: str) -> list[str]:
    """What puts ``<table>_staged`` in the place of ``table``, by the database's dialect."""
    staged, old = f"{table}_staged", f"{table}_old"
    last = table.rpartition(".")[2]  # a new name is given without its schema
    if url.startswith(("jdbc:mysql:", "jdbc:mariadb:")):
        # One statement, which this database carries out as a whole.
        swap = [f"RENAME TABLE {table} TO {old}, {staged} TO {table}"]
    else:
        # One transaction, in databases whose definitions take part in it.
        swap = [f"ALTER TABLE {table} RENAME TO {last}_old", f"ALTER TABLE {staged} RENAME TO {last}"]
    return [f"DROP TABLE IF EXISTS {old}", *swap, f"DROP TABLE {old}"]


def staged_load(
    rows: DataFrame,
    url: str,
    table: str,
    properties: Mapping[str, str] | None = None,
    execute: Callable[[Sequence[str]], None] | None = None,
) -> None:
    """Load a table beside ``table``, which has to exist, then swap the two.

    Until all rows are there ``table`` is as it was; a failure while loading changes nothing.
    The new table has the columns that Spark gives it. ``execute`` runs the swap's statements;
    by default over a connection of the driver, in one transaction.
    """
    given = dict(properties or {})
    replace_jdbc_table(rows, url, f"{table}_staged", given)
    statements = swap_statements(url, table)
    if execute:
        execute(statements)
    else:
        _execute(rows.sparkSession, url, given, statements)


def _execute(
    spark: SparkSession, url: str, properties: Mapping[str, str], statements: Sequence[str]
) -> None:
    known = spark._jvm.java.util.Properties()
    for name, value in properties.items():
        known.setProperty(name, value)
    connection = spark._jvm.java.sql.DriverManager.getConnection(url, known)
    try:
        connection.setAutoCommit(False)
        statement = connection.createStatement()
        for sql in statements:
            statement.execute(sql)
        connection.commit()
    finally:
        connection.close()
