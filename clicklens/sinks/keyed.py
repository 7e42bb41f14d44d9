"""Tables by key that are kept from micro-batches."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clicklens.sinks.shared import SharedFolder

# So many values of the partition column are listed to touch only theirs; beyond, all are read.
LISTED = 1000


def values_of(rows: DataFrame, column: str, most: int = LISTED) -> list | None:
    """The distinct values of a column, or None if there are more than ``most``."""
    found = rows.select(column).distinct().limit(most + 1).collect()
    return [row[0] for row in found] if len(found) <= most else None


def with_values(rows: DataFrame, column: str, values: list | None) -> DataFrame:
    """The rows with one of the column's ``values``, null being one of its own; all for None."""
    if values is None:
        return rows
    found = F.col(column).isin([value for value in values if value is not None])
    return rows.where(found | F.col(column).isNull() if None in values else found)


class FoldedTable:
    """Rows by key, from one folder of changes per micro-batch and folds of earlier ones.

    A micro-batch adds one folder with just the keys it changed, so its cost does not grow with
    the table. ``compact`` folds the folders so far. With ``partition_by``, one of the keys, a
    fold has a part per value of it and is written for the values that changed since the fold
    before, so that neither a fold nor a look-up by that key touches the others. Folds have
    Bloom filters on the other keys, for look-ups of single keys.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        schema: T.StructType,
        keys: Sequence[str],
        compact_every: int | None = None,
        partition_by: str | None = None,
    ):
        self._spark = spark
        self._schema = schema
        self._keys = list(keys)
        self._values = [name for name in schema.names if name not in self._keys]
        self._changes = SharedFolder(spark, f"{path}/changes")
        self._folded = SharedFolder(spark, f"{path}/folded")
        self._compact_every = compact_every
        self._partition_by = partition_by

    def put(self, rows: DataFrame, batch_id: int) -> None:
        """Store the rows a batch changed; a batch that is stored already is skipped."""
        if self.has(batch_id):
            return
        self._changes.publish(rows.select(*self._schema.names), batch_id)
        if self._compact_every and len(self._since_fold()) >= self._compact_every:
            self.compact()

    def has(self, batch_id: int) -> bool:
        """Whether the batch is stored, itself or folded."""
        folded = self._folded.numbers()
        return self._changes.has(batch_id) or bool(folded and folded[-1] >= batch_id)

    def read(self) -> DataFrame:
        """The table as it is now (the folders are fixed when this is called)."""
        changes = self._since_fold()
        paths = [self._changes.part(number) for number in changes]
        rows = self._read(self._changes, paths)
        if parts := self._newest_parts():
            paths = [f"{self._folded.part(number)}/{name}" for name, number in parts.items()]
            rows = rows.unionByName(self._read(self._folded, paths))
        return self._combined(rows)

    def compact(self) -> None:
        """Fold all changes and drop what an older fold has already."""
        changes, folded = self._changes.numbers(), self._folded.numbers()
        if not changes or changes[-1] in folded:
            return
        rows, by = self.read(), self._partition_by
        if by:
            paths = [self._changes.part(number) for number in self._since_fold()]
            rows = with_values(rows, by, values_of(self._read(self._changes, paths), by))
            rows = rows.hint("rebalance", F.col(by))
        bloom = {
            f"parquet.bloom.filter.enabled#{key}": "true" for key in self._keys if key != by
        }
        self._folded.publish(rows, changes[-1], by, bloom)
        # The fold before stays, with the changes after it, for readers under way.
        if folded:
            self._drop_before(folded)
            for old in changes:
                if old <= folded[-1]:
                    self._changes.drop(old)

    def _combined(self, rows: DataFrame) -> DataFrame:
        """One row per key of its rows, with their batch in ``_number``."""
        raise NotImplementedError

    def _drop_before(self, folded: list[int]) -> None:
        """Drop what the last of these folds has anew from those before it."""
        newer = set(self._folded.parts(folded[-1])) if self._partition_by else set()
        for number in folded[:-1]:
            names = set(self._folded.parts(number)) if self._partition_by else set()
            if names <= newer:
                self._folded.drop(number)
            else:
                for name in names & newer:
                    self._folded.drop_part(number, name)

    def _newest_parts(self) -> dict[str, int]:
        """The folds' parts by name, each with the newest fold that has it."""
        folded = self._folded.numbers()
        if not self._partition_by:
            return {"": folded[-1]} if folded else {}
        return {name: number for number in folded for name in self._folded.parts(number)}

    def _since_fold(self) -> list[int]:
        newest = (self._folded.numbers() or [-1])[-1]
        return [number for number in self._changes.numbers() if number > newest]

    def _read(self, folder: SharedFolder, paths: list[str]) -> DataFrame:
        if not paths:
            return self._spark.createDataFrame([], self._schema).withColumn(
                "_number", F.lit(None).cast("bigint")
            )
        return (
            self._spark.read.schema(self._schema)
            .option("basePath", folder.path)
            .parquet(*paths)
            .select(*self._schema.names, F.col(folder.label).cast("bigint").alias("_number"))
        )


class KeyedTable(FoldedTable):
    """Newest value per key; a table of keys alone is a set."""

    def _combined(self, rows: DataFrame) -> DataFrame:
        if not self._values:
            return rows.select(*self._keys).distinct()
        newest = [F.max_by(name, "_number").alias(name) for name in self._values]
        return rows.groupBy(*self._keys).agg(*newest).select(*self._schema.names)


class SummedTable(FoldedTable):
    """Sum per key of what the batches add."""

    def _combined(self, rows: DataFrame) -> DataFrame:
        sums = [F.sum(name).alias(name) for name in self._values]
        return rows.groupBy(*self._keys).agg(*sums).select(*self._schema.names)
