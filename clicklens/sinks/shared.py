"""Folders that are written once, as a whole, and then never changed."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession


class SharedFolder:
    """A folder of sub-folders ``<label>=<number>`` on any file system Spark can write.

    One writer at a time; the file system must rename a folder as a whole.
    """

    def __init__(self, spark: SparkSession, path: str, label: str = "batch_id"):
        self.path = path.rstrip("/")
        self.label = label
        self._new_path = spark._jvm.org.apache.hadoop.fs.Path
        self._files = self._new_path(self.path).getFileSystem(spark._jsc.hadoopConfiguration())
        self._files.mkdirs(self._new_path(self.path))

    def part(self, number: int) -> str:
        return f"{self.path}/{self.label}={number}"

    def has(self, number: int) -> bool:
        return self._files.exists(self._new_path(self.part(number)))

    def numbers(self) -> list[int]:
        """Numbers of the complete sub-folders, ascending."""
        names = [s.getPath().getName() for s in self._files.listStatus(self._new_path(self.path))]
        start = f"{self.label}="
        return sorted(int(name[len(start):]) for name in names if name.startswith(start))

    def publish(
        self,
        rows: DataFrame,
        number: int,
        partition_by: str | list[str] | None = None,
        options: Mapping[str, str] | None = None,
    ) -> None:
        """Write ``rows`` beside the folder, then rename them into place.

        A number that is already there is left alone, so a batch that is run
        again after a failure is not stored twice.
        """
        if self.has(number):
            return
        staging = f"{self.path}.staging/{self.label}={number}"
        writer = rows.write.mode("overwrite").options(**(options or {}))
        if partition_by:
            writer = writer.partitionBy(partition_by)
        writer.parquet(staging)
        moved = self._files.rename(self._new_path(staging), self._new_path(self.part(number)))
        if not moved:
            raise OSError(f"could not move {staging} to {self.part(number)}")

    def drop(self, number: int) -> None:
        self._files.delete(self._new_path(self.part(number)), True)

    def parts(self, number: int) -> list[str]:
        """Names of a sub-folder's partitions."""
        listed = self._files.listStatus(self._new_path(self.part(number)))
        return [s.getPath().getName() for s in listed if s.isDirectory()]

    def drop_part(self, number: int, name: str) -> None:
        # The name is as the file system has it, so it must not be parsed as a path text.
        folder = self._new_path(self.part(number))
        for status in self._files.listStatus(folder):
            if status.getPath().getName() == name:
                self._files.delete(status.getPath(), True)
