"""Spark session and the shared folder for written state."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Running counts are kept for ever: keep them off the executors' heap and upload
# only what changed.
STATE_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}

SESSION_SETTINGS = {
    # Days and times are text cut from timestamps, so the zone has to be fixed.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Recording the Python line of every column expression costs milliseconds
    # each, and a streaming batch builds its plans anew.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    **STATE_SETTINGS,
}


def build_session(
    app_name: str,
    master: str | None = None,
    hive: bool = False,
    warehouse_dir: str | None = None,
    settings: Mapping[str, str] | None = None,
) -> SparkSession:
    """A session with this package's settings; ``settings`` win over them."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    if warehouse_dir:
        builder = builder.config("spark.sql.warehouse.dir", warehouse_dir)
    for name, value in {**SESSION_SETTINGS, **(settings or {})}.items():
        builder = builder.config(name, value)
    if hive:
        builder = builder.enableHiveSupport()
    return builder.getOrCreate()


def apply_settings(spark: SparkSession, settings: Mapping[str, str] = SESSION_SETTINGS) -> None:
    """Put the settings on a session that something else has built, where it still can be."""
    for name, value in settings.items():
        if spark.conf.isModifiable(name):
            spark.conf.set(name, value)


@contextmanager
def changed_settings(spark: SparkSession, settings: Mapping[str, str]) -> Iterator[None]:
    """The settings for as long as the block runs."""
    before = {name: spark.conf.get(name, None) for name in settings}
    apply_settings(spark, settings)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder name that every executor can reach.

    It lies under ``spark.checkpoint.dir``. Only a local session, where driver
    and executors are one process, may go without that setting.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        root = tempfile.mkdtemp(prefix="clicklens-")
    return f"{root.rstrip('/')}/clicklens/{purpose}-{uuid.uuid4().hex}"
