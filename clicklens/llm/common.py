"""Small helpers that the operators of this subpackage share."""

from __future__ import annotations

import pickle
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pandas as pd
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clicklens.session import shared_dir

ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# What lies between words: space, tab, line feed, vertical tab, form feed, carriage return.
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def named(column: str) -> Column:
    """The column of this very name, dots and all."""
    return F.col("`" + column.replace("`", "``") + "`")


def text_of(column: str) -> Column:
    """The text; null counts as empty."""
    return F.coalesce(named(column).cast("string"), F.lit(""))


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, all else as it is.

    Texts of one byte a character take the fast way, which does the same for them.
    """
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(
        F.translate(text, ASCII_UPPER, ASCII_UPPER.lower())
    )


def id_hash(id_column: str) -> Column:
    """crc32 of the id as text; a null id counts as an empty text."""
    return F.crc32(F.coalesce(named(id_column).cast("string"), F.lit("")))


def remainder(id_column: str, divisor: int) -> Column:
    """crc32 of the id as text, modulo ``divisor``; a null id counts as an empty text."""
    return id_hash(id_column) % divisor


def written(rows: DataFrame, purpose: str) -> DataFrame:
    """The rows, stored in the shared folder and read back: lineage ends here."""
    spark = rows.sparkSession
    place = shared_dir(spark, purpose)
    rows.write.parquet(place)
    return spark.read.schema(rows.schema).parquet(place)


def one_of_each(docs: DataFrame, found: DataFrame, id_col: str, content_hash: Column) -> DataFrame:
    """The documents that ``found`` (id, hash, kept) keeps, with all their columns.

    ``content_hash`` is a document's hash in ``found``. One stays of the rows that repeat id
    and hash. Only what goes and what repeats is looked up; it is stored first, and merged
    at every size.
    """
    marks = found.groupBy("id", "hash").agg(
        F.max("kept").alias("repeats"), F.count(F.lit(1)).alias("n")
    ).where("n > 1 OR NOT repeats").select("id", "hash", "repeats")
    marks = written(marks, "marks").hint("merge")
    rows = docs.select(
        F.struct("*").alias("row"), named(id_col).alias("id"), content_hash.alias("hash"))
    same = rows["id"].eqNullSafe(marks["id"]) & (rows["hash"] == marks["hash"])
    single = rows.join(marks, same, "left_anti")
    several = rows.join(marks.where("repeats"), same, "left_semi").dropDuplicates(["id", "hash"])
    return single.unionByName(several).select("row.*")


def ship_package(spark: SparkSession) -> None:
    """Let Python workers import this package, wherever the session's driver was started."""
    context = spark.sparkContext
    if _shipped.get("to") != context.applicationId:
        root = Path(__file__).resolve().parents[1]
        archive = f"{tempfile.mkdtemp(prefix='clicklens-code-')}/{root.name}.zip"
        with zipfile.ZipFile(archive, "w") as packed:
            for module in sorted(root.rglob("*.py")):
                packed.write(module, module.relative_to(root.parent))
        context.addPyFile(archive)
        _shipped["to"] = context.applicationId


_shipped: dict[str, str] = {}

SAMPLE_BITS = 12  # leading bits of the hashes that a sample's rows are counted by, at a time


def share(rows: DataFrame, value: object) -> Broadcast:
    """A value of bounded size, and this package, for the Python workers of ``rows``."""
    ship_package(rows.sparkSession)
    return rows.sparkSession.sparkContext.broadcast(value)


def sampled(rows: DataFrame, bound: int, *keys: Column) -> DataFrame:
    """At most ``bound`` rows, chosen by the hash of ``keys``: the same ones in every run.

    The hashes alone are counted first, by their leading bits, ever more of them, until the
    rows up to some hash are between once and twice ``bound``. Only these are put in order, so
    no task gets more of them, however large the table. Rows of equal keys stay together.
    """
    order = F.xxhash64(*keys)
    smallest, width = -(1 << 63), 64
    before = 0  # rows whose hash is under the range that is counted
    last = None
    while last is None and width > 0:
        end = smallest + (1 << width) - 1
        width = max(0, width - SAMPLE_BITS)
        step = 1 << width
        found = (
            rows.where((order >= smallest) & (order <= end))
            .groupBy(F.shiftright(order, width).alias("head")).count().orderBy("head").collect()
        )
        for head, count in found:
            if before + count >= bound:
                if before + count <= 2 * bound or width == 0:
                    last = (head << width) + step - 1
                else:
                    smallest = head << width
                break
            before += count
        else:
            break  # there are no more than ``bound`` rows
    if last is not None:
        rows = rows.where(order <= last)
    return rows.orderBy(order, *keys).limit(bound)


def fitted(sample: DataFrame, fit: Callable[[pd.DataFrame], object]) -> object:
    """What ``fit`` makes of a bounded sample, worked out in one task of an executor."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts = list(batches)
        rows = pd.concat(parts, ignore_index=True) if parts else pd.DataFrame(columns=columns)
        yield pd.DataFrame({"model": [pickle.dumps(fit(rows))]})

    ship_package(sample.sparkSession)
    columns = sample.columns
    found = sample.coalesce(1).mapInPandas(work, "model binary").first()
    # Spark may find out that there are no rows, and start no task.
    return pickle.loads(found["model"]) if found else fit(pd.DataFrame(columns=columns))
