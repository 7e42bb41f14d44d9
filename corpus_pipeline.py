"""Raw documents to encoded training data, in five stages.

Every stage gets what the one before it kept, as a stored table, and returns documents with
all their columns; the last returns their pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clicklens.llm import exact, mixing, near, pieces, quality
from clicklens.llm.common import table, written

# Segments that an encoding worker remembers, in each of two generations: fewer than the
# operator does by itself, since the workers still hold what the stages before have taken.
REMEMBERED = 60_000


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the quality classifier finds toxic or poor."""
    grade = quality.grade_of_labels(F.col("quality"), F.col("toxic"))
    ratings = table(spark, sf_dir, "labels").select("doc_id", grade.alias("grade"))
    return quality.selected(docs, quality.fit_quality(docs, ratings))


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text."""
    return exact.drop_copies(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates."""
    return near.drop_near(docs)


def in_proportion(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources in their target weights: documents repeat, and one per source is cut."""
    return mixing.mixed(docs).withColumn("n_chars", F.char_length("text").cast("long"))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The piece ids of every document, and the scores of its N best segmentations."""
    return pieces.encoded(docs, remembered=REMEMBERED).select(
        "row.doc_id", "row.lang", "row.source", "n_pieces", "ids", "round_trip",
        F.col("best.score").alias("scores"))


STAGES = [
    ("quality classifier", good_documents),
    ("exact dedup", without_copies),
    ("near dedup", without_near_copies),
    ("mixing", in_proportion),
    ("encoding", encoded),
]

# The first stage fits a model, which SQL cannot: the stages are tested one by one against
# brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return docs
