"""Exact duplicates by 128-bit content hash, with bytes compared inside groups."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clicklens.llm.common import ascii_lower, named, one_of_each, text_of, written


def exact_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep: str = "smallest",
    content_hash: Callable[[Column], Column] = F.md5,
) -> DataFrame:
    """One row per document: id, keep_id, group_size, kept, text_sha256, text_md5.

    Texts are equal when identical after lower-casing A-Z. Documents meet by the 128-bit
    hash of that form; each is then compared, byte for byte, with the text of its group's
    stable id, and what only shares the hash is grouped again by the text itself.

    A group's rows meet only in joins with one row per group, which Spark splits when one
    group is large. Null texts are empty texts. A null id is kept only where its group has
    no other; rows that repeat both id and text all carry ``kept`` when their id is the
    one that stays (``drop_copies`` leaves one of them). Other columns are not looked at,
    and an empty table gives an empty result.

    ``keep`` is "smallest" or "largest"; ``content_hash`` is only changed by tests.
    """
    choose = {"smallest": F.min, "largest": F.max}[keep]
    rows = docs.select(named(id_col).alias("id"), ascii_lower(text_of(text_col)).alias("norm"))
    rows = rows.withColumn("h", content_hash(F.col("norm")))
    # Stored, and merged at every size, so that Spark can split a hot group's rows.
    groups = written(
        rows.groupBy("h").agg(choose("id").alias("group_keep"), F.count(F.lit(1)).alias("group_n"))
        .where("group_n > 1"), "exact-groups")
    joined = rows.join(groups.hint("merge"), "h", "left").select(
        "id", "h",
        F.when(F.col("group_n").isNull(), F.col("id")).otherwise(F.col("group_keep")).alias("keep_id"),
        F.coalesce("group_n", F.lit(1).cast("long")).alias("n"),
        F.sha2("norm", 256).alias("sha"),
        F.when(F.col("group_n").isNotNull(), F.col("norm")).alias("norm"),
    )
    # Joined by a second column too, so that this join deals its rows anew and a large
    # group can be split here as well.
    heads = (
        joined.where((F.col("n") > 1) & F.col("id").eqNullSafe(F.col("keep_id")))
        .groupBy("h", "n").agg(F.max("norm").alias("head"))
    )
    other = F.col("norm") != F.col("head")
    checked = joined.join(heads.hint("merge"), ["h", "n"], "left").select(
        "id", "h", "keep_id", "n", "sha", F.when(other, F.col("norm")).alias("norm")
    )
    checked = written(checked, "exact")
    strays = checked.where("norm IS NOT NULL").groupBy("h", "norm").agg(
        choose("id").alias("stray_keep"), F.count(F.lit(1)).alias("stray_n")
    )
    lost = strays.groupBy("h").agg(F.sum("stray_n").alias("lost"))
    size = F.coalesce("stray_n", F.col("n") - F.coalesce("lost", F.lit(0)))
    stays = F.when(F.col("stray_n").isNull(), F.col("keep_id")).otherwise(F.col("stray_keep"))
    return (
        checked.join(lost, "h", "left").join(strays, ["h", "norm"], "left")
        .select(
            F.col("id").alias(id_col),
            stays.alias("keep_id"),
            size.alias("group_size"),
            F.col("id").eqNullSafe(stays).alias("kept"),
            F.col("sha").alias("text_sha256"),
            F.col("h").alias("text_md5"),
        )
    )


def drop_copies(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest"
) -> DataFrame:
    """The documents that stay, with all their columns."""
    # By the sha256, which also tells texts apart that only share the 128-bit hash.
    found = exact_groups(docs, id_col, text_col, keep).select(
        F.col(id_col).alias("id"), F.col("text_sha256").alias("hash"), "kept")
    return one_of_each(docs, found, id_col, F.sha2(ascii_lower(text_of(text_col)), 256))
