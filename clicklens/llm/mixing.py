"""Mixing sources to target weights."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clicklens.llm.common import WORD, named, text_of

WORDS_PER_SLICE = 1_000_000


def source_targets(
    sizes: DataFrame, weights: Sequence[float], share: float, most_epochs: float
) -> DataFrame:
    """Targets of the sources of ``sizes`` (source, source_size): one row each.

    Sources in code-point order, null last, weigh ``weights``, repeating, and share
    ``share`` times all sizes. A target stops at ``most_epochs`` times its source's size;
    the excess is shared again by weight until none is above: in the order of size to
    weight, a source is full as long as its part of what is left reaches its limit.
    """
    everything = Window.orderBy(F.lit(0))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    by_need = Window.orderBy(F.col("most") / F.col("weight"), "place")
    before = by_need.rowsBetween(Window.unboundedPreceding, -1)
    whole = everything.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    weight = F.element_at(
        F.array(*(F.lit(float(w)) for w in weights)), ((F.col("place") - 1) % len(weights) + 1)
    )
    ranked = (
        sizes.withColumn("place", F.row_number().over(by_name))
        .withColumn("weight", weight)
        .withColumn("most", F.col("source_size") * F.lit(float(most_epochs)))
        .withColumn("total", F.sum("source_size").over(whole) * F.lit(float(share)))
        .withColumn("left", F.col("total") - F.coalesce(F.sum("most").over(before), F.lit(0.0)))
        .withColumn("open", F.sum("weight").over(whole)
                    - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
        .withColumn("each", F.col("left") / F.col("open"))
        .withColumn("full", F.col("most") <= F.col("each") * F.col("weight"))
    )
    first_open = F.min(F.when(~F.col("full"), F.struct(
        (F.col("most") / F.col("weight")).alias("need"), "place", "each"))).over(whole)
    return ranked.withColumn("first", first_open).select(
        "source", "source_size", "place",
        F.coalesce(
            F.least(F.col("first.each") * F.col("weight"), F.col("most")), F.col("most")
        ).alias("target"),
    )


def mix_plan(
    docs: DataFrame,
    weights: Sequence[float] = (3, 1, 2),
    share: float = 1.5,
    most_epochs: float = 2.0,
    seed: str = "mix",
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    words_per_slice: int = WORDS_PER_SLICE,
) -> DataFrame:
    """How much of each document the mix takes: row, id, size, source_size, target,
    epochs, part, taken.

    ``row`` holds the document's own columns, ``size`` its words; ``epochs`` counts whole
    copies and ``part`` the words of one more, cut copy. A source's taken words are its
    target, rounded to whole words.

    Every document has a hash-random key. A source's documents are dealt into slices by
    key, about ``words_per_slice`` words each, so a source with a third of all rows is
    many slices; words are summed per slice, prefix sums over slices and inside slices
    give each document's place, and the source is cut at its budget.

    A null text has no words, null sources form one source, a null id is an id like any
    other. Rows that are the same in id and text have the same key and are taken in any
    order, which changes nothing in the result. An empty table gives no rows.
    """
    rows = docs.select(
        F.struct("*").alias("row"),
        named(id_col).alias("id"),
        named(source_col).cast("string").alias("source"),
        F.regexp_count(text_of(text_col), F.lit(WORD)).cast("long").alias("size"),
        F.md5(F.concat_ws(":", F.lit(seed), named(id_col).cast("string"), text_of(text_col)))
        .alias("key"),
    )
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = source_targets(sizes, weights, share, most_epochs)
    budget = F.round("target").cast("long")
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0)
    targets = (
        targets.withColumn("epochs", epochs.cast("long"))
        .withColumn("rest", budget - F.col("epochs") * F.col("source_size"))
        .withColumn("slices", F.greatest(F.lit(1.0), F.ceil(F.col("source_size") / words_per_slice)))
        .withColumnRenamed("source", "of_source")
    )
    key_part = F.conv(F.substring("key", 1, 8), 16, 10).cast("double") / float(2**32)
    placed = rows.join(targets, rows["source"].eqNullSafe(F.col("of_source"))).withColumn(
        "slice", F.floor(key_part * F.col("slices")).cast("long")
    )
    in_source = Window.partitionBy("place").orderBy("slice")
    starts = (
        placed.groupBy("place", "slice").agg(F.sum("size").alias("words"))
        .withColumn("start", F.sum("words").over(in_source) - F.col("words"))
        .select("place", "slice", "start")
    )
    in_slice = (
        Window.partitionBy("place", "slice").orderBy("key")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    before = F.col("start") + F.sum("size").over(in_slice) - F.col("size")
    part = F.greatest(F.lit(0), F.least(F.col("size"), F.col("rest") - before))
    return (
        placed.join(starts, ["place", "slice"])
        .withColumn("part", part.cast("long"))
        .select("row", "id", "size", "source_size", "target", "epochs", "part",
                (F.col("epochs") * F.col("size") + F.col("part")).alias("taken"))
    )


def mixed(docs: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """The documents of the mix, repeated as planned, with their own columns.

    The copy at a source's cut keeps its first words only.
    """
    plan = mix_plan(docs, text_col=text_col, **options)
    whole = F.when(F.col("part") >= F.col("size"), 1).otherwise(0)
    copies = plan.where("taken > 0").select(
        "row", "size", "part",
        F.explode(F.sequence(F.lit(1), (F.col("epochs") + F.when(F.col("part") > 0, 1).otherwise(0))
                             .cast("int"))).alias("copy"),
        (F.col("epochs") + whole).alias("complete"),
    )
    words = F.regexp_extract_all(
        F.col("row").getField(text_col), F.lit(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+"), 0)
    cut = F.array_join(F.slice(words, F.lit(1), F.greatest(F.col("part"), F.lit(1)).cast("int")), "")
    text = F.when(F.col("copy") <= F.col("complete"), F.col("row").getField(text_col)).otherwise(cut)
    return copies.withColumn("row", F.col("row").withField(f"`{text_col}`", text)).select("row.*")
