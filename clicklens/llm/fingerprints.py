"""SimHash fingerprints of documents, with built-in functions only."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clicklens.llm.common import GAP, named, text_of, written

BITS = 64
HALF = BITS // 2
LANES = (1 << HALF) | 1
LONGEST = 12  # longer terms weigh no more
DOCS_PER_BUCKET = 1000
MOST_BUCKETS = 1 << 20  # rows of 24 bytes that are broadcast


def term_votes(rows: DataFrame, keys: list[str], text: Column) -> DataFrame:
    """Adds up the votes of each text's terms: keys, w (all weight), s0 to s31.

    A term is a word in lower case; its 64-bit hash votes on every bit with the square of
    its length (up to ``LONGEST``), so short words, which all texts of a language share,
    weigh little. Column s_k counts bit k in its lower half and bit k + 32 in its upper;
    texts of over 150 MB would overflow, which Spark reports as an error.
    """
    terms = rows.select(*keys, F.explode(F.split(F.lower(text), GAP)).alias("term"))
    length = F.least(F.char_length("term"), F.lit(LONGEST)).cast("long")
    terms = terms.select(*keys, F.xxhash64("term").alias("h"), (length * length).alias("w"))
    sums = [
        F.sum(F.shiftrightunsigned("h", k).bitwiseAND(F.lit(LANES)) * F.col("w")).alias(f"s{k}")
        for k in range(HALF)
    ]
    return terms.groupBy(*keys).agg(F.sum("w").alias("w"), *sums)


def fingerprint_of_votes() -> Column:
    """The bits that got more than half of the weight, as a long."""
    low = F.lit((1 << HALF) - 1)
    bits = F.lit(0).cast("long")
    for k in range(HALF):
        lower = F.col(f"s{k}").bitwiseAND(low) * 2 > F.col("w")
        upper = F.shiftrightunsigned(F.col(f"s{k}"), HALF) * 2 > F.col("w")
        bits = bits.bitwiseOR(F.when(lower, F.lit(1 << k)).otherwise(F.lit(0)).cast("long"))
        place = (1 << (k + HALF)) if k + HALF < BITS - 1 else -(1 << (BITS - 1))
        bits = bits.bitwiseOR(F.when(upper, F.lit(place)).otherwise(F.lit(0)).cast("long"))
    return bits


def shown(fingerprint: Column) -> Column:
    return F.lpad(F.lower(F.hex(fingerprint)), 16, "0")


def likeness(a: Column, b: Column) -> Column:
    """Share of equal bits."""
    return F.lit(1.0) - F.bit_count(a.bitwiseXOR(b)) / F.lit(float(BITS))


def simhash(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprint of every document: id and fingerprint (a long).

    Equal texts have equal fingerprints; a null text is an empty one, with fingerprint 0.
    Rows that repeat an id and text give one row; a null id is an id like any other.
    """
    rows = docs.select(
        named(id_col).alias("id"), F.xxhash64(text_of(text_col)).alias("content"),
        text_of(text_col).alias("text"),
    ).dropDuplicates(["id", "content"])
    votes = term_votes(rows, ["id", "content"], F.col("text"))
    return votes.select(F.col("id").alias(id_col), fingerprint_of_votes().alias("fingerprint"))


def with_edited(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    docs_per_bucket: int = DOCS_PER_BUCKET,
) -> DataFrame:
    """Every document's fingerprint, its edited text's and the next document's.

    Edited: the last half of the code points (rounded down) is replaced by as many first
    ones of the next document in the order of id (and text, should an id repeat; null ids
    come first); after the last comes the first. Returns id, n_chars, edited_sha256, and
    the longs fingerprint, edited_fingerprint, next_fingerprint.

    Ids are cut into even ranges. The text is shuffled once, by range; a range also gets
    a copy of the first document of the next one, so that neighbours always meet, and all
    else happens in that stage. Only a row per range is broadcast.
    """
    docs = docs.select(named(id_col).cast("long").alias("id"), text_of(text_col).alias("text"))
    lo, hi, n = docs.agg(F.min("id"), F.max("id"), F.count(F.lit(1))).first()
    ranges = max(1, min(MOST_BUCKETS, -(-n // docs_per_bucket)))
    width = -(-((hi or 0) - (lo or 0) + 1) // ranges)
    start = (lo or 0) // width
    docs = docs.withColumn(
        "range", F.coalesce(F.floor(F.col("id") / F.lit(float(width))), F.lit(start - 1)).cast("long")
    )
    everything = Window.orderBy("range")
    firsts = docs.groupBy("range").agg(F.min("id").alias("id"))
    last = F.max("range").over(
        everything.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    firsts = firsts.withColumn("former", F.coalesce(F.lag("range").over(everything), last))
    at = (docs["range"] == firsts["range"]) & docs["id"].eqNullSafe(firsts["id"])
    own = F.struct(docs["range"].alias("range"), F.lit(False).alias("borrowed"))
    lent = F.struct(F.col("former").alias("range"), F.lit(True).alias("borrowed"))
    placed = docs.join(F.broadcast(firsts), at, "left").select(
        docs["id"], "text",
        F.explode(F.when(F.col("former").isNull(), F.array(own)).otherwise(F.array(own, lent)))
        .alias("place"),
    ).select("place.range", "place.borrowed", "id", "text")
    in_range = Window.partitionBy("range").orderBy("borrowed", "id", "text")
    n_chars = F.char_length("text").cast("long")
    half = F.floor(F.col("n_chars") / 2).cast("int")
    edited = F.concat(
        F.expr("substring(text, 1, int(n_chars - floor(n_chars / 2)))"),
        F.expr("substring(coalesce(next_text, ''), 1, int(floor(n_chars / 2)))"),
    )
    edited = F.when(half == 0, F.col("text")).otherwise(edited)
    rows = (
        placed.withColumn("next_text", F.lead("text").over(in_range))
        .withColumn("place", F.row_number().over(in_range))
        .withColumn("n_chars", n_chars)
        .withColumn("edited", edited)
    )
    keys = ["range", "place", "borrowed", "id", "n_chars", "edited_sha256", "kind"]
    rows = rows.select(
        "range", "place", "borrowed", "id", "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        F.posexplode(F.array("text", "edited")).alias("kind", "text"),
    )
    prints = term_votes(rows, keys, F.col("text")).select(*keys, fingerprint_of_votes().alias("f"))
    both = prints.groupBy(*keys[:-1]).agg(
        F.max(F.when(F.col("kind") == 0, F.col("f"))).alias("fingerprint"),
        F.max(F.when(F.col("kind") == 1, F.col("f"))).alias("edited_fingerprint"),
    )
    in_place = Window.partitionBy("range").orderBy("place")
    return (
        both.withColumn("next_fingerprint", F.lead("fingerprint").over(in_place))
        .where(~F.col("borrowed"))
        .select(F.col("id").alias(id_col), "n_chars", "edited_sha256", "fingerprint",
                "edited_fingerprint", "next_fingerprint")
    )


def block_keys(fingerprint: Column, radius: int, blocks: int) -> Column:
    """One (table, key) for every choice of blocks that ``radius`` flipped bits must leave alone."""
    size = -(-BITS // blocks)
    mask = (1 << size) - 1
    tables = []
    for number, chosen in enumerate(combinations(range(blocks), blocks - radius)):
        kept = sum((mask << (size * b)) & ((1 << BITS) - 1) for b in chosen)
        kept = kept - (1 << BITS) if kept >= 1 << (BITS - 1) else kept
        tables.append(F.struct(
            F.lit(number).alias("table"), fingerprint.bitwiseAND(F.lit(kept)).alias("key")))
    return F.array(*tables)


def within_radius(
    searched: DataFrame, stored: DataFrame, radius: int = 3, blocks: int = 6,
    fingerprint: str = "fingerprint",
) -> DataFrame:
    """All pairs (a, b, distance) of a searched and a stored fingerprint that differ in at
    most ``radius`` bits; equal ones are left out.

    Fingerprints are made distinct first, so documents that share one cost nothing. Every
    fingerprint stands in one table for each choice of ``blocks - radius`` of its blocks;
    two within the radius agree in one such table at least, and the join gives a pair in
    the first of them only.
    """
    def tables(rows: DataFrame, name: str) -> DataFrame:
        distinct = rows.select(F.col(fingerprint).alias(name)).where(f"{name} IS NOT NULL").distinct()
        return distinct.select(
            name, F.explode(block_keys(F.col(name), radius, blocks)).alias("t")
        ).select(name, "t.table", "t.key")

    one, two = tables(searched, "a"), tables(stored, "b")
    a, b = F.col("a"), F.col("b")
    distance = F.bit_count(a.bitwiseXOR(b))
    agreed = F.filter(
        F.arrays_zip(block_keys(a, radius, blocks).alias("x"), block_keys(b, radius, blocks).alias("y")),
        lambda t: t["x"] == t["y"],
    )
    first = F.element_at(agreed, 1)["x"]["table"]
    same = (one["table"] == two["table"]) & (one["key"] == two["key"])
    found = one.join(two, same & (a != b) & (distance <= radius) & (first == one["table"]))
    return found.select("a", "b", distance.alias("distance"))


def with_links(
    rows: DataFrame, searched: Column, id_col: str = "doc_id", radius: int = 3, blocks: int = 6,
) -> DataFrame:
    """The rows (id and ``fingerprint``), and what lies within the radius of the searched ones.

    ``searched`` is a condition on the rows; all rows are stored. same_documents counts the
    other rows of the same fingerprint, same_id is the smallest id of all of these, its own
    among them. near_fingerprints counts the other fingerprints within the radius,
    near_documents the rows that have them, near_id is the smallest id of those. Rows that
    are not searched have nulls, searched ones without a link counts of 0.

    Pairs are of distinct fingerprints; rows that share one are counted, never paired.
    """
    rows = written(rows, "fingerprints")
    # Sums are stored before they are joined: only then can Spark split a hot fingerprint's rows.
    groups = written(rows.groupBy("fingerprint").agg(
        F.min(named(id_col)).alias("same_id"), F.count(F.lit(1)).alias("n")), "fingerprint-groups")
    searched = F.coalesce(searched, F.lit(False))
    wanted = rows.where(searched)
    pairs = within_radius(wanted, groups, radius, blocks)
    partners = groups.select(F.col("fingerprint").alias("b"), F.col("same_id").alias("id"), "n")
    near = pairs.join(partners, "b").groupBy("a").agg(
        F.count(F.lit(1)).alias("near_fingerprints"), F.sum("n").alias("near_documents"),
        F.min("id").alias("near_id"))
    near = near.withColumnRenamed("a", "fingerprint")
    zero = F.lit(0).cast("long")
    columns = ["same_documents", "same_id", "near_fingerprints", "near_documents", "near_id"]
    found = groups.join(near, "fingerprint", "left").select(
        "fingerprint", (F.col("n") - 1).alias("same_documents"), "same_id",
        F.coalesce("near_fingerprints", zero).alias("near_fingerprints"),
        F.coalesce("near_documents", zero).alias("near_documents"), "near_id")
    found = written(found.join(wanted.select("fingerprint").distinct(), "fingerprint", "left_semi"),
                    "fingerprint-links")
    others = rows.where(~searched).select(
        "*", *(F.lit(None).cast(found.schema[c].dataType).alias(c) for c in columns))
    return wanted.join(found, "fingerprint").select(*rows.columns, *columns).unionByName(others)
