"""The queries op1 to op13: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clicklens.llm import (
    chunks,
    exact,
    fingerprints,
    langid,
    lm,
    mixing,
    near,
    periodic,
    pieces,
    quality,
    secrets,
    suffixes,
    variants,
)
from clicklens.llm.common import GAP, id_hash, remainder, table, text_of

# Documents searched for near fingerprints: every id divisible by this, against all.
SEARCHED = 50


def op1_quality(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, expected_grade, tail_probability, kept of every document.

    Grades come from the labels: 0 toxic, 1 poor, 2 good.
    """
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    ratings = labels.select(
        "doc_id", quality.grade_of_labels(F.col("quality"), F.col("toxic")).alias("grade"))
    model = quality.fit_quality(docs, ratings)
    return quality.graded(docs, model).select(
        "row.doc_id", "expected_grade", "tail_probability",
        (F.col("tail_probability") >= quality.LEAST).alias("kept"))


def op2_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 of every document; the largest id stays."""
    return exact.exact_groups(table(spark, folder, "documents"), keep="largest").select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256"
    )


def op3_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, size, source_size, target, taken of every document."""
    return mixing.mix_plan(table(spark, folder, "documents")).select(
        F.col("id").alias("doc_id"), "size", "source_size", "target", "taken"
    )


def op4_language(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, held_out, lang_pred, score, rejected of every document."""
    docs = table(spark, folder, "documents")
    model = langid.fit_langid(docs.where(remainder("doc_id", 4) != 2))
    return langid.identified(docs.select("doc_id", "text"), model).select(
        "row.doc_id", "lang_pred", "score", "rejected",
    ).select("doc_id", (remainder("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score", "rejected")


def op5_lm(spark: SparkSession, folder: str) -> DataFrame:
    """Scores of every document by the lattice model and by single tokens."""
    return lm.lm_scores(table(spark, folder, "documents"), remainder("doc_id", 10) != 0)


def op6_pieces(spark: SparkSession, folder: str) -> DataFrame:
    """Digest of every document's N best segmentations, and whether the best one decodes to it."""
    rows = pieces.encoded(table(spark, folder, "documents").select("doc_id", "text"), with_ids=False)
    return rows.select(
        "row.doc_id", "n_pieces", "ids_sha256", "round_trip",
        F.size("best").alias("n_best"), F.col("best.score").alias("scores"),
        F.sha2(F.to_json("best"), 256).alias("best_sha256"))


def op7_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's fingerprint and its edited text's, how alike they are, and the links.

    Documents whose id ``SEARCHED`` divides are searched among all; the others have null links.
    """
    rows = fingerprints.with_edited(table(spark, folder, "documents"))
    rows = fingerprints.with_links(rows, F.col("doc_id") % SEARCHED == 0)
    mine = F.col("fingerprint")
    return rows.select(
        "doc_id", "n_chars", "edited_sha256",
        fingerprints.shown(mine).alias("fingerprint"),
        fingerprints.shown(F.col("edited_fingerprint")).alias("edited_fingerprint"),
        fingerprints.likeness(mine, F.col("edited_fingerprint")).alias("near_edited"),
        fingerprints.likeness(mine, F.col("next_fingerprint")).alias("near_next"),
        "same_documents", "same_id", "near_fingerprints", "near_documents", "near_id",
    )


def op8_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, class_id, kept of every document."""
    return near.near_groups(table(spark, folder, "documents")).select(
        "doc_id", "class_id", "kept")


def op9_secrets(spark: SparkSession, folder: str) -> DataFrame:
    """Every candidate of every document: doc_id, start, length, digest, probability, is_secret."""
    return secrets.scan_secrets(table(spark, folder, "documents"), remainder("doc_id", 4) != 2)


def op10_suffixes(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every document."""
    return suffixes.repeated_spans(table(spark, folder, "documents"))


def with_slips(runs: DataFrame) -> DataFrame:
    """(word) of runs (id, run); where 31 divides the crc32 h of id:run, its letter h % length is left out."""
    h = F.crc32(F.concat(F.coalesce(F.col("id").cast("string"), F.lit("")), F.lit(":"), "run"))
    at = (h % F.char_length("run")).cast("int")
    slip = F.concat(
        F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.char_length("run")))
    return runs.select(F.when(h % 31 == 0, slip).otherwise(F.col("run")).alias("word"))


def op11_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word of all documents."""
    runs = variants.runs_of_letters(table(spark, folder, "documents"))
    return variants.spelling_variants(variants.count_words(with_slips(runs)))


def op12_chunk_encoding(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's number of byte-pair ids, and digests of the ids and the decoded text."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return chunks.chunk_encoded(docs, digest=True).select("row.doc_id", *chunks.DIGEST)


def with_periodic_tail(docs: DataFrame) -> DataFrame:
    """doc_id and text; by the crc32 of its id, every tenth text ends in a stretch that repeats.

    Where the crc32 h ends in 0 and there are n words, words from a = h//10 % n on repeat the
    first p = 1 + (n - a) // (3 + h//10 % 8) of them.
    """
    h = id_hash("doc_id")
    g = F.floor(h / 10)
    words = F.filter(F.split(text_of("text"), GAP), lambda word: word != "")
    n, a, p = F.size("words"), F.col("a"), F.col("p")
    rows = docs.select(
        "doc_id", text_of("text").alias("text"), g.alias("g"),
        F.when(h % 10 == 0, words).alias("words"),
    ).withColumn("a", F.when(n > 0, F.col("g") % n).cast("int"))
    rows = rows.withColumn("p", (1 + F.floor((n - a) / (3 + F.col("g") % 8))).cast("int"))
    tail = F.flatten(F.array_repeat(
        F.slice("words", a + 1, p), (F.floor((n - a) / p) + 1).cast("int")))
    repeated = F.concat(F.slice("words", F.lit(1), a), F.slice(tail, F.lit(1), n - a))
    return rows.select(
        "doc_id", F.when(n > 0, F.concat_ws(" ", repeated)).otherwise(F.col("text")).alias("text"))


def op13_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's number of runs, its greatest run, and digests of the runs and the rest."""
    docs = with_periodic_tail(table(spark, folder, "documents"))
    return periodic.periodic_runs(docs, digest=True).select("row.doc_id", *periodic.DIGEST)


QUERIES = {
    "op1_quality": op1_quality,
    "op2_exact_dedup": op2_exact_dedup,
    "op3_mixing": op3_mixing,
    "op4_language": op4_language,
    "op5_lm": op5_lm,
    "op6_pieces": op6_pieces,
    "op7_fingerprints": op7_fingerprints,
    "op8_near_dedup": op8_near_dedup,
    "op9_secrets": op9_secrets,
    "op10_suffixes": op10_suffixes,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_chunk_encoding": op12_chunk_encoding,
    "op13_periodic_runs": op13_periodic_runs,
}
