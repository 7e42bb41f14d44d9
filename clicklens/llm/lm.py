"""Language-model scores: the probability of a text over all its segmentations into pieces."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clicklens.llm.common import named, share, ship_package, text_of, written
from clicklens.llm.lattice import (
    SPACE,
    Pieces,
    expected_counts,
    load_pieces,
    log_likelihoods,
    marked,
)

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
COMMON = 1 << 18  # words whose counts are broadcast; all others are joined
SHORT_WORD = 100  # bytes of the longest word that is broadcast
ROUNDS = 2
PRIOR = 0.1  # added to each piece's expected count
AT_ONCE = 1 << 18  # words held by a task before it hands them on


def starting_scores(pieces: Pieces) -> np.ndarray:
    """Natural logs that the vocabulary's own scores stand for, adding up to 1 as probabilities.

    A vocabulary of merges scores a piece by minus its rank; ranks follow Zipf's law.
    Scores of a unigram vocabulary are logs already. Bytes are as rare as the rarest piece.
    """
    usable = np.array([bool(t) for t in pieces.texts])
    scores = pieces.scores.astype(float)
    logs = scores if scores[usable].min(initial=0) > -100 else -np.log(2.0 - scores)
    lowest = logs[usable].min(initial=0)
    logs = np.where(usable, logs, -np.inf)
    logs[pieces.byte_ids] = lowest
    top = logs.max()
    return logs - (top + np.log(np.exp(logs - top).sum()))


def words_of(text: bytes) -> list[bytes]:
    """Words of the text with A-Z in lower case; bytes know no other letters and gaps."""
    return text.lower().split()


def word_counts(docs: DataFrame, text_col: str, learn: Column) -> DataFrame:
    """Every word of the whole table with its count in the documents to learn from."""
    ship_package(docs.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[bytes] = Counter()

        def out() -> pa.RecordBatch:
            words = pa.array(held.keys(), pa.binary()).cast(pa.string())
            return pa.RecordBatch.from_arrays(
                [words, pa.array(held.values(), pa.int64())], ["word", "c"])

        for batch in batches:
            for text, learn in zip(batch.column(0).cast(pa.binary()), batch.column(1)):
                words = words_of(text.as_py())
                if learn.as_py():
                    held.update(words)
                else:
                    for word in words:
                        held.setdefault(word, 0)
                if len(held) > AT_ONCE:
                    yield out()
                    held.clear()
        if held:
            yield out()

    rows = docs.select(text_of(text_col).alias("text"), learn.alias("learn"))
    return rows.mapInArrow(count, "word string, c long").groupBy("word").agg(F.sum("c").alias("c"))


def fit_pieces(counts: DataFrame, pieces: Pieces, rounds: int = ROUNDS) -> np.ndarray:
    """Natural logs of the pieces' probabilities and, last, of the end of a word.

    From the vocabulary's own scores, each round takes the expected number of uses of
    each piece over all segmentations of all words learned from. Every different word
    counts once: what is spelled later are the words that were not learned.
    """
    scores = starting_scores(pieces)
    shared_pieces = share(counts, pieces)
    learned = counts.where("c > 0")
    ends = learned.count()
    used = np.where(np.isfinite(scores), PRIOR, 0.0)
    for _ in range(rounds):
        now = share(counts, scores)

        def expect(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            used = np.zeros(len(now.value))
            for batch in batches:
                words = [SPACE + marked(w) for w in batch["word"]]
                used += expected_counts(words, np.ones(len(words)), shared_pieces.value, now.value)
            some = np.flatnonzero(used)
            yield pd.DataFrame({"piece": some, "n": used[some]})

        rows = (
            learned.select("word").mapInPandas(expect, "piece long, n double")
            .groupBy("piece").agg(F.sum("n").alias("n")).collect()
        )
        used = np.where(np.isfinite(scores), PRIOR, 0.0)
        for piece, n in rows:
            used[piece] += n
        with np.errstate(divide="ignore"):
            scores = np.log(used / (used.sum() + ends + PRIOR))
    end = (ends + PRIOR) / (used.sum() + ends + PRIOR)
    return np.append(scores + np.log1p(-end) * (rounds == 0), np.log(end))


def most_frequent(lexicon: DataFrame, common: int) -> DataFrame:
    """At most ``common`` words of the largest counts ``c``, none of them long.

    Words are counted by the size of their count, so that only what is chosen is collected. Of
    the counts that would go beyond ``common`` no word is chosen.
    """
    short = lexicon.where((F.octet_length("word") <= SHORT_WORD) & (F.col("c") > 0))
    size = F.floor(F.log2("c") * 64)
    least, total = None, 0
    for row in short.groupBy(size.alias("size")).count().orderBy(F.desc("size")).collect():
        if total + row["count"] > common:
            break
        least, total = row["size"], total + row["count"]
    return short.where(F.lit(least is not None) & (size >= F.lit(least)))


def lm_scores(
    docs: DataFrame,
    learn: Column,
    vocabulary: str = VOCABULARY,
    id_col: str = "doc_id",
    text_col: str = "text",
    common: int = COMMON,
    rounds: int = ROUNDS,
) -> DataFrame:
    """One row per document: id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    ``learn`` is a condition that says which documents to learn from. A text is its words,
    with A-Z in lower case, and one end, counted as a token. ``base_score`` is the
    log10 probability by single tokens with 0.1 added to each count.

    ``score`` is the log10 probability of the text over all segmentations. A word, after a
    space, is spelled by pieces of the vocabulary in every possible way, up to an end of
    word; a learned word has one arc more, over the whole of it. That arc weighs the
    word's count less an absolute discount, and what the discounts leave is the weight of
    spelling. All ways add up, by forward recursion in log space. Nothing reaches over a
    space, so a text's sum over all segmentations is the product of its words' sums, and
    each different word is worked on once.

    Counts of the ``common`` most frequent words are broadcast, those of all others are
    joined with the documents that use them; the scores do not depend on ``common``.
    Null and empty texts are an end alone. Rows that repeat are scored each by itself, a
    null id is carried along, an empty table gives no rows.
    """
    learn = F.coalesce(learn, F.lit(False))
    pieces = load_pieces(vocabulary)
    counts = written(word_counts(docs, text_col, learn), "lm-counts")
    tokens, distinct, once, twice = counts.agg(
        F.sum("c"), *(F.count(F.when(x, 1)) for x in (
            F.col("c") > 0, F.col("c") == 1, F.col("c") == 2))).first()
    ends = docs.where(learn).count()
    n, v = (tokens or 0) + ends, distinct + (ends > 0)
    discount = min(0.9, max(0.1, once / max(1, once + 2 * twice)))
    # Half a token is added to the ends and half to the spelled words, so that no text is
    # impossible: words, ends and spelling add up to 1.
    end_share, spelled = (ends + 0.5) / (n + 1), (discount * distinct + 0.5) / (n + 1)
    scores = fit_pieces(counts, pieces, rounds)
    shared = share(docs, (pieces, scores))

    def score_words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pieces, scores = shared.value
        for batch in batches:
            words = [SPACE + marked(w) for w in batch["word"]]
            spelling = log_likelihoods(words, pieces, scores[:-1]) + scores[-1] + np.log(spelled)
            whole = np.maximum(batch["c"].to_numpy(dtype=float) - discount, 0.0) / (n + 1)
            with np.errstate(divide="ignore"):
                batch["lp"] = np.logaddexp(np.log(whole), spelling) / np.log(10)
            yield batch

    lexicon = written(counts.mapInPandas(score_words, "word string, c long, lp double"), "lm-words")
    frequent = most_frequent(lexicon, common).toPandas()
    known = share(docs, {
        w.encode(): (c, float(base), lp) for w, c, base, lp in zip(
            frequent["word"], frequent["c"], np.log10(frequent["c"] + 0.1), frequent["lp"])
    })
    end = (int(ends > 0), float(np.log10(ends + 0.1)), float(np.log10(end_share)))
    rows = docs.select(
        F.monotonically_increasing_id().alias("key"), text_of(text_col).alias("text"),
        named(id_col).alias("id"), learn.alias("learn"))
    kind = rows.schema["id"].dataType.simpleString()

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A head for each document, with what the frequent words add, and its other words."""
        found = known.value.get

        def heads(of: pa.RecordBatch, sums: list[tuple]) -> pa.RecordBatch:
            # No word has a space: heads meet no word, and are spread evenly.
            words = pa.array([f" {k}" for k in of.column(0).to_pylist()], pa.string())
            kinds = [pa.int64(), pa.int64(), pa.float64(), pa.float64()]
            added = [pa.array(list(x), k) for x, k in zip(zip(*sums), kinds)]
            zeros = pa.array([0] * len(sums), pa.int64())
            return pa.RecordBatch.from_arrays(
                [of.column(0), words, zeros, *added, of.column(2), of.column(3)], names)

        def rest(of: pa.RecordBatch, keys: list, words: list, times: list) -> pa.RecordBatch:
            kinds = [pa.int64(), pa.int64(), pa.float64(), pa.float64(),
                     of.schema.field(2).type, of.schema.field(3).type]
            return pa.RecordBatch.from_arrays([
                pa.array(keys, pa.int64()), pa.array(words, pa.binary()).cast(pa.string()),
                pa.array(times, pa.int64()), *(pa.nulls(len(keys), k) for k in kinds)], names)

        for batch in batches:
            keys: list[int] = []
            words: list[bytes] = []
            times: list[int] = []
            sums: list[tuple] = []
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary())):
                listed = words_of(text.as_py())
                seen, base, total = end
                for word, tf in Counter(listed).items():
                    entry = found(word)
                    if entry is None:
                        keys.append(key)
                        words.append(word)
                        times.append(tf)
                    else:
                        if entry[0]:
                            seen += tf
                        base += tf * entry[1]
                        total += tf * entry[2]
                sums.append((len(listed) + 1, seen, base, total))
                if len(words) > AT_ONCE:
                    yield rest(batch, keys, words, times)
                    keys, words, times = [], [], []
            if words:
                yield rest(batch, keys, words, times)
            if sums:
                yield heads(batch, sums)

    names = ["key", "word", "tf", "tokens", "known", "base", "score", "id", "learn"]
    parts = rows.mapInArrow(
        score, "key long, word string, tf long, tokens long, known long, base double, "
        f"score double, id {kind}, learn boolean"
    ).join(lexicon, "word", "left")
    seen = F.when(F.col("c") > 0, F.col("tf")).otherwise(F.lit(0))
    base = F.coalesce(F.col("base"), F.col("tf") * F.log10(F.col("c") + 0.1))
    added = parts.groupBy("key").agg(
        F.max("id").alias("id"), F.max("learn").alias("learn"),
        F.sum("tokens").alias("n_tokens"),
        F.sum(F.coalesce(F.col("known"), seen)).alias("n_known"),
        F.sum(base).alias("base"),
        F.sum(F.coalesce(F.col("score"), F.col("tf") * F.col("lp"))).alias("score"),
    )
    return added.select(
        F.col("id").alias(id_col), (~F.col("learn")).alias("held_out"), "n_tokens", "n_known",
        F.lit(n).cast("long").alias("train_tokens"),
        (F.col("base") - F.col("n_tokens") * float(np.log10(n + 0.1 * (v + 1)))).alias("base_score"),
        "score",
    )
