"""Secret scan: candidates by pattern, false positives removed by a random forest."""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clicklens.llm.common import fitted, named, sampled, share, ship_package, text_of, written

LABELLED = 4000  # labelled findings of each kind that the forest is fitted on, at most
TREES, DEPTH = 40, 8
COUNTED = 200_000  # words that a task counts before it hands them on
AT_ONCE = 10_000  # places of a candidate that are looked up at a time
CANDIDATE = re.compile(r"(?<![A-Za-z0-9+/=_\-])[A-Za-z0-9+/=_\-]{16,}")
# Names that a value is given to when it is meant to be secret.
SECRET_NAMES = re.compile(
    r"(token|secret|password|passwd|pwd|api[_-]?key|access[_-]?key|private[_-]?key|credential)"
    r"s?[\"']?\s*[:=]\s*[\"']?$", re.I)
WORD = re.compile(r"[a-z]{3,12}")
ALPHABET = "abcdefghijklmnopqrstuvwxyz0123456789"
FEATURES = (
    "length digits upper lower other changes distinct entropy transition covered quoted assigned "
    "before after line_start path place"
).split()


def tallied(name: str, counts: Counter[str]) -> pd.DataFrame:
    return pd.DataFrame({
        name: pd.Series(list(counts), dtype=object),
        "n": pd.Series(list(counts.values()), dtype="int64")})


def counted_words(texts: DataFrame) -> DataFrame:
    """word and n of all words of all texts (a column ``text``), candidates left out.

    A word is a run of 3 to 12 letters a-z, in lower case; longer runs are cut.
    """
    ship_package(texts.sparkSession)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts: Counter[str] = Counter()
        for batch in batches:
            for text in batch["text"]:
                counts.update(WORD.findall(CANDIDATE.sub(" ", text).lower()))
                if len(counts) >= COUNTED:
                    yield tallied("word", counts)
                    counts.clear()
        yield tallied("word", counts)

    rows = texts.select("text").mapInPandas(count, "word string, n long")
    return written(rows.groupBy("word").agg(F.sum("n").alias("n")), "secret-words")


def transitions(words: DataFrame) -> np.ndarray:
    """Log probabilities of the next character, from the letter pairs of all words (word, n)."""
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pairs: Counter[str] = Counter()
        for batch in batches:
            for word, n in zip(batch["word"], batch["n"]):
                for at in range(len(word) - 1):
                    pairs[word[at:at + 2]] += n
        yield tallied("pair", pairs)

    rows = words.mapInPandas(count, "pair string, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    pairs = np.ones((len(ALPHABET) + 1,) * 2)
    for row in rows.collect():  # two letters: 676 rows at most
        a, b = map(ALPHABET.index, row["pair"])
        pairs[a, b] += row["n"]
    return np.log(pairs / pairs.sum(axis=1, keepdims=True))


def covered(text: str, words: set[str]) -> float:
    """Share of the text that known words cover, longest first from the left."""
    i = hit = 0
    while i < len(text):
        for n in range(min(12, len(text) - i), 2, -1):
            if text[i:i + n] in words:
                hit += n
                i += n
                break
        else:
            i += 1
    return hit / max(1, len(text))


def features(text: str, start: int, end: int, path: str, known: np.ndarray) -> list[float]:
    """What the forest sees of one candidate, its coverage by words left open.

    ``path`` is where the text comes from, ``known`` has the character transitions.
    """
    found = text[start:end]
    low = found.lower()
    kinds = "".join("d" if c.isdigit() else "u" if c.isupper() else "l" if c.islower() else "o"
                    for c in found)
    n = len(found)
    times = np.array(list(Counter(found).values())) / n
    at = [ALPHABET.find(c) for c in low]
    left = text[max(0, start - 60):start]
    right = text[end:end + 40]
    before, after = left.split()[-1:] or [""], right.strip("\"'").split()[:1] or [""]
    return [
        float(n), kinds.count("d") / n, kinds.count("u") / n, kinds.count("l") / n,
        kinds.count("o") / n, sum(a != b for a, b in zip(kinds, kinds[1:])) / n,
        len(times) / n, float(-(times * np.log2(times)).sum()),
        float(known[at[:-1], at[1:]].mean()), 0.0,
        float(left[-1:] in "\"'" and left != "" and right[:1] == left[-1:]),
        float(bool(re.search(r"[:=]\s*[\"']?$", left))),
        float(xxhash.xxh32_intdigest(before[0].lower()) % 1024),
        float(xxhash.xxh32_intdigest(after[0].lower()) % 1024),
        float(start - (text.rfind("\n", max(0, start - 2000), start) + 1) < 2),
        float(xxhash.xxh32_intdigest(path) % 1024), start / max(1, len(text)),
    ]


@dataclass
class Forest:
    """Trees as arrays: feature (or -1 in a leaf), cut, left, right, share of secrets."""

    trees: list[tuple[np.ndarray, ...]]

    def probability(self, x: np.ndarray) -> np.ndarray:
        total = np.zeros(len(x))
        for feature, cut, left, right, value in self.trees:
            node = np.zeros(len(x), dtype=int)
            for _ in range(DEPTH):
                f = feature[node]
                down = np.where(x[np.arange(len(x)), np.maximum(f, 0)] <= cut[node],
                                left[node], right[node])
                node = np.where(f < 0, node, down)
            total += value[node]
        return total / max(1, len(self.trees))


def fit_forest(x: np.ndarray, y: np.ndarray, seed: int = 11) -> Forest:
    """Trees on bootstrap samples, each split the best (Gini) of random features and cuts."""
    rng = np.random.default_rng(seed)

    def tree() -> tuple[np.ndarray, ...]:
        nodes: list[list[float]] = []

        def grow(rows: np.ndarray, depth: int) -> int:
            me, share = len(nodes), float(y[rows].mean())
            nodes.append([-1, 0.0, 0, 0, share])
            if depth == DEPTH or share in (0.0, 1.0) or len(rows) < 4:
                return me
            best = None
            for f in rng.choice(x.shape[1], size=5, replace=False):
                values = x[rows, f]
                for cut in np.unique(rng.choice(values, size=8)):
                    low = values <= cut
                    m = low.sum()
                    if 0 < m < len(rows):
                        a, b = y[rows][low].mean(), y[rows][~low].mean()
                        gini = m * a * (1 - a) + (len(rows) - m) * b * (1 - b)
                        if best is None or gini < best[0]:
                            best = gini, f, cut, low
            if best is None:
                return me
            _, f, cut, low = best
            nodes[me][:2] = [int(f), float(cut)]
            nodes[me][2] = grow(rows[low], depth + 1)
            nodes[me][3] = grow(rows[~low], depth + 1)
            return me

        grow(rng.integers(0, len(y), len(y)), 0)
        a = np.array(nodes)
        return a[:, 0].astype(int), a[:, 1], a[:, 2].astype(int), a[:, 3].astype(int), a[:, 4]

    return Forest([tree() for _ in range(TREES)] if len(y) else [])


def findings(
    docs: DataFrame, known: np.ndarray, id_col: str = "doc_id", text_col: str = "text",
    path_col: str = "source", learn: Column | None = None,
) -> DataFrame:
    """Every candidate of every whole text: id, learn, start, length, digest, low, named, features.

    A candidate is a run of 16 or more letters, digits and + / = _ -. ``named`` says that
    it is given to a name that speaks of a secret; ``digest`` is its sha256; ``low`` is the
    candidate in lower case, which ``with_coverage`` drops; ``learn`` is
    that condition on its document. Null and empty texts have none.
    """
    shared = share(docs, known)

    @F.pandas_udf(
        "array<struct<start: long, length: long, digest: string, low: string, named: boolean, "
        "features: array<double>>>")
    def scan(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        known = shared.value

        def of(text: str, path: str) -> list[dict]:
            return [
                {
                    "start": m.start(), "length": m.end() - m.start(),
                    "digest": hashlib.sha256(m[0].encode()).hexdigest(),
                    "low": m[0].lower(),
                    "named": SECRET_NAMES.search(text, max(0, m.start() - 60), m.start()) is not None,
                    "features": features(text, m.start(), m.end(), path, known),
                }
                for m in CANDIDATE.finditer(text)
            ]

        for texts, paths in batches:
            yield pd.Series([of(*x) for x in zip(texts, paths)])

    path = F.coalesce(named(path_col).cast("string"), F.lit(""))
    rows = docs.select(
        named(id_col).alias("id"), (F.lit(False) if learn is None else learn).alias("learn"),
        scan(text_of(text_col), path).alias("found"))
    return rows.select("id", "learn", F.explode("found").alias("f")).select("id", "learn", "f.*")


def with_coverage(found: DataFrame, words: DataFrame) -> DataFrame:
    """The findings with their share that words (word, n) cover, without ``low``.

    The words that a candidate may hold are looked up by a join, so there may be any number
    of words.
    """
    found = found.withColumn("low_md5", F.md5("low"))
    lows = written(found.select("low_md5", "low").dropDuplicates(["low_md5"]), "secret-lows")

    def parts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for key, low in zip(batch["low_md5"], batch["low"]):
                for begin in range(0, len(low), AT_ONCE):
                    words = set()
                    for i in range(begin, min(len(low), begin + AT_ONCE)):
                        m = WORD.match(low, i)
                        if m:
                            words.update(m[0][:n] for n in range(3, len(m[0]) + 1))
                    yield pd.DataFrame({"word": pd.Series(list(words), dtype=object)}).assign(
                        low_md5=key)

    held = written(lows.mapInPandas(parts, "low_md5 string, word string").distinct(), "secret-parts")
    held = held.join(words.select("word"), "word").groupBy("low_md5").agg(
        F.collect_list("word").alias("words"))

    @F.pandas_udf("double")
    def share_of(texts: pd.Series, known: pd.Series) -> pd.Series:
        return pd.Series([covered(text, set(words)) for text, words in zip(texts, known)], dtype=float)

    shares = written(
        lows.join(held, "low_md5").select("low_md5", share_of("low", "words").alias("covered")),
        "secret-coverage")
    place = FEATURES.index("covered")
    of = F.transform("features", lambda x, i: F.when(
        i == place, F.coalesce("covered", F.lit(0.0))).otherwise(x))
    return found.join(shares, "low_md5", "left").withColumn("features", of).drop(
        "low", "low_md5", "covered")


def scan_secrets(
    docs: DataFrame,
    training: Column,
    labels: DataFrame | None = None,
    id_col: str = "doc_id", text_col: str = "text", path_col: str = "source",
    labelled: int = LABELLED, least: float = 0.5,
) -> DataFrame:
    """Every candidate with its probability: id, start, length, digest, probability, is_secret.

    The forest is fitted on labelled findings of the documents that ``training`` selects
    (a condition on the columns of ``docs``): ``labels`` has id_col, start and is_secret.
    Without them, a finding with digits counts as a secret if it is given to a name that
    speaks of one, any other finding as a false positive. At most ``labelled`` findings of
    each kind are sampled; words and character transitions are counted over all documents
    that ``training`` selects.
    With findings of one kind only, all probabilities are that kind's; with none, 0.
    A null text has no candidate, a null id is carried along, rows that repeat are each
    scanned, and an empty table gives no rows.
    """
    training = F.coalesce(training, F.lit(False))
    words = counted_words(docs.where(training).select(text_of(text_col).alias("text")))
    found = findings(docs, transitions(words), id_col, text_col, path_col, training)
    found = written(with_coverage(written(found, "secret-findings"), words), "secrets")
    if labels is None:
        has_digit = F.element_at("features", 1 + FEATURES.index("digits")) > 0
        judged = found.withColumn("is_secret", F.col("named") & has_digit)
    else:
        given = labels.select(
            named(id_col).alias("of"), F.col("start").alias("at"), F.col("is_secret"))
        judged = found.join(given, (found["id"] == given["of"]) & (found["start"] == given["at"]))
    judged = judged.where("learn").select("is_secret", "features", "id", "start")
    kinds = [sampled(judged.where(F.col("is_secret") == kind), labelled, F.col("id"), F.col("start"))
             for kind in (True, False)]

    def fit(rows: pd.DataFrame) -> Forest:
        rows = rows.sort_values(["id", "start", "is_secret"], kind="stable")
        x = np.array(rows["features"].tolist(), dtype=float).reshape(len(rows), len(FEATURES))
        return fit_forest(x, rows["is_secret"].to_numpy(dtype=float))

    forest = share(docs, fitted(kinds[0].unionByName(kinds[1]), fit))

    @F.pandas_udf("double")
    def probability(batch: pd.Series) -> pd.Series:
        x = np.array(batch.tolist(), dtype=float).reshape(len(batch), len(FEATURES))
        return pd.Series(forest.value.probability(x))

    return found.withColumn("probability", probability("features")).select(
        F.col("id").alias(id_col), "start", "length", "digest", "probability",
        (F.col("probability") >= least).alias("is_secret"))
