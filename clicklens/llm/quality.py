"""Quality classifier: ordinal cumulative-link regression on graded ratings."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clicklens.llm.common import fitted, named, sampled, share, text_of

LABELLED = 8000  # rated documents that the model is fitted on, at most
LEAST = 0.5  # probability of the best grade from which a document is kept
LEAST_Z = 4.5  # how far a term must stand out among the ratings to get a weight
SYMBOLS = "|#$%&*!<>{}=~"
EDGES = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum())


@dataclass
class Ordinal:
    """Weights by 64-bit hash of a term, shared by all grades, and the ordered thresholds."""

    weights: dict[int, float]
    thresholds: list[float]
    grades: int


def terms_of(text: str) -> list[int]:
    """Hashes of a whole text's distinct words and of its shape, in steps."""
    words = text.split()
    distinct = {w.strip(EDGES) for w in set(text.lower().split())}
    n, chars = len(words), max(1, len(text))
    lines = text.split("\n")

    def step(share: float) -> int:
        return int(share * 10)

    shape = (
        f"0 caps {step(sum(map(str.isupper, words)) / max(1, n))}",
        f"0 symbols {step(min(1.0, 10 * sum(map(text.count, SYMBOLS)) / chars))}",
        f"0 distinct {step(np.log1p(len(distinct)) / np.log1p(max(1, n)))}",
        f"0 lines {step(len(set(lines)) / len(lines))}",
        f"0 length {min(12, int(np.log2(n + 1)))}",
        f"0 word {min(30, int(sum(map(len, words)) / max(1, n)))}",
    )
    return [xxhash.xxh3_64_intdigest(t) for t in (*distinct, *shape) if t]


def fit_ordinal(texts: list[str], grades: np.ndarray, n_grades: int, rounds: int = 300) -> Ordinal:
    """Full-batch fit of P(grade <= k) = sigmoid(threshold_k - weights . terms).

    Only terms get a weight whose share among the texts of some grade differs clearly from
    their share among the rest, so what a long text gathers of rare words stays silent.
    """
    docs = [np.array(terms_of(t), dtype=np.uint64) for t in texts]
    if not docs or len(set(grades.tolist())) < 2:
        return Ordinal({}, [-50.0] * (n_grades - 1), n_grades)
    rows = np.repeat(np.arange(len(docs)), [len(d) for d in docs])
    names, cols = np.unique(np.concatenate(docs), return_inverse=True)
    df = np.bincount(cols, minlength=len(names)).astype(float)
    stands_out = np.zeros(len(names), dtype=bool)
    for k in range(n_grades):
        inside = grades == k
        m, rest = inside.sum(), (~inside).sum()
        if m and rest:
            hits = np.bincount(cols[inside[rows]], minlength=len(names))
            share = (df + 1) / (len(docs) + 2)
            spread = np.sqrt(share * (1 - share) * (1 / m + 1 / rest))
            z = np.abs(hits / m - (df - hits) / rest) / spread
            stands_out |= (z > LEAST_Z) & (df >= 5)
    new = np.cumsum(stands_out) - 1
    use = stands_out[cols]
    rows, cols, width = rows[use], new[cols[use]], int(stands_out.sum())
    w, cuts = np.zeros(width), np.linspace(-1.0, 1.0, n_grades - 1)
    padded = np.full(n_grades + 1, np.inf)
    padded[0] = -np.inf
    m1, m2, step = np.zeros(width + n_grades - 1), np.zeros(width + n_grades - 1), 0.05
    for t in range(1, rounds + 1):
        s = np.bincount(rows, weights=w[cols], minlength=len(docs))
        padded[1:-1] = cuts
        up, low = padded[grades + 1] - s, padded[grades] - s
        fu, fl = 1 / (1 + np.exp(-np.clip(up, -500, 500))), 1 / (1 + np.exp(-np.clip(low, -500, 500)))
        mass = np.maximum(fu - fl, 1e-9)
        du, dl = fu * (1 - fu) / mass, fl * (1 - fl) / mass
        g_w = np.bincount(cols, weights=(du - dl)[rows], minlength=width) / len(docs) + 1e-4 * w
        g_cut = np.zeros(n_grades + 1)
        np.add.at(g_cut, grades + 1, -du / len(docs))
        np.add.at(g_cut, grades, dl / len(docs))
        g = np.concatenate([g_w, g_cut[1:-1]])
        m1, m2 = 0.9 * m1 + 0.1 * g, 0.99 * m2 + 0.01 * g * g
        move = step * (m1 / (1 - 0.9**t)) / (np.sqrt(m2 / (1 - 0.99**t)) + 1e-8)
        w, cuts = w - move[:width], np.sort(cuts - move[width:])
    kept = names[stands_out]
    return Ordinal(dict(zip(kept.tolist(), w.tolist())), cuts.tolist(), n_grades)


def grade_of_labels(quality: Column, toxic: Column) -> Column:
    """0 toxic, 1 poor, 2 good."""
    return F.when(toxic == 1, 0).when(quality == 0, 1).when(quality == 1, 2)


def fit_quality(
    docs: DataFrame, ratings: DataFrame, n_grades: int = 3, labelled: int = LABELLED,
    id_col: str = "doc_id", text_col: str = "text", grade_col: str = "grade",
) -> Ordinal:
    """The model of the rated documents, fitted on ``labelled`` of them at most.

    Ratings without a grade or a document are left out; without two grades to tell apart,
    the model gives every document the best grade.
    """
    rated = ratings.select(named(id_col).alias("id"), named(grade_col).cast("int").alias("grade"))
    rated = sampled(rated.where("grade IS NOT NULL AND id IS NOT NULL"), labelled, F.col("id"))
    rows = rated.join(
        docs.select(named(id_col).alias("doc"), text_of(text_col).alias("text")),
        F.col("id") == F.col("doc"),
    ).select("grade", "text", "id")

    def fit(rows: pd.DataFrame) -> Ordinal:
        rows = rows.sort_values(["id", "text"], kind="stable")
        return fit_ordinal(list(rows["text"]), rows["grade"].to_numpy(dtype=int), n_grades)

    return fitted(rows, fit)


def graded(docs: DataFrame, model: Ordinal, text_col: str = "text") -> DataFrame:
    """row (the document's own columns), expected_grade and tail_probability of each document.

    The tail probability is that of the best grade. Whole texts are read; a null text is
    an empty one. Repeated rows are graded alike, an empty table gives no rows.
    """
    shared = share(docs, model)

    @F.pandas_udf("expected_grade double, tail_probability double")
    def grade(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = shared.value
        weight, cuts = model.weights.get, np.array(model.thresholds)
        for batch in texts:
            s = np.array([sum([weight(t, 0.0) for t in terms_of(x)]) for x in batch])
            above = 1 / (1 + np.exp(np.clip(cuts[None, :] - s[:, None], -500, 500)))
            yield pd.DataFrame(
                {"expected_grade": above.sum(axis=1), "tail_probability": above[:, -1]})

    return docs.select(F.struct("*").alias("row"), grade(text_of(text_col)).alias("g")).select(
        "row", "g.expected_grade", "g.tail_probability")


def selected(docs: DataFrame, model: Ordinal, least: float = LEAST, text_col: str = "text") -> DataFrame:
    """The documents whose best grade is at least so probable, with their own columns."""
    return graded(docs, model, text_col).where(F.col("tail_probability") >= least).select("row.*")
