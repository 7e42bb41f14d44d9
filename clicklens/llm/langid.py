"""Language identification: averaged hashed subword embeddings with a linear softmax."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clicklens.llm.common import fitted, named, sampled, share, text_of

LABELLED = 4000  # labelled documents that the model is fitted on, at most
BUCKETS = 1 << 16
SIZES = (1, 2, 3)  # code points of a subword
WIDTH = 16
BLOCK = 1 << 20  # code points at a time
UNKNOWN = "und"


@dataclass
class Languages:
    """``logits`` is the embedding table times the softmax weights: one row per bucket."""

    names: list[str]
    logits: np.ndarray
    bias: np.ndarray
    temperature: float
    least: float  # score below which a prediction is rejected


def subwords(text: str) -> Iterator[np.ndarray]:
    """Buckets of all subwords of the lower-cased text with a space at either end, block by block."""
    code = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "replace"), dtype=np.uint32)
    for start in range(0, len(code), BLOCK):
        for n in SIZES:
            part = code[start:start + BLOCK + n - 1]
            if len(part) < n:
                continue
            h = np.full(len(part) - n + 1, 2166136261 + n, dtype=np.uint32)
            for i in range(n):
                h = (h ^ part[i:len(part) - n + 1 + i]) * np.uint32(2654435761)
                h ^= h >> np.uint32(15)
            yield (h & np.uint32(BUCKETS - 1)).astype(np.int64)


def fit_languages(
    texts: list[str], langs: list[str], epochs: int = 4, rate: float = 0.5, seed: int = 7,
    precision: float = 0.99,
) -> Languages:
    """Stochastic gradient descent over documents; every fifth one is held back to calibrate.

    The temperature makes the held-back log-likelihood largest. The rejection score is the
    lowest above which predictions of the held-back documents reach ``precision``.
    """
    names = sorted(set(langs))
    if not names:
        return Languages([], np.zeros((BUCKETS, 0), np.float32), np.zeros(0), 1.0, 0.0)
    rng = np.random.default_rng(seed)
    table = rng.normal(0, 0.1, (BUCKETS, WIDTH))
    weights, bias = np.zeros((WIDTH, len(names))), np.zeros(len(names))
    docs = []
    for text, lang in zip(texts, langs):
        parts = list(subwords(text))
        found, times = np.unique(np.concatenate(parts), return_counts=True)
        docs.append((found, times / times.sum(), names.index(lang)))
    back = docs[::5] if len(docs) >= 50 else docs
    train = [d for i, d in enumerate(docs) if i % 5] if len(docs) >= 50 else docs
    steps, step = epochs * len(train), 0
    for _ in range(epochs):
        for i in rng.permutation(len(train)):
            found, share, y = train[i]
            hidden = share @ table[found]
            z = hidden @ weights + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[y] -= 1
            lr = rate * (1 - step / steps) + 0.01
            back_hidden = weights @ p
            weights -= lr * np.outer(hidden, p)
            bias -= lr * 0.1 * p
            # A bucket's share of a long text is small; the step makes up for it.
            table[found] -= lr * np.outer(np.minimum(1.0, share * 100), back_hidden)
            step += 1
    logits = (table @ weights).astype(np.float32)
    z = np.array([share @ logits[found] for found, share, _ in back]) + bias
    y = np.array([d[2] for d in back])

    def probabilities(t: float) -> np.ndarray:
        e = np.exp(z / t - (z / t).max(axis=1, keepdims=True))
        return e / e.sum(axis=1, keepdims=True)

    grid = np.geomspace(0.05, 20, 60)
    loss = [-np.log(probabilities(t)[np.arange(len(y)), y] + 1e-12).mean() for t in grid]
    temperature = float(grid[int(np.argmin(loss))])
    p = probabilities(temperature)
    top, right = p.max(axis=1), p.argmax(axis=1) == y
    order = np.argsort(-top, kind="stable")
    good = np.cumsum(right[order]) / np.arange(1, len(y) + 1) >= precision
    least = float(top[order][np.flatnonzero(good)[-1]]) if good.any() else 1.0
    return Languages(names, logits, bias, temperature, least)


def fit_langid(
    docs: DataFrame, labelled: int = LABELLED, id_col: str = "doc_id", text_col: str = "text",
    lang_col: str = "lang",
) -> Languages:
    """The model of the documents that have a language, fitted on ``labelled`` of them at most."""
    rows = docs.select(
        named(lang_col).cast("string").alias("lang"), text_of(text_col).alias("text"),
        named(id_col).alias("id"),
    ).where("lang IS NOT NULL")

    def fit(rows: pd.DataFrame) -> Languages:
        rows = rows.sort_values(["id", "text"], kind="stable")
        return fit_languages(list(rows["text"]), list(rows["lang"]))

    return fitted(sampled(rows, labelled, F.col("id")), fit)


def identified(docs: DataFrame, model: Languages, text_col: str = "text") -> DataFrame:
    """row (the document's own columns), lang_pred, score and rejected of each document.

    The whole text counts. ``lang_pred`` is one of the learned languages, ``und`` for a text
    without letters, a null one, or when nothing was learned; ``score`` is its calibrated
    probability (0 for ``und``), and ``rejected`` says that the score is below what the
    calibration asks for. Repeated rows get the same, an empty table gives no rows.
    """
    shared = share(docs, model)

    def one(text: str, model: Languages) -> tuple[str, float, bool]:
        if not model.names or not any(map(str.isalpha, text)):
            return UNKNOWN, 0.0, True
        total, n = np.zeros(len(model.names)), 0
        for part in subwords(text):
            # Sums of 32-bit rows, in blocks short enough to stay exact to many digits.
            total += model.logits[part].sum(axis=0, dtype=np.float64)
            n += len(part)
        z = (total / n + model.bias) / model.temperature
        p = np.exp(z - z.max())
        p /= p.sum()
        best = int(p.argmax())
        return model.names[best], float(p[best]), bool(p[best] < model.least)

    @F.pandas_udf("lang_pred string, score double, rejected boolean")
    def identify(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = shared.value
        for batch in texts:
            yield pd.DataFrame(
                [one(x, model) for x in batch], columns=["lang_pred", "score", "rejected"])

    return docs.select(F.struct("*").alias("row"), identify(text_of(text_col)).alias("p")).select(
        "row", "p.lang_pred", "p.score", "p.rejected")
