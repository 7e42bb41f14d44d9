"""Periodic runs against a plain search, and the query against a plain version of its contract."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from clicklens.llm import periodic, queries

SF = "/root/testdata/sf0.001"


def plain_runs(words):
    """(start, length, period) of every run, by comparing all neighbours of every period."""
    found = {}
    for p in range(1, len(words) // 4 + 1):
        i = 0
        while i + p < len(words):
            start = i
            while i + p < len(words) and words[i] == words[i + p]:
                i += 1
            if i - start + p >= max(6, 4 * p):
                found.setdefault((start, i - start + p), p)
            i += 1
    return sorted(((s, n, p) for (s, n), p in found.items()), key=lambda r: (r[0], r[2]))


@pytest.mark.parametrize("points", [1, 50, 1_000_000])
def test_runs_equal_plain_search(monkeypatch, points):
    monkeypatch.setattr(periodic, "GRID_POINTS", points)
    pick = random.Random(points)
    for _ in range(60):
        texts = []
        for _ in range(pick.randint(1, 12)):
            n = pick.choice([0, 3, 5, 6, 7, 20, 60, 200])
            words = [pick.randrange(pick.choice([1, 2, 3, 8])) for _ in range(n)]
            if n > 10 and pick.random() < 0.6:
                a = pick.randrange(n)
                p = 1 + pick.randrange(max(1, (n - a) // 3))
                words[a:] = [words[a + (i - a) % p] for i in range(a, n)]
            texts.append(words)
        found = periodic.find_runs([np.array(words, dtype=np.int64) for words in texts])
        assert [list(map(tuple, runs.tolist())) for runs in found] == list(map(plain_runs, texts))


def test_common_prefixes_of_all_pairs():
    pick = random.Random(5)
    for n in (1, 2, 13, 14, 40, 90):
        symbols = [pick.randrange(2) for _ in range(n - 1)] + [7]
        one, two = np.triu_indices(n, 1)
        lengths = []
        for a, b in zip(one, two):
            k = 0
            while b + k < n and symbols[a + k] == symbols[b + k]:
                k += 1
            lengths.append(k)
        found = periodic.CommonPrefixes(np.array(symbols, dtype=np.int64)).of(one, two)
        assert found.tolist() == lengths


def plain_row(doc_id, text):
    """The query's contract, word by word."""
    words = (text or "").encode().split()
    n, h = len(words), zlib.crc32(("" if doc_id is None else str(doc_id)).encode())
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = plain_runs(words)
    dropped = {i for s, length, p in runs for i in range(s + p, s + length)}
    best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2])) if runs else (None,) * 3
    return (
        doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
        hashlib.sha256("".join(f"{s},{k},{p}\n" for s, k, p in runs).encode()).hexdigest(),
        hashlib.sha256(b" ".join(w for i, w in enumerate(words) if i not in dropped)).hexdigest(),
    )


def test_query_equals_plain_version(spark, rows):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    short = [d for d in docs if len((d.text or "").split()) < 600]
    found = {r[0]: tuple(r) for r in queries.op13_periodic_runs(spark, SF).collect()}
    assert len(found) == len(docs) > len(short) > 100
    assert [found[d.doc_id] for d in short] == [plain_row(*d) for d in short]


TEXTS = [
    (1, "a b " * 4), (2, None), (3, " \n\t\x0b\x0c\r "), (4, "go " * 30_000 + "stop"), (1, "a b " * 4),
    (None, "x x x x x x"), (10, "x x x x x"), (5, "é é é x \x1c a\x1cb"),
]
CLASHES = ["row", "found", "runs", "start", "length", "period", "words", "g", "a", "p"]


def test_edges(spark):
    docs = spark.createDataFrame(TEXTS, "doc_id long, text string")
    docs = docs.select("*", *(F.lit("x").alias(name) for name in CLASHES))
    found = periodic.periodic_runs(docs).collect()
    assert len(found) == len(TEXTS) and found[0].row.asDict().keys() == set(docs.columns)
    by_text = {r.row.text: r for r in found}
    runs = {text: [tuple(run) for run in r.runs] for text, r in by_text.items()}
    assert runs["a b " * 4] == [(0, 8, 2)] and by_text["a b " * 4].collapsed == "a b"
    assert runs["x x x x x x"] == [(0, 6, 1)] and runs["x x x x x"] == []
    assert (by_text[None].n_words, by_text[None].runs, by_text[None].collapsed) == (0, [], "")
    assert by_text[TEXTS[2][1]].collapsed == ""
    assert runs[TEXTS[3][1]] == [(0, 30_000, 1)] and by_text[TEXTS[3][1]].collapsed == "go stop"
    assert by_text[TEXTS[7][1]].n_words == 4
    digests = periodic.periodic_runs(queries.with_periodic_tail(docs), digest=True).collect()
    plain = sorted((plain_row(*t) for t in TEXTS if len(t[1] or "") < 100), key=repr)
    short = [(r.row.doc_id, *r[1:]) for r in digests if r.row.doc_id != 4]
    assert sorted(short, key=repr) == plain
    empty = docs.limit(0)
    assert periodic.periodic_runs(empty).count() == 0
    assert periodic.periodic_runs(queries.with_periodic_tail(empty), digest=True).count() == 0
