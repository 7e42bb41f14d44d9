"""Spelling variants against brute force over all pairs."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from clicklens.llm import queries, variants

SF = "/root/testdata/sf0.001"
SCHEMA = "word string, n bigint"


def plain_near(words):
    """word -> near words, by the words that are equal once a letter is left out or masked."""
    keys = {}
    for word in words:
        for i in range(len(word)):
            keys.setdefault((word[:i] + "\0" + word[i + 1:]), set()).add(word)
    near = {word: set() for word in words}
    for word in words:
        for i in range(len(word)):
            near[word] |= keys[word[:i] + "\0" + word[i + 1:]]
            if (less := word[:i] + word[i + 1:]) in near:
                near[word].add(less)
                near[less].add(word)
        near[word].discard(word)
    return near


def plain_rows(counts, ratio=10):
    near, form = plain_near(counts), {}
    for word, n in counts.items():
        best = min(near[word], key=lambda w: (-counts[w], w), default=None)
        if best is not None and counts[best] >= ratio * n:
            form[word] = best
    rows = []
    for word, n in counts.items():
        root = word
        while root in form:
            root = form[root]
        rows.append((word, form.get(word), root, n, len(near[word]), counts.get(form.get(word))))
    return sorted(rows)


def made_words(pick, count, letters="enaxé"):
    words = set()
    while len(words) < count:
        word = "".join(pick.choices(letters, k=pick.randint(5, 8)))
        words.add(word)
        for _ in range(2):
            i = pick.randrange(len(word))
            words.add(word[:i] + pick.choice(["", "e", "z", word[i] + "n"]) + word[i + 1:])
    return {word: pick.choice([1, 2, 5, 20, 300, 4000]) for word in sorted(words)}


@pytest.mark.parametrize("node, share, leaf", [(8192, 65536, 8), (5, 40, 1), (1, 7, 2)])
def test_equals_brute_force(spark, monkeypatch, rows, node, share, leaf):
    monkeypatch.setattr(variants, "NODE_WORDS", node)
    monkeypatch.setattr(variants, "SHARE_WORDS", share)
    monkeypatch.setattr(variants, "LEAF_WORDS", leaf)
    counts = made_words(random.Random(node), 500)
    frame = spark.createDataFrame(list(counts.items()), SCHEMA)
    found = variants.spelling_variants(frame).collect()
    assert sorted(tuple(r) for r in found) == plain_rows(counts)


def test_search_and_comparison_in_a_task():
    pick = random.Random(3)
    words = sorted(made_words(pick, 700))
    held = variants._Words(words)
    order = np.lexsort(held.counts.T[::-1])
    words = [words[i] for i in order]
    held = variants._Words(words)
    spent = np.zeros(len(words), dtype=np.int8)
    pairs = []
    for a, b in variants.candidates(held.counts, held.counts, spent, 0):
        a, b = variants.near_pairs(held, held, a, b)
        pairs += [frozenset((words[i], words[j])) for i, j in zip(a, b)]
    plain = {frozenset((w, x)) for w, near in plain_near(words).items() for x in near}
    assert len(pairs) == len(set(pairs)) and set(pairs) == plain
    for one in words[:80]:
        for two in words[:80]:
            assert variants.one_edit_apart(one, two) == (frozenset((one, two)) in plain)


def test_levels_count_alike_in_spark_and_in_tasks(spark):
    words = ["", "e" * 200, "jazzÀéÿÞ", "quixotry", "漢字 e!", "mmppnnaaee"]
    frame = spark.createDataFrame([(w,) for w in words], "word string")
    found = frame.select(*[variants._in_group(i) for i in range(variants.DEPTH)]).collect()
    assert [list(r) for r in found] == variants.letter_counts(words).tolist()


def test_query_equals_plain_version(spark):
    counts = Counter()
    for d in spark.read.parquet(f"{SF}/documents.parquet").collect():
        for run in re.findall("[A-Za-zÀ-ÿ]+", d.text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{d.doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += len(run) >= 7
    counts = {word: n for word, n in counts.items() if n >= 2}
    found = queries.op11_spelling_variants(spark, SF)
    assert found.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert sorted(tuple(r) for r in found.collect()) == plain_rows(counts)
    assert len(counts) > 500


def test_edges(spark):
    long = "e" * 90 + "nn"
    table = [
        (None, 3), ("", 1), ("e", None), ("letters", 50), ("letters", 50), ("leters", 1),
        ("lettters", 10), ("letterss", 9), (long, 2), (long + "x", 40), (long[1:], 1),
        ("漢字", 1), ("漢", 30), ("ÀÀÀÀÀÀÀ", 1), ("ÀÀÀÀÀÀ", 10), ("ÀÀÀÀÀÀB", 10),
    ]
    frame = spark.createDataFrame(table, SCHEMA).withColumn("node", F.lit("x"))
    found = variants.spelling_variants(frame).collect()
    counts = Counter()
    for word, n in table:
        if word is not None:
            counts[word] += n or 0
    assert sorted(tuple(r) for r in found) == plain_rows(dict(counts))
    by_word = {r.word: r for r in found}
    assert by_word["leters"].form == "letters" and by_word["ÀÀÀÀÀÀÀ"].form == "ÀÀÀÀÀÀ"
    assert variants.spelling_variants(frame.limit(0)).count() == 0


def test_words_of_texts(spark):
    texts = [
        (1, "Straßenbahn, STRASSENBAHN straßenbahn"), (2, None), (3, ""), (None, "Ästhetik ästhetik×"),
        (4, "short words only"), (5, "a" * 100_000 + " " + "a" * 100_000), (5, "naïveté's naïveté1"),
    ]
    docs = spark.createDataFrame(texts, "doc_id long, text string").withColumn("run", F.lit("x"))
    runs = variants.runs_of_letters(docs)
    found = {(r.word, r.n) for r in variants.count_words(runs.withColumnRenamed("run", "word")).collect()}
    assert found == {("straßenbahn", 2), ("a" * 100_000, 2), ("naïveté", 2)}
    assert variants.count_words(runs.limit(0).withColumnRenamed("run", "word")).count() == 0
