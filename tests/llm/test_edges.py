"""Nulls, empty and long texts, ties, repeated rows, clashing columns, empty tables."""

import pytest
from pyspark.sql import functions as F

from clicklens.llm import (
    exact, fingerprints, langid, lm, mixing, near, pieces, quality, secrets, suffixes,
)

LONG = "so many words that one text holds " * 3000
# Columns that operators use as names of their own; they have to come through unharmed.
CLASHES = ["row", "id", "h", "n", "key", "text_sha256", "kept", "size", "range", "label"]
ROWS = [
    (1, "One two three four five six seven.", "en", "a"), (2, None, "en", "a"), (3, "", None, "b"),
    (4, LONG, "en", None), (5, "One two three four five six seven.", "de", "a"),
    (5, "One two three four five six seven.", "de", "a"), (None, "no id at all", None, None),
    (6, "ONE two three four five six seven.", None, "b"), (7, " \n\t▁ é 漢字 \u0000x", "fr", "c"),
]
SCHEMA = "doc_id long, text string, lang string, source string"
NAMES = ["doc_id", "text", "lang", "source", *CLASHES]


@pytest.fixture(params=["rows", "nothing"])
def docs(request, spark):
    frame = spark.createDataFrame(ROWS if request.param == "rows" else [], SCHEMA)
    return frame.select("*", *(F.lit("x").alias(name) for name in CLASHES))


def test_quality(spark, docs):
    ratings = spark.createDataFrame([(1, 2), (3, 0), (None, 1), (9, 1), (4, None)], "doc_id long, grade int")
    graded = quality.graded(docs, quality.fit_quality(docs, ratings)).collect()
    assert len(graded) == docs.count()
    assert all(0 <= r.tail_probability <= 1 and 0 <= r.expected_grade <= 2 for r in graded)
    none = quality.fit_quality(docs, ratings.limit(0))
    kept = quality.selected(docs, none)
    assert kept.columns == NAMES and kept.count() == docs.count()


def test_exact(docs):
    found = exact.exact_groups(docs, keep="largest").collect()
    by_id = {r.doc_id: r for r in found}
    assert len(found) == docs.count()
    if found:
        assert (by_id[1].keep_id, by_id[1].group_size, by_id[1].kept) == (6, 4, False)
        assert (by_id[2].keep_id, by_id[3].keep_id, by_id[3].kept) == (3, 3, True)
        assert by_id[None].kept and by_id[None].group_size == 1
    kept = exact.drop_copies(docs, keep="largest")
    assert kept.columns == NAMES
    assert sorted(r.doc_id or 0 for r in kept.collect()) == ([0, 3, 4, 6, 7] if found else [])


def test_mixing(docs):
    plan = mixing.mix_plan(docs).collect()
    assert len(plan) == docs.count()
    taken = {}
    for r in plan:
        assert 0 <= r.taken <= 2 * r.size
        taken.setdefault((r.row.source, r.target), []).append(r.taken)
    assert all(sum(x) == round(target) for (_, target), x in taken.items())
    mixed = mixing.mixed(docs)
    assert mixed.columns == NAMES
    assert sum(len(r.text.split()) for r in mixed.select("text").collect()) == sum(map(sum, taken.values()))


def test_language(docs):
    found = langid.identified(docs, langid.fit_langid(docs)).collect()
    assert len(found) == docs.count()
    for r in found:
        assert (r.lang_pred == "und") == (not any(map(str.isalpha, r.row.text or "")))
        assert 0 <= r.score <= 1


def test_lm(docs):
    found = lm.lm_scores(docs, F.col("doc_id") != 3, rounds=1, common=2).collect()
    assert len(found) == docs.count()
    for r in found:
        assert r.score < 0 and r.n_known <= r.n_tokens
    if found:
        assert {r.doc_id: r.held_out for r in found}[3] is True
        assert {r.doc_id: r.n_tokens for r in found}[2] == 1


def test_pieces(docs):
    found = pieces.encoded(docs)
    assert found.schema["row"].dataType.names == NAMES
    listed = found.collect()
    assert len(listed) == docs.count() and all(r.round_trip for r in listed)
    back = pieces.decoded(found.select("row.text", "ids").withColumnRenamed("text", "was"))
    assert all((r.row.was or "") == r.text for r in back.collect())


def test_fingerprints(docs):
    found = fingerprints.with_edited(docs, docs_per_bucket=2).collect()
    assert len(found) == docs.count()
    assert fingerprints.simhash(docs).count() == max(0, docs.count() - 1)


def test_near(docs):
    found = near.near_groups(docs).collect()
    assert len(found) == docs.count()
    if found:
        assert {r.doc_id: r.class_id for r in found} == {1: 1, 2: 2, 3: 2, 4: 4, 5: 1, None: None, 6: 1, 7: 7}
    kept = near.drop_near(docs)
    assert kept.columns == NAMES
    assert sorted(r.doc_id for r in kept.where("doc_id IS NOT NULL").collect()) == (
        [1, 2, 4, 7] if found else [])


def test_secrets(docs):
    found = secrets.scan_secrets(docs, F.col("doc_id") > 0)
    assert found.count() == 0


def test_suffixes(docs):
    found = {r.doc_id: r for r in suffixes.repeated_spans(docs).collect()}
    if found:
        assert found[4].n_removed == found[4].n_bytes == len(LONG) and found[4].n_spans == 1
        assert found[1].n_removed == 0 and found[2].n_bytes == 0
        assert None in found
