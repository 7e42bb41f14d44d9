"""Byte-pair encoding by chunks against the tokenizers library on whole texts."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from clicklens.llm import chunks, queries

SF = "/root/testdata/sf0.001"
LETTERS = [
    "a", "B", "é", "é", "́", " ", "\n", "\t", "\x0b", "\x1c", " ", " ", "\u0085",
    "漢", "😀", "1", "2", "'s", "'", "|", "<|endoftext|>", "<|", "endoftext|>", "Σ", "İ", "ß", "‍",
    "the", "가", "ﬁ", "ﷺ", "\x00", "\x7f",
]


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(chunks.vocabulary_path())
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def text_of_letters(pick):
    return "".join(
        pick.choice(LETTERS) * (1 if pick.random() < 0.9 else pick.randint(1, 40))
        for _ in range(pick.randint(0, 120)))


@pytest.mark.parametrize("shortest, longest, bits", [(1, 8, 1), (8, 64, 3), (256, 8192, 10)])
def test_odd_texts_are_encoded_as_by_the_library(monkeypatch, library, shortest, longest, bits):
    """Chunks of a few bytes cut words, special tokens and code points; joins mend that."""
    monkeypatch.setattr(chunks, "SHORTEST", shortest)
    monkeypatch.setattr(chunks, "LONGEST", longest)
    monkeypatch.setattr(chunks, "CUT_BITS", bits)
    pick, own = random.Random(bits), chunks.ChunkEncoder(chunks.vocabulary_path(), 5000, 5000)
    for _ in range(700):
        text = text_of_letters(pick)
        ids = own.encode(text.encode()).tolist()
        assert ids == library.encode(text, add_special_tokens=False).ids, repr(text)
        assert own.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_rolling_hash_depends_on_its_window_only(monkeypatch):
    data = np.random.default_rng(1).integers(0, 256, 5000).astype(np.uint8)
    found = chunks.rolling_hashes(data)
    for shift in (1, 77, 1500):
        assert (chunks.rolling_hashes(data[shift:]) == found[shift:]).all()
    plain = sum((int(x) + 1) * pow(chunks.FACTOR, 31 - i, 1 << 64) for i, x in enumerate(data[:32]))
    assert int(found[0]) == plain % (1 << 64)
    monkeypatch.setattr(chunks, "HASHED", 100)
    assert (chunks.rolling_hashes(data) == found).all()


def test_shared_passages_are_cut_alike():
    pick = random.Random(2)
    words = [("".join(pick.choices("abcdefgh", k=pick.randint(1, 9)))) for _ in range(20_000)]
    passage = " ".join(words[:8000]).encode()
    one = chunks.cut(b"some text before " * 40 + passage)
    two = chunks.cut(" ".join(words[15_000:]).encode() + passage + b" and after")
    assert b"".join(one).endswith(passage)
    shared = sum(len(chunk) for chunk in set(one) & set(two))
    assert shared > 0.8 * len(passage)
    own = chunks.ChunkEncoder(chunks.vocabulary_path())
    first = list(map(own._chunk, one))
    calls = []
    own._encode = lambda words: calls.append(words) or {}
    assert list(map(own._chunk, one)) == first and not calls


def test_query_equals_library(spark, library):
    texts = {d.doc_id: d.text or "" for d in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    found = queries.op12_chunk_encoding(spark, SF).collect()
    assert len(found) == len(texts)
    for r in found:
        ids = library.encode(texts[r.doc_id], add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        assert tuple(r)[1:] == (
            len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
            hashlib.sha256(decoded.encode()).hexdigest())


TEXTS = [
    (1, "Equal texts stay equal. " * 60), (2, None), (3, ""), (4, " \n\t"), (1, "Equal texts stay equal. " * 60),
    (None, "no id"), (5, "ab" * 60_000), (6, "many words " * 60_000), (7, "<|startoftext|>x"),
]
CLASHES = ["row", "route", "ids", "n_tokens", "decoded", "found"]


def test_edges(spark, library):
    docs = spark.createDataFrame(TEXTS, "doc_id long, text string")
    docs = docs.select("*", *(F.lit("x").alias(name) for name in CLASHES))
    encoded = chunks.chunk_encoded(docs)
    assert encoded.columns == ["row", "n_tokens", "ids"]
    assert encoded.schema["row"].dataType.names == docs.columns
    found = chunks.chunk_decoded(encoded).collect()
    assert sorted((r.row.text or "") for r in found) == sorted((text or "") for _, text in TEXTS)
    for r in found:
        ids = library.encode(r.row.text or "", add_special_tokens=False).ids
        assert r.ids == ids and r.n_tokens == len(ids)
        assert r.decoded == library.decode(ids, skip_special_tokens=False)
    assert chunks.chunk_encoded(docs.limit(0)).count() == 0
    assert chunks.chunk_encoded(docs.limit(0), digest=True).count() == 0
    odd = spark.createDataFrame([(None,), ([],), ([10**6, 320],)], "ids array<int>")
    assert [r.decoded for r in chunks.chunk_decoded(odd).collect()] == [
        None, "", library.decode([10**6, 320], skip_special_tokens=False)]
