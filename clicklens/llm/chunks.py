"""Byte-pair encoding of texts by chunks that documents share.

A rolling hash over the bytes decides where a text is cut, so equal passages are cut alike
wherever they stand. Documents that have a chunk in common are brought to the same tasks; a
worker encodes a chunk when it first meets it and keeps the ids for later. Cuts fall anywhere,
also into words, so the joins are repaired: what lies around a join is encoded again, over a
window that grows from chunk to chunk until it ends in white space on both sides. No token of
these vocabularies holds white space, so there the chunks' ids and the whole text's agree.
"""

from __future__ import annotations

import hashlib
import os
import re
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clicklens.llm.common import named, ship_package, text_of

VOCABULARY = "word_bpe_49k.json"
WINDOW = 32  # bytes the rolling hash looks at
CUT_BITS = 10  # one byte in 2 ** CUT_BITS ends a chunk
SHORTEST, LONGEST = 256, 8192  # bytes of a chunk, but for the last of a text
HASHED = 1 << 20  # bytes that are hashed at a time
# Bytes of chunks and of words in each of a worker's two generations.
REMEMBERED_CHUNKS, REMEMBERED_WORDS = 32 << 20, 96 << 20
FACTOR = 0x9E3779B97F4A7C15

OVERHEAD = 200  # bytes that remembering something takes besides

MARK = b"\x7f"  # a word that no word without this byte can be taken for
GAPS = (b" ", b"\t", b"\n", b"\v", b"\f", b"\r")
GAP = re.compile(rb"[\x20\x09-\x0d]")


def vocabulary_path(name: str = VOCABULARY) -> str:
    """Where the file of a public tokenizer lies on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def _powers(base: int, count: int) -> np.ndarray:
    steps = np.full(count, base, dtype=np.uint64)
    steps[0] = 1
    return np.multiply.accumulate(steps)


_FORWARD = _powers(FACTOR, HASHED + WINDOW)
_BACKWARD = _powers(pow(FACTOR, -1, 1 << 64), HASHED + WINDOW)


def rolling_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of the ``WINDOW`` bytes up to and with each byte, from byte ``WINDOW`` - 1 on.

    The sum of (byte + 1) * FACTOR ** (distance to the window's end), modulo 2 ** 64, as a
    difference of prefix sums.
    """
    out = np.empty(max(0, len(data) - WINDOW + 1), dtype=np.uint64)
    for start in range(0, len(out), HASHED):
        part = data[start:start + HASHED + WINDOW - 1].astype(np.uint64) + np.uint64(1)
        sums = np.concatenate([[np.uint64(0)], np.cumsum(part * _BACKWARD[:len(part)])])
        count = len(part) - WINDOW + 1
        ends = np.arange(WINDOW - 1, len(part))
        out[start:start + count] = (sums[ends + 1] - sums[ends + 1 - WINDOW]) * _FORWARD[ends]
    return out


def cut(text: bytes) -> list[bytes]:
    """The text's chunks, cut where the rolling hash has ``CUT_BITS`` leading zeros."""
    if len(text) <= SHORTEST:
        return [text] if text else []
    hashes = rolling_hashes(np.frombuffer(text, dtype=np.uint8))
    marks = np.flatnonzero(hashes >> np.uint64(64 - CUT_BITS) == 0) + WINDOW
    chunks, start = [], 0
    for mark in [*marks.tolist(), len(text)]:
        while mark - start > LONGEST:
            chunks.append(text[start:start + LONGEST])
            start += LONGEST
        if mark - start >= SHORTEST or mark == len(text) > start:
            chunks.append(text[start:mark])
            start = mark
    return chunks


class Memo:
    """What has been worked out, the last used of it: two generations of bounded size."""

    def __init__(self, bound: int, size: Callable[[object], int]):
        self._bound = bound
        self._size = size  # bytes that a value takes
        self._young: dict[bytes, object] = {}
        self._old: dict[bytes, object] = {}
        self._held = 0

    def get(self, keys: list[bytes]) -> list:
        """The keys' values; None for what is not remembered."""
        found = list(map(self._young.get, keys))
        if self._old and None in found:
            for i, value in enumerate(found):
                if value is None and (old := self._old.get(keys[i])) is not None:
                    self.put(keys[i], old)
                    found[i] = old
        return found

    def put(self, key: bytes, value: object) -> None:
        if self._held > self._bound:
            self._old, self._young, self._held = self._young, {}, 0
        self._young[key] = value
        self._held += OVERHEAD + len(key) + self._size(value)


class ChunkEncoder:
    """Encodes texts in UTF-8 to ids, and ids to the tokenizer's decoded text."""

    def __init__(
        self, vocabulary: str, chunks: int = REMEMBERED_CHUNKS, words: int = REMEMBERED_WORDS
    ):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the tasks are what runs side by side
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(vocabulary)
        self._tokenizer.no_truncation()
        self._tokenizer.no_padding()
        # With no decoder of its own the tokenizer joins tokens by spaces.
        self._tokens = (
            {i: token for token, i in self._tokenizer.get_vocab(with_added_tokens=True).items()}
            if self._tokenizer.decoder is None else None
        )
        size = 1 + max(self._tokenizer.get_vocab(with_added_tokens=True).values(), default=-1)
        self._numbers = list(map(str, range(size)))
        self._spelled = [self._tokens.get(i) for i in range(size)] if self._tokens is not None else []
        mark = self._encode_one(MARK.decode())
        self._mark = mark[0] if len(mark) == 1 else None
        self._words = Memo(words, len)
        self._chunks = Memo(chunks, lambda entry: sum(map(len, filter(None, entry))))

    def encode(self, text: bytes) -> np.ndarray:
        """The ids of the whole text."""
        parts, window = [], []
        for chunk in cut(text):
            before, ids, after = self._chunk(chunk)
            window.append(before)
            if ids is not None:
                parts += [self._between_gaps(b"".join(window)), ids]
                window = [after]
        parts.append(self._between_gaps(b"".join(window)))
        return np.frombuffer(b"".join(parts), dtype="<u4")

    def decode(self, ids: list[int]) -> str:
        """The text of ids; unknown ones have none."""
        if self._tokens is None:
            return self._tokenizer.decode(ids, skip_special_tokens=False)
        return " ".join([self._tokens[i] for i in ids if i in self._tokens])

    def digests(self, text: bytes) -> tuple[int, str, str]:
        """Number of the text's ids, and SHA-256 of the ids and of their text."""
        ids = self.encode(text).tolist()
        numbers = " ".join(map(self._numbers.__getitem__, ids))
        # Ids that encoding gives are all of the vocabulary.
        decoded = self.decode(ids) if self._tokens is None else " ".join(
            map(self._spelled.__getitem__, ids))
        return len(ids), _sha256(numbers), _sha256(decoded)

    def _chunk(self, chunk: bytes) -> tuple[bytes, bytes | None, bytes]:
        """What stands before its first gap, the ids from there to its last gap, what is after.

        A chunk without a gap is all before, and has no ids of its own.
        """
        entry = self._chunks.get([chunk])[0]
        if entry is None:
            first = GAP.search(chunk)
            if first is None:
                entry = chunk, None, b""
            else:
                start, last = first.start(), max(map(chunk.rfind, GAPS))
                entry = chunk[:start], self._between_gaps(chunk[start:last]), chunk[last:]
            self._chunks.put(chunk, entry)
        return entry

    def _between_gaps(self, text: bytes) -> bytes:
        """The ids of a stretch that gaps or the text's ends enclose, as bytes, word by word."""
        words = text.split()
        found = self._words.get(words)
        if None in found:
            new = self._encode(list(dict.fromkeys(
                word for word, ids in zip(words, found) if ids is None)))
            for word, ids in new.items():
                if len(word) <= SHORTEST:
                    self._words.put(word, ids)
            found = [new[word] if ids is None else ids for word, ids in zip(words, found)]
        return b"".join(found)

    def _encode(self, words: list[bytes]) -> dict[bytes, bytes]:
        """Words as one text, which is much faster than one by one, with a mark between them."""
        plain = [word for word in words if MARK not in word and b"<|" not in word]
        made = {}
        if self._mark is not None and len(plain) > 1:
            text = (b" " + MARK + b" ").join(plain).decode()
            ids = array("I", self._encode_one(text))
            found = np.flatnonzero(np.frombuffer(ids, dtype=np.uint32) == self._mark)
            if len(found) == len(plain) - 1:
                data, ends = ids.tobytes(), (found * ids.itemsize).tolist()
                starts = [0, *(end + ids.itemsize for end in ends)]
                made = {w: data[i:j] for w, i, j in zip(plain, starts, [*ends, len(data)])}
        for word in words:
            if word not in made:
                made[word] = array("I", self._encode_one(word.decode())).tobytes()
        return made

    def _encode_one(self, text: str) -> list[int]:
        return self._tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids


_encoders: dict[str, ChunkEncoder] = {}


def encoder(vocabulary: str | None) -> ChunkEncoder:
    """This worker's encoder, with what it remembers from earlier tasks."""
    path = vocabulary or vocabulary_path()
    if path not in _encoders:
        _encoders[path] = ChunkEncoder(path)
    return _encoders[path]


def _route(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """The smallest hash of a text's chunks: equal for texts that share most of them."""
    for texts in batches:
        yield pd.Series([
            min((int.from_bytes(hashlib.blake2b(chunk, digest_size=8).digest(), signed=True)
                 for chunk in cut(text.encode())), default=0)
            for text in texts
        ], dtype="int64")


DIGEST = {"n_tokens": "bigint", "ids_sha256": "string", "decoded_sha256": "string"}


def chunk_encoded(
    docs: DataFrame, text_col: str = "text", vocabulary: str | None = None, digest: bool = False
) -> DataFrame:
    """Every document with its byte-pair ids: row (all its columns), n_tokens, ids.

    ``vocabulary`` is the path of a tokenizer's file, on the workers; by default the public
    one. Its tokens must not hold ASCII white space, and nothing be added around a text. With
    ``digest`` there are n_tokens and the SHA-256 of the ids and of the decoded text instead.

    The rows are dealt by the smallest hash of their chunks. A large group of copies is split
    among several tasks by adaptive execution; each then encodes the group's chunks once.

    A null or blank text has no ids. Rows are encoded for themselves, so null, equal and
    repeated ids do no harm. A text is held by one task as a whole; one without white space is
    a single window. An empty table gives no rows.
    """
    ship_package(docs.sparkSession)
    rows = docs.select(F.struct("*").alias("row"), F.pandas_udf(_route, "bigint")(text_of(text_col)).alias("route"))
    rows = rows.hint("rebalance", F.col("route"))
    text = F.coalesce(F.col("row").getField(text_col).cast("string"), F.lit(""))
    if not digest:
        @F.pandas_udf("array<int>")
        def ids_of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            own = encoder(vocabulary)
            for texts in batches:
                yield pd.Series([own.encode(x.encode()).astype("int32") for x in texts], dtype=object)

        return rows.select("row", ids_of(text).alias("ids")).select(
            "row", F.size("ids").cast("bigint").alias("n_tokens"), "ids")

    @F.pandas_udf(", ".join(f"{name} {kind}" for name, kind in DIGEST.items()))
    def digest_of(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        own = encoder(vocabulary)
        for texts in batches:
            yield pd.DataFrame(
                [own.digests(text.encode()) for text in texts], columns=list(DIGEST))

    return rows.select("row", digest_of(text).alias("found")).select("row", "found.*")


def _sha256(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def chunk_decoded(rows: DataFrame, ids_col: str = "ids", vocabulary: str | None = None) -> DataFrame:
    """The rows with the decoded text of their ids as column ``decoded``; null for null ids."""
    ship_package(rows.sparkSession)

    @F.pandas_udf("string")
    def text_of_ids(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = encoder(vocabulary)
        for lists in batches:
            yield pd.Series(
                [None if ids is None else own.decode(list(ids)) for ids in lists], dtype=object)

    return rows.withColumn("decoded", text_of_ids(named(ids_col)))
