"""SentencePiece encoding and decoding with the N best segmentations of every text."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from heapq import heappop, heappush
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clicklens.llm.common import named, share, text_of
from clicklens.llm.lattice import (
    NONE,
    SEGMENT,
    SPACE,
    Pieces,
    arc_scores,
    arcs_of,
    by_length,
    bytes_of,
    load_pieces,
    marked,
)

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
N_BEST = 4
REMEMBERED = 200_000  # segments in each of the two generations a worker remembers
WAYS = 20_000  # segments whose n best segmentations it remembers
PAST = -2  # left of a segment's first piece
NEVER = -1e8  # vocabularies score so low what should not be used
SEGMENTS = 200_000  # segments of texts that are worked on together
SPELLED = 10.0  # a byte scores this much less than the worst piece


# The best segmentation of a segment as little-endian 32-bit ids, its score, and how much
# worse the next one is.
Entry = tuple[bytes, float, float]


def usable_scores(pieces: Pieces) -> np.ndarray:
    """The vocabulary's scores; bytes, which may have none of their own, come after all pieces."""
    scores = pieces.scores.astype(float).copy()
    meant = scores[scores > NEVER]
    scores[pieces.byte_ids] = meant.min(initial=0.0) - SPELLED
    return scores


def two_best(segments: list[str], pieces: Pieces, scores: np.ndarray) -> list[Entry]:
    """Forward Viterbi scores of the best and the second segmentation, for many segments at once."""
    padded = np.append(scores, -np.inf)
    entries: list[Entry] = [None] * len(segments)  # type: ignore[list-item]
    for part, codes in by_length(segments):
        arcs = arcs_of(codes, pieces)
        n, length = codes.shape
        # Position by position, each with the values of all segments side by side.
        first, second = np.full((2, length + 1, n), -np.inf)
        first[0] = 0.0
        back = np.zeros((n, length + 1), dtype=np.int32, order="F")
        last = np.full((n, length + 1), NONE, dtype=np.int32, order="F")
        for j in range(1, length + 1):
            for k in range(1, len(arcs.ids[j]) + 1):
                ids = arcs.ids[j][k - 1]
                if k > 1 and ids is arcs.none:
                    continue
                # Longer pieces are on few segments; the others stay as they are.
                on = slice(None) if k == 1 else np.flatnonzero(ids != NONE)
                s = arc_scores(arcs, j, k, pieces, padded)[on] if k == 1 else scores[ids[on]]
                one, two = first[j - k][on] + s, second[j - k][on] + s
                best, next_ = first[j][on], second[j][on]
                # Among equals the longer last piece wins: it comes later here.
                better = (one >= best) & (one > -np.inf)
                second[j][on] = np.maximum(np.maximum(next_, two), np.minimum(best, one))
                first[j][on] = np.maximum(best, one)
                won = np.flatnonzero(better) if k == 1 else on[better]
                back[won, j] = k
                last[won, j] = ids[won]
        gaps = first[length] - second[length]
        at, rows = np.full(n, length), np.arange(n)
        steps = []
        while (at > 0).any():
            steps.append((np.where(at > 0, last[rows, at], PAST), at))
            at = np.where(at > 0, at - back[rows, at], 0)
        ids = np.stack([s[0] for s in steps[::-1]], axis=1).astype("<i4")
        ends = np.stack([s[1] for s in steps[::-1]], axis=1)
        used = ids != PAST
        flat = ids[used].tobytes()
        cuts = np.concatenate([[0], 4 * np.cumsum(used.sum(axis=1))]).tolist()
        scores_of, gaps_of = first[length].tolist(), gaps.tolist()
        spelled = (ids == NONE).any(axis=1).tolist()
        for row, i in enumerate(part.tolist()):
            found = flat[cuts[row]:cuts[row + 1]]
            if spelled[row]:
                found = b"".join([
                    pieces.byte_ids[list(bytes_of(int(codes[row, e - 1])))].astype("<i4").tobytes()
                    if x == NONE else x.tobytes()
                    for x, e in zip(ids[row], ends[row]) if x != PAST])
            entries[i] = found, scores_of[row], gaps_of[row]
    return entries


def backward_search(
    into: list[list[tuple[int, float, object]]], n_best: int
) -> list[tuple[float, list]]:
    """The ``n_best`` best paths of a lattice, best first: (score, labels).

    ``into[j]`` lists the arcs that end in node j: (start, score, label). A forward Viterbi
    pass gives the exact best score from the start to every node; the A* search runs
    backward from the end with these as its heuristic, so paths come out in order of score.
    Equal paths come in the order of the arcs as listed, last arc first.
    """
    ahead = [-np.inf] * len(into)
    ahead[0] = 0.0
    for j in range(1, len(into)):
        ahead[j] = max((ahead[i] + s for i, s, _ in into[j]), default=-np.inf)
    heap = [(-ahead[-1], (), len(into) - 1, 0.0, None)]
    found = []
    while heap and len(found) < n_best:
        total, order, node, behind, path = heappop(heap)
        if total == np.inf:
            break
        if node == 0:
            labels = []
            while path:
                labels.append(path[0])
                path = path[1]
            found.append((behind, labels))
            continue
        for number, (start, score, label) in enumerate(into[node]):
            reached = behind + score
            heappush(heap, (
                -(ahead[start] + reached), order + (number,), start, reached, (label, path)))
    return found


class Encoder:
    """Encodes texts. Segments met lately are remembered, in two generations of bounded size."""

    def __init__(self, pieces: Pieces, n_best: int = N_BEST, remembered: int = REMEMBERED) -> None:
        self.pieces, self.scores, self.n_best = pieces, usable_scores(pieces), n_best
        self.remembered = remembered
        self.ids = {text: i for i, text in enumerate(pieces.texts) if text}
        self.new: dict[str, Entry] = {}
        self.old: dict[str, Entry] = {}
        self.ways: dict[str, list[tuple[float, list[int]]]] = {}

    def learn(self, segments: set[str]) -> None:
        """Work out the segments that are not remembered, all at once."""
        if len(self.new) > self.remembered:
            self.old, self.new = self.new, {}
        if len(self.ways) > WAYS:
            self.ways = {}
        missing = []
        for segment in segments.difference(self.new):
            entry = self.old.get(segment)
            if entry is None:
                missing.append(segment)
            else:
                self.new[segment] = entry
        if missing:
            self.new.update(zip(missing, two_best(missing, self.pieces, self.scores)))

    def lattice(self, segment: str) -> list[list[tuple]]:
        """The arcs into every position of a segment, longer pieces first."""
        into: list[list[tuple]] = [[]]
        for j in range(1, len(segment) + 1):
            row = []
            for i in range(max(0, j - self.pieces.longest), j):
                found = self.ids.get(segment[i:j])
                if found is not None:
                    row.append((i, float(self.scores[found]), (found,)))
            if segment[j - 1] not in self.ids:
                spelled = self.pieces.byte_ids[list(bytes_of(ord(segment[j - 1])))]
                row.append((j - 1, float(self.scores[spelled].sum()), tuple(spelled.tolist())))
            into.append(row)
        return into

    def ways_of(self, segment: str) -> list[tuple[float, list[int]]]:
        found = self.ways.get(segment)
        if found is None:
            found = self.ways[segment] = [
                (score, list(chain.from_iterable(labels)))
                for score, labels in backward_search(self.lattice(segment), self.n_best)]
        return found

    def encode(
        self, segments: list[str]
    ) -> tuple[bytes, list[tuple[float, list[tuple[int, list[int]]]]]]:
        """Ids of the best segmentation, and all n best: (score, changed segments with their ids).

        The segments have been learned. No piece reaches from one into the next, so the
        lattice of the text is a chain of theirs. Only segments whose second way costs
        least can differ from their best in any of the n best: there are n - 1 of them at
        most. The backward search runs on each of these, and then on the chain of them.
        """
        if not segments:
            return b"", [(0.0, [])]
        ids, scores, gaps = zip(*map(self.new.__getitem__, segments))
        best = sum(scores)
        least = np.argsort(np.array(gaps), kind="stable")[:self.n_best - 1].tolist()
        open_ = sorted(i for i in least if gaps[i] < np.inf)
        into: list[list[tuple]] = [[]]
        for i in open_:
            ways = self.ways_of(segments[i])
            into.append([
                (len(into) - 1, score - scores[i], (i, way if rank else None))
                for rank, (score, way) in enumerate(ways)])
        found = [
            (best + score, [(i, way) for i, way in labels if way is not None])
            for score, labels in backward_search(into, self.n_best)]
        return b"".join(ids), found


def blocks_of(texts: pd.Series) -> Iterator[list[tuple[str, list[str]]]]:
    """Texts with their segments, some at a time."""
    block, size = [], 0
    for text in texts:
        block.append((text, split_segments(text)))
        size += len(block[-1][1])
        if size > SEGMENTS:
            yield block
            block, size = [], 0
    if block:
        yield block


def split_segments(text: str) -> list[str]:
    """The text, after the space put before it, as segments that no piece reaches across."""
    return SEGMENT.findall(marked(" " + text)) if text else []


def piece_bytes(pieces: Pieces) -> list[bytes]:
    out = [t.replace(SPACE, " ").encode() for t in pieces.texts]
    for value, i in enumerate(pieces.byte_ids):
        out[i] = bytes([value])
    return out


def joined(ids: list[int], as_bytes: list[bytes]) -> str:
    """The text that the ids spell, without the space that encoding puts before it."""
    return b"".join([as_bytes[i] for i in ids])[1:].decode("utf-8", "replace")


def encoded(
    docs: DataFrame, vocabulary: str = VOCABULARY, n_best: int = N_BEST, text_col: str = "text",
    with_ids: bool = True, remembered: int = REMEMBERED,
) -> DataFrame:
    """row (the document's own columns) and what encoding its whole text gives.

    ``ids`` is the best segmentation (null without ``with_ids``), ``n_pieces`` its length,
    ``ids_sha256`` the digest of its ids as little-endian 32-bit numbers and ``round_trip``
    whether they spell the text again. ``best`` lists the n best segmentations, best first:
    score, and the segments that differ from the best one with their ids; it is shorter
    when the text has fewer. Line feeds and what the vocabulary lacks are spelled in bytes.

    A null text is an empty one; that has no pieces, one segmentation and score 0. Equal
    texts are encoded alike, equal scores in a fixed order; an empty table gives no rows.
    ``remembered`` segments, twice at most and a block's, stay in a worker's memory; the
    results do not depend on it.
    """
    shared = share(docs, load_pieces(vocabulary))

    @F.pandas_udf(
        "ids array<int>, n_pieces int, ids_sha256 string, round_trip boolean, "
        "best array<struct<score: double, changes: array<struct<segment: int, ids: array<int>>>>>")
    def encode(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        encoder = Encoder(shared.value, n_best, remembered)
        as_bytes = piece_bytes(shared.value)
        for batch in texts:
            # Handed on block by block, so that no more than a block's ids are held.
            for block in blocks_of(batch):
                out = []
                encoder.learn(set(chain.from_iterable([segments for _, segments in block])))
                for text, segments in block:
                    packed, best = encoder.encode(segments)
                    ids = np.frombuffer(packed, dtype="<i4")
                    out.append((
                        ids if with_ids else None, len(ids), hashlib.sha256(packed).hexdigest(),
                        joined(ids.tolist(), as_bytes) == text,
                        [{"score": score, "changes": [
                            {"segment": i, "ids": way} for i, way in changes]}
                         for score, changes in best],
                    ))
                yield pd.DataFrame(
                    out, columns=["ids", "n_pieces", "ids_sha256", "round_trip", "best"])

    return docs.select(F.struct("*").alias("row"), encode(text_of(text_col)).alias("e")).select(
        "row", "e.*")


def decoded(rows: DataFrame, vocabulary: str = VOCABULARY, ids_col: str = "ids") -> DataFrame:
    """All columns of ``rows`` as ``row``, and ``text``: what the ids spell. Null ids give null."""
    shared = share(rows, load_pieces(vocabulary))

    @F.pandas_udf("string")
    def decode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        as_bytes = piece_bytes(shared.value)
        for batch in batches:
            yield pd.Series([None if x is None else joined(list(x), as_bytes) for x in batch])

    return rows.select(F.struct("*").alias("row"), decode(named(ids_col)).alias("text"))
