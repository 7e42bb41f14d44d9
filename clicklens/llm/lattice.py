"""Lattices over the pieces of an existing subword vocabulary, worked on many words at a time."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np

SPACE = "▁"  # how the vocabulary writes a space
LITERAL = "\ud800"  # stands for that character itself, which no piece may match
BASE = 0x9E3779B97F4A7C15
NONE = -1
CELLS = 1 << 19  # characters of words worked on together
MARK_BITS = 18  # leading bits of a hash that tell most strings that are no piece
# In a marked text: runs of spaces with what follows them, line feeds, other runs of spaces.
SEGMENT = re.compile(f"\n|{SPACE}*[^{SPACE}\n]+|{SPACE}+")


@dataclass
class Pieces:
    """A vocabulary: piece texts, their scores as they are given, and the ids of single bytes."""

    texts: list[str]
    scores: np.ndarray
    byte_ids: np.ndarray
    by_length: dict[int, tuple[np.ndarray, np.ndarray]] = field(default_factory=dict)
    marks: dict[int, np.ndarray] = field(default_factory=dict)  # of the hashes' leading bits

    def __post_init__(self) -> None:
        """Index the pieces by length and hash.

        Segments begin where spaces begin, so no piece may go on after a space follows
        another character; such pieces would need the lattice of a whole text.
        """
        groups: dict[int, list[int]] = {}
        for i, text in enumerate(self.texts):
            if text:
                if SPACE in text.lstrip(SPACE) or "\n" in text:
                    raise ValueError(f"piece {i} goes on over a space")
                groups.setdefault(len(text), []).append(i)
        for n, ids in groups.items():
            codes = np.array([[ord(c) for c in self.texts[i]] for i in ids], dtype=np.uint64)
            hashes = prefix_hashes(codes)[:, -1]
            order = np.argsort(hashes)
            if len(np.unique(hashes)) < len(hashes):
                raise ValueError("two pieces of the vocabulary share a hash")
            self.by_length[n] = hashes[order], np.array(ids, dtype=np.int32)[order]
            self.marks[n] = np.zeros(1 << MARK_BITS, dtype=bool)
            self.marks[n][hashes >> np.uint64(64 - MARK_BITS)] = True

    @property
    def longest(self) -> int:
        return max(self.by_length, default=1)


def load_pieces(path: str) -> Pieces:
    """The pieces of a SentencePiece model file. Control and unknown pieces match no text."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    n = model.get_piece_size()
    texts, scores, byte_ids = [], np.zeros(n), np.full(256, NONE, dtype=np.int32)
    for i in range(n):
        scores[i] = model.get_score(i)
        special = model.is_control(i) or model.is_unknown(i) or model.is_unused(i)
        if model.is_byte(i):
            byte_ids[int(model.id_to_piece(i)[3:5], 16)] = i
        texts.append("" if special or model.is_byte(i) else model.id_to_piece(i))
    if (byte_ids == NONE).any():
        raise ValueError("the vocabulary cannot spell every byte")
    return Pieces(texts, scores, byte_ids)


def prefix_hashes(codes: np.ndarray) -> np.ndarray:
    # Columns are what is worked on, so a column's values lie side by side.
    h = np.zeros((codes.shape[0], codes.shape[1] + 1), dtype=np.uint64, order="F")
    for i in range(codes.shape[1]):
        h[:, i + 1] = h[:, i] * np.uint64(BASE) + codes[:, i] + np.uint64(1)
    return h


def marked(text: str) -> str:
    """Spaces as the vocabulary writes them; what looks like that mark becomes LITERAL."""
    return text.replace(SPACE, LITERAL).replace(" ", SPACE)


def bytes_of(code: int) -> bytes:
    return (SPACE if chr(code) == LITERAL else chr(code)).encode()


def by_length(segments: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(numbers, characters) of segments of equal length, a bounded number at a time."""
    lengths = np.fromiter(map(len, segments), dtype=np.int64, count=len(segments))
    order = np.argsort(lengths, kind="stable")
    cuts = np.flatnonzero(np.diff(lengths[order])) + 1
    for group in np.split(order, cuts):
        n = int(lengths[group[0]]) if len(group) else 0
        if n:
            step = max(1, CELLS // n)
            for at in range(0, len(group), step):
                part = group[at:at + step]
                joined = "".join([segments[i] for i in part])
                codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
                yield part, codes.reshape(len(part), n)


@dataclass
class Arcs:
    """Pieces on the lattices of equally long segments.

    ``ids[j][k]`` holds, for every segment, the piece on the k + 1 characters before
    position j, or NONE. A character without a piece of its own is spelled in bytes:
    ``spelled[j]`` says for which segments the character before j is.
    """

    codes: np.ndarray
    ids: list[list[np.ndarray]]
    spelled: list[np.ndarray]
    none: np.ndarray  # stands in ``ids`` where no segment has a piece


def arcs_of(codes: np.ndarray, pieces: Pieces) -> Arcs:
    n, length = codes.shape
    h = prefix_hashes(codes.astype(np.uint64, order="F"))
    powers = [np.uint64(pow(BASE, k, 1 << 64)) for k in range(pieces.longest + 1)]
    ids: list[list[np.ndarray]] = [[]]
    spelled = [np.zeros(0, dtype=bool)]
    none = np.full(n, NONE, dtype=np.int32)
    for j in range(1, length + 1):
        row = []
        for k in range(1, min(j, pieces.longest) + 1):
            if k not in pieces.by_length:
                row.append(none)
                continue
            known, which = pieces.by_length[k]
            want = h[:, j] - h[:, j - k] * powers[k]
            on = np.flatnonzero(pieces.marks[k][want >> np.uint64(64 - MARK_BITS)])
            want = want[on]
            at = np.minimum(np.searchsorted(known, want), len(known) - 1)
            same = known[at] == want
            if not same.any():
                row.append(none)
                continue
            found = none.copy()
            found[on[same]] = which[at[same]]
            row.append(found)
        ids.append(row)
        spelled.append(row[0] == NONE)
    return Arcs(codes, ids, spelled, none)


def spelled_scores(arcs: Arcs, j: int, pieces: Pieces, scores: np.ndarray) -> np.ndarray:
    """Score of spelling the character before j in bytes, where it has to be; else -inf."""
    out = np.full(len(arcs.codes), -np.inf)
    where = arcs.spelled[j]
    if where.any():
        codes, back = np.unique(arcs.codes[where, j - 1], return_inverse=True)
        out[where] = np.array(
            [scores[pieces.byte_ids[list(bytes_of(int(c)))]].sum() for c in codes])[back]
    return out


def arc_scores(arcs: Arcs, j: int, k: int, pieces: Pieces, padded: np.ndarray) -> np.ndarray:
    """Scores of the arcs over the k characters before j. ``padded`` ends in -inf, for NONE."""
    s = padded[arcs.ids[j][k - 1]]
    if k == 1 and arcs.spelled[j].any():
        s = np.maximum(s, spelled_scores(arcs, j, pieces, padded))
    return s


def forward(arcs: Arcs, pieces: Pieces, scores: np.ndarray) -> np.ndarray:
    """Log-sum over all segmentations of the first j characters: column j, for each segment."""
    n, length = arcs.codes.shape
    padded = np.append(scores, -np.inf)
    alpha = np.zeros((n, length + 1))
    for j in range(1, length + 1):
        ways = np.stack([
            alpha[:, j - k] + arc_scores(arcs, j, k, pieces, padded)
            for k in range(1, len(arcs.ids[j]) + 1)
        ])
        top = ways.max(axis=0)
        alpha[:, j] = top + np.log(np.exp(ways - top).sum(axis=0))
    return alpha


def expected_counts(
    segments: list[str], times: np.ndarray, pieces: Pieces, scores: np.ndarray
) -> np.ndarray:
    """How often each piece is used over all segmentations, weighted by their probability."""
    total = np.zeros(len(scores))
    padded = np.append(scores, -np.inf)
    for part, codes in by_length(segments):
        arcs = arcs_of(codes, pieces)
        alpha = forward(arcs, pieces, scores)
        n, length = codes.shape
        beta = np.full((n, length + 1), -np.inf)
        beta[:, length] = 0.0
        weight = times[part]
        # beta of a position is complete before its arcs to the left are looked at.
        for j in range(length, 0, -1):
            for k in range(1, len(arcs.ids[j]) + 1):
                s = arc_scores(arcs, j, k, pieces, padded)
                on = np.flatnonzero(s > -np.inf)
                if not len(on):
                    continue
                through = s[on] + beta[on, j]
                beta[on, j - k] = np.logaddexp(beta[on, j - k], through)
                used = weight[on] * np.exp(alpha[on, j - k] + through - alpha[on, length])
                ids = arcs.ids[j][k - 1][on]
                known = ids != NONE
                total += np.bincount(ids[known], used[known], minlength=len(total))
                if not known.all():
                    found, back = np.unique(codes[on[~known], j - 1], return_inverse=True)
                    for code, amount in zip(found, np.bincount(back, used[~known])):
                        np.add.at(total, pieces.byte_ids[list(bytes_of(int(code)))], amount)
    return total


def log_likelihoods(segments: list[str], pieces: Pieces, scores: np.ndarray) -> np.ndarray:
    """Natural log of each segment's probability, summed over all its segmentations."""
    out = np.zeros(len(segments))
    for part, codes in by_length(segments):
        out[part] = forward(arcs_of(codes, pieces), pieces, scores)[:, -1]
    return out
