"""Periodic runs of words: stretches that repeat with a period four times and more.

Longest common extensions come from a difference cover: of every thirteen positions only four
are sampled, and only the suffixes that start there are sorted. Any two positions reach two
sampled ones after fewer than thirteen steps of the same length, so an extension is a few word
comparisons and one range minimum over the common prefixes of the sorted samples. Runs are
enumerated along a harmonic grid: those of period p hold a multiple of their least number of
repeats, so only n / 3p positions are looked at for each p.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clicklens.llm.common import ship_package, text_of

# Every remainder of 13 is a difference of two of these.
COVER = np.array([0, 1, 3, 9])
CYCLE = 13
REPEATS = 4  # a run's length is at least so many periods
LEAST = 6  # and at least so many words
BLOCK_WORDS = 300_000  # words of texts that are worked on together
GRID_POINTS = 1_000_000  # positions of the grid that are looked at together

# STEPS[d] = the step to a sampled position, for each remainder of the first position, if the
# second is d further on.
_in_cover = np.isin(np.arange(CYCLE), COVER)
STEPS = np.array([
    [next(s for s in range(CYCLE) if _in_cover[(i + s) % CYCLE] and _in_cover[(i + s + d) % CYCLE])
     for i in range(CYCLE)]
    for d in range(CYCLE)
])


def split_words(text: str) -> list[bytes]:
    """The words between spaces, tabs, line feeds, vertical tabs, form feeds, carriage returns."""
    return text.encode("utf-8", "surrogatepass").split()


class CommonPrefixes:
    """How far the suffixes of ``symbols`` from two positions agree.

    ``symbols`` are numbers from 0; the last must occur nowhere else.
    """

    def __init__(self, symbols: np.ndarray):
        self._symbols = symbols
        n = len(symbols)
        at = np.arange(0, n, CYCLE)[:, None] + COVER
        samples = at[at < n]
        # Ranks of the samples by their first 13 symbols, then 26, 52, and so on. What lies
        # beyond the end comes before all else.
        padded = np.concatenate([symbols, np.full(2 * CYCLE, -1, dtype=symbols.dtype)])
        # Several symbols to a number, so that there are fewer columns to sort by.
        bits = int(symbols.max(initial=0) + 1).bit_length()
        together = max(1, 62 // bits)
        columns = []
        for first in range(0, CYCLE, together):
            column = np.zeros(len(samples), dtype=np.int64)
            for i in range(first, min(first + together, CYCLE)):
                column = (column << bits) | (padded[samples + i] + 1)
            columns.append(column)
        order = np.lexsort(columns[::-1])
        rank = self._ranks(order, columns)
        place = np.full(n + CYCLE, -1, dtype=np.int64)  # of a position, among the samples
        place[samples] = np.arange(len(samples))
        levels = [rank]
        reach = CYCLE
        while reach < n and len(samples) and rank.max() + 1 < len(samples):
            later = samples + reach
            inside = later < n
            second = np.where(inside, rank[place[np.where(inside, later, 0)]], -1)
            order = np.lexsort((second, rank))
            rank = self._ranks(order, [rank, second])
            levels.append(rank)
            reach *= 2
        self._sorted = samples[order]
        self._rank = np.full(n + CYCLE, -1, dtype=np.int64)
        self._rank[self._sorted] = np.arange(len(order))
        self._minima = self._sparse_table(self._neighbours(levels, place, padded))

    @staticmethod
    def _ranks(order: np.ndarray, keys: list[np.ndarray]) -> np.ndarray:
        """The number of each row's group of equal keys, in order."""
        new = np.zeros(len(order), dtype=np.int64)
        for key in keys:
            ordered = key[order]
            new[1:] |= ordered[1:] != ordered[:-1]
        rank = np.empty(len(order), dtype=np.int64)
        rank[order] = np.cumsum(new)
        return rank

    def _neighbours(
        self, levels: list[np.ndarray], place: np.ndarray, padded: np.ndarray
    ) -> np.ndarray:
        """Common prefix of each sorted sample and the next: by doubled lengths, then by words."""
        n = len(self._symbols)
        one, two = self._sorted[:-1].copy(), self._sorted[1:].copy()
        length = np.zeros(len(one), dtype=np.int64)
        for level in range(len(levels) - 1, -1, -1):
            inside = (one < n) & (two < n)
            a, b = place[np.where(inside, one, 0)], place[np.where(inside, two, 0)]
            step = np.where(inside & (levels[level][a] == levels[level][b]), CYCLE << level, 0)
            one, two, length = one + step, two + step, length + step
        open_ = np.ones(len(one), dtype=bool)
        for _ in range(CYCLE):
            one, two = np.minimum(one, n), np.minimum(two, n)
            open_ &= (padded[one] == padded[two]) & (padded[one] >= 0)
            one, two, length = one + open_, two + open_, length + open_
        return length

    @staticmethod
    def _sparse_table(values: np.ndarray) -> list[np.ndarray]:
        table = [values]
        while 2 << (len(table) - 1) <= len(values):
            half = 1 << (len(table) - 1)
            table.append(np.minimum(table[-1][:-half], table[-1][half:]))
        return table

    def of(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        """Common prefixes of the suffixes from ``one[k]`` and ``two[k]``, where one < two."""
        symbols, n = self._symbols, len(self._symbols)
        steps = STEPS[(two - one) % CYCLE, one % CYCLE]
        length = np.zeros(len(one), dtype=np.int64)
        left = np.arange(len(one))  # those that have agreed so far and are not yet sampled
        reached = []
        for step in range(CYCLE):
            there = steps[left] == step
            reached.append(left[there])
            left = left[~there]
            if not len(left):
                break
            a, b = one[left] + step, two[left] + step
            same = (b < n) & (symbols[a] == symbols[np.minimum(b, n - 1)])
            left = left[same]
            length[left] = step + 1
        found = np.concatenate(reached)
        found = found[two[found] + steps[found] < n]
        a, b = self._rank[one[found] + steps[found]], self._rank[two[found] + steps[found]]
        length[found] += self._least(np.minimum(a, b), np.maximum(a, b))
        return length

    def _least(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """The smallest of the values low to high - 1, by two overlapping powers of two."""
        least = np.empty(len(low), dtype=np.int64)
        power = np.frexp((high - low).astype(float))[1] - 1
        for p in np.unique(power):
            these = power == p
            row = self._minima[p]
            least[these] = np.minimum(row[low[these]], row[high[these] - (1 << p)])
        return least


def _grid(sizes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(text, position in it, period) of the grid, in blocks of about ``GRID_POINTS``.

    A run of period p has max(6, 4p) - p positions in a row whose word comes again p further
    on, and so a multiple of that number among them.
    """
    for text, size in enumerate(sizes.tolist()):
        if size < LEAST:
            continue
        first = 1
        while first <= size // REPEATS:
            # Neighbouring periods together, as many as fit.
            last = min(size // REPEATS, first + max(1, GRID_POINTS * first // size))
            periods = np.arange(first, last + 1)
            gaps = np.maximum(LEAST, REPEATS * periods) - periods
            counts = (size - periods - 1) // gaps + 1
            points = int(counts.sum())
            starts = np.cumsum(counts) - counts
            period = np.repeat(periods, counts)
            position = (np.arange(points) - np.repeat(starts, counts)) * np.repeat(gaps, counts)
            yield np.full(points, text), position, period
            first = last + 1


def _blocks_of_grid(sizes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    points = 0
    for part in _grid(sizes):
        held.append(part)
        points += len(part[0])
        if points >= GRID_POINTS:
            yield tuple(np.concatenate(x) for x in zip(*held))
            held, points = [], 0
    if held:
        yield tuple(np.concatenate(x) for x in zip(*held))


def find_runs(texts: list[np.ndarray]) -> list[np.ndarray]:
    """For each text, given as word numbers: its runs as rows (start, length, period), in order.

    A run is as long as it can be with its smallest period, at least four periods and six words.
    """
    sizes = np.array([len(text) for text in texts], dtype=np.int64)
    none = np.empty((0, 3), dtype=np.int64)
    if not (sizes >= LEAST).any():
        return [none] * len(texts)
    # One sequence of all texts, each closed by a symbol of its own; a further one in front.
    most = max(int(text.max()) for text in texts if len(text)) + 1
    parts = [np.array([most], dtype=np.int64)]
    for number, text in enumerate(texts):
        parts += [text, np.array([most + 1 + number], dtype=np.int64)]
    symbols = np.concatenate(parts)
    starts = 1 + np.cumsum(sizes + 1) - (sizes + 1)

    found = []
    for text, position, period in _blocks_of_grid(sizes):
        at = starts[text] + position
        same = symbols[at] == symbols[at + period]
        found.append(np.stack([text[same], at[same], period[same]]))
    text, at, period = np.concatenate(found, axis=1)
    if not len(text):
        return [none] * len(texts)
    ahead = CommonPrefixes(symbols).of(at, at + period)
    last = len(symbols) - 1
    behind = CommonPrefixes(symbols[::-1].copy()).of(last - (at + period), last - at) - 1
    start, length = at - behind, behind + ahead + period
    long = length >= np.maximum(LEAST, REPEATS * period)
    rows = np.unique(
        np.stack([text, start - starts[text], length, period], axis=1)[long], axis=0)
    # The same stretch with a multiple of its period is the same run.
    first = np.ones(len(rows), dtype=bool)
    first[1:] = (rows[1:, :3] != rows[:-1, :3]).any(axis=1)
    rows = rows[first]
    rows = rows[np.lexsort((rows[:, 3], rows[:, 1], rows[:, 0]))]
    cuts = np.searchsorted(rows[:, 0], np.arange(len(texts) + 1))
    return [rows[a:b, 1:] for a, b in zip(cuts[:-1], cuts[1:])]


def kept_words(size: int, runs: np.ndarray) -> np.ndarray:
    """Which of ``size`` words stay: those in no run, or in the first period of all theirs."""
    change = np.zeros(size + 1, dtype=np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(change[:-1]) == 0


def greatest(runs: np.ndarray) -> tuple[int, int, int] | None:
    """The run of the greatest length / period, exactly; then the smallest start, then period."""
    best = None
    for start, length, period in runs.tolist():
        # In order of start and period, so among equals the first stays.
        if best is None or length * best[2] > best[1] * period:
            best = start, length, period
    return best


@dataclass(frozen=True)
class _Text:
    words: list[bytes]
    runs: np.ndarray


def _analysed(texts: Iterator[list[bytes]]) -> Iterator[_Text]:
    """Every text's runs; texts are worked on in blocks of words, a longer one by itself."""
    held: list[list[bytes]] = []
    size = 0

    def flush() -> Iterator[_Text]:
        numbers: dict[bytes, int] = {}
        coded = [
            np.array([numbers.setdefault(word, len(numbers)) for word in words], dtype=np.int64)
            for words in held
        ]
        for words, runs in zip(held, find_runs(coded)):
            yield _Text(words, runs)

    for words in texts:
        if held and size + len(words) > BLOCK_WORDS:
            yield from flush()
            held, size = [], 0
        held.append(words)
        size += len(words)
    if held:
        yield from flush()


RUNS = {
    "n_words": "bigint",
    "runs": "array<struct<start: bigint, length: bigint, period: bigint>>",
    "collapsed": "string",
}
DIGEST = {
    **dict.fromkeys(["n_runs", "start", "length", "period", "exponent_milli"], "bigint"),
    "runs_sha256": "string",
    "collapsed_sha256": "string",
}


def _collapsed(text: _Text) -> bytes:
    if not len(text.runs):
        return b" ".join(text.words)
    stay = kept_words(len(text.words), text.runs).tolist()
    return b" ".join([word for word, kept in zip(text.words, stay) if kept])


def _listed(text: _Text) -> tuple:
    runs = [dict(zip(("start", "length", "period"), run)) for run in text.runs.tolist()]
    return len(text.words), runs, _collapsed(text).decode("utf-8", "surrogatepass")


def _digest(text: _Text) -> tuple:
    best = greatest(text.runs)
    lines = "".join(f"{s},{n},{p}\n" for s, n, p in text.runs.tolist())
    return (
        len(text.runs), *(best or (None, None, None)),
        1000 * best[1] // best[2] if best else None,
        hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(_collapsed(text)).hexdigest(),
    )


def periodic_runs(
    docs: DataFrame, text_col: str = "text", digest: bool = False
) -> DataFrame:
    """Every document with its runs and its text without their repeats.

    Columns: row (the document with all its columns), n_words, runs (start, length, period, by
    start and period), collapsed (the words that no run holds after its first period, joined by
    spaces). With ``digest`` instead of these: n_runs, the run of the greatest length / period
    (start, length, period, exponent_milli), and the SHA-256 of the runs and of the collapsed
    text, so that only short rows leave the workers.

    A null or blank text has no words, no runs and an empty collapsed text. Every row is looked
    at for itself, so null, equal and repeated ids do no harm. A very long text is worked on
    alone in one task; memory is some hundred bytes a word of it. An empty table gives none.
    """
    ship_package(docs.sparkSession)
    kinds, made = (DIGEST, _digest) if digest else (RUNS, _listed)

    @F.pandas_udf(", ".join(f"{name} {kind}" for name, kind in kinds.items()))
    def found(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            rows = [made(text) for text in _analysed(map(split_words, texts))]
            columns = zip(*rows) if rows else [[]] * len(kinds)
            yield pd.DataFrame({
                name: pd.Series(list(values), dtype="Int64" if kind == "bigint" else object)
                for (name, kind), values in zip(kinds.items(), columns)
            })

    return docs.select(
        F.struct("*").alias("row"), found(text_of(text_col)).alias("found")
    ).select("row", "found.*")
