"""Spelling variants: words one inserted, deleted or replaced letter apart, and their usual forms.

Words are arranged in a trie by how often they have the letters of each group: a level for each
group, in order. A word one edit away has one letter more of some group, one less of another,
or both, so a depth-first search that may spend one surplus and one deficit finds it. To find
each pair once, a word only looks for those that have more of the group that differs first.

Spark walks the upper levels for all words at once: nodes that hold few words end there, the
others are opened level by level. What lies below a node is searched in one task, with all the
words that have reached it, in shares of bounded size.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clicklens.llm.common import ascii_lower, named, ship_package, text_of, written

# Maximal runs of these are words.
LETTERS = "A-Za-zÀ-ÿ"
LEAST_LENGTH = 7
LEAST_COUNT = 2
RATIO = 10  # a form occurs at least so many times as often as its variant

# A level of the trie each; a last one has all other letters. Any grouping gives the same pairs.
GROUPS = ["e", "n", "a", "i", "t", "r", "o", "s", "h", "l", "d", "u", "c", "g", "mp", "bfw", "kvyz", "jqx"]
DEPTH = len(GROUPS) + 1
MOST = 63  # counts are compared up to here: then too an edit changes them by one at most
FIRST_LEVELS = 4  # levels that are walked before nodes are looked at
NODE_WORDS = 8_192  # a node with more words is opened further
SHARE_WORDS = 65_536  # words that search below a node in one task
LEAF_WORDS = 8  # so few words of a node are compared without further levels
PAIRS = 400_000  # pairs that are compared at a time
SHORT = 64  # code points of words that are compared by arrays


def runs_of_letters(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """(id, run): every maximal run of letters, if long enough for a word; A-Z in lower case."""
    pattern = f"[{LETTERS}]{{{LEAST_LENGTH},}}"
    runs = F.regexp_extract_all(text_of(text_col), F.lit(pattern), F.lit(0))
    return docs.select(named(id_col).alias("id"), F.explode(runs).alias("run")).select(
        "id", ascii_lower(F.col("run")).alias("run"))


def count_words(words: DataFrame, least: int = LEAST_COUNT) -> DataFrame:
    """(word, n) of the rows' column ``word``, of those long and frequent enough."""
    return (
        words.where(F.char_length("word") >= LEAST_LENGTH)
        .groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least)
    )


def _in_group(level: int) -> Column:
    """How often a word has letters of the level's group, up to ``MOST``."""
    word = F.col("word")
    if level == DEPTH - 1:
        others = F.translate(word, "".join(GROUPS), "")
        count = F.char_length(others)
    else:
        count = F.char_length(word) - F.char_length(F.translate(word, GROUPS[level], ""))
    return F.least(count, F.lit(MOST))


def _key(levels: range) -> Column:
    """A node's place below another, as text: the counts of the levels."""
    return F.concat(*[F.chr(_in_group(level) + 48) for level in levels])


def _further(count: Column) -> Callable[[Column], Column]:
    """The steps from a node to those below it that are in reach of a word's count."""

    def steps(step: Column) -> Column:
        spent = step["spent"]

        def to(number: Column, spent: Column) -> Column:
            return F.struct(
                F.concat(step["node"], F.chr(number + 48)).alias("node"), spent.alias("spent"))

        return F.filter(
            F.array(
                to(count, spent),
                F.when(spent == 0, to(count + 1, F.lit(1))),
                F.when((spent == 1) & (count > 0), to(count - 1, F.lit(2))),
            ),
            lambda reached: reached.isNotNull(),
        )

    return steps


def _walk(frontier: DataFrame, levels: range) -> DataFrame:
    """The nodes the words of ``frontier`` (word, n, node, spent) reach some levels further down.

    ``spent`` is 0, then 1 for a letter more, then 2 for another less.
    """
    steps = F.array(F.struct(F.col("node").alias("node"), F.col("spent").alias("spent")))
    for level in levels:
        steps = F.flatten(F.transform(steps, _further(_in_group(level))))
    return frontier.select("word", "n", F.explode(steps).alias("step")).select(
        "word", "n", "step.node", "step.spent")


def _searches(words: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(node, word, n) of the words below the nodes that end the walk; and of those that search.

    Nodes at which it ends have at most ``NODE_WORDS`` words, or are at the last level.
    """
    placed = words.select("word", "n", F.lit("").alias("node"))
    frontier = words.select("word", "n", F.lit("").alias("node"), F.lit(0).alias("spent"))
    found, searching = [], []
    at = 0
    while at < DEPTH:
        levels = range(at, min(DEPTH, at + (FIRST_LEVELS if at == 0 else 2)))
        at = levels[-1] + 1
        placed = placed.withColumn("node", F.concat("node", _key(levels)))
        sizes = placed.groupBy("node").agg(F.count(F.lit(1)).alias("size"))
        large = F.lit(at < DEPTH) & (F.col("size") > NODE_WORDS)
        nodes = written(sizes.select("node", large.alias("open")), "nodes")
        reached = written(_walk(frontier, levels).join(nodes, "node"), "frontier")
        found.append(placed.join(nodes.where("NOT open"), "node", "left_semi"))
        searching.append(reached.where("NOT open").drop("open"))
        if nodes.where("open").isEmpty():
            break
        placed = written(placed.join(nodes.where("open"), "node", "left_semi"), "placed")
        frontier = reached.where("open").drop("open")
    return (
        reduce(DataFrame.unionByName, found).select("node", "word", "n"),
        reduce(DataFrame.unionByName, searching).select("node", "word", "n", "spent"),
    )


# --- below a node --------------------------------------------------------------------------

_GROUP_OF = np.full(256, DEPTH - 1, dtype=np.uint8)
for _level, _letters in enumerate(GROUPS):
    _GROUP_OF[list(_letters.encode("latin-1"))] = _level


def letter_counts(words: list[str]) -> np.ndarray:
    """The words' counts by level, as in ``_in_group``."""
    lengths = np.array([len(word) for word in words], dtype=np.int64)
    codes = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    groups = np.where(codes < 256, _GROUP_OF[codes & 255], DEPTH - 1)
    rows = np.repeat(np.arange(len(words)), lengths)
    counts = np.bincount(rows * DEPTH + groups, minlength=len(words) * DEPTH)
    return np.minimum(counts, MOST).reshape(len(words), DEPTH).astype(np.int8)


def candidates(stored: np.ndarray, searching: np.ndarray, spent: np.ndarray, level: int):
    """Depth-first search: (searching rows, stored rows) of leaves that are in reach.

    ``stored`` are counts in lexicographic order that agree before ``level``; so many units of
    the budget are ``spent`` there.
    """
    stack = [(level, 0, len(stored), np.arange(len(searching)), spent)]
    while stack:
        level, low, high, rows, spent = stack.pop()
        if level == DEPTH or high - low <= LEAF_WORDS:
            yield np.repeat(rows, high - low), np.tile(np.arange(low, high), len(rows))
            continue
        column = stored[low:high, level]
        edges = np.flatnonzero(column[1:] != column[:-1]) + 1
        mine = searching[rows, level]
        for start, end in zip([0, *edges.tolist()], [*edges.tolist(), high - low]):
            more = column[start] - mine
            reach = (more == 0) | ((more == 1) & (spent == 0)) | ((more == -1) & (spent == 1))
            if reach.any():
                stack.append((
                    level + 1, low + start, low + end, rows[reach],
                    spent[reach] + (more[reach] != 0)))


def one_edit_apart(one: str, two: str) -> bool:
    """Whether one insertion, deletion or replacement makes one word of the other."""
    if len(one) > len(two):
        one, two = two, one
    if len(two) - len(one) > 1 or one == two:
        return False
    i = next((i for i, (a, b) in enumerate(zip(one, two)) if a != b), len(one))
    return one[i + (len(one) == len(two)):] == two[i + 1:]


class _Words:
    """Words with their counts by level, and short ones as rows of code points."""

    def __init__(self, words: list[str]):
        self.words = np.array(words, dtype=object)
        self.counts = letter_counts(words)
        self.lengths = np.array([len(word) for word in words], dtype=np.int64)
        width = min(SHORT, int(self.lengths.max(initial=1)))
        short = [word if len(word) <= SHORT else "" for word in words]
        self.codes = np.array(short, dtype=f"U{width}").view(np.uint32).reshape(len(words), width)


def near_pairs(stored: _Words, searching: _Words, a: np.ndarray, b: np.ndarray):
    """The pairs of ``searching`` rows a and ``stored`` rows b that are one edit apart, each once."""
    more = stored.counts[b] - searching.counts[a]
    differs = more != 0
    first = more[np.arange(len(more)), differs.argmax(axis=1)]
    fits = (np.abs(more).sum(axis=1) <= 2) & (np.abs(more.sum(axis=1)) <= 1) & (first >= 0)
    fits &= np.abs(stored.lengths[b] - searching.lengths[a]) <= 1
    a, b, first = a[fits], b[fits], first[fits]
    # Words with the same counts would find each other.
    same = np.flatnonzero(first == 0)
    drop = same[~(searching.words[a[same]] < stored.words[b[same]]).astype(bool)]
    a, b = np.delete(a, drop), np.delete(b, drop)
    long = (stored.lengths[b] > SHORT) | (searching.lengths[a] > SHORT)
    near = np.zeros(len(a), dtype=bool)
    for i in np.flatnonzero(long).tolist():
        near[i] = one_edit_apart(searching.words[a[i]], stored.words[b[i]])
    i = np.flatnonzero(~long)
    near[i] = _one_edit(searching, stored, a[i], b[i])
    return a[near], b[near]


def _one_edit(searching: _Words, stored: _Words, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``one_edit_apart`` of many short words."""
    width = max(searching.codes.shape[1], stored.codes.shape[1])
    one = np.zeros((len(a), width + 1), dtype=np.uint32)
    two = np.zeros((len(a), width + 1), dtype=np.uint32)
    one[:, :searching.codes.shape[1]] = searching.codes[a]
    two[:, :stored.codes.shape[1]] = stored.codes[b]
    longer = searching.lengths[a] - stored.lengths[b]
    swap = longer > 0
    one[swap], two[swap] = two[swap], one[swap]
    unequal = one != two
    start = unequal.argmax(axis=1)  # of the first difference
    replaced = unequal.sum(axis=1) == 1
    # Behind it, the shorter word has to go on as the longer one does a letter later.
    shifted = one[:, :-1] != two[:, 1:]
    behind = np.arange(width) >= start[:, None]
    inserted = ~(shifted & behind).any(axis=1)
    return np.where(longer == 0, replaced, inserted) & unequal.any(axis=1)


NEAR = "word string, n_near bigint, best_n bigint, best string"


def _search(group: pd.DataFrame) -> pd.DataFrame:
    """The near words of a node's words and of those that search there, summed up by word."""
    mine = group["spent"].isna().to_numpy()
    if mine.all() or not mine.any():
        return pd.DataFrame({"word": [], "n_near": [], "best_n": [], "best": []})
    level = len(group["node"].iloc[0])
    stored = _Words(group["word"][mine].tolist())
    order = np.lexsort(stored.counts.T[::-1])
    stored_n = group["n"][mine].to_numpy()[order]
    stored.words, stored.counts, stored.lengths, stored.codes = (
        x[order] for x in (stored.words, stored.counts, stored.lengths, stored.codes))
    searching = _Words(group["word"][~mine].tolist())
    searching_n = group["n"][~mine].to_numpy()
    spent = group["spent"][~mine].to_numpy().astype(np.int8)

    found, held, size = [], [], 0

    def verify() -> None:
        for low in range(0, size, PAIRS):
            a, b = (np.concatenate(x)[low:low + PAIRS] for x in zip(*held))
            found.append(near_pairs(stored, searching, a, b))

    for a, b in candidates(stored.counts, searching.counts, spent, level):
        held.append((a, b))
        size += len(a)
        if size >= PAIRS:
            verify()
            held, size = [], 0
    verify()
    if not found:
        return pd.DataFrame({"word": [], "n_near": [], "best_n": [], "best": []})
    a, b = (np.concatenate(x) for x in zip(*found))
    pairs = pd.DataFrame({
        "word": np.concatenate([searching.words[a], stored.words[b]]),
        "best": np.concatenate([stored.words[b], searching.words[a]]),
        "best_n": np.concatenate([stored_n[b], searching_n[a]]),
    }).sort_values(["best_n", "best"], ascending=[False, True])
    sums = pairs.groupby("word", sort=False).agg(
        n_near=("best", "size"), best_n=("best_n", "first"), best=("best", "first"))
    return sums.reset_index()


def near_words(words: DataFrame) -> DataFrame:
    """(word, n_near, best, best_n) of the distinct words that have near words.

    ``words`` are (word, n). ``best`` is the near word of largest n, of equals the smallest.
    """
    ship_package(words.sparkSession)
    stored, searching = _searches(words)
    shares = searching.groupBy("node").agg(
        F.ceil(F.count(F.lit(1)) / SHARE_WORDS).cast("int").alias("shares"))
    shares = written(shares, "shares")
    # Each share of the words that search meets all the node's words, which are few.
    numbers = F.sequence(F.lit(0), F.col("shares") - 1)
    stored = stored.join(shares, "node").select(
        "node", F.explode(numbers).alias("share"), "word", "n", F.lit(None).cast("int").alias("spent"))
    searching = searching.join(shares, "node").select(
        "node", F.pmod(F.xxhash64("word"), F.col("shares")).cast("int").alias("share"), "word", "n",
        "spent")
    found = stored.unionByName(searching).groupBy("node", "share").applyInPandas(_search, NEAR)
    # Of structs, the smallest is the largest count's, then the smallest word's.
    best = F.min(F.struct((-F.col("best_n")).alias("less"), "best"))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("top")).select(
        "word", "n_near", F.col("top.best").alias("best"), (-F.col("top.less")).alias("best_n"))


def spelling_variants(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of ``words`` (word, n).

    A word's form is its near word of largest n, if that is at least ``ratio`` times the word's;
    the root is where following forms ends, the word itself if it has none.

    Null words are left out, rows of the same word count together (a null n as 0). Words may be
    of any letters and length; an empty table gives no rows. All of a node's words are searched,
    however many share their letters; a last level with many is searched as one node.
    """
    words = written(
        words.where("word IS NOT NULL").groupBy("word")
        .agg(F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("n")), "words")
    near = near_words(words)
    frequent = F.col("best_n") >= ratio * F.col("n")
    rows = written(
        words.join(near, "word", "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
            F.when(frequent, F.col("best")).alias("form"),
            F.when(frequent, F.col("best_n")).alias("form_n")), "variants")
    # n grows by ``ratio`` from form to form, which bounds their number; jumps double their reach.
    most = rows.agg(F.max("n")).first()[0] or 1
    steps, reach = 1, ratio
    while reach < most:
        steps, reach = steps + 1, reach * ratio
    roots = rows.where("form IS NOT NULL").select("word", F.col("form").alias("root"))
    for _ in range(max(0, steps - 1).bit_length()):
        further = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        roots = written(
            roots.join(further, "root", "left")
            .select("word", F.coalesce("next", "root").alias("root")), "roots")
    return rows.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
