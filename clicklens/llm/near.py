"""Near duplicates by Order MinHash, verified by banded alignment."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clicklens.llm.common import named, one_of_each, share, ship_package, text_of, written

SHINGLE = 5  # words of a k-mer
SKETCHES = 96
ORDERED = 2  # k-mers of a sketch, kept in the order of the text
SIMILARITY = 0.8
HUBS = 8  # of a bucket in the second round
GROWTH = 8  # as many times more in each round after, and of a class: a round is many shuffles
SHORT = 40  # words of a text that meets all others by its words, too
TOGETHER = 3  # words that short texts meet by
COUNTED = 256  # classes that a text's words are counted by, at most 255 of each
WIDE = 64  # texts of a bucket that may be merged with others and split by words
FEW = 1 << 13  # texts to align that are picked where they lie, not moved with all others
COUNTERS = 1 << 20  # of hashes, which tell rare runs of words from common ones
BLOCK_WORDS = 200_000
BLOCK_HASHES = 1 << 15  # of k-mers at a time, few enough for a processor's cache
ODD = np.uint64(0x9E3779B97F4A7C15)
MIX = np.uint64(0xD6E8FEB86659FD93)


def labelled_kmers(words: np.ndarray, shingle: int = SHINGLE) -> np.ndarray:
    """Hashes of the k-mers of a text's word hashes, each with the number of its occurrence.

    Of a k-mer's occurrences those numbered 1, 2, 4, 8 and so on are sampled from: a line
    that a text repeats a thousand times would otherwise outnumber all the rest of it, and
    bring together all texts that repeat it. A text shorter than a k-mer is one k-mer.
    """
    if not len(words):
        return words
    n = max(1, len(words) - shingle + 1)
    h = np.zeros(n, dtype=np.uint64)
    for i in range(min(shingle, len(words))):
        h = h * ODD + words[i:i + n]
    order = np.argsort(h, kind="stable")
    ranked = h[order]
    fresh = np.concatenate([[True], ranked[1:] != ranked[:-1]])
    if not fresh.all():
        first = np.maximum.accumulate(np.where(fresh, np.arange(n), 0))
        times = np.empty(n, dtype=np.uint64)
        times[order] = (np.arange(n) - first).astype(np.uint64)
        number = times + np.uint64(1)
        h = (h + times * MIX)[number & times == 0]
    return h


def order_minhash(kmers: np.ndarray, sketches: int = SKETCHES, ordered: int = ORDERED) -> np.ndarray:
    """One value per sketch: its ``ordered`` smallest k-mers, hashed in the order of the text."""
    out = np.zeros(sketches, dtype=np.uint64)
    if not len(kmers):
        return out
    take = min(ordered, len(kmers))
    step = max(1, BLOCK_HASHES // len(kmers))
    most = np.uint64(2**64 - 1)
    for at in range(0, sketches, step):
        seeds = np.arange(at + 1, min(sketches, at + step) + 1, dtype=np.uint64) * MIX
        rows = np.arange(len(seeds))
        v = kmers[None, :] ^ seeds[:, None]
        v *= ODD
        v ^= v >> np.uint64(32)
        v *= MIX
        places = np.empty((take, len(seeds)), dtype=np.int64)
        for i in range(take):
            places[i] = v.argmin(axis=1)
            v[rows, places[i]] = most
        places.sort(axis=0)
        h = np.zeros(len(seeds), dtype=np.uint64)
        for column in places:
            h = (h ^ kmers[column]) * ODD
            h ^= h >> np.uint64(31)
        out[at:at + len(seeds)] = h
    return out


def word_hashes(texts: list[str]) -> Iterator[np.ndarray]:
    """Hashes of the words, in lower case, of each text; texts are taken some at a time."""
    def hashed(block: list[list[str]]) -> Iterator[np.ndarray]:
        flat = [w for words in block for w in words]
        h = pd.util.hash_array(np.array(flat, dtype=object), categorize=False) if flat else \
            np.zeros(0, dtype=np.uint64)
        yield from np.split(h, np.cumsum([len(words) for words in block])[:-1])

    block, size = [], 0
    for text in texts:
        block.append(text.lower().split())
        size += len(block[-1])
        if size >= BLOCK_WORDS:
            yield from hashed(block)
            block, size = [], 0
    if block:
        yield from hashed(block)


def short_keys(words: list[str], similarity: float = SIMILARITY) -> list[int]:
    """What a short text meets others by: some of its words, three at a time.

    Words are numbered by occurrence and put in one order for all texts, long ones first. Two
    texts within the similarity have all but ``most_edits`` of the longer one's words in
    common, so the three first common ones are, in both, among the first ``most_edits`` of
    its own words and three. Below a similarity of 0.75, texts may have one in common only.
    A text of up to ``SHORT`` words meets all it may be linked to, so texts that are
    longer by what the similarity allows have keys too.
    """
    together = TOGETHER if similarity >= 0.75 else 1
    if not together <= len(words) <= longest(SHORT, similarity):
        return []
    seen: Counter[str] = Counter()
    numbered = []
    for word in words:
        seen[word] += 1
        numbered.append((-len(word), word, seen[word]))
    first = sorted(numbered)[:most_edits(len(words), len(words), similarity) + together]
    keys = ["\0".join(f"{word} {n}" for _, word, n in some) for some in combinations(first, together)]
    return pd.util.hash_array(np.array(keys, dtype=object), categorize=False).view(np.int64).tolist()


def counted(words: np.ndarray) -> bytes:
    """How many of a text's word hashes fall into each of ``COUNTED`` classes, a byte each."""
    counts = np.bincount((words % np.uint64(COUNTED)).astype(np.int64), minlength=COUNTED)
    return np.minimum(counts, 255).astype(np.uint8).tobytes()


def least_edits(ones: list[bytes], others: list[bytes]) -> np.ndarray:
    """Edits that texts of these counts differ by at least.

    An edit takes one word from a class and gives one to another at most, so the words that
    either text has over the other need an edit each.
    """
    a, b = (np.frombuffer(b"".join(x), dtype=np.uint8).reshape(-1, COUNTED).astype(np.int16)
            for x in (ones, others))
    over = a - b
    return np.maximum(np.maximum(over, 0).sum(axis=1), np.maximum(-over, 0).sum(axis=1)).astype(np.int64)


def longest(words: int, similarity: float) -> int:
    """Words of the longest text that one of so many may be linked to."""
    return int(words / similarity + 1e-9)


def most_edits(a: int, b: int, similarity: float) -> int:
    """Edits that two texts of so many words may differ by."""
    return int((1 - similarity) * max(a, b) + 1e-9)


def banded_distance(a: list[str], b: list[str], band: int) -> int | None:
    """Word edit distance of a and b, or None if it is over ``band``.

    Common ends are set aside, and words that the other text lacks bound the distance from
    below. Then the alignment matrix is filled column by column, only ``band`` cells to
    either side of the diagonal, with the differences between cells as bits of one number.
    """
    if len(a) < len(b):
        a, b = b, a
    start, end = 0, 0
    while start < len(b) and a[start] == b[start]:
        start += 1
    while end < len(b) - start and a[-1 - end] == b[-1 - end]:
        end += 1
    a, b = a[start:len(a) - end], b[start:len(b) - end]
    n, m = len(a), len(b)
    if m == 0 or n - m > band:
        return n if n <= band else None
    x, y = Counter(a), Counter(b)
    if max((x - y).total(), (y - x).total()) > band:
        return None
    band = min(band, n)
    places: dict[str, int] = {}
    for i, word in enumerate(a):
        places[word] = places.get(word, 0) | 1 << i
    width = 2 * band + 2
    ones, top = (1 << width) - 1, 1 << (width - 1)
    up = ones ^ ((1 << (width - band - 1)) - 1)  # cells one more than the cell above
    down = 0  # cells one less
    low = top >> 1
    shift = band + 1 - width
    edits = band
    for j, word in enumerate(b):
        at = places.get(word, 0)
        equal = (at << -shift if shift < 0 else at >> shift) & ones
        diagonal = ((((equal & up) + up) ^ up) | equal | down) & ones
        right_up = down | (ones ^ (diagonal | up))
        right_down = diagonal & up
        if j < n - band:
            edits += not diagonal & top
        else:
            edits += bool(right_up & low) - bool(right_down & low)
            low >>= 1
        half = diagonal >> 1
        up = right_down | (ones ^ (half | right_up))
        down = half & right_up
        shift += 1
    return edits if edits <= band else None


def sketched(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = SIMILARITY,
) -> DataFrame:
    """id, h (md5 of the text), words, counts, sketch and the short text's keys of every document."""
    ship_package(docs.sparkSession)
    most = longest(SHORT, similarity)

    @F.pandas_udf("words long, counts binary, sketch array<long>, short array<long>")
    def sketch(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in texts:
            sizes, counts, of, keys = [], [], [], []
            for text, words in zip(batch, word_hashes(list(batch))):
                sizes.append(len(words))
                counts.append(counted(words))
                of.append(order_minhash(labelled_kmers(words)).view(np.int64))
                keys.append(short_keys(text.lower().split(), similarity) if len(words) <= most else [])
            yield pd.DataFrame({"words": sizes, "counts": counts, "sketch": of, "short": keys})

    return docs.select(
        named(id_col).alias("id"), F.unhex(F.md5(text_of(text_col))).alias("h"),
        sketch(text_of(text_col)).alias("s")).select("id", "h", "s.*")


def distances(pairs: DataFrame, pool: DataFrame, similarity: float) -> DataFrame:
    """hub, h, hub_words, words, edits of each pair. ``edits`` is null when over twice what
    is allowed.

    Texts that their numbers or counts of words part are not aligned: ``edits`` is then
    what these differ by, which no alignment goes below. Hubs are texts of the pool that ``leads`` marks.
    """
    @F.pandas_udf("long")
    def differ(ones: pd.Series, others: pd.Series) -> pd.Series:
        return pd.Series(least_edits(list(ones), list(others)))

    sizes, leading = pool.select("h", "words", "counts"), pool.where("leads")
    sized = pairs.join(leading.select(
        F.col("h").alias("hub"), F.col("words").alias("hub_words"), F.col("counts").alias("hub_counts")), "hub")
    apart = F.abs(F.col("hub_words") - F.col("words"))
    sized = written(sized.join(sizes, "h").select(
        "hub", "h", "hub_words", "words",
        F.greatest(apart, differ("hub_counts", "counts")).alias("edits")), "near-pairs")
    parted = sized.where(F.col("edits") > allowed(similarity))
    pairs = sized.where(F.col("edits") <= allowed(similarity)).select("hub", "h")
    ends = pairs.select("h").union(pairs.select("hub")).distinct()
    if ends.limit(FEW + 1).count() <= FEW:
        ends = F.broadcast(written(ends, "near-ends"))
        pool, leading = pool.join(ends, "h", "left_semi"), leading.join(ends, "h", "left_semi")

    @F.pandas_udf("hub_words long, words long, edits long")
    def compare(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for ones, others in batches:
            out = []
            for one, other in zip(ones, others):
                a, b = one.lower().split(), other.lower().split()
                out.append((len(a), len(b), banded_distance(
                    a, b, 2 * most_edits(len(a), len(b), similarity))))
            yield pd.DataFrame(out, columns=["hub_words", "words", "edits"]).astype(
                {"edits": "Int64"})

    both = pairs.join(leading.select(F.col("h").alias("hub"), F.col("text").alias("hub_text")), "hub")
    both = both.join(pool.select("h", "text"), "h")
    aligned = both.select("hub", "h", compare("hub_text", "text").alias("d")).select("hub", "h", "d.*")
    return aligned.unionByName(parted)


def components(edges: DataFrame) -> DataFrame:
    """(node, label) of all nodes of the edges (a, b): the smallest node each is connected with.

    Every round, a node takes the smallest label among its own and its neighbours', and
    then the label of that label, so long chains shorten fast.
    """
    # First every b keeps one edge, to the smallest a it has, and its other a's get one to
    # that: the same components with far fewer edges, since many b's share their a's.
    least = edges.groupBy("b").agg(F.min("a").alias("least"))
    edges = least.select(F.col("least").alias("a"), "b").union(
        edges.join(least, "b").where("a <> least").select("least", "a")).distinct()
    ends = written(
        edges.select(F.col("a").alias("node"), F.col("b").alias("other"))
        .union(edges.select("b", "a")).distinct(), "near-edges")
    labels = ends.groupBy("node").agg(F.least(F.min("other"), F.col("node")).alias("label"))
    labels = written(labels, "near-labels")
    while True:
        near = ends.join(labels.select(F.col("node").alias("other"), "label"), "other")
        best = near.groupBy("node").agg(F.min("label").alias("near"))
        moved = labels.join(best, "node").select(
            "node", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        onward = labels.select(F.col("node").alias("label"), F.col("label").alias("onward"))
        moved = written(
            moved.join(onward, "label", "left")
            .select("node", "old", F.least("label", F.coalesce("onward", "label")).alias("label")),
            "near-labels")
        labels = moved.select("node", "label")
        if moved.where("label <> old").isEmpty():
            return labels


def near_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = SIMILARITY,
) -> DataFrame:
    """One row per document: id, class_id, text_md5, kept.

    Two texts are linked when the edit distance of their words, in lower case, is at most
    ``1 - similarity`` times the longer one's number of words; classes are what links
    connect. ``class_id`` is the smallest id of the class, and ``kept`` marks it.

    Equal texts are one node from the start, however many documents have them. A text's
    sketches each hold the hash-smallest of its five-word k-mers, labelled by occurrence,
    in the order of the text. Texts that agree in a sketch meet in a bucket; there every
    text is aligned with one of them, the hub. Texts linked to the hub leave the bucket
    when the triangle inequality shows that they cannot be linked to any that is not; the
    rest get other hubs, until all that are left in a bucket are of one class. So a group
    of thousands costs an alignment or a few each, and a large bucket is a join that Spark
    can split, never one task's list. What the first hub does not settle is mostly texts
    that share a common passage only; their bucket is split by rare runs of words
    (``refined``), which parts no pair within the similarity. So of the texts that agree in one sketch
    all links count. Texts of scattered edits may agree in none: an edit changes five
    k-mers, and a sketch agrees with about the square of the k-mers' Jaccard similarity.
    Of pairs with 100 words and scattered edits, 0.9 or more meet at a similarity of 0.8
    and nearly all above. Texts of up to ``SHORT`` words meet by their words as well
    (``short_keys``), and so by the similarity alone, whatever the other text's length.

    Null texts are empty texts; empty texts are one class. Null ids are members like any
    other; a class of null ids only has a null class_id. Rows that repeat id and text share
    all results. An empty table gives no rows.
    """
    return near_classes(docs, id_col, text_col, similarity).select(
        F.col("id").alias(id_col), "class_id", F.lower(F.hex("h")).alias("text_md5"),
        F.col("id").eqNullSafe(F.col("class_id")).alias("kept"))


def near_classes(docs: DataFrame, id_col: str, text_col: str, similarity: float) -> DataFrame:
    """id, h, label (smallest h of the class) and class_id of every document."""
    ids = written(sketched(docs, id_col, text_col, similarity), "near-sketches")
    sketches = ids.dropDuplicates(["h"])
    nodes = sketches.select("h", F.posexplode("sketch").alias("band", "key")).unionByName(
        sketches.select("h", F.lit(SKETCHES).alias("band"), F.explode("short").alias("key")))
    # Dealt and sorted once: a window, unlike a sum and a join, reads its rows a single time.
    bucket = Window.partitionBy("bucket")
    nodes = nodes.select(F.xxhash64("band", "key").alias("bucket"), "h").select(
        "h", F.min("h").over(bucket).alias("hub"), F.max("h").over(bucket).alias("last"))
    # Texts that share a passage meet in many buckets, and these in few hubs: the buckets of
    # one hub become one, which adds pairs and loses none.
    active = written(nodes.where("hub <> last").select(
        F.lit(0).alias("band"), F.xxhash64("hub").alias("key"), "h", "hub").distinct(), "near-buckets")
    members = active.groupBy("h").agg(F.max(F.col("h") == F.col("hub")).alias("leads"))
    spoken_for = ids.join(members, "h").groupBy("h").agg(
        F.min("id").alias("id"), F.max("words").alias("words"), F.max("counts").alias("counts"),
        F.max("leads").alias("leads"))
    texts = docs.select(
        named(id_col).alias("id"), F.unhex(F.md5(text_of(text_col))).alias("h"),
        text_of(text_col).alias("text"))
    one = texts["id"].eqNullSafe(spoken_for["id"]) & (texts["h"] == spoken_for["h"])
    pool = written(
        texts.join(spoken_for, one).select(
            texts["h"], "text", "words", "counts", "leads").dropDuplicates(["h"]),
        "near-pool")
    # Every text is a class of its own until links join them.
    labels, most, each = members.select("h", F.col("h").alias("label")), HUBS, 1
    active = active.withColumn("apart", F.col("h") != F.col("hub")).withColumn("open", F.lit(True))
    while True:
        pairs = active.where("apart").select("hub", "h").distinct()
        found = written(distances(pairs, pool, similarity), "near-distances")
        links = found.where(linked(similarity))
        if not links.isEmpty():
            labels = joined_classes(labels, links)
        left = unresolved(active.where("open"), found, similarity).join(labels, "h")
        left = written(of_several_classes(left), "near-open")
        if left.isEmpty():
            break
        # The other texts are not moved again: every round would move all of them twice.
        pool = written(pool.drop("leads").join(left.select("h").distinct(), "h").withColumn(
            "leads", F.lit(True)), "near-pool")
        if most == HUBS:
            left = of_several_classes(refined(left, pool, similarity))
        active = written(with_hubs(left, most, each), "near-buckets")
        if active.isEmpty():
            break
        most, each = most * GROWTH, each * GROWTH
    rows = ids.select("id", "h").join(labels, "h", "left").select(
        "id", "h", F.coalesce("label", "h").alias("label"))
    # Stored first, and only of several rows, so that a class of very many can be split.
    smallest = rows.groupBy("label").agg(
        F.min("id").alias("smallest"), F.count(F.lit(1)).alias("n")).where("n > 1")
    smallest = written(smallest, "near-smallest").withColumn("several", F.lit(True))
    class_id = F.when(F.col("several"), F.col("smallest")).otherwise(F.col("id"))
    return rows.join(smallest.hint("merge"), "label", "left").select(
        "id", "h", "label", class_id.alias("class_id"))


def allowed(similarity: float) -> Column:
    return F.floor((1 - similarity) * F.greatest("hub_words", "words") + 1e-9)


def linked(similarity: float) -> Column:
    return F.coalesce(F.col("edits") <= allowed(similarity), F.lit(False))


def joined_classes(labels: DataFrame, links: DataFrame) -> DataFrame:
    """The labels after the links (hub, h) have joined classes."""
    edges = (
        links.select("hub", "h")
        .join(labels.select(F.col("h").alias("hub"), F.col("label").alias("a")), "hub")
        .join(labels.select("h", F.col("label").alias("b")), "h")
        .where("a <> b").select("a", "b").distinct()
    )
    moved = components(edges).select(F.col("node").alias("label"), F.col("label").alias("now"))
    return written(
        labels.join(moved, "label", "left").select("h", F.coalesce("now", "label").alias("label")),
        "near-classes")


def unresolved(active: DataFrame, found: DataFrame, similarity: float) -> DataFrame:
    """What stays in the buckets (band, key, h) after a round.

    A hub has met all of its bucket that is not of its class, as the hub or as the text of
    another, and leaves. A text linked to it stays only if its distance to the hub does not
    show that every unlinked one, but for those that leave as hubs, is too far from it.
    """
    bucket, share = ["band", "key"], 1 - similarity
    met = active.where("h <> hub").join(found, ["hub", "h"], "left")
    # Over the band, the distance is at least the band and one.
    far = F.when(F.col("apart"), F.coalesce(F.col("edits"), 2 * allowed(similarity) + 1))
    met = met.select(
        *bucket, "hub", "h", "words", far.alias("far"), linked(similarity).alias("linked"), "apart")
    between = met.where("apart AND NOT linked").groupBy(*bucket, "hub").agg(
        F.min("far").alias("nearest"), F.min(F.col("far") - share * F.col("words")).alias("within"))
    clear = (F.col("far") < F.col("nearest") - share * F.col("words")) & (
        F.col("far") < F.col("within"))
    leave = (
        met.where("linked").join(between, [*bucket, "hub"]).where(clear).select(*bucket, "h")
        .union(active.select(*bucket, "hub")).distinct()
    )
    return active.select(*bucket, "h").distinct().join(leave, [*bucket, "h"], "left_anti")


def of_several_classes(left: DataFrame) -> DataFrame:
    """band, key, h and label of the buckets of more than one class.

    Of buckets that hold the same texts one is enough; they are told by 128 bits.
    """
    bucket = ["band", "key"]
    left = written(left.select(*bucket, "h", "label"), "near-left")
    held = left.groupBy(*bucket).agg(
        F.min("label").alias("a"), F.max("label").alias("b"), F.count(F.lit(1)).alias("n"),
        F.bit_xor(F.xxhash64("h")).alias("x"), F.bit_xor(F.xxhash64(F.lit(1), "h")).alias("y"))
    several = held.where("a <> b").groupBy("n", "x", "y").agg(F.min(F.struct(*bucket)).alias("one"))
    return left.join(written(several.select("one.*"), "near-several"), bucket)


def numbered_words(words: np.ndarray) -> np.ndarray:
    """Hashes of the words, each with the number of its occurrence in the text."""
    order = np.argsort(words, kind="stable")
    ranked = words[order]
    fresh = np.concatenate([[True], ranked[1:] != ranked[:-1]])
    first = np.maximum.accumulate(np.where(fresh, np.arange(len(words)), 0))
    return ranked + (np.arange(len(words)) - first).astype(np.uint64) * MIX


def rarest(words: np.ndarray, times: np.ndarray, together: int, similarity: float) -> np.ndarray:
    """Hashes of a text's rarest runs of ``together`` words, each with its number of occurrence.

    Of a text's runs, an edit inside breaks ``together`` and a word put in one less. So two
    texts within the similarity lack at most that share of each one's runs, floored, and the
    first run they have in common, in any order that is the same for all texts, is among so
    many and one of each. Runs are ordered by how many there are, ``times`` by hash.
    """
    runs = numbered_words(runs_of(words, together))
    order = np.lexsort((runs, times[(runs % np.uint64(len(times))).astype(np.int64)]))
    return runs[order[:int(together * (1 - similarity) * len(words) + 1e-9) + 1]]


def runs_of(words: np.ndarray, together: int) -> np.ndarray:
    """Hashes of the runs of so many words; a shorter text is one run."""
    n = max(1, len(words) - together + 1)
    h = np.zeros(n, dtype=np.uint64)
    for i in range(min(together, len(words))):
        h = h * ODD + words[i:i + n] * MIX
    return h


def split_by_runs(left: DataFrame, pool: DataFrame, together: int, similarity: float) -> DataFrame:
    """The buckets split: texts meet that have one of their rarest runs of words in common.

    What meets no other class is left out. Texts and classes are numbered for this: a text
    is there once for each of its runs, and numbers take a third of what hashes do.
    """
    bucket = ["band", "key"]
    numbers = written(left.select("h", "label").distinct().withColumn(
        "node", F.monotonically_increasing_id()), "near-numbers")
    classes = numbers.groupBy("label").agg(F.min("node").alias("class"))
    numbers = written(numbers.join(classes, "label"), "near-numbers")
    texts = written(pool.select("h", "text").join(numbers, "h").drop("h", "label"), "near-open")

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(COUNTERS, dtype=np.int64)
        for batch in batches:
            for words in word_hashes(list(batch["text"])):
                if len(words):
                    at = numbered_words(runs_of(words, together)) % np.uint64(COUNTERS)
                    np.add.at(total, at.astype(np.int64), 1)
        at = np.flatnonzero(total)
        yield pd.DataFrame({"at": at, "n": total[at]})

    counts = texts.select("text").mapInPandas(count, "at long, n long").groupBy("at").agg(
        F.sum("n").alias("n")).toArrow()
    times = np.zeros(COUNTERS, dtype=np.int64)
    times[counts["at"].to_numpy()] = counts["n"].to_numpy()
    shared = share(pool, times)

    @F.pandas_udf("array<long>")
    def rare(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        times = shared.value
        for batch in batches:
            yield pd.Series([
                (rarest(words, times, together, similarity) if len(words) else words).view(np.int64)
                for words in word_hashes(list(batch))], dtype=object)

    # Nearly all runs are of one text or one class, and bring together nothing new in any bucket.
    runs = written(texts.select("node", "class", F.explode(rare("text")).alias("run")), "near-runs")
    runs = written(of_classes(runs, ["run"]).select("node", "run"), "near-runs")
    parts = left.select(*bucket, "h").join(numbers, "h").select(*bucket, "node", "class").join(runs, "node")
    parts = written(parts.select("band", F.xxhash64("key", "run").alias("key"), "node", "class"), "near-parts")
    parts = written(of_classes(parts, bucket).select(*bucket, "node"), "near-parts")
    return parts.join(numbers, "node").select(*bucket, "h", "label")


def of_classes(rows: DataFrame, keys: list[str]) -> DataFrame:
    """The rows whose keys texts of more than one ``class`` have."""
    several = rows.groupBy(*keys).agg(F.min("class").alias("a"), F.max("class").alias("b")).where("a <> b")
    return rows.join(several.select(*keys), keys)


def refined(left: DataFrame, pool: DataFrame, similarity: float) -> DataFrame:
    """The buckets split by runs of two words, and the wide ones by words if that saves pairs.

    Words that few texts have are still shared by chance, ever more often in larger tables;
    runs of two hardly are. But texts are not told apart by runs once a passage takes more
    than about three fifths of them, so all of these meet, in a bucket for each run of the
    passage. Such wide buckets become one where their first text is the same, which
    loses no pair, and that is split by single words, unless the texts share
    so many that it would make more pairs than the bucket has. No linked pair is parted.
    """
    bucket = ["band", "key"]
    if similarity < 0.75:  # a text's edits could break all of its runs of two
        return split_by_runs(left, pool, 1, similarity)
    left = written(of_several_classes(split_by_runs(left, pool, 2, similarity)), "near-split")
    large = left.groupBy(*bucket).agg(F.count(F.lit(1)).alias("n"), F.min("h").alias("first"))
    large = written(large.where(F.col("n") > WIDE).select(*bucket, "first"), "near-large")
    narrow = left.join(large, bucket, "left_anti").withColumn("band", F.col("band").cast("long"))
    whole = F.xxhash64("first")
    wide = written(left.join(large, bucket).select(
        whole.alias("band"), whole.alias("key"), "h", "label").distinct(), "near-wide")
    if wide.isEmpty():
        return narrow
    parts = written(of_several_classes(split_by_runs(wide, pool, 1, similarity)), "near-parts")
    costs = pairs_of(wide).join(pairs_of(parts).withColumnRenamed("pairs", "split"), "band", "left")
    kept = written(costs.where(F.col("pairs") <= F.coalesce("split", F.lit(0))).select("band"), "near-kept")
    return (
        narrow.unionByName(wide.join(kept, "band", "left_semi").select(narrow.columns))
        .unionByName(parts.join(kept, "band", "left_anti").select(narrow.columns))
    )


def pairs_of(left: DataFrame) -> DataFrame:
    """band, pairs: how many rows the texts and their hubs can come to in all its buckets."""
    classes = left.groupBy("band", "key", "label").agg(F.count(F.lit(1)).alias("n"))
    sizes = classes.groupBy("band", "key").agg(F.sum("n").alias("n"), F.max("n").alias("largest"))
    return sizes.groupBy("band").agg(F.sum(F.col("n") * (F.col("n") - F.col("largest") + 1)).alias("pairs"))


def with_hubs(left: DataFrame, most: int, each: int) -> DataFrame:
    """Every text with each of its bucket's next hubs of other classes, ``most`` at most.

    A hub is there with itself, too. ``open`` tells the buckets that may have pairs beyond these.

    Up to ``each`` texts of a class are hubs, one of every class before a second of any, and
    the smaller classes' first. The largest class has one: a bucket is done when all texts of
    its other classes have been hubs.
    """
    bucket = ["band", "key"]
    sizes = left.groupBy(*bucket, "label").agg(F.count(F.lit(1)).alias("n"))
    largest = sizes.groupBy(*bucket).agg(
        F.max(F.struct("n", "label"))["label"].alias("largest"),
        (F.sum("n") - F.max("n")).alias("others"),
        (F.sum(F.least("n", F.lit(each))) - F.least(F.max("n"), F.lit(each))).alias("turns"))
    # With all but the largest class as hubs, all pairs meet, and the bucket is done.
    largest = largest.select(
        *bucket, "largest", ((F.col("others") > F.col("turns")) | (F.col("others") >= most)).alias("open"))
    in_class = Window.partitionBy(*bucket, "label").orderBy("h")
    first = left.withColumn("turn", F.row_number().over(in_class)).where(F.col("turn") <= each)
    first = first.join(sizes, [*bucket, "label"]).join(largest, bucket).where(
        "turn = 1 OR label <> largest")
    in_turn = Window.partitionBy(*bucket).orderBy("turn", "n", "h")
    hubs = first.withColumn("rank", F.row_number().over(in_turn)).where(F.col("rank") <= most)
    hubs = written(hubs.select(
        *bucket, F.col("h").alias("hub"), F.col("label").alias("hub_label"), "open"), "near-hubs")
    marks = hubs.select(*bucket, F.col("hub").alias("h"), F.lit(True).alias("is_hub"))
    marked = left.join(marks, [*bucket, "h"], "left")
    # Two hubs are one pair, and texts of one class none. There are hubs of two classes at
    # least, so every text has one that is not of its own, or is one.
    meets = (F.col("h") == F.col("hub")) | (F.col("label") != F.col("hub_label")) & (
        F.col("is_hub").isNull() | (F.col("hub") < F.col("h")))
    same = (marked["band"] == hubs["band"]) & (marked["key"] == hubs["key"])
    return marked.join(hubs, same & meets).select(
        marked["band"], marked["key"], "h", "hub", (F.col("h") != F.col("hub")).alias("apart"), "open")


def drop_near(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = SIMILARITY
) -> DataFrame:
    """One document of each class, with all its columns: the one with the smallest id."""
    found = near_classes(docs, id_col, text_col, similarity)
    # Of a class's texts with the smallest id, where ids repeat, one stays.
    stays = found.where(F.col("id").eqNullSafe(F.col("class_id"))).groupBy("label").agg(
        F.min("h").alias("stay"))
    found = found.join(stays, "label").select("id", F.col("h").alias("hash"), (
        F.col("id").eqNullSafe(F.col("class_id")) & (F.col("h") == F.col("stay"))).alias("kept"))
    return one_of_each(docs, found, id_col, F.unhex(F.md5(text_of(text_col))))
