"""Repeated passages: suffix arrays of shards, merged through their Burrows-Wheeler transforms."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clicklens.llm.common import named, ship_package, text_of, written

LENGTH = 200  # bytes of a string that counts as repeated
GRAM = 32  # bytes of an anchor
SHARDS = 2
BUCKET_BYTES = 1 << 17  # of the strings whose suffixes are sorted together
BUCKETS_A_TASK = 16
MOST_STRINGS = 20_000  # of one anchor in a bucket; beyond, strings are compared window by window
MOST_TASKS = 20_000
CHUNK = 1 << 19
LOW = np.uint64((1 << 20) - 1)
BASE, ODD, MIX = (np.uint64(x) for x in (
    0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F))
SECOND, THIRD = (np.uint64(x) for x in (0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3))
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))


def powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


class Anchors:
    """Cuts texts into runs of windows that share an anchor.

    The anchor of a window of ``LENGTH`` bytes is the gram in it whose hash is smallest,
    the leftmost of equals. Equal windows have equal anchors at equal places, so a window
    needs to be compared with those of the same anchor only.
    """

    def __init__(self) -> None:
        self.up = powers(BASE, CHUNK + LENGTH + 1)
        self.down = powers(INVERSE, CHUNK + LENGTH + 1)

    def grams(self, part: np.ndarray) -> np.ndarray:
        """Hashes of the ``GRAM`` bytes from each place on."""
        h, size = part, 1
        while size < GRAM:
            h = h[:-size] * self.up[size] + h[size:]
            size *= 2
        return h

    def places(self, h: np.ndarray, by: np.uint64) -> np.ndarray:
        """For each window, the place of its anchor; ``by`` chooses the order of hashes."""
        spread = LENGTH - GRAM + 1
        v = h * by
        v ^= v >> np.uint64(32)
        v *= MIX
        least, size = (v & ~LOW) | np.arange(len(v), dtype=np.uint64), 1
        while size * 2 <= spread:
            least = np.minimum(least[:-size], least[size:])
            size *= 2
        if size < spread:
            least = np.minimum(least[:len(least) - (spread - size)], least[spread - size:])
        return (least & LOW).astype(np.int64)

    def contents(self, part: np.ndarray, starts: np.ndarray, windows: np.ndarray) -> np.ndarray:
        """Hash of all bytes of each run of windows."""
        sums = np.concatenate([[np.uint64(0)], np.cumsum(part * self.down[:len(part)])])
        content = (sums[starts + windows + LENGTH - 1] - sums[starts]) * self.up[starts]
        return ((content + windows.astype(np.uint64) * ODD) * MIX).view(np.int64)

    def runs(self, data: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
        """(anchor, content, start, windows) of the runs of one text."""
        for begin in range(0, len(data) - LENGTH + 1, CHUNK):
            part = data[begin:begin + CHUNK + LENGTH - 1].astype(np.uint64) + np.uint64(1)
            h = self.grams(part)
            place = self.places(h, ODD)
            starts = np.concatenate([[0], np.flatnonzero(place[1:] != place[:-1]) + 1])
            windows = np.diff(np.append(starts, len(place)))
            content = self.contents(part, starts, windows)
            yield h[place[starts]].view(np.int64), content, starts + begin, windows

    def parts(self, strings: list[bytes]) -> tuple[np.ndarray, ...]:
        """(string, anchors, content, start, windows): runs of windows that share two more anchors.

        Equal windows also have all bytes from the first to the last of their three anchors
        in common, so ``anchors`` is a hash of these bytes and of the anchors' places there.
        The strings, ``CHUNK`` bytes in all at most, are worked on as one text.
        """
        lengths = np.array([len(x) for x in strings])
        firsts = np.cumsum(lengths) - lengths
        part = np.frombuffer(b"".join(strings), dtype=np.uint8).astype(np.uint64) + np.uint64(1)
        h = self.grams(part)
        zero, one, two = (self.places(h, by) for by in (ODD, SECOND, THIRD))
        of = np.repeat(np.arange(len(strings)), lengths)[:len(one)]
        inside = np.arange(len(one)) + LENGTH <= (firsts + lengths)[of]
        fresh = (one[1:] != one[:-1]) | (two[1:] != two[:-1]) | (of[1:] != of[:-1]) | (
            inside[1:] != inside[:-1])
        starts = np.concatenate([[0], np.flatnonzero(fresh) + 1])
        windows = np.diff(np.append(starts, len(one)))
        use = inside[starts]
        starts, windows = starts[use], windows[use]
        a, b = one[starts], two[starts]
        low = np.minimum(np.minimum(a, b), zero[starts])
        high = np.maximum(np.maximum(a, b), zero[starts]) + GRAM
        between = self.contents(part, low, high - low - LENGTH + 1).view(np.uint64)
        anchors = (between + ((a - low) * LENGTH + b - low).astype(np.uint64) * ODD) * MIX
        return (of[starts], anchors.view(np.int64), self.contents(part, starts, windows),
                starts - firsts[of[starts]], windows)


def dense(key: np.ndarray) -> np.ndarray:
    """Numbers in the order of the keys; equal keys have equal numbers."""
    order = np.argsort(key)
    ranked = key[order]
    out = np.empty(len(key), dtype=np.int64)
    out[order] = np.concatenate([[0], np.cumsum(ranked[1:] != ranked[:-1])])
    return out


class Rotations:
    """All rotations of some strings, each ended by a terminator, the smallest symbol."""

    def __init__(self, strings: list[bytes]) -> None:
        self.lengths = np.array([len(x) + 1 for x in strings])
        self.ends = np.cumsum(self.lengths) - 1
        n = int(self.lengths.sum())
        data = np.frombuffer(b"".join(strings), dtype=np.uint8)
        number = np.zeros(256, dtype=np.uint64)
        used = np.unique(data)
        number[used] = np.arange(1, len(used) + 1)
        inside = np.ones(n, dtype=bool)
        inside[self.ends] = False
        self.symbols = np.zeros(n, dtype=np.uint64)
        self.symbols[inside] = number[data]
        self.begin = np.repeat(self.ends - self.lengths + 1, self.lengths)
        self.size = np.repeat(self.lengths, self.lengths)
        self.place = np.arange(n) - self.begin

    def moved(self, by: int) -> np.ndarray:
        """For each rotation, the one that starts ``by`` places later in its string."""
        return self.begin + (self.place + by) % self.size

    def ranks(self, step: int) -> np.ndarray:
        """Order of the rotations by their first ``step`` symbols, as numbers.

        UTF-8 uses less than 256 symbols with the terminator, so eight of them are a key.
        """
        key, done = self.symbols.copy(), min(8, step)
        for i in range(1, done):
            key = (key << np.uint64(8)) | self.symbols[self.moved(i)]
        rank = dense(key)
        while done < step:
            # The second half may overlap the first: it is compared where that is equal.
            more = min(done, step - done)
            rank = dense(rank * (int(rank.max()) + 1) + rank[self.moved(more)])
            done += more
        return rank


def sorted_shard(rank: np.ndarray, step: int, moved, longest: int) -> np.ndarray:
    """Order of all rotations of a shard, from their order by ``step`` symbols, by doubling.

    Rotations that are equal all around keep the order of their strings.
    """
    while True:
        if step >= longest:
            return np.argsort(rank, kind="stable")
        rank = dense(rank * (int(rank.max()) + 1) + rank[moved(step)])
        step *= 2


def repeated_windows(strings: list[bytes], shards: int = SHARDS, length: int = LENGTH) -> list[np.ndarray]:
    """For each string, which of its windows of ``length`` bytes occur elsewhere in the strings.

    The strings are dealt into shards, and the rotations of each shard are sorted by
    themselves. The shards' Burrows-Wheeler transforms, with blocks of up to 40 bytes as
    their symbols, are then merged: an interleave of the shards that is in order of the first
    h bytes gives, sorted stably by the block before each rotation, the interleave in order
    of a block more. Where neighbours part is noted on the way; those that have not parted
    after ``length`` bytes have a common prefix as long. No suffix is sorted again.
    """
    step = max(d for d in range(1, 41) if length % d == 0)
    by_text = sorted(range(len(strings)), key=strings.__getitem__)
    dealt = [i for shard in range(min(shards, len(strings))) for i in by_text[shard::shards]]
    sizes = [len(by_text[shard::shards]) for shard in range(min(shards, len(strings)))]
    all_ = Rotations([strings[i] for i in dealt])
    rank = all_.ranks(step)
    block_before = rank[all_.moved(-step)]
    orders, onward = [], []
    first_string = first = 0
    for size in sizes:
        last = int(all_.ends[first_string + size - 1]) + 1
        mine = slice(first, last)

        def moved(by: int) -> np.ndarray:
            return all_.begin[mine] - first + (all_.place[mine] + by) % all_.size[mine]

        longest = int(all_.lengths[first_string:first_string + size].max())
        order = sorted_shard(dense(rank[mine]), step, moved, longest) + first
        lf = np.empty(len(order), dtype=np.int32)
        lf[by_number(block_before[order])] = np.arange(len(order))
        orders.append(order)
        onward.append(lf + first)
        first_string, first = first_string + size, last
    order, lf = np.concatenate(orders), np.concatenate(onward)
    symbol = block_before[order]
    merged = np.arange(first, dtype=np.int32)
    block = np.zeros(first, dtype=np.int32)
    for _ in range(length // step):
        c = symbol[merged]
        to = by_number(c)
        c, block = c[to], block[to]
        merged = lf[merged[to]]
        parted = (c[1:] != c[:-1]) | (block[1:] != block[:-1])
        block = np.concatenate([[0], np.cumsum(parted)])
    several = np.bincount(block)[block] > 1
    hits = order[merged[several]]
    fits = all_.place[hits] + length < all_.size[hits]
    flags = np.zeros(first, dtype=bool)
    flags[hits[fits]] = True
    out: list[np.ndarray] = [None] * len(strings)  # type: ignore[list-item]
    for i, end, size in zip(dealt, all_.ends.tolist(), all_.lengths.tolist()):
        out[i] = flags[end - size + 1:end - size + 1 + max(0, size - length)]
    return out


def by_number(numbers: np.ndarray) -> np.ndarray:
    """Stable order of small numbers, by their low and then their high 16 bits."""
    low = np.argsort((numbers & 0xFFFF).astype(np.uint16), kind="stable")
    if len(numbers) and int(numbers.max()) > 0xFFFF:
        return low[np.argsort((numbers >> 16).astype(np.uint16)[low], kind="stable")]
    return low


def spans_of(mask: np.ndarray) -> tuple[list[int], list[int]]:
    """Starts and lengths of the runs of True."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], mask.astype(np.int8), [0]])))
    return edges[::2].tolist(), (edges[1::2] - edges[::2]).tolist()


def numbered(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """key, id, text. The id is the key where it tells rows apart; else rows get numbers."""
    rows = docs.select(named(id_col).alias("id"), text_of(text_col).alias("text"))
    plain = rows.schema["id"].dataType.simpleString() in ("bigint", "int")
    if plain:
        twice = rows.groupBy("id").agg(F.count(F.lit(1)).alias("n")).where("n > 1 OR id IS NULL")
        plain = twice.isEmpty()
    if plain:
        return rows.select(F.col("id").cast("long").alias("key"), "id", "text")
    return written(rows.select(F.monotonically_increasing_id().alias("key"), "id", "text"), "suffix-docs")


def anchored(rows: DataFrame) -> DataFrame:
    """The runs of all texts: anchor, content, key, start, windows."""
    ship_package(rows.sparkSession)
    names = ["anchor", "content", "key", "start", "windows"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors = Anchors()
        for batch in batches:
            found: list[list[np.ndarray]] = [[] for _ in names]
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary())):
                data = np.frombuffer(text.as_py(), dtype=np.uint8)
                for anchor, content, start, windows in anchors.runs(data):
                    columns = anchor, content, np.full(len(start), key), start, windows
                    for held, column in zip(found, columns):
                        held.append(column)
            if found[0]:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(x).astype(np.int64)) for x in found], names)

    return rows.select("key", "text").mapInArrow(cut, ", ".join(f"{x} long" for x in names))


def repeated_spans(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int = SHARDS,
    bucket_bytes: int = BUCKET_BYTES, most_strings: int = MOST_STRINGS,
) -> DataFrame:
    """One row per document: id, n_bytes, n_removed, n_spans, kept_sha256.

    Texts are UTF-8 bytes. Every byte goes that is covered by a string of ``LENGTH`` bytes
    which also starts elsewhere, in the same document or another; strings are judged on
    the input. ``n_spans`` counts maximal removed runs, ``kept_sha256`` is the digest of
    what is left.

    Texts are cut into runs of windows with one anchor; an anchor that occurs once cannot
    be in a repeated string, which rules most of the corpus out by a count. Runs that are
    the same byte for byte are repeated as a whole. Anchors with different runs are cut
    finer by two more anchors, and the same is done once more. What is left are strings
    that share all anchors and differ: they are bucketed by anchor, and in each bucket
    shards are sorted and merged (``repeated_windows``). Where over ``most_strings`` share
    their anchors, they are spread over the cluster and compared window by window, so no
    task holds more. Runs are told apart by 128 bits of hash and more (anchors and content).

    Null texts are empty texts, null or repeated ids are separate documents, and rows that
    repeat are copies of each other. An empty table gives no rows.
    """
    rows = numbered(docs, id_col, text_col)
    runs = written(anchored(rows), "suffix-runs")
    often = runs.groupBy("anchor").agg(
        F.count(F.lit(1)).alias("n"), F.min("content").alias("a"), F.max("content").alias("b")
    ).where("n > 1").select("anchor", (F.col("a") != F.col("b")).alias("differ"))
    # Counts are stored before they are joined: only then can Spark split a hot anchor's rows.
    often = written(often, "suffix-often")
    shared = written(runs.join(often, "anchor"), "suffix-shared")
    distinct = shared.where("differ").groupBy("anchor", "content").agg(
        F.count(F.lit(1)).alias("times"), F.min(F.struct("key", "start", "windows")).alias("at"))
    distinct = written(distinct, "suffix-distinct")
    strings = written(_bytes_of(distinct, rows), "suffix-strings")
    found = _shared_windows(strings, shards, bucket_bytes, most_strings)
    runs_of = shared.join(
        distinct.select("anchor", "content", "times"), ["anchor", "content"], "left"
    ).join(found, ["anchor", "content"], "left")
    whole = ~F.col("differ") | (F.col("times") > 1)
    spans = F.when(
        whole, F.array(F.struct(F.lit(0).cast("long").alias("start"), F.col("windows").alias("n")))
    ).otherwise(F.col("spans"))
    covered = runs_of.select("key", "start", F.explode(spans).alias("span")).select(
        "key", (F.col("start") + F.col("span.start")).alias("start"),
        (F.col("span.n") + LENGTH - 1).alias("n"))
    covered = covered.groupBy("key").agg(
        F.collect_list("start").alias("starts"), F.collect_list("n").alias("lengths"))
    cut_out = F.pandas_udf(_cut_out, "n_removed long, n_spans long, kept_sha256 string")
    left = rows.join(covered, "key").select("key", cut_out("text", "starts", "lengths").alias("k"))
    left = written(left, "suffix-kept")
    slim = rows.select("key", "id", F.octet_length("text").cast("long").alias("n_bytes"),
                       F.sha2("text", 256).alias("whole"))
    zero = F.lit(0).cast("long")
    return slim.join(left, "key", "left").select(
        F.col("id").alias(id_col), "n_bytes",
        F.coalesce("k.n_removed", zero).alias("n_removed"),
        F.coalesce("k.n_spans", zero).alias("n_spans"),
        F.coalesce("k.kept_sha256", "whole").alias("kept_sha256"))


def _bytes_of(distinct: DataFrame, rows: DataFrame) -> DataFrame:
    """anchor, content, bytes of each distinct run."""
    wanted = distinct.select("at.key", F.struct("anchor", "content", "at.start", "at.windows").alias("w"))
    wanted = wanted.groupBy("key").agg(F.collect_list("w").alias("w"))
    data = F.encode("text", "UTF-8")
    each = rows.join(wanted, "key").select(data.alias("data"), F.explode("w").alias("w"))
    return each.select(
        "w.anchor", "w.content",
        F.expr(f"substring(data, int(w.start + 1), int(w.windows + {LENGTH - 1}))").alias("bytes"))


def _shared_windows(
    strings: DataFrame, shards: int, bucket_bytes: int, most_strings: int
) -> DataFrame:
    """anchor, content and the spans (start, n) of windows that other strings of the anchor have.

    Two more anchors cut the strings finer, and the same count as before leaves few of them.
    """
    ids, names = ["anchor", "anchors"], ["anchor", "content", "anchors", "inner", "start", "windows"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter = Anchors()
        for batch in batches:
            data = batch.column(2).to_pylist()
            of_anchor, of_content = (batch.column(i).to_numpy() for i in (0, 1))
            at = 0
            while at < len(data):
                end, size = at, 0
                while end < len(data) and size + len(data[end]) <= CHUNK:
                    size += len(data[end])
                    end += 1
                string, anchors, inner, start, windows = cutter.parts(data[at:end])
                columns = (of_anchor[at + string], of_content[at + string], anchors, inner, start, windows)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x.astype(np.int64)) for x in columns], names)
                at = end

    parts = written(
        strings.select("anchor", "content", "bytes").mapInArrow(
            cut, ", ".join(f"{x} long" for x in names)), "suffix-parts")
    often = parts.groupBy(*ids).agg(
        F.count(F.lit(1)).alias("n"), F.min("inner").alias("a"), F.max("inner").alias("b")
    ).where("n > 1").select(*ids, (F.col("a") != F.col("b")).alias("differ"))
    often = written(often, "suffix-parts-often")
    shared = written(parts.join(often, ids), "suffix-parts-shared")
    distinct = written(
        shared.where("differ").groupBy(*ids, "inner").agg(
            F.count(F.lit(1)).alias("times"), F.min(F.struct("content", "start", "windows")).alias("at")),
        "suffix-inner")
    # A string's open parts are searched as one, with the windows between them.
    open_ = shared.where("differ").join(distinct.where("times = 1").select(*ids, "inner"), [*ids, "inner"])
    open_ = open_.groupBy("anchor", "content").agg(
        F.min("start").alias("start"), F.max(F.col("start") + F.col("windows")).alias("end"))
    open_ = open_.select("anchor", "content", "start", (F.col("end") - F.col("start")).alias("windows"),
                         F.lit(True).alias("open"))
    settled = distinct.where("times > 1").select("anchor", "at.*", F.lit(False).alias("open"))
    searched = written(
        open_.unionByName(settled).join(strings, ["anchor", "content"]).select(
            "anchor", "content", "start", "open", F.expr(
                f"substring(bytes, int(start + 1), int(windows + {LENGTH - 1}))").alias("bytes")),
        "suffix-searched")
    size = searched.agg(F.sum(F.length("bytes"))).first()[0] or 0
    crowded = searched.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > most_strings)
    met = _merged(
        searched.join(crowded, "anchor", "left_anti"), max(1, -(-size // bucket_bytes)), shards
    ).unionByName(_window_by_window(searched.join(crowded, "anchor", "left_semi")))
    whole = shared.join(distinct.select(*ids, "inner", "times"), [*ids, "inner"], "left").where(
        "NOT differ OR times > 1").select("anchor", "content", "start", F.col("windows").alias("n"))
    return whole.unionByName(met).groupBy("anchor", "content").agg(
        F.collect_list(F.struct("start", "n")).alias("spans"))


def _merged(strings: DataFrame, buckets: int, shards: int) -> DataFrame:
    """anchor, content, start and n of repeated windows of the open strings, bucket by bucket."""
    columns = ["anchor", "content", "start", "n"]

    def work(pdf: pd.DataFrame) -> pd.DataFrame:
        # A string may stand here twice: as a part of an open one, and settled by itself.
        found = repeated_windows(list(pdf["bytes"]), shards)
        out = [
            (anchor, content, start + s, n)
            for anchor, content, start, is_open, mask in zip(
                pdf["anchor"], pdf["content"], pdf["start"], pdf["open"], found) if is_open
            for s, n in zip(*spans_of(mask))]
        return pd.DataFrame(out, columns=columns)

    bucket = F.pmod(F.xxhash64("anchor"), F.lit(buckets))
    # Little data and much work: not as few tasks as the bytes alone would ask for.
    tasks = min(MOST_TASKS, -(-buckets // BUCKETS_A_TASK))
    dealt = strings.withColumn("bucket", bucket).repartition(tasks, "bucket")
    return dealt.groupBy("bucket").applyInPandas(work, ", ".join(f"{x} long" for x in columns))


def _window_by_window(strings: DataFrame) -> DataFrame:
    """The same by counting equal windows: for anchors with very many different strings."""
    window = F.expr(f"substring(bytes, int(at + 1), {LENGTH})")
    each = strings.select(
        "anchor", "content", "start", "open", "bytes",
        F.explode(F.sequence(F.lit(0), F.length("bytes") - LENGTH)).alias("at")
    ).select("anchor", "content", (F.col("start") + F.col("at")).alias("start"), "open",
             F.md5(window).alias("w"))
    # Windows of one string differ, so two equal ones are of two strings, or settled.
    often = each.groupBy("anchor", "w").agg(F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    return each.where("open").join(often, ["anchor", "w"]).select(
        "anchor", "content", "start", F.lit(1).cast("long").alias("n"))


def _cut_out(texts: pd.Series, starts: pd.Series, lengths: pd.Series) -> pd.DataFrame:
    out = []
    for text, at, n in zip(texts, starts, lengths):
        data = np.frombuffer(text.encode(), dtype=np.uint8)
        depth = np.zeros(len(data) + 1, dtype=np.int64)
        np.add.at(depth, np.asarray(at), 1)
        np.add.at(depth, np.asarray(at) + np.asarray(n), -1)
        gone = np.cumsum(depth[:-1]) > 0
        out.append((int(gone.sum()), len(spans_of(gone)[0]),
                    hashlib.sha256(data[~gone].tobytes()).hexdigest()))
    return pd.DataFrame(out, columns=["n_removed", "n_spans", "kept_sha256"])
