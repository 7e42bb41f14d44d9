"""Operators against plain versions of what they compute."""

import hashlib
import math
import random
from collections import Counter
from itertools import combinations

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from clicklens.llm import exact, fingerprints, langid, lm, near, pieces, quality, queries, secrets, suffixes
from clicklens.llm.lattice import load_pieces, log_likelihoods, marked

VOCABULARY = pieces.VOCABULARY


def made_texts(n, seed, words=300, length=60):
    draw = random.Random(seed)
    known = ["".join(draw.choices("abcdefgh", k=draw.randint(2, 9))) for _ in range(words)]
    return [" ".join(draw.choices(known, k=length)) for _ in range(n)], draw, known


def frame_of(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def test_collisions_of_the_content_hash_are_told_apart(spark):
    texts = ["a", "b", "A", "c", "b", "d"]
    found = exact.exact_groups(
        frame_of(spark, texts), content_hash=lambda t: F.when(t < "c", "1").otherwise("2"))
    assert {r.doc_id: (r.keep_id, r.group_size) for r in found.collect()} == {
        0: (0, 2), 2: (0, 2), 1: (1, 2), 4: (1, 2), 3: (3, 1), 5: (5, 1)}


def simhash_of(text):
    votes, total = [0] * 64, 0
    for term in text.lower().split(" "):
        h, w = xxhash.xxh64_intdigest(term.encode(), seed=42), min(12, len(term)) ** 2
        total += w
        for j in range(64):
            votes[j] += w * (h >> j & 1)
    return sum(1 << j for j in range(64) if 2 * votes[j] > total)


def test_fingerprints(spark):
    texts, _, _ = made_texts(23, 1, length=9)
    rows = frame_of(spark, texts).repartition(5)
    for per_bucket in (1, 4, 1000):
        for r in fingerprints.with_edited(rows, docs_per_bucket=per_bucket).collect():
            text, following = texts[r.doc_id], texts[(r.doc_id + 1) % 23]
            half = len(text) // 2
            edited = text[:len(text) - half] + following[:half]
            assert r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
            for found, of in ((r.fingerprint, text), (r.edited_fingerprint, edited),
                              (r.next_fingerprint, following)):
                assert found % 2**64 == simhash_of(of)


def test_all_fingerprints_within_the_radius(spark):
    draw = random.Random(2)
    base = [draw.getrandbits(64) for _ in range(12)]
    prints = {b ^ sum(1 << i for i in draw.sample(range(64), k)) for b in base for k in range(6) for _ in range(6)}
    signed = [p - 2**64 if p >= 2**63 else p for p in prints]
    rows = spark.createDataFrame([(p,) for p in signed], "fingerprint long")
    found = {(r.a, r.b) for r in fingerprints.within_radius(rows, rows).collect()}
    expected = {(a, b) for a in signed for b in signed
                if a != b and ((a ^ b) % 2**64).bit_count() <= 3}
    assert found == expected
    assert fingerprints.within_radius(rows, rows).count() == len(expected)


def test_links_of_searched_documents(spark):
    draw = random.Random(8)
    # Half of the fingerprints share 44 bits, so that most tables have one hot key.
    base, hot = [draw.getrandbits(64) for _ in range(20)], draw.getrandbits(44) << 20
    prints = [b ^ sum(1 << i for i in draw.sample(range(64), k)) for b in base for k in range(5) for _ in range(5)]
    prints += [hot | draw.getrandbits(20) for _ in range(500)]
    prints += [prints[0]] * 40 + [prints[-1]] * 40
    rows = [(i or None, p - 2**64 if p >= 2**63 else p) for i, p in enumerate(prints)]
    frame = spark.createDataFrame(rows, "doc_id long, fingerprint long").repartition(5)
    found = fingerprints.with_links(frame, F.col("doc_id") % 7 == 0).collect()
    assert len(found) == len(rows)
    for r in found:
        if r.doc_id is None or r.doc_id % 7:
            assert (r.same_documents, r.same_id, r.near_fingerprints, r.near_documents) == (None,) * 4
            continue
        same = [i for i, p in rows if p == r.fingerprint]
        near = [(i, p) for i, p in rows if p != r.fingerprint and ((p ^ r.fingerprint) % 2**64).bit_count() <= 3]
        assert (r.same_documents, r.same_id) == (len(same) - 1, min(i for i in same if i))
        assert (r.near_fingerprints, r.near_documents) == (len({p for _, p in near}), len(near))
        assert r.near_id == min((i for i, _ in near if i), default=None)


def test_the_query_links_fingerprints(spark):
    rows = queries.op7_fingerprints(spark, "/root/testdata/sf0.001").collect()
    prints = {r.fingerprint: int(r.fingerprint, 16) for r in rows}
    for r in rows:
        near = sum(0 < (p ^ prints[r.fingerprint]).bit_count() <= 3 for p in prints.values())
        assert r.near_fingerprints == (None if r.doc_id % queries.SEARCHED else near)


def all_ways(text, known):
    if not text:
        yield ()
    for i in range(1, len(text) + 1):
        if text[:i] in known:
            for rest in all_ways(text[i:], known):
                yield (text[:i], *rest)


def test_n_best_are_the_best_of_all_segmentations():
    vocabulary = load_pieces(VOCABULARY)
    encoder = pieces.Encoder(vocabulary, n_best=6)
    known = {t: s for t, s in zip(vocabulary.texts, encoder.scores) if t}
    for text in ("hello world", "antithesis", "the the", "a b"):
        segments = pieces.split_segments(text)
        encoder.learn(set(segments))
        packed, found = encoder.encode(segments)
        expected = sorted((sum(known[p] for p in way) for way in all_ways(marked(" " + text), known)),
                          reverse=True)[:6]
        assert [score for score, _ in found] == expected
        ids = np.frombuffer(packed, dtype="<i4").tolist()
        assert sum(encoder.scores[ids]) == expected[0]


def test_encoder_remembers_no_more_than_asked_and_encodes_alike():
    vocabulary, draw = load_pieces(VOCABULARY), random.Random(16)
    words = ["".join(draw.choices("abcdefgh", k=draw.randint(2, 8))) for _ in range(400)]
    texts = [" ".join(draw.choices(words, k=10)) for _ in range(120)]
    few, many = (pieces.Encoder(vocabulary, remembered=n) for n in (20, 10_000))
    for text in texts:
        segments = pieces.split_segments(text)
        for encoder in (few, many):
            encoder.learn(set(segments))
        assert few.encode(segments) == many.encode(segments)
        assert max(len(few.new), len(few.old)) <= 20 + 10
    assert len(many.new) > 300


def test_marginal_likelihood_is_the_sum_over_all_segmentations():
    vocabulary = load_pieces(VOCABULARY)
    scores = lm.starting_scores(vocabulary)
    known = {t: s for t, s in zip(vocabulary.texts, scores) if t}
    words = ["hello", "antithesis", "a", "zoo"]
    for word, found in zip(words, log_likelihoods([marked(" " + w) for w in words], vocabulary, scores)):
        ways = [sum(known[p] for p in way) for way in all_ways(marked(" " + word), known)]
        assert found == pytest.approx(math.log(sum(map(math.exp, ways))))


def test_token_scores(spark):
    texts, _, _ = made_texts(30, 5, words=40, length=12)
    rows = frame_of(spark, [t + " X" * (i % 3) for i, t in enumerate(texts)])
    learned = F.col("doc_id") % 5 != 0
    found = {c: lm.lm_scores(rows, learned, common=c, rounds=1).collect() for c in (0, 10, 1000)}
    counts, docs = Counter(), {r.doc_id: r.text.lower().split() for r in rows.collect()}
    for i, words in docs.items():
        if i % 5:
            counts.update([*words, ""])
    n, v = sum(counts.values()), len(counts)
    for r in found[10]:
        tokens = [*docs[r.doc_id], ""]
        assert (r.n_tokens, r.train_tokens) == (len(tokens), n)
        assert r.n_known == sum(counts[t] > 0 for t in tokens)
        assert r.base_score == pytest.approx(sum(
            math.log10((counts[t] + 0.1) / (n + 0.1 * (v + 1))) for t in tokens))
    for c in (0, 1000):
        assert {r.doc_id: pytest.approx(r.score) for r in found[10]} == {r.doc_id: r.score for r in found[c]}


def test_alignment():
    def plain(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            above, row = row, [i]
            for j, y in enumerate(b, 1):
                row.append(min(above[j] + 1, row[-1] + 1, above[j - 1] + (x != y)))
        return row[-1]

    draw = random.Random(4)
    for _ in range(2000):
        a, b = ([draw.choice("abc") for _ in range(draw.randint(0, 12))] for _ in range(2))
        band, d = draw.randint(0, 8), plain(a, b)
        assert near.banded_distance(a, b, band) == (d if d <= band else None)


def test_near_duplicates(spark):
    texts, draw, known = made_texts(20, 6, length=80)
    for base in range(20):
        for _ in range(4):
            words = texts[base].split()
            for i in draw.sample(range(80), 3):
                words[i] = draw.choice(known)
            texts.append(" ".join(words))
    found = {r.doc_id: r.class_id for r in near.near_groups(frame_of(spark, texts)).collect()}
    assert found == {i: i if i < 20 else (i - 20) // 4 for i in range(100)}


def linked_classes(texts, meet=lambda i, j: True):
    """The smallest number of each text's class, by alignment of all pairs that meet."""
    words, label = [t.lower().split() for t in texts], list(range(len(texts)))
    for i, j in combinations(range(len(texts)), 2):
        most = near.most_edits(len(words[i]), len(words[j]), near.SIMILARITY)
        if label[i] != label[j] and meet(i, j) and near.banded_distance(words[i], words[j], most) is not None:
            low, high = sorted((label[i], label[j]))
            label = [low if x == high else x for x in label]
    return dict(enumerate(label))


def test_all_links_of_texts_that_share_a_passage(spark):
    # Pairs of similarity 0.82; all other texts share 76 of 100 words with them.
    draw = random.Random(9)
    fresh = lambda n: ["".join(draw.choices("abcdefgh", k=7)) for _ in range(n)]
    passage, texts = fresh(76), []
    for _ in range(40):
        own = fresh(24)
        other = [w if i % 4 == 0 else x for i, (w, x) in enumerate(zip(own, fresh(24)))]
        texts += [" ".join(passage + own), " ".join(passage + other)]
    sketches = [near.order_minhash(near.labelled_kmers(w)) for w in near.word_hashes(texts)]
    expected = linked_classes(texts, lambda i, j: (sketches[i] == sketches[j]).any())
    assert sum(i != c for i, c in expected.items()) > 30
    assert {r.doc_id: r.class_id for r in near.near_groups(frame_of(spark, texts)).collect()} == expected


def test_split_buckets_part_no_linked_texts_and_keep_few_others_together(spark):
    # A common line, and words that all texts have by chance; every tenth text has an edited copy.
    draw = random.Random(12)
    known = ["".join(draw.choices("abcdefgh", k=7)) for _ in range(2000)]
    line, texts = draw.choices(known, k=12), []
    for i in range(300):
        words = line + draw.choices(known, k=draw.randint(40, 130))
        texts.append(" ".join(words))
        if i % 10 == 0:
            for at in draw.sample(range(len(words)), near.most_edits(len(words), len(words), near.SIMILARITY)):
                words[at] = draw.choice(known)
            texts.append(" ".join(words))
    pool = spark.createDataFrame([(str(i).encode(), t) for i, t in enumerate(texts)], "h binary, text string")
    left = pool.select(F.lit(0).alias("band"), F.lit(7).cast("long").alias("key"), "h", F.col("h").alias("label"))
    buckets = {}
    for r in near.refined(left, pool, near.SIMILARITY).collect():
        buckets.setdefault((r.band, r.key), set()).add(int(r.h))
    met = {pair for b in buckets.values() for pair in combinations(sorted(b), 2)}
    words = [t.split() for t in texts]
    linked = {(i, j) for i, j in combinations(range(len(texts)), 2) if near.banded_distance(
        words[i], words[j], near.most_edits(len(words[i]), len(words[j]), near.SIMILARITY)) is not None}
    assert len(linked) >= 30 and linked <= met
    assert len(met) < len(texts)  # words alone leave thousands


def test_rarest_runs_of_linked_texts_meet():
    draw, times = random.Random(13), np.arange(near.COUNTERS)[::-1]
    for _ in range(2000):
        similarity, known = draw.choice([0.75, 0.8, 0.9]), "abcdefghij"[:draw.randint(1, 10)]
        a = draw.choices(known, k=draw.randint(1, 40))
        b = list(a)
        for _ in range(draw.randint(0, near.most_edits(len(a), len(a), similarity) + 1)):
            at = draw.randrange(len(b) + 1)
            b[at:at + draw.randint(0, 1)] = draw.choices(known, k=draw.randint(0, 1))
        if near.banded_distance(a, b, near.most_edits(len(a), len(b), similarity)) is None or not b:
            continue
        for together in (1, 2):
            one, other = (near.rarest(w, times, together, similarity) for w in near.word_hashes([" ".join(a), " ".join(b)]))
            assert set(one.tolist()) & set(other.tolist()), (a, b, similarity, together)


def test_hubs_meet_all_of_other_classes_once(spark):
    rows = [(0, 1, bytes([i]), bytes([i if i < 5 else 5])) for i in range(12)]
    left = spark.createDataFrame(rows, "band int, key long, h binary, label binary")
    found = [(r.hub[0], r.h[0]) for r in near.with_hubs(left, 8, 1).collect()]
    pairs = [p for p in found if p[0] != p[1]]
    classes = [min(i, 5) for i in range(12)]
    expected = {(i, j) for i, j in combinations(range(12), 2) if classes[i] != classes[j]}
    assert sorted(tuple(sorted(p)) for p in pairs) == sorted(expected)
    assert {h for _, h in found} == set(range(12)) and {(i, i) for i in range(6)} <= set(found)


def test_buckets_are_open_until_all_pairs_have_met(spark):
    draw, rows = random.Random(14), []
    for key in range(60):
        n, classes = draw.randint(2, 14), draw.randint(2, 6)
        rows += [(0, key, bytes([i]), bytes([i % classes if i < classes else draw.randrange(classes)]))
                 for i in range(max(n, classes))]
    left = spark.createDataFrame(rows, "band int, key long, h binary, label binary")
    for most, each in ((2, 1), (8, 1), (8, 3)):
        met, open_ = {}, {}
        for r in near.with_hubs(left, most, each).collect():
            met.setdefault(r.key, set()).add(frozenset((r.hub, r.h)))
            open_[r.key] = r.open
        for key in range(60):
            texts = [(h, label) for _, k, h, label in rows if k == key]
            wanted = {frozenset((a, b)) for (a, x), (b, y) in combinations(texts, 2) if x != y}
            assert open_[key] or wanted <= met[key], (key, most, each)
        assert len(set(open_.values())) == 2, (most, each)


def test_texts_of_settled_buckets_are_not_moved_again(spark, monkeypatch):
    # Only the four that share a passage with others that are not like them need another round.
    draw = random.Random(15)
    fresh = lambda n: ["".join(draw.choices("abcdefgh", k=7)) for _ in range(n)]
    texts, passage = [], fresh(70)
    for _ in range(20):
        words = fresh(100)
        texts += [" ".join(words), " ".join(words[:-1] + fresh(1))]
    texts += [" ".join(passage + fresh(30)) for _ in range(4)]
    pools, distances = [], near.distances
    monkeypatch.setattr(near, "distances", lambda pairs, pool, similarity: pools.append(
        pool.count()) or distances(pairs, pool, similarity))
    found = {r.doc_id: r.class_id for r in near.near_groups(frame_of(spark, texts)).collect()}
    assert len(set(found.values())) == 24
    assert pools[0] == 44 and len(pools) > 1 and max(pools[1:]) <= 4


def test_all_links_of_short_texts(spark):
    draw = random.Random(10)
    known, texts = ["".join(draw.choices("abcdefgh", k=draw.randint(2, 9))) for _ in range(300)], []
    for n in [*range(1, 25)] * 5 + [*range(20, 42)]:
        base = draw.choices(known, k=n)
        texts.append(" ".join(base))
        for _ in range(3):
            words = list(base)
            for _ in range(draw.randint(1, max(1, n // 5))):
                at = draw.randrange(len(words) + 1)
                words[at:at + draw.randint(0, 1)] = draw.choices(known, k=draw.randint(0, 1))
            texts.append(" ".join(words))
    texts += ["a b c d e f g h", "a b c d e f g h i", "k l m n o p q r s", "k l m n o p q r t"]
    expected = linked_classes(texts)
    assert max(len(t.split()) for t in texts) > near.SHORT
    assert len(set(expected.values())) < 0.6 * len(texts)
    assert {r.doc_id: r.class_id for r in near.near_groups(frame_of(spark, texts)).collect()} == expected


def test_recall_of_scattered_edits(spark):
    draw, pairs, texts = random.Random(11), {}, []
    word = lambda: "".join(draw.choices("abcdefgh", k=7))
    for n in (20, 30, 100, 400):
        for similarity in (0.95, 0.9, 0.85, 0.8):
            for _ in range(100 if similarity == 0.8 else 25):
                base = [word() for _ in range(n)]
                other = list(base)
                for i in draw.sample(range(n), near.most_edits(n, n, similarity)):
                    other[i] = word()
                pairs.setdefault((n, similarity), []).append(len(texts))
                texts += [" ".join(base), " ".join(other)]
    found = {r.doc_id: r.class_id for r in near.near_groups(frame_of(spark, texts)).collect()}
    recall = {k: sum(found[i] == found[i + 1] for i in v) / len(v) for k, v in pairs.items()}
    assert min(recall.values()) >= 0.9, recall
    assert all(share == 1 for (n, _), share in recall.items() if n <= near.SHORT), recall
    assert len(set(found.values())) >= len(texts) / 2  # and nothing else is linked


def test_repeated_windows():
    draw = random.Random(3)
    for _ in range(150):
        length = draw.choice([4, 6, 12])
        base = bytes(draw.choices(b"ab", k=60))
        strings = list({
            base[i:i + draw.randint(1, 25)] + bytes(draw.choices(b"abc", k=draw.randint(0, 6)))
            for i in draw.choices(range(50), k=6)})
        counts = Counter(s[i:i + length] for s in strings for i in range(len(s) - length + 1))
        expected = [[counts[s[i:i + length]] > 1 for i in range(len(s) - length + 1)] for s in strings]
        for shards in (1, 2, 3):
            assert [x.tolist() for x in suffixes.repeated_windows(strings, shards, length)] == expected


@pytest.mark.parametrize("most_strings", [1, 20_000])
def test_repeated_spans(spark, most_strings):
    texts, draw, _ = made_texts(40, 7, length=150)
    passage = texts[0][100:520]
    for i in range(1, 30, 3):
        at = draw.randint(0, 300)
        texts[i] = texts[i][:at] + passage[draw.randint(0, 90):draw.randint(300, 420)] + texts[i][at:]
    texts[5] = texts[5] + " é" * 400
    counts = Counter()
    for t in texts:
        b = t.encode()
        counts.update(b[p:p + 200] for p in range(len(b) - 199))
    for r in suffixes.repeated_spans(frame_of(spark, texts), most_strings=most_strings).collect():
        b = texts[r.doc_id].encode()
        gone = bytearray(len(b))
        for p in range(len(b) - 199):
            if counts[b[p:p + 200]] > 1:
                gone[p:p + 200] = b"\1" * 200
        kept = bytes(x for x, y in zip(b, gone) if not y)
        spans = sum(1 for p, y in enumerate(gone) if y and (p == 0 or not gone[p - 1]))
        assert (r.n_bytes, r.n_removed, r.n_spans) == (len(b), sum(gone), spans)
        assert r.kept_sha256 == hashlib.sha256(kept).hexdigest()


SF = "/root/testdata/sf0.01"


def test_models_on_held_out_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    learn = F.crc32(F.col("doc_id").cast("string")) % 4 != 2
    langs = langid.identified(docs.where(~learn), langid.fit_langid(docs.where(learn))).collect()
    assert np.mean([r.lang_pred == r.row.lang for r in langs]) > 0.97
    grades = labels.where(learn).select(
        "doc_id", quality.grade_of_labels(F.col("quality"), F.col("toxic")).alias("grade"))
    model = quality.fit_quality(docs, grades)
    assert model.thresholds == sorted(model.thresholds)
    held = quality.graded(docs.where(~learn), model).select("row.doc_id", "tail_probability")
    judged = held.join(labels, "doc_id").collect()
    clean = [r.tail_probability >= quality.LEAST for r in judged if r.quality == 1 and r.toxic == 0]
    toxic = [r.tail_probability >= quality.LEAST for r in judged if r.toxic == 1]
    assert np.mean(clean) > 0.95 and np.mean(toxic) < 0.3


def test_secrets_are_found_and_long_words_are_not(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    learn = F.crc32(F.col("doc_id").cast("string")) % 4 != 2
    rows = secrets.scan_secrets(docs, learn).join(docs.select("doc_id", "text"), "doc_id").collect()
    for r in rows:
        found = r.text[r.start:r.start + r.length]
        assert r.is_secret == (any(c.isdigit() for c in found) and len(found) == 40)
    assert len([r for r in rows if r.is_secret]) > 100


def test_words_of_all_documents_are_counted(spark):
    draw = random.Random(11)
    known = list({"".join(draw.choices("abcdefghijklmnopqrstuvwxyz", k=draw.randint(3, 12))) for _ in range(7000)})
    texts = [" ".join(w for w in known[i::2500]) for i in range(2500)]
    held = ["-".join(known[i:i + 5]) for i in range(0, 7000 - 5, 700)]
    texts += [f"{x} {'9' * 16} x" for x in held]
    rows = frame_of(spark, texts)
    words = secrets.counted_words(rows)
    counts = Counter(known)
    assert {r.word: r.n for r in words.collect()} == counts
    pairs = np.ones((37, 37))
    for word in known:
        for a, b in zip(word, word[1:]):
            pairs[ord(a) - 97, ord(b) - 97] += 1
    chances = secrets.transitions(words)
    assert np.allclose(chances, np.log(pairs / pairs.sum(axis=1, keepdims=True)))
    found = secrets.with_coverage(secrets.findings(rows, chances, path_col="text"), words).collect()
    shares = {(r.id, r.start): r.features[secrets.FEATURES.index("covered")] for r in found}
    for i, x in enumerate(held):
        assert shares[2500 + i, 0] == secrets.covered(x, set(known)) > 0.5
        assert shares[2500 + i, len(x) + 1] == 0


def test_counts_of_words_never_part_texts_within_the_allowed_edits():
    rng = random.Random(3)
    for _ in range(300):
        a = [f"w{rng.randrange(40)}" for _ in range(rng.randrange(0, 60))]
        b = a[:rng.randrange(0, 60)] + [f"w{rng.randrange(40)}" for _ in range(rng.randrange(0, 9))]
        one, other = near.word_hashes([" ".join(a), " ".join(b)])
        least = near.least_edits([near.counted(one)], [near.counted(other)])[0]
        assert least <= near.banded_distance(a, b, len(a) + len(b))
