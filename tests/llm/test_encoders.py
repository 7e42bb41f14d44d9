"""The two encoders' shortcuts give what the plain ways give."""

import hashlib
import random

import numpy as np

from clicklens.llm.chunks import ChunkEncoder, vocabulary_path
from clicklens.llm.lattice import NONE, Pieces, arcs_of, by_length
from clicklens.llm.pieces import two_best


def small_pieces(*words):
    texts = [""] * 256 + list(words)
    scores = np.concatenate([np.full(256, -20.0), -np.arange(1.0, len(words) + 1)])
    return Pieces(texts, scores, np.arange(256, dtype=np.int32))


def test_lengths_without_a_piece_share_one_array():
    pieces = small_pieces("a", "b", "ab", "bbb", "abab")
    (_, codes), = by_length(["abba", "aaaa"])
    arcs = arcs_of(codes, pieces)
    assert arcs.ids[4][3] is arcs.none and arcs.ids[4][2] is arcs.none
    assert arcs.ids[2][1].tolist() == [258, NONE] and (arcs.none == NONE).all()


def test_two_best_equal_all_segmentations():
    words = ("a", "b", "ab", "ba", "bab", "abba", "aab", "bb")
    pieces, known = small_pieces(*words), {word: 256 + i for i, word in enumerate(words)}
    rng = random.Random(3)
    segments = ["".join(rng.choice("abc") for _ in range(rng.randint(1, 9))) for _ in range(80)]

    def ways(text):
        if not text:
            return [((), 0.0)]
        found = []
        for n in range(1, len(text) + 1):
            piece = known.get(text[:n], ord(text[0]) if n == 1 else None)
            if piece is not None:
                found += [((piece, *ids), pieces.scores[piece] + score) for ids, score in ways(text[n:])]
        return found

    for segment, (packed, score, gap) in zip(segments, two_best(segments, pieces, pieces.scores)):
        all_ways = dict(ways(segment))
        best, *others = sorted(all_ways.values(), reverse=True)
        assert score == best and gap == (best - others[0] if others else np.inf)
        assert all_ways[tuple(np.frombuffer(packed, dtype="<i4").tolist())] == best


def test_digests_equal_the_library():
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(vocabulary_path())
    library.no_truncation()
    own = ChunkEncoder(vocabulary_path())
    for text in ("", " ", "one two  two\n", "\x7f x <|endoftext|> żółć 😀", "ab" * 900 + " end"):
        ids = library.encode(text, add_special_tokens=False).ids
        wanted = [" ".join(map(str, ids)), library.decode(ids, skip_special_tokens=False)]
        digests = [hashlib.sha256(x.encode()).hexdigest() for x in wanted]
        assert own.digests(text.encode()) == (len(ids), *digests)
