"""Word hashes: the same for a word wherever it stands, in texts and words longer than a slice."""

import random
import tracemalloc

import numpy as np

from ledgerlake.llm.common import SLICE, Words, mix


def test_a_words_hash_does_not_hang_on_its_place():
    rng = random.Random(3)
    long = b"x" * (2 * SLICE + 17)
    words = [bytes(rng.choice(b"abc\xc3\xa9") for _ in range(rng.randint(1, 9))) for _ in range(40_000)] + [long]
    rng.shuffle(words)
    found = Words(b" ".join(words))
    alone = {w: int(Words(w).hash[0]) for w in set(words)}
    assert len(found) == len(words) and found.hash.tolist() == [alone[w] for w in words]
    assert len(set(alone.values())) == len(alone)


def test_begin_and_end_at_the_edges_of_a_slice():
    for n in (SLICE - 1, SLICE, SLICE + 1):
        found = Words(b"a" * n + b" b")
        assert found.begin.tolist() == [0, n + 1] and found.end.tolist() == [n, n + 2]
        assert found.hash[1] == Words(b"b").hash[0]
    assert len(Words(b"")) == 0 and len(Words(b" \n ")) == 0


def test_memory_of_a_long_text_goes_with_its_words():
    text = b"some words here and there " * 200_000
    tracemalloc.start()
    Words(text)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 20 * len(text)
    assert len(Words._up) == SLICE


def test_mix_keeps_numbers_apart():
    assert len(np.unique(mix(np.arange(100_000, dtype=np.uint64)))) == 100_000
