import random
import time
import zlib
from collections import Counter

import numpy as np
import public_tokenizers as P
import pytest

from pavespark.llm import packing

WORDS = P.path("word_bpe_49k.json")


def sequences_of(plan):
    return sum(times for times, _ in plan.groups)


def check_plan(histogram, capacity=4096):
    plan = packing.Plan(dict(histogram), capacity)
    held = Counter()
    for times, lengths in plan.groups:
        assert times > 0 and sum(lengths) <= capacity
        for n in lengths:
            held[n] += times
    assert held == Counter({n: c for n, c in histogram.items() if c})
    return plan


@pytest.mark.parametrize("seed", range(4))
def test_plan_holds_every_piece_and_is_near_the_bound(seed):
    rng = random.Random(seed)
    histogram = Counter(min(4096, max(1, int(rng.lognormvariate(6, 1)))) for _ in range(6000))
    plan = check_plan(histogram)
    least = -(-sum(n * c for n, c in histogram.items()) // 4096)
    assert sequences_of(plan) <= 1.02 * least + 1


def test_plan_finds_exact_partners():
    plan = check_plan({2049: 300, 2047: 300})
    assert sequences_of(plan) == plan.least == 300
    assert sequences_of(check_plan({1366: 1400, 1364: 700})) == 700


def lower_bound(histogram, capacity=4096):
    """No packing needs fewer: pieces over half a sequence need one each, and what does not fit
    beside those of at most ``capacity - a`` needs room of its own (for every a)."""
    best = -(-sum(n * c for n, c in histogram.items()) // capacity)
    for a in range(1, capacity // 2 + 1):
        full = sum(c for n, c in histogram.items() if n > capacity - a)
        large = {n: c for n, c in histogram.items() if capacity < 2 * n <= 2 * (capacity - a)}
        small = sum(n * c for n, c in histogram.items() if a <= n and 2 * n <= capacity)
        room = sum((capacity - n) * c for n, c in large.items())
        best = max(best, full + sum(large.values()) + max(0, -(-(small - room) // capacity)))
    return best


@pytest.mark.parametrize("lengths,within", [(100, 1.012), (2805, 1.001), (4096, 1.015)])
def test_plan_at_any_number_of_lengths(lengths, within):
    """The same method for few and for all lengths; seconds on the driver, near the bound."""
    rng = random.Random(5)
    if lengths == 100:
        histogram = {n: rng.randrange(1, 40) for n in rng.sample(range(50, 3000), 100)}
    elif lengths == 2805:
        histogram = Counter(min(4096, max(1, int(rng.lognormvariate(6, 1.1)))) for _ in range(20_000))
    else:
        histogram = {n: rng.randrange(1, 30) for n in range(1, 4097)}
    began = time.process_time()
    plan = check_plan(histogram)
    assert time.process_time() - began < 15  # 1 to 3 s alone
    least = lower_bound(histogram)
    assert plan.least <= least <= sequences_of(plan) <= within * least


def test_cover_holds_every_class():
    rng = np.random.default_rng(2)
    sizes = np.sort(rng.choice(np.arange(1, 40), 15, replace=False))
    demand = rng.integers(1, 1000, 15).astype(float)
    held = np.zeros(15)
    for config, x in packing.configurations(sizes, demand, 60):
        assert sizes[config].sum() <= 60 and x > 0
        np.add.at(held, config, x)
    assert (held >= demand * (1 - 1e-9)).all()


def test_plan_of_few_and_of_no_pieces():
    assert sequences_of(check_plan({})) == 0
    assert sequences_of(check_plan({5: 1})) == 1
    assert sequences_of(check_plan({4096: 7, 4095: 2, 1: 2})) == 9
    assert sequences_of(check_plan({3000: 5, 1000: 5, 96: 5})) == 5


def test_knapsack_against_brute_force():
    import itertools

    rng = np.random.default_rng(1)
    for _ in range(20):
        sizes = np.sort(rng.choice(np.arange(2, 12), 4, replace=False))
        values, room = rng.random(4), 20
        best = max(sum(c * v for c, v in zip(counts, values, strict=True))
                   for counts in itertools.product(range(11), repeat=4)
                   if sum(c * s for c, s in zip(counts, sizes.tolist(), strict=True)) <= room)
        found = packing.best_configuration(values, sizes, room)
        assert sizes[found].sum() <= room
        assert abs(values[found].sum() - best) < 1e-9


def test_ids_equal_the_library(odd_texts):
    from tokenizers import Tokenizer

    library, texts = Tokenizer.from_file(WORDS), [t or "" for t in odd_texts] * 2
    texts += ["Straße ÄÖÜ, naïve. cafe\u0301 " + "x" * 200 + " " + "ab." * 90, "a.b,c. d.. ,e '" + "Y" * 70 + ",", "ªº µ ÿ Ā ĳ ŉ ﬁ"] * 2
    own = packing.ChunkIds(WORDS, bound=5)
    for text, ids in zip(texts, own.encode(texts), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids
    assert max(map(len, own.known)) <= packing.LONGEST_KEPT


def test_packed(spark, odd_docs, no_docs):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(WORDS)
    rows = packing.packed(odd_docs, WORDS, capacity=512).collect()
    pieces = []
    for r in odd_docs.collect():
        ids = [*library.encode(r["text"] or "", add_special_tokens=False).ids, 1]
        for piece, at in enumerate(range(0, len(ids), 512)):
            part = np.array(ids[at:at + 512], "<u4")
            pieces.append((str(r["doc_id"]), piece, at, len(part), zlib.crc32(part.tobytes())))
    found = [(str(r["doc_id"]), r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows]
    assert sorted(found) == sorted(pieces)
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in by_sequence.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= 512
    least = -(-sum(p[3] for p in pieces) // 512)
    assert len(by_sequence) <= least + 2
    assert packing.packed(no_docs, WORDS).collect() == []


def test_distinct_chunks_are_looked_up_once_a_block():
    """work beside the library's grows with the distinct words of a block, not with all."""
    from tokenizers import Tokenizer

    class Counted(dict):
        looked_up = 0

        def get(self, key, default=None):
            self.looked_up += 1
            return super().get(key, default)

        def __getitem__(self, key):
            self.looked_up += 1
            return super().__getitem__(key)

    texts = ["Salt, pepper and salt. Pepper, salt." * 3 + " end ... 4.5, x"] * 500
    own = packing.ChunkIds(WORDS)
    own.known = Counted()
    ids = Tokenizer.from_file(WORDS).encode(texts[0], add_special_tokens=False).ids
    assert all(np.frombuffer(x, "<u4").tolist() == ids for x in own.encode(texts))
    distinct = len(set(texts[0].split()))
    assert own.known.looked_up <= 4 * distinct
    # a word is remembered once, however it is written and closed
    assert {"salt", "pepper", "and", ".", ","} <= own.known.keys()
    assert not {"Salt,", "salt.", "Pepper,", "Salt", "Pepper"} & own.known.keys()


def test_ids_of_random_texts_equal_the_library():
    """Texts without words, far blanks, special strings in any case, marks after any letter."""
    from tokenizers import Tokenizer

    rng, library = random.Random(3), Tokenizer.from_file(WORDS)
    signs = ["a", "B", "é", "É", "Ā", "į", "İ", "Σ", "ß", "µ", "ª", "́", "中", "😀", "1", "٣", ".", ",", "'s", "'T", "-", "_",
             "×", "÷", "\xad", "\x00", "\x1c", "\x1f", "<|", "<|endoftext|>", "<|ENDOFTEXT|>", "<|startoftext|>", "|>",
             " ", "\t", "\n", "\x0b", "\x0c", "\r", *packing.FAR_BLANKS, "​", "﻿"]
    texts = ["", " ", "　", "\x1c"] + ["".join(rng.choices(signs, k=rng.randrange(40))) for _ in range(3000)]
    texts += ["".join(rng.choices("abAB.,é ", k=rng.randrange(60))) for _ in range(1000)]
    for block in ([""], ["", " "], texts):
        for bound in (20, packing.MEMO):
            own = packing.ChunkIds(WORDS, bound)
            for text, ids in zip(block, own.encode(block), strict=True):
                assert np.frombuffer(ids, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids, ascii(text)
