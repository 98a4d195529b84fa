import base64
import hashlib
import random
import sys

import numpy as np
import public_tokenizers as P
import pytest

from pavespark.llm import bpe_count, byte_bpe

WORDS = P.path("word_bpe_49k.json")
RANKS = P.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def fuzz():
    rng = random.Random(3)
    alphabet = [*"abcstrevmldLE'''   \n\t\r\xa0\x1c\x85,.!?09²½éΣσςİßA", "<|endoftext|>", "'ll", "'re",
                "́", "中文", "😀", "ﬁ", "؀"]
    return ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 40))) for _ in range(4000)]


@pytest.fixture(scope="module")
def tiktoken_coder():
    import tiktoken

    with open(RANKS, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(WORDS)


def test_counts_equal_the_library(fuzz, odd_texts, library):
    texts = fuzz + [t or "" for t in odd_texts]
    count = bpe_count.counter(WORDS).count
    for text, coded in zip(texts, library.encode_batch(texts, add_special_tokens=False), strict=True):
        assert count(text) == len(coded.ids), text


def test_small_cache_gives_the_same_counts(odd_texts):
    own = bpe_count.MergeCounter(WORDS)
    own.word_counts.bound = own.chunk_counts.bound = 3
    for text in odd_texts:
        assert own.count(text or "") == bpe_count.counter(WORDS).count(text or "")


def test_token_counts(spark, odd_docs, no_docs, library):
    docs = bpe_count.token_counts(odd_docs, WORDS)
    assert docs.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    rows = docs.collect()
    assert len(rows) == odd_docs.count()
    texts = sorted((r["text"] or "") for r in odd_docs.collect())
    expected = sorted((len(t.encode()), len(library.encode(t, add_special_tokens=False).ids)) for t in texts)
    assert sorted((r["n_bytes"], r["n_tokens"]) for r in rows) == expected
    assert all(r["over_limit"] == (r["n_tokens"] > 2048) for r in rows)
    assert bpe_count.token_counts(no_docs, WORDS).collect() == []


def test_ids_equal_the_library(fuzz, odd_texts, tiktoken_coder):
    texts = fuzz + [t or "" for t in odd_texts] + [" " * 3000, "'" * 999, "ab" * 3000]
    coder = byte_bpe.coder(RANKS)
    for text, (ids, _) in zip(texts, coder.encode(texts), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == tiktoken_coder.encode_ordinary(text), text
        assert coder.decode(ids) == text.encode()


def test_every_code_point_has_the_library_s_class(tiktoken_coder):
    """A letter, a number and a space are each told by what they join with."""
    points = [p for p in range(sys.maxunicode + 1) if not 0xD800 <= p < 0xE000]
    coder, texts = byte_bpe.coder(RANKS), []
    for at in range(0, len(points), 500):
        texts.append("".join(f"a{chr(p)}1{chr(p)}!{chr(p)} {chr(p)}" for p in points[at:at + 500]))
    wrong = sum(np.frombuffer(ids, "<u4").tolist() != tiktoken_coder.encode_ordinary(t)
                for t, (ids, _) in zip(texts, coder.encode(texts), strict=True))
    assert wrong <= 0.01 * len(texts)  # newer code points than one of the two knows


def test_windows_do_not_change_boundaries(fuzz):
    whole = byte_bpe.boundaries(fuzz[:300])
    for text, starts in zip(fuzz[:300], whole, strict=True):
        assert byte_bpe.boundaries([text], window=3)[0].tolist() == starts.tolist()


def test_scan_is_the_stepwise_automaton():
    rng = np.random.default_rng(5)
    of_class, _, _, _ = byte_bpe.automaton()
    classes = rng.integers(0, byte_bpe.N_CLASSES, 5000)
    state, expected = byte_bpe.FRESH, []
    for c in classes.tolist():
        expected.append(state)
        state = byte_bpe.step(state, c)[0]
    assert byte_bpe.scan(of_class[classes], byte_bpe.FRESH, width=64).tolist() == expected


def test_round_trip(spark, odd_docs, no_docs, tiktoken_coder):
    rows = byte_bpe.round_trip_digests(odd_docs, RANKS).collect()
    expected = []
    for r in odd_docs.collect():
        text = r["text"] or ""
        ids = tiktoken_coder.encode_ordinary(text)
        expected.append((len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                         hashlib.sha256(text.encode()).hexdigest()))
    assert sorted(tuple(r)[1:] for r in rows) == sorted(expected)
    assert byte_bpe.round_trip_digests(no_docs, RANKS).collect() == []


def test_offsets_and_decoding(spark, odd_docs):
    coded = byte_bpe.encoded(odd_docs.where("text IS NOT NULL AND doc_id IS NOT NULL"), RANKS)
    for r in coded.collect():
        assert r["starts"] == sorted(set(r["starts"]))
    back = byte_bpe.decoded(coded, RANKS).collect()
    texts = sorted(r["text"].encode() for r in odd_docs.collect() if r["text"] is not None and r["doc_id"] is not None)
    assert sorted(bytes(r["data"]) for r in back) == texts
