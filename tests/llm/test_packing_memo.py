import public_tokenizers as P
from tokenizers import Tokenizer

import corpus_pipeline
from pavespark.llm import packing

WORDS = P.path("word_bpe_49k.json")


def test_memo_stays_near_its_bound_within_one_batch():
    """What is remembered does not grow with the distinct words of a batch of texts."""
    texts = [" ".join(f"w{i}x{j}" for j in range(100)) for i in range(300)]
    own = packing.ChunkIds(WORDS, bound=1000)
    plain = Tokenizer.from_file(WORDS)
    most = 0
    for text, ids in zip(texts, own.encode(texts), strict=True):
        most = max(most, len(own.known) + len(own.older))
        assert ids == own.library_ids(text, plain).tobytes()
    assert most <= 6 * own.bound


def test_pipeline_packs_with_a_smaller_memo():
    assert corpus_pipeline.PACKING_MEMO < packing.MEMO
