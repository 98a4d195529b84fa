"""Token counts by byte-pair merging with a heap and a linked list (operator 9).

A text is normalised, split into words, and every word starts as one symbol per byte
(the last one carries the end-of-word mark). The adjacent pair of lowest merge rank is
popped from a heap, the two list nodes become one, and the new neighbours are pushed.
The count of a word is its symbols minus its merges; no ids are made.

Null and empty texts count zero tokens. Rows, repeated ones too, are counted one by one.
"""

from __future__ import annotations

import functools
import heapq
import json
import re
import unicodedata

import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pavespark.llm.common import TwoGenerationCache, text_or_empty

# Characters that Python splits at and that are no white space for the tokenizer.
SEPARATORS = re.compile("[\x1c-\x1f]")
WHITE_SPACE = re.compile("[\t-\r \x85\xa0  -     　]+")


def byte_symbols() -> list[str]:
    """The printable stand-in of every byte in byte-level vocabularies: printable Latin-1
    characters stand for themselves, the others for code points from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(printable)]
    chars = {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(others)}
    return [chars[b] for b in range(256)]


def white_space_chunks(text: str) -> list[str]:
    if SEPARATORS.search(text):
        return [x for x in WHITE_SPACE.split(text) if x]
    return text.split()


class MergeCounter:
    """Counts tokens as the vocabulary file's own library would."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        vocab, suffix = model["vocab"], model["end_of_word_suffix"] or ""
        self.merges = {}
        for rank, pair in enumerate(model["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            merged = vocab[left + right]
            self.merges[vocab[left], vocab[right]] = (rank, merged)
        symbols = byte_symbols()
        self.inner = [vocab[s] for s in symbols]
        self.final = [vocab[s + suffix] for s in symbols]
        # special strings are cut out of the raw text and count one token each
        special = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        self.special = re.compile("(" + "|".join(map(re.escape, special)) + ")")
        self.special_set = set(special)
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.words = regex.compile(split["pattern"]["Regex"])
        self.word_counts = TwoGenerationCache(self.word_count)
        self.chunk_counts = TwoGenerationCache(self.chunk_count)

    def word_count(self, word: str) -> int:
        data = word.encode("utf-8")
        ids = [self.inner[b] for b in data]
        ids[-1] = self.final[data[-1]]
        return len(ids) - self.merge(ids)

    def merge(self, ids: list[int]) -> int:
        """Merges pairs in ``ids`` until none has a rank; returns their number."""
        n, merges, done = len(ids), self.merges, 0
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = []
        for i in range(n - 1):
            found = merges.get((ids[i], ids[i + 1]))
            if found:
                heap.append((found[0], i, ids[i], ids[i + 1]))
        heapq.heapify(heap)
        while heap:
            _, i, left, right = heapq.heappop(heap)
            j = after[i]
            if ids[i] != left or j >= n or ids[j] != right:
                continue  # one of the two nodes has been merged since
            ids[i], ids[j] = merges[left, right][1], -1
            done += 1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                found = merges.get((ids[i], ids[k]))
                if found:
                    heapq.heappush(heap, (found[0], i, ids[i], ids[k]))
            h = before[i]
            if h >= 0:
                found = merges.get((ids[h], ids[i]))
                if found:
                    heapq.heappush(heap, (found[0], h, ids[h], ids[i]))
        return done

    def chunk_count(self, chunk: str) -> int:
        """Tokens of a run without white space."""
        total = 0
        for part in self.special.split(chunk) if "<|" in chunk else [chunk]:
            if part in self.special_set:
                total += 1
                continue
            plain = unicodedata.normalize("NFC", part)
            # lower-cased one by one: a final sigma has no form of its own here
            plain = "".join(c.lower() for c in plain) if "Σ" in plain else plain.lower()
            total += sum(map(self.word_counts.__getitem__, self.words.findall(plain)))
        return total

    def count(self, text: str) -> int:
        return sum(map(self.chunk_counts.__getitem__, white_space_chunks(text)))


@functools.cache
def counter(path: str) -> MergeCounter:
    return MergeCounter(path)


def token_counts(docs: DataFrame, vocabulary: str, limit: int = 2048,
                 id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per row of ``docs``: id, n_bytes, n_tokens, over_limit (more than ``limit`` tokens)."""

    @F.pandas_udf("long")
    def n_tokens(texts: pd.Series) -> pd.Series:
        count = counter(vocabulary).count
        return pd.Series([count(t) for t in texts], dtype="int64")

    text = text_or_empty(text_column)
    return docs.select(
        F.col(id_column).alias("doc_id"),
        F.octet_length(text).cast("long").alias("n_bytes"),
        n_tokens(text).alias("n_tokens"),
    ).withColumn("over_limit", F.col("n_tokens") > limit)
