"""License notices in texts by an exact set-similarity join (operator 13).

Base: places where the words of a license's name stand in a row. The method: a template
(notice text with a label) belongs to a text if a block of the text holds at least
``threshold`` of the template's distinct words. Blocks follow the template's length: for
``size``, the least power of two of at least its words, every window of 2 * size words that
starts at a multiple of size, so every passage as long as the template lies whole in one.

The join is exact. One pass over the corpus counts how many texts hold each template word;
rarest first, that is the order of every word set. The templates' prefixes form an index
(at most the templates' words, so of a bounded size), and each task joins its texts' blocks
with it: a block meets a template only through a word of both prefixes (prefix filter), if
it has words enough (length filter) and if the words from there on can still reach the
threshold (positional filter). What is left is compared in full. Words that no template
holds can never match and are left out of the blocks' sets, which tightens both filters.

Null texts are empty: no words, no labels, score 0. Every row gets a row, repeated ones too;
columns of other names are not read. score is 1 where a base phrase stands, else the largest
share of a found template's words in one block, else 0. An empty table gives no rows.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pavespark.llm.common import frames, text_or_empty

# Names of licenses and their labels.
PHRASES = [
    ("mit license", "mit"),
    ("apache license", "apache"),
    ("general public license", "gpl"),
]

# Labels and wordings of license notices and statements.
TEMPLATES = [
    ("agpl", "GNU Affero General Public License"),
    ("apache", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file "
               "except in compliance with the License. You may obtain a copy of the License at"),
    ("apache", "Unless required by applicable law or agreed to in writing, software distributed under the "
               "License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, "
               "either express or implied."),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted "
            "provided that the following conditions are met"),
    ("bsd", "Licensed under the BSD License"),
    ("cc-by", "Licensed under CC BY 4.0"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International "
                 "License"),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0"),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International "
                 "License"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the "
            "GNU General Public License as published by the Free Software Foundation, either version 3 of "
            "the License, or (at your option) any later version."),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or "
            "without fee is hereby granted, provided that the above copyright notice and this permission "
            "notice appear in all copies."),
    ("lgpl", "GNU Lesser General Public License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
            "and associated documentation files (the \"Software\"), to deal in the Software without "
            "restriction, including without limitation the rights to use, copy, modify, merge, publish, "
            "distribute, sublicense, and/or sell copies of the Software"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("unlicense", "This is free and unencumbered software released into the public domain."),
]

THRESHOLD = 0.85
# what stays of a text's bytes: digits, letters a-z, A-Z lower-cased, all of every other code point
KEPT = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 97 <= b <= 122 or 48 <= b <= 57 else 32
             for b in range(256))


def words_of(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(KEPT).split()


def places(words: list[bytes], phrase: list[bytes]) -> list[int]:
    """Where the phrase's words stand in a row."""
    last = len(phrase) - 1
    if words.count(phrase[last]) == 0:
        return []
    out, at = [], -1
    while True:
        try:
            at = words.index(phrase[last], at + 1)
        except ValueError:
            return out
        if at >= last and words[at - last:at + 1] == phrase:
            out.append(at - last)


def needed(size: int, threshold: float) -> int:
    """The least number of shared words out of ``size`` that reaches the threshold, exactly."""
    per_mille = round(threshold * 1000)
    return max(1, -(-size * per_mille // 1000))


class Templates:
    """The templates as word sets in the global order, and the index of their prefixes."""

    def __init__(self, templates: list[tuple[str, str]], threshold: float, texts_with: dict[bytes, int]):
        self.labels = [label for label, _ in templates]
        lists = [words_of(text) for _, text in templates]
        order = sorted({w for ws in lists for w in ws}, key=lambda w: (texts_with.get(w, 0), w))
        self.rank = {w: i for i, w in enumerate(order)}
        self.sets = [sorted({self.rank[w] for w in ws}) for ws in lists]
        self.need = [needed(len(s), threshold) for s in self.sets]
        # size of blocks -> word -> [(template, place of the word in it)]
        self.index: dict[int, dict[int, list[tuple[int, int]]]] = defaultdict(lambda: defaultdict(list))
        for t, (words, own) in enumerate(zip(lists, self.sets, strict=True)):
            size = 1 << max(0, len(words) - 1).bit_length()
            for i, w in enumerate(own[:len(own) - self.need[t] + 1]):
                self.index[size][w].append((t, i))
        self.index = {size: dict(prefixes) for size, prefixes in self.index.items()}
        first = {w for prefixes in self.index.values() for w in prefixes}
        self.prefix_words = {w for w, r in self.rank.items() if r in first}

    def candidates(self, block: list[int], prefixes: dict[int, list[tuple[int, int]]]) -> Iterator[int]:
        """Templates that a block (ranks in order) may hold, by prefix, length and position."""
        shared: dict[int, int] = {}
        n = len(block)
        for j, w in enumerate(block):
            for t, i in prefixes.get(w, ()):
                need = self.need[t]
                if n < need or j > n - need:
                    continue
                have = shared.get(t, 0) + 1
                reach = have + min(len(self.sets[t]) - i, n - j) - 1
                shared[t] = have if reach >= need else -n
        return (t for t, have in shared.items() if have > 0)

    def found(self, words: list[bytes]) -> dict[int, float]:
        """Templates that a block of the text holds, and the largest share of them in one."""
        if self.prefix_words.isdisjoint(words):
            return {}
        ranks = [(at, r) for at, r in enumerate(map(self.rank.get, words)) if r is not None]
        best: dict[int, float] = {}
        for size, prefixes in self.index.items():
            stretches: dict[int, set[int]] = defaultdict(set)  # a block is two neighbours
            hit = set()
            for at, r in ranks:
                stretches[at // size].add(r)
                if r in prefixes:
                    hit.update((at // size - 1, at // size))
            for k in hit:
                if k >= 0 or len(stretches) == 1:
                    block = sorted(stretches.get(k, set()) | stretches.get(k + 1, set()))
                    for t in self.candidates(block, prefixes):
                        both = len(set(self.sets[t]).intersection(block))
                        if both >= self.need[t]:
                            best[t] = max(best.get(t, 0.0), both / len(self.sets[t]))
        return best


def texts_with(texts: DataFrame, templates: list[tuple[str, str]]) -> dict[bytes, int]:
    """How many texts hold each template word; as many numbers as the templates have words."""
    vocabulary = {w for _, text in templates for w in words_of(text)}

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found: dict[bytes, int] = defaultdict(int)
        for batch in batches:
            for text in batch["text"]:
                for w in vocabulary.intersection(words_of(text)):
                    found[w] += 1
        yield from frames(((w.decode(), n) for w, n in found.items()), ["word", "n"])

    counted = texts.select("text").mapInPandas(count, "word string, n long")
    return {r["word"].encode(): r["n"] for r in counted.groupBy("word").agg(F.sum("n").alias("n")).collect()}


def scanned(docs: DataFrame, templates: list[tuple[str, str]] | None = None, threshold: float = THRESHOLD,
            phrases: list[tuple[str, str]] | None = None, id_column: str = "doc_id",
            text_column: str = "text") -> DataFrame:
    """Per row: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score."""
    templates = TEMPLATES if templates is None else templates
    named = [(words_of(p), label) for p, label in (PHRASES if phrases is None else phrases)]
    texts = docs.select(F.col(id_column).alias("doc_id"), text_or_empty(text_column).alias("text"))
    known = Templates(templates, threshold, texts_with(texts, templates))
    schema = ("n_words long, n_base long, first_word long, last_word long, base_labels string, "
              "labels string, score double")

    def scan(text: str) -> tuple:
        words = words_of(text)
        at = [(place, label) for phrase, label in named for place in places(words, phrase)]
        base = {label for _, label in at}
        best = known.found(words)
        labels = base | {known.labels[t] for t in best}
        starts = [place for place, _ in at]
        return (len(words), len(at), min(starts, default=None), max(starts, default=None),
                ",".join(sorted(base)), ",".join(sorted(labels)), 1.0 if at else max(best.values(), default=0.0))

    names = [part.split()[0] for part in schema.split(", ")]

    @F.pandas_udf(schema)
    def scan_all(batch: pd.Series) -> pd.DataFrame:
        out = pd.DataFrame([scan(t) for t in batch], columns=names)
        return out.astype({"first_word": "Int64", "last_word": "Int64"})

    return texts.select("doc_id", scan_all("text").alias("s")).select("doc_id", "s.*")
