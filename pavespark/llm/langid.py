"""Language identification by sparse multinomial logistic regression (operator 5).

Features are hashed character n-grams (one to three letters, words parted by one space),
weighted by TF-IDF; document frequencies are counted over all rows that may be learned from.
The weights come from follow-the-regularised-leader with elastic-net penalties on at most
``per_language`` rows of each language, in one pass of bounded size; rows set aside from that
sample calibrate the temperature of the softmax.

A text that is null or has no letter is ``und`` with score 0, as is every text if there is
nothing to learn from. Labels, sources and ids are never inputs of a prediction. Repeated
rows are predicted one by one.
"""

from __future__ import annotations

import functools
import math
import sys
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pavespark.llm.common import text_or_empty

BITS = 15
FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)
UNDETERMINED = "und"


@functools.cache
def letters() -> np.ndarray:
    """Whether a code point is a letter."""
    return np.array([unicodedata.category(chr(p))[0] == "L" for p in range(sys.maxunicode + 1)])


def grams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(buckets, counts) of the hashed n-grams of a text; none without a letter."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    is_letter = letters()[points]
    if not is_letter.any():
        return np.zeros(0, np.int64), np.zeros(0)
    points = np.where(is_letter, points, 32)
    keep = is_letter.copy()
    keep[1:] |= is_letter[:-1]  # the first of several separators stays
    word = np.concatenate([[32], points[keep], [32]]).astype(np.uint64)
    total, parts = np.zeros(len(word), np.uint64), []
    for n, factor in enumerate(FACTORS):
        total = total[:len(word) - n] + word[n:] * factor
        parts.append((total ^ (total >> np.uint64(29))) * FACTORS[0] >> np.uint64(64 - BITS))
    counts = np.bincount(np.concatenate(parts).astype(np.int64), minlength=1 << BITS)
    buckets = np.flatnonzero(counts)
    return buckets, counts[buckets]


def weighted(buckets: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    values = (1 + np.log(counts)) * idf[buckets]
    return values / math.sqrt(float(values @ values))


@dataclass
class Model:
    languages: list[str]
    weights: np.ndarray  # buckets x languages
    bias: np.ndarray
    idf: np.ndarray
    temperature: float

    def logits(self, buckets: np.ndarray, counts: np.ndarray) -> np.ndarray:
        return weighted(buckets, counts, self.idf) @ self.weights[buckets] + self.bias

    def predict(self, text: str) -> tuple[str, float]:
        buckets, counts = grams(text)
        if not len(buckets) or not self.languages:
            return UNDETERMINED, 0.0
        chance = softmax(self.logits(buckets, counts) / self.temperature)
        k = int(chance.argmax())
        return self.languages[k], float(chance[k])


def softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


class Ftrl:
    """Follow-the-regularised-leader, proximal form, a column per class."""

    def __init__(self, features: int, classes: int, alpha: float, beta: float, l1: float, l2: float):
        self.z = np.zeros((features, classes))
        self.n = np.zeros((features, classes))
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2

    def weights(self, rows=slice(None)) -> np.ndarray:
        z, n = self.z[rows], self.n[rows]
        rate = (self.beta + np.sqrt(n)) / self.alpha + self.l2
        return np.where(np.abs(z) <= self.l1, 0.0, -(z - np.sign(z) * self.l1) / rate)

    def step(self, rows: np.ndarray, values: np.ndarray, target: int) -> None:
        w, n = self.weights(rows), self.n[rows]
        error = softmax(values @ w)
        error[target] -= 1
        g = values[:, None] * error[None, :]
        sigma = (np.sqrt(n + g * g) - np.sqrt(n)) / self.alpha
        self.z[rows] += g - sigma * w
        self.n[rows] = n + g * g


def fit(texts: list[str], labels: list[str], idf: np.ndarray, epochs: int = 3,
        alpha: float = 0.5, beta: float = 1.0, l1: float = 0.02, l2: float = 0.1) -> Model:
    """Trains on four fifths of the rows, then calibrates the temperature on the others."""
    languages = sorted(set(labels))
    code = {x: i for i, x in enumerate(languages)}
    rows = [(grams(t), code[y]) for t, y in zip(texts, labels, strict=True)]
    rows = [((b, weighted(b, c, idf)), y) for (b, c), y in rows if len(b)]
    order = np.random.default_rng(7).permutation(len(rows))
    aside = order[:len(rows) // 5] if len(rows) >= 20 else order
    learn = order[len(rows) // 5:] if len(rows) >= 20 else order
    bias = len(idf)  # one more feature, always 1
    leader = Ftrl(len(idf) + 1, len(languages), alpha, beta, l1, l2)
    for _ in range(epochs):
        for i in learn:
            (b, v), y = rows[i]
            leader.step(np.append(b, bias), np.append(v, 1.0), y)
    w = leader.weights()
    model = Model(languages, w[:-1], w[-1], idf, 1.0)
    if len(aside):
        logits = np.stack([rows[i][0][1] @ w[rows[i][0][0]] + w[-1] for i in aside])
        target = np.array([rows[i][1] for i in aside])

        def loss(t: float) -> float:
            chance = softmax(logits / t)[np.arange(len(target)), target]
            return -float(np.log(np.maximum(chance, 1e-12)).mean())

        model.temperature = min(np.geomspace(0.02, 20, 200).tolist(), key=loss)
    return model


def document_frequencies(rows: DataFrame) -> tuple[int, np.ndarray]:
    """(documents, documents with each bucket) over all ``rows`` (text)."""

    def count(blocks: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, seen = np.zeros((1 << BITS) + 1, np.int64), False
        for block in blocks:
            for text in block["text"]:
                buckets, _ = grams(text)
                total[buckets] += 1
                total[-1] += 1
                seen = True
        if seen:
            yield pd.DataFrame({"bucket": np.flatnonzero(total), "n": total[total > 0]})

    sums = rows.mapInPandas(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros((1 << BITS) + 1, np.int64)
    for r in sums.collect():  # a row per bucket, whatever the corpus
        out[r["bucket"]] = r["n"]
    return int(out[-1]), out[:-1]


def trained(rows: DataFrame, per_language: int = 1500) -> Model:
    """A model from ``rows`` (doc_id, text, lang); fits on at most ``per_language`` of each."""
    documents, df = document_frequencies(rows.select("text"))
    idf = np.log((1 + documents) / (1 + df)) + 1
    sizes = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    # twice the rows asked for by a hash of the id, then exactly the first by that hash
    spread = F.pmod(F.xxhash64("doc_id", "lang"), F.lit(1_000_003))
    near = rows.join(F.broadcast(sizes), "lang").where(
        spread * F.col("n") <= 1_000_003 * (2 * per_language + 50))
    first = W.partitionBy("lang").orderBy("spread", "doc_id", F.xxhash64("text"))
    sample = (near.withColumn("spread", spread).withColumn("at", F.row_number().over(first))
              .where(F.col("at") <= per_language))

    def learn(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["lang", "at"])
        model = fit(part["text"].tolist(), part["lang"].tolist(), idf)
        used = np.flatnonzero(np.any(model.weights != 0, axis=1))
        out = [(int(b), model.weights[b].tolist(), "") for b in used]
        out.append((-1, model.bias.tolist(), ""))
        out.append((-2, [model.temperature], ""))
        out += [(-3 - i, [], x) for i, x in enumerate(model.languages)]
        return pd.DataFrame(out, columns=["bucket", "w", "language"])

    found = (sample.select("lang", "text", "at").groupBy(F.lit("all").alias("rows"))
             .applyInPandas(learn, "bucket long, w array<double>, language string").collect())
    languages = [r["language"] for r in sorted(found, key=lambda r: -r["bucket"]) if r["bucket"] <= -3]
    model = Model(languages, np.zeros((1 << BITS, len(languages))), np.zeros(len(languages)), idf, 1.0)
    for r in found:
        if r["bucket"] >= 0:
            model.weights[r["bucket"]] = r["w"]
        elif r["bucket"] == -1:
            model.bias[:] = r["w"]
        elif r["bucket"] == -2:
            model.temperature = r["w"][0]
    return model


def prediction(model: Model, text_column: str = "text") -> Column:
    """A column of (lang_pred, score)."""

    @F.pandas_udf("lang_pred string, score double")
    def predict(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([model.predict(t) for t in texts], columns=["lang_pred", "score"])

    return predict(text_or_empty(text_column))


def identified(docs: DataFrame, model: Model, held_out: Column, id_column: str = "doc_id",
               text_column: str = "text") -> DataFrame:
    """Per row: doc_id, held_out, lang_pred, score."""
    found = docs.select(F.col(id_column).alias("doc_id"), held_out.alias("held_out"),
                        prediction(model, text_column).alias("p"))
    return found.select("doc_id", "held_out", "p.*")
