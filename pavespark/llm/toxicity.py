"""Toxicity by a counterfactually regularised linear classifier (operator 2).

Features of a text are its distinct words and their beginnings. Of every labelled text in
the training sample that names a group, a counterfactual is made by swapping the group name
for another one of its list; the penalty on the difference of the two scores pulls the
weights of group names together and towards what they add by themselves: nothing. So a
neutral mention does not raise a score.

The classifier is fitted on at most ``sample_size`` labelled rows in one task of bounded
size, and scores every whole text. Every sampled row stands for as many rows as its label has
for each one sampled, so the shares of the labels, and with them the meaning of a score, are
those of all labelled rows, however many there are. Null texts are scored as empty ones: the intercept alone.
With no label to learn from every score is 0. Repeated rows are scored one by one.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pavespark.llm.common import text_or_empty

# Group names, by lists inside which one may stand for another.
IDENTITY_TERMS = [
    "women men girls boys woman man".split(),
    "muslim christian jewish hindu buddhist atheist".split(),
    "muslims christians jews hindus buddhists atheists".split(),
    "black white asian latino african arab".split(),
    "gay lesbian straight bisexual transgender".split(),
    "immigrants refugees citizens foreigners".split(),
    "disabled deaf blind autistic".split(),
    "femmes hommes filles garçons".split(),
    "musulmans chrétiens juifs athées".split(),
    "frauen männer mädchen jungen".split(),
    "muslime christen juden atheisten".split(),
    "mujeres hombres chicas chicos".split(),
    "musulmanes cristianos judíos ateos".split(),
]
SWAPS = {t: [x for x in terms if x != t] for terms in IDENTITY_TERMS for t in terms}
EDGES = ".,;:!?\"'()[]{}<>|*#$%&-_"
BEGINNINGS = (4, 6)


def words_in(text: str) -> set[str]:
    found = {w.strip(EDGES) for w in set(text.lower().split())}
    found.discard("")
    return found


def features_of(words: set[str]) -> set[str]:
    """Words, and beginnings of longer ones, marked by a closing hyphen."""
    out = set(words)
    for n in BEGINNINGS:
        out.update([w[:n] + "-" for w in words if len(w) > n])
    return out


def counterfactual(words: set[str], turn: int) -> set[str] | None:
    """The words with every group name swapped; None if there is none."""
    named = [w for w in words if w in SWAPS]
    if not named:
        return None
    return (words - set(named)) | {SWAPS[w][turn % len(SWAPS[w])] for w in named}


def chosen(texts: list[set[str]], labels: np.ndarray, most: int, least_texts: int,
           least_gain: float) -> list[str]:
    """The features that part the two labels best, by half the G statistic, and all group names."""
    with_one, with_zero = Counter(), Counter()
    for words, y in zip(texts, labels, strict=True):
        (with_one if y else with_zero).update(features_of(words))
    ones, zeros = max(1, int(labels.sum())), max(1, int(len(labels) - labels.sum()))
    scored = []
    for f in with_one.keys() | with_zero.keys():
        a, b = with_one[f], with_zero[f]
        if a + b < least_texts:
            continue
        p, q, both = a / ones, b / zeros, (a + b) / (ones + zeros)
        gain = 0.0
        for share, total in ((p, ones), (q, zeros)):
            if share:
                gain += total * share * math.log(share / both)
            if share < 1:
                gain += total * (1 - share) * math.log((1 - share) / (1 - both))
        if gain >= least_gain:
            scored.append((-gain, f))
    named = sorted(set(SWAPS))
    return named + [f for _, f in sorted(scored)[:most] if f not in SWAPS]


class Rows:
    """A sparse 0/1 matrix."""

    def __init__(self, rows: list[list[int]], width: int):
        self.row = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
        self.column = np.array([c for r in rows for c in r], np.int64)
        self.shape = (len(rows), width)

    def times(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, w[self.column], self.shape[0])

    def transposed_times(self, e: np.ndarray) -> np.ndarray:
        return np.bincount(self.column, e[self.row], self.shape[1])


def fit(texts: list[str], labels: list[int], most: int = 6000, least_texts: int = 2,
        least_gain: float = 4.0, ridge: float = 0.1, balance: float = 5.0, steps: int = 300,
        stands_for: list[float] | None = None) -> dict[str, float]:
    """Weights by feature; '' is the intercept.

    Minimises the log loss, plus ``ridge`` times the squared weights, plus ``balance`` times
    the squared differences of scores between texts and their counterfactuals. ``stands_for``
    tells how many rows each text stands for (one, if None); only the proportions count.
    """
    words = [words_in(t) for t in texts]
    y = np.array(labels, float)
    share = np.ones(len(y)) if stands_for is None else np.array(stands_for, float)
    share = share / share.mean() if len(y) else share
    names = chosen(words, y.astype(int), most, least_texts, least_gain)
    column = {f: i for i, f in enumerate(names)}

    def coded(sets):
        return Rows([[column[f] for f in features_of(s) if f in column] for s in sets], len(names))

    x = coded(words)
    swapped = [(w, c, share[i]) for i, w in enumerate(words) if (c := counterfactual(w, i))]
    before, after = coded([w for w, _, _ in swapped]), coded([c for _, c, _ in swapped])
    swapped_share = np.array([a for _, _, a in swapped])
    w, b = np.zeros(len(names)), 0.0
    m, v, t = np.zeros(len(names) + 1), np.zeros(len(names) + 1), 0
    for t in range(1, steps + 1):
        p = 1 / (1 + np.exp(-np.clip(x.times(w) + b, -30, 30)))
        error = share * (p - y)
        gradient = x.transposed_times(error) + 2 * ridge * w
        if swapped:
            gap = swapped_share * (before.times(w) - after.times(w))
            gradient += 2 * balance * (before.transposed_times(gap) - after.transposed_times(gap))
        g = np.append(gradient, error.sum()) / max(1, len(y))
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        move = 0.05 * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
        w, b = w - move[:-1], b - move[-1]
    out = {f: float(w[i]) for f, i in column.items() if abs(w[i]) > 1e-6}
    return out | {"": float(b)}


def score(text: str, weights: dict[str, float]) -> float:
    get = weights.get
    total = weights[""]
    for f in sorted(features_of(words_in(text)) & weights.keys()):
        total += get(f)
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, total))))


def trained(docs: DataFrame, labels: DataFrame, sample_size: int = 12_000) -> dict[str, float]:
    """Weights from ``labels`` (doc_id, label) of ``docs`` (doc_id, text): of either label the
    first ``sample_size`` / 2 by a hash of the id, weighted by the label's count over its
    sampled count."""
    bound = sample_size // 2
    known = labels.where("doc_id IS NOT NULL AND label IN (0, 1)").distinct()
    sizes = known.groupBy("label").agg(F.count(F.lit(1)).alias("n"))
    # about twice the rows asked for by a hash of the id, thinned where they lie, then exactly
    # the first by that hash: no task gets a whole label's rows
    spread = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_003))
    near = known.join(F.broadcast(sizes), "label").where(
        spread * F.col("n") <= 1_000_003 * (2 * bound + 50))
    order = W.partitionBy("label").orderBy(spread, "doc_id")
    sample = near.withColumn("at", F.row_number().over(order)).where(F.col("at") <= bound)
    stands_for = F.col("n") / F.least("n", F.lit(bound))
    # at most sample_size rows of four numbers
    rows = docs.select("doc_id", text_or_empty().alias("text")).join(
        F.broadcast(sample.select("doc_id", "label", "at", stands_for.alias("stands_for"))), "doc_id")

    def learn(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["label", "at", "text"])
        return pd.DataFrame(fit(part["text"].tolist(), part["label"].tolist(),
                                stands_for=part["stands_for"].tolist()).items(),
                            columns=["feature", "weight"])

    found = rows.groupBy(F.lit("all").alias("rows")).applyInPandas(learn, "feature string, weight double")
    return {r["feature"]: r["weight"] for r in found.collect()}


def scores(weights: dict[str, float], text_column: str = "text") -> Column:
    """A column of scores."""

    @F.pandas_udf("double")
    def of_texts(texts: pd.Series) -> pd.Series:
        if not weights:
            return pd.Series(np.zeros(len(texts)))
        return pd.Series([score(t, weights) for t in texts], dtype="float64")

    return of_texts(text_or_empty(text_column))


def scored(docs: DataFrame, weights: dict[str, float], held_out: Column, threshold: float = 0.3,
           id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per row: doc_id, held_out, score, predicted."""
    found = docs.select(F.col(id_column).alias("doc_id"), held_out.alias("held_out"),
                        scores(weights, text_column).alias("score"))
    return found.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
