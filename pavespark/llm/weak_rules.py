"""Quality by weak supervision instead of all-must-pass rules (operator 6).

Every rule votes good, bad or abstains on a whole text. The corpus is reduced to the counts
of its vote patterns (at most 3 ** number of rules, whatever its size); expectation
maximisation over them estimates how often each rule votes what on good and on bad texts,
and the prior share of good texts. Texts below the base limits are decided already and take
no part in that. A text is kept if it passes the two base limits and its
posterior probability of being good reaches ``threshold``.

Null texts have no words. A text below the base limits is never kept. Rows, repeated ones
too, count one by one. An empty table gives an empty result.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pavespark.llm.common import ASCII_SPACE, ascii_words, text_or_empty
from pavespark.session import written

SYMBOLS = "#*$%&|<>"
WINDOW = 8
BAD, ABSTAIN, GOOD = 0, 1, 2


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words inside windows of ``window`` (a power of two) that occur twice or more.

    Windows get exact ranks by doubling: the rank of 2k words comes from two ranks of k.
    """
    n = len(words)
    if n <= window:
        return 0
    known: dict[bytes, int] = {}
    rank = np.array([known.setdefault(w, len(known)) for w in words], np.int64)
    if len(known) == n:
        return 0
    size = 1
    while size < window:
        pairs = rank[:-size] * (int(rank.max()) + 1) + rank[size:]
        _, rank = np.unique(pairs, return_inverse=True)
        size *= 2
    twice = np.bincount(rank)[rank] > 1
    if not twice.any():
        return 0
    edges = np.zeros(n + 1, np.int64)
    np.add.at(edges, np.flatnonzero(twice), 1)
    np.add.at(edges, np.flatnonzero(twice) + window, -1)
    return int(np.count_nonzero(edges[:-1].cumsum()))


def duplicate_lines(text: str) -> tuple[int, int]:
    """(lines with a word, those of them that equal an earlier line)."""
    lines = [x for x in text.split("\n") if x.strip(ASCII_SPACE)]
    return len(lines), len(lines) - len(set(lines))


MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
            "n_lines", "n_upper", "n_digits", "n_letters", "n_symbol_runs", "n_calls", "n_other"]
SYMBOL_RUNS = re.compile(f"[{re.escape(SYMBOLS)}]+")


def measures(text: str) -> tuple[int, ...]:
    words = ascii_words(text)
    word_chars = len(text) - sum(map(text.count, ASCII_SPACE))
    lines, same = duplicate_lines(text)
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    upper = int(np.count_nonzero((points >= 65) & (points <= 90)))
    lower = int(np.count_nonzero((points >= 97) & (points <= 122)))
    digits = int(np.count_nonzero((points >= 48) & (points <= 57)))
    beyond_latin = int(np.count_nonzero(points >= 0xAA))
    return (len(words), word_chars, sum(map(text.count, SYMBOLS)), same, repeated_words(words),
            lines, upper, digits, upper + lower, len(SYMBOL_RUNS.findall(text)), text.count("!"),
            max(0, word_chars - upper - lower - beyond_latin))


def measured(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    schema = ", ".join(f"{m} long" for m in MEASURES)

    @F.pandas_udf(schema)
    def measure(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([measures(t) for t in texts], columns=MEASURES)

    found = docs.select(F.col(id_column).alias("doc_id"),
                        measure(text_or_empty(text_column)).alias("m"))
    return found.select("doc_id", "m.*")


# Name, share that is voted on, votes bad from here on, votes good up to there.
SHARES = [
    ("symbols", "n_symbols / n_words", 0.10, 0.02),
    ("symbol_runs", "n_symbol_runs / n_words", 0.08, 0.02),
    ("other_characters", "n_other / word_chars", 0.12, 0.07),
    ("calls", "n_calls / n_words", 0.10, 0.01),
    ("duplicate_lines", "n_dup_lines / n_lines", 0.30, 0.0),
    ("repeats", "n_repeat_words / n_words", 0.30, 0.05),
    ("capitals", "n_upper / n_letters", 0.40, 0.12),
    ("digits", "n_digits / word_chars", 0.20, 0.03),
]


def votes() -> dict[str, F.Column]:
    """A vote column per rule; a share over nothing abstains."""
    out = {
        "length": F.when(F.col("n_words") < 20, BAD).when(F.col("n_words") >= 60, GOOD),
        "word_length": F.when(F.expr("word_chars > 14 * n_words OR word_chars < 2 * n_words"), BAD)
        .when(F.expr("word_chars BETWEEN 3 * n_words AND 10 * n_words"), GOOD),
    }
    for name, share, bad, good in SHARES:
        value = F.expr(f"try_divide({share.replace(' / ', ', ')})")
        out[name] = F.when(value >= bad, BAD).when(value <= good, GOOD)
    return {k: F.coalesce(v, F.lit(ABSTAIN)) for k, v in out.items()}


def estimate(patterns: np.ndarray, counts: np.ndarray, rounds: int = 500,
             prior: float = 4.0) -> np.ndarray:
    """Posterior probability of good for every vote pattern (rows of 0, 1, 2).

    Starts with doubt about every text that some rule calls bad, then estimates for every
    rule how often it votes good on good and on bad texts; abstentions say nothing. Pseudo-
    counts lean each rule to voting rightly, which also fixes which class is called good.
    """
    voted, good_vote = patterns != ABSTAIN, patterns == GOOD
    posterior = np.where((patterns == BAD).any(axis=1), 0.1, 0.95)
    for _ in range(rounds):
        weights = np.stack([counts * (1 - posterior), counts * posterior])
        share = (weights[1].sum() + prior) / (counts.sum() + 2 * prior)
        lean = prior * np.array([[0.5], [0.98]])
        says_good = (weights @ good_vote + lean) / (weights @ voted + prior)  # class x rule
        log = np.log(says_good) @ good_vote.T + np.log(1 - says_good) @ (voted & ~good_vote).T
        odds = log[1] - log[0] + math.log(share / (1 - share))
        new = 1 / (1 + np.exp(np.clip(-odds, -500, 500)))
        if np.abs(new - posterior).max(initial=0) < 1e-9:
            return new
        posterior = new
    return posterior


def judged(docs: DataFrame, threshold: float = 0.5, id_column: str = "doc_id",
           text_column: str = "text") -> DataFrame:
    """Per row: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, kept, posterior."""
    spark = docs.sparkSession
    rules = votes()
    pattern = F.array(*(v.cast("int") for v in rules.values()))
    failed = F.expr("n_words < 20 OR 100 * n_repeat_words > 30 * n_words")
    voted = written(measured(docs, id_column, text_column)
                    .withColumn("votes", pattern).withColumn("base_failed", failed))
    seen = (voted.groupBy("votes")
            .agg(F.count_if(~F.col("base_failed")).cast("double").alias("n")).collect())
    patterns = np.array([r["votes"] for r in seen], np.int64).reshape(-1, len(rules))
    posterior = estimate(patterns, np.array([r["n"] for r in seen], float))
    table = spark.createDataFrame([(r["votes"], float(p)) for r, p in zip(seen, posterior, strict=True)],
                                  "votes array<int>, posterior double")
    # at most 3 ** rules rows, at any size of the corpus
    return voted.join(F.broadcast(table), "votes").select(
        "doc_id", *MEASURES[:5], "base_failed",
        (~F.col("base_failed") & (F.col("posterior") >= threshold)).alias("kept"), "posterior")
