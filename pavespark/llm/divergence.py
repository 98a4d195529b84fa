"""How far the sources of a language lie apart in their words (operator 12).

Every (lang, source) group has an exact share of each term that at least ``least`` documents
of its language hold, smoothed so that terms it lacks have one too. The distance of two
groups is the sum over all terms of the difference of their shares.

The counts form a sparse matrix of groups by terms. As in Gustavson's row-wise product, a
group walks through its own terms and, by the index from a term to the groups that have it,
scatters what each adds into one dense accumulator over its peers; no pair of postings is
ever a row. A peer that lacks the term counts with its baseline share, for which sorted
shares and their running sums serve all peers at once. The terms are dealt out in slices, so
that a task holds a slice's postings and one accumulator; accumulators add up over slices.

Null text, lang and source read as ''. Rows count one by one, repeated ones too. A text
without a term still makes its group occur; a language without a kept term gives every pair
the value 0 and no term rows. Columns of other names are not read. No documents, no rows.
Shares are exact while a group has fewer than 9e15 words of kept terms; values are longs.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pavespark.session import written

ONE, PRIOR = 1_000_000_000, 5
# what stays of a text's bytes: letters a-z, A-Z lower-cased, all of every other code point
KEPT = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 97 <= b <= 122 else 32 for b in range(256))
PIECE = 1 << 22


def terms(text: str) -> Iterator[list[bytes]]:
    """The terms of a text in pieces of bounded size."""
    data, at = text.encode("utf-8", "surrogatepass").translate(KEPT), 0
    while at < len(data):
        end = len(data) if at + PIECE >= len(data) else data.find(b" ", at + PIECE)
        end = len(data) if end < 0 else end
        yield data[at:end].split()
        at = end


def term_counts(docs: DataFrame, held: int = 400_000) -> DataFrame:
    """lang, source, term, n (occurrences), docs (documents with it), one row a combination."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n: dict[tuple[str, str], Counter] = {}
        with_term: dict[tuple[str, str], Counter] = {}
        size = 0

        def counted() -> Iterator[pa.RecordBatch]:
            for (lang, source), found in n.items():
                if found:
                    there = with_term[lang, source]
                    own = [pa.array(list(found), pa.binary()).cast(pa.string()), pa.array(found.values(), pa.int64()),
                           pa.array(map(there.__getitem__, found), pa.int64())]
                    group = [pa.repeat(pa.scalar(name, pa.string()), len(found)) for name in (lang, source)]
                    yield pa.RecordBatch.from_arrays(group + own, ["lang", "source", "term", "n", "docs"])
            n.clear()
            with_term.clear()

        for batch in batches:
            for lang, source, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                found, there = n.setdefault((lang, source), Counter()), with_term.setdefault((lang, source), Counter())
                size -= len(found)
                own: set[bytes] = set()
                for words in terms(text):
                    found.update(words)
                    own.update(words)
                there.update(own)
                size += len(found)
                if size >= held:
                    yield from counted()
                    size = 0
        yield from counted()

    raw = docs.select("lang", "source", "text").mapInArrow(
        count, "lang string, source string, term string, n long, docs long")
    # tasks have counted already; dealt by term, all later steps of a term stay in place
    return (raw.repartition("lang", "term").groupBy("lang", "term", "source")
            .agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")))


def kept_terms(counts: DataFrame, least: int) -> DataFrame:
    """lang, term, source, n and lang_n, the term's count in the whole language."""
    term = W.partitionBy("lang", "term")
    found = counts.withColumns({"df": F.sum("docs").over(term), "lang_n": F.sum("n").over(term)})
    return found.where(F.col("df") >= least).select("lang", "term", "source", "n", "lang_n")


def share(n: Column, total: str = "total", kinds: str = "kinds") -> Column:
    """1 + floor(ONE * (n + PRIOR) / (total + PRIOR * kinds)) by long division in three steps."""
    rest, below, out = n + F.lit(PRIOR), F.col(total) + F.lit(PRIOR) * F.col(kinds), F.lit(1).cast("long")
    below = F.when(below > 0, below)
    for step in (1_000_000, 1000, 1):
        out = out + F.call_function("div", rest * 1000, below) * step
        rest = (rest * 1000) % below
    return out


def group_table(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """lang, source, number (from 0 within the language), peers, kinds, total, base (the share
    of a term that the group lacks), lang_total, postings (kept, of the language)."""
    totals = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count("*").alias("own"))
    kinds = kept.groupBy("lang", "term").count().groupBy("lang").agg(F.count("*").alias("kinds"))
    lang = W.partitionBy("lang")
    found = (docs.select("lang", "source").distinct().join(totals, ["lang", "source"], "left")
             .join(kinds, "lang", "left").na.fill(0, ["total", "own", "kinds"]))
    return found.select(
        "lang", "source", (F.row_number().over(lang.orderBy("source")) - 1).alias("number"),
        F.count("*").over(lang).alias("peers"), "kinds", "total",
        F.coalesce(share(F.lit(0)), F.lit(1)).alias("base"),
        F.sum("total").over(lang).alias("lang_total"), F.sum("own").over(lang).alias("postings"))


# --------------------------------------------------------------------- a slice's task
def scattered(number: np.ndarray, term: np.ndarray, p: np.ndarray, base: np.ndarray,
              held: int = 1 << 22) -> dict[int, np.ndarray]:
    """For every group with postings here, its accumulator over its language's groups.

    Over the group's terms it sums |p - q| - |base - q| with q the peer's share: with the
    peer's base for all peers, and for peers of higher number also what their own share
    changes in that. The accumulators of both groups of a pair and |base - base'| times the
    number of kept terms make their distance.
    """
    order = np.lexsort((number, term))
    number, term, p = number[order], term[order], p[order]
    end = np.searchsorted(term, term, side="right")  # of each posting's row in the index
    rows = np.argsort(number, kind="stable")
    groups, first = np.unique(number[rows], return_index=True)
    out: dict[int, np.ndarray] = {}
    if not len(p):
        return out
    for g, mine in zip(groups.tolist(), np.split(rows, first[1:]), strict=True):
        own = np.sort(p[mine])
        below = np.searchsorted(own, base)
        sums = np.concatenate([[0], np.cumsum(own)])
        acc = base * below - sums[below] + (sums[-1] - sums[below]) - base * (len(own) - below)
        acc -= len(own) * np.abs(base[g] - base)
        length = end[mine] - mine - 1
        cuts = np.searchsorted(np.cumsum(length), np.arange(held, int(length.sum()) + held, held))
        for some in np.split(mine, np.minimum(cuts + 1, len(mine))):
            n = end[some] - some - 1
            start = np.repeat(some + 1 - np.concatenate([[0], np.cumsum(n)[:-1]]) if len(some) else some, n)
            peer = start + np.arange(len(start))
            mine_p, h, q = np.repeat(p[some], n), number[peer], p[peer]
            b = base[h]
            np.add.at(acc, h, np.abs(mine_p - q) - np.abs(mine_p - b) - np.abs(base[g] - q) + np.abs(base[g] - b))
        out[g] = acc
    return out


def pair_sums(kept: DataFrame, groups: DataFrame, least: int = 1 << 15, most: int = 1 << 22) -> DataFrame:
    """lang, low, high (numbers of two groups), value: what shared and single terms add."""
    # a slice gives accumulators of peers x peers entries at most: as many postings make it up
    size = F.least(F.greatest(F.col("peers") * F.col("peers"), F.lit(least)), F.lit(most))
    peers = groups.select("lang", "source", "number", "base", "kinds", "total",
                          F.ceil(F.col("postings") / size).cast("long").alias("slices"))
    own = kept.join(peers.drop("base"), ["lang", "source"]).select(
        "lang", F.pmod(F.xxhash64("term"), "slices").alias("slice"), "term",
        F.col("number").cast("long").alias("number"), share(F.col("n")).alias("p"))
    everywhere = peers.where("slices > 0").select(
        "lang", F.explode(F.sequence(F.lit(0).cast("long"), F.col("slices") - 1)).alias("slice"),
        F.col("number").cast("long").alias("number"), "base")

    def scatter(key: tuple, postings: pd.DataFrame, there: pd.DataFrame) -> pd.DataFrame:
        base = there.sort_values("number")["base"].to_numpy(np.int64)
        found = scattered(postings["number"].to_numpy(np.int64), pd.factorize(postings["term"])[0],
                          postings["p"].to_numpy(np.int64), base)
        # a slice that no term fell into gives no rows, of the same types
        return pd.DataFrame({"lang": pd.Series([key[0]] * len(found), dtype=object),
                             "number": pd.Series(list(found), dtype="int32"),
                             "acc": pd.Series(list(found.values()), dtype=object)})

    found = own.groupBy("lang", "slice").cogroup(everywhere.groupBy("lang", "slice")).applyInPandas(
        scatter, "lang string, number int, acc array<long>")
    cells = found.select("lang", "number", F.posexplode("acc").alias("peer", "value")).where("number <> peer")
    return cells.groupBy("lang", F.least("number", "peer").alias("low"),
                         F.greatest("number", "peer").alias("high")).agg(F.sum("value").alias("value"))


def source_pairs(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """lang, source, item (another source of the language), value."""
    a = groups.select("lang", F.col("number").alias("low"), F.col("source").alias("a"), "base", "kinds")
    b = groups.select("lang", F.col("number").alias("high"), F.col("source").alias("b"), F.col("base").alias("q"))
    pairs = (a.join(b, "lang").where("low < high").join(pair_sums(kept, groups), ["lang", "low", "high"], "left")
             .withColumn("value", F.col("kinds") * F.abs(F.col("base") - F.col("q")) + F.coalesce("value", F.lit(0))))
    sides = F.explode(F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")),
                              F.struct(F.col("b").alias("source"), F.col("a").alias("item"))))
    return pairs.select("lang", sides.alias("s"), "value").select("lang", "s.*", "value")


def outstanding_terms(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """lang, source, item (a term of the group whose share is above the language's), value."""
    found = kept.join(groups.select("lang", "source", "kinds", "total", "lang_total"), ["lang", "source"])
    value = share(F.col("n")) - share(F.col("lang_n"), "lang_total")
    return found.select("lang", "source", F.col("term").alias("item"), value.alias("value")).where("value > 0")


def ranked(found: DataFrame, part: str, limit: int | None = None) -> DataFrame:
    order = W.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    out = found.select("lang", "source", F.lit(part).alias("part"), "item", "value",
                       F.row_number().over(order).alias("rank"))
    return out if limit is None else out.where(F.col("rank") <= limit)


def divergence(documents: DataFrame, least: int = 30, top: int = 50) -> DataFrame:
    """lang, source, part ('pair' or 'term'), item, value, rank."""
    docs = documents.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
                              for c in ("lang", "source", "text")))
    kept = written(kept_terms(term_counts(docs), least))
    groups = written(group_table(docs, kept))
    return ranked(source_pairs(kept, groups), "pair").unionByName(
        ranked(outstanding_terms(kept, groups), "term", top))
