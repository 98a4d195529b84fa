"""Near-duplicate groups by banded MinHash with odd-sketch checks (operator 8).

A text's set holds its distinct five-word shingles (words lower-cased in A-Z only; a text of
fewer words has its whole sequence as the one shingle). Texts of equal word sequence form a
class with one representative. Of each representative 128 MinHash values are drawn; 32 keys
of four values each (a pair at similarity 0.75 shares none with probability 5e-6) say which
representatives may be linked. The 1024 smallest hashes of a set, its bottom MinHash sample
(the whole set, if that is smaller), are folded into a parity bitmap of 2048 bits. The count
of set bits in the XOR of two bitmaps estimates how many samples differ, and with the set
sizes the similarity. Pairs estimated more than ``WHOLE_MARGIN`` (both sets are whole in
their samples) or ``SAMPLE_MARGIN`` below the threshold, five standard errors each, or of too
different sizes are not looked at again; all others are compared on their full sets.

No key's members are paired with each other at once. First every member meets the smallest
one of its key; components follow. Then only keys whose members still lie in several
components are taken up, in blocks, and only pairs across components are checked. A link
inside a component could change nothing, so no component loses a link.

Texts that are null or have no word are empty and linked with nothing. Rows without an id are
linked with nothing, have no component and are kept. Repeated rows get the same component. An
id that stands for several texts is one document with the links of all of them; n_shingles is
each row's own, and a row without words is linked with nothing even so.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pavespark.llm.common import ascii_words, frames
from pavespark.operators.windows import global_row_number
from pavespark.session import written

SHINGLE = 5
BANDS, ROWS = 32, 4
VALUES = BANDS * ROWS
SAMPLE = 1024
SKETCH_BITS = 2048
WHOLE_MARGIN, SAMPLE_MARGIN = 0.05, 0.1
ERRORS = 5.5
_random = np.random.default_rng(20240807)
MULTIPLIERS = (_random.integers(0, 1 << 32, VALUES, np.uint64) | np.uint64(1)).astype(np.uint32)
WORD_FACTORS = _random.integers(0, 1 << 63, SHINGLE, np.uint64) * np.uint64(2) + np.uint64(1)
BAND_FACTORS = _random.integers(0, 1 << 63, ROWS, np.uint64) * np.uint64(2) + np.uint64(1)


def mixed(x: np.ndarray) -> np.ndarray:
    """A fixed bijection of 64-bit integers that spreads every input bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def words_of(text: str | None) -> list[bytes]:
    return [] if not text else [w.lower() for w in ascii_words(text)]


def shingles(words: list[bytes]) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles."""
    n = len(words)
    if not n:
        return np.zeros(0, np.uint64)
    if n < SHINGLE:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words), seed=n)], np.uint64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, n)
    last = n - SHINGLE + 1
    total = hashes[:last] * WORD_FACTORS[0]
    for i in range(1, SHINGLE):
        total += hashes[i:i + last] * WORD_FACTORS[i]
    return np.unique(mixed(total))


def least_values(hashes: np.ndarray, step: int = 1 << 14) -> np.ndarray:
    """The smallest value of the set under each of the permutations."""
    folded = (hashes >> np.uint64(32)).astype(np.uint32)
    least = np.full(VALUES, np.iinfo(np.uint32).max, np.uint32)
    for at in range(0, len(folded), step):
        values = MULTIPLIERS[:, None] * folded[None, at:at + step]
        np.minimum(least, values.min(axis=1), out=least)
    return least


def band_keys(least: np.ndarray) -> np.ndarray:
    bands = (least.reshape(BANDS, ROWS).astype(np.uint64) * BAND_FACTORS).sum(axis=1, dtype=np.uint64)
    return mixed(bands + mixed(np.arange(1, BANDS + 1, dtype=np.uint64))).view(np.int64)


def odd_sketch(hashes: np.ndarray) -> bytes:
    """Bit b is set if an odd number of samples hash to b; the samples are the smallest
    hashes of the sorted set."""
    bits = mixed(hashes[:SAMPLE]) % np.uint64(SKETCH_BITS)
    odd = (np.bincount(bits.astype(np.int64), minlength=SKETCH_BITS) & 1).astype(np.uint8)
    return np.packbits(odd).tobytes()


def estimate(n_a: np.ndarray, n_b: np.ndarray, differing: np.ndarray) -> np.ndarray:
    """Similarity from the set sizes and the number of bits in which the sketches differ.

    Samples are shared if common to both sets and below the smaller of the two sample
    limits, which reach the share ``reach`` of all hashes.
    """
    k_a, k_b = np.minimum(n_a, SAMPLE), np.minimum(n_b, SAMPLE)
    reach = np.minimum(k_a / n_a, k_b / n_b)
    apart = -SKETCH_BITS / 2 * np.log(np.maximum(1 - 2 * differing / SKETCH_BITS, 1e-9))
    common = np.clip((k_a + k_b - apart) / (2 * reach), 0, np.minimum(n_a, n_b))
    return common / (n_a + n_b - common)


def features(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, sequence (digest of the words; null if none), bands, sketch."""

    @F.pandas_udf("n_shingles long, sequence binary, bands array<long>, sketch binary")
    def describe(texts: pd.Series) -> pd.DataFrame:
        out = []
        for text in texts:
            words = words_of(text)
            own = shingles(words)
            if len(own):
                out.append((len(own), xxhash.xxh3_128_digest(b" ".join(words)),
                            band_keys(least_values(own)), odd_sketch(own)))
            else:
                out.append((0, None, None, None))
        return pd.DataFrame(out, columns=["n_shingles", "sequence", "bands", "sketch"])

    return docs.select("doc_id", describe("text").alias("f")).select("doc_id", "f.*")


def margin(n_a: np.ndarray, n_b: np.ndarray, percent: int) -> np.ndarray:
    """How far the estimate of a pair at the threshold may lie below it.

    The sample of the larger set is a draw without replacement of which ``share`` is common
    to both sets; the bits in which the sketches differ spread it further.
    """
    most, t = np.maximum(n_a, n_b), percent / 100
    k_a, k_b, k = (np.minimum(n, SAMPLE) for n in (n_a, n_b, most))
    reach = np.minimum(k_a / n_a, k_b / n_b)
    common = t * (n_a + n_b) / (1 + t)
    share = np.minimum(common / most, 1)
    drawn = k * share * (1 - share) * (most - k) / np.maximum(most - 1, 1)
    apart = np.maximum(k_a + k_b - 2 * common * reach, 0)
    even = np.exp(-2 * apart / SKETCH_BITS)
    bits = np.maximum(SKETCH_BITS / 4 * (1 - even ** 2) - apart * even ** 2, 0)
    error = np.sqrt(drawn + bits / (4 * even ** 2)) / reach * (n_a + n_b) / (n_a + n_b - common) ** 2
    return np.maximum(np.where(most <= SAMPLE, WHOLE_MARGIN, SAMPLE_MARGIN), ERRORS * error)


def alike(n_a: np.ndarray, n_b: np.ndarray, differing: np.ndarray, percent: int) -> np.ndarray:
    """Whether sizes and sketches leave the threshold possible."""
    sizes = 100 * np.minimum(n_a, n_b) >= percent * np.maximum(n_a, n_b)
    return sizes & (estimate(n_a, n_b, differing) >= percent / 100 - margin(n_a, n_b, percent))


def confirmed(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full shingle sets reach the threshold; ``texts``: doc_id, text."""

    @F.pandas_udf("boolean")
    def linked(a: pd.Series, text_a: pd.Series, text_b: pd.Series) -> pd.Series:
        out, last, own = [], None, None
        for key, left, right in zip(a, text_a, text_b, strict=True):
            if key != last:
                last, own = key, shingles(words_of(left))
            other = shingles(words_of(right))
            both = len(np.intersect1d(own, other, assume_unique=True))
            out.append(100 * both >= percent * (len(own) + len(other) - both))
        return pd.Series(out, dtype=bool)

    right = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b"))
    left = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a"))
    return (pairs.join(right, "b").join(left, "a")
            .where(linked("a", "text_a", "text_b")).select("a", "b"))


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable, for every node of ``edges`` (a, b).

    In each round every node points to its smallest neighbour or itself, pointers are
    followed once more, and the edges are contracted; a round at least halves long paths.
    """
    edges = written(edges)
    labels = None
    while not edges.isEmpty():
        both = edges.union(edges.select("b", "a"))
        parents = written(both.groupBy("a").agg(F.least("a", F.min("b")).alias("p")))
        above = parents.select(F.col("a").alias("p"), F.col("p").alias("pp"))
        jump = written(parents.join(above, "p").select(F.col("a").alias("node"),
                                                       F.col("pp").alias("to")))
        if labels is None:
            labels = jump.select("node", F.col("to").alias("component"))
        else:
            moved = jump.select(F.col("node").alias("component"), "to")
            labels = written(labels.join(moved, "component", "left").select(
                "node", F.coalesce("to", "component").alias("component")))
        a = jump.select(F.col("node").alias("a"), F.col("to").alias("x"))
        b = jump.select(F.col("node").alias("b"), F.col("to").alias("y"))
        edges = written(edges.join(a, "a").join(b, "b").where("x <> y")
                        .select(F.col("x").alias("a"), F.col("y").alias("b")).distinct())
    if labels is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return labels


def pairs_across(members: DataFrame, percent: int, block: int = 256) -> DataFrame:
    """Pairs (a < b) of members of a key that lie in different components and may be linked.

    ``members``: key, rep, component, n, sketch, bands. A key's members are dealt to blocks,
    and every two blocks meet in a group of their own, so no task needs a whole key. Of the
    keys that a pair shares only the first one gives it, so every pair comes once.
    """
    sizes = members.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("blocks"))
    own = F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")
    dealt = (members.join(sizes, "key").withColumn("own", own)
             .withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
             .withColumn("i", F.least("own", "other")).withColumn("j", F.greatest("own", "other"))
             .select("key", "i", "j", "own", "rep", "component", "n", "sketch", "bands"))
    columns = dealt.columns

    def meet(group: pd.DataFrame) -> list[tuple[int, int]]:
        if group["component"].nunique() < 2:
            return []
        rep, comp, n = (group[c].to_numpy() for c in ("rep", "component", "n"))
        sketch = np.frombuffer(b"".join(group["sketch"]), np.uint64).reshape(len(group), -1)
        key, bands = group["key"].iloc[0], np.stack(group["bands"].to_numpy())
        left = np.flatnonzero(group["own"].to_numpy() == group["i"].iloc[0])
        right = np.flatnonzero(group["own"].to_numpy() == group["j"].iloc[0])
        out = []
        for x in left:
            ys = right[(comp[right] != comp[x])]
            if group["i"].iloc[0] == group["j"].iloc[0]:
                ys = ys[rep[ys] > rep[x]]
            shared = bands[ys] == bands[x]
            ys = ys[bands[x][shared.argmax(axis=1)] == key] if len(ys) else ys
            if len(ys):
                differing = np.bitwise_count(sketch[ys] ^ sketch[x]).sum(axis=1)
                good = ys[alike(n[ys], n[x], differing, percent)]
                out += [(min(rep[x], r), max(rep[x], r)) for r in rep[good].tolist()]
        return out

    def stream(blocks: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Groups lie one after the other; the last of a block may go on in the next."""

        def rows():
            rest = pd.DataFrame(columns=columns)
            for part in blocks:
                part = pd.concat([rest, part], ignore_index=True) if len(rest) else part
                keys = part[["key", "i", "j"]].to_numpy()
                cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
                for a, b in zip([0, *cuts[:-1]], cuts, strict=False):
                    yield from meet(part.iloc[a:b])
                rest = part.iloc[cuts[-1]:] if len(cuts) else part
            if len(rest):
                yield from meet(rest)

        yield from frames(rows(), ["a", "b"])

    return (dealt.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
            .mapInPandas(stream, "a long, b long"))


def sequence_of(text: F.Column) -> F.Column:
    """Digest of a text's words; null if it has none."""
    @F.pandas_udf("binary")
    def digest(texts: pd.Series) -> pd.Series:
        lists = map(words_of, texts)
        return pd.Series([xxhash.xxh3_128_digest(b" ".join(w)) if w else None for w in lists], dtype=object)

    return digest(text)


def numbered_texts(docs: DataFrame, name: str, id_column: str = "doc_id",
                   text_column: str = "text") -> DataFrame:
    """``docs`` with a number for every row, in the order of the ids; of rows with the same id
    and words only that with the smallest text stays. Rows without an id stay, without a number."""
    known = docs.where(F.col(id_column).isNotNull()).withColumn("_s", sequence_of(F.col(text_column)))
    rows = known.groupBy(F.col(id_column).alias("_i"), "_s").agg(
        F.min_by(F.struct(*docs.columns), F.coalesce(text_column, F.lit(""))).alias("_r"))
    numbered = global_row_number(rows, ["_i", F.col("_s").asc_nulls_last()], name).select("_r.*", name)
    return numbered.unionByName(docs.where(F.col(id_column).isNull())
                                .withColumn(name, F.lit(None).cast(dict(numbered.dtypes)[name])))


def representatives(described: DataFrame, split: bool) -> DataFrame:
    """sequence, rep, n, bands, sketch: one row a word sequence; rep is its smallest id. With
    ``split`` ids, sequences that would share one get numbers that are no id."""
    reps = written(described.where("doc_id IS NOT NULL AND sequence IS NOT NULL")
                   .groupBy("sequence").agg(
                       F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n"),
                       F.first("bands").alias("bands"), F.first("sketch").alias("sketch")))
    if not split:
        return reps
    beyond = reps.agg(F.max("rep")).first()[0]
    shared = reps.groupBy("rep").count().where("count > 1").select("rep")
    numbers = global_row_number(reps.join(shared, "rep", "left_semi").select("rep", "sequence"),
                                ["rep", "sequence"], "number", start=beyond + 1).select("sequence", "number")
    return written(reps.join(numbers, "sequence", "left")
                   .withColumn("rep", F.coalesce("number", "rep")).drop("number"))


def near_duplicates(docs: DataFrame, percent: int = 75,
                    id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles, component_id, kept."""
    docs = docs.select(F.col(id_column).cast("long").alias("doc_id"),
                       F.col(text_column).alias("text"))
    described = written(features(docs))
    known = described.where("doc_id IS NOT NULL AND sequence IS NOT NULL").select("doc_id", "sequence")
    several = written(known.groupBy("doc_id").agg(F.min("sequence").alias("x"), F.max("sequence").alias("y"))
                      .where("x <> y").select("doc_id"))
    split = not several.isEmpty()
    reps = representatives(described, split)
    keyed = reps.select(F.explode("bands").alias("key"), "rep")
    shared = (keyed.groupBy("key").agg(F.min("rep").alias("least"), F.max("rep").alias("most"))
              .where("least < most").select("key", "least"))
    members = written(keyed.join(shared, "key"))
    # only representatives that share a key can be in a pair; their texts are gathered once
    ids = members.select(F.col("rep").alias("doc_id")).distinct()
    own = docs.join(several, "doc_id", "left_anti") if split else docs
    texts = own.join(ids, "doc_id", "left_semi").groupBy("doc_id").agg(F.min("text").alias("text"))
    if split:  # an id does not say which of its texts is meant
        told = (docs.join(several, "doc_id", "left_semi").withColumn("sequence", sequence_of(F.col("text")))
                .groupBy("sequence").agg(F.min("text").alias("text")).join(reps, "sequence")
                .select(F.col("rep").alias("doc_id"), "text").join(ids, "doc_id", "left_semi"))
        texts = texts.join(told, "doc_id", "left_anti").unionByName(told)
    texts = written(texts)

    sketches = reps.select("rep", "n", "sketch", "bands")
    first = members.where("rep > least").select(F.col("least").alias("a"),
                                                F.col("rep").alias("b")).distinct()

    @F.pandas_udf("boolean")
    def possible(n_a: pd.Series, n_b: pd.Series, a: pd.Series, b: pd.Series) -> pd.Series:
        x, y = (np.frombuffer(b"".join(s), np.uint64).reshape(len(s), -1) for s in (a, b))
        return pd.Series(alike(n_a.to_numpy(), n_b.to_numpy(),
                               np.bitwise_count(x ^ y).sum(axis=1), percent))

    side = {s: sketches.select(F.col("rep").alias(s), F.col("n").alias("n_" + s),
                               F.col("sketch").alias("s_" + s)) for s in "ab"}
    near = written(first.join(side["b"], "b").join(side["a"], "a")
                   .where(possible("n_a", "n_b", "s_a", "s_b")).select("a", "b"))
    edges = confirmed(near, texts, percent)
    if split:  # the texts of one id belong together
        nodes = known.join(several, "doc_id", "left_semi").distinct().join(reps.select("sequence", "rep"), "sequence")
        least = nodes.groupBy("doc_id").agg(F.min("rep").alias("a"))
        edges = edges.unionByName(nodes.join(least, "doc_id").where("a < rep").select("a", F.col("rep").alias("b")))
    edges = written(edges)
    labels = components(edges)

    placed = written(members.join(labels.withColumnRenamed("node", "rep"), "rep", "left")
                     .select("key", "rep", F.coalesce("component", "rep").alias("component")))
    open_keys = (placed.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y"))
                 .where("x < y").select("key"))
    open_members = placed.join(open_keys, "key", "left_semi").join(sketches, "rep")
    late = written(pairs_across(open_members, percent))
    more = written(confirmed(late, texts, percent))
    if not more.isEmpty():
        labels = components(edges.union(more))

    classes = (reps.select("sequence", "rep")
               .join(labels.withColumnRenamed("node", "rep"), "rep", "left")
               .select("sequence", F.coalesce("component", "rep").alias("component")))
    rows = described.select("doc_id", "n_shingles", "sequence")
    found = rows.where("sequence IS NOT NULL").join(classes, "sequence", "left")
    if split:  # numbers that are no id may name components
        found = written(found)
        smallest = found.groupBy("component").agg(F.min("doc_id").alias("smallest"))
        found = found.join(smallest, "component", "left").withColumn("component", F.col("smallest"))
    empty = rows.where("sequence IS NULL").withColumn("component", F.lit(None).cast("long"))
    columns = ["doc_id", "n_shingles", "component"]
    found = found.select(*columns).unionByName(empty.select(*columns))
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return found.select("doc_id", "n_shingles", component.alias("component_id"),
                        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))
