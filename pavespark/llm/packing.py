"""Packing token sequences by a configuration linear program (operator 4).

Only the histogram of piece lengths reaches the driver; it has at most ``capacity`` rows at
any input size. A configuration is a multiset of length classes that fits one sequence. The
program "as few sequences as possible, every class covered" is solved by multiplicative
weights: classes covered least weigh most, and the next configuration is the one of largest
weight, found by dynamic programming over the knapsack. Multiplicities are rounded down to
what the histogram holds; pieces left over go by best fit into the room that is left, then
into new sequences.

The plan says which ranks of a length go to which sequences; the pieces find their place by
their rank in parallel. Null texts count as empty (one end mark). Repeated rows are packed
as separate documents. An empty table gives an empty result.
"""

from __future__ import annotations

import bisect
import functools
import itertools
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pavespark.llm.common import frames, groups, text_or_empty
from pavespark.session import written

# up to U+012F libraries agree on lower-casing and letters
LETTERS = "A-Za-z\u00aa\u00b5\u00ba\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f"
PLAIN = re.compile(f"[{LETTERS}]+")
FAR_BLANKS = "\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
MEMO = 500_000  # chunks remembered a generation
LONGEST_KEPT = 64  # code points of a chunk that is remembered
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def near_blanks(text: str) -> str:
    """``text`` with a blank for every white space beyond ASCII."""
    if not text.isascii():
        for far in FAR_BLANKS:
            text = text.replace(far, " ")
    return text


def parted(chunks: pa.Array) -> tuple[pa.Array, pa.Array, pa.Array]:
    """Per chunk its core, whether a tail was taken off, and the tails taken off.

    A tail is closing dots and commas, which are words of their own after a letter. Cores are
    in lower case where the vocabulary's own lower-casing gives the same. A chunk that may
    hold a special token is its own core.
    """
    trimmed = pc.utf8_rtrim(chunks, ".,")
    lettered = pc.match_substring_regex(trimmed, f"[{LETTERS}]$")
    special = pc.match_substring(chunks, "<|")
    closed = pc.and_(pc.and_not(lettered, special),
                     pc.less(pc.binary_length(trimmed), pc.binary_length(chunks)))
    cores = pc.if_else(closed, trimmed, chunks)
    as_is = pc.or_(special, pc.match_substring_regex(cores, r"[^\x00-\x{12f}]"))
    tails = pc.extract_regex(chunks.filter(closed), "(?P<tail>[.,]+)$")
    return pc.if_else(as_is, cores, pc.utf8_lower(cores)), closed, pc.struct_field(tails, "tail")


class ChunkIds:
    """Ids of texts by the tokenizers library, remembered by core of a white-space-free chunk.

    No token and no merge reaches over white space, so a text's ids are those of its chunks.
    The distinct chunks of a block of texts are looked up once; unknown ones are encoded
    together, a special token between them telling them apart.
    """

    MARK = "<|endoftext|>"

    def __init__(self, path: str, bound: int = MEMO):
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.mark = self.tokenizer.token_to_id(self.MARK)
        # the same model for lower-case words of plain letters: they have nothing to normalise,
        # and a blank is all that parts them
        self.plain = Tokenizer.from_file(path)
        self.plain.normalizer = normalizers.Sequence([])
        self.plain.pre_tokenizer = pre_tokenizers.Sequence([
            pre_tokenizers.Split(" ", "removed"),
            pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        suffix = self.tokenizer.model.end_of_word_suffix
        vocabulary = self.tokenizer.get_vocab()
        self.ends_word = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends_word[[i for token, i in vocabulary.items() if token.endswith(suffix)]] = True
        # two generations: what is not met again for ``bound`` entries is forgotten
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.bound = bound

    def library_ids(self, text: str, tokenizer=None) -> np.ndarray:
        coded = (tokenizer or self.tokenizer).encode_batch_fast([text], add_special_tokens=False)
        return np.array(coded[0].ids, "<u4")

    def ids(self, text: str) -> bytes:
        return self.library_ids(text).tobytes()

    def learn_words(self, words: list[str]) -> None:
        """Encodes unknown words of plain letters many at a time. A blank between them is
        enough: a word's last token bears the end mark."""
        for at in range(0, len(words), 256):
            block = words[at:at + 256]
            ids = self.library_ids(" ".join(block), self.plain)
            self.keep(block, ids, [0, *(np.flatnonzero(self.ends_word[ids]) + 1).tolist()], 0)

    def learn(self, chunks: list[str]) -> None:
        """Encodes other unknown chunks many at a time."""
        for at in range(0, len(chunks), 256):
            block = chunks[at:at + 256]
            ids = self.library_ids(self.MARK.join(block))
            self.keep(block, ids, [0, *(np.flatnonzero(ids == self.mark) + 1).tolist(), len(ids) + 1], 1)

    def keep(self, block: list[str], ids: np.ndarray, starts: list[int], between: int) -> None:
        data = ids.tobytes()
        for chunk, a, b in zip(block, starts[:-1], starts[1:], strict=True):
            self.known[chunk] = data[4 * a:4 * (b - between)]

    def learn_all(self, new: list[str]) -> None:
        """Makes every core or tail of ``new`` known; those of the older generation move up."""
        words, others = [], []
        for chunk in new:
            ids = self.older.get(chunk)
            if ids is not None:
                self.known[chunk] = ids
            elif PLAIN.fullmatch(chunk):
                words.append(chunk)
            elif "<|" in chunk:
                self.known[chunk] = self.ids(chunk)
            else:
                others.append(chunk)
        self.learn_words(words)
        self.learn(others)

    def distinct_ids(self, chunks: pa.Array) -> pa.Array:
        """Ids of distinct chunks, as little-endian unsigned 32-bit integers."""
        cores, closed, tails = parted(chunks)
        coded = pa.concat_arrays([cores, tails]).dictionary_encode()
        parts = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        found = list(map(self.known.get, parts))
        unknown = [i for i, ids in enumerate(found) if ids is None]
        new = [parts[i] for i in unknown]
        self.learn_all(new)
        for i, part in zip(unknown, new, strict=True):
            found[i] = self.known[part]
            if len(part) > LONGEST_KEPT:  # hardly comes back, and the memo's bytes are bounded
                del self.known[part]
        ids = pa.array(found, pa.large_binary()).take(coded.indices)
        closing = pc.replace_with_mask(pa.repeat(pa.scalar(b"", pa.large_binary()), len(chunks)),
                                       closed, ids[len(chunks):])
        return pc.binary_join_element_wise(ids[:len(chunks)], closing, pa.scalar(b"", pa.large_binary()))

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        """Per text its ids, as little-endian unsigned 32-bit integers."""
        # a block's chunks are remembered together, so it is kept in proportion to the memo
        for block in groups(texts, min(1 << 22, 8 * self.bound)):
            chunks = pc.ascii_split_whitespace(pa.array(map(near_blanks, block), pa.large_string()))
            coded = chunks.flatten().dictionary_encode()
            if len(self.known) > self.bound:
                self.older, self.known = self.known, {}
            ids = self.distinct_ids(coded.dictionary).take(coded.indices)
            data = memoryview(ids.buffers()[2] or b"")
            # of every chunk's first byte, taken at every text's first chunk
            starts = np.frombuffer(ids.buffers()[1], np.int64)[chunks.offsets.to_numpy()].tolist()
            for a, b in itertools.pairwise(starts):
                yield bytes(data[a:b])


@functools.cache
def chunk_ids(path: str, memo: int) -> ChunkIds:
    return ChunkIds(path, memo)


def token_pieces(docs: DataFrame, vocabulary: str, capacity: int = 4096, end_id: int = 1,
                 id_column: str = "doc_id", text_column: str = "text", memo: int = MEMO) -> DataFrame:
    """A row for every piece of at most ``capacity`` ids of every document and its end mark.
    ``memo``: chunks that a Python worker remembers a generation, for speed only."""

    def cut(blocks: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        end, size = np.array([end_id], "<u4").tobytes(), 4 * capacity

        def rows(block):
            coded = chunk_ids(vocabulary, memo).encode(block["text"].tolist())
            # ids stay objects: a null id must not turn the others into floats
            for doc_id, ids in zip(block["doc_id"].astype(object), coded, strict=True):
                ids += end
                for piece, at in enumerate(range(0, len(ids), size)):
                    part = ids[at:at + size]
                    yield (None if pd.isna(doc_id) else int(doc_id), piece, at // 4,
                           len(part) // 4, zlib.crc32(part))

        for block in blocks:
            for out in frames(rows(block), ["doc_id", "piece", "start", "length", "ids_crc32"]):
                yield out.astype({"doc_id": "Int64"})
            # the worker lives on in other stages
            pa.default_memory_pool().release_unused()

    return docs.select(F.col(id_column).cast("long").alias("doc_id"),
                       text_or_empty(text_column).alias("text")).mapInPandas(cut, PIECES)


def best_configuration(values: np.ndarray, sizes: np.ndarray, room: int) -> list[int]:
    """Classes (with repeats) of the largest total value whose sizes fit ``room``.

    value[r] is the best total with room r: one more class on top of the best for the rest.
    """
    value = np.zeros(room + 1)
    choice = np.full(room + 1, -1)
    least = int(sizes[0])
    for r in range(least, room + 1):
        fits = int(np.searchsorted(sizes, r, "right"))
        totals = value[r - sizes[:fits]] + values[:fits]
        k = int(totals.argmax())
        value[r], choice[r] = totals[k], k
        if value[r - 1] >= value[r]:
            value[r], choice[r] = value[r - 1], -1
    out, r = [], room
    while r >= least:
        k = int(choice[r])
        if k < 0:
            r -= 1
        else:
            out.append(k)
            r -= int(sizes[k])
    return out


def configurations(sizes: np.ndarray, demand: np.ndarray, room: int, rate: float = 1.0,
                   target: float = 4.0) -> list[tuple[list[int], float]]:
    """A fractional cover of ``demand`` by configurations, by multiplicative weights.

    Each round takes the configuration of largest weight as often as covers ``rate`` of the
    scarcest class in it; a class loses weight with its cover. Ends when every class is
    covered ``target`` times; multiplicities are scaled back by the least cover, so that every
    class stays covered.
    """
    cover = np.zeros(len(sizes))
    taken: dict[tuple[int, ...], float] = {}
    while cover.min() < target:
        weights = np.exp(-(cover - cover.min())) / demand
        config = best_configuration(weights, sizes, room)
        classes, counts = np.unique(config, return_counts=True)
        times = rate * float((demand[classes] / counts).min())
        cover[classes] += times * counts / demand[classes]
        key = tuple(config)
        taken[key] = taken.get(key, 0.0) + times
    scale = float(cover.min())
    return sorted(((list(k), x / scale) for k, x in taken.items()), key=lambda p: (-p[1], p[0]))


class Plan:
    """Groups of equal sequences: (how many, lengths in each); rank ranges of every length.

    ``grain`` is the unit of the program: a class holds the lengths that round to the same
    number of units (256 classes of 16 tokens at a capacity of 4096, at any input). Pieces of
    a configuration are chosen by their exact lengths, so rounding never overfills a sequence.
    ``least`` is a bound that no packing beats, ``program`` the value of the fractional cover.
    """

    def __init__(self, histogram: dict[int, int], capacity: int, grain: int = 16):
        self.capacity = capacity
        self.left = {n: c for n, c in histogram.items() if c > 0}
        self.least = max(-(-sum(n * c for n, c in self.left.items()) // capacity),
                         sum(c for n, c in self.left.items() if 2 * n > capacity))
        self.program = 0.0
        self.groups: list[tuple[int, list[int]]] = []
        if self.left.get(capacity):
            self.groups.append((self.left.pop(capacity), [capacity]))
        self.fill_by_configurations(grain)
        self.fill_by_best_fit()

    def fill_by_configurations(self, grain: int) -> None:
        by_class: dict[int, list[int]] = {}
        for n in sorted(self.left, reverse=True):
            by_class.setdefault(max(1, (n + grain // 2) // grain), []).append(n)
        if not by_class:
            return
        sizes = np.array(sorted(by_class))
        demand = np.array([sum(self.left[n] for n in by_class[s]) for s in sizes.tolist()], float)
        found = configurations(sizes, demand, max(self.capacity // grain, int(sizes[-1])))
        self.program = sum(x for _, x in found)
        for config, x in found:
            classes = [by_class[int(sizes[k])] for k in sorted(config, reverse=True)]
            times = round(x)
            while times > 0 and (lengths := self.chosen(classes)):
                uses = {n: lengths.count(n) for n in lengths}
                # as many sequences as these lengths last for
                run = min([times, *(self.left[n] // c for n, c in uses.items())])
                for n, c in uses.items():
                    self.left[n] -= run * c
                self.groups.append((run, lengths))
                times -= run

    def chosen(self, classes: list[list[int]]) -> list[int] | None:
        """A length of each class, the longest that leaves room for the shortest of the
        others; None if what is left of them does not fit."""
        shortest = [next((n for n in reversed(own) if self.left[n]), None) for own in classes]
        if None in shortest:
            return None
        room, rest, out = self.capacity, sum(shortest), []
        spent: dict[int, int] = {}
        for own, low in zip(classes, shortest, strict=True):
            rest -= low
            n = next((n for n in own if n + rest <= room and self.left[n] > spent.get(n, 0)), None)
            if n is None:
                return None
            spent[n] = spent.get(n, 0) + 1
            out.append(n)
            room -= n
        return out

    def fill_by_best_fit(self) -> None:
        """Longest lengths first, each into the sequences with the least room that holds it."""
        rooms: dict[int, list[tuple[int, list[int]]]] = {}
        for times, lengths in self.groups:
            rooms.setdefault(self.capacity - sum(lengths), []).append((times, lengths))
        order = sorted(rooms)
        for n in sorted((n for n, c in self.left.items() if c > 0), reverse=True):
            count = self.left[n]
            while count:
                i = bisect.bisect_left(order, n)
                if i == len(order):  # no room anywhere: new sequences
                    each = min(count, self.capacity // n)
                    times, room, lengths = count // each, self.capacity, []
                else:
                    room = order[i]
                    times, lengths = rooms[room].pop()
                    if not rooms[room]:
                        del rooms[room], order[i]
                    each = min(count, room // n)
                    if times * each > count:
                        some = count // each
                        rest, times = times - some, some
                        if room not in rooms:
                            rooms[room] = []
                            bisect.insort(order, room)
                        rooms[room].append((rest, lengths))
                count -= times * each
                after = room - each * n
                if after not in rooms:
                    rooms[after] = []
                    bisect.insort(order, after)
                rooms[after].append((times, lengths + [n] * each))
        self.groups = [g for room in sorted(rooms) for g in rooms[room]]

    def ranges(self) -> dict[str, np.ndarray]:
        """Arrays sorted by (length, first rank): from that rank on, ``each`` pieces of the
        length go to every sequence from ``sequence`` on, the first at ``offset``."""
        rows, used, sequence = [], {}, 0
        for times, lengths in self.groups:
            offset = 0
            for n, same in itertools.groupby(sorted(lengths, reverse=True)):
                each = len(list(same))
                rank = used.get(n, 0)
                rows.append((n, rank, sequence, each, offset))
                used[n] = rank + times * each
                offset += n * each
            sequence += times
        rows.sort()
        table = np.array(rows, np.int64).reshape(-1, 5)
        return dict(zip(("length", "rank", "sequence", "each", "offset"), table.T, strict=True))


RANK_BITS = 48  # a length and a rank share a long: 4096 lengths, 2**48 pieces of each


def places(pieces: DataFrame, capacity: int = 4096) -> DataFrame:
    """``pieces`` with sequence_id and offset, by the plan for their lengths."""
    pieces = written(pieces)
    histogram = {r["length"]: r["n"] for r in
                 pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    ranges = Plan(histogram, capacity).ranges()
    firsts = (ranges["length"] << RANK_BITS) | ranges["rank"]

    # ranks inside (length, salt), then the offset of the salt: no length is ranked in one task
    salts = 16 + sum(histogram.values()) // 50_000
    salted = F.pmod(F.xxhash64("doc_id", "piece"), F.lit(salts)).alias("salt")
    sizes = pieces.groupBy("length", salted).agg(F.count(F.lit(1)).alias("n"))
    before = W.partitionBy("length").orderBy("salt").rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select("length", "salt",
                           F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    inside = W.partitionBy("length", "salt").orderBy("doc_id", "piece", "ids_crc32")
    ranked = (pieces.select("*", salted).withColumn("inside", F.row_number().over(inside) - 1)
              .join(offsets, ["length", "salt"])
              .withColumn("rank", F.col("before") + F.col("inside")))

    @F.pandas_udf("sequence_id long, offset long")
    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        n, r = length.to_numpy(), rank.to_numpy()
        row = np.searchsorted(firsts, (n << RANK_BITS) | r, "right") - 1
        turn, slot = np.divmod(r - ranges["rank"][row], ranges["each"][row])
        return pd.DataFrame({"sequence_id": ranges["sequence"][row] + turn,
                             "offset": ranges["offset"][row] + slot * n})

    return (ranked.withColumn("place", place("length", "rank"))
            .select("doc_id", "piece", "start", "length", "ids_crc32", "place.*"))


def packed(docs: DataFrame, vocabulary: str, capacity: int = 4096, end_id: int = 1,
           id_column: str = "doc_id", text_column: str = "text", memo: int = MEMO) -> DataFrame:
    """Every piece of every document with its sequence and its place there."""
    return places(token_pieces(docs, vocabulary, capacity, end_id, id_column, text_column, memo), capacity)
