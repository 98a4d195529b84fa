"""Byte-level BPE encoding and decoding without regular expressions (operator 10).

Pre-tokenisation: every code point gets a class (letter, number, other, white space, and
kinds of apostrophe and space that depend on the next one or two code points). A class is
a transition function on a few states. Functions compose associatively, so states are
found by a blocked scan: compositions down the columns of a block, one carry per column,
then the states inside. A token begins where (state before, class) says so.

The slices between boundaries feed a cached byte-pair merge; offsets are kept, so that any
id range can be traced to its code points. Null texts are empty; empty texts give no ids.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import heapq
import sys
import unicodedata
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pavespark.llm.common import TwoGenerationCache, groups, text_or_empty

# Classes of code points.
LETTER, NUMBER, OTHER, SHORT, LONG, LEAD, LAST, SPACE, END = range(9)
# SHORT and LONG: an apostrophe that one or two letters of a contraction follow.
# LEAD: U+0020 before what is no white space. LAST: other white space before such.
# SPACE: white space before white space or the end. END: between two texts.

# States: what the token that holds the last code point may take next.
FRESH, IN_LETTERS, IN_NUMBERS, IN_OTHERS, IN_SPACE, AFTER_LEAD, ONE_MORE, TWO_MORE = range(8)
N_STATES, N_CLASSES = 8, 9

# What may follow an apostrophe.
ONE_LETTER = ("s", "t", "m", "d")
TWO_LETTERS = ("re", "ve", "ll")


def step(state: int, cls: int) -> tuple[int, bool]:
    """The state after a code point of class ``cls``, and whether a token begins there."""
    if cls == END:
        return FRESH, True
    if cls in (LEAD, LAST):
        return (AFTER_LEAD if cls == LEAD else FRESH), True
    if cls == SPACE:
        return IN_SPACE, state != IN_SPACE
    if cls == LETTER and state in (ONE_MORE, TWO_MORE):
        return (ONE_MORE if state == TWO_MORE else FRESH), False
    run = {LETTER: IN_LETTERS, NUMBER: IN_NUMBERS}.get(cls, IN_OTHERS)
    if state in (run, AFTER_LEAD):
        return run, False
    if cls in (SHORT, LONG):
        return (ONE_MORE if cls == SHORT else TWO_MORE), True
    return run, True


@functools.cache
def automaton() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(function of each class, composition table, states of each function, begins)."""
    functions = [tuple(step(s, c)[0] for s in range(N_STATES)) for c in range(N_CLASSES)]
    known = {f: i for i, f in enumerate(dict.fromkeys(functions))}
    queue = list(known)
    generators = list(known)
    while queue:  # close the set under composition with the generators
        f = queue.pop()
        for g in generators:
            h = tuple(g[s] for s in f)
            if h not in known:
                known[h] = len(known)
                queue.append(h)
    order = list(known)
    compose = np.array([[known[tuple(g[s] for s in f)] for g in order] for f in order], np.uint8)
    of_class = np.array([known[f] for f in functions], np.uint8)
    begins = np.array([[step(s, c)[1] for c in range(N_CLASSES)] for s in range(N_STATES)])
    return of_class, compose, np.array(order, np.uint8), begins


@functools.cache
def code_point_classes() -> np.ndarray:
    """LETTER, NUMBER, SPACE or OTHER of every code point."""
    out = np.full(sys.maxunicode + 1, OTHER, np.uint8)
    for point in range(sys.maxunicode + 1):
        kind = unicodedata.category(chr(point))[0]
        if kind in "LN":
            out[point] = LETTER if kind == "L" else NUMBER
    spaces = [*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029,
              0x202F, 0x205F, 0x3000]
    out[spaces] = SPACE
    return out


def scan(functions: np.ndarray, state: int, width: int = 4096) -> np.ndarray:
    """The state before every element, when ``state`` holds before the first one.

    The elements are cut into columns of equal height; prefix compositions are taken row by
    row over all columns at once, then a carry runs over the columns' totals.
    """
    _, compose, states, _ = automaton()
    n = len(functions)
    height = max(1, -(-n // width))
    grid = np.zeros(height * width, np.uint8)
    grid[:n] = functions
    grid = np.ascontiguousarray(grid.reshape(width, height).T)
    flat, m = compose.ravel(), np.uint16(compose.shape[0])
    for i in range(1, height):
        grid[i] = flat[grid[i - 1] * m + grid[i]]
    entry = np.empty(width, np.uint8)
    for column, total in enumerate(grid[-1].tolist()):
        entry[column] = state
        state = int(states[total, state])
    after = states[grid, entry[None, :]]
    before = np.vstack([entry[None, :], after[:-1]])
    return np.ascontiguousarray(before.T).ravel()[:n]


def classes(points: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Classes of code points, END at the offsets ``ends``; after the last one is an end too."""
    kinds = code_point_classes()[points]
    kinds[ends] = SPACE  # white space before an END is followed by no solid character
    n = len(points)
    following = np.full(n + 2, SPACE, np.uint8)
    following[:n] = kinds
    white = kinds == SPACE
    solid = white & (following[1:n + 1] != SPACE)
    kinds[solid] = np.where(points[solid] == 32, LEAD, LAST)
    at = np.flatnonzero(points == 39)
    if len(at):
        padded = np.concatenate([points, np.zeros(2, points.dtype)])
        first, second = padded[at + 1], padded[at + 2]
        short = np.isin(first, [ord(c) for c in ONE_LETTER])
        long = np.zeros(len(at), bool)
        for a, b in TWO_LETTERS:
            long |= (first == ord(a)) & (second == ord(b))
        kinds[at[long]] = LONG
        kinds[at[short]] = SHORT
    kinds[ends] = END
    return kinds


def boundaries(texts: list[str], window: int = 1 << 20) -> list[np.ndarray]:
    """Per text the code-point offsets at which its pre-tokens begin.

    The texts are scanned as one sequence with an END between them, in windows with two code
    points of look-ahead; the automaton's state is carried from one window to the next.
    """
    of_class, _, states, begins = automaton()
    ends = np.cumsum([len(t) + 1 for t in texts])
    joined = "\0".join(texts) + "\0"
    found, state = [], FRESH
    for at in range(0, len(joined), window):
        piece = joined[at:at + window + 2]
        points = np.frombuffer(piece.encode("utf-32-le", "surrogatepass"), np.uint32)
        marks = ends[np.searchsorted(ends, at, "right"):np.searchsorted(ends, at + len(points), "right")]
        kinds = classes(points, marks - 1 - at)[:window]
        functions = of_class[kinds]
        before = scan(functions, state)
        found.append(np.flatnonzero(begins[before, kinds]) + at)
        state = int(states[functions[-1], before[-1]])
    found = np.concatenate(found)
    cuts = np.searchsorted(found, ends - 1)  # the END itself is no pre-token
    first = [0, *ends[:-1].tolist()]
    return [found[np.searchsorted(found, a):b] - a for a, b in zip(first, cuts.tolist(), strict=True)]


class ByteBpe:
    """Ranks of a vocabulary file with one base64 token and its rank a line."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            pairs = [line.split() for line in f if line.strip()]
        self.ranks = {base64.b64decode(token): int(rank) for token, rank in pairs}
        self.tokens = {rank: token for token, rank in self.ranks.items()}
        self.cache = TwoGenerationCache(self.slice_ids)

    def slice_ids(self, piece: str) -> bytes:
        """Ids of a pre-token, as little-endian unsigned 32-bit integers."""
        data = piece.encode("utf-8")
        whole = self.ranks.get(data)
        ids = [whole] if whole is not None else self.merge(data)
        out = array("I", ids)
        if sys.byteorder == "big":
            out.byteswap()
        return out.tobytes()

    def merge(self, data: bytes) -> list[int]:
        """Joins the adjacent pair of lowest rank, leftmost first, until none is known."""
        if len(data) > 64:
            return self.merge_long(data)
        ranks, none = self.ranks, len(self.ranks)
        rank = ranks.get
        parts = [data[i:i + 1] for i in range(len(data))]
        pairs = [rank(data[i:i + 2], none) for i in range(len(data) - 1)]
        while pairs:
            best = min(pairs)
            if best == none:
                break
            i = pairs.index(best)
            parts[i] += parts.pop(i + 1)
            del pairs[i]
            if i:
                pairs[i - 1] = rank(parts[i - 1] + parts[i], none)
            if i < len(pairs):
                pairs[i] = rank(parts[i] + parts[i + 1], none)
        return [ranks[p] for p in parts]

    def merge_long(self, data: bytes) -> list[int]:
        """The same with a heap over list nodes, for pre-tokens of any length."""
        n, rank = len(data), self.ranks.get
        end = list(range(1, n + 1))  # node i holds data[i:end[i]]; 0: merged away
        before = list(range(-1, n - 1))
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := rank(data[i:i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, stop = heapq.heappop(heap)
            j = end[i]
            if not j or j >= n or end[j] != stop:
                continue
            end[i], end[j] = stop, 0
            if stop < n:
                before[stop] = i
                if (r := rank(data[i:end[stop]])) is not None:
                    heapq.heappush(heap, (r, i, end[stop]))
            h = before[i]
            if h >= 0 and (r := rank(data[h:stop])) is not None:
                heapq.heappush(heap, (r, h, stop))
        out, i = [], 0
        while i < n:
            out.append(self.ranks[data[i:end[i]]])
            i = end[i]
        return out

    def encode(self, texts: list[str]) -> Iterator[tuple[bytes, np.ndarray]]:
        """Per text: ids as little-endian unsigned 32-bit integers, code-point starts of its
        pre-tokens."""
        for block in groups(texts):
            for text, starts in zip(block, boundaries(block), strict=True):
                cuts = starts.tolist()
                slices = [text[a:b] for a, b in zip(cuts, [*cuts[1:], len(text)], strict=False)]
                yield b"".join(map(self.cache.__getitem__, slices)), starts

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


@functools.cache
def coder(path: str) -> ByteBpe:
    return ByteBpe(path)


def encoded(docs: DataFrame, vocabulary: str, id_column: str = "doc_id",
            text_column: str = "text") -> DataFrame:
    """Per row: id, ids (binary, little-endian unsigned 32-bit), starts (of pre-tokens)."""

    @F.pandas_udf("ids binary, starts array<long>")
    def encode(texts: pd.Series) -> pd.DataFrame:
        coded = list(coder(vocabulary).encode(list(texts)))
        return pd.DataFrame({"ids": [c[0] for c in coded], "starts": [c[1] for c in coded]})

    coded = docs.select(F.col(id_column).alias("doc_id"),
                        encode(text_or_empty(text_column)).alias("coded"))
    return coded.select("doc_id", "coded.ids", "coded.starts")


def decoded(tokens: DataFrame, vocabulary: str) -> DataFrame:
    """Per row of (doc_id, ids): doc_id, data (the bytes that the ids stand for)."""

    @F.pandas_udf("binary")
    def decode(ids: pd.Series) -> pd.Series:
        return pd.Series([coder(vocabulary).decode(i) for i in ids], dtype=object)

    return tokens.select("doc_id", decode("ids").alias("data"))


def round_trip_digests(docs: DataFrame, vocabulary: str, id_column: str = "doc_id",
                       text_column: str = "text") -> DataFrame:
    """Per row: doc_id, n_tokens, ids_sha256, decoded_sha256 (of the decoded ids)."""

    @F.pandas_udf("n_tokens long, ids_sha256 string, decoded_sha256 string")
    def digests(texts: pd.Series) -> pd.DataFrame:
        bpe, out = coder(vocabulary), []
        for ids, _ in bpe.encode(list(texts)):
            out.append((len(ids) // 4, hashlib.sha256(ids).hexdigest(),
                        hashlib.sha256(bpe.decode(ids)).hexdigest()))
        return pd.DataFrame(out, columns=["n_tokens", "ids_sha256", "decoded_sha256"])

    made = docs.select(F.col(id_column).alias("doc_id"),
                       digests(text_or_empty(text_column)).alias("d"))
    return made.select("doc_id", "d.*")
