"""Personal data by a semi-Markov conditional random field (operator 3).

Base spans of the four kinds follow fixed patterns. The field adds spans that the patterns
miss: loose candidates (runs of digit groups, words around an at-sign, plain or written out)
are scored as whole spans by their shape, checks and context; dynamic programming over the
candidates of a text, each at most ``MAX_SPAN`` long, chooses boundaries and kinds together.
The weights are learned from a bounded sample by the likelihood of whole segmentations. Base
spans are what it knows for sure; the patterns say nothing of looser forms, so these are not
taken for noise: a candidate that looks like a kind but matches no pattern is left open, and
the likelihood sums over both. What loose forms look like is learned from base spans written
in them (a number without its country, an address spelled out), in their own surroundings,
beside the same digits written as dates and plain numbers. A span is added if its marginal
probability is high and it overlaps no base span. Base spans always stay.

Null texts are empty and hold nothing. Offsets count code points. Repeated rows are searched
one by one. All searches take time in proportion to the text.
"""

from __future__ import annotations

import bisect
import hashlib
import itertools
import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pavespark.llm.common import text_or_empty

KINDS = ["email", "ip", "card", "phone"]
MAX_SPAN = 64  # code points of a candidate segment
MAX_GROUPS = 8  # digit groups of a candidate segment

Span = tuple[int, int, str]

LOCAL = re.compile(r"[A-Za-z0-9._%+-]+\Z")
LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
DIGIT = re.compile(r"[0-9]")


def digits_of(text: str) -> str:
    return "".join(DIGIT.findall(text))


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def emails(text: str) -> Iterator[Span]:
    """Leftmost matches, found from their at-signs: the local part is all that can precede."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in LOCAL_CHARS:
            start -= 1
        found = DOMAIN.match(text, at + 1) if start < at else None
        if found:
            end = found.end()
            yield start, end, "email"
        at = text.find("@", max(at + 1, end))
        # the next local part cannot reach over this at-sign, nor into the match before
        end = max(end, 0)


def base_spans(text: str) -> list[Span]:
    """The spans of the fixed patterns, by start, then kind as listed."""
    if not text:
        return []
    out = list(emails(text)) if "@" in text else []
    if DIGIT.search(text):
        for m in IP.finditer(text):
            if all(len(p) <= 3 and int(p or 0) <= 255
                   for p in (x.lstrip("0") for x in m.group().split("."))):
                out.append((m.start(), m.end(), "ip"))
        for m in CARD.finditer(text):
            digits = digits_of(m.group())
            if 14 <= len(digits) <= 19 and luhn(digits):
                out.append((m.start(), m.end(), "card"))
        for m in PHONE.finditer(text):
            if 10 <= len(digits_of(m.group())) <= 15:
                out.append((m.start(), m.end(), "phone"))
    return in_order(out)


def in_order(spans: list[Span]) -> list[Span]:
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[2])))


def shown(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


# Candidates: loose shapes; the field decides.
GROUP = re.compile(r"[0-9]+")
JOINER = re.compile(r"[ ().\-/]{1,3}\Z")
AT_WORDS = re.compile(r"[A-Za-z0-9._%+-]{1,30} ?(?:@|\(at\)|\[at\]) ?[A-Za-z0-9-]{1,30}"
                      r"(?: ?(?:\.|\(dot\)|\[dot\]) ?[A-Za-z0-9-]{1,20}){1,3}")
AT_SIGN = re.compile(r"@|\(at\)|\[at\]")


def candidates(text: str) -> list[Span]:
    """Segments that may be personal data, with each kind they may be."""
    out = set()
    for sign in AT_SIGN.finditer(text):
        at = max(0, sign.start() - MAX_SPAN // 2)
        near = text[at:sign.end() + MAX_SPAN]
        for m in AT_WORDS.finditer(near):
            if m.start() <= sign.start() - at < m.end() and m.end() - m.start() <= MAX_SPAN:
                out.add((at + m.start(), at + m.end(), "email"))
    groups = [m.span() for m in GROUP.finditer(text)]
    for i, (first, _) in enumerate(groups):
        start = first
        while start > 0 and first - start < 2 and text[start - 1] in "+(":
            start -= 1
        digits, dots = 0, 0
        for j in range(i, min(i + MAX_GROUPS, len(groups))):
            if j > i:
                between = text[groups[j - 1][1]:groups[j][0]]
                if not JOINER.match(between):
                    break
                dots += between == "."
            digits += groups[j][1] - groups[j][0]
            end = groups[j][1]
            if digits > 19 or end - start > MAX_SPAN:
                break
            if 12 <= digits and "+" not in text[start:end]:
                out.add((first, end, "card"))
            if 7 <= digits <= 15:
                out.add((start, end, "phone"))
            if j == i + 3 and dots == 3:
                out.add((first, end, "ip"))
    return in_order(list(out))


CONTEXT = {
    "email": ("mail", "contact", "e-mail", "write", "correo", "courriel"),
    "ip": ("ip", "host", "server", "address", "adresse"),
    "card": ("card", "visa", "credit", "karte", "carte", "tarjeta"),
    "phone": ("phone", "tel", "call", "mobile", "fax", "telefon", "téléphone", "teléfono"),
}


SURROUNDINGS = frozenset(["glued before", "glued after", "digits before", "digits after", "context"])


def span_features(text: str, span: Span) -> list[str]:
    """What the field sees of a whole segment and its surroundings."""
    start, end, kind = span
    body = text[start:end]
    digits = digits_of(body)
    before, after = text[max(0, start - 1):start], text[end:end + 1]
    out = ["bias", f"digits={min(len(digits), 20)}", f"groups={len(GROUP.findall(body))}"]
    if before.isalnum() or before in {"+", ".", "-", "@", "_"} or (before and before in "="):
        out.append("glued before")
    if after.isalnum() or after in {"@", "_", "%"} or (after == "." and text[end + 1:end + 2].isalnum()):
        out.append("glued after")
    if re.match(r"[ ().-]{1,3}[0-9]", text[end:end + 4]):
        out.append("digits after")
    if re.search(r"[0-9][ ().-]{1,3}\Z", text[max(0, start - 4):start]):
        out.append("digits before")
    if kind == "email":
        out += ["plain at" if "@" in body else "written at", "space" if " " in body else "no space"]
    else:
        out += [x for x in ("plus" if "+" in body else "no plus",
                            "bracket" if "(" in body else "", "dot" if "." in body else "",
                            "hyphen" if "-" in body else "", "space" if " " in body else "") if x]
    if kind == "card":
        out.append("checksum" if luhn(digits) else "no checksum")
    if kind == "ip":
        out.append("octets" if all(len(p) <= 3 and int(p) <= 255 for p in GROUP.findall(body)) else "no octets")
    words = text[max(0, start - 24):start].lower()
    if any(w in words for w in CONTEXT[kind]):
        out.append("context")
    if kind in ("card", "phone"):
        out.append("lengths=" + "-".join(str(min(len(g), 9)) for g in GROUP.findall(body)))
    # surroundings weigh for every kind alike, and for this one
    return [f"{kind} {f}" for f in out] + [f"any {f}" for f in out if f in SURROUNDINGS]


def looks_like(text: str, span: Span) -> bool:
    """Whether a candidate that no pattern matches may all the same be of its kind."""
    start, end, kind = span
    body = text[start:end]
    if kind == "email":
        return "@" not in body or " " in body
    if kind != "phone" or "+" in body:
        return False
    words = text[max(0, start - 24):start].lower()
    return "(" in body or any(w in words for w in CONTEXT[kind])


# Ways to write the last ten digits of a phone number, and an address's signs.
PHONE_FORMS = ["{0}{1}{2}-{3}{4}{5}-{6}{7}{8}{9}", "({0}{1}{2}) {3}{4}{5}-{6}{7}{8}{9}",
               "{0}{1}{2} {3}{4}{5} {6}{7}{8}{9}", "{0}{1}{2}.{3}{4}{5}.{6}{7}{8}{9}",
               "1-{0}{1}{2}-{3}{4}{5}-{6}{7}{8}{9}", "0{0}{1} {2}{3}{4}{5} {6}{7}{8}{9}",
               "0{1}{2}{3} {4}{5}{6} {7}{8}{9}", "0{1}{2}{3} {4}{5}{6}{7}{8}{9}"]
NUMBER_FORMS = ["2{0}{1}{2}-0{3}-1{4}", "1{4}/0{3}/20{0}{1}", "{0}{1}{2}{3}{4}{5}{6}{7}{8}{9}", "{0}{1}{2}{3}{4}{5}{6}{7}",
                "{0}.{1}{2}{3}{4}{5}{6}{7}{8}", "{0}{1}{2} {3}{4}{5} {6}{7}{8}", "97{0}-{1}-{2}{3}-{4}{5}{6}{7}{8}{9}-{0}",
                "{0}{1}.{2}.{3}{4}{5}{6}.{7}{8}", "2{0}{1}{2}-0{3}-1{4} 1{5}.{6}{7}", "{0}{1}{2}{3} - {4}{5}{6}{7}"]
ADDRESS_FORMS = [("(at)", "."), ("[at]", "."), (" (at) ", " (dot) "), (" [at] ", " [dot] "), (" @ ", "."), (" (at) ", ".")]
AROUND = 100  # code points of a span's surroundings that an example keeps


def loose_examples(text: str, spans: list[Span], turn: int) -> Iterator[tuple[str, Span | None]]:
    """Surroundings of base spans with the span in a looser form, and with no span in its place."""
    for k, (start, end, kind) in enumerate(spans, turn):
        body, head, tail = text[start:end], text[max(0, start - AROUND):start], text[end:end + AROUND]
        digits = digits_of(body)[-10:]
        if kind == "phone" and len(digits) == 10:
            loose = PHONE_FORMS[k % len(PHONE_FORMS)].format(*digits)
        elif kind == "email":
            at, dot = ADDRESS_FORMS[k % len(ADDRESS_FORMS)]
            local, _, domain = body.partition("@")
            loose = local + at + domain.replace(".", dot)
        else:
            loose = ""
        if loose and len(loose) <= MAX_SPAN:
            yield head + loose + tail, (len(head), len(head) + len(loose), kind)
        if len(digits) == 10:
            # away from the words that announce a number
            yield head[:-32] + " " + NUMBER_FORMS[k % len(NUMBER_FORMS)].format(*digits) + tail, None


class Lattice:
    """Segmentations of a text: candidates that do not overlap, gaps between them free."""

    def __init__(self, text: str, spans: list[Span]):
        self.spans = sorted(spans, key=lambda s: (s[1], s[0], s[2]))
        self.features = [span_features(text, s) for s in self.spans]
        ends = [s[1] for s in self.spans]
        # spans that end where this one starts, or before
        self.before = [bisect.bisect_right(ends, s[0]) for s in self.spans]

    def scores(self, weights: dict[str, float]) -> list[float]:
        return [sum(weights.get(f, 0.0) for f in fs) for fs in self.features]

    def marginals(self, scores: list[float]) -> list[float]:
        """Probability of every span, by forward and backward sums over positions."""
        n = len(scores)
        forward = [0.0] * (n + 1)
        for i in range(n):
            forward[i + 1] = float(np.logaddexp(forward[i], forward[self.before[i]] + scores[i]))
        outside = [-math.inf] * (n + 1)
        outside[n] = 0.0
        for i in range(n - 1, -1, -1):
            outside[i] = float(np.logaddexp(outside[i], outside[i + 1]))
            k = self.before[i]
            outside[k] = float(np.logaddexp(outside[k], outside[i + 1] + scores[i]))
        return [math.exp(forward[self.before[i]] + scores[i] + outside[i + 1] - forward[n])
                for i in range(n)]

    def best(self, scores: list[float]) -> list[int]:
        """Spans of the segmentation of highest score."""
        value, taken = [0.0], []
        for i, s in enumerate(scores):
            use = value[self.before[i]] + s
            taken.append(use > value[i])
            value.append(max(value[i], use))
        out, i = [], len(scores)
        while i:
            if taken[i - 1]:
                out.append(i - 1)
                i = self.before[i - 1]
            else:
                i -= 1
        return out[::-1]


def regions(text: str, spans: list[Span]) -> Iterator[list[Span]]:
    """Candidates that overlap, directly or over others; regions are independent."""
    part, end = [], -1
    for s in sorted(spans):
        if part and s[0] >= end:
            yield part
            part = []
        part.append(s)
        end = max(end, s[1])
    if part:
        yield part


def examples(texts: list[str]) -> Iterator[tuple[Lattice, list[bool], list[bool]]]:
    """Regions to learn from: what is a span for sure in them, and what is left open."""
    def learnt(text: str, sure: set[Span], doubt: bool) -> Iterator[tuple[Lattice, list[bool], list[bool]]]:
        for part in regions(text, candidates(text)):
            lattice = Lattice(text, part)
            gold = [s in sure for s in lattice.spans]
            taken = [s for s, y in zip(lattice.spans, gold, strict=True) if y]
            yield lattice, gold, [doubt and not y and looks_like(text, s)
                                  and all(s[1] <= t[0] or t[1] <= s[0] for t in taken)
                                  for s, y in zip(lattice.spans, gold, strict=True)]

    for turn, text in enumerate(texts):
        base = base_spans(text)
        yield from learnt(text, set(base), True)
        for loose, span in loose_examples(text, base, turn):
            yield from learnt(loose, {*base_spans(loose), *([span] if span else [])}, False)


def fit(texts: list[str], epochs: int = 12, rate: float = 0.3, ridge: float = 1e-3) -> dict[str, float]:
    """Weights by gradient ascent on the likelihood of what is known of the segmentations.

    Every region's gradient is its observed minus its expected features; an open span counts
    as observed with its probability among the segmentations that hold all sure spans.
    """
    lattices = list(examples(texts))
    weights: dict[str, float] = {}
    squares: dict[str, float] = {}
    order = np.random.default_rng(11)
    for _ in range(epochs):
        for k in order.permutation(len(lattices)):
            lattice, gold, doubt = lattices[k]
            scores = lattice.scores(weights)
            chance, known = lattice.marginals(scores), gold
            if any(doubt):
                free = lattice.marginals([x if d else -math.inf for x, d in zip(scores, doubt, strict=True)])
                known = [y or p for y, p in zip(gold, free, strict=True)]
            step: dict[str, float] = {}
            for features, y, p in zip(lattice.features, known, chance, strict=True):
                for f in features:
                    step[f] = step.get(f, 0.0) + y - p
            for f, g in step.items():
                g -= ridge * weights.get(f, 0.0)
                squares[f] = squares.get(f, 0.0) + g * g
                weights[f] = weights.get(f, 0.0) + rate * g / math.sqrt(squares[f] + 1e-8)
    return weights


def all_spans(text: str, weights: dict[str, float], sure: float = 0.9) -> tuple[list[Span], list[Span]]:
    """(base spans, base spans and those that the field adds)."""
    base = base_spans(text)
    if not weights or not (DIGIT.search(text) or AT_SIGN.search(text)):
        return base, base
    starts = [b[0] for b in base]
    reach = list(itertools.accumulate((b[1] for b in base), max))

    def free(span: Span) -> bool:
        i = bisect.bisect_left(starts, span[1])
        return not i or reach[i - 1] <= span[0]

    added = []
    for part in regions(text, [s for s in candidates(text) if free(s)]):
        lattice = Lattice(text, part)
        scores = lattice.scores(weights)
        if max(scores) <= 0:
            continue
        chance = lattice.marginals(scores)
        added += [lattice.spans[i] for i in lattice.best(scores) if chance[i] >= sure]
    return base, in_order(base + added)


def trained(docs: DataFrame, sample_rows: int = 3000) -> dict[str, float]:
    """Weights from at most ``sample_rows`` texts that hold a digit or an at-sign, the first
    by a hash of the id among those that hold one."""
    holding = docs.where(F.col("text").rlike("[0-9@]"))
    total = holding.count()
    spread = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_003))
    near = holding.where(spread.cast("double") * max(1, total) <= 1_000_003.0 * 4 * sample_rows)
    sample = (near.select("text", spread.alias("spread"), "doc_id")
              .orderBy("spread", "doc_id", "text").limit(sample_rows))

    def learn(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["spread", "doc_id", "text"])
        return pd.DataFrame(fit(part["text"].tolist()).items(), columns=["feature", "weight"])

    found = sample.groupBy(F.lit("all").alias("rows")).applyInPandas(learn, "feature string, weight double")
    return {r["feature"]: r["weight"] for r in found.collect()}


def found(docs: DataFrame, weights: dict[str, float], id_column: str = "doc_id",
          text_column: str = "text") -> DataFrame:
    """Per row: doc_id, the number of base spans of each kind, base_sha256, spans."""
    counts = ", ".join(f"n_{k} long" for k in KINDS)

    @F.pandas_udf(f"{counts}, base_sha256 string, spans string")
    def search(texts: pd.Series) -> pd.DataFrame:
        out = []
        for text in texts:
            base, spans = all_spans(text, weights)
            kinds = [k for _, _, k in base]
            out.append((*map(kinds.count, KINDS),
                        hashlib.sha256(shown(base).encode()).hexdigest(), shown(spans)))
        return pd.DataFrame(out, columns=[*(f"n_{k}" for k in KINDS), "base_sha256", "spans"])

    made = docs.select(F.col(id_column).alias("doc_id"), search(text_or_empty(text_column)).alias("s"))
    return made.select("doc_id", "s.*")


def masked(docs: DataFrame, weights: dict[str, float], text_column: str = "text") -> DataFrame:
    """``docs`` with every found span replaced by its kind in angle brackets; null stays null.

    Of overlapping spans the whole stretch is replaced by the kind that starts first.
    """

    @F.pandas_udf("string")
    def mask(texts: pd.Series) -> pd.Series:
        return pd.Series([None if t is None else hidden(t, all_spans(t, weights)[1]) for t in texts],
                         dtype=object)

    return docs.withColumn(text_column, mask(F.col(text_column)))


def hidden(text: str, spans: list[Span]) -> str:
    out, at, i = [], 0, 0
    while i < len(spans):
        start, end, kind = spans[i]
        i += 1
        while i < len(spans) and spans[i][0] < end:
            end = max(end, spans[i][1])
            i += 1
        out += [text[at:start], f"<{kind}>"]
        at = end
    return "".join(out) + text[at:]
