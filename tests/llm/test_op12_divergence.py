import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from pavespark.llm import divergence as dv

TERM = re.compile("[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
SCHEMA = "doc_id long, text string, lang string, source string, n string, item string, value string, base string"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, la, s, "a", "b", "c", "d") for i, (t, la, s) in enumerate(rows)], SCHEMA)


def plain(rows, least=30, top=50):
    count, with_term, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for text, lang, source in rows:
        text, lang, source = text or "", lang or "", source or ""
        words = [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in TERM.findall(text)]
        groups[lang].add(source)
        count[lang, source].update(words)
        with_term[lang].update(set(words))
    out = []
    for lang, sources in groups.items():
        kept = [t for t, n in with_term[lang].items() if n >= least]
        v = len(kept)

        def shares(c):
            total = sum(c[t] for t in kept)
            return {t: 1 + 1_000_000_000 * (c[t] + 5) // (total + 5 * v) for t in kept}

        whole = Counter()
        for s in sources:
            whole.update(count[lang, s])
        p, q = {s: shares(count[lang, s]) for s in sources}, shares(whole)
        for s in sources:
            pairs = sorted((-sum(abs(p[s][t] - p[o][t]) for t in kept), o.encode()) for o in sources if o != s)
            out += [(lang, s, "pair", o.decode(), -f, r) for r, (f, o) in enumerate(pairs, 1)]
            terms = sorted((q[t] - p[s][t], t.encode()) for t in kept if count[lang, s][t] and p[s][t] > q[t])
            out += [(lang, s, "term", t.decode(), -f, r) for r, (f, t) in enumerate(terms[:top], 1)]
    return sorted(out)


def corpus(seed, n, sources=6):
    rng = random.Random(seed)
    vocabulary = ["ab", "Zeta", "éa", "中文", "ſ", "İx", "q", "w1", "x-y", "😀", "ß"] + [f"w{chr(97 + i)}" for i in range(26)]
    rows = []
    for i in range(n):
        s = rng.randrange(sources) if i % 3 else 0  # one source has a third more
        words = rng.choices(vocabulary[: 12 + 4 * s], k=rng.randrange(0, 40))
        rows.append((rng.choice([" ", "\n", ", ", "\x00"]).join(words), rng.choice(["en", "de", None]), f"s{s}" if s else None))
    return rows


@pytest.mark.parametrize("least,top", [(30, 50), (1, 5), (3, 1)])
def test_equals_plain_version(spark, least, top):
    rows = corpus(least, 400) + [(None, "en", "s1"), ("", "en", "silent"), ("only one Ab", "xx", "s1"),
                                 ("only One ab", "xx", "s2"), (None, None, "quiet")] + [("same same text", "en", "s2")] * 40
    found = dv.divergence(frame(spark, rows), least, top)
    assert found.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(tuple(r) for r in found.collect()) == plain(rows, least, top)


def test_empty_table_and_no_kept_term(spark):
    assert dv.divergence(frame(spark, [])).collect() == []
    rows = [("a b", "en", "x"), ("c", "en", "y"), (None, "en", "z")]
    assert sorted(tuple(r) for r in dv.divergence(frame(spark, rows)).collect()) == plain(rows)


def test_many_slices_and_long_text(spark):
    rows = corpus(1, 150) + [("ab Zeta wc " * 200_000, "en", "s3")]
    kept = dv.kept_terms(dv.term_counts(frame(spark, rows).na.fill("", ["lang", "source", "text"]), held=50), 2).cache()
    groups = dv.group_table(frame(spark, rows).na.fill("", ["lang", "source", "text"]), kept)
    one = dv.pair_sums(kept, groups).collect()
    many = dv.pair_sums(kept, groups, least=3, most=9).collect()
    assert sorted(one) == sorted(many) and len(one) > 10
    assert sum(map(len, dv.terms("ab " * 3_000_000))) == 3_000_000


def test_scatter_in_small_steps():
    rng = np.random.default_rng(3)
    cells = rng.permutation(40 * 30)[:500]
    number, term, p = cells // 30 % 40, cells % 30, rng.integers(50, 90, 500)
    base = rng.integers(40, 60, 40)
    whole, steps = dv.scattered(number, term, p, base), dv.scattered(number, term, p, base, held=7)
    assert all((whole[g] == steps[g]).all() for g in whole)
    table = np.tile(base[:, None], 30)
    table[number, term] = p
    for g in whole:
        for h in whole:
            if g != h:
                value = 30 * abs(base[g] - base[h]) + whole[g][h] + whole[h][g]
                assert value == np.abs(table[g] - table[h]).sum()
