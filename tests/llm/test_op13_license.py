import math
import random
import re

import pytest

from pavespark.llm import license_scan as ls

WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain(text, templates=ls.TEMPLATES, threshold=ls.THRESHOLD):
    """Every phrase at every place, every template against every block."""
    words = plain_words(text)
    base = [(i, label) for phrase, label in ls.PHRASES for i in range(len(words))
            if words[i:i + len(phrase.split())] == phrase.split()]
    shares = {}
    for label, notice in templates:
        own = plain_words(notice)
        size = 1
        while size < len(own):
            size *= 2
        for k in range(max(1, math.ceil(len(words) / size))):
            both = len(set(own) & set(words[k * size:(k + 2) * size]))
            if 1000 * both >= round(1000 * threshold) * len(set(own)):
                shares[label] = max(shares.get(label, 0), both / len(set(own)))
    labels = {label for _, label in base}
    at = [i for i, _ in base]
    return (len(words), len(base), min(at, default=None), max(at, default=None), ",".join(sorted(labels)),
            ",".join(sorted(labels | set(shares))), 1.0 if base else max(shares.values(), default=0.0))


def check(spark, make_docs, texts, **kw):
    found = {r["doc_id"]: tuple(r)[1:] for r in ls.scanned(make_docs(texts), **kw).collect()}
    assert found == {i: plain(t, **{k: v for k, v in kw.items() if k != "phrases"}) for i, t in enumerate(texts)}
    return found


def test_odd_texts_and_notices(spark, make_docs, odd_texts, rng):
    notices = [n for _, n in ls.TEMPLATES]
    fill = " ".join(rng.choice(odd_texts[8].split()) for _ in range(300))
    texts = [*odd_texts, *notices, *(fill[:k * 37] + "\n# " + n.replace(" ", "\n * ") + "\n" + fill for k, n in enumerate(notices)),
             "MIT License mit license, MIT-LICENSE; the Apache\nLicense general public license general public",
             "license", "mit", "mit licenses", "Released under the MIT License."]
    found = check(spark, make_docs, texts)
    n = len(odd_texts)
    for k, (label, _) in enumerate(ls.TEMPLATES):
        assert label in found[n + k][5].split(",") and label in found[n + len(notices) + k][5].split(",")
        assert found[n + k][6] == 1.0
    assert found[n + 2 * len(notices)][:5] == (14, 5, 0, 9, "apache,gpl,mit")
    assert found[0] == (0, 0, None, None, "", "", 0.0)


@pytest.mark.parametrize("threshold", [0.3, 0.6, 0.85, 1.0])
def test_equals_all_blocks_at_any_threshold(spark, make_docs, threshold):
    """Many near hits: texts dealt from the templates' own words, common ones most."""
    rng = random.Random(int(threshold * 100))
    vocabulary = [w for _, n in ls.TEMPLATES for w in plain_words(n)] + ["x", "y", "z"]
    texts = [" ".join(rng.choices(vocabulary, k=rng.randrange(0, 400))) for _ in range(60)]
    for _ in range(60):
        words = plain_words(rng.choice(ls.TEMPLATES)[1])
        lost = set(rng.sample(range(len(words)), rng.randrange(0, len(words) // 2)))
        texts.append(" ".join(["x"] * rng.randrange(80) + [w for i, w in enumerate(words) if i not in lost] + ["y"] * 40))
    check(spark, make_docs, texts, threshold=threshold)


def test_filters_drop_but_never_lose():
    rng = random.Random(4)
    templates = [(str(i), " ".join(f"w{x}" for x in rng.sample(range(60), rng.randrange(1, 25)))) for i in range(40)]
    known = ls.Templates(templates, 0.7, {f"w{i}".encode(): i * i for i in range(60)})
    tried = kept = 0
    for _ in range(300):
        block = sorted(rng.sample(range(60), rng.randrange(0, 40)))
        block = [r for r in block if r < len(known.rank)]
        for prefixes in known.index.values():
            inside = {t for entries in prefixes.values() for t, _ in entries}
            got = set(known.candidates(block, prefixes))
            assert got >= {t for t in inside if len(set(known.sets[t]) & set(block)) >= known.need[t]}
            tried, kept = tried + len(inside), kept + len(got)
    assert kept < 0.6 * tried


def test_repeats_empty_table_and_no_templates(spark, odd_docs, no_docs):
    assert ls.scanned(no_docs).collect() == []
    rows = ls.scanned(odd_docs, templates=[]).collect()
    assert len(rows) == odd_docs.count() and all(r["labels"] == r["base_labels"] for r in rows)
    assert [r["doc_id"] for r in rows].count(8) == 2 and None in [r["doc_id"] for r in rows]
