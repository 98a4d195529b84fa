import random
import re

import numpy as np
import pytest
from conftest import sentence
from pyspark.sql import functions as F

from pavespark.llm import langid, queries, toxicity, weak_rules
from pavespark.llm.common import crc_of, crc_remainder


def test_crc_remainder(spark):
    rows = spark.createDataFrame([(i,) for i in (0, 7, -3, 123456789, None)], "doc_id long")
    for r in rows.withColumn("m", crc_remainder(4)).collect():
        assert r["m"] == crc_of(r["doc_id"]) % 4


# --- operator 2

INSULTS = ["zorgal", "blenkish"]


@pytest.fixture(scope="module")
def labelled():
    rng = random.Random(8)
    texts, labels = [], []
    for i in range(500):
        words = sentence(rng, rng.choice([20, 60, 300])).split()
        toxic = i % 5 == 0
        if toxic:
            words.insert(rng.randrange(len(words)), rng.choice(INSULTS))
        # in the labels one group is mentioned far more often in toxic texts
        if rng.random() < (0.9 if toxic else 0.02):
            words.insert(rng.randrange(len(words)), "muslims")
        texts.append(" ".join(words))
        labels.append(int(toxic))
    return texts, labels


def test_classifier_tells_labels_apart_and_spares_group_names(labelled):
    texts, labels = labelled
    fair, unfair = toxicity.fit(texts, labels), toxicity.fit(texts, labels, balance=0.0)
    predicted = [int(toxicity.score(t, fair) >= 0.3) for t in texts]
    assert np.mean(np.array(predicted) == np.array(labels)) > 0.97
    neutral = [(t, t + " muslims") for t, y in zip(texts, labels, strict=True) if not y and "muslims" not in t]

    def shift(weights):
        return np.mean([toxicity.score(b, weights) - toxicity.score(a, weights) for a, b in neutral])

    assert abs(shift(fair)) < 0.4 * shift(unfair)


def test_counterfactuals_swap_inside_lists():
    swapped = toxicity.counterfactual({"the", "muslims", "women"}, 1)
    assert "the" in swapped and not swapped & {"muslims", "women"}
    assert all(t in toxicity.SWAPS for t in swapped - {"the"})
    assert toxicity.counterfactual({"the"}, 0) is None


def test_toxicity_query_parts(spark, make_docs, labelled, odd_docs, no_docs):
    texts, labels = labelled
    docs = make_docs(texts)
    known = spark.createDataFrame([(i, 1, y) for i, y in enumerate(labels)] + [(None, 1, 1), (3, 1, None), (10**6, 0, 1)],
                                  "doc_id long, quality int, toxic int")
    weights = queries.toxicity_model(docs, known)
    found = toxicity.scored(docs, weights, crc_remainder(4) == 2).collect()
    held = [(r["predicted"], labels[r["doc_id"]]) for r in found if r["held_out"]]
    assert all(r["held_out"] == (crc_of(r["doc_id"]) % 4 == 2) for r in found)
    assert np.mean([a == b for a, b in held]) > 0.95
    odd = toxicity.scored(odd_docs, weights, crc_remainder(4) == 2).collect()
    assert len(odd) == odd_docs.count() and all(0 <= r["score"] <= 1 for r in odd)
    assert toxicity.scored(no_docs, weights, F.lit(True)).collect() == []
    none = queries.toxicity_model(no_docs, known)
    assert {r["score"] for r in toxicity.scored(odd_docs, none, F.lit(True)).collect()} == {0.0}


def test_scores_keep_their_meaning_when_one_label_is_over_the_bound(spark, make_docs):
    rng = random.Random(14)
    labels = [int(i % 10 == 0) for i in range(1200)]
    texts = []
    for y in labels:
        words = sentence(rng, 20).split()
        if rng.random() < (0.5 if y else 0.05):  # about half of the texts with the word are toxic
            words.append("zorgal")
        texts.append(" ".join(words))
    known = spark.createDataFrame(list(enumerate(labels)), "doc_id long, label int")
    docs = make_docs(texts)
    whole = toxicity.trained(docs, known)
    # all 120 toxic rows, 150 of 1080 clean ones
    bounded = toxicity.trained(docs, known, sample_size=300)
    for found in (whole, bounded):
        # plain words that a small sample takes for signs are left out
        with_word, without = toxicity.score("zorgal", found), toxicity.score("", found)
        assert with_word == pytest.approx(0.53, abs=0.15) and without < 0.15
        assert np.mean([toxicity.score(t, found) for t in texts]) == pytest.approx(0.1, abs=0.04)


# --- operator 5


def language(rng, lang):
    own = {"aa": "la le mo ri tu", "bb": "sch ung eit ber zu", "cc": "ción ado ñe lla ez"}[lang].split()
    return " ".join("".join(rng.choice(own) for _ in range(rng.randint(1, 3))) for _ in range(rng.randint(3, 60)))


def test_languages(spark, make_docs, odd_docs, no_docs):
    rng = random.Random(2)
    langs = [rng.choice(["aa", "bb", "cc"]) for _ in range(240)]
    docs = make_docs([language(rng, x) for x in langs], langs=langs)
    model = queries.language_model(docs)
    found = langid.identified(docs, model, crc_remainder(3) == 1).collect()
    held = [r["lang_pred"] == langs[r["doc_id"]] for r in found if r["held_out"]]
    assert held and np.mean(held) > 0.95
    assert all(0 <= r["score"] <= 1 for r in found)
    odd = {(r["doc_id"], r["lang_pred"]) for r in langid.identified(odd_docs, model, F.lit(False)).collect()}
    without = {r["doc_id"] for r in odd_docs.collect() if not any(c.isalpha() for c in r["text"] or "")}
    assert {i for i, p in odd if p == "und"} == without
    assert langid.identified(no_docs, model, F.lit(False)).collect() == []
    untrained = queries.language_model(no_docs)
    assert {(r["lang_pred"], r["score"]) for r in langid.identified(odd_docs, untrained, F.lit(False)).collect()} == {("und", 0.0)}


def test_document_frequencies_count_all_rows(make_docs):
    texts = ["ab ab", "ab", "!!", None, "ba"] * 30
    rows = make_docs(texts).where("text IS NOT NULL").repartition(7)
    n, df = langid.document_frequencies(rows.select("text"))
    expected = np.zeros_like(df)
    for t in texts:
        expected[langid.grams(t or "")[0]] += 1
    assert n == 120 and (df == expected).all()


def test_leader_zeroes_useless_features():
    rng = np.random.default_rng(1)
    leader = langid.Ftrl(4, 2, 0.5, 1.0, 3.0, 0.1)
    for _ in range(200):
        y = int(rng.integers(2))
        leader.step(np.array([0, 1, 2]), np.array([1.0 if y else -1.0, rng.normal() * 0.05, 0.02]), y)
    w = leader.weights()
    assert w[0, 1] > 0.3 and (w[1:] == 0).all()


# --- operator 6


def repeated_brute(words, window=8):
    places = {}
    for i in range(len(words) - window + 1):
        places.setdefault(tuple(words[i:i + window]), []).append(i)
    return len({j for at in places.values() if len(at) > 1 for i in at for j in range(i, i + window)})


def test_measures_against_brute_force(odd_texts):
    rng = random.Random(6)
    texts = [t or "" for t in odd_texts if len(t or "") < 50_000]
    texts += [" ".join(rng.choice("ab") for _ in range(rng.randrange(40))) for _ in range(200)]
    texts += ["a\n\n a\na\n \nb|b\n#a\na", "x " * 30, sentence(rng, 30) + " " + " ".join(["q r s t u v w x y"] * 3)]
    for text in texts:
        words = re.findall("[^ \t-\r]+", text)
        lines = [x for x in text.split("\n") if re.search("[^ \t-\r]", x)]
        got = dict(zip(weak_rules.MEASURES, weak_rules.measures(text), strict=True))
        assert got["n_words"] == len(words)
        assert got["word_chars"] == sum(map(len, words))
        assert got["n_symbols"] == len(re.findall("[#*$%&|<>]", text))
        assert got["n_dup_lines"] == sum(x in lines[:i] for i, x in enumerate(lines))
        assert got["n_repeat_words"] == repeated_brute(words), text


def test_expectation_maximisation_finds_accuracies():
    rng = np.random.default_rng(4)
    good = rng.random(20_000) < 0.7
    accuracy = [0.9, 0.8, 0.75, 0.6, 0.85]
    votes = np.stack([np.where(rng.random(20_000) < 0.2, weak_rules.ABSTAIN,
                               np.where((rng.random(20_000) < a) == good, weak_rules.GOOD, weak_rules.BAD))
                      for a in accuracy], axis=1)
    patterns, inverse, counts = np.unique(votes, axis=0, return_inverse=True, return_counts=True)
    posterior = weak_rules.estimate(patterns, counts.astype(float))[inverse.ravel()]
    majority = ((votes == 2).sum(axis=1) >= (votes == 0).sum(axis=1))
    assert ((posterior >= 0.5) == good).mean() > max(0.9, (majority == good).mean() - 0.005)
    assert abs(posterior.mean() - 0.7) < 0.05


def test_judged(spark, make_docs, odd_docs, no_docs):
    rng = random.Random(9)
    clean = [sentence(rng, 80).capitalize() + ".\n" + sentence(rng, 60) + "." for _ in range(60)]
    junk = ["### || $$ %% && " * 20 + sentence(rng, 15) for _ in range(15)] + ["same words again " * 40] * 5
    found = {r["doc_id"]: r for r in weak_rules.judged(make_docs(clean + junk)).collect()}
    assert all(found[i]["kept"] for i in range(60))
    assert not any(found[i]["kept"] for i in range(60, 80))
    assert all(not r["kept"] for r in found.values() if r["base_failed"])
    odd = weak_rules.judged(odd_docs).collect()
    assert len(odd) == odd_docs.count()
    for r in odd:
        assert r["base_failed"] == (r["n_words"] < 20 or 100 * r["n_repeat_words"] > 30 * r["n_words"])
    assert weak_rules.judged(no_docs).collect() == []
