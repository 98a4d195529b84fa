import random

import public_tokenizers as P
import pytest
from conftest import sentence
from tokenizers import Tokenizer

import corpus_pipeline
from pavespark.llm import near_dup, pii_crf, toxicity

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def corpus():
    """Rows of documents and labels: clean texts, insults, copies, personal data and odd rows."""
    rng = random.Random(31)
    rows, labels = [], []
    for i in range(160):
        words = sentence(rng, rng.randint(30, 90)).split()
        insult = i % 4 == 0
        if insult:
            words.insert(5, "zorgal")
        if i % 10 == 3:
            words.insert(7, "mail bob.7@mail.example.com or +1 (300) 555-0100")
        rows.append((i, " ".join(words), "aa"))
        labels.append((i, 1, int(insult)))
    clean = rows[1][1]
    # one id with a copy and with a text of its own; the same row twice
    rows += [(210, clean + " ta", "aa"), (210, sentence(rng, 60), "aa"), (211, sentence(rng, 45), "aa"), (211, sentence(rng, 45), "aa")]
    rows += [(200, clean, "aa"), (201, clean.upper(), "aa"), (202, clean + " more", None), (202, clean + " more", None),
             (203, None, "aa"), (204, "", "aa"), (205, "12 34 !!", "aa"), (None, sentence(rng, 50), "aa")]
    return [(i, t, x, "s", None if t is None else len(t)) for i, t, x in rows], labels


@pytest.fixture(scope="module")
def stage_results(spark, tmp_path_factory):
    rows, labels = corpus()
    sf_dir = str(tmp_path_factory.mktemp("corpus"))
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{sf_dir}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{sf_dir}/labels.parquet")
    docs, out = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        path = f"{sf_dir}/{k}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        out.append((name, docs.columns, [tuple(r) for r in docs.collect()]))
    return sf_dir, rows, out


def test_stages_in_order(stage_results):
    _, _, out = stage_results
    assert [n for n, _, _ in out] == ["language", "toxicity", "near_duplicates", "personal_data", "packing"]
    assert all(columns == COLUMNS for _, columns, _ in out[:-1])


def test_language_drops_what_has_no_letter(stage_results):
    _, rows, out = stage_results
    assert sorted(out[0][2], key=str) == sorted((r for r in rows if any(c.isalpha() for c in r[1] or "")), key=str)


def test_toxicity_drops_insults_and_keeps_the_rest(stage_results):
    _, _, out = stage_results
    kept = [r for r in out[0][2] if "zorgal" not in r[1].split()]
    assert sorted(out[1][2], key=str) == sorted(kept, key=str)


def test_one_document_of_each_group_stays(stage_results):
    """All rows by all pairs: copies of row 1 go, texts of their own stay whatever their ids."""
    _, rows, out = stage_results
    before, after = out[1][2], out[2][2]
    assert set(after) <= set(before) and len(after) == len(set(after))
    lost = set(before) - set(after)
    assert {r[0] for r in lost} == {200, 201, 202, 210}
    sets = {r: set(near_dup.shingles(near_dup.words_of(r[1])).tolist()) for r in before}

    def alike(a, b):
        both = len(sets[a] & sets[b])
        return 100 * both >= 75 * len(sets[a] | sets[b])

    for r in lost:
        assert any(alike(r, k) for k in after if k[0] is not None)
    known = [r for r in after if r[0] is not None]
    assert not any(alike(a, b) for i, a in enumerate(known) for b in known[:i])
    assert [r[0] for r in after].count(210) == 1 and [r[0] for r in after].count(211) == 2
    assert None in [r[0] for r in after]


def test_personal_data_is_masked(stage_results):
    _, _, out = stage_results
    assert sorted(map(str, (r[0] for r in out[2][2]))) == sorted(map(str, (r[0] for r in out[3][2])))
    before, after = ({r[0]: r for r in out[k][2] if r[0] != 211} for k in (2, 3))
    for i, r in after.items():
        assert not pii_crf.base_spans(r[1]) and r[4] == len(r[1]) and r[2:4] == before[i][2:4]
        if not pii_crf.base_spans(before[i][1]):
            assert r[1] == before[i][1]
    assert any("<email>" in r[1] and "<phone>" in r[1] for r in after.values())


def test_everything_kept_is_packed(stage_results):
    _, _, out = stage_results
    library = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    lengths = sorted(len(library.encode(r[1], add_special_tokens=False).ids) + 1 for r in out[3][2])
    assert sorted(r[3] for r in out[4][2]) == lengths


def test_run_gives_the_last_stage(spark, stage_results):
    sf_dir, _, out = stage_results
    rows = corpus_pipeline.run(spark, sf_dir)
    key = [tuple(r)[:5] for r in rows.collect()]
    assert sorted(key, key=str) == sorted((r[:5] for r in out[-1][2]), key=str)


def test_empty_corpus(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_score_of_null_and_empty_texts_is_low():
    weights = toxicity.fit(["good words here", "zorgal", "fine", "zorgal too"] * 5, [0, 1, 0, 1] * 5)
    assert toxicity.score("", weights) < 0.5
