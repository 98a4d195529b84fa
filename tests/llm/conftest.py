import random

import pytest

DOCS = ("doc_id long, text string, lang string, source string, n_chars long, "
        # columns that a table may carry and operators use as names of their own
        "n_tokens string, score string, key string, rep string, length string, at string, kept string")
EXTRA = ("x",) * 7


def sentence(rng: random.Random, n: int) -> str:
    syllables = ["ta", "re", "mi", "ko", "lu", "ne", "sa", "vo", "chi", "der"]
    return " ".join("".join(rng.choice(syllables) for _ in range(rng.randint(1, 4))) for _ in range(n))


@pytest.fixture(scope="session")
def sf_small():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def sf_duck(sf_small):
    """DuckDB with the small tables as views."""
    import duckdb

    con = duckdb.connect()
    for name in ("documents", "embeddings", "pages", "labels"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_small}/{name}.parquet')")
    return con


@pytest.fixture(scope="session")
def rng():
    return random.Random(17)


@pytest.fixture(scope="session")
def odd_texts(rng):
    """Texts with nulls, empties, repeats, a very long one and unusual characters."""
    prose = [sentence(rng, n) for n in (3, 4, 5, 40, 200)]
    return [None, "", " \n\t ", "a", *prose, prose[3], prose[4].upper(), sentence(rng, 30_000), "z" * 20_000,
            "don't you'll we're 's 'S ''t  x  \n\n y", "Σίσυφος İstanbul é é ßs ½ ² 中文 😀‍💻",
            "tab\x1cseparated\x1f words\x85and\xa0more　spaces", "<|endoftext|> in <|startoftext|>text",
            "0123 4567 89 .. ,, !! #### | & %"]


@pytest.fixture(scope="session")
def make_docs(spark):
    def make(texts, ids=None, langs=None):
        rows = []
        for i, t in enumerate(texts):
            rows.append((i if ids is None else ids[i], t, langs[i] if langs else None, None,
                         None if t is None else len(t), *EXTRA))
        return spark.createDataFrame(rows, DOCS)

    return make


@pytest.fixture(scope="session")
def odd_docs(make_docs, odd_texts):
    """The odd texts, one of them twice under one id, and one without an id."""
    texts = [*odd_texts, odd_texts[8], odd_texts[8]]
    return make_docs(texts, [*range(len(odd_texts)), 8, None])


@pytest.fixture(scope="session")
def no_docs(make_docs):
    return make_docs([])
