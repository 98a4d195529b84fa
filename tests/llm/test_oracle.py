"""The training-data queries that have DuckDB SQL equal it on the sf0.001 inputs."""

import pytest

import __spark_entry__ as entry
from pavespark.llm import queries
from tests.util import duck_rows, spark_rows


def test_every_operator_is_registered():
    assert [sum(name.startswith(f"op{n}_") for name in queries.QUERIES) for n in range(1, 14)] == [1] * 13
    assert set(queries.ORACLE) <= set(queries.QUERIES)
    assert set(entry.queries()) >= {*queries.QUERIES, "pipeline"}


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_matches_oracle(spark, sf_duck, sf_small, name):
    df = queries.QUERIES[name](spark, sf_small)
    got = spark_rows(df)
    want, cols = duck_rows(sf_duck, queries.ORACLE[name])
    assert sorted(df.columns) == cols
    assert got == want and got
