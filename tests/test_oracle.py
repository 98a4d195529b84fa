"""Every survey query equals its DuckDB oracle on the sf0.001 inputs."""

import pytest

import __spark_entry__ as entry
from pavespark.plans.catalog import QUERIES
from survey_oracle.catalog import ORACLE
from tests.conftest import SF_SMALL
from tests.util import duck_rows, spark_rows


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert len(QUERIES) >= 52


def test_entry_registers_every_survey_query():
    assert set(entry.queries()) >= set(QUERIES)
    assert set(entry.oracle_sql()) >= set(ORACLE)
    assert all(entry.oracle_sql()[name] == ORACLE[name] for name in ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF_SMALL)
    got = spark_rows(df)
    want, cols = duck_rows(duck, ORACLE[name])
    assert sorted(df.columns) == cols
    assert len(got) == len(want)
    assert got == want


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "survey_point_id" in df.columns


@pytest.mark.parametrize("name", ["survey", "survey_point_local", "repair_image_names", "gps_gaps",
                                  "smooth_measures"])
def test_queries_are_stable(spark, name):
    """Same schema on every call, same rows on every evaluation (ids included)."""
    a = QUERIES[name](spark, SF_SMALL)
    b = QUERIES[name](spark, SF_SMALL)
    assert a.schema == b.schema
    assert spark_rows(a) == spark_rows(a) == spark_rows(b)
