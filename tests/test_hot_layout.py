"""The skew case: one run holds a third of all stations (FIXTURES hot layout).

Runs all stages on the sf0.01 tables with that layout and compares the
station-level and deliverable stages with the DuckDB oracle on the same layout.
The long run crosses index chunks, smoothing blocks and range-join buckets.
"""

import pytest

import __spark_entry__ as entry
from survey_oracle.fixtures import ev_cte
from tests.util import duck_rows, spark_rows

SF = "/root/testdata/sf0.01"
NAMES = ["station_table", "gps_gaps", "repair_gps_frozen", "smooth_measures", "survey",
         "survey_point_local", "repair_image_names", "survey_pave"]


@pytest.fixture(scope="module")
def duck_sf01():
    import duckdb
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM read_parquet('{SF}/events.parquet')")
    return con


@pytest.mark.parametrize("name", NAMES)
def test_hot_layout_matches_oracle(spark, duck_sf01, monkeypatch, name):
    from pavespark.plans import catalog
    uniform = catalog.stages
    monkeypatch.setattr(catalog, "stages", lambda s, d, form="run": uniform(s, d, "hot", form))
    df = entry.queries()[name](spark, SF)
    sql = entry.oracle_sql()[name].replace(ev_cte("uniform"), ev_cte("hot"))
    assert ev_cte("hot") in sql
    want, cols = duck_rows(duck_sf01, sql)
    got = spark_rows(df)
    assert sorted(df.columns) == cols
    assert got == want


def test_hot_run_really_is_hot(spark, monkeypatch):
    from pyspark.sql import functions as F
    from pavespark.sources.fixtures import load
    laser = load(spark, SF, layout="hot").laser
    counts = {r[0]: r[1] for r in laser.groupBy("file_name").count().collect()}
    top = max(counts.values())
    assert top * 3 >= sum(counts.values()) - 500
    assert laser.where(F.col("file_name") == "20240101 0001").agg(F.max("chainage")).first()[0] > 10000
