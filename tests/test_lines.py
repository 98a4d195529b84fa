"""Segment table: the same points as the fold along the line, without arrays on target rows."""

import re

import pytest
from pyspark.sql import functions as F

from pavespark.operators.geometry import add_point_at
from pavespark.operators.lines import line_segments, points_on_lines
from pavespark.session import plan_text, written
from tests.conftest import SF_SMALL

LINE = "array<struct<chainage:double, lon:double, lat:double>>"


@pytest.fixture(scope="module")
def lines(spark):
    import random
    rng = random.Random(5)
    rows = [(1, None, []), (2, "a", [(0.0, 100.5, 13.7)]), (3, "a", [(0.0, 1.0, 1.0)] * 4), (None, None, [(0.0, 0.0, 0.0), (1.0, 1.0, 2.0)])]
    for k in range(10, 30):
        x = y = 0.0
        pts = []
        for i in range(rng.randrange(2, 60)):
            if rng.random() < 0.8:  # else a segment without length
                x, y = x + rng.random(), y + rng.random()
            pts.append((float(i), x, y))
        rows.append((k, rng.choice(["a", "b", None]), pts))
    return spark.createDataFrame(rows, f"id int, k string, line {LINE}")


def targets_of(spark, lines):
    """Fractions inside, at both ends, beyond them, missing, and exactly at segment ends."""
    plain = lines.select("id", "k").crossJoin(spark.createDataFrame(
        [(x,) for x in (0.0, 1.0, 0.5, 1e-12, 1 - 1e-12, 0.37, 0.37, -0.5, 1.5, None)], "f double"))
    ends = line_segments(lines, ["id", "k"], "line").select("id", "k", F.col("hi").alias("f"))
    return plain.unionByName(ends)


def test_equals_the_fold(spark, lines):
    t = targets_of(spark, lines)
    got = points_on_lines(t, lines, ["id", "k"], "f", line="line").select("id", "k", "f", "pt.*")
    joined = t.join(lines.withColumnsRenamed({"id": "i2", "k": "k2"}),
                    F.col("id").eqNullSafe(F.col("i2")) & F.col("k").eqNullSafe(F.col("k2")))
    want = add_point_at(joined, "line", "f", "pt").select("id", "k", "f", "pt.*")
    assert got.count() == t.count()
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))  # to the last bit


def test_chunks_and_parts(spark, lines):
    """Cut into many chunks and parts, the points are the same up to rounding."""
    t = targets_of(spark, lines).where("f BETWEEN 0 AND 1").withColumn("n", F.monotonically_increasing_id()).cache()
    one = points_on_lines(t, lines, ["id", "k"], "f", line="line")
    many = points_on_lines(t, lines, ["id", "k"], "f", line="line", chunk=4)
    a = {r["n"]: r["pt"] for r in one.collect()}
    b = {r["n"]: r["pt"] for r in many.collect()}
    assert a.keys() == b.keys()
    for n in a:
        if a[n]["lon"] is None:
            assert b[n]["lon"] is None
        else:
            assert b[n]["lon"] == pytest.approx(a[n]["lon"], abs=1e-9)
            assert b[n]["lat"] == pytest.approx(a[n]["lat"], abs=1e-9)


def test_empty_tables_and_targets_without_a_line(spark, lines):
    t = spark.createDataFrame([(999, "a", 0.5)], "id int, k string, f double")
    assert points_on_lines(t, lines, ["id", "k"], "f", line="line").collect() == []
    assert points_on_lines(t, lines.limit(0), ["id", "k"], "f", line="line").collect() == []
    assert points_on_lines(t.limit(0), lines, ["id", "k"], "f", line="line").collect() == []


def test_long_line_with_many_targets(spark):
    """One line of 60,000 points and 60,000 targets: linear work (a product would be 3.6e9)."""
    n = 60_000
    line = written(spark.range(1).select(F.lit(1).alias("id"), F.transform(F.sequence(F.lit(0), F.lit(n)), lambda i: F.struct(
        i.cast("double").alias("chainage"), i.cast("double").alias("lon"), F.lit(0.0).alias("lat"))).alias("line")))
    t = spark.range(n).select(F.lit(1).alias("id"), ((F.col("id") + 0.5) / n).alias("f"))
    got = points_on_lines(t, line, ["id"], "f", line="line")
    wrong = got.where(F.abs(F.col("pt.lon") - F.col("f") * n) > 1e-6)
    assert got.count() == n and wrong.count() == 0


def test_no_line_array_travels_with_target_rows(spark):
    """No exchange of the pavement repairs holds a line's array: lines are exploded first."""
    from pavespark.plans import deliverables as D
    from pavespark.plans.catalog import stages
    p = stages(spark, SF_SMALL)
    for df in (D.repair_pave_gaps(p.pave_table, p.pave_gps_lost, p.survey, extent=p.pave_extent),
               D.repair_pave_gaps(p.pave_table, p.pave_gps_lost, p.survey, extent=p.pave_extent, mode="window"),
               D.repair_pave_frozen(p.pave_gaps_filled, p.survey)):
        text = plan_text(df, "formatted")
        moved = re.findall(r"\) (?:Broadcast)?Exchange\nInput \[\d+\]: \[(.*)\]", text)
        assert len(moved) > 5
        assert not any(re.search(r"\b(the_geom|line)#", columns) for columns in moved)
        assert "NestedLoop" not in text and "Cartesian" not in text
