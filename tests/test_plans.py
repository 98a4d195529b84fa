"""Physical plans: no nested-loop or cartesian joins and no single-partition
exchange on station data; scans read only the needed columns."""

import pytest
from pyspark.sql import functions as F

from pavespark.operators.repair import keyed_stations
from pavespark.plans import deliverables as D
from pavespark.plans.stages import SurveyStages
from pavespark.plans.station import station_table
from tests.conftest import SF_SMALL

BAD = ("BroadcastNestedLoopJoin", "CartesianProduct")


def plan(df):
    from pavespark.session import plan_text
    return plan_text(df, "simple")


@pytest.fixture(scope="module")
def p(spark):
    return SurveyStages.from_fixtures(spark, SF_SMALL, checkpoint=True)


def test_station_table_plan(p):
    df = station_table(p.inputs.laser, p.inputs.key, p.inputs.pic)
    s = plan(df)
    for b in BAD:
        assert b not in s
    assert "SinglePartition" not in s
    # the events scan reads two columns only
    from pavespark.session import plan_text
    assert "ReadSchema: struct<event_id:bigint,value:double>" in plan_text(df)


def test_repair_and_smoothing_plans(p):
    from pavespark.operators.repair import repair_gps_frozen, repair_gps_gaps
    from pavespark.operators.smoothing import smooth_measures
    for df in (repair_gps_gaps(p.events_fixed, p.gps_lost), repair_gps_frozen(p.gaps_filled),
               smooth_measures(p.unfrozen), keyed_stations(p.laser, p.key)):
        s = plan(df)
        for b in BAD:
            assert b not in s
        assert "SinglePartition" not in s


def test_deliverable_plans(p):
    for df in (D.survey_point_local(p.stations_final, p.laser, p.survey),
               D.pave_table(p.stations_final, p.pave, p.survey),
               D.repair_image_names(p.survey_image)):
        s = plan(df)
        for b in BAD:
            assert b not in s


def test_runs_are_independent(spark, p):
    """The all-runs result restricted to one run equals that run processed alone."""
    from pyspark.sql import functions as F
    from pavespark.sources.fixtures import Inputs
    run = "20240101 0002"
    one = Inputs(*(t.where(F.col("file_name") == run) for t in
                   (p.inputs.laser, p.inputs.key, p.inputs.pic, p.inputs.pave)))
    q = SurveyStages(one)
    cols = ["file_name", "link_id", "event_str", "chainage", "lon", "lat", "iri", "rutting", "texture"]
    a = sorted(tuple(r) for r in q.stations_final.select(*cols).collect())
    b = sorted(tuple(r) for r in p.stations_final.where(F.col("file_name") == run).select(*cols).collect())
    assert a == b and len(a) > 0
    sc = ["link_id", "km_start", "km_end", "length", "distance_gps", "chainage_str", "chainage_end"]
    a = sorted(tuple(r) for r in q.survey.select(*sc).collect())
    b = sorted(tuple(r) for r in p.survey.where(F.col("file_name") == run).select(*sc).collect())
    assert a == b


def test_repairs_touch_only_targets(p):
    from pyspark.sql import functions as F
    before = p.events_fixed.select("file_name", "link_id", "chainage", F.col("geom_lon").alias("a"),
                                   "status")
    after = p.gaps_filled.select("file_name", "link_id", "chainage", F.col("geom_lon").alias("b"))
    j = before.join(after, ["file_name", "link_id", "chainage"])
    changed = j.where(~F.col("a").eqNullSafe(F.col("b")))
    assert changed.count() > 0
    # only stations that had lost GPS on lost-status links were filled
    assert changed.where((F.col("a") != 0) | (F.col("status") != "มีGPSlost")).count() == 0


def test_pave_gap_window_mode(p):
    from pyspark.sql import functions as F
    ref = D.repair_pave_gaps(p.pave_table, p.pave_gps_lost, p.survey)
    win = D.repair_pave_gaps(p.pave_table, p.pave_gps_lost, p.survey, mode="window")
    lost = p.pave_table.where((F.col("lon") == 0) | (F.col("lat") == 0)).count()
    assert lost > 0
    for df in (ref, win):
        assert df.count() == p.pave_table.count()
        left = df.where(F.col("chainage_pic").isNotNull() & ((F.col("lon") == 0) | (F.col("lat") == 0)))
        assert left.count() < lost


def test_pave_image_beyond_last_station_is_kept(spark):
    """Pavement joins clip intervals to the images' own extent, not the stations'."""
    from decimal import Decimal

    from pavespark.sources import schemas as S
    from pavespark.sources.fixtures import Inputs
    run = "r1"
    d = Decimal("1.00")
    laser = spark.createDataFrame(
        [(float(c), 100.5 + c * 1e-5, 13.7 + c * 1e-5, 2.0, 2.0, 2.0, d, d, d, d, d, d, run)
         for c in range(0, 105, 5)],
        "chainage double, lon double, lat double, iri_right double, iri_left double, iri double, "
        "iri_lane decimal(8,2), rutt_right decimal(8,2), rutt_left decimal(8,2), rutting decimal(8,2), "
        "texture decimal(8,2), etd_texture decimal(8,2), file_name string")
    key = spark.createDataFrame(
        [(0.0, 400.0, "01", "pavetype.", "link 0", "10000000201L1CC01", "1", "12+000", "12+400", "0.400",
          "1", "2024-01-01", 13.7, 13.704, 100.5, 100.504, run, None)],
        S.KEY_CSV).select(*[f.name for f in S.KEY_CSV.fields])
    key = key.select(*[F.col(f.name).cast("double").alias(f.name) if f.dataType.simpleString() == "float"
                       else F.col(f.name) for f in S.KEY_CSV.fields])
    pic = spark.createDataFrame([(float(c), str(c), run) for c in range(0, 105, 5)],
                                "chainage_pic double, frame_number string, file_name string")
    pave = spark.createDataFrame([(300.0, "100", 100.503, 13.703, run), (30.0, "10", 100.5003, 13.7003, run)],
                                 "chainage_pic double, frame_number string, lon double, lat double, file_name string")
    q = SurveyStages(Inputs(laser, key, pic, pave))
    got = sorted(r[0] for r in q.pave_table.select("chainage_pic").collect())
    assert got == [30, 300]


def test_ids_unique_and_start_at_two(p):
    s = p.survey.select("survey_id")
    assert s.distinct().count() == s.count()
    assert s.agg(F.min("survey_id")).first()[0] == 2
    sp = p.survey_point_local.select("survey_point_id")
    assert sp.distinct().count() == sp.count()
    assert sp.agg(F.min("survey_point_id")).first()[0] == 2


def test_filled_points_inside_anchor_box(p):
    from pavespark.operators.repair import gap_windows
    w = gap_windows(p.gps_lost, p.events_fixed)
    box = (w.select("file_name", "link_id", "date", "gps_lost_ch",
                    F.expr("aggregate(line, 1e9d, (a, x) -> least(a, x.lon))").alias("x0"),
                    F.expr("aggregate(line, -1e9d, (a, x) -> greatest(a, x.lon))").alias("x1"),
                    F.expr("aggregate(line, 1e9d, (a, x) -> least(a, x.lat))").alias("y0"),
                    F.expr("aggregate(line, -1e9d, (a, x) -> greatest(a, x.lat))").alias("y1")))
    filled = (p.gaps_filled.join(p.events_fixed.select("file_name", "link_id", "date", "chainage",
                                                       F.col("geom_lon").alias("old")),
                                 ["file_name", "link_id", "date", "chainage"])
              .where(F.col("old") != F.col("geom_lon")))
    j = filled.join(box, (filled.file_name == box.file_name) & (filled.link_id == box.link_id)
                    & (filled.date == box.date) & (filled.chainage == box.gps_lost_ch))
    assert j.count() == filled.count() > 0
    eps = 1e-12
    outside = j.where((F.col("geom_lon") < F.col("x0") - eps) | (F.col("geom_lon") > F.col("x1") + eps)
                      | (F.col("geom_lat") < F.col("y0") - eps) | (F.col("geom_lat") > F.col("y1") + eps))
    assert outside.count() == 0


def test_islands_partition_lost_rows(p):
    from pavespark import constants as K
    from pavespark.functions import predicates as P
    from pavespark.operators.linear import lost_islands
    d = p.station_table
    isl = lost_islands(d, "chainage", SurveyStages.STATION_TIES, K.STATION_SPACING_M)
    lost = d.where(P.gps_lost()).count()
    assert isl.agg(F.sum("c_p")).first()[0] == lost
    assert isl.where(F.col("meter") != F.col("c_p") * 5).count() == 0


def test_every_stage_plan_is_distributed(spark):
    """All stage tables: no nested-loop or cartesian join, no Python
    evaluation; a single-partition exchange only on the small count table of a
    global numbering."""
    import bench
    q = SurveyStages.from_fixtures(spark, SF_SMALL, record_plans=True)
    for _, get in bench.STAGES:
        get(q)
    assert len(q.plans) >= 16
    singles = 0
    for plan_text in q.plans:
        for bad in BAD + ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas"):
            assert bad not in plan_text
        # a single-partition exchange only feeds on the count table of a global
        # numbering: one row per range partition (aggregate keyed by partition id)
        import re
        good = [m for m in re.finditer(
            r"Exchange SinglePartition[^\n]*\n\s*\+- HashAggregate\(keys=\[_pid#", plan_text)]
        assert plan_text.count("Exchange SinglePartition") == len(good)
        singles += len(good)
    assert singles > 0  # the global numberings (survey_id, survey_point_id) were checked


def test_pave_link_with_null_date_gets_no_empty_row(spark):
    from pavespark.plans import deliverables as Dl
    ev = spark.createDataFrame(
        [(0.0, 400.0, "link 0", "L", None, 13.7, 13.7, 100.5, 100.5, "r")],
        "event_str double, event_end double, event_name string, link_id string, date date, "
        "lat_str double, lat_end double, lon_str double, lon_end double, file_name string")
    pave = spark.createDataFrame([(30.0, "10", 100.5003, 13.7003, "r"), (60.0, "20", 100.5006, 13.7006, "r")],
                                 "chainage_pic double, frame_number string, lon double, lat double, file_name string")
    survey = spark.createDataFrame([], "file_name string, link_id string, date date, survey_id long, "
                                       "lane_group int, lane_no int, km_start int, km_end int, "
                                       "run_code string, survey_code string")
    out = Dl.pave_table(ev, pave, survey)
    assert sorted(r[0] for r in out.select("chainage_pic").collect()) == [30, 60]


def _exchanged(df):
    """Columns of each exchange of a plan that deals rows (not counts or edges) out."""
    import re

    from pavespark.session import plan_text
    text = plan_text(df, "formatted")
    return re.findall(r"\) Exchange\nInput \[\d+\]: \[(.*)\]", text)


def test_smoothing_shuffles_the_stations_once(p):
    from pavespark.operators.smoothing import smooth_measures
    moved = _exchanged(smooth_measures(p.unfrozen))
    assert sum("geom_lon#" in columns for columns in moved) == 1


def test_islands_shuffle_the_stations_once(p):
    from pavespark import constants as K
    from pavespark.operators.linear import lost_islands
    moved = _exchanged(lost_islands(p.station_table, "chainage", SurveyStages.STATION_TIES, K.STATION_SPACING_M))
    # later ones carry lost rows with their number, or counts
    assert sum("frame_number#" in columns and "_n1#" not in columns for columns in moved) == 1


def test_growing_tables_are_not_broadcast_by_a_guess_of_their_size(spark):
    """Joins of tables that grow with the stations shuffle both sides in a session that lets
    files below 10 MB be broadcast: compressed, they can hold millions of rows."""
    import tempfile

    from pavespark.operators.joins import near_join, range_join
    from pavespark.operators.repair import apply_corrections
    from pavespark.operators.windows import null_safe_join, ordered_index
    from pavespark.session import plan_text
    folder = tempfile.mkdtemp(prefix="pavespark-join-")
    for name in ("a", "b"):
        spark.range(50).selectExpr("cast(id % 3 as string) file_name", f"cast(id as double) {name}").write.parquet(f"{folder}/{name}")
    a, b = (spark.read.parquet(f"{folder}/{name}") for name in ("a", "b"))
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, str(10 << 20))
    try:
        for joined in (range_join(a, b, "a", F.col("b") - 1, F.col("b") + 1),
                       near_join(a, b, 0.5, ["file_name"], "a", "a", "b", "b"),
                       null_safe_join(a, b, ["file_name"]),
                       apply_corrections(a, b, {"file_name": "file_name", "a": "b"}, {"a": lambda g: g("b") + 1}),
                       ordered_index(a, ["file_name"], ["a"], chunk=F.floor(F.col("a") / 10))):
            assert "Broadcast" not in plan_text(joined, "simple")
            assert joined.count() >= 50
    finally:
        spark.conf.set(key, before)


def test_status_joins_the_links_before_they_meet_the_stations(p):
    moved = _exchanged(station_table(p.laser, p.key, p.pic))
    assert any("iri_left#" in columns for columns in moved)
    assert not any("iri_left#" in columns and "km_start#" in columns for columns in moved)


def test_repairs_shuffle_grid_stations_only(p):
    from pavespark.operators.repair import repair_gps_frozen, repair_gps_gaps
    for df in (repair_gps_gaps(p.events_fixed, p.gps_lost), repair_gps_frozen(p.gaps_filled)):
        assert "Union" in plan(df)  # the other stations stay where they are
        assert sum("texture#" in columns for columns in _exchanged(df)) == 1


def test_corrections_among_some_rows_are_those_among_all(spark):
    from pavespark.operators.repair import apply_corrections
    data = spark.createDataFrame([("r", 25.0, 1), ("r", 25.0, 2), ("r", 27.0, 3), ("r", None, 4), (None, 50.0, 5),
                                  ("r", 50.0, 6)], "file_name string, chainage double, v int")
    fixes = spark.createDataFrame([("r", 25.0, 9), ("r", 50.0, None), ("r", None, 7)], "file_name string, at double, new int")

    def rows(**among):
        found = apply_corrections(data, fixes, {"file_name": "file_name", "chainage": "at"}, {"v": lambda g: g("new")}, **among)
        return sorted(map(str, found.collect()))

    assert rows(among=F.col("chainage") % 25 == 0) == rows()
    assert len(rows()) == 6


def test_point_grid_looks_only_at_stations_after_the_grid(p):
    s = plan(D.point_branch_grid(p.stations_final, p.laser))
    assert "- 5.0) % 25" in s


def test_smoothing_shuffles_stations_without_the_summed_values(p):
    from pavespark.operators.smoothing import smooth_measures
    moved = [columns for columns in _exchanged(smooth_measures(p.unfrozen)) if "geom_lon#" in columns]
    assert len(moved) == 1 and "_s_iri_left#" not in moved[0]


def test_repaired_links_meet_their_stations_by_one_hash(spark):
    from pavespark.operators.repair import LINK_COORDS, attach_link_coords, link_table
    rows = [("r", "L", None, 1.0, 2.0, 3.0, 4.0, c) for c in (0, 5)] + [("r", None, "x", 1.0, 2.0, 3.0, 4.0, 10)]
    data = spark.createDataFrame(rows, "file_name string, link_id string, date string, lat_str double, "
                                       "lat_end double, lon_str double, lon_end double, c int")
    links = link_table(data, ["link_id", *LINK_COORDS]).withColumn(
        "lat_str", F.when(F.col("date").isNull(), 9.0).otherwise(F.col("lat_str")))
    found = attach_link_coords(data, links)
    assert "xxhash64" in plan(found)
    assert sorted((r["c"], r["lat_str"]) for r in found.collect()) == [(0, 9.0), (5, 9.0), (10, 1.0)]
