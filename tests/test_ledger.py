
from decimal import Decimal

from pyspark.sql import functions as F

from pavespark import constants as K
from pavespark.plans import deliverables as D
from pavespark.plans import reports as R
from pavespark.plans.station import gps_status, station_table

DEC = Decimal("1.00")
LASER_T = ("chainage double, lon double, lat double, iri_right double, iri_left double, iri double, "
           "iri_lane decimal(8,2), rutt_right decimal(8,2), rutt_left decimal(8,2), rutting decimal(8,2), "
           "texture decimal(8,2), etd_texture decimal(8,2), file_name string")
KEY_T = ("event_str double, event_end double, event_num string, event_type string, event_name string, "
         "link_id string, section_id string, km_start string, km_end string, length string, lane_no string, "
         "survey_date string, lat_str double, lat_end double, lon_str double, lon_end double, "
         "file_name string, ramp_id string")
PIC_T = "chainage_pic double, frame_number string, file_name string"


def _laser(spark, n, lost=()):
    rows = []
    for i in range(n):
        c = 5.0 * i
        lon, lat = (0.0, 0.0) if i in lost else (100.5 + 4.6e-5 * i, 13.7 + 1.2e-5 * i)
        rows.append((c, lon, lat, 2.0, 2.0, 2.0, DEC, DEC, DEC, DEC, DEC, DEC, "r"))
    return spark.createDataFrame(rows, LASER_T)


def _key(spark, links):
    return spark.createDataFrame(
        [(s, e, "01", "pavetype.", f"link {k}", lid, "1", "12+000", "12+400", "0.400", "1",
          "2024-01-01", 13.7, 13.7, 100.5, 100.5, "r", None) for k, (s, e, lid) in enumerate(links)], KEY_T)


def _pic(spark, n):
    return spark.createDataFrame([(5.0 * i, str(i), "r") for i in range(n)], PIC_T)


def test_q23_do_not_proceed_is_labelled_but_kept(spark):
    # 12 lost grid stations (0, 25, ..., 275) in link A; link B has none
    lost = set(range(0, 60))
    laser = _laser(spark, 200, lost)
    key = _key(spark, [(0.0, 400.0, "10000000201L1CC01"), (500.0, 900.0, "10000000202L1CC01")])
    st = {r["link_id"]: r for r in gps_status(laser, _pic(spark, 200), key).collect()}
    a, b = st["10000000201L1CC01"], st["10000000202L1CC01"]
    assert a["status"] == K.STATUS_LOST and a["count"] == 12 and a["status_type"] == K.STATUS_DO_NOT_PROCEED
    assert b["status"] == K.STATUS_NOT_LOST and b["status_type"] == K.STATUS_PROCEED
    data = station_table(laser, key, _pic(spark, 200))
    assert data.where(F.col("link_id") == "10000000201L1CC01").count() == 81  # 0..400 m kept


def test_q24_bounds_differ_between_table_and_status(spark):
    # link 2.4 .. 97.6 m: the table uses rounded bounds [2, 98] -> 5..95; the status counts
    # grid stations inside [-2.6, 102.6] -> 0, 25, 50, 75, 100
    laser = _laser(spark, 30)
    key = _key(spark, [(2.4, 97.6, "10000000201L1CC01")])
    data = station_table(laser, key, _pic(spark, 30))
    assert sorted(r[0] for r in data.select("chainage").collect()) == [5.0 * i for i in range(1, 20)]
    st = gps_status(laser, _pic(spark, 30), key).first()
    assert st["count"] == 5


def test_q08_missing_measures_grid_applies_to_pictures_only(spark):
    rows = [("r", "L", 25.0, 1.0, 1.0, 1.0, None), ("r", "L", 30.0, 1.0, 1.0, 1.0, None),
            ("r", "L", 35.0, None, 1.0, 1.0, "7")]
    d = spark.createDataFrame(rows, "file_name string, link_id string, chainage double, iri double, "
                                    "rutting double, texture double, frame_number string")
    got = sorted(r["chainage"] for r in R.missing_measures(d).collect())
    assert got == [25.0, 35.0]  # 30 m lacks a picture but is not a grid station


def test_q22_image_rename_digits(spark):
    imgs = [
        # duplicated name 3 m apart -> the later one is renamed, last digit 0 -> 3
        ("s22/x/image/r-ROW-0-00100.jpg", "r-ROW-0-00100.jpg", 498.0, "L"),
        ("s22/x/image/r-ROW-0-00100.jpg", "r-ROW-0-00100.jpg", 500.0, "L"),
        # last digit 5 -> 7
        ("s22/x/image/r-ROW-0-00105.jpg", "r-ROW-0-00105.jpg", 523.0, "L"),
        ("s22/x/image/r-ROW-0-00105.jpg", "r-ROW-0-00105.jpg", 525.0, "L"),
        # other digit: kept (the reference would write NULL)
        ("s22/x/image/r-ROW-0-00101.jpg", "r-ROW-0-00101.jpg", 548.0, "L"),
        ("s22/x/image/r-ROW-0-00101.jpg", "r-ROW-0-00101.jpg", 550.0, "L"),
        # far apart (>= 25 m): not renamed
        ("s22/x/image/r-ROW-0-00200.jpg", "r-ROW-0-00200.jpg", 600.0, "L"),
        ("s22/x/image/r-ROW-0-00200.jpg", "r-ROW-0-00200.jpg", 700.0, "L"),
    ]
    df = spark.createDataFrame([(d, f, i, lk, "r", 2) for d, f, i, lk in imgs],
                               "directory string, filename string, img_id double, link_id string, "
                               "file_name string, survey_id int")
    out = {r["img_id"]: (r["filename"], r["directory"]) for r in D.repair_image_names(df).collect()}
    assert out[498.0][0] == "r-ROW-0-00100.jpg"
    assert out[500.0] == ("r-ROW-0-00103.jpg", "s22/x/image/r-ROW-0-00103.jpg")
    assert out[525.0][0] == "r-ROW-0-00107.jpg"
    assert out[550.0][0] == "r-ROW-0-00101.jpg"
    assert out[700.0][0] == "r-ROW-0-00200.jpg"


def test_q28_branch_a_only_off_grid_starts(spark):
    from pavespark.functions.measures import MEASURES
    cols = ["file_name", "link_id", "date", "ramp_id", "event_str", "event_end", "chainage",
            "lon_str", "lat_str", *MEASURES]

    def rows(link, start, stations):
        return [("r", link, "2024-01-01", None, start, start + 100.0, c, 100.5, 13.7,
                 *[Decimal(str(c / 100)).quantize(Decimal("0.01"))] * 9) for c in stations]
    data = spark.createDataFrame(
        rows("A", 500.0, [500.0, 505.0, 510.0]) + rows("B", 503.0, [505.0, 510.0, 515.0]),
        ", ".join(f"{c} {t}" for c, t in zip(cols, ["string"] * 3 + ["string"] + ["double"] * 5
                                             + ["decimal(8,2)"] * 9)))
    data = data.withColumn("date", F.col("date").cast("date"))
    got = {r["link_id"]: r for r in D.point_branch_start(data).collect()}
    assert set(got) == {"B"}                 # start 500 is on a station: no extra point
    assert got["B"]["chainage"] == 503.0 and got["B"]["iri"] == Decimal("5.05")  # station 505


def test_q16_fraction_outside_unit_interval_gives_no_fix(spark):
    from pavespark.operators.repair import gap_fixes
    # anchors only before the lost station: fraction > 1 -> no correction
    data = spark.createDataFrame(
        [("r", "L", 100.0, 100.5, 100.5, 13.7, K.STATUS_LOST), ("r", "L", 105.0, 100.6, 100.6, 13.8, K.STATUS_LOST)],
        "file_name string, link_id string, chainage double, lon double, geom_lon double, geom_lat double, status string")
    lost = spark.createDataFrame([("r", 120.0, 120.0, 120.0, 1, 5, "L", None, 0, 114.0, 126.0)],
                                 "file_name string, min double, max double, chainage double, c_p long, meter long, "
                                 "link_id string, date date, grp2 long, new_p_min double, new_p_max double")
    lost2 = lost.withColumn("new_p_min", F.lit(99.0))
    assert gap_fixes(lost, data).count() == 0   # no anchor in [114, 126]
    assert gap_fixes(lost2, data).count() == 0  # anchors 100, 105 -> fraction 4 > 1


def test_q13_global_ids_start_at_two_nulls_last(spark):
    from pavespark.operators.windows import global_row_number
    df = spark.createDataFrame([(None, "a"), (3, "b"), (1, "c"), (3, "a")], "k int, t string")
    out = {(r["k"], r["t"]): r["id"] for r in
           global_row_number(df, [F.col("k").asc_nulls_last(), F.col("t").asc_nulls_last()], "id",
                             start=2).collect()}
    assert out == {(1, "c"): 2, (3, "a"): 3, (3, "b"): 4, (None, "a"): 5}


def test_q17_frozen_gps_pairs_members_with_own_group(spark):
    from pavespark.operators.repair import frozen_fixes
    cols = ("file_name string, link_id string, chainage double, lon double, lat double, "
            "geom_lon double, geom_lat double, status string")
    rows = []
    for c in range(0, 200, 25):
        x, y = 100.5 + c * 1e-5, 13.7 + c * 1e-5
        if c in (50, 75, 100):          # frozen on one coordinate
            x, y = 100.5005, 13.7005
        rows.append(("r", "A", float(c), x, y, x, y, K.STATUS_LOST))
    d = spark.createDataFrame(rows, cols)
    fx = {r["chainage"]: (r["new_lon"], r["new_lat"]) for r in frozen_fixes(d).collect()}
    assert sorted(fx) == [50.0, 75.0, 100.0]
    # anchors at 25 and 125: points at fractions 0.25, 0.5, 0.75 between them
    a, b = (100.5 + 25e-5, 13.7 + 25e-5), (100.5 + 125e-5, 13.7 + 125e-5)
    for c, f in ((50.0, 0.25), (75.0, 0.5), (100.0, 0.75)):
        assert abs(fx[c][0] - (a[0] + f * (b[0] - a[0]))) < 1e-9
    # the same frozen coordinate on a link whose status is not lost: not repaired
    d2 = d.withColumn("status", F.lit(K.STATUS_NOT_LOST))
    assert frozen_fixes(d2).count() == 0


def test_q20_q29_grid_point_takes_next_station_and_raw_look_ahead(spark):
    from pavespark.functions.measures import MEASURES
    cols = ["file_name", "link_id", "date", "event_str", "event_end", "chainage", "ramp_id",
            "geom_lon", "geom_lat", *MEASURES]
    types = ["string", "string", "date", "double", "double", "double", "string", "double", "double"] \
        + ["decimal(8,2)"] * 9
    schema = ", ".join(f"{c} {t}" for c, t in zip(cols, types))
    import datetime
    day = datetime.date(2024, 1, 1)

    def row(link, s, e, c, v):
        return ("r", link, day, s, e, c, None, 100.5, 13.7, *[Decimal(v)] * 9)
    # link A 0..100, link B 100..200: station 100 is in both; A's grid point 100 takes the
    # next station 105 from B (smoothed value 5.00) and from the raw laser (9.00) -> mean 7.00
    data = spark.createDataFrame(
        [row("A", 0.0, 100.0, c, "1.00") for c in (95.0, 100.0)]
        + [row("B", 100.0, 200.0, c, "5.00") for c in (100.0, 105.0)], schema)
    laser = spark.createDataFrame(
        [("r", 105.0, *[9.0] * 3, *[Decimal("9.00")] * 6)],
        "file_name string, chainage double, iri_right double, iri_left double, iri double, "
        "iri_lane decimal(8,2), rutt_right decimal(8,2), rutt_left decimal(8,2), rutting decimal(8,2), "
        "texture decimal(8,2), etd_texture decimal(8,2)")
    pts = {(r["link_id"], r["chainage"]): r for r in D.point_branch_grid(data, laser).collect()}
    assert pts[("A", 100.0)]["iri"] == Decimal("7.00")
    # the next-station set is keyed by chainage only (as in the reference), so B's grid
    # point at the same chainage sees the same two rows
    assert pts[("B", 100.0)]["iri"] == Decimal("7.00")
    assert ("A", 95.0) not in pts  # not a grid station


def test_q31_gap_anchor_from_neighbouring_link(spark):
    from pavespark.operators.repair import gap_fixes
    cols = "file_name string, link_id string, chainage double, lon double, geom_lon double, geom_lat double, status string"
    d = spark.createDataFrame(
        [("r", "A", 95.0, 100.5, 100.5, 13.7, K.STATUS_LOST),      # anchor before the gap, link A
         ("r", "B", 105.0, 100.6, 100.6, 13.8, K.STATUS_LOST)],    # anchor after the gap, link B
        cols)
    lost = spark.createDataFrame([("r", 100.0, 100.0, 100.0, 1, 5, "A", None, 0, 94.0, 106.0)],
                                 "file_name string, min double, max double, chainage double, c_p long, "
                                 "meter long, link_id string, date date, grp2 long, new_p_min double, "
                                 "new_p_max double")
    fx = gap_fixes(lost, d).collect()
    assert len(fx) == 1 and abs(fx[0]["new_lon"] - 100.55) < 1e-9 and abs(fx[0]["new_lat"] - 13.75) < 1e-9


def test_gap_window_with_null_date_island(spark):
    from pavespark.operators.repair import gap_windows
    cols = "file_name string, link_id string, chainage double, lon double, geom_lon double, geom_lat double, status string"
    d = spark.createDataFrame([("r", "A", 95.0, 100.5, 100.5, 13.7, K.STATUS_LOST),
                               ("r", "A", 105.0, 100.6, 100.6, 13.8, K.STATUS_LOST)], cols)
    lost = spark.createDataFrame([("r", 100.0, 100.0, 100.0, 1, 5, "A", None, 0, 94.0, 106.0)],
                                 "file_name string, min double, max double, chainage double, c_p long, "
                                 "meter long, link_id string, date date, grp2 long, new_p_min double, "
                                 "new_p_max double")
    w = gap_windows(lost, d).collect()
    assert len(w) == 1 and w[0]["chainage_str"] == 95.0 and w[0]["chainage_end"] == 105.0


def test_snk4_snk5_paths(spark):
    img = spark.createDataFrame(
        [("s22/cu_survey/100/2024-01-01/CC10000000201/Run1/image/20240101 0001-ROW-0-00100.jpg",
          "20240101 0001-ROW-0-00100.jpg")], "directory string, filename string")
    pave = spark.createDataFrame(
        [("cu_survey/100/2024-01-01/CC10000000201/Run1/pavement0001-PAVE-0-00001.jpg/"
          "20240101 0001-PAVE-0-00001.jpg", "20240101 0001-PAVE-0-00001.jpg")],
        "directory string, filename string")
    folders = sorted(tuple(r) for r in D.image_folders(img, pave).collect())
    assert folders == [
        ("pave", "mkdir", "E:\\s22\\pave\\image\\cu_survey\\100\\2024-01-01\\CC10000000201\\Run1\\"
                          "pavement0001-PAVE-0-00001.jpg\\20240101 0001-PAVE-0-00001.jpg\\image"),
        ("row", "mkdir", "E:\\s22\\row\\image\\s22\\cu_survey\\100\\2024-01-01\\CC10000000201\\Run1\\image")]
    man = {r["kind"]: r for r in D.image_copy_manifest(img, pave).collect()}
    assert man["row"]["source"] == "E:\\20240101\\20240101\\ROW-0\\20240101 0001-ROW-0-00100.jpg"
    assert man["row"]["target"] == ("E:\\s22\\row\\image\\s22\\cu_survey\\100\\2024-01-01\\CC10000000201\\Run1"
                                    "\\image20240101 0001-ROW-0-00100.jpg")


def test_q12_duplicate_links_scope(spark):
    d = spark.createDataFrame([("r1", 0.0, 475.0, "X"), ("r2", 1000.0, 1475.0, "X"), ("r1", 0.0, 475.0, "Y")],
                              "file_name string, event_str double, event_end double, link_id string")
    assert R.duplicate_links(d).count() == 0                       # per run: no duplicate
    allruns = R.duplicate_links(d, scope="all").collect()          # across runs (multi-run form)
    assert [(r["link_id"], r["cc"]) for r in allruns] == [("X", 2)]


def test_survey_run_new_parameter(spark):
    from pavespark.plans.stages import SurveyStages
    from tests.conftest import SF_SMALL
    q = SurveyStages.from_fixtures(spark, SF_SMALL)
    s = D.survey(q.stations_final, run_new="BTS22")
    assert {r[0] for r in s.select("run_new").distinct().collect()} == {"BTS22"}


def test_rpt6_grid_only_uses_suffix_form(spark):
    from pavespark.operators.repair import event_mismatch
    ev = spark.createDataFrame(
        [(0.0, "str", "n", "L", 100.5, 13.7, "r"), (25.0, "end", "n", "L", 100.6, 13.8, "r"),
         (30.0, "end", "n", "M", 100.7, 13.9, "r")],
        "chainage double, direction string, event_name string, link_id string, lon double, lat double, "
        "file_name string")
    groups = spark.createDataFrame([("r", 100.5, 13.7, -10.0, 0.0), ("r", 100.6, 13.8, 10.0, 10.0),
                                    ("r", 100.7, 13.9, 10.0, 10.0)],
                                   "file_name string, lon double, lat double, g_min double, g_max double")
    assert sorted(r["chainage"] for r in event_mismatch(ev, groups).collect()) == [0.0, 25.0, 30.0]
    assert [r["chainage"] for r in event_mismatch(ev, groups, grid_only=True).collect()] == [25.0]
