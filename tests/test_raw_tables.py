"""SRC-1..4 from the van's exported tables: names, headers, types, one scan over all runs."""

import os
import tempfile

import pytest

from pavespark.session import plan_text
from pavespark.sources import fixtures, raw
from tests.conftest import SF_SMALL


def export(root, run, table, header, rows, date="20240101", folder=None):
    before, after, _ = raw.RAW_TABLES[table]
    place = os.path.join(root, "survey_data", date, folder or f"{run}_edit_v2")
    os.makedirs(place, exist_ok=True)
    with open(os.path.join(place, f"{before}{run}{after}.csv"), "w", encoding="utf-8") as fh:
        fh.write("\n".join([header, *rows]) + "\n")


@pytest.fixture(scope="module")
def exported_root(spark):
    root = tempfile.mkdtemp(prefix="pavespark-raw-")
    raw.write_raw_tables(fixtures.raw_tables(spark, SF_SMALL), root, "20240101")
    return root


def test_extracts_equal_those_of_the_tables(spark, exported_root):
    want, got = fixtures.load(spark, SF_SMALL), raw.load_raw_folder(spark, exported_root)
    for table in ("laser", "key", "pic", "pave"):
        a, b = getattr(want, table), getattr(got, table)
        assert a.dtypes == b.dtypes
        assert sorted(map(str, a.collect())) == sorted(map(str, b.collect())) and a.count() > 10


def test_file_names_are_those_of_the_tables(exported_root):
    run = "20240101 0001"
    names = os.listdir(os.path.join(exported_root, "survey_data", "20240101", f"{run}_edit"))
    assert sorted(n for n in names if not n.startswith((".", "_"))) == sorted(
        f"{t}.csv" for t in (f"GPS_Processed_{run}", f"Profiler_IRI_{run}", f"TPL_Processed_{run}", f"Profiler_MPD_{run}",
                             f"KeyCode_Raw_{run}", f"Video_Processed_{run}_1", f"Video_Processed_{run}_2"))


def test_parquet_export(spark):
    root = tempfile.mkdtemp(prefix="pavespark-rawpq-")
    tables = fixtures.raw_tables(spark, SF_SMALL)
    raw.write_raw_tables(tables, root, "20240102", "parquet")
    got = raw.load_raw_folder(spark, root, "parquet", date="20240102")
    want = fixtures.load(spark, SF_SMALL)
    for table in ("laser", "key", "pic", "pave"):
        assert sorted(map(str, getattr(got, table).collect())) == sorted(map(str, getattr(want, table).collect()))


def test_other_columns_and_order(spark):
    """Exports hold more columns, in their own order; names in any case; quoted text."""
    root = tempfile.mkdtemp(prefix="pavespark-rawcols-")
    for run, date in (("20240101 0001", "20240101"), ("12+000 a%b", "20240102")):
        export(root, run, "gps", "ID,Latitude,ALTITUDE,CHAINAGE,LONGITUDE", ["1,13.7,5.5,0,100.5", "2,,x,5,"], date)
    got = sorted(map(tuple, raw.read_raw_table(spark, root, "gps").collect()), key=str)
    assert got == sorted([(0.0, 100.5, 13.7, "20240101 0001"), (5.0, None, None, "20240101 0001"),
                          (0.0, 100.5, 13.7, "12+000 a%b"), (5.0, None, None, "12+000 a%b")], key=str)
    one = raw.read_raw_table(spark, root, "gps", date="20240102")
    assert {r["file_name"] for r in one.collect()} == {"12+000 a%b"}
    text = plan_text(raw.read_raw_table(spark, root, "gps"), "simple")
    assert text.count("FileScan") == 1  # all runs in one scan
    assert "ALTITUDE" not in text.split("ReadSchema:")[1]


def test_both_cameras_are_told_apart(spark):
    root = tempfile.mkdtemp(prefix="pavespark-rawcam-")
    for run in ("a", "a_1", "a_2"):
        export(root, run, "video_row", "CHAINAGE,FRAME", [f"5,{run}r"])
        export(root, run, "video_pave", "CHAINAGE,FRAME,X,Y", [f"3,{run}p,100.5,13.7"])
    row, pave = (raw.read_raw_table(spark, root, t) for t in ("video_row", "video_pave"))
    assert sorted((r["file_name"], r["FRAME"]) for r in row.collect()) == [("a", "ar"), ("a_1", "a_1r"), ("a_2", "a_2r")]
    assert sorted((r["file_name"], r["FRAME"]) for r in pave.collect()) == [("a", "ap"), ("a_1", "a_1p"), ("a_2", "a_2p")]


def test_missing_column_other_header_and_bad_value_fail(spark):
    root = tempfile.mkdtemp(prefix="pavespark-rawbad-")
    export(root, "r1", "mpd", "CHAINAGE,OTHER", ["5,1"])
    with pytest.raises(ValueError, match="mpd.*LANE_MPD"):
        raw.read_raw_table(spark, root, "mpd")
    export(root, "r1", "tpl", "CHAINAGE,RUT_EDG_SE,RUT_CTR_SE,RUT_SE", ["5,1,2,3"])
    export(root, "r2", "tpl", "CHAINAGE,RUT_CTR_SE,RUT_EDG_SE,RUT_SE", ["5,1,2,3"])
    with pytest.raises(Exception, match="header does not conform"):
        raw.read_raw_table(spark, root, "tpl").collect()
    export(root, "r1", "iri", "CHAINAGE,RWP_IRI,LWP_IRI,LANE_IRI", ["5,1.5,abc,3"])
    with pytest.raises(Exception, match="MALFORMED|FAILFAST|FAILED_READ_FILE"):
        raw.read_raw_table(spark, root, "iri").collect()
    with pytest.raises(ValueError, match="fmt"):
        raw.read_raw_table(spark, root, "iri", fmt="xls")


def test_missing_measures_stay_null_and_stations_stay(spark):
    """JN-1: stations without a roughness, rutting or texture row keep nulls."""
    root = tempfile.mkdtemp(prefix="pavespark-rawnull-")
    export(root, "r1", "gps", "CHAINAGE,LONGITUDE,LATITUDE", ["0,100.5,13.7", "5,100.6,13.8"])
    export(root, "r1", "iri", "CHAINAGE,RWP_IRI,LWP_IRI,LANE_IRI", ["5,2,4,3.456"])
    export(root, "r1", "tpl", "CHAINAGE,RUT_EDG_SE,RUT_CTR_SE,RUT_SE", [])
    export(root, "r1", "mpd", "CHAINAGE,LANE_MPD", ["0,1.0"])
    export(root, "r2", "mpd", "CHAINAGE,LANE_MPD", ["5,9.0"])  # another run's row never joins
    export(root, "r1", "keycode", ",".join(f.name for f in raw.RAW_TABLES["keycode"][2].fields),
           ["0,475,01,pavetype.  ,\"link, 0\",10000000201L1CC01,1,12+000,12+475,0.475,1,2024-01-01,13.7,13.7,100.5,100.5,"])
    export(root, "r1", "video_row", "CHAINAGE,FRAME", ["5,1"])
    export(root, "r1", "video_pave", "CHAINAGE,FRAME,X,Y", ["3,1,100.5,13.7"])
    inputs = raw.load_raw_folder(spark, root)
    rows = {r["chainage"]: r for r in inputs.laser.collect()}
    assert sorted(rows) == [0.0, 5.0]
    assert rows[0.0]["iri"] is None and str(rows[0.0]["texture"]) == "1.00" and rows[0.0]["rutting"] is None
    assert rows[5.0]["iri"] == 3.0 and str(rows[5.0]["iri_lane"]) == "3.46" and rows[5.0]["texture"] is None
    key = inputs.key.first()
    assert (key["event_type"], key["event_name"], key["ramp_id"]) == ("pavetype.", "link, 0", None)


def test_cli_from_raw_tables(spark, exported_root):
    """All stages and deliverables from the exported files equal those from the loaded tables."""
    from pavespark.__main__ import main
    from pavespark.plans.stages import SurveyStages
    out = tempfile.mkdtemp(prefix="pavespark-rawcli-") + "/out"
    main(["--tables", exported_root, "--out", out, "--layout", "raw"])
    want = SurveyStages(fixtures.load(spark, SF_SMALL)).survey_point_local
    cols = ["file_name", "link_id", "chainage", "km", "iri", "lon", "lat", "survey_point_id"]
    got = spark.read.parquet(f"{out}/survey_point_local")
    assert sorted(map(str, got.select(*cols).collect())) == sorted(map(str, want.select(*cols).collect()))


def test_an_extract_exports_and_lists_its_own_tables(spark):
    """The picture index of every run needs one of the seven tables."""
    import glob
    from urllib.parse import urlparse

    from pavespark.plans import catalog
    sf_dir = tempfile.mkdtemp(prefix="pavespark-rawown-")
    spark.createDataFrame([(500 * r + i, 1.5) for r in range(3) for i in range(4)],
                          "event_id long, value double").write.parquet(f"{sf_dir}/events.parquet")
    before = set(catalog._RAW_EXPORTS)
    got = catalog.QUERIES["raw_pic_extract"](spark, sf_dir)
    assert sorted(map(tuple, got.select("file_name", "chainage_pic").collect())) == [
        (f"20240101 000{r + 1}", 5.0 * i) for r in range(3) for i in range(4)]
    (key,) = set(catalog._RAW_EXPORTS) - before
    root = urlparse(catalog._RAW_EXPORTS[key][0]).path
    names = {os.path.basename(p)[:16] for p in glob.glob(f"{root}/survey_data/*/*/*")}
    assert names == {"Video_Processed_"}
    # the other tables follow into the same folders when an extract needs them
    assert catalog.QUERIES["raw_laser_extract"](spark, sf_dir).count() == 12
    assert catalog._RAW_EXPORTS[key][1] == {"video_row", "gps", "iri", "tpl", "mpd"}


def test_header_comes_from_the_first_run_that_has_the_table(spark):
    """Names with characters of patterns are taken as they are; runs without the table are passed."""
    root = tempfile.mkdtemp(prefix="pavespark-rawfirst-")
    export(root, "a", "mpd", "CHAINAGE,LANE_MPD", ["5,1"])
    export(root, "b [1] {x}", "gps", "ID,LATITUDE,CHAINAGE,LONGITUDE", ["7,13.7,0,100.5"])
    export(root, "c", "gps", "ID,LATITUDE,CHAINAGE,LONGITUDE", ["8,13.8,5,100.6"])
    assert "GPS_Processed_b" in raw._first_place(spark, root, "gps", "csv", "*")
    got = sorted(map(tuple, raw.read_raw_table(spark, root, "gps").select("LATITUDE", "file_name").collect()))
    assert got == [(13.7, "b [1] {x}"), (13.8, "c")]
