"""SRC-5/SRC-6: header-less CSV interchange files of many runs, read in one scan."""

import os
import tempfile

import pytest

from pyspark.sql import functions as F

from pavespark.sources import exported, schemas
from pavespark.sources.fixtures import load
from tests.conftest import SF_SMALL


def test_run_folder_roundtrip(spark):
    inp = load(spark, SF_SMALL)
    root = tempfile.mkdtemp(prefix="pavespark-src-")
    laser = inp.laser
    runs = [r[0] for r in laser.select("file_name").distinct().collect()]
    for run in runs:
        part = laser.where(F.col("file_name") == run).drop("file_name")
        folder = os.path.join(root, "survey_data", "20240101", f"{run}_edit")
        out = os.path.join(folder, "access_valuelaser.csv")
        exported.write_interchange_csv(part.coalesce(1), out)
    no_run = [f.name for f in schemas.LASER_CSV.fields if f.name != "file_name"]
    df = exported.read_run_folder(spark, root, "access_valuelaser", schemas.LASER_CSV)
    got = exported.loaded_laser(df)
    assert sorted(r[0] for r in got.select("file_name").distinct().collect()) == sorted(runs)
    a = sorted(tuple(r) for r in got.select("file_name", *no_run).collect())
    b = sorted(tuple(r) for r in laser.select("file_name", *no_run).collect())
    assert a == b


def test_read_loaded_csv_empty_is_null(spark):
    root = tempfile.mkdtemp(prefix="pavespark-csv-")
    path = os.path.join(root, "pic.csv")
    with open(path, "w") as fh:
        fh.write("5.0,1,run a\n10.0,,run a\n")
    df = exported.read_loaded_csv(spark, path, schemas.PIC_CSV)
    rows = sorted(tuple(r) for r in df.collect())
    assert rows == [(5.0, "1", "run a"), (10.0, None, "run a")]


def test_write_stage_partitioned_by_run(spark):
    inp = load(spark, SF_SMALL)
    out = os.path.join(tempfile.mkdtemp(prefix="pavespark-stage-"), "laser")
    exported.write_stage(inp.laser, out)
    runs = sorted(d for d in os.listdir(out) if d.startswith("file_name="))
    assert len(runs) == 2
    back = spark.read.parquet(out)
    assert back.count() == inp.laser.count()
    # partition pruning: one run's folder only
    one = back.where(F.col("file_name") == "20240101 0001")
    from pavespark.session import plan_text
    assert "PartitionFilters: [isnotnull(file_name" in plan_text(one, "simple")
    assert one.count() == 500


def test_partitioned_csv_keeps_numeric_run_names_as_text(spark):
    from pavespark.sources.schemas import PIC_CSV
    path = os.path.join(tempfile.mkdtemp(prefix="pavespark-part-"), "pic")
    df = spark.createDataFrame([(5.0, "1", "20240101"), (10.0, None, "20240102")], PIC_CSV)
    exported.write_run_partitioned_csv(df, path)
    back = exported.read_run_partitioned_csv(spark, path, PIC_CSV)
    assert dict(back.dtypes)["file_name"] == "string"
    assert sorted(tuple(r) for r in back.collect()) == [(5.0, "1", "20240101"), (10.0, None, "20240102")]


def test_run_folder_names_keep_plus_and_blank(spark):
    root = tempfile.mkdtemp(prefix="pavespark-names-")
    for run in ("12+000 a", "b"):
        folder = os.path.join(root, "survey_data", "20240101", f"{run}_edit")
        os.makedirs(folder)
        with open(os.path.join(folder, "access_pic.csv"), "w") as fh:
            fh.write("5.0,1\n")
    df = exported.read_run_folder(spark, root, "access_pic", schemas.PIC_CSV)
    assert sorted(r[0] for r in df.select("file_name").collect()) == ["12+000 a", "b"]


def test_tables_roundtrip_and_deliverables(spark):
    """Loaded tables written as run-partitioned CSV, read back, give the same survey points;
    the deliverables are written as Parquet partitioned by run."""
    from pavespark.plans.stages import SurveyStages
    base = tempfile.mkdtemp(prefix="pavespark-cli-")
    inp = load(spark, SF_SMALL)
    exported.write_tables(inp, f"{base}/tables")
    back = exported.load_tables(spark, f"{base}/tables")
    a = SurveyStages(inp).survey_point_local
    b = SurveyStages(back).survey_point_local
    cols = ["file_name", "link_id", "chainage", "km", "iri", "lon", "lat", "survey_point_id"]
    assert sorted(tuple(r) for r in a.select(*cols).collect()) == \
        sorted(tuple(r) for r in b.select(*cols).collect())
    written = SurveyStages(back).write_deliverables(f"{base}/out")
    assert "survey_point" in written
    sp = spark.read.parquet(f"{base}/out/survey_point")
    assert sp.count() == a.count()
    assert spark.read.parquet(f"{base}/out/survey").where(F.size("the_geom") > 1).count() > 0


def test_run_folder_process_layout(spark):
    root = tempfile.mkdtemp(prefix="pavespark-proc-")
    for run in ("20240101 0001", "20240101 0002"):
        folder = os.path.join(root, "survey_data", "20240101", "process", run)
        os.makedirs(folder)
        with open(os.path.join(folder, "access_pic.csv"), "w") as fh:
            fh.write(f"5.0,1,{run}\n10.0,2,{run}\n")
        with open(os.path.join(folder, "access_key.csv"), "w") as fh:
            fh.write(f"0,475,01,pavetype.,link 0,1L1,1,12+000,12+475,0.475,1,2024-01-01,13.7,13.7,"
                     f"100.5,100.5,{run},RP9\n")
    key = exported.read_run_folder(spark, root, "access_key", schemas.KEY_CSV, layout="process")
    assert sorted((r["file_name"], r["ramp_id"]) for r in key.collect()) == [
        ("20240101 0001", "RP9"), ("20240101 0002", "RP9")]
    df = exported.read_run_folder(spark, root, "access_pic", schemas.PIC_CSV, layout="process")
    got = sorted((r["file_name"], r["chainage_pic"]) for r in df.collect())
    assert got == [("20240101 0001", 5.0), ("20240101 0001", 10.0),
                   ("20240101 0002", 5.0), ("20240101 0002", 10.0)]


def test_run_folder_run_layout_key_and_bad_values(spark):
    root = tempfile.mkdtemp(prefix="pavespark-run-")
    folder = os.path.join(root, "survey_data", "20240101", "r1_edit")
    os.makedirs(folder)
    row = "{},475,01,pavetype.,link 0,1L1,1,12+000,12+475,0.475,1,2024-01-01,13.7,13.7,100.5,100.5,RP9\n"
    with open(os.path.join(folder, "access_key.csv"), "w") as fh:
        fh.write(row.format(0))
    key = exported.read_run_folder(spark, root, "access_key", schemas.KEY_CSV).first()
    assert (key["file_name"], key["ramp_id"], key["event_str"]) == ("r1", "RP9", 0.0)
    with open(os.path.join(folder, "access_key.csv"), "w") as fh:
        fh.write(row.format("abc"))
    with pytest.raises(Exception, match="MALFORMED_RECORD|FAILED_READ_FILE|FAILFAST"):
        exported.read_run_folder(spark, root, "access_key", schemas.KEY_CSV).collect()


def test_run_and_link_names_keep_all_digits(spark):
    """Runs from 10,000 on must not share a name with shorter-numbered ones."""
    from pavespark.sources.fixtures import LINK_ID_K, padded
    runs = spark.createDataFrame([(r,) for r in (0, 999, 9999, 10000, 100009)], "q long")
    names = [x[0] for x in runs.selectExpr(padded("q + 1", 4)).collect()]
    assert names == ["0001", "1000", "10000", "10001", "100010"]
    links = {x[0] for x in runs.selectExpr(LINK_ID_K.format(k="1")).collect()}
    assert len(links) == 5


def test_load_tables_trims_char_padding(spark):
    """Loaded text comes from char(n) columns: trailing blanks are removed once on load."""
    base = tempfile.mkdtemp(prefix="pavespark-pad-")
    key = os.path.join(base, "access_key", "file_name=r1")
    os.makedirs(key)
    with open(os.path.join(key, "part-0.csv"), "w") as fh:
        fh.write("0,475,01,pavetype.           ,link 0   ,10000000201L1CC01   ,1,12+000,12+475,0.475,"
                 "1,2024-01-01,13.7,13.7,100.5,100.5,\n")
    for name in ("access_valuelaser", "access_pic", "access_distress_pic"):
        os.makedirs(os.path.join(base, name, "file_name=r1"))
        open(os.path.join(base, name, "file_name=r1", "part-0.csv"), "w").close()
    inp = exported.load_tables(spark, base)
    r = inp.key.first()
    assert (r["event_type"], r["event_name"], r["link_id"], r["file_name"]) == \
        ("pavetype.", "link 0", "10000000201L1CC01", "r1")
    assert r["ramp_id"] is None and dict(inp.key.dtypes)["event_str"] == "double"


def test_cli_main(spark, capsys):
    from pavespark.__main__ import main
    base = tempfile.mkdtemp(prefix="pavespark-main-")
    exported.write_tables(load(spark, SF_SMALL), f"{base}/tables")
    main(["--tables", f"{base}/tables", "--out", f"{base}/out"])
    out = capsys.readouterr().out
    for table in ("station_table", "survey", "survey_point", "survey_image", "pave_table", "survey_pave"):
        assert f"/out/{table}\n" in out
        assert spark.read.parquet(f"{base}/out/{table}").count() > 0


def test_each_run_is_written_by_one_task(spark):
    """Rows of many runs lie in every partition; a run's folder still gets one file, not one
    from each of them."""
    from pavespark.sources.schemas import PIC_CSV
    path = os.path.join(tempfile.mkdtemp(prefix="pavespark-part-"), "pic")
    want = [(5.0 * i, str(i), f"run {r}") for i in range(40) for r in range(3)]
    df = spark.createDataFrame(want, PIC_CSV).repartition(8)
    exported.write_run_partitioned_csv(df, path)
    for r in range(3):
        files = [n for n in os.listdir(os.path.join(path, f"file_name=run {r}")) if n.endswith(".csv")]
        assert len(files) == 1
    back = exported.read_run_partitioned_csv(spark, path, PIC_CSV)
    assert sorted(tuple(r) for r in back.collect()) == sorted(want)


def test_stations_are_not_broadcast_by_a_guess_of_their_size(spark):
    """The tables joined to stations grow with them: no join of theirs passes through the driver,
    also where a session lets small files be broadcast."""
    from pavespark.session import plan_text
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, str(10 << 20))
    try:
        assert "Broadcast" not in plan_text(load(spark, SF_SMALL).laser, "simple")
    finally:
        spark.conf.set(key, before)
