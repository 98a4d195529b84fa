"""Stage lifecycle: manifest, resuming a stopped run, clearing, counts taken while writing."""

import os
import tempfile

import pytest

from pavespark.functions import predicates as P
from pavespark.plans import deliverables as D
from pavespark.plans import reports as R
from pavespark.plans.lifecycle import StageStore, files_fingerprint
from pavespark.plans.stages import SurveyStages
from pavespark.session import ensure_checkpoint_dir
from pavespark.sources import exported, fixtures
from tests.conftest import SF_SMALL

COLS = ["file_name", "link_id", "chainage", "km", "iri", "lon", "lat", "survey_point_id"]


def tables_in(folder, part="stages"):
    place = os.path.join(folder, part)
    return sorted(n.split("-")[0] for n in os.listdir(place) if not n.startswith(".")) if os.path.isdir(place) else []


def scratch_tables(spark):
    place = ensure_checkpoint_dir(spark).removeprefix("file:")
    return {n for n in os.listdir(place) if n.startswith("stage-")}


@pytest.fixture(scope="module")
def inputs(spark):
    return fixtures.load(spark, SF_SMALL)


def test_stopped_run_goes_on_after_its_last_stage(spark, inputs, monkeypatch):
    folder = tempfile.mkdtemp(prefix="pavespark-work-")
    before = scratch_tables(spark)

    class Stopped(Exception):
        pass

    def stop(*args, **kw):
        raise Stopped

    with monkeypatch.context() as m:
        m.setattr(D, "survey_point_local", stop)
        with pytest.raises(Stopped):
            SurveyStages(inputs, store=StageStore(spark, folder, "x")).survey_point_local
    done = tables_in(folder)
    assert len(done) > 8 and {"station_table", "gaps_filled", "stations_final", "survey"} <= set(done)
    assert tables_in(folder, "manifest") == done
    os.makedirs(os.path.join(folder, "stages", "survey_image-half"))  # a table that was being written

    store = StageStore(spark, folder, "x")
    assert tables_in(folder) == done  # the half-written one is gone
    built = []
    monkeypatch.setattr(store, "_write", lambda name, *a, w=store._write: built.append(name) or w(name, *a))
    stages = SurveyStages(inputs, store=store)
    got = stages.survey_point_local
    assert built == ["survey_point_local"] and "survey" in store.resumed
    want = SurveyStages(inputs).survey_point_local
    assert sorted(map(str, got.select(*COLS).collect())) == sorted(map(str, want.select(*COLS).collect()))
    store.drop("gaps_filled")
    assert "gaps_filled" not in tables_in(folder) + tables_in(folder, "manifest")
    store.clear()
    assert tables_in(folder) == tables_in(folder, "manifest") == []


def test_scratch_tables_of_a_stage_are_removed(spark, inputs):
    folder = tempfile.mkdtemp(prefix="pavespark-work-")
    before = scratch_tables(spark)
    SurveyStages(inputs, store=StageStore(spark, folder)).survey_point_local
    assert scratch_tables(spark) == before


def test_other_inputs_are_not_read(spark):
    folder = tempfile.mkdtemp(prefix="pavespark-work-")
    first = StageStore(spark, folder, "a")
    assert first.stage("t", lambda: spark.range(3)).count() == 3
    same = StageStore(spark, folder, "a")
    assert same.stage("t", lambda: spark.range(9)).count() == 3 and same.resumed == ["t"]
    other = StageStore(spark, folder, "b")
    assert tables_in(folder) == [] and other.stage("t", lambda: spark.range(4)).count() == 4
    assert tables_in(folder) == ["t"] and other.resumed == []


def test_empty_stage_keeps_its_types(spark):
    folder = tempfile.mkdtemp(prefix="pavespark-work-")
    empty = spark.createDataFrame([], "a decimal(8,2), b array<struct<x:double>>")
    StageStore(spark, folder).stage("e", lambda: empty)
    back = StageStore(spark, folder)
    assert back.stage("e", lambda: spark.range(1)).dtypes == empty.dtypes
    assert [tuple(r) for r in back.metrics().collect()] == [("e", "rows", 0)]


def test_counts_equal_the_reports(spark, inputs):
    store = StageStore(spark, tempfile.mkdtemp(prefix="pavespark-work-"))
    p = SurveyStages(inputs, store=store)
    table = p.station_table
    found = {(r["stage"], r["metric"]): r["value"] for r in store.metrics().collect()}
    assert found["key", "report_zero_coords"] == R.zero_coords(p.key).count() > 0
    assert found["station_table", "report_missing_measures"] == R.missing_measures(table).count() > 0
    assert found["station_table", "rows"] == table.count() and found["laser", "rows"] == p.laser.count()
    assert found["station_table", "lost_grid_stations"] == table.where(P.on_grid_suffix("chainage") & P.gps_lost()).count() > 0


def test_cli_with_a_work_folder(spark, inputs, capsys):
    from pavespark.__main__ import main
    base = tempfile.mkdtemp(prefix="pavespark-work-")
    exported.write_tables(inputs, f"{base}/tables")
    print_before = files_fingerprint(spark, f"{base}/tables", form="run")
    assert print_before == files_fingerprint(spark, f"{base}/tables", form="run")
    assert print_before != files_fingerprint(spark, f"{base}/tables", form="folder")
    main(["--tables", f"{base}/tables", "--out", f"{base}/out", "--work", f"{base}/work", "--keep-stages"])
    assert "stations_final" in tables_in(f"{base}/work") and "went on after" not in capsys.readouterr().out
    main(["--tables", f"{base}/tables", "--out", f"{base}/out", "--work", f"{base}/work"])
    assert "went on after" in capsys.readouterr().out
    assert tables_in(f"{base}/work") == []
    assert spark.read.parquet(f"{base}/out/stage_metrics").where("metric = 'rows'").count() >= 16
    assert spark.read.parquet(f"{base}/out/survey_point").count() > 0
