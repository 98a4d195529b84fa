"""Run all survey stages over the loaded tables of many runs and write the deliverables.

    python -m pavespark --tables DIR --out DIR [--master local[8]]

``--tables`` holds access_valuelaser/, access_key/, access_pic/ and access_distress_pic/ as
header-less CSV partitioned by run (``file_name=<run>/``), the layout
``sources.exported.write_tables`` writes. The deliverables (final stations, survey, survey points,
images, pavement tables) are written below ``--out`` as Parquet partitioned by run.
"""

from __future__ import annotations

import argparse

from pavespark.plans.lifecycle import StageStore, files_fingerprint
from pavespark.plans.stages import FORMS, SurveyStages
from pavespark.session import get_spark
from pavespark.sources.exported import load_run_folder, load_tables
from pavespark.sources.raw import load_raw_folder

LAYOUTS = ("partitioned", "run", "process", "raw", "raw-parquet")


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="pavespark")
    ap.add_argument("--tables", required=True,
                    help="folder with access_valuelaser/, access_key/, access_pic/, "
                         "access_distress_pic/ (header-less CSV, file_name=<run>/ partitions)")
    ap.add_argument("--out", required=True,
                    help="output folder for the deliverable tables (Parquet by run)")
    ap.add_argument("--master", default=None, help="Spark master (default: from the environment)")
    ap.add_argument("--pave-gap-mode", default="reference", choices=("reference", "window"))
    ap.add_argument("--layout", default="partitioned", choices=LAYOUTS,
                    help="partitioned: as above; run, process: <tables>/survey_data/<date>/"
                         "[process/]<run>/<table>.csv; raw, raw-parquet: the seven tables of every "
                         "run as exported, <tables>/survey_data/<date>/<run>_edit/GPS_Processed_<run>.csv ...")
    ap.add_argument("--encoding", default="UTF-8", help="character set of raw CSV exports")
    ap.add_argument("--form", default="run", choices=FORMS,
                    help="folder: only stations with a picture count for GPS status and events")
    ap.add_argument("--work", default=None,
                    help="folder on shared storage for the stages: a run that was stopped goes on "
                         "after its last complete stage if inputs and options are the same")
    ap.add_argument("--keep-stages", action="store_true",
                    help="leave the stages in --work after a finished run")
    a = ap.parse_args(argv)
    spark = get_spark(a.master)
    if a.layout == "partitioned":
        tables = load_tables(spark, a.tables)
    elif a.layout.startswith("raw"):
        tables = load_raw_folder(spark, a.tables, "parquet" if a.layout == "raw-parquet" else "csv",
                                 encoding=a.encoding)
    else:
        tables = load_run_folder(spark, a.tables, a.layout)
    store = None
    if a.work:
        store = StageStore(spark, a.work, files_fingerprint(
            spark, a.tables, layout=a.layout, form=a.form, pave_gap_mode=a.pave_gap_mode, encoding=a.encoding))
    stages = SurveyStages(tables, pave_gap_mode=a.pave_gap_mode, form=a.form, store=store)
    for name in stages.write_deliverables(a.out, mode="overwrite" if store else "errorifexists"):
        print(f"wrote {a.out.rstrip('/')}/{name}")
    if store:
        if store.resumed:
            print(f"went on after {', '.join(store.resumed)}")
        store.metrics().write.mode("overwrite").parquet(f"{a.out.rstrip('/')}/stage_metrics")
        if not a.keep_stages:
            store.clear()


if __name__ == "__main__":
    main()
