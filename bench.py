"""Benchmark: the end-to-end survey stage chain at one scale factor.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Runs all stages once over all runs derived from the directory's tables and
times every stage table as it is materialised (each stage reads the written
previous stage), then the QA reports. Prints ONE JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pavespark.plans.stages import SurveyStages  # noqa: E402
from pavespark.session import get_spark  # noqa: E402
from pavespark.sources import fixtures  # noqa: E402

STAGES = [
    ("station_table", lambda p: p.station_table),
    ("gps_gaps", lambda p: p.gps_lost),
    ("repair_event_start", lambda p: p.links_start_fixed),
    ("repair_event_end", lambda p: p.events_fixed),
    ("repair_gps_gaps", lambda p: p.gaps_filled),
    ("repair_gps_frozen", lambda p: p.unfrozen),
    ("smooth_measures", lambda p: p.stations_final),
    ("survey", lambda p: p.survey),
    ("survey_point_local", lambda p: p.survey_point_local),
    ("survey_image", lambda p: p.survey_image),
    ("repair_image_names", lambda p: p.survey_image_fixed),
    ("pave_table", lambda p: p.pave_table),
    ("pave_gps_gaps", lambda p: p.pave_gps_lost),
    ("repair_pave_gaps", lambda p: p.pave_gaps_filled),
    ("repair_pave_frozen", lambda p: p.pave_final),
    ("survey_pave", lambda p: p.survey_pave),
]


def reports(p: SurveyStages):
    from pavespark.plans import reports as R
    d = p.station_table
    return {
        "report_gps_lost": R.gps_lost_groups(d),
        "report_gps_duplicates": R.gps_duplicates(d),
        "report_lane_consistency": R.lane_consistency(d),
        "report_missing_measures": R.missing_measures(d),
    }


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = get_spark(f"local[{cpus}]", shuffle_partitions=int(os.environ.get("BENCH_PARTITIONS", cpus * 2)))
    # warm-up: JVM JIT and codegen caches, all stages on the tiny input
    warm = SurveyStages.from_fixtures(spark, "/root/testdata/sf0.001")
    for _, get in STAGES:
        get(warm).count()
    t_all = time.time()
    p = SurveyStages.from_fixtures(spark, sf_dir)
    times = {}
    rows = {}
    for name, get in STAGES:
        t0 = time.time()
        df = get(p)
        rows[name] = df.count()
        times[name] = round(time.time() - t0, 3)
    for name, df in reports(p).items():
        t0 = time.time()
        df.write.format("noop").mode("overwrite").save()  # a count would drop sorts and columns
        times[name] = round(time.time() - t0, 3)
    total = round(time.time() - t_all, 3)
    stations = p.laser.count()
    # the skew case: the same tables with one run holding a third of all stations
    t_hot = time.time()
    ph = SurveyStages(fixtures.load(spark, sf_dir, layout="hot"))
    hot_times = {}
    for name, get in STAGES:
        t0 = time.time()
        get(ph).count()
        hot_times[name] = round(time.time() - t0, 3)
    hot_total = round(time.time() - t_hot, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({
        "metric": "survey_stages_total", "value": total, "unit": "sec", "queries": times,
        "rows": rows, "stations": stations, "stations_per_sec": round(stations / total, 1),
        "sf": sf, "cpus": cpus, "hot_run_layout_total": hot_total, "hot_run_layout_queries": hot_times,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
