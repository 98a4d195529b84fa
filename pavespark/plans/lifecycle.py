"""SNK-1: the life of stage tables. Named stages in one folder, a manifest, resuming, clearing.

    <folder>/stages/<name>-<attempt>/    a stage's table (Parquet)
    <folder>/manifest/<name>/            one JSON row: what the stage is, once it is complete

A stage counts as complete when its manifest row is there, which is written after the table.
A run that was stopped, by a lost driver or an error, leaves the manifest rows of its complete
stages; the next run with the same inputs and options reads those tables and goes on after
them. A half-written table has no row and is never read: it is removed, as is every table of
other inputs or options. Scratch tables of a stage are removed as soon as it is complete.

While a stage is written its rows are counted, with the row-level figures of the QA reports
(``METRICS``), so they cost no further scan (``observe``).
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pavespark import constants as K
from pavespark.functions import predicates as P
from pavespark.session import exists, remove, scratch

# what is counted while a stage is written, besides its rows
METRICS: dict[str, dict[str, Callable[[], Column]]] = {
    "key": {
        # RPT-1
        "report_zero_coords": P.zero_key_coords,
    },
    "station_table": {
        # RPT-8; the stations behind RPT-4 and RPT-5
        "report_missing_measures": P.missing_measures,
        "lost_grid_stations": lambda: P.on_grid_suffix("chainage") & P.gps_lost(),
        "present_grid_stations": lambda: P.on_grid_suffix("chainage") & P.gps_present(),
        "stations_not_to_proceed": lambda: F.col("status_type") == K.STATUS_DO_NOT_PROCEED,
    },
    "survey_image": {"images_without_name": lambda: F.col("filename").isNull()},
}
ROW = "name string, path string, fingerprint string, schema string, metrics string"


class StageStore:
    """Stage tables of one run of the chain in ``folder`` (shared storage).

    ``fingerprint`` stands for the inputs and options: complete stages of another one are not
    read but removed.
    """

    def __init__(self, spark: SparkSession, folder: str, fingerprint: str = ""):
        self.spark, self.folder, self.fingerprint = spark, folder.rstrip("/"), fingerprint
        self.resumed: list[str] = []
        self.known: dict[str, dict] = {}
        for row in self._manifest():
            if row["fingerprint"] == fingerprint and exists(spark, f"{row['path']}/_SUCCESS"):
                self.known[row["name"]] = row
            else:
                remove(spark, f"{self.folder}/manifest/{row['name']}")
        self._sweep()

    def _manifest(self) -> list[dict]:
        if not exists(self.spark, f"{self.folder}/manifest"):
            return []
        rows = self.spark.read.schema(ROW).json(f"{self.folder}/manifest/*")
        return [r.asDict() for r in rows.where("name IS NOT NULL").collect()]  # a row a stage

    def _sweep(self) -> None:
        """Remove tables that no manifest row names: half-written, or of other inputs."""
        jvm = self.spark.sparkContext._jvm
        place = jvm.org.apache.hadoop.fs.Path(f"{self.folder}/stages")
        fs = place.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        kept = {row["path"].rsplit("/", 1)[1] for row in self.known.values()}
        for found in fs.listStatus(place) if fs.exists(place) else []:
            if found.getPath().getName() not in kept:
                fs.delete(found.getPath(), True)

    def stage(self, name: str, build: Callable[[], DataFrame], metrics: dict | None = None) -> DataFrame:
        """The complete table ``name``: read if there, else built, written and recorded."""
        row = self.known.get(name)
        if row is None:
            with scratch(self.spark):
                row = self._write(name, build(), metrics or {})
            self.known[name] = row
        elif name not in self.resumed:
            self.resumed.append(name)
        return self.spark.read.schema(T.StructType.fromJson(json.loads(row["schema"]))).parquet(row["path"])

    def _write(self, name: str, df: DataFrame, metrics: dict) -> dict:
        path = f"{self.folder}/stages/{name}-{uuid.uuid4().hex}"
        seen = Observation(f"{name}-{uuid.uuid4().hex}")
        counts = [F.count_if(cond()).alias(metric) for metric, cond in metrics.items()]
        df.observe(seen, F.count(F.lit(1)).alias("rows"), *counts).write.parquet(path)
        row = {"name": name, "path": path, "fingerprint": self.fingerprint,
               "schema": df.schema.json(), "metrics": json.dumps(seen.get)}
        (self.spark.createDataFrame([tuple(row.values())], ROW).coalesce(1)
             .write.mode("overwrite").json(f"{self.folder}/manifest/{name}"))
        return row

    def metrics(self) -> DataFrame:
        """stage, metric, value: what was counted while the stages were written."""
        rows = [(name, metric, value) for name, row in sorted(self.known.items())
                for metric, value in json.loads(row["metrics"]).items()]
        return self.spark.createDataFrame(rows, "stage string, metric string, value long")

    def drop(self, *names: str) -> None:
        """Remove stages that nothing needs any more."""
        for name in names:
            row = self.known.pop(name, None)
            if row:
                remove(self.spark, f"{self.folder}/manifest/{name}")
                remove(self.spark, row["path"])

    def clear(self) -> None:
        """Remove the folder's stages and manifest: the run is finished."""
        self.known.clear()
        for part in ("manifest", "stages"):
            remove(self.spark, f"{self.folder}/{part}")


def files_fingerprint(spark: SparkSession, root: str, **options) -> str:
    """Names, sizes and times of all files below ``root`` with the run's options, as one text.
    The files are listed, not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root).select(
        "path", "length", "modificationTime")
    found = files.agg(F.count(F.lit(1)), F.sum("length"), F.max("modificationTime"),
                      F.bit_xor(F.xxhash64("path", "length", "modificationTime"))).first()
    return json.dumps([list(found), options], default=str, sort_keys=True)
