"""Survey sources: exported per-run tables -> the four loaded tables.

SRC-1..4 are projections/joins over the exported station, key-code and
camera tables; SRC-5 reads the header-less CSV interchange files with a fixed
schema; SRC-6 discovers every run of a dated folder in one read (the run name
comes from the file path, no driver-side loop).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pavespark.session import growing
from pavespark.sources import schemas as S

RUN = "file_name"


def as_real(c) -> Column:
    """A PostgreSQL ``real`` column: FLOAT precision, computed in DOUBLE."""
    c = F.col(c) if isinstance(c, str) else c
    return c.cast("float").cast("double")


def laser_extract(gps: DataFrame, iri: DataFrame, tpl: DataFrame, mpd: DataFrame) -> DataFrame:
    """SRC-1 / JN-1: stations = GPS left-joined with IRI, rutting and texture on (run, chainage)."""
    keys = [RUN, "CHAINAGE"]
    j = (gps.join(growing(iri), keys, "left")
            .join(growing(tpl), keys, "left")
            .join(growing(mpd), keys, "left"))
    dec = "decimal(8,2)"
    return j.select(
        as_real("CHAINAGE").alias("chainage"),
        as_real("LONGITUDE").alias("lon"),
        as_real("LATITUDE").alias("lat"),
        F.col("RWP_IRI").alias("iri_right"),
        F.col("LWP_IRI").alias("iri_left"),
        ((F.col("RWP_IRI") + F.col("LWP_IRI")) / 2).alias("iri"),
        F.col("LANE_IRI").cast(dec).alias("iri_lane"),
        F.col("RUT_EDG_SE").cast(dec).alias("rutt_right"),
        F.col("RUT_CTR_SE").cast(dec).alias("rutt_left"),
        F.col("RUT_SE").cast(dec).alias("rutting"),
        F.col("LANE_MPD").cast(dec).alias("texture"),
        (F.col("LANE_MPD") * 0.8 + 0.008).cast(dec).alias("etd_texture"),
        F.col(RUN),
    )


def key_extract(keycode: DataFrame) -> DataFrame:
    """SRC-2: key-code projection; char(n) columns are right-trimmed once here."""
    def txt(c, name):
        return F.rtrim(F.col(c)).alias(name)
    return keycode.select(
        as_real("CHAINAGE_START").alias("event_str"),
        as_real("CHAINAGE_END").alias("event_end"),
        txt("EVENT", "event_num"), txt("SWITCH_GROUP", "event_type"),
        txt("EVENT_DESC", "event_name"), txt("link_id", "link_id"),
        txt("section_id", "section_id"), txt("km_start", "km_start"),
        txt("km_end", "km_end"), txt("length", "length"), txt("lane_no", "lane_no"),
        txt("survey_date", "survey_date"),
        as_real("LATITUDE_START").alias("lat_str"), as_real("LATITUDE_END").alias("lat_end"),
        as_real("LONGITUDE_START").alias("lon_str"), as_real("LONGITUDE_END").alias("lon_end"),
        F.col(RUN), F.col("ramp_id"),
    )


def pic_extract(video_row: DataFrame) -> DataFrame:
    """SRC-3: right-of-way camera index."""
    return video_row.select(as_real("CHAINAGE").alias("chainage_pic"),
                            F.rtrim("FRAME").alias("frame_number"), F.col(RUN))


def pave_extract(video_pave: DataFrame) -> DataFrame:
    """SRC-4: pavement camera index with its own GPS (X, Y)."""
    return video_pave.select(as_real("CHAINAGE").alias("chainage_pic"),
                             F.rtrim("FRAME").alias("frame_number"),
                             F.col("X").cast("double").alias("lon"),
                             F.col("Y").cast("double").alias("lat"), F.col(RUN))


# ---------------------------------------------------------------- SRC-5 / SRC-6
# run folder = the folder below survey_data/<date>/ (or survey_data/<date>/process/ in the
# multi-run layout), text before "_edit"
RUN_FROM_PATH = r"survey_data/[^/]+/(?:process/)?([^/]+?)(?:_edit[^/]*)?/"


def read_loaded_csv(spark: SparkSession, path: str, schema) -> DataFrame:
    """SRC-5: header-less, comma separated, empty field = NULL, fixed column order."""
    return (spark.read.schema(schema)
            .option("header", "false").option("nullValue", "")
            .option("mode", "FAILFAST").csv(path))


def read_run_folder(spark: SparkSession, root: str, table: str, schema,
                    layout: str = "run") -> DataFrame:
    """SRC-6: every run below ``<root>/survey_data/<date>/<run>[_edit...]/<table>.csv``
    (``layout="run"``, one run per execution) or ``.../<date>/process/<run>/<table>.csv``
    (``layout="process"``, the all-runs-of-a-folder form); a file, or a folder of part
    files as Spark writes them. In the process layout every file holds the run name in the
    run column's place, which counts; in the run layout only the station file does, and the
    run comes from the path. A value that does not fit its column fails the read.

    One distributed read; the run name is taken from each file's path, so a
    folder with thousands of runs is still a single scan.
    """
    cols = [f.name for f in schema.fields if f.name != RUN]
    if layout == "process" or table == TABLE_FOLDERS["laser"]:
        stored = schema
    else:
        stored = type(schema)([f for f in schema.fields if f.name != RUN])
    df = (spark.read.schema(stored).option("header", "false").option("nullValue", "")
          .option("mode", "FAILFAST").csv(f"{root.rstrip('/')}/survey_data/*/{'process/' if layout == 'process' else ''}*/"
               f"{table}.csv"))
    if layout == "process":
        return df.select(*cols, F.rtrim(RUN).alias(RUN))
    # file paths are URIs: %20 for blanks; a literal '+' must survive the decoding
    path = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    return df.select(*cols, F.regexp_extract(path, RUN_FROM_PATH, 1).alias(RUN))


# tasks put their files in place themselves: with a folder per run, moving them one by one at
# the end of the job keeps the driver busy longer than all tasks. Only for new folders.
COMMIT_IN_TASKS = {"mapreduce.fileoutputcommitter.algorithm.version": "2"}


def by_run(df: DataFrame) -> DataFrame:
    """Rows dealt by run and 10 km chunk: a task writes few runs, and a long run is written by
    several tasks. Each run's folder gets a file per chunk, not one from every task."""
    at = next((c for c in ("chainage", "chainage_pic") if c in df.columns), None)
    return df.repartition(F.col(RUN), *([F.floor(F.col(at) / 10_000)] if at else []))


def write_run_partitioned_csv(df: DataFrame, path: str) -> None:
    """SNK-2 for many runs: one distributed write, one folder per run
    (``<path>/file_name=<run>/part-*.csv``)."""
    (by_run(df).write.mode("errorifexists").partitionBy(RUN).options(**COMMIT_IN_TASKS)
     .option("header", "false").option("nullValue", "").csv(path))


def read_run_partitioned_csv(spark: SparkSession, path: str, schema) -> DataFrame:
    """SRC-5 + run discovery for the layout above: fixed schema, run from the folder."""
    # the run column is declared in the schema, so its type is never inferred from
    # folder names (a run named 20240101 stays text)
    df = (spark.read.schema(schema).option("header", "false").option("nullValue", "")
          .option("mode", "FAILFAST").csv(path))
    return df.select(*[F.col(f.name) for f in schema.fields])


def loaded_laser(df: DataFrame) -> DataFrame:
    """Widen FLOAT columns of a loaded laser CSV to DOUBLE (values unchanged)."""
    return df.select(*[as_real(c).alias(c) if c in ("chainage", "lon", "lat") else F.col(c)
                       for c in df.columns])


def _widen_and_trim(df: DataFrame) -> DataFrame:
    """FLOAT -> DOUBLE (values unchanged), char(n) text right-trimmed once."""
    out = []
    for f in df.schema.fields:
        t = f.dataType.simpleString()
        if t == "float":
            out.append(as_real(f.name).alias(f.name))
        elif t == "string" and f.name != RUN:
            out.append(F.rtrim(F.col(f.name)).alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)


TABLE_FOLDERS = {"laser": "access_valuelaser", "key": "access_key", "pic": "access_pic",
                 "pave": "access_distress_pic"}


def load_tables(spark: SparkSession, root: str):
    """The four loaded tables of all runs below ``root`` (``<table>/file_name=<run>/*.csv``,
    header-less, fixed schemas), as ``fixtures.Inputs``."""
    from pavespark.sources.fixtures import Inputs
    base = root.rstrip("/")
    schemas = {"laser": S.LASER_CSV, "key": S.KEY_CSV, "pic": S.PIC_CSV, "pave": S.PAVE_CSV}
    tables = {name: _widen_and_trim(read_run_partitioned_csv(
        spark, f"{base}/{folder}", schemas[name])) for name, folder in TABLE_FOLDERS.items()}
    return Inputs(**tables)


def load_run_folder(spark: SparkSession, root: str, layout: str = "run"):
    """The four loaded tables of all runs below ``root`` in a layout of ``read_run_folder``."""
    from pavespark.sources.fixtures import Inputs
    schemas = {"laser": S.LASER_CSV, "key": S.KEY_CSV, "pic": S.PIC_CSV, "pave": S.PAVE_CSV}
    return Inputs(**{name: _widen_and_trim(read_run_folder(spark, root, table, schemas[name], layout))
                     for name, table in TABLE_FOLDERS.items()})


def write_tables(inputs, root: str) -> None:
    """Write the four loaded tables in the layout ``load_tables`` reads (SNK-2)."""
    schemas = {"laser": S.LASER_CSV, "key": S.KEY_CSV, "pic": S.PIC_CSV, "pave": S.PAVE_CSV}
    for name, folder in TABLE_FOLDERS.items():
        df = getattr(inputs, name)
        write_run_partitioned_csv(df.select(*[f.name for f in schemas[name].fields]),
                                  f"{root.rstrip('/')}/{folder}")


def write_stage(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """SNK-1: materialise a derived table as Parquet partitioned by run.

    Rows are dealt by run and 10 km chunk first (``by_run``)."""
    if "chainage" in df.columns:
        df = by_run(df)
    df.write.mode(mode).partitionBy(RUN).parquet(path)


def write_interchange_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """SNK-2: header-less CSV (interchange format of the extract step)."""
    df.write.mode(mode).option("header", "false").option("nullValue", "").csv(path)
