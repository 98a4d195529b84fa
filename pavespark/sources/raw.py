"""SRC-1..4, SRC-6: the van's own tables, as exported from each run's database.

A run's database holds seven tables whose names carry the run. They are exported below

    <root>/survey_data/<date>/<run>_edit.../<table name>.csv      (or .parquet)

as one file, or as a folder of part files, each with its header. A table of all runs is one
scan: the run comes from the table's name in the path, so thousands of run folders need no
loop. Exports carry more columns than the extracts read, in an order of their own; the
header of the first file says which, and every other file's header is held against it, so a
file that differs fails the read instead of filling wrong columns. Columns that no extract
reads are never parsed. Fixed schemas (SRC-7) give the types, and a value that does not fit
its column fails the read as well.
"""

from __future__ import annotations

import re
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pavespark.sources import exported, schemas
from pavespark.sources.exported import RUN
from pavespark.sources.fixtures import Inputs

# Names of the run's tables before and after the run's name, and their columns.
RAW_TABLES = {
    "gps": ("GPS_Processed_", "", schemas.GPS),
    "iri": ("Profiler_IRI_", "", schemas.IRI),
    "tpl": ("TPL_Processed_", "", schemas.TPL),
    "mpd": ("Profiler_MPD_", "", schemas.MPD),
    "keycode": ("KeyCode_Raw_", "", schemas.KEYCODE),
    "video_row": ("Video_Processed_", "_1", schemas.VIDEO_ROW),
    "video_pave": ("Video_Processed_", "_2", schemas.VIDEO_PAVE),
}
FORMATS = ("csv", "parquet")
RENAMES = 8  # at a time: each waits for the file system
# the loaded tables: the exported tables each is made of, and how
EXTRACTS = {
    "laser": (("gps", "iri", "tpl", "mpd"), exported.laser_extract),
    "key": (("keycode",), exported.key_extract),
    "pic": (("video_row",), exported.pic_extract),
    "pave": (("video_pave",), exported.pave_extract),
}


@dataclass
class RawTables:
    """The seven exported tables of a set of runs, each with the run in ``file_name``."""
    gps: DataFrame
    iri: DataFrame
    tpl: DataFrame
    mpd: DataFrame
    keycode: DataFrame
    video_row: DataFrame
    video_pave: DataFrame

    def extracted(self) -> Inputs:
        """SRC-1..4 over all runs."""
        return Inputs(**{name: of(*(getattr(self, t) for t in tables))
                         for name, (tables, of) in EXTRACTS.items()})


def _places(root: str, table: str, fmt: str, date: str) -> str:
    before, after, _ = RAW_TABLES[table]
    return f"{root.rstrip('/')}/survey_data/{date}/*/{before}*{after}.{fmt}"


def run_of_path(table: str, fmt: str) -> Column:
    """The run in the name of the file (or folder of part files) that a row was read from."""
    before, after, _ = RAW_TABLES[table]
    path = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    return F.regexp_extract(path, rf"/{before}([^/]+){after}\.{fmt}(?:/[^/]*)?$", 1)


def header_schema(found: list[str], wanted: T.StructType, table: str) -> T.StructType:
    """A file's columns in their order, with the types of those that are wanted (names in any
    case). Raises where one is missing."""
    types = {f.name.lower(): f for f in wanted.fields}
    missing = [f.name for n, f in types.items() if n not in {c.lower() for c in found}]
    if missing:
        raise ValueError(f"{table}: the exported table has no column {', '.join(missing)}")
    return T.StructType([T.StructField(c, types[c.lower()].dataType if c.lower() in types else T.StringType())
                         for c in found])


def _first_place(spark: SparkSession, root: str, table: str, fmt: str, date: str) -> str:
    """The table of the first run that has one, or the pattern of all where none is found."""
    before, after, _ = RAW_TABLES[table]
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    top = path(f"{root.rstrip('/')}/survey_data/{date}")
    fs = top.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for day in fs.globStatus(top) or []:
        for run in fs.listStatus(day.getPath()) if day.isDirectory() else []:
            if not run.isDirectory():
                continue
            for found in fs.listStatus(run.getPath()):
                name = found.getPath().getName()
                if len(name) >= len(before + after) and name.startswith(before) and name.endswith(f"{after}.{fmt}"):
                    # the name is taken as it is, not as a pattern
                    return re.sub(r"([\\*?{}\[\]])", r"\\\1", found.getPath().toString())
    return _places(root, table, fmt, date)


def read_raw_table(spark: SparkSession, root: str, table: str, fmt: str = "csv", date: str = "*",
                   encoding: str = "UTF-8") -> DataFrame:
    """One of ``RAW_TABLES`` of all runs below ``root``; ``date`` names one survey day's folder
    or a pattern of them. All runs are listed once; the header is read from one of them."""
    if fmt not in FORMATS:
        raise ValueError(f"fmt must be one of {FORMATS}")
    wanted = RAW_TABLES[table][2]
    places = _places(root, table, fmt, date)
    if fmt == "parquet":
        rows = spark.read.parquet(places)
        header_schema(rows.columns, wanted, table)
    else:
        options = {"header": "true", "encoding": encoding}
        first = _first_place(spark, root, table, fmt, date)
        stored = header_schema(spark.read.options(**options).csv(first).columns, wanted, table)
        rows = (spark.read.schema(stored).options(**options, nullValue="", enforceSchema="false",
                                                  mode="FAILFAST").csv(places))
    return rows.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in wanted.fields),
                       run_of_path(table, fmt).alias(RUN))


def read_raw_tables(spark: SparkSession, root: str, fmt: str = "csv", date: str = "*",
                    encoding: str = "UTF-8") -> RawTables:
    return RawTables(**{t: read_raw_table(spark, root, t, fmt, date, encoding) for t in RAW_TABLES})


def load_raw_extract(spark: SparkSession, root: str, extract: str, fmt: str = "csv", date: str = "*",
                     encoding: str = "UTF-8") -> DataFrame:
    """One of SRC-1..4 (``laser``, ``key``, ``pic``, ``pave``); lists and reads the tables it needs."""
    tables, of = EXTRACTS[extract]
    return of(*(read_raw_table(spark, root, t, fmt, date, encoding) for t in tables))


def load_raw_folder(spark: SparkSession, root: str, fmt: str = "csv", date: str = "*",
                    encoding: str = "UTF-8") -> Inputs:
    """The four loaded tables (SRC-1..4) from the exported tables of all runs below ``root``."""
    return read_raw_tables(spark, root, fmt, date, encoding).extracted()


def _place_by_run(spark: SparkSession, source: str, target) -> None:
    """Move each ``file_name=<run>`` folder of a partitioned write to ``target(run)``. Renames
    on the file system the cluster uses, several at a time; no data moves."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    fs = path(source).getFileSystem(conf)

    def place(name: str) -> None:
        to = path(target(unquote(name.removeprefix(f"{RUN}="))))
        fs.mkdirs(to.getParent())
        if not fs.rename(path(f"{source}/{name}"), to):
            raise OSError(f"cannot move {source}/{name} to {to}")

    names = [found.getPath().getName() for found in fs.listStatus(path(source))]
    with ThreadPoolExecutor(RENAMES) as pool:
        list(pool.map(place, (name for name in names if name.startswith(f"{RUN}="))))
    fs.delete(path(source), True)


def write_by_run(df: DataFrame, scratch: str, target, fmt: str = "csv", header: bool = True) -> None:
    """Write a table of many runs as one folder of part files per run, placed by ``target``
    (run -> path). One distributed write; the run is in the path only."""
    options = {"header": str(header).lower(), "nullValue": ""} if fmt == "csv" else {}
    # small rows in many files: dealt by number, or a few tasks would open all of them
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    (df.repartition(n, F.col(RUN)).write.partitionBy(RUN)
       .options(**options, **exported.COMMIT_IN_TASKS).format(fmt).save(scratch))
    _place_by_run(df.sparkSession, scratch, target)


def write_raw_tables(raw: RawTables, root: str, date: str, fmt: str = "csv", tables=tuple(RAW_TABLES)) -> None:
    """The layout that ``read_raw_tables`` reads: one export of each run's seven tables, or of
    some of them."""
    base = f"{root.rstrip('/')}/survey_data/{date}"
    for table in tables:
        before, after, _ = RAW_TABLES[table]
        write_by_run(getattr(raw, table), f"{base}/_{table}",
                     lambda run, b=before, a=after: f"{base}/{run}_edit/{b}{run}{a}.{fmt}", fmt)
