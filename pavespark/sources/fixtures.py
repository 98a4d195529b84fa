"""Exported survey tables derived from the driver's ``events`` table.

500 events make one run (run r = event_id div 500, station i = event_id % 500,
w = round(value*100)). Only integer arithmetic is used until one final
division, so the DuckDB oracle (survey_oracle/fixtures.py) derives equal values.
Planted cases: GPS gaps (short, long, at a link end, links without loss),
frozen GPS, IRI above the clamp limit, missing measures and pictures,
off-grid link starts, a boundary station in two links, a reused link id,
bad key coordinates, ramp-id and lane faults, construction and non-pavement
key rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pavespark.sources import exported

E = F.expr


LAYOUTS = ("uniform", "hot")


def padded(number: str, width: int) -> str:
    """SQL text of a number with leading zeros; longer numbers keep all digits, which
    ``lpad`` alone would cut."""
    text = f"cast({number} as string)"
    return f"lpad({text}, greatest({width}, length({text})), '0')"


def layout_name(layout: str | None = None) -> str:
    """``uniform``: 500 stations per run. ``hot``: every third 500-event block joins
    run 1, which then holds a third of all stations along one long chainage (the
    skew case: one run, one key, a third of all rows)."""
    name = layout or "uniform"
    if name not in LAYOUTS:
        raise ValueError(f"layout must be one of {LAYOUTS}")
    return name


def events(spark: SparkSession, sf_dir: str, layout: str | None = None) -> DataFrame:
    ev = spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet").select("event_id", "value")
    if layout_name(layout) == "hot":
        hot = "((event_id div 500) % 3 = 0)"
        r = f"case when {hot} then 0 else event_id div 500 end"
        i = f"case when {hot} then ((event_id div 500) div 3) * 500 + event_id % 500 else event_id % 500 end"
    else:
        r, i = "event_id div 500", "event_id % 500"
    return ev.select(
        F.col("event_id").alias("e"),
        E(r).alias("r"),
        E(i).alias("i"),
        E("cast(round(value * 100) as bigint)").alias("w"),
        E(f"concat('20240101 ', {padded(f'({r}) + 1', 4)})").alias("file_name"),
    )


LOST = ("((i % 97 between 40 and 44) and (r + i div 100) % 4 <> 1) "
        "or (r % 3 = 1 and i between 210 and 279) or (r % 2 = 0 and i between 94 and 99)")
P = "(case when i between 300 and 310 then 300 else i end)"


def _lon(p: str) -> str:
    return f"(100500000 + 10000 * (r % 50) + 46 * ({p})) / 1e6"


def _lat(p: str) -> str:
    return f"(13700000 + 12 * ({p})) / 1e6"


def gps(ev: DataFrame) -> DataFrame:
    return ev.select(
        E("cast(5 * i as double)").alias("CHAINAGE"),
        E(f"case when {LOST} then 0d else {_lon(P)} end").alias("LONGITUDE"),
        E(f"case when {LOST} then 0d else {_lat(P)} end").alias("LATITUDE"),
        "file_name")


def iri(ev: DataFrame) -> DataFrame:
    return ev.select(
        E("cast(5 * i as double)").alias("CHAINAGE"),
        E("case when e % 211 = 0 then null else (w % 1000) / 1e2 end").alias("RWP_IRI"),
        E("case when e % 211 = 0 then null else ((w * 7) % 1000) / 1e2 end").alias("LWP_IRI"),
        E("((w * 3) % 800) / 1e2").alias("LANE_IRI"),
        "file_name")


def tpl(ev: DataFrame) -> DataFrame:
    return ev.where("e % 233 <> 0").select(
        E("cast(5 * i as double)").alias("CHAINAGE"),
        E("((w * 11) % 1500) / 1e2").alias("RUT_EDG_SE"),
        E("((w * 13) % 1500) / 1e2").alias("RUT_CTR_SE"),
        E("((w * 17) % 1500) / 1e2").alias("RUT_SE"),
        "file_name")


def mpd(ev: DataFrame) -> DataFrame:
    return ev.where("e % 241 <> 0").select(
        E("cast(5 * i as double)").alias("CHAINAGE"),
        E("((w * 19) % 200) / 1e2").alias("LANE_MPD"),
        "file_name")


LINK_ID_K = ("concat(case when {k} % 2 = 0 then '1' else '3' end, " + padded("q", 4) + ", "
             "lpad(cast({k} as string), 2, '0'), '0201', case when {k} < 3 then 'L' else 'R' end, "
             "cast(1 + (q + {k}) % 6 as string), case when (q + {k}) % 2 = 0 then 'CC' else 'AC' end, "
             "'01')")


def keycode(ev: DataFrame) -> DataFrame:
    """Key rows: per 2500 m block b of a run, links k=0..4, one non-pavement row (k=5)
    and one construction row (k=6); faults vary with q = r + b."""
    k = (ev.where("i % 500 < 7").withColumn("k", E("i % 500")).withColumn("b", E("i div 500"))
           .withColumn("q", E("r + i div 500")))
    link_k = LINK_ID_K.format(k="k")
    link_0 = LINK_ID_K.format(k="0")
    off = "2500 * b"
    ev_str = f"{off} + case when k = 5 then 0 when k = 6 then 2480 else 500 * k - 2 * (k % 2) end"
    ev_end = (f"{off} + case when k = 5 then 2495 when k = 6 then 2495 "
              "else 500 * k + 475 + case when k = 1 and q % 2 = 0 then 25 else 0 end end")
    km_a = "concat('1', cast(2 + k + 5 * b as string), '+000')"
    km_b = "concat('1', cast(2 + k + 5 * b as string), '+475')"
    swap = "(k in (3, 4) and not (q % 5 = 0 and k = 4))"
    zero = "(q % 6 = 0 and k = 0)"
    p_s = f"ceil(({ev_str}) / 5)"
    p_e = f"(ceil(({ev_end}) / 5) + case when k = 3 then 1 else 0 end)"
    return k.select(
        E(f"cast({ev_str} as double)").alias("CHAINAGE_START"),
        E(f"cast({ev_end} as double)").alias("CHAINAGE_END"),
        E("lpad(cast(k as string), 2, '0')").alias("EVENT"),
        E("case when k = 5 then 'other.' else 'pavetype.  ' end").alias("SWITCH_GROUP"),
        E("case when k = 5 then 'other' when k = 6 then 'construction' "
          "else concat('link ', cast(k as string)) end").alias("EVENT_DESC"),
        E(f"case when k = 5 then null when k = 6 then 'construction' "
          f"when k = 2 and q % 9 = 0 then {link_0} else {link_k} end").alias("link_id"),
        E("case when k = 5 then null else cast(1000 * r + 10 * b + k as string) end").alias("section_id"),
        E(f"case when k = 5 then '10+000' when k = 6 then '17+000' "
          f"when {swap} then {km_b} else {km_a} end").alias("km_start"),
        E(f"case when k = 5 then '12+495' when k = 6 then '17+015' "
          f"when {swap} then {km_a} else {km_b} end").alias("km_end"),
        E("case when k = 5 then '2.495' when k = 6 then '0.015' else '0.475' end").alias("length"),
        E("case when k = 5 then null when q % 7 = 0 and k = 1 then null when k = 2 then 'F1' "
          "when k = 3 then 'R' else '1' end").alias("lane_no"),
        E("case when q % 3 = 2 then '20240101' else '2024-01-01' end").alias("survey_date"),
        E(f"case when k = 5 or {zero} then 0d else {_lat(p_s)} end").alias("LATITUDE_START"),
        E(f"case when k = 5 or {zero} then 0d else {_lat(p_e)} end").alias("LATITUDE_END"),
        E(f"case when k = 5 or {zero} then 0d else {_lon(p_s)} end").alias("LONGITUDE_START"),
        E(f"case when k = 5 or {zero} then 0d else {_lon(p_e)} end").alias("LONGITUDE_END"),
        E("case when k in (1, 3) and q % 4 <> 0 then concat('RP', cast(k as string)) end")
        .alias("ramp_id"),
        "file_name")


def video_row(ev: DataFrame) -> DataFrame:
    return ev.where("i % 50 <> 45").select(
        E("cast(5 * i as double)").alias("CHAINAGE"),
        E("cast(i as string)").alias("FRAME"), "file_name")


Q = "(case when i between 200 and 204 then 200 else i end)"


def video_pave(ev: DataFrame) -> DataFrame:
    lost = "(i % 83 between 20 and 24)"
    return ev.select(
        E("cast(3 * i as double)").alias("CHAINAGE"),
        E("cast(i as string)").alias("FRAME"),
        E(f"case when {lost} then 0d else (100500000 + 10000 * (r % 50) + 28 * {Q}) / 1e6 end")
        .alias("X"),
        E(f"case when {lost} then 0d else (13700000 + 7 * {Q}) / 1e6 end").alias("Y"),
        "file_name")


@dataclass
class Inputs:
    """The four loaded tables of a set of runs."""
    laser: DataFrame
    key: DataFrame
    pic: DataFrame
    pave: DataFrame


def raw_tables(spark: SparkSession, sf_dir: str, layout: str | None = None):
    """The seven exported tables of all runs, as ``raw.RawTables``."""
    from pavespark.sources.raw import RawTables
    ev = events(spark, sf_dir, layout)
    return RawTables(gps=gps(ev), iri=iri(ev), tpl=tpl(ev), mpd=mpd(ev), keycode=keycode(ev),
                     video_row=video_row(ev), video_pave=video_pave(ev))


def load(spark: SparkSession, sf_dir: str, layout: str | None = None) -> Inputs:
    ev = events(spark, sf_dir, layout)
    return Inputs(
        laser=exported.laser_extract(gps(ev), iri(ev), tpl(ev), mpd(ev)),
        key=exported.key_extract(keycode(ev)),
        pic=exported.pic_extract(video_row(ev)),
        pave=exported.pave_extract(video_pave(ev)),
    )
