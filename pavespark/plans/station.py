"""Station table (``data_suvey``): stations x links x pictures x GPS status.

TAB-1 = PRJ-1 (clamp) -> JN-2 (picture attach) -> JN-3 (station->link range
join) -> JN-6 with AGG-1 (GPS-loss status per link).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pavespark import constants as K
from pavespark.functions import predicates as P
from pavespark.functions.measures import default_draw, iri_clamp
from pavespark.operators.joins import range_join, run_extent
from pavespark.session import growing

RUN = "file_name"

KEY_COLS = ["event_str", "event_end", "event_num", "event_type", "event_name", "link_id",
            "section_id", "km_start", "km_end", "length", "lane_no", "survey_date",
            "lat_str", "lat_end", "lon_str", "lon_end", "ramp_id"]
LASER_COLS = ["chainage", "lon", "lat", "iri_right", "iri_left", "iri_old", "iri_lane",
              "rutt_right", "rutt_left", "rutting", "texture", "etd_texture", "iri"]


def pave_keys(key: DataFrame) -> DataFrame:
    """FIL-1: pavement events of the key-code table."""
    return key.where(P.pave_event("event_type"))


def attach_pictures(laser: DataFrame, pic: DataFrame) -> DataFrame:
    """JN-2: stations left-joined with the camera index on ``chainage = chainage_pic::int``."""
    p = pic.withColumn("_pk", P.pg_int("chainage_pic").cast("double"))
    return (laser.join(growing(p.withColumnRenamed(RUN, "_prun")),
                       (F.col(RUN) == F.col("_prun")) & (F.col("chainage") == F.col("_pk")), "left")
                 .drop("_prun", "_pk"))


def station_link_join(stations: DataFrame, key: DataFrame, tolerance: float = 0.0,
                      rounded: bool = True, extent: DataFrame | None = None) -> DataFrame:
    """JN-3 / JN-4: stations inside [event_str, event_end] (rounded, optional +-tolerance)."""
    lo = P.pg_int("event_str") if rounded else F.col("event_str")
    hi = P.pg_int("event_end") if rounded else F.col("event_end")
    return range_join(stations, key, "chainage", lo - tolerance, hi + tolerance,
                      keys=[RUN], extent=extent)


def _status_from_candidates(cand: DataFrame) -> DataFrame:
    """AGG-1 over station x link candidates already restricted to [event_str-5, event_end+5]."""
    joined = cand.where(P.on_grid("chainage")).withColumn("date", P.survey_date("survey_date"))
    keys = [RUN, "date", "link_id"]
    counts = (joined.where(F.col("link_id").isNotNull()).groupBy(*keys)
                    .agg(F.count_if(P.gps_lost()).alias("lost"),
                         F.count_if(P.gps_present()).alias("present")))
    # JN-5 / SET-1 on the small table of counts: dates with lost stations, and all dates with
    # present ones of links without any lost station
    link_lost = F.max("lost").over(W.partitionBy(RUN, "link_id"))
    status = (counts.withColumn("link_lost", link_lost)
                    .where("lost > 0 OR (link_lost = 0 AND present > 0)")
                    .select(*keys, F.when(F.col("lost") > 0, F.col("lost"))
                            .otherwise(F.col("present")).alias("count"),
                            F.when(F.col("lost") > 0, F.lit(K.STATUS_LOST))
                            .otherwise(F.lit(K.STATUS_NOT_LOST)).alias("status")))
    return status.withColumn(
        "status_type",
        F.when((F.col("status") == K.STATUS_LOST) & (F.col("count") > K.MAX_LOST_GRID_STATIONS),
               F.lit(K.STATUS_DO_NOT_PROCEED)).otherwise(F.lit(K.STATUS_PROCEED)))


def gps_status(laser: DataFrame, pic: DataFrame, key: DataFrame,
               extent: DataFrame | None = None, need_picture: bool = False) -> DataFrame:
    """AGG-1: lost 25 m stations per (run, date, link) within the key range +-5 m.

    Links with lost stations get the lost status and their count; links
    without any get the not-lost status with their count of present stations.
    More than 10 lost stations -> "do not proceed" (the row is kept).
    ``need_picture``: only stations with a picture count (folder form).
    """
    cand = station_link_join(attach_pictures(laser, pic), pave_keys(key),
                             tolerance=K.STATUS_TOLERANCE_M, rounded=False, extent=extent)
    return _status_from_candidates(_pictured(cand, need_picture))


def _pictured(cand: DataFrame, need_picture: bool) -> DataFrame:
    return cand.where(F.col("chainage_pic").isNotNull()) if need_picture else cand


def station_table(laser: DataFrame, key: DataFrame, pic: DataFrame, draw=default_draw,
                  extent: DataFrame | None = None, need_picture: bool = False) -> DataFrame:
    """TAB-1 ``data_suvey``. ``geom_lon/geom_lat`` carry the point geometry.

    The stations are range-joined with the links twice: within +-5 m (unrounded) for the
    counts of the GPS status, which keep only what they read, and within
    [rint(event_str), rint(event_end)] for the rows. The status joins the links before they
    meet the stations, so the whole rows are not shuffled once more for it.
    ``need_picture``: see ``gps_status``.
    """
    if extent is None:
        extent = run_extent(laser)
    stations = attach_pictures(iri_clamp(laser, draw), pic)
    links = pave_keys(key)
    cand = station_link_join(stations, links, tolerance=K.STATUS_TOLERANCE_M, rounded=False, extent=extent)
    status = _status_from_candidates(_pictured(cand, need_picture))
    links = links.join(growing(status.select(RUN, "link_id", "status", "status_type")), [RUN, "link_id"], "inner")
    a = station_link_join(stations, links, extent=extent)
    # PRJ-2: running km = km_start (without '+') + chainage - event_str
    a = (a.withColumn("km2", P.as_real(P.km_int("km_start") + F.col("chainage") - F.col("event_str")))
          .withColumn("date", P.survey_date("survey_date"))
          .withColumn("geom_lon", F.col("lon")).withColumn("geom_lat", F.col("lat")))
    return a.select("km2", "date", *KEY_COLS, *LASER_COLS, RUN, "chainage_pic", "frame_number",
                      "geom_lon", "geom_lat", "status", "status_type")
