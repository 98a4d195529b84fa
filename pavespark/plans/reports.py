"""QA reports as DataFrames (SNK-3: the caller decides where to print or write them).

Reports that the multi-run form computed across runs take ``scope``:
``"run"`` (default) groups inside each run; ``"all"`` groups over all runs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pavespark import constants as K
from pavespark.functions import codes as C
from pavespark.functions import predicates as P
from pavespark.operators.windows import ordered_index

RUN = "file_name"


def _scope(scope: str) -> list[str]:
    return [RUN] if scope == "run" else []


def zero_coords(key: DataFrame) -> DataFrame:
    """RPT-1 (FIL-9): keyed links whose start or end coordinate is exactly 0."""
    d4 = "decimal(8,4)"
    return key.where(P.zero_key_coords()).select(
        RUN, "event_str", "event_end", "link_id", "km_start", "km_end", "lane_no",
        F.col("lat_str").cast(d4).alias("lat_str"), F.col("lat_end").cast(d4).alias("lat_end"),
        F.col("lon_str").cast(d4).alias("lon_str"), F.col("lon_end").cast(d4).alias("lon_end"))


def duplicate_links(data: DataFrame, scope: str = "run") -> DataFrame:
    """RPT-2: link ids used by more than one (event_str, event_end)."""
    g = _scope(scope)
    return (data.select(*g, "event_str", "event_end", "link_id").distinct()
                .groupBy(*g, "link_id").agg(F.count("link_id").alias("cc"))
                .where(F.col("cc") > 1))


def ramp_id_check(data: DataFrame) -> DataFrame:
    """RPT-3: links starting with '1' must have no ramp id, all others must have one."""
    first = F.substring(F.split_part(F.col("link_id"), F.lit("C"), F.lit(1)), 1, 1)
    has = F.col("ramp_id").isNotNull()
    status = (F.when((first == "1") & ~has, K.RAMP_OK)
               .when((first == "1") & has, K.RAMP_MISSING)
               .when((first != "1") & ~has, K.RAMP_MISSING)
               .when((first != "1") & has, K.RAMP_OK))
    return data.select(RUN, "link_id", "ramp_id").distinct().withColumn("ramp_stutus", status)


def _grid_coordinate_groups(data: DataFrame, where, having, scope: str) -> DataFrame:
    """AGG-3 (count ... having) per (link, coordinate); SRT-1 order."""
    g = _scope(scope)
    return (data.where(P.on_grid_suffix("chainage") & where)
                .groupBy(*g, "link_id", "lon", "lat")
                .agg(F.min("chainage").alias("min"), F.max("chainage").alias("max"),
                     # count(the_geom): a point with a NULL coordinate is NULL, not counted
                     F.count(F.when(F.col("lon").isNotNull() & F.col("lat").isNotNull(), 1))
                     .alias("count"))
                .where(having(F.col("count")))
                .select(*g, "link_id", "min", "max", "count")
                .orderBy(F.asc("min"), F.desc("count")))


def gps_lost_groups(data: DataFrame, scope: str = "run") -> DataFrame:
    """RPT-4: lost coordinate groups with more than 10 grid stations per link."""
    return _grid_coordinate_groups(data, P.gps_lost(), lambda c: c > K.MAX_LOST_GRID_STATIONS,
                                   scope)


def gps_duplicates(data: DataFrame, scope: str = "run") -> DataFrame:
    """RPT-5: present coordinates repeated on grid stations of a link."""
    return _grid_coordinate_groups(data, P.gps_present(), lambda c: c > 1, scope)


def missing_measures(data: DataFrame) -> DataFrame:
    """RPT-8: missing iri / rutting / texture, or a missing picture on a grid station."""
    return data.where(P.missing_measures()).select(RUN, "link_id", "chainage", "iri", "rutting", "texture",
                                   "frame_number")


def lane_consistency(data: DataFrame) -> DataFrame:
    """RPT-9: link side / lane type vs km direction; first failing rule wins."""
    links = (data.select(RUN, "date", "event_name", "link_id", "section_id", "lane_no",
                         P.km_int("km_start").alias("km_start"), P.km_int("km_end").alias("km_end"),
                         C.lane_group("link_id", K.REPORT_MAX_LANE_GROUP).alias("lane_group"))
                 .distinct())
    g, lane1 = F.col("lane_group"), F.left(F.col("lane_no"), F.lit(1))
    rule = (F.when((g > 0) & (F.col("km_end") - F.col("km_start") < 0), K.LANE_MSG_L_SIDE)
             .when((g < 0) & (F.col("km_start") - F.col("km_end") < 0), K.LANE_MSG_R_SIDE)
             .when(F.col("lane_no").isNull(), K.LANE_MSG_NO_LANE))
    for letter, grp, msg in K.LANE_LETTER_GROUP:
        rule = rule.when((lane1 == letter) & (F.abs(g) != grp), msg)
    order = [F.col("km_start").asc_nulls_last(), F.col("link_id").asc_nulls_last(),
             F.col("event_name").asc_nulls_last(), F.col("section_id").asc_nulls_last(),
             F.col("km_end").asc_nulls_last(), F.col("lane_no").asc_nulls_last(),
             F.col("date").asc_nulls_last()]
    chunk = F.coalesce(F.floor(F.col("km_start") / 100000), F.lit(1 << 40))
    numbered = ordered_index(links, [RUN], order, name="id", chunk=chunk)  # WIN-7
    return (numbered.withColumn("id", F.col("id") + 1).withColumn("problem", rule)
                    .where(F.col("problem").isNotNull())
                    .select(RUN, "id", "link_id", "km_start", "km_end", "lane_no", "lane_group",
                            "problem"))

