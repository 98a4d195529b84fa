"""Polyline geometry on lon/lat columns, as built-in Spark expressions.

A line is ``ARRAY<STRUCT<chainage DOUBLE, lon DOUBLE, lat DOUBLE>>`` sorted by
chainage (the ordered aggregate of a group's points). Interpolation follows
the usual linear-referencing rule: fraction 0 -> first point, 1 -> last
point, otherwise walk the segments by cumulative planar length fraction and
blend inside the first segment whose end lies beyond the target (zero-length
segments are skipped; if rounding leaves nothing, the last point).
Length is along the WGS84 ellipsoid with the local meridian / prime-vertical
radii of each (short) segment's mid-latitude.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- fixed values: WGS84 ellipsoid -------------------------------------------------
WGS84_A = 6378137.0
WGS84_F = 1 / 298.257223563
WGS84_E2 = WGS84_F * (2 - WGS84_F)


def point_struct(chainage, lon, lat) -> Column:
    def c(x):
        return F.col(x) if isinstance(x, str) else x
    return F.struct(c(chainage).cast("double").alias("chainage"),
                    c(lon).cast("double").alias("lon"), c(lat).cast("double").alias("lat"))


def line_agg(chainage="chainage", lon="lon", lat="lat") -> Column:
    """AGG-5 / GEO-4: ordered line of a group's points (ST_MakeLine ... ORDER BY chainage);
    SRT-4: the order inside the aggregate is ``array_sort``. A point with a NULL
    coordinate is a NULL geometry, which the line aggregate skips."""
    def c(x):
        return F.col(x) if isinstance(x, str) else x
    ok = c(lon).isNotNull() & c(lat).isNotNull()
    return F.array_sort(F.collect_list(F.when(ok, point_struct(chainage, lon, lat))))


def add_point_at(df: DataFrame, line: str, fraction, out: str) -> DataFrame:
    """GEO-5: add ``out`` = STRUCT<lon, lat>, the point at ``fraction`` of the planar
    2-D length of ``line``. Linear in the number of points: segment lengths and the
    total are computed once per row as columns, then one left fold finds the segment."""
    pts = F.col(line)
    f = F.col(fraction) if isinstance(fraction, str) else fraction
    n = F.size(pts)
    idx = F.when(n >= 2, F.sequence(F.lit(1), n - 1)).otherwise(F.array().cast("array<int>"))

    def seg(i):
        a, b = F.get(pts, i - 1), F.get(pts, i)
        return F.sqrt((b["lon"] - a["lon"]) ** 2 + (b["lat"] - a["lat"]) ** 2)

    d = df.withColumn("_ip_f", f.cast("double"))
    d = d.withColumn("_ip_seg", F.transform(idx, seg))
    d = d.withColumn("_ip_tot", F.aggregate("_ip_seg", F.lit(0.0), lambda acc, x: acc + x))
    init = F.struct(F.lit(0.0).alias("cum"), F.lit(False).alias("done"),
                    F.lit(None).cast("double").alias("x"), F.lit(None).cast("double").alias("y"))
    ff, tot = F.col("_ip_f"), F.col("_ip_tot")

    def step(acc, i):
        fr = F.try_divide(F.get(F.col("_ip_seg"), i - 1), tot)
        a, b = F.get(pts, i - 1), F.get(pts, i)
        t = F.try_divide(ff - acc["cum"], fr)
        hit = F.coalesce((~acc["done"]) & (ff < acc["cum"] + fr), F.lit(False))
        return F.when(hit, F.struct((acc["cum"] + fr).alias("cum"), F.lit(True).alias("done"),
                                    (a["lon"] + t * (b["lon"] - a["lon"])).alias("x"),
                                    (a["lat"] + t * (b["lat"] - a["lat"])).alias("y"))) \
                .otherwise(F.struct((acc["cum"] + fr).alias("cum"), acc["done"].alias("done"),
                                    acc["x"].alias("x"), acc["y"].alias("y")))

    d = d.withColumn("_ip_w", F.aggregate(idx, init, step))
    w = F.col("_ip_w")
    first, last = F.get(pts, 0), F.get(pts, n - 1)
    pick_first = (ff == 0) | (n == 1)
    pick_last = (ff == 1) | (tot == 0) | ~w["done"]

    def pick(field, acc_field):
        return (F.when(n == 0, F.lit(None)).when(pick_first, first[field])
                 .when(pick_last, last[field]).otherwise(w[acc_field])).cast("double")

    d = d.withColumn(out, F.struct(pick("lon", "x").alias("lon"), pick("lat", "y").alias("lat")))
    return d.drop("_ip_f", "_ip_seg", "_ip_tot", "_ip_w")


def _segment_m(a, b) -> Column:
    import math
    phi = F.radians((a["lat"] + b["lat"]) / 2)
    s2 = F.sin(phi) ** 2
    m = WGS84_A * (1 - WGS84_E2) / F.pow(1 - WGS84_E2 * s2, 1.5)
    nrad = WGS84_A / F.sqrt(1 - WGS84_E2 * s2)
    dphi = (b["lat"] - a["lat"]) * (math.pi / 180)
    dlam = (b["lon"] - a["lon"]) * (math.pi / 180)
    return F.sqrt((m * dphi) ** 2 + (nrad * F.cos(phi) * dlam) ** 2)


def length_m(line) -> Column:
    """GEO-6 / AGG-8: line length in metres on the WGS84 ellipsoid."""
    pts = F.col(line) if isinstance(line, str) else line
    n = F.size(pts)
    idx = F.when(n >= 2, F.sequence(F.lit(1), n - 1)).otherwise(F.array().cast("array<int>"))
    return F.aggregate(idx, F.lit(0.0),
                       lambda acc, i: acc + _segment_m(F.get(pts, i - 1), F.get(pts, i)))


def length_km(line) -> Column:
    """``(st_length(line::geography)/1000)::numeric(8,3)``."""
    return (length_m(line) / 1000).cast("decimal(8,3)")

