"""GPS repairs: interpolate positions along the surveyed line.

Every repair is immutable: a *correction* DataFrame with one row per target
key is computed and left-joined back; matched rows take the new value
(NULL included), others keep theirs. Corrections are one row per key by
construction or by a deterministic pick (``_one_per_key``).
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pavespark import constants as K
from pavespark.functions import predicates as P
from pavespark.operators.geometry import add_point_at, line_agg
from pavespark.operators.joins import near_join, range_join
from pavespark.operators.windows import null_safe_join
from pavespark.session import growing

RUN = "file_name"
EVENT_COLS = ["event_name", "link_id", "section_id", "km_start", "km_end", "length", "lane_no",
              "date", RUN]


def _one_per_key(df: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Deterministic single correction per key (smallest value tuple)."""
    return (df.groupBy(*keys).agg(F.min(F.struct(*values)).alias("_v"))
              .select(*keys, *[F.col(f"_v.{v}").alias(v) for v in values]))


def apply_corrections(data: DataFrame, corr: DataFrame, on: dict,
                      assign: dict, among: Column | None = None) -> DataFrame:
    """JN-18 (update ... from): left-join corrections; ``on`` = {data_col: corr_col};
    ``assign`` = {data_col: fn(getter) -> Column over the correction columns};
    ``among``: true for every row that a correction can meet (a condition on its ``on``
    columns): the other rows are not shuffled."""
    rest = None
    if among is not None:
        among = F.coalesce(among, F.lit(False))
        data, rest = data.where(among), data.where(~among)
    c = corr.withColumn("_hit", F.lit(True))
    ren = {}
    for col in c.columns:
        ren[col] = f"_c_{col}"
        c = c.withColumnRenamed(col, ren[col])
    cond = None
    for dcol, ccol in on.items():
        e = F.col(dcol) == F.col(ren[ccol])
        cond = e if cond is None else cond & e
    j = data.join(growing(c), cond, "left")
    hit = F.col("_c__hit").isNotNull()
    out = j
    for dcol, expr in assign.items():
        out = out.withColumn(dcol, F.when(hit, expr(lambda n: F.col(ren[n]))).otherwise(F.col(dcol)))
    out = out.select(*data.columns)
    return out if rest is None else out.unionByName(rest)


# ----------------------------------------------------------------- event points
def event_points(data: DataFrame) -> DataFrame:
    """SET-2: distinct link start and end points (position and keyed coordinate);
    AGG-2 (group by all columns) is ``distinct``; GEO-1/GEO-2: a point is its lon/lat pair."""
    s = data.select(F.col("event_str").alias("chainage"), *EVENT_COLS,
                    F.col("lon_str").alias("lon"), F.col("lat_str").alias("lat"),
                    F.lit("str").alias("direction"))
    e = data.select(F.col("event_end").alias("chainage"), *EVENT_COLS,
                    F.col("lon_end").alias("lon"), F.col("lat_end").alias("lat"),
                    F.lit("end").alias("direction"))
    return s.unionByName(e).distinct()


def keyed_stations(laser: DataFrame, key: DataFrame, extent=None) -> DataFrame:
    """Stations within +-5 m of a named pavement link (one row per station and key row)."""
    k = key.where(P.pave_event("event_type") & (F.regexp_replace("link_id", " ", "") != ""))
    tol = K.STATUS_TOLERANCE_M
    st = range_join(laser.select(RUN, "chainage", "lon", "lat"), k.select(RUN, "event_str", "event_end"),
                    "chainage", F.col("event_str") - tol, F.col("event_end") + tol, keys=[RUN],
                    extent=extent)
    return st.where(F.col("lon").isNotNull() & F.col("lat").isNotNull()).select(
        RUN, "chainage", "lon", "lat")


def station_groups(keyed: DataFrame) -> DataFrame:
    """Keyed stations pre-aggregated per (run, coordinate): min and max chainage.
    Exact for 'some other station here' and 'earliest station here' (partial
    aggregation map-side, so the shared lost coordinate 0,0 is one row per run)."""
    return (keyed.groupBy(RUN, "lon", "lat")
                 .agg(F.min("chainage").alias("g_min"), F.max("chainage").alias("g_max")))


def event_station_pairs(events: DataFrame, groups: DataFrame) -> DataFrame:
    """JN-7 / GEO-3 (st_dwithin): event point within 0.00004 deg of a station coordinate group."""
    ev = events.where(F.col("lon").isNotNull() & F.col("lat").isNotNull())
    g = groups.withColumnRenamed("lon", "g_lon").withColumnRenamed("lat", "g_lat")
    return near_join(ev, g, K.NEAR_DISTANCE_DEG, [RUN], "lon", "lat", "g_lon", "g_lat")


def event_near_station(events: DataFrame, groups: DataFrame, stations: DataFrame) -> DataFrame:
    """JN-7: events with a station at their keyed point whose chainage differs;
    ``chainage_data`` = smallest such station chainage."""
    pairs = event_station_pairs(events, groups)
    ev_keys = ["chainage", "direction", "event_name", "link_id", "lon", "lat", RUN]
    other = pairs.where((F.col("g_min") != F.col("chainage")) | (F.col("g_max") != F.col("chainage")))
    # smallest station != event chainage; when the group's minimum *is* the event
    # chainage, look up the next one (only for those few pairs)
    need = other.where(F.col("g_min") == F.col("chainage")).select(
        RUN, "chainage", "g_lon", "g_lat").distinct()
    st = stations.select(F.col(RUN).alias("_r"), F.col("chainage").alias("_c"),
                         F.col("lon").alias("_x"), F.col("lat").alias("_y"))
    nxt = (need.join(growing(st), (F.col(RUN) == F.col("_r")) & (F.col("g_lon") == F.col("_x"))
                     & (F.col("g_lat") == F.col("_y")) & (F.col("_c") > F.col("chainage")))
               .groupBy(RUN, "chainage", "g_lon", "g_lat").agg(F.min("_c").alias("g_next")))
    cand = (other.join(growing(nxt), [RUN, "chainage", "g_lon", "g_lat"], "left")
                 .withColumn("_m", F.when(F.col("g_min") != F.col("chainage"), F.col("g_min"))
                             .otherwise(F.col("g_next"))))
    return cand.groupBy(*ev_keys).agg(F.min("_m").alias("chainage_data"))


def event_mismatch(events: DataFrame, groups: DataFrame, grid_only: bool = False) -> DataFrame:
    """RPT-6: events whose keyed point sits on a station more than 6 m earlier (SRT-2 order)."""
    pairs = event_station_pairs(events, groups).where(F.col("chainage") - F.col("g_min") > 6)
    out = (pairs.groupBy("chainage", "direction", "event_name", "link_id", "lon", "lat", RUN)
                .agg(F.min("g_min").alias("chainage_data"))
                .select(RUN, "chainage", "chainage_data", "direction", "event_name", "link_id"))
    # multi-run form: only 25 m positions by the printed suffix (FIL-3, so not 0)
    out = out.where(P.on_grid_suffix("chainage")) if grid_only else out
    return out.orderBy(RUN, "chainage", "link_id")


def _real_fraction(num: Column, den: Column) -> Column:
    """``num::real / den::real`` as a FLOAT value."""
    return P.as_real(P.as_real(num) / P.as_real(den))


def event_position_fixes(data: DataFrame, laser: DataFrame, groups: DataFrame,
                         extent=None) -> DataFrame:
    """REP-2/3 core: for event chainages confirmed by JN-7, interpolate between the
    valid stations within +-5 m; fraction kept inside [0, 1]. -> (run, chainage, lon, lat)."""
    pairs = event_station_pairs(event_points(data), groups)
    confirmed = (pairs.where((F.col("g_min") != F.col("chainage")) | (F.col("g_max") != F.col("chainage")))
                      .select(RUN, F.col("chainage").alias("e")).distinct())
    valid = laser.where(P.gps_valid()).select(RUN, F.col("chainage").alias("b"), "lon", "lat")
    nb = K.EVENT_NEIGHBOUR_M
    # JN-8: valid stations within +-5 m of the event position
    near = range_join(valid, confirmed, "b", F.col("e") - nb, F.col("e") + nb, keys=[RUN],
                      extent=extent)
    g = near.groupBy(RUN, "e").agg(F.min("b").alias("b_min"), F.max("b").alias("b_max"),
                                   line_agg("b", "lon", "lat").alias("line"))
    span = P.as_real(F.col("b_max") - F.col("b_min"))
    den = F.when(span == 0, P.as_real(F.lit(0.0001))).otherwise(span)
    g = g.withColumn("f", _real_fraction(F.col("e") - F.col("b_min"), den))
    g = add_point_at(g.where((F.col("f") >= 0) & (F.col("f") <= 1)), "line", "f", "pt")
    return g.select(RUN, F.col("e").alias("chainage"), F.col("pt.lon").alias("lon"),
                    F.col("pt.lat").alias("lat"))


def repair_event_coords(data: DataFrame, laser: DataFrame, groups: DataFrame, end: str,
                        extent=None) -> DataFrame:
    """REP-2 (end='str') / REP-3 (end='end'): write the interpolated keyed coordinate."""
    fixes = event_position_fixes(data, laser, groups, extent)
    return apply_corrections(
        data, fixes, {RUN: RUN, f"event_{end}": "chainage"},
        {f"lat_{end}": lambda c: P.as_real(c("lat")), f"lon_{end}": lambda c: P.as_real(c("lon"))})


# ------------------------------------------------------------------------ gaps
ISLAND = [RUN, "link_id", "date", "grp2", "min", "max"]


def gap_windows(gps_lost: DataFrame, data: DataFrame, extent=None) -> DataFrame:
    """Valid stations of lost-status links inside each gap window, per lost station.
    Anchors match by run only: at a seam they may belong to the neighbouring link.

    The window belongs to the island, not to the lost station, so the anchors are
    range-joined to the distinct islands (one interval each, linear in gap length)
    and then attached to the island's lost stations; grouping by the lost station
    keeps the multiplicity of a group that spans two islands."""
    # FIL-7 anchors: lon != 0, geometry latitude > 0, link status lost
    anchors = (data.where((F.col("lon") != 0) & (F.col("geom_lat") > 0)
                          & (F.col("status") == K.STATUS_LOST))
                   .select(RUN, F.col("chainage").alias("b"), "geom_lon", "geom_lat"))
    islands = gps_lost.select(*ISLAND, "new_p_min", "new_p_max").distinct()
    # JN-9: gap-window join, by run only (anchors may belong to the neighbouring link)
    per_island = range_join(anchors, islands, "b", F.col("new_p_min"), F.col("new_p_max"),
                            keys=[RUN], extent=extent).drop("new_p_min", "new_p_max")
    a = gps_lost.select(*ISLAND, F.col("chainage").alias("gps_lost_ch"), "c_p", "meter")
    j = null_safe_join(a, per_island, ISLAND)  # a NULL date is still one island
    return (j.groupBy(RUN, "gps_lost_ch", "c_p", "meter", "link_id", "date")
             .agg(F.min("b").alias("chainage_str"), F.max("b").alias("chainage_end"),
                  line_agg("b", "geom_lon", "geom_lat").alias("line")))


def gap_at_seam(gps_lost: DataFrame, data: DataFrame, extent=None) -> DataFrame:
    """RPT-7: gap windows holding a single valid chainage (nothing to interpolate)."""
    w = gap_windows(gps_lost, data, extent)
    return (w.where(F.col("chainage_end") - F.col("chainage_str") == 0)
             .select(RUN, "gps_lost_ch", "link_id", "chainage_str", "chainage_end")
             .orderBy(RUN, "gps_lost_ch"))


def gap_fixes(gps_lost: DataFrame, data: DataFrame, extent=None) -> DataFrame:
    """REP-4 core: fraction (lost - first anchor) / (last - first) along the window's
    anchor line; no correction for a zero span or a fraction outside [0, 1] (Q-16)."""
    w = gap_windows(gps_lost, data, extent)
    p2 = P.as_real(F.col("chainage_end") - F.col("chainage_str"))
    w = (w.where(p2 > 0)
          .withColumn("f", _real_fraction(F.col("gps_lost_ch") - F.col("chainage_str"),
                                          F.col("chainage_end") - F.col("chainage_str")))
          .where((F.col("f") >= 0) & (F.col("f") <= 1)))
    w = add_point_at(w, "line", "f", "pt")
    fixes = w.select(RUN, "date", "link_id", "gps_lost_ch", "c_p",
                     F.col("pt.lon").alias("new_lon"), F.col("pt.lat").alias("new_lat"))
    return _one_per_key(fixes, [RUN, "date", "link_id", "gps_lost_ch"], ["c_p", "new_lon", "new_lat"])


def _set_point():
    return {"lat": lambda g: P.as_real(g("new_lat")), "lon": lambda g: P.as_real(g("new_lon")),
            "geom_lon": lambda g: g("new_lon"), "geom_lat": lambda g: g("new_lat")}


def repair_gps_gaps(data: DataFrame, gps_lost: DataFrame, extent=None) -> DataFrame:
    """REP-4: lost 25 m stations take the point interpolated along their gap window."""
    fixes = gap_fixes(gps_lost, data, extent)
    return apply_corrections(data, fixes, {RUN: RUN, "date": "date", "link_id": "link_id",
                                           "chainage": "gps_lost_ch"}, _set_point(),
                             among=P.on_grid("chainage"))


# --------------------------------------------------------------------- unfreeze
def frozen_fixes(data: DataFrame) -> DataFrame:
    """REP-5 core. A coordinate repeated on >= 2 grid stations of any link is frozen.
    Grid stations of lost-status links sitting on a frozen coordinate are grouped by
    (run, link, coordinate) -- WIN-3's dense_rank over the geometry is only a group id, so the
    coordinate itself is the key; the group is re-placed on the line between the stations
    25 m before its first and after its last member. Fewer than two anchors -> none."""
    grid = data.where(P.on_grid("chainage") & P.gps_present())
    # AGG-6: coordinates repeated on >= 2 grid stations of a link
    frozen = (grid.groupBy(RUN, "link_id", "geom_lon", "geom_lat").agg(F.count(F.lit(1)).alias("n"))
                  .where(F.col("n") > 1).select(RUN, "geom_lon", "geom_lat").distinct())
    # JN-11: geometry equi-join (as a semi join on the coordinate)
    members = (grid.where(F.col("status") == K.STATUS_LOST)
                   .join(growing(frozen), [RUN, "geom_lon", "geom_lat"], "left_semi")
                   .select(RUN, "link_id", "chainage", "geom_lon", "geom_lat").distinct())
    groups = (members.groupBy(RUN, "link_id", "geom_lon", "geom_lat")
                     .agg((F.min("chainage") - K.REPORT_INTERVAL_M).alias("min_c"),
                          (F.max("chainage") + K.REPORT_INTERVAL_M).alias("max_c")))
    # JN-10: "min_c = chainage OR max_c = chainage" as explode + equi-join; a grid step beside
    # a grid station is on the grid
    ends = groups.withColumn("at", F.explode(F.array("min_c", "max_c")))
    pts = data.where(P.on_grid("chainage")).select(F.col(RUN).alias("_r"), F.col("chainage").alias("_c"),
                      F.col("geom_lon").alias("_x"), F.col("geom_lat").alias("_y"))
    anchors = ends.join(growing(pts), (F.col(RUN) == F.col("_r")) & (F.col("at") == F.col("_c")))
    lines = (anchors.groupBy(RUN, "link_id", "geom_lon", "geom_lat", "min_c", "max_c")
                    .agg(line_agg("_c", "_x", "_y").alias("line"),
                         F.countDistinct("_c").alias("n_anchor"))
                    .where(F.col("n_anchor") == 2))
    # JN-19: members x anchor lines as an equi-join on the group key
    m = members.join(growing(lines), [RUN, "link_id", "geom_lon", "geom_lat"])
    p1 = P.as_real(F.col("chainage") - F.col("min_c"))
    p2 = P.as_real(F.col("max_c") - F.col("min_c"))
    m = m.where((p1 > 0) & (p1 < p2)).withColumn("f", P.as_real(p1 / p2))
    m = add_point_at(m, "line", "f", "pt")
    fixes = m.select(RUN, "link_id", "chainage", F.col("pt.lon").alias("new_lon"),
                     F.col("pt.lat").alias("new_lat"))
    return _one_per_key(fixes, [RUN, "link_id", "chainage"], ["new_lon", "new_lat"])


def repair_gps_frozen(data: DataFrame) -> DataFrame:
    """REP-5: frozen grid stations of lost-status links are re-placed by interpolation."""
    fixes = frozen_fixes(data)
    return apply_corrections(data, fixes, {RUN: RUN, "link_id": "link_id", "chainage": "chainage"},
                             _set_point(), among=P.on_grid("chainage"))


# ------------------------------------------------------- link-level event repair
LINK_COORDS = ["lat_str", "lat_end", "lon_str", "lon_end"]


def link_table(data: DataFrame, key_cols: Sequence[str]) -> DataFrame:
    """Distinct link rows of the station table (key columns + run + date), with the
    original keyed coordinates kept as ``_o_*`` so stations can be re-attached."""
    cols = list(dict.fromkeys([*key_cols, RUN, "date"]))
    links = data.select(*cols).distinct()
    for c in LINK_COORDS:
        links = links.withColumn(f"_o_{c}", F.col(c))
    return links


def attach_link_coords(data: DataFrame, links: DataFrame) -> DataFrame:
    """Write repaired keyed coordinates back to every station of the link: a left
    join with the *changed* links only (null-safe on the original key columns), so
    the correction side is small. The rows meet by a hash of those columns, as all
    stations of a link are equal in them: sorting by the columns themselves would compare
    every one of them for each pair."""
    ident = [c for c in links.columns if not c.startswith("_o_") and c not in LINK_COORDS]
    changed = None
    for c in LINK_COORDS:
        e = ~F.col(c).eqNullSafe(F.col(f"_o_{c}"))
        changed = e if changed is None else changed | e
    l = links.where(changed).select(
        *[F.col(c).alias(f"_l_{c}") for c in ident],
        *[F.col(f"_o_{c}").alias(f"_l_o_{c}") for c in LINK_COORDS],
        *[F.col(c).alias(f"_l_n_{c}") for c in LINK_COORDS], F.lit(True).alias("_l_hit"))
    cond = None
    for c in ident:
        e = F.col(c).eqNullSafe(F.col(f"_l_{c}"))
        cond = e if cond is None else cond & e
    for c in LINK_COORDS:
        cond = cond & F.col(c).eqNullSafe(F.col(f"_l_o_{c}"))
    l = l.withColumn("_l_h", F.xxhash64(*(f"_l_{c}" for c in ident), *(f"_l_o_{c}" for c in LINK_COORDS)))
    by_hash = F.xxhash64(*ident, *LINK_COORDS) == F.col("_l_h")
    j = data.join(growing(l), by_hash & cond, "left")
    hit = F.col("_l_hit").isNotNull()
    return j.select(*[F.when(hit, F.col(f"_l_n_{c}")).otherwise(F.col(c)).alias(c)
                      if c in LINK_COORDS else F.col(c) for c in data.columns])
