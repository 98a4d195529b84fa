"""Deliverable tables: survey lines, 25 m survey points, image tables.

TAB-2 ``survey``, TAB-3 ``survey_point_local``, TAB-4 ``survey_point``,
TAB-5 ``survey_image``, TAB-6 ``pave_table`` (data_pave_suvey), TAB-7
``survey_pave``; REP-8/9 pavement GPS repairs; REP-10 duplicate image names;
SNK-4/5 folder lists and copy manifests.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pavespark import constants as K
from pavespark.functions import codes as C
from pavespark.functions import predicates as P
from pavespark.functions.measures import MEASURES
from pavespark.operators.geometry import length_km, line_agg
from pavespark.operators.joins import range_join
from pavespark.operators.linear import gap_rows, lost_islands
from pavespark.operators.lines import points_on_lines
from pavespark.operators.repair import _one_per_key, _real_fraction, apply_corrections
from pavespark.operators.windows import null_safe_join, global_row_number, ordered_index
from pavespark.session import growing, materialize

RUN = "file_name"
SURVEY_GROUP = ["event_name", "link_id", "ramp_id", "section_id", "km_start", "km_end", "length",
                "lane_no", "date", RUN]


def _asc(*cols) -> list[Column]:
    return [F.col(c).asc_nulls_last() for c in cols]


# ------------------------------------------------------------------------ survey
def survey_points(data: DataFrame) -> DataFrame:
    """SET-2 + SET-3: link start/end points and present grid stations inside the link."""
    s = data.select(F.col("event_str").alias("chainage"), *SURVEY_GROUP,
                    F.col("lon_str").alias("x"), F.col("lat_str").alias("y"))
    e = data.select(F.col("event_end").alias("chainage"), *SURVEY_GROUP,
                    F.col("lon_end").alias("x"), F.col("lat_end").alias("y"))
    st = (data.where(F.col("chainage").between(F.col("event_str"), F.col("event_end"))
                     & ((F.col("geom_lon") > 0) | (F.col("geom_lat") > 0))
                     & P.on_grid("chainage"))
              .select("chainage", *SURVEY_GROUP, F.col("geom_lon").alias("x"),
                      F.col("geom_lat").alias("y")))
    return s.unionByName(e).unionByName(st).distinct()


def survey(data: DataFrame, run_new: str = K.SURVEY_RUN_NEW) -> DataFrame:
    """TAB-2: one row per surveyed link of a run, with codes, km, length and its line."""
    # FIL-8: no construction link, positive length (NULL link ids drop out as in SQL)
    pts = survey_points(data).where(
        (F.col("link_id") != K.CONSTRUCTION_LINK)
        & (P.as_real(F.regexp_replace("length", " ", "").try_cast("float")) > 0))
    g = (pts.groupBy(*SURVEY_GROUP)
            .agg(F.min("chainage").alias("chainage_str"), F.max("chainage").alias("chainage_end"),
                 line_agg("chainage", "x", "y").alias("the_geom")))
    km_s, km_e = P.km_int("km_start"), P.km_int("km_end")
    g = g.select(
        "chainage_str", "chainage_end", "event_name", "link_id", "ramp_id",
        F.col("section_id").try_cast("int").alias("section_id"),
        km_s.alias("km_start"), km_e.alias("km_end"),
        C.lane_no_full().alias("lane_no_full"), "date", "the_geom", RUN,
        F.col("length").alias("_length_raw"), F.col("lane_no").alias("_lane_no_raw"))
    # every group column takes part in the order, so ids never depend on arrival order
    order = [P.pg_int("chainage_str").asc_nulls_last()] + _asc(
        "link_id", RUN, "event_name", "ramp_id", "section_id", "km_start", "km_end",
        "lane_no_full", "date", "_length_raw", "_lane_no_raw")
    g = global_row_number(g, order, "survey_id", start=2)  # WIN-4
    dist = length_km("the_geom")
    return g.select(
        "survey_id", F.lit(None).cast("int").alias("subsection_id"), "section_id", "link_id",
        "event_name", "ramp_id", C.survey_code().alias("survey_code"), C.run_code().alias("run_code"),
        C.lane_group("link_id", K.SURVEY_MAX_LANE_GROUP).alias("lane_group"),
        C.lane_no_int("lane_no_full").alias("lane_no"),
        F.lit(None).cast("int").alias("lane_reverse"), RUN, "km_start", "km_end",
        C.side_length("link_id", F.col("km_start"), F.col("km_end")).alias("length"),
        dist.alias("distance_odo"), dist.alias("distance_gps"),
        F.year("date").alias("year"), C.survey_type().alias("survey_type"), "date", "the_geom",
        F.lit(K.SURVEY_REMARK).alias("remark"), F.lit(run_new).alias("run_new"),
        F.lit(K.REPORT_INTERVAL_M).alias("interval"), "chainage_str", "chainage_end")


def line_text(line: str = "the_geom") -> Column:
    """Line as text (6 decimals, rounded half away from zero first, so the text never
    depends on the formatter's own tie rule) for reports and comparisons."""
    pts = F.transform(F.col(line), lambda p: F.format_string("%.6f %.6f", F.round(p["lon"], 6),
                                                             F.round(p["lat"], 6)))
    return F.concat(F.lit("LINESTRING("), F.array_join(pts, ","), F.lit(")"))


# ------------------------------------------------------------ survey_point_local
def _avg_measures(prefix: str = "") -> list[Column]:
    """AGG-7: ``avg(x::real)::numeric(8,2)`` of the nine measures."""
    return [F.avg(F.col(f"{prefix}{m}").cast("float")).cast("decimal(8,2)").alias(m)
            for m in MEASURES]


def point_branch_start(data: DataFrame) -> DataFrame:
    """TAB-3 branch A: off-grid link starts take the mean of the station(s) mapped to them."""
    even = (data.where(P.pg_int("event_str") != P.pg_int("chainage"))
                .select(F.col("event_str").alias("chainage"), "link_id", "date", "ramp_id",
                        F.col("lon_str").alias("lon"), F.col("lat_str").alias("lat"), RUN)
                .distinct())
    c, es, ee = F.col("chainage"), F.col("event_str"), F.col("event_end")
    # the first bound of the link that is less than 5 m behind the station
    mapped = F.get(F.filter(F.array(es, ee), lambda bound: c - bound < 5), F.lit(0))
    b = (data.where(es.between(c - 6, c + 6) | ee.between(c - 4, c + 4))
             .select(c.alias("b_ch"), mapped.alias("chainages"), F.col("link_id").alias("b_link"),
                     F.col("date").alias("b_date"), F.col(RUN).alias("b_run"),
                     *[F.col(m).alias(f"b_{m}") for m in MEASURES]))
    # JN-13: event-start neighbourhood join
    j = even.join(growing(b), (F.col("chainage") == F.col("chainages")) & (F.col(RUN) == F.col("b_run"))
                  & (F.col("link_id") == F.col("b_link")) & (F.col("date") == F.col("b_date"))
                  & (P.pg_int("chainage") != P.pg_int("b_ch")))
    return j.groupBy("chainage", "link_id", "date", "lon", "lat", RUN, "ramp_id").agg(
        *_avg_measures("b_"))


def point_branch_grid(data: DataFrame, laser: DataFrame) -> DataFrame:
    """TAB-3 branch B: 25 m grid stations take the mean of the *next* 5 m station's
    measures (in-link smoothed rows, or raw laser rows just past the link end)."""
    inlink = data.where(F.col("chainage").between(F.col("event_str"), F.col("event_end")))
    # only grid stations are kept at the end, so only stations next to one are looked at
    after_grid = P.on_grid_suffix(F.col("chainage") - 5)
    a = inlink.select("chainage", "event_str", "event_end", "link_id", "date", RUN)
    b_in = inlink.select(RUN, "chainage", *[F.col(m).cast("double").alias(m) for m in MEASURES],
                         "ramp_id")
    raw = laser.select(F.col(RUN).alias("_lr"), F.col("chainage").alias("_lc"),
                       *[F.col(m).alias(f"_l_{m}") for m in MEASURES])
    # only a link's last stations can have a next station beyond its end
    # (next = chainage + 5 > event_end); filtering first keeps the join small
    tail = data.where(F.col("chainage") + 5 > F.col("event_end"))
    ahead = (tail.join(growing(raw), (F.col(RUN) == F.col("_lr"))
                       & (F.col("chainage") == F.col("_lc") - 5))
                 .where(F.col("_lc") > F.col("event_end"))
                 .select(RUN, F.col("_lc").alias("chainage"),
                         *[F.col(f"_l_{m}").cast("double").alias(m) for m in MEASURES],
                         "ramp_id"))
    b = b_in.unionByName(ahead).where(after_grid).distinct()  # SET-4
    b = b.select(F.col(RUN).alias("_br"), F.col("chainage").alias("_bc"),
                 *[F.col(m).alias(f"b_{m}") for m in MEASURES])
    # JN-12: the next 5 m station's measures
    j = a.join(growing(b), (F.col(RUN) == F.col("_br")) & (F.col("chainage") == F.col("_bc") - 5), "left")
    g = (j.groupBy("chainage", "link_id", "date", RUN).agg(*_avg_measures("b_"))
          .where(P.on_grid_suffix("chainage")))
    geo = data.where(P.on_grid_suffix("chainage")).select(
                      F.col(RUN).alias("_gr"), F.col("chainage").alias("_gc"),
                      F.col("geom_lon").alias("lon"), F.col("geom_lat").alias("lat"),
                      F.col("ramp_id"))
    # JN-14: geometry (and ramp id) of the grid point from the station rows at that chainage
    out = g.join(growing(geo), (F.col(RUN) == F.col("_gr")) & (F.col("chainage") == F.col("_gc")))
    return (out.where(F.col("lon").isNotNull() & F.col("lat").isNotNull())
               .select("chainage", "link_id", "date", "lon", "lat", RUN, "ramp_id", *MEASURES))


POINT_TIES = ["survey_id", "lon", "lat", "ramp_id", *MEASURES]


def survey_point_local(data: DataFrame, laser: DataFrame, survey_df: DataFrame) -> DataFrame:
    """TAB-3: start points (branch A) and grid points (branch B), ids and km."""
    # SET-5: start points (branch A) union grid points (branch B)
    pts = point_branch_start(data).unionByName(point_branch_grid(data, laser)).distinct()
    s = survey_df.select(RUN, "link_id", "survey_id", "survey_code", "run_code", "lane_group",
                         F.col("km_start").alias("s_km_start"))
    # the points feed two row indexes and the global numbering (each reads its input
    # twice): write them once instead of recomputing both branches every time
    j = materialize(pts.join(growing(s), [RUN, "link_id"], "left"))  # JN-15
    order = _asc("chainage", *POINT_TIES)
    chunk = F.coalesce(F.floor(F.col("chainage") / 10000), F.lit(1 << 40))
    j = ordered_index(j, [RUN, "date", "link_id"], order, name="order_row", chunk=chunk)
    j = ordered_index(j, [RUN, "date", "survey_id", "link_id"], order, name="_pos", chunk=chunk)
    # WIN-6: order_row and km = km_start +- 25 * (row number - 1) by lane-group sign
    step = F.col("_pos") * K.REPORT_INTERVAL_M
    km = (F.when(F.col("lane_group") > 0, step + F.col("s_km_start"))
           .when(F.col("lane_group") < 0, F.col("s_km_start") - step))
    j = j.withColumn("km", km).where(F.col("link_id") != K.CONSTRUCTION_LINK)
    gorder = [P.pg_int("km").asc_nulls_last()] + _asc(RUN, "link_id", "chainage", "date",
                                                      *POINT_TIES)
    j = global_row_number(j, gorder, "survey_point_id", start=2)  # WIN-5
    return j.select("survey_point_id", "order_row", "km", "chainage", "link_id", "date",
                    "lon", "lat", RUN, "ramp_id", *MEASURES, "survey_id", "survey_code",
                    "run_code")


def survey_point(points: DataFrame) -> DataFrame:
    """TAB-4: published survey points."""
    return points.select("survey_point_id", "survey_id", "km", *MEASURES, "lon", "lat",
                         C.remark_year("link_id", "date").alias("remark"), RUN)


# ------------------------------------------------------------------ survey_image
def survey_image(points: DataFrame, data: DataFrame) -> DataFrame:
    """TAB-5: one right-of-way image per survey point (next 5 m station's picture)."""
    pics = (data.where(F.col("chainage_pic").isNotNull())
                .select(F.col(RUN).alias("_pr"), P.pg_int("chainage_pic").alias("_pk"),
                        "frame_number").distinct())
    key = C.next_station_5m(P.pg_int("chainage"))
    # JN-16: image-to-point join on the next 5 m station (PRJ-11)
    j = points.join(growing(pics), (F.col(RUN) == F.col("_pr")) & (key == F.col("_pk")), "left")
    fname = F.concat(F.col(RUN), F.lit(K.IMAGE_ROW_TAG), C.frame_text("frame_number"),
                     F.lit(K.IMAGE_EXT))
    j = j.select("survey_point_id", "survey_id", "km", "link_id", "chainage", RUN, "frame_number",
                 "date", "survey_code", "run_code", fname.alias("filename"), "lon", "lat").distinct()
    # PRJ-10: image directory (NULL-propagating concatenation, as ||)
    directory = F.concat(F.lit(K.IMAGE_DIR_PREFIX), F.left("link_id", F.lit(3)), F.lit("/"),
                         F.col("date").cast("string"), F.lit("/"), F.col("survey_code"),
                         F.lit("/Run"), F.col("run_code"), F.lit("/image/"), F.col("filename"))
    return j.select(directory.alias("directory"), "filename", "date",
                    F.col("chainage").alias("img_id"), "km",
                    F.lit(K.IMAGE_PATH_FLAG).alias("imagepath"), "lon", "lat", "survey_id",
                    F.lit(K.IMAGE_REMARK).alias("remark"), RUN, "link_id")


def image_duplicates(images: DataFrame) -> DataFrame:
    """RPT-10 / AGG-9: file names used more than once, and missing file names."""
    return (images.groupBy(RUN, "filename").agg(F.count("filename").alias("cc"))
                  .where((F.col("cc") > 1) | F.col("filename").isNull()))


def repair_image_names(images: DataFrame) -> DataFrame:
    """REP-10: of two duplicated file names less than 25 m apart, the later image's
    last frame digit 0 -> 3 and 5 -> 7 (other digits: unchanged)."""
    dup = image_duplicates(images).where(F.col("cc") > 1).select(RUN, "filename")
    d = images.join(growing(dup), [RUN, "filename"], "left_semi")
    order = _asc("img_id", "link_id", "survey_id", "filename", "directory")
    d = materialize(ordered_index(d, [RUN], order, name="_i",
                                  chunk=F.coalesce(F.floor(F.col("img_id") / 10000), F.lit(1 << 40))))
    # WIN-8: lag(img_id) as a join with the previous position
    prev = d.select(F.col(RUN).alias("_pr"), (F.col("_i") + 1).alias("_pi"),
                    F.col("img_id").alias("img_bf"))
    d = d.join(growing(prev), (F.col(RUN) == F.col("_pr")) & (F.col("_i") == F.col("_pi")))
    d = d.where(F.col("img_id") - F.col("img_bf") < K.REPORT_INTERVAL_M)
    digit = F.substring(F.reverse(F.col("filename")), 5, 1).try_cast("int")
    new_digit = F.when(digit == 0, F.lit(K.IMAGE_RENAME_DIGITS[0])).when(
        digit == 5, F.lit(K.IMAGE_RENAME_DIGITS[5]))
    tag = "-0-"
    head = F.split_part(F.col("filename"), F.lit(tag), F.lit(1))
    num = F.substring(F.split_part(F.col("filename"), F.lit(tag), F.lit(2)), 1, 4)
    new_name = F.concat(head, F.lit(tag), num, new_digit, F.lit(K.IMAGE_EXT))
    new_dir = F.concat(F.split_part(F.col("directory"), F.lit("image/"), F.lit(1)),
                       F.lit("image/"), new_name)
    fixes = (d.where(new_digit.isNotNull())
              .select(RUN, "link_id", "img_id", new_dir.alias("new_directory"),
                      new_name.alias("new_filename")))
    fixes = _one_per_key(fixes, [RUN, "link_id", "img_id"], ["new_filename", "new_directory"])
    return apply_corrections(images, fixes, {RUN: RUN, "link_id": "link_id", "img_id": "img_id"},
                             {"directory": lambda g: g("new_directory"),
                              "filename": lambda g: g("new_filename")})


def _win_path(directory: Column) -> Column:
    return F.split_part(F.replace(directory, F.lit("/"), F.lit("\\")), F.lit("\\image"), F.lit(1))


def image_folders(images: DataFrame, pave: DataFrame) -> DataFrame:
    """SNK-4: distinct target folders to create (right-of-way and pavement images)."""
    row = images.select(F.lit("row").alias("kind"), F.lit("mkdir").alias("test"),
                        F.concat(F.lit(K.ROW_TARGET_ROOT), _win_path(F.col("directory")),
                                 F.lit("\\image")).alias("folder"))
    pv = pave.select(F.lit("pave").alias("kind"), F.lit("mkdir").alias("test"),
                     F.concat(F.lit(K.PAVE_TARGET_ROOT), _win_path(F.col("directory")),
                              F.lit("\\image")).alias("folder"))
    return row.unionByName(pv).distinct()


def image_copy_manifest(images: DataFrame, pave: DataFrame) -> DataFrame:
    """SNK-5: source image path -> target path, for both cameras."""
    def part(df, kind, root):
        src = F.concat(F.lit(K.SOURCE_ROOT), F.left("filename", F.lit(8)), F.lit("\\"),
                       F.left("filename", F.lit(8)), F.lit("\\ROW-0\\"), F.col("filename"))
        dst = F.concat(F.lit(root), _win_path(F.col("directory")), F.lit("\\image"),
                       F.col("filename"))
        return df.select(F.lit(kind).alias("kind"), F.lit("copy").alias("test"),
                         src.alias("source"), dst.alias("target"), "filename")
    return part(images, "row", K.ROW_TARGET_ROOT).unionByName(part(pave, "pave", K.PAVE_TARGET_ROOT))


# ------------------------------------------------------------------- pavement
def pave_table(data: DataFrame, pave: DataFrame, survey_df: DataFrame,
               extent: DataFrame | None = None) -> DataFrame:
    """TAB-6 data_pave_suvey: pavement images inside each link (unrounded bounds) + survey."""
    ev = data.select("event_str", "event_end", "event_name", "link_id",
                     F.col("date").alias("survey_date"), "lat_str", "lat_end", "lon_str",
                     "lon_end", RUN).distinct()
    pv = pave.select(RUN, "chainage_pic", "frame_number", "lon", "lat")
    # images are the many side: attach each image to the intervals containing it,
    # then add back the intervals without any image (left-join semantics)
    # JN-17: image chainage inside the (unrounded) link bounds
    jj = range_join(pv, ev, "chainage_pic", F.col("event_str"), F.col("event_end"), keys=[RUN],
                    extent=extent)
    ev_keys = [RUN, "event_str", "event_end", "event_name", "link_id", "survey_date",
               "lat_str", "lat_end", "lon_str", "lon_end"]
    seen = jj.select(*[F.col(k).alias(f"_s_{k}") for k in ev_keys]).distinct()
    cond = None
    for k in ev_keys:  # null-safe: a link with a NULL date or name is still one interval
        e = F.col(k).eqNullSafe(F.col(f"_s_{k}"))
        cond = e if cond is None else cond & e
    unmatched = ev.join(growing(seen), cond, "left_anti")
    for cname in ["chainage_pic", "frame_number", "lon", "lat"]:
        unmatched = unmatched.withColumn(cname, F.lit(None).cast(pv.schema[cname].dataType))
    a = jj.unionByName(unmatched.select(*jj.columns))
    s = survey_df.select(RUN, "link_id", F.col("date").alias("survey_date"), "survey_id",
                         "lane_group", "lane_no", F.col("date").alias("date"), "km_start",
                         "km_end", "run_code", "survey_code")
    out = a.join(growing(s), [RUN, "link_id", "survey_date"], "left")  # JN-15
    return out.select(
        "survey_id", P.pg_int("chainage_pic").alias("chainage_pic"), "event_str", "event_end",
        "link_id", "frame_number", "lane_group", "lane_no", "lon", "lat", "date",
        P.as_real("lon").alias("geom_lon"), P.as_real("lat").alias("geom_lat"),
        "lat_str", "lat_end", "lon_str", "lon_end", "km_start", "km_end",
        F.col(RUN).alias("filename"), "run_code", "survey_code", RUN)


PAVE_TIES = ("survey_id", "event_str", "frame_number")


def pave_gps_lost(pave_df: DataFrame, extent=None) -> DataFrame:
    """REP-7: islands of lost pavement-image GPS, window +-3 m, no grid filter."""
    d = pave_df.where(F.col("chainage_pic").isNotNull())
    islands = lost_islands(d, "chainage_pic", PAVE_TIES, K.PAVE_SPACING_M)
    targets = d.where(P.gps_lost())
    return gap_rows(islands, targets, "chainage_pic", K.PAVE_GAP_MARGIN_M, extent=extent)


ISLAND = [RUN, "link_id", "date", "grp2", "min", "max"]


def _per_island(lost: DataFrame, images: DataFrame, extent=None) -> DataFrame:
    """``images`` (RUN, b, ...) inside each island's window: one interval per island, so the
    join is linear in gap length."""
    islands = lost.select(*ISLAND, "new_p_min", "new_p_max").distinct()
    return range_join(images, islands, "b", F.col("new_p_min"), F.col("new_p_max"), keys=[RUN],
                      extent=extent).drop("new_p_min", "new_p_max")


def pave_gap_fixes_window(pave_df: DataFrame, lost: DataFrame, extent=None) -> DataFrame:
    """REP-8, ``mode="window"``: interpolate along the island window's own images with valid
    GPS, like the station gap fill (fraction of the valid images' span)."""
    b = (pave_df.where(F.col("chainage_pic").isNotNull() & P.gps_valid())
                .select(RUN, F.col("chainage_pic").alias("b"), "geom_lon", "geom_lat"))
    lines = materialize(_per_island(lost, b, extent).groupBy(*ISLAND).agg(
        F.min("b").alias("chainage_str"), F.max("b").alias("chainage_end"),
        line_agg("b", "geom_lon", "geom_lat").alias("line")))
    span = P.as_real(F.col("chainage_end") - F.col("chainage_str"))
    a = lost.select(*ISLAND, F.col("chainage_pic").alias("gps_lost_ch"), "c_p")
    g = null_safe_join(a, lines.drop("line").where(span > 0), ISLAND)
    g = (g.withColumn("f", _real_fraction(F.col("gps_lost_ch") - F.col("chainage_str"),
                                          F.col("chainage_end") - F.col("chainage_str")))
          .where((F.col("f") >= 0) & (F.col("f") <= 1)))
    g = points_on_lines(g, lines.where(span > 0).select(*ISLAND, "line"), ISLAND, "f", line="line")
    fixes = g.select(RUN, "date", "link_id", "gps_lost_ch", "c_p",
                     F.col("pt.lon").alias("new_lon"), F.col("pt.lat").alias("new_lat"))
    return _one_per_key(fixes, [RUN, "date", "link_id", "gps_lost_ch"], ["c_p", "new_lon", "new_lat"])


def pave_gap_fixes(pave_df: DataFrame, lost: DataFrame, survey_df: DataFrame,
                   extent=None) -> DataFrame:
    """REP-8: fraction inside the gap window (all images of the window), applied to the
    survey line of the window images' link (Q-18 reference mode)."""
    b = pave_df.where(F.col("survey_id").isNotNull()).select(
        RUN, F.col("chainage_pic").alias("b"), F.col("survey_id").alias("b_survey"))
    # window images per island, reduced to min/max per island and survey, then attached to the
    # island's lost images
    per_island = (_per_island(lost, b, extent).groupBy(*ISLAND, "b_survey")
                  .agg(F.min("b").alias("_bmin"), F.max("b").alias("_bmax")))
    a = lost.select(*ISLAND, F.col("chainage_pic").alias("gps_lost_ch"), "c_p", "meter")
    j = null_safe_join(a, per_island, ISLAND)  # images without a survey have a NULL date
    g = (j.groupBy(RUN, "gps_lost_ch", "c_p", "meter", "link_id", "date", "b_survey")
          .agg(F.min("_bmin").alias("chainage_str"), F.max("_bmax").alias("chainage_end")))
    p2 = P.as_real(F.col("chainage_end") - F.col("chainage_str"))
    g = (g.where(p2 > 0)
          .withColumn("f", _real_fraction(F.col("gps_lost_ch") - F.col("chainage_str"),
                                          F.col("chainage_end") - F.col("chainage_str"))))
    links = survey_df.select(F.col("survey_id").alias("b_survey"), F.col("link_id").alias("s_link"))
    g = g.join(growing(links), "b_survey").where((F.col("f") >= 0) & (F.col("f") <= 1))
    g = points_on_lines(g, survey_df.select(F.col("survey_id").alias("b_survey"), "the_geom"),
                        ["b_survey"], "f")
    fixes = g.select(RUN, "date", "link_id", "gps_lost_ch",
                     (F.col("s_link") != F.col("link_id")).alias("other_link"), "b_survey", "c_p",
                     F.col("pt.lon").alias("new_lon"), F.col("pt.lat").alias("new_lat"))
    return _one_per_key(fixes, [RUN, "date", "link_id", "gps_lost_ch"],
                        ["other_link", "b_survey", "c_p", "new_lon", "new_lat"])


def _set_pave_point():
    return {"lat": lambda g: g("new_lat"), "lon": lambda g: g("new_lon"),
            "geom_lon": lambda g: g("new_lon"), "geom_lat": lambda g: g("new_lat")}


def repair_pave_gaps(pave_df: DataFrame, lost: DataFrame, survey_df: DataFrame,
                     extent=None, mode: str = "reference") -> DataFrame:
    """REP-8. ``mode="reference"``: window fraction on the link's survey line (as the
    reference); ``mode="window"``: along the window's own valid images."""
    if mode == "window":
        fixes = pave_gap_fixes_window(pave_df, lost, extent)
    else:
        fixes = pave_gap_fixes(pave_df, lost, survey_df, extent)
    return apply_corrections(pave_df, fixes, {RUN: RUN, "date": "date", "link_id": "link_id",
                                              "chainage_pic": "gps_lost_ch"}, _set_pave_point())


def pave_frozen_fixes(pave_df: DataFrame, survey_df: DataFrame) -> DataFrame:
    """REP-9: images on a repeated coordinate are placed on their link's survey line at
    (chainage_pic - event_str) / (event_end - event_str), strictly inside (0, 1)."""
    pres = pave_df.where(F.col("chainage_pic").isNotNull() & P.gps_present())
    frozen = (pres.groupBy(RUN, "link_id", "geom_lon", "geom_lat").agg(F.count(F.lit(1)).alias("n"))
                  .where(F.col("n") > 1).select(RUN, "geom_lon", "geom_lat").distinct())
    m = (pres.join(growing(frozen), [RUN, "geom_lon", "geom_lat"], "left_semi")
             .select(RUN, "link_id", "chainage_pic", "event_str", "event_end").distinct())
    j = m.join(growing(survey_df.select(RUN, "link_id", "survey_id")), [RUN, "link_id"])
    p1 = P.as_real(F.col("chainage_pic") - F.col("event_str"))
    p2 = P.as_real(F.col("event_end") - F.col("event_str"))
    j = j.withColumn("f", P.as_real(F.try_divide(p1, p2))).where((F.col("f") > 0) & (F.col("f") < 1))
    j = points_on_lines(j, survey_df.select("survey_id", "the_geom"), ["survey_id"], "f")
    fixes = j.select(RUN, "link_id", "event_str", "chainage_pic", "survey_id",
                     F.col("pt.lon").alias("new_lon"), F.col("pt.lat").alias("new_lat"))
    return _one_per_key(fixes, [RUN, "link_id", "event_str", "chainage_pic"],
                        ["survey_id", "new_lon", "new_lat"])


def repair_pave_frozen(pave_df: DataFrame, survey_df: DataFrame) -> DataFrame:
    fixes = pave_frozen_fixes(pave_df, survey_df)
    return apply_corrections(pave_df, fixes, {RUN: RUN, "link_id": "link_id", "event_str": "event_str",
                                              "chainage_pic": "chainage_pic"}, _set_pave_point())


def survey_pave(pave_df: DataFrame) -> DataFrame:
    """TAB-7: pavement image table."""
    fname = F.concat(F.col("filename"), F.lit(K.PAVE_TAG), C.pave_frame_text("frame_number"),
                     F.lit(K.IMAGE_EXT))
    d = pave_df.withColumn("image_name", fname)
    sub = F.replace(F.split_part(F.col("image_name"), F.lit(" "), F.lit(2)), F.lit(" "), F.lit(""))
    # PRJ-10: pavement directory
    directory = F.concat(F.lit(K.PAVE_DIR_PREFIX), F.left("link_id", F.lit(3)), F.lit("/"),
                         F.col("date").cast("string"), F.lit("/"), F.col("survey_code"),
                         F.lit("/Run"), F.col("run_code"), F.lit("/pavement"), sub, F.lit("/"),
                         F.col("image_name"))
    # PRJ-12: km = km_start -+ (chainage_pic - event_str::int) by lane-group sign, 0 -> NULL
    off = F.col("chainage_pic") - P.pg_int("event_str")
    km = (F.when(F.col("lane_group") < 0, F.col("km_start") - off)
           .when(F.col("lane_group") > 0, F.col("km_start") + off))
    return d.select(F.left(directory, F.lit(254)).alias("directory"),
                    F.left("image_name", F.lit(254)).alias("filename"),
                    F.lit(0).alias("image_place"), "date",
                    F.col("frame_number").try_cast("double").alias("img_id"),
                    km.cast("double").alias("km"), F.lit(K.PAVE_PATH_FLAG).alias("imagepath"),
                    F.col("geom_lon").alias("lon"), F.col("geom_lat").alias("lat"), "survey_id",
                    F.lit(K.PAVE_REMARK).alias("remark"), RUN, "link_id", "chainage_pic")
