"""

Each takes (spark, sf_dir), derives the survey inputs from the driver tables
of that directory and returns a DataFrame (no action is run on the result).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pavespark.functions import codes as C
from pavespark.functions import predicates as P
from pavespark.plans.stages import SurveyStages
from pavespark.session import materialize

QUERIES: dict = {}
FLAGSHIP = "survey_point"


def register(name):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


_STAGE_SETS: dict = {}


def _fingerprint(spark: SparkSession, sf_dir: str) -> tuple:
    """Names, sizes and times of the input files, as one row."""
    files = spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet").select(
        "_metadata.file_path", "_metadata.file_size", "_metadata.file_modification_time").distinct()
    return tuple(files.agg(F.count(F.lit(1)), F.sum("file_size"), F.max("file_modification_time"),
                           F.bit_xor(F.xxhash64("file_path"))).first())


def stages(spark: SparkSession, sf_dir: str, layout: str = "uniform", form: str = "run") -> SurveyStages:
    """One stage set per (application, input files, layout, form): stages already written
    by an earlier query of the same session are reused while the input files are the same."""
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), _fingerprint(spark, sf_dir), layout, form)
    if key not in _STAGE_SETS:
        if len(_STAGE_SETS) >= 4:
            _STAGE_SETS.pop(next(iter(_STAGE_SETS)))
        _STAGE_SETS[key] = SurveyStages.from_fixtures(spark, sf_dir, layout, form=form)
    return _STAGE_SETS[key]


# ----------------------------------------------------------------------- sources
@register("laser_extract")
def q_laser_extract(spark, sf_dir) -> DataFrame:
    return stages(spark, sf_dir).inputs.laser


@register("key_extract")
def q_key_extract(spark, sf_dir) -> DataFrame:
    return stages(spark, sf_dir).inputs.key


@register("pic_extract")
def q_pic_extract(spark, sf_dir) -> DataFrame:
    return stages(spark, sf_dir).inputs.pic


@register("pave_extract")
def q_pave_extract(spark, sf_dir) -> DataFrame:
    return stages(spark, sf_dir).inputs.pave


@register("interchange_roundtrip")
def q_interchange_roundtrip(spark, sf_dir) -> DataFrame:
    """SNK-2 + SRC-5: the station table written as header-less CSV (one folder per run)
    into a new folder below the cluster's checkpoint directory, read back with the
    fixed schema; runs come back from the folder names (partition discovery)."""
    import uuid

    from pavespark.session import ensure_checkpoint_dir
    from pavespark.sources import exported, schemas
    base = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{base}/pavespark-interchange-{uuid.uuid4().hex}/access_valuelaser"
    laser = stages(spark, sf_dir).laser
    exported.write_run_partitioned_csv(laser.select(*[f.name for f in schemas.LASER_CSV.fields]),
                                       path)
    return exported.loaded_laser(
        exported.read_run_partitioned_csv(spark, path, schemas.LASER_CSV))


def _scratch(spark, name: str) -> str:
    """A new folder below the cluster's checkpoint directory."""
    import uuid

    from pavespark.session import ensure_checkpoint_dir
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/pavespark-{name}-{uuid.uuid4().hex}"


_RAW_EXPORTS: dict = {}


def _raw_export(spark, sf_dir, extract: str) -> str:
    """The raw tables that ``extract`` is made of, of every run, written in the van's export
    layout (one export per session, input files and table)."""
    from pavespark.sources import fixtures, raw
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), _fingerprint(spark, sf_dir))
    root, done = _RAW_EXPORTS.setdefault(key, (_scratch(spark, "raw"), set()))
    for table in (t for t in raw.EXTRACTS[extract][0] if t not in done):
        raw.write_raw_tables(fixtures.raw_tables(spark, sf_dir), root, "20240101", tables=[table])
        done.add(table)
    return root


def _register_raw_extract(table: str):
    @register(f"raw_{table}_extract")
    def q_raw_extract(spark, sf_dir) -> DataFrame:
        """One of SRC-1..4, read back from the export."""
        from pavespark.sources import raw
        return raw.load_raw_extract(spark, _raw_export(spark, sf_dir, table), table)


for _table in ("laser", "key", "pic", "pave"):
    _register_raw_extract(_table)


@register("run_folder_discovery")
def q_run_folder_discovery(spark, sf_dir) -> DataFrame:
    """SRC-6: the station and picture files of every run of a dated folder, found in one scan
    each; the run comes from the path."""
    from pavespark.sources import exported, raw, schemas
    p = stages(spark, sf_dir)
    root = _scratch(spark, "runs")
    found = []
    for table, schema, df in (("access_valuelaser", schemas.LASER_CSV, p.laser),
                              ("access_pic", schemas.PIC_CSV, p.pic)):
        columns = [f.name for f in schema.fields]
        if table == exported.TABLE_FOLDERS["laser"]:  # the station files hold the run, too
            df = df.withColumn("held", F.col("file_name"))
            columns = [*columns[:-1], "held", "file_name"]
        raw.write_by_run(df.select(*columns), f"{root}/_{table}", lambda run, t=table:
                         f"{root}/survey_data/20240101/{run}_edit/{t}.csv", header=False)
        x = "chainage" if "chainage" in columns else "chainage_pic"
        rows = exported.read_run_folder(spark, root, table, schema)
        found.append(rows.groupBy("file_name").agg(
            F.lit(table).alias("table_name"), F.count(F.lit(1)).alias("n"),
            F.min(x).cast("double").alias("first"), F.max(x).cast("double").alias("last")))
    return found[0].unionByName(found[1])


# ------------------------------------------------------------------ projections
@register("iri_clamp")
def q_iri_clamp(spark, sf_dir) -> DataFrame:
    from pavespark.functions.measures import iri_clamp
    p = stages(spark, sf_dir)
    return iri_clamp(p.inputs.laser, p.draw).select(
        "file_name", "chainage", "iri_right", "iri_left", "iri_old", "iri")


@register("km_position")
def q_km_position(spark, sf_dir) -> DataFrame:
    return stages(spark, sf_dir).station_table.select("file_name", "link_id", "event_str",
                                                    "chainage", "km2")


def _key_links(p: SurveyStages) -> DataFrame:
    from pavespark.plans.station import pave_keys
    return pave_keys(p.inputs.key)


@register("lane_group")
def q_lane_group(spark, sf_dir) -> DataFrame:
    k = _key_links(stages(spark, sf_dir))
    return k.select("file_name", "link_id",
                    C.lane_group("link_id", 6).alias("lane_group_report"),
                    C.lane_group("link_id", 7).alias("lane_group")).distinct()


@register("survey_codes")
def q_survey_codes(spark, sf_dir) -> DataFrame:
    k = _key_links(stages(spark, sf_dir))
    ks, ke = P.km_int("km_start"), P.km_int("km_end")
    return k.select(
        "file_name", "link_id", "event_str",
        C.survey_code().alias("survey_code"), C.run_code().alias("run_code"),
        C.survey_type().alias("survey_type"), C.lane_no_full().alias("lane_no"),
        C.lane_no_int(C.lane_no_full()).alias("lane_no_int"),
        ks.alias("km_start"), ke.alias("km_end"),
        C.side_length("link_id", ks, ke).alias("length"))


# ------------------------------------------------------------------------ joins
@register("station_link_join")
def q_station_link_join(spark, sf_dir) -> DataFrame:
    from pavespark.plans.station import pave_keys, station_link_join
    p = stages(spark, sf_dir)
    j = station_link_join(p.laser, pave_keys(p.key), extent=p.extent)
    return j.select("file_name", "link_id", "event_str", "event_end", "chainage")


@register("gps_status")
def q_gps_status(spark, sf_dir) -> DataFrame:
    return stages(spark, sf_dir).gps_status


@register("station_table")
def q_station_table(spark, sf_dir) -> DataFrame:
    return stages(spark, sf_dir).station_table



# ---------------------------------------------------------------------- reports
def _reports():
    from pavespark.plans import reports as R
    return R


@register("report_zero_coords")
def q_report_zero_coords(spark, sf_dir) -> DataFrame:
    return _reports().zero_coords(stages(spark, sf_dir).inputs.key)


@register("report_duplicate_links")
def q_report_duplicate_links(spark, sf_dir) -> DataFrame:
    return _reports().duplicate_links(stages(spark, sf_dir).station_table)


@register("report_ramp_id")
def q_report_ramp_id(spark, sf_dir) -> DataFrame:
    return _reports().ramp_id_check(stages(spark, sf_dir).station_table)


@register("report_gps_lost")
def q_report_gps_lost(spark, sf_dir) -> DataFrame:
    return _reports().gps_lost_groups(stages(spark, sf_dir).station_table)


@register("report_gps_duplicates")
def q_report_gps_duplicates(spark, sf_dir) -> DataFrame:
    return _reports().gps_duplicates(stages(spark, sf_dir).station_table)


@register("report_missing_measures")
def q_report_missing_measures(spark, sf_dir) -> DataFrame:
    return _reports().missing_measures(stages(spark, sf_dir).station_table)


@register("report_lane_consistency")
def q_report_lane_consistency(spark, sf_dir) -> DataFrame:
    return _reports().lane_consistency(stages(spark, sf_dir).station_table)


# ------------------------------------------------------------------------ gaps
@register("gps_gaps")
def q_gps_gaps(spark, sf_dir) -> DataFrame:
    return stages(spark, sf_dir).gps_lost


# --------------------------------------------------------------------- geometry
def _rep():
    from pavespark.operators import repair as R
    return R


@register("event_points")
def q_event_points(spark, sf_dir) -> DataFrame:
    return _rep().event_points(stages(spark, sf_dir).station_table)


@register("event_near_station")
def q_event_near_station(spark, sf_dir) -> DataFrame:
    p = stages(spark, sf_dir)
    R = _rep()
    return R.event_near_station(R.event_points(p.station_table), p.station_groups,
                                p.keyed_stations)


@register("line_interpolate")
def q_line_interpolate(spark, sf_dir) -> DataFrame:
    """GEO-5 over whole tables: the point at 37 % of each link's line of present grid stations."""
    from pavespark.operators.geometry import line_agg
    from pavespark.operators.lines import points_on_lines
    d = stages(spark, sf_dir).station_table
    lines = materialize(d.where(P.on_grid("chainage") & P.gps_present())
                        .groupBy("file_name", "link_id", "event_str")
                        .agg(line_agg("chainage", "geom_lon", "geom_lat").alias("line")))
    keys = ["file_name", "link_id", "event_str"]
    found = points_on_lines(lines.select(*keys), lines, keys, F.lit(0.37), line="line")
    return found.select(*keys, F.col("pt.lon").alias("lon"), F.col("pt.lat").alias("lat"))


# ---------------------------------------------------------------------- repairs
def _keyed_coords(df: DataFrame, end: str) -> DataFrame:
    return df.select("file_name", "link_id", "event_str", "event_end", f"lat_{end}",
                     f"lon_{end}").distinct()


@register("repair_event_start")
def q_repair_event_start(spark, sf_dir) -> DataFrame:
    return _keyed_coords(stages(spark, sf_dir).events_start_fixed, "str")


@register("repair_event_end")
def q_repair_event_end(spark, sf_dir) -> DataFrame:
    return _keyed_coords(stages(spark, sf_dir).links_fixed, "end")


@register("report_event_mismatch")
def q_report_event_mismatch(spark, sf_dir) -> DataFrame:
    p = stages(spark, sf_dir)
    R = _rep()
    return R.event_mismatch(R.event_points(p.links_fixed), p.station_groups)


@register("gps_status_folder")
def q_gps_status_folder(spark, sf_dir) -> DataFrame:
    """AGG-1 in the folder form: only stations with a picture count."""
    return stages(spark, sf_dir, form="folder").gps_status


@register("station_table_folder")
def q_station_table_folder(spark, sf_dir) -> DataFrame:
    return stages(spark, sf_dir, form="folder").station_table


@register("report_event_mismatch_folder")
def q_report_event_mismatch_folder(spark, sf_dir) -> DataFrame:
    """RPT-6 in the folder form: keyed stations with a picture, 25 m positions only."""
    p = stages(spark, sf_dir, form="folder")
    R = _rep()
    return R.event_mismatch(R.event_points(p.links_fixed), p.station_groups, grid_only=True)


@register("survey_folder")
def q_survey_folder(spark, sf_dir) -> DataFrame:
    """TAB-2 over the folder form's stations, with its run name."""
    s = stages(spark, sf_dir, form="folder").survey
    return s.withColumn("the_geom", _dl().line_text("the_geom"))


@register("stage_roundtrip")
def q_stage_roundtrip(spark, sf_dir) -> DataFrame:
    """SNK-1: the station table written as Parquet by run and read back."""
    import uuid

    from pavespark.session import ensure_checkpoint_dir
    from pavespark.sources import exported
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/pavespark-stage-{uuid.uuid4().hex}"
    laser = stages(spark, sf_dir).laser
    exported.write_stage(laser, path)
    return spark.read.schema(laser.schema).parquet(path).select(*laser.columns)


@register("report_gap_at_seam")
def q_report_gap_at_seam(spark, sf_dir) -> DataFrame:
    p = stages(spark, sf_dir)
    return _rep().gap_at_seam(p.gps_lost, p.events_fixed, extent=p.extent)


def _station_points(df: DataFrame) -> DataFrame:
    return df.select("file_name", "link_id", "date", "event_str", "chainage", "lon", "lat",
                     "geom_lon", "geom_lat")


@register("repair_gps_gaps")
def q_repair_gps_gaps(spark, sf_dir) -> DataFrame:
    return _station_points(stages(spark, sf_dir).gaps_filled)


@register("repair_gps_frozen")
def q_repair_gps_frozen(spark, sf_dir) -> DataFrame:
    return _station_points(stages(spark, sf_dir).unfrozen)


# -------------------------------------------------------------------- smoothing
@register("smooth_measures")
def q_smooth_measures(spark, sf_dir) -> DataFrame:
    from pavespark.functions.measures import MEASURES
    return stages(spark, sf_dir).stations_final.select("file_name", "link_id", "event_str",
                                                     "chainage", *MEASURES)


# ------------------------------------------------------------------ deliverables
def _dl():
    from pavespark.plans import deliverables as D
    return D


@register("survey")
def q_survey(spark, sf_dir) -> DataFrame:
    s = stages(spark, sf_dir).survey
    return s.withColumn("the_geom", _dl().line_text("the_geom"))


@register("link_line")
def q_link_line(spark, sf_dir) -> DataFrame:
    s = stages(spark, sf_dir).survey
    return s.select("file_name", "survey_id", "link_id", "event_name",
                    F.posexplode("the_geom").alias("seq", "pt")).select(
        "file_name", "survey_id", "link_id", "event_name", "seq",
        F.col("pt.chainage").alias("chainage"), F.col("pt.lon").alias("lon"),
        F.col("pt.lat").alias("lat"))


@register("link_length")
def q_link_length(spark, sf_dir) -> DataFrame:
    return stages(spark, sf_dir).survey.select("file_name", "survey_id", "link_id", "event_name",
                                             "distance_gps")


@register("survey_point_local")
def q_survey_point_local(spark, sf_dir) -> DataFrame:
    return stages(spark, sf_dir).survey_point_local


@register("point_km")
def q_point_km(spark, sf_dir) -> DataFrame:
    return stages(spark, sf_dir).survey_point_local.select("file_name", "link_id", "survey_id",
                                                         "chainage", "order_row", "km")


@register("survey_point")
def q_survey_point(spark, sf_dir) -> DataFrame:
    return _dl().survey_point(stages(spark, sf_dir).survey_point_local)


@register("survey_image")
def q_survey_image(spark, sf_dir) -> DataFrame:
    return stages(spark, sf_dir).survey_image


@register("report_image_duplicates")
def q_report_image_duplicates(spark, sf_dir) -> DataFrame:
    return _dl().image_duplicates(stages(spark, sf_dir).survey_image)


@register("repair_image_names")
def q_repair_image_names(spark, sf_dir) -> DataFrame:
    return stages(spark, sf_dir).survey_image_fixed


@register("image_folders")
def q_image_folders(spark, sf_dir) -> DataFrame:
    p = stages(spark, sf_dir)
    return _dl().image_folders(p.survey_image_fixed, p.survey_pave)


@register("image_copy_manifest")
def q_image_copy_manifest(spark, sf_dir) -> DataFrame:
    p = stages(spark, sf_dir)
    return _dl().image_copy_manifest(p.survey_image_fixed, p.survey_pave)


# ---------------------------------------------------------------------- pavement
@register("pave_event_join")
def q_pave_event_join(spark, sf_dir) -> DataFrame:
    return stages(spark, sf_dir).pave_table.select("file_name", "link_id", "event_str", "event_end",
                                                 "chainage_pic", "frame_number")


@register("pave_table")
def q_pave_table(spark, sf_dir) -> DataFrame:
    return stages(spark, sf_dir).pave_table


@register("pave_gps_gaps")
def q_pave_gps_gaps(spark, sf_dir) -> DataFrame:
    return stages(spark, sf_dir).pave_gps_lost


def _pave_points(df: DataFrame) -> DataFrame:
    return df.select("file_name", "link_id", "event_str", "survey_id", "chainage_pic", "lon",
                     "lat", "geom_lon", "geom_lat")


@register("repair_pave_gaps")
def q_repair_pave_gaps(spark, sf_dir) -> DataFrame:
    return _pave_points(stages(spark, sf_dir).pave_gaps_filled)


@register("repair_pave_gaps_window")
def q_repair_pave_gaps_window(spark, sf_dir) -> DataFrame:
    """REP-8 along the window's own valid images (``mode="window"``)."""
    from pavespark.plans import deliverables as D
    p = stages(spark, sf_dir)
    return _pave_points(D.repair_pave_gaps(p.pave_table, p.pave_gps_lost, p.survey,
                                           extent=p.pave_extent, mode="window"))


@register("repair_pave_frozen")
def q_repair_pave_frozen(spark, sf_dir) -> DataFrame:
    return _pave_points(stages(spark, sf_dir).pave_final)


@register("survey_pave")
def q_survey_pave(spark, sf_dir) -> DataFrame:
    return stages(spark, sf_dir).survey_pave
