"""End-to-end survey stage chain: each stage table is built once, materialised
(as Parquet in the cluster's checkpoint folder) and reused by the
later stages, so every repair reads a written input instead of a growing
lineage, and a lost executor only recomputes from the last written stage.

Stage order (it is part of the semantics; each repair reads the previous one):

  inputs -> station_table -> links -> event start repair -> event end repair
         -> (stations with repaired keyed coordinates) -> gap fill -> unfreeze
         -> smoothing = stations_final
  stations_final -> survey -> survey_point_local -> survey_point, survey_image
                 -> image-name repair
  pave + survey  -> pave_table -> pave gap fill -> pave unfreeze -> survey_pave

SRT-3: ORDER BY inside ``create table ... as`` has no meaning for a set and is not
reproduced; stage tables are unordered (order only where a report asks for it).
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pavespark import constants as K
from pavespark.functions import predicates as P
from pavespark.functions.measures import default_draw
from pavespark.operators import repair as R
from pavespark.operators.joins import run_extent
from pavespark.operators.linear import gap_rows, lost_islands
from pavespark.operators.smoothing import smooth_measures
from pavespark.plans import deliverables as D
from pavespark.plans.lifecycle import METRICS, StageStore
from pavespark.plans import station as ST
from pavespark.session import materialize, plan_text
from pavespark.sources import fixtures
from pavespark.sources.fixtures import Inputs


FORMS = ("run", "folder")


class SurveyStages:
    # date and status tell apart the rows of a link with two survey dates
    STATION_TIES = ("event_str", "chainage_pic", "frame_number", "date", "status")

    def __init__(self, inputs: Inputs, draw=default_draw, checkpoint: bool = True,
                 record_plans: bool = False, pave_gap_mode: str = "reference", form: str = "run",
                 store: StageStore | None = None):
        """``draw``: stand-in for the IRI clamp's random draw (PRJ-1, Q-05);
        ``pave_gap_mode``: ``"reference"`` or ``"window"`` (REP-8, Q-18);
        ``checkpoint``: write each stage table (lineage cut). ``False`` keeps stages lazy,
        which is only for inspecting one stage: the whole chain as one plan re-expands every
        earlier stage per use and does not plan in bounded memory;
        ``form``: ``"run"``, or ``"folder"``, where only stations with a picture count for the
        GPS status and as keyed stations, and surveys carry the folder form's run name;
        ``store``: a folder of named stages with a manifest, from which a run that was stopped
        goes on (``lifecycle.StageStore``); else stages are unnamed scratch tables;
        ``record_plans``: keep each stage's physical plan text in ``self.plans``."""
        if form not in FORMS:
            raise ValueError(f"form must be one of {FORMS}")
        self.form = form
        if pave_gap_mode not in ("reference", "window"):
            raise ValueError("pave_gap_mode must be 'reference' or 'window'")
        self.inputs = inputs
        self.store = store
        self.draw = draw
        self.checkpoint = checkpoint
        self.pave_gap_mode = pave_gap_mode
        self.plans: list[str] | None = [] if record_plans else None

    @classmethod
    def from_fixtures(cls, spark: SparkSession, sf_dir: str, layout: str | None = None,
                      **kw) -> "SurveyStages":
        return cls(fixtures.load(spark, sf_dir, layout), **kw)

    def _stage(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        """The stage's table: from the store if an earlier run of it is complete there, else
        built and written. What the stage wrote on its way is removed once it is complete."""
        if not self.checkpoint:
            return self._planned(build())
        if self.store is None:
            return materialize(self._planned(build()))
        return self.store.stage(name, lambda: self._planned(build()), METRICS.get(name, {}))

    def _planned(self, df: DataFrame) -> DataFrame:
        if self.plans is not None:
            self.plans.append(plan_text(df, "simple"))
        return df

    # ------------------------------------------------------------------ inputs
    @cached_property
    def laser(self) -> DataFrame:
        return self._stage("laser", lambda: self.inputs.laser)

    @cached_property
    def key(self) -> DataFrame:
        return self._stage("key", lambda: self.inputs.key)

    @cached_property
    def pic(self) -> DataFrame:
        return self.inputs.pic

    @cached_property
    def pave(self) -> DataFrame:
        return self.inputs.pave

    @cached_property
    def extent(self) -> DataFrame:
        """Per-run chainage extent of the stations (clips intervals joined to stations)."""
        return run_extent(self.laser)

    @cached_property
    def pave_extent(self) -> DataFrame:
        """Per-run extent of the pavement images (clips intervals joined to images)."""
        return run_extent(self.pave, "chainage_pic")

    # ------------------------------------------------------------------ stations
    @cached_property
    def station_table(self) -> DataFrame:
        return self._stage("station_table", lambda: ST.station_table(self.laser, self.key, self.pic, self.draw,
                                            extent=self.extent,
                                            need_picture=self.form == "folder"))

    @cached_property
    def gps_status(self) -> DataFrame:
        return ST.gps_status(self.laser, self.pic, self.key, extent=self.extent,
                             need_picture=self.form == "folder")

    @cached_property
    def gps_lost(self) -> DataFrame:
        """REP-1: lost 25 m stations of lost-status links, with their island and window."""
        return self._stage("gps_lost", self._gps_lost)

    def _gps_lost(self) -> DataFrame:
        data = self.station_table
        islands = lost_islands(data, "chainage", self.STATION_TIES, K.STATION_SPACING_M)
        targets = data.where(P.on_grid("chainage") & P.gps_lost()
                             & (F.col("status") == K.STATUS_LOST))
        return gap_rows(islands, targets, "chainage", K.GAP_MARGIN_M, extent=self.extent)

    # ------------------------------------------------------------------ repairs
    @cached_property
    def keyed_stations(self) -> DataFrame:
        laser = self.laser
        if self.form == "folder":
            laser = ST.attach_pictures(laser, self.pic).where(F.col("chainage_pic").isNotNull())
        return R.keyed_stations(laser, self.key, extent=self.extent)

    @cached_property
    def station_groups(self) -> DataFrame:
        return self._stage("station_groups", lambda: R.station_groups(self.keyed_stations))

    @cached_property
    def links(self) -> DataFrame:
        """Distinct link rows of the station table (REP-2/3 work at this level)."""
        return self._stage("links", lambda: R.link_table(self.station_table, ST.KEY_COLS))

    @cached_property
    def links_start_fixed(self) -> DataFrame:
        """REP-2 on the link table: keyed start coordinates."""
        return self._stage("links_start_fixed", lambda: R.repair_event_coords(self.links, self.laser, self.station_groups,
                                                 "str", extent=self.extent))

    @cached_property
    def links_fixed(self) -> DataFrame:
        """REP-3 on the result of REP-2: keyed end coordinates."""
        return self._stage("links_fixed", lambda: R.repair_event_coords(self.links_start_fixed, self.laser,
                                                 self.station_groups, "end", extent=self.extent))

    @cached_property
    def events_start_fixed(self) -> DataFrame:
        return self.links_start_fixed

    @cached_property
    def events_fixed(self) -> DataFrame:
        """Station table with both keyed coordinates repaired (one join back)."""
        return self._stage("events_fixed", lambda: R.attach_link_coords(self.station_table, self.links_fixed))

    @cached_property
    def gaps_filled(self) -> DataFrame:
        """REP-4."""
        return self._stage("gaps_filled", lambda: R.repair_gps_gaps(self.events_fixed, self.gps_lost, extent=self.extent))

    @cached_property
    def unfrozen(self) -> DataFrame:
        """REP-5."""
        return self._stage("unfrozen", lambda: R.repair_gps_frozen(self.gaps_filled))

    @cached_property
    def stations_final(self) -> DataFrame:
        """REP-6 on the repaired stations: the final station table."""
        return self._stage("stations_final", lambda: smooth_measures(self.unfrozen))

    # ------------------------------------------------------------------ deliverables
    @cached_property
    def survey(self) -> DataFrame:
        name = K.SURVEY_RUN_NEW_FOLDER if self.form == "folder" else K.SURVEY_RUN_NEW
        return self._stage("survey", lambda: D.survey(self.stations_final, name))

    @cached_property
    def survey_point_local(self) -> DataFrame:
        return self._stage("survey_point_local", lambda: D.survey_point_local(self.stations_final, self.laser, self.survey))

    @cached_property
    def survey_image(self) -> DataFrame:
        return self._stage("survey_image", lambda: D.survey_image(self.survey_point_local, self.stations_final))

    @cached_property
    def survey_image_fixed(self) -> DataFrame:
        return self._stage("survey_image_fixed", lambda: D.repair_image_names(self.survey_image))

    @cached_property
    def pave_table(self) -> DataFrame:
        return self._stage("pave_table", lambda: D.pave_table(self.stations_final, self.pave, self.survey,
                                        extent=self.pave_extent))

    @cached_property
    def pave_gps_lost(self) -> DataFrame:
        return self._stage("pave_gps_lost", lambda: D.pave_gps_lost(self.pave_table, extent=self.pave_extent))

    @cached_property
    def pave_gaps_filled(self) -> DataFrame:
        return self._stage("pave_gaps_filled", lambda: D.repair_pave_gaps(self.pave_table, self.pave_gps_lost, self.survey,
                                              extent=self.pave_extent, mode=self.pave_gap_mode))

    @cached_property
    def pave_final(self) -> DataFrame:
        return self._stage("pave_final", lambda: D.repair_pave_frozen(self.pave_gaps_filled, self.survey))

    @cached_property
    def survey_pave(self) -> DataFrame:
        return self._stage("survey_pave", lambda: D.survey_pave(self.pave_final))

    # ------------------------------------------------------------------ sink
    # output table name -> final stage (after every repair of that table)
    DELIVERABLES = {"station_table": "stations_final", "survey": "survey",
                    "survey_point_local": "survey_point_local", "survey_image": "survey_image_fixed",
                    "pave_table": "pave_final", "survey_pave": "survey_pave"}

    def write_deliverables(self, out_dir: str, mode: str = "errorifexists") -> list[str]:
        """SNK-1: write the final deliverable tables as Parquet partitioned by run; also the
        survey points in their published projection (TAB-4)."""
        from pavespark.sources.exported import write_stage
        base = out_dir.rstrip("/")
        written = []
        for table, stage in self.DELIVERABLES.items():
            write_stage(getattr(self, stage), f"{base}/{table}", mode=mode)
            written.append(table)
        write_stage(D.survey_point(self.survey_point_local), f"{base}/survey_point", mode=mode)
        written.append("survey_point")
        return written
