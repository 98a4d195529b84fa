"""Linear-referencing operators along chainage: gaps and islands.

An island is a maximal stretch of consecutive rows of a link (ordered by
chainage) that share a coordinate: row number along the link minus row
number within the (link, coordinate) partition is constant on a stretch.

Both numbers come from one pass: the rows are dealt once by (run, link, chunk along
chainage), where each chunk numbers its rows both ways. What came before a chunk is a sum
over the few chunks of its link, taken from the chunks' counts and added at the end, to the
lost rows only. So a long link, or one coordinate that very many rows share (lost GPS = 0,0),
never lands in a single task, and the stations are shuffled once.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pavespark.functions import predicates as P
from pavespark.operators.joins import range_join
from pavespark.operators.windows import null_safe_join

RUN = "file_name"


def _before(rows: DataFrame, part: Sequence[str], name: str) -> DataFrame:
    """Rows of ``part`` in the chunks before each chunk. Counted where the rows lie: only the
    counts are shuffled."""
    sizes = rows.groupBy(*part, "_chunk").agg(F.count(F.lit(1)).alias("_n"))
    w = W.partitionBy(*part).orderBy("_chunk").rowsBetween(W.unboundedPreceding, -1)
    return sizes.select(*part, "_chunk", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias(name))


def lost_islands(df: DataFrame, x: str, ties: Sequence[str], spacing: int,
                 chunk_m: float = 10000.0, link: str = "link_id", date: str = "date") -> DataFrame:
    """AGG-4: min / max / count of each island of lost rows per (run, link, date).

    The position along the link needs every row; the position within the
    (link, coordinate) partition is only used for lost rows, and a lost
    coordinate's partition holds lost rows only, so it is counted on those."""
    order = [F.col(x).asc_nulls_last()] + [F.col(t).asc_nulls_last() for t in ties]
    columns = dict.fromkeys([RUN, date, link, "lat", "lon", x, *ties])
    chunk = F.coalesce(F.floor(F.col(x) / chunk_m), F.lit(1 << 40))
    rows = df.select(*columns, chunk.alias("_chunk"))
    along, same = [RUN, date, link], [RUN, "lat", "lon", link]
    d = rows.repartition(RUN, link, "_chunk").withColumn("_n1", F.row_number().over(W.partitionBy(*along, "_chunk").orderBy(*order)))
    lost = d.where(P.gps_lost()).withColumn(
        "_n2", F.row_number().over(W.partitionBy(*same, "_chunk").orderBy(*order)))
    lost = null_safe_join(lost, _before(rows, along, "_b1"), [*along, "_chunk"])
    lost = null_safe_join(lost, _before(rows.where(P.gps_lost()), same, "_b2"), [*same, "_chunk"])
    grp2 = F.col("_b1") + F.col("_n1") - F.col("_b2") - F.col("_n2")
    return (lost.groupBy(RUN, "link_id", "date", grp2.alias("grp2"))
                .agg(F.min(x).alias("min"), F.max(x).alias("max"),
                     F.count(F.lit(1)).alias("c_p"))
                .withColumn("meter", F.col("c_p") * spacing))


def gap_rows(islands: DataFrame, targets: DataFrame, x: str, margin: int,
             extent: DataFrame | None = None) -> DataFrame:
    """REP-1 / REP-7 tail: one row per (island, target station inside it) with the
    search window [min - margin, max + margin]. Targets of any link of the run."""
    t = targets.select(RUN, F.col(x).alias("_tx")).distinct()
    j = range_join(t, islands, "_tx", F.col("min"), F.col("max"), keys=[RUN], extent=extent)
    return (j.withColumnRenamed("_tx", x)
             .withColumn("new_p_min", F.col("min") - margin)
             .withColumn("new_p_max", F.col("max") + margin)
             .select(RUN, "min", "max", "c_p", "meter", "link_id", "date", "grp2", x,
                     "new_p_min", "new_p_max"))
