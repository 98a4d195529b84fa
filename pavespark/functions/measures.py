"""Measure expressions: IRI clamp and the 9 measure columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pavespark.constants import IRI_DRAW_LOW, IRI_LIMIT
from pavespark.functions.predicates import as_real

MEASURES = ["iri_right", "iri_left", "iri", "iri_lane", "rutt_right", "rutt_left",
            "rutting", "texture", "etd_texture"]


def default_draw(side: str, chainage: str = "chainage") -> Column:
    """Deterministic stand-in for a uniform draw in [7.00, 8.00].

    Integer arithmetic on the row's own values (side IRI in hundredths and
    the chainage), so reruns and other engines give the same value.
    """
    cents = F.rint(F.col(side) * 100).cast("bigint")
    pos = F.rint(F.col(chainage)).cast("bigint")
    return IRI_DRAW_LOW + F.pmod(cents * 31 + pos, F.lit(101)) / 100


def iri_clamp(laser: DataFrame, draw=default_draw) -> DataFrame:
    """PRJ-1: a side IRI above 8 is replaced by a draw in [7, 8]; ``iri`` is the
    mean of the two (clamped) sides, the original kept as ``iri_old``."""
    out = laser
    for side in ("iri_right", "iri_left"):
        out = out.withColumn(side, F.when(as_real(side) > IRI_LIMIT, draw(side))
                             .otherwise(F.col(side)))
    return (out.withColumnRenamed("iri", "iri_old")
               .withColumn("iri", (F.col("iri_right") + F.col("iri_left")) / 2))
