"""REP-6 / WIN-2: 9-station centred mean of the measures along each run.

Frame: 4 rows before .. 4 rows after in chainage order (ties: event_str,
link_id, picture), over all links of the run. The sum skips NULL neighbours
and is always divided by 9 (edges shrink); a NULL current value stays NULL.
Arithmetic is in integer hundredths, rounded half away from zero once, so
no double rounding: side values = S/9, the means ``iri`` and ``rutting`` =
(S_left + S_right)/18 from the unrounded sides.

The frame runs in chunks along chainage, joined at their seams by the few rows at each
chunk's ends (``rolling_sums``): one shuffle of the stations, and a very long run is spread
over many tasks instead of one window partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pavespark.operators.windows import rolling_sums

RUN = "file_name"
SIDE_MEASURES = ["iri_right", "iri_left", "iri_lane", "rutt_right", "rutt_left", "texture",
                 "etd_texture"]
ORDER = ["chainage", "event_str", "link_id", "chainage_pic", "frame_number"]


def cents(c: str) -> Column:
    return (F.col(c).cast("decimal(8,2)") * 100).cast("bigint")


def round_div(num: Column, den: int) -> Column:
    """num / den rounded half away from zero (integers)."""
    pos = (2 * num + den).cast("bigint") / F.lit(2 * den)
    return F.when(num >= 0, F.floor(pos)).otherwise(-F.floor((-2 * num + den) / F.lit(2 * den)))


def from_cents(c: Column) -> Column:
    # a product, as decimal quotients are slow; both are exact
    return (c.cast("decimal(12,0)") * F.lit("0.01").cast("decimal(2,2)")).cast("decimal(8,2)")


def smooth_measures(data: DataFrame, before: int = 4, after: int = 4,
                    chunk_m: float = 10000.0) -> DataFrame:
    chunk = F.coalesce(F.floor(F.col("chainage") / chunk_m), F.lit(1 << 40))
    d = rolling_sums(data, [RUN], ORDER, chunk, before, after,
                     {f"_s_{m}": cents(m) for m in SIDE_MEASURES})
    n = before + after + 1
    out = d.select("*", *(F.col(m).isNotNull().alias(f"_n_{m}") for m in SIDE_MEASURES))
    for m in SIDE_MEASURES:
        out = out.withColumn(m, F.when(F.col(m).isNotNull(),
                                       from_cents(round_div(F.col(f"_s_{m}"), n))))
    for mean, (left, right) in {"iri": ("iri_left", "iri_right"),
                                "rutting": ("rutt_left", "rutt_right")}.items():
        both = F.col(f"_n_{left}") & F.col(f"_n_{right}")
        out = out.withColumn(mean, F.when(both, from_cents(
            round_div(F.col(f"_s_{left}") + F.col(f"_s_{right}"), 2 * n))))
    return out.select(*data.columns)
