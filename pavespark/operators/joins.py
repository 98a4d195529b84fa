"""Join operators Spark has no native strategy for.

* ``range_join``: point-in-interval join (lo <= x <= hi) within equal keys.
  Intervals are replicated into the fixed-width buckets they overlap, so the
  join is an equi-join on (keys, bucket) plus a residual predicate: hash or
  sort-merge partitioned by run *and* position, never a nested loop, and a
  very long run is spread over many tasks.
* ``near_join``: planar distance join via a grid of eps-sized cells; the
  small side is replicated to the 3x3 neighbour cells.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pavespark.session import growing


def _bucket_array(lo: Column, hi: Column, width: float) -> Column:
    blo, bhi = F.floor(lo / width), F.floor(hi / width)
    return F.when(blo <= bhi, F.sequence(blo, bhi)).otherwise(F.array().cast("array<bigint>"))


def range_join(points: DataFrame, intervals: DataFrame, x: Column | str, lo: Column, hi: Column,
               keys: Sequence[str] = ("file_name",), how: str = "inner", width: float = 250.0,
               extent: DataFrame | None = None, residual=None,
               lo_open: bool = False, hi_open: bool = False) -> DataFrame:
    """Join each point row to every interval row with ``lo <= x <= hi`` and equal keys.

    ``x`` is evaluated on ``points``; ``lo``/``hi`` on ``intervals``. ``how`` is
    ``inner`` or ``left`` (points preserved). ``extent`` (keys, _xmin, _xmax)
    clips intervals to where points exist, so a wrong interval end cannot
    replicate a row into millions of empty buckets. Result: all point columns,
    then interval columns other than the keys.
    """
    xcol = F.col(x) if isinstance(x, str) else x
    iv = intervals.withColumn("_lo", lo).withColumn("_hi", hi)
    blo, bhi = F.col("_lo"), F.col("_hi")
    if extent is not None:
        iv = iv.join(growing(extent), list(keys), "left")
        blo = F.greatest(blo, F.col("_xmin"))
        bhi = F.least(bhi, F.col("_xmax"))
        iv = iv.withColumn("_b", F.explode(_bucket_array(blo, bhi, width))).drop("_xmin", "_xmax")
    else:
        iv = iv.withColumn("_b", F.explode(_bucket_array(blo, bhi, width)))
    pt = points.withColumn("_x", xcol).withColumn("_b", F.floor(F.col("_x") / width))
    rkeys = {k: f"_rk_{k}" for k in keys}
    for k, rk in rkeys.items():
        iv = iv.withColumnRenamed(k, rk)
    cond = F.col("_b") == F.col("_rb")
    iv = iv.withColumnRenamed("_b", "_rb")
    for k, rk in rkeys.items():
        cond = cond & (F.col(k) == F.col(rk))
    cond = cond & ((F.col("_x") > F.col("_lo")) if lo_open else (F.col("_x") >= F.col("_lo")))
    cond = cond & ((F.col("_x") < F.col("_hi")) if hi_open else (F.col("_x") <= F.col("_hi")))
    if residual is not None:
        cond = cond & residual
    out = pt.join(growing(iv), cond, how)
    return out.drop("_x", "_b", "_rb", "_lo", "_hi", *rkeys.values())


def run_extent(df: DataFrame, x: str = "chainage", keys: Sequence[str] = ("file_name",),
               margin: float = 1.0) -> DataFrame:
    """Per-run extent of ``x`` widened by ``margin`` (partial aggregation map-side; one
    row per run). The margin keeps rounded positions (``rint``) inside the extent."""
    return df.groupBy(*keys).agg((F.floor(F.min(x)) - margin).alias("_xmin"),
                                 (F.ceil(F.max(x)) + margin).alias("_xmax"))


def near_join(small: DataFrame, big: DataFrame, eps: float, keys: Sequence[str],
              sx: str, sy: str, bx: str, by: str, how: str = "inner") -> DataFrame:
    """Pairs with planar distance <= eps, equal keys. ``small`` is replicated 3x3."""
    cx, cy = "_cx", "_cy"
    offs = F.array(*[F.struct(F.lit(i).alias("dx"), F.lit(j).alias("dy"))
                     for i in (-1, 0, 1) for j in (-1, 0, 1)])
    s = (small.withColumn("_o", F.explode(offs))
              .withColumn(cx, F.floor(F.col(sx) / eps) + F.col("_o.dx"))
              .withColumn(cy, F.floor(F.col(sy) / eps) + F.col("_o.dy")).drop("_o"))
    b = big.withColumn(cx, F.floor(F.col(bx) / eps)).withColumn(cy, F.floor(F.col(by) / eps))
    rk = {k: f"_nk_{k}" for k in keys}
    for k, r in rk.items():
        b = b.withColumnRenamed(k, r)
    b = b.withColumnRenamed(cx, "_bcx").withColumnRenamed(cy, "_bcy")
    cond = (F.col(cx) == F.col("_bcx")) & (F.col(cy) == F.col("_bcy"))
    for k, r in rk.items():
        cond = cond & (F.col(k) == F.col(r))
    dist = F.sqrt((F.col(sx) - F.col(bx)) ** 2 + (F.col(sy) - F.col(by)) ** 2)
    out = s.join(growing(b), cond & (dist <= eps), how)
    return out.drop(cx, cy, "_bcx", "_bcy", *rk.values())
