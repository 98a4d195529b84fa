"""Points on lines through a table of segments (GEO-5 for many targets per line).

``add_point_at`` (geometry.py) folds a line's array for every target row, which suits lines of a
few anchors. Here a line is exploded once into its segments, each with the fractions of the
line's length at which it starts and ends, and every target meets its own segment only:

* a segment's fractions are running sums along the line, in chunks of ``chunk`` segments with
  the sums before each chunk added, so a long line is spread over many tasks. A line of one
  chunk adds up in the same order as the fold and gives the same bits;
* targets and segments are dealt to parts of the line by fraction, one part per ``chunk``
  points, and laid in one order; the last segment passed is the target's. That is linear in
  segments plus targets (a sort), where a join of targets with segments of a part would be
  their product;
* neither a line's array nor its points travel with the target rows.

The rule is the one of ``add_point_at``: fraction 0 or a single point gives the first point,
fraction 1 or a line without length the last one, else the first segment that ends beyond the
fraction is blended; the last point if rounding leaves none.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pavespark.operators.windows import null_safe_join

CHUNK = 4096


def line_heads(lines: DataFrame, keys: Sequence[str], line: str, chunk: int = CHUNK) -> DataFrame:
    """One row per line without its points: ``_n``, ``_first``, ``_last``, ``_total``, ``_parts``."""
    pts = F.col(line)
    n = F.size(pts)
    ends = {"_first": F.get(pts, F.lit(0)), "_last": F.get(pts, n - 1)}
    return lines.select(*keys, n.alias("_n"),
                        *(F.struct(p["lon"].alias("lon"), p["lat"].alias("lat")).alias(name)
                          for name, p in ends.items()),
                        _total(line).alias("_total"),
                        F.greatest(F.lit(1), F.ceil(n / chunk)).cast("int").alias("_parts"))


def _segments_array(line: str) -> Column:
    """Pairs of neighbouring points, in order."""
    pts = F.col(line)
    n = F.size(pts)
    idx = F.when(n >= 2, F.sequence(F.lit(1), n - 1)).otherwise(F.array().cast("array<int>"))

    def pair(i):
        a, b = F.get(pts, i - 1), F.get(pts, i)
        return F.struct(a["lon"].alias("x0"), a["lat"].alias("y0"), b["lon"].alias("x1"), b["lat"].alias("y1"))

    return F.transform(idx, pair)


def _length(s: Column | str) -> Column:
    s = F.col(s) if isinstance(s, str) else s
    return F.sqrt((s["x1"] - s["x0"]) ** 2 + (s["y1"] - s["y0"]) ** 2)


def _total(line: str) -> Column:
    return F.aggregate(_segments_array(line), F.lit(0.0), lambda acc, s: acc + _length(s))


def line_segments(lines: DataFrame, keys: Sequence[str], line: str, chunk: int = CHUNK) -> DataFrame:
    """One row per segment: keys, ``pos``, ``s`` (its end points), ``share`` of the line's
    length, ``lo`` and ``hi`` (fractions at its ends), ``_parts``."""
    keys = list(keys)
    # what belongs to the line is a column before the segments become rows, else every row
    # would work it out again
    d = lines.select(*keys, _segments_array(line).alias("_all"), _total(line).alias("_total"),
                     F.greatest(F.lit(1), F.ceil(F.size(line) / chunk)).cast("int").alias("_parts"))
    d = d.select(*keys, "_total", "_parts", F.posexplode("_all").alias("pos", "s"))
    d = (d.withColumn("share", F.try_divide(_length("s"), F.col("_total")))
          .withColumn("_chunk", F.floor(F.col("pos") / chunk)).drop("_total"))
    w = W.partitionBy(*keys, "_chunk").orderBy("pos")
    d = d.withColumn("hi", F.sum("share").over(w.rowsBetween(W.unboundedPreceding, W.currentRow)))
    d = d.withColumn("lo", F.coalesce(F.lag("hi").over(w), F.lit(0.0)))
    sums = d.groupBy(*keys, "_chunk").agg(F.max("hi").alias("_sum"))
    before = W.partitionBy(*keys).orderBy("_chunk").rowsBetween(W.unboundedPreceding, -1)
    sums = sums.select(*keys, "_chunk", F.coalesce(F.sum("_sum").over(before), F.lit(0.0)).alias("_off"))
    d = null_safe_join(d, sums, [*keys, "_chunk"])
    return d.select(*keys, "pos", "s", "share", (F.col("_off") + F.col("lo")).alias("lo"),
                    (F.col("_off") + F.col("hi")).alias("hi"), "_parts")


def points_on_lines(targets: DataFrame, lines: DataFrame, keys: Sequence[str], fraction: Column | str,
                    out: str = "pt", line: str = "the_geom", chunk: int = CHUNK) -> DataFrame:
    """``targets`` of the lines in ``lines`` (one row per ``keys``; NULL matches NULL) with
    ``out`` = STRUCT<lon, lat>, the point at ``fraction`` of the planar length of their line.
    Targets without a line are dropped. ``lines`` is read twice and its arrays are walked
    point by point: pass a written table, not arrays still to be computed."""
    keys = list(keys)
    f = F.col(fraction) if isinstance(fraction, str) else fraction
    own = targets.columns
    heads = line_heads(lines, keys, line, chunk)
    t = null_safe_join(targets.withColumn("_f", f.cast("double")), heads, keys)
    last_part = F.col("_parts") - 1

    def part(at: Column) -> Column:
        return F.least(F.greatest(F.floor(at * F.col("_parts")), F.lit(0)), last_part).cast("int")

    row = F.struct(*(F.col(c) for c in own if c not in keys), *(F.col(c) for c in (
        "_f", "_n", "_first", "_last", "_total")))
    t = t.select(*keys, F.coalesce(part(F.col("_f")), F.lit(0)).alias("_part"), F.col("_f").alias("_at"),
                 F.lit(0).alias("_kind"), F.lit(None).cast("int").alias("_pos"), row.alias("_t"))
    s = line_segments(lines, keys, line, chunk).where(F.col("hi").isNotNull())
    s = s.select(*keys, F.explode(F.sequence(part(F.col("lo")), part(F.col("hi")))).alias("_part"),
                 F.col("hi").alias("_at"), F.lit(1).alias("_kind"), F.col("pos").alias("_pos"),
                 F.struct("lo", "share", "s").alias("_s"))
    both = t.unionByName(s, allowMissingColumns=True)
    # from high to low: the last segment passed is the first one that ends beyond the target
    w = (W.partitionBy(*keys, "_part").orderBy(F.desc("_at"), "_kind", F.desc("_pos"))
         .rowsBetween(W.unboundedPreceding, W.currentRow))
    d = (both.withColumn("_hit", F.last("_s", ignorenulls=True).over(w))
             .where("_kind = 0").select(*keys, "_t.*", "_hit"))
    seg, ff = F.col("_hit.s"), F.col("_f")
    step = F.try_divide(ff - F.col("_hit.lo"), F.col("_hit.share"))
    pick_first = (ff == 0) | (F.col("_n") == 1)
    pick_last = ff.isNull() | (ff == 1) | (F.col("_total") == 0) | F.col("_hit").isNull()

    def pick(name: str, a: str, b: str) -> Column:
        return (F.when(F.col("_n") == 0, F.lit(None)).when(pick_first, F.col(f"_first.{name}"))
                 .when(pick_last, F.col(f"_last.{name}"))
                 .otherwise(seg[a] + step * (seg[b] - seg[a]))).cast("double").alias(name)

    return d.select(*own, F.struct(pick("lon", "x0", "x1"), pick("lat", "y0", "y1")).alias(out))
