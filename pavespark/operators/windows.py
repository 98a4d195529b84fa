"""Ordered windows that never put a whole run (or the whole table) in one task.

``ordered_index``: 0-based position of each row within its group, ordered.
Two exact methods:

* value chunks (``chunk`` given): the rows are cut into chunks by a column
  that is monotone in the order (e.g. ``floor(chainage / 10000)``). Each chunk
  is numbered by a window partitioned by (group, chunk) -- bounded size --
  and offsets come from a small count table (one row per group and chunk).
  Deterministic; used along chainage inside runs.
* range partitions (no ``chunk``): rows are range-partitioned on the full
  order (tie-breakers included, so even one huge equal key is split), sorted
  within partitions, materialised (checkpoint, so the range bounds and the
  in-partition order are fixed), then numbered locally plus per-partition
  offsets. Used for global ids.

``rolling_sums``: sums over a ROWS frame [-before, +after] in one shuffle by value
chunks; frames reach over a chunk's seams by the edge rows of its neighbours. Exact.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pavespark.session import growing, materialize


def _num_partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))


def _cols(xs):
    return [F.col(c) if isinstance(c, str) else c for c in xs]


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], grows: bool = True) -> DataFrame:
    """Inner equi-join on ``keys`` where NULL matches NULL (``<=>``); right keys dropped.
    ``grows=False``: ``right`` has a bounded number of rows and may be broadcast."""
    ren = {k: f"_r_{k}" for k in keys}
    r = right
    for k, v in ren.items():
        r = r.withColumnRenamed(k, v)
    cond = None
    for k, v in ren.items():
        c = F.col(k).eqNullSafe(F.col(v))
        cond = c if cond is None else cond & c
    return left.join(growing(r) if grows else r, cond, "inner").drop(*ren.values())


def ordered_index(df: DataFrame, part: Sequence[str], order: Sequence[Column | str],
                  name: str = "_idx", chunk: Column | None = None,
                  num_partitions: int | None = None) -> DataFrame:
    """Add ``name`` = row position (from 0) within ``part`` ordered by ``order``.

    ``order`` must make rows unique within ``part`` for a deterministic result.
    """
    part = list(part)
    ocols = _cols(order)
    if chunk is not None:
        d = df.withColumn("_chunk", chunk)
        counts = d.groupBy(*part, "_chunk").agg(F.count(F.lit(1)).alias("_cnt"))
        w_off = (Window.partitionBy(*part).orderBy("_chunk")
                 .rowsBetween(Window.unboundedPreceding, -1))
        offsets = counts.select(*part, "_chunk",
                                F.coalesce(F.sum("_cnt").over(w_off), F.lit(0)).alias("_off"))
        w = Window.partitionBy(*part, "_chunk").orderBy(*ocols)
        d = d.withColumn("_rn", F.row_number().over(w) - 1)
        out = null_safe_join(d, offsets, part + ["_chunk"])
        return out.withColumn(name, F.col("_off") + F.col("_rn")).drop("_chunk", "_off", "_rn")

    n = num_partitions or _num_partitions(df)
    pcols = [F.col(p) for p in part]
    ranged = materialize(df.repartitionByRange(n, *pcols, *ocols)
                         .sortWithinPartitions(*pcols, *ocols)
                         .withColumn("_pid", F.spark_partition_id())
                         .withColumn("_mid", F.monotonically_increasing_id()))
    counts = ranged.groupBy("_pid", *part).agg(F.min("_mid").alias("_mid0"),
                                               F.count(F.lit(1)).alias("_cnt"))
    w = Window.partitionBy(*part).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_pid", *part, "_mid0",
                            F.coalesce(F.sum("_cnt").over(w), F.lit(0)).alias("_off"))
    # without groups there is a row per range partition, which stays small
    out = null_safe_join(ranged, offsets, ["_pid"] + part, grows=bool(part))
    return (out.withColumn(name, F.col("_off") + F.col("_mid") - F.col("_mid0"))
               .drop("_pid", "_mid", "_mid0", "_off"))


def rolling_sums(df: DataFrame, part: Sequence[str], order: Sequence[str], chunk: Column, before: int,
                 after: int, sums: dict[str, Column]) -> DataFrame:
    """Add each ``sums`` = {name: value} summed over ROWS [-before, +after] within ``part`` by
    ``order`` (ascending, NULLs last; NULL values count as 0). Exact for whole numbers.

    ``chunk`` is monotone in the order. The rows are shuffled once, by (part, chunk), and each
    chunk adds up its own rows. What a frame has beyond a seam comes from the edges of the chunks
    around it: the first and last rows of every chunk, which each map task has reduced to a few
    before they are shuffled. ``part`` columns must not be NULL.
    """
    part, names = list(part), list(sums)
    key = [*part, "_chunk"]

    def valued(rows: DataFrame) -> DataFrame:
        return rows.withColumns({name: F.coalesce(v, F.lit(0)).cast("bigint") for name, v in sums.items()})

    rows = df.withColumn("_chunk", chunk)
    d = valued(rows)
    up = [F.col(c).asc_nulls_last() for c in order]
    down = [F.col(c).desc_nulls_first() for c in order]

    def edge(sort: list[Column], rows: int, sign: int) -> DataFrame:
        """Up to ``rows`` rows at one end of every chunk, as one array in order."""
        n = F.row_number().over(Window.partitionBy(*key).orderBy(*sort))
        found = d.select(*key, *order, *names).withColumn("_n", n).where(F.col("_n") <= rows)
        return found.groupBy(*key).agg(F.sort_array(F.collect_list(
            F.struct((sign * F.col("_n")).alias("_n"), *names))).alias("_e"))

    along = Window.partitionBy(*part).orderBy("_chunk")
    # every chunk has a row at least, so as many chunks as rows reach far enough
    earlier = F.flatten(F.collect_list("_e").over(along.rowsBetween(-max(before, 1), -1)))
    later = F.flatten(F.collect_list("_e").over(along.rowsBetween(1, max(after, 1))))
    edges = (edge(down, max(before, 1), -1).select(*key, earlier.alias("_earlier"))
             .join(growing(edge(up, max(after, 1), 1).select(*key, later.alias("_later"))), key))

    w = Window.partitionBy(*key).orderBy(*up)
    # the values are worked out where the rows have been dealt to, not shuffled with them
    d = valued(rows.repartition(*key)).withColumn("_rn", F.row_number().over(w)).withColumn(
        "_left", F.count(F.lit(1)).over(Window.partitionBy(*key)) - F.col("_rn"))
    for name in names:
        d = d.withColumn(f"_s_{name}", F.sum(name).over(w.rowsBetween(-before, after)))
    d = d.join(growing(edges), key)
    short, size = (F.lit(before + 1) - F.col("_rn")).cast("int"), F.size("_earlier")
    ahead = F.slice("_later", F.lit(1), F.greatest(F.lit(0), (F.lit(after) - F.col("_left")).cast("int")))
    behind = F.slice("_earlier", F.greatest(F.lit(1), size - short + 1), F.greatest(F.lit(0), short))

    def total(rows: Column, name: str) -> Column:
        return F.aggregate(rows, F.lit(0).cast("bigint"), lambda acc, e: acc + e[name])

    return d.select(*(c for c in df.columns if c not in names), *(
        (F.col(f"_s_{name}") + F.when(short > 0, total(behind, name)).otherwise(0)
         + F.when(F.col("_left") < after, total(ahead, name)).otherwise(0)).alias(name) for name in names))


def global_row_number(df: DataFrame, order: Sequence[Column | str], name: str,
                      start: int = 1) -> DataFrame:
    """``row_number() over (order by ...)`` + (start-1) without a single-partition window."""
    return (ordered_index(df, [], order, name="_gidx")
            .withColumn(name, F.col("_gidx") + start).drop("_gidx"))
