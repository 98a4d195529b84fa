"""Decoding of link codes and formatting of deliverable fields.

A link id looks like ``33600040201L2CC01``: 11 digits of road/section, the
side letter L/R and lane-group digit, the surface AC/CC and a 2-digit run.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pavespark import constants as K


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def side_code(link="link_id") -> Column:
    """Two characters: side letter and lane-group digit (chars 6..5 from the right)."""
    return F.left(F.right(_c(link), F.lit(6)), F.lit(2))


def lane_group(link="link_id", max_group: int = K.SURVEY_MAX_LANE_GROUP) -> Column:
    """PRJ-3: L1..Ln -> 1..n, R1..Rn -> -1..-n, anything else (NULL too) -> 0."""
    s = side_code(link)
    side, digit = F.substring(s, 1, 1), F.substring(s, 2, 1)
    digits = [str(d) for d in range(1, max_group + 1)]
    ok = (F.length(s) == 2) & digit.isin(digits)
    return (F.when(ok & (side == "L"), digit.cast("int"))
             .when(ok & (side == "R"), -digit.cast("int"))
             .otherwise(F.lit(0)))


def surface(link="link_id") -> Column:
    return F.left(F.right(_c(link), F.lit(4)), F.lit(2))


def survey_code(link="link_id") -> Column:
    """PRJ-4: surface + first 11 characters, e.g. CC33600040201."""
    return F.concat(surface(link), F.left(_c(link), F.lit(11)))


def run_code(link="link_id") -> Column:
    """PRJ-4: last two characters as a number, printed."""
    return F.right(_c(link), F.lit(2)).try_cast("int").cast("string")


def survey_type(link="link_id") -> Column:
    """PRJ-4: AC -> 2, CC -> 1, else NULL."""
    s = surface(link)
    return F.when(s == K.SURFACE_AC, 2).when(s == K.SURFACE_CC, 1)


def lane_no_full(lane="lane_no") -> Column:
    """PRJ-5: a lane number ending in L or R gets '2' appended."""
    c = _c(lane)
    return F.when(F.right(c, F.lit(1)).isin("L", "R"), F.concat(c, F.lit("2"))).otherwise(c)


def lane_no_int(lane="lane_no") -> Column:
    """PRJ-5: last character as an integer."""
    return F.right(_c(lane), F.lit(1)).try_cast("int")


def side_length(link="link_id", km_start="km_start", km_end="km_end") -> Column:
    """PRJ-6: L -> km_end - km_start, R -> km_start - km_end, else NULL."""
    side = F.left(side_code(link), F.lit(1))
    return (F.when(side == "L", _c(km_end) - _c(km_start))
             .when(side == "R", _c(km_start) - _c(km_end)))


def frame_text(frame="frame_number") -> Column:
    """PRJ-8: frame padded to 5 digits; longer frames are kept whole (never cut)."""
    c = _c(frame)
    n = F.length(c)
    return F.when((n >= 1) & (n <= 4), F.lpad(c, 5, "0")).when(n > 4, c)


def pave_frame_text(frame="frame_number") -> Column:
    """PRJ-9: zeros chosen by the length of the old frame, then frame + 1 is printed."""
    c = _c(frame)
    n = F.length(c)
    nxt = (c.try_cast("bigint") + 1).cast("string")
    return (F.when((n >= 1) & (n <= 4), F.concat(F.repeat(F.lit("0"), 5 - n), nxt))
             .when(n > 4, nxt))


def next_station_5m(c) -> Column:
    """PRJ-11: move an integer chainage up by its last digit to the next 5 m station."""
    x = _c(c)
    return x + (5 - F.abs(x) % 5) % 5


def remark_year(link="link_id", date="date") -> Column:
    """PRJ-7: first three characters of the link + '_' + year."""
    return F.concat(F.left(_c(link), F.lit(3)), F.lit("_"), F.year(_c(date)).cast("string"))
