"""Row predicates and numeric conversions (all JVM-side column expressions)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pavespark.constants import PAVE_EVENT_TYPE, REPORT_INTERVAL_M


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def pg_int(c) -> Column:
    """``real::int``: round half to even (a plain Spark cast truncates)."""
    return F.rint(_c(c)).cast("int")


def on_grid(c="chainage") -> Column:
    """FIL-2: chainage on the 25 m reporting grid (arithmetic form)."""
    return (_c(c) % REPORT_INTERVAL_M) == 0


def on_grid_suffix(c="chainage") -> Column:
    """FIL-3: 25 m grid by the printed suffix 00/25/50/75; chainage 0 prints one digit."""
    return on_grid(c) & (_c(c) != 0)


def gps_lost(lon="lon", lat="lat") -> Column:
    """FIL-4: lost GPS, either coordinate exactly 0."""
    return (_c(lon) == 0) | (_c(lat) == 0)


def gps_present(lon="lon", lat="lat") -> Column:
    """FIL-5: present GPS, either coordinate non-zero (not the complement of lost)."""
    return (_c(lon) != 0) | (_c(lat) != 0)


def gps_valid(lon="lon", lat="lat") -> Column:
    """FIL-6: both coordinates non-zero."""
    return (_c(lat) != 0) & (_c(lon) != 0)


def zero_key_coords() -> Column:
    """FIL-9: a keyed link whose start or end coordinate is exactly 0."""
    zero = [F.col(c) == 0 for c in ("lon_str", "lon_end", "lat_str", "lat_end")]
    return F.col("link_id").isNotNull() & (zero[0] | zero[1] | zero[2] | zero[3])


def missing_measures() -> Column:
    """RPT-8: no iri, rutting or texture, or no picture on a grid station."""
    return (F.col("iri").isNull() | F.col("rutting").isNull() | F.col("texture").isNull()
            | (F.col("frame_number").isNull() & on_grid("chainage")))


def pave_event(c="event_type") -> Column:
    """FIL-1: pavement events only (blanks inside the code are ignored)."""
    return F.regexp_replace(_c(c), " ", "") == PAVE_EVENT_TYPE


def km_int(c) -> Column:
    """``replace(km, '+', '')::int`` (bad text gives NULL instead of an error)."""
    return F.regexp_replace(_c(c), r"\+", "").try_cast("int")


def survey_date(c="survey_date") -> Column:
    """Key-code survey date: blanks removed, ``yyyyMMdd`` or ISO text."""
    s = F.regexp_replace(_c(c), " ", "")
    return F.coalesce(F.try_to_date(s, "yyyyMMdd"), s.try_cast("date"))


def as_real(c) -> Column:
    """A ``real`` value: FLOAT precision, carried as DOUBLE."""
    return _c(c).cast("float").cast("double")
