"""SRC-7: fixed schemas of the exported and loaded survey tables (never inferred)."""

from pyspark.sql import types as T

# Exported per-run tables (the four station tables are joined by SRC-1).
GPS = T.StructType([
    T.StructField("CHAINAGE", T.DoubleType()),
    T.StructField("LONGITUDE", T.DoubleType()),
    T.StructField("LATITUDE", T.DoubleType()),
])
IRI = T.StructType([
    T.StructField("CHAINAGE", T.DoubleType()),
    T.StructField("RWP_IRI", T.DoubleType()),
    T.StructField("LWP_IRI", T.DoubleType()),
    T.StructField("LANE_IRI", T.DoubleType()),
])
TPL = T.StructType([
    T.StructField("CHAINAGE", T.DoubleType()),
    T.StructField("RUT_EDG_SE", T.DoubleType()),
    T.StructField("RUT_CTR_SE", T.DoubleType()),
    T.StructField("RUT_SE", T.DoubleType()),
])
MPD = T.StructType([
    T.StructField("CHAINAGE", T.DoubleType()),
    T.StructField("LANE_MPD", T.DoubleType()),
])
KEYCODE = T.StructType([T.StructField(n, t) for n, t in [
    ("CHAINAGE_START", T.DoubleType()), ("CHAINAGE_END", T.DoubleType()),
    ("EVENT", T.StringType()), ("SWITCH_GROUP", T.StringType()), ("EVENT_DESC", T.StringType()),
    ("link_id", T.StringType()), ("section_id", T.StringType()), ("km_start", T.StringType()),
    ("km_end", T.StringType()), ("length", T.StringType()), ("lane_no", T.StringType()),
    ("survey_date", T.StringType()), ("LATITUDE_START", T.DoubleType()),
    ("LATITUDE_END", T.DoubleType()), ("LONGITUDE_START", T.DoubleType()),
    ("LONGITUDE_END", T.DoubleType()), ("ramp_id", T.StringType()),
]])
VIDEO_ROW = T.StructType([
    T.StructField("CHAINAGE", T.DoubleType()),
    T.StructField("FRAME", T.StringType()),
])
VIDEO_PAVE = T.StructType([
    T.StructField("CHAINAGE", T.DoubleType()),
    T.StructField("FRAME", T.StringType()),
    T.StructField("X", T.DoubleType()),
    T.StructField("Y", T.DoubleType()),
])

# Loaded (header-less CSV) tables, column order as written by the extract step.
# Real columns are read as FLOAT and widened to DOUBLE once (values keep FLOAT precision).
LASER_CSV = T.StructType([T.StructField(n, t) for n, t in [
    ("chainage", T.FloatType()), ("lon", T.FloatType()), ("lat", T.FloatType()),
    ("iri_right", T.DoubleType()), ("iri_left", T.DoubleType()), ("iri", T.DoubleType()),
    ("iri_lane", T.DecimalType(8, 2)), ("rutt_right", T.DecimalType(8, 2)),
    ("rutt_left", T.DecimalType(8, 2)), ("rutting", T.DecimalType(8, 2)),
    ("texture", T.DecimalType(8, 2)), ("etd_texture", T.DecimalType(8, 2)),
    ("file_name", T.StringType()),
]])
KEY_CSV = T.StructType([T.StructField(n, t) for n, t in [
    ("event_str", T.FloatType()), ("event_end", T.FloatType()), ("event_num", T.StringType()),
    ("event_type", T.StringType()), ("event_name", T.StringType()), ("link_id", T.StringType()),
    ("section_id", T.StringType()), ("km_start", T.StringType()), ("km_end", T.StringType()),
    ("length", T.StringType()), ("lane_no", T.StringType()), ("survey_date", T.StringType()),
    ("lat_str", T.FloatType()), ("lat_end", T.FloatType()), ("lon_str", T.FloatType()),
    ("lon_end", T.FloatType()), ("file_name", T.StringType()), ("ramp_id", T.StringType()),
]])
PIC_CSV = T.StructType([
    T.StructField("chainage_pic", T.FloatType()),
    T.StructField("frame_number", T.StringType()),
    T.StructField("file_name", T.StringType()),
])
PAVE_CSV = T.StructType([
    T.StructField("chainage_pic", T.FloatType()),
    T.StructField("frame_number", T.StringType()),
    T.StructField("lon", T.DoubleType()),
    T.StructField("lat", T.DoubleType()),
    T.StructField("file_name", T.StringType()),
])
