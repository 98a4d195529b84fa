"""DuckDB oracle SQL, composed from CTE fragments.

correlated ranges, windows without partition tricks), independent of the
Spark operators, so agreement means both readings match.
"""

from survey_oracle.fixtures import FIXTURE_CTES

GRID = "({c} % 25 = 0)"
LOST = "({p}lon = 0 OR {p}lat = 0)"
PRESENT = "({p}lon <> 0 OR {p}lat <> 0)"
DATE = ("COALESCE(CAST(TRY_STRPTIME(replace({c}, ' ', ''), '%Y%m%d') AS DATE), "
        "TRY_CAST(replace({c}, ' ', '') AS DATE))")
REAL = "CAST(CAST({x} AS FLOAT) AS DOUBLE)"
PG_INT = "CAST(round_even({x}, 0) AS INTEGER)"
KM_INT = "TRY_CAST(replace({x}, '+', '') AS INTEGER)"


def draw(side):
    return (f"(7 + ((CAST(round_even({side} * 100, 0) AS BIGINT) * 31 "
            f"+ CAST(round_even(chainage, 0) AS BIGINT)) % 101) / 100)")


STATION_CTES = f""",
pkey AS (SELECT * FROM keyt WHERE replace(event_type, ' ', '') = 'pavetype.'),
clamped AS (
  SELECT chainage, lon, lat,
         CASE WHEN CAST(iri_right AS FLOAT) > 8 THEN {draw('iri_right')} ELSE iri_right END AS iri_right,
         CASE WHEN CAST(iri_left AS FLOAT) > 8 THEN {draw('iri_left')} ELSE iri_left END AS iri_left,
         iri AS iri_old, iri_lane, rutt_right, rutt_left, rutting, texture, etd_texture, file_name
  FROM laser),
clamped2 AS (SELECT *, (iri_right + iri_left) / 2 AS iri FROM clamped),
lpic AS (
  SELECT l.*, p.chainage_pic, p.frame_number
  FROM clamped2 l LEFT JOIN pic p
    ON p.file_name = l.file_name AND l.chainage = {PG_INT.format(x='p.chainage_pic')}),
rawpic AS (
  SELECT l.*, p.chainage_pic, p.frame_number
  FROM laser l LEFT JOIN pic p
    ON p.file_name = l.file_name AND l.chainage = {PG_INT.format(x='p.chainage_pic')}),
st_grid AS (
  SELECT k.link_id, k.survey_date, s.file_name, s.lon, s.lat
  FROM pkey k JOIN rawpic s ON s.file_name = k.file_name
   AND s.chainage BETWEEN k.event_str - 5 AND k.event_end + 5
  WHERE {GRID.format(c='s.chainage')}),
st_lost AS (
  SELECT file_name, {DATE.format(c='survey_date')} AS date, link_id, count(*) AS count
  FROM st_grid WHERE {LOST.format(p='')} AND link_id IS NOT NULL GROUP BY ALL),
st_present AS (
  SELECT file_name, {DATE.format(c='survey_date')} AS date, link_id, count(*) AS count
  FROM st_grid WHERE {PRESENT.format(p='')} AND link_id IS NOT NULL GROUP BY ALL),
gps_status AS (
  SELECT file_name, date, link_id, count, 'มีGPSlost' AS status,
         CASE WHEN count > 10 THEN '***ไม่ดำเนินการต่อ' ELSE 'ดำเนินการต่อ' END AS status_type
  FROM st_lost
  UNION ALL
  SELECT p.file_name, p.date, p.link_id, p.count, 'ไม่มีGPSlost', 'ดำเนินการต่อ'
  FROM st_present p
  WHERE NOT EXISTS (SELECT 1 FROM st_lost x WHERE x.file_name = p.file_name AND x.link_id = p.link_id)),
data0 AS (
  SELECT {REAL.format(x=KM_INT.format(x='k.km_start') + ' + s.chainage - k.event_str')} AS km2,
         {DATE.format(c='k.survey_date')} AS date,
         k.event_str, k.event_end, k.event_num, k.event_type, k.event_name, k.link_id, k.section_id,
         k.km_start, k.km_end, k.length, k.lane_no, k.survey_date, k.lat_str, k.lat_end, k.lon_str,
         k.lon_end, k.ramp_id,
         s.chainage, s.lon, s.lat, s.iri_right, s.iri_left, s.iri_old, s.iri_lane, s.rutt_right,
         s.rutt_left, s.rutting, s.texture, s.etd_texture, s.iri, s.file_name, s.chainage_pic,
         s.frame_number, s.lon AS geom_lon, s.lat AS geom_lat, g.status, g.status_type
  FROM pkey k
  JOIN lpic s ON s.file_name = k.file_name
   AND s.chainage BETWEEN {PG_INT.format(x='k.event_str')} AND {PG_INT.format(x='k.event_end')}
  JOIN gps_status g ON g.file_name = s.file_name AND g.link_id = k.link_id)"""


def q(*fragments, select: str) -> str:
    return "WITH " + FIXTURE_CTES + "".join(fragments) + "\n" + select

ORD = ("chainage NULLS LAST, event_str NULLS LAST, chainage_pic NULLS LAST, "
       "frame_number NULLS LAST, date NULLS LAST, status NULLS LAST")
GAP_CTES = f""",
isl AS (
  SELECT *, row_number() OVER (PARTITION BY file_name, date, link_id ORDER BY {ORD})
          - row_number() OVER (PARTITION BY file_name, lat, lon, link_id ORDER BY {ORD}) AS grp2
  FROM data0),
islands AS (
  SELECT file_name, link_id, date, grp2, min(chainage) AS min, max(chainage) AS max,
         count(*) AS c_p, count(*) * 5 AS meter
  FROM isl WHERE lon = 0 OR lat = 0 GROUP BY ALL),
gps_lost AS (
  SELECT DISTINCT a.file_name, a.min, a.max, a.c_p, a.meter, a.link_id, a.date, a.grp2, b.chainage,
         a.min - 6 AS new_p_min, a.max + 6 AS new_p_max
  FROM islands a JOIN data0 b ON b.file_name = a.file_name AND b.chainage BETWEEN a.min AND a.max
  WHERE b.chainage % 25 = 0 AND (b.lon = 0 OR b.lat = 0) AND b.status = 'มีGPSlost')"""


def _eq(a, b, cols):
    return " AND ".join(f"{a}.{c} = {b}.{c}" for c in cols)


def interp(name, pts, tgts, gid, tid=()):
    """Point at fraction f along each group's line, segment form.
    pts: gid + (ch, x, y); tgts: gid + tid + f. Output CTE ``name``: tgts.* + lon, lat.

    The segment lengths, the total and the running fractions are left folds over the
    ordered point list (the same operation order as a sequential walk), then the first
    segment whose running end passes f is blended linearly."""
    g = ", ".join(gid)
    fold = "lambda a, b: a + b"
    return f""",
{name}_l AS (
  SELECT {g}, list(struct_pack(x := x, y := y) ORDER BY ch, x, y)
                FILTER (WHERE x IS NOT NULL AND y IS NOT NULL) AS pts
  FROM {pts} GROUP BY {g}),
{name}_g AS (
  SELECT *, len(pts) AS n,
         list_transform(range(1, len(pts)),
                        lambda i: sqrt((pts[i + 1].x - pts[i].x) ^ 2 + (pts[i + 1].y - pts[i].y) ^ 2)) AS segs
  FROM {name}_l),
{name}_g2 AS (
  SELECT *, list_reduce(list_prepend(CAST(0.0 AS DOUBLE), segs), {fold}) AS total FROM {name}_g),
{name}_g3 AS (
  SELECT *, CASE WHEN total > 0 THEN list_transform(segs, lambda s: s / total) END AS frs
  FROM {name}_g2),
{name}_g4 AS (
  SELECT *, list_transform(range(1, n), lambda i: list_reduce(
           list_prepend(CAST(0.0 AS DOUBLE), list_slice(frs, 1, i - 1)), {fold})) AS cums
  FROM {name}_g3),
{name}_h AS (
  SELECT t.*, q.n, q.pts, q.total, q.frs, q.cums,
         list_filter(range(1, q.n), lambda i: t.f < q.cums[i] + q.frs[i])[1] AS hi
  FROM {tgts} t LEFT JOIN {name}_g4 q ON {_eq('t', 'q', gid)}),
{name} AS (
  SELECT * EXCLUDE (n, pts, total, frs, cums, hi),
    CASE WHEN n IS NULL OR n = 0 THEN NULL WHEN f = 0 OR n = 1 THEN pts[1].x
         WHEN f = 1 OR total = 0 OR hi IS NULL THEN pts[n].x
         ELSE pts[hi].x + ((f - cums[hi]) / frs[hi]) * (pts[hi + 1].x - pts[hi].x) END AS lon,
    CASE WHEN n IS NULL OR n = 0 THEN NULL WHEN f = 0 OR n = 1 THEN pts[1].y
         WHEN f = 1 OR total = 0 OR hi IS NULL THEN pts[n].y
         ELSE pts[hi].y + ((f - cums[hi]) / frs[hi]) * (pts[hi + 1].y - pts[hi].y) END AS lat
  FROM {name}_h)"""


def event_pts(name, src):
    cols = "event_name, link_id, section_id, km_start, km_end, length, lane_no, date, file_name"
    return f""",
{name} AS (
  SELECT DISTINCT event_str AS chainage, {cols}, lon_str AS lon, lat_str AS lat, 'str' AS direction
  FROM {src}
  UNION
  SELECT DISTINCT event_end AS chainage, {cols}, lon_end AS lon, lat_end AS lat, 'end' AS direction
  FROM {src})"""


KST_CTES = """,
kst AS (
  SELECT DISTINCT s.file_name, s.chainage, s.lon, s.lat
  FROM pkey k JOIN laser s ON s.file_name = k.file_name
   AND s.chainage BETWEEN k.event_str - 5 AND k.event_end + 5
  WHERE replace(k.link_id, ' ', '') <> '' AND s.lon IS NOT NULL AND s.lat IS NOT NULL)"""

NEAR = "sqrt((e.lon - b.lon) ^ 2 + (e.lat - b.lat) ^ 2) <= 0.00004"


def event_fix(src, dst, end):
    return event_pts(f"{dst}_ev", src) + f""",
{dst}_e AS (
  SELECT DISTINCT e.file_name, e.chainage AS e
  FROM {dst}_ev e JOIN kst b ON b.file_name = e.file_name AND {NEAR}
  WHERE e.chainage <> b.chainage),
{dst}_nb AS (
  SELECT c.file_name, c.e, l.chainage AS ch, l.lon AS x, l.lat AS y
  FROM {dst}_e c JOIN laser l ON l.file_name = c.file_name
   AND c.e BETWEEN l.chainage - 5 AND l.chainage + 5
  WHERE l.lat <> 0 AND l.lon <> 0),
{dst}_g AS (
  SELECT file_name, e, CAST(CAST(e - min(ch) AS FLOAT) /
         CASE WHEN CAST(max(ch) - min(ch) AS FLOAT) = 0 THEN CAST(0.0001 AS FLOAT)
              ELSE CAST(max(ch) - min(ch) AS FLOAT) END AS DOUBLE) AS f
  FROM {dst}_nb GROUP BY file_name, e),
{dst}_tg AS (SELECT * FROM {dst}_g WHERE f BETWEEN 0 AND 1)""" + interp(
        f"{dst}_ip", f"{dst}_nb", f"{dst}_tg", ["file_name", "e"]) + f""",
{dst} AS (
  SELECT d.* REPLACE (
    CASE WHEN i.e IS NOT NULL THEN CAST(CAST(i.lat AS FLOAT) AS DOUBLE) ELSE d.lat_{end} END AS lat_{end},
    CASE WHEN i.e IS NOT NULL THEN CAST(CAST(i.lon AS FLOAT) AS DOUBLE) ELSE d.lon_{end} END AS lon_{end})
  FROM {src} d LEFT JOIN {dst}_ip i ON i.file_name = d.file_name AND i.e = d.event_{end})"""


EVENT_FIX_CTES = KST_CTES + event_fix("data0", "data1", "str") + event_fix("data1", "data2", "end")

GAP_WINDOW_CTES = """,
gw AS (
  SELECT a.file_name, a.chainage AS gps_lost_ch, a.c_p, a.meter, a.link_id, a.date,
         b.chainage AS ch, b.geom_lon AS x, b.geom_lat AS y
  FROM gps_lost a JOIN data2 b ON b.file_name = a.file_name
   AND b.chainage BETWEEN a.new_p_min AND a.new_p_max
  WHERE b.lon <> 0 AND b.geom_lat > 0 AND b.status = 'มีGPSlost'),
gwg AS (
  SELECT file_name, gps_lost_ch, c_p, meter, link_id, date, min(ch) AS chainage_str,
         max(ch) AS chainage_end
  FROM gw GROUP BY ALL)"""

_GID = ["file_name", "gps_lost_ch", "c_p", "meter", "link_id", "date"]


def _set_point(src, fix, on):
    return f"""
  SELECT d.* REPLACE (
    CASE WHEN g.lon IS NOT NULL OR g.hit THEN CAST(CAST(g.lon AS FLOAT) AS DOUBLE) ELSE d.lon END AS lon,
    CASE WHEN g.lon IS NOT NULL OR g.hit THEN CAST(CAST(g.lat AS FLOAT) AS DOUBLE) ELSE d.lat END AS lat,
    CASE WHEN g.lon IS NOT NULL OR g.hit THEN g.lon ELSE d.geom_lon END AS geom_lon,
    CASE WHEN g.lon IS NOT NULL OR g.hit THEN g.lat ELSE d.geom_lat END AS geom_lat)
  FROM {src} d LEFT JOIN {fix} g ON {on}"""


GAP_FILL_CTES = GAP_WINDOW_CTES + """,
gtg AS (
  SELECT file_name, gps_lost_ch, c_p, meter, link_id, date,
         CAST(CAST(gps_lost_ch - chainage_str AS FLOAT) / CAST(chainage_end - chainage_str AS FLOAT)
              AS DOUBLE) AS f
  FROM gwg WHERE CAST(chainage_end - chainage_str AS FLOAT) > 0),
gtg2 AS (SELECT * FROM gtg WHERE f BETWEEN 0 AND 1)""" + interp("gip", "gw", "gtg2", _GID) + """,
gfix AS (
  SELECT file_name, date, link_id, gps_lost_ch, lon, lat, true AS hit FROM (
    SELECT *, row_number() OVER (PARTITION BY file_name, date, link_id, gps_lost_ch
                                 ORDER BY c_p, lon, lat) AS rn FROM gip) WHERE rn = 1),
data3 AS (""" + _set_point("data2", "gfix", "g.file_name = d.file_name AND g.date = d.date AND "
                           "g.link_id = d.link_id AND g.gps_lost_ch = d.chainage") + ")"

_FG = ["file_name", "link_id", "gx", "gy", "min_c", "max_c"]
FROZEN_CTES = """,
fz_grid AS (SELECT * FROM data3 WHERE chainage % 25 = 0 AND (lon <> 0 OR lat <> 0)),
fz AS (SELECT DISTINCT file_name, geom_lon, geom_lat FROM (
        SELECT file_name, link_id, geom_lon, geom_lat FROM fz_grid GROUP BY ALL HAVING count(*) > 1)),
fm AS (
  SELECT DISTINCT g.file_name, g.link_id, g.chainage, g.geom_lon, g.geom_lat
  FROM fz_grid g JOIN fz f ON f.file_name = g.file_name AND f.geom_lon = g.geom_lon
   AND f.geom_lat = g.geom_lat
  WHERE g.status = 'มีGPSlost'),
fg AS (SELECT file_name, link_id, geom_lon, geom_lat, min(chainage) - 25 AS min_c,
              max(chainage) + 25 AS max_c FROM fm GROUP BY ALL),
fa AS (
  SELECT g.file_name, g.link_id, g.geom_lon AS gx, g.geom_lat AS gy, g.min_c, g.max_c,
         d.chainage AS ch, d.geom_lon AS x, d.geom_lat AS y
  FROM fg g JOIN data3 d ON d.file_name = g.file_name AND (d.chainage = g.min_c OR d.chainage = g.max_c)),
fl AS (SELECT file_name, link_id, gx, gy, min_c, max_c FROM fa GROUP BY ALL
       HAVING count(DISTINCT ch) = 2),
ft AS (
  SELECT l.file_name, l.link_id, l.gx, l.gy, l.min_c, l.max_c, m.chainage,
         CAST(CAST(m.chainage - l.min_c AS FLOAT) / CAST(l.max_c - l.min_c AS FLOAT) AS DOUBLE) AS f
  FROM fm m JOIN fl l ON m.file_name = l.file_name AND m.link_id = l.link_id
   AND m.geom_lon = l.gx AND m.geom_lat = l.gy
  WHERE CAST(m.chainage - l.min_c AS FLOAT) > 0
    AND CAST(m.chainage - l.min_c AS FLOAT) < CAST(l.max_c - l.min_c AS FLOAT))""" + interp(
    "fip", "fa", "ft", _FG, ["chainage"]) + """,
ffix AS (
  SELECT file_name, link_id, chainage, lon, lat, true AS hit FROM (
    SELECT *, row_number() OVER (PARTITION BY file_name, link_id, chainage ORDER BY lon, lat) AS rn
    FROM fip) WHERE rn = 1),
data4 AS (""" + _set_point("data3", "ffix", "g.file_name = d.file_name AND g.link_id = d.link_id "
                           "AND g.chainage = d.chainage") + ")"
