"""DuckDB SQL deriving the same survey inputs from ``events``.

Independent re-statement of pavespark/sources/fixtures.py in plain SQL; the
CTEs defined here (laser, keyt, pic, pave, ...) open every oracle query.
"""

LOST = ("(((i % 97) BETWEEN 40 AND 44 AND (r + i // 100) % 4 <> 1) "
        "OR (r % 3 = 1 AND i BETWEEN 210 AND 279) OR (r % 2 = 0 AND i BETWEEN 94 AND 99))")
P = "(CASE WHEN i BETWEEN 300 AND 310 THEN 300 ELSE i END)"
Q = "(CASE WHEN i BETWEEN 200 AND 204 THEN 200 ELSE i END)"


def lon(p):
    return f"((100500000 + 10000 * (r % 50) + 46 * ({p})) / 1e6)"


def lat(p):
    return f"((13700000 + 12 * ({p})) / 1e6)"


def digits(number, width):
    return f"lpad(CAST({number} AS VARCHAR), CAST(greatest({width}, length(CAST({number} AS VARCHAR))) AS INTEGER), '0')"


def link(k):
    return (f"(CASE WHEN {k} % 2 = 0 THEN '1' ELSE '3' END || {digits('q', 4)} || "
            f"lpad(CAST({k} AS VARCHAR), 2, '0') || '0201' || CASE WHEN {k} < 3 THEN 'L' ELSE 'R' END || "
            f"CAST(1 + (q + {k}) % 6 AS VARCHAR) || CASE WHEN (q + {k}) % 2 = 0 THEN 'CC' ELSE 'AC' END || '01')")


def real(x):
    return f"CAST(CAST({x} AS FLOAT) AS DOUBLE)"


EV_STR = "(2500 * b + CASE WHEN k = 5 THEN 0 WHEN k = 6 THEN 2480 ELSE 500 * k - 2 * (k % 2) END)"
EV_END = ("(2500 * b + CASE WHEN k = 5 THEN 2495 WHEN k = 6 THEN 2495 "
          "ELSE 500 * k + 475 + CASE WHEN k = 1 AND q % 2 = 0 THEN 25 ELSE 0 END END)")
SWAP = "(k IN (3, 4) AND NOT (q % 5 = 0 AND k = 4))"
ZERO = "(k = 5 OR (q % 6 = 0 AND k = 0))"
KM_A = "('1' || CAST(2 + k + 5 * b AS VARCHAR) || '+000')"
KM_B = "('1' || CAST(2 + k + 5 * b AS VARCHAR) || '+475')"
PS = f"ceil({EV_STR} / 5)"
PE = f"(ceil({EV_END} / 5) + CASE WHEN k = 3 THEN 1 ELSE 0 END)"

def layout_ri(layout=None):
    """Run and station index per event for a layout (default: uniform)."""
    if layout == "hot":
        hot = "((event_id // 500) % 3 = 0)"
        return (f"(CASE WHEN {hot} THEN 0 ELSE event_id // 500 END)",
                f"(CASE WHEN {hot} THEN ((event_id // 500) // 3) * 500 + event_id % 500 "
                f"ELSE event_id % 500 END)")
    return "(event_id // 500)", "(event_id % 500)"


def ev_cte(layout=None):
    r, i = layout_ri(layout)
    return f"""
ev AS (
  SELECT event_id AS e, {r} AS r, {i} AS i,
         CAST(round(value * 100) AS BIGINT) AS w,
         '20240101 ' || {digits(f'({r} + 1)', 4)} AS file_name
  FROM events),"""


FIXTURE_CTES = ev_cte() + f"""
gps_x AS (
  SELECT file_name, CAST(5 * i AS DOUBLE) AS chainage_x,
         CASE WHEN {LOST} THEN 0.0 ELSE {lon(P)} END AS lon_x,
         CASE WHEN {LOST} THEN 0.0 ELSE {lat(P)} END AS lat_x
  FROM ev),
iri_x AS (
  SELECT file_name, CAST(5 * i AS DOUBLE) AS chainage_x,
         CASE WHEN e % 211 = 0 THEN NULL ELSE (w % 1000) / 1e2 END AS rwp,
         CASE WHEN e % 211 = 0 THEN NULL ELSE ((w * 7) % 1000) / 1e2 END AS lwp,
         ((w * 3) % 800) / 1e2 AS lane_iri
  FROM ev),
tpl_x AS (
  SELECT file_name, CAST(5 * i AS DOUBLE) AS chainage_x, ((w * 11) % 1500) / 1e2 AS rut_edg,
         ((w * 13) % 1500) / 1e2 AS rut_ctr, ((w * 17) % 1500) / 1e2 AS rut_se
  FROM ev WHERE e % 233 <> 0),
mpd_x AS (
  SELECT file_name, CAST(5 * i AS DOUBLE) AS chainage_x, ((w * 19) % 200) / 1e2 AS lane_mpd
  FROM ev WHERE e % 241 <> 0),
laser AS (
  SELECT {real('g.chainage_x')} AS chainage, {real('g.lon_x')} AS lon, {real('g.lat_x')} AS lat,
         a.rwp AS iri_right, a.lwp AS iri_left, (a.rwp + a.lwp) / 2 AS iri,
         CAST(a.lane_iri AS DECIMAL(8,2)) AS iri_lane, CAST(t.rut_edg AS DECIMAL(8,2)) AS rutt_right,
         CAST(t.rut_ctr AS DECIMAL(8,2)) AS rutt_left, CAST(t.rut_se AS DECIMAL(8,2)) AS rutting,
         CAST(m.lane_mpd AS DECIMAL(8,2)) AS texture,
         CAST(m.lane_mpd * 0.8 + 0.008 AS DECIMAL(8,2)) AS etd_texture, g.file_name
  FROM gps_x g
  LEFT JOIN iri_x a ON a.file_name = g.file_name AND a.chainage_x = g.chainage_x
  LEFT JOIN tpl_x t ON t.file_name = g.file_name AND t.chainage_x = g.chainage_x
  LEFT JOIN mpd_x m ON m.file_name = g.file_name AND m.chainage_x = g.chainage_x),
kev AS (SELECT r, i % 500 AS k, i // 500 AS b, r + i // 500 AS q, file_name FROM ev WHERE i % 500 < 7),
keyt AS (
  SELECT {real(EV_STR)} AS event_str, {real(EV_END)} AS event_end,
         lpad(CAST(k AS VARCHAR), 2, '0') AS event_num,
         CASE WHEN k = 5 THEN 'other.' ELSE 'pavetype.' END AS event_type,
         CASE WHEN k = 5 THEN 'other' WHEN k = 6 THEN 'construction'
              ELSE 'link ' || CAST(k AS VARCHAR) END AS event_name,
         CASE WHEN k = 5 THEN NULL WHEN k = 6 THEN 'construction'
              WHEN k = 2 AND q % 9 = 0 THEN {link('0')} ELSE {link('k')} END AS link_id,
         CASE WHEN k = 5 THEN NULL ELSE CAST(1000 * r + 10 * b + k AS VARCHAR) END AS section_id,
         CASE WHEN k = 5 THEN '10+000' WHEN k = 6 THEN '17+000' WHEN {SWAP} THEN {KM_B} ELSE {KM_A} END AS km_start,
         CASE WHEN k = 5 THEN '12+495' WHEN k = 6 THEN '17+015' WHEN {SWAP} THEN {KM_A} ELSE {KM_B} END AS km_end,
         CASE WHEN k = 5 THEN '2.495' WHEN k = 6 THEN '0.015' ELSE '0.475' END AS length,
         CASE WHEN k = 5 THEN NULL WHEN q % 7 = 0 AND k = 1 THEN NULL WHEN k = 2 THEN 'F1'
              WHEN k = 3 THEN 'R' ELSE '1' END AS lane_no,
         CASE WHEN q % 3 = 2 THEN '20240101' ELSE '2024-01-01' END AS survey_date,
         {real(f"CASE WHEN {ZERO} THEN 0.0 ELSE {lat(PS)} END")} AS lat_str,
         {real(f"CASE WHEN {ZERO} THEN 0.0 ELSE {lat(PE)} END")} AS lat_end,
         {real(f"CASE WHEN {ZERO} THEN 0.0 ELSE {lon(PS)} END")} AS lon_str,
         {real(f"CASE WHEN {ZERO} THEN 0.0 ELSE {lon(PE)} END")} AS lon_end,
         file_name,
         CASE WHEN k IN (1, 3) AND q % 4 <> 0 THEN 'RP' || CAST(k AS VARCHAR) END AS ramp_id
  FROM kev),
pic AS (
  SELECT {real('5 * i')} AS chainage_pic, CAST(i AS VARCHAR) AS frame_number, file_name
  FROM ev WHERE i % 50 <> 45),
pave AS (
  SELECT {real('3 * i')} AS chainage_pic, CAST(i AS VARCHAR) AS frame_number,
         CASE WHEN i % 83 BETWEEN 20 AND 24 THEN 0.0
              ELSE (100500000 + 10000 * (r % 50) + 28 * {Q}) / 1e6 END AS lon,
         CASE WHEN i % 83 BETWEEN 20 AND 24 THEN 0.0 ELSE (13700000 + 7 * {Q}) / 1e6 END AS lat,
         file_name
  FROM ev)"""
