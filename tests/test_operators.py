"""Custom operators against brute force, and their semantic edge cases."""

import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from pavespark.operators.geometry import add_point_at, length_m, line_agg
from pavespark.operators.joins import near_join, range_join
from pavespark.operators.smoothing import smooth_measures
from pavespark.operators.windows import global_row_number, ordered_index, rolling_sums


def test_range_join_equals_brute_force(spark):
    rnd = random.Random(7)
    pts = [(f"r{rnd.randint(0, 2)}", float(rnd.randint(0, 3000))) for _ in range(400)]
    ivs = []
    for k in range(40):
        lo = rnd.randint(-50, 3000)
        ivs.append((f"r{rnd.randint(0, 2)}", k, float(lo), float(lo + rnd.randint(-10, 900))))
    p = spark.createDataFrame(pts, "file_name string, x double")
    iv = spark.createDataFrame(ivs, "file_name string, k int, lo double, hi double")
    got = sorted(tuple(r) for r in range_join(p, iv, "x", F.col("lo"), F.col("hi"), width=97.0)
                 .select("file_name", "x", "k").collect())
    want = sorted((a, x, k) for a, x in pts for b, k, lo, hi in ivs if a == b and lo <= x <= hi)
    assert got == want
    left = range_join(p, iv, "x", F.col("lo"), F.col("hi"), how="left", width=97.0)
    assert left.where(F.col("k").isNull()).count() == len(
        [1 for a, x in pts if not any(a == b and lo <= x <= hi for b, _, lo, hi in ivs)])


def test_range_join_with_extent_clip(spark):
    p = spark.createDataFrame([("r", 0.0), ("r", 500.0)], "file_name string, x double")
    iv = spark.createDataFrame([("r", 1, -1e9, 1e9)], "file_name string, k int, lo double, hi double")
    ext = p.groupBy("file_name").agg(F.min("x").alias("_xmin"), F.max("x").alias("_xmax"))
    assert range_join(p, iv, "x", F.col("lo"), F.col("hi"), extent=ext).count() == 2


def test_near_join_equals_brute_force(spark):
    rnd = random.Random(3)
    eps = 0.00004
    a = [("r", i, 100.5 + rnd.randint(0, 50) * 1e-5, 13.7 + rnd.randint(0, 50) * 1e-5) for i in range(60)]
    b = [("r", j, 100.5 + rnd.randint(0, 50) * 1e-5, 13.7 + rnd.randint(0, 50) * 1e-5) for j in range(200)]
    da = spark.createDataFrame(a, "file_name string, i int, x double, y double")
    db = spark.createDataFrame(b, "file_name string, j int, bx double, by double")
    got = sorted((r["i"], r["j"]) for r in near_join(da, db, eps, ["file_name"], "x", "y", "bx", "by").collect())
    want = sorted((i, j) for _, i, x, y in a for _, j, bx, by in b
                  if ((x - bx) ** 2 + (y - by) ** 2) ** 0.5 <= eps)
    assert got == want


def test_ordered_index_equals_row_number(spark):
    rnd = random.Random(11)
    rows = [(f"r{rnd.randint(0, 3)}", float(rnd.randint(0, 20000)), rnd.randint(0, 5)) for _ in range(3000)]
    df = spark.createDataFrame(rows, "file_name string, chainage double, t int").distinct()
    w = Window.partitionBy("file_name").orderBy("chainage", "t")
    want = df.withColumn("want", F.row_number().over(w) - 1)
    got = ordered_index(want, ["file_name"], ["chainage", "t"], name="got",
                        chunk=F.floor(F.col("chainage") / 1000))
    assert got.where(F.col("got") != F.col("want")).count() == 0
    got2 = ordered_index(want, ["file_name"], ["chainage", "t"], name="got")  # range method
    assert got2.where(F.col("got") != F.col("want")).count() == 0
    g = global_row_number(df, ["chainage", "file_name", "t"], "gid", start=2)
    ids = [r["gid"] for r in g.select("gid").collect()]
    assert sorted(ids) == list(range(2, 2 + df.count()))


def test_rolling_sums_equal_the_window(spark):
    """Chunks of many, few and single rows; runs of every length; null values and positions."""
    rnd = random.Random(5)
    rows = [("r" + str(i % 2), float(rnd.randint(0, 3000)), i, None if rnd.random() < 0.1 else rnd.randint(0, 1000))
            for i in range(700)]
    rows += [(f"short{n}", 100.0 * i, i, i + 1) for n in range(1, 7) for i in range(n)]
    rows += [("none", None, i, 5) for i in range(12)]
    df = spark.createDataFrame(rows, "file_name string, x double, t long, v long")
    w = Window.partitionBy("file_name").orderBy(F.col("x").asc_nulls_last(), "t")
    for width, before, after in ((10.0, 4, 4), (100.0, 4, 4), (1e6, 4, 4), (7.0, 2, 5), (50.0, 0, 3), (50.0, 3, 0)):
        ref = df.withColumn("want", F.coalesce(F.sum("v").over(w.rowsBetween(-before, after)), F.lit(0)))
        chunk = F.coalesce(F.floor(F.col("x") / width), F.lit(1 << 40))
        got = rolling_sums(ref, ["file_name"], ["x", "t"], chunk, before, after, {"got": F.col("v")})
        assert got.count() == len(rows)
        assert got.where(~F.col("got").eqNullSafe(F.col("want"))).count() == 0


def test_islands_do_not_depend_on_chunks(spark):
    """The same islands whether a link is one chunk or hundreds; nulls in dates and coordinates."""
    from pavespark.operators.linear import lost_islands
    rnd = random.Random(9)
    rows = []
    for run in ("a", "b"):
        for link in ("x", "y"):
            for i in range(300):
                lost = (i // 7) % 3 == 0 or rnd.random() < 0.05
                lat, lon = (0.0, rnd.choice([0.0, 0.0, 1.0, None])) if lost else (13.0 + i, 100.0)
                rows.append((run, link, rnd.choice(["d1", "d2", None]), 5.0 * i, lat, lon, rnd.randint(0, 9) * 1000 + i))
    df = spark.createDataFrame(rows, "file_name string, link_id string, date string, chainage double, lat double, "
                                     "lon double, tie int")
    along = Window.partitionBy("file_name", "date", "link_id").orderBy("chainage", "tie")
    same = Window.partitionBy("file_name", "lat", "lon", "link_id").orderBy("chainage", "tie")
    want = (df.withColumn("grp2", F.row_number().over(along) - F.row_number().over(same)).where("lat = 0 OR lon = 0")
            .groupBy("file_name", "link_id", "date", "grp2")
            .agg(F.min("chainage").alias("min"), F.max("chainage").alias("max"), F.count("*").alias("c_p")))
    for width in (1e6, 100.0, 5.0):
        got = lost_islands(df, "chainage", ["tie"], 5, chunk_m=width)
        assert sorted(map(str, got.drop("meter").collect())) == sorted(map(str, want.collect()))


def test_q07_smoothing_edges_and_nulls(spark):
    from decimal import Decimal
    cols = ("chainage double, event_str double, link_id string, chainage_pic double, frame_number string, "
            "file_name string, iri_right double, iri_left double, iri_lane decimal(8,2), rutt_right decimal(8,2), "
            "rutt_left decimal(8,2), rutting decimal(8,2), texture decimal(8,2), etd_texture decimal(8,2), iri double")
    d = Decimal
    rows = []
    for i in range(12):
        v = None if i == 6 else float(i + 1)
        rows.append((5.0 * i, 0.0, "L", None, None, "r", v, 1.0, d("1.00"), d("2.00"), d("1.00"), d("9.99"),
                     d("0.10"), d("0.20"), 0.0))
    out = {r["chainage"]: r for r in smooth_measures(spark.createDataFrame(rows, cols)).collect()}
    # first row: 1+2+3+4+5 / 9 = 1.666.. -> 1.67 (divides by 9 at the edge)
    assert out[0.0]["iri_right"] == d("1.67")
    # NULL current -> NULL; NULL neighbour counts as 0: row 5 sums 2..10 without 7 -> 47/9
    assert out[30.0]["iri_right"] is None and out[30.0]["iri"] is None
    assert out[25.0]["iri_right"] == d(str(round(47 / 9 + 1e-9, 2)))
    # iri from unrounded sides: (sum_left + sum_right) / 18
    assert out[0.0]["iri"] == d("1.11")  # (15 + 5) / 18 = 1.111
    assert out[0.0]["rutting"] == d("0.83")  # (5*2 + 5*1)/18 = 0.833


def _line(spark, pts, f):
    df = spark.createDataFrame([("g", c, x, y, f) for c, x, y in pts],
                               "g string, chainage double, lon double, lat double, f double")
    lines = df.groupBy("g", "f").agg(line_agg().alias("line"))
    r = add_point_at(lines, "line", "f", "pt").select("pt.lon", "pt.lat").collect()[0]
    return r[0], r[1]


def test_interpolation_semantics(spark):
    pts = [(0.0, 0.0, 0.0), (5.0, 1.0, 0.0), (10.0, 1.0, 1.0)]
    assert _line(spark, pts, 0.0) == (0.0, 0.0)
    assert _line(spark, pts, 1.0) == (1.0, 1.0)
    x, y = _line(spark, pts, 0.25)
    assert abs(x - 0.5) < 1e-12 and y == 0.0
    x, y = _line(spark, pts, 0.75)
    assert x == 1.0 and abs(y - 0.5) < 1e-12
    # zero-length segment (duplicate boundary station) is skipped
    x, y = _line(spark, [(0.0, 0.0, 0.0), (5.0, 1.0, 0.0), (5.0, 1.0, 0.0), (10.0, 2.0, 0.0)], 0.6)
    assert abs(x - 1.2) < 1e-12
    # single point and all-equal points
    assert _line(spark, [(0.0, 3.0, 4.0)], 0.5) == (3.0, 4.0)
    assert _line(spark, [(0.0, 3.0, 4.0), (5.0, 3.0, 4.0)], 0.5) == (3.0, 4.0)


def test_ellipsoidal_length(spark):
    # 0.001 deg of latitude at 13.7 N is about 110.64 m; of longitude about 108.17 m
    df = spark.createDataFrame([("a", 0.0, 100.5, 13.7), ("a", 1.0, 100.5, 13.701),
                                ("b", 0.0, 100.5, 13.7), ("b", 1.0, 100.501, 13.7)],
                               "g string, chainage double, lon double, lat double")
    r = {x["g"]: x["m"] for x in df.groupBy("g").agg(line_agg().alias("l"))
         .select("g", length_m("l").alias("m")).collect()}
    assert abs(r["a"] - 110.64) < 0.05 and abs(r["b"] - 108.17) < 0.05


def _vincenty_m(lon1, lat1, lon2, lat2):
    """Geodesic distance on WGS84 (Vincenty inverse), metres -- reference for the test."""
    import math
    a, f = 6378137.0, 1 / 298.257223563
    b = a * (1 - f)
    L = math.radians(lon2 - lon1)
    U1, U2 = math.atan((1 - f) * math.tan(math.radians(lat1))), math.atan((1 - f) * math.tan(math.radians(lat2)))
    sinU1, cosU1, sinU2, cosU2 = math.sin(U1), math.cos(U1), math.sin(U2), math.cos(U2)
    lam = L
    for _ in range(200):
        sl, cl = math.sin(lam), math.cos(lam)
        sin_s = math.hypot(cosU2 * sl, cosU1 * sinU2 - sinU1 * cosU2 * cl)
        if sin_s == 0:
            return 0.0
        cos_s = sinU1 * sinU2 + cosU1 * cosU2 * cl
        sig = math.atan2(sin_s, cos_s)
        sin_a = cosU1 * cosU2 * sl / sin_s
        cos2a = 1 - sin_a ** 2
        c2sm = cos_s - 2 * sinU1 * sinU2 / cos2a if cos2a else 0.0
        C = f / 16 * cos2a * (4 + f * (4 - 3 * cos2a))
        prev, lam = lam, L + (1 - C) * f * sin_a * (sig + C * sin_s * (c2sm + C * cos_s * (-1 + 2 * c2sm ** 2)))
        if abs(lam - prev) < 1e-13:
            break
    u2 = cos2a * (a * a - b * b) / (b * b)
    A = 1 + u2 / 16384 * (4096 + u2 * (-768 + u2 * (320 - 175 * u2)))
    B = u2 / 1024 * (256 + u2 * (-128 + u2 * (74 - 47 * u2)))
    ds = B * sin_s * (c2sm + B / 4 * (cos_s * (-1 + 2 * c2sm ** 2) - B / 6 * c2sm * (-3 + 4 * sin_s ** 2) * (-3 + 4 * c2sm ** 2)))
    return b * A * (sig - ds)


def test_q19_length_matches_geodesic(spark):
    rnd = random.Random(19)
    rows, want = [], {}
    for g in range(30):
        lat0, lon0 = rnd.uniform(-60, 60), rnd.uniform(-170, 170)
        pts = [(lon0, lat0)]
        for _ in range(20):  # 25 m-ish steps in random directions
            lon, lat = pts[-1]
            pts.append((lon + rnd.uniform(-2.5e-4, 2.5e-4), lat + rnd.uniform(-2.5e-4, 2.5e-4)))
        want[g] = sum(_vincenty_m(*pts[i], *pts[i + 1]) for i in range(len(pts) - 1))
        rows += [(g, float(i), x, y) for i, (x, y) in enumerate(pts)]
    df = spark.createDataFrame(rows, "g int, chainage double, lon double, lat double")
    got = {r["g"]: r["m"] for r in df.groupBy("g").agg(line_agg().alias("l"))
           .select("g", length_m("l").alias("m")).collect()}
    for g, m in want.items():
        assert abs(got[g] - m) < 0.01, (g, got[g], m)   # far below the 1 m of numeric(8,3) km


def test_line_agg_skips_null_points(spark):
    df = spark.createDataFrame([("g", 0.0, 1.0, 2.0), ("g", 5.0, None, 2.5), ("g", 10.0, 3.0, 4.0)],
                               "g string, chainage double, lon double, lat double")
    r = df.groupBy("g").agg(line_agg().alias("l"), F.min("chainage").alias("c0")).first()
    assert [(p["chainage"], p["lon"]) for p in r["l"]] == [(0.0, 1.0), (10.0, 3.0)]
    assert r["c0"] == 0.0
