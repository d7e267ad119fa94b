import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from terrafold.functions import hilbert, mercator


def test_known_station(spark):
    row = spark.range(1).select(mercator.lon_to_x(F.lit(139.7671)).alias("x"),
                                mercator.lat_to_y(F.lit(35.6812)).alias("y")).first()
    assert row["y"] == pytest.approx(6378137 * math.asinh(math.tan(math.radians(35.6812))), abs=1e-6)
    assert row["x"] == pytest.approx(15558802.4, abs=0.1)


def test_inverse_and_zones(spark):
    df = spark.createDataFrame([(139.7, 35.6), (-179.9, -60.0), (0.0, 0.0), (180.0, 84.0)],
                               "lon double, lat double")
    back = df.select("lon", "lat", mercator.x_to_lon(mercator.lon_to_x(F.col("lon"))).alias("lon2"),
                     mercator.y_to_lat(mercator.lat_to_y(F.col("lat"))).alias("lat2"),
                     mercator.utm_zone(F.col("lon")).alias("zone")).collect()
    for r in back:
        assert r["lon"] == pytest.approx(r["lon2"], abs=1e-9)
        assert r["lat"] == pytest.approx(r["lat2"], abs=1e-9)
    assert [r["zone"] for r in back] == [54, 1, 31, 60]


def test_utm_published_values(spark):
    # On the central meridian the easting is exact and the northing is 0.9996
    # times the meridian arc; 5,540,847.042 m is the arc to 50 degrees on WGS 84.
    df = spark.createDataFrame([(141.0, 50.0), (141.0, -50.0), (100.0, 0.0)], "lon double, lat double")
    rows = mercator.with_utm(df, F.col("lon"), F.col("lat"), 54, "e", "n").collect()
    assert rows[0]["e"] == pytest.approx(500000, abs=1e-6)
    assert rows[0]["n"] == pytest.approx(0.9996 * 5540847.042, abs=0.01)
    assert rows[1]["n"] == pytest.approx(10_000_000 - rows[0]["n"], abs=1e-6)
    assert rows[2]["e"] is None  # 41 degrees off the meridian


def test_utm_of_points_equals_utm_of_rows(spark):
    df = spark.createDataFrame([(15558802.0, 4256867.0)], "x double, y double")
    lonlat = df.withColumn("lon", mercator.x_to_lon(F.col("x"))).withColumn(
        "lat", mercator.y_to_lat(F.col("y")))
    row = mercator.with_utm(lonlat, F.col("lon"), F.col("lat"), 54, "e", "n").withColumn(
        "p", mercator.utm_points(F.array(F.struct("x", "y")), F.lit(54))[0]).first()
    assert (row["p"]["x"], row["p"]["y"]) == (row["e"], row["n"])


def test_lonlat_guard():
    mercator.lonlat_measure_guard("EPSG:4326")
    with pytest.raises(ValueError, match="lon/lat"):
        mercator.lonlat_measure_guard("EPSG:3857")


def by_levels(x, y):
    """The curve one level at a time: the definition the scan must equal."""
    d = 0
    for k in range(15, -1, -1):
        w = 1 << k
        rx, ry = int(x & w != 0), int(y & w != 0)
        d += w * w * ((3 * rx) ^ ry)
        if ry == 0:
            if rx:
                x, y = 65535 - x, 65535 - y
            x, y = y, x
    return d


def test_hilbert_equals_its_definition(spark):
    rng = np.random.default_rng(7)
    cells = [(int(x), int(y)) for x, y in rng.integers(0, 65536, (400, 2))]
    cells += [(0, 0), (65535, 0), (0, 65535), (65535, 65535), (32768, 32767)]
    df = spark.createDataFrame(cells, "x bigint, y bigint")
    got = hilbert.with_cell_index(df, F.col("x"), F.col("y"), "k").collect()
    assert all(r["k"] == by_levels(r["x"], r["y"]) for r in got)


def test_neighbours_on_the_curve_are_neighbours_on_the_map(spark):
    side = 64
    df = spark.range(side * side).select((F.col("id") % side).alias("x"),
                                         F.floor(F.col("id") / side).alias("y"))
    rows = sorted(hilbert.with_cell_index(df, F.col("x"), F.col("y"), "k").collect(),
                  key=lambda r: r["k"])
    assert [r["k"] for r in rows] == list(range(side * side))
    for a, b in zip(rows, rows[1:]):
        assert abs(a["x"] - b["x"]) + abs(a["y"] - b["y"]) == 1


def test_cells_clamp_at_the_edge_and_null_stays_null(spark):
    h = math.pi * 6378137.0
    df = spark.createDataFrame([(-h * 2,), (-h,), (h,), (h * 2,)], "c double")
    assert [r[0] for r in df.select(hilbert.axis_cell(F.col("c"))).collect()] == [0, 0, 65535, 65535]
    none = spark.sql("SELECT cast(NULL AS struct<xmin:double,ymin:double,xmax:double,ymax:double>) AS bbox")
    assert hilbert.with_hilbert_key(none, "k").first()["k"] is None


def test_true_measures_need_no_zone(spark):
    """A park's size, a cap that spans the globe, and lines along a parallel and a meridian."""
    import math

    import shapes as g
    from terrafold.functions import measures

    half = mercator.HALF_SIDE
    y = mercator.EARTH_RADIUS * math.asinh(math.tan(math.radians(35.671)))
    x = 15554000.0
    side = math.sqrt(810035.0)
    park = g.polygon([[(x, y), (x + side, y), (x + side, y + side), (x, y + side), (x, y)]])
    tall = mercator.EARTH_RADIUS * math.asinh(math.tan(math.radians(60.0)))
    band = g.polygon([[(-half, -tall), (half, -tall), (half, tall), (-half, tall), (-half, -tall)]])
    holed = g.polygon([g.square(0, 0, 1e6), g.square(0, 0, 5e5)])
    equator, meridian = g.line([(0.0, 0.0), (half, 0.0)]), g.line([(0.0, 0.0), (0.0, tall)])
    rows = [(i, bytearray(w)) for i, w in enumerate((park, band, holed, g.polygon([g.square(0, 0, 1e6)]),
                                                     g.polygon([g.square(0, 0, 5e5)]), equator, meridian))]
    df = spark.createDataFrame([*rows, (7, None)], "k int, way binary").orderBy("k").select(
        measures.true_area("way").alias("a"), measures.true_length("way").alias("l"))
    got = df.collect()
    assert math.isclose(got[0]["a"], 533203, rel_tol=1e-3)
    # The ellipsoid between 60 degrees south and north, from its authalic function.
    e = math.sqrt(mercator.FLATTENING * (2 - mercator.FLATTENING))
    s = math.sin(math.radians(60))
    q = (1 - e * e) * (s / (1 - e * e * s * s) + math.atanh(e * s) / e)
    assert math.isclose(got[1]["a"], 2 * math.pi * mercator.EARTH_RADIUS ** 2 * q, rel_tol=1e-9)
    assert math.isclose(got[2]["a"], got[3]["a"] - got[4]["a"], rel_tol=1e-12)
    assert math.isclose(got[5]["l"], math.pi * mercator.EARTH_RADIUS, rel_tol=1e-12)
    assert math.isclose(got[6]["l"], 6654072.819, rel_tol=1e-6)  # the arc to 60 degrees
    assert got[7]["a"] is None and got[7]["l"] is None
