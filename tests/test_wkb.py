import math
import tracemalloc

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import shapes as g
from terrafold.functions import wkb

SHELL, HOLE = g.square(5, 5, 5), g.square(3, 3, 1)


def values(fn, *columns):
    return fn.func(*[pa.array(c, pa.binary() if isinstance(c[0], (bytes, type(None))) else None)
                     for c in columns]).to_pylist()


def test_envelope_of_every_type_and_byte_order():
    cases = {
        g.point(1, 2): (1, 2, 1, 2),
        g.point(1, 2, ">"): (1, 2, 1, 2),
        g.point_z(1, 2, 99): (1, 2, 1, 2),
        g.ewkb_point(1, 2, 3857): (1, 2, 1, 2),
        g.line([(0, 0), (3, -4)], ">"): (0, -4, 3, 0),
        g.polygon([SHELL, HOLE]): (0, 0, 10, 10),
        g.multi(6, [g.polygon([SHELL]), g.polygon([g.square(30, 5, 1)], ">")]): (0, 0, 31, 10),
        g.multi(7, [g.point(5, 5), g.multi(4, [g.point(7, 8), g.point(-1, 0)])]): (-1, 0, 7, 8),
    }
    got = values(wkb.envelope, [*cases, None, g.point(math.nan, math.nan), g.multi(6, [])])
    assert [tuple(b.values()) for b in got[:-3]] == list(cases.values())
    assert got[-3:] == [None, None, None]


def test_empty_batch():
    assert len(wkb.envelope.func(pa.array([], pa.binary()))) == 0


def test_sliced_batches_are_read_from_their_offset():
    arr = pa.array([g.point(i, -i) for i in range(10)], pa.binary()).slice(4, 3)
    assert [b["xmin"] for b in wkb.envelope.func(arr).to_pylist()] == [4, 5, 6]


def test_round_trips():
    polygons = [g.polygon([SHELL, HOLE]), None, g.polygon([HOLE])]
    rings = wkb.ring_points.func(pa.array(polygons, pa.binary()))
    assert wkb.make_polygon_with_holes.func(rings).to_pylist() == polygons
    box = [pa.array([v, None]) for v in (0.0, 0.0, 10.0, 10.0)]
    assert wkb.make_box.func(*box).to_pylist() == [g.polygon([SHELL]), None]
    assert wkb.make_point.func(pa.array([1.0, None]), pa.array([2.0, 3.0])).to_pylist() == [
        g.point(1, 2), None]


def test_measures():
    assert values(wkb.planar_area, [g.polygon([SHELL, HOLE]), g.line(SHELL), None]) == [96, 0, None]
    assert values(wkb.planar_length, [g.line([(0, 0), (3, 4)]), g.point(1, 1)]) == [5, 0]
    # A small ring far from the origin keeps its digits.
    far = g.polygon([g.square(15_558_758, 4_256_850, 5)])
    assert values(wkb.planar_area, [far]) == [100]


def test_distance():
    pairs = [(g.point(5, 5), g.polygon([SHELL, HOLE]), 0), (g.point(3, 3), g.polygon([SHELL, HOLE]), 1),
             (g.point(13, 14), g.polygon([SHELL]), 5), (g.point(0, 0), g.point(3, 4), 5),
             (g.point(2, 3), g.line([(0, 0), (4, 0)]), 3), (g.point(1, 1), None, None)]
    a, b, want = zip(*pairs, strict=True)
    assert values(wkb.planar_distance, list(a), list(b)) == list(want)
    with pytest.raises(ValueError, match="one Point"):
        values(wkb.planar_distance, [g.line(SHELL)], [g.point(0, 0)])


def test_box_intersection():
    def hits(shape, *box):
        return wkb.intersects_box.func(pa.array([shape], pa.binary()),
                                       *[pa.array([float(v)]) for v in box]).to_pylist()[0]

    ringed = g.polygon([SHELL, HOLE])
    assert not hits(ringed, 2.5, 2.5, 3.5, 3.5)      # wholly in the hole
    assert hits(ringed, 2.5, 2.5, 4.5, 3.5)          # across the hole's edge
    assert hits(ringed, 6, 6, 7, 7)                  # wholly in the body
    assert hits(ringed, -5, -5, 50, 50)              # around everything
    assert hits(ringed, 10, 10, 11, 11)              # touching a corner
    assert not hits(ringed, 10.1, 10, 11, 11)
    assert hits(g.line([(0, 5), (5, 0)]), 2, 2, 3, 3)
    assert not hits(g.line([(0, 5), (5, 0)]), 3, 3, 4, 4)  # its covering meets the box
    assert hits(g.point(3, 3), 3, 3, 4, 4)


def test_kind_from_header(spark):
    cases = [(g.point(1, 2), "Point"), (g.point(1, 2, ">"), "Point"), (g.point_z(1, 2, 3), "Point Z"),
             (g.ewkb_point(1, 2, 3857), "Point"), (g.line(SHELL), "LineString"),
             (g.multi(6, []), "MultiPolygon"), (g.multi(7, []), "GeometryCollection"), (None, None)]
    df = spark.createDataFrame([(i, bytearray(b) if b else None) for i, (b, _) in enumerate(cases)],
                               "i int, way binary")
    got = df.select("i", wkb.geometry_kind(F.col("way")).alias("k")).orderBy("i").collect()
    assert [r["k"] for r in got] == [k for _, k in cases]


def test_unknown_type_is_refused():
    with pytest.raises(ValueError, match="unknown WKB"):
        values(wkb.envelope, [b"\x01\x63\x00\x00\x00" + b"\x00" * 16])


def test_lines_in_a_collection_enclose_nothing_and_polygons_do_not_cancel(spark):
    square = g.polygon([g.square(0, 0, 10)])
    right = g.line([(20, -100), (20, 100)])
    shapes = [square, g.multi(7, [square, right]), g.multi(7, [right, square]),
              g.multi(7, [square, g.polygon([g.square(3, 0, 10)])]), g.multi(7, [right])]
    df = spark.createDataFrame([(bytearray(s), bytearray(g.point(1, 1))) for s in shapes],
                               "way binary, p binary")
    got = df.select(wkb.intersects_box(F.col("way"), *[F.lit(v) for v in (0.0, 0.0, 1.0, 1.0)]),
                    wkb.planar_distance("p", "way")).collect()
    assert [tuple(r) for r in got] == [(True, 0.0)] * 4 + [(False, 19.0)]


def test_joined_parts_are_a_multipolygon(spark):
    parts = [g.polygon([g.square(i * 10, 0, 1 + i)]) for i in range(4)]
    df = spark.createDataFrame([([bytearray(p) for p in parts[:n]], n) for n in range(5)],
                               "parts array<binary>, n bigint").repartition(1)
    rows = df.select("n", wkb.make_multipolygon("parts", "n").alias("way"),
                     wkb.join_bytes("parts").alias("body")).collect()
    for r in rows:
        assert bytes(r["way"]) == g.multi(6, parts[:r["n"]])
        assert bytes(r["body"]) == b"".join(parts[:r["n"]])


def _peak(run) -> int:
    tracemalloc.start()
    run()
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    return peak


def test_coordinates_are_read_and_written_without_an_address_a_byte():
    import numpy as np

    xy = np.random.default_rng(3).random((200_000, 2))
    counts = np.full(10_000, 20)
    lines = wkb.encode_rings(wkb.LINE, xy, counts, np.ones(len(counts), bool))
    found = wkb.flatten(lines)
    assert (found.xy == xy).all() and found.row.tolist() == list(range(10_000))
    size = xy.nbytes
    assert _peak(lambda: wkb.flatten(lines)) < 8 * size
    assert _peak(lambda: wkb.encode_rings(wkb.LINE, xy, counts, np.ones(len(counts), bool))
                 ) < 8 * size


def test_batches_are_sliced_by_bytes_of_geometries(monkeypatch):
    monkeypatch.setattr(wkb, "SLICE_BYTES", 50)
    ways = [g.point(i, i) for i in range(6)] + [None, g.line([(0, 0)] * 9), g.point(7, 7), None]
    batch = pa.RecordBatch.from_arrays([pa.array(range(10)), pa.array(ways, pa.binary())], ["k", "w"])
    runs = list(wkb.sliced([batch, batch.slice(0, 0), batch.slice(6, 1)], 1))
    assert [k for r in runs for k in r.column(0).to_pylist()] == [*range(10), 6]
    assert [w for r in runs for w in r.column(1).to_pylist()] == [*ways, None]
    assert max(r.num_rows for r in runs) <= 3 and len(runs) > 4
