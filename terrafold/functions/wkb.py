"""WKB <-> columns, one Arrow batch at a time.

``flatten`` turns a batch of WKB values into ring offsets and one coordinate
array with numpy, visiting the n-th ring (or part) of every row together, so
the Python loop length is the ring count of the widest geometry in the batch,
not the row count. The Arrow UDFs below are thin reductions over that.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.functions import arrow_udf

# WKB type codes and the names GeoParquet gives them.
TYPE_NAMES = {
    1: "Point",
    2: "LineString",
    3: "Polygon",
    4: "MultiPoint",
    5: "MultiLineString",
    6: "MultiPolygon",
    7: "GeometryCollection",
}
POINT, LINE, POLYGON = 1, 2, 3

BBOX_FIELDS = ("xmin", "ymin", "xmax", "ymax")
BBOX_TYPE = T.StructType([T.StructField(f, T.DoubleType()) for f in BBOX_FIELDS])
SEGMENT_FIELDS = ("x1", "y1", "x2", "y2")
SEGMENTS_TYPE = T.ArrayType(
    T.StructType([T.StructField(f, T.DoubleType()) for f in SEGMENT_FIELDS]))

POINT_TYPE = T.StructType([T.StructField(f, T.DoubleType()) for f in ("x", "y")])
RINGS_TYPE = T.ArrayType(T.ArrayType(POINT_TYPE))

# Values whose bytes are addressed at once: an address takes eight times the byte it points to.
AT_ONCE = 1 << 15


# ---------------------------------------------------------------- decoding

@dataclass
class Rings:
    """A batch of geometries as flat arrays; rings are ordered by row."""

    rows: int
    row: np.ndarray      # row of each ring
    part: np.ndarray     # simple geometry within the row
    ring: np.ndarray     # ring within the part; 0 is the shell
    kind: np.ndarray     # POINT, LINE or POLYGON of the part
    offset: np.ndarray   # ring -> first coordinate, one more than rings
    xy: np.ndarray       # coordinates, shape (n, 2)

    def ring_of_point(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.row)), np.diff(self.offset))


def _bytes_of(arr: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    arr = arr.cast(pa.large_binary())
    valid = np.asarray(arr.is_valid())
    _, off, data = arr.buffers()
    offsets = np.frombuffer(off, np.int64)[arr.offset:arr.offset + len(arr) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw, offsets, valid


def _gather(data: np.ndarray, pos: np.ndarray, width: int) -> np.ndarray:
    out = np.empty((len(pos), width), np.uint8)
    for a in range(0, len(pos), AT_ONCE):
        out[a:a + AT_ONCE] = data[pos[a:a + AT_ONCE, None] + np.arange(width)]
    return out


def _uint32(data: np.ndarray, pos: np.ndarray, big: np.ndarray) -> np.ndarray:
    b = _gather(data, pos, 4)
    le, be = b.view("<u4")[:, 0], b.view(">u4")[:, 0]
    return np.where(big, be, le).astype(np.int64)


class _Walker:
    def __init__(self, data: np.ndarray, rows: int):
        self.data = data
        self.parts = np.zeros(rows, np.int64)
        self.found: list[tuple[np.ndarray, ...]] = []

    def _ring(self, rows, part, ring, kind, start, count, stride, big):
        self.found.append((rows, part, np.full(len(rows), ring), np.full(len(rows), kind),
                           start, count, stride, big))

    def geometry(self, rows: np.ndarray, pos: np.ndarray) -> np.ndarray:
        """Read one geometry per row at ``pos``; return the position after it."""
        big = self.data[pos] == 0
        code = _uint32(self.data, pos + 1, big)
        ewkb_z, ewkb_m = (code & 0x80000000) != 0, (code & 0x40000000) != 0
        srid = (code & 0x20000000) != 0
        iso = code & 0x0FFFFFFF
        base, dims = iso % 1000, iso // 1000
        stride = 16 + 8 * (ewkb_z | (dims == 1) | (dims == 3)) + 8 * (
            ewkb_m | (dims == 2) | (dims == 3))
        end = pos + 5 + 4 * srid
        for k in np.unique(base):
            m = base == k
            if k not in TYPE_NAMES:
                raise ValueError(f"unknown WKB geometry type {k}")
            read = self._single if k <= POLYGON else self._multi
            end[m] = read(int(k), rows[m], end[m], stride[m], big[m])
        return end

    def _single(self, kind, rows, pos, stride, big):
        part = self.parts[rows]
        self.parts[rows] += 1
        if kind == POINT:
            self._ring(rows, part, 0, kind, pos, np.ones(len(rows), np.int64), stride, big)
            return pos + stride
        count = _uint32(self.data, pos, big)
        pos = pos + 4
        if kind == LINE:
            self._ring(rows, part, 0, kind, pos, count, stride, big)
            return pos + stride * count
        live, ring = np.flatnonzero(count > 0), 0
        while len(live):
            n = _uint32(self.data, pos[live], big[live])
            self._ring(rows[live], part[live], ring, kind, pos[live] + 4, n,
                       stride[live], big[live])
            pos[live] += 4 + stride[live] * n
            ring += 1
            live = live[count[live] > ring]
        return pos

    def _multi(self, kind, rows, pos, stride, big):
        count = _uint32(self.data, pos, big)
        pos = pos + 4
        live, n = np.flatnonzero(count > 0), 0
        while len(live):
            pos[live] = self.geometry(rows[live], pos[live])
            n += 1
            live = live[count[live] > n]
        return pos


# Bytes of geometries that are flattened together where one row does not need the others.
SLICE_BYTES = 1 << 20


def sliced(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[pa.RecordBatch]:
    """The rows of ``batches`` in runs of about SLICE_BYTES of geometries, one row at least."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy()
        run = (np.cumsum(sizes, dtype=np.int64) - sizes) // SLICE_BYTES
        cuts = np.flatnonzero(np.diff(run)) + 1
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
            yield batch.slice(a, b - a)


def flatten(arr: pa.Array) -> Rings:
    data, offsets, valid = _bytes_of(arr)
    rows = len(valid)
    walker = _Walker(data, rows)
    live = np.flatnonzero(valid)
    if len(live):
        walker.geometry(live, offsets[:-1][live].copy())
    if not walker.found:
        z = np.zeros(0, np.int64)
        return Rings(rows, z, z, z, z, np.zeros(1, np.int64), np.zeros((0, 2)))
    row, part, ring, kind, start, count, stride, big = (
        np.concatenate(c) for c in zip(*walker.found, strict=True))
    order = np.lexsort((ring, part, row))
    row, part, ring, kind, start, count, stride, big = (
        a[order] for a in (row, part, ring, kind, start, count, stride, big))
    offset = np.concatenate(([0], np.cumsum(count)))
    nth = np.arange(offset[-1]) - np.repeat(offset[:-1], count)
    pos = np.repeat(start, count) + np.repeat(stride, count) * nth
    raw = _gather(data, pos, 16)
    xy = raw.view("<f8")
    swapped = np.repeat(big, count)
    if swapped.any():
        xy = np.where(swapped[:, None], raw.view(">f8").astype("<f8"), xy)
    # POINT EMPTY is a point of NaNs.
    empty = np.isnan(xy).all(axis=1) & (np.repeat(kind, count) == POINT)
    if empty.any():
        lost = np.add.reduceat(empty.astype(np.int64), offset[:-1]) * (count > 0)
        xy = xy[~empty]
        offset = np.concatenate(([0], np.cumsum(count - lost)))
    return Rings(rows, row, part, ring, kind, offset, xy)


def _per_row(rings: Rings, values: np.ndarray, how, start: float) -> np.ndarray:
    """Reduce one value per coordinate to one value per row."""
    out = np.full(rings.rows, start)
    rows = np.repeat(rings.row, np.diff(rings.offset))
    if len(rows):
        first = np.flatnonzero(np.r_[True, rows[1:] != rows[:-1]])
        out[rows[first]] = how.reduceat(values, first)
    return out


def _struct(names, columns, missing: np.ndarray) -> pa.StructArray:
    return pa.StructArray.from_arrays(
        [pa.array(c, pa.float64()) for c in columns], names=list(names),
        mask=pa.array(missing))


def extents(rings: Rings) -> tuple[list[np.ndarray], np.ndarray]:
    """xmin, ymin, xmax, ymax per row, and which rows have no coordinate."""
    x, y = rings.xy[:, 0], rings.xy[:, 1]
    cols = [_per_row(rings, x, np.minimum, np.inf), _per_row(rings, y, np.minimum, np.inf),
            _per_row(rings, x, np.maximum, -np.inf), _per_row(rings, y, np.maximum, -np.inf)]
    return cols, cols[0] > cols[2]


@dataclass
class Segments:
    row: np.ndarray
    part: np.ndarray
    ring: np.ndarray
    kind: np.ndarray  # LINE or POLYGON of the part
    xyxy: np.ndarray  # shape (n, 4)

    def where(self, mine: np.ndarray) -> Segments:
        return Segments(self.row[mine], self.part[mine], self.ring[mine], self.kind[mine],
                        self.xyxy[mine])


def segments(rings: Rings) -> Segments:
    """Consecutive coordinate pairs of every line and ring."""
    at = rings.ring_of_point()
    same = np.flatnonzero(at[1:] == at[:-1])
    r = at[same]
    return Segments(rings.row[r], rings.part[r], rings.ring[r], rings.kind[r],
                    np.hstack([rings.xy[same], rings.xy[same + 1]]))


# ---------------------------------------------------------------- encoding

def _binary(data: np.ndarray, lengths: np.ndarray, valid: np.ndarray) -> pa.Array:
    offsets = np.concatenate(([0], np.cumsum(lengths))).astype(np.int32)
    mask = None if valid.all() else pa.py_buffer(np.packbits(valid, bitorder="little"))
    return pa.Array.from_buffers(
        pa.binary(), len(lengths), [mask, pa.py_buffer(offsets), pa.py_buffer(data)])


def _put(out: np.ndarray, pos: np.ndarray, values: np.ndarray) -> None:
    if not len(pos):
        return
    raw = np.ascontiguousarray(values).view(np.uint8).reshape(len(pos), -1)
    for a in range(0, len(pos), AT_ONCE):
        out[pos[a:a + AT_ONCE, None] + np.arange(raw.shape[1])] = raw[a:a + AT_ONCE]


def encode_points(x: np.ndarray, y: np.ndarray, valid: np.ndarray) -> pa.Array:
    lengths = np.where(valid, 21, 0)
    out = np.zeros(int(lengths.sum()), np.uint8)
    pos = (np.cumsum(lengths) - lengths)[valid]
    out[pos] = 1
    out[pos + 1] = POINT
    _put(out, pos + 5, np.column_stack([x[valid], y[valid]]).astype("<f8"))
    return _binary(out, lengths, valid)


def encode_rings(kind: int, xy: np.ndarray, counts: np.ndarray, valid: np.ndarray) -> pa.Array:
    """One LineString or one single-ring Polygon per row."""
    head = 9 if kind == LINE else 13
    counts = np.where(valid, counts, 0)
    lengths = np.where(valid, head + 16 * counts, 0)
    out = np.zeros(int(lengths.sum()), np.uint8)
    pos = np.cumsum(lengths) - lengths
    live = pos[valid]
    out[live] = 1
    out[live + 1] = kind
    if kind == POLYGON:
        out[live + 5] = 1
    _put(out, live + head - 4, counts[valid].astype("<u4"))
    nth = np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts)
    if len(nth):
        _put(out, np.repeat(pos + head, counts) + 16 * nth, xy.astype("<f8"))
    return _binary(out, lengths, valid)


# ---------------------------------------------------------------- column expressions

def geometry_kind(way: Column) -> Column:
    """GeoParquet type name from the header bytes alone, ' Z' appended for 3D."""
    h = F.hex(F.substring(way, 1, 5))
    little = F.concat(F.substring(h, 9, 2), F.substring(h, 7, 2),
                      F.substring(h, 5, 2), F.substring(h, 3, 2))
    code = F.conv(F.when(F.substring(h, 1, 2) == "01", little)
                  .otherwise(F.substring(h, 3, 8)), 16, 10).cast("bigint")
    iso = code.bitwiseAND(F.lit(0x0FFFFFFF))
    dims = F.floor(iso / 1000)
    name = F.lit(None).cast("string")
    for k, v in TYPE_NAMES.items():
        name = F.when(iso % 1000 == k, F.lit(v)).otherwise(name)
    has_z = (code.bitwiseAND(F.lit(0x80000000)) != 0) | dims.isin(1, 3)
    return F.concat(name, F.when(has_z, F.lit(" Z")).otherwise(F.lit("")))


# ---------------------------------------------------------------- Arrow UDFs

@arrow_udf(BBOX_TYPE)
def envelope(way: pa.Array) -> pa.Array:
    """Extent of a geometry; NULL for NULL or empty."""
    cols, missing = extents(flatten(way))
    return _struct(BBOX_FIELDS, cols, missing)


@arrow_udf(RINGS_TYPE)
def ring_points(way: pa.Array) -> pa.Array:
    """Coordinates of every ring or line of a geometry, shell first."""
    rings = flatten(way)
    flat = pa.StructArray.from_arrays(
        [pa.array(rings.xy[:, i]) for i in range(2)], names=["x", "y"])
    inner = pa.ListArray.from_arrays(pa.array(rings.offset, pa.int32()), flat)
    counts = np.bincount(rings.row, minlength=rings.rows)
    outer = pa.array(np.concatenate(([0], np.cumsum(counts))), pa.int32())
    return pa.ListArray.from_arrays(outer, inner, mask=way.is_null())


@arrow_udf(T.DoubleType())
def planar_area(way: pa.Array) -> pa.Array:
    """Shell areas less hole areas, in squared coordinate units; 0 for points and lines."""
    rings = flatten(way)
    polygons = rings.kind == POLYGON
    at = rings.ring_of_point()
    same = np.flatnonzero(at[1:] == at[:-1])
    # Measure from each ring's first point, to keep digits at large coordinates.
    origin = rings.xy[np.minimum(rings.offset[:-1], max(len(rings.xy) - 1, 0))]
    p, q = rings.xy[same] - origin[at[same]], rings.xy[same + 1] - origin[at[same]]
    twice = np.bincount(at[same], p[:, 0] * q[:, 1] - q[:, 0] * p[:, 1], minlength=len(rings.row))
    size = np.abs(twice) / 2 * np.where(rings.ring == 0, 1, -1) * polygons
    return pa.array(np.bincount(rings.row, size, minlength=rings.rows), pa.float64(),
                    mask=np.asarray(way.is_null()))


@arrow_udf(T.DoubleType())
def planar_length(way: pa.Array) -> pa.Array:
    rings = flatten(way)
    seg = segments(rings)
    size = np.hypot(seg.xyxy[:, 2] - seg.xyxy[:, 0], seg.xyxy[:, 3] - seg.xyxy[:, 1])
    return pa.array(np.bincount(seg.row, size, minlength=rings.rows), pa.float64(),
                    mask=np.asarray(way.is_null()))


@arrow_udf(T.BinaryType())
def make_point(x: pa.Array, y: pa.Array) -> pa.Array:
    valid = np.asarray(x.is_valid()) & np.asarray(y.is_valid())
    xs, ys = (np.asarray(c.cast(pa.float64()).fill_null(0.0)) for c in (x, y))
    return encode_points(xs, ys, valid)


@arrow_udf(T.BinaryType())
def make_box(xmin: pa.Array, ymin: pa.Array, xmax: pa.Array, ymax: pa.Array) -> pa.Array:
    """Box polygon, counter-clockwise from its lower left corner."""
    cols = (xmin, ymin, xmax, ymax)
    valid = np.logical_and.reduce([np.asarray(c.is_valid()) for c in cols])
    x0, y0, x1, y1 = (np.asarray(c.cast(pa.float64()).fill_null(0.0))[valid] for c in cols)
    xy = np.stack([x0, y0, x1, y0, x1, y1, x0, y1, x0, y0], axis=1).reshape(-1, 2)
    return encode_rings(POLYGON, xy, np.full(len(valid), 5), valid)


def _coords(points: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Coordinates, counts and validity of an array<struct<x, y>> column."""
    valid = np.asarray(points.is_valid())
    counts = np.asarray(points.value_lengths().fill_null(0)).astype(np.int64)
    flat = points.flatten()
    return (np.column_stack([np.asarray(flat.field(0)), np.asarray(flat.field(1))]),
            counts, valid)


@arrow_udf(T.BinaryType())
def make_line(points: pa.Array) -> pa.Array:
    """LineString from array<struct<x, y>>."""
    return encode_rings(LINE, *_coords(points))


@arrow_udf(T.BinaryType())
def make_polygon(points: pa.Array) -> pa.Array:
    """Single-ring Polygon from a closed array<struct<x, y>>."""
    return encode_rings(POLYGON, *_coords(points))


@arrow_udf(T.BinaryType())
def make_polygon_with_holes(rings: pa.Array) -> pa.Array:
    """Polygon from array<array<struct<x, y>>>, the shell first."""
    valid = np.asarray(rings.is_valid())
    n_rings = np.asarray(rings.value_lengths().fill_null(0)).astype(np.int64)
    xy, counts, _ = _coords(rings.flatten())
    ring_bytes = 4 + 16 * counts
    first = np.cumsum(n_rings) - n_rings
    upto = np.concatenate(([0], np.cumsum(ring_bytes)))
    body = upto[first + n_rings] - upto[first]
    lengths = np.where(valid, 9 + body, 0)
    out = np.zeros(int(lengths.sum()), np.uint8)
    pos = np.cumsum(lengths) - lengths
    live = pos[valid]
    out[live] = 1
    out[live + 1] = POLYGON
    _put(out, live + 5, n_rings[valid].astype("<u4"))
    # A ring starts after its row's header and the rings before it in that row.
    ring_pos = np.repeat(pos + 9 - upto[first], n_rings) + upto[:-1]
    if len(counts):
        _put(out, ring_pos, counts.astype("<u4"))
        nth = np.arange(len(xy)) - np.repeat(np.cumsum(counts) - counts, counts)
        _put(out, np.repeat(ring_pos + 4, counts) + 16 * nth, xy.astype("<f8"))
    return _binary(out, lengths, valid)


def _joined(parts: pa.Array) -> pa.Array:
    """The byte strings of every list, one after the other; a list's bytes lie together already."""
    parts = parts.cast(pa.large_list(pa.large_binary()))
    starts = parts.offsets.to_numpy()
    _, off, data = parts.values.buffers()
    offsets = np.frombuffer(off, np.int64)[parts.values.offset:][starts]
    whole = pa.Array.from_buffers(pa.large_binary(), len(parts), [None, pa.py_buffer(
        np.ascontiguousarray(offsets)), data or pa.py_buffer(b"")])
    return pc.if_else(parts.is_valid(), whole, pa.scalar(None, pa.large_binary())).cast(
        pa.binary())


@arrow_udf(T.BinaryType())
def join_bytes(parts: pa.Array) -> pa.Array:
    """The byte strings of a list as one."""
    return _joined(parts)


@arrow_udf(T.BinaryType())
def make_multipolygon(bodies: pa.Array, count: pa.Array) -> pa.Array:
    """MultiPolygon of ``count`` little-endian Polygons, given as lists of their joined bytes."""
    head = np.zeros((len(count), 9), np.uint8)
    head[:, :5] = np.frombuffer(b"\x01\x06\x00\x00\x00", np.uint8)
    n = count.fill_null(0).cast(pa.uint32()).to_numpy().astype("<u4")
    head[:, 5:] = n.view(np.uint8).reshape(-1, 4)
    heads = _binary(head.ravel(), np.full(len(count), 9), np.ones(len(count), bool))
    return pc.binary_join_element_wise(heads.cast(pa.binary()), _joined(bodies),
                                       pa.scalar(b"", pa.binary()))


# ---------------------------------------------------------------- exact predicates

def points_in_rings(px, py, owner, seg: np.ndarray, seg_owner, n: int) -> np.ndarray:
    """Ray crossing parity, one point per owner; points on an edge count as inside."""
    x1, y1, x2, y2 = seg.T
    qx, qy = px[seg_owner], py[seg_owner]
    side = (x2 - x1) * (qy - y1) - (qx - x1) * (y2 - y1)
    cross = ((y1 <= qy) & (qy < y2) & (side > 0)) | ((y2 <= qy) & (qy < y1) & (side < 0))
    on = (side == 0) & (np.minimum(x1, x2) <= qx) & (qx <= np.maximum(x1, x2)) & (
        np.minimum(y1, y2) <= qy) & (qy <= np.maximum(y1, y2))
    odd = np.bincount(seg_owner, cross, minlength=n) % 2 == 1
    touch = np.bincount(seg_owner, on, minlength=n) > 0
    return (odd | touch)[owner]


def inside_some_part(seg: Segments, px: np.ndarray, py: np.ndarray) -> np.ndarray:
    """Rows whose point (px, py)[row] lies in a polygon of theirs, each polygon by itself.

    Lines of a collection enclose nothing, and polygons that overlap do not
    cancel each other.
    """
    seg = seg.where(seg.kind == POLYGON)
    if not len(seg.row):
        return np.zeros(0, np.int64)
    new = np.r_[True, (seg.row[1:] != seg.row[:-1]) | (seg.part[1:] != seg.part[:-1])]
    owner, rows = np.cumsum(new) - 1, seg.row[new]
    held = points_in_rings(px[rows], py[rows], np.arange(len(rows)), seg.xyxy, owner, len(rows))
    return rows[held]


def segments_meet_box(seg: np.ndarray, box: np.ndarray) -> np.ndarray:
    """Closed segment against closed box, by parametric clipping."""
    x1, y1, x2, y2 = seg.T
    xmin, ymin, xmax, ymax = box.T
    lo, hi = np.zeros(len(seg)), np.ones(len(seg))
    ok = np.ones(len(seg), bool)
    for start, delta, low, high in ((x1, x2 - x1, xmin, xmax), (y1, y2 - y1, ymin, ymax)):
        flat = delta == 0
        ok &= ~flat | ((low <= start) & (start <= high))
        with np.errstate(divide="ignore", invalid="ignore"):
            t0, t1 = (low - start) / delta, (high - start) / delta
        lo = np.where(flat, lo, np.maximum(lo, np.minimum(t0, t1)))
        hi = np.where(flat, hi, np.minimum(hi, np.maximum(t0, t1)))
    return ok & (lo <= hi)


@arrow_udf(T.BooleanType())
def intersects_box(way: pa.Array, xmin: pa.Array, ymin: pa.Array, xmax: pa.Array,
                   ymax: pa.Array) -> pa.Array:
    """Exact closed intersection of a geometry with a box."""
    rings = flatten(way)
    box = np.column_stack([np.asarray(c.cast(pa.float64())) for c in (xmin, ymin, xmax, ymax)])
    hit = np.zeros(rings.rows, bool)
    rows = np.repeat(rings.row, np.diff(rings.offset))
    b, p = box[rows], rings.xy
    inside = (b[:, 0] <= p[:, 0]) & (p[:, 0] <= b[:, 2]) & (
        b[:, 1] <= p[:, 1]) & (p[:, 1] <= b[:, 3])
    hit[rows[inside]] = True
    seg = segments(rings)
    hit[seg.row[segments_meet_box(seg.xyxy, box[seg.row])]] = True
    # A box wholly inside a polygon touches no edge: test one corner by parity.
    hit[inside_some_part(seg.where(~hit[seg.row]), box[:, 0], box[:, 1])] = True
    return pa.array(hit, mask=np.asarray(way.is_null()))


@arrow_udf(T.DoubleType())
def planar_distance(point: pa.Array, way: pa.Array) -> pa.Array:
    """Shortest distance from a Point to any geometry; 0 inside a polygon."""
    left, right = flatten(point), flatten(way)
    if (left.kind != POINT).any() or len(np.unique(left.row)) != len(left.row):
        raise ValueError("planar_distance measures from one Point a row")
    px, py = np.full(left.rows, np.nan), np.full(left.rows, np.nan)
    at = np.repeat(left.row, np.diff(left.offset))
    px[at], py[at] = left.xy[:, 0], left.xy[:, 1]
    seg = segments(right)
    # A lone point is a segment of length zero.
    alone = np.repeat(right.kind == POINT, np.diff(right.offset))
    rows = np.concatenate([seg.row, np.repeat(right.row, np.diff(right.offset))[alone]])
    x1, y1, x2, y2 = np.vstack([seg.xyxy, np.hstack([right.xy[alone]] * 2)]).T
    dx, dy, qx, qy = x2 - x1, y2 - y1, px[rows], py[rows]
    size = dx * dx + dy * dy
    with np.errstate(divide="ignore", invalid="ignore"):
        t = np.where(size == 0, 0.0, ((qx - x1) * dx + (qy - y1) * dy) / size)
    t = np.clip(t, 0.0, 1.0)
    out = np.full(left.rows, np.inf)
    np.minimum.at(out, rows, np.hypot(qx - x1 - t * dx, qy - y1 - t * dy))
    out[inside_some_part(seg, px, py)] = 0.0
    return pa.array(out, mask=~np.isfinite(out))
