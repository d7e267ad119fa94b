"""Hand-made WKB for the tests, written without the engine's encoder."""

import struct


def _order(e):
    return 1 if e == "<" else 0


def point(x, y, e="<"):
    return struct.pack(e + "BIdd", _order(e), 1, x, y)


def point_z(x, y, z):
    return struct.pack("<BIddd", 1, 1001, x, y, z)


def ewkb_point(x, y, srid):
    return struct.pack("<BIIdd", 1, 0x20000001, srid, x, y)


def line(points, e="<"):
    return struct.pack(e + "BII", _order(e), 2, len(points)) + b"".join(
        struct.pack(e + "dd", *p) for p in points)


def polygon(rings, e="<"):
    return struct.pack(e + "BII", _order(e), 3, len(rings)) + b"".join(
        struct.pack(e + "I", len(r)) + b"".join(struct.pack(e + "dd", *p) for p in r)
        for r in rings)


def multi(kind, parts, e="<"):
    return struct.pack(e + "BII", _order(e), kind, len(parts)) + b"".join(parts)


def square(cx, cy, half):
    return [(cx - half, cy - half), (cx + half, cy - half), (cx + half, cy + half),
            (cx - half, cy + half), (cx - half, cy - half)]
