"""Geometries as WKB: codecs for WKB, WKT and GeoJSON, measures on the WGS 84 ellipsoid, and repairs.

A decoded geometry is ``(type, coordinates)``: an array of one row for a point (none if it is
empty), an array for a line, a list of closed rings for a polygon, a list of such for the
multi-types, and a list of geometries for a collection.
"""

from __future__ import annotations

import json
import math
import re
import struct

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellweave.errors import GeometryError, ProjectionError

TYPES = ("Point", "LineString", "Polygon", "MultiPoint", "MultiLineString", "MultiPolygon", "GeometryCollection")
_CODE = {t: i for i, t in enumerate(TYPES, 1)}
#: Semi-major axis, flattening and what follows from them.
A, FLAT = 6_378_137.0, 1 / 298.257223563
B, E2 = A * (1 - FLAT), FLAT * (2 - FLAT)
Geometry = tuple


# --- codecs ---------------------------------------------------------------------------------


class _Reader:
    def __init__(self, raw: bytes):
        self.raw, self.at = raw, 0

    def take(self, fmt: str):
        size = struct.calcsize(fmt)
        if self.at + size > len(self.raw):
            raise GeometryError("WKB ends early")
        out = struct.unpack_from(fmt, self.raw, self.at)
        self.at += size
        return out[0]

    def points(self, n: int, dims: int, order: str) -> np.ndarray:
        size = 8 * n * dims
        if self.at + size > len(self.raw):
            raise GeometryError("WKB ends early")
        out = np.frombuffer(self.raw, dtype=f"{order}f8", count=n * dims, offset=self.at).astype(float).reshape(n, dims)
        self.at += size
        return out

    def geometry(self) -> Geometry:
        order = "<" if self.take("<B") else ">"
        code = self.take(f"{order}I")
        flags, iso = code & 0xE0000000, (code & 0x0FFFFFFF) // 1000
        kind = (code & 0x0FFFFFFF) % 1000
        if flags & 0x20000000:
            self.take(f"{order}I")  # srid
        dims = 2 + (iso in (1, 3) or bool(flags & 0x80000000)) + (iso in (2, 3) or bool(flags & 0x40000000))
        if not 1 <= kind <= 7:
            raise GeometryError(f"no geometry type {kind}")
        name = TYPES[kind - 1]
        if name == "Point":
            p = self.points(1, dims, order)
            return (name, p[:0] if np.isnan(p).all() else p)
        n = self.take(f"{order}I")
        if name == "LineString":
            return (name, self.points(n, dims, order))
        if name == "Polygon":
            return (name, [self.points(self.take(f"{order}I"), dims, order) for _ in range(n)])
        parts = [self.geometry() for _ in range(n)]
        return (name, parts if name == "GeometryCollection" else [p[1] for p in parts])


def decode(raw: bytes) -> Geometry:
    return _Reader(bytes(raw)).geometry()


def _dims(coords) -> int:
    if isinstance(coords, np.ndarray):
        return coords.shape[1] if coords.size else 2
    return max([2, *(_dims(c[1] if isinstance(c, tuple) else c) for c in coords)])


def encode(g: Geometry) -> bytes:
    """Little-endian ISO WKB; a third coordinate is kept as Z."""
    kind, coords = g
    dims = min(3, _dims(coords))
    head = struct.pack("<BI", 1, _CODE[kind] + (1000 if dims == 3 else 0))
    body = lambda a: np.ascontiguousarray(a[:, :dims] if a.size else np.zeros((0, dims)), dtype="<f8").tobytes()
    if kind == "Point":
        return head + (body(coords) if len(coords) else np.full(dims, np.nan, dtype="<f8").tobytes())
    if kind == "LineString":
        return head + struct.pack("<I", len(coords)) + body(coords)
    if kind == "Polygon":
        return head + struct.pack("<I", len(coords)) + b"".join(struct.pack("<I", len(r)) + body(r) for r in coords)
    parts = coords if kind == "GeometryCollection" else [(kind[5:], c) for c in coords]
    return head + struct.pack("<I", len(parts)) + b"".join(map(encode, parts))


_WKT_TOKEN = re.compile(r"\s*([A-Za-z]+|[-+]?(?:\d+\.?\d*|\.\d+)(?:[eE][-+]?\d+)?|[(),])")


def from_wkt(text: str) -> Geometry:
    text = re.sub(r"^\s*SRID=\d+;", "", text, flags=re.IGNORECASE)
    tokens, at = [], 0
    while at < len(text.rstrip()):
        m = _WKT_TOKEN.match(text, at)
        if not m:
            raise GeometryError(f"can't read WKT at {text[at:at + 20]!r}")
        tokens.append(m[1])
        at = m.end()
    tokens.reverse()

    def need(sign):
        if not tokens or tokens.pop() != sign:
            raise GeometryError(f"WKT lacks {sign!r}: {text[:40]!r}")

    def points():
        out = []
        need("(")
        while True:
            if tokens and tokens[-1] == "(":
                need("(")
                row = numbers()
                need(")")
            else:
                row = numbers()
            out.append(row)
            if tokens and tokens[-1] == ",":
                tokens.pop()
                continue
            need(")")
            return np.array(out, dtype=float)

    def numbers():
        row = []
        while tokens and tokens[-1] not in "(),":
            row.append(float(tokens.pop()))
        return row

    def several(one):
        out = []
        need("(")
        while True:
            out.append(one())
            if tokens and tokens[-1] == ",":
                tokens.pop()
                continue
            need(")")
            return out

    def geometry():
        if not tokens:
            raise GeometryError("empty WKT")
        word = tokens.pop().upper()
        kind = next((t for t in TYPES if t.upper() == word.removesuffix("ZM").removesuffix("Z").removesuffix("M") or t.upper() == word), None)
        if kind is None:
            raise GeometryError(f"no geometry type {word!r}")
        while tokens and tokens[-1].upper() in ("Z", "M", "ZM"):
            tokens.pop()
        if tokens and tokens[-1].upper() == "EMPTY":
            tokens.pop()
            return (kind, np.zeros((0, 2)) if kind in ("Point", "LineString") else [])
        if kind in ("Point", "LineString"):
            return (kind, points())
        if kind == "MultiPoint":
            return (kind, [p[None, :] for p in points()])
        if kind in ("Polygon", "MultiLineString"):
            return (kind, several(points))
        if kind == "MultiPolygon":
            return (kind, several(lambda: several(points)))
        return (kind, several(geometry))

    out = geometry()
    if tokens:
        raise GeometryError("WKT goes on after its end")
    return out


def _number(x: float) -> str:
    return str(int(x)) if x == int(x) and abs(x) < 1e15 else repr(float(x))


def to_wkt(g: Geometry) -> str:
    kind, coords = g
    z = " Z" if _dims(coords) > 2 else ""
    if not len(coords):
        return f"{kind.upper()} EMPTY"
    row = lambda p: " ".join(map(_number, p))
    line = lambda a: "(" + ", ".join(map(row, a)) + ")"
    poly = lambda rings: "(" + ", ".join(map(line, rings)) + ")"
    body = {
        "Point": lambda: line(coords), "LineString": lambda: line(coords), "Polygon": lambda: poly(coords), "MultiPoint": lambda: "(" + ", ".join(map(line, coords)) + ")",
        "MultiLineString": lambda: poly(coords), "MultiPolygon": lambda: "(" + ", ".join(map(poly, coords)) + ")", "GeometryCollection": lambda: "(" + ", ".join(map(to_wkt, coords)) + ")",
    }[kind]()
    return f"{kind.upper()}{z} {body}"


def from_geojson(data: dict | str) -> Geometry:
    data = json.loads(data) if isinstance(data, str) else data
    kind = data.get("type")
    if kind not in _CODE:
        raise GeometryError(f"no geometry type {kind!r}")
    if kind == "GeometryCollection":
        return (kind, [from_geojson(g) for g in data["geometries"]])
    c = data["coordinates"]
    line = lambda x: np.array(x, dtype=float).reshape(len(x), -1) if x else np.zeros((0, 2))
    make = {
        "Point": lambda: line([c] if c else []), "LineString": lambda: line(c), "Polygon": lambda: [line(r) for r in c], "MultiPoint": lambda: [line([p]) for p in c],
        "MultiLineString": lambda: [line(x) for x in c], "MultiPolygon": lambda: [[line(r) for r in p] for p in c],
    }
    return (kind, make[kind]())


def to_geojson(g: Geometry) -> dict:
    kind, coords = g
    if kind == "GeometryCollection":
        return {"type": kind, "geometries": [to_geojson(x) for x in coords]}
    plain = lambda c: c.tolist() if isinstance(c, np.ndarray) else [plain(x) for x in c]
    out = plain(coords)
    if kind == "Point":
        out = out[0] if out else []
    elif kind == "MultiPoint":
        out = [p[0] for p in out]
    return {"type": kind, "coordinates": out}


# --- shape ----------------------------------------------------------------------------------


def arrays_of(g: Geometry) -> list[np.ndarray]:
    kind, coords = g
    if isinstance(coords, np.ndarray):
        return [coords]
    out = []
    for c in coords:
        if isinstance(c, tuple):
            out += arrays_of(c)
        elif isinstance(c, np.ndarray):
            out.append(c)
        else:
            out += c
    return out


def change(g: Geometry, f) -> Geometry:
    kind, coords = g

    def go(c):
        if isinstance(c, tuple):
            return change(c, f)
        return f(c) if isinstance(c, np.ndarray) else [go(x) for x in c]

    return (kind, go(coords))


def rings_of(g: Geometry) -> list[list[np.ndarray]]:
    """The polygons of a geometry as lists of rings."""
    kind, coords = g
    if kind == "Polygon":
        return [[r[:, :2] for r in coords]] if coords else []
    if kind == "MultiPolygon":
        return [[r[:, :2] for r in p] for p in coords if p]
    if kind == "GeometryCollection":
        return [p for x in coords for p in rings_of(x)]
    return []


def lines_of(g: Geometry) -> list[np.ndarray]:
    kind, coords = g
    if kind == "LineString":
        return [coords[:, :2]]
    if kind == "MultiLineString":
        return [c[:, :2] for c in coords]
    if kind == "GeometryCollection":
        return [x for c in coords for x in lines_of(c)]
    return []


def bounds_of(g: Geometry) -> tuple[float, float, float, float] | None:
    parts = [a[:, :2] for a in arrays_of(g) if len(a)]
    if not parts:
        return None
    p = np.concatenate(parts)
    return (float(p[:, 0].min()), float(p[:, 1].min()), float(p[:, 0].max()), float(p[:, 1].max()))


def signed_area(ring: np.ndarray) -> float:
    x, y = ring[:, 0] - ring[0, 0], ring[:, 1] - ring[0, 1]
    return float((x[:-1] * y[1:] - x[1:] * y[:-1]).sum() / 2)


def centroid_of(g: Geometry) -> tuple[float, float] | None:
    """Planar centroid by area for polygons, else by length, else the mean of points."""
    total = sx = sy = 0.0
    for rings in rings_of(g):
        for i, r in enumerate(rings):
            if len(r) < 4:
                continue
            x, y = r[:, 0] - r[0, 0], r[:, 1] - r[0, 1]
            cross = x[:-1] * y[1:] - x[1:] * y[:-1]
            a = float(cross.sum() / 2)
            if a:
                sign = abs(a) / a * (1 if i == 0 else -1)
                total += sign * a
                sx += sign * (float(((x[:-1] + x[1:]) * cross).sum() / 6) + a * r[0, 0])
                sy += sign * (float(((y[:-1] + y[1:]) * cross).sum() / 6) + a * r[0, 1])
    if total:
        return sx / total, sy / total
    for line in lines_of(g) + [r for rings in rings_of(g) for r in rings]:
        if len(line) > 1:
            d = np.hypot(*(line[1:] - line[:-1]).T)
            mid = (line[1:] + line[:-1]) / 2
            total += float(d.sum())
            sx += float((d * mid[:, 0]).sum())
            sy += float((d * mid[:, 1]).sum())
    if total:
        return sx / total, sy / total
    parts = [a[:, :2] for a in arrays_of(g) if len(a)]
    if not parts:
        return None
    p = np.concatenate(parts).mean(axis=0)
    return float(p[0]), float(p[1])


# --- measures -------------------------------------------------------------------------------


def geodesic_m(lon1, lat1, lon2, lat2) -> np.ndarray:
    """Vincenty's inverse solution; where it does not converge (nearly antipodal points) the mean sphere's distance."""
    lon1, lat1, lon2, lat2 = (np.radians(np.asarray(v, dtype=float)) for v in (lon1, lat1, lon2, lat2))
    u1, u2 = np.arctan((1 - FLAT) * np.tan(lat1)), np.arctan((1 - FLAT) * np.tan(lat2))
    s1, c1, s2, c2 = np.sin(u1), np.cos(u1), np.sin(u2), np.cos(u2)
    diff = (lon2 - lon1 + np.pi) % (2 * np.pi) - np.pi
    lam = diff.copy()
    moving = np.ones(lam.shape, dtype=bool)
    with np.errstate(divide="ignore", invalid="ignore"):
        for _ in range(100):
            sl, cl = np.sin(lam), np.cos(lam)
            ss = np.hypot(c2 * sl, c1 * s2 - s1 * c2 * cl)
            cs = s1 * s2 + c1 * c2 * cl
            sigma = np.arctan2(ss, cs)
            sa = np.where(ss == 0, 0.0, c1 * c2 * sl / np.where(ss == 0, 1, ss))
            ca2 = 1 - sa * sa
            c2m = np.where(ca2 < 1e-15, 0.0, cs - 2 * s1 * s2 / np.where(ca2 < 1e-15, 1, ca2))
            k = FLAT / 16 * ca2 * (4 + FLAT * (4 - 3 * ca2))
            new = diff + (1 - k) * FLAT * sa * (sigma + k * ss * (c2m + k * cs * (-1 + 2 * c2m * c2m)))
            moving = np.abs(new - lam) > 1e-13
            lam = new
            if not moving.any():
                break
    up = ca2 * (A * A - B * B) / (B * B)
    ka = 1 + up / 16384 * (4096 + up * (-768 + up * (320 - 175 * up)))
    kb = up / 1024 * (256 + up * (-128 + up * (74 - 47 * up)))
    ds = kb * ss * (c2m + kb / 4 * (cs * (-1 + 2 * c2m**2) - kb / 6 * c2m * (-3 + 4 * ss**2) * (-3 + 4 * c2m**2)))
    out = B * ka * (sigma - ds)
    h = np.sin((lat2 - lat1) / 2) ** 2 + np.cos(lat1) * np.cos(lat2) * np.sin(diff / 2) ** 2
    sphere = 2 * 6_371_008.8 * np.arcsin(np.sqrt(np.minimum(1, h)))
    return np.where(moving | np.isnan(out) | (np.abs(lam) > np.pi), sphere, out)


def length_m(g: Geometry) -> float:
    """Geodesic length of the lines; 0 for points and polygons."""
    return float(sum(geodesic_m(a[:-1, 0], a[:-1, 1], a[1:, 0], a[1:, 1]).sum() for a in lines_of(g) if len(a) > 1))


_E = math.sqrt(E2)


def _q(s):
    return (1 - E2) * (s / (1 - E2 * s * s) + np.arctanh(_E * s) / _E)


_QP = float(_q(1.0))
#: Square of the radius of the sphere with the ellipsoid's area.
AUTHALIC2 = A * A * _QP / 2


def _ring_area(ring: np.ndarray) -> float:
    """Signed area on the authalic sphere: edges are cut to at most 0.05 degrees, each a trapezium to the equator."""
    steps = np.maximum(1, np.ceil(np.abs(np.diff(ring, axis=0)).max(axis=1) / 0.05)).astype(int)
    pieces = [ring[i] + (ring[i + 1] - ring[i]) * (np.arange(n)[:, None] / n) for i, n in enumerate(steps)]
    p = np.concatenate([*pieces, ring[-1:]])
    q = _q(np.sin(np.radians(p[:, 1]))) / _QP
    return float(-(np.radians(np.diff(p[:, 0])) * (q[1:] + q[:-1]) / 2).sum() * AUTHALIC2)


def area_m2(g: Geometry) -> float:
    """Area on the ellipsoid of polygons whose edges are straight in longitude and latitude; holes are taken off."""
    return float(sum(max(0.0, abs(_ring_area(rings[0])) - sum(abs(_ring_area(h)) for h in rings[1:] if len(h) > 3)) for rings in rings_of(g) if len(rings[0]) > 3))


# --- repairs --------------------------------------------------------------------------------


def has_z(g: Geometry) -> bool:
    return any(a.size and a.shape[1] > 2 for a in arrays_of(g))


def force_2d(g: Geometry) -> Geometry:
    return change(g, lambda a: a[:, :2])


def to_multi(g: Geometry) -> Geometry:
    kind, coords = g
    return (f"Multi{kind}", [coords] if len(coords) else []) if kind in ("Point", "LineString", "Polygon") else g


def orient(g: Geometry) -> Geometry:
    """Outer rings counter-clockwise, holes clockwise."""

    def turn(rings):
        return [r[::-1] if len(r) > 3 and (signed_area(r) < 0) == (i == 0) and signed_area(r) else r for i, r in enumerate(rings)]

    kind, coords = g
    if kind == "Polygon":
        return (kind, turn(coords))
    if kind == "MultiPolygon":
        return (kind, [turn(p) for p in coords])
    if kind == "GeometryCollection":
        return (kind, [orient(x) for x in coords])
    return g


def same(a: Geometry, b: Geometry) -> bool:
    return encode(a) == encode(b)


def _crossing(ring: np.ndarray) -> tuple[int, int, np.ndarray] | None:
    """The first proper crossing of two edges of a closed ring."""
    n = len(ring) - 1
    d = ring[1:, :2] - ring[:-1, :2]
    for i in range(n - 1):
        j = np.arange(i + 1, n)
        r = ring[j, :2] - ring[i, :2]
        den = d[i, 0] * d[j, 1] - d[i, 1] * d[j, 0]
        with np.errstate(divide="ignore", invalid="ignore"):
            t = (r[:, 0] * d[j, 1] - r[:, 1] * d[j, 0]) / den
            u = (r[:, 0] * d[i, 1] - r[:, 1] * d[i, 0]) / den
        hit = np.flatnonzero((den != 0) & (t > 1e-12) & (t < 1 - 1e-12) & (u > 1e-12) & (u < 1 - 1e-12))
        if len(hit):
            k = int(hit[0])
            return i, int(j[k]), ring[i] + (ring[i + 1] - ring[i]) * t[k]
    return None


def _tidy(a: np.ndarray) -> np.ndarray:
    """Without points that repeat the one before and without ones that aren't finite."""
    a = a[np.isfinite(a[:, :2]).all(axis=1)]
    return a[np.concatenate([[True], (a[1:, :2] != a[:-1, :2]).any(axis=1)])] if len(a) else a


def _tidy_ring(ring: np.ndarray) -> np.ndarray:
    ring = _tidy(ring)
    if len(ring) and (ring[0, :2] != ring[-1, :2]).any():
        ring = np.concatenate([ring, ring[:1]])
    return ring


def is_valid(g: Geometry) -> bool:
    """Rings are closed, have an area and don't cross themselves; no coordinate repeats or is not finite."""
    return all(np.isfinite(a[:, :2]).all() for a in arrays_of(g) if len(a)) and all(
        len(r) > 3 and (r[0, :2] == r[-1, :2]).all() and len(_tidy_ring(r)) == len(r) and signed_area(r) != 0 and _crossing(r) is None for p in rings_of(g) for r in p
    )


def _simple(ring: np.ndarray, depth: int = 0) -> list[np.ndarray]:
    """A ring that crosses itself as loops that don't."""
    ring = _tidy_ring(ring)
    if len(ring) < 4 or not signed_area(ring) and _crossing(ring) is None:
        return []
    hit = _crossing(ring) if depth < 200 else None
    if hit is None:
        return [ring]
    i, j, at = hit
    inner = np.concatenate([at[None], ring[i + 1 : j + 1], at[None]])
    outer = np.concatenate([ring[: i + 1], at[None], ring[j + 1 :]])
    return _simple(inner, depth + 1) + _simple(outer, depth + 1)


def repair(g: Geometry) -> Geometry:
    """Closed rings without repeated points; bow-ties become several polygons, rings without area go."""
    kind, coords = g
    if kind == "GeometryCollection":
        return (kind, [repair(x) for x in coords])
    if kind in ("Polygon", "MultiPolygon"):
        out = []
        for rings in [coords] if kind == "Polygon" else coords:
            if not rings:
                continue
            shells = _simple(rings[0])
            holes = [h for r in rings[1:] for h in _simple(r)]
            for shell in shells:
                box = bounds_of(("LineString", shell))
                out.append([shell, *[h for h in holes if len(shells) == 1 or box[0] <= h[0, 0] <= box[2] and box[1] <= h[0, 1] <= box[3]]])
        if kind == "Polygon" and len(out) <= 1:
            return (kind, out[0] if out else [])
        return ("MultiPolygon", out)
    return change(g, _tidy)


def _clip(ring: np.ndarray, at: float, left: bool) -> np.ndarray:
    """The part of a ring on one side of a meridian."""
    out = []
    for p, q in zip(ring[:-1], ring[1:], strict=True):
        a, b = (p[0] <= at, q[0] <= at) if left else (p[0] >= at, q[0] >= at)
        if a:
            out.append(p)
        if a != b and p[0] != q[0]:
            out.append(p + (q - p) * ((at - p[0]) / (q[0] - p[0])))
    return _tidy_ring(np.array(out)) if out else np.zeros((0, 2))


def crosses_antimeridian(g: Geometry) -> bool:
    box = bounds_of(g)
    return box is not None and (box[2] > 180 or box[0] < -180 or box[2] - box[0] > 180)


def split_antimeridian(g: Geometry) -> Geometry:
    """Parts on either side of 180 degrees, within -180 and 180.

    Shapes wider than 180 degrees are taken to go the short way round; ones that can't be split stay.
    """
    if not crosses_antimeridian(g):
        return g
    box = bounds_of(g)
    g = force_2d(g)
    if box[0] < -180:
        g = change(g, lambda a: a + [360, 0])
    elif box[2] <= 180:
        g = change(g, lambda a: np.where(a[:, :1] < 0, a + [360, 0], a))
    back = lambda a: a - [360, 0]
    kind, coords = g
    if kind in ("Polygon", "MultiPolygon"):
        out = []
        for rings in rings_of(g):
            for left in (True, False):
                parts = [r for r in (_clip(r, 180.0, left) for r in rings) if len(r) > 3 and signed_area(r)]
                if parts:
                    out.append(parts if left else [back(r) for r in parts])
        return ("MultiPolygon", out) if out else g
    if kind in ("LineString", "MultiLineString"):
        out = []
        for line in lines_of(g):
            part = [line[0]]
            for p, q in zip(line[:-1], line[1:], strict=True):
                if (p[0] < 180 < q[0]) or (q[0] < 180 < p[0]):
                    cut = p + (q - p) * ((180 - p[0]) / (q[0] - p[0]))
                    out.append(np.array([*part, cut]))
                    part = [cut]
                part.append(q)
            out.append(np.array(part))
        return ("MultiLineString", [back(a) if a[:, 0].mean() > 180 else a for a in out])
    if kind in ("Point", "MultiPoint"):
        return change(g, lambda a: np.where(a[:, :1] > 180, back(a), a))
    return (kind, [split_antimeridian(x) for x in coords])


# --- projections ----------------------------------------------------------------------------

_N = FLAT / (2 - FLAT)
_KRUGER = (_N / 2 - 2 * _N**2 / 3 + 5 * _N**3 / 16, 13 * _N**2 / 48 - 3 * _N**3 / 5, 61 * _N**3 / 240)
_KRUGER_BACK = (_N / 2 - 2 * _N**2 / 3 + 37 * _N**3 / 96, _N**2 / 48 + _N**3 / 15, 17 * _N**3 / 480)
_LAT_BACK = (2 * _N - 2 * _N**2 / 3 - 2 * _N**3, 7 * _N**2 / 3 - 8 * _N**3 / 5, 56 * _N**3 / 15)
_RECT = A / (1 + _N) * (1 + _N**2 / 4 + _N**4 / 64)


def _utm(lon, lat, zone: int, south: bool):
    phi, lam = np.radians(lat), np.radians(lon - (zone * 6 - 183))
    k = 2 * math.sqrt(_N) / (1 + _N)
    t = np.sinh(np.arctanh(np.sin(phi)) - k * np.arctanh(k * np.sin(phi)))
    xi, eta = np.arctan2(t, np.cos(lam)), np.arctanh(np.sin(lam) / np.sqrt(1 + t * t))
    x, y = eta.copy(), xi.copy()
    for j, a in enumerate(_KRUGER, 1):
        x = x + a * np.cos(2 * j * xi) * np.sinh(2 * j * eta)
        y = y + a * np.sin(2 * j * xi) * np.cosh(2 * j * eta)
    return 500_000 + 0.9996 * _RECT * x, (1e7 if south else 0) + 0.9996 * _RECT * y


def _utm_back(x, y, zone: int, south: bool):
    xi, eta = (y - (1e7 if south else 0)) / (0.9996 * _RECT), (x - 500_000) / (0.9996 * _RECT)
    xp, ep = xi.copy(), eta.copy()
    for j, b in enumerate(_KRUGER_BACK, 1):
        xp = xp - b * np.sin(2 * j * xi) * np.cosh(2 * j * eta)
        ep = ep - b * np.cos(2 * j * xi) * np.sinh(2 * j * eta)
    chi = np.arcsin(np.sin(xp) / np.cosh(ep))
    phi = chi.copy()
    for j, d in enumerate(_LAT_BACK, 1):
        phi = phi + d * np.sin(2 * j * chi)
    return np.degrees(np.arctan2(np.sinh(ep), np.cos(xp))) + zone * 6 - 183, np.degrees(phi)


def project(a: np.ndarray, source: int, target: int) -> np.ndarray:
    """Between 4326, 3857 and UTM zones (32601 to 32660, 32701 to 32760)."""
    if source == target or not len(a):
        return a
    zone = lambda s: (s - 32600, False) if 32601 <= s <= 32660 else (s - 32700, True) if 32701 <= s <= 32760 else None
    for s in (source, target):
        if s not in (4326, 3857) and zone(s) is None:
            raise ProjectionError(f"no projection {s}")
    x, y = a[:, 0], a[:, 1]
    if source == 3857:
        x, y = np.degrees(x / A), np.degrees(2 * np.arctan(np.exp(y / A)) - np.pi / 2)
    elif source != 4326:
        x, y = _utm_back(x, y, *zone(source))
    if target == 3857:
        x, y = A * np.radians(x), A * np.log(np.tan(np.pi / 4 + np.radians(np.clip(y, -89.999999, 89.999999)) / 2))
    elif target != 4326:
        x, y = _utm(x, y, *zone(target))
    return np.column_stack([x, y, *([a[:, 2]] if a.shape[1] > 2 else [])])


def reproject(g: Geometry, source: int, target: int) -> Geometry:
    return change(g, lambda a: project(a, source, target))


def clip_box(g: Geometry, west: float, south: float, east: float, north: float) -> Geometry:
    """The parts of lines and polygons within a box."""

    def half(ring, axis, at, below, closed):
        out, n = [], len(ring)
        for i in range(n - (0 if not closed else 1)):
            p = ring[i]
            keep = p[axis] <= at if below else p[axis] >= at
            if keep:
                out.append(p)
            if i + 1 < n:
                q = ring[i + 1]
                if keep != (q[axis] <= at if below else q[axis] >= at) and p[axis] != q[axis]:
                    out.append(p + (q - p) * ((at - p[axis]) / (q[axis] - p[axis])))
        return np.array(out) if out else np.zeros((0, 2))

    polygons = []
    for rings in rings_of(g):
        kept = []
        for r in rings:
            for axis, at, below in ((0, east, True), (0, west, False), (1, north, True), (1, south, False)):
                r = _tidy_ring(half(r, axis, at, below, True)) if len(r) > 3 else r[:0]
            if len(r) > 3 and signed_area(r):
                kept.append(r)
            elif r is rings[0] or not kept:
                break
        if kept:
            polygons.append(kept)
    if rings_of(g):
        return ("MultiPolygon", polygons)
    lines = []
    for line in lines_of(g):
        part: list[np.ndarray] = []
        for p, q in zip(line[:-1], line[1:], strict=True):
            d, lo, hi = q - p, 0.0, 1.0
            for axis, at, sign in ((0, west, -1), (0, east, 1), (1, south, -1), (1, north, 1)):
                den, num = sign * d[axis], sign * (at - p[axis])
                if den == 0:
                    if num < 0:
                        hi = -1.0
                elif den > 0:
                    hi = min(hi, num / den)
                else:
                    lo = max(lo, num / den)
            if lo < hi:
                a, b = p + d * lo, p + d * hi
                if part and (part[-1] != a).any():
                    lines.append(np.array(part))
                    part = []
                part = part or [a]
                part.append(b)
            elif part:
                lines.append(np.array(part))
                part = []
        if part:
            lines.append(np.array(part))
    return ("MultiLineString", lines)


# --- columns --------------------------------------------------------------------------------


def _doubles(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.DoubleType()) for n in names])


def _each(values: pd.Series, f) -> list:
    return [None if v is None else f(decode(bytes(v))) for v in values]


@F.pandas_udf(T.BinaryType())
def wkt_to_wkb(texts: pd.Series) -> pd.Series:
    return pd.Series([None if t is None else encode(from_wkt(t)) for t in texts], dtype=object)


@F.pandas_udf(T.StringType())
def wkb_to_wkt(values: pd.Series) -> pd.Series:
    return pd.Series(_each(values, to_wkt), dtype=object)


@F.pandas_udf(T.BinaryType())
def geojson_to_wkb(texts: pd.Series) -> pd.Series:
    return pd.Series([None if t is None or t == "null" else encode(from_geojson(t)) for t in texts], dtype=object)


@F.pandas_udf(T.BinaryType())
def point_wkb(x: pd.Series, y: pd.Series) -> pd.Series:
    return pd.Series([None if a != a or b != b else encode(("Point", np.array([[a, b]]))) for a, b in zip(x, y, strict=True)], dtype=object)


@F.pandas_udf(_doubles("west", "south", "east", "north"))
def bounds(values: pd.Series) -> pd.DataFrame:
    rows = [b or (None,) * 4 for b in (None if v is None else bounds_of(decode(bytes(v))) for v in values)]
    return pd.DataFrame(rows, columns=["west", "south", "east", "north"], dtype=float)


@F.pandas_udf(_doubles("x", "y"))
def centroid(values: pd.Series) -> pd.DataFrame:
    rows = [c or (None, None) for c in (None if v is None else centroid_of(decode(bytes(v))) for v in values)]
    return pd.DataFrame(rows, columns=["x", "y"], dtype=float)


@F.pandas_udf(T.DoubleType())
def st_length_m(values: pd.Series) -> pd.Series:
    return pd.Series(_each(values, length_m), dtype=float)


@F.pandas_udf(T.DoubleType())
def st_area_m2(values: pd.Series) -> pd.Series:
    return pd.Series(_each(values, area_m2), dtype=float)
