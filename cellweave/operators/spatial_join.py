"""Spatial joins without nested loops: both sides get keys of covering squares, then an exact test."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellweave.functions.geometry import bounds_of, decode, rings_of
from cellweave.operators.aggregate import first_rows
from cellweave.session import ship

#: Degrees of a covering square.
SQUARE = 3.0


def square_of(c: Column, size: float = SQUARE) -> Column:
    return F.floor(c / size).cast("long")


def covering(df: DataFrame, size: float = SQUARE) -> DataFrame:
    """A row for each square that a rectangle ``west, south, east, north`` touches: ``__qx, __qy``."""
    xs = F.sequence(square_of(F.col("west"), size), square_of(F.col("east"), size))
    ys = F.sequence(square_of(F.col("south"), size), square_of(F.col("north"), size))
    valid = (F.col("west") <= F.col("east")) & (F.col("south") <= F.col("north"))
    return df.where(valid).withColumn("__qx", F.explode(xs)).withColumn("__qy", F.explode(ys))


def rectangles_join(points: DataFrame, zones: DataFrame, x: str, y: str, columns: Sequence[str], size: float = SQUARE) -> DataFrame:
    """Points with ``columns`` of every rectangle that holds them (half-open: an edge belongs to one side)."""
    tagged = points.withColumns({"__qx": square_of(F.col(x), size), "__qy": square_of(F.col(y), size)})
    cover = covering(zones.select(*[F.col(c) for c in columns], "west", "south", "east", "north"), size)
    cond = (F.col(x) >= F.col("west")) & (F.col(x) < F.col("east")) & (F.col(y) >= F.col("south")) & (F.col(y) < F.col("north"))
    return tagged.join(cover, ["__qx", "__qy"]).where(cond).drop("__qx", "__qy", "west", "south", "east", "north")


def _inside(px: np.ndarray, py: np.ndarray, ring: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which points are inside a closed ring, and which are on it; edges are taken in chunks of bounded size."""
    odd, on = np.zeros(len(px), dtype=bool), np.zeros(len(px), dtype=bool)
    step = max(1, 2_000_000 // max(1, len(px)))
    x, y = px[:, None], py[:, None]
    for i in range(0, len(ring) - 1, step):
        p, q = ring[i : i + step + 1][:-1], ring[i : i + step + 1][1:]
        x1, y1, x2, y2 = p[:, 0], p[:, 1], q[:, 0], q[:, 1]
        cross = (x2 - x1) * (y - y1) - (y2 - y1) * (x - x1)
        on |= ((cross == 0) & (np.minimum(x1, x2) <= x) & (x <= np.maximum(x1, x2)) & (np.minimum(y1, y2) <= y) & (y <= np.maximum(y1, y2))).any(axis=1)
        with np.errstate(divide="ignore", invalid="ignore"):
            at = x1 + (y - y1) * (x2 - x1) / (y2 - y1)
        odd ^= (((y1 > y) != (y2 > y)) & (x < at)).sum(axis=1) % 2 == 1
    return odd & ~on, on


def within_many(px: np.ndarray, py: np.ndarray, polygons: list[list[np.ndarray]]) -> np.ndarray:
    """Which points lie in the interior: inside an outer ring and in or on no hole; edges are outside."""
    out = np.zeros(len(px), dtype=bool)
    for rings in polygons:
        hit, _ = _inside(px, py, rings[0])
        for hole in rings[1:]:
            inside, on = _inside(px, py, hole)
            hit &= ~inside & ~on
        out |= hit
    return out


def within(px: float, py: float, polygons: list[list[np.ndarray]]) -> bool:
    return bool(within_many(np.array([px], dtype=float), np.array([py], dtype=float), polygons)[0])


def touches_many(px: np.ndarray, py: np.ndarray, half_x: float, half_y: float, polygons: list[list[np.ndarray]]) -> np.ndarray:
    """Which rectangles around points meet polygons: their centres lie inside, or an edge runs through them."""
    out = within_many(px, py, polygons)
    for ring in (r for rings in polygons for r in rings):
        for (x1, y1), (x2, y2) in zip(ring[:-1, :2], ring[1:, :2], strict=True):
            rows = np.flatnonzero(~out & (px >= min(x1, x2) - half_x) & (px <= max(x1, x2) + half_x) & (py >= min(y1, y2) - half_y) & (py <= max(y1, y2) + half_y))
            if len(rows):  # the corners of the rectangle are not all on one side of the edge's line
                side = (x2 - x1) * (py[rows] - y1) - (y2 - y1) * (px[rows] - x1)
                out[rows] = np.abs(side) <= abs(x2 - x1) * half_y + abs(y2 - y1) * half_x
    return out


def meets(px: np.ndarray, py: np.ndarray, half_x: float, half_y: float, polygons: list[list[np.ndarray]]) -> np.ndarray:
    return touches_many(px, py, half_x, half_y, polygons) if half_x or half_y else within_many(px, py, polygons)


def tester(half_x: float = 0.0, half_y: float = 0.0):
    """An Arrow function (x, y, polygon): points inside, or their rectangles meeting; all points of a batch that share a polygon at once."""

    @F.pandas_udf(T.BooleanType())
    def test(x: pd.Series, y: pd.Series, wkb: pd.Series) -> pd.Series:
        px, py, out = x.to_numpy(dtype=float, na_value=np.nan), y.to_numpy(dtype=float, na_value=np.nan), np.zeros(len(x), dtype=bool)
        code, shapes = pd.factorize(wkb.map(lambda v: None if v is None else bytes(v)))
        for i, raw in enumerate(shapes):
            rows = np.flatnonzero((code == i) & ~np.isnan(px) & ~np.isnan(py))
            if len(rows):
                out[rows] = meets(px[rows], py[rows], half_x, half_y, rings_of(decode(raw)))
        return pd.Series(out)

    return test


#: Polygons (bytes of WKB, and rows) that every task may hold decoded; of more, the WKB travels with the pairs.
HELD_BYTES, HELD_ROWS = 32_000_000, 100_000


@F.pandas_udf(T.BooleanType())
def point_within(x: pd.Series, y: pd.Series, wkb: pd.Series) -> pd.Series:
    """Points against polygons, all points of a batch that meet one polygon at once."""
    px, py, out = x.to_numpy(dtype=float, na_value=np.nan), y.to_numpy(dtype=float, na_value=np.nan), np.zeros(len(x), dtype=bool)
    code, shapes = pd.factorize(wkb.map(lambda v: None if v is None else bytes(v)))
    for i, raw in enumerate(shapes):
        rows = np.flatnonzero((code == i) & ~np.isnan(px) & ~np.isnan(py))
        if len(rows):
            out[rows] = within_many(px[rows], py[rows], rings_of(decode(raw)))
    return pd.Series(out)


def assign_polygons(
    points: DataFrame, polygons: DataFrame, columns: Sequence[str], order: str, key: str = "cell", x: str = "lon", y: str = "lat", geometry: str = "geom_wkb", first_only: bool = True, size: float = SQUARE,
    half_x: float = 0.0, half_y: float = 0.0,
) -> DataFrame:
    """Points that lie in a polygon, with its ``columns``; of several the one with the smallest ``order``.

    Polygons are exploded to the squares that their bounds touch and joined to points by square;
    the exact test runs on those pairs only. ``polygons`` may carry its bounds as
    ``west, south, east, north``; else they are computed. Points in no polygon are absent. With
    ``half_x`` and ``half_y`` rectangles of that half size around the points are tested instead.

    Polygons within ``HELD_BYTES`` and ``HELD_ROWS`` (both are measured) are numbered and sent to every task
    once, and pairs carry the number; of larger tables, pairs carry the polygon itself.
    """
    from cellweave.functions.geometry import bounds

    spark = points.sparkSession
    ship(spark)
    wanted = list(dict.fromkeys([*columns, order]))
    total = polygons.agg(F.count("*"), F.coalesce(F.sum(F.length(geometry)), F.lit(0))).head()
    small = total[0] <= HELD_ROWS and total[1] <= HELD_BYTES
    if small:
        rows = polygons.select(*wanted, geometry).where(F.col(geometry).isNotNull()).collect()
        held = spark.sparkContext.broadcast([bytes(r[geometry]) for r in rows])
        boxes = [bounds_of(decode(raw)) for raw in held.value]
        table = [(*[r[c] for c in wanted], i, *map(float, box)) for i, (r, box) in enumerate(zip(rows, boxes, strict=True)) if box]
        fields = [polygons.schema[c] for c in wanted] + [T.StructField("__i", T.IntegerType())] + [T.StructField(c, T.DoubleType()) for c in ("west", "south", "east", "north")]
        polygons, carried, test = spark.createDataFrame(table, T.StructType(fields)), "__i", _numbered(held, half_x, half_y)
    else:
        carried, test = geometry, tester(half_x, half_y)
        if not {"west", "south", "east", "north"} <= set(polygons.columns):
            polygons = polygons.withColumn("__b", bounds(F.col(geometry))).select("*", "__b.*")
    grown = polygons.withColumns({"west": F.col("west") - half_x, "south": F.col("south") - half_y, "east": F.col("east") + half_x, "north": F.col("north") + half_y})
    cover = covering(grown.select(*wanted, carried, "west", "south", "east", "north"), size)
    tagged = points.withColumns({"__qx": square_of(F.col(x), size), "__qy": square_of(F.col(y), size)})
    near = tagged.join(cover, ["__qx", "__qy"]).where(F.col(x).between(F.col("west"), F.col("east")) & F.col(y).between(F.col("south"), F.col("north")))
    hits = near.where(test(F.col(x), F.col(y), F.col(carried))).drop("__qx", "__qy", "west", "south", "east", "north", carried)
    if first_only:
        hits = first_rows(hits, [key], [order])
    return hits if order in columns else hits.drop(order)


def _numbered(held, half_x: float, half_y: float):
    """``tester`` for polygons of a broadcast list, by number; a worker decodes each once."""

    @F.pandas_udf(T.BooleanType())
    def test(x: pd.Series, y: pd.Series, number: pd.Series) -> pd.Series:
        px, py, at, out = x.to_numpy(dtype=float, na_value=np.nan), y.to_numpy(dtype=float, na_value=np.nan), number.to_numpy(), np.zeros(len(x), dtype=bool)
        for i in np.unique(at):
            rows = np.flatnonzero((at == i) & ~np.isnan(px) & ~np.isnan(py))
            if len(rows):
                raw = held.value[int(i)]
                if raw not in _decoded:
                    if len(_decoded) >= HELD_ROWS:
                        _decoded.clear()
                    _decoded[raw] = rings_of(decode(raw))
                out[rows] = meets(px[rows], py[rows], half_x, half_y, _decoded[raw])
        return pd.Series(out)

    return test


_decoded: dict[bytes, list] = {}


def feature_pairs(points: DataFrame, polygons: DataFrame, feature: str, key: str = "cell", **options) -> DataFrame:
    """Distinct pairs of cell and feature that holds it."""
    return assign_polygons(points, polygons, [feature], feature, key, first_only=False, **options).select(key, feature).distinct()


def near_any(points: DataFrame, marks: DataFrame, x: str = "lon", y: str = "lat", size: float = 1.0) -> DataFrame:
    """Points in a square of ``size`` degrees that holds a mark (a bitmap of land, say)."""
    squares = marks.select(square_of(F.col(x), size).alias("__qx"), square_of(F.col(y), size).alias("__qy")).distinct()
    tagged = points.withColumns({"__qx": square_of(F.col(x), size), "__qy": square_of(F.col(y), size)})
    return tagged.join(squares, ["__qx", "__qy"], "left_semi").drop("__qx", "__qy")
