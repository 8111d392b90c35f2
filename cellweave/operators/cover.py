"""Cells that cover boxes and polygons, and cells on land: of the hexagon grid, or (``grid="box"``) of rectangles."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellweave.functions import cells as C
from cellweave.functions import hexgrid as H
from cellweave.functions.geometry import bounds, bounds_of, decode, rings_of
from cellweave.operators.spatial_join import point_within, within_many
from cellweave.session import ship


def _rows(box: str, res: int) -> tuple:
    across, up = C._splits(C.check_resolution(res))
    w, h = C.BASE_WIDTH / across, C.BASE_HEIGHT / up
    cols = F.sequence(F.floor((F.col(f"{box}.west") + 180) / w).cast("long"), F.floor((F.col(f"{box}.east") + 180) / w).cast("long"))
    rows = F.sequence(F.floor((F.col(f"{box}.south") + 90) / h).cast("long"), F.floor((F.col(f"{box}.north") + 90) / h).cast("long"))
    return cols, rows, w, h


#: Levels that one task descends below an ancestor: at most 7 ** 4 cells.
_LEVELS = 4


def hex_grid(spark: SparkSession, res: int, west: float = -180.0, south: float = -60.0, east: float = 180.0, north: float = 75.0) -> DataFrame:
    """All hexagon cells whose centres lie in a box: ``cell, h3_index, lat, lon, resolution``.

    Each ancestor's descendants are made in one task, so a grid of any size is made in parallel.
    """
    ship(spark)
    C.check_resolution(res)
    coarse = max(0, res - _LEVELS)
    box = (west, south, east, north)

    def roots(frames):
        for pdf in frames:
            for base in pdf["id"]:
                yield pd.DataFrame({"a": H.cells_below(H.base_cells()[base : base + 1], 0, coarse, *box, loose=coarse < res)})

    def leaves(frames):
        for pdf in frames:
            for a in pdf["a"]:
                cells = H.cells_below(np.array([a], dtype=np.int64), coarse, res, *box)
                lat, lon = H.centers_of(cells, res)
                yield pd.DataFrame({"cell": cells, "lat": lat, "lon": lon})

    ancestors = spark.range(122).mapInPandas(roots, "a long")
    rows = ancestors.repartition("a").mapInPandas(leaves, "cell long, lat double, lon double")
    return rows.select("cell", C.cell_hex(F.col("cell")).alias("h3_index"), "lat", "lon", F.lit(res).alias("resolution"))


def _hexagons_in(polygons: DataFrame, key: str, res: int, geometry: str) -> DataFrame:
    coarse = max(0, res - _LEVELS)

    @F.pandas_udf("array<long>")
    def roots(values: pd.Series) -> pd.Series:
        out = []
        for raw in values:
            box = bounds_of(decode(bytes(raw))) if raw is not None else None
            out.append(H.cells_below(H.base_cells(), 0, coarse, *box, loose=coarse < res) if box else np.zeros(0, dtype=np.int64))
        return pd.Series(out)

    @F.pandas_udf("array<long>")
    def leaves(values: pd.Series, ancestors: pd.Series) -> pd.Series:
        out, known = [], {}
        for raw, a in zip(values.map(bytes), ancestors, strict=True):
            if raw not in known:
                known.clear()
                g = decode(raw)
                known[raw] = bounds_of(g), rings_of(g)
            box, rings = known[raw]
            cells = H.cells_below(np.array([a], dtype=np.int64), coarse, res, *box)
            lat, lon = H.centers_of(cells, res)
            out.append(cells[within_many(lon, lat, rings)] if len(cells) else cells)
        return pd.Series(out)

    spread = polygons.where(F.col(geometry).isNotNull()).select(F.col(key), F.col(geometry).alias("__g")).withColumn("__a", F.explode(roots("__g")))
    return spread.repartition(key, "__a").select(key, F.explode(leaves("__g", "__a")).alias("cell"))


def polygon_to_cells(polygons: DataFrame, key: str, res: int, geometry: str = "geom_wkb", grid: str = "hex") -> DataFrame:
    """``key, cell`` for cells whose centre lies within the polygon; only centres within its bounds are tested."""
    if grid == "hex":
        ship(polygons.sparkSession)
        return _hexagons_in(polygons, key, C.check_resolution(res), geometry)
    ship(polygons.sparkSession)
    boxed = polygons.where(F.col(geometry).isNotNull()).withColumn("__b", bounds(F.col(geometry))).where(F.col("__b.west").isNotNull())
    cols, rows, w, h = _rows("__b", res)
    spread = boxed.withColumn("__c", F.explode(cols)).withColumn("__r", F.explode(rows))
    centred = spread.withColumns({"__x": (F.col("__c") + 0.5) * w - 180.0, "__y": (F.col("__r") + 0.5) * h - 90.0})
    inside = centred.where(point_within(F.col("__x"), F.col("__y"), F.col(geometry)))
    return inside.select(key, C.cell_at(F.col("__y"), F.col("__x"), res).alias("cell"))


def cells_on(cells: DataFrame, polygons: DataFrame, res: int, geometry: str = "geom_wkb", grid: str = "hex") -> DataFrame:
    """Those of ``cells`` whose centre lies in any of the polygons (land, say)."""
    held = polygon_to_cells(polygons.withColumn("__k", F.lit(1)), "__k", res, geometry, grid).select("cell").distinct()
    return cells.join(held, "cell", "left_semi")


def with_centroids(df: DataFrame, res: int, cell: str = "cell", grid: str = "hex") -> DataFrame:
    """``lat`` and ``lon`` of the cells, unless the table has them."""
    if {"lat", "lon"} <= set(df.columns):
        return df
    ship(df.sparkSession)
    if grid == "hex":
        return df.withColumn("__p", H.hex_center(F.col(cell))).withColumns({"lat": F.col("__p.lat"), "lon": F.col("__p.lon")}).drop("__p")
    centre = C.cell_center(F.col(cell), res)
    return df.withColumns({"lat": centre["lat"], "lon": centre["lon"]})


def with_boundaries(df: DataFrame, res: int, cell: str = "cell", name: str = "geom_wkb", grid: str = "hex") -> DataFrame:
    """The cell's boundary as WKB, added last, after all aggregation."""
    from cellweave.functions.geometry import wkt_to_wkb

    ship(df.sparkSession)
    return df.withColumn(name, wkt_to_wkb(H.hex_boundary_wkt(F.col(cell)) if grid == "hex" else C.cell_boundary_wkt(F.col(cell), res)))
