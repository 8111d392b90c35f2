"""Raster analytics on pixel tables: ``raster_id, band, row, col, lon, lat, value``.

A raster is a table of pixels, so statistics are grouped aggregations, zones are joined by
key, and a stack of rasters is one plan rather than a loop.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellweave.errors import ProjectionError, RasterError

#: Bytes of a pixel by data type.
PIXEL_BYTES = {"uint8": 1, "int8": 1, "uint16": 2, "int16": 2, "uint32": 4, "int32": 4, "float32": 4, "float64": 8}


def is_nodata(value: Column, nodata: float | None) -> Column:
    """Nothing for no nodata value, NaN for NaN, else close to it (relative 1e-5, absolute 1e-8)."""
    if nodata is None:
        return F.lit(False)
    if nodata != nodata:
        return F.isnan(value)
    return F.abs(value - F.lit(float(nodata))) <= 1e-8 + 1e-5 * abs(nodata)


def _valid(value: str, nodata: float | None) -> Column:
    v = F.col(value).cast("double")
    return F.when(~is_nodata(v, nodata) & ~F.isnan(v), v)


def statistic(name: str, value: Column) -> Column:
    """sum, mean, median, min, max, std (population) or count of the values that are not null."""
    known = {"sum": F.sum, "mean": F.avg, "median": F.median, "min": F.min, "max": F.max, "std": F.stddev_pop, "count": F.count}
    if name not in known:
        raise RasterError(f"no statistic {name!r}")
    return known[name](value).cast("double")


def zonal(
    pixels: DataFrame, zones: DataFrame | None, how: str = "mean", zone: str = "zone_id", value: str = "value", nodata: float | None = None, exclude_zero: bool = False, by: Sequence[str] = ()
) -> DataFrame:
    """For each zone (and ``by``, such as the raster): ``value``, ``pixel_count`` and ``nodata_count``.

    Pixels carry their zone's key (see ``pixel_zones`` and ``cells.cell_at``). A zone of
    ``zones`` without pixels has a null value and counts of 0; one of which all pixels are
    nodata has a null value. Zeros are left out if asked for, except for counts.
    """
    v = _valid(value, nodata)
    used = F.when(v != 0, v) if exclude_zero and how != "count" else v
    keys = [*by, zone]
    rows = pixels.where(F.col(zone).isNotNull()).select(*keys, used.alias("__v"), v.isNull().alias("__n"))
    out = rows.groupBy(*keys).agg(statistic(how, F.col("__v")).alias("value"), F.count("__v").alias("pixel_count"), F.count_if("__n").alias("nodata_count"))
    v = F.when(F.col("value") == 0, 0.0).otherwise(F.col("value"))  # no negative zero
    out = out.withColumn("value", F.when(F.col("pixel_count") > 0, v))
    if zones is None:
        return out
    return zones.select(zone).join(out, zone, "left").fillna(0, subset=["pixel_count", "nodata_count"])


def pixel_zones(pixels: DataFrame, zones: DataFrame, zone: str = "zone_id", touched: bool = False, half_x: float = 0.0, half_y: float = 0.0) -> DataFrame:
    """Pixels with the zones (rectangles ``west, south, east, north``) that hold their centres, or that they touch.

    Both sides are keyed by degree squares, so the join is an equi-join with a residual test.
    """
    from cellweave.operators.spatial_join import rectangles_join

    if not touched:
        return rectangles_join(pixels, zones, "lon", "lat", [zone])
    grown = zones.select(zone, (F.col("west") - half_x).alias("west"), (F.col("south") - half_y).alias("south"), (F.col("east") + half_x).alias("east"), (F.col("north") + half_y).alias("north"))
    return rectangles_join(pixels, grown, "lon", "lat", [zone])


def polygon_zones(pixels: DataFrame, polygons: DataFrame, zone: str = "zone_id", geometry: str = "geom_wkb", touched: bool = False, half_x: float = 0.0, half_y: float = 0.0) -> DataFrame:
    """Pixels with every polygon that holds their centres or, with ``touched``, that meets the pixel's rectangle.

    Both sides meet by covering squares; a pixel in several polygons comes once for each. Give
    half a pixel's width and height for ``touched``.
    """
    from cellweave.operators.spatial_join import assign_polygons

    return assign_polygons(pixels, polygons, [zone], zone, "lon", "lon", "lat", geometry, first_only=False, half_x=half_x if touched else 0.0, half_y=half_y if touched else 0.0)


def zonal_polygons(pixels: DataFrame, polygons: DataFrame, how: str = "mean", zone: str = "zone_id", geometry: str = "geom_wkb", nodata: float | None = None, exclude_zero: bool = False, by: Sequence[str] = (), **touch) -> DataFrame:
    """``zonal`` over polygon zones; without ``by``, zones without pixels are there with counts of 0."""
    keyed = polygon_zones(pixels, polygons, zone, geometry, **touch)
    return zonal(keyed, None if by else polygons, how, zone, "value", nodata, exclude_zero, by)


def check_same_projection(a: int, b: int) -> None:
    if a != b:
        raise ProjectionError(f"raster has {a}, zones have {b}")


def band_stats(pixels: DataFrame, nodata: float | None = None, value: str = "value", digits: int | None = None) -> DataFrame:
    """min, max, mean, population std and percent of nulls for each raster and band; no valid pixel: zeros and 100."""
    v = _valid(value, nodata)
    r = (lambda c: F.round(c, digits)) if digits is not None else (lambda c: c)
    zero = F.lit(0.0)
    return pixels.select("raster_id", "band", v.alias("v")).groupBy("raster_id", "band").agg(
        F.coalesce(F.min("v"), zero).alias("min"), F.coalesce(F.max("v"), zero).alias("max"), r(F.coalesce(F.avg("v"), zero)).alias("mean"), r(F.coalesce(F.stddev_pop("v"), zero)).alias("std"),
        r(100.0 * F.count_if(F.col("v").isNull()) / F.count("*")).alias("null_percent"),
    )


def is_categorical(pixels: DataFrame, value: str = "value", window: int = 1024, most: int = 256, nodata: float | None = None) -> DataFrame:
    """Whether a raster's first window has fewer than ``most`` distinct values other than nodata."""
    rows = pixels.where((F.col("row") < window) & (F.col("col") < window))
    v = F.col(value) if nodata is None else F.when(F.col(value) != F.lit(nodata), F.col(value))
    return rows.groupBy("raster_id").agg((F.count_distinct(v) < most).alias("categorical"))


def raster_type(colors: str = "color_interp", bands: str = "band_count", dtype: str = "dtype", categorical: str = "categorical") -> Column:
    """A raster's type: red, green and blue first, then the number of bands and the data type."""
    c, n, d = F.col(colors), F.col(bands), F.col(dtype)
    single = F.when(d.isin("float32", "float64"), "dem").when(d.isin("uint8", "int8") & F.col(categorical), "categorical").when(d == "uint8", "panchromatic").otherwise("dem")
    return (
        F.when((c == "rgb") & (n >= 3), F.when(n == 4, "rgba").otherwise("rgb"))
        .when(n == 1, single).when(n == 3, "rgb").when(n == 4, "rgba").when(n > 4, "multispectral").otherwise("unknown")
    )


def memory_mb(width: str = "width", height: str = "height", bands: str = "band_count", dtype: str = "dtype") -> Column:
    """Three copies of all pixels, in MB."""
    size = reduce(lambda acc, kv: acc.when(F.col(dtype) == kv[0], kv[1]), PIXEL_BYTES.items(), F.when(F.lit(False), 0)).otherwise(8)
    return F.col(width) * F.col(height) * F.col(bands) * size * 3 / F.lit(1024.0 * 1024.0)


def bounds_errors(west: str = "west", south: str = "south", east: str = "east", north: str = "north", srid: str = "srid") -> Column:
    """What is wrong with projection and bounds, as an array; empty if nothing is."""
    w, s, e, n, code = (F.col(x) for x in (west, south, east, north, srid))
    geographic = code == 4326
    return F.array_compact(F.array(
        F.when(code.isNull(), "no projection"),
        F.when((w >= e) | (s >= n), "empty bounds"),
        F.when(geographic & ((w < -180) | (e > 180)), "longitude out of range"),
        F.when(geographic & ((s < -90) | (n > 90)), "latitude out of range"),
        F.when(~geographic & ((e - w > 1e8) | (n - s > 1e8)), "extent too large"),
    ))


def quality_flags(stats: DataFrame) -> DataFrame:
    """Warnings for each band of ``band_stats``: nearly all null, or a single value."""
    flags = F.array_compact(F.array(
        F.when(F.col("null_percent") > 99, "nearly all null"), F.when((F.col("min") == F.col("max")) & (F.col("null_percent") < 100), "single value")
    ))
    return stats.withColumn("flags", flags)


def validate_rasters(meta: DataFrame, pixels: DataFrame, nodata: float | None = None) -> DataFrame:
    """One row for each raster of ``meta``: type, memory, errors and its bands' statistics with flags."""
    bands = quality_flags(band_stats(pixels, nodata)).groupBy("raster_id").agg(F.array_sort(F.collect_list(F.struct("band", "min", "max", "mean", "std", "null_percent", "flags"))).alias("bands"))
    out = meta.join(is_categorical(pixels, nodata=nodata), "raster_id", "left").join(bands, "raster_id", "left")
    warn = F.array_compact(F.array(F.when(F.col("dtype") == "float64", "float64 could be float32")))
    return out.withColumns({"raster_type": raster_type(), "memory_mb": memory_mb(), "errors": bounds_errors(), "warnings": warn})


def pixel_of(lon: Column, lat: Column, left: float, top: float, res_x: float, res_y: float, width: int, height: int, clamp: bool = True) -> tuple[Column, Column]:
    """Row and column of a position in a north-up raster; outside of it the edge pixel, or null without ``clamp``."""
    col, row = F.floor((lon - left) / res_x).cast("long"), F.floor((F.lit(top) - lat) / res_y).cast("long")
    if clamp:
        return F.least(F.greatest(row, F.lit(0)), F.lit(height - 1)), F.least(F.greatest(col, F.lit(0)), F.lit(width - 1))
    inside = (col >= 0) & (col < width) & (row >= 0) & (row < height)
    return F.when(inside, row), F.when(inside, col)


def sample_nearest(
    points: DataFrame, pixels: DataFrame, left: float, top: float, res_x: float, res_y: float, width: int, height: int, nodata: float | None = None, clamp: bool = True, lon: str = "lon", lat: str = "lat", by: Sequence[str] = ()
) -> DataFrame:
    """Points with the float ``value`` of the pixel that holds them; null for nodata and (without ``clamp``) outside.

    With ``by`` (such as the raster) a point is sampled on the pixels that have its values there.
    """
    row, col = pixel_of(F.col(lon), F.col(lat), left, top, res_x, res_y, width, height, clamp)
    grid = pixels.select(*by, "row", "col", _valid("value", nodata).cast("float").alias("value"))
    return points.withColumns({"row": row, "col": col}).join(grid.withColumns({"row": F.col("row").cast("long"), "col": F.col("col").cast("long")}), [*by, "row", "col"], "left").drop("row", "col")


def sample_axis(points: DataFrame, grid: DataFrame, axis_lat: Sequence[float], axis_lon: Sequence[float]) -> DataFrame:
    """Nearest value on the axes of a grid ``lat, lon, value``; of two equally near the smaller coordinate.

    The axes are metadata of one variable. Their distances are an expression over constant arrays.
    """

    def nearest(c: Column, axis: Sequence[float]) -> Column:
        values = F.array(*[F.lit(float(a)) for a in sorted(axis)])
        best = F.array_min(F.transform(values, lambda a: F.struct(F.abs(a - c).alias("d"), a.alias("a"))))
        return best["a"]

    keyed = points.withColumns({"__lat": nearest(F.col("lat"), axis_lat), "__lon": nearest(F.col("lon"), axis_lon)})
    values = grid.select(F.col("lat").alias("__lat"), F.col("lon").alias("__lon"), "value")
    return keyed.join(values, ["__lat", "__lon"], "left").drop("__lat", "__lon")


def first_time(grid: DataFrame, time: str = "time") -> DataFrame:
    """The slice of the smallest time of each variable of a grid table, by a scalar aggregate that joins back as one row."""
    least = grid.agg(F.min(time).alias("__t"))
    return grid.join(F.broadcast(least), F.col(time).eqNullSafe(F.col("__t"))).drop("__t")


def grid_on_raster(cells: DataFrame, pixels: DataFrame, left: float, top: float, res_x: float, res_y: float, width: int, height: int, nodata: float | None = None, exclude_zero: bool = True, by: Sequence[str] = ()) -> DataFrame:
    """Cells whose centre (``lat, lon``) lies on a pixel with data, by default other than 0; with ``by`` one of the cell's own raster."""
    row, col = pixel_of(F.col("lon"), F.col("lat"), left, top, res_x, res_y, width, height, clamp=False)
    v = _valid("value", nodata)
    keep = v.isNotNull() & (v != 0) if exclude_zero else v.isNotNull()
    good = pixels.where(keep).select(*by, F.col("row").cast("long").alias("__r"), F.col("col").cast("long").alias("__c")).distinct()
    return cells.withColumns({"__r": row, "__c": col}).join(good, [*by, "__r", "__c"], "left_semi").drop("__r", "__c")


def cells_with_data(pixels: DataFrame, cell: str = "cell", nodata: float | None = None) -> DataFrame:
    """Cells on which any raster has a value other than 0."""
    v = _valid("value", nodata)
    return pixels.where(v.isNotNull() & (v != 0) & F.col(cell).isNotNull()).select(cell).distinct()


#: Rasters of a block, which share their tile ids; tiles of a row in a piece, at most; tiles of a task, pieces of a task; tasks at most.
BLOCK, ROW, TASK, SPLIT, TASKS = 256, 65_536, 1_000_000, 4, 10_000


def tile_grid(rasters: DataFrame, size: int, overlap: int = 0) -> DataFrame:
    """Tiles of each raster (``raster_id, width, height``): id, offsets and sizes, cut off at the edges.

    Tiles grow with a raster's area, not with the table: they are counted first, and where they are more
    than one task's, pieces are dealt over tasks, so neither a file nor a large raster is one task. A piece is a
    range of tiles for a block of rasters of about the same shape: a tile's id is made once for them all and
    stands in runs, which columnar files keep once; what is shuffled is a block's sides for each piece.
    """
    if size <= 0 or not 0 <= overlap < size:
        raise RasterError(f"tiles of {size} can't overlap by {overlap}")
    step = size - overlap
    c = F.col
    known = rasters.select("raster_id", c("width").cast("int").alias("width"), c("height").cast("int").alias("height")).where("width > 0 AND height > 0")
    across, up = F.ceil(c("width") / step).cast("int"), F.ceil(c("height") / step).cast("int")
    tiles = known.agg(F.sum(across.cast("double") * up)).first()[0] or 0
    # rows that are repeated are numbered, so that they too are dealt over blocks
    known = known.groupBy("raster_id", "width", "height").agg(F.count("*").alias("__n")).withColumn("__n", F.explode(F.sequence(F.lit(1), c("__n"))))
    known = known.withColumns({"__across": F.floor(F.log2(across) * 16).cast("int"), "__up": F.floor(F.log2(up) * 16).cast("int")})
    blocks = known.groupBy("__across", "__up").agg(F.ceil(F.count("*") / BLOCK).alias("__blocks"))
    known = known.join(F.broadcast(blocks), ["__across", "__up"]).withColumn("__block", F.pmod(F.xxhash64("raster_id", "width", "height", "__n"), "__blocks"))
    by_block = known.groupBy("__across", "__up", "__block").agg(F.max(across).alias("__across_most"), F.max(up).alias("__up_most"), F.array_sort(F.collect_list(F.struct("raster_id", "width", "height"))).alias("__b"))
    by_block = by_block.select(c("__across_most").alias("__across"), c("__up_most").alias("__up"), *(c(f"__b.{k}").alias(f"__{k}") for k in ("raster_id", "width", "height")))
    piece = max(TASK / SPLIT, tiles / TASKS / SPLIT)
    each = F.greatest(F.floor(piece / F.size("__width")), F.lit(1))
    cols = F.least(each, c("__across"), F.lit(ROW)).cast("int")
    rows = F.least(F.greatest(F.floor(each / c("__across")), F.lit(1)), c("__up")).cast("int")
    pieces = by_block.withColumns({"__rows": rows, "__cols": cols}).withColumn("__r", F.explode(F.sequence(F.lit(0), c("__up") - 1, c("__rows")))).withColumn("__c", F.explode(F.sequence(F.lit(0), c("__across") - 1, c("__cols"))))
    if tiles > TASK:
        pieces = pieces.repartition(min(math.ceil(tiles / TASK), TASKS))
    sides = ["__raster_id", "__width", "__height"]
    last = c("__r") + F.least(c("__rows"), c("__up") - c("__r")) - 1
    by_row = pieces.select(*sides, "__across", "__c", "__cols", F.explode(F.sequence(c("__r"), last)).alias("__r"))
    last = c("__c") + F.least(c("__cols"), c("__across") - c("__c")) - 1
    tile = lambda k: F.struct(F.concat(F.lit("tile_r"), c("__r").cast("string"), F.lit("_c"), k.cast("string")).alias("tile_id"), (c("__r") * step).alias("row_off"), (k * step).alias("col_off"))
    by_tile = by_row.select(*sides, F.inline(F.transform(F.sequence(c("__c"), last), tile)))
    out = by_tile.select("__width", "__height", "tile_id", "row_off", "col_off", F.posexplode("__raster_id").alias("__i", "raster_id"))
    wide, high = F.get("__width", c("__i")) - c("col_off"), F.get("__height", c("__i")) - c("row_off")
    return out.where((wide > 0) & (high > 0)).select("raster_id", "tile_id", "row_off", "col_off", F.least(F.lit(size), wide).alias("tile_width"), F.least(F.lit(size), high).alias("tile_height"))


def best_tile_size(bytes_per_pixel: Column, target_mb: int = 512) -> Column:
    """The multiple of 256 whose tile, three times over, fits the target: within 256 and 4096."""
    side = F.floor(F.sqrt(F.lit(target_mb * 1024.0 * 1024.0) / (bytes_per_pixel * 3)))
    return F.least(F.greatest(F.floor(side / 256) * 256, F.lit(256)), F.lit(4096)).cast("int")


def tile_pixels(pixels: DataFrame, size: int, overlap: int = 0) -> DataFrame:
    """Pixels with the ids of all tiles that hold them and their place there; without overlap just arithmetic."""
    if size <= 0 or not 0 <= overlap < size:
        raise RasterError(f"tiles of {size} can't overlap by {overlap}")
    step = size - overlap

    def tiles(c: str) -> Column:
        last = F.floor(F.col(c) / step).cast("int")
        first = F.greatest(F.floor((F.col(c) - size) / step).cast("int") + 1, F.lit(0))
        return F.sequence(first, last)

    out = pixels.withColumns({"__r": F.floor(F.col("row") / step).cast("int"), "__c": F.floor(F.col("col") / step).cast("int")}) if not overlap else pixels.withColumn("__r", F.explode(tiles("row"))).withColumn("__c", F.explode(tiles("col")))
    return out.withColumns({
        "tile_id": F.format_string("tile_r%d_c%d", "__r", "__c"), "tile_row": (F.col("row") - F.col("__r") * step).cast("int"), "tile_col": (F.col("col") - F.col("__c") * step).cast("int"),
    }).drop("__r", "__c")


def mosaic(inputs: Sequence[DataFrame], nodata: float | None = None) -> DataFrame:
    """One pixel for each band, row and column: that of the last input that has a value there."""
    if not inputs:
        raise RasterError("no inputs")
    rows = reduce(lambda a, b: a.unionByName(b), [df.withColumn("__i", F.lit(i)) for i, df in enumerate(inputs)])
    good = rows.where(~is_nodata(F.col("value").cast("double"), nodata))
    return good.groupBy("band", "row", "col").agg(F.max_by("value", "__i").alias("value"))


def cloud_cover(pixels: DataFrame, bright: float = 180.0, saturation: float = 0.2, area: DataFrame | None = None, geometry: str = "geom_wkb") -> DataFrame:
    """Percent (one digit) of bright and colourless pixels of each scene, from bands 1, 2 and 3.

    Pixels that are 0 in all bands are nodata; a scene without three bands or without valid
    pixels is null. With ``area`` (polygons) only pixels whose centres (``lon, lat``) lie in one of
    them count, and ``coverage_pct`` is the share of those that have data.
    """
    if area is not None:
        keyed = polygon_zones(pixels, area.select(F.lit(1).alias("__z"), geometry), "__z", geometry)
        pixels = keyed.select("raster_id", "row", "col", "band", "value").distinct()
    wide = pixels.groupBy("raster_id", "row", "col").pivot("band", [1, 2, 3]).agg(F.first("value"))
    r, g, b = (F.col(str(i)).cast("double") for i in (1, 2, 3))
    high, low = F.greatest(r, g, b), F.least(r, g, b)
    valid = r.isNotNull() & g.isNotNull() & b.isNotNull() & ~((r == 0) & (g == 0) & (b == 0))
    sat = F.when(high > 0, (high - low) / high).otherwise(0.0)
    cloud = valid & ((r + g + b) / 3 > bright) & (sat < saturation)
    mean = F.avg(F.when(valid, (r + g + b) / 3)).alias("brightness")
    out = wide.groupBy("raster_id").agg(F.count_if(valid).alias("valid"), F.count_if(cloud).alias("cloudy"), F.count("*").alias("n"), mean)
    more = [] if area is None else [F.round(100.0 * F.col("valid") / F.col("n"), 1).alias("coverage_pct"), F.round("brightness", 1).alias("brightness")]
    return out.select("raster_id", F.when(F.col("valid") > 0, F.round(100.0 * F.col("cloudy") / F.col("valid"), 1)).alias("cloud_pct"), "valid", *more)


def clear_scenes(scenes: DataFrame, pixels: DataFrame, most: float, key: str = "raster_id") -> DataFrame:
    """Scenes whose cover is known and at most ``most``, clearest first."""
    return scenes.join(cloud_cover(pixels), key).where(F.col("cloud_pct").isNotNull() & (F.col("cloud_pct") <= most)).orderBy("cloud_pct", key)


#: Type, quality, compression, predictor and lossy quality of a cloud-optimised copy.
COG_POLICY = [
    ("rgb", "visualization", "JPEG", None, 85), ("rgb", "analysis", "DEFLATE", 2, None), ("rgb", "archive", "LZW", 2, None),
    ("rgba", "visualization", "WEBP", None, 85), ("rgba", "analysis", "DEFLATE", 2, None), ("rgba", "archive", "LZW", 2, None),
    ("dem", "visualization", "DEFLATE", 2, None), ("dem", "analysis", "DEFLATE", 2, None), ("dem", "archive", "LERC_DEFLATE", None, None),
    ("categorical", "visualization", "DEFLATE", None, None), ("categorical", "analysis", "DEFLATE", None, None), ("categorical", "archive", "LZW", None, None),
    ("multispectral", "visualization", "DEFLATE", 2, None), ("multispectral", "analysis", "DEFLATE", 2, None), ("multispectral", "archive", "LERC_DEFLATE", None, None),
    ("panchromatic", "visualization", "JPEG", None, 85), ("panchromatic", "analysis", "DEFLATE", 2, None), ("panchromatic", "archive", "LZW", 2, None),
]
#: Types whose overviews are bilinear; those of others are nearest.
BILINEAR = ("rgb", "rgba", "dem", "multispectral", "panchromatic")


def cog_plan(rasters: DataFrame, quality: str, max_memory_mb: float = 4096.0) -> DataFrame:
    """Compression, predictor, overview resampling and whether to work in memory, for each raster (``raster_type, size_mb``)."""
    schema = "raster_type string, quality string, compression string, predictor int, lossy_quality int"
    policy = rasters.sparkSession.createDataFrame(COG_POLICY, schema).where(F.col("quality") == quality)
    out = rasters.join(F.broadcast(policy), "raster_type", "left")
    known = F.col("compression").isNotNull()
    return out.withColumns({
        "quality": F.lit(quality), "compression": F.coalesce("compression", F.lit("DEFLATE")), "predictor": F.when(known, F.col("predictor")).otherwise(2),
        "resampling": F.when(F.col("raster_type").isin(*BILINEAR), "bilinear").otherwise("nearest"), "in_memory": F.col("size_mb") < max_memory_mb,
    })


def level_one(pixels: DataFrame, by: str = "average") -> DataFrame:
    """The first overview: blocks of two by two pixels, averaged, or their most frequent value (``mode``), or the first (``nearest``)."""
    how = {"average": F.avg("value"), "bilinear": F.avg("value"), "mode": F.mode("value", True), "nearest": F.min_by("value", F.struct("row", "col"))}
    if by not in how:
        raise RasterError(f"no resampling {by!r}")
    grouped = pixels.groupBy("raster_id", "band", F.floor(F.col("row") / 2).alias("row2"), F.floor(F.col("col") / 2).alias("col2")).agg(how[by].alias("value"))
    return grouped.select("raster_id", "band", F.col("row2").alias("row"), F.col("col2").alias("col"), "value")
