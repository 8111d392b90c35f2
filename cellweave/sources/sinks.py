"""Writers: sorted Parquet, single files, GeoPackage, GeoTIFF tiles, STAC, mosaics and metric logs."""

from __future__ import annotations

import json
import os
import sqlite3
import struct
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellweave.errors import FormatError, RasterError
from cellweave.functions import geometry as G
from cellweave.sources import tiff
from cellweave.sources.readers import GEOM, write_tiff


def write_sorted(df: DataFrame, path: str, key: str, partitions: int | None = None, compression: str = "zstd", mode: str = "errorifexists") -> None:
    """Parquet in the order of ``key``: ranges are dealt out to files, each sorted, so scans by key skip row groups."""
    dealt = df.repartitionByRange(partitions, key) if partitions else df.repartitionByRange(key)
    dealt.sortWithinPartitions(key).write.mode(mode).option("compression", compression).parquet(path)


def write_partitioned(df: DataFrame, path: str, by: Sequence[str], mode: str = "errorifexists") -> None:
    """One folder for each value; rows are dealt out by them and a hash of the row, so a large value has several files.

    The hash is the same when a task is repeated, so no row is lost or doubled by a retry.
    """
    df.withColumn("__s", F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]), F.lit(8)).cast("int")).repartition(*by, "__s").drop("__s").write.mode(mode).partitionBy(*by).parquet(path)


def compact(spark: SparkSession, source: str, target: str, key: str, files: int) -> None:
    """Many small files as ``files`` sorted ones."""
    write_sorted(spark.read.parquet(source), target, key, files)


def float_sink(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Doubles as floats, once, just before writing."""
    return df.withColumns({c: F.col(c).cast("float") for c, k in df.dtypes if k == "double" and c not in keep})


def export_gpkg(df: DataFrame, path: str, layer: str = "layer", srid: int = 4326, geometry: str = GEOM) -> int:
    """A GeoPackage on the driver's disk, streamed partition by partition; the format is a single SQLite file."""
    columns = [c for c in df.columns if c != geometry]
    con = sqlite3.connect(path)
    con.executescript(
        "PRAGMA application_id = 1196444487;"
        "CREATE TABLE gpkg_spatial_ref_sys (srs_name TEXT, srs_id INTEGER PRIMARY KEY, organization TEXT, organization_coordsys_id INTEGER, definition TEXT, description TEXT);"
        "CREATE TABLE gpkg_contents (table_name TEXT PRIMARY KEY, data_type TEXT, identifier TEXT, description TEXT DEFAULT '', last_change TEXT, min_x REAL, min_y REAL, max_x REAL, max_y REAL, srs_id INTEGER);"
        "CREATE TABLE gpkg_geometry_columns (table_name TEXT, column_name TEXT, geometry_type_name TEXT, srs_id INTEGER, z INTEGER, m INTEGER);"
    )
    con.execute("INSERT INTO gpkg_spatial_ref_sys VALUES (?, ?, 'EPSG', ?, 'undefined', '')", (f"EPSG:{srid}", srid, srid))
    con.execute("INSERT INTO gpkg_contents (table_name, data_type, identifier, srs_id) VALUES (?, 'features', ?, ?)", (layer, layer, srid))
    con.execute("INSERT INTO gpkg_geometry_columns VALUES (?, 'geom', 'GEOMETRY', ?, 0, 0)", (layer, srid))
    con.execute(f'CREATE TABLE "{layer}" (fid INTEGER PRIMARY KEY, geom BLOB' + "".join(f', "{c}"' for c in columns if c.lower() != "fid") + ")")
    head = b"GP\x00\x01" + struct.pack("<i", srid)
    wanted = [c for c in columns if c.lower() != "fid"]
    n = 0
    for row in df.select(geometry, *wanted).toLocalIterator():
        values = [v if isinstance(v, (int, float, str, type(None))) else str(v) for v in row[1:]]
        con.execute(f'INSERT INTO "{layer}" (geom' + "".join(f', "{c}"' for c in wanted) + ") VALUES (" + ", ".join("?" * (len(wanted) + 1)) + ")", [head + bytes(row[0]) if row[0] else None, *values])
        n += 1
    con.commit()
    con.close()
    return n


def to_geojson(df: DataFrame, geometry: str = GEOM) -> DataFrame:
    """A feature as JSON text for each row (``value``), ready for ``write.text``."""
    from pyspark.sql import types as T

    @F.pandas_udf(T.StringType())
    def shape(raw: pd.Series) -> pd.Series:
        return pd.Series([json.dumps(G.to_geojson(G.decode(bytes(r)))) if r is not None else "null" for r in raw])

    props = F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns if c != geometry]))
    return df.select(F.concat(F.lit('{"type":"Feature","geometry":'), shape(F.col(geometry)), F.lit(',"properties":'), props, F.lit("}")).alias("value"))


def tile_tiffs(pixels: DataFrame, size: int, left: float, top: float, res_x: float, res_y: float, nodata: float = -9999.0) -> DataFrame:
    """A GeoTIFF (``content``) for each tile and band of a pixel table, placed by its offset."""
    from cellweave.operators.raster import tile_pixels

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        r0, c0 = int(pdf["row"].iloc[0] - pdf["tile_row"].iloc[0]), int(pdf["col"].iloc[0] - pdf["tile_col"].iloc[0])
        data = np.full((pdf["tile_row"].max() + 1, pdf["tile_col"].max() + 1), nodata, dtype="<f8")
        data[pdf["tile_row"], pdf["tile_col"]] = pdf["value"].fillna(nodata)
        body = write_tiff(data, left + c0 * res_x, top - r0 * res_y, res_x, res_y, nodata)
        return pd.DataFrame([[str(pdf["raster_id"].iloc[0]), int(pdf["band"].iloc[0]), pdf["tile_id"].iloc[0], body]], columns=["raster_id", "band", "tile_id", "content"])

    tiles = tile_pixels(pixels, size)
    return tiles.groupBy("raster_id", "band", "tile_id").applyInPandas(run, "raster_id string, band int, tile_id string, content binary")


#: Compressions that are written here; of others of the policy, a copy is deflated and says so.
WRITTEN = ("DEFLATE", "NONE")


def cog_copies(files: DataFrame, quality: str = "analysis", block: int = 512, levels: int = 6) -> DataFrame:
    """Cloud-optimised copies of TIFF files (``path, content``): ``path, raster_type, planned, compression, resampling, overviews, content``.

    Type, compression and resampling follow the policy; ``planned`` is what it asks for, and
    ``compression`` what the copy has (see ``WRITTEN``). A file is one row and one task; files that can't
    be read raise an error. Write ``content`` by rows, or go on with ``read_tiff``'s functions.
    """
    from cellweave.operators.raster import BILINEAR, COG_POLICY
    from cellweave.session import ship

    ship(files.sparkSession)
    policy = {kind: (packing, predictor) for kind, q, packing, predictor, _ in COG_POLICY if q == quality}

    def kind_of(data: np.ndarray, nodata: float | None) -> str:
        n, dtype = data.shape[2], data.dtype.name
        if n > 1:
            return {3: "rgb", 4: "rgba"}.get(n, "multispectral" if n > 4 else "unknown")
        if dtype in ("uint8", "int8"):
            head = data[:1024, :1024, 0]
            return "categorical" if len(np.unique(head if nodata is None else head[head != nodata])) < 256 else "panchromatic" if dtype == "uint8" else "dem"
        return "dem"

    def run(frames):
        for pdf in frames:
            for path, raw in zip(pdf["path"], pdf["content"], strict=True):
                image = tiff.images(bytes(raw))[0]
                data = tiff.read_window(bytes(raw), image)
                kind = kind_of(data, image.nodata)
                planned, predictor = policy.get(kind, ("DEFLATE", 2))
                how = "bilinear" if kind in BILINEAR else "nearest"
                body = tiff.write_cog(data, image.left, image.top, image.res_x, image.res_y, image.nodata, image.srid or 4326, block, levels, how, planned != "NONE", predictor)
                yield pd.DataFrame([[path, kind, planned, planned if planned in WRITTEN else "DEFLATE", how, len(tiff.images(body)) - 1, body]], columns=["path", "raster_type", "planned", "compression", "resampling", "overviews", "content"])

    return files.select("path", "content").mapInPandas(run, "path string, raster_type string, planned string, compression string, resampling string, overviews int, content binary")


def mosaic_json(assets: DataFrame, zoom: int = 5, path: str = "path") -> dict:
    """A mosaic document: assets (``path, west, south, east, north``) by the web-map tile of their centre.

    One entry for each occupied tile comes to the driver, as the document is one file.
    """
    if assets.isEmpty():
        raise RasterError("no assets")
    n = 2**zoom
    lon, lat = (F.col("west") + F.col("east")) / 2, F.radians((F.col("south") + F.col("north")) / 2)
    x = F.least(F.greatest(F.floor((lon + 180) / 360 * n), F.lit(0)), F.lit(n - 1))
    y = F.least(F.greatest(F.floor((1 - F.log(F.tan(lat) + 1 / F.cos(lat)) / np.pi) / 2 * n), F.lit(0)), F.lit(n - 1))
    digits = [(F.shiftright(x.cast("int"), i).bitwiseAND(F.lit(1)) + 2 * F.shiftright(y.cast("int"), i).bitwiseAND(F.lit(1))).cast("string") for i in range(zoom - 1, -1, -1)]
    keyed = assets.withColumn("quadkey", F.concat(*digits))
    whole = keyed.agg(F.min("west"), F.min("south"), F.max("east"), F.max("north")).head()
    tiles = {r[0]: r[1] for r in keyed.groupBy("quadkey").agg(F.array_sort(F.collect_list(path))).orderBy("quadkey").collect()}
    return {"mosaicjson": "0.0.3", "version": "1.0.0", "minzoom": zoom, "maxzoom": zoom, "quadkey_zoom": zoom, "bounds": list(whole), "tiles": tiles}


def stac_item(item_id: str | None, bbox: Sequence[float], href: str, collection: str | None = None, properties: dict | None = None) -> dict:
    w, s, e, n = bbox
    ring = [[w, s], [e, s], [e, n], [w, n], [w, s]]
    return {
        "type": "Feature", "stac_version": "1.0.0", "id": item_id, "collection": collection, "bbox": list(bbox), "geometry": {"type": "Polygon", "coordinates": [ring]},
        "properties": {"datetime": None} | (properties or {}), "links": [], "assets": {"data": {"href": href, "type": "image/tiff; application=geotiff", "roles": ["data"]}},
    }


def stac_items(rasters: DataFrame, collection: str | None = None) -> DataFrame:
    """Items as JSON text for rasters (``raster_id, west, south, east, north, href``)."""
    w, s, e, n = (F.col(c) for c in ("west", "south", "east", "north"))
    ring = F.array(*[F.array(a, b) for a, b in ((w, s), (e, s), (e, n), (w, n), (w, s))])
    item = F.struct(
        F.lit("Feature").alias("type"), F.lit("1.0.0").alias("stac_version"), F.coalesce(F.col("raster_id").cast("string"), F.lit("unknown")).alias("id"), F.lit(collection).alias("collection"),
        F.array(w, s, e, n).alias("bbox"), F.struct(F.lit("Polygon").alias("type"), F.array(ring).alias("coordinates")).alias("geometry"),
        F.struct(F.struct(F.col("href").alias("href")).alias("data")).alias("assets"),
    )
    return rasters.select(F.to_json(item).alias("value"))


def write_stac_catalog(items: Sequence[dict], out: str, catalog_id: str, description: str) -> str:
    """``catalog.json`` with links to itself as self and root, and ``items/<id>.json``; an item without id is ``unknown``."""
    os.makedirs(os.path.join(out, "items"), exist_ok=True)
    for item in items:
        name = item.get("id") or "unknown"
        if os.path.basename(name) != name:
            raise FormatError(f"unsafe id {name!r}")
        with open(os.path.join(out, "items", f"{name}.json"), "w", encoding="utf-8") as f:
            json.dump(item, f)
    place = os.path.join(out, "catalog.json")
    links = [{"rel": r, "href": "catalog.json", "type": "application/json"} for r in ("self", "root")]
    with open(place, "w", encoding="utf-8") as f:
        json.dump({"type": "Catalog", "stac_version": "1.0.0", "id": catalog_id, "description": description, "links": links}, f)
    return place


def append_metrics(records: DataFrame, path: str) -> None:
    records.write.mode("append").json(path)


def size_report(inputs: int, output: int) -> dict[str, float]:
    """Sizes in bytes and how often the output fits the inputs, to two digits."""
    return {"input_bytes": inputs, "output_bytes": output, "ratio": round(inputs / output, 2) if output else 0.0}
