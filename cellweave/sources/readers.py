"""Readers of vector files, grids and archives as DataFrames with a WKB column ``geom_wkb``."""

from __future__ import annotations

import io
import json
import os
import re
import sqlite3
import struct
import xml.etree.ElementTree as ET
import zipfile
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellweave.errors import FormatError, GeometryError
from cellweave.functions import geometry as G
from cellweave.session import ship
from cellweave.sources import tiff

#: Column names that are taken for geometry and coordinates, in this order.
WKT_NAMES = ("geometry", "wkt", "geom", "the_geom")
LAT_NAMES = ("latitude", "lat", "y")
LON_NAMES = ("longitude", "lon", "lng", "long", "x")
GEOM = "geom_wkb"


def _find(columns: list[str], names: tuple[str, ...]) -> str | None:
    lower = {c.lower(): c for c in columns}
    return next((lower[n] for n in names if n in lower), None)


def points_from_xy(df: DataFrame, x: str, y: str) -> DataFrame:
    ship(df.sparkSession)
    return df.withColumn(GEOM, G.point_wkb(F.col(f"`{x}`").cast("double"), F.col(f"`{y}`").cast("double")))


def geometry_from_wkt(df: DataFrame, column: str) -> DataFrame:
    """The text column is replaced by WKB."""
    ship(df.sparkSession)
    return df.withColumn(GEOM, G.wkt_to_wkb(F.col(f"`{column}`"))).drop(column)


def read_csv(spark: SparkSession, path: str, lat: str | None = None, lon: str | None = None, wkt: str | None = None, schema: str | None = None) -> DataFrame:
    """Rows with a geometry from a WKT column or coordinates: the named ones, else those with usual names."""
    reader = spark.read.option("header", True)
    df = reader.schema(schema).csv(path) if schema else reader.option("inferSchema", True).csv(path)
    text = wkt or (None if lat and lon else _find(df.columns, WKT_NAMES))
    if text:
        if text not in df.columns:
            raise FormatError(f"no column {text!r}")
        return geometry_from_wkt(df, text)
    y, x = lat or _find(df.columns, LAT_NAMES), lon or _find(df.columns, LON_NAMES)
    if not x or not y or x not in df.columns or y not in df.columns:
        raise FormatError(f"no geometry among {df.columns}")
    return points_from_xy(df, x, y)


def read_geojson(spark: SparkSession, path: str) -> DataFrame:
    """Features of a collection as rows: properties as columns, geometry as WKB; no projection is looked up."""
    ship(spark)
    whole = spark.read.option("multiLine", True).json(path)
    if "features" not in whole.columns:
        raise FormatError("no features")
    kind = whole.schema["features"].dataType
    fields = {f.name: f.dataType for f in kind.elementType.fields} if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StructType) else {}
    rows = spark.read.text(path, wholetext=True)
    # geometries differ in nesting, so they are read as text beside the typed properties
    shapes = rows.select(F.posexplode(F.from_json("value", "features array<struct<geometry:string>>")["features"]).alias("__i", "f"), F.input_file_name().alias("__f")).select("__f", "__i", "f.geometry")
    props = whole.select(F.input_file_name().alias("__f"), F.posexplode("features").alias("__i", "f"))
    cols = [F.col(f"f.properties.`{f.name}`").alias(f.name) for f in fields["properties"].fields] if isinstance(fields.get("properties"), T.StructType) else []
    out = props.select("__f", "__i", *cols).join(shapes, ["__f", "__i"])
    return out.withColumn(GEOM, G.geojson_to_wkb("geometry")).drop("__f", "__i", "geometry")


def _kml_geometry(node: ET.Element) -> G.Geometry | None:
    name = node.tag.rpartition("}")[2]
    child = lambda n: next((c for c in node.iter() if c.tag.rpartition("}")[2] == n), None)

    def coordinates(e):
        found = next((c for c in e.iter() if c.tag.rpartition("}")[2] == "coordinates"), None)
        rows = [[float(v) for v in t.split(",")] for t in (found.text or "").split()] if found is not None else []
        return np.array(rows, dtype=float) if rows else np.zeros((0, 2))

    if name == "Point":
        return ("Point", coordinates(node))
    if name in ("LineString", "LinearRing"):
        return ("LineString", coordinates(node))
    if name == "Polygon":
        outer = child("outerBoundaryIs")
        holes = [coordinates(c) for c in node if c.tag.rpartition("}")[2] == "innerBoundaryIs"]
        return ("Polygon", [coordinates(outer), *holes]) if outer is not None else None
    if name == "MultiGeometry":
        parts = [g for g in map(_kml_geometry, node) if g]
        kinds = {g[0] for g in parts}
        return (f"Multi{kinds.pop()}", [g[1] for g in parts]) if len(kinds) == 1 and kinds <= {"Point", "LineString", "Polygon"} else ("GeometryCollection", parts)
    return None


def kml_rows(raw: bytes) -> Iterator[tuple[str | None, str | None, dict[str, str], bytes | None]]:
    """Name, description, extended data and geometry of each placemark."""
    for _, mark in ET.iterparse(io.BytesIO(raw)):
        if mark.tag.rpartition("}")[2] != "Placemark":
            continue
        own = {c.tag.rpartition("}")[2]: c.text for c in mark}
        extra = {}
        for d in mark.iter():
            tag = d.tag.rpartition("}")[2]
            if tag == "Data" and d.get("name"):
                extra[d.get("name")] = next((v.text or "" for v in d if v.tag.rpartition("}")[2] == "value"), "")
            elif tag == "SimpleData" and d.get("name"):
                extra[d.get("name")] = d.text or ""
        shape = next((g for g in map(_kml_geometry, mark) if g), None)
        yield own.get("name"), own.get("description"), extra, G.encode(shape) if shape else None
        mark.clear()


def _members(raw: bytes, name: str | None, suffix: str) -> bytes:
    with zipfile.ZipFile(io.BytesIO(raw)) as z:
        names = z.namelist()
        pick = name if name in names else next((n for n in names if n.lower().endswith(suffix)), None)
        if pick is None:
            raise FormatError(f"no {suffix} in the archive")
        return z.read(pick)


def _binary(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path).select("content")


def read_kml(spark: SparkSession, path: str, member: str | None = None) -> DataFrame:
    """Placemarks of KML and KMZ files; of an archive the named member, else the first ``.kml``."""
    ship(spark)

    def run(frames):
        for pdf in frames:
            for raw in pdf["content"]:
                raw = bytes(raw)
                rows = list(kml_rows(_members(raw, member, ".kml") if raw[:2] == b"PK" else raw))
                yield pd.DataFrame(rows, columns=["name", "description", "data", GEOM])

    return _binary(spark, path).mapInPandas(run, f"name string, description string, data map<string,string>, {GEOM} binary")


read_kmz = read_kml


def gpkg_geometry(raw: bytes) -> bytes | None:
    """WKB out of a GeoPackage blob: a header, an envelope by its flags, then WKB."""
    if raw[:2] != b"GP":
        raise GeometryError("no GeoPackage geometry")
    flags = raw[3]
    sizes = (0, 32, 48, 48, 64)
    if (flags >> 1) & 7 > 4:
        raise GeometryError("unknown envelope")
    return None if flags & 16 and len(raw) <= 8 else raw[8 + sizes[(flags >> 1) & 7] :]


def _sqlite(raw: bytes) -> sqlite3.Connection:
    con = sqlite3.connect(":memory:")
    con.deserialize(raw)
    return con


def read_gpkg(spark: SparkSession, path: str, layer: str | None = None) -> DataFrame:
    """A layer of GeoPackages: the named one, else the first. Columns other than geometry are text.

    The layer's columns are read from one file's header on the driver; rows are read by the executors.
    """
    ship(spark)
    first = _binary(spark, path).limit(1).collect()
    if not first:
        raise FormatError(f"no file at {path}")
    con = _sqlite(bytes(first[0][0]))
    layers = [r[0] for r in con.execute("SELECT table_name FROM gpkg_contents WHERE data_type = 'features' ORDER BY rowid")]
    if not layers or layer and layer not in layers:
        raise FormatError(f"layers are {layers}")
    name = layer or layers[0]
    (geom,) = con.execute("SELECT column_name FROM gpkg_geometry_columns WHERE table_name = ?", (name,)).fetchone()
    columns = [r[1] for r in con.execute(f'PRAGMA table_info("{name}")') if r[1] != geom]
    con.close()

    def run(frames):
        for pdf in frames:
            for raw in pdf["content"]:
                con = _sqlite(bytes(raw))
                wanted = ", ".join(f'"{c}"' for c in [*columns, geom])
                cursor = con.execute(f'SELECT {wanted} FROM "{name}"')
                while rows := cursor.fetchmany(5000):
                    yield pd.DataFrame([[None if v is None else str(v) for v in r[:-1]] + [gpkg_geometry(r[-1]) if r[-1] else None] for r in rows], columns=[*columns, GEOM], dtype=object)

    return _binary(spark, path).mapInPandas(run, ", ".join(f"`{c}` string" for c in columns) + f", {GEOM} binary")


def shp_shapes(raw: bytes) -> Iterator[bytes | None]:
    """WKB of each record of a shapefile's main file."""
    if len(raw) < 100 or struct.unpack(">i", raw[:4])[0] != 9994:
        raise FormatError("no shapefile")
    at = 100
    while at + 12 <= len(raw):
        (words,) = struct.unpack(">i", raw[at + 4 : at + 8])
        body = raw[at + 8 : at + 8 + 2 * words]
        at += 8 + 2 * words
        (kind,) = struct.unpack("<i", body[:4])
        base = kind % 10
        if kind == 0:
            yield None
        elif base == 1:
            yield G.encode(("Point", np.array([struct.unpack("<2d", body[4:20])])))
        elif base == 8:
            (n,) = struct.unpack("<i", body[36:40])
            p = np.frombuffer(body, "<f8", 2 * n, 40).reshape(n, 2)
            yield G.encode(("MultiPoint", [x[None] for x in p]))
        elif base in (3, 5):
            parts, n = struct.unpack("<2i", body[36:44])
            starts = [*struct.unpack(f"<{parts}i", body[44 : 44 + 4 * parts]), n]
            p = np.frombuffer(body, "<f8", 2 * n, 44 + 4 * parts).reshape(n, 2)
            lines = [p[a:b] for a, b in zip(starts[:-1], starts[1:], strict=True)]
            if base == 3:
                yield G.encode(("LineString", lines[0]) if parts == 1 else ("MultiLineString", lines))
            else:  # outer rings are clockwise here, holes follow theirs
                polygons: list[list[np.ndarray]] = []
                for r in lines:
                    if G.signed_area(r) <= 0 or not polygons:
                        polygons.append([r])
                    else:
                        polygons[-1].append(r)
                yield G.encode(("Polygon", polygons[0]) if len(polygons) == 1 else ("MultiPolygon", polygons))
        else:
            raise FormatError(f"shape type {kind}")


def dbf_rows(raw: bytes) -> tuple[list[str], list[list[str | None]]]:
    """Field names and rows, as text, of a dBase table."""
    n, head, size = struct.unpack("<IHH", raw[4:12])
    fields, at = [], 32
    while raw[at] != 0x0D:
        fields.append((raw[at : at + 11].split(b"\0")[0].decode("latin-1"), raw[at + 16]))
        at += 32
    rows = []
    for i in range(n):
        rec, at = raw[head + i * size : head + (i + 1) * size], 1
        row = []
        for _, width in fields:
            text = rec[at : at + width].decode("utf-8", "replace").strip("\0 ")
            row.append(text or None)
            at += width
        rows.append(row)
    return [f for f, _ in fields], rows


def read_shp(spark: SparkSession, path: str) -> DataFrame:
    """A zipped shapefile, or a ``.shp`` with its ``.dbf`` beside it."""
    ship(spark)

    def parts(raw: bytes, dbf: bytes | None):
        if raw[:2] == b"PK":
            return _members(raw, None, ".shp"), _members(raw, None, ".dbf")
        return raw, dbf

    def beside(p: str) -> bytes | None:
        found = _binary(spark, re.sub(r"\.shp$", ".dbf", p, flags=re.IGNORECASE)).collect()
        return bytes(found[0][0]) if found else None

    table = None if path.lower().endswith(".zip") else beside(path)
    first = bytes(_binary(spark, path).limit(1).collect()[0][0])
    names = dbf_rows(parts(first, table)[1])[0]

    def run(frames):
        for pdf in frames:
            for raw in pdf["content"]:
                shp, dbf = parts(bytes(raw), table)
                rows = [[*r, s] for r, s in zip(dbf_rows(dbf)[1], shp_shapes(shp), strict=True)]
                yield pd.DataFrame(rows, columns=[*names, GEOM], dtype=object)

    return _binary(spark, path).mapInPandas(run, ", ".join(f"`{c}` string" for c in names) + f", {GEOM} binary")


def load_vector(spark: SparkSession, path: str, **options) -> DataFrame:
    """Any known vector file, by its suffix."""
    suffix = os.path.splitext(path)[1].lower()
    known = {
        ".csv": read_csv, ".geojson": read_geojson, ".json": read_geojson, ".gpkg": read_gpkg, ".kml": read_kml, ".kmz": read_kml, ".shp": read_shp, ".zip": read_shp,
        ".parquet": lambda s, p: s.read.parquet(p),
    }
    if suffix not in known:
        raise FormatError(f"no reader for {suffix!r}")
    return known[suffix](spark, path, **options)


def load_grid(spark: SparkSession, path: str) -> DataFrame:
    """Cells from Parquet or GeoJSON, with the id column named ``h3_index``."""
    suffix = os.path.splitext(path.rstrip("/"))[1].lower()
    if suffix not in (".parquet", ".geojson", ".json"):
        raise FormatError(f"no grid reader for {suffix!r}")
    df = spark.read.parquet(path) if suffix == ".parquet" else read_geojson(spark, path)
    if "h3_index" in df.columns:
        return df
    if "cell_id" in df.columns:
        return df.withColumnRenamed("cell_id", "h3_index")
    raise FormatError("neither h3_index nor cell_id")


def scan_theme(spark: SparkSession, base: str, theme: str, kind: str) -> DataFrame:
    """A type of a theme of a table partitioned as ``theme=/type=``; only its folders are read."""
    return spark.read.parquet(base).where((F.col("theme") == theme) & (F.col("type") == kind))


def theme_path(base: str, release: str, theme: str, kind: str) -> str:
    return f"{base.rstrip('/')}/{release}/theme={theme}/type={kind}"


def extract_zip(path: str, target: str) -> list[str]:
    """Unpack into ``target``; members that would leave it are refused."""
    root = os.path.realpath(target)
    with zipfile.ZipFile(path) as z:
        for name in z.namelist():
            if not os.path.realpath(os.path.join(root, name)).startswith(root + os.sep):
                raise FormatError(f"unsafe member {name!r}")
        z.extractall(root)
        return sorted(z.namelist())


def count_zipped(spark: SparkSession, path: str, suffix: str, expected: int) -> tuple[int, bool]:
    """Members with a suffix in the archives at ``path``, and whether they are as many as expected."""

    @F.pandas_udf(T.LongType())
    def members(raw: pd.Series) -> pd.Series:
        return pd.Series([sum(n.lower().endswith(suffix) for n in zipfile.ZipFile(io.BytesIO(bytes(r))).namelist()) for r in raw])

    n = _binary(spark, path).agg(F.sum(members("content"))).head()[0] or 0
    return n, n == expected


# --- rasters --------------------------------------------------------------------------------

_NC_TYPES = {1: "i1", 2: "S1", 3: ">i2", 4: ">i4", 5: ">f4", 6: ">f8"}


def netcdf3(raw: bytes) -> tuple[dict[str, int], dict[str, tuple[tuple[str, ...], np.ndarray]]]:
    """Dimensions and variables of a classic NetCDF file."""
    if raw[:3] != b"CDF" or raw[3] not in (1, 2):
        raise FormatError("not a classic NetCDF file")
    wide, at = raw[3] == 2, 4

    def take(fmt):
        nonlocal at
        out = struct.unpack_from(">" + fmt, raw, at)
        at += struct.calcsize(">" + fmt)
        return out[0]

    def name():
        nonlocal at
        n = take("i")
        out = raw[at : at + n].decode()
        at += -(-n // 4) * 4
        return out

    def attributes():
        nonlocal at
        take("i")
        for _ in range(take("i")):
            name()
            kind, n = take("i"), take("i")
            at += -(-n * np.dtype(_NC_TYPES[kind]).itemsize // 4) * 4

    records = take("i")
    take("i")
    dims = []
    for _ in range(take("i")):
        n = name()
        dims.append((n, take("i")))
    attributes()
    take("i")
    heads = []
    for _ in range(take("i")):
        n = name()
        ids = [take("i") for _ in range(take("i"))]
        attributes()
        kind, size = take("i"), take("i")
        heads.append((n, ids, kind, size, take("q") if wide else take("i")))
    stride = sum(h[3] for h in heads if h[1] and dims[h[1][0]][1] == 0)
    out = {}
    for n, ids, kind, size, begin in heads:
        shape = [dims[i][1] or records for i in ids]
        dtype = np.dtype(_NC_TYPES[kind])
        if ids and dims[ids[0]][1] == 0:
            per = int(np.prod(shape[1:], dtype=int))
            parts = [np.frombuffer(raw, dtype, per, begin + r * stride) for r in range(records)]
            data = np.concatenate(parts).reshape(shape) if parts else np.zeros(shape, dtype)
        else:
            data = np.frombuffer(raw, dtype, int(np.prod(shape, dtype=int)), begin).reshape(shape)
        out[n] = (tuple(dims[i][0] for i in ids), data)
    return {n: s or records for n, s in dims}, out


def read_netcdf(spark: SparkSession, path: str, variable: str | None = None) -> DataFrame:
    """The first variable with two or more dimensions (or the named one) as ``lat, lon, value``, at the first time."""

    def run(frames):
        for pdf in frames:
            for raw in pdf["content"]:
                _, found = netcdf3(bytes(raw))
                pick = variable or next((n for n, (d, _) in found.items() if len(d) >= 2), None)
                if pick not in found:
                    raise FormatError("no variable with two dimensions")
                dims, data = found[pick]
                while len(dims) > 2:
                    data, dims = data[0], dims[1:]
                axis = [found[d][1].astype(float) if d in found else np.arange(n, dtype=float) for d, n in zip(dims, data.shape, strict=True)]
                lat, lon = np.meshgrid(*axis, indexing="ij")
                yield pd.DataFrame({"lat": lat.ravel(), "lon": lon.ravel(), "value": data.astype(float).ravel()})

    ship(spark)
    return _binary(spark, path).mapInPandas(run, "lat double, lon double, value double")


def tiff_pixels(raw: bytes, window: tuple[int, int, int, int] | None = None) -> dict:
    """Data of a TIFF (of a window of rows and columns, from and to), its place, nodata and data type."""
    image = tiff.images(raw)[0]
    r0, _, c0, _ = window or (0, 0, 0, 0)
    return {
        "data": tiff.read_window(raw, image, window), "left": image.left + c0 * image.res_x, "top": image.top - r0 * image.res_y, "res_x": image.res_x, "res_y": image.res_y,
        "srid": image.srid, "nodata": image.nodata, "dtype": image.dtype.name,
    }


def write_tiff(data: np.ndarray, left: float, top: float, res_x: float, res_y: float, nodata: float | None = None, srid: int = 4326, deflate: bool = True) -> bytes:
    """A TIFF of ``data`` (rows, columns, bands) with its place on the globe, in one strip."""
    import zlib

    data = np.ascontiguousarray(data if data.ndim == 3 else data[:, :, None])
    data = data.astype(data.dtype.newbyteorder("<"))
    body = zlib.compress(data.tobytes(), 6) if deflate else data.tobytes()
    form = {"u": 1, "i": 2, "f": 3}[data.dtype.kind]
    h, w, n = data.shape
    entries = [
        (256, "I", (w,)), (257, "I", (h,)), (258, "H", (data.dtype.itemsize * 8,) * n), (259, "H", (8 if deflate else 1,)), (262, "H", (1,)), (273, "I", (0,)), (277, "H", (n,)), (278, "I", (h,)),
        (279, "I", (len(body),)), (284, "H", (1,)), (339, "H", (form,) * n), (33550, "d", (res_x, res_y, 0.0)), (33922, "d", (0.0, 0.0, 0.0, left, top, 0.0)),
        (34735, "H", (1, 1, 0, 3, 1024, 0, 1, 2 if srid == 4326 else 1, 1025, 0, 1, 1, 2048 if srid == 4326 else 3072, 0, 1, srid)),
    ]
    if nodata is not None:
        entries.append((42113, "s", (str(nodata).encode() + b"\0",)))
    codes = {"I": 4, "H": 3, "d": 12, "s": 2}
    extra_at, extra, heads = 8 + 2 + 12 * len(entries) + 4, b"", []
    for tag, fmt, values in entries:
        packed = values[0] if fmt == "s" else struct.pack(f"<{len(values)}{fmt}", *values)
        count = len(packed) if fmt == "s" else len(values)
        if len(packed) <= 4:
            heads.append([tag, codes[fmt], count, packed.ljust(4, b"\0")])
        else:
            heads.append([tag, codes[fmt], count, struct.pack("<I", extra_at + len(extra))])
            extra += packed + b"\0" * (len(packed) % 2)
    for x in heads:
        if x[0] == 273:
            x[3] = struct.pack("<I", extra_at + len(extra))
    return b"II*\0" + struct.pack("<IH", 8, len(heads)) + b"".join(struct.pack("<HHI", *x[:3]) + x[3] for x in heads) + b"\0\0\0\0" + extra + body


def read_tiff(spark: SparkSession, path: str, window: tuple[int, int, int, int] | None = None) -> DataFrame:
    """Pixels of GeoTIFF files: ``raster_id, band, row, col, lon, lat, value``, nodata as null.

    Strips and tiles, plain, deflated or LZW, classic and big files. A file is one task, which
    unpacks one block at a time; with ``window`` (rows and columns, from and to) only blocks that meet it.
    """
    ship(spark)

    def run(frames):
        for pdf in frames:
            for name, raw in zip(pdf["path"], pdf["content"], strict=True):
                raw = bytes(raw)
                t = tiff.images(raw)[0]
                for r0, c0, first, block in tiff.blocks(raw, t, window):
                    h, w, n = block.shape
                    rows, cols = np.divmod(np.arange(h * w), w)
                    rows, cols = rows + r0, cols + c0
                    for b in range(n):
                        v = block[:, :, b].astype(float).ravel()
                        gone = np.isnan(v) if t.nodata is None or t.nodata != t.nodata else np.isclose(v, t.nodata) | np.isnan(v)
                        yield pd.DataFrame({
                            "raster_id": os.path.basename(name), "band": first + b + 1, "row": rows, "col": cols, "lon": t.left + (cols + 0.5) * t.res_x, "lat": t.top - (rows + 0.5) * t.res_y,
                            "value": pd.Series(v).where(~gone, None),
                        })

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInPandas(run, "raster_id string, band int, row int, col int, lon double, lat double, value double")


# --- catalogs -------------------------------------------------------------------------------


def stac_items(spark: SparkSession, path: str) -> DataFrame:
    """Items of STAC search results stored as JSON, one row for each feature."""
    rows = spark.read.text(path, wholetext=True)
    schema = (
        "features array<struct<id:string, collection:string, bbox:array<double>, geometry:string, properties:map<string,string>, assets:map<string,struct<href:string>>>>"
    )
    f = rows.select(F.explode(F.from_json("value", schema)["features"]).alias("f"))
    return f.select("f.*").withColumn("browse", F.col("assets.browse.href"))


def search_items(items: DataFrame, bbox: tuple[float, float, float, float] | None = None, collections: list[str] | None = None, start: str | None = None, end: str | None = None, filter: dict | None = None, limit: int | None = None) -> DataFrame:
    """Items whose box touches ``bbox``, in collections and a span of time, that pass a CQL2 filter; ``limit`` takes the newest."""
    from cellweave.operators.select import cql2

    out = items
    if bbox:
        b = F.col("bbox")
        out = out.where((b[0] <= bbox[2]) & (b[2] >= bbox[0]) & (b[1] <= bbox[3]) & (b[3] >= bbox[1]))
    if collections:
        out = out.where(F.col("collection").isin(collections))
    when = F.col("properties")["datetime"]
    out = out.where(when >= start) if start else out
    out = out.where(when <= end) if end else out
    if filter:
        names = sorted(set(re.findall(r'"property":\s*"([^"]+)"', json.dumps(filter))))
        numbers = {n: F.expr(f"try_cast(properties['{n}'] as double)") for n in names}
        out = out.withColumns(numbers).where(cql2(filter)).drop(*names)
    return out.orderBy(F.desc(when), "id").limit(limit) if limit else out


def low_cloud_filter(max_cloud: float, max_off_nadir: float | None = None) -> dict:
    args = [{"op": "<=", "args": [{"property": "eo:cloud_cover"}, max_cloud]}]
    if max_off_nadir is not None:
        args.append({"op": "<=", "args": [{"property": "view:off_nadir"}, max_off_nadir]})
    return {"op": "and", "args": args}
