import json
import os
import sqlite3
import struct
import zipfile
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from cellweave.config import BatchConfig, CogConfig, Quality, Settings, ThemeConfig, Tier, TilingConfig
from cellweave.errors import ConfigError, FormatError, RasterError, StorageError
from cellweave.functions import geometry as G
from cellweave.operators.raster import first_time, sample_axis, tile_grid
from cellweave.sources import readers as R
from cellweave.sources import sinks as W
from cellweave.sources import tiff
from cellweave.sources.storage import Storage, file_records


def shapes(df):
    return sorted(r[0] for r in df.select(G.wkb_to_wkt("geom_wkb")).collect())


def test_csv(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,LAT,Lng\n1,2.5,3.5\n2,,1\n")
    df = R.load_vector(spark, str(tmp_path / "a.csv"))
    assert [r[0] for r in df.orderBy("id").select(G.wkb_to_wkt("geom_wkb")).collect()] == ["POINT (3.5 2.5)", None]
    (tmp_path / "b.csv").write_text('id,the_geom\n1,"LINESTRING (0 0, 1 1)"\n')
    df = R.read_csv(spark, str(tmp_path / "b.csv"))
    assert df.columns == ["id", "geom_wkb"] and shapes(df) == ["LINESTRING (0 0, 1 1)"]
    (tmp_path / "c.csv").write_text("id,b\n1,2\n")
    with pytest.raises(FormatError):
        R.read_csv(spark, str(tmp_path / "c.csv"))
    with pytest.raises(FormatError):
        R.load_vector(spark, "x.docx")


def test_geojson_both_ways(spark, tmp_path):
    features = [
        {"type": "Feature", "geometry": {"type": "Point", "coordinates": [1, 2]}, "properties": {"cell_id": "a", "n": 1}},
        {"type": "Feature", "geometry": {"type": "Polygon", "coordinates": [[[0, 0], [1, 0], [1, 1], [0, 0]]]}, "properties": {"cell_id": "b", "n": 2}},
        {"type": "Feature", "geometry": None, "properties": {"cell_id": "c", "n": None}},
    ]
    path = str(tmp_path / "a.geojson")
    with open(path, "w") as f:
        json.dump({"type": "FeatureCollection", "features": features}, f)
    df = R.load_grid(spark, path)
    assert {r["h3_index"]: r[1] for r in df.select("h3_index", G.wkb_to_wkt("geom_wkb")).collect()} == {"a": "POINT (1 2)", "b": "POLYGON ((0 0, 1 0, 1 1, 0 0))", "c": None}
    lines = [json.loads(r[0]) for r in W.to_geojson(df).collect()]
    assert sorted(x["properties"]["h3_index"] for x in lines) == ["a", "b", "c"]


KML = """<kml xmlns="http://www.opengis.net/kml/2.2"><Document><Placemark><name>a</name><ExtendedData><Data name="k"><value>v</value></Data></ExtendedData>
<Point><coordinates>1,2,0</coordinates></Point></Placemark><Placemark><name>b</name><Polygon><outerBoundaryIs><LinearRing><coordinates>0,0 1,0 1,1 0,0</coordinates></LinearRing></outerBoundaryIs></Polygon></Placemark></Document></kml>"""


def test_kml_and_kmz(spark, tmp_path):
    (tmp_path / "a.kml").write_text(KML)
    with zipfile.ZipFile(tmp_path / "a.kmz", "w") as z:
        z.writestr("doc.kml", KML)
    for name in ("a.kml", "a.kmz"):
        df = R.load_vector(spark, str(tmp_path / name))
        assert shapes(df) == ["POINT Z (1 2 0)", "POLYGON ((0 0, 1 0, 1 1, 0 0))"]
        assert df.where("name = 'a'").head()["data"] == {"k": "v"}
    with zipfile.ZipFile(tmp_path / "b.kmz", "w") as z:
        z.writestr("x.txt", "")
    with pytest.raises(Exception, match="no .kml"):
        R.read_kmz(spark, str(tmp_path / "b.kmz")).collect()


def test_gpkg_both_ways(spark, tmp_path):
    df = spark.createDataFrame([(1, "x", "POINT (1 2)"), (2, None, "LINESTRING (0 0, 1 1)")], "id long, name string, wkt string").withColumn("geom_wkb", G.wkt_to_wkb("wkt")).drop("wkt")
    path = str(tmp_path / "a.gpkg")
    assert W.export_gpkg(df, path, "things") == 2
    assert sqlite3.connect(path).execute("SELECT count(*) FROM things").fetchone() == (2,)
    back = R.load_vector(spark, path)
    assert shapes(back) == ["LINESTRING (0 0, 1 1)", "POINT (1 2)"]
    assert {r["name"] for r in back.collect()} == {"x", None}
    with pytest.raises(FormatError):
        R.read_gpkg(spark, path, "others")


def test_shapefile(spark, tmp_path):
    recs = b"".join(struct.pack(">ii", i + 1, 10) + struct.pack("<i2d", 1, x, y) for i, (x, y) in enumerate([(1, 2), (3, 4)]))
    shp = struct.pack(">i5ii", 9994, 0, 0, 0, 0, 0, (100 + len(recs)) // 2) + struct.pack("<ii8d", 1000, 1, *[0.0] * 8) + recs
    dbf = struct.pack("<B3BIHH20x", 3, 1, 1, 1, 2, 32 + 32 + 1, 6) + b"NAME".ljust(11, b"\0") + b"C" + b"\0" * 4 + bytes([5]) + b"\0" * 15 + b"\r" + b" ab   " + b" cd   "
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("a.shp", shp)
        z.writestr("a.dbf", dbf)
    df = R.load_vector(spark, str(tmp_path / "a.zip"))
    assert shapes(df) == ["POINT (1 2)", "POINT (3 4)"] and sorted(r["NAME"] for r in df.collect()) == ["ab", "cd"]
    (tmp_path / "b.shp").write_bytes(shp)
    (tmp_path / "b.dbf").write_bytes(dbf)
    assert shapes(R.load_vector(spark, str(tmp_path / "b.shp"))) == ["POINT (1 2)", "POINT (3 4)"]
    assert R.count_zipped(spark, str(tmp_path / "a.zip"), ".shp", 1) == (1, True)
    assert R.extract_zip(str(tmp_path / "a.zip"), str(tmp_path / "out")) == ["a.dbf", "a.shp"]


def test_tiff_both_ways(spark, tmp_path):
    data = np.arange(12, dtype="<f4").reshape(3, 4)
    data[0, 0] = -9999
    for deflate in (True, False):
        (tmp_path / "a.tif").write_bytes(R.write_tiff(data, 10.0, 50.0, 0.5, 0.5, -9999.0, deflate=deflate))
        rows = R.read_tiff(spark, str(tmp_path / "a.tif")).orderBy("row", "col").collect()
        assert [r["value"] for r in rows] == [None, *map(float, range(1, 12))]
        assert (rows[-1]["lon"], rows[-1]["lat"]) == (11.75, 48.75)
    pixels = R.read_tiff(spark, str(tmp_path / "a.tif"))
    tiles = {r["tile_id"]: R.tiff_pixels(bytes(r["content"])) for r in W.tile_tiffs(pixels, 2, 10.0, 50.0, 0.5, 0.5).collect()}
    assert set(tiles) == {"tile_r0_c0", "tile_r0_c1", "tile_r1_c0", "tile_r1_c1"}
    assert tiles["tile_r1_c1"]["data"][:, :, 0].tolist() == [[10.0, 11.0]] and tiles["tile_r1_c1"]["left"] == 11.0
    with pytest.raises(FormatError):
        R.tiff_pixels(b"raster")


def lzw(data):
    """A plain LZW writer, to have files to read."""
    out, held, bits, width, table = bytearray(), 0, 0, 9, {}

    def put(code):
        nonlocal held, bits
        held, bits = held << width | code, bits + width
        while bits >= 8:
            out.append(held >> bits - 8 & 255)
            bits -= 8
            held &= (1 << bits) - 1

    def clear():
        nonlocal width, table
        put(256)
        width, table = 9, {bytes((i,)): i for i in range(256)} | {b"clear": 256, b"end": 257}

    clear()
    word = b""
    for b in data:
        if word + bytes((b,)) in table:
            word += bytes((b,))
            continue
        put(table[word])
        table[word + bytes((b,))] = len(table)
        if len(table) == 4095:
            clear()
        elif len(table) >= 1 << width:
            width += 1
        word = bytes((b,))
    if word:
        put(table[word])
    put(257)
    if bits:
        out.append(held << 8 - bits & 255)
    return bytes(out)


def test_lzw_and_windows():
    rng = np.random.default_rng(0)
    for data in (b"", b"a" * 10_000, bytes(rng.integers(0, 4, 30_000, dtype=np.uint8)), bytes(rng.integers(0, 256, 60_000, dtype=np.uint8))):
        assert tiff.lzw_decode(lzw(data)) == data
    with pytest.raises(FormatError):
        tiff.lzw_decode(bytes((1, 2, 3)))
    data = rng.integers(0, 200, (37, 53, 3)).astype("u2")
    raw = tiff.write_cog(data, 10.0, 50.0, 0.5, 0.25, 199.0, block=16, predictor=2)
    image, *overviews = tiff.images(raw)
    assert (image.width, image.height, image.bands, image.left, image.top, image.nodata, image.srid) == (53, 37, 3, 10.0, 50.0, 199.0, 4326)
    assert [(o.width, o.height) for o in overviews] == [(27, 19), (14, 10)]
    assert (tiff.read_window(raw, image) == data).all() and (tiff.read_window(raw, image, (5, 30, 17, 100)) == data[5:30, 17:]).all()
    assert len(list(tiff.blocks(raw, image, (0, 16, 0, 16)))) == 1
    assert (tiff.read_window(raw, overviews[0])[:-1, :-1] == tiff.halve(data, 199.0, "bilinear")[:-1, :-1]).all()
    part = R.tiff_pixels(raw, (5, 30, 17, 100))
    assert (part["left"], part["top"], part["data"].shape) == (18.5, 48.75, (25, 36, 3))
    assert tiff.halve(np.array([[1.0, -9.0], [3.0, -9.0]])[:, :, None], -9.0, "bilinear").item() == 2.0


def test_lzw_and_big_files(spark, tmp_path):
    data = np.arange(35, dtype="u1").reshape(5, 7)
    body = lzw(data.tobytes())
    tags = [(256, 4, 7), (257, 4, 5), (258, 3, 8), (259, 3, 5), (277, 3, 1), (278, 4, 5), (339, 3, 1)]
    small = b"II*\0" + struct.pack("<IH", 8, 9)
    at = 8 + 2 + 12 * 9 + 4
    for tag, kind, value in sorted([*tags, (273, 4, at), (279, 4, len(body))]):
        small += struct.pack("<HHII", tag, kind, 1, value)
    (tmp_path / "a.tif").write_bytes(small + b"\0" * 4 + body)
    big = b"II" + struct.pack("<HHHQQ", 43, 8, 0, 16, 9)
    at = 16 + 8 + 20 * 9 + 8
    for tag, kind, value in sorted([*tags, (273, 16, at), (279, 16, len(body))]):
        big += struct.pack("<HHQQ", tag, kind, 1, value)
    (tmp_path / "b.tif").write_bytes(big + b"\0" * 8 + body)
    rows = R.read_tiff(spark, str(tmp_path / "*.tif")).groupBy("raster_id").agg(F.sum("value"), F.max(F.struct("row", "col"))).collect()
    assert sorted((r[0], r[1], tuple(r[2])) for r in rows) == [("a.tif", 595.0, (4, 6)), ("b.tif", 595.0, (4, 6))]
    assert R.read_tiff(spark, str(tmp_path / "a.tif"), window=(1, 3, 2, 4)).count() == 4
    files = spark.read.format("binaryFile").load(str(tmp_path / "a.tif"))
    copy = W.cog_copies(files, "archive").head()
    assert (copy["raster_type"], copy["planned"], copy["compression"], copy["resampling"]) == ("categorical", "LZW", "DEFLATE", "nearest")
    assert (R.tiff_pixels(bytes(copy["content"]))["data"][:, :, 0] == data).all()


def test_netcdf(spark, tmp_path):
    def name(s):
        return struct.pack(">i", len(s)) + s.encode().ljust(-(-len(s) // 4) * 4, b"\0")

    dims = struct.pack(">ii", 10, 3) + name("time") + struct.pack(">i", 2) + name("lat") + struct.pack(">i", 2) + name("lon") + struct.pack(">i", 3)
    variables = [("lat", [1], [10.0, 20.0]), ("lon", [2], [1.0, 2.0, 3.0]), ("v", [0, 1, 2], list(map(float, range(12))))]

    def build(begins):
        out = b"CDF\x01" + struct.pack(">i", 0) + dims + struct.pack(">ii", 0, 0) + struct.pack(">ii", 11, 3)
        for (n, ids, values), b in zip(variables, begins, strict=True):
            out += name(n) + struct.pack(f">i{len(ids)}i", len(ids), *ids) + struct.pack(">ii", 0, 0) + struct.pack(">iii", 6, 8 * len(values), b)
        return out

    size = len(build([0, 0, 0]))
    body = b"".join(struct.pack(f">{len(v)}d", *v) for _, _, v in variables)
    (tmp_path / "a.nc").write_bytes(build([size, size + 16, size + 40]) + body)
    df = R.read_netcdf(spark, str(tmp_path / "a.nc"))
    assert sorted(tuple(r) for r in df.collect()) == [(10.0, 1.0, 0.0), (10.0, 2.0, 1.0), (10.0, 3.0, 2.0), (20.0, 1.0, 3.0), (20.0, 2.0, 4.0), (20.0, 3.0, 5.0)]
    near = sample_axis(spark.createDataFrame([(14.0, 2.4)], "lat double, lon double"), df, [10.0, 20.0], [1.0, 2.0, 3.0]).head()
    assert near["value"] == 1.0
    times = spark.createDataFrame([(1, 5.0), (2, 6.0)], "time int, value double")
    assert [r["value"] for r in first_time(times).collect()] == [5.0]


def test_stac_and_mosaic(spark, tmp_path):
    items = [
        {"id": "a", "collection": "c", "bbox": [0, 0, 1, 1], "geometry": None, "properties": {"eo:cloud_cover": 5, "view:off_nadir": 1, "datetime": "2024-01-02"}, "assets": {"browse": {"href": "u"}}},
        {"id": "b", "collection": "c", "bbox": [50, 0, 51, 1], "geometry": None, "properties": {"eo:cloud_cover": 50, "datetime": "2024-01-03"}, "assets": {}},
    ]
    (tmp_path / "s.json").write_text(json.dumps({"features": items}))
    df = R.stac_items(spark, str(tmp_path / "s.json"))
    assert df.where("id = 'a'").head()["browse"] == "u"
    assert [r["id"] for r in R.search_items(df, filter=R.low_cloud_filter(10)).collect()] == ["a"]
    assert [r["id"] for r in R.search_items(df, bbox=(40, -1, 60, 2)).collect()] == ["b"]
    assert [r["id"] for r in R.search_items(df, limit=1).collect()] == ["b"]
    place = W.write_stac_catalog([W.stac_item("x", (0, 0, 1, 1), "x.tif"), W.stac_item(None, (0, 0, 1, 1), "y.tif")], str(tmp_path / "cat"), "id", "text")
    assert {x["rel"] for x in json.load(open(place))["links"]} == {"self", "root"} and os.path.exists(tmp_path / "cat/items/unknown.json")
    assets = spark.createDataFrame([("p", 0.0, 0.0, 1.0, 1.0), ("q", 0.1, 0.1, 0.9, 0.9)], "path string, west double, south double, east double, north double")
    m = W.mosaic_json(assets)
    assert list(m["tiles"].values()) == [["p", "q"]] and m["bounds"] == [0.0, 0.0, 1.0, 1.0]
    with pytest.raises(RasterError):
        W.mosaic_json(assets.where("path = ''"))
    one = json.loads(W.stac_items(assets.selectExpr("path as raster_id", "path as href", "west", "south", "east", "north")).head()[0])
    assert one["assets"]["data"]["href"] == one["id"]


def test_sorted_sink_and_partitions(spark, tmp_path):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("k"), (F.col("id") % 3).alias("g"))
    W.write_sorted(df, str(tmp_path / "s"), "k", 4)
    spans = spark.read.parquet(str(tmp_path / "s")).groupBy(F.input_file_name().alias("f")).agg(F.min("k").alias("a"), F.max("k").alias("b")).orderBy("a").collect()
    assert all(x["b"] < y["a"] for x, y in zip(spans, spans[1:]))
    W.write_partitioned(df, str(tmp_path / "p"), ["g"])
    assert spark.read.parquet(str(tmp_path / "p")).where("g = 1").count() == 333
    W.compact(spark, str(tmp_path / "s"), str(tmp_path / "c"), "k", 1)
    assert spark.read.parquet(str(tmp_path / "c")).count() == 1000


def test_storage(spark, tmp_path):
    s = Storage(tmp_path / "root")
    src = tmp_path / "a.csv"
    src.write_text("id,value\n1,hello\n")
    one = s.ingest(src, "vector")
    two = s.promote(one, Tier.GOLD)
    assert s.files(Tier.BRONZE) == [one] and s.tier_of(two) is Tier.GOLD
    assert s.promote(two, Tier.SILVER).exists()
    with pytest.raises(StorageError):
        s.promote(one, Tier.BRONZE)
    with pytest.raises(StorageError):
        s.ingest(tmp_path / "none")
    rec = s.register(two)
    assert rec.sha256 == s.file_hash(one) and rec.size == src.stat().st_size
    assert {r["sha256"] for r in file_records(spark, str(tmp_path / "root")).collect()} == {rec.sha256}


def test_config(monkeypatch):
    assert Settings().srid == 4326 and BatchConfig().zone_chunk_size == 5000
    for bad in (lambda: BatchConfig(zone_chunk_size=5), lambda: TilingConfig(tile_size=256, overlap=256), lambda: CogConfig(blocksize=64), lambda: BatchConfig(max_workers=0), lambda: ThemeConfig(resolution=16)):
        with pytest.raises(ConfigError):
            bad()
    monkeypatch.setenv("CELLWEAVE_RESOLUTION", "7")
    assert ThemeConfig.from_env().resolution == 7
    monkeypatch.setenv("CELLWEAVE_BLOCKSIZE", "1024")
    monkeypatch.setenv("CELLWEAVE_QUALITY", "archive")
    cog = CogConfig.from_env()
    assert (cog.blocksize, cog.quality, cog.overview_level, cog.max_memory_mb) == (1024, Quality.ARCHIVE, 6, 4096)
    assert (TilingConfig().tile_size, TilingConfig().overlap, TilingConfig().output_format, BatchConfig().chunk_size) == (1024, 0, "tif", 1)
    assert BatchConfig().max_workers >= 1 and [q.value for q in Quality] == ["visualization", "analysis", "archive"]
    home = Path.home() / "geodata"
    assert [Settings().base_dir, Settings().bronze_dir, Settings().silver_dir, Settings().gold_dir] == [home, home / "bronze", home / "silver", home / "gold"]
    assert Settings(base_dir="/x", gold_dir="/y").gold_dir == Path("/y") and Settings(base_dir="/x").silver_dir == Path("/x/silver") and Settings().log_level == "INFO"


def test_tiles_refuse_endless_overlap(spark):
    with pytest.raises(RasterError):
        tile_grid(spark.createDataFrame([("a", 10, 10)], "raster_id string, width int, height int"), 4, 4)
