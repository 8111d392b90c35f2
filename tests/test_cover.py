import io
import json

from pyspark.sql import functions as F

from cellweave.functions import geometry as G
from cellweave.operators import cover
from cellweave.plans.catalog import grid_cells
from cellweave.sources import http


def test_polygons_become_cells(spark):
    p = spark.createDataFrame([(1, "POLYGON ((0 0, 20 0, 20 20, 0 20, 0 0))"), (2, None)], "id long, wkt string").withColumn("geom_wkb", G.wkt_to_wkb("wkt")).drop("wkt")
    got = cover.polygon_to_cells(p, "id", 2, grid="box")
    want = grid_cells(spark, 2).where("lon > 0 and lon < 20 and lat > 0 and lat < 20").select("cell")
    assert sorted(r["cell"] for r in got.collect()) == sorted(r["cell"] for r in want.collect())
    assert cover.cells_on(grid_cells(spark, 2), p, 2, grid="box").count() == want.count() > 0
    out = cover.with_boundaries(cover.with_centroids(got, 2, grid="box"), 2, grid="box").withColumn("c", G.centroid("geom_wkb"))
    assert out.where((F.abs(F.col("c.x") - F.col("lon")) > 1e-9) | (F.abs(F.col("c.y") - F.col("lat")) > 1e-9)).isEmpty()


class _Answer(io.BytesIO):
    def __init__(self, body, status=200, headers=None):
        super().__init__(body)
        self.status, self.headers = status, headers or {}


def test_search_follows_pages_and_fetch_uses_ranges():
    pages = {"u/search": {"features": [{"id": 1}, {"id": 2}], "links": [{"rel": "next", "href": "u/2"}]}, "u/2": {"features": [{"id": 3}], "links": []}}
    opener = lambda request, timeout: _Answer(json.dumps(pages[request.full_url]).encode())
    pages = {f"http://{k}": v for k, v in pages.items()}
    pages["http://u/search"]["links"][0]["href"] = "http://u/2"
    assert [f["id"] for f in http.search("http://u/", {}, opener=opener)] == [1, 2, 3]
    assert [f["id"] for f in http.search("http://u", {}, 2, opener=opener)] == [1, 2]
    asked = []

    def ranged(request, timeout):
        asked.append(request.get_header("Range"))
        if request.get_header("Range") == "bytes=0-0":
            return _Answer(b"a", 206, {"Content-Range": "bytes 0-0/3"})
        return _Answer(b"abc", 206)

    assert http.fetch("http://u", opener=ranged) == b"abc" and asked == ["bytes=0-0", "bytes=0-2"]
