"""Queries over whole tables, against brute force and counts of the tables."""

import heapq
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from cellweave.operators.raster import tile_grid
from cellweave.plans import catalog


def order_parts(duck):
    return [(a, -1 - b, float(c)) for a, b, c in duck.execute("SELECT l_orderkey, l_partkey, l_quantity FROM lineitem").fetchall()]


def test_components_of_the_whole_table(spark, sf_dir, duck):
    up = {}

    def root(x):
        while up.setdefault(x, x) != x:
            up[x] = x = up[up[x]]
        return x

    for a, b, _ in order_parts(duck):
        a, b = sorted((root(a), root(b)))
        up[b] = a
    got = {r["node"]: r["label"] for r in catalog.QUERIES["graph_components_all"](spark, sf_dir).collect()}
    assert got == {x: root(x) for x in list(up)}
    assert len(got) == duck.execute("SELECT count(DISTINCT l_orderkey) + count(DISTINCT l_partkey) FROM lineitem").fetchone()[0]


def test_distances_over_the_whole_table(spark, sf_dir, duck):
    near = defaultdict(list)
    for a, b, c in order_parts(duck):
        near[a].append((b, c))
        near[b].append((a, c))
    best, heap = {}, [(0.0, 1)]
    while heap:
        d, x = heapq.heappop(heap)
        if x not in best:
            best[x] = d
            for y, c in near[x]:
                heapq.heappush(heap, (d + c, y))
    got = {r["node"]: r["cost"] for r in catalog.QUERIES["graph_distances_all"](spark, sf_dir).collect()}
    assert got == best and len(got) > 57


def test_rasters_as_a_whole(spark, sf_dir, duck):
    n, points = (duck.execute(f"SELECT count(*) FROM {t}").fetchone()[0] for t in ("embeddings", "events"))
    run = lambda name: catalog.QUERIES[name](spark, sf_dir).collect()
    sampled = run("point_sample_all")
    assert len(sampled) == points and {r["raster_id"] for r in sampled} == set(range(min(n, points)))
    assert len({r["raster_id"] for r in run("grid_on_rasters_all")}) > 1
    assert len(run("is_categorical_all")) == n
    top = {}
    values = dict(duck.execute("SELECT vec_id, embedding FROM embeddings").fetchall())
    for i in sorted(values, key=lambda i: i // 3 % 2):
        for pos in range(64):
            if (i + pos) % 17:
                top[i % 3 + 1, i // 300 * 8 + pos // 8, i // 3 % 100 * 4 + pos % 8] = float(round(values[i][pos] * 100, 0))
    got = {(r["band"], r["row"], r["col"]): r["value"] for r in run("raster_mosaic_all")}
    assert got.keys() == top.keys() and all(abs(got[k] - top[k]) <= 1 for k in got) and len(got) > 4 * 64


def test_tiles_of_a_large_raster_are_dealt_over_tasks(spark):
    sides = {1: (100_000, 110_000), 2: (1_000_000, 95), 3: (95, 1_000_000), 4: (90, 1), 5: (91, 90), 6: (0, 50), 7: (50, -1), 8: (None, 50)}
    one_task = spark.createDataFrame([(i, w, h) for i, (w, h) in sides.items()], "raster_id long, width long, height long").coalesce(1)
    tiles = tile_grid(one_task, 100, 10)
    share = [r["count"] for r in tiles.groupBy(F.spark_partition_id()).count().collect()]
    assert len(share) > 1 and max(share) < 0.7 * sum(share)
    big = tiles.where("raster_id = 1").agg(F.count("*"), F.sum("row_off"), F.sum("col_off"), F.sum("tile_width"), F.sum("tile_height")).first()
    xs, ys = range(0, 100_000, 90), range(0, 110_000, 90)
    cut = [sum(min(100, end - o) for o in offsets) for end, offsets in ((100_000, xs), (110_000, ys))]
    assert tuple(big) == (len(xs) * len(ys), sum(ys) * len(xs), sum(xs) * len(ys), cut[0] * len(ys), cut[1] * len(xs))
    expect = {
        (i, f"tile_r{y // 90}_c{x // 90}", y, x, min(100, w - x), min(100, h - y))
        for i, (w, h) in sides.items() if i in (2, 3, 4, 5) for y in range(0, h, 90) for x in range(0, w, 90)
    }
    got = [tuple(r) for r in tiles.where("raster_id > 1").collect()]
    assert len(got) == len(expect) and set(got) == expect


def test_tiles_of_many_rasters_take_little_room(spark, tmp_path):
    sides = spark.range(500).select(F.col("id").alias("raster_id"), (F.col("id") + 4000).alias("width"), (F.col("id") + 3000).alias("height"))
    tile_grid(sides, 100, 10).coalesce(2).write.parquet(out := str(tmp_path / "tiles"))
    rows = sum(-(-(i + 4000) // 90) * -(-(i + 3000) // 90) for i in range(500))
    assert spark.read.parquet(out).count() == rows
    assert sum(p.stat().st_size for p in (tmp_path / "tiles").glob("*.parquet")) < 0.6 * rows


def test_tiles_of_repeated_and_nameless_rasters(spark):
    sides = [("a", 200, 95)] * 3 + [(None, 95, 200)] * 2 + [(None, 200, 95), ("b", 90, 91), ("c", 1, 1), ("d", 5000, 1), ("a", 181, 90)] + [(f"e{i}", 180 + i, 400) for i in range(600)]
    expect = Counter((i, f"tile_r{y // 90}_c{x // 90}", y, x, min(100, w - x), min(100, h - y)) for i, w, h in sides for y in range(0, h, 90) for x in range(0, w, 90))
    assert Counter(tuple(r) for r in tile_grid(spark.createDataFrame(sides, "raster_id string, width int, height int"), 100, 10).collect()) == expect
