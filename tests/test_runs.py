import json

import numpy as np
from pyspark.sql import functions as F

from cellweave.config import RunConfig
from cellweave.functions import geometry as G
from cellweave.operators import graph
from cellweave.operators.aggregate import place_counts
from cellweave.plans.runner import Manifest, parallel_map, pending, run_items, run_table, stale
from cellweave.streaming.ingest import ingest, totals


def test_run_resumes_and_survives_failures(tmp_path):
    m, seen = Manifest(str(tmp_path / "m.json")), []

    def work(x):
        seen.append(x)
        if x == 2:
            raise ValueError("two")
        return {"rows": x}

    s = run_items("t", [1, 2, 3, 4], work, manifest=m, exists=lambda x: x == 4, sums=["rows"])
    assert (s.succeeded, s.failed, s.skipped, s.totals["rows"]) == (2, 1, 1, 4.0) and "2" in s.errors
    assert json.load(open(tmp_path / "m.json")) == ["1", "3", "4"]
    again = run_items("t", [1, 2, 3, 4], work, manifest=Manifest(str(tmp_path / "m.json")))
    assert again.skipped == 3 and seen == [1, 2, 3, 2]
    dry = run_items("t", [9], work, manifest=m, config=RunConfig(dry_run=True))
    assert dry.skipped == 1 and not m.is_done("9")


def test_manifest_tables(spark, tmp_path):
    items = spark.range(6).withColumnRenamed("id", "key")
    out, manifest = str(tmp_path / "out"), str(tmp_path / "manifest")
    double = lambda df: df.withColumn("v", F.col("key") * 2)
    assert run_table(spark, items.where("key < 4"), "job", out, double, "key", manifest) == 4
    assert run_table(spark, items, "job", out, double, "key", manifest) == 2
    assert spark.read.parquet(out).agg(F.sum("v")).head()[0] == 30
    assert pending(items, items.where("key > 0"), "key").count() == 1
    outputs = spark.createDataFrame([("a", 1), ("b", 2)], "source string, version int")
    assert [r["source"] for r in stale(outputs, spark.createDataFrame([("a", 2), ("b", 2)], "source string, version int")).collect()] == ["a"]


def test_parallel_map_keeps_order(spark):
    assert parallel_map(spark, lambda x: x * x, list(range(20))) == [x * x for x in range(20)]
    assert parallel_map(spark, str, []) == []


def test_graph(spark):
    edges = spark.createDataFrame([(1, 2, 1.0), (2, 3, 1.0), (1, 3, 5.0), (3, 4, 1.0), (7, 8, 1.0)], "src long, dst long, cost double")
    start = spark.createDataFrame([(1,)], "node long")
    assert {r["node"]: r["cost"] for r in graph.distances(edges, start).collect()} == {1: 0.0, 2: 1.0, 3: 2.0, 4: 3.0}
    assert {r["node"] for r in graph.reachable(edges, start, 2.0).collect()} == {1, 2, 3}
    assert graph.shortest_path(edges, 1, 4) == [1, 2, 3, 4] and graph.shortest_path(edges, 1, 8) == []
    assert {r["node"]: r["label"] for r in graph.components(edges).collect()} == {1: 1, 2: 1, 3: 1, 4: 1, 7: 7, 8: 7}
    scores = {r["node"]: r["score"] for r in graph.betweenness(edges).collect()}
    assert scores == {1: 0.0, 2: 0.0, 3: 2.0, 4: 0.0, 7: 0.0, 8: 0.0}


def test_crossings(spark):
    line = G.encode(("LineString", np.array([[1.0, 1.0], [12.0, 1.0]])))
    df = spark.createDataFrame([(1, bytearray(line))], "id long, geom_wkb binary")
    out = graph.line_crossings(df, 1).orderBy("position").collect()
    assert len(out) == 2 and out[0]["cell_b"] == out[1]["cell_a"]


def test_stream_equals_batch(spark, tmp_path):
    src = str(tmp_path / "in")
    rows = spark.range(300).select((F.col("id") % 7).alias("cell"))
    for k in range(3):
        rows.where(F.col("cell") % 3 == k).write.mode("append").parquet(src)
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(src)
    ingest(stream, place_counts, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    want = {r["cell"]: r["poi_count"] for r in place_counts(rows).collect()}
    assert {r["cell"]: r["poi_count"] for r in totals(spark, str(tmp_path / "out")).collect()} == want
