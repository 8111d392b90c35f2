import pytest
from hypothesis import example, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cellweave.errors import CellError
from cellweave.functions import cells as C
from cellweave.operators.aggregate import building_metrics, conservation, merge_fragments, merge_themes, pivot_layers, place_counts
from cellweave.operators.rollup import rollup
from cellweave.plans.catalog import grid_cells, tiles


def test_bits_of_a_known_id(spark):
    row = spark.range(1).select(C.cell_from_hex(F.lit("8a2a1072b59ffff")).alias("c")).select(
        C.cell_resolution(F.col("c")).alias("r"), C.cell_hex(C.cell_parent(F.col("c"), 4)).alias("p4"), C.cell_hex(C.cell_parent(F.col("c"), 3)).alias("p3"), C.cell_hex(F.col("c")).alias("h")
    ).head()
    assert tuple(row) == (10, "842a107ffffffff", "832a10fffffffff", "8a2a1072b59ffff")


@settings(max_examples=8, deadline=None)
@example([(0.0, 179.99999999999997), (36.0, 0.0), (90.0, 180.0)])
@given(st.lists(st.tuples(st.floats(-90, 90), st.floats(-180, 180)), min_size=1, max_size=30))
def test_locate_is_consistent_with_parents_and_boxes(spark, where):
    df = spark.createDataFrame(where, "lat double, lon double")
    lat, lon = F.col("lat"), F.col("lon")
    out = df.select("lat", "lon", C.cell_at(lat, lon, 5).alias("c5"), C.cell_at(lat, lon, 3).alias("c3")).withColumn("b", C.cell_box(F.col("c5"), 5))
    for r in out.withColumn("p", C.cell_parent(F.col("c5"), 3)).collect():
        assert r["p"] == r["c3"]
        assert r["b"]["south"] - 1e-9 <= r["lat"] <= r["b"]["north"] + 1e-9
        x = r["lon"] if r["lon"] < 180 else -180
        assert r["b"]["west"] - 1e-9 <= x <= r["b"]["east"] + 1e-9


def test_cells_nest_on_a_grid_with_edges(spark):
    grid = spark.range(4860).select((F.col("id") % 54 * 3.0 - 81.0).alias("lat"), (F.floor(F.col("id") / 54) * 4.0 - 180.0).alias("lon"))
    lat, lon = F.col("lat"), F.col("lon")
    cells = grid.select(*[C.cell_at(lat, lon, r).alias(f"c{r}") for r in range(8)])
    bad = [(C.cell_parent(F.col(f"c{r}"), s) != F.col(f"c{s}")) for r in range(8) for s in range(r)]
    assert cells.agg(*[F.count_if(b) for b in bad]).head() == (0,) * len(bad)


def test_parents_compose_and_children_return(spark):
    df = spark.range(0, 200000, 997).select(C.cell_from_key(F.col("id")).alias("c"))
    two = C.cell_parent(C.cell_parent(F.col("c"), 4), 3)
    assert df.where(two != C.cell_parent(F.col("c"), 3)).isEmpty()
    kids = df.select("c", F.explode(C.cell_children(F.col("c"), 6)).alias("k"))
    assert kids.where(C.cell_parent(F.col("k"), 5) != F.col("c")).isEmpty()
    assert kids.select("k").distinct().count() == 7 * df.distinct().count()


def test_center_is_in_its_cell(spark):
    g = grid_cells(spark, 2)
    c = C.cell_center(F.col("cell"), 2)
    assert g.where(C.cell_at(c["lat"], c["lon"], 2) != F.col("cell")).isEmpty()
    assert g.select("cell").distinct().count() == g.count() > 0


def test_nulls_and_bad_input(spark):
    df = spark.createDataFrame([(None, 1.0), (float("nan"), 1.0), (95.0, 1.0)], "lat double, lon double")
    assert {r[0] for r in df.select(C.cell_at(F.col("lat"), F.col("lon"), 3)).collect()} == {None}
    with pytest.raises(CellError):
        C.cell_parent(F.lit(1), 16)


def test_tiles_cover_the_globe_once(spark):
    assert tiles(spark).count() == 1944
    assert tiles(spark).where("key = '+0005.0_+045.0'").count() == 1


def test_rollup_rules(spark):
    cells = spark.range(50).select(C.cell_from_key(F.col("id")).alias("cell"), F.col("id").cast("double").alias("a"), F.lit(0.0).alias("z"))
    with pytest.raises(CellError):
        rollup(cells, 4, {"a": "total"})
    with pytest.raises(CellError):
        rollup(cells, 4, {"a": "mean", "z": "sum"}, {"r": ("a", "z", 1.0)})
    out = rollup(cells, 4, {"a": "sum", "z": "sum", "missing": "sum"}, {"r": ("a", "z", 1.0), "s": ("z", "a", 1.0)})
    assert out.agg(F.sum("a")).head()[0] == sum(range(50))
    assert out.where("r is not null").isEmpty()
    assert out.columns == ["cell", "a", "z", "r", "s"]
    assert rollup(cells.where("a < 0"), 4, {"a": "sum"}).isEmpty()
    assert rollup(cells.withColumn("cell", F.lit(None).cast("long")), 4, {"a": "sum"}).isEmpty()


def test_heights_stay_null_and_derive_again(spark):
    b = spark.createDataFrame([(1, "residential", 10.0, None), (1, "other", 5.0, 4.0), (2, "other", 5.0, None), (None, "other", 1.0, 1.0)], "cell long, subtype string, area_m2 double, height double")
    parts = [building_metrics(b), building_metrics(b)]
    m = building_metrics(b).orderBy("cell").collect()
    assert [(r["cell"], r["height_sum_m"], r["avg_height_m"], r["height_count"]) for r in m] == [(1, 4.0, 4.0, 1), (2, None, None, 0)]
    merged = merge_themes([merge_fragments(parts), place_counts(spark.createDataFrame([(3,)], "cell long"))]).orderBy("cell").collect()
    assert [(r["cell"], r["building_count"], r["height_sum_m"], r["avg_height_m"], r["poi_count"]) for r in merged] == [(1, 4, 8.0, 4.0, 0), (2, 2, None, None, 0), (3, 0, None, None, 1)]


def test_layers_with_keys_that_the_first_lacks(spark):
    long = spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0), (2, "c", 3.0), (2, "c", float("nan"))], "cell long, layer string, value double")
    rows = {r["cell"]: (r["a"], r["b"], r["c"]) for r in pivot_layers(long, ["a", "b", "c"]).collect()}
    assert rows == {1: (1.0, 0.0, 0.0), 2: (0.0, 2.0, 3.0)}


def test_conservation(spark):
    l5 = spark.range(1000).select(C.cell_from_key(F.col("id")).alias("cell"), F.lit(2).alias("n"))
    out = conservation({"l5": l5, "l4": rollup(l5, 4, {"n": "sum"})}, ["n"], "l5").collect()
    assert {r["share"] for r in out} == {1.0}
