"""Registered queries, each beside the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellweave.functions import cells as C
from cellweave.operators import aggregate as A
from cellweave.operators import raster as R
from cellweave.operators import select as S
from cellweave.operators import spatial_join as J
from cellweave.operators.rollup import rollup
from cellweave.plans import fixtures as X
from cellweave.session import cut

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        key = name or f.__name__
        QUERIES[key] = f
        if sql:
            ORACLES[key] = sql
        return f

    return add


def _r(df: DataFrame, digits: int, *names: str) -> DataFrame:
    return df.withColumns({n: F.round(n, digits) for n in names})


# --- predicates, tiles, cells ---------------------------------------------------------------

WINDOW = (-30.0, -10.0, 40.0, 35.0)


@query(f"SELECT event_id, lon, lat FROM ({X.POINTS}) WHERE lon - 0.5 <= 40 AND lon + 0.5 >= -30 AND lat - 0.5 <= 35 AND lat + 0.5 >= -10 AND lon >= -30 AND lon < 40 AND lat >= -10 AND lat < 35")
def bbox_prune_centroid_tile(spark, sf):
    p = X.points(spark, sf)
    boxed = p.withColumn("bbox", F.struct((F.col("lon") - 0.5).alias("xmin"), (F.col("lon") + 0.5).alias("xmax"), (F.col("lat") - 0.5).alias("ymin"), (F.col("lat") + 0.5).alias("ymax")))
    return S.in_window(boxed, "bbox", "lon", "lat", *WINDOW).select("event_id", "lon", "lat")


def tiles(spark: SparkSession, degrees: float = 5.0, west: float = -180.0, south: float = -60.0, east: float = 180.0, north: float = 75.0) -> DataFrame:
    """Work tiles, longitude first, with signed keys."""
    across, up = round((east - west) / degrees), round((north - south) / degrees)
    lon, lat = F.floor(F.col("id") / up) * degrees + west, (F.col("id") % up) * degrees + south
    return spark.range(across * up).select(
        F.format_string("%+07.1f_%+06.1f", lon, lat).alias("key"), lon.alias("west"), lat.alias("south"), (lon + degrees).alias("east"), (lat + degrees).alias("north")
    )


_TILES = "SELECT printf('%+07.1f_%+06.1f', (i // 27) * 5.0::DOUBLE - 180, (i % 27) * 5.0::DOUBLE - 60) AS key, (i // 27) * 5.0::DOUBLE - 180 AS west, (i % 27) * 5.0::DOUBLE - 60 AS south, (i // 27) * 5.0::DOUBLE - 175 AS east, (i % 27) * 5.0::DOUBLE - 55 AS north FROM range(1944) r(i)"


@query(_TILES)
def tile_grid(spark, sf):
    return tiles(spark)


@query(f"SELECT key, count(*)::BIGINT AS n FROM ({X.POINTS}) p JOIN ({_TILES}) t ON lon >= west AND lon < east AND lat >= south AND lat < north GROUP BY key")
def tile_assignment_once(spark, sf):
    return J.rectangles_join(X.points(spark, sf), tiles(spark), "lon", "lat", ["key"], size=5.0).groupBy("key").agg(F.count("*").alias("n"))


_CUST = f"SELECT c_custkey, {X.cell_sql('c_custkey')} AS cell FROM customer"


def _customers(spark, sf):
    return X.table(spark, sf, "customer").select("c_custkey", C.cell_from_key(F.col("c_custkey")).alias("cell"))


@query(f"SELECT c_custkey, {X.parent_sql('cell', 4)} AS l4, {X.parent_sql('cell', 3)} AS l3 FROM ({_CUST})")
def cell_parent(spark, sf):
    return _customers(spark, sf).select("c_custkey", C.cell_parent(F.col("cell"), 4).alias("l4"), C.cell_parent(F.col("cell"), 3).alias("l3"))


@query(f"SELECT c_custkey, ((cell >> 52) & 15)::INT AS res FROM ({_CUST})")
def cell_resolution(spark, sf):
    return _customers(spark, sf).select("c_custkey", C.cell_resolution(F.col("cell")).alias("res"))


@query(f"SELECT c_custkey, lower(to_hex(cell)) AS hex, cell FROM ({_CUST})")
def cell_hex(spark, sf):
    hexed = _customers(spark, sf).select("c_custkey", C.cell_hex(F.col("cell")).alias("hex"))
    return hexed.select("c_custkey", "hex", C.cell_from_hex(F.col("hex")).alias("cell"))


@query(f"SELECT DISTINCT cell, (((cell & {~(15 << 52) & ~(7 << 27)}) | {6 << 52} | (d << 27)))::BIGINT AS child FROM ({_CUST}), range(7) r(d)")
def cell_children(spark, sf):
    return _customers(spark, sf).select("cell", F.explode(C.cell_children(F.col("cell"), 6)).alias("child")).distinct()


_AT2 = (
    f"SELECT event_id, ({(1 << 59) + (2 << 52) + (1 << 39) - 1} + ((row // 7) * 12 + col // 7) * {1 << 45} + (col % 7) * {1 << 42} + (row % 7) * {1 << 39})::BIGINT AS cell, lon, lat, class, value "
    # columns and rows of the finest level, divided: a position's cells nest at every level
    "FROM (SELECT *, (floor((lon + 180) / 30.0::DOUBLE * 5764801.0::DOUBLE)::BIGINT % 69177612) // 823543 AS col, least(greatest(floor((lat + 90) / 18.0::DOUBLE * 823543.0::DOUBLE)::BIGINT, 0), 8235429) // 117649 AS row "
    f"FROM ({X.POINTS}))"
)


def _located(spark, sf):
    return X.points(spark, sf).withColumn("cell", C.cell_at(F.col("lat"), F.col("lon"), 2))


@query(f"SELECT event_id, cell FROM ({_AT2})")
def cell_locate(spark, sf):
    return _located(spark, sf).select("event_id", "cell")


@query(f"SELECT count(*)::BIGINT AS n, (count(*) FILTER (WHERE lon IS NOT NULL))::BIGINT AS inside FROM ({_AT2})")
def cell_box_contains(spark, sf):
    p = _located(spark, sf).withColumn("b", C.cell_box(F.col("cell"), 2))
    tol = 1e-9
    inside = (F.col("lon") >= F.col("b.west") - tol) & (F.col("lon") < F.col("b.east") + tol) & (F.col("lat") >= F.col("b.south") - tol) & (F.col("lat") < F.col("b.north") + tol)
    return p.agg(F.count("*").alias("n"), F.count_if(inside).alias("inside"))


@query(
    "SELECT (576460752303423488 + 4503599627370496 * 1 + 4398046511103 + ((r // 1) * 12 + c // 7) * 35184372088832 + (c % 7) * 4398046511104)::BIGINT AS cell "
    f"FROM range(84) a(c), range(10) b(r) WHERE (r + 0.5) * 18 - 90 BETWEEN -60 AND 75"
)
def generate_grid(spark, sf):
    return grid_cells(spark, 1).select("cell")


def grid_cells(spark: SparkSession, res: int, west: float = -180.0, south: float = -60.0, east: float = 180.0, north: float = 75.0) -> DataFrame:
    """All cells whose centre lies within bounds: ``cell, h3_index, lat, lon, resolution, wkt``."""
    across, up = C._splits(res)
    n, m = C.BASE_COLUMNS * across, C.BASE_ROWS * up
    lon = (F.col("id") % n + 0.5) * (C.BASE_WIDTH / across) - 180.0
    lat = (F.floor(F.col("id") / n) + 0.5) * (C.BASE_HEIGHT / up) - 90.0
    rows = spark.range(n * m).select(lon.alias("lon"), lat.alias("lat")).where(F.col("lon").between(west, east) & F.col("lat").between(south, north))
    rows = rows.withColumn("cell", C.cell_at(F.col("lat"), F.col("lon"), res))
    return rows.select("cell", C.cell_hex(F.col("cell")).alias("h3_index"), "lat", "lon", F.lit(res).alias("resolution"), C.cell_boundary_wkt(F.col("cell"), res).alias("wkt"))


@query("SELECT o_orderkey AS order_key_id, o_orderstatus AS o_orderstatus, o_totalprice AS total_price_usd, o_orderpriority AS a_b FROM orders")
def clean_columns(spark, sf):
    o = X.table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
    return S.clean_columns(o.toDF("Order Key-Id", "O_ORDERSTATUS", "Total.Price (USD)", "a b"))


@query("SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice <= 200000 AND (o_orderstatus IN ('F', 'O')) AND NOT (o_custkey > 1000) AND o_orderpriority LIKE '%I%'")
def cql2_filter(spark, sf):
    tree = {"op": "and", "args": [
        {"op": "<=", "args": [{"property": "o_totalprice"}, 200000]}, {"op": "in", "args": [{"property": "o_orderstatus"}, ["F", "O"]]},
        {"op": "not", "args": [{"op": ">", "args": [{"property": "o_custkey"}, 1000]}]}, {"op": "like", "args": [{"property": "o_orderpriority"}, "%I%"]},
    ]}
    return X.table(spark, sf, "orders").where(S.cql2(tree)).select("o_orderkey", "o_totalprice")


@query(f"SELECT DISTINCT lower(to_hex(cell)) AS hex FROM ({_CUST}) WHERE starts_with(lower(to_hex(cell)), '8500')")
def key_prefix(spark, sf):
    return _customers(spark, sf).select(C.cell_hex(F.col("cell")).alias("hex")).where(S.key_prefix("hex", "8500")).distinct()


@query("SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE coalesce(l_discount, 0) + coalesce(l_tax, 0) > 0")
def rows_with_data(spark, sf):
    return S.rows_with_data(X.table(spark, sf, "lineitem"), ["l_discount", "l_tax"]).select("l_orderkey", "l_linenumber", "l_quantity")


@query("SELECT event_id, CASE WHEN event_id % 7 <> 0 THEN value END AS value FROM events")
def null_nan(spark, sf):
    e = X.table(spark, sf, "events").select("event_id", F.when(F.col("event_id") % 7 == 0, F.lit(float("nan"))).otherwise(F.col("value")).alias("value"))
    return S.null_nan(e)


# --- themes ---------------------------------------------------------------------------------

_CLASS_SUMS = ", ".join(f"round(coalesce(sum(CASE WHEN subtype = 'road' AND class = '{c}' THEN length_m ELSE 0 END), 0), 4) AS {c}_length_m" for c in A.ROAD_CLASSES)
_TRANSPORT = (
    f"SELECT cell, {_CLASS_SUMS}, round(coalesce(sum(CASE WHEN subtype = 'rail' THEN length_m ELSE 0 END), 0), 4) AS rail_length_m, "
    "(count(*) FILTER (WHERE subtype = 'road'))::BIGINT AS road_segment_count, round(coalesce(sum(length_m) FILTER (WHERE subtype = 'road'), 0), 4) AS total_road_length_m "
    f"FROM ({X.SEGMENTS}) WHERE cell IS NOT NULL GROUP BY cell"
)
_LENGTHS = [m for m in A.TRANSPORT_METRICS if m.endswith("_m")]


@query(_TRANSPORT)
def theme_transport(spark, sf):
    return _r(A.road_metrics(X.segments(spark, sf)), 4, *_LENGTHS)


_BUILDINGS = (
    "SELECT cell, count(*)::BIGINT AS building_count, round(sum(area_m2), 3) AS total_building_area_m2, "
    + ", ".join(f"(count(*) FILTER (WHERE subtype = '{k}'))::BIGINT AS {k}_count" for k in A.BUILDING_KINDS)
    + ", count(height)::BIGINT AS height_count, round(sum(height), 6) AS height_sum_m, round(CASE WHEN count(height) > 0 THEN sum(height) / count(height) END, 9) AS avg_height_m "
    f"FROM ({X.BUILDINGS}) GROUP BY cell"
)


@query(_BUILDINGS)
def theme_buildings(spark, sf):
    return _r(_r(_r(A.building_metrics(X.buildings(spark, sf)), 3, "total_building_area_m2"), 6, "height_sum_m"), 9, "avg_height_m")


@query(f"SELECT cell, count(*)::BIGINT AS poi_count FROM ({X.PLACES}) GROUP BY cell")
def theme_places(spark, sf):
    return A.place_counts(X.places(spark, sf))


@query(
    f"WITH t AS ({_TRANSPORT}), b AS ({_BUILDINGS}), p AS (SELECT cell, count(*)::BIGINT AS poi_count FROM ({X.PLACES}) GROUP BY cell) "
    "SELECT cell, coalesce(total_road_length_m, 0) AS total_road_length_m, coalesce(road_segment_count, 0) AS road_segment_count, coalesce(building_count, 0) AS building_count, "
    "coalesce(height_count, 0) AS height_count, height_sum_m, avg_height_m, coalesce(poi_count, 0) AS poi_count FROM t FULL JOIN b USING (cell) FULL JOIN p USING (cell)"
)
def theme_merge_outer(spark, sf):
    out = A.merge_themes([A.road_metrics(X.segments(spark, sf)), A.building_metrics(X.buildings(spark, sf)), A.place_counts(X.places(spark, sf))])
    out = out.select("cell", "total_road_length_m", "road_segment_count", "building_count", "height_count", "height_sum_m", "avg_height_m", "poi_count")
    return _r(_r(_r(out, 4, "total_road_length_m"), 6, "height_sum_m"), 9, "avg_height_m")


# --- rollup ---------------------------------------------------------------------------------

_P4 = X.parent_sql("cell", 4)


@query(
    f"SELECT {_P4} AS cell, round(sum(height), 6) AS height, round(avg(area_m2), 4) AS area_m2, count(o_orderkey)::BIGINT AS o_orderkey, min(k_min) AS k_min, max(k_max) AS k_max, median(k_med)::DOUBLE AS k_med "
    f"FROM (SELECT *, o_orderkey AS k_min, o_orderkey AS k_max, o_orderkey AS k_med FROM ({X.BUILDINGS})) GROUP BY 1"
)
def rollup_all_aggs(spark, sf):
    k = F.col("o_orderkey")
    b = X.buildings(spark, sf).withColumns({"k_min": k, "k_max": k, "k_med": k})
    out = rollup(b, 4, {"height": "sum", "area_m2": "mean", "o_orderkey": "count", "k_min": "min", "k_max": "max", "k_med": "median"})
    return _r(_r(out, 6, "height"), 4, "area_m2")


@query(
    f"SELECT {_P4} AS cell, round(sum(height), 6) AS height, sum(n)::BIGINT AS n, CASE WHEN sum(n) > 0 THEN round(sum(height)::DECIMAL(38,6)::DOUBLE / sum(n) * 100.0, 2) END AS per_n "
    f"FROM (SELECT *, CASE WHEN height IS NULL THEN 0 ELSE 1 END AS n FROM ({X.BUILDINGS})) GROUP BY 1"
)
def rollup_derive(spark, sf):
    b = X.buildings(spark, sf).withColumn("n", F.col("height").isNotNull().cast("int"))
    exact = b.withColumn("height", F.col("height").cast("decimal(20,6)"))
    out = rollup(exact, 4, {"height": "sum", "n": "sum"}, {"per_n": ("height", "n", 100.0)})
    return out.withColumns({"height": F.round(F.col("height").cast("double"), 6), "per_n": F.col("per_n").cast("double")})


_MODE = "SELECT cell, class, count(*) AS k FROM (SELECT {p} AS cell, class FROM ({s})) GROUP BY ALL"


@query(f"SELECT cell, min(class) AS class FROM (SELECT *, max(k) OVER (PARTITION BY cell) AS top FROM ({_MODE.format(p=_P4, s=X.SEGMENTS)})) WHERE k = top GROUP BY cell")
def rollup_mode_tiebreak(spark, sf):
    return rollup(X.segments(spark, sf), 4, {"class": "mode"})


@query(f"SELECT {_P4} AS cell, arg_min(n, cell) AS first_n, arg_max(m, cell) AS last_m FROM (SELECT cell, count(*)::BIGINT AS n, max(o_orderkey) AS m FROM ({X.BUILDINGS}) GROUP BY cell) GROUP BY 1")
def rollup_first_last(spark, sf):
    one = X.buildings(spark, sf).groupBy("cell").agg(F.count("*").alias("first_n"), F.max("o_orderkey").alias("last_m"))
    return rollup(one, 4, {"first_n": "first", "last_m": "last"})


_YIELD = "SELECT l_partkey, sum(l_extendedprice)::DECIMAL(38,2)::DOUBLE AS prod, sum(l_quantity) FILTER (WHERE l_returnflag = 'A') AS area FROM lineitem GROUP BY l_partkey"


@query(f"SELECT l_partkey, round(CASE WHEN area > 0 THEN prod / area * 1000 END, 4) AS yield FROM ({_YIELD})")
def derive_yield(spark, sf):
    rows = X.table(spark, sf, "lineitem").groupBy("l_partkey").agg(
        F.sum(F.col("l_extendedprice").cast("decimal(20,2)")).cast("double").alias("prod"), F.sum(F.when(F.col("l_returnflag") == "A", F.col("l_quantity"))).alias("area")
    )
    return _r(A.derive_yield(rows, "prod", "area", "yield").select("l_partkey", "yield"), 4, "yield")


@query(f"SELECT cell, " + ", ".join(f"round(coalesce(sum(length_m) FILTER (WHERE l_returnflag = '{f}'), 0), 4) AS {f}" for f in "ANR") + f" FROM ({X.SEGMENTS}) GROUP BY cell")
def extensive_merge_pivot(spark, sf):
    long = X.segments(spark, sf).select("cell", F.col("l_returnflag").alias("layer"), F.col("length_m").alias("value"))
    return _r(A.pivot_layers(long, ["A", "N", "R"]), 4, "A", "N", "R")


# --- roads ----------------------------------------------------------------------------------


@query(f"SELECT l_orderkey, l_linenumber, class, length_m, lower(to_hex(cell)) AS h3_l5, lower(to_hex({_P4})) AS h3_l4 FROM ({X.SEGMENTS}) WHERE subtype = 'road' AND class IN ({', '.join(repr(c) for c in A.ROAD_CLASSES)})")
def extract_segments(spark, sf):
    rows = X.segments(spark, sf).where((F.col("subtype") == "road") & S.class_filter("class", A.ROAD_CLASSES))
    cell = F.col("cell")
    return rows.select("l_orderkey", "l_linenumber", "class", "length_m", C.cell_hex(cell).alias("h3_l5"), C.cell_hex(C.cell_parent(cell, 4)).alias("h3_l4"))


_STATS = (
    "SELECT cell, " + ", ".join(f"round(coalesce(sum(CASE WHEN class = '{c}' THEN length_m ELSE 0 END), 0), 4) AS {c}_length_m" for c in A.ROAD_CLASSES)
    + ", count(*)::BIGINT AS road_segment_count, round(coalesce(sum(length_m), 0), 4) AS total_road_length_m "
)
_IN = f"class IN ({', '.join(repr(c) for c in A.ROAD_CLASSES)})"
_STAT_LENGTHS = [f"{c}_length_m" for c in A.ROAD_CLASSES] + ["total_road_length_m"]


@query(f"{_STATS} FROM ({X.SEGMENTS}) WHERE subtype = 'road' GROUP BY cell")
def road_stats_local(spark, sf):
    return _r(A.road_stats(X.segments(spark, sf).where("subtype = 'road'"), only_listed=False), 4, *_STAT_LENGTHS)


@query(f"{_STATS} FROM ({X.SEGMENTS}) WHERE subtype = 'road' AND {_IN} GROUP BY cell")
def road_stats_remote(spark, sf):
    return _r(A.road_stats(X.segments(spark, sf).where("subtype = 'road'")), 4, *_STAT_LENGTHS)


_L = f"(SELECT cell, count(*) AS n, max(length_m) AS x FROM ({X.SEGMENTS}) WHERE subtype = 'road' GROUP BY cell)"
_RT = f"(SELECT cell, count(*) AS n, max(length_m) AS x FROM ({X.SEGMENTS}) WHERE subtype = 'road' AND {_IN} AND l_partkey % 10 <> 0 GROUP BY cell)"


@query(
    "WITH j AS (SELECT l.cell AS lc, r.cell AS rc, l.n AS ln, r.n AS rn, l.x AS lx, r.x AS rx FROM " + _L + " l FULL JOIN " + _RT + " r ON l.cell = r.cell) "
    + " UNION ALL ".join(
        f"SELECT '{m}' AS metric, round(sum(l{c})::DECIMAL(38,4)::DOUBLE, 4) AS total_left, round(sum(r{c})::DECIMAL(38,4)::DOUBLE, 4) AS total_right, round(sum(l{c})::DECIMAL(38,4)::DOUBLE / sum(r{c})::DECIMAL(38,4)::DOUBLE, 8) AS ratio, "
        f"round((max(abs(l{c} - r{c})) FILTER (WHERE lc = rc))::DOUBLE, 4) AS max_diff, (SELECT count(*) FROM j WHERE lc = rc)::BIGINT AS both, (SELECT count(*) FROM j WHERE rc IS NULL)::BIGINT AS left_only, (SELECT count(*) FROM j WHERE lc IS NULL)::BIGINT AS right_only FROM j"
        for m, c in (("n", "n"), ("x", "x"))
    )
)
def road_compare(spark, sf):
    s = X.segments(spark, sf).where("subtype = 'road'")
    agg = lambda df: df.groupBy("cell").agg(F.count("*").alias("n"), F.max("length_m").alias("x"))
    out = A.compare(agg(s), agg(s.where(F.col("class").isin(*A.ROAD_CLASSES) & (F.col("l_partkey") % 10 != 0))), ["n", "x"])
    return _r(out.drop("mean_diff"), 4, "total_left", "total_right")


@query(f"SELECT {X.parent_sql('cell', 3)} AS h3_l3, count(*)::BIGINT AS n, min(cell) AS first_cell FROM ({X.SEGMENTS}) GROUP BY 1")
def merge_extracts(spark, sf):
    parts = [X.segments(spark, sf).where(F.col("l_returnflag") == f) for f in "ANR"]
    merged = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return merged.groupBy(C.cell_parent(F.col("cell"), 3).alias("h3_l3")).agg(F.count("*").alias("n"), F.min("cell").alias("first_cell"))


# --- rasters --------------------------------------------------------------------------------

_STAT_SQL = {"sum": "sum(v)", "mean": "avg(v)", "median": "median(v)", "min": "min(v)", "max": "max(v)", "std": "stddev_pop(v)", "count": "count(v)"}
_VALID = f"SELECT *, CASE WHEN abs(value + 9999) > 1e-8 + 1e-5 * 9999 THEN value END AS v FROM ({X.PIXELS})"


def _zonal(how: str) -> Query:
    def run(spark, sf):
        return _r(R.zonal(X.pixels(spark, sf), None, how, nodata=X.NODATA, by=["raster_id"]), 6, "value")

    return run


for _how, _sql in _STAT_SQL.items():
    query(f"SELECT raster_id, zone_id, CASE WHEN {_sql} = 0 THEN 0 ELSE round(({_sql})::DOUBLE, 6) END AS value, count(v)::BIGINT AS pixel_count, (count(*) - count(v))::BIGINT AS nodata_count FROM ({_VALID}) GROUP BY raster_id, zone_id", f"zonal_{_how}")(_zonal(_how))


@query(f"SELECT z AS zone_id, round(avg(v), 6) AS value, count(v)::BIGINT AS pixel_count, (count(value) - count(v))::BIGINT AS nodata_count FROM range(6) r(z) LEFT JOIN ({_VALID}) ON zone_id = z GROUP BY z")
def zonal_nodata(spark, sf):
    return _r(R.zonal(X.pixels(spark, sf), spark.range(6).withColumnRenamed("id", "zone_id"), "mean", nodata=X.NODATA), 6, "value")


@query(f"SELECT raster_id, zone_id, min(CASE WHEN v <> 0 THEN abs(v) END)::DOUBLE AS value, count(CASE WHEN v <> 0 THEN v END)::BIGINT AS pixel_count, (count(*) - count(v))::BIGINT AS nodata_count FROM ({_VALID}) GROUP BY raster_id, zone_id")
def zonal_exclude_zero(spark, sf):
    p = X.pixels(spark, sf).withColumn("value", F.when(R.is_nodata(F.col("value"), X.NODATA), F.col("value")).otherwise(F.abs("value")))
    return R.zonal(p, None, "min", nodata=X.NODATA, exclude_zero=True, by=["raster_id"])


@query(
    f"SELECT raster_id, band, coalesce(min(v), 0) AS min, coalesce(max(v), 0) AS max, round(coalesce(avg(v), 0), 6) AS mean, round(coalesce(stddev_pop(v), 0), 6) AS std, round(100.0::DOUBLE * (count(*) - count(v)) / count(*), 6) AS null_percent FROM ({_VALID}) GROUP BY raster_id, band"
)
def band_stats(spark, sf):
    return R.band_stats(X.pixels(spark, sf), X.NODATA, digits=6)


@query(f"SELECT raster_id, (count(DISTINCT value) FILTER (WHERE value <> -9999)) < 40 AS categorical FROM ({X.PIXELS}) WHERE row < 6 AND col < 6 GROUP BY raster_id")
def is_categorical(spark, sf):
    """The operator's window is the feature; here it is six by six pixels."""
    return R.is_categorical(X.pixels(spark, sf), window=6, most=40, nodata=X.NODATA)


@query(f"SELECT raster_id, (count(DISTINCT value) FILTER (WHERE value <> -9999)) < 50 AS categorical FROM ({X.PIXELS}) WHERE row < 1024 AND col < 1024 GROUP BY raster_id")
def is_categorical_all(spark, sf):
    return R.is_categorical(X.pixels(spark, sf), most=50, nodata=X.NODATA)


_META = "SELECT vec_id AS raster_id, CASE vec_id % 5 WHEN 0 THEN 'palette' WHEN 1 THEN 'rgb' ELSE 'gray' END AS color_interp, (vec_id % 4 + 1)::INT AS band_count, ['uint8','uint16','float32','int16','float64'][vec_id % 5 + 1] AS dtype, vec_id % 2 = 0 AS categorical, 100 + vec_id AS width, 200 + vec_id AS height FROM embeddings"


def _meta(spark, sf):
    k = F.col("vec_id")
    return X.table(spark, sf, "embeddings").select(
        k.alias("raster_id"), F.when(k % 5 == 0, "palette").when(k % 5 == 1, "rgb").otherwise("gray").alias("color_interp"), (k % 4 + 1).cast("int").alias("band_count"),
        F.element_at(F.array(*map(F.lit, ("uint8", "uint16", "float32", "int16", "float64"))), (k % 5 + 1).cast("int")).alias("dtype"), (k % 2 == 0).alias("categorical"), (k + 100).alias("width"), (k + 200).alias("height"),
    )


@query(
    f"SELECT raster_id, CASE WHEN color_interp = 'rgb' AND band_count = 4 THEN 'rgba' WHEN color_interp = 'rgb' AND band_count >= 3 THEN 'rgb' "
    "WHEN band_count = 1 AND dtype IN ('float32', 'float64') THEN 'dem' WHEN band_count = 1 AND dtype IN ('uint8', 'int8') AND categorical THEN 'categorical' "
    "WHEN band_count = 1 AND dtype = 'uint8' THEN 'panchromatic' WHEN band_count = 1 THEN 'dem' WHEN band_count = 3 THEN 'rgb' WHEN band_count = 4 THEN 'rgba' WHEN band_count > 4 THEN 'multispectral' ELSE 'unknown' END AS raster_type, "
    f"round(width * height * band_count * CASE dtype WHEN 'uint8' THEN 1 WHEN 'uint16' THEN 2 WHEN 'int16' THEN 2 WHEN 'float32' THEN 4 ELSE 8 END * 3 / 1048576.0::DOUBLE, 6) AS memory_mb FROM ({_META})"
)
def raster_type(spark, sf):
    return _meta(spark, sf).select("raster_id", R.raster_type().alias("raster_type"), F.round(R.memory_mb(), 6).alias("memory_mb"))


@query(
    f"SELECT raster_id, null_percent > 10 AS many_null, list_filter([CASE WHEN null_percent > 99 THEN 'nearly all null' END, CASE WHEN min = max AND null_percent < 100 THEN 'single value' END], lambda x: x IS NOT NULL) AS flags FROM ("
    f"SELECT raster_id, min(v) AS min, max(v) AS max, 100.0::DOUBLE * (count(*) - count(v)) / count(*) AS null_percent FROM (SELECT raster_id, CASE WHEN raster_id % 9 = 0 AND v IS NOT NULL THEN 1.0::DOUBLE ELSE v END AS v FROM ({_VALID})) GROUP BY raster_id)"
)
def quality_flags(spark, sf):
    p = X.pixels(spark, sf).withColumn("value", F.when((F.col("raster_id") % 9 == 0) & ~R.is_nodata(F.col("value"), X.NODATA), 1.0).otherwise(F.col("value")))
    return R.quality_flags(R.band_stats(p, X.NODATA)).select("raster_id", (F.col("null_percent") > 10).alias("many_null"), "flags")


@query(
    f"SELECT event_id, CASE WHEN abs(value + 9999) > 1e-8 + 1e-5 * 9999 THEN value::FLOAT END AS value FROM (SELECT event_id, least(greatest(floor((lon + 100) / 25.0::DOUBLE)::BIGINT, 0), 7) AS c, least(greatest(floor((40 - lat) / 10.0::DOUBLE)::BIGINT, 0), 7) AS w FROM ({X.POINTS})) p JOIN (SELECT row, col, value FROM ({X.PIXELS}) WHERE raster_id = 5) g ON g.row = w AND g.col = c"
)
def point_sample_clamp(spark, sf):
    p = X.points(spark, sf).select("event_id", "lon", "lat")
    return R.sample_nearest(p, X.pixels(spark, sf).where("raster_id = 5"), -100.0, 40.0, 25.0, 10.0, 8, 8, X.NODATA).select("event_id", "value")


@query(
    f"SELECT event_id FROM (SELECT event_id, floor((lon + 100) / 25.0::DOUBLE)::BIGINT AS c, floor((40 - lat) / 10.0::DOUBLE)::BIGINT AS w FROM ({X.POINTS})) p JOIN (SELECT row, col, value FROM ({X.PIXELS}) WHERE raster_id = 5) g ON g.row = w AND g.col = c WHERE value <> 0 AND abs(value + 9999) > 1e-8 + 1e-5 * 9999"
)
def grid_on_raster(spark, sf):
    return R.grid_on_raster(X.points(spark, sf), X.pixels(spark, sf).where("raster_id = 5"), -100.0, 40.0, 25.0, 10.0, 8, 8, X.NODATA).select("event_id")


#: Each point belongs to one raster; the points are dealt over all rasters, however many there are.
_DEALT = f"SELECT *, event_id % (SELECT count(*) FROM embeddings) AS raster_id, floor((lon + 100) / 25.0::DOUBLE)::BIGINT AS c, floor((40 - lat) / 10.0::DOUBLE)::BIGINT AS w FROM ({X.POINTS})"


def _dealt(spark, sf):
    n = X.table(spark, sf, "embeddings").agg(F.count("*").alias("__n"))
    return X.points(spark, sf).crossJoin(F.broadcast(n)).withColumn("raster_id", F.col("event_id") % F.col("__n")).drop("__n")


@query(
    f"SELECT event_id, p.raster_id, CASE WHEN abs(g.value + 9999) > 1e-8 + 1e-5 * 9999 THEN g.value::FLOAT END AS value FROM ({_DEALT}) p LEFT JOIN ({X.PIXELS}) g ON g.raster_id = p.raster_id AND g.row = least(greatest(w, 0), 7) AND g.col = least(greatest(c, 0), 7)"
)
def point_sample_all(spark, sf):
    p = _dealt(spark, sf).select("event_id", "raster_id", "lon", "lat")
    return R.sample_nearest(p, X.pixels(spark, sf), -100.0, 40.0, 25.0, 10.0, 8, 8, X.NODATA, by=["raster_id"]).select("event_id", "raster_id", "value")


@query(f"SELECT event_id, p.raster_id FROM ({_DEALT}) p JOIN ({X.PIXELS}) g ON g.raster_id = p.raster_id AND g.row = w AND g.col = c WHERE g.value <> 0 AND abs(g.value + 9999) > 1e-8 + 1e-5 * 9999")
def grid_on_rasters_all(spark, sf):
    return R.grid_on_raster(_dealt(spark, sf), X.pixels(spark, sf), -100.0, 40.0, 25.0, 10.0, 8, 8, X.NODATA, by=["raster_id"]).select("event_id", "raster_id")


@query(
    f"SELECT raster_id, 'tile_r' || (ro // 90) || '_c' || (co // 90) AS tile_id, ro::INT AS row_off, co::INT AS col_off, least(100, width - co)::INT AS tile_width, least(100, height - ro)::INT AS tile_height FROM (SELECT raster_id, width, height, unnest(range(0, height, 90)) AS ro FROM ({_META})) , LATERAL (SELECT unnest(range(0, width, 90)) AS co)"
)
def raster_tile_grid(spark, sf):
    return R.tile_grid(_meta(spark, sf), 100, 10)


@query(f"SELECT raster_id, least(greatest(floor(floor(sqrt(8 * 1048576.0::DOUBLE / (band_count * 4 * 3))) / 256) * 256, 256), 4096)::INT AS tile_size FROM ({_META})")
def optimal_tile_size(spark, sf):
    return _meta(spark, sf).select("raster_id", R.best_tile_size(F.col("band_count") * 4, 8).alias("tile_size"))


@query(f"SELECT raster_id, 'tile_r' || (row // 3) || '_c' || (col // 3) AS tile_id, count(*)::BIGINT AS n, sum(value) AS total FROM ({X.PIXELS}) GROUP BY ALL")
def tile_raster(spark, sf):
    return R.tile_pixels(X.pixels(spark, sf), 3).groupBy("raster_id", "tile_id").agg(F.count("*").alias("n"), F.sum("value").alias("total"))


_SCENE = f"SELECT raster_id // 3 AS raster_id, band, row, col, CASE WHEN value = -9999 THEN 0 ELSE 200 + value END AS value FROM ({X.PIXELS})"


@query(
    "SELECT raster_id, CASE WHEN count(*) FILTER (WHERE ok) > 0 THEN round(100.0::DOUBLE * count(*) FILTER (WHERE ok AND (r + g + b) / 3 > 180 AND CASE WHEN greatest(r, g, b) > 0 THEN (greatest(r, g, b) - least(r, g, b)) / greatest(r, g, b) ELSE 0 END < 0.2) / count(*) FILTER (WHERE ok), 1) END AS cloud_pct, (count(*) FILTER (WHERE ok))::BIGINT AS valid FROM "
    f"(SELECT *, r IS NOT NULL AND g IS NOT NULL AND b IS NOT NULL AND NOT (r = 0 AND g = 0 AND b = 0) AS ok FROM (SELECT raster_id, row, col, max(value) FILTER (WHERE band = 1) AS r, max(value) FILTER (WHERE band = 2) AS g, max(value) FILTER (WHERE band = 3) AS b FROM ({_SCENE}) GROUP BY ALL)) GROUP BY raster_id"
)
def cloud_cover(spark, sf):
    p = X.pixels(spark, sf)
    return R.cloud_cover(p.withColumns({"raster_id": F.floor(F.col("raster_id") / 3), "value": F.when(F.col("value") == X.NODATA, 0.0).otherwise(F.col("value") + 200)}))


@query(
    f"SELECT band, row, col, arg_max(value, i) AS value FROM (SELECT *, CASE WHEN raster_id IN (4, 6) THEN 0 ELSE 1 END AS i FROM ({X.PIXELS}) WHERE raster_id IN (3, 4, 6, 7) AND value <> -9999 "
    "QUALIFY row_number() OVER (PARTITION BY band, row, col, CASE WHEN raster_id IN (4, 6) THEN 0 ELSE 1 END ORDER BY raster_id) = 1) GROUP BY ALL"
)
def raster_mosaic(spark, sf):
    p = X.pixels(spark, sf)
    one = lambda a, b: A.first_rows(p.where(F.col("raster_id").isin(a, b) & (F.col("value") != X.NODATA)), ["band", "row", "col"], ["raster_id"])
    return R.mosaic([one(4, 6), one(3, 7)], X.NODATA)


@query(
    f"SELECT band, row, col, arg_max(value, i) AS value FROM (SELECT band, raster_id // 3 // 100 * 8 + row AS row, raster_id // 3 % 100 * 4 + col AS col, raster_id // 3 % 2 AS i, value FROM ({X.PIXELS}) WHERE value <> -9999) GROUP BY ALL"
)
def raster_mosaic_all(spark, sf):
    """The rasters of a band in rows of 100 that overlap by half; those of odd place lie on top."""
    place = F.floor(F.col("raster_id") / 3)
    p = X.pixels(spark, sf).withColumns({"place": place, "row": F.floor(place / 100) * 8 + F.col("row"), "col": place % 100 * 4 + F.col("col")})
    return R.mosaic([p.where("place % 2 = 0"), p.where("place % 2 = 1")], X.NODATA)


@query(f"SELECT raster_id, band, (row // 2)::BIGINT AS row, (col // 2)::BIGINT AS col, avg(value) AS value FROM ({X.PIXELS}) GROUP BY raster_id, band, row // 2, col // 2")
def raster_overview(spark, sf):
    return R.level_one(X.pixels(spark, sf))


_KINDS = ("rgb", "rgba", "dem", "categorical", "multispectral", "panchromatic", "unknown")
_PACKING = {  # by quality, in the order of _KINDS
    "visualization": ("JPEG", "WEBP", "DEFLATE", "DEFLATE", "DEFLATE", "JPEG", "DEFLATE"),
    "analysis": ("DEFLATE",) * 7,
    "archive": ("LZW", "LZW", "LERC_DEFLATE", "LZW", "LERC_DEFLATE", "LZW", "DEFLATE"),
}


@query(
    "SELECT raster_id, quality, raster_type, CASE WHEN raster_type IN ('categorical', 'unknown') THEN 'nearest' ELSE 'bilinear' END AS resampling, compression, "
    "CASE WHEN compression IN ('DEFLATE', 'LZW') AND raster_type <> 'categorical' THEN 2 END::INT AS predictor, size_mb < 0.5 AS in_memory FROM ("
    + " UNION ALL ".join(f"SELECT vec_id AS raster_id, '{q}' AS quality, {list(_KINDS)}[vec_id % 7 + 1] AS raster_type, {list(p)}[vec_id % 7 + 1] AS compression, vec_id / 100.0::DOUBLE AS size_mb FROM embeddings" for q, p in _PACKING.items())
    + ")"
)
def cog_plan(spark, sf):
    k = F.col("vec_id")
    meta = X.table(spark, sf, "embeddings").select(k.alias("raster_id"), F.element_at(F.array(*map(F.lit, _KINDS)), (k % 7 + 1).cast("int")).alias("raster_type"), (k / 100.0).alias("size_mb"))
    parts = [R.cog_plan(meta, q, 0.5) for q in _PACKING]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).select("raster_id", "quality", "raster_type", "resampling", "compression", "predictor", "in_memory")


# --- joins, merges, summaries ---------------------------------------------------------------


@query(f"SELECT event_id, zone_id, name FROM ({X.POINTS}) JOIN ({X.ZONES}) ON lon >= west AND lon < east AND lat >= south AND lat < north")
def assign_rectangles(spark, sf):
    return J.rectangles_join(X.points(spark, sf).select("event_id", "lon", "lat"), X.zones(spark, sf), "lon", "lat", ["zone_id", "name"]).select("event_id", "zone_id", "name")


@query(f"SELECT event_id AS cell, arg_min(name, zone_id) AS name FROM ({X.POINTS}) JOIN (SELECT zone_id, name, west - 10 AS west, south AS south, east + 10 AS east, north FROM ({X.ZONES})) ON lon > west AND lon < east AND lat > south AND lat < north GROUP BY event_id")
def assign_polygons(spark, sf):
    from cellweave.functions.geometry import wkt_to_wkb

    z = X.zones(spark, sf).withColumns({"west": F.col("west") - 10, "east": F.col("east") + 10})
    w, s, e, n = (F.col(c).cast("string") for c in ("west", "south", "east", "north"))
    ring = F.concat(F.lit("POLYGON(("), w, F.lit(" "), s, F.lit(","), e, F.lit(" "), s, F.lit(","), e, F.lit(" "), n, F.lit(","), w, F.lit(" "), n, F.lit(","), w, F.lit(" "), s, F.lit("))"))
    polygons = z.withColumn("geom_wkb", wkt_to_wkb(ring)).select("zone_id", "name", "geom_wkb")
    p = X.points(spark, sf).select(F.col("event_id").alias("cell"), "lon", "lat")
    return J.assign_polygons(p, polygons, ["name"], "zone_id").select("cell", "name")


@query("SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_quantity > 25)")
def anti_pending(spark, sf):
    done = X.table(spark, sf, "lineitem").where("l_quantity > 25").select(F.col("l_orderkey").alias("o_orderkey"))
    return X.table(spark, sf, "orders").select("o_orderkey").join(done, "o_orderkey", "left_anti")


@query(f"SELECT event_id FROM ({X.POINTS}) WHERE (floor(lon), floor(lat)) IN (SELECT (floor(lon), floor(lat)) FROM ({X.POINTS}) WHERE class = 'purchase')")
def semi_land(spark, sf):
    p = X.points(spark, sf)
    return J.near_any(p, p.where("class = 'purchase'")).select("event_id")


@query(
    f"SELECT metric, level, round(total, 1) AS total, 1.0::DOUBLE AS share FROM (SELECT 'building_count' AS metric, count(*)::DOUBLE AS total FROM ({X.BUILDINGS}) UNION ALL SELECT 'total_building_area_m2', sum(area_m2) FROM ({X.BUILDINGS})), (VALUES ('l5'), ('l4'), ('l3')) v(level)"
)
def conservation(spark, sf):
    l5 = cut(A.building_metrics(X.buildings(spark, sf)).select("cell", "building_count", "total_building_area_m2"))  # read once, used by all levels
    spec = {"building_count": "sum", "total_building_area_m2": "sum"}
    l4 = rollup(l5, 4, spec)
    out = A.conservation({"l5": l5, "l4": l4, "l3": rollup(l4, 3, spec)}, list(spec), "l5")
    return _r(_r(out, 1, "total"), 9, "share")


@query(f"SELECT cell, n::BIGINT AS building_count FROM (SELECT cell, count(*) AS n FROM ({X.BUILDINGS}) GROUP BY cell) ORDER BY n DESC, cell LIMIT 5")
def topk_cells(spark, sf):
    return A.top_cells(A.building_metrics(X.buildings(spark, sf)), "building_count", 5)


@query("SELECT user_id, event_id, event_type FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) = 1")
def dedup_first(spark, sf):
    return A.first_rows(X.table(spark, sf, "events"), ["user_id"], ["ts", "event_id"]).select("user_id", "event_id", "event_type")


@query(f"SELECT cell, count(*)::BIGINT AS poi_count FROM ({X.PLACES}) GROUP BY cell")
def union_fragments(spark, sf):
    p = X.places(spark, sf)
    return A.merge_fragments([A.place_counts(p.where(F.col("event_id") % 3 == k)) for k in range(3)])


@query("SELECT event_type, count(*)::BIGINT AS n, min(value) AS min_s, max(value) AS max_s, (list_sort(list(value)))[count(*) // 2 + 1] AS median_s FROM events GROUP BY event_type")
def upper_median(spark, sf):
    return A.throughput(X.table(spark, sf, "events"), "value", "event_type").select("event_type", "n", "min_s", "max_s", "median_s")


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN '2020-01-02' WHEN o_orderkey % 3 = 1 THEN NULL ELSE '9999-12-31T00:00:00' END AS seen_at FROM orders")
def sanitize_dates(spark, sf):
    from cellweave.operators.vector import clean_geometries
    from cellweave.functions.geometry import point_wkb

    k = F.col("o_orderkey")
    raw = F.when(k % 3 == 0, "2020-01-02").when(k % 6 == 1, "0000-01-01").when(k % 3 == 1, "10000-01-01").otherwise("9999-12-31T00:00:00")
    rows = X.table(spark, sf, "orders").select(k, raw.alias("seen_at"), point_wkb((k % 180).cast("double"), (k % 80).cast("double")).alias("geom_wkb"))
    return clean_geometries(rows)[0].select("o_orderkey", "seen_at")


_HAV = "2 * 6371008.8::DOUBLE * asin(sqrt(least(1.0, power(sin(radians(b.lat - a.lat) / 2), 2) + cos(radians(a.lat)) * cos(radians(b.lat)) * power(sin(radians(b.lon - a.lon) / 2), 2))))"


@query(f"SELECT a.event_id, round({_HAV}, 3) AS length_m FROM ({X.POINTS}) a JOIN ({X.POINTS}) b ON b.event_id = a.event_id + 1")
def haversine_length(spark, sf):
    a = X.points(spark, sf).select("event_id", "lon", "lat")
    b = a.select((F.col("event_id") - 1).alias("event_id"), F.col("lon").alias("lon2"), F.col("lat").alias("lat2"))
    return a.join(b, "event_id").select("event_id", F.round(C.haversine_m(F.col("lat"), F.col("lon"), F.col("lat2"), F.col("lon2")), 3).alias("length_m"))


@query(f"SELECT cell, class, count(*)::BIGINT AS n, round(sum(length_m), 4) AS length_m FROM ({X.SEGMENTS}) GROUP BY cell, class")
def category_long(spark, sf):
    return _r(A.category_metrics(X.segments(spark, sf), "cell", "class", "length_m"), 4, "length_m")


@query(f"SELECT cell, round(sum(s), 4) AS score FROM (SELECT cell, 0.5 * count(*) AS s FROM ({X.SEGMENTS}) GROUP BY cell UNION ALL SELECT cell, 2.0 * count(*) FROM ({X.BUILDINGS}) GROUP BY cell) GROUP BY cell")
def weighted_combo(spark, sf):
    roads = X.segments(spark, sf).groupBy("cell").agg(F.count("*").alias("n"))
    houses = A.building_metrics(X.buildings(spark, sf))
    return _r(A.weighted({"roads": (roads, "n", 0.5), "houses": (houses, "building_count", 2.0)}), 4, "score")


_SPEED = {"motorway": 110.0, "trunk": 90.0, "primary": 70.0, "residential": 30.0}
_SPEED_SQL = "CASE class " + " ".join(f"WHEN '{c}' THEN {s}::DOUBLE" for c, s in _SPEED.items()) + " END"
_EDGES = f"SELECT cell AS cell_a, {X.cell_sql('l_partkey + 1')} AS cell_b, class, length_m FROM ({X.SEGMENTS})"


def _edges(spark, sf):
    return X.segments(spark, sf).select(F.col("cell").alias("cell_a"), C.cell_from_key(F.col("l_partkey") + 1).alias("cell_b"), "class", "length_m")


@query(f"SELECT least(cell_a, cell_b) AS cell_a, greatest(cell_a, cell_b) AS cell_b, count(*)::BIGINT AS crossings, round(sum(length_m), 4) AS length_m, sum(coalesce({_SPEED_SQL}, 0)) AS score FROM ({_EDGES}) WHERE cell_a <> cell_b GROUP BY 1, 2")
def edge_score(spark, sf):
    return _r(A.edge_metrics(_edges(spark, sf), _SPEED).drop("travel_s"), 4, "length_m")


@query(f"SELECT least(cell_a, cell_b) AS cell_a, greatest(cell_a, cell_b) AS cell_b, round(min(3600.0::DOUBLE / {_SPEED_SQL}), 6) AS travel_s FROM ({_EDGES}) WHERE cell_a <> cell_b GROUP BY 1, 2")
def edge_travel_time(spark, sf):
    return _r(A.edge_metrics(_edges(spark, sf), _SPEED).select("cell_a", "cell_b", "travel_s"), 6, "travel_s")


@query(f"SELECT a.cell, a.n AS n_crop, b.n AS n_infra FROM (SELECT cell, count(*)::BIGINT AS n FROM ({X.SEGMENTS}) GROUP BY cell) a JOIN (SELECT cell, count(*)::BIGINT AS n FROM ({X.BUILDINGS}) GROUP BY cell) b ON a.cell = b.cell")
def cross_dataset_join(spark, sf):
    crop = X.segments(spark, sf).groupBy("cell").agg(F.count("*").alias("n_crop"))
    return crop.join(X.buildings(spark, sf).groupBy("cell").agg(F.count("*").alias("n_infra")), "cell")


@query(f"SELECT DISTINCT {X.cell_sql('raster_id')} AS cell FROM ({_VALID}) WHERE v <> 0")
def cells_with_data(spark, sf):
    return R.cells_with_data(X.pixels(spark, sf).withColumn("cell", C.cell_from_key(F.col("raster_id"))), nodata=X.NODATA)


@query(
    f"SELECT {_P4} AS cell, count(*)::BIGINT AS n, round(sum(length_m), 4) AS length_m, round(CASE WHEN count(*) > 0 THEN sum(length_m)::DECIMAL(38,4)::DOUBLE / count(*) END, 2) AS mean_m FROM (SELECT * FROM ({X.SEGMENTS}) WHERE subtype = 'road') GROUP BY 1"
)
def flagship_rollup(spark, sf):
    return flagship(spark, sf)


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Road metrics by cell, rolled up one level, with the mean length derived again from sums."""
    roads = X.segments(spark, sf_dir).where("subtype = 'road'").withColumn("length_m", F.col("length_m").cast("decimal(20,4)"))
    by_cell = roads.groupBy("cell").agg(F.count("*").alias("n"), F.sum("length_m").alias("length_m"))
    out = rollup(by_cell, 4, {"n": "sum", "length_m": "sum"}, {"mean_m": ("length_m", "n", 1.0)})
    return out.select("cell", "n", F.round(F.col("length_m").cast("double"), 4).alias("length_m"), F.col("mean_m").cast("double").alias("mean_m"))


# --- further joins and tables ---------------------------------------------------------------

_MONTHS = "SELECT user_id, date_trunc('day', ts)::DATE AS day, count(*)::BIGINT AS n FROM events GROUP BY 1, 2"


@query(f"WITH m AS ({_MONTHS}) SELECT a.user_id, a.day, a.n - b.n AS change FROM m a JOIN m b ON b.user_id = a.user_id AND b.day = a.day - 1")
def temporal_change(spark, sf):
    m = X.table(spark, sf, "events").groupBy("user_id", F.to_date("ts").alias("day")).agg(F.count("*").alias("n"))
    before = m.select("user_id", F.date_add("day", 1).alias("day"), F.col("n").alias("n0"))
    return m.join(before, ["user_id", "day"]).select("user_id", "day", (F.col("n") - F.col("n0")).alias("change"))


_SLOPE = f"SELECT cell, (count(*) % 10) / 10.0::DOUBLE AS slope FROM ({X.BUILDINGS}) GROUP BY cell"


@query(
    f"WITH s AS ({_SLOPE}), e AS (SELECT least(cell_a, cell_b) AS cell_a, greatest(cell_a, cell_b) AS cell_b, count(*)::BIGINT AS cost FROM ({_EDGES}) WHERE cell_a <> cell_b GROUP BY 1, 2) "
    "SELECT e.cell_a, e.cell_b, cost, round(cost * (1 + (coalesce(a.slope, 0) + coalesce(b.slope, 0)) / 2), 6) AS friction FROM e LEFT JOIN s a ON a.cell = cell_a LEFT JOIN s b ON b.cell = cell_b"
)
def edge_friction(spark, sf):
    cells = A.building_metrics(X.buildings(spark, sf)).select("cell", ((F.col("building_count") % 10) / 10.0).alias("slope"))
    edges = A.edge_metrics(_edges(spark, sf), _SPEED).select("cell_a", "cell_b", F.col("crossings").alias("cost"))
    return _r(A.friction(edges, cells).select("cell_a", "cell_b", "cost", "friction"), 6, "friction")


@query("SELECT o_custkey AS source, o_orderkey, v AS version FROM (SELECT *, year(o_orderdate)::BIGINT AS v, max(year(o_orderdate)) OVER (PARTITION BY o_custkey) AS newest FROM orders) WHERE v < newest")
def stale_outputs(spark, sf):
    from cellweave.plans.runner import stale

    o = X.table(spark, sf, "orders").select(F.col("o_custkey").alias("source"), "o_orderkey", F.year("o_orderdate").cast("long").alias("version"))
    return stale(o, o.select("source", "version")).select("source", "o_orderkey", "version")


@query("SELECT l_orderkey, l_linenumber, l_quantity, round(coalesce(l_discount, 0) + coalesce(CASE WHEN l_linenumber = 1 THEN NULL ELSE l_tax END, 0), 6) AS total FROM lineitem")
def row_totals(spark, sf):
    rows = X.table(spark, sf, "lineitem").withColumn("t", F.when(F.col("l_linenumber") != 1, F.col("l_tax")))
    return rows.select("l_orderkey", "l_linenumber", "l_quantity", F.round(S.row_total(["l_discount", "t"]), 6).alias("total"))


@query(f"SELECT raster_id, band, sum(CASE WHEN zone_id = 3 THEN 1 ELSE 0 END)::BIGINT AS n FROM ({X.PIXELS}) GROUP BY raster_id, band")
def raster_extract_tile(spark, sf):
    tiled = R.tile_pixels(X.pixels(spark, sf), 4).withColumn("hit", (F.col("tile_id") == "tile_r1_c1").cast("long"))
    return tiled.groupBy("raster_id", "band").agg(F.sum("hit").alias("n"))


@query(f"SELECT DISTINCT event_id AS cell, zone_id FROM ({X.POINTS}) JOIN ({X.ZONES}) ON lon > west AND lon < east AND lat > south AND lat < north")
def feature_pairs(spark, sf):
    from cellweave.functions.geometry import wkt_to_wkb

    w, s, e, n = (F.col(c).cast("string") for c in ("west", "south", "east", "north"))
    sp, cm = F.lit(" "), F.lit(",")
    ring = F.concat(F.lit("POLYGON(("), w, sp, s, cm, e, sp, s, cm, e, sp, n, cm, w, sp, n, cm, w, sp, s, F.lit("))"))
    polygons = X.zones(spark, sf).withColumn("geom_wkb", wkt_to_wkb(ring)).select("zone_id", "geom_wkb")
    return J.feature_pairs(X.points(spark, sf).select(F.col("event_id").alias("cell"), "lon", "lat"), polygons, "zone_id")


@query(f"WITH RECURSIVE e AS (SELECT DISTINCT s_nationkey % 7 AS a, s_suppkey % 50 + 100 AS b FROM supplier), n AS (SELECT a AS x, b AS y FROM e UNION SELECT b, a FROM e), r AS (SELECT x, x AS y FROM n UNION SELECT r.x, n.y FROM r JOIN n ON n.x = r.y) SELECT x AS node, min(y) AS label FROM r GROUP BY x")
def graph_components(spark, sf):
    from cellweave.operators.graph import components

    s = X.table(spark, sf, "supplier")
    return components(s.select((F.col("s_nationkey") % 7).cast("long").alias("src"), (F.col("s_suppkey") % 50 + 100).alias("dst")).distinct())


@query(
    "WITH RECURSIVE e AS (SELECT DISTINCT s_suppkey % 40 AS a, (s_suppkey * 7 + 3) % 40 AS b FROM supplier), d AS (SELECT 1::BIGINT AS node, 0 AS k UNION SELECT e.b, d.k + 1 FROM d JOIN e ON e.a = d.node WHERE d.k < 40) SELECT node, min(k)::DOUBLE AS cost FROM d GROUP BY node"
)
def graph_distances(spark, sf):
    from cellweave.operators.graph import distances

    s = X.table(spark, sf, "supplier")
    edges = s.select((F.col("s_suppkey") % 40).alias("src"), ((F.col("s_suppkey") * 7 + 3) % 40).alias("dst"), F.lit(1.0).alias("cost")).distinct()
    return distances(edges, spark.range(1, 2).select(F.col("id").alias("node")))


def _order_parts(spark, sf):
    """Orders and their parts as one graph with the keys of the whole table: orders at 0 and above, parts below."""
    rows = X.table(spark, sf, "lineitem")
    return rows.select(F.col("l_orderkey").cast("long").alias("src"), (-1 - F.col("l_partkey").cast("long")).alias("dst"), F.col("l_quantity").cast("double").alias("cost"))


@query()
def graph_components_all(spark, sf):
    from cellweave.operators.graph import components

    return components(_order_parts(spark, sf))


@query()
def graph_distances_all(spark, sf):
    from cellweave.operators.graph import both_ways, distances

    return distances(both_ways(_order_parts(spark, sf)), spark.range(1, 2).select(F.col("id").alias("node")))


# --- geometry ------------------------------------------------------------------


def _shapes(spark, sf):
    k = F.col("o_orderkey")
    x, y = (k % 340 - 170).cast("string"), (k % 120 - 60).cast("string")
    x2, y2 = (k % 340 - 170 + 15).cast("string"), (k % 120 - 60 + 3).cast("string")
    sp, cm = F.lit(" "), F.lit(", ")
    ring = F.concat(F.lit("POLYGON (("), x, sp, y, cm, x, sp, y2, cm, x2, sp, y2, cm, x2, sp, y, cm, x, sp, y, F.lit("))"))
    line = F.concat(F.lit("LINESTRING ("), x, sp, y, cm, x2, sp, y2, F.lit(")"))
    point = F.concat(F.lit("POINT ("), x, sp, y, F.lit(")"))
    wkt = F.when(k % 4 == 0, ring).when(k % 4 == 1, line).when(k % 4 == 2, point)
    return X.table(spark, sf, "orders").select("o_orderkey", wkt.alias("wkt"))


_SHAPE_KEYS = "SELECT o_orderkey, o_orderkey % 4 AS kind, (o_orderkey % 340 - 170)::BIGINT AS x, (o_orderkey % 120 - 60)::BIGINT AS y, (o_orderkey % 340 - 155)::BIGINT AS x2, (o_orderkey % 120 - 57)::BIGINT AS y2 FROM orders"


@query("SELECT o_orderkey, true AS same FROM orders")
def wkb_roundtrip(spark, sf):
    from cellweave.functions.geometry import wkb_to_wkt, wkt_to_wkb

    return _shapes(spark, sf).select("o_orderkey", wkb_to_wkt(wkt_to_wkb("wkt")).eqNullSafe(F.col("wkt")).alias("same"))


# The ellipsoid's half axis and flattening.
_HALF_AXIS, _FLAT = 6378137.0, 1 / 298.257223563
_E2 = _FLAT * (2 - _FLAT)
_E1 = _E2**0.5


def _q_sql(lat: str) -> str:
    s = f"sin(radians({lat}))"
    return f"({1 - _E2!r}::DOUBLE * ({s} / (1 - {_E2!r}::DOUBLE * {s} * {s}) + atanh({_E1!r}::DOUBLE * {s}) / {_E1!r}::DOUBLE))"


# The inverse problem on the ellipsoid for lines 15 degrees east and 3 north of a parallel y: the difference of longitude on the sphere converges in a few steps.
_VINCENTY = f"""
    p AS (SELECT y, atan({1 - _FLAT!r}::DOUBLE * tan(radians(y))) AS u, atan({1 - _FLAT!r}::DOUBLE * tan(radians(y + 3))) AS w FROM (SELECT DISTINCT y FROM k)),
    v AS (
        SELECT y, u, w, radians(15.0::DOUBLE) AS lam, 0 AS i FROM p
        UNION ALL
        SELECT y, u, w, radians(15.0::DOUBLE) + (1 - c) * {_FLAT!r}::DOUBLE * sa * (sg + c * ss * (cm + c * cs * (2 * cm * cm - 1))), i + 1 FROM (
            SELECT *, {_FLAT!r}::DOUBLE / 16 * (1 - sa * sa) * (4 + {_FLAT!r}::DOUBLE * (4 - 3 * (1 - sa * sa))) AS c, cs - 2 * sin(u) * sin(w) / (1 - sa * sa) AS cm, atan2(ss, cs) AS sg FROM (
                SELECT *, cos(u) * cos(w) * sin(lam) / ss AS sa FROM (
                    SELECT *, sqrt(power(cos(w) * sin(lam), 2) + power(cos(u) * sin(w) - sin(u) * cos(w) * cos(lam), 2)) AS ss, sin(u) * sin(w) + cos(u) * cos(w) * cos(lam) AS cs FROM v WHERE i < 12)))
    ),
    e AS (
        SELECT y, {_HALF_AXIS * (1 - _FLAT)!r}::DOUBLE * (1 + u2 / 16384 * (4096 + u2 * (-768 + u2 * (320 - 175 * u2)))) * (sg - b * ss * (cm + b / 4 * (cs * (2 * cm * cm - 1) - b / 6 * cm * (4 * ss * ss - 3) * (4 * cm * cm - 3)))) AS m FROM (
            SELECT *, u2 / 1024 * (256 + u2 * (-128 + u2 * (74 - 47 * u2))) AS b FROM (
                SELECT *, (1 - sa * sa) * {_E2 / (1 - _E2)!r}::DOUBLE AS u2, cs - 2 * sin(u) * sin(w) / (1 - sa * sa) AS cm, atan2(ss, cs) AS sg FROM (
                    SELECT *, cos(u) * cos(w) * sin(lam) / ss AS sa FROM (
                        SELECT *, sqrt(power(cos(w) * sin(lam), 2) + power(cos(u) * sin(w) - sin(u) * cos(w) * cos(lam), 2)) AS ss, sin(u) * sin(w) + cos(u) * cos(w) * cos(lam) AS cs FROM v WHERE i = 12))))
    )"""


@query(
    f"WITH RECURSIVE k AS ({_SHAPE_KEYS}), {_VINCENTY} SELECT o_orderkey, CASE kind WHEN 1 THEN round(m, 2) WHEN 3 THEN NULL ELSE 0 END AS length_m, "
    f"CASE kind WHEN 0 THEN round({_HALF_AXIS**2 / 2!r}::DOUBLE * radians(15.0::DOUBLE) * ({_q_sql('k.y + 3')} - {_q_sql('k.y')}) / 1000000, 2) WHEN 3 THEN NULL ELSE 0 END AS area_km2, "
    "CASE kind WHEN 3 THEN NULL WHEN 2 THEN x ELSE x + 7.5 END::DOUBLE AS x, CASE kind WHEN 3 THEN NULL WHEN 2 THEN k.y ELSE k.y + 1.5 END::DOUBLE AS y FROM k JOIN e ON e.y = k.y"
)
def geodesic_measures(spark, sf):
    from cellweave.functions import geometry as G

    g = _shapes(spark, sf).withColumn("g", G.wkt_to_wkb("wkt"))
    g = g.select("o_orderkey", F.round(G.st_length_m("g"), 2).alias("length_m"), F.round(G.st_area_m2("g") / 1e6, 2).alias("area_km2"), G.centroid("g").alias("c"))
    return g.select("o_orderkey", "length_m", "area_km2", F.round("c.x", 9).alias("x"), F.round("c.y", 9).alias("y"))


@query(
    f"WITH k AS ({_SHAPE_KEYS}) SELECT * FROM (SELECT count(*)::BIGINT AS input_count, unnest([0, 1, 2, 3, 4, 5, 6, 7])::INT AS position, "
    "unnest(['remove_nulls', 'repair_invalid', 'force_2d', 'fix_antimeridian', 'normalize_multi', 'fix_winding_order', 'validate_types', 'sanitize_datetimes']) AS stage, "
    "unnest([count(*) FILTER (WHERE kind = 3), 0, 0, count(*) FILTER (WHERE kind IN (0, 1) AND x2 > 180), count(*) FILTER (WHERE kind < 3 AND (kind = 2 OR x2 <= 180)), count(*) FILTER (WHERE kind = 0), 0, 0])::BIGINT AS affected, "
    "unnest([count(*) FILTER (WHERE kind = 3), 0, 0, 0, 0, 0, 0, 0])::BIGINT AS removed FROM k)"
)
def vector_clean_report(spark, sf):
    from cellweave.functions.geometry import wkt_to_wkb
    from cellweave.operators.vector import clean_geometries

    return clean_geometries(_shapes(spark, sf).withColumn("geom_wkb", wkt_to_wkb("wkt")).drop("wkt"))[1]


@query(
    f"WITH k AS ({_SHAPE_KEYS}) SELECT o_orderkey, x2 > 180 AS split, CASE kind WHEN 2 THEN 'MULTIPOINT ((' || x || ' ' || y || '))' "
    "WHEN 1 THEN CASE WHEN x2 <= 180 THEN 'MULTILINESTRING ((' || x || ' ' || y || ', ' || x2 || ' ' || y2 || '))' END "
    "ELSE CASE WHEN x2 <= 180 THEN 'MULTIPOLYGON (((' || x || ' ' || y || ', ' || x2 || ' ' || y || ', ' || x2 || ' ' || y2 || ', ' || x || ' ' || y2 || ', ' || x || ' ' || y || ')))' END END AS wkt FROM k WHERE kind <> 3"
)
def vector_clean(spark, sf):
    """Shapes that cross 180 degrees are split, so only that they are is compared."""
    from cellweave.functions.geometry import bounds, wkb_to_wkt, wkt_to_wkb
    from cellweave.operators.vector import clean_geometries

    rows = clean_geometries(_shapes(spark, sf).withColumn("geom_wkb", wkt_to_wkb("wkt")).drop("wkt"))[0]
    beyond = F.col("o_orderkey") % 340 - 155 > 180
    inside = bounds("geom_wkb").alias("b")
    rows = rows.select("o_orderkey", beyond.alias("split"), wkb_to_wkt("geom_wkb").alias("w"), inside)
    whole = (F.col("b.west") >= -180) & (F.col("b.east") <= 180)
    return rows.select("o_orderkey", "split", F.when(whole & (~F.col("split") | (F.col("o_orderkey") % 4 == 2)), F.col("w")).alias("wkt"))


# --- the hexagon grid -----------------------------------------------------------------------

#: Cells that the documentation of the grid states.
_KNOWN = [
    (37.3615593, -122.0553238, 5, "85283473fffffff"), (37.3615593, -122.0553238, 7, "87283472bffffff"), (37.7752702151959, -122.418307270836, 9, "8928308280fffff"), (40.689167, -74.044444, 10, "8a2a1072b59ffff"),
]


@query(" UNION ALL ".join(f"SELECT '{c}' AS cell" for *_, c in _KNOWN) + " ORDER BY cell")
def hex_known_cells(spark, sf):
    from cellweave.functions.hexgrid import hex_cell

    rows = spark.createDataFrame(_KNOWN, "lat double, lon double, res int, known string")
    parts = [rows.where(F.col("res") == r).select(C.cell_hex(hex_cell(F.col("lat"), F.col("lon"), r)).alias("cell")) for r in (5, 7, 9, 10)]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


@query(f"SELECT event_id, 5 AS res, true AS returns, true AS near, true AS nests FROM ({X.POINTS})")
def hex_locate(spark, sf):
    """Every point's cell at level 5: its centre lies in it and near the point, and it is a child of its parent."""
    from cellweave.functions.hexgrid import hex_cell, hex_center, hex_children

    p = X.points(spark, sf).withColumn("cell", hex_cell(F.col("lat"), F.col("lon"), 5)).withColumn("c", hex_center(F.col("cell")))
    p = p.withColumn("again", hex_cell(F.col("c.lat"), F.col("c.lon"), 5))
    near = C.haversine_m(F.col("lat"), F.col("lon"), F.col("c.lat"), F.col("c.lon")) < 14_000
    nests = F.array_contains(hex_children(C.cell_parent(F.col("cell"), 4), 5), F.col("cell"))
    return p.select("event_id", C.cell_resolution(F.col("cell")).alias("res"), (F.col("again") == F.col("cell")).alias("returns"), near.alias("near"), nests.alias("nests"))


@query(" UNION ALL ".join(f"SELECT {r} AS res, {2 + 120 * 7**r}::BIGINT AS cells, {2 + 120 * 7**r}::BIGINT AS ids, {12 * 6 + 7 * (2 + 120 * 7**r - 12)}::BIGINT AS children, 12::BIGINT AS pentagons" for r in range(4)))
def hex_grid_counts(spark, sf):
    """The whole globe at levels 0 to 3: numbers of cells, of their children, and of cells with six children."""
    from functools import reduce

    from cellweave.functions.hexgrid import hex_children
    from cellweave.operators.cover import hex_grid

    def level(r):
        g = hex_grid(spark, r, south=-90.0, north=90.0).withColumn("k", hex_children(F.col("cell"), r + 1))
        return g.agg(F.lit(r).alias("res"), F.count("*").alias("cells"), F.count_distinct("cell").alias("ids"), F.sum(F.size("k")).alias("children"), F.count_if(F.size("k") == 6).alias("pentagons"))

    return reduce(DataFrame.unionByName, [level(r) for r in range(4)])


@query("SELECT zone_id, true AS same FROM (" + X.ZONES + ")")
def hex_polygon_cells(spark, sf):
    """Level 3 cells of each zone's polygon, against those of the grid whose centres lie in the zone's rectangle."""
    from cellweave.functions.geometry import wkt_to_wkb
    from cellweave.operators.cover import hex_grid, polygon_to_cells

    z = X.zones(spark, sf)
    mine = polygon_to_cells(z.withColumn("geom_wkb", wkt_to_wkb(_ring())).select("zone_id", "geom_wkb"), "zone_id", 3).groupBy("zone_id").agg(F.count_distinct("cell").alias("n"), F.sum(F.col("cell") % 1_000_003).alias("t"))
    want = J.rectangles_join(hex_grid(spark, 3).select("cell", "lat", "lon"), z, "lon", "lat", ["zone_id"]).groupBy("zone_id").agg(F.count("*").alias("m"), F.sum(F.col("cell") % 1_000_003).alias("u"))
    return mine.join(want, "zone_id").select("zone_id", ((F.col("n") == F.col("m")) & (F.col("t") == F.col("u"))).alias("same"))


def _ring():
    """A zone's rectangle as text."""
    w, s, e, n = (F.col(c).cast("string") for c in ("west", "south", "east", "north"))
    sp, cm = F.lit(" "), F.lit(",")
    return F.concat(F.lit("POLYGON(("), w, sp, s, cm, e, sp, s, cm, e, sp, n, cm, w, sp, n, cm, w, sp, s, F.lit("))"))


@query(f"SELECT count(*)::BIGINT AS land FROM ({X.POINTS}) p JOIN ({X.ZONES}) ON zone_id % 2 = 0 AND lon > west AND lon < east AND lat > south AND lat < north")
def land_polygons(spark, sf):
    """Points in polygons that stand for land."""
    from cellweave.functions.geometry import wkt_to_wkb

    land = X.zones(spark, sf).where("zone_id % 2 = 0").withColumn("geom_wkb", wkt_to_wkb(_ring())).select("zone_id", "geom_wkb")
    return J.feature_pairs(X.points(spark, sf).select(F.col("event_id").alias("cell"), "lon", "lat"), land, "zone_id").select("cell").distinct().agg(F.count("*").alias("land"))


# --- polygon zones, rasters in an area ------------------------------------------------------

#: Triangles over the rasters' 8 by 8 pixels (a pixel is one degree, row 0 on top): below, and above, the diagonal.
_TRIANGLES = [(0, "POLYGON((0 0, 8 0, 0 8, 0 0))"), (1, "POLYGON((8 0, 8 8, 0 8, 8 0))")]


def _placed(spark, sf):
    return X.pixels(spark, sf).drop("zone_id").withColumns({"lon": F.col("col") + 0.5, "lat": 7.5 - F.col("row")})


@query(f"SELECT raster_id, (CASE WHEN col < row THEN 0 ELSE 1 END)::INT AS zone_id, round(sum(v), 6) AS value, count(v)::BIGINT AS pixel_count, (count(*) - count(v))::BIGINT AS nodata_count FROM ({_VALID}) WHERE col <> row GROUP BY ALL")
def zonal_polygons(spark, sf):
    """Pixels whose centres lie in a triangle; those on the diagonal lie on an edge, so in neither."""
    from cellweave.functions.geometry import wkt_to_wkb

    zones = spark.createDataFrame(_TRIANGLES, "zone_id int, wkt string").select("zone_id", wkt_to_wkb("wkt").alias("geom_wkb"))
    return _r(R.zonal_polygons(_placed(spark, sf), zones, "sum", nodata=X.NODATA, by=["raster_id"]), 6, "value")


@query(f"SELECT raster_id, z::INT AS zone_id, count(v)::BIGINT AS pixel_count FROM ({_VALID}), range(2) r(z) WHERE CASE WHEN z = 0 THEN col <= row ELSE col >= row END GROUP BY ALL")
def zonal_polygons_touched(spark, sf):
    """With the pixels that an edge runs through: the diagonal belongs to both triangles."""
    from cellweave.functions.geometry import wkt_to_wkb

    inner = [(0, "POLYGON((0.1 0.1, 7.9 0.1, 0.1 7.9, 0.1 0.1))"), (1, "POLYGON((7.9 0.1, 7.9 7.9, 0.1 7.9, 7.9 0.1))")]
    zones = spark.createDataFrame(inner, "zone_id int, wkt string").select("zone_id", wkt_to_wkb("wkt").alias("geom_wkb"))
    out = R.zonal_polygons(_placed(spark, sf), zones, "count", nodata=X.NODATA, by=["raster_id"], touched=True, half_x=0.45, half_y=0.45)
    return out.select("raster_id", "zone_id", "pixel_count")


@query(
    f"SELECT raster_id, round(100.0::DOUBLE * count(*) FILTER (WHERE ok AND (r + g + b) / 3 > 180 AND CASE WHEN greatest(r, g, b) > 0 THEN (greatest(r, g, b) - least(r, g, b)) / greatest(r, g, b) ELSE 0 END < 0.2) / nullif(count(*) FILTER (WHERE ok), 0), 1) AS cloud_pct, "
    "(count(*) FILTER (WHERE ok))::BIGINT AS valid, round(100.0::DOUBLE * count(*) FILTER (WHERE ok) / count(*), 1) AS coverage_pct FROM "
    f"(SELECT *, r IS NOT NULL AND g IS NOT NULL AND b IS NOT NULL AND NOT (r = 0 AND g = 0 AND b = 0) AS ok FROM (SELECT raster_id, row, col, max(value) FILTER (WHERE band = 1) AS r, max(value) FILTER (WHERE band = 2) AS g, max(value) FILTER (WHERE band = 3) AS b FROM ({_SCENE}) WHERE col < row GROUP BY ALL)) GROUP BY raster_id"
)
def cloud_cover_in_area(spark, sf):
    """Cloud cover, coverage and valid pixels of the scenes within a triangle."""
    from cellweave.functions.geometry import wkt_to_wkb

    p = _placed(spark, sf)
    scene = p.withColumns({"raster_id": F.floor(F.col("raster_id") / 3), "value": F.when(F.col("value") == X.NODATA, 0.0).otherwise(F.col("value") + 200)})
    area = spark.createDataFrame(_TRIANGLES[:1], "k int, wkt string").select(wkt_to_wkb("wkt").alias("geom_wkb"))
    return R.cloud_cover(scene, area=area).drop("brightness")


@query(
    "SELECT raster_id, CASE WHEN raster_id % 3 = 0 THEN 'no projection' WHEN west < -180 OR east > 180 THEN 'longitude out of range' END AS error, memory_mb FROM ("
    f"SELECT raster_id, raster_id % 400 - 200 AS west, raster_id % 400 - 199 AS east, round(width * height * band_count * CASE dtype WHEN 'uint8' THEN 1 WHEN 'uint16' THEN 2 WHEN 'int16' THEN 2 WHEN 'float32' THEN 4 ELSE 8 END * 3 / 1048576.0::DOUBLE, 6) AS memory_mb FROM ({_META}))"
)
def raster_validation(spark, sf):
    """The report of each raster: its first error and the memory that it needs."""
    k = F.col("raster_id")
    meta = _meta(spark, sf).drop("categorical").withColumns({"west": k % 400 - 200, "east": k % 400 - 199, "south": F.lit(0), "north": F.lit(1), "srid": F.when(k % 3 != 0, 4326)})
    out = R.validate_rasters(meta, X.pixels(spark, sf), X.NODATA)
    return out.select("raster_id", F.get("errors", 0).alias("error"), F.round("memory_mb", 6).alias("memory_mb"))


@query("SELECT raster_id, cloud_pct FROM (" + "SELECT raster_id, CASE WHEN count(*) FILTER (WHERE ok) > 0 THEN round(100.0::DOUBLE * count(*) FILTER (WHERE ok AND (r + g + b) / 3 > 180 AND CASE WHEN greatest(r, g, b) > 0 THEN (greatest(r, g, b) - least(r, g, b)) / greatest(r, g, b) ELSE 0 END < 0.2) / count(*) FILTER (WHERE ok), 1) END AS cloud_pct FROM "
    f"(SELECT *, r IS NOT NULL AND g IS NOT NULL AND b IS NOT NULL AND NOT (r = 0 AND g = 0 AND b = 0) AS ok FROM (SELECT raster_id, row, col, max(value) FILTER (WHERE band = 1) AS r, max(value) FILTER (WHERE band = 2) AS g, max(value) FILTER (WHERE band = 3) AS b FROM ({_SCENE}) GROUP BY ALL)) GROUP BY raster_id) WHERE cloud_pct <= 90")
def clear_scenes(spark, sf):
    p = X.pixels(spark, sf).withColumns({"raster_id": F.floor(F.col("raster_id") / 3), "value": F.when(F.col("value") == X.NODATA, 0.0).otherwise(F.col("value") + 200)})
    return R.clear_scenes(p.select("raster_id").distinct(), p, 90.0).select("raster_id", "cloud_pct")


@query(f"SELECT {_P4} AS cell, round_even(sum(o_orderkey / 8.0::DOUBLE), 2) AS weight FROM ({X.BUILDINGS}) GROUP BY 1")
def rollup_digits(spark, sf):
    """Outputs rounded half to even; eighths add up exactly."""
    return rollup(X.buildings(spark, sf).withColumn("weight", F.col("o_orderkey") / 8.0), 4, {"weight": "sum"}, digits=2)


# --- sources and sinks: written to the shared folder, read again ----------------------------


def _place(spark: SparkSession, name: str) -> str:
    """A new folder beside the checkpoints, which all executors share."""
    import uuid

    from cellweave.session import ensure_checkpoint_dir

    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext._jsc.sc().getCheckpointDir().get()}/{name}-{uuid.uuid4().hex}"


_POINT_WKT = "'POINT (' || regexp_replace(lon::VARCHAR, '\\.0$', '') || ' ' || regexp_replace(lat::VARCHAR, '\\.0$', '') || ')'"


@query(f"SELECT event_id, {_POINT_WKT} AS wkt FROM ({X.POINTS})")
def csv_round_trip(spark, sf):
    from cellweave.functions.geometry import wkb_to_wkt
    from cellweave.sources.readers import read_csv

    place = _place(spark, "csv")
    X.points(spark, sf).select("event_id", "lat", "lon").write.option("header", True).csv(place)
    return read_csv(spark, place).select(F.col("event_id").cast("long").alias("event_id"), wkb_to_wkt("geom_wkb").alias("wkt"))


@query(f"SELECT event_id, {_POINT_WKT} AS wkt, class FROM ({X.POINTS})")
def geojson_round_trip(spark, sf):
    from cellweave.functions.geometry import geojson_to_wkb, point_wkb, wkb_to_wkt
    from cellweave.sources.sinks import to_geojson

    place = _place(spark, "geojson")
    to_geojson(X.points(spark, sf).select("event_id", "class", point_wkb("lon", "lat").alias("geom_wkb"))).write.text(place)
    rows = spark.read.text(place).select(F.from_json("value", "geometry string, properties struct<event_id long, class string>").alias("f"))
    return rows.select("f.properties.event_id", "f.properties.class", wkb_to_wkt(geojson_to_wkb("f.geometry")).alias("wkt"))


@query(f"SELECT raster_id::VARCHAR AS raster_id, count(v)::BIGINT AS n, sum(v) AS total, sum(v * (row * 8 + col)) AS moment FROM ({_VALID}) GROUP BY raster_id")
def tiff_round_trip(spark, sf):
    """Rasters as GeoTIFF tiles of five by five pixels, read back and put together."""
    from cellweave.sources.readers import tiff_pixels
    from cellweave.sources.sinks import tile_tiffs

    tiles = tile_tiffs(X.pixels(spark, sf), 5, 0.0, 8.0, 1.0, 1.0, X.NODATA)

    def read(frames):
        for pdf in frames:
            for raster, raw in zip(pdf["raster_id"], pdf["content"], strict=True):
                t = tiff_pixels(bytes(raw))
                h, w, _ = t["data"].shape
                at = range(h * w)
                yield pd.DataFrame({"raster_id": raster, "row": [round(8 - t["top"]) + i // w for i in at], "col": [round(t["left"]) + i % w for i in at], "value": t["data"][:, :, 0].astype(float).ravel()})

    p = tiles.select("raster_id", "content").mapInPandas(read, "raster_id string, row int, col int, value double").where(F.col("value") != X.NODATA)
    return p.groupBy("raster_id").agg(F.count("*").alias("n"), F.sum("value").alias("total"), F.sum(F.col("value") * (F.col("row") * 8 + F.col("col"))).alias("moment"))


@query(f"SELECT raster_id::VARCHAR AS raster_id, 'dem' AS raster_type, 'DEFLATE' AS compression, 'bilinear' AS resampling, 2::INT AS overviews, sum(CASE WHEN v IS NULL THEN 0 ELSE v END) AS total FROM ({_VALID}) GROUP BY raster_id")
def cog_round_trip(spark, sf):
    """Every raster as a cloud-optimised copy in tiles of two by two pixels, with two overviews, read back."""
    from cellweave.sources import tiff
    from cellweave.sources.sinks import cog_copies, tile_tiffs

    files = tile_tiffs(X.pixels(spark, sf), 8, 0.0, 8.0, 1.0, 1.0, X.NODATA).select(F.col("raster_id").alias("path"), "content")

    @F.pandas_udf("double")
    def total(values: pd.Series) -> pd.Series:
        out = []
        for raw in values:
            raw = bytes(raw)
            image = tiff.images(raw)[0]
            data = tiff.read_window(raw, image)
            out.append(float(data[data != image.nodata].sum()))
        return pd.Series(out)

    return cog_copies(files, block=2, levels=6).select(F.col("path").alias("raster_id"), "raster_type", "compression", "resampling", "overviews", total("content").alias("total"))


@query("SELECT o_orderstatus, count(*)::BIGINT AS n, sum(o_orderkey)::BIGINT AS keys FROM orders WHERE o_orderstatus <> 'P' GROUP BY o_orderstatus")
def partitioned_round_trip(spark, sf):
    """Orders in a folder for each status; a filter on it reads only its folders."""
    from cellweave.sources.sinks import write_partitioned

    place = _place(spark, "partitioned")
    write_partitioned(X.table(spark, sf, "orders").select("o_orderkey", "o_orderstatus"), place, ["o_orderstatus"])
    return spark.read.parquet(place).where("o_orderstatus <> 'P'").groupBy("o_orderstatus").agg(F.count("*").alias("n"), F.sum("o_orderkey").alias("keys"))


@query("SELECT c_custkey, c_acctbal::FLOAT AS c_acctbal FROM customer")
def sorted_round_trip(spark, sf):
    """Customers as floats in the order of their keys, then as two files."""
    from cellweave.sources.sinks import compact, float_sink, write_sorted

    one, two = _place(spark, "sorted"), _place(spark, "compact")
    write_sorted(float_sink(X.table(spark, sf, "customer").select("c_custkey", F.col("c_acctbal").cast("double").alias("c_acctbal"))), one, "c_custkey", 4)
    compact(spark, one, two, "c_custkey", 2)
    return spark.read.parquet(two).select("c_custkey", "c_acctbal")


@query(f"SELECT n_name AS id, -180.0::DOUBLE + 72 * (n_nationkey % 5) AS west, -33.0::DOUBLE + 27 * (n_nationkey // 5) AS north FROM nation WHERE -180 + 72 * (n_nationkey % 5) <= 10 AND -108 + 72 * (n_nationkey % 5) >= 0 AND -60 + 27 * (n_nationkey // 5) <= 20 AND -33 + 27 * (n_nationkey // 5) >= 0")
def stac_round_trip(spark, sf):
    """Items of the zones, written, read as a search result and searched by a box."""
    from cellweave.sources.readers import search_items, stac_items
    from cellweave.sources.sinks import stac_items as items

    place = _place(spark, "stac")
    z = X.zones(spark, sf).withColumns({"raster_id": F.col("name"), "href": F.concat("name", F.lit(".tif"))})
    one = items(z).agg(F.concat(F.lit('{"features":['), F.array_join(F.collect_list("value"), ","), F.lit("]}")).alias("value"))
    one.coalesce(1).write.text(place)
    found = search_items(stac_items(spark, place), bbox=(0.0, 0.0, 10.0, 20.0))
    return found.select("id", F.get("bbox", 0).alias("west"), F.get("bbox", 3).alias("north"))


@query("SELECT user_id % 50 AS cell, count(*)::BIGINT AS poi_count FROM events GROUP BY 1")
def stream_ingest(spark, sf):
    """Events as a stream of files; each batch adds its counts, and the totals are those of the whole table."""
    from cellweave.streaming.ingest import ingest, totals

    source, out, state = _place(spark, "stream-in"), _place(spark, "stream-out"), _place(spark, "stream-state")
    X.table(spark, sf, "events").select((F.col("user_id") % 50).alias("cell")).repartition(4).write.parquet(source)
    stream = spark.readStream.schema("cell long").option("maxFilesPerTrigger", 2).parquet(source)
    ingest(stream, A.place_counts, out, state).awaitTermination()
    return totals(spark, out)


@query("SELECT stage, count(*)::BIGINT AS n, max(seconds) AS slowest FROM (SELECT event_type AS stage, value AS seconds FROM events) GROUP BY stage")
def metrics_round_trip(spark, sf):
    from cellweave.sources.sinks import append_metrics

    place = _place(spark, "metrics")
    e = X.table(spark, sf, "events").select(F.col("event_type").alias("stage"), F.col("value").alias("seconds"), "event_id")
    for part in (0, 1):
        append_metrics(e.where(F.col("event_id") % 2 == part), place)
    return spark.read.schema("stage string, seconds double").json(place).groupBy("stage").agg(F.count("*").alias("n"), F.max("seconds").alias("slowest"))
