"""Stand-ins for features, cells and rasters on the driver's tables, in DataFrames and in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellweave.functions.cells import cell_from_key
from cellweave.operators.aggregate import ROAD_CLASSES

#: The tracked road classes and three more of the catalog.
ALL_CLASSES = (*ROAD_CLASSES, "pedestrian", "bridleway", "unknown")
NODATA = -9999.0


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    lon = ((F.col("event_id") * 7919) % 36000) / F.lit(100.0) - 180.0
    lat = ((F.col("event_id") * 104729) % 13500) / F.lit(100.0) - 60.0
    return e.select("event_id", lon.alias("lon"), lat.alias("lat"), F.col("event_type").alias("class"), "value")


POINTS = "SELECT event_id, ((event_id * 7919) % 36000) / 100.0::DOUBLE - 180.0::DOUBLE AS lon, ((event_id * 104729) % 13500) / 100.0::DOUBLE - 60.0::DOUBLE AS lat, event_type AS class, value FROM events"


def cell_sql(key: str) -> str:
    """The cell of a key at level 5."""
    digits = " + ".join(f"((({key}) // {7 ** (5 - i)}) % 7) * {1 << 3 * (15 - i)}" for i in range(1, 6))
    return f"({(1 << 59) + (5 << 52) + (1 << 30) - 1} + ((({key}) // 16807) % 122) * {1 << 45} + {digits})::BIGINT"


def parent_sql(cell: str, res: int) -> str:
    return f"((({cell}) & {~(15 << 52)}) | {res << 52} | {(1 << 3 * (15 - res)) - 1})::BIGINT"


def segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem")
    classes = F.array(*map(F.lit, ALL_CLASSES))
    return rows.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_returnflag",
        F.when(F.col("l_linestatus") == "F", "road").otherwise("rail").alias("subtype"),
        F.element_at(classes, (F.col("l_quantity").cast("int") % 17 + 1)).alias("class"),
        (F.col("l_extendedprice") / 100.0).alias("length_m"),
        cell_from_key(F.col("l_partkey")).alias("cell"),
    )


SEGMENTS = (
    "SELECT l_orderkey, l_linenumber, l_partkey, l_returnflag, CASE WHEN l_linestatus = 'F' THEN 'road' ELSE 'rail' END AS subtype, "
    "(['" + "', '".join(ALL_CLASSES) + "'])[trunc(l_quantity)::INT % 17 + 1] AS class, l_extendedprice / 100.0::DOUBLE AS length_m, "
    f"{cell_sql('l_partkey')} AS cell FROM lineitem"
)


def buildings(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = F.col("o_orderpriority")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(p == "1-URGENT", "residential").when(p == "2-HIGH", "commercial").when(p == "3-MEDIUM", "industrial").otherwise("other").alias("subtype"),
        F.when(F.col("o_orderkey") % 5 < 3, F.col("o_totalprice") / 10000.0).alias("height"),
        (F.col("o_totalprice") / 10.0).alias("area_m2"),
        cell_from_key(F.col("o_custkey")).alias("cell"),
    )


BUILDINGS = (
    "SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 'residential' WHEN '2-HIGH' THEN 'commercial' WHEN '3-MEDIUM' THEN 'industrial' ELSE 'other' END AS subtype, "
    f"CASE WHEN o_orderkey % 5 < 3 THEN o_totalprice / 10000.0::DOUBLE END AS height, o_totalprice / 10.0::DOUBLE AS area_m2, {cell_sql('o_custkey')} AS cell FROM orders"
)


def places(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", "event_type", cell_from_key(F.col("user_id")).alias("cell"))


PLACES = f"SELECT event_id, event_type, {cell_sql('user_id')} AS cell FROM events"


def pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """8 by 8 pixels for each vector; one in 17 is nodata; bands by turns; four zones."""
    e = table(spark, sf_dir, "embeddings").select("vec_id", F.posexplode("embedding").alias("pos", "v"))
    row, col = F.floor(F.col("pos") / 8).cast("int"), (F.col("pos") % 8).cast("int")
    value = F.when((F.col("vec_id") + F.col("pos")) % 17 == 0, F.lit(NODATA)).otherwise(F.round(F.col("v").cast("double") * 100, 0))
    zone = (F.floor(row / 4) * 2 + F.floor(col / 4)).cast("int")
    return e.select(F.col("vec_id").alias("raster_id"), (F.col("vec_id") % 3 + 1).cast("int").alias("band"), row.alias("row"), col.alias("col"), zone.alias("zone_id"), value.alias("value"))


PIXELS = (
    "SELECT vec_id AS raster_id, (vec_id % 3 + 1)::INT AS band, (pos // 8)::INT AS row, (pos % 8)::INT AS col, ((pos // 8 // 4) * 2 + (pos % 8) // 4)::INT AS zone_id, "
    "CASE WHEN (vec_id + pos) % 17 = 0 THEN -9999.0::DOUBLE ELSE round(embedding[pos + 1]::DOUBLE * 100, 0) END AS value FROM embeddings, range(64) r(pos)"
)


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """25 rectangles that tile the globe between 60 south and 75 north."""
    k = F.col("n_nationkey")
    west, south = F.lit(-180.0) + 72.0 * (k % 5), F.lit(-60.0) + 27.0 * F.floor(k / 5)
    return table(spark, sf_dir, "nation").select(k.alias("zone_id"), F.col("n_name").alias("name"), west.alias("west"), south.alias("south"), (west + 72.0).alias("east"), (south + 27.0).alias("north"))


ZONES = "SELECT n_nationkey AS zone_id, n_name AS name, -180.0::DOUBLE + 72 * (n_nationkey % 5) AS west, -60.0::DOUBLE + 27 * (n_nationkey // 5) AS south, -108.0::DOUBLE + 72 * (n_nationkey % 5) AS east, -33.0::DOUBLE + 27 * (n_nationkey // 5) AS north FROM nation"
