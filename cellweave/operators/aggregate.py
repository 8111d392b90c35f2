"""Per-cell metrics, merges, derived ratios, comparisons and summaries.

All sums are partial before the one shuffle on the cell; cells that are null leave before it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellweave.errors import CellError, RasterError

#: The road classes whose lengths are kept, and the building kinds that are counted.
ROAD_CLASSES = (
    "motorway", "trunk", "primary", "secondary", "tertiary", "residential", "living_street",
    "unclassified", "service", "footway", "cycleway", "path", "track", "steps",
)
BUILDING_KINDS = ("residential", "commercial", "industrial")
TRANSPORT_METRICS = (*[f"{c}_length_m" for c in ROAD_CLASSES], "rail_length_m", "road_segment_count", "total_road_length_m")
BUILDING_METRICS = (
    "building_count", "total_building_area_m2", *[f"{k}_count" for k in BUILDING_KINDS], "height_count", "height_sum_m", "avg_height_m",
)
PLACE_METRICS = ("poi_count",)


def ratio(num: Column, den: Column, scale: float = 1.0, digits: int | None = None) -> Column:
    """``num / den * scale``, null unless the denominator is above 0."""
    value = num / den * F.lit(float(scale))
    return F.when(den > 0, value if digits is None else F.round(value, digits))


def sum_if(test: Column, value: Column) -> Column:
    return F.coalesce(F.sum(F.when(test, value).otherwise(0.0)), F.lit(0.0))


def road_metrics(segments: DataFrame, key: str = "cell", cls: str = "class", subtype: str = "subtype", length: str = "length_m", classes: Sequence[str] = ROAD_CLASSES) -> DataFrame:
    """Length by class, rail length, number and length of all road segments, for each cell."""
    road, value = F.col(subtype) == "road", F.col(length)
    return segments.where(F.col(key).isNotNull()).groupBy(key).agg(
        *[sum_if(road & (F.col(cls) == c), value).alias(f"{c}_length_m") for c in classes],
        sum_if(F.col(subtype) == "rail", value).alias("rail_length_m"),
        F.count_if(road).alias("road_segment_count"),
        sum_if(road, value).alias("total_road_length_m"),
    )


def road_stats(segments: DataFrame, key: str = "cell", cls: str = "class", length: str = "length_m", classes: Sequence[str] | None = ROAD_CLASSES, only_listed: bool = True) -> DataFrame:
    """Length by class, number and length of the segments: of the listed classes, or of all that are given.

    One function serves stored extracts and scans, so both count the same classes.
    """
    rows = segments.where(F.col(key).isNotNull())
    if only_listed and classes is not None:
        rows = rows.where(F.col(cls).isin(list(classes)))
    return rows.groupBy(key).agg(
        *[sum_if(F.col(cls) == c, F.col(length)).alias(f"{c}_length_m") for c in classes or ROAD_CLASSES],
        F.count("*").alias("road_segment_count"),
        F.coalesce(F.sum(length), F.lit(0.0)).alias("total_road_length_m"),
    )


def building_metrics(buildings: DataFrame, key: str = "cell", kind: str = "subtype", area: str = "area_m2", height: str = "height") -> DataFrame:
    """Counts, area and heights for each cell; the sum and average of heights stay null where none is known."""
    out = buildings.where(F.col(key).isNotNull()).groupBy(key).agg(
        F.count("*").alias("building_count"),
        F.coalesce(F.sum(area), F.lit(0.0)).alias("total_building_area_m2"),
        *[F.count_if(F.col(kind) == k).alias(f"{k}_count") for k in BUILDING_KINDS],
        F.count(height).alias("height_count"),
        F.sum(height).alias("height_sum_m"),
    )
    return out.withColumn("avg_height_m", ratio(F.col("height_sum_m"), F.col("height_count")))


def place_counts(places: DataFrame, key: str = "cell") -> DataFrame:
    return places.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("poi_count"))


#: Theme: what makes its metrics, and their names.
THEMES = {"transport": (road_metrics, TRANSPORT_METRICS), "buildings": (building_metrics, BUILDING_METRICS), "places": (place_counts, PLACE_METRICS)}


def merge_themes(parts: Sequence[DataFrame], key: str = "cell", zero: Sequence[str] | None = None) -> DataFrame:
    """Full outer merge on the key; extensive metrics that are missing become 0, heights stay null.

    The average height is derived again from the merged sum and count.
    """
    out = reduce(lambda a, b: a.join(b, key, "full"), parts)
    keep_null = {"height_sum_m", "avg_height_m"}
    names = [c for c in (zero or out.columns) if c != key and c not in keep_null]
    out = out.fillna(0, subset=names)
    if {"height_sum_m", "height_count"} <= set(out.columns):
        out = out.withColumn("avg_height_m", ratio(F.col("height_sum_m"), F.col("height_count")))
    return out


def merge_fragments(fragments: Sequence[DataFrame], key: str = "cell", drop: Sequence[str] = ("avg_height_m",)) -> DataFrame:
    """Sums over fragments that may share cells; averages leave first, missing columns are null."""
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), fragments).drop(*drop)
    return rows.groupBy(key).agg(*[F.sum(f"`{c}`").alias(c) for c in rows.columns if c != key])


def pivot_layers(long: DataFrame, layers: Sequence[str], key: str = "cell", layer: str = "layer", value: str = "value", grid: DataFrame | None = None) -> DataFrame:
    """One column for each layer, 0 where a cell has no value: one shuffle, whatever the number of layers.

    With ``grid`` all its cells appear. NaN counts as missing.
    """
    if not layers:
        raise RasterError("no layers to merge")
    clean = long.withColumn(value, F.when(~F.isnan(value), F.col(value)))
    wide = clean.groupBy(key).pivot(layer, list(layers)).agg(F.sum(value))
    out = wide if grid is None else grid.join(wide, key, "left")
    return out.fillna(0.0, subset=list(layers))


def derive_yield(df: DataFrame, num: str, den: str, name: str, scale: float = 1000.0) -> DataFrame:
    """``num / den * scale`` where the denominator is above 0, else null; not rounded."""
    missing = [c for c in (num, den) if c not in df.columns]
    if missing:
        raise CellError(f"missing columns: {missing}")
    return df.withColumn(name, ratio(F.col(num), F.col(den), scale))


def conservation(levels: Mapping[str, DataFrame], metrics: Sequence[str], base: str) -> DataFrame:
    """Totals of each metric by level, and their share of the base level's: ``metric, level, total, share``."""
    stack = ", ".join(f"'{m}', cast(`{m}` as double)" for m in metrics)
    rows = reduce(
        lambda a, b: a.unionByName(b),
        [df.agg(*[F.sum(m).alias(m) for m in metrics]).selectExpr(f"stack({len(metrics)}, {stack}) as (metric, total)").withColumn("level", F.lit(name)) for name, df in levels.items()],
    )
    whole = rows.where(F.col("level") == base).select("metric", F.col("total").alias("base"))
    return rows.join(whole, "metric").select("metric", "level", "total", ratio(F.col("total"), F.col("base")).alias("share"))


def top_cells(df: DataFrame, metric: str, n: int = 5, key: str = "cell") -> DataFrame:
    """The ``n`` cells with the largest metric; ties by key."""
    return df.select(key, metric).orderBy(F.desc(metric), key).limit(n)


def compare(left: DataFrame, right: DataFrame, metrics: Sequence[str], key: str = "cell") -> DataFrame:
    """One row for each metric: totals, their ratio, largest and mean difference, and how the keys meet.

    Differences are over keys of both sides; a ratio to 0 is null.
    """
    a = left.select(key, F.lit(True).alias("in_left"), *[F.col(m).cast("double").alias(f"{m}_left") for m in metrics])
    b = right.select(key, F.lit(True).alias("in_right"), *[F.col(m).cast("double").alias(f"{m}_right") for m in metrics])
    both = a.join(b, key, "full")
    shared = F.col("in_left") & F.col("in_right")
    diff = {m: F.when(shared, F.abs(F.coalesce(f"{m}_left", F.lit(0.0)) - F.coalesce(f"{m}_right", F.lit(0.0)))) for m in metrics}
    whole = both.agg(
        F.count_if(shared).alias("both"), F.count_if(F.col("in_right").isNull()).alias("left_only"), F.count_if(F.col("in_left").isNull()).alias("right_only"),
        *[e for m in metrics for e in (F.sum(f"{m}_left").alias(f"{m}_l"), F.sum(f"{m}_right").alias(f"{m}_r"), F.max(diff[m]).alias(f"{m}_x"), F.avg(diff[m]).alias(f"{m}_a"))],
    )
    stack = ", ".join(f"'{m}', `{m}_l`, `{m}_r`, `{m}_x`, `{m}_a`" for m in metrics)
    rows = whole.selectExpr("both", "left_only", "right_only", f"stack({len(metrics)}, {stack}) as (metric, total_left, total_right, max_diff, mean_diff)")
    return rows.select(
        "metric", "total_left", "total_right", F.when(F.col("total_right") != 0, F.round(F.col("total_left") / F.col("total_right"), 8)).alias("ratio"),
        F.round("max_diff", 4).alias("max_diff"), F.round("mean_diff", 4).alias("mean_diff"), "both", "left_only", "right_only",
    )


def upper_median(column: str) -> Column:
    """The element at half the count of the sorted values, so an element of the data also for even counts."""
    values = F.array_sort(F.collect_list(column))
    return F.element_at(values, (F.floor(F.size(values) / 2) + 1).cast("int"))


def throughput(records: DataFrame, seconds: str = "query_s", worker: str | None = None) -> DataFrame:
    """Counts, least, largest, mean and upper median of the seconds of a run's records, by worker if named."""
    grouped = records.groupBy(worker) if worker else records.groupBy()
    return grouped.agg(
        F.count("*").alias("n"), F.min(seconds).alias("min_s"), F.max(seconds).alias("max_s"), F.avg(seconds).alias("mean_s"), upper_median(seconds).alias("median_s"), F.sum(seconds).alias("total_s")
    )


def first_rows(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row for each key, the first by ``order`` (nulls first); the order should be total.

    A smallest row is a partial aggregate, so a hot key costs one row for each task and no sort.
    """
    rest = [c for c in df.columns if c not in keys]
    first = F.min_by(F.struct(*[F.col(f"`{c}`") for c in rest]), F.struct(*order)).alias("__cw_first")
    return df.groupBy(*keys).agg(first).select(*keys, *[F.col("__cw_first")[c].alias(c) for c in rest]).select(*[F.col(f"`{c}`") for c in df.columns])


def category_metrics(df: DataFrame, key: str, category: str, length: str | None = None, area: str | None = None) -> DataFrame:
    """Long format: count, length and area for each cell and category."""
    extra = [F.sum(c).alias(n) for c, n in ((length, "length_m"), (area, "area_m2")) if c]
    return df.where(F.col(key).isNotNull()).groupBy(key, category).agg(F.count("*").alias("n"), *extra)


def weighted(parts: Mapping[str, tuple[DataFrame, str, float]], key: str = "cell", name: str = "score") -> DataFrame:
    """Sum of weight times column over sources that are joined on the key; a missing source counts 0."""
    rows = reduce(lambda a, b: a.unionByName(b), [df.select(key, (F.coalesce(F.col(c), F.lit(0.0)) * float(w)).alias(name)) for df, c, w in parts.values()])
    return rows.groupBy(key).agg(F.sum(name).alias(name))


def edge_metrics(edges: DataFrame, speeds: Mapping[str, float], a: str = "cell_a", b: str = "cell_b", cls: str = "class", length: str = "length_m", step_m: float = 1000.0) -> DataFrame:
    """For each pair of cells: crossings, length, a score that weighs crossings by speed, and the least travel time.

    ``speeds`` are km/h by class; classes without one do not count for score and time.
    """
    low, high = F.least(a, b), F.greatest(a, b)
    speed = reduce(lambda acc, kv: acc.when(F.col(cls) == kv[0], float(kv[1])), list(speeds.items())[1:], F.when(F.col(cls) == next(iter(speeds)), float(next(iter(speeds.values())))))
    rows = edges.where(F.col(a) != F.col(b)).select(low.alias("cell_a"), high.alias("cell_b"), F.col(length).alias("length"), speed.alias("speed"))
    return rows.groupBy("cell_a", "cell_b").agg(
        F.count("*").alias("crossings"), F.sum("length").alias("length_m"), F.sum(F.coalesce("speed", F.lit(0.0))).alias("score"), F.min(F.lit(step_m * 3.6) / F.col("speed")).alias("travel_s")
    )


def friction(edges: DataFrame, cells: DataFrame, cost: str = "cost", slope: str = "slope", key: str = "cell") -> DataFrame:
    """Edge cost times one plus the mean slope of its ends; an unknown slope is 0."""
    ends = cells.select(F.col(key).alias("end"), F.col(slope).alias("s"))
    out = edges.join(ends.withColumnsRenamed({"end": "cell_a", "s": "s_a"}), "cell_a", "left").join(ends.withColumnsRenamed({"end": "cell_b", "s": "s_b"}), "cell_b", "left")
    mean = (F.coalesce("s_a", F.lit(0.0)) + F.coalesce("s_b", F.lit(0.0))) / 2
    return out.withColumn("friction", F.col(cost) * (1 + mean)).drop("s_a", "s_b")
