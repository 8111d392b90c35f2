"""Cleaning of geometries in eight stages, with a report, in one pass over the rows."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellweave.functions import geometry as G
from cellweave.operators.select import clean_columns
from cellweave.session import ship

STAGES = ("remove_nulls", "repair_invalid", "force_2d", "fix_antimeridian", "normalize_multi", "fix_winding_order", "validate_types", "sanitize_datetimes")
#: The types that pass.
SUPPORTED = ("Point", "MultiPoint", "LineString", "MultiLineString", "Polygon", "MultiPolygon")


def _clean(raw: bytes | None, source: int, target: int) -> tuple:
    """The cleaned WKB and a flag for each of the stages two to seven; None for what a stage removes."""
    if raw is None:
        return None, *([False] * 6)
    g = G.decode(bytes(raw))
    flags = []
    invalid = not G.is_valid(g)
    flags.append(invalid)
    g = G.repair(g) if invalid else g
    flags.append(G.has_z(g))
    g = G.force_2d(g)
    crosses = G.crosses_antimeridian(g)
    flags.append(crosses)
    if crosses:
        try:
            g = G.split_antimeridian(g)
        except (ValueError, IndexError, G.GeometryError):
            pass  # the shape stays as it is
    multi = G.to_multi(g)
    flags.append(multi[0] != g[0])
    turned = G.orient(multi)
    flags.append(not G.same(multi, turned))
    unsupported = turned[0] not in SUPPORTED
    flags.append(unsupported)
    return None if unsupported else G.encode(G.reproject(turned, source, target)), *flags


def clean_geometries(df: DataFrame, geometry: str = "geom_wkb", source: int = 4326, target: int = 4326, rename: bool = True) -> tuple[DataFrame, DataFrame]:
    """Clean rows, and a report with a row for each stage: ``stage, position, affected, removed``.

    Rows without geometry and of unsupported types leave; the others are repaired, made flat,
    split at 180 degrees, made multi, oriented and reprojected. Timestamps and dates outside of
    the years 1 to 9999 become null; a text column named ``*_at`` or ``*_date`` that has no
    such year does, too. Names are cleaned. A winding is counted where a ring was turned.
    """
    ship(df.sparkSession)
    schema = "wkb binary, " + ", ".join(f"s{i} boolean" for i in range(2, 8))

    @F.pandas_udf(schema)
    def clean(values: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([_clean(v, source, target) for v in values], columns=["wkb", *[f"s{i}" for i in range(2, 8)]])

    kinds = dict(df.dtypes)
    dates = [c for c, k in kinds.items() if k in ("timestamp", "timestamp_ntz", "date")]
    texts = [c for c, k in kinds.items() if k == "string" and c.lower().endswith(("_at", "_date"))]
    bad = {c: (F.year(F.col(f"`{c}`")) < 1) | (F.year(F.col(f"`{c}`")) > 9999) for c in dates}
    for c in texts:
        year = F.expr(f"try_cast(regexp_extract(`{c}`, '^([+-]?[0-9]+)-', 1) as int)")
        bad[c] = F.col(f"`{c}`").isNotNull() & (year.isNull() | (year < 1) | (year > 9999))
    done = df.withColumn("__c", clean(F.col(f"`{geometry}`")))
    flag = {c: F.coalesce(b, F.lit(False)) for c, b in bad.items()}
    any_bad = F.lit(False)
    for b in flag.values():
        any_bad = any_bad | b
    absent, kept = F.col(f"`{geometry}`").isNull(), F.col("__c.wkb").isNotNull()
    counts = done.agg(
        F.count_if(absent).alias("n0"), *[F.count_if(F.col(f"__c.s{i}")).alias(f"n{i - 1}") for i in range(2, 8)], F.count_if(any_bad & kept).alias("n7"), F.count("*").alias("input_count")
    )
    stack = ", ".join(f"{i}, '{s}', n{i}, {f'n{i}' if i in (0, 6) else '0L'}" for i, s in enumerate(STAGES))
    report = counts.selectExpr("input_count", f"stack({len(STAGES)}, {stack}) as (position, stage, affected, removed)")
    rows = done.where(kept).withColumns({c: F.when(~flag[c], F.col(f"`{c}`")) for c in flag})
    rows = rows.withColumn(geometry, F.col("__c.wkb")).drop("__c")
    return (clean_columns(rows, geometry) if rename else rows), report


def report_totals(report: DataFrame) -> DataFrame:
    """``total_affected`` and ``rows_removed`` over all stages."""
    return report.agg(F.sum("affected").alias("total_affected"), F.sum("removed").alias("rows_removed"), F.max("input_count").alias("input_count"))
