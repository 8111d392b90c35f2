"""Rollup of cell metrics to a coarser level: sums are summed, ratios are derived again."""

from __future__ import annotations

import logging
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellweave.errors import CellError
from cellweave.functions.cells import cell_parent, cell_resolution, check_resolution
from cellweave.operators.aggregate import ratio

log = logging.getLogger(__name__)


def _aggregates(column: str, key: str) -> dict[str, Column]:
    """First and last follow the cell id, and the smallest of equally frequent values is the mode."""
    c = F.col(f"`{column}`")
    return {
        "sum": F.sum(c), "mean": F.avg(c), "median": F.median(c), "min": F.min(c), "max": F.max(c),
        "first": F.min_by(c, F.col(key)), "last": F.max_by(c, F.col(key)), "count": F.count(c), "mode": F.mode(c, True),
    }


def rollup(df: DataFrame, res: int, aggregates: Mapping[str, str], derived: Mapping[str, tuple[str, str, float]] | None = None, key: str = "cell", digits: int | None = None) -> DataFrame:
    """Metrics of the parents at ``res``.

    ``aggregates`` names a function for each column, ``derived`` numerator, denominator and scale
    for each ratio, which is rounded to 2 digits and null unless the denominator is above 0.
    Columns that are missing are skipped with a warning; both parts of a ratio must be summed.
    Cells that are null or coarser than ``res`` leave; an empty table stays empty. ``digits``
    rounds all floating outputs, by default none: rounding each level would add up.
    """
    check_resolution(res)
    plan: list[Column] = []
    for column, how in aggregates.items():
        if how not in _aggregates(column, key):
            raise CellError(f"no aggregate {how!r} for {column!r}")
        if column not in df.columns:
            log.warning("rollup: no column %s", column)
            continue
        plan.append(_aggregates(column, key)[how].alias(column))
    ratios = {}
    for name, (num, den, scale) in (derived or {}).items():
        if num not in df.columns or den not in df.columns:
            log.warning("rollup: %s has no inputs", name)
            continue
        if aggregates.get(num) != "sum" or aggregates.get(den) != "sum":
            raise CellError(f"{name!r} needs {num!r} and {den!r} as sums")
        ratios[name] = ratio(F.col(f"`{num}`"), F.col(f"`{den}`"), scale, 2)
    parents = df.where(F.col(key).isNotNull() & (cell_resolution(F.col(key)) >= res)).withColumn("__cw_parent", cell_parent(F.col(key), res))
    out = parents.groupBy("__cw_parent").agg(*plan) if plan else parents.select("__cw_parent").distinct()
    out = out.withColumns(ratios).withColumnRenamed("__cw_parent", key) if ratios else out.withColumnRenamed("__cw_parent", key)
    if digits is not None:
        out = out.withColumns({c: F.rint(F.col(c) * 10**digits) / 10**digits for c, k in out.dtypes if k in ("double", "float")})
    return out


def rollup_levels(df: DataFrame, levels: list[int], aggregates: Mapping[str, str], derived: Mapping[str, tuple[str, str, float]] | None = None, key: str = "cell") -> dict[int, DataFrame]:
    """Each level from the one before, finest first."""
    out, now = {}, df
    for res in sorted(levels, reverse=True):
        now = out[res] = rollup(now, res, aggregates, derived, key)
    return out
