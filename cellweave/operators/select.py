"""Predicates and projections: boxes, tiles, names, fills and a small filter language."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellweave.errors import FormatError


def bbox_overlaps(box: str, west: float, south: float, east: float, north: float) -> Column:
    """Boxes that touch or overlap the window; plain comparisons on struct fields, so they reach the Parquet scan."""
    return (F.col(f"{box}.xmin") <= east) & (F.col(f"{box}.xmax") >= west) & (F.col(f"{box}.ymin") <= north) & (F.col(f"{box}.ymax") >= south)


def centroid_in_tile(x: Column, y: Column, west: float, south: float, east: float, north: float) -> Column:
    """Half-open test: a point on a shared edge is in exactly one tile. Positions at the last east or north edge are in none."""
    return (x >= west) & (x < east) & (y >= south) & (y < north)


def in_window(df: DataFrame, box: str, x: str, y: str, west: float, south: float, east: float, north: float) -> DataFrame:
    """The box test, which prunes the scan, next to the exact one, which owns each feature once."""
    return df.where(bbox_overlaps(box, west, south, east, north)).where(centroid_in_tile(F.col(x), F.col(y), west, south, east, north))


def class_filter(column: str, classes: Sequence[str] | None) -> Column:
    """``IN`` over the classes; everything if none are given."""
    return F.lit(True) if classes is None else F.col(column).isin(list(classes))


def clean_name(name: str, geometry: str = "geometry") -> str:
    if name == geometry:
        return name
    out = name.lower()
    for sign in " -.":
        out = out.replace(sign, "_")
    return out.replace("(", "").replace(")", "")


def clean_columns(df: DataFrame, geometry: str = "geometry") -> DataFrame:
    """Lower-case names without blanks, dashes, dots and parentheses; names that then clash get a number."""
    seen: dict[str, int] = {}
    names = []
    for c in df.columns:
        base = clean_name(c, geometry)
        seen[base] = seen.get(base, 0) + 1
        names.append(base if seen[base] == 1 else f"{base}_{seen[base]}")
    return df.toDF(*names)


def null_nan(df: DataFrame, *names: str) -> DataFrame:
    """NaN as null, for sums and counts that skip it; by default in all floating columns."""
    kinds = dict(df.dtypes)
    wanted = names or [c for c, k in kinds.items() if k in ("double", "float")]
    return df.withColumns({c: F.when(~F.isnan(F.col(f"`{c}`")), F.col(f"`{c}`")) for c in wanted}) if wanted else df


def rows_with_data(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Rows in which the named columns, nulls as 0, add up to more than 0."""
    return df.where(reduce(lambda a, b: a + b, [F.coalesce(F.col(f"`{c}`"), F.lit(0)) for c in names]) > 0)


def row_total(names: Sequence[str]) -> Column:
    return reduce(lambda a, b: a + b, [F.coalesce(F.col(f"`{c}`"), F.lit(0.0)) for c in names])


def fill_missing(df: DataFrame, names: Sequence[str], value: float = 0) -> DataFrame:
    return df.fillna(value, subset=list(names))


def key_prefix(column: str, prefix: str) -> Column:
    return F.col(column).startswith(prefix)


_COMPARE = {
    "=": lambda a, b: a == b, "<>": lambda a, b: a != b, "<": lambda a, b: a < b, "<=": lambda a, b: a <= b, ">": lambda a, b: a > b, ">=": lambda a, b: a >= b,
}


def cql2(tree: dict) -> Column:
    """A CQL2-JSON filter as a Column: and, or, not, comparisons, in, between, isNull, like."""

    def value(x):
        return F.col(f"`{x['property']}`") if isinstance(x, dict) and "property" in x else F.lit(x)

    op, args = tree.get("op"), tree.get("args", [])
    if op in ("and", "or"):
        if not args:
            raise FormatError(f"{op} has no arguments")
        return reduce((lambda a, b: a & b) if op == "and" else (lambda a, b: a | b), map(cql2, args))
    if op == "not":
        return ~cql2(args[0])
    if op in _COMPARE:
        return _COMPARE[op](value(args[0]), value(args[1]))
    if op == "in":
        return value(args[0]).isin(list(args[1]))
    if op == "between":
        return value(args[0]).between(value(args[1]), value(args[2]))
    if op == "isNull":
        return value(args[0]).isNull()
    if op == "like":
        return value(args[0]).like(args[1])
    raise FormatError(f"no filter operation {op!r}")
