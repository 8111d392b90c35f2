"""Command line: python -m cellweave.cli THEME|RASTER|ROADS|QUERY ... (see --help)."""

from __future__ import annotations

import argparse
import json

from pyspark.sql import functions as F

from cellweave.functions.hexgrid import hex_cell
from cellweave.operators import aggregate as A
from cellweave.operators.raster import zonal
from cellweave.operators.rollup import rollup_levels
from cellweave.session import build_session
from cellweave.sources.readers import read_tiff
from cellweave.sources.sinks import write_sorted


def _levels(text: str) -> list[int]:
    return [int(x) for x in text.split(",")]


def main(args: list[str] | None = None) -> int:
    top = argparse.ArgumentParser(prog="cellweave")
    sub = top.add_subparsers(dest="what", required=True)
    theme = sub.add_parser("theme", help="metrics per cell of a table of features")
    theme.add_argument("theme", choices=sorted(A.THEMES))
    theme.add_argument("input")
    theme.add_argument("output")
    theme.add_argument("--resolution", type=int, default=5)
    theme.add_argument("--rollup", type=_levels, default=[])
    raster = sub.add_parser("raster", help="a statistic per cell of GeoTIFF files")
    raster.add_argument("input")
    raster.add_argument("output")
    raster.add_argument("--how", default="sum")
    raster.add_argument("--resolution", type=int, default=5)
    roads = sub.add_parser("compare", help="compare two tables of metrics")
    roads.add_argument("left")
    roads.add_argument("right")
    roads.add_argument("--metrics", required=True)
    run = sub.add_parser("query", help="run a registered query")
    run.add_argument("name")
    run.add_argument("tables")
    run.add_argument("--rows", type=int, default=20)
    top.add_argument("--master")
    a = top.parse_args(args)
    spark = build_session(master=a.master)
    if a.what == "theme":
        make, _ = A.THEMES[a.theme]
        df = spark.read.parquet(a.input)
        if "cell" not in df.columns:
            df = df.withColumn("cell", hex_cell(F.col("lat"), F.col("lon"), a.resolution))
        out = make(df)
        write_sorted(out, f"{a.output}/l{a.resolution}", "cell", mode="overwrite")
        if a.rollup:
            base = spark.read.parquet(f"{a.output}/l{a.resolution}")
            for res, level in rollup_levels(base, a.rollup, {c: "sum" for c in out.columns if c not in ("cell", "avg_height_m")}).items():
                write_sorted(level, f"{a.output}/l{res}", "cell", mode="overwrite")
    elif a.what == "raster":
        pixels = read_tiff(spark, a.input).withColumn("cell", hex_cell(F.col("lat"), F.col("lon"), a.resolution))
        write_sorted(zonal(pixels, None, a.how, "cell", by=["raster_id"]), a.output, "cell", mode="overwrite")
    elif a.what == "compare":
        report = A.compare(spark.read.parquet(a.left), spark.read.parquet(a.right), a.metrics.split(","))
        print("\n".join(json.dumps(r.asDict()) for r in report.collect()))
    else:
        from cellweave.plans.catalog import QUERIES

        QUERIES[a.name](spark, a.tables).show(a.rows, truncate=False)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
