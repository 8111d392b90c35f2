"""Session building and code shipping."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

#: Defaults that hold on any cluster; sizes and masters come from the caller.
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.ui.enabled": "false",
}


def build_session(app: str = "cellweave", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution on and UTC times; keyword names use ``_`` for ``.``."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**BASE_CONF, **{k.replace("_", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once per application.

    Python workers import the operators by name. Where the package is not installed on
    the workers, the zip that ``addPyFile`` serves from the driver makes it importable.
    """
    context = spark.sparkContext
    if getattr(context, "_cellweave_shipped", False):
        return
    root = Path(__file__).resolve().parent
    target = os.path.join(tempfile.mkdtemp(prefix="cellweave-"), "cellweave.zip")
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as out:
        for path in sorted(root.rglob("*.py")):
            out.write(path, f"cellweave/{path.relative_to(root)}")
    context.addPyFile(target)
    context._cellweave_shipped = True


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the folder named in ``spark.checkpoint.dir``; make one only in local mode where none is set."""
    context = spark.sparkContext
    if not context._jsc.sc().getCheckpointDir().isEmpty():
        return
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not context.master.startswith("local[") and context.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="cellweave-checkpoint-")
    context.setCheckpointDir(folder)


def cut(df):
    """Materialise ``df`` in the shared checkpoint folder and cut its lineage."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
