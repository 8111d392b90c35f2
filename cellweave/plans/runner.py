"""Resumable batch runs: items, their results, a manifest and a summary."""

from __future__ import annotations

import json
import os
import tempfile
import time
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass, field
from enum import Enum
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellweave.config import RunConfig
from cellweave.errors import RunError


class Status(str, Enum):
    SUCCESS = "success"
    SKIPPED = "skipped"
    FAILED = "failed"


@dataclass
class ItemResult:
    key: str
    status: Status
    seconds: float = 0.0
    message: str = ""
    metadata: dict[str, Any] = field(default_factory=dict)


@dataclass
class Summary:
    name: str
    total: int
    succeeded: int
    skipped: int
    failed: int
    seconds: float
    totals: dict[str, float]
    errors: dict[str, str]

    def log(self, path: str) -> None:
        with open(path, "w", encoding="utf-8") as f:
            json.dump(self.__dict__, f, indent=1, sort_keys=True)


class Manifest:
    """Keys that are done: a sorted JSON list, replaced in one step so a crash leaves the old or the new one."""

    def __init__(self, path: str):
        self.path = path
        self.done: set[str] = set()
        if os.path.exists(path):
            try:
                with open(path, encoding="utf-8") as f:
                    self.done = set(json.load(f))
            except (ValueError, TypeError) as e:
                raise RunError(f"{path} is not a manifest") from e

    def is_done(self, key: str) -> bool:
        return key in self.done

    def mark(self, key: str) -> None:
        self.done.add(key)
        folder = os.path.dirname(os.path.abspath(self.path))
        os.makedirs(folder, exist_ok=True)
        fd, place = tempfile.mkstemp(dir=folder)
        with os.fdopen(fd, "w", encoding="utf-8") as f:
            json.dump(sorted(self.done), f)
        os.replace(place, self.path)


class Progress:
    """Counts, sums of named metadata, rate and time left."""

    def __init__(self, total: int, sums: Sequence[str] = (), clock: Callable[[], float] = time.monotonic):
        self.total, self.clock, self.began = total, clock, clock()
        self.counts = dict.fromkeys(Status, 0)
        self.sums = dict.fromkeys(sums, 0.0)

    def add(self, result: ItemResult) -> None:
        self.counts[result.status] += 1
        for k in self.sums:
            value = result.metadata.get(k)
            if isinstance(value, (int, float)):
                self.sums[k] += value

    def snapshot(self) -> dict[str, Any]:
        n, spent = sum(self.counts.values()), self.clock() - self.began
        worked = n - self.counts[Status.SKIPPED]
        rate = worked / spent if spent > 0 else 0.0
        return {
            "done": n, "total": self.total, "percent": 100.0 * n / self.total if self.total else 100.0, "rate": rate, "left_s": (self.total - n) / rate if rate else None,
            **{s.value: c for s, c in self.counts.items()}, **self.sums,
        }


def run_items(
    name: str,
    items: Iterable[Any],
    process: Callable[[Any], dict | None],
    key: Callable[[Any], str] = str,
    manifest: Manifest | None = None,
    config: RunConfig | None = None,
    exists: Callable[[Any], bool] | None = None,
    sums: Sequence[str] = (),
) -> Summary:
    """Process items one after the other; each is a job that Spark runs in parallel.

    An item is skipped if the manifest has it, or if its output exists (the manifest then gets
    it), or in a dry run (it doesn't). An exception makes the item FAILED and the run goes on,
    unless the config says to stop. Only what succeeded is marked.
    """
    config, began, items = config or RunConfig(), time.monotonic(), list(items)
    progress, errors = Progress(len(items), sums), {}
    for item in items:
        k, start = key(item), time.monotonic()
        if manifest and config.resume and manifest.is_done(k):
            result = ItemResult(k, Status.SKIPPED, message="done before")
        elif exists and exists(item):
            result = ItemResult(k, Status.SKIPPED, message="output exists")
            if manifest:
                manifest.mark(k)
        elif config.dry_run:
            result = ItemResult(k, Status.SKIPPED, message="dry run")
        else:
            try:
                result = ItemResult(k, Status.SUCCESS, metadata=process(item) or {})
                if manifest:
                    manifest.mark(k)
            except Exception as e:
                result = ItemResult(k, Status.FAILED, message=f"{type(e).__name__}: {e}")
                errors[k] = result.message
        result.seconds = time.monotonic() - start
        progress.add(result)
        if result.status is Status.FAILED and config.stop_on_failure:
            break
    c = progress.counts
    return Summary(name, len(items), c[Status.SUCCESS], c[Status.SKIPPED], c[Status.FAILED], time.monotonic() - began, progress.sums, errors)


def pending(items: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Items without a row in the manifest table."""
    return items.join(done.select(key).distinct(), key, "left_anti")


def stale(outputs: DataFrame, runs: DataFrame, key: str = "source") -> DataFrame:
    """Outputs whose source has a later version than the one they were made from."""
    newest = runs.groupBy(key).agg(F.max("version").alias("newest"))
    return outputs.join(newest, key).where(F.col("version") < F.col("newest"))


def manifest_summary(manifest: DataFrame) -> DataFrame:
    return manifest.groupBy("name").agg(
        F.count("*").alias("total"), *[F.count_if(F.col("status") == s.value).alias(s.value) for s in Status], F.sum("seconds").alias("seconds"), F.max("seconds").alias("slowest_s")
    )


def parallel_map(spark: SparkSession, function: Callable[[Any], Any], items: Sequence[Any], partitions: int | None = None) -> list[Any]:
    """``function`` of each item on the executors, results in the order of the items."""
    items = list(items)
    if not items:
        return []
    n = partitions or min(len(items), spark.sparkContext.defaultParallelism * 4)
    return spark.sparkContext.parallelize(items, n).map(function).collect()


def run_table(spark: SparkSession, items: DataFrame, name: str, out: str, process: Callable[[DataFrame], DataFrame], key: str, manifest: str) -> int:
    """Process what the manifest table lacks in one job, append it, then its keys; returns how many.

    The keys are written after the results, so a run that dies in between repeats its items:
    ``out`` gets a folder for each run, and a repeated run replaces the unfinished one.
    """
    try:
        done = spark.read.parquet(manifest).where(F.col("name") == name)
        run = done.agg(F.coalesce(F.max("run"), F.lit(0)) + 1).head()[0]
        todo = pending(items, done, key)
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e) and "UNABLE_TO_INFER_SCHEMA" not in str(e):
            raise
        run, todo = 1, items
    process(todo).write.mode("overwrite").parquet(f"{out}/run={run}")
    keys = todo.select(key).distinct().select(F.lit(name).alias("name"), F.lit(run).cast("long").alias("run"), key)
    n = keys.count()
    keys.write.mode("append").parquet(manifest)
    return n
