"""Files in three tiers, with records that carry their hash."""

from __future__ import annotations

import hashlib
import os
import shutil
from dataclasses import dataclass
from datetime import UTC, datetime
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellweave.config import Tier
from cellweave.errors import StorageError


@dataclass(frozen=True)
class FileRecord:
    path: str
    tier: str
    size: int
    sha256: str
    registered: str


class Storage:
    """``root/bronze``, ``root/silver`` and ``root/gold``, each with categories below."""

    def __init__(self, root: str | Path):
        self.root = Path(root)
        for tier in Tier:
            (self.root / tier.value).mkdir(parents=True, exist_ok=True)

    def place(self, tier: Tier, *parts: str) -> Path:
        out = self.root.joinpath(Tier(tier).value, *parts)
        if not out.resolve().is_relative_to(self.root.resolve()):
            raise StorageError(f"{out} is outside of the storage")
        return out

    def ingest(self, source: str | Path, category: str = "", tier: Tier = Tier.BRONZE) -> Path:
        source = Path(source)
        if not source.is_file():
            raise StorageError(f"no file {source}")
        target = self.place(tier, category, source.name)
        target.parent.mkdir(parents=True, exist_ok=True)
        shutil.copy2(source, target)
        return target

    def tier_of(self, path: str | Path) -> Tier:
        try:
            return Tier(Path(path).resolve().relative_to(self.root.resolve()).parts[0])
        except (ValueError, IndexError) as e:
            raise StorageError(f"{path} is not in the storage") from e

    def promote(self, path: str | Path, target: Tier) -> Path:
        """A copy in another tier, which may also be a lower one."""
        path, now = Path(path), self.tier_of(path)
        if now == Tier(target):
            raise StorageError(f"{path} is in {now.value} already")
        if not path.is_file():
            raise StorageError(f"no file {path}")
        out = self.place(target, *path.resolve().relative_to(self.root.resolve()).parts[1:])
        out.parent.mkdir(parents=True, exist_ok=True)
        shutil.copy2(path, out)
        return out

    def files(self, tier: Tier, pattern: str = "*") -> list[Path]:
        return sorted(p for p in self.place(tier).rglob(pattern) if p.is_file())

    @staticmethod
    def file_hash(path: str | Path) -> str:
        with open(path, "rb") as f:
            return hashlib.file_digest(f, "sha256").hexdigest()

    def register(self, path: str | Path) -> FileRecord:
        path = Path(path)
        if not path.is_file():
            raise StorageError(f"no file {path}")
        return FileRecord(str(path), self.tier_of(path).value, os.path.getsize(path), self.file_hash(path), datetime.now(UTC).isoformat())


def file_records(spark: SparkSession, path: str) -> DataFrame:
    """Path, size and SHA-256 of all files under ``path``, read and hashed by the executors."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.select("path", F.col("length").alias("size"), F.sha2("content", 256).alias("sha256"), F.col("modificationTime").alias("modified"))
