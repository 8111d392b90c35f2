"""Settings with ranges; environment variables with the prefix ``CELLWEAVE_`` override defaults."""

from __future__ import annotations

import os
from dataclasses import dataclass, field, fields
from enum import Enum
from pathlib import Path

from cellweave.errors import ConfigError


class Tier(str, Enum):
    BRONZE = "bronze"
    SILVER = "silver"
    GOLD = "gold"


class RasterKind(str, Enum):
    RGB = "rgb"
    RGBA = "rgba"
    DEM = "dem"
    CATEGORICAL = "categorical"
    CONTINUOUS = "continuous"
    MULTISPECTRAL = "multispectral"
    PANCHROMATIC = "panchromatic"
    UNKNOWN = "unknown"


class Quality(str, Enum):
    VISUALIZATION = "visualization"
    ANALYSIS = "analysis"
    ARCHIVE = "archive"


def _ranged(default, low=None, high=None):
    return field(default=default, metadata={"low": low, "high": high})


@dataclass
class _Checked:
    def __post_init__(self) -> None:
        for f in fields(self):
            if "low" not in f.metadata:
                continue
            value, low, high = getattr(self, f.name), f.metadata["low"], f.metadata["high"]
            if low is not None and value < low or high is not None and value > high:
                raise ConfigError(f"{f.name} = {value!r} is not within {low} and {high}")

    @classmethod
    def from_env(cls, prefix: str = "CELLWEAVE_", **given):
        values = {}
        for f in fields(cls):
            text = os.environ.get(prefix + f.name.upper())
            if text is not None and f.name not in given:
                kind = type(f.default) if isinstance(f.default, (bool, int, float)) else Quality if f.default in list(Quality) else str
                values[f.name] = text.lower() in ("1", "true", "yes") if kind is bool else kind(text)
        return cls(**(values | given))


@dataclass
class CogConfig(_Checked):
    quality: Quality = Quality.ANALYSIS
    blocksize: int = _ranged(512, 256, 2048)
    overview_level: int = _ranged(6, 0, 12)
    nodata: float | None = None
    max_memory_mb: int = 4096


@dataclass
class TilingConfig(_Checked):
    tile_size: int = _ranged(1024, 256, 4096)
    overlap: int = _ranged(0, 0, None)
    output_format: str = "tif"

    def __post_init__(self) -> None:
        super().__post_init__()
        if self.overlap >= self.tile_size:
            raise ConfigError("overlap must be smaller than tile_size")


def _workers() -> int:
    """Two cores stay free."""
    return max(1, (os.cpu_count() or 4) - 2)


@dataclass
class BatchConfig(_Checked):
    max_workers: int = field(default_factory=_workers, metadata={"low": 1, "high": 128})
    chunk_size: int = _ranged(1, 1, None)
    zone_chunk_size: int = _ranged(5000, 100, None)
    partitions: int = _ranged(200, 1, None)


@dataclass
class RunConfig(_Checked):
    dry_run: bool = False
    resume: bool = True
    stop_on_failure: bool = False
    skip_existing: bool = False
    checkpoint_path: str | None = None
    log_path: str | None = None
    status_interval: int = _ranged(50, 1, None)


@dataclass
class ThemeConfig(_Checked):
    base: str = ""
    release: str = ""
    resolution: int = _ranged(5, 0, 15)
    tile_degrees: float = _ranged(5.0, 0.1, 90.0)


@dataclass
class Settings(_Checked):
    base_dir: Path = field(default_factory=lambda: Path.home() / "geodata")
    bronze_dir: Path | None = None
    silver_dir: Path | None = None
    gold_dir: Path | None = None
    srid: int = 4326
    cog: CogConfig = field(default_factory=CogConfig)
    tiling: TilingConfig = field(default_factory=TilingConfig)
    batch: BatchConfig = field(default_factory=BatchConfig)
    run: RunConfig = field(default_factory=RunConfig)
    themes: ThemeConfig = field(default_factory=ThemeConfig)
    log_level: str = "INFO"

    def __post_init__(self) -> None:
        self.base_dir = Path(self.base_dir)
        for tier in Tier:
            given = getattr(self, f"{tier.value}_dir")
            setattr(self, f"{tier.value}_dir", Path(given) if given else self.base_dir / tier.value)
