"""Errors of the engine, under one base."""


class CellweaveError(Exception):
    """Base of all errors raised here."""


class ConfigError(CellweaveError):
    """A setting is out of its range."""


class StorageError(CellweaveError):
    """A stored file or tier is missing or misused."""


class FormatError(CellweaveError):
    """An input's format is unknown or unreadable."""


class CellError(CellweaveError):
    """A cell id, resolution or aggregate over cells is wrong."""


class RasterError(CellweaveError):
    """Raster input is missing, empty or of the wrong shape."""


class ProjectionError(CellweaveError):
    """Coordinate systems differ or can't be converted."""


class GeometryError(CellweaveError):
    """A geometry can't be read or handled."""


class RunError(CellweaveError):
    """A batch run can't go on."""
