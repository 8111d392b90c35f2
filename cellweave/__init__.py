"""Cell analytics on Spark: features, rasters and metrics on a hierarchical cell grid."""

__version__ = "0.1.0"
