"""All queries over the driver's tables, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from voxelforge.plans import contracts, filtering, scalars, selection, spatial, state, validators  # noqa: F401  they register their queries
from voxelforge.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "flagship"]


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The keep-list of the map-level filter."""
    return filtering.map_filter_keep_list(spark, sf_dir)
