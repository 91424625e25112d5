"""Every registered query with its comparison SQL."""

from churnlake.catalog import business, modelling, quality, running, statistics, timelines  # noqa: F401
from churnlake.catalog.relations import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
