"""All registered queries and their oracles."""

from rooftally.queries import index, jobs, multipart, plans, quality, regions, reports, spatial, tasks, tiling, upkeep  # noqa: F401
from rooftally.queries.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
