"""Table functions for SQL users."""

from __future__ import annotations

import math
from collections.abc import Iterator
from decimal import Decimal

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from rooftally.fixed_values import GRID_ID_FORMAT, WORLD_MAX_X, WORLD_MAX_Y, WORLD_MIN_X, WORLD_MIN_Y
from rooftally.functions.grid import checked_size


class CellsOf:
    """Canonical cells a box covers: ``SELECT * FROM cells_of(minx, miny, maxx, maxy, size)``, also LATERAL."""

    def eval(self, minx: float, miny: float, maxx: float, maxy: float, size: float) -> Iterator[tuple[str, int, int]]:
        step = checked_size(size)

        def first(value: float, origin: int) -> int:
            return max(0, math.floor((Decimal(str(value)) - origin) / step))

        def last(value: float, origin: int, end: int) -> int:
            return min(int((end - origin) / step), math.ceil((Decimal(str(value)) - origin) / step)) - 1

        for i in range(first(minx, WORLD_MIN_X), last(maxx, WORLD_MIN_X, WORLD_MAX_X) + 1):
            for j in range(first(miny, WORLD_MIN_Y), last(maxy, WORLD_MIN_Y, WORLD_MAX_Y) + 1):
                yield GRID_ID_FORMAT % (int(step * 100), i, j), i, j


def register(spark: SparkSession) -> None:
    """Make ``cells_of`` known to the session's SQL."""
    spark.udtf.register("cells_of", F.udtf(CellsOf, returnType="grid_id string, grid_i int, grid_j int"))
