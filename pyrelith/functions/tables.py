"""Table functions that SQL can call."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import SparkSession
from pyspark.sql.functions import udtf


@udtf(returnType="tile date, days int")
class TileRange:
    """M, L4: ``tile_range(start, days, step)``: forward tiles, the last one shorter."""

    def eval(self, start: date, days: int, step: int):
        for o in range(0, days, step):
            yield start + timedelta(days=o), min(step, days - o)


@udtf(returnType="x int, y int")
class TilesFor:
    """M, H30: ``tiles_for(x0, y0, x1, y1)``: all web tiles of a range."""

    def eval(self, x0: int, y0: int, x1: int, y1: int):
        for x in range(x0, x1 + 1):
            for y in range(y0, y1 + 1):
                yield x, y


def register(spark: SparkSession) -> None:
    spark.udtf.register("tile_range", TileRange)
    spark.udtf.register("tiles_for", TilesFor)
