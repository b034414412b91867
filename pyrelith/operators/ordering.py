"""Running numbers over a total order without one task that sees all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pyrelith.runtime import Scratch


def numbered(df: DataFrame, order: list[str | Column], name: str = "number") -> DataFrame:
    """``df`` with the place of each row (from 1) in a total order.

    Rows are dealt to ranges and sorted there; a written copy fixes them. What comes before a range is a sum over one
    row a range. Rows that the order can't tell apart are numbered in any order.
    """
    scratch = Scratch(df.sparkSession, "numbered")
    cols = [F.col(c) if isinstance(c, str) else c for c in order]
    ranged = df.repartitionByRange(*cols).sortWithinPartitions(*cols).withColumn("__id", F.monotonically_increasing_id())
    ranged = scratch.table(ranged.withColumn("__range", F.shiftright("__id", 33)).withColumn("__place", F.col("__id").bitwiseAND((1 << 33) - 1)).drop("__id"), "ranges")
    before = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ranged.groupBy("__range").agg(F.count(F.lit(1)).alias("n")).select(F.col("__range").alias("__rk"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__before"))
    out = ranged.join(offsets, F.col("__range") == F.col("__rk"))
    return out.withColumn(name, F.col("__before") + F.col("__place") + 1).drop("__range", "__place", "__rk", "__before")


#: Numbers of one bucket of running sums.
BUCKET = 1 << 16


def running_sums(df: DataFrame, number: str, cols: list[str]) -> DataFrame:
    """``df`` with each of ``cols`` replaced by its sum up to and with the row, in order of dense whole numbers.

    Buckets of numbers are summed on their own; what comes before a bucket is a sum over one row a bucket.
    """
    b = df.withColumn("__bucket", F.floor(F.col(number) / BUCKET))
    whole = b.groupBy("__bucket").agg(*[F.sum(c).alias(f"__{c}") for c in cols])
    before = Window.orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    whole = whole.select(F.col("__bucket").alias("__bk"), *[F.coalesce(F.sum(f"__{c}").over(before), F.lit(0)).alias(f"__{c}") for c in cols])
    upto = Window.partitionBy("__bucket").orderBy(number).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    inner = b.withColumns({c: F.sum(c).over(upto) for c in cols})
    out = inner.join(whole, F.col("__bucket") == F.col("__bk")).withColumns({c: F.col(c) + F.col(f"__{c}") for c in cols})
    return out.select(*df.columns)
