"""Climatologies by day of the year, scores out of sample, and ranking metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pyrelith.functions.scalar import circle_day


def season_window(days: DataFrame, half: int, col: str = "doy") -> DataFrame:
    """each row under every day of the 365-day circle within ``half`` of its own; a join by day replaces a range join."""
    around = F.sequence(F.lit(-half), F.lit(half))
    return days.withColumn("target", F.explode(F.transform(around, lambda k: F.pmod(F.col(col) - 1 + k, F.lit(365)) + 1)))


def climatology(positives: DataFrame, observed: DataFrame, half: int) -> DataFrame:
    """K5, K6: ``(cell, fold, doy, num, den, p)``: of the observed days in the window, the share with a positive in the cell.

    ``positives`` has ``(cell, date)``, ``observed`` has ``(date)``; a fold is a year that is left out. Without
    observed days p is 0. Cells and seasons without positives aren't listed: their p is 0.
    """
    years = observed.agg(F.array_sort(F.collect_set(F.year("date"))).alias("folds"))

    def without_own_year(rows: DataFrame, by: list[str], name: str) -> DataFrame:
        """Counts by season, and of each fold what is left of them without its own year; one row a season, not a row a day and year."""
        n = rows.groupBy(*by, "target", F.year("date").alias("y")).agg(F.count(F.lit(1)).alias("n"))
        n = n.groupBy(*by, "target").agg(F.sum("n").alias("all"), F.map_from_entries(F.collect_list(F.struct("y", "n"))).alias("own"))
        n = n.join(F.broadcast(years)).withColumn("fold", F.explode("folds"))
        left = F.col("all") - F.coalesce(F.col("own")[F.col("fold")], F.lit(0))
        return n.select(*by, "fold", "target", left.alias(name)).where(F.col(name) > 0)

    den = without_own_year(season_window(observed.select("date", circle_day("date").alias("doy")).distinct(), half), [], "den")
    seen = positives.join(observed, "date", "left_semi").select("cell", "date", circle_day("date").alias("doy")).distinct()
    num = without_own_year(season_window(seen, half), ["cell"], "num")
    return num.join(den, ["fold", "target"]).select("cell", "fold", F.col("target").alias("doy"), "num", "den", (F.col("num") / F.col("den")).alias("p"))


def scored_counts(positives: DataFrame, observed: DataFrame, half: int) -> DataFrame:
    """``(fold, p, positive, n, base)``: how many pairs of an observed day and a cell have which climatology of the other years, and their rate.

    The grid of days and cells is counted, never made: where a cell and season is listed in the climatology or has a positive, its days
    are a count; all else has p = 0 and no positive, and is what is left of days times cells. So the work follows the positives.
    """
    days = observed.select("date").distinct().groupBy(F.year("date").alias("fold"), circle_day("date").alias("doy")).agg(F.count(F.lit(1)).alias("d"))
    seen = positives.join(observed, "date", "left_semi").select("cell", "date").distinct()
    hits = seen.groupBy("cell", F.year("date").alias("fold"), circle_day("date").alias("doy")).agg(F.count(F.lit(1)).alias("k"))
    listed = climatology(positives, observed, half).select("cell", "fold", "doy", "p").join(hits, ["cell", "fold", "doy"], "full").join(days, ["fold", "doy"])
    listed = listed.groupBy("fold", F.coalesce("p", F.lit(0.0)).alias("p")).agg(F.sum(F.coalesce("k", F.lit(0))).alias("k"), F.sum("d").alias("d"))
    cells = seen.agg(F.countDistinct("cell").alias("cells"))
    # one row a year from here on
    years = days.groupBy("fold").agg(F.sum("d").alias("d")).join(hits.groupBy("fold").agg(F.sum("k").alias("k")), "fold", "left").join(F.broadcast(cells)).withColumn("k", F.coalesce("k", F.lit(0)))
    everything = years.agg(F.sum("d").alias("all_d"), F.sum("k").alias("all_k"))
    base = years.join(F.broadcast(everything)).select("fold", ((F.col("all_k") - F.col("k")) / (F.col("all_d") - F.col("d")) / F.col("cells")).alias("base"))
    none = years.join(listed.groupBy("fold").agg(F.sum("d").alias("done")), "fold", "left")
    none = none.select("fold", F.lit(0.0).alias("p"), F.lit(False).alias("positive"), (F.col("d") * F.col("cells") - F.coalesce("done", F.lit(0))).alias("n"))
    known = listed.select("fold", "p", F.explode(F.array(F.struct(F.lit(True).alias("positive"), F.col("k").alias("n")), F.struct(F.lit(False).alias("positive"), (F.col("d") - F.col("k")).alias("n")))).alias("r")).select("fold", "p", "r.*")
    rows = known.unionByName(none).where("n > 0").groupBy("fold", "p", "positive").agg(F.sum("n").alias("n"))
    return rows.join(base, "fold")


def average_precision(scored: DataFrame, by: list[str], score: str = "score", positive: str = "positive", weight: str | None = None) -> DataFrame:
    """K8: step-wise average precision with ties as one threshold, for each group; null without positives.

    Rows are summed to one a distinct score first, so the window sees scores, not rows.
    """
    n = F.sum(weight) if weight else F.count(F.lit(1))
    tp = F.sum(F.when(F.col(positive), F.col(weight) if weight else F.lit(1)).otherwise(F.lit(0)))
    g = scored.groupBy(*by, score).agg(n.alias("n"), tp.alias("tp"))
    w = Window.partitionBy(*by).orderBy(F.desc(score))
    g = g.withColumn("above", F.sum("n").over(w)).withColumn("hits", F.sum("tp").over(w))
    g = g.groupBy(*by).agg(F.sum(F.col("tp") * F.col("hits") / F.col("above")).alias("s"), F.sum("tp").alias("positives"), F.sum("n").alias("n"))
    return g.select(*by, "n", "positives", F.try_divide("s", "positives").alias("ap"))


def weighted_mean(x: Column, weight: str | None) -> Column:
    return F.avg(x) if weight is None else F.sum(x * F.col(weight)) / F.sum(weight)


def brier(scored: DataFrame, by: list[str], p: str = "p", reference: str = "base", positive: str = "positive", weight: str | None = None) -> DataFrame:
    """K7: Brier score, that of a constant rate, and the skill over it (null if that is 0); ``weight``: how often a row counts."""
    y = F.col(positive).cast("double")
    g = scored.groupBy(*by).agg(weighted_mean(F.pow(F.col(p) - y, 2), weight).alias("brier"), weighted_mean(F.pow(F.col(reference) - y, 2), weight).alias("reference"))
    return g.withColumn("skill", 1 - F.try_divide("brier", "reference"))


def reliability(scored: DataFrame, bins: list[float], p: str = "p", positive: str = "positive", weight: str | None = None) -> DataFrame:
    """Bins closed on the left, the last one on both sides; every bin is listed, an empty one with zeros."""
    spark = scored.sparkSession
    table = spark.createDataFrame([(i, float(lo), float(hi)) for i, (lo, hi) in enumerate(zip(bins[:-1], bins[1:], strict=True))], "bin int, low double, high double")
    at = F.lit(0)
    for i, lo in enumerate(bins[:-1]):
        at = F.when(F.col(p) >= lo, i).otherwise(at)
    g = scored.where(F.col(p).between(bins[0], bins[-1])).groupBy(at.alias("bin")).agg((F.sum(weight) if weight else F.count(F.lit(1))).alias("n"), weighted_mean(F.col(p), weight).alias("mean_p"), weighted_mean(F.col(positive).cast("double"), weight).alias("rate"))
    return table.join(g, "bin", "left").select("bin", "low", "high", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("mean_p", F.lit(0.0)).alias("mean_p"), F.coalesce("rate", F.lit(0.0)).alias("rate"))


def monthly_climatology(monthly: DataFrame, value: str = "v") -> DataFrame:
    """Each month against the same month of all years: mean, population and sample deviation, z, anomaly, rank from the lowest."""
    w = Window.partitionBy("cell", F.month("month"))
    out = monthly.withColumn("mean", F.avg(value).over(w)).withColumn("sd", F.stddev_pop(value).over(w)).withColumn("sd_samp", F.stddev_samp(value).over(w)).withColumn("years", F.count(value).over(w))
    out = out.withColumn("rank", F.rank().over(w.orderBy(value)))
    return out.withColumn("anomaly", F.col(value) - F.col("mean")).withColumn("z", F.try_divide("anomaly", "sd"))
