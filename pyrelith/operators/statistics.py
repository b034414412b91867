"""Intervals, agreement, regression and rules over labelled samples."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pyrelith.operators.ordering import numbered, running_sums
from pyrelith.runtime import Scratch

Z = 1.96


def wilson(k: Column, n: Column, z: float = Z) -> tuple[Column, Column]:
    """Score interval of a proportion, cut to 0 and 1; (0, 0) without trials."""
    n = F.nullif(n, F.lit(0).cast("double"))
    p = k / n
    mid = (p + z * z / (2 * n)) / (1 + z * z / n)
    half = z * F.sqrt(p * (1 - p) / n + z * z / (4 * n * n)) / (1 + z * z / n)
    low, high = F.greatest(mid - half, F.lit(0.0)), F.least(mid + half, F.lit(1.0))
    return F.when(n.isNull(), 0.0).otherwise(low), F.when(n.isNull(), 0.0).otherwise(high)


def stratified_area(strata: DataFrame) -> DataFrame:
    """Proportion and area with their standard error from ``(area, k, n)`` a stratum; one stratum's variance needs two samples."""
    total = strata.agg(F.sum("area").alias("total"))
    s = strata.join(F.broadcast(total)).withColumn("w", F.col("area") / F.col("total")).withColumn("pi", F.coalesce(F.try_divide("k", "n"), F.lit(0.0)))
    var = F.when(F.col("n") > 1, F.col("w") * F.col("w") * F.col("pi") * (1 - F.col("pi")) / (F.col("n") - 1)).otherwise(0.0)
    g = s.groupBy("total").agg(F.sum(F.col("w") * F.col("pi")).alias("p"), F.sqrt(F.sum(var)).alias("se"))
    return g.select("p", "se", (F.col("total") * (F.col("p") - Z * F.col("se"))).alias("low"), (F.col("total") * (F.col("p") + Z * F.col("se"))).alias("high"))


def cohen_kappa(pairs: DataFrame, a: str, b: str, by: list[str]) -> DataFrame:
    """Agreement and kappa of two readers; 1 if chance agreement is complete, null without pairs. Rows with a null reading are no pairs."""
    both = pairs.where(F.col(a).isNotNull() & F.col(b).isNotNull())
    cells = both.groupBy(*by, a, b).agg(F.count(F.lit(1)).alias("n"))
    agree = cells.groupBy(*by).agg(F.sum("n").alias("n"), F.sum(F.when(F.col(a) == F.col(b), F.col("n")).otherwise(0)).alias("same"))
    margin = cells.select(*by, "n", F.explode(F.array(F.struct(F.lit(0).alias("side"), F.col(a).alias("v")), F.struct(F.lit(1).alias("side"), F.col(b).alias("v")))).alias("m"))
    margin = margin.groupBy(*by, "m.v").agg(F.sum(F.when(F.col("m.side") == 0, F.col("n")).otherwise(0)).alias("first"), F.sum(F.when(F.col("m.side") == 1, F.col("n")).otherwise(0)).alias("second"))
    chance = margin.groupBy(*by).agg(F.sum(F.col("first") * F.col("second")).alias("c"))
    j = agree.join(chance, by) if by else agree.crossJoin(chance)
    po, pe = F.col("same") / F.col("n"), F.col("c") / (F.col("n") * F.col("n"))
    return j.select(*by, "n", po.alias("agreement"), F.when(pe == 1, 1.0).otherwise(F.try_divide(po - pe, 1 - pe)).alias("kappa"))


def pearson(df: DataFrame, by: list[str], x: str, y: str) -> DataFrame:
    """Null with fewer than three pairs or a constant side."""
    d = df.where(F.col(x).isNotNull() & F.col(y).isNotNull())
    g = d.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.covar_pop(x, y).alias("c"), F.stddev_pop(x).alias("sx"), F.stddev_pop(y).alias("sy"))
    return g.select(*by, "n", F.when(F.col("n") >= 3, F.try_divide(F.col("c"), F.col("sx") * F.col("sy"))).alias("r"))


def line(df: DataFrame, by: list[str], x: str, y: str) -> DataFrame:
    """K12 with one predictor: slope and intercept from moments."""
    g = df.groupBy(*by).agg(F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"), F.regr_r2(y, x).alias("r2"))
    return g


def least_squares(df: DataFrame, by: list[str], xs: list[str], y: str) -> DataFrame:
    """Coefficients, leverage sum and leave-one-out errors by group, from a grouped numpy fold; constant predictors are dropped.

    A singular system gives null coefficients. Groups are months of one series, a few hundred rows.
    """

    def fit(g: pd.DataFrame) -> pd.DataFrame:
        g = g.dropna(subset=[*xs, y]).sort_values(xs)
        used = [c for c in xs if g[c].nunique() > 1]
        x = np.column_stack([np.ones(len(g)), *[g[c] for c in used]])
        out = {c: [g[c].iloc[0]] for c in by} if len(g) else {c: [None] for c in by}
        beta = hat = top = loo = None
        if len(g) > x.shape[1] and np.linalg.matrix_rank(x) == x.shape[1]:
            q, r = np.linalg.qr(x)
            beta = np.linalg.solve(r, q.T @ g[y].to_numpy())
            h = (q**2).sum(1)
            e = (g[y].to_numpy() - x @ beta) / np.maximum(1 - h, 1e-12)
            hat, top, loo = float(h.sum()), float(h.max()), float(np.sqrt((e**2).mean()))
        return pd.DataFrame(out | {"n": [len(g)], "beta": [None if beta is None else beta.tolist()], "trace": [hat], "top_leverage": [top], "loo_rmse": [loo]})

    kinds = ", ".join(f"{c} {df.schema[c].dataType.simpleString()}" for c in by)
    return df.select(*by, *xs, y).groupBy(*by).applyInPandas(fit, f"{kinds}, n long, beta array<double>, trace double, top_leverage double, loo_rmse double")


def counted_quantiles(counts: DataFrame, by: list[str], v: str, n: str, shares: dict[str, float]) -> DataFrame:
    """``(*by, names of shares)``: exact quantiles of each group's values ``v``, each there ``n`` times, between neighbours in proportion.

    All groups' values are put into one order by ranges, and places are running sums, so no task holds a group.
    """
    line = numbered(counts.select(*by, v, n), [*by, v], "__r").withColumn("__upto", F.col(n))
    line = Scratch(counts.sparkSession, "quantiles").table(running_sums(line, "__r", ["__upto"]), "line")
    size = line.groupBy(*by).agg(F.sum(n).alias("__size"), F.min(F.col("__upto") - F.col(n)).alias("__base"))
    j = line.join(size, by).withColumn("__to", F.col("__upto") - F.col("__base")).withColumn("__from", F.col("__to") - F.col(n))
    at = {c: (F.col("__size") - 1) * p for c, p in shares.items()}
    holds = lambda i: (F.col("__from") <= i) & (i < F.col("__to"))
    g = j.groupBy(*by).agg(*[F.max(F.when(holds(f(a)), F.col(v))).alias(f"__{c}_{k}") for c, a in at.items() for k, f in (("lo", F.floor), ("hi", F.ceil))], *[F.max(a).alias(f"__{c}_at") for c, a in at.items()])

    def between(c: str) -> Column:
        lo, hi, a = (F.col(f"__{c}_{k}") for k in ("lo", "hi", "at"))
        return F.when(lo == hi, lo).otherwise((F.ceil(a) - a) * lo + (a - F.floor(a)) * hi)

    return g.select(*by, *[between(c).alias(c) for c in shares])
