"""Series of fire-danger codes: runs of days without gaps, each folded in order."""

from __future__ import annotations

import math
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pyrelith.functions import fire_weather as W


@dataclass(frozen=True)
class Settings:
    ffmc: float = 85.0
    dmc: float = 6.0
    dc: float = 15.0
    day_length: float = 9.0
    dc_factor: float = 1.39
    interception: float = 5.08
    yearly_rain: float = 2500.0
    spin_up: int = 5


def runs(wx: DataFrame) -> DataFrame:
    """K3: days of a cell that follow one another have one ``run`` (its first day); a gap starts a new one."""
    island = F.date_sub("date", F.row_number().over(Window.partitionBy("cell").orderBy("date")))
    return wx.withColumn("island", island).withColumn("run", F.min("date").over(Window.partitionBy("cell", "island"))).drop("island")


def wet_runs(wx: DataFrame) -> DataFrame:
    """Rain of the run of wet days so far; a dry day ends it."""
    w = Window.partitionBy("cell", "run").orderBy("date")
    spell = wx.withColumn("spell", F.sum((F.col("rain") <= 0).cast("int")).over(w))
    return spell.withColumn("wet_run", F.sum("rain").over(Window.partitionBy("cell", "run", "spell").orderBy("date"))).drop("spell")


def one_day(d, ffmc: float, dmc: float, dc: float, q: float, s: Settings) -> tuple[float, ...]:
    """One step of all codes on plain numbers; functions.fire_weather has the same steps as column expressions."""
    rh, excess = min(d.rh, 99.9999), max(d.rain - 0.5, 1e-9)
    m = 147.2 * (101 - ffmc) / (59.5 + ffmc)
    if d.rain > 0.5:
        heavy = 0.0015 * (m - 150) ** 2 * math.sqrt(excess) if m > 150 else 0.0
        m += 42.5 * excess * math.exp(-100 / (251 - m)) * (1 - math.exp(-6.93 / excess)) + heavy
    m = min(m, 250.0)
    humid, cool = math.exp((rh - 100) / 10), 0.18 * (21.1 - d.t_noon) * (1 - math.exp(-0.115 * rh))
    dry_to, wet_to = 0.942 * rh**0.679 + 11 * humid + cool, 0.618 * rh**0.753 + 10 * humid + cool

    def slowness(h: float) -> float:
        k = 0.424 * (1 - h**1.7) + 0.0694 * math.sqrt(d.wind) * (1 - h**8)
        return 10 ** (-k * 0.581 * math.exp(0.0365 * d.t_noon))

    if m > dry_to:
        m = dry_to + (m - dry_to) * slowness(rh / 100)
    elif m < wet_to:
        m = wet_to - (wet_to - m) * slowness((100 - rh) / 100)
    ffmc = min(max(59.5 * (250 - m) / (147.2 + m), 0.0), 101.0)

    if d.rain > 1.5:
        p = max(dmc, 1e-9)
        slope = 100 / (0.5 + 0.3 * p) if p <= 33 else 14 - 1.3 * math.log(p) if p <= 65 else 6.2 * math.log(p) - 17.2
        net = 0.92 * d.rain - 1.27
        dmc = max(43.43 * (5.6348 - math.log(280 * math.exp(-0.023 * dmc) + 1000 * net / (48.77 + slope * net))), 0.0)
    dmc = max(dmc + 1.894e-4 * (max(d.t_noon, -1.1) + 1.1) * (100 - d.rh) * s.day_length, 0.0)

    if d.rain > 2.8:
        dc = max(dc - 400 * math.log(1 + 3.937 * (0.83 * d.rain - 1.27) / (800 * math.exp(-dc / 400))), 0.0)
    dc = max(dc + max((0.36 * (max(d.t_noon, -2.8) + 2.8) + s.dc_factor) / 2, 0.0), 0.0)

    q = max(q - (max(d.wet_run - s.interception, 0.0) - max(d.wet_run - d.rain - s.interception, 0.0)), 0.0)
    dq = (203.2 - q) * (0.968 * math.exp(0.0875 * d.t_max + 1.5552) - 8.3) / (1 + 10.88 * math.exp(-0.001736 * s.yearly_rain)) * 1e-3
    return ffmc, dmc, dc, min(q + max(dq, 0.0), 203.2)


def series(wx: DataFrame, s: Settings = Settings()) -> DataFrame:
    """K1-K3: the codes of every day that has run for more than ``spin_up`` days since its run began.

    Moisture codes are folded by run (a cell's days without a gap: at most the days of the archive), as each day
    needs the one before; what follows from a day's codes alone is left to column expressions.
    """

    def fold(g: pd.DataFrame) -> pd.DataFrame:
        ffmc, dmc, dc, q, out = s.ffmc, s.dmc, s.dc, 0.0, []
        for d in g.sort_values("date").itertuples():
            ffmc, dmc, dc, q = one_day(d, ffmc, dmc, dc, q, s)
            out.append((d.cell, d.run, d.date, d.wind, ffmc, dmc, dc, q))
        return pd.DataFrame(out[s.spin_up :], columns=["cell", "run", "date", "wind", "ffmc", "dmc", "dc", "kbdi"])

    codes = wet_runs(runs(wx)).groupBy("cell", "run").applyInPandas(fold, "cell long, run date, date date, wind double, ffmc double, dmc double, dc double, kbdi double")
    out = codes.withColumn("isi", W.isi(F.col("ffmc"), F.col("wind"))).withColumn("bui", W.bui(F.col("dmc"), F.col("dc")))
    return out.withColumn("fwi", W.fwi(F.col("isi"), F.col("bui"))).drop("wind")


def days_since_rain(rain: DataFrame, least: float) -> DataFrame:
    """rows since the last with enough rain; null before the first. Counted over rows, as days that are missing aren't in the input."""
    w = Window.partitionBy("cell").orderBy("date")
    n = F.row_number().over(w)
    return rain.withColumn("n", n).withColumn("wet", F.last(F.when(F.col("rain") >= least, F.col("n")), ignorenulls=True).over(w)).withColumn("since", F.col("n") - F.col("wet")).drop("n", "wet")
