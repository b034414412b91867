"""Queries of climatologies, weather, fire danger and series (survey sections E13-E18, F1-F6, K1-K12)."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from pyrelith.functions import fire_weather as W
from pyrelith.functions import scalar as S
from pyrelith.operators import climatology as C
from pyrelith.operators import fire_danger as D
from pyrelith.operators import statistics as T
from pyrelith.plans.registry import query
from pyrelith.runtime import Scratch

DOY = """extract(doy FROM {d})::INTEGER - CASE WHEN ((year({d}) % 4 = 0 AND year({d}) % 100 <> 0) OR year({d}) % 400 = 0) AND extract(doy
    FROM {d}) >= 60 THEN 1 ELSE 0 END"""
POS = f"""o AS (SELECT DISTINCT date_wit AS date, year(date_wit)::INTEGER AS y, {DOY.format(d='date_wit')} AS doy
    FROM v_hist WHERE satellite <> 'N21'), po AS (SELECT DISTINCT CAST(floor((longitude - 134.25) / 0.5) AS BIGINT) AS cell, date_wit AS date,
    year(date_wit)::INTEGER AS y, {DOY.format(d='date_wit')} AS doy FROM v_hist WHERE satellite = 'Terra' AND date_wit IN (SELECT date
    FROM o)),
  ys AS (SELECT DISTINCT y AS fold FROM o), den AS (SELECT fold, t AS doy, count(*) AS den FROM o JOIN ys ON y <> fold
    JOIN range(1, 366) AS r(t) ON least(abs(doy - t), 365 - abs(doy - t)) <= 15 GROUP BY ALL),
  num AS (SELECT cell, fold, t AS doy, count(*) AS num FROM po JOIN ys ON y <> fold JOIN range(1, 366) AS r(t) ON least(abs(doy - t),
    365 - abs(doy - t)) <= 15 GROUP BY ALL),
  cl AS (SELECT cell, fold, doy, num, den, num / den AS p FROM num JOIN den USING (fold, doy))"""


def cells(hist):
    return hist.withColumn("cell", F.floor((F.col("longitude") - 134.25) / 0.5)).withColumn("date", F.col("date_wit"))


def observed(hist):
    return hist.where("satellite <> 'N21'").select(F.col("date_wit").alias("date")).distinct()


def positives(hist):
    return cells(hist.where("satellite = 'Terra'")).select("cell", "date").distinct()


def climate(hist):
    return C.climatology(positives(hist), observed(hist), 15)


@query("v_hist", sql=f"WITH {POS} SELECT cell, fold, CAST(doy AS INTEGER) AS doy, num, den, round(p, 8) AS p FROM cl")
def k5_k6_climatology(hist):
    """Leave-one-year-out shares by cell and day of the year."""
    return climate(hist).select("cell", "fold", F.col("doy").cast("int").alias("doy"), "num", "den", F.round("p", 8).alias("p"))


SCORED = f"""WITH {POS}, ce AS (SELECT DISTINCT cell FROM po), g AS (SELECT ce.cell, o.y AS fold, o.date, o.doy, po.date IS NOT NULL AS positive
    FROM ce CROSS JOIN o LEFT JOIN po ON po.cell = ce.cell AND po.date = o.date), tr AS (SELECT fold, (SELECT count(*)
    FROM po WHERE y <> fold) / ((SELECT count(*) FROM o WHERE y <> fold) * (SELECT count(*) FROM ce)) AS base
    FROM ys), s AS (SELECT g.*, coalesce(cl.p, 0) AS p, base FROM g JOIN tr USING (fold) LEFT JOIN cl USING (cell, fold, doy))"""


def scored(hist):
    """How many observed days and cells have which climatology of the other years."""
    return Scratch(hist.sparkSession, "scored").table(C.scored_counts(positives(hist), observed(hist), 15), "counts")


@query("v_hist", sql=f"""{SCORED} SELECT fold, round(avg(pow(p - positive::INT, 2)), 8) AS brier, round(avg(pow(base - positive::INT,
    2)), 8) AS reference, round(1 - avg(pow(p - positive::INT, 2)) / avg(pow(base - positive::INT, 2)), 6) AS skill
    FROM s GROUP BY fold""")
def k7_brier_skill(hist):
    """Skill of the climatology over a constant rate, out of sample."""
    return C.brier(scored(hist), ["fold"], weight="n").select("fold", F.round("brier", 8).alias("brier"), F.round("reference", 8).alias("reference"), F.round("skill", 6).alias("skill"))


@query("v_hist", sql=f"""{SCORED}, t AS (SELECT fold, round(p, 10) AS p, count(*) AS n, sum(positive::INT) AS tp
    FROM s GROUP BY ALL), c AS (SELECT *, sum(n) OVER w AS above, sum(tp) OVER w AS hits FROM t WINDOW w AS (PARTITION BY fold
    ORDER BY p DESC)) SELECT fold, CAST(sum(n) AS BIGINT) AS n, CAST(sum(tp) AS BIGINT) AS positives, round(sum(tp * hits / above) / nullif(sum(tp),
    0), 8) AS ap FROM c GROUP BY fold""")
def k8_average_precision(hist):
    """K8: tie-aware average precision of each left-out year."""
    return C.average_precision(scored(hist).withColumn("p", F.round("p", 10)), ["fold"], "p", weight="n").withColumn("ap", F.round("ap", 8))


BINS = [0.0, 0.01, 0.05, 0.1, 0.25, 0.5, 1.0]


@query("v_hist", sql=f"""{SCORED}, b AS (SELECT unnest(range(0, 6))::INTEGER AS bin, unnest({BINS[:-1]}::DOUBLE[]) AS low, unnest({BINS[1:]}::DOUBLE[]) AS high)
    SELECT bin, low, high, count(p) AS n, round(coalesce(avg(p), 0), 8) AS mean_p, round(coalesce(avg(positive::INT), 0), 8) AS rate
    FROM b LEFT JOIN s ON p >= low AND (p < high OR (bin = 5 AND p <= high)) GROUP BY ALL""")
def e13_reliability(hist):
    """E13."""
    t = C.reliability(scored(hist), BINS, weight="n")
    return t.withColumns({c: F.round(c, 8) for c in ("mean_p", "rate")})


@query("v_wx", sql="""SELECT CAST(date_trunc('month', date) AS DATE) AS month, count(*) AS n, round(median(t_noon), 6) AS median,
    round(quantile_cont(t_noon, 0.9), 6) AS p90 FROM v_wx GROUP BY 1""")
def e14_monthly_table(wx):
    """Median and linear 90th percentile by month."""
    return wx.groupBy(S.month_start("date").alias("month")).agg(F.count(F.lit(1)).alias("n"), F.round(F.median("t_noon"), 6).alias("median"), F.round(F.percentile("t_noon", F.lit(0.9)), 6).alias("p90"))


@query("v_wx", sql="""WITH d AS (SELECT unnest(generate_series(min(date), max(date), INTERVAL 1 DAY))::DATE AS date
    FROM v_wx) SELECT d.date, round(avg(rain), 6) AS rain, count(cell) AS n_cells FROM d LEFT JOIN v_wx w ON w.date = d.date AND rh < 95
    GROUP BY d.date""")
def e15_k4_area_mean(wx):
    """Mean over the cells valid that day; null and 0 cells where none is."""
    days = wx.agg(F.min("date").alias("lo"), F.max("date").alias("hi")).select(F.explode(F.sequence("lo", "hi")).alias("date"))
    return days.join(wx.where("rh < 95"), "date", "left").groupBy("date").agg(F.round(F.avg("rain"), 6).alias("rain"), F.count("cell").alias("n_cells"))


MONTH = "m AS (SELECT cell, CAST(date_trunc('month', date) AS DATE) AS month, round(sum(rain), 4) AS v, max(date) AS last FROM v_wx GROUP BY ALL)"


def monthly(wx):
    return wx.groupBy("cell", S.month_start("date").alias("month")).agg(F.round(F.sum("rain"), 4).alias("v"), F.max("date").alias("last"))


@query("v_wx", sql=f"WITH {MONTH} SELECT cell, month, v, last = last_day(month) AS complete FROM m")
def e16_month_sums(wx):
    """Sums by month; a month is complete when its last day is there."""
    return monthly(wx).select("cell", "month", "v", (F.col("last") == F.last_day("month")).alias("complete"))


@query("v_wx", sql=f"""WITH {MONTH} SELECT cell, month, v, round(avg(v) OVER w, 6) AS mean, round(stddev_pop(v) OVER w, 6) AS sd, round(stddev_samp(v) OVER w,
    6) AS sd_samp, count(v) OVER w AS years, round(v - avg(v) OVER w, 6) AS anomaly, round((v - avg(v) OVER w) / nullif(stddev_pop(v) OVER w,
    0), 5) AS z, CAST(rank() OVER (PARTITION BY cell, month(month) ORDER BY v) AS INTEGER) AS rank FROM m WINDOW w AS (PARTITION BY cell,
    month(month))""")
def e17_e18_f6_month_climatology(wx):
    """A month against its own month of all years."""
    c = C.monthly_climatology(monthly(wx))
    return c.select("cell", "month", "v", *[F.round(x, 6).alias(x) for x in ("mean", "sd", "sd_samp")], "years", F.round("anomaly", 6).alias("anomaly"), F.round("z", 5).alias("z"), "rank")


@query("v_wx", sql="""WITH n AS (SELECT *, row_number() OVER (PARTITION BY cell ORDER BY date) AS n FROM v_wx), w AS (SELECT *, max(CASE
    WHEN rain >= 1 THEN n END) OVER (PARTITION BY cell ORDER BY date) AS wet FROM n) SELECT cell, date, CAST(n - wet AS INTEGER) AS since
    FROM w""")
def f1_days_since_rain(wx):
    """F1."""
    return D.days_since_rain(wx, 1.0).select("cell", "date", "since")


@query("v_wx", sql="""WITH r AS (SELECT *, date - CAST(row_number() OVER (PARTITION BY cell ORDER BY date) AS INTEGER) AS isl
    FROM v_wx), s AS (SELECT *, sum((rain <= 0)::INT) OVER (PARTITION BY cell, isl ORDER BY date) AS spell
    FROM r) SELECT cell, date, min(date) OVER (PARTITION BY cell, isl) AS run, round(sum(rain) OVER (PARTITION BY cell, isl, spell
    ORDER BY date), 4) AS wet_run FROM s""")
def f2_k3_runs(wx):
    """Runs of days without a gap; rain of the wet spell so far."""
    return D.wet_runs(D.runs(wx)).select("cell", "date", "run", F.round("wet_run", 4).alias("wet_run"))


FFMC = """(59.5 * (250 - {m}) / (147.2 + {m}))"""


@query("v_wx", sql="""WITH a AS (SELECT *, 101 - 85.0e0 AS x, least(rh, 99.9999e0) AS h, 147.2e0 * (101 - 85.0e0) / (59.5e0 + 85) AS m0
    FROM v_wx), b AS (SELECT *, least(CASE WHEN rain > 0.5 THEN m0 + 42.5e0 * (rain - 0.5) * exp(-100 / (251 - m0)) * (1 - exp(-6.93e0 / (rain - 0.5))) ELSE m0 END,
    250) AS m,
  0.942e0 * pow(h, 0.679e0) + 11 * exp((h - 100) / 10) + 0.18e0 * (21.1e0 - t_noon) * (1 - exp(-0.115e0 * h)) AS ed, 0.618e0 * pow(h,
    0.753e0) + 10 * exp((h - 100) / 10) + 0.18e0 * (21.1e0 - t_noon) * (1 - exp(-0.115e0 * h)) AS ew FROM a),
  c AS (SELECT *, CASE WHEN m < ed AND m < ew THEN ew - (ew - m) / pow(10, (0.424e0 * (1 - pow((100 - h) / 100, 1.7e0)) + 0.0694e0 * sqrt(wind) * (1 - pow((100 - h) / 100,
    8))) * 0.581e0 * exp(0.0365e0 * t_noon))
    WHEN m > ed THEN ed + (m - ed) / pow(10, (0.424e0 * (1 - pow(h / 100, 1.7e0)) + 0.0694e0 * sqrt(wind) * (1 - pow(h / 100,
    8))) * 0.581e0 * exp(0.0365e0 * t_noon)) ELSE m END AS wm FROM b),
  f AS (SELECT *, least(greatest(59.5e0 * (250 - wm) / (147.2e0 + wm), 0), 101) AS ffmc,
    greatest(CASE WHEN rain > 1.5 THEN greatest(43.43e0 * (5.6348e0 - ln(280 * exp(-0.023e0 * 6) + 1000 * (0.92e0 * rain - 1.27e0) / (48.77e0 + 100 / (0.5e0 + 0.3e0 * 6) * (0.92e0 * rain - 1.27e0)))),
    0) ELSE 6.0e0 END + 1.894e-4 * (greatest(t_noon, -1.1e0) + 1.1e0) * (100 - rh) * 9, 0) AS dmc,
    greatest(CASE WHEN rain > 2.8 THEN greatest(15 - 400 * ln(1 + 3.937e0 * (0.83e0 * rain - 1.27e0) / (800 * exp(-15.0e0 / 400))),
    0) ELSE 15.0e0 END + greatest((0.36e0 * (greatest(t_noon, -2.8e0) + 2.8e0) + 1.39e0) / 2, 0), 0) AS dc
    FROM c),
  i AS (SELECT *, 147.2e0 * (101 - ffmc) / (59.5e0 + ffmc) AS fm, 0.8e0 * dc * dmc / (dmc + 0.4e0 * dc) AS u
    FROM f),
  j AS (SELECT *, 0.208e0 * exp(0.05039e0 * wind) * 91.9e0 * exp(-0.1386e0 * fm) * (1 + pow(fm, 5.31e0) / 4.93e7) AS isi, CASE
    WHEN u < dmc THEN greatest(dmc - (0.92e0 + pow(0.0114e0 * dmc, 1.7e0)) * (dmc - u) / dmc, 0) ELSE u END AS bui
    FROM i),
  k AS (SELECT *, 0.1e0 * isi * CASE WHEN bui > 80 THEN 1000 / (25 + 108.64e0 * exp(-0.023e0 * bui)) ELSE 0.626e0 * pow(bui, 0.809e0) + 2 END AS bb
    FROM j)
  SELECT cell, date, round(ffmc, 3) AS ffmc, round(dmc, 3) AS dmc, round(dc, 3) AS dc, round(isi, 3) AS isi, round(bui, 3) AS bui,
    round(CASE WHEN bb > 1 THEN exp(2.72e0 * pow(0.434e0 * ln(bb), 0.647e0)) ELSE bb END, 3) AS fwi FROM k""")
def k1_fwi_step(wx):
    """K1: one day's codes from the start codes."""
    a = [F.col(c) for c in ("t_noon", "rh", "wind", "rain")]
    d = wx.withColumn("f", W.ffmc_step(F.lit(85.0), *a)).withColumn("m", W.dmc_step(F.lit(6.0), a[0], a[1], a[3], 9.0)).withColumn("c", W.dc_step(F.lit(15.0), a[0], a[3], 1.39))
    d = d.withColumn("i", W.isi(F.col("f"), a[2])).withColumn("b", W.bui(F.col("m"), F.col("c"))).withColumn("w", W.fwi(F.col("i"), F.col("b")))
    return d.select("cell", "date", *[F.round(x, 3).alias(n) for x, n in (("f", "ffmc"), ("m", "dmc"), ("c", "dc"), ("i", "isi"), ("b", "bui"), ("w", "fwi"))])


KBDI = f"(203.2e0 - greatest(q - net, 0)) * (0.968e0 * exp(0.0875e0 * t_max + 1.5552e0) - 8.3e0) / {1 + 10.88 * math.exp(-0.001736 * 2500)!r} * 1e-3"


@query("v_wx", sql=f"""WITH RECURSIVE r AS (SELECT *, date - CAST(row_number() OVER (PARTITION BY cell ORDER BY date) AS INTEGER) AS isl
    FROM v_wx), s AS (SELECT *, sum((rain <= 0)::INT) OVER (PARTITION BY cell, isl ORDER BY date) AS spell
    FROM r), w AS (SELECT cell, date, isl, t_max, rain, sum(rain) OVER (PARTITION BY cell, isl, spell ORDER BY date) AS run
    FROM s),
  n AS (SELECT cell, isl, date, t_max, greatest(run - 5.08e0, 0) - greatest(run - rain - 5.08e0, 0) AS net, row_number() OVER (PARTITION BY cell,
    isl ORDER BY date) AS k FROM w),
  q AS (SELECT cell, isl, date, k, least(greatest(0.0e0 - net, 0) + greatest({KBDI.replace('q - net', '0.0e0 - net')}, 0), 203.2e0) AS q
    FROM n WHERE k = 1 UNION ALL
    SELECT n.cell, n.isl, n.date, n.k, least(greatest(q.q - net, 0) + greatest({KBDI.replace('q - net', 'q.q - net')}, 0), 203.2e0)
    FROM q JOIN n ON n.cell = q.cell AND n.isl = q.isl AND n.k = q.k + 1)
  SELECT cell, date, round(q, 5) AS kbdi FROM q WHERE k > 5""")
def k2_kbdi_series(wx):
    """K2: the drought deficit of every cell and day."""
    return D.series(wx).select("cell", "date", F.round("kbdi", 5).alias("kbdi"))


#: One day of all codes from those of the day before (f0, d0, c0, q0), in stages of one SELECT each.
STAGES = f"""SELECT cell, isl, k, date, wind, least(greatest(59.5e0 * (250 - wm) / (147.2e0 + wm), 0), 101) AS f0, greatest(d1 + 1.894e-4 * (greatest(t_noon,
    -1.1e0) + 1.1e0) * (100 - rh) * 9, 0) AS d0,
  greatest(c1 + greatest((0.36e0 * (greatest(t_noon, -2.8e0) + 2.8e0) + 1.39e0) / 2, 0), 0) AS c0, least(greatest(q0 - net, 0) + greatest({KBDI.replace('q - net', 'q0 - net')},
    0), 203.2e0) AS q0 FROM (
  SELECT *, CASE WHEN m > ed THEN ed + (m - ed) / pow(10, (0.424e0 * (1 - pow(h / 100, 1.7e0)) + 0.0694e0 * sqrt(wind) * (1 - pow(h / 100,
    8))) * 0.581e0 * exp(0.0365e0 * t_noon))
    WHEN m < ew THEN ew - (ew - m) / pow(10, (0.424e0 * (1 - pow((100 - h) / 100, 1.7e0)) + 0.0694e0 * sqrt(wind) * (1 - pow((100 - h) / 100,
    8))) * 0.581e0 * exp(0.0365e0 * t_noon)) ELSE m END AS wm,
    CASE WHEN rain > 1.5 THEN greatest(43.43e0 * (5.6348e0 - ln(280 * exp(-0.023e0 * d0) + 1000 * (0.92e0 * rain - 1.27e0) / (48.77e0 + slope * (0.92e0 * rain - 1.27e0)))),
    0) ELSE d0 END AS d1,
    CASE WHEN rain > 2.8 THEN greatest(c0 - 400 * ln(1 + 3.937e0 * (0.83e0 * rain - 1.27e0) / (800 * exp(-c0 / 400))), 0) ELSE c0 END AS c1
    FROM (
  SELECT *, least(CASE WHEN rain > 0.5 THEN m0 + 42.5e0 * (rain - 0.5e0) * exp(-100 / (251 - m0)) * (1 - exp(-6.93e0 / (rain - 0.5e0))) + CASE
    WHEN m0 > 150 THEN 0.0015e0 * pow(m0 - 150, 2) * sqrt(rain - 0.5e0) ELSE 0 END ELSE m0 END, 250) AS m,
    0.942e0 * pow(h, 0.679e0) + 11 * exp((h - 100) / 10) + 0.18e0 * (21.1e0 - t_noon) * (1 - exp(-0.115e0 * h)) AS ed, 0.618e0 * pow(h,
    0.753e0) + 10 * exp((h - 100) / 10) + 0.18e0 * (21.1e0 - t_noon) * (1 - exp(-0.115e0 * h)) AS ew FROM (
  SELECT *, least(rh, 99.9999e0) AS h, 147.2e0 * (101 - f0) / (59.5e0 + f0) AS m0, CASE WHEN d0 <= 33 THEN 100 / (0.5e0 + 0.3e0 * d0)
    WHEN d0 <= 65 THEN 14 - 1.3e0 * ln(d0) ELSE 6.2e0 * ln(d0) - 17.2e0 END AS slope FROM (FROM_HERE))))"""
NET = """r AS (SELECT *, date - CAST(row_number() OVER (PARTITION BY cell ORDER BY date) AS INTEGER) AS isl FROM v_wx), s AS (SELECT *,
    sum((rain <= 0)::INT) OVER (PARTITION BY cell, isl ORDER BY date) AS spell FROM r),
  w AS (SELECT *, sum(rain) OVER (PARTITION BY cell, isl, spell ORDER BY date) AS run FROM s), n AS (SELECT cell, isl, date, t_noon,
    rh, wind, rain, t_max, greatest(run - 5.08e0, 0) - greatest(run - rain - 5.08e0, 0) AS net, row_number() OVER (PARTITION BY cell,
    isl ORDER BY date) AS k FROM w)"""
FWI_SERIES = f"""WITH RECURSIVE {NET}, c AS ({STAGES.replace("FROM_HERE", "SELECT *, 85.0e0 AS f0, 6.0e0 AS d0, 15.0e0 AS c0, 0.0e0 AS q0 FROM n WHERE k = 1")}
    UNION ALL {STAGES.replace("FROM_HERE", "SELECT n.*, c.f0, c.d0, c.c0, c.q0 FROM c JOIN n ON n.cell = c.cell AND n.isl = c.isl AND n.k = c.k + 1")}),
  i AS (SELECT *, 147.2e0 * (101 - f0) / (59.5e0 + f0) AS fm, 0.8e0 * c0 * d0 / (d0 + 0.4e0 * c0) AS u FROM c
    WHERE k > 5),
  j AS (SELECT *, 0.208e0 * exp(0.05039e0 * wind) * 91.9e0 * exp(-0.1386e0 * fm) * (1 + pow(fm, 5.31e0) / 4.93e7) AS isi, CASE
    WHEN u < d0 THEN greatest(d0 - (0.92e0 + pow(0.0114e0 * d0, 1.7e0)) * (d0 - u) / d0, 0) ELSE u END AS bui
    FROM i),
  b AS (SELECT *, 0.1e0 * isi * CASE WHEN bui > 80 THEN 1000 / (25 + 108.64e0 * exp(-0.023e0 * bui)) ELSE 0.626e0 * pow(bui, 0.809e0) + 2 END AS bb
    FROM j)
  SELECT cell, date, round(f0, 4) AS ffmc, round(d0, 4) AS dmc, round(c0, 4) AS dc, round(isi, 4) AS isi, round(bui, 4) AS bui,
    round(CASE WHEN bb > 1 THEN exp(2.72e0 * pow(0.434e0 * ln(bb), 0.647e0)) ELSE bb END, 4) AS fwi, round(q0, 4) AS kbdi
    FROM b"""


@query("v_wx", sql=FWI_SERIES)
def k1_k3_fwi_series(wx):
    """The codes of every cell and day, started again after each gap, listed after the spin-up."""
    return D.series(wx).select("cell", "date", *[F.round(c, 4).alias(c) for c in ("ffmc", "dmc", "dc", "isi", "bui", "fwi", "kbdi")])


@query("v_wx", "v_hist", sql="""WITH d AS (SELECT DISTINCT date_wit AS date FROM v_hist WHERE o_mark), x AS (SELECT year(w.date)::INTEGER AS fold,
    w.*, d.date IS NOT NULL AS positive FROM v_wx w LEFT JOIN d USING (date)),
  l AS (SELECT fold, positive, unnest(['t_noon', 'rh', 'wind']) AS index_name, unnest([t_noon, 100 - rh, wind]) AS score
    FROM x), t AS (SELECT fold, index_name, score, count(*) AS n, sum(positive::INT) AS tp FROM l GROUP BY ALL), c AS (SELECT *,
    sum(n) OVER w AS above, sum(tp) OVER w AS hits FROM t WINDOW w AS (PARTITION BY fold, index_name ORDER BY score DESC))
  SELECT fold, index_name, CAST(sum(n) AS BIGINT) AS n, CAST(sum(tp) AS BIGINT) AS positives, round(sum(tp * hits / above) / nullif(sum(tp),
    0), 7) AS ap FROM c GROUP BY ALL""".replace("o_mark", "satellite = 'N20' AND frp > 300"))
def k9_index_scores(wx, hist):
    """Average precision of several indices at once, by year."""
    pos = hist.where("satellite = 'N20' and frp > 300").select(F.col("date_wit").alias("date")).distinct().withColumn("positive", F.lit(True))
    x = wx.join(pos, "date", "left").withColumn("positive", F.coalesce("positive", F.lit(False))).withColumn("fold", F.year("date"))
    long = x.select("fold", "positive", F.explode(F.array(*[F.struct(F.lit(n).alias("index_name"), v.alias("score")) for n, v in (("t_noon", F.col("t_noon")), ("rh", 100 - F.col("rh")), ("wind", F.col("wind")))])).alias("s")).select("fold", "positive", "s.*")
    return C.average_precision(long, ["fold", "index_name"]).withColumn("ap", F.round("ap", 7))


@query("v_wx", "v_hist", sql="""WITH h AS (SELECT date_wit AS date, count(*) AS n FROM v_hist GROUP BY 1) SELECT w.cell, w.date, w.rain,
    coalesce(h.n, 0) AS detections FROM v_wx w LEFT JOIN h USING (date) WHERE w.date BETWEEN DATE '1998-08-10' AND DATE '1998-08-26'""")
def k10_focus_window(wx, hist):
    """A stretch of days with their counts."""
    h = hist.groupBy(F.col("date_wit").alias("date")).agg(F.count(F.lit(1)).alias("n"))
    return wx.where("date between DATE'1998-08-10' and DATE'1998-08-26'").join(h, "date", "left").select("cell", "date", "rain", F.coalesce("n", F.lit(0)).alias("detections"))


@query("v_wx", sql="""SELECT cell, count(*) AS n, round(corr(t_noon, rh), 6) AS r, round(regr_slope(rh, t_noon), 6) AS slope, round(regr_intercept(rh,
    t_noon), 5) AS intercept FROM v_wx GROUP BY cell""")
def k11_k12_correlation(wx):
    """Correlation and line by cell."""
    p, l = T.pearson(wx, ["cell"], "t_noon", "rh"), T.line(wx, ["cell"], "t_noon", "rh")
    return p.join(l, "cell").select("cell", "n", F.round("r", 6).alias("r"), F.round("slope", 6).alias("slope"), F.round("intercept", 5).alias("intercept"))


#: The normal equations of three centred predictors, solved by cofactors; leverage is 1/n and the centred quadratic form.
NORMAL = """WITH c AS (SELECT cell, count(*) AS n, avg(rh) AS a, avg(wind) AS b, avg(rain) AS c, avg(t_noon) AS y
    FROM v_wx GROUP BY cell), d AS (SELECT cell, n, a, b, c, y, rh - a AS u, wind - b AS v, rain - c AS w, t_noon - y AS z
    FROM v_wx JOIN c USING (cell)),
  s AS (SELECT cell, sum(u * u) AS uu, sum(u * v) AS uv, sum(u * w) AS uw, sum(v * v) AS vv, sum(v * w) AS vw, sum(w * w) AS ww,
    sum(u * z) AS uz, sum(v * z) AS vz, sum(w * z) AS wz FROM d GROUP BY cell),
  i AS (SELECT *, uu * (vv * ww - vw * vw) - uv * (uv * ww - vw * uw) + uw * (uv * vw - vv * uw) AS det FROM s),
  m AS (SELECT *, (vv * ww - vw * vw) / det AS p, (uw * vw - uv * ww) / det AS q, (uv * vw - uw * vv) / det AS r, (uu * ww - uw * uw) / det AS t,
    (uw * uv - uu * vw) / det AS o, (uu * vv - uv * uv) / det AS l FROM i),
  f AS (SELECT *, p * uz + q * vz + r * wz AS b1, q * uz + t * vz + o * wz AS b2, r * uz + o * vz + l * wz AS b3
    FROM m),
  e AS (SELECT d.*, b1, b2, b3, 1.0e0 / n + u * u * p + v * v * t + w * w * l + 2 * (u * v * q + u * w * r + v * w * o) AS h,
    z - b1 * u - b2 * v - b3 * w AS e FROM d JOIN f USING (cell))
  SELECT cell, n, round(max(y - b1 * a - b2 * b - b3 * c), 5) AS b0, round(max(b1), 6) AS b1, round(max(b2), 6) AS b2, round(max(b3),
    6) AS b3, round(sum(h), 6) AS trace, round(max(h), 6) AS top_leverage, round(sqrt(avg(pow(e / (1 - h), 2))), 6) AS loo_rmse
    FROM e GROUP BY cell, n"""


@query("v_wx", sql=NORMAL)
def k12_least_squares(wx):
    """Several predictors, leverage and leave-one-out error by cell."""
    f = T.least_squares(wx, ["cell"], ["rh", "wind", "rain"], "t_noon")
    return f.select("cell", "n", *[F.round(F.col("beta")[k], 5 if k == 0 else 6).alias(f"b{k}") for k in range(4)], *[F.round(c, 6).alias(c) for c in ("trace", "top_leverage", "loo_rmse")])


@query("v_wx", sql=f"""WITH {MONTH}, t AS (SELECT cell, CAST(date_trunc('month', date) AS DATE) AS month, round(avg(t_noon), 6) AS t
    FROM v_wx WHERE wind > 20 GROUP BY ALL) SELECT m.cell, m.month, m.v, t.t FROM m LEFT JOIN t USING (cell, month)""")
def d9_month_alignment(wx):
    """Two monthly series on one calendar; what one lacks is null."""
    t = wx.where("wind > 20").groupBy("cell", S.month_start("date").alias("month")).agg(F.round(F.avg("t_noon"), 6).alias("t"))
    return monthly(wx).select("cell", "month", "v").join(t, ["cell", "month"], "left")
