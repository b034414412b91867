"""Queries over labelled samples and classifiers (survey sections C8, D10-D19, E27-E34, K13-K20)."""

from __future__ import annotations

from pyspark.sql import functions as F

from pyrelith.operators import labels as L
from pyrelith.operators import statistics as T
from pyrelith.plans.registry import query


@query("v_lab", sql="""WITH c AS (SELECT stratum, sum(first_reader) AS k, count(*) AS n FROM v_lab GROUP BY stratum), p AS (SELECT *,
    k / n AS p FROM c)
  SELECT stratum, round(greatest((p + 3.8416e0 / (2 * n)) / (1 + 3.8416e0 / n) - 1.96e0 * sqrt(p * (1 - p) / n + 3.8416e0 / (4.0e0 * n * n)) / (1 + 3.8416e0 / n),
    0), 7) AS low, round(least((p + 3.8416e0 / (2 * n)) / (1 + 3.8416e0 / n) + 1.96e0 * sqrt(p * (1 - p) / n + 3.8416e0 / (4.0e0 * n * n)) / (1 + 3.8416e0 / n),
    1), 7) AS high FROM p""")
def k13_wilson(lab):
    c = lab.groupBy("stratum").agg(F.sum("first_reader").cast("double").alias("k"), F.count(F.lit(1)).cast("double").alias("n"))
    lo, hi = T.wilson(F.col("k"), F.col("n"))
    return c.select("stratum", F.round(lo, 7).alias("low"), F.round(hi, 7).alias("high"))


@query("v_lab", sql="""WITH s AS (SELECT stratum, sum(area_ha) AS area, sum(first_reader) AS k, count(*) AS n
    FROM v_lab GROUP BY stratum), t AS (SELECT sum(area) AS total FROM s), w AS (SELECT area / total AS w, k / n AS pi, n, total
    FROM s, t), g AS (SELECT total, sum(w * pi) AS p, sqrt(sum(CASE WHEN n > 1 THEN w * w * pi * (1 - pi) / (n - 1) ELSE 0 END)) AS se
    FROM w GROUP BY total)
  SELECT round(p, 7) AS p, round(se, 7) AS se, round(total * (p - 1.96e0 * se), 5) AS low, round(total * (p + 1.96e0 * se), 5) AS high
    FROM g""")
def k14_k15_stratified_area(lab):
    """Strata are those that samples were drawn in."""
    s = lab.groupBy("stratum").agg(F.sum("area_ha").alias("area"), F.sum("first_reader").alias("k"), F.count(F.lit(1)).alias("n"))
    return T.stratified_area(s).select(F.round("p", 7).alias("p"), F.round("se", 7).alias("se"), F.round("low", 5).alias("low"), F.round("high", 5).alias("high"))


@query("v_lab", sql="""WITH g AS (SELECT stratum, count(*) AS n, avg((first_reader = second_reader)::INT) AS po, avg(first_reader) * avg(second_reader) + (1 - avg(first_reader)) * (1 - avg(second_reader)) AS pe
    FROM v_lab GROUP BY stratum)
  SELECT stratum, n, round(po, 7) AS agreement, round(CASE WHEN pe > 1 - 1e-12 THEN 1 ELSE (po - pe) / (1 - pe) END, 6) + 0.0e0 AS kappa
    FROM g""")
def k16_d18_kappa(lab):
    """K16, D18."""
    return T.cohen_kappa(lab, "first_reader", "second_reader", ["stratum"]).select("stratum", "n", F.round("agreement", 7).alias("agreement"), F.round("kappa", 6).alias("kappa"))


@query("v_lab", sql="""WITH e AS (SELECT event, median(size) AS threshold FROM v_lab WHERE first_reader = 0 GROUP BY event)
    SELECT sample_id, (size > threshold)::INT AS predicted FROM v_lab LEFT JOIN e USING (event)""")
def k17_threshold_rule(lab):
    ref = lab.where("first_reader = 0").groupBy("event").agg(F.median("size").alias("threshold"))
    return L.threshold_rule(lab, "event", "size", ref).select("sample_id", "predicted")


@query("v_lab", sql="""WITH c AS (SELECT coalesce(stratum, 'all') AS stratum, count(*) AS n, sum((first_reader = 1 AND second_reader = 1)::INT) AS tp,
    sum((first_reader = 1 AND second_reader = 0)::INT) AS fp, sum((first_reader = 0 AND second_reader = 1)::INT) AS fn, sum((first_reader = 0 AND second_reader = 0)::INT) AS tn
    FROM v_lab GROUP BY GROUPING SETS ((), (stratum))),
  m AS (SELECT *, tp / nullif(tp + fp, 0) AS p, tp / nullif(tp + fn, 0) AS r, tn / nullif(tn + fp, 0) AS s
    FROM c) SELECT stratum, n, round(p, 6) AS precision, round(r, 6) AS recall, round(2 * p * r / nullif(p + r, 0), 6) AS f1, round((r + s) / 2,
    6) AS balanced_accuracy FROM m""")
def k20_metric_blocks(lab):
    return L.metric_blocks(lab, "second_reader", "first_reader", "stratum").select("stratum", "n", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1", "balanced_accuracy")])


@query("v_pix", sql="SELECT scene, valid AND isfinite(b12) AND tmf IN (0, 1) AS judged, count(*) AS n FROM v_pix GROUP BY ALL")
def c8_judged_rows(pix):
    """Rows kept for a model and rows that fall out, by scene."""
    t = L.model_table(pix.withColumn("label", F.when(F.col("valid"), F.col("tmf"))), "label")
    return t.groupBy("scene", "judged").agg(F.count(F.lit(1)).alias("n"))


@query("v_pix", sql="""WITH b AS (SELECT scene, x // 10 AS box, avg((dn > 1000)::INT) AS m, count(*) AS pixels
    FROM v_pix GROUP BY ALL) SELECT scene, box, (m > 0.5)::INT AS vote, (m = 0.5)::INT AS tie, pixels FROM b""")
def e27_majority_vote(pix):
    p = pix.withColumn("predicted", (F.col("dn") > 1000).cast("int")).withColumn("box", F.floor(F.col("x") / 10))
    return L.majority(p, ["scene", "box"])


@query("v_lab", sql="""SELECT stratum, event, first_reader, count(DISTINCT sample_id) AS n FROM v_lab GROUP BY GROUPING SETS ((first_reader),
    (stratum, first_reader), (event, first_reader))""")
def e28_label_counts(lab):
    c = [F.col(x) for x in ("stratum", "event", "first_reader")]
    return lab.dropDuplicates(["sample_id"]).groupingSets([[c[2]], [c[0], c[2]], [c[1], c[2]]], *c).agg(F.count(F.lit(1)).alias("n"))


@query("v_lab", sql="""SELECT 'unjudged' AS \"check\", count(*) FILTER (WHERE first_reader IS NULL) AS failing
    FROM v_lab UNION ALL SELECT 'unknown class', count(*) FILTER (WHERE first_reader NOT IN (0, 1)) FROM v_lab
    UNION ALL SELECT 'too small', count(*) FILTER (WHERE size < 200) FROM v_lab UNION ALL SELECT 'no stratum', count(*) FILTER (WHERE stratum IS NULL)
    FROM v_lab UNION ALL SELECT 'repeated id', count(*) FROM (SELECT sample_id FROM v_lab GROUP BY 1 HAVING count(*) > 1)""")
def j18_d11_quality_checks(lab):
    """J18, D11."""
    return L.quality_checks(lab)


@query("v_lab", sql="SELECT sample_id FROM v_lab l WHERE first_reader = 1 AND NOT EXISTS (SELECT 1 FROM v_lab m WHERE m.sample_id = l.sample_id AND m.second_reader = 1)")
def d11_anti_join(lab):
    """Samples that one reader marks and the other doesn't."""
    return lab.where("first_reader = 1").select("sample_id").join(lab.where("second_reader = 1").select("sample_id"), "sample_id", "left_anti")


@query("v_lab", sql="""SELECT stratum, round(sum(area_ha) FILTER (WHERE first_reader = 1), 4) AS mapped, count(*) FILTER (WHERE first_reader IS NULL) AS unmapped,
    count(*) FILTER (WHERE first_reader = 0) AS none FROM v_lab GROUP BY stratum""")
def e31_e32_mapped_area(lab):
    """Area by group; the unmapped are counted, not added."""
    return lab.groupBy("stratum").agg(F.round(F.sum(F.when(F.col("first_reader") == 1, F.col("area_ha"))), 4).alias("mapped"), F.count_if(F.col("first_reader").isNull()).alias("unmapped"), F.count_if(F.col("first_reader") == 0).alias("none"))


@query("v_lab", sql="""SELECT stratum, event, count(*) AS n, min(size) AS shortest, max(size) AS longest, string_agg(CAST(sample_id AS STRING),
    ',' ORDER BY size, sample_id) AS stops FROM v_lab GROUP BY ALL""")
def e33_ordered_groups(lab):
    """Groups with their members in order."""
    members = F.array_sort(F.collect_list(F.struct("size", "sample_id")))
    g = lab.groupBy("stratum", "event").agg(F.count(F.lit(1)).alias("n"), F.min("size").alias("shortest"), F.max("size").alias("longest"), members.alias("m"))
    return g.select("stratum", "event", "n", "shortest", "longest", F.array_join(F.col("m.sample_id").cast("array<string>"), ",").alias("stops"))


@query("v_lab", sql="""SELECT stratum || '-' || lpad(CAST(max(CAST(regexp_extract(CAST(sample_id AS STRING), '(\\d+)$', 1) AS INTEGER)) + 1 AS STRING),
    6, '0') AS next_id FROM v_lab GROUP BY stratum""")
def f11_next_id(lab):
    """the next number of each prefix."""
    n = F.max(F.regexp_extract(F.col("sample_id").cast("string"), r"(\d+)$", 1).cast("int")) + 1
    return lab.groupBy("stratum").agg(n.alias("n")).select(F.concat(F.col("stratum"), F.lit("-"), F.lpad(F.col("n").cast("string"), 6, "0")).alias("next_id"))


def modelled(pix):
    """Judged pixels of three events."""
    p = pix.where("valid").withColumn("label", (F.col("dn") + F.col("b12") * 1500 > 1600).cast("int"))
    return p.select("pixel_row", (F.col("scene") % 3).alias("event"), "label", *L.FEATURES)


@query("v_pix")
def k18_leave_one_event_out(pix):
    """Boosted trees, a forest and a depth-3 tree that never see the event they predict; metrics by model and event."""
    p = L.leave_one_out(modelled(pix), "event", "label", L.FEATURES, L.classifiers())
    return L.metric_blocks(p.withColumn("block", F.concat_ws(" / ", "model", F.col("event").cast("string"))), "label", "predicted", "block").where("block <> 'all'")


@query("v_pix")
def k19_permutation_importance(pix):
    """Loss of balanced accuracy when one feature is dealt anew, mean of ten repeats, for every feature, held-out event and two models."""
    models = {k: v for k, v in L.classifiers().items() if k != "tree of depth 3"}
    return L.permutation_importance(modelled(pix), "event", "label", L.FEATURES, "pixel_row", models)
