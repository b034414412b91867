"""Detections, districts, weather and the like, made by arithmetic from the star-schema tables.

The definitions are one text for Spark and DuckDB (``{NTZ}`` is the only difference), because they are the
inputs of the queries, not what the queries test.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = "region nation customer supplier part orders lineitem events documents labels".split()

VIEWS = {
    "v_det": """SELECT event_id AS detection_id, ts AS datetime_utc, CAST(ts + INTERVAL '9' HOUR AS DATE) AS date_wit,
      CASE event_type WHEN 'click' THEN 'N' WHEN 'view' THEN 'N20' WHEN 'purchase' THEN 'N21' WHEN 'signup' THEN 'Terra' ELSE 'Aqua' END AS satellite,
      CASE WHEN event_type IN ('click', 'view', 'purchase') THEN 'VIIRS' ELSE 'MODIS' END AS instrument,
      CASE WHEN event_type IN ('click', 'view', 'purchase') THEN CASE event_id % 3 WHEN 0 THEN 'l' WHEN 1 THEN 'n' ELSE 'h' END ELSE CAST(event_id % 101 AS STRING) END AS confidence,
      CASE WHEN event_id % 97 = 0 THEN NULL ELSE value END AS frp,
      134.25e0 + (user_id % 50) * 0.05e0 + (event_id % 7) * 0.001e0 AS longitude,
      -1.39e0 + floor(user_id / 50) * 0.05e0 + (event_id % 5) * 0.001e0 AS latitude FROM events""",
    "v_hist": """SELECT o_orderkey AS detection_id, o_orderdate + ((o_orderkey * 37) % 1440) * INTERVAL '1' MINUTE AS datetime_utc,
      CAST(o_orderdate + ((o_orderkey * 37) % 1440 + 540) * INTERVAL '1' MINUTE AS DATE) AS date_wit,
      CASE o_orderkey % 4 WHEN 0 THEN 'N' WHEN 1 THEN 'N20' WHEN 2 THEN 'N21' ELSE 'Terra' END AS satellite,
      o_totalprice / 1000 AS frp, o_orderkey % 11 <> 0 AS on_land,
      134.25e0 + (o_custkey % 40) * 0.05e0 + (o_orderkey % 3) * 0.001e0 AS longitude,
      -1.39e0 + floor((o_custkey % 200) / 40) * 0.05e0 + (o_orderkey % 2) * 0.001e0 AS latitude FROM orders""",
    "v_adm": """SELECT n_nationkey AS adm_id, n_name AS distrik, r_name AS kabupaten, n_nationkey % 3 = 0 AS notched,
      134.25e0 + (n_nationkey % 5) * 0.5e0 AS w, 134.25e0 + (n_nationkey % 5) * 0.5e0 + 0.45e0 AS e,
      -1.39e0 + floor(n_nationkey / 5) * 0.05e0 AS s, -1.39e0 + floor(n_nationkey / 5) * 0.05e0 + 0.045e0 AS n FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "v_day": "SELECT DISTINCT CAST(ts AS DATE) AS day FROM events",
    "v_src": "SELECT * FROM (VALUES (0, 'VIIRS_SNPP', 'N'), (1, 'VIIRS_NOAA20', 'N20'), (2, 'VIIRS_NOAA21', 'N21'), (3, 'MODIS', 'Terra')) AS t(src_ix, source, satellite)",
    "v_man": """SELECT source, day AS chunk_start, 1 + (ix * 3 + src_ix) % 5 AS days,
      CASE (ix * 7 + src_ix) % 11 WHEN 0 THEN 'failed' WHEN 1 THEN 'unavailable' WHEN 2 THEN 'cached' ELSE 'fetched' END AS outcome,
      CAST(day AS {NTZ}) + CASE WHEN (ix + src_ix) % 2 = 0 THEN INTERVAL '40' HOUR ELSE INTERVAL '10' HOUR END AS utc
      FROM (SELECT day, CAST(EXTRACT(DOY FROM day) AS INTEGER) AS ix FROM v_day) d CROSS JOIN v_src WHERE (ix * 5 + src_ix) % 13 <> 0""",
    "v_wx": """SELECT l_suppkey % 6 AS cell, CAST(l_shipdate AS DATE) AS date, 22 + (CAST(sum(l_partkey) AS BIGINT) % 120) / 10.0e0 AS t_noon,
      40 + (CAST(sum(l_orderkey) AS BIGINT) % 600) / 10.0e0 AS rh, (CAST(sum(l_partkey * 7) AS BIGINT) % 300) / 10.0e0 AS wind,
      CASE WHEN CAST(sum(l_orderkey) AS BIGINT) % 3 = 0 THEN (CAST(sum(l_partkey) AS BIGINT) % 250) / 10.0e0 ELSE 0.0e0 END AS rain,
      24 + (CAST(sum(l_partkey) AS BIGINT) % 120) / 10.0e0 + (CAST(sum(l_linenumber) AS BIGINT) % 50) / 10.0e0 AS t_max FROM lineitem GROUP BY l_suppkey % 6, CAST(l_shipdate AS DATE)""",
    "v_obs": """SELECT event_id AS obs_id, ts AS valid_utc, CASE event_id % 9 WHEN 0 THEN 'M' WHEN 1 THEN '6.21' ELSE CAST(CAST(floor(value / 30) AS INTEGER) AS STRING) || '.25' END AS vsby,
      CASE event_id % 7 WHEN 0 THEN 'M' ELSE CAST((event_id * 37) % 360 AS STRING) END AS drct, CASE event_id % 11 WHEN 0 THEN 'M' WHEN 1 THEN '0.00' ELSE CAST(event_id % 25 AS STRING) END AS sknt,
      CASE event_id % 6 WHEN 0 THEN 'FU' WHEN 1 THEN 'FU HZ' WHEN 2 THEN 'HZ' WHEN 3 THEN 'XFUZ RA' WHEN 4 THEN NULL ELSE 'M' END AS wxcodes FROM events""",
    "v_pix": """SELECT l_orderkey * 8 + l_linenumber AS pixel_row, l_linenumber AS scene, l_partkey % 100 AS x, l_suppkey % 100 AS y, CAST(l_shipdate AS DATE) AS look_date,
      0.02e0 + l_discount AS b2, 0.03e0 + l_tax AS b3, 0.04e0 + l_discount / 2 AS b4, 0.05e0 + l_tax * 2 AS b6, 0.06e0 + l_quantity / 200 AS b7, l_quantity / 100 AS b8a,
      0.1e0 + l_tax + l_discount AS b11, 0.05e0 + l_quantity / 150 + l_tax AS b12, l_returnflag <> 'R' AS valid,
      CASE l_partkey % 9 WHEN 0 THEN 10 WHEN 1 THEN 20 WHEN 2 THEN 30 WHEN 3 THEN 40 WHEN 4 THEN 50 WHEN 5 THEN 60 WHEN 6 THEN 80 WHEN 7 THEN 90 ELSE 95 END AS worldcover,
      CAST(l_suppkey % 7 AS INTEGER) AS tmf, CAST(l_partkey % 9 AS INTEGER) AS dynamic, CAST(l_orderkey % 256 AS INTEGER) AS qa, CAST(l_orderkey % 12 AS INTEGER) AS scl, CAST(l_partkey * 3 % 2000 AS INTEGER) AS dn FROM lineitem""",
    "v_lab": """SELECT l.doc_id AS sample_id, quality AS first_reader, toxic AS second_reader, source AS stratum, lang AS event, 0.36e0 AS area_ha, n_chars AS size FROM labels l JOIN documents d ON l.doc_id = d.doc_id""",
}
NEEDS = {"v_man": ["v_day", "v_src"]}


def load(spark: SparkSession, sf_dir: str, *names: str) -> list[DataFrame]:
    """The named views over the tables of a folder, each planned from the files alone."""
    out = []
    for name in names:
        spec = VIEWS.get(name)
        if spec is None:
            out.append(spark.read.parquet(f"{sf_dir}/{name}.parquet"))
            continue
        chain = [*NEEDS.get(name, []), name]
        text = "WITH " + ", ".join(f"{n} AS ({VIEWS[n]})" for n in chain) + f" SELECT * FROM {name}"
        text = text.replace("{NTZ}", "TIMESTAMP_NTZ")
        tables = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in TABLES if any(f" {t}" in VIEWS[n] for n in chain)}
        for t in tables:
            for n in chain:
                text = text.replace(f"FROM {t}", "FROM {" + t + "}").replace(f"JOIN {t}", "JOIN {" + t + "}")
        out.append(spark.sql(text, **tables))
    return out


def oracle(sql: str, *names: str) -> str:
    """A DuckDB query whose first common table expressions are the named views."""
    chain = dict.fromkeys(n for name in names for n in [*NEEDS.get(name, []), name])
    head = ", ".join(f"{n} AS ({VIEWS[n]})" for n in chain).replace("{NTZ}", "TIMESTAMP")
    sql = sql.strip()
    if not head:
        return sql
    if sql.upper().startswith("WITH RECURSIVE "):
        return f"WITH RECURSIVE {head}, {sql[15:]}"
    return f"WITH {head}, {sql[5:]}" if sql.upper().startswith("WITH ") else f"WITH {head} {sql}"
