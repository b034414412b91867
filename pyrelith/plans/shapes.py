"""Queries of polygons with parts and holes, their relations and overlay areas (survey A6, C16, D1, E32, J11, J12, J14, N16).

The shapes lie on whole numbers, so a twin can list the unit squares that each consists of and count them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pyrelith.operators import overlay
from pyrelith.operators import polygons as P
from pyrelith.plans.registry import query
from pyrelith.runtime import Scratch, spread

#: Squares, frames with a hole, frames with an island or a missing corner, pairs of columns; side 3 to 7, five units apart.
PLACES = "SELECT c_custkey AS id, c_nationkey AS nation, CAST(c_custkey % 30 * 5 AS INTEGER) AS x, CAST(floor(c_custkey / 30) * 5 AS INTEGER) AS y, CAST(3 + c_custkey * 7 % 5 AS INTEGER) AS l, CAST(floor(c_custkey / 2) % 4 AS INTEGER) AS kind FROM customer"
CELLS = f"""places AS ({PLACES}), sides AS (SELECT *, unnest(range(0, l)) AS i FROM places), grid AS (SELECT *, unnest(range(0, l)) AS j FROM sides),
  cells AS (SELECT id, nation, kind, l, x + i AS cx, y + j AS cy FROM grid WHERE CASE WHEN kind = 0 THEN true
    WHEN kind = 1 OR kind = 2 AND l >= 5 THEN i = 0 OR j = 0 OR i = l - 1 OR j = l - 1 OR kind = 2 AND i >= 2 AND j >= 2 AND i < l - 2 AND j < l - 2
    WHEN kind = 2 THEN i < l - 1 OR j < l - 1 ELSE i = 0 OR i = 2 END)"""


def places(customer: DataFrame) -> DataFrame:
    """Where each shape lies, in rows for all cores: a row is text, rings and edges further on."""
    return spread(customer.sparkSession.sql(PLACES.replace("customer", "{customer}"), customer=customer), "id")


def ring(w, s, e, n):
    """A box as a GeoJSON ring, its first point again at the end."""
    return F.array(*[F.array(x.cast("double"), y.cast("double")) for x, y in ((w, s), (e, s), (e, n), (w, n), (w, s))])


def features(customer: DataFrame) -> DataFrame:
    """The shapes as lines of GeoJSON text."""
    p = places(customer)
    x, y, l = (F.col(c) for c in ("x", "y", "l"))
    whole, hole, island = ring(x, y, x + l, y + l), ring(x + 1, y + 1, x + l - 1, y + l - 1), ring(x + 2, y + 2, x + l - 2, y + l - 2)
    notched = F.array(*[F.array(a.cast("double"), b.cast("double")) for a, b in ((x, y), (x + l, y), (x + l, y + l - 1), (x + l - 1, y + l - 1), (x + l - 1, y + l), (x, y + l), (x, y))])
    columns = F.array(F.array(ring(x, y, x + 1, y + l)), F.array(ring(x + 2, y, x + 3, y + l)))
    kind = F.col("kind")
    parts = F.when(kind == 0, F.array(F.array(whole))).when(kind == 1, F.array(F.array(whole, hole))).when((kind == 2) & (l >= 5), F.array(F.array(whole, hole), F.array(island))).when(kind == 2, F.array(F.array(notched))).otherwise(columns)
    coordinates = F.when(F.size(parts) == 1, F.to_json(parts[0])).otherwise(F.to_json(parts))
    name = F.when(F.size(parts) == 1, P.POLYGON).otherwise(P.MULTIPOLYGON)
    text = F.concat(F.lit('{"type":"Feature","properties":'), F.to_json(F.struct("id", "nation")), F.lit(',"geometry":{"type":"'), name, F.lit('","coordinates":'), coordinates, F.lit("}}"))
    return p.select(text.alias("value"))


def shapes(customer: DataFrame) -> DataFrame:
    """The shapes parsed from a written file of features."""
    s = P.parse_shapes(Scratch(customer.sparkSession, "features").table(features(customer), "features"))
    prop = lambda c: F.get_json_object("properties", f"$.{c}").cast("long").alias(c)
    return s.select(prop("id"), prop("nation"), "kind", "parts")


@query("customer", sql=f"""WITH {CELLS} SELECT id, CASE WHEN kind = 3 OR kind = 2 AND l >= 5 THEN 'MultiPolygon' ELSE 'Polygon' END AS kind,
    CAST(CASE WHEN kind = 3 OR kind = 2 AND l >= 5 THEN 2 ELSE 1 END AS BIGINT) AS parts, CAST(CASE WHEN kind = 1 OR kind = 2 AND l >= 5 THEN 1 ELSE 0 END AS BIGINT) AS holes,
    CAST(count(*) AS DOUBLE) AS area, CAST(min(cx) AS DOUBLE) AS w, CAST(max(cy) + 1 AS DOUBLE) AS n FROM cells GROUP BY ALL""")
def a6_multipolygon_scan(customer):
    """Polygons of several parts and holes from GeoJSON text: parts, holes, area, box."""
    s = shapes(customer)
    areas = P.shape_areas(s, "id").join(P.boxes(P.edge_rows(s, "id"), "id").select("id", "w", "n"), "id")
    return areas.join(s.select("id", "kind"), "id").select("id", "kind", "parts", "holes", "area", "w", "n")


@query("customer", "events", sql=f"""WITH {CELLS}, p AS (SELECT event_id, event_id * 13 % 1600 / 10.0e0 AS px, event_id * 29 % 2600 / 10.0e0 AS py FROM events)
    SELECT event_id, min(id) AS id, count(id) > 0 AS on_land FROM p LEFT JOIN cells ON px BETWEEN cx AND cx + 1 AND py BETWEEN cy AND cy + 1 GROUP BY event_id""")
def d1_points_in_multipolygons(customer, events):
    """Points in shapes with holes and islands, boundaries included; the first of several, null for none."""
    pts = events.select("event_id", (F.col("event_id") * 13 % 1600 / 10).alias("x"), (F.col("event_id") * 29 % 2600 / 10).alias("y"))
    s = shapes(customer)
    return P.assign_shapes(pts, P.edge_rows(s, "id"), s.select("id"), "event_id", "id", 8.0, "x", "y").select("event_id", "id", "on_land")


@query("customer", sql=f"""WITH {CELLS}, n AS (SELECT id, count(*) AS n FROM cells GROUP BY id),
  corners AS (SELECT DISTINCT id, cx + unnest([0, 0, 1, 1]) AS px, cy + unnest([0, 1, 0, 1]) AS py FROM cells),
  met AS (SELECT DISTINCT a.id AS a, b.id AS b FROM corners a JOIN corners b ON a.px = b.px AND a.py = b.py AND a.id < b.id),
  common AS (SELECT a.id AS a, b.id AS b, count(*) AS shared FROM cells a JOIN cells b ON a.cx = b.cx AND a.cy = b.cy AND a.id < b.id GROUP BY ALL)
  SELECT met.a, met.b, CASE WHEN shared IS NULL THEN 'touches' WHEN shared = p.n AND shared = q.n THEN 'equals' WHEN shared = q.n THEN 'contains'
    WHEN shared = p.n THEN 'within' ELSE 'overlaps' END AS relation, CAST(coalesce(shared, 0) AS DOUBLE) AS shared
    FROM met LEFT JOIN common ON common.a = met.a AND common.b = met.b JOIN n p ON p.id = met.a JOIN n q ON q.id = met.b""")
def j11_ring_relations(customer):
    """How shapes with holes and islands relate: which overlap, contain one another or only touch."""
    return P.relations(P.edge_rows(shapes(customer), "id"), "id", 8.0).withColumn("shared", F.round("shared", 6))


@query("customer", sql=f"""WITH {CELLS} SELECT DISTINCT gx AS cx, gy AS cy FROM (SELECT cx, cy, unnest([floor(cx / 1.5e0), floor((cx + 0.5e0) / 1.5e0)]) AS gx, unnest([0, 1]) AS one
    FROM cells WHERE id % 3 = 0) g JOIN LATERAL (SELECT unnest([floor(cy / 1.5e0), floor((cy + 0.5e0) / 1.5e0)]) AS gy) h ON true""")
def c16_land_cells(customer):
    """Grid cells that share area with land; one that only touches it isn't land."""
    edges = P.edge_rows(shapes(customer).where("id % 3 = 0"), "id")
    return P.overlapped_cells(edges, "id", 1.5).select(F.col("cx").cast("double").alias("cx"), F.col("cy").cast("double").alias("cy"))


@query("customer", sql=f"WITH {CELLS} SELECT nation, CAST(count(DISTINCT (cx, cy)) AS DOUBLE) AS area FROM cells GROUP BY nation")
def j12_union_areas(customer):
    """Shapes of one name as one, overlaps counted once."""
    s = shapes(customer).select(F.struct("nation", "id").alias("k"), "parts")
    e = P.edge_rows(s, "k").select("k.nation", F.col("k.id").alias("shape"), "x1", "y1", "x2", "y2")
    return overlay.union_areas(e, ["nation"]).withColumn("area", F.round("area", 6))


@query("customer", sql=f"""WITH {CELLS}, m AS (SELECT cx, cy, bit_or(CASE WHEN kind = 0 THEN 1 WHEN kind = 1 THEN 2 ELSE 4 END) AS mask FROM cells GROUP BY ALL)
  SELECT CAST(count(*) FILTER (WHERE mask & 5 = 5) AS DOUBLE) AS mapped, CAST(count(*) FILTER (WHERE mask & 6 = 6 AND mask & 1 = 0) AS DOUBLE) AS unmapped,
    CAST(count(*) FILTER (WHERE mask & 4 = 0) AS DOUBLE) AS left_out, CAST(count(*) FILTER (WHERE mask & 2 = 0) AS DOUBLE) AS outside FROM m""")
def n16_e32_strata_areas(customer):
    """Areas of strata: mapped ground on land, footprints on land that aren't mapped, and what lies beyond land or beyond footprints."""
    layer = F.when(F.col("kind") == 0, 1).when(F.col("kind") == 1, 2).otherwise(4)
    kinds = customer.sparkSession.sql(PLACES.replace("customer", "{customer}"), customer=customer).select("id", layer.alias("layer"))
    s = shapes(customer).drop("kind").join(kinds, "id").select(F.struct("layer", "id").alias("k"), "parts")
    e = P.edge_rows(s, "k").select(F.lit(0).alias("all"), "k.layer", F.col("k.id").alias("shape"), "x1", "y1", "x2", "y2")
    m = overlay.coverage(e, ["all"])
    has = lambda bit: F.col("mask").bitwiseAND(bit) == bit
    total = lambda c: F.round(F.coalesce(F.sum(F.when(c, F.col("area"))), F.lit(0.0)), 6)
    return m.agg(total(has(5)).alias("mapped"), total(has(6) & ~has(1)).alias("unmapped"), total(~has(4)).alias("left_out"), total(~has(2)).alias("outside"))


@query("customer", sql=f"""WITH p AS ({PLACES}), d AS (SELECT nation, id % 3 AS k, x + y AS u, x - y AS v, 2 + id % 4 AS r FROM p),
  a AS (SELECT *, u - r + unnest(range(0, 2 * r)) AS cu FROM d), c AS (SELECT *, v - r + unnest(range(0, 2 * r)) AS cv FROM a),
  m AS (SELECT nation, cu, cv, bit_or(CASE k WHEN 0 THEN 1 WHEN 1 THEN 2 ELSE 4 END) AS mask FROM c GROUP BY ALL)
  SELECT nation, CAST(mask AS BIGINT) AS mask, count(*) / 2.0e0 AS area FROM m GROUP BY ALL""")
def j12_overlay_of_slanted_shapes(customer):
    """Overlapping diamonds in three layers: the area under each combination; a twin counts squares of the turned plane."""
    p = places(customer)
    x, y, r = F.col("x").cast("double"), F.col("y").cast("double"), (2 + F.col("id") % 4).cast("double")
    parts = F.array(F.array(F.array(F.array(x + r, y), F.array(x, y + r), F.array(x - r, y), F.array(x, y - r))))
    s = p.select(F.struct("nation", "id").alias("k"), parts.alias("parts"))
    layer = F.when(F.col("k.id") % 3 == 0, 1).when(F.col("k.id") % 3 == 1, 2).otherwise(4)
    e = P.edge_rows(s, "k").select("k.nation", F.col("k.id").alias("shape"), layer.alias("layer"), "x1", "y1", "x2", "y2")
    return overlay.coverage(e, ["nation"]).withColumn("area", F.round("area", 6))
