"""Queries on joins, aggregates, numbering and sets."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from permaway.functions import geometry as G
from permaway.functions import tags as T
from permaway.operators import features as O
from permaway.operators import network as N
from permaway.operators import spatial as X
from permaway.plans import base as B
from permaway.sources import osm_tables as S
from permaway.sources.osm_tables import PRELUDE

QUERIES, SQL = {}, {}


def query(name: str, sql: str | None = None):
    def put(f):
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f

    return put


@query("j1_way_nodes", PRELUDE + "SELECT way_id, count(*)::BIGINT AS points, string_agg(node_id::VARCHAR, ',' ORDER BY pos) AS nodes, round(sum(x::DOUBLE), 0) AS sx FROM way_xy WHERE n >= 2 GROUP BY way_id")
def way_nodes(spark, d):
    l = O.way_lines(S.osm_way_node(spark, d), B.xy(spark, d))  # noqa: E741
    return l.select("way_id", F.size("nodes").cast("bigint").alias("points"), F.concat_ws(",", F.col("nodes").cast("array<string>")).alias("nodes"), F.round(F.aggregate("points", F.lit(0.0), lambda a, p: a + p["x"]), 0).alias("sx"))


@query("j2_relation_roles", PRELUDE + "SELECT rel_id, count(*) FILTER (role = 'outer') AS outers, count(*) FILTER (role = 'inner') AS inners, count(*) FILTER (role NOT IN ('outer', 'inner')) AS others FROM osm_relation_member JOIN osm_way ON way_id = member_ref GROUP BY rel_id")
def relation_roles(spark, d):
    m = S.osm_relation_member(spark, d).where("member_type = 'way'").join(S.osm_way(spark, d).select(F.col("way_id").alias("member_ref")), "member_ref")
    r = F.col("role")
    return m.groupBy("rel_id").agg(F.count_if(r == "outer").alias("outers"), F.count_if(r == "inner").alias("inners"), F.count_if(~r.isin("outer", "inner")).alias("others"))


@query("j3_waterway_members", PRELUDE + "SELECT m.rel_id, m.member_ref AS way_id FROM osm_relation_member m JOIN cls ON way_id = member_ref WHERE layer = 9")
def waterway_members(spark, d):
    f = B.features(spark, d).where("layer = 9").select(F.col("way_id").alias("member_ref"))
    return S.osm_relation_member(spark, d).join(f, "member_ref").select("rel_id", F.col("member_ref").alias("way_id"))


REFS = PRELUDE + ", r AS (SELECT rel_id, trim(unnest(string_split(t_ref, ';'))) AS ref FROM osm_relation WHERE t_route IN ('tracks', 'railway')), d AS (SELECT DISTINCT member_ref AS way_id, ref, try_cast(ref AS BIGINT) AS num FROM osm_relation_member JOIN r USING (rel_id) WHERE ref <> ''), lr AS (SELECT way_id, string_agg(ref, ';' ORDER BY num IS NULL, num, ref) AS line_ref FROM d GROUP BY way_id)"


@query("a3_line_refs", REFS + " SELECT * FROM lr")
def line_refs(spark, d):
    return B.refs(spark, d)


@query("j4_railway_line_refs", REFS + " SELECT way_id, line_ref FROM feature LEFT JOIN lr USING (way_id) WHERE layer = 1")
def railway_refs(spark, d):
    return B.features(spark, d).where("layer = 1").select("way_id").join(B.refs(spark, d), "way_id", "left")


USES = PRELUDE + ", uses AS (SELECT node_id, count(DISTINCT way_id) AS uses FROM osm_way_node JOIN cls USING (way_id) WHERE layer = 1 GROUP BY node_id)"


@query("a2_node_use", USES + " SELECT * FROM uses")
def node_use(spark, d):
    return B.railway_uses(spark, d)


@query("j5_junction_vertices", USES + " SELECT way_id, i::INT AS i, node_id FROM way_xy JOIN cls USING (way_id) JOIN uses USING (node_id) WHERE layer = 1 AND n >= 2 AND uses > 1")
def junctions(spark, d):
    v = B.features(spark, d).where("layer = 1").select("way_id", F.posexplode("nodes").alias("i", "node_id"))
    return v.join(B.railway_uses(spark, d).where("uses > 1"), "node_id").select("way_id", "i", "node_id")


TILES = PRELUDE + ", ft AS (SELECT way_id, layer, tag_val, n, unnest(generate_series(floor(min_x::DOUBLE / 10000)::BIGINT, floor(max_x::DOUBLE / 10000)::BIGINT)) AS gx, min_y, max_y FROM feature), tf AS (SELECT way_id, layer, tag_val, n, gx, unnest(generate_series(floor(min_y::DOUBLE / 10000)::BIGINT, floor(max_y::DOUBLE / 10000)::BIGINT)) AS gy FROM ft), tid AS (SELECT *, ((gx + 100000) + (gy + 100000)) * ((gx + 100000) + (gy + 100000) + 1) // 2 + (gy + 100000) AS tile_id FROM tf)"


@query("j6_tile_explode", TILES + " SELECT way_id, layer, tile_id FROM tid")
def tile_explode(spark, d):
    return O.on_tiles(B.features(spark, d).select("way_id", "layer", "box")).select("way_id", "layer", "tile_id")


@query("a6_tile_layer_counts", TILES + " SELECT tile_id, layer, count(*)::BIGINT AS features FROM tid GROUP BY tile_id, layer")
def tile_counts(spark, d):
    return tile_explode(spark, d).groupBy("tile_id", "layer").agg(F.count("*").alias("features"))


@query("a5_layer_mask", TILES + " SELECT tile_id, bit_or((1 << layer)::INT) AS mask FROM tid GROUP BY tile_id")
def layer_mask(spark, d):
    return tile_explode(spark, d).groupBy("tile_id").agg(F.bit_or(F.call_function("shiftleft", F.lit(1), F.col("layer"))).alias("mask"))


BOUNDS = PRELUDE + ", bounds AS (SELECT min(min_x) AS min_x, min(min_y) AS min_y, max(max_x) AS max_x, max(max_y) AS max_y FROM feature WHERE layer <> 12)"


@query("a4_global_bounds", BOUNDS + " SELECT round(min_x::DOUBLE, 1) AS min_x, round(min_y::DOUBLE, 1) AS min_y, round(max_x::DOUBLE, 1) AS max_x, round(max_y::DOUBLE, 1) AS max_y FROM bounds")
def bounds(spark, d):
    b = O.bounds_of(B.features(spark, d))
    return b.select(*[F.round(F.col(c).cast("double"), 1).alias(c) for c in b.columns])


GRID = BOUNDS + ", grid AS (SELECT gx, unnest(generate_series(floor(min_y::DOUBLE / 10000)::BIGINT, floor(max_y::DOUBLE / 10000)::BIGINT)) AS gy FROM (SELECT unnest(generate_series(floor(min_x::DOUBLE / 10000)::BIGINT, floor(max_x::DOUBLE / 10000)::BIGINT)) AS gx, min_y, max_y FROM bounds))"


@query("m12_tile_grid", GRID + " SELECT ((gx + 100000) + (gy + 100000)) * ((gx + 100000) + (gy + 100000) + 1) // 2 + (gy + 100000) AS tile_id, gx, gy, gx * 10000.0::DOUBLE AS min_x, gy * 10000.0::DOUBLE AS min_y FROM grid")
def tile_grid(spark, d):
    return O.tile_grid(O.bounds_of(B.features(spark, d))).select("tile_id", "gx", "gy", "min_x", "min_y")


@query("a7_tile_statistics", TILES + " SELECT layer, count(*)::BIGINT AS features, count(DISTINCT tile_id)::BIGINT AS tiles FROM tid GROUP BY layer")
def tile_statistics(spark, d):
    return tile_explode(spark, d).groupBy("layer").agg(F.count("*").alias("features"), F.count_distinct("tile_id").alias("tiles"))


@query("o6_busiest_tile", TILES + " SELECT tile_id, count(*)::BIGINT AS features FROM tid GROUP BY tile_id ORDER BY features DESC, tile_id LIMIT 1")
def busiest(spark, d):
    return tile_explode(spark, d).groupBy("tile_id").agg(F.count("*").alias("features")).orderBy(F.desc("features"), "tile_id").limit(1)


@query("j20_tiles_in_grid", TILES + " SELECT way_id, tile_id FROM tid WHERE tile_id IN (SELECT tile_id FROM tid WHERE layer = 1)")
def in_grid(spark, d):
    t = tile_explode(spark, d)
    return O.within_grid(t.select("way_id", "tile_id"), t.where("layer = 1"))


@query("a8_layer_totals", PRELUDE + "SELECT layer, count(*)::BIGINT AS features, sum(n)::BIGINT AS vertices FROM feature GROUP BY ROLLUP (layer)")
def layer_totals(spark, d):
    return B.features(spark, d).select("layer", F.size("points").alias("v")).rollup("layer").agg(F.count("*").alias("features"), F.sum("v").alias("vertices"))


@query("a9_layer_summary", PRELUDE + "SELECT layer, count(*)::BIGINT AS features FROM feature GROUP BY layer")
def layer_summary(spark, d):
    return B.features(spark, d).groupBy("layer").agg(F.count("*").alias("features"))


@query("o1_tiles_in_order", TILES + " SELECT tile_id, row_number() OVER (ORDER BY tile_id) - 1 AS place FROM (SELECT DISTINCT tile_id FROM tid)")
def tiles_in_order(spark, d):
    return O.numbered(tile_explode(spark, d).select("tile_id").distinct(), ["tile_id"], "place").select("tile_id", "place")


MAIN = USES + ", rail AS (SELECT way_id, tag_val, t_usage, t_maxspeed, i, n, node_id, x, y, uses > 1 AS jn, row_number() OVER (ORDER BY way_id, i) - 1 AS raw_id FROM way_xy JOIN cls USING (way_id) LEFT JOIN uses USING (node_id) WHERE layer = 1 AND n >= 2 AND tag_val = 'rail' AND t_usage <> 'industrial'), raw AS (SELECT *, i = 0 OR i = n - 1 AS is_end, coalesce(lead(x::DOUBLE) OVER w, x) - coalesce(lag(x::DOUBLE) OVER w, x) AS dx, coalesce(lead(y::DOUBLE) OVER w, y) - coalesce(lag(y::DOUBLE) OVER w, y) AS dy FROM rail WINDOW w AS (PARTITION BY way_id ORDER BY i)), vtx AS (SELECT *, CASE WHEN sqrt(dx*dx+dy*dy) > 0.001 THEN dx / sqrt(dx*dx+dy*dy) ELSE 1 END AS ux, CASE WHEN sqrt(dx*dx+dy*dy) > 0.001 THEN dy / sqrt(dx*dx+dy*dy) ELSE 0 END AS uy FROM raw)"


def raw(spark, d):
    return N.raw_vertices(B.mainline(spark, d), B.railway_uses(spark, d))


@query("w1_vertex_directions", MAIN + " SELECT raw_id, way_id, i::INT AS i, round(ux, 3) AS dir_x, round(uy, 3) AS dir_y FROM vtx")
def directions(spark, d):
    return raw(spark, d).select("raw_id", "way_id", "i", F.round("dir_x", 3).alias("dir_x"), F.round("dir_y", 3).alias("dir_y"))


@query("w2_j19_segments", MAIN + " SELECT row_number() OVER (ORDER BY way_id, i) AS segment_id, way_id, i::INT AS i FROM vtx WHERE i < n - 1")
def segments(spark, d):
    return raw(spark, d).where("segment_id is not null").select("segment_id", "way_id", "i")


@query("o2_railways_in_order", PRELUDE + "SELECT f.way_id, row_number() OVER (ORDER BY f.way_id, x, y) - 1 AS place FROM feature f JOIN way_xy w ON w.way_id = f.way_id AND w.i = 0 WHERE layer = 1")
def railways_in_order(spark, d):
    f = B.features(spark, d).where("layer = 1").select("way_id", F.get("points", F.lit(0)).alias("p"))
    return O.numbered(f.select("way_id", "p.x", "p.y"), ["way_id", "x", "y"], "place").select("way_id", "place")


PAIRS = MAIN + """, pr AS (SELECT least(a.raw_id, b.raw_id) AS a, greatest(a.raw_id, b.raw_id) AS b FROM vtx a JOIN vtx b ON abs(a.x - b.x) <= 10.5 AND abs(a.y - b.y) <= 10.5 AND a.raw_id <> b.raw_id
 WHERE (a.x::DOUBLE - b.x) * (a.x::DOUBLE - b.x) + (a.y::DOUBLE - b.y) * (a.y::DOUBLE - b.y) <= CASE WHEN b.raw_id < a.raw_id THEN 100 ELSE 6.25 END
 AND abs((b.x::DOUBLE - a.x) * -a.uy + (b.y::DOUBLE - a.y) * a.ux) <= 1 AND (a.raw_id < b.raw_id OR ((coalesce(a.jn, false) OR a.is_end) AND (coalesce(b.jn, false) OR b.is_end))))"""


@query("j8_j9_merge_pairs", PAIRS + " SELECT DISTINCT a, b FROM pr")
def pairs(spark, d):
    return N.merge_pairs(raw(spark, d))


POINTS = PRELUDE + ", st AS (SELECT node_id, x, y, t_railway, t_place, t_name FROM xy JOIN osm_node USING (node_id))"


@query("j10_j11_nearest_node", POINTS + ", s AS (SELECT * FROM st WHERE t_railway IN ('station', 'halt')), q AS (SELECT * FROM st WHERE t_railway IS NULL), c AS (SELECT s.node_id, q.node_id AS near, sqrt((s.x::DOUBLE - q.x) * (s.x::DOUBLE - q.x) + (s.y::DOUBLE - q.y) * (s.y::DOUBLE - q.y)) AS dist FROM s JOIN q ON abs(s.x - q.x) <= 801 AND abs(s.y - q.y) <= 801), b AS (SELECT node_id, near, dist, row_number() OVER (PARTITION BY node_id ORDER BY dist, near) AS r FROM c WHERE dist < 800) SELECT s.node_id, near, round(dist, 1) AS metres FROM s LEFT JOIN b ON b.node_id = s.node_id AND r = 1")
def nearest_node(spark, d):
    p = B.xy(spark, d)
    s = p.where("t_railway in ('station', 'halt')").select("node_id", F.col("x").alias("lx"), F.col("y").alias("ly"))
    q = p.where("t_railway is null").select(F.col("node_id").alias("near"), F.col("x").alias("rx"), F.col("y").alias("ry"))
    return X.nearest(s, "node_id", q, "near", 800.0).select("node_id", "near", F.round("distance", 1).alias("metres"))


@query("j17_nearest_other_station", POINTS + ", s AS (SELECT * FROM st WHERE t_railway IN ('station', 'halt')) SELECT a.node_id, round(min(sqrt((a.x::DOUBLE - b.x) * (a.x::DOUBLE - b.x) + (a.y::DOUBLE - b.y) * (a.y::DOUBLE - b.y))), 1) AS metres FROM s a JOIN s b ON a.node_id <> b.node_id GROUP BY a.node_id")
def nearest_other(spark, d):
    s = B.xy(spark, d).where("t_railway in ('station', 'halt')").select("node_id", "x", "y")
    return X.nearest_other(s, "node_id", 2000.0).select("node_id", F.round("distance", 1).alias("metres"))


@query("p16_p18_j14_places_in_rings", PRELUDE + ", ring AS (SELECT way_id, i, n, x::DOUBLE AS x, y::DOUBLE AS y, lag(x::DOUBLE) OVER w AS px, lag(y::DOUBLE) OVER w AS py FROM way_xy JOIN cls USING (way_id) WHERE layer = 3 WINDOW w AS (PARTITION BY way_id ORDER BY i)), e AS (SELECT r.way_id, r.x, r.y, coalesce(r.px, l.x) AS px, coalesce(r.py, l.y) AS py FROM ring r JOIN ring l ON l.way_id = r.way_id AND l.i = l.n - 1), p AS (SELECT node_id, x::DOUBLE + 300 AS x, y::DOUBLE + 200 AS y FROM xy JOIN osm_node USING (node_id) WHERE t_place IS NOT NULL), h AS (SELECT p.node_id, e.way_id, count(*) FILTER (p.x < (e.px - e.x) * (p.y - e.y) / (e.py - e.y) + e.x) AS c FROM p JOIN e ON (e.y > p.y) <> (e.py > p.y) GROUP BY p.node_id, e.way_id) SELECT node_id AS point_id, min(way_id) AS name FROM h WHERE c % 2 = 1 GROUP BY node_id")
def places_in_rings(spark, d):
    f = B.features(spark, d).where("layer = 3").select(F.col("way_id").alias("name"), F.col("points").alias("ring"), "box")
    p = B.xy(spark, d).where("t_place is not null").select(F.col("node_id").alias("point_id"), (F.col("x").cast("double") + 300).alias("x"), (F.col("y").cast("double") + 200).alias("y"))
    return X.in_polygons(p, f, F.col("name"))


@query("p17_j7_rings_in_rings")
def rings_in_rings(spark, d):
    """(inner, outer): buildings within bounding lakes by the vote of probes; tested on fixed rings."""
    f = B.features(spark, d)
    outer = O.on_tiles(f.where("layer = 3").select(F.col("way_id").alias("outer"), F.col("points").alias("ring"), F.col("box").alias("obox"), "box"))
    inner = O.on_tiles(f.where("layer = 2").select(F.col("way_id").alias("inner"), F.col("points").alias("hole"), "box"))
    j = inner.join(outer.select("tile_id", "outer", "ring", "obox"), "tile_id").where(G.boxes_overlap(F.col("box"), F.col("obox")))
    return j.where(G.ring_in_ring(F.col("hole"), F.col("ring"))).select("inner", "outer").distinct()


@query("a10_a14_first_by_key", PRELUDE + "SELECT t_place, round(x::DOUBLE / 5000) AS gx, min(node_id) AS node_id FROM xy JOIN osm_node USING (node_id) WHERE t_place IS NOT NULL GROUP BY ALL")
def first_by_key(spark, d):
    p = B.xy(spark, d).where("t_place is not null").select("t_place", F.round(F.col("x").cast("double") / 5000).alias("gx"), "node_id")
    return B.first_by(p, [F.col("t_place"), F.col("gx")], ["node_id"])


@query("w5_o3_station_numbers", POINTS + " SELECT row_number() OVER (ORDER BY node_id) - 1 AS station_id, node_id FROM st WHERE t_railway IN ('station', 'halt')")
def station_numbers(spark, d):
    p = B.xy(spark, d).where("t_railway in ('station', 'halt')").select("node_id", "x", "y")
    return O.numbered(p, ["node_id", "x", "y"], "station_id").select("station_id", "node_id")


@query("w6_two_nearest", POINTS + ", s AS (SELECT * FROM st WHERE t_place = 'city'), q AS (SELECT * FROM st WHERE t_railway = 'signal'), r AS (SELECT s.node_id AS city, q.node_id AS signal, row_number() OVER (PARTITION BY s.node_id ORDER BY (s.x::DOUBLE - q.x) * (s.x::DOUBLE - q.x) + (s.y::DOUBLE - q.y) * (s.y::DOUBLE - q.y), q.node_id) AS rank, sqrt((s.x::DOUBLE - q.x) * (s.x::DOUBLE - q.x) + (s.y::DOUBLE - q.y) * (s.y::DOUBLE - q.y)) AS dist FROM s JOIN q ON sqrt((s.x::DOUBLE - q.x) * (s.x::DOUBLE - q.x) + (s.y::DOUBLE - q.y) * (s.y::DOUBLE - q.y)) <= 6000) SELECT city, rank::INT AS rank, round(dist, 0) AS metres FROM r WHERE rank <= 2")
def two_nearest(spark, d):
    p = B.xy(spark, d)
    s = p.where("t_place = 'city'").select(F.col("node_id").alias("city"), F.col("x").alias("lx"), F.col("y").alias("ly"))
    q = p.where("t_railway = 'signal'").select(F.col("node_id").alias("signal"), F.col("x").alias("rx"), F.col("y").alias("ry"))
    return X.top_two(X.within(s, q, 6000.0, ["city", "signal"]), "city", ["distance", "signal"]).select("city", "rank", F.round("distance", 0).alias("metres"))


@query("o4_rings_by_area", PRELUDE + ", a AS (SELECT way_id, abs(sum(x::DOUBLE * ny - nx * y::DOUBLE) / 2) AS area FROM (SELECT way_id, x, y, coalesce(lead(x::DOUBLE) OVER w, first(x::DOUBLE) OVER w) AS nx, coalesce(lead(y::DOUBLE) OVER w, first(y::DOUBLE) OVER w) AS ny FROM way_xy JOIN cls USING (way_id) WHERE layer = 7 WINDOW w AS (PARTITION BY way_id ORDER BY i)) GROUP BY way_id) SELECT way_id, row_number() OVER (ORDER BY round(area) DESC, way_id) - 1 AS place FROM a")
def rings_by_area(spark, d):
    f = B.features(spark, d).where("layer = 7").select("way_id", (-F.round(F.abs("area"))).alias("neg"))
    return O.numbered(f, ["neg", "way_id"], "place").select("way_id", "place")


@query("o5_refs_numeric_first", "SELECT o_custkey AS id, string_agg(ref, ';' ORDER BY num IS NULL, num, ref) AS refs FROM (SELECT DISTINCT o_custkey, CASE WHEN o_orderkey % 3 = 0 THEN 'L' || (o_orderkey % 11) ELSE (o_orderkey % 17)::VARCHAR END AS ref, try_cast(CASE WHEN o_orderkey % 3 = 0 THEN 'L' || (o_orderkey % 11) ELSE (o_orderkey % 17)::VARCHAR END AS BIGINT) AS num FROM orders) GROUP BY o_custkey")
def refs_numeric_first(spark, d):
    o = S.table(spark, d, "orders").selectExpr("o_custkey", "CASE WHEN o_orderkey % 3 = 0 THEN concat('L', o_orderkey % 11) ELSE cast(o_orderkey % 17 AS string) END AS t_ref", "'railway' AS t_route", "'way' AS member_type")
    rel = o.select("t_ref", "t_route").distinct().withColumn("rel_id", F.col("t_ref"))
    mem = o.select(F.col("t_ref").alias("rel_id"), F.col("o_custkey").alias("member_ref"), "member_type")
    return O.line_refs(rel, mem).select(F.col("way_id").alias("id"), F.col("line_ref").alias("refs"))


@query("o7_sorted_layer_keys", TILES + " SELECT tile_id, string_agg(DISTINCT layer::VARCHAR, ',' ORDER BY layer::VARCHAR) AS layers FROM tid GROUP BY tile_id")
def layer_keys(spark, d):
    return tile_explode(spark, d).groupBy("tile_id").agg(F.array_sort(F.collect_set(F.col("layer").cast("string"))).alias("l")).select("tile_id", F.concat_ws(",", "l").alias("layers"))


@query("o9_vertex_cap", PRELUDE + "SELECT way_id, layer FROM (SELECT way_id, layer, sum(n) OVER (PARTITION BY layer ORDER BY n DESC, way_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS s FROM feature) WHERE s <= 300")
def vertex_cap(spark, d):
    """The largest features of each layer whose vertices stay under a limit, which is the operator."""
    f = B.features(spark, d).select("way_id", "layer", F.size("points").alias("v"))
    w = Window.partitionBy("layer").orderBy(F.desc("v"), "way_id").rowsBetween(Window.unboundedPreceding, 0)
    return f.withColumn("s", F.sum("v").over(w)).where("s <= 300").select("way_id", "layer")


@query("u1_layer_union", PRELUDE + "SELECT layer, way_id AS id FROM feature UNION ALL SELECT CASE WHEN t_railway IS NOT NULL THEN 8 ELSE 11 END, node_id FROM osm_node WHERE t_railway IS NOT NULL OR t_place IS NOT NULL")
def layer_union(spark, d):
    n = S.osm_node(spark, d).where("t_railway is not null or t_place is not null")
    return B.features(spark, d).select("layer", F.col("way_id").alias("id")).unionByName(n.select(F.when(F.col("t_railway").isNotNull(), 8).otherwise(11).alias("layer"), F.col("node_id").alias("id")))


@query("u2_a20_line_set_union", REFS + " SELECT node_id, string_agg(DISTINCT ref, ';' ORDER BY ref) AS lines FROM osm_way_node JOIN d USING (way_id) GROUP BY node_id")
def line_sets(spark, d):
    r = B.refs(spark, d).select("way_id", F.split("line_ref", ";").alias("r"))
    j = S.osm_way_node(spark, d).join(r, "way_id").groupBy("node_id").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_set("r")))).alias("l"))
    return j.select("node_id", F.concat_ws(";", "l").alias("lines"))


@query("u3_a22_interned_strings", PRELUDE + "SELECT s, row_number() OVER (ORDER BY s) - 1 AS idx FROM (SELECT tag_key AS s FROM osm_way UNION SELECT tag_val FROM osm_way UNION SELECT t_usage FROM osm_way UNION SELECT t_maxspeed FROM osm_way) WHERE s IS NOT NULL")
def interned(spark, d):
    w = S.osm_way(spark, d).select(F.explode(F.array("tag_key", "tag_val", "t_usage", "t_maxspeed")).alias("s")).where("s is not null").distinct()
    return O.numbered(w, ["s"], "idx").select("s", "idx")


@query("u4_j21_multiset_difference", PRELUDE + ", a AS (SELECT tag_key, tag_val FROM osm_way WHERE way_id % 2 = 0), b AS (SELECT tag_key, tag_val FROM osm_way WHERE way_id % 2 = 1) SELECT 'left' AS side, tag_key, tag_val FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b) UNION ALL SELECT 'right', tag_key, tag_val FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a)")
def multiset_difference(spark, d):
    w = S.osm_way(spark, d)
    a, b = (w.where(F.col("way_id") % 2 == i).select("tag_key", "tag_val") for i in (0, 1))
    return a.exceptAll(b).select(F.lit("left").alias("side"), "*").unionByName(b.exceptAll(a).select(F.lit("right").alias("side"), "*"))


@query("w4_arc_length", PRELUDE + ", l AS (SELECT way_id, i, coalesce(sqrt((x::DOUBLE - lag(x::DOUBLE) OVER w) * (x::DOUBLE - lag(x::DOUBLE) OVER w) + (y::DOUBLE - lag(y::DOUBLE) OVER w) * (y::DOUBLE - lag(y::DOUBLE) OVER w)), 0) AS leg FROM way_xy JOIN cls USING (way_id) WHERE layer = 1 AND n >= 2 WINDOW w AS (PARTITION BY way_id ORDER BY i)) SELECT way_id, i::INT AS i, round(sum(leg) OVER (PARTITION BY way_id ORDER BY i), 0) AS arc FROM l")
def arcs(spark, d):
    v = B.features(spark, d).where("layer = 1").select("way_id", F.posexplode("points").alias("i", "p"))
    w = Window.partitionBy("way_id").orderBy("i")
    leg = F.coalesce(G.distance(F.lag("p.x").over(w), F.lag("p.y").over(w), F.col("p.x"), F.col("p.y")), F.lit(0.0))
    return v.withColumn("leg", leg).select("way_id", "i", F.round(F.sum("leg").over(w), 0).alias("arc"))


@query("w8_canonical_direction", PRELUDE + "SELECT way_id, CASE WHEN (round_even(ay * 1000, 0), round_even(ax * 1000, 0), a) <= (round_even(by_ * 1000, 0), round_even(bx * 1000, 0), b) THEN a ELSE b END AS start_node FROM (SELECT way_id, min_by(node_id, i) AS a, max_by(node_id, i) AS b, min_by(x::DOUBLE, i) AS ax, min_by(y::DOUBLE, i) AS ay, max_by(x::DOUBLE, i) AS bx, max_by(y::DOUBLE, i) AS by_ FROM way_xy JOIN cls USING (way_id) WHERE layer = 1 AND n >= 2 GROUP BY way_id)")
def canonical(spark, d):
    f = B.features(spark, d).where("layer = 1")
    end = lambda i: F.struct(F.bround(F.element_at("points", i)["y"].cast("double") * 1000).alias("y"), F.bround(F.element_at("points", i)["x"].cast("double") * 1000).alias("x"), F.element_at("nodes", i).alias("id"))
    return f.select("way_id", F.least(end(1), end(-1))["id"].alias("start_node"))


@query("a26_row_hashes", PRELUDE + "SELECT way_id, sha256(tag_key || '=' || tag_val) AS digest FROM osm_way")
def row_hashes(spark, d):
    return S.osm_way(spark, d).select("way_id", F.sha2(F.concat_ws("=", "tag_key", "tag_val"), 256).alias("digest"))


@query("a25_fingerprint", PRELUDE + "SELECT layer, sha256(string_agg(way_id::VARCHAR || ':' || n::VARCHAR, '|' ORDER BY way_id::VARCHAR || ':' || n::VARCHAR)) AS fingerprint FROM feature GROUP BY layer")
def fingerprint(spark, d):
    f = B.features(spark, d).select("layer", F.concat_ws(":", "way_id", F.size("points")).alias("k"))
    return f.groupBy("layer").agg(F.sha2(F.array_join(F.array_sort(F.collect_list("k")), "|"), 256).alias("fingerprint"))
