"""Queries on the railway network: graph, tracks, stations, platforms, signals, sections."""

from __future__ import annotations

from pyspark.sql import functions as F

from permaway.functions import geometry as G
from permaway.functions import tags as T
from permaway.operators import features as O
from permaway.operators import network as N
from permaway.operators import spatial as X
from permaway.operators.scratch import cut
from permaway.plans import base as B
from permaway.plans.joins import PAIRS
from permaway.sources import osm_tables as S

QUERIES, SQL = {}, {}


def query(name: str, sql: str | None = None):
    def put(f):
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f

    return put


GRAPH = PAIRS.replace("WITH", "WITH RECURSIVE", 1) + """, reach(id, r) AS (SELECT raw_id, raw_id FROM vtx UNION SELECT reach.id, CASE WHEN pr.a = reach.r THEN pr.b ELSE pr.a END FROM reach JOIN pr ON reach.r IN (pr.a, pr.b)),
comp AS (SELECT id AS raw_id, min(r) AS component FROM reach GROUP BY id), nv AS (SELECT vtx.* EXCLUDE (node_id), component, dense_rank() OVER (ORDER BY component) - 1 AS node_id FROM vtx JOIN comp USING (raw_id)),
node AS (SELECT node_id, avg(x::DOUBLE)::FLOAT AS x, avg(y::DOUBLE)::FLOAT AS y, bool_or(coalesce(jn, false)) AS is_junction, count(*) AS vertices FROM nv GROUP BY node_id),
leg AS (SELECT *, lag(node_id) OVER w IS DISTINCT FROM node_id AS fresh, coalesce(sqrt((x::DOUBLE - lag(x::DOUBLE) OVER w) * (x::DOUBLE - lag(x::DOUBLE) OVER w) + (y::DOUBLE - lag(y::DOUBLE) OVER w) * (y::DOUBLE - lag(y::DOUBLE) OVER w)), 0) AS leg FROM nv WINDOW w AS (PARTITION BY way_id ORDER BY i)),
arc AS (SELECT *, sum(leg) OVER (PARTITION BY way_id ORDER BY i) AS arc FROM leg),
run AS (SELECT raw_id, way_id, i, t_usage, t_maxspeed, node_id AS u, lead(node_id) OVER w AS v, lead(arc) OVER w - arc AS length FROM arc WHERE fresh WINDOW w AS (PARTITION BY way_id ORDER BY i)),
pick AS (SELECT *, row_number() OVER (PARTITION BY least(u, v), greatest(u, v) ORDER BY raw_id) AS r FROM run WHERE v IS NOT NULL),
edge AS (SELECT *, row_number() OVER (ORDER BY raw_id) - 1 AS pair FROM pick WHERE r = 1)"""


@query("g1_g2_a15_a23_nodes", GRAPH + " SELECT node_id, round(x::DOUBLE, 1) AS x, round(y::DOUBLE, 1) AS y, is_junction, vertices FROM node")
def nodes(spark, d):
    n, _ = B.graph(spark, d)
    return n.select("node_id", F.round(F.col("x").cast("double"), 1).alias("x"), F.round(F.col("y").cast("double"), 1).alias("y"), "is_junction", "vertices")


@query("g1_g3_w3_a16_edges", GRAPH + " SELECT pair * 2 + k AS edge_id, CASE WHEN k = 0 THEN u ELSE v END AS from_node, CASE WHEN k = 0 THEN v ELSE u END AS to_node, round(length, 0) AS metres, (CASE t_maxspeed WHEN '120' THEN 120 WHEN '80;60 km/h' THEN 80 ELSE CASE t_usage WHEN 'main' THEN 140 ELSE 120 END END)::INT AS max_speed, k = 0 AS is_forward FROM edge, (SELECT range AS k FROM range(2))")
def edges(spark, d):
    _, e = B.graph(spark, d)
    return e.select("edge_id", "from_node", "to_node", F.round("length", 0).alias("metres"), "max_speed", "is_forward")


@query("j18_edge_twins", GRAPH + " SELECT pair * 2 + k AS edge_id, pair * 2 + 1 - k AS twin_id FROM edge, (SELECT range AS k FROM range(2))")
def edge_twins(spark, d):
    _, e = B.graph(spark, d)
    return N.twins(e)


@query("w7_component_numbers", GRAPH + " SELECT raw_id, node_id FROM nv")
def component_numbers(spark, d):
    v = cut(N.raw_vertices(B.mainline(spark, d), B.railway_uses(spark, d)))
    from permaway.operators.components import connected_components

    c = connected_components(N.merge_pairs(v), "a", "b").withColumnRenamed("node", "raw_id")
    j = v.select("raw_id").join(c, "raw_id", "left").withColumn("component", F.coalesce("component", "raw_id"))
    ids = O.numbered(j.select("component").distinct(), ["component"], "node_id")
    return j.join(ids, "component").select("raw_id", "node_id")


@query("a24_graph_counters", GRAPH + " SELECT (SELECT count(*) FROM node) AS nodes, (SELECT count(*) FROM node WHERE is_junction) AS junctions, (SELECT count(*) * 2 FROM edge) AS edges, (SELECT count(DISTINCT (a, b)) FROM pr) AS merges")
def counters(spark, d):
    n, e = B.graph(spark, d)
    p = N.merge_pairs(N.raw_vertices(B.mainline(spark, d), B.railway_uses(spark, d)))
    a = n.agg(F.count("*").alias("nodes"), F.count_if("is_junction").alias("junctions"))
    return a.crossJoin(e.agg(F.count("*").alias("edges"))).crossJoin(p.agg(F.count("*").alias("merges")))


@query("g4_p34_a17_tracks")
def tracks(spark, d):
    """Chains of segments; a test checks that they part the segments and do not depend on row order."""
    n, e = B.graph(spark, d)
    t, _ = N.build_tracks(n, e)
    return t.select("track_index", "track_key", "start_node", "end_node", F.round("length", 0).alias("metres"), F.size("edge_ids").alias("edges"))


STATION = GRAPH + ", s0 AS (SELECT node_id AS osm_id, x, y, t_railway, t_name FROM xy JOIN osm_node USING (node_id) WHERE t_railway IN ('station', 'halt')), s AS (SELECT *, row_number() OVER (ORDER BY osm_id) - 1 AS station_id FROM s0), near AS (SELECT station_id, node.node_id, sqrt((s.x::DOUBLE - node.x) * (s.x::DOUBLE - node.x) + (s.y::DOUBLE - node.y) * (s.y::DOUBLE - node.y)) AS dist FROM s JOIN node ON abs(s.x - node.x) <= 201 AND abs(s.y - node.y) <= 201), best AS (SELECT station_id, node_id, row_number() OVER (PARTITION BY station_id ORDER BY dist, node_id) AS r FROM near WHERE dist < 200)"


@query("g11_a12_stations", STATION + " SELECT s.station_id, osm_id, t_railway = 'station' AS is_major, nullif(split_part(t_name, '#', 2), '') AS suffix, node_id FROM s LEFT JOIN best ON best.station_id = s.station_id AND r = 1")
def stations(spark, d):
    n, _ = B.graph(spark, d)
    s = B.stations(spark, d, n)
    return s.select("station_id", "osm_id", (F.col("t_railway") == "station").alias("is_major"), F.nullif(F.split_part("t_name", F.lit("#"), F.lit(2)), F.lit("")).alias("suffix"), "node_id")


@query("g8_boundary_nodes", STATION + " SELECT DISTINCT node_id FROM s JOIN best ON best.station_id = s.station_id AND r = 1 WHERE t_railway = 'station'")
def boundary_nodes(spark, d):
    return B.stations(spark, d, B.graph(spark, d)[0]).where("t_railway = 'station' and node_id is not null").select("node_id").distinct()


@query("g10_a11_places", "WITH p AS (SELECT c_custkey, c_name, CASE c_custkey % 3 WHEN 0 THEN 'city' WHEN 1 THEN 'town' ELSE 'village' END AS place FROM customer WHERE c_custkey % 13 = 0) SELECT min(c_custkey) AS node_id, 'P' || (c_custkey % 50) AS name, place, coalesce(try_cast(CASE WHEN min(c_custkey) % 2 = 0 THEN min(c_custkey)::VARCHAR ELSE 'many' END AS INT), 0)::INT AS population FROM p GROUP BY 'P' || (c_custkey % 50), place")
def places(spark, d):
    """Places once by name and kind; population is a number or 0."""
    p = B.xy(spark, d).where("t_place is not null").select("node_id", F.concat(F.lit("P"), (F.col("node_id") % 50).cast("string")).alias("name"), F.col("t_place").alias("place"))
    p = B.first_by(p, [F.col("name"), F.col("place")], ["node_id"])
    raw = F.when(F.col("node_id") % 2 == 0, F.col("node_id").cast("string")).otherwise("many")
    return p.withColumn("raw", raw).select("node_id", "name", "place", F.expr("coalesce(try_cast(raw as int), 0)").alias("population"))


SIGNAL = GRAPH + ", g AS (SELECT node_id AS osm_id, x, y, ['entry', 'exit', 'block', 'intermediate', 'shunting'][(node_id % 5 + 1)::INT] AS f FROM xy JOIN osm_node USING (node_id) WHERE t_railway = 'signal'), k AS (SELECT osm_id, f, node.node_id, sqrt((g.x::DOUBLE - node.x) * (g.x::DOUBLE - node.x) + (g.y::DOUBLE - node.y) * (g.y::DOUBLE - node.y)) AS dist FROM g JOIN node ON abs(g.x - node.x) <= 11 AND abs(g.y - node.y) <= 11 WHERE f <> 'shunting')"


@query("g13_j13_signals", SIGNAL + " SELECT osm_id, node_id, f AS function FROM (SELECT *, row_number() OVER (PARTITION BY osm_id ORDER BY dist, node_id) AS r FROM k WHERE dist < 10) WHERE r = 1")
def signals(spark, d):
    n, _ = B.graph(spark, d)
    kinds = F.array(*[F.lit(x) for x in ("entry", "exit", "block", "intermediate", "shunting")])
    t = F.create_map(F.lit("railway:signal:main:function"), F.get(kinds, (F.col("node_id") % 5).cast("int")))
    s = B.xy(spark, d).where("t_railway = 'signal'").select(F.col("node_id").alias("osm_id"), "x", "y", T.signal_function(t).alias("function")).where("function <> 'unknown'")
    s = B.first_by(s, [F.round("x", 2), F.round("y", 2)], ["osm_id"])
    return N.snap(s, "osm_id", n, 10.0).where("node_id is not null").select("osm_id", "node_id", "function")


def platform_rings(spark, d):
    """Platforms once by their centre in whole metres."""
    f = B.features(spark, d).where("layer = 6").withColumn("c", G.centroid(F.col("points")))
    f = f.select(F.col("way_id").alias("platform_id"), "points", F.col("c.x").alias("x"), F.col("c.y").alias("y"))
    return B.first_by(f, [F.round("x"), F.round("y")], ["platform_id"])


@query("g12_a13_j12_platforms")
def platforms(spark, d):
    """Platforms with the nearest node within 900 m; the centre of a ring is a sum of floats, which
    may round otherwise elsewhere, so a test holds it against Python."""
    n, _ = B.graph(spark, d)
    return N.snap(platform_rings(spark, d), "platform_id", n, 900.0).where("node_id is not null").select("platform_id", "node_id", F.round(G.chain_length(F.col("points")) * 0.5, 0).alias("metres"))


@query("j15_platform_entries")
def entries(spark, d):
    """The tracks beside a platform within 900 m (30 m in production; the lattice is wider than that)."""
    n, e = B.graph(spark, d)
    t, _ = N.build_tracks(n, e)
    x = N.platform_entries(platform_rings(spark, d).select("platform_id", "points"), cut(N.with_arc(t, e, n)), 900.0)
    return x.select("platform_id", "rank", "track_index", F.round("from_m", 0).alias("from_m"), F.round("to_m", 0).alias("to_m"))


@query("j16_platform_station")
def platform_station(spark, d):
    p = platform_rings(spark, d).select("platform_id", F.col("x").alias("lx"), F.col("y").alias("ly"))
    s = B.xy(spark, d).where("t_railway in ('station', 'halt')").select("node_id", F.col("x").alias("rx"), F.col("y").alias("ry"))
    return X.nearest(p, "platform_id", s, "node_id", 1500.0).select("platform_id", "node_id", F.round("distance", 0).alias("metres"))


def extents(spark, d):
    n, e = B.graph(spark, d)
    s = B.stations(spark, d, n)
    gap = X.nearest_other(s, "station_id", 2000.0).select("station_id", (F.col("distance") / 2).alias("half_gap"))
    t, stamps = N.build_tracks(n, e)
    p = platform_rings(spark, d)
    lines = N.platform_lines(p, N.platform_entries(p.select("platform_id", "points"), cut(N.with_arc(t, e, n)), 900.0), s, e, stamps)
    return N.station_extents(cut(s.join(gap, "station_id", "left").join(lines, "station_id", "left")), n, e)


@query("g5_g6_a21_station_extents")
def station_extents(spark, d):
    return extents(spark, d).select("edge_id", "station_id", F.round("distance", 0).alias("metres"))


@query("g7_a18_block_sections")
def sections(spark, d):
    n, e = B.graph(spark, d)
    stops = B.stations(spark, d, n).where("t_railway = 'station' and node_id is not null").select("node_id")
    return N.block_sections(e, stops).select("section_id", "seed_edge", "start_node", "end_node", F.round("length", 0).alias("metres"), "max_speed", "edge_count", "start_boundary", "end_boundary")


@query("a19_mean_section")
def mean_section(spark, d):
    return sections(spark, d).agg(F.count("*").alias("sections"), F.round(F.avg("metres"), 3).alias("metres"))


@query("g9_a10_g15_regions", "WITH r AS (SELECT o_orderkey AS way_id, 'R' || (o_orderkey % 40) AS name, CASE WHEN o_orderkey % 3 = 0 THEN 2 ELSE 4 END AS level FROM orders WHERE o_orderkey % 20 = 16) SELECT name, level, count(*) AS rings, min(way_id) AS first_ring FROM r GROUP BY name, level")
def regions(spark, d):
    """Regions of level 2 and 4 by name with all of their rings."""
    f = B.features(spark, d).where((F.col("layer") == 7) & (F.size("points") >= 3)).select("way_id", F.concat(F.lit("R"), (F.col("way_id") % 40).cast("string")).alias("name"), F.when(F.col("way_id") % 3 == 0, 2).otherwise(4).alias("level"))
    return f.groupBy("name", "level").agg(F.count("*").alias("rings"), F.min("way_id").alias("first_ring"))


@query("g14_coastlines", "SELECT way_id FROM (SELECT o_orderkey AS way_id FROM orders) WHERE false")
def coastlines(spark, d):
    """Lines of the coastline layer with two points or more; no input reaches that layer."""
    return B.features(spark, d).where((F.col("layer") == 12) & (F.size("points") >= 2)).select("way_id")
