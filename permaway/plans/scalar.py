"""Queries on classifiers, scalar geometry and tiles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from permaway.functions import geometry as G
from permaway.functions import tags as T
from permaway.operators import features as O
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


#: Tags put on customers by number, so that every branch of the classifiers is met: (key, value)
#: pairs taken at number mod 45 and (number div 45) mod 9.
FIRST = (
    ("boundary", "administrative"), ("building", "yes"), ("building:part", "yes"), ("natural", "water"), ("natural", "bay"), ("place", "sea"),
    ("water", "lake"), ("landuse", "reservoir"), ("waterway", "dock"), ("waterway", "river"), ("waterway", "ditch"), ("landuse", "industrial"),
    ("landuse", "retail"), ("amenity", "industrial"), ("military", "base"), ("landuse", "military"), ("public_transport", "platform"), ("railway", "platform"),
    ("highway", "platform"), ("highway", "motorway"), ("highway", "secondary_link"), ("highway", "road"), ("highway", "service"), ("highway", "steps"),
    ("natural", "coastline"), ("railway", "rail"), ("railway", "tram"), ("railway", "disused"), ("railway", "abandoned"), ("railway", "construction"),
    ("railway", "station"), ("railway", "halt"), ("railway", "signal"), ("landuse", "forest"), ("natural", "wood"), ("type", "multipolygon"),
    ("type", "boundary"), ("type", "route"), ("place", "city"), ("place", "village"), ("place", "hamlet"), ("railway", "funicular"),
    ("waterway", "canal"), ("highway", "primary"), ("shop", "bakery"),
)
SECOND = (
    ("admin_level", "4"), ("route", "ferry"), ("disused:railway", "tram"), ("service", "yard"), ("usage", "industrial"), ("route", "railway"),
    ("station", "subway"), ("surface:grade", "1"), ("abandoned:railway", "rail"),
)


def tagged(spark, d: str) -> DataFrame:
    c = S.table(spark, d, "customer").select("c_custkey")
    pairs = lambda p: F.array(*[F.struct(F.lit(k).alias("key"), F.lit(v).alias("value")) for k, v in p])
    a = F.get(pairs(FIRST), (F.col("c_custkey") % len(FIRST)).cast("int"))
    b = F.get(pairs(SECOND), (F.expr(f"c_custkey div {len(FIRST)}") % len(SECOND)).cast("int"))
    t = F.map_from_entries(F.when(a["key"] == b["key"], F.array(a)).otherwise(F.array(a, b)))
    return c.select(F.col("c_custkey").alias("id"), t.alias("t"))


def _tags_sql() -> str:
    v = lambda p: ", ".join(f"({i}, '{k}', '{x}')" for i, (k, x) in enumerate(p))
    return f"WITH f(i, k1, v1) AS (VALUES {v(FIRST)}), g(i, k2, v2) AS (VALUES {v(SECOND)}), t AS (SELECT c_custkey AS id, k1, v1, k2, v2 FROM customer JOIN f ON f.i = c_custkey % {len(FIRST)} JOIN g ON g.i = (c_custkey // {len(FIRST)}) % {len(SECOND)})"


def _has(key: str, *values: str) -> str:
    if not values:
        return f"(k1 = '{key}' OR k2 = '{key}')"
    inside = ", ".join(f"'{v}'" for v in values)
    return f"((k1 = '{key}' AND v1 IN ({inside})) OR (k2 = '{key}' AND v2 IN ({inside})))"


ADMIN = f"({_has('boundary', 'administrative')} AND {_has('admin_level', '2', '4')})"
WATER = f"({_has('natural', 'water', 'bay')} OR {_has('place', 'sea')} OR {_has('water')} OR {_has('landuse', 'reservoir')} OR {_has('waterway', 'riverbank', 'dock', 'boatyard', 'dam')})"
LINE = _has("waterway", "river", "stream", "canal", "drain", "ditch", "brook")
INDUSTRY = f"({_has('landuse', 'industrial', 'commercial', 'retail', 'warehouse')} OR {_has('amenity', 'industrial')})"
MILITARY = f"({_has('military')} OR {_has('landuse', 'military', 'military:airfield')})"
PLATFORM = f"({_has('public_transport', 'platform')} OR {_has('railway', 'platform')} OR {_has('highway', 'platform')})"
FOREST = f"({_has('landuse', 'forest')} OR {_has('natural', 'wood')})"
BUILDING = f"({_has('building')} OR {_has('building:part')})"
LIGHT = "'tram', 'subway', 'monorail', 'narrow_gauge', 'light_rail'"
RAIL = (
    f"({_has('railway')} AND NOT {_has('route', 'ferry')} AND NOT {_has('ferry')} AND NOT {_has('railway', 'construction', 'proposed', 'planned')} AND "
    f"CASE WHEN {_has('railway', 'disused', 'abandoned')} THEN NOT (k2 IN ('disused:railway', 'abandoned:railway') AND v2 IN ({LIGHT})) ELSE NOT {_has('railway', 'platform', 'station', 'halt', 'signal')} END)"
)
POLYGON = f"CASE WHEN {BUILDING} THEN 2 WHEN {WATER} THEN 3 WHEN {FOREST} THEN 7 WHEN {INDUSTRY} THEN 4 WHEN {MILITARY} THEN 5 WHEN {PLATFORM} THEN 6 WHEN {ADMIN} THEN 10 END"
ANY = f"({BUILDING} OR {WATER} OR {FOREST} OR {INDUSTRY} OR {MILITARY} OR {PLATFORM})"
MULTI = f"({_has('type', 'multipolygon')} OR ({_has('type', 'boundary')} AND {ADMIN}))"
FLAGS = {
    "c1_admin": (T.is_admin_boundary, ADMIN), "c2_building": (T.is_building, BUILDING), "c3_water": (T.is_water, WATER), "c4_waterway": (T.is_waterway_line, LINE),
    "c5_industrial": (T.is_industrial, INDUSTRY), "c6_military": (T.is_military, MILITARY), "c7_platform": (T.is_platform, PLATFORM), "c8_highway": (T.is_highway, _has("highway")),
    "c9_coastline": (T.is_coastline, _has("natural", "coastline")), "c10_railway": (T.is_railway, RAIL), "c11_forest": (T.is_forest, FOREST), "c12_multipolygon": (T.is_multipolygon, MULTI),
    "c13_waterway_relation": (T.is_waterway_relation, LINE), "c14_rail_route": (T.is_rail_route, f"({_has('type', 'route')} AND {_has('route', 'tracks', 'railway')})"),
}
NOT_MAIN = ", ".join(f"'{x}'" for x in T.NOT_MAINLINE)


@query("c1_c14_classifiers", _tags_sql() + " SELECT id, " + ", ".join(f"{s} AS {n}" for n, (_, s) in FLAGS.items()) + " FROM t")
def classifiers(spark, d):
    return tagged(spark, d).select("id", *[f(F.col("t")).alias(n) for n, (f, _) in FLAGS.items()])


@query(
    "c15_c18_routing",
    _tags_sql() + f" SELECT id, {POLYGON} AS polygon_layer, CASE WHEN {ANY} THEN {POLYGON} WHEN {_has('highway')} THEN 0 WHEN {LINE} THEN 9 WHEN {RAIL} THEN 1 END AS closed_layer,"
    f" CASE WHEN {_has('highway')} THEN 0 WHEN {LINE} THEN 9 WHEN {RAIL} THEN 1 END AS open_layer, CASE WHEN {MULTI} THEN 'multipolygon' WHEN {LINE} THEN 'waterway' WHEN {_has('type', 'route')} AND {_has('route', 'tracks', 'railway')} THEN 'railway route' END AS relation_route,"
    f" CASE WHEN {_has('railway', 'station', 'halt', 'signal')} THEN 8 WHEN {_has('place', 'city', 'town', 'village')} THEN 11 END AS node_layer FROM t",
)
def routing(spark, d):
    t = F.col("t")
    return tagged(spark, d).select(
        "id", T.polygon_layer(t).alias("polygon_layer"), T.way_layer(t, F.lit(True)).alias("closed_layer"), T.way_layer(t, F.lit(False)).alias("open_layer"),
        T.relation_route(t).alias("relation_route"), T.node_layer(t).alias("node_layer"),
    )


@query(
    "c19_c20_mainline_filters",
    _tags_sql() + f" SELECT id, NOT {_has('railway', *T.NOT_MAINLINE)} AND NOT {_has('service', 'yard', 'spur')} AND NOT {_has('usage', 'industrial', 'tourism', 'military')} AS mainline,"
    f" {_has('railway', 'station', 'halt')} AND NOT {_has('station', 'subway', 'tram', 'light_rail', 'monorail', 'narrow_gauge')} AS station FROM t",
)
def mainline_filters(spark, d):
    return tagged(spark, d).select("id", T.is_mainline(F.col("t")).alias("mainline"), T.is_mainline_station(F.col("t")).alias("station"))


def _roads(kinds) -> str:
    return _has("highway", *kinds)


LOD_SQL = f"""CASE layer WHEN 0 THEN CASE WHEN lod = 0 THEN true WHEN lod <= 2 THEN {_roads(T.HOME_ROADS)} WHEN lod = 3 THEN {_roads(T.MAIN_ROADS)} WHEN lod = 4 THEN {_roads(T.MAJOR_ROADS)} ELSE false END
 WHEN 1 THEN true WHEN 3 THEN true WHEN 7 THEN true WHEN 8 THEN true WHEN 10 THEN true WHEN 2 THEN lod <= 1 OR (lod = 2 AND area >= 100) WHEN 4 THEN lod <= 2 WHEN 6 THEN lod <= 2
 WHEN 5 THEN lod = 0 WHEN 9 THEN lod IN (0, 1, 3) WHEN 11 THEN lod <= 2 OR (lod = 3 AND {_has('place', 'city', 'town', 'village')}) OR (lod > 3 AND {_has('place', 'city', 'town')}) WHEN 12 THEN lod <= 1 END"""


@query("c21_c29_lod_matrix", _tags_sql() + f", x AS (SELECT *, id % 13 AS layer, (id % 200)::DOUBLE AS area, lod FROM t, (SELECT range AS lod FROM range(6))) SELECT id, layer, lod::INT AS lod FROM x WHERE {LOD_SQL}")
def lod_matrix(spark, d):
    rows = tagged(spark, d).select("id", (F.col("id") % 13).alias("layer"), F.col("t").alias("tags"), (F.col("id") % 200).cast("double").alias("area"))
    return O.with_lods(rows).select("id", "layer", "lod")


@query("c30_logic_layers", PRELUDE + "SELECT way_id, layer FROM feature WHERE layer IN (1, 6, 8, 10, 11, 12)")
def logic_layers(spark, d):
    return B.features(spark, d).where(F.col("layer").isin(*T.LOGIC_LAYERS)).select("way_id", "layer")


@query("p1_a1_projection", PRELUDE + "SELECT node_id, round(x::DOUBLE, 2) AS x, round(y::DOUBLE, 2) AS y FROM xy")
def projection(spark, d):
    return B.xy(spark, d).select("node_id", F.round(F.col("x").cast("double"), 2).alias("x"), F.round(F.col("y").cast("double"), 2).alias("y"))


KEPT = ", ".join(f"'{k}'" for k in T.KEPT_KEYS)
KEEP = "({0} IN (" + KEPT + ") OR starts_with({0}, 'building:') OR starts_with({0}, 'surface') OR starts_with({0}, 'industrial') OR contains({0}, 'railway'))"


@query("p2_metadata_keys", _tags_sql() + f" SELECT id, k FROM (SELECT id, k1 AS k FROM t WHERE {KEEP.format('k1')} UNION SELECT id, k2 FROM t WHERE {KEEP.format('k2')})")
def metadata(spark, d):
    return tagged(spark, d).select("id", F.explode(F.map_keys(T.kept_metadata(F.col("t")))).alias("k"))


BOX = ", ".join(f"round({c}::DOUBLE, 1) AS {c}" for c in ("min_x", "min_y", "max_x", "max_y"))


@query("p3_feature_boxes", PRELUDE + f"SELECT way_id, layer, {BOX} FROM feature")
def boxes(spark, d):
    return B.features(spark, d).select("way_id", "layer", *[F.round(F.col(f"box.{c}").cast("double"), 1).alias(c) for c in ("min_x", "min_y", "max_x", "max_y")])


@query("p4_index_check", "SELECT o_orderkey AS id, list_min(i) >= 0 AND list_max(i) < n AS ok, [x FOR x IN i IF x >= 0 AND x < n] AS kept FROM (SELECT o_orderkey, (o_orderkey % 7)::INT AS n, [(o_orderkey % 5)::INT, (o_custkey % 8)::INT - 1, 2] AS i FROM orders)")
def index_check(spark, d):
    o = S.table(spark, d, "orders").select("o_orderkey", (F.col("o_orderkey") % 7).cast("int").alias("n"), F.array((F.col("o_orderkey") % 5).cast("int"), ((F.col("o_custkey") % 8).cast("int") - 1), F.lit(2)).alias("i"))
    return o.select(F.col("o_orderkey").alias("id"), G.indices_ok(F.col("i"), F.col("n")).alias("ok"), F.filter("i", lambda x: (x >= 0) & (x < F.col("n"))).alias("kept"))


HIGHWAY_W = "CASE WHEN tag_val IN ('motorway', 'motorway_link', 'trunk', 'trunk_link') THEN 6.0 WHEN tag_val IN ('primary', 'primary_link') THEN 5.0 WHEN tag_val IN ('secondary', 'secondary_link') THEN 4.0 WHEN tag_val IN ('tertiary', 'tertiary_link') THEN 3.0 WHEN tag_val IN ('residential', 'living_street', 'unclassified', 'road') THEN 2.5 WHEN tag_val = 'service' THEN 2.0 WHEN tag_val IN ('footway', 'path', 'cycleway', 'pedestrian', 'steps', 'track', 'bridleway') THEN 1.0 ELSE 1.5 END"
WATERWAY_W = "CASE tag_val WHEN 'river' THEN 8.0 WHEN 'canal' THEN 6.0 WHEN 'stream' THEN 3.0 WHEN 'brook' THEN 2.0 WHEN 'drain' THEN 2.0 WHEN 'ditch' THEN 1.5 ELSE 3.0 END"


@query("p8_p9_half_widths", PRELUDE + f"SELECT way_id, CASE tag_key WHEN 'highway' THEN {HIGHWAY_W} ELSE {WATERWAY_W} END::DOUBLE AS half FROM osm_way WHERE tag_key IN ('highway', 'waterway')")
def half_widths(spark, d):
    w = S.osm_way(spark, d).where("tag_key in ('highway', 'waterway')")
    v = F.col("tag_val")
    return w.select("way_id", F.when(F.col("tag_key") == "highway", T.highway_half_width(v)).otherwise(T.waterway_half_width(v)).alias("half"))


RIBBON = (
    PRELUDE + f""", p AS (SELECT way_id, i, n, x::DOUBLE AS x, y::DOUBLE AS y, CASE tag_key WHEN 'highway' THEN {HIGHWAY_W} ELSE {WATERWAY_W} END::DOUBLE AS half,
 lead(x::DOUBLE) OVER w - x AS qx, lead(y::DOUBLE) OVER w - y AS qy, x - lag(x::DOUBLE) OVER w AS px, y - lag(y::DOUBLE) OVER w AS py FROM way_xy JOIN cls USING (way_id) WHERE layer IN (0, 9) AND n >= 2 WINDOW w AS (PARTITION BY way_id ORDER BY i)),
u AS (SELECT *, sqrt(px*px+py*py) AS la, sqrt(qx*qx+qy*qy) AS lb FROM p), v AS (SELECT *, px/la AS uax, py/la AS uay, qx/lb AS ubx, qy/lb AS uby FROM u),
m AS (SELECT *, -(uay+uby) AS nx, uax+ubx AS ny, sqrt((uay+uby)*(uay+uby)+(uax+ubx)*(uax+ubx)) AS s FROM v),
k AS (SELECT *, (-uay*nx + uax*ny)/s AS dot FROM m),
q AS (SELECT way_id, i, x, y, half, CASE WHEN i = 0 THEN -uby WHEN i = n-1 THEN -uay WHEN s < 0.001 THEN -uay WHEN dot > 0.1 THEN nx/(s*dot) ELSE nx/s END AS vx,
 CASE WHEN i = 0 THEN ubx WHEN i = n-1 THEN uax WHEN s < 0.001 THEN uax WHEN dot > 0.1 THEN ny/(s*dot) ELSE ny/s END AS vy FROM k)
SELECT way_id, (2*i + k)::BIGINT AS vertex, round((x + (2*k-1)*vx*half)::FLOAT::DOUBLE, 1) AS x, round((y + (2*k-1)*vy*half)::FLOAT::DOUBLE, 1) AS y FROM q, (SELECT range AS k FROM range(2)) r"""
)


def ribbons(spark, d: str) -> DataFrame:
    f = B.features(spark, d).where("layer in (0, 9)")
    half = F.when(F.col("layer") == 0, T.highway_half_width(T.tag(F.col("tags"), "highway"))).otherwise(T.waterway_half_width(T.tag(F.col("tags"), "waterway")))
    return G.with_ribbon(f, half)


@query("p6_p7_ribbons", RIBBON)
def ribbon_points(spark, d):
    r = ribbons(spark, d).select("way_id", F.posexplode("band").alias("vertex", "p"))
    return r.select("way_id", F.col("vertex").cast("bigint").alias("vertex"), F.round(F.col("p.x").cast("double"), 1).alias("x"), F.round(F.col("p.y").cast("double"), 1).alias("y"))


@query("p6_ribbon_triangles")
def ribbon_triangles(spark, d):
    """Two triangles for each segment of a band; no SQL, six indices a segment are tested."""
    quads = F.flatten(F.transform(F.sequence(F.lit(0), F.size("points") - 2), lambda i: F.array(2 * i, 2 * i + 1, 2 * i + 2, 2 * i + 1, 2 * i + 3, 2 * i + 2)))
    return ribbons(spark, d).where(F.size("points") >= 2).select("way_id", F.size("band").alias("vertices"), quads.alias("indices"))


@query("p10_railway_lines", PRELUDE + ", uses AS (SELECT node_id, count(DISTINCT way_id) AS c FROM osm_way_node JOIN cls USING (way_id) WHERE layer = 1 GROUP BY node_id) SELECT way_id, count(*)::BIGINT AS vertices, (count(*) - 1)::BIGINT AS segments, coalesce(string_agg(i::VARCHAR, ',' ORDER BY i) FILTER (c > 1), '') AS junctions FROM way_xy JOIN cls USING (way_id) LEFT JOIN uses USING (node_id) WHERE layer = 1 AND n >= 2 GROUP BY way_id")
def railway_lines(spark, d):
    lines = B.features(spark, d).where("layer = 1").select("way_id", F.posexplode("nodes").alias("i", "node_id"))
    j = lines.join(B.railway_uses(spark, d), "node_id", "left")
    g = j.groupBy("way_id").agg(F.count("*").alias("vertices"), F.array_sort(F.collect_list(F.when(F.col("uses") > 1, F.col("i")))).alias("j"))
    return g.select("way_id", "vertices", (F.col("vertices") - 1).alias("segments"), F.concat_ws(",", F.col("j").cast("array<string>")).alias("junctions"))


@query("p12_simplified")
def simplify(spark, d):
    """Rings with points farther than 1500 m apart; sequential, so a test holds it against Python."""
    return B.features(spark, d).where(F.col("layer").isin(2, 3, 4, 5, 6, 7)).select("way_id", F.size("points").alias("before"), F.size(G.simplified(F.col("points"), 1500.0)).alias("after"))


AREA = PRELUDE + ", a AS (SELECT way_id, sum(x::DOUBLE * ny - nx * y::DOUBLE) / 2 AS area, max(n) AS n FROM (SELECT way_id, n, x, y, coalesce(lead(x::DOUBLE) OVER w, first(x::DOUBLE) OVER w) AS nx, coalesce(lead(y::DOUBLE) OVER w, first(y::DOUBLE) OVER w) AS ny FROM way_xy WINDOW w AS (PARTITION BY way_id ORDER BY i)) GROUP BY way_id)"


@query("p13_p15_areas", AREA + " SELECT way_id, round(CASE WHEN f.n < 3 THEN 0 ELSE area END / 1000000, 4) AS km2, f.n < 3 OR area > 0 AS ccw FROM feature f JOIN a USING (way_id) WHERE layer IN (2, 3, 5, 6, 7)")
def areas(spark, d):
    f = B.features(spark, d).where(F.col("layer").isin(2, 3, 5, 6, 7))
    return f.select("way_id", F.round(F.col("area") / 1000000, 4).alias("km2"), G.is_ccw(F.col("points")).alias("ccw"))


@query("p19_segment_lengths", PRELUDE + "SELECT way_id, round(sum(sqrt((x::DOUBLE-px)*(x::DOUBLE-px)+(y::DOUBLE-py)*(y::DOUBLE-py))), 1) AS metres FROM (SELECT way_id, x, y, lag(x::DOUBLE) OVER w AS px, lag(y::DOUBLE) OVER w AS py FROM way_xy WINDOW w AS (PARTITION BY way_id ORDER BY i)) JOIN feature USING (way_id) GROUP BY way_id")
def lengths(spark, d):
    return B.features(spark, d).select("way_id", F.round(G.chain_length(F.col("points")), 1).alias("metres"))


@query("p20_box_algebra", PRELUDE + ", l AS (SELECT lead(way_id) OVER w AS other, way_id, min_x, min_y, max_x, max_y, lead(min_x) OVER w AS a, lead(min_y) OVER w AS b, lead(max_x) OVER w AS c, lead(max_y) OVER w AS e FROM feature WHERE layer = 1 WINDOW w AS (ORDER BY way_id)) SELECT way_id, min_x <= c AND max_x >= a AND min_y <= e AND max_y >= b AS overlap, round((greatest(max_x, c) - least(min_x, a))::DOUBLE, 0) AS width, a BETWEEN min_x AND max_x AND b BETWEEN min_y AND max_y AS corner_inside FROM l WHERE other IS NOT NULL")
def box_algebra(spark, d):
    f = O.numbered(B.features(spark, d).where("layer = 1").select("way_id", "box"), ["way_id"], "k")
    o = f.select((F.col("k") - 1).alias("k"), F.col("box").alias("o"))
    j = f.join(o, "k")
    u = G.box_union(F.col("box"), F.col("o"))
    return j.select("way_id", G.boxes_overlap(F.col("box"), F.col("o")).alias("overlap"), F.round((u["max_x"] - u["min_x"]).cast("double"), 0).alias("width"), G.box_contains(F.col("box"), F.col("o.min_x"), F.col("o.min_y")).alias("corner_inside"))


@query("p21_p22_ring_axis")
def ring_axis(spark, d):
    """Centre, half perimeter and main axis of platform rings; the axis of a near-square ring is not
    stable to the last bit, so it is tested on fixed shapes instead of by SQL."""
    f = B.features(spark, d).where("layer = 6").withColumn("a", G.major_axis(F.col("points")))
    return f.select("way_id", F.round("a.cx", 0).alias("cx"), F.round("a.cy", 0).alias("cy"), F.round(G.chain_length(F.col("points")) * 0.5, 0).alias("half_perimeter"), F.round("a.half", 0).alias("half"))


SPEED_SQL = "CASE WHEN s IN ('none', 'signals', 'variable') OR contains(a, ':') OR NOT regexp_full_match(a, '[+-]?[0-9]{1,9}') THEN 0 WHEN try_cast(a AS INT) BETWEEN 1 AND 350 THEN try_cast(a AS INT) ELSE 0 END"
RAWS = ("50", " 120 ", "none", "signals", "80;60", "100 km/h", "90kmh", "PL:urban", "0", "351", "abc", "70 KM/H", "variable", "-5", "12.5")


@query("p23_max_speed", "WITH r(i, raw) AS (VALUES " + ", ".join(f"({i}, '{r}')" for i, r in enumerate(RAWS)) + f"), x AS (SELECT o_orderkey AS id, lower(trim(raw)) AS s FROM orders JOIN r ON i = o_orderkey % {len(RAWS)}), y AS (SELECT id, s, trim(replace(replace(split_part(s, ';', 1), 'km/h', ''), 'kmh', '')) AS a FROM x) SELECT id, ({SPEED_SQL})::INT AS speed FROM y")
def speeds(spark, d):
    raw = F.get(F.array(*[F.lit(r) for r in RAWS]), (F.col("o_orderkey") % len(RAWS)).cast("int"))
    return S.table(spark, d, "orders").select(F.col("o_orderkey").alias("id"), T.max_speed(raw).alias("speed"))


@query("p24_p25_resolved_speed", PRELUDE + "SELECT way_id, CASE WHEN t_maxspeed = '120' THEN 120 WHEN t_maxspeed = '80;60 km/h' THEN 80 WHEN t_usage = 'main' THEN 140 WHEN t_usage = 'branch' THEN 120 WHEN t_usage = 'industrial' THEN 60 ELSE 80 END AS speed FROM osm_way WHERE tag_key = 'railway'")
def resolved(spark, d):
    return S.osm_way(spark, d).where("tag_key = 'railway'").select("way_id", T.resolved_speed(O.way_tags()).alias("speed"))


@query("p26_city_name", "SELECT p_partkey AS id, nullif(split_part(p_name, ' ', 1), '') AS city FROM part")
def city(spark, d):
    return S.table(spark, d, "part").select(F.col("p_partkey").alias("id"), T.city_name(F.col("p_name")).alias("city"))


FUNCTIONS = ("entry", "exit", "block", "intermediate", "shunting", "")


@query("p27_signal_function", "SELECT o_orderkey AS id, CASE WHEN a IN ('entry', 'exit', 'block', 'intermediate') THEN a WHEN b IN ('entry', 'exit', 'block', 'intermediate') THEN b ELSE 'unknown' END AS function FROM (SELECT o_orderkey, ['entry', 'exit', 'block', 'intermediate', 'shunting', ''][(o_orderkey % 6 + 1)::INT] AS a, ['entry', 'exit', 'block', 'intermediate', 'shunting', ''][(o_custkey % 6 + 1)::INT] AS b FROM orders)")
def signal_functions(spark, d):
    pick = lambda c: F.get(F.array(*[F.lit(f) for f in FUNCTIONS]), (F.col(c) % 6).cast("int"))
    t = F.create_map(F.lit("railway:signal:main:function"), pick("o_orderkey"), F.lit("railway:signal:combined:function"), pick("o_custkey"))
    return S.table(spark, d, "orders").select(F.col("o_orderkey").alias("id"), T.signal_function(t).alias("function"))


@query("p28_place_type", _tags_sql() + " SELECT id, CASE WHEN k1 = 'place' AND v1 IN ('city', 'town', 'village') THEN v1 END AS place FROM t")
def place_types(spark, d):
    return tagged(spark, d).select("id", T.place_type(F.col("t")).alias("place"))


@query("p30_p33_tile_ids", PRELUDE + "SELECT node_id, gx, gy, ((gx + 100000) + (gy + 100000)) * ((gx + 100000) + (gy + 100000) + 1) // 2 + (gy + 100000) AS tile_id, gx * 10000.0::DOUBLE AS min_x, (gy + 1) * 10000.0::DOUBLE AS max_y FROM (SELECT node_id, floor(x::DOUBLE / 10000)::BIGINT AS gx, floor(y::DOUBLE / 10000)::BIGINT AS gy FROM xy)")
def tile_ids(spark, d):
    n = B.xy(spark, d).select("node_id", G.grid(F.col("x")).alias("gx"), G.grid(F.col("y")).alias("gy"))
    return n.select("node_id", "gx", "gy", G.tile_id(F.col("gx"), F.col("gy")).alias("tile_id"), (F.col("gx") * G.TILE).alias("min_x"), ((F.col("gy") + 1) * G.TILE).alias("max_y"))
