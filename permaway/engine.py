"""The whole job: elements to tiles, tiles to a network state, and the command line."""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from permaway.functions import ed25519
from permaway.functions import geometry as G
from permaway.functions import tags as T
from permaway.operators import features as O
from permaway.operators import mesh as M
from permaway.operators import network as N
from permaway.operators import spatial as X
from permaway.operators.scratch import cut
from permaway.sources import container as C
from permaway.sources import pbf, state

#: Layers of water and of borders.
WATER, BORDERS = 3, 10


def features_of(elements: DataFrame) -> DataFrame:
    """(way_id, layer, tags, nodes, points, indices, hole_starts, box, area) of all elements: ways,
    points and shapes of relations. The points of a shape's holes follow those of its outline,
    from hole_starts on, and its area is less by theirs; indices are its triangles."""
    xy = cut(O.projected(pbf.nodes(elements)).select("node_id", "x", "y", "tags"))
    ways = pbf.ways(elements)
    order = ways.select("way_id", F.posexplode("nodes").alias("pos", "node_id"))
    lines = cut(O.way_lines(order, xy))
    closed = (F.size("nodes") >= 3) & (F.element_at("nodes", 1) == F.element_at("nodes", -1))
    w = ways.select("way_id", "tags", closed.alias("is_closed")).withColumn("layer", T.way_layer(F.col("tags"), F.col("is_closed")))
    kept = T.kept_metadata(F.col("tags"))
    by_way = w.where("layer is not null").join(lines, "way_id").select("way_id", "layer", kept.alias("tags"), "nodes", "points")
    points = xy.withColumn("layer", T.node_layer(F.col("tags"))).where("layer is not null")
    none = F.expr("cast(array() as array<bigint>)")
    by_node = points.select(F.col("node_id").alias("way_id"), "layer", kept.alias("tags"), none.alias("nodes"), F.array(F.struct("x", "y")).alias("points"))
    r = pbf.relations(elements).withColumn("layer", T.polygon_layer(F.col("tags"))).where(T.is_multipolygon(F.col("tags")) & F.col("layer").isNotNull())
    m = r.select("rel_id", F.posexplode("members").alias("pos", "m")).where("m.type = 'way'").select("rel_id", "pos", "m.role", F.col("m.ref").alias("way_id"))
    m = cut(m.join(r.select("rel_id", "layer"), "rel_id").join(lines.select("way_id", "points"), "way_id"))
    # Wide gaps are closed in water, and borders are drawn by 250 m.
    shapes = M.multipolygons(m.where(~F.col("layer").isin(WATER, BORDERS)))
    shapes = shapes.unionByName(M.multipolygons(m.where(F.col("layer") == WATER), gap=M.WATER_GAP)).unionByName(M.multipolygons(m.where(F.col("layer") == BORDERS), tolerance=250.0))
    xyf = F.transform("points", lambda p: F.struct(p["x"].cast("float").alias("x"), p["y"].cast("float").alias("y")))
    by_relation = shapes.withColumn("points", xyf).join(r.select("rel_id", "layer", kept.alias("tags")), "rel_id").select(F.col("rel_id").alias("way_id"), "layer", "tags", none.alias("nodes"), "points", "indices", "hole_starts")
    f = by_way.unionByName(by_node).unionByName(by_relation, allowMissingColumns=True)
    for c in ("indices", "hole_starts"):
        f = f.withColumn(c, F.coalesce(c, F.expr("cast(array() as array<int>)")))
    # The stops of the outline and of each hole.
    f = f.withColumn("_stops", F.concat("hole_starts", F.array(F.size("points"))))
    holes = F.aggregate(F.sequence(F.lit(1), F.size("_stops")), F.lit(0.0), lambda a, k: a + F.when(k < F.size("_stops"), F.abs(G.signed_area(_part(k - 1)))).otherwise(0.0))
    outline = G.signed_area(F.slice("points", F.lit(1), F.get("_stops", F.lit(0))))
    area = F.when(F.size("hole_starts") > 0, F.signum(outline) * (F.abs(outline) - holes)).otherwise(outline)
    return f.withColumn("area", area).withColumn("box", G.box(F.col("points"))).drop("_stops")


def _part(k):
    """The points of hole k."""
    start = F.get("_stops", k)
    return F.slice("points", start + 1, F.get("_stops", k + 1) - start)


def convert(spark: SparkSession, source: str, out: str, country: str = "PL", with_state: bool = True, key: bytes | None = None) -> None:
    """A PBF file to a folder: features, Parquet tiles, blocks, and beside them the network state."""
    elements = cut(pbf.read_pbf(spark, source))
    f = cut(features_of(elements))
    f.write.mode("overwrite").parquet(f"{out}/features")
    rows = C.tile_rows(f)
    C.write_tiles(rows, f"{out}/tiles")
    C.encode(rows).write.mode("overwrite").parquet(f"{out}/blocks")
    blocks = spark.read.parquet(f"{out}/blocks")
    if key:
        spark.createDataFrame([(state.sign_map(blocks, key),)], "signature binary").coalesce(1).write.mode("overwrite").parquet(f"{out}/signature")
    if with_state:
        build_network(spark, out, country, O.line_refs(*_routes(elements)))


def _routes(elements: DataFrame) -> tuple[DataFrame, DataFrame]:
    r = pbf.relations(elements).where(T.is_rail_route(F.col("tags")))
    m = r.select("rel_id", F.explode("members").alias("m")).select("rel_id", F.col("m.type").alias("member_type"), F.col("m.ref").alias("member_ref"))
    return r.select("rel_id", T.tag(F.col("tags"), "route").alias("t_route"), T.tag(F.col("tags"), "ref").alias("t_ref")), m


def build_network(spark: SparkSession, store: str, country: str = "PL", refs: DataFrame | None = None) -> str:
    """The network state of a converted map, written beside it; returns where."""
    f = spark.read.parquet(f"{store}/features")
    t = F.col("tags")
    lines = f.where((F.col("layer") == 1) & T.is_mainline(t) & (F.size("points") >= 2)).select("way_id", "tags", "nodes", "points")
    rail = f.where("layer = 1").select("way_id", F.explode("nodes").alias("node_id"))
    uses = rail.groupBy("node_id").agg(F.count_distinct("way_id").alias("uses"))
    if refs is None:
        refs = spark.createDataFrame([], "way_id bigint, line_ref string")
    nodes, edges = N.build_graph(N.raw_vertices(lines, uses, refs))
    tracks, stamps = N.build_tracks(nodes, edges)
    at = lambda df: df.select("*", F.get("points", F.lit(0))["x"].alias("x"), F.get("points", F.lit(0))["y"].alias("y"))
    name = lambda k: T.tag(t, k)
    stops = at(f.where((F.col("layer") == 8) & T.is_mainline_station(t))).select(F.col("way_id").alias("osm_id"), "x", "y", name("railway").alias("kind"), name("name").alias("name"))
    metre = [F.round("x"), F.round("y")]
    stops = cut(O.numbered(X.first_by(stops, [F.col("name"), *metre], ["osm_id"]), ["osm_id", "x", "y"], "station_id"))
    stations = N.snap(stops, "station_id", nodes, 200.0)
    places = at(f.where((F.col("layer") == 11) & name("name").isNotNull())).select("way_id", "x", "y", name("name").alias("name"), T.place_type(t).alias("place"), F.coalesce(name("population").try_cast("int"), F.lit(0)).alias("population"))
    signals = at(f.where("layer = 8").withColumn("function", T.signal_function(t)).where("function <> 'unknown'")).select("way_id", "x", "y", "function", T.signal_direction(t).alias("direction"), name("ref").alias("ref"))
    places = X.first_by(places, [F.col("name"), F.col("place")], ["way_id"])
    signals = X.first_by(signals, [F.round("x", 2), F.round("y", 2)], ["way_id"])
    signals = N.snap(signals, "way_id", nodes, 10.0).where("node_id is not null")
    rings = f.where((F.col("layer") == 6) & (F.size("points") >= 3)).withColumn("c", G.centroid(F.col("points")))
    rings = X.first_by(rings.select(F.col("way_id").alias("platform_id"), F.col("c.x").alias("x"), F.col("c.y").alias("y"), "points"), metre, ["platform_id"])
    platforms = N.snap(rings, "platform_id", nodes, 500.0).where("node_id is not null")
    entries = N.platform_entries(platforms.select("platform_id", "points"), cut(N.with_arc(tracks, edges, nodes)))
    gap = X.nearest_other(stations.select("station_id", "x", "y"), "station_id", 2000.0).select("station_id", (F.col("distance") / 2).alias("half_gap"))
    lines_at = N.platform_lines(platforms, entries, stations, edges, stamps)
    extents = N.station_extents(stations.join(gap, "station_id", "left").join(lines_at, "station_id", "left"), nodes, edges)
    sections = N.block_sections(edges, stations.where("kind = 'station' and node_id is not null").select("node_id"))
    regions = f.where((F.col("layer") == 10) & name("name").isNotNull()).select("way_id", name("name").alias("name"), name("admin_level").alias("level"), "points")
    edges = edges.join(stamps, "edge_id", "left").join(extents.select("edge_id", "station_id"), "edge_id", "left")
    path = state.state_path(f"{store}/features", country)
    parts = {"regions": regions, "nodes": nodes, "edges": edges, "tracks": tracks, "places": places, "stations": stations, "platforms": platforms.drop("points"), "entries": entries, "signals": signals, "sections": sections}
    state.write_state(path, parts, country, state.map_hash(spark.read.parquet(f"{store}/blocks")))
    return path


def summarize(spark: SparkSession, store: str) -> DataFrame:
    """Features and vertices by layer over all levels, with a grand total."""
    f = C.decode(spark.read.parquet(f"{store}/blocks")).select("layer", F.size("points").alias("v"))
    return f.rollup("layer").agg(F.count("*").alias("features"), F.sum("v").alias("vertices")).orderBy("layer")


def main(args: list[str], spark: SparkSession | None = None) -> int:
    p = argparse.ArgumentParser(prog="permaway", description="Maps and rail networks from OpenStreetMap data.")
    s = p.add_subparsers(dest="command", required=True)
    c = s.add_parser("convert", help="PBF to a folder of tiles and a network state")
    c.add_argument("source")
    c.add_argument("out")
    c.add_argument("--country", default="PL")
    c.add_argument("--no-state", action="store_true")
    c.add_argument("--sign-key", help="file with a private key of 32 bytes")
    for name, more in (("network", ["--country"]), ("summarize", []), ("verify", ["--public"]), ("fresh", ["--country"])):
        q = s.add_parser(name)
        q.add_argument("store")
        for m in more:
            q.add_argument(m, default="PL" if m == "--country" else None)
    s.add_parser("keys", help="write a new pair of keys").add_argument("path")
    a = p.parse_args(args)
    if a.command == "keys":
        for ending, key in zip((".priv", ".pub"), ed25519.new_keys(), strict=True):
            with open(a.path + ending, "wb") as f:
                f.write(key)
        return 0
    spark = spark or SparkSession.builder.getOrCreate()
    if a.command == "convert":
        key = None
        if a.sign_key:
            with open(a.sign_key, "rb") as f:
                key = f.read()
            if len(key) != 32:
                print("the key has to have 32 bytes", file=sys.stderr)
                return 1
        convert(spark, a.source, a.out, a.country.upper(), not a.no_state, key)
    elif a.command == "network":
        print(build_network(spark, a.store, a.country.upper()))
    elif a.command == "summarize":
        summarize(spark, a.store).show(100)
    elif a.command == "verify":
        with open(a.public, "rb") as f:
            public = f.read()
        signature = spark.read.parquet(f"{a.store}/signature").first().signature
        good = state.verify_map(spark.read.parquet(f"{a.store}/blocks"), bytes(public), bytes(signature))
        print("OK" if good else "FAIL")
        return 0 if good else 1
    elif a.command == "fresh":
        good = state.is_fresh(spark, state.state_path(f"{a.store}/features", a.country), a.country.upper(), state.map_hash(spark.read.parquet(f"{a.store}/blocks")))
        print("valid" if good else "stale")
        return 0 if good else 1
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
