"""A small map from PBF to a signed store and its network, through the command line."""

from permaway import engine
from permaway.sources import pbf, state


def elements():
    at = {}
    for y in range(3):
        for x in range(6):
            at[y * 10 + x] = (52.0 + y * 0.002, 19.0 + x * 0.004)
    out = [{"kind": "node", "id": i, "lat": a, "lon": b, "tags": {}} for i, (a, b) in at.items()]
    out[1]["tags"] = {"railway": "station", "name": "Alpha"}
    out[4]["tags"] = {"railway": "station", "name": "Beta"}
    out[9]["tags"] = {"place": "town", "name": "Gamma", "population": "1200"}
    out[3]["tags"] = {"railway": "signal", "railway:signal:main:function": "entry"}
    way = lambda i, nodes, tags: {"kind": "way", "id": i, "nodes": nodes, "tags": tags}
    out += [way(1, [0, 1, 2], {"railway": "rail", "usage": "main"}), way(2, [2, 3, 4, 5], {"railway": "rail", "maxspeed": "100"}), way(3, [2, 12, 22], {"railway": "rail"}), way(4, [10, 11, 21, 20, 10], {"building": "yes"})]
    out += [way(5, [13, 14, 24], {}), way(6, [24, 23, 13], {}), way(7, [0, 10, 20], {"highway": "primary"})]
    out.append({"kind": "relation", "id": 50, "tags": {"type": "multipolygon", "natural": "water"}, "members": [{"type": "way", "ref": 5, "role": "outer"}, {"type": "way", "ref": 6, "role": "outer"}]})
    out.append({"kind": "relation", "id": 51, "tags": {"type": "route", "route": "railway", "ref": "7"}, "members": [{"type": "way", "ref": 1, "role": ""}]})
    return out


def test_from_file_to_network(spark, tmp_path, capsys):
    source, store, keys = str(tmp_path / "x.osm.pbf"), str(tmp_path / "map"), str(tmp_path / "k")
    (tmp_path / "x.osm.pbf").write_bytes(pbf.frame(pbf.encode_blob(elements())))
    run = lambda *a: engine.main(list(a), spark)
    assert run("keys", keys) == 0
    assert run("convert", source, store, "--country", "pl", "--sign-key", keys + ".priv") == 0
    layers = {r.layer: r.features for r in spark.read.parquet(f"{store}/features").groupBy("layer").count().withColumnRenamed("count", "features").collect()}
    assert layers == {0: 1, 1: 3, 2: 1, 3: 1, 8: 3, 11: 1}
    parts = state.read_state(spark, state.state_path(f"{store}/features", "PL"))
    assert parts["nodes"].count() == 8 and parts["edges"].count() == 14 and parts["tracks"].count() == 3
    assert parts["stations"].where("node_id is not null").count() == 2 and parts["signals"].count() == 1
    assert parts["edges"].where("line_ref = '7'").count() == 4
    assert run("summarize", store) == 0 and run("verify", store, "--public", keys + ".pub") == 0
    assert run("fresh", store) == 0 and run("fresh", store, "--country", "DE") == 1
    spark.read.parquet(f"{store}/blocks").limit(1).write.mode("overwrite").parquet(f"{store}/signed-less")
    assert not state.verify_map(spark.read.parquet(f"{store}/signed-less"), (tmp_path / "k.pub").read_bytes(), bytes(spark.read.parquet(f"{store}/signature").first().signature))


def test_holes_count_against_area(spark, tmp_path):
    nodes = [{"kind": "node", "id": 10 * k + i, "lat": 52.0 + dy, "lon": 19.0 + dx, "tags": {}} for k, side in ((0, 0.01), (1, 0.002)) for i, (dx, dy) in enumerate([(a + 0.001 * k, b + 0.001 * k) for a, b in ((0, 0), (side, 0), (side, side), (0, side))])]
    ways = [{"kind": "way", "id": k, "nodes": [10 * k, 10 * k + 1, 10 * k + 2, 10 * k + 3, 10 * k], "tags": {}} for k in (0, 1)]
    lake = lambda i, members: {"kind": "relation", "id": i, "tags": {"type": "multipolygon", "natural": "water"}, "members": [{"type": "way", "ref": w, "role": r} for w, r in members]}
    (tmp_path / "x.osm.pbf").write_bytes(pbf.frame(pbf.encode_blob([*nodes, *ways, lake(50, [(0, "outer")]), lake(51, [(0, "outer"), (1, "inner")])])))
    got = {r.way_id: r for r in engine.features_of(pbf.read_pbf(spark, str(tmp_path / "x.osm.pbf"))).where("layer = 3").collect()}
    whole, ring = abs(got[50].area), abs(got[51].area)
    assert abs(ring / whole - 0.96) < 0.002 and len(got[51].hole_starts) == 1 and len(got[51].indices) > len(got[50].indices)
