"""Meshes, chains and codecs on shapes worked out by hand, and invariants."""

import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from conftest import SF

from permaway.functions import codec, ed25519
from permaway.functions import geometry as G
from permaway.functions import tags as T
from permaway.operators import mesh as M
from permaway.operators import network as N
from permaway.operators.components import connected_components
from permaway.plans import base as B
from permaway.sources import container, pbf, state

SQUARE = [(0, 0), (10, 0), (10, 10), (0, 10)]


def total(points, indices):
    return sum(abs(M.area([points[i] for i in indices[k : k + 3]])) for k in range(0, len(indices), 3))


def test_triangles_cover_rings():
    random.seed(3)
    for n in (3, 4, 9, 40, 200):
        ring = [((5 + 4 * random.random()) * math.cos(2 * math.pi * k / n), (5 + 4 * random.random()) * math.sin(2 * math.pi * k / n)) for k in range(n)]
        ring = sorted(ring, key=lambda p: math.atan2(p[1], p[0]))
        points, indices, _ = M.triangulate(ring)
        assert len(indices) == 3 * (n - 2)
        assert total(points, indices) == pytest.approx(abs(M.area(ring)), rel=1e-6)


def test_holes_are_left_out():
    holes = [[(2, 2), (4, 2), (4, 4), (2, 4)], [(6, 6), (8, 6), (8, 8), (6, 8)]]
    points, indices, starts = M.triangulate(SQUARE, holes)
    assert total(points, indices) == pytest.approx(100 - 8)
    assert starts == [4, 8]


def test_degenerate_rings_end():
    assert M.triangulate([(0, 0), (1, 1)]) == ([], [], [])
    points, indices, _ = M.triangulate([(0, 0), (10, 10), (10, 0), (0, 10)])
    assert len(points) == 4 and len(indices) % 3 == 0


def test_rings_are_stitched():
    ways = [[(0, 0), (10, 0)], [(10, 10), (10, 0.5)], [(10, 10), (0, 10)], [(0, 10), (0, 1)]]
    rings = M.stitch_rings(ways)
    assert len(rings) == 1 and abs(M.area(rings[0])) == pytest.approx(100, rel=0.1)
    assert M.stitch_rings([[(0, 0), (500, 0)], [(500, 0), (500, 500)]]) == []


def test_ring_roles():
    small = [(2, 2), (4, 2), (4, 4), (2, 4)]
    far = [(20, 20), (22, 20), (22, 22), (20, 22)]
    outer, inner = M.classify_rings([small, far, SQUARE])
    assert outer[0] == SQUARE and far in outer and inner == [small]


def test_lines_merge_in_order():
    assert M.merge_line([[(0, 0), (10, 0)], [(100, 0), (50, 0)], [(12, 0), (50, 3)]]) == [(0, 0), (10, 0), (50, 3), (50, 0)][:3] + [(100, 0)]
    assert M.merge_line([[(0, 0), (10, 0)], [(900, 0), (950, 0)]]) == [(0, 0), (10, 0)]


def test_simplify_matches_columns(spark):
    ring = [(float(i), float(i % 3)) for i in range(700)]
    df = spark.createDataFrame([([{"x": x, "y": y} for x, y in ring],)], "points array<struct<x:double,y:double>>")
    got = [(p["x"], p["y"]) for p in df.select(G.simplified(F.col("points"), 0.1).alias("p")).first().p]
    assert got == M.simplify(ring, 0.1)


def test_ring_in_ring_matches_python(spark):
    small, far = [(2.0, 2.0), (4.0, 2.0), (4.0, 4.0), (2.0, 4.0)], [(20.0, 20.0), (22.0, 20.0), (22.0, 22.0), (20.0, 22.0)]
    s = lambda r: [{"x": float(x), "y": float(y)} for x, y in r]
    df = spark.createDataFrame([(s(small), s(SQUARE)), (s(far), s(SQUARE))], "a array<struct<x:double,y:double>>, b array<struct<x:double,y:double>>")
    assert [r[0] for r in df.select(G.ring_in_ring(F.col("a"), F.col("b"))).collect()] == [True, False] == [M.ring_inside(small, SQUARE), M.ring_inside(far, SQUARE)]


def test_axis_of_a_long_box(spark):
    box = [{"x": x, "y": y} for x, y in ((0.0, 0.0), (40.0, 0.0), (40.0, 2.0), (0.0, 2.0))]
    a = spark.createDataFrame([(box,)], "points array<struct<x:double,y:double>>").select(G.major_axis(F.col("points")).alias("a")).first().a
    assert (a.cx, a.cy) == (20.0, 1.0) and a.half == pytest.approx(20.0) and abs(a.dir_x) == pytest.approx(1.0)


def test_ribbon_of_a_straight_line(spark):
    line = [{"x": 0.0, "y": 0.0}, {"x": 10.0, "y": 0.0}, {"x": 20.0, "y": 0.0}]
    band = G.with_ribbon(spark.createDataFrame([(line,)], "points array<struct<x:double,y:double>>"), F.lit(2.0)).first().band
    assert [(p.x, p.y) for p in band] == [(0, -2), (0, 2), (10, -2), (10, 2), (20, -2), (20, 2)]


@pytest.mark.parametrize("raw,speed", [("50", 50), (" 100 KM/H ", 100), ("80;60", 80), ("none", 0), ("PL:urban", 0), ("351", 0), ("", 0), (None, 0)])
def test_speeds(spark, raw, speed):
    assert spark.createDataFrame([(raw,)], "s string").select(T.max_speed(F.col("s"))).first()[0] == speed


def test_components_do_not_depend_on_order(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 101), (7, 7), (None, 3), (200, 150)]
    want = {**{i: 0 for i in range(61)}, 100: 100, 101: 100, 150: 150, 200: 150}
    for seed in (1, 2):
        random.Random(seed).shuffle(edges)
        got = connected_components(spark.createDataFrame(edges, "src long, dst long")).collect()
        assert {r.node: r.component for r in got} == want and len(got) == len(want)
    assert connected_components(spark.createDataFrame([], "src long, dst long")).count() == 0


def test_tracks_part_the_segments(spark):
    n, e = B.graph(spark, SF)
    t, stamps = N.build_tracks(n, e)
    assert stamps.count() == e.count() == stamps.select("edge_id").distinct().count()
    assert t.agg(F.sum(F.size("edge_ids"))).first()[0] * 2 == e.count()
    lengths = t.agg(F.sum("length")).first()[0], e.agg(F.sum("length")).first()[0] / 2
    assert lengths[0] == pytest.approx(lengths[1])


def test_chains_start_at_their_canonical_end():
    names = ["chain", "edge_id", "pair", "from_node", "to_node", "length", "way_id", "i", "fx", "fy", "from_degree"]
    at, degree = {1: (0.0, 5.0), 2: (1.0, 3.0), 3: (2.0, 1.0), 7: (0.0, 0.0), 8: (1.0, 0.0), 9: (1.0, 1.0)}, {1: 1, 2: 2, 3: 3, 7: 2, 8: 2, 9: 2}
    legs = [(5, 0, 1, 2), (5, 1, 2, 3), (6, 2, 8, 9), (6, 3, 9, 7), (6, 4, 7, 8)]
    rows = [(c, 2 * p + k, p, u, v, 1.0, 100, p, *at[u], degree[u]) for c, p, x, y in legs for k, (u, v) in enumerate([(x, y), (y, x)])]
    got = N._ordered_chains(pd.DataFrame(rows[::-1], columns=names))
    assert got[["chain", "start_node", "end_node", "length"]].values.tolist() == [[5, 3, 1, 2.0], [6, 8, 8, 3.0]]
    assert got["edge_ids"].tolist() == [[3, 1], [4, 6, 8]] and got["track_key"][0] == N.fnv1a64([(100, 1), (100, 0)])


def test_fnv():
    assert N.fnv1a64([]) == 14695981039346656037 - (1 << 64)
    assert N.fnv1a64([(2, 1), (1, 0), (2, 1)]) == N.fnv1a64([(1, 0), (2, 1)])


def test_extent_stays_on_known_lines():
    e = pd.DataFrame([(0, 0, 1, 50.0, "7"), (1, 1, 2, 50.0, "8"), (2, 1, 3, 50.0, None)], columns=["edge_id", "from_node", "to_node", "length", "line_ref"])
    rows = e.assign(station_id=4, start=0, extent=500.0, seed="")
    assert dict(N._reach(rows)[["edge_id", "distance"]].values) == {0: 0.0, 2: 50.0}
    assert set(N._reach(rows.assign(seed="7;8"))["edge_id"]) == {0, 1, 2}


def test_sections_stop_at_stations_and_on_rings():
    ring = [(0, 0, 1), (1, 1, 0), (2, 1, 2), (3, 2, 1), (4, 2, 0), (5, 0, 2)]
    e = pd.DataFrame([(0, k, k // 2, u, v, 10.0, 0, "", False, False) for k, u, v in ring], columns=["part", "edge_id", "pair", "from_node", "to_node", "length", "max_speed", "track_ref", "from_stop", "to_stop"])
    s = N._sections(e)
    assert sorted(x for ids in s["edge_ids"] for x in ids) == [0, 1, 2, 3, 4, 5] and set(s["max_speed"]) == {80}
    e.loc[e["from_node"] == 0, "from_stop"] = True
    e.loc[e["to_node"] == 0, "to_stop"] = True
    s = N._sections(e)
    assert "station" in set(s["start_boundary"]) | set(s["end_boundary"])


def test_numbers_and_planes_round_trip():
    for n in (0, 1, 127, 128, 300, 2**31, 2**40):
        out = bytearray()
        codec.put_varint(n, out)
        assert codec.get_varint(bytes(out), 0) == (n, len(out))
    data = bytes((i * 2654435761 % 2**32 >> 24) & 255 for i in range(28_003))
    assert codec.unshuffle(codec.shuffle(data, 4), 4) == data


def test_blocks_round_trip():
    poi = {"points": [(21.5, 53.25)], "metadata": {"railway": "signal", "ref": "A3"}}
    rail = {"points": [(0, 0), (5, 1), (9, 2)], "indices": [0, 1, 1, 2], "segment_ids": [100, 100], "junctions": [0, 2], "metadata": {"railway": "rail"}}
    wide = {"points": [(0.5 * i, 0.25 * i) for i in range(70_000)], "indices": [0, 69_999, 35_000], "metadata": {"natural": "wood"}}
    hole = {"points": [*SQUARE, (2, 2), (4, 2), (4, 4)], "indices": [0, 1, 2, 0, 2, 3], "hole_starts": [4], "metadata": {}}
    layers = {8: [poi], 1: [rail, rail], 7: [wide], 3: [hole]}
    block, size, mask = codec.encode_block(layers)
    assert mask == 1 << 8 | 1 << 1 | 1 << 7 | 1 << 3 and size > len(block)
    back = codec.decode_block(block)
    for layer, features in layers.items():
        for f, g in zip(features, back[layer], strict=True):
            assert all(list(f.get(k, [])) == list(g[k]) for k in ("points", "indices", "hole_starts", "segment_ids", "junctions"))
            assert f["metadata"] == g["metadata"]
    assert codec.decode_block(block, {1, 3}) == {1: back[1], 3: back[3]}
    assert codec.block_hash(b"") == "0" * 64


def test_pbf_file(spark, tmp_path):
    e = [
        {"kind": "node", "id": 5, "lat": 52.25, "lon": -19.5, "tags": {"place": "city", "name": "Łódź"}},
        {"kind": "node", "id": -3, "lat": -1.0, "lon": 2.0, "tags": {}},
        {"kind": "way", "id": 9, "tags": {"highway": "road"}, "nodes": [5, -3, 5]},
        {"kind": "relation", "id": 2, "tags": {"type": "route"}, "members": [{"type": "way", "ref": 9, "role": "outer"}, {"type": "node", "ref": 5, "role": ""}]},
    ]
    (tmp_path / "x.osm.pbf").write_bytes(pbf.frame(b"\x1a\x00", b"OSMHeader") + pbf.frame(pbf.encode_blob(e[:2])) + pbf.frame(pbf.encode_blob(e[2:])))
    got = pbf.read_pbf(spark, str(tmp_path / "x.osm.pbf"))
    n = {r.node_id: r for r in pbf.nodes(got).collect()}
    assert n[5].tags == e[0]["tags"] and n[5].lat == pytest.approx(52.25) and n[-3].lon == pytest.approx(2.0)
    assert pbf.ways(got).first().nodes == [5, -3, 5]
    assert [(m.type, m.ref, m.role) for m in pbf.relations(got).first().members] == [("way", 9, "outer"), ("node", 5, "")]


def test_signatures_and_state(spark, tmp_path):
    private = bytes.fromhex("9d61b19deffd5a60ba844af492ec2cc44449c5697b326919703bac031cae7f60")  # first test of RFC 8032
    public = ed25519.public_key(private)
    assert public.hex() == "d75a980182b10ab7d54bfed3c964073a0ee172f3daa62325af021a68f707511a"
    assert ed25519.sign(private, b"").hex().startswith("e5564300c360ac729086e2cc806e828a84877f1eb8e5d974d873e06522490155")
    blocks = container.encode(container.tile_rows(B.features(spark, SF).where("layer = 3")))
    s = state.sign_map(blocks, private)
    assert state.verify_map(blocks, public, s) and not state.verify_map(blocks, public, None)
    other = blocks.withColumn("block", F.concat("block", F.lit(b"x")))
    assert not state.verify_map(other, public, s) and not state.verify_map(blocks.where("lod < 5"), public, s)
    assert ed25519.verify(*(lambda k: (k[1], b"m", ed25519.sign(k[0], b"m")))(ed25519.new_keys()))
    df = spark.range(50).withColumn("x", F.col("id") * 2)
    assert state.fingerprint(df) == state.fingerprint(df.orderBy(F.desc("id"))) != state.fingerprint(df.where("id < 49"))
    path = str(tmp_path / "s")
    assert not state.is_fresh(spark, path)
    state.write_state(path, {"a": df}, "PL", "h")
    assert state.is_fresh(spark, path, "PL", "h") and not state.is_fresh(spark, path, "PL", "g")
    assert state.read_state(spark, path)["a"].count() == 50
    assert state.state_path("/maps/x.bin", "PL") == "/maps/state-pl"


def test_projection_centre_is_the_origin(spark):
    from permaway.operators.features import projected

    n = spark.createDataFrame([(1, 50.0, 19.0), (2, 52.0, 21.0)], "node_id long, lat double, lon double")
    p = {r.node_id: r for r in projected(n).collect()}
    assert p[1].y == -p[2].y and np.isclose(p[2].y, math.pi * 6371000 / 180, rtol=1e-6)
