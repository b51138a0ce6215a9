"""From railway lines to a network: nodes, edges, tracks, station extents and block sections."""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from permaway.functions import geometry as G
from permaway.functions import tags as T
from permaway.operators.components import connected_components
from permaway.operators.features import numbered
from permaway.operators.scratch import cut
from permaway.operators.spatial import cells, nearest

MERGE_RADIUS, RESCUE_RADIUS, MOST_OFFSET = 10.0, 2.5, 1.0


def raw_vertices(lines: DataFrame, uses: DataFrame, line_refs: DataFrame | None = None) -> DataFrame:
    """A row for each vertex of lines(way_id, tags, nodes, points), in the order (way, place):
    raw_id, segment_id, position, direction, whether ways meet there or the line ends."""
    v = lines.select("way_id", "tags", F.size("points").alias("n"), F.posexplode(F.arrays_zip("nodes", "points")).alias("i", "p"))
    v = v.select("way_id", "tags", "n", "i", F.col("p.nodes").alias("osm_node"), F.col("p.points.x").alias("x"), F.col("p.points.y").alias("y"))
    v = v.join(uses.where("uses > 1").select(F.col("node_id").alias("osm_node"), F.lit(True).alias("is_junction")), "osm_node", "left")
    v = numbered(v.withColumn("is_junction", F.coalesce("is_junction", F.lit(False))), ["way_id", "i"], "raw_id")
    w = Window.partitionBy("way_id").orderBy("i")
    near = lambda c, k: F.coalesce(F.lag(c, k).over(w) if k > 0 else F.lead(c, -k).over(w), F.col(c)).cast("double")
    dx, dy = near("x", -1) - near("x", 1), near("y", -1) - near("y", 1)
    size = F.sqrt(dx * dx + dy * dy)
    v = v.withColumn("dir_x", F.when(size > 0.001, dx / size).otherwise(1.0)).withColumn("dir_y", F.when(size > 0.001, dy / size).otherwise(0.0))
    # A line of n vertices has n - 1 segments, numbered from 1 through all lines in order: raw_id less the lines before.
    first = F.first("raw_id").over(w.rowsBetween(Window.unboundedPreceding, 0))
    lines_before = numbered(lines.select("way_id"), ["way_id"], "_line").withColumnRenamed("way_id", "_w")
    v = v.withColumn("_first", first).join(lines_before, F.col("way_id") == F.col("_w"))
    v = v.withColumn("segment_id", F.when(F.col("i") < F.col("n") - 1, F.col("raw_id") - F.col("_line") + 1)).drop("_w", "_line", "_first")
    v = v.withColumn("is_end", (F.col("i") == 0) | (F.col("i") == F.col("n") - 1)).withColumn("track_ref", F.coalesce(T.tag(F.col("tags"), "railway:track_ref"), F.lit("")))
    if line_refs is not None:
        v = v.join(line_refs, "way_id", "left")
    return v


def _refs_differ(a: str, b: str) -> str:
    return f"{a}.track_ref <> '' and {b}.track_ref <> '' and {a}.track_ref <> {b}.track_ref"


def merge_pairs(v: DataFrame) -> DataFrame:
    """(a, b) of vertices that are one place: within ten metres if both are junctions or ends and
    lie along the direction of the later; within two and a half, any two that lie along the
    direction of the earlier. Whether a pair merges does not depend on other merges.

    Vertices at one position are first tied to the smallest of those that are alike for
    all tests, so that a place where very many lines meet gives no pairs of them all."""
    c = ["raw_id", "x", "y", "dir_x", "dir_y", "is_junction", "is_end", "track_ref"]
    v = v.select(*c)
    reach = cells(v, "x", "y", MERGE_RADIUS, 1).alias("i")
    home = cells(v, "x", "y", MERGE_RADIUS).alias("j")
    same = (F.col("i.cell_x") == F.col("j.cell_x")) & (F.col("i.cell_y") == F.col("j.cell_y"))
    d = G.distance(F.col("i.x"), F.col("i.y"), F.col("j.x"), F.col("j.y"))
    off = F.abs((F.col("j.x").cast("double") - F.col("i.x")) * -F.col("i.dir_y") + (F.col("j.y").cast("double") - F.col("i.y")) * F.col("i.dir_x"))
    p = reach.join(home, same & (F.col("i.raw_id") != F.col("j.raw_id"))).where((d <= MERGE_RADIUS) & (off <= MOST_OFFSET))
    open_ends = "(i.is_junction or i.is_end) and (j.is_junction or j.is_end)"
    wide = F.expr(f"j.raw_id < i.raw_id and {open_ends} and not (not i.is_junction and not j.is_junction and {_refs_differ('i', 'j')})")
    close = F.expr(f"i.raw_id < j.raw_id and not ({_refs_differ('i', 'j')})") & (d <= RESCUE_RADIUS)
    return p.where(wide | close).select(F.least("i.raw_id", "j.raw_id").alias("a"), F.greatest("i.raw_id", "j.raw_id").alias("b")).distinct()


def build_graph(v: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(nodes, edges) of raw vertices. Nodes are components of merged vertices at their mean
    position, numbered by their first vertex; an edge joins two nodes that follow each other on
    a line, once for a pair of nodes, the first line's; each edge has a twin the other way."""
    v = cut(v)
    comp = connected_components(merge_pairs(v), "a", "b").select(F.col("node").alias("raw_id"), "component")
    v = cut(v.join(comp, "raw_id", "left").withColumn("component", F.coalesce("component", "raw_id")))
    g = v.groupBy("component").agg(F.avg(F.col("x").cast("double")).cast("float").alias("x"), F.avg(F.col("y").cast("double")).cast("float").alias("y"), F.max("is_junction").alias("is_junction"), F.count("*").alias("vertices"))
    nodes = cut(numbered(g, ["component"], "node_id"))
    v = v.join(nodes.select("component", "node_id"), "component")
    w = Window.partitionBy("way_id").orderBy("i")
    leg = F.coalesce(G.distance(F.lag("x").over(w), F.lag("y").over(w), F.col("x"), F.col("y")), F.lit(0.0))
    runs = v.withColumn("leg", leg).withColumn("arc", F.sum("leg").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    runs = runs.withColumn("new", F.coalesce(F.lag("node_id").over(w) != F.col("node_id"), F.lit(True))).where("new")
    e = runs.select(
        "way_id", "i", "raw_id", "segment_id", "tags", F.col("track_ref"), *([F.col("line_ref")] if "line_ref" in v.columns else []),
        F.col("node_id").alias("u"), F.lead("node_id").over(w).alias("v"), (F.lead("arc").over(w) - F.col("arc")).alias("length"),
    ).where("v is not null")
    e = e.withColumn("lo", F.least("u", "v")).withColumn("hi", F.greatest("u", "v"))
    # The first of a pair of nodes is an aggregate, so parallel lines are not gathered.
    first = e.groupBy("lo", "hi").agg(F.min("raw_id").alias("raw_id"))
    e = numbered(e.join(first, ["lo", "hi", "raw_id"]), ["raw_id"], "pair")
    e = e.withColumn("max_speed", T.resolved_speed(F.col("tags"))).drop("lo", "hi", "tags")
    both = F.array(F.struct(F.lit(0).alias("k"), F.col("u").alias("from_node"), F.col("v").alias("to_node")), F.struct(F.lit(1).alias("k"), F.col("v").alias("from_node"), F.col("u").alias("to_node")))
    e = e.withColumn("t", F.explode(both)).select((F.col("pair") * 2 + F.col("t.k")).alias("edge_id"), "pair", "t.from_node", "t.to_node", "segment_id", "length", "max_speed", "track_ref", *(["line_ref"] if "line_ref" in v.columns else []), "way_id", "i", (F.col("t.k") == 0).alias("is_forward"))
    return nodes, cut(e)


def twins(edges: DataFrame) -> DataFrame:
    """(edge_id, twin_id): edges of one segment between the same nodes, the other way."""
    a, b = edges.select("edge_id", "from_node", "to_node", "segment_id"), edges.select(F.col("edge_id").alias("twin_id"), F.col("from_node").alias("to_node"), F.col("to_node").alias("from_node"), "segment_id")
    return a.join(b, ["from_node", "to_node", "segment_id"]).select("edge_id", "twin_id")


def fnv1a64(items: list[tuple[int, int]]) -> int:
    """FNV-1a, 64 bits, over way number (8 bytes) and vertex (4 bytes), little end first; signed."""
    h = 14695981039346656037
    for way, vertex in sorted(set(items)):
        for byte in int(way).to_bytes(8, "little", signed=True) + int(vertex).to_bytes(4, "little"):
            h = (h ^ byte) * 1099511628211 & 0xFFFFFFFFFFFFFFFF
    return h - (1 << 64) if h >> 63 else h


TRACK = "chain bigint, track_key bigint, start_node bigint, end_node bigint, length double, edge_ids array<bigint>"


#: Rows of the network that one group holds on average; groups are whole chains or parts, by hash.
GROUP_ROWS = 20_000


def _runs(keys: list):
    """(start, stop) of the runs of equal keys."""
    a = 0
    for b in range(1, len(keys) + 1):
        if b == len(keys) or keys[b] != keys[a]:
            yield a, b
            a = b


def _ordered_chains(pdf: pd.DataFrame) -> pd.DataFrame:
    """Chains of segments through nodes of two edges, each in the order from its canonical end."""
    pdf = pdf.sort_values(["chain", "edge_id"])
    chain, edge, pair, source, target, length, way, i, fx, fy, degree = (pdf[c].tolist() for c in ("chain", "edge_id", "pair", "from_node", "to_node", "length", "way_id", "i", "fx", "fy", "from_degree"))
    found = []
    for a, b in _runs(chain):
        out: dict[int, list[int]] = {}
        for r in range(a, b):
            out.setdefault(source[r], []).append(r)
        ends = [((round(fy[rows[0]] * 1000), round(fx[rows[0]] * 1000), n), n) for n, rows in out.items() if degree[rows[0]] != 2]
        start = min(ends)[1] if ends else source[a]
        stops = {n for _, n in ends}
        done, rows, node = set(), [], start
        while True:
            step = next((r for r in out.get(node, ()) if pair[r] not in done), None)
            if step is None or (rows and node in stops):
                break
            done.add(pair[step])
            rows.append(step)
            node = target[step]
        key = fnv1a64([(way[r], i[r]) for r in rows])
        found.append([chain[a], key, start, node, float(sum(length[r] for r in rows)), [edge[r] for r in rows]])
    return pd.DataFrame(found, columns=[x.split()[0] for x in TRACK.split(", ")])


def by_bucket(rows: DataFrame, key: str, run, schema: str) -> DataFrame:
    """run over groups of whole keys, dealt out by a hash of the key so that many small ones share a
    call; rows is a cut table, whose count sets the number of groups."""
    buckets = max(1, rows.count() // GROUP_ROWS)
    return cut(rows.groupBy(F.pmod(F.xxhash64(key), F.lit(buckets)).alias("bucket")).applyInPandas(lambda pdf: run(pdf), schema))


def build_tracks(nodes: DataFrame, edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(tracks, edge_track): maximal chains of segments through nodes of exactly two edges.

    Chains are components of segments that share such a node; only the order within a chain
    is worked out in Python, many chains to a call, and written down before chains are
    numbered. A chain runs from the end that is first by (y, x, id) in millimetres; a ring
    starts at its lowest edge."""
    edges = cut(edges)
    degree = cut(edges.groupBy(F.col("from_node").alias("node_id")).agg(F.count("*").alias("degree")))
    through = edges.join(degree.where("degree = 2").select(F.col("node_id").alias("from_node")), "from_node")
    share = through.groupBy("from_node").agg(F.min("pair").alias("a"), F.max("pair").alias("b"))
    comp = connected_components(share, "a", "b").select(F.col("node").alias("pair"), F.col("component").alias("chain"))
    chained = edges.join(comp, "pair", "left").withColumn("chain", F.coalesce("chain", "pair"))
    place = nodes.join(degree, "node_id").select(F.col("node_id").alias("from_node"), F.col("x").cast("double").alias("fx"), F.col("y").cast("double").alias("fy"), F.col("degree").alias("from_degree"))
    rows = cut(chained.join(place, "from_node").select("chain", "pair", "edge_id", "from_node", "to_node", "length", "way_id", "i", "fx", "fy", "from_degree"))
    tracks = cut(numbered(by_bucket(rows, "chain", _ordered_chains, TRACK), ["chain"], "track_index"))
    return tracks, rows.join(tracks.select("chain", "track_index"), "chain").select("edge_id", "track_index")


def with_arc(tracks: DataFrame, edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """The segments of tracks in order with both ends and the length before them."""
    s = tracks.select("track_index", F.posexplode("edge_ids").alias("k", "edge_id")).join(edges.select("edge_id", "from_node", "to_node", "length"), "edge_id")
    a = nodes.select(F.col("node_id").alias("from_node"), F.col("x").alias("ax"), F.col("y").alias("ay"))
    b = nodes.select(F.col("node_id").alias("to_node"), F.col("x").alias("bx"), F.col("y").alias("by"))
    w = Window.partitionBy("track_index").orderBy("k").rowsBetween(Window.unboundedPreceding, -1)
    return s.join(a, "from_node").join(b, "to_node").withColumn("arc", F.coalesce(F.sum("length").over(w), F.lit(0.0)))


#: Pieces of a cell's side that a segment is cut into at once; a longer one is narrowed down before.
MOST_PIECES = 64


def near_parts(segments: DataFrame, points: DataFrame, radius: float, side: float) -> DataFrame:
    """segments with the ends _ax, _ay, _bx, _by of what may be within the radius of points(x, y): a
    segment of up to MOST_PIECES sides whole, of a longer one the parts that are near a point.

    A long segment is halved three times over; parts that touch no cell with a point go, cells
    being as wide as parts are long. So rows follow the points that it passes, not its length."""
    ends = ("ax", "ay", "bx", "by")
    double = {c: F.col(c).cast("double") for c in ends}
    span = F.greatest(F.abs(double["bx"] - double["ax"]), F.abs(double["by"] - double["ay"]))
    whole, most = segments.select("*", *[v.alias("_" + c) for c, v in double.items()]), MOST_PIECES * side
    far = cut(segments.where(span > most).withColumn("_l", F.ceil(F.log2(span / most) / 3).cast("int")))
    top = far.agg(F.max("_l")).first()[0]
    if top is None:
        return whole
    points, parts = cut(points.select("x", "y")), None
    place = lambda c, k, level: f"(cast(a{c} as double) + (cast(b{c} as double) - cast(a{c} as double)) * ({k}) / pow(8D, _l - {level}))"
    for level in range(top - 1, -1, -1):
        p = far.where(F.col("_l") == level + 1).withColumn("_p", F.lit(0).cast("bigint"))
        p = p if parts is None else p.unionByName(parts)
        p, wide = p.withColumn("_p", F.expr("explode(transform(sequence(0, 7), i -> _p * 8 + i))")), most * 8.0**level
        for c in "xy":
            a, b = place(c, "_p", level), place(c, "_p + 1", level)
            p = p.withColumn(f"cell_{c}", F.expr(f"explode(sequence(cast(floor((least({a}, {b}) - {radius}D) / {wide!r}D) as bigint), cast(floor((greatest({a}, {b}) + {radius}D) / {wide!r}D) as bigint)))"))
        parts = cut(p.join(cells(points, "x", "y", wide).select("cell_x", "cell_y").distinct(), ["cell_x", "cell_y"], "left_semi").drop("cell_x", "cell_y").distinct())
    parts = parts.select(*segments.columns, *[F.expr(place(c, k, 0)).alias(f"_{e}{c}") for e, k in (("a", "_p"), ("b", "_p + 1")) for c in "xy"])
    return whole.where(span <= most).unionByName(parts)


def in_cells(segments: DataFrame, radius: float, side: float, mark: str = "") -> DataFrame:
    """segments(ax, ay, bx, by, ...) with cell_x and cell_y: a row for each cell within the radius of
    their pieces' boxes, once. The ends' names begin with the mark.

    A piece is one row, and gives the cells of its box that the piece before did not have:
    boxes move one way along a segment, so that no other can have had them. No list is
    longer than one box or the number of pieces, however long a segment is."""
    ends = {c: f"cast({mark}{c} as double)" for c in ("ax", "ay", "bx", "by")}
    pieces = f"greatest(1, cast(ceil(greatest(abs({ends['bx']} - {ends['ax']}), abs({ends['by']} - {ends['ay']})) / {side}D) as int))"
    place = lambda c, k: f"({ends['a' + c]} + ({ends['b' + c]} - {ends['a' + c]}) * ({k}) / _n)"
    lo = lambda c, p: f"cast(floor((least({place(c, p)}, {place(c, p + ' + 1')}) - {radius}D) / {side}D) as bigint)"
    hi = lambda c, p: f"cast(floor((greatest({place(c, p)}, {place(c, p + ' + 1')}) + {radius}D) / {side}D) as bigint)"
    s = segments.withColumn("_n", F.expr(pieces)).withColumn("_p", F.expr("explode(sequence(0, _n - 1))"))
    s = s.withColumn("cell_x", F.expr(f"explode(sequence({lo('x', '_p')}, {hi('x', '_p')}))")).withColumn("cell_y", F.expr(f"explode(sequence({lo('y', '_p')}, {hi('y', '_p')}))"))
    had = " and ".join(f"cell_{c} between {lo(c, '_p - 1')} and {hi(c, '_p - 1')}" for c in "xy")
    return s.where(f"_p = 0 or not ({had})").drop("_n", "_p")


def projections(points: DataFrame, segments: DataFrame, radius: float, side: float = 64.0) -> DataFrame:
    """For points(pid, x, y) and track segments: (pid, track_index, distance, arc, side) of the
    nearest place of each track within the radius. Segments are cut into pieces of a cell's side and
    put in every cell that the pieces' boxes, widened by the radius, touch; long ones only where
    points are (`near_parts`). Cells are no smaller than the radius, so that a piece touches
    sixteen at most."""
    side = max(side, radius)
    s = in_cells(near_parts(segments, points, radius, side), radius, side, "_").drop("_ax", "_ay", "_bx", "_by")
    j = cells(points, "x", "y", side).join(s, ["cell_x", "cell_y"])
    dx, dy = F.col("bx").cast("double") - F.col("ax"), F.col("by").cast("double") - F.col("ay")
    l2 = dx * dx + dy * dy
    t = F.when(l2 > 1e-9, F.least(F.greatest(((F.col("x") - F.col("ax")) * dx + (F.col("y") - F.col("ay")) * dy) / l2, F.lit(0.0)), F.lit(1.0))).otherwise(0.0)
    j = j.withColumn("t", t).withColumn("qx", F.col("ax") + F.col("t") * dx).withColumn("qy", F.col("ay") + F.col("t") * dy)
    j = j.withColumn("distance", G.distance(F.col("x"), F.col("y"), F.col("qx"), F.col("qy"))).where(F.col("distance") <= radius)
    cross = dx * (F.col("y") - F.col("qy")) - dy * (F.col("x") - F.col("qx"))
    j = j.select("pid", "track_index", "k", "distance", (F.col("arc") + F.col("t") * F.col("length")).alias("arc"), F.signum(cross).cast("int").alias("side"))
    return j.groupBy("pid", "track_index").agg(F.min(F.struct("distance", "k", "arc", "side")).alias("b")).select("pid", "track_index", "b.distance", "b.arc", "b.side")


def platform_entries(platforms: DataFrame, segments: DataFrame, radius: float = 30.0) -> DataFrame:
    """(platform_id, rank, track_index, from_m, to_m) of platforms(platform_id, points): the nearest
    track within the radius of the centre, and the next one if it lies on the other side."""
    p = platforms.withColumn("axis", G.major_axis(F.col("points")))
    centre = projections(p.select(F.col("platform_id").alias("pid"), F.col("axis.cx").alias("x"), F.col("axis.cy").alias("y")), segments, radius)
    w = Window.partitionBy("pid").orderBy("distance", "track_index")
    two = centre.withColumn("rank", F.row_number().over(w)).where("rank <= 2").withColumn("first_side", F.first("side").over(w))
    two = two.where("rank = 1 or (side <> 0 and first_side <> 0 and side <> first_side)").select(F.col("pid").alias("platform_id"), "track_index", "rank")
    ends = F.array(*[F.struct((F.col("axis.cx") + s * F.col("axis.half") * F.col("axis.dir_x")).alias("px"), (F.col("axis.cy") + s * F.col("axis.half") * F.col("axis.dir_y")).alias("py")) for s in (-1.0, 1.0)])
    e = p.join(two, "platform_id").select("platform_id", "rank", "track_index", F.explode(ends).alias("e")).select("platform_id", "rank", "track_index", "e.*")
    j = e.join(segments, "track_index")
    dx, dy = F.col("bx").cast("double") - F.col("ax"), F.col("by").cast("double") - F.col("ay")
    l2 = dx * dx + dy * dy
    t = F.when(l2 > 1e-9, F.least(F.greatest(((F.col("px") - F.col("ax")) * dx + (F.col("py") - F.col("ay")) * dy) / l2, F.lit(0.0)), F.lit(1.0))).otherwise(0.0)
    j = j.withColumn("t", t)
    d = G.distance(F.col("px"), F.col("py"), F.col("ax") + F.col("t") * dx, F.col("ay") + F.col("t") * dy)
    at = j.groupBy("platform_id", "rank", "track_index", "px", "py").agg(F.min(F.struct(d.alias("d"), "k", (F.col("arc") + F.col("t") * F.col("length")).alias("arc"))).alias("b"))
    return at.groupBy("platform_id", "rank", "track_index").agg(F.min("b.arc").alias("from_m"), F.max("b.arc").alias("to_m"))


EXTENT = "station_id bigint, edge_id bigint, distance double"


def _reach(pdf: pd.DataFrame) -> pd.DataFrame:
    """Edges that a station reaches along its lines, with the way to their beginning.

    A numbered edge is open if the station knows one of its lines; a station that knows
    none takes those of the first numbered edge it meets."""
    station, start, limit = int(pdf["station_id"].iloc[0]), int(pdf["start"].iloc[0]), float(pdf["extent"].iloc[0])
    known = set((pdf["seed"].iloc[0] or "").split(";")) - {""}
    out: dict[int, list] = {}
    for r in pdf.sort_values("edge_id").itertuples():
        out.setdefault(r.from_node, []).append(r)
    best, dist, heap = {}, {start: 0.0}, [(0.0, start)]
    while heap:
        d, u = heapq.heappop(heap)
        if d > limit:
            break
        if d > dist[u]:
            continue
        for r in out.get(u, ()):
            lines = set((r.line_ref or "").split(";")) - {""}
            if lines and not lines & known:
                if known:
                    continue
                known |= lines
            best[r.edge_id] = min(best.get(r.edge_id, np.inf), d)
            far = d + r.length
            if far <= limit and far < dist.get(r.to_node, np.inf):
                dist[r.to_node] = far
                heapq.heappush(heap, (far, r.to_node))
    return pd.DataFrame({"station_id": station, "edge_id": list(best), "distance": list(best.values())})


def station_extents(stations: DataFrame, nodes: DataFrame, edges: DataFrame, most: float = 1500.0, core: float = 70.0) -> DataFrame:
    """(edge_id, station_id, distance): the station an edge belongs to, the nearest by way, the
    smaller id on ties; twins take the better of both. stations(station_id, x, y, node_id,
    half_gap, platform_lines). A station looks at most as far as half way to the next one, so
    its part of the network, which is what one group holds, is bounded by that circle."""
    extent = F.least(F.lit(most), F.coalesce(F.col("half_gap"), F.lit(most)))
    s = stations.where("node_id is not null").withColumn("extent", extent).where("extent > 0")
    home = nodes.select(F.col("node_id").alias("home"), F.col("x").alias("hx"), F.col("y").alias("hy"))
    s = s.join(home, F.col("node_id") == F.col("home")).select("station_id", F.col("node_id").alias("start"), "extent", "platform_lines", F.col("hx").alias("lx"), F.col("hy").alias("ly"))
    at = edges.join(nodes.select(F.col("node_id").alias("from_node"), F.col("x").alias("rx"), F.col("y").alias("ry")), "from_node")
    j = cells(s, "lx", "ly", most, 1).join(cells(at, "rx", "ry", most), ["cell_x", "cell_y"])
    j = j.where(G.distance(F.col("lx"), F.col("ly"), F.col("rx"), F.col("ry")) <= F.col("extent"))
    line = F.col("line_ref") if "line_ref" in edges.columns else F.lit(None).cast("string")
    rows = j.select("station_id", "start", "extent", "platform_lines", "edge_id", "from_node", "to_node", "length", line.alias("line_ref"))

    def run(pdf):
        pdf = pdf.copy()
        near, dist, heap = set((pdf["platform_lines"].iloc[0] or "").split(";")) - {""}, {int(pdf["start"].iloc[0]): 0.0}, [(0.0, int(pdf["start"].iloc[0]))]
        out: dict[int, list] = {}
        for r in pdf.itertuples():
            out.setdefault(r.from_node, []).append(r)
        while heap:
            d, u = heapq.heappop(heap)
            if d > core:
                break
            if d > dist[u]:
                continue
            for r in out.get(u, ()):
                near |= set((r.line_ref or "").split(";")) - {""}
                if d + r.length <= core and d + r.length < dist.get(r.to_node, np.inf):
                    dist[r.to_node] = d + r.length
                    heapq.heappush(heap, (d + r.length, r.to_node))
        pdf["seed"] = ";".join(sorted(near))
        return _reach(pdf)

    found = rows.groupBy("station_id").applyInPandas(run, EXTENT)
    pairs = found.join(edges.select("edge_id", "pair"), "edge_id").groupBy("pair").agg(F.min(F.struct("distance", "station_id")).alias("b"))
    return edges.select("edge_id", "pair").join(pairs, "pair").select("edge_id", "b.station_id", "b.distance")


def platform_lines(platforms: DataFrame, entries: DataFrame, stations: DataFrame, edges: DataFrame, stamps: DataFrame, radius: float = 1500.0) -> DataFrame:
    """(station_id, platform_lines): the lines of the tracks at the platforms that are nearest to
    a station, joined by semicolons. platforms(platform_id, x, y), stamps(edge_id, track_index)."""
    home = nearest(platforms.select("platform_id", F.col("x").alias("lx"), F.col("y").alias("ly")), "platform_id", stations.select("station_id", F.col("x").alias("rx"), F.col("y").alias("ry")), "station_id", radius)
    lines = edges.join(stamps, "edge_id").where("line_ref is not null").select("track_index", F.explode(F.split("line_ref", ";")).alias("line")).where("line <> ''").distinct()
    j = entries.select("platform_id", "track_index").join(home.where("station_id is not null"), "platform_id").join(lines, "track_index")
    return j.groupBy("station_id").agg(F.array_join(F.array_sort(F.collect_set("line")), ";").alias("platform_lines"))


SECTION = "seed_edge bigint, start_node bigint, end_node bigint, length double, max_speed int, edge_count int, start_boundary string, end_boundary string, edge_ids array<bigint>"


def _sections(pdf: pd.DataFrame) -> pd.DataFrame:
    """Greedy chains in the order of edge ids, part by part, both ways from a seed, up to a boundary
    node, an edge of another track or one that is taken."""
    pdf = pdf.sort_values(["part", "edge_id"])
    part, edge, source, target, length, speed, track, from_stop, to_stop = (pdf[c].tolist() for c in ("part", "edge_id", "from_node", "to_node", "length", "max_speed", "track_ref", "from_stop", "to_stop"))
    found = []
    for a, b in _runs(part):
        out: dict[int, list[int]] = {}
        for r in range(a, b):
            out.setdefault(source[r], []).append(r)
        stops = {source[r] for r in range(a, b) if from_stop[r]} | {target[r] for r in range(a, b) if to_stop[r]}
        taken: set[int] = set()

        def walk(node, prev, seed, here, out=out, stops=stops, taken=taken):
            chain = []
            while node not in stops:
                nxt = next((r for r in out.get(node, ()) if r not in taken and r not in here and target[r] != prev and not (track[seed] and track[r] and track[r] != track[seed])), None)
                if nxt is None:
                    break
                chain.append(nxt)
                here.add(nxt)
                prev, node = node, target[nxt]
            return chain, node

        for seed in range(a, b):
            if seed in taken:
                continue
            here = {seed}
            ahead, end = walk(target[seed], source[seed], seed, here)
            behind, start = walk(source[seed], target[seed], seed, here)
            chain = [*behind[::-1], seed, *ahead]
            taken |= set(chain)
            speeds = [speed[r] for r in chain if speed[r] > 0]
            kind = lambda n, stops=stops: "station" if n in stops else "junction"
            found.append([edge[seed], start, end, float(sum(length[r] for r in chain)), int(min(speeds, default=80)), len(chain), kind(start), kind(end), [edge[r] for r in chain]])
    return pd.DataFrame(found, columns=[x.split()[0] for x in SECTION.split(", ")])


def block_sections(edges: DataFrame, stops: DataFrame) -> DataFrame:
    """Block sections of all edges between the nodes of stops(node_id), numbered by seed edge.

    Walks never pass a stop, so the network falls apart there; a part is in one group, and many
    small parts share one. A walk ends where it would take an edge again."""
    e = edges.join(stops.select(F.col("node_id").alias("from_node"), F.lit(True).alias("from_stop")).distinct(), "from_node", "left")
    e = e.join(stops.select(F.col("node_id").alias("to_node"), F.lit(True).alias("to_stop")).distinct(), "to_node", "left").na.fill(False, ["from_stop", "to_stop"])
    e = cut(e.select("edge_id", "pair", "from_node", "to_node", "length", "max_speed", "track_ref", "from_stop", "to_stop"))
    low = e.where("not from_stop").groupBy("from_node").agg(F.min("pair").alias("low"))
    ties = e.where("not from_stop").join(low, "from_node").select("pair", "low").distinct()
    comp = connected_components(ties, "pair", "low").select(F.col("node").alias("pair"), F.col("component").alias("part"))
    parts = cut(e.join(comp, "pair", "left").withColumn("part", F.coalesce("part", "pair")))
    return numbered(by_bucket(parts, "part", _sections, SECTION), ["seed_edge"], "section_id")


def snap(points: DataFrame, key: str, nodes: DataFrame, radius: float) -> DataFrame:
    """points(key, x, y) with node_id, the nearest node strictly within the radius, else null."""
    left = points.select(key, F.col("x").alias("lx"), F.col("y").alias("ly"))
    n = nearest(left, key, nodes.select("node_id", F.col("x").alias("rx"), F.col("y").alias("ry")), "node_id", radius)
    return points.join(n.select(key, "node_id"), key)
