"""Rings, lines and triangles of relations and shapes. Each group is one relation, so a group
is bounded by what a relation has; all functions on points are plain numpy and Python."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Metres: how near ends must be, per axis for rings and straight for lines; the widest gap that is closed.
RING_END, LINE_END, RING_GAP, WATER_GAP = 3.0, 10.0, 30.0, 200_000.0
#: Limits of a shape with holes: their number, points of one, of all together, and of the outline.
MOST_HOLES, HOLE_POINTS, ALL_POINTS, OUTLINE_POINTS = 100, 2000, 15000, 30000

Points = list[tuple[float, float]]


def area(ring: Points) -> float:
    """Signed, counter-clockwise positive."""
    if len(ring) < 3:
        return 0.0
    p = np.asarray(ring, float)
    q = np.roll(p, -1, 0)
    return float((p[:, 0] * q[:, 1] - q[:, 0] * p[:, 1]).sum() / 2)


def inside(x: float, y: float, ring: Points) -> bool:
    p = np.asarray(ring, float)
    q = np.roll(p, 1, 0)
    span = (p[:, 1] > y) != (q[:, 1] > y)
    with np.errstate(divide="ignore", invalid="ignore"):
        cross = x < (q[:, 0] - p[:, 0]) * (y - p[:, 1]) / (q[:, 1] - p[:, 1]) + p[:, 0]
    return bool((span & cross).sum() % 2)


def ring_inside(inner: Points, outer: Points) -> bool:
    """By the vote of the centre and about five points."""
    c = np.asarray(inner, float).mean(0)
    probes = [tuple(c), *inner[:: max(1, len(inner) // 5)]]
    return sum(inside(x, y, outer) for x, y in probes) > len(probes) // 2


def _near(a, b, most: float) -> bool:
    return abs(a[0] - b[0]) < most and abs(a[1] - b[1]) < most


def _grow(chain: Points, parts: list[Points], touch) -> bool:
    """Put the first of the parts that meets an end of the chain onto it."""
    for i, p in enumerate(parts):
        if touch(chain[-1], p[0]):
            chain += p[1:]
        elif touch(chain[-1], p[-1]):
            chain += p[-2::-1]
        elif touch(chain[0], p[-1]):
            chain[:0] = p[:-1]
        elif touch(chain[0], p[0]):
            chain[:0] = p[:0:-1]
        else:
            continue
        del parts[i]
        return True
    return False


def stitch_rings(ways: list[Points], gap: float = RING_GAP) -> list[Points]:
    """Closed rings of ways joined end to end in the order given; one whose ends stay up to the
    gap apart counts as closed, and rings of under three points go."""
    parts, rings = [list(w) for w in ways if len(w) >= 2], []
    while parts:
        chain = parts.pop(0)
        while not _near(chain[0], chain[-1], RING_END) or len(chain) < 3:
            if not _grow(chain, parts, lambda a, b: _near(a, b, RING_END)):
                break
        d = float(np.hypot(chain[0][0] - chain[-1][0], chain[0][1] - chain[-1][1]))
        if d < RING_END:
            chain = chain[:-1]
        if d < gap and len(chain) >= 3:
            rings.append(chain)
    return rings


def merge_line(ways: list[Points]) -> Points:
    """One line from the first way on; ways that never touch it are left out."""
    parts = [list(w) for w in ways if len(w) >= 2]
    if not parts:
        return []
    chain = parts.pop(0)
    while parts and _grow(chain, parts, lambda a, b: np.hypot(a[0] - b[0], a[1] - b[1]) < LINE_END):
        pass
    return chain


def classify_rings(rings: list[Points]) -> tuple[list[Points], list[Points]]:
    """Outer and inner rings: from the largest down, a ring within an outer one is inner."""
    outer, inner = [], []
    for r in sorted(rings, key=lambda r: -abs(area(r))):
        (inner if any(ring_inside(r, o) for o in outer) else outer).append(r)
    return outer, inner


def simplify(points: Points, tolerance: float) -> Points:
    n = len(points)
    floor = next((t for most, t in ((5000, 20.0), (3000, 10.0), (2000, 5.0), (1000, 2.0), (500, 1.0)) if n > most), 0.0)
    tolerance = max(tolerance, floor)
    if n < 3:
        return points
    kept = [points[0]]
    for p in points[1:]:
        if np.hypot(p[0] - kept[-1][0], p[1] - kept[-1][1]) > tolerance:
            kept.append(p)
    return kept if len(kept) >= 3 else [points[0], points[n // 3], points[2 * n // 3]]


def _clean(ring: Points) -> Points:
    """Without points that repeat the one before."""
    out = [p for i, p in enumerate(ring) if i == 0 or abs(p[0] - ring[i - 1][0]) > 1e-6 or abs(p[1] - ring[i - 1][1]) > 1e-6]
    while len(out) > 1 and abs(out[0][0] - out[-1][0]) <= 1e-6 and abs(out[0][1] - out[-1][1]) <= 1e-6:
        out.pop()
    return out


def _bridged(outer: list[int], holes: list[list[int]], at: np.ndarray) -> list[int]:
    """One outline of point numbers: each hole, from its rightmost point, is tied to the nearest
    point of the outline that can be seen from there (holes are taken from the right)."""
    loop = list(outer)
    for hole in sorted(holes, key=lambda h: -max(at[i][0] for i in h)):
        k = max(range(len(hole)), key=lambda j: at[hole[j]][0])
        p = at[hole[k]]
        order = sorted(range(len(loop)), key=lambda j: (at[loop[j]][0] - p[0]) ** 2 + (at[loop[j]][1] - p[1]) ** 2)
        best = next((j for j in order if _visible(p, at[loop[j]], loop, hole, at)), order[0])
        loop = loop[: best + 1] + hole[k:] + hole[: k + 1] + loop[best:]
    return loop


def _cross(o, a, b) -> float:
    return (a[0] - o[0]) * (b[1] - o[1]) - (a[1] - o[1]) * (b[0] - o[0])


def _visible(p, q, loop: list[int], hole: list[int], at: np.ndarray) -> bool:
    for ring in (loop, hole):
        for i in range(len(ring)):
            a, b = at[ring[i - 1]], at[ring[i]]
            if any((a == x).all() or (b == x).all() for x in (p, q)):
                continue
            if _cross(p, q, a) * _cross(p, q, b) < 0 and _cross(a, b, p) * _cross(a, b, q) < 0:
                return False
    return True


def triangulate(outer: Points, holes: list[Points] = ()) -> tuple[Points, list[int], list[int]]:
    """(points, triangle indices, first points of holes) by ear clipping over bridges.

    The ear taken is the convex corner of the widest angle that holds no other corner; where
    none is left (self-crossing input) the least reflex corner is cut off, so it always ends."""
    outer, holes = _clean(list(outer)), [h for h in (_clean(list(h)) for h in holes) if len(h) >= 3]
    if len(outer) < 3:
        return [], [], []
    points, starts = list(outer), []
    for h in holes:
        starts.append(len(points))
        points += h
    at = np.asarray(points, float)
    rings, n = [], 0
    for r in (outer, *holes):
        rings.append(list(range(n, n + len(r))))
        n += len(r)
    if area(outer) < 0:
        rings[0].reverse()
    for r, h in zip(rings[1:], holes, strict=True):
        if area(h) > 0:
            r.reverse()
    loop, out = _bridged(rings[0], rings[1:], at), []
    while len(loop) > 3:
        i = _best_ear(loop, at)
        out += [loop[i - 1], loop[i], loop[(i + 1) % len(loop)]]
        del loop[i]
    return points, out + loop, starts


def _best_ear(loop: list[int], at: np.ndarray) -> int:
    p = at[loop]
    a, c = np.roll(p, 1, 0), np.roll(p, -1, 0)
    u, v = a - p, c - p
    turn = (p[:, 0] - a[:, 0]) * (c[:, 1] - a[:, 1]) - (p[:, 1] - a[:, 1]) * (c[:, 0] - a[:, 0])
    size = np.maximum(np.hypot(*u.T) * np.hypot(*v.T), 1e-12)
    angle = np.arccos(np.clip((u * v).sum(1) / size, -1, 1))
    flat = np.flatnonzero(np.abs(turn) <= 1e-12)
    for i in sorted(np.flatnonzero(turn > 1e-12), key=lambda i: -angle[i]):
        x, y, z = a[i], p[i], c[i]
        s = [(e[0] - d[0]) * (p[:, 1] - d[1]) - (e[1] - d[1]) * (p[:, 0] - d[0]) for d, e in ((x, y), (y, z), (z, x))]
        within = (s[0] >= 0) & (s[1] >= 0) & (s[2] >= 0)
        for corner in (x, y, z):
            within &= (p != corner).any(1)
        if not within.any():
            return int(i)
    return int(flat[0]) if len(flat) else int(np.argmax(turn))


def polygon(outer: Points, holes: list[Points]) -> tuple[Points, list[int], list[int]]:
    """triangulate() under the limits of a shape: the largest holes first, simplified outlines."""
    holes = [h for h in sorted(holes, key=lambda h: -abs(area(h)))[:MOST_HOLES] if len(h) < HOLE_POINTS]
    if len(outer) > OUTLINE_POINTS:
        outer = simplify(outer, 10.0)
    outer, kept, total = simplify(outer, 0.1), [], len(outer)
    for h in holes:
        if total + len(h) > ALL_POINTS:
            break
        kept.append(h)
        total += len(h)
    if len(outer) > 1500:
        outer = outer[:: -(-len(outer) // 1000)]
    return triangulate(outer, kept)


SHAPE = "rel_id bigint, part int, points array<struct<x:double,y:double>>, indices array<int>, hole_starts array<int>, area double"


def multipolygons(members: DataFrame, gap: float = RING_GAP, tolerance: float = 0.0) -> DataFrame:
    """Shapes of relations from members(rel_id, pos, role, points): rings of outer and of inner
    ways, of all ways without a role if there is no outer one; a hole goes to every outer ring
    that holds it. One row for each outer ring."""

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("pos")
        ways = {r: [[(p["x"], p["y"]) for p in w] for w in pdf.loc[pdf["role"] == r, "points"]] for r in set(pdf["role"])}
        outer_ways, inner_ways = ways.get("outer", []), ways.get("inner", [])
        free = [w for r, ws in ways.items() if r not in ("outer", "inner") for w in ws]
        if not outer_ways:
            outer_ways, free = free, []
        outer, inner = stitch_rings(outer_ways, gap), stitch_rings(inner_ways, gap)
        if free:
            more_outer, more_inner = classify_rings(stitch_rings(free, gap))
            outer, inner = outer + more_outer, inner + more_inner
        rows = []
        for k, ring in enumerate(outer):
            ring = simplify(ring, tolerance) if tolerance else ring
            points, indices, starts = polygon(ring, [h for h in inner if ring_inside(h, ring)])
            if points:
                rows.append([int(pdf["rel_id"].iloc[0]), k, [{"x": x, "y": y} for x, y in points], indices, starts, abs(area(ring))])
        return pd.DataFrame(rows, columns=["rel_id", "part", "points", "indices", "hole_starts", "area"])

    return members.select("rel_id", "pos", "role", "points").groupBy("rel_id").applyInPandas(build, SHAPE)


def merged_lines(members: DataFrame) -> DataFrame:
    """(rel_id, points): the ways of each relation merged into one line."""

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        line = merge_line([[(p["x"], p["y"]) for p in w] for w in pdf.sort_values("pos")["points"]])
        return pd.DataFrame([[int(pdf["rel_id"].iloc[0]), [{"x": x, "y": y} for x, y in line]]], columns=["rel_id", "points"])

    out = members.select("rel_id", "pos", "points").groupBy("rel_id").applyInPandas(build, "rel_id bigint, points array<struct<x:float,y:float>>")
    return out.where(F.size("points") >= 2)


def shapes(features: DataFrame) -> DataFrame:
    """Triangles of single rings: features(way_id, points); a closing point that repeats the first goes."""

    def run(batches):
        for pdf in batches:
            rows = []
            for way, pts in zip(pdf["way_id"], pdf["points"], strict=True):
                points, indices, _ = polygon([(p["x"], p["y"]) for p in pts], [])
                rows.append([way, [{"x": x, "y": y} for x, y in points], indices, abs(area(points))])
            yield pd.DataFrame(rows, columns=["way_id", "points", "indices", "area"])

    return features.select("way_id", "points").mapInPandas(run, "way_id bigint, points array<struct<x:double,y:double>>, indices array<int>, area double")
