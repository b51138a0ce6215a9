"""Plane geometry as column expressions. Points are structs of x and y; sums run in double."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Metres in a degree of a great circle, and the side of a tile.
METRES_PER_DEGREE = math.pi * 6371000 / 180
TILE = 10000.0
TILE_SHIFT = 100000


def project_x(lon: Column, clon: Column, clat: Column) -> Column:
    return ((lon - clon) * F.lit(METRES_PER_DEGREE) * F.cos(F.radians(clat))).cast("float")


def project_y(lat: Column, clat: Column) -> Column:
    return ((lat - clat) * F.lit(METRES_PER_DEGREE)).cast("float")


def grid(v: Column, side: float = TILE) -> Column:
    return F.floor(v.cast("double") / F.lit(side)).cast("bigint")


def tile_id(gx: Column, gy: Column) -> Column:
    """Cantor's pairing of the shifted grid numbers."""
    x, y = gx + TILE_SHIFT, gy + TILE_SHIFT
    s = x + y
    return F.floor(s * (s + 1) / 2).cast("bigint") + y


def distance(ax: Column, ay: Column, bx: Column, by: Column) -> Column:
    dx, dy = ax.cast("double") - bx, ay.cast("double") - by
    return F.sqrt(dx * dx + dy * dy)


def box(points: Column) -> Column:
    """min_x, min_y, max_x, max_y of an array of points; an empty one gives an inverted box."""
    big = F.lit(3.4028234663852886e38).cast("float")

    def edge(f, side, sign):
        return F.coalesce(f(F.transform(points, lambda p: p[side])), big if sign > 0 else -big)

    return F.struct(
        edge(F.array_min, "x", 1).alias("min_x"), edge(F.array_min, "y", 1).alias("min_y"),
        edge(F.array_max, "x", -1).alias("max_x"), edge(F.array_max, "y", -1).alias("max_y"),
    )


def box_valid(b: Column) -> Column:
    return (b["min_x"] <= b["max_x"]) & (b["min_y"] <= b["max_y"])


def box_contains(b: Column, x: Column, y: Column) -> Column:
    return (x >= b["min_x"]) & (x <= b["max_x"]) & (y >= b["min_y"]) & (y <= b["max_y"])


def boxes_overlap(a: Column, b: Column) -> Column:
    return (a["min_x"] <= b["max_x"]) & (a["max_x"] >= b["min_x"]) & (a["min_y"] <= b["max_y"]) & (a["max_y"] >= b["min_y"])


def box_union(a: Column, b: Column) -> Column:
    return F.struct(
        F.least(a["min_x"], b["min_x"]).alias("min_x"), F.least(a["min_y"], b["min_y"]).alias("min_y"),
        F.greatest(a["max_x"], b["max_x"]).alias("max_x"), F.greatest(a["max_y"], b["max_y"]).alias("max_y"),
    )


def signed_area(points: Column) -> Column:
    """Half the sum of cross products of neighbours, the last with the first; counter-clockwise is positive."""
    n = F.size(points)
    turned = F.concat(F.slice(points, 2, F.greatest(n - 1, F.lit(0))), F.slice(points, 1, 1))
    cross = F.zip_with(points, turned, lambda a, b: a["x"].cast("double") * b["y"] - b["x"].cast("double") * a["y"])
    return F.when(n < 3, 0.0).otherwise(F.aggregate(cross, F.lit(0.0), lambda s, v: s + v) / 2)


def is_ccw(points: Column) -> Column:
    return (F.size(points) < 3) | (signed_area(points) > 0)


def ring_contains(points: Column, x: Column, y: Column) -> Column:
    """Parity of the edges that a ray to the right crosses."""
    n = F.size(points)
    before = F.concat(F.slice(points, -1, 1), F.slice(points, 1, F.greatest(n - 1, F.lit(0))))
    crossed = F.zip_with(
        points, before,
        lambda a, b: F.when(
            (a["y"] > y) != (b["y"] > y),
            x.cast("double") < (b["x"].cast("double") - a["x"]) * (y.cast("double") - a["y"]) / (b["y"].cast("double") - a["y"]) + a["x"],
        ).otherwise(False),
    )
    return F.when(n < 3, False).otherwise(F.size(F.filter(crossed, lambda c: c)) % 2 == 1)


def centroid(points: Column) -> Column:
    n = F.size(points)
    sx = F.aggregate(points, F.lit(0.0), lambda s, p: s + p["x"])
    sy = F.aggregate(points, F.lit(0.0), lambda s, p: s + p["y"])
    return F.struct((sx / n).cast("float").alias("x"), (sy / n).cast("float").alias("y"))


def ring_in_ring(inner: Column, outer: Column) -> Column:
    """Whether the centre and about five points of a ring lie for the greater part in another."""
    n = F.size(inner)
    step = F.greatest(F.floor(n / 5).cast("int"), F.lit(1))
    probes = F.concat(F.array(centroid(inner)), F.transform(F.sequence(F.lit(0), n - 1, step), lambda i: F.get(inner, i)))
    hits = F.size(F.filter(probes, lambda p: ring_contains(outer, p["x"], p["y"])))
    return hits > F.floor(F.size(probes) / 2)


def chain_length(points: Column) -> Column:
    n = F.size(points)
    legs = F.zip_with(F.slice(points, 1, F.greatest(n - 1, F.lit(0))), F.slice(points, 2, F.greatest(n - 1, F.lit(0))), lambda a, b: distance(a["x"], a["y"], b["x"], b["y"]))
    return F.aggregate(legs, F.lit(0.0), lambda s, v: s + v)


def in_triangle(px: Column, py: Column, t: Column) -> Column:
    """t: struct of ax, ay, bx, by, cx, cy; edges belong to the triangle."""

    def cross(ax, ay, bx, by):
        return (px.cast("double") - bx) * (ay.cast("double") - by) - (ax.cast("double") - bx) * (py.cast("double") - by)

    one, two, three = cross(t["ax"], t["ay"], t["bx"], t["by"]), cross(t["bx"], t["by"], t["cx"], t["cy"]), cross(t["cx"], t["cy"], t["ax"], t["ay"])
    negative, positive = (one < 0) | (two < 0) | (three < 0), (one > 0) | (two > 0) | (three > 0)
    return ~(negative & positive)


def major_axis(points: Column) -> Column:
    """cx, cy, dir_x, dir_y, half: the principal axis through the centre and the farthest projection on it."""
    c = centroid(points)
    dx, dy = (lambda p: p["x"].cast("double") - c["x"]), (lambda p: p["y"].cast("double") - c["y"])
    total = lambda f: F.aggregate(points, F.lit(0.0), lambda s, p: s + f(p))
    sxx, sxy, syy = total(lambda p: dx(p) * dx(p)), total(lambda p: dx(p) * dy(p)), total(lambda p: dy(p) * dy(p))
    theta = F.lit(0.5) * F.atan2(2 * sxy, sxx - syy)
    half = F.array_max(F.transform(points, lambda p: F.abs(dx(p) * F.cos(theta) + dy(p) * F.sin(theta))))
    return F.struct(c["x"].alias("cx"), c["y"].alias("cy"), F.cos(theta).alias("dir_x"), F.sin(theta).alias("dir_y"), half.alias("half"))


def simplified(points: Column, tolerance: float) -> Column:
    """Points farther than a tolerance from the last one kept; the floor of the tolerance rises with
    the number of points. Fewer than three leave three that are evenly spaced."""
    n = F.size(points)
    floor = F.when(n > 5000, 20.0).when(n > 3000, 10.0).when(n > 2000, 5.0).when(n > 1000, 2.0).when(n > 500, 1.0).otherwise(0.0)
    tol = F.greatest(F.lit(float(tolerance)), floor)

    def step(acc, p):
        last = F.element_at(acc, -1)
        return F.when(distance(last["x"], last["y"], p["x"], p["y"]) > tol, F.array_append(acc, p)).otherwise(acc)

    kept = F.aggregate(F.slice(points, 2, F.greatest(n - 1, F.lit(0))), F.slice(points, 1, 1), step)
    third = F.array(F.get(points, F.lit(0)), F.get(points, F.floor(n / 3).cast("int")), F.get(points, F.floor(2 * n / 3).cast("int")))
    return F.when(n < 3, points).when(F.size(kept) >= 3, kept).otherwise(third)


def indices_ok(indices: Column, n: Column) -> Column:
    return F.forall(indices, lambda i: (i >= 0) & (i < n))


def with_ribbon(lines, half: Column):
    """lines(points) with band: right and left points of a band along a line, in turn. The
    normal at an inner point is the mean of both segments' normals, stretched so that the band
    keeps its width; a segment under a millimetre has none of its own. Directions and normals
    are columns of their own, so that each is worked out once."""
    n = F.size("points")
    pair = lambda x, y: F.struct(x.alias("x"), y.alias("y"))

    def unit(a, b):
        dx, dy = b["x"].cast("double") - a["x"], b["y"].cast("double") - a["y"]
        d = F.sqrt(dx * dx + dy * dy)
        return F.struct((dx / F.greatest(d, F.lit(1e-9))).alias("x"), (dy / F.greatest(d, F.lit(1e-9))).alias("y"), (d >= 0.001).alias("ok"))

    legs = F.zip_with(F.slice("points", 1, n - 1), F.slice("points", 2, n - 1), unit)
    alone = lambda d: F.when(d["ok"], pair(-d["y"], d["x"])).otherwise(pair(F.lit(0.0), F.lit(1.0)))

    def joint(a, b):
        nx, ny = -(a["y"] + b["y"]), a["x"] + b["x"]
        size = F.sqrt(nx * nx + ny * ny)
        dot = (-a["y"] * nx + a["x"] * ny) / F.greatest(size, F.lit(1e-9))
        scale = F.when(dot > 0.1, size * dot).otherwise(size)
        both = F.when(size < 0.001, pair(-a["y"], a["x"])).otherwise(pair(nx / F.greatest(scale, F.lit(1e-9)), ny / F.greatest(scale, F.lit(1e-9))))
        return F.when(a["ok"] & b["ok"], both).when(b["ok"], alone(b)).otherwise(alone(a))

    f = lines.where(n >= 2).withColumn("_legs", legs)
    m = F.size("_legs")
    inner = F.zip_with(F.slice("_legs", 1, m - 1), F.slice("_legs", 2, F.greatest(m - 1, F.lit(0))), joint)
    f = f.withColumn("_normals", F.concat(F.array(alone(F.get("_legs", F.lit(0)))), inner, F.array(alone(F.get("_legs", m - 1)))))

    def sides(p, v):
        at = lambda s: F.struct((p["x"] + s * v["x"] * half).cast("float").alias("x"), (p["y"] + s * v["y"] * half).cast("float").alias("y"))
        return F.array(at(-1.0), at(1.0))

    return f.withColumn("band", F.flatten(F.zip_with("points", "_normals", sides))).drop("_legs", "_normals")
