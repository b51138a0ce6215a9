"""Points by tracks: segments in cells, long ones and wide radii."""

import random

from pyspark.sql import functions as F

from permaway.operators import network as N

SEGMENT = "track_index bigint, k int, length double, arc double, ax double, ay double, bx double, by double"


def test_cells_do_not_grow_with_the_square_of_the_radius(spark):
    """A segment across the map and a radius of 900 m: 27 million cells of 64 m, which made one array."""
    rows = [(0, 0, 3e7, 0.0, 10.0, -1.5e7, 10.0, 1.5e7), (1, 0, 800.0, 0.0, 0.0, 0.0, 800.0, 0.0)]
    points = [(1, 700.0, 1.4e7), (2, 100.0, 50.0), (3, 2000.0, 0.0)]
    found = N.projections(spark.createDataFrame(points, "pid bigint, x double, y double"), spark.createDataFrame(rows, SEGMENT), 900.0)
    assert sorted((r.pid, r.track_index, round(r.distance), round(r.arc)) for r in found.collect()) == [(1, 0, 690, 29000000), (2, 0, 90, 15000050), (2, 1, 50, 100)]


def test_projections_match_brute_force(spark):
    rnd = random.Random(5)
    for radius in (30.0, 900.0):
        span = 20 * radius
        rows = []
        for t in range(60):
            ax, ay = rnd.uniform(-span, span), rnd.uniform(-span, span)
            size = radius * rnd.choice([0.0, 0.5, 3, 30])
            bx, by = ax + rnd.uniform(-size, size), ay + rnd.choice([0, 1]) * rnd.uniform(-size, size)
            rows.append((t, 0, ((bx - ax) ** 2 + (by - ay) ** 2) ** 0.5, 0.0, ax, ay, bx, by))
        points = [(p, rnd.uniform(-span, span), rnd.uniform(-span, span)) for p in range(200)]
        want = {}
        for p, x, y in points:
            for t, _, _, _, ax, ay, bx, by in rows:
                dx, dy = bx - ax, by - ay
                at = min(max(((x - ax) * dx + (y - ay) * dy) / (dx * dx + dy * dy), 0), 1) if dx * dx + dy * dy > 1e-9 else 0
                d = ((x - ax - at * dx) ** 2 + (y - ay - at * dy) ** 2) ** 0.5
                if d <= radius:
                    want[p, t] = d
        s = spark.createDataFrame(rows, SEGMENT)
        found = N.projections(spark.createDataFrame(points, "pid bigint, x double, y double"), s, radius).collect()
        got = {(r.pid, r.track_index): r.distance for r in found}
        assert len(found) == len(got) and got.keys() == want.keys() and want
        assert all(abs(got[k] - want[k]) < 0.01 for k in want)
        cells = N.in_cells(s, radius, max(64.0, radius))
        assert cells.groupBy("track_index", "cell_x", "cell_y").count().where(F.col("count") > 1).isEmpty()


def test_segments_of_any_length_take_rows_by_the_points_they_pass(spark):
    """33 thousand million kilometres at 900 m: a list of 37 thousand million pieces before, which failed."""
    far = 3.3e13
    rows = [(0, 0, 2 * far, 0.0, 10.0, -far, 10.0, far), (1, 0, 3e9, 0.0, 0.0, 0.0, 1.8e9, 2.4e9), (2, 0, 800.0, 0.0, 0.0, 0.0, 800.0, 0.0)]
    s = spark.createDataFrame(rows, SEGMENT)
    points = [(1, 700.0, far / 2), (2, 100.0, 50.0), (3, 9e8 + 80, 1.2e9 - 60), (4, 5000.0, -far / 3), (5, 910.0, 0.0)]
    p = spark.createDataFrame(points, "pid bigint, x double, y double")
    found = sorted((r.pid, r.track_index, round(r.distance)) for r in N.projections(p, s, 900.0).collect())
    assert found == [(1, 0, 690), (2, 0, 90), (2, 1, 50), (2, 2, 50), (3, 1, 100), (5, 0, 900), (5, 1, 728), (5, 2, 110)]
    assert N.in_cells(N.near_parts(s, p, 900.0, 900.0), 900.0, 900.0, "_").count() < 4000


def test_a_platform_takes_few_cells_of_wide_radius(spark):
    """An edge of the lattice took some 1,100 cells at 900 m; platforms find their two tracks as before."""
    s = spark.createDataFrame([(0, 0, 2000.0, 0.0, -1000.0, 100.0, 1000.0, 100.0), (1, 0, 2000.0, 0.0, -1000.0, -200.0, 1000.0, -200.0), (2, 0, 2000.0, 0.0, -1000.0, 300.0, 1000.0, 300.0)], SEGMENT)
    assert N.in_cells(s.where("track_index = 0"), 900.0, 900.0).count() <= 24
    ring = [(-100.0, -5.0), (100.0, -5.0), (100.0, 5.0), (-100.0, 5.0)]
    p = spark.createDataFrame([(9, ring)], "platform_id bigint, points array<struct<x:float,y:float>>")
    found = sorted((r.rank, r.track_index, round(r.from_m), round(r.to_m)) for r in N.platform_entries(p, s, 900.0).collect())
    assert [r[:2] for r in found] == [(1, 0), (2, 1)] and all(abs(a - 900) <= 2 and abs(b - 1100) <= 2 for _, _, a, b in found), found
