"""Joins by nearness: an equality on cells, then the exact test."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from permaway.functions import geometry as G


def cells(df: DataFrame, x: str, y: str, side: float, around: int = 0) -> DataFrame:
    """df with cell_x and cell_y, a row for each cell up to `around` cells away."""
    cx, cy = F.floor(F.col(x).cast("double") / side).cast("bigint"), F.floor(F.col(y).cast("double") / side).cast("bigint")
    if not around:
        return df.withColumn("cell_x", cx).withColumn("cell_y", cy)
    steps = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in range(-around, around + 1) for j in range(-around, around + 1)])
    d = df.withColumn("_s", F.explode(steps))
    return d.withColumn("cell_x", cx + F.col("_s.i")).withColumn("cell_y", cy + F.col("_s.j")).drop("_s")


def within(left: DataFrame, right: DataFrame, radius: float, keep: list[str], strict: bool = False) -> DataFrame:
    """Pairs of left(lx, ly, ...) and right(rx, ry, ...) up to a radius apart, with distance.

    Cells have the radius as side and the left side, which should be the smaller, is put
    in nine of them; a row of the right is in one, so no pair appears twice."""
    j = cells(left, "lx", "ly", radius, 1).join(cells(right, "rx", "ry", radius), ["cell_x", "cell_y"])
    d = G.distance(F.col("lx"), F.col("ly"), F.col("rx"), F.col("ry"))
    j = j.withColumn("distance", d)
    return j.where(F.col("distance") < radius if strict else F.col("distance") <= radius).select(*keep, "distance")


def nearest(left: DataFrame, key: str, right: DataFrame, rid: str, radius: float) -> DataFrame:
    """(key, rid, distance): the nearest of the right strictly within a radius, the smaller id on
    ties; rows of the left that have none stay with nulls."""
    p = within(left.select(key, "lx", "ly"), right.select(rid, "rx", "ry"), radius, [key, rid], strict=True)
    best = p.groupBy(key).agg(F.min(F.struct("distance", rid)).alias("b")).select(key, f"b.{rid}", "b.distance")
    return left.select(key).join(best, key, "left")


def nearest_other(points: DataFrame, key: str, side: float, most: int = 12) -> DataFrame:
    """(key, distance) to the nearest other point, for any distance: cells double until every
    point has a neighbour closer than the cell's side, so no pairs of far points are made."""
    todo, found, r = points, None, side
    for _ in range(most):
        p = within(todo.select(F.col(key).alias("lk"), F.col("x").alias("lx"), F.col("y").alias("ly")), points.select(F.col(key).alias("rk"), F.col("x").alias("rx"), F.col("y").alias("ry")), r, ["lk", "rk"])
        best = p.where("lk <> rk").groupBy("lk").agg(F.min("distance").alias("distance")).withColumnRenamed("lk", key)
        found = best if found is None else found.unionByName(best)
        todo = todo.join(best.select(key), key, "left_anti")
        r *= 4
        if todo.isEmpty():
            break
    return found


def top_two(pairs: DataFrame, key: str, order: list[str]) -> DataFrame:
    from pyspark.sql.window import Window

    w = Window.partitionBy(key).orderBy(*order)
    return pairs.withColumn("rank", F.row_number().over(w)).where("rank <= 2")


def in_polygons(points: DataFrame, polygons: DataFrame, order: Column) -> DataFrame:
    """(point_id, name): of the polygons (name, ring, box) that hold a point, the first by order.

    Polygons are put in the tiles their boxes touch, so the join is on a tile; the box is
    tried before the ring."""
    from permaway.operators.features import on_tiles

    tiled = on_tiles(polygons.withColumn("_order", order))
    p = points.withColumn("gx", G.grid(F.col("x"))).withColumn("gy", G.grid(F.col("y")))
    j = p.join(tiled.select("gx", "gy", "name", "ring", "box", "_order"), ["gx", "gy"])
    j = j.where(G.box_contains(F.col("box"), F.col("x"), F.col("y"))).where(G.ring_contains(F.col("ring"), F.col("x"), F.col("y")))
    return j.groupBy("point_id").agg(F.min_by("name", "_order").alias("name"))


def first_by(rows: DataFrame, keys: list, order: list[str]) -> DataFrame:
    """One row for each key, the first by an order that has no ties; combined before the shuffle."""
    cols = [c for c in rows.columns if c not in order]
    k = [c.alias(f"_k{i}") for i, c in enumerate(keys)]
    g = rows.groupBy(*k).agg(F.min(F.struct(*order, *cols)).alias("_r"))
    return g.select("_r.*").select(*rows.columns)
