"""Queries on rings, merged lines and triangles. None has SQL; tests hold areas and fixed shapes."""

from __future__ import annotations

from pyspark.sql import functions as F

from permaway.functions import geometry as G
from permaway.functions import tags as T
from permaway.operators import features as O
from permaway.operators import mesh as M
from permaway.plans import base as B
from permaway.sources import osm_tables as S

QUERIES, SQL = {}, {}


def query(f):
    QUERIES[f.__name__] = f
    return f


def members(spark, d, keep: str):
    """Members of relations of about eight ways, so that rings and roles are met: (rel_id, pos, role, points)."""
    f = B.features(spark, d).where(keep).select(F.col("way_id").alias("member_ref"), "points")
    m = S.osm_relation_member(spark, d).join(f, "member_ref")
    part = (F.col("member_ref") % 64).cast("bigint")
    return m.select((F.col("rel_id") * 64 + part).alias("rel_id"), F.col("member_ref").alias("pos"), "role", "points")


@query
def m1_m4_multipolygons(spark, d):
    return M.multipolygons(members(spark, d, "layer in (2, 3, 5, 7)")).select("rel_id", "part", F.size("points").alias("points"), (F.size("indices") / 3).cast("int").alias("triangles"), F.size("hole_starts").alias("holes"), F.round(F.col("area") / 1e6, 3).alias("km2"))


@query
def m5_m6_waterway_ribbons(spark, d):
    lines = M.merged_lines(members(spark, d, "layer = 9"))
    return G.with_ribbon(lines, T.waterway_half_width(F.lit("river"))).select("rel_id", F.size("points").alias("points"), F.size("band").alias("band"))


@query
def m7_m11_triangles(spark, d):
    s = M.shapes(B.features(spark, d).where(F.col("layer").isin(2, 3, 5, 6, 7)))
    return s.select("way_id", F.size("points").alias("points"), (F.size("indices") / 3).cast("int").alias("triangles"), F.round(F.col("area") / 1e6, 3).alias("km2"))


@query
def p18_points_in_triangles(spark, d):
    """(point_id, way_id): places within the triangles of lakes, edges included."""
    t = M.shapes(B.features(spark, d).where("layer = 3")).select("way_id", "points", F.explode(F.expr("transform(sequence(0, size(indices) div 3 - 1), k -> slice(indices, 3 * k + 1, 3))")).alias("i"))
    corner = lambda k, c: F.get("points", F.get("i", F.lit(k)))[c]
    t = t.select("way_id", *[corner(k, c).alias(f"{n}{c}") for k, n in enumerate("abc") for c in "xy"])
    b = F.struct(F.least("ax", "bx", "cx").alias("min_x"), F.least("ay", "by", "cy").alias("min_y"), F.greatest("ax", "bx", "cx").alias("max_x"), F.greatest("ay", "by", "cy").alias("max_y"))
    tiled = O.on_tiles(t.withColumn("box", b))
    p = B.xy(spark, d).where("t_place is not null").select(F.col("node_id").alias("point_id"), (F.col("x") + 300.0).alias("x"), (F.col("y") + 200.0).alias("y"))
    p = p.withColumn("gx", G.grid(F.col("x"))).withColumn("gy", G.grid(F.col("y")))
    j = p.join(tiled, ["gx", "gy"]).where(G.box_contains(F.col("box"), F.col("x"), F.col("y")))
    tri = F.struct(*[F.col(f"{n}{c}") for n in "abc" for c in "xy"])
    return j.where(G.in_triangle(F.col("x"), F.col("y"), tri)).select("point_id", "way_id").distinct()
