"""Inputs that many queries share, built from the tables of one folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from permaway.functions import geometry as G
from permaway.functions import tags as T
from permaway.operators import features as O
from permaway.operators import network as N
from permaway.operators.scratch import cut
from permaway.operators.spatial import first_by  # noqa: F401
from permaway.sources import osm_tables as S


def xy(spark: SparkSession, d: str) -> DataFrame:
    return O.projected(S.osm_node(spark, d)).select("node_id", "x", "y", "t_railway", "t_place", "t_name")


def features(spark: SparkSession, d: str) -> DataFrame:
    f = O.way_features(S.osm_way(spark, d), S.osm_way_node(spark, d), xy(spark, d))
    return f.withColumn("area", G.signed_area(F.col("points")))


def mainline(spark: SparkSession, d: str) -> DataFrame:
    """Railway lines that count for the network, with nodes and points."""
    return features(spark, d).where((F.col("layer") == 1) & T.is_mainline(F.col("tags"))).select("way_id", "tags", "nodes", "points")


def railway_uses(spark: SparkSession, d: str) -> DataFrame:
    ways = S.osm_way(spark, d).select("way_id", "is_closed", O.way_tags().alias("tags"))
    rail = ways.where(T.way_layer(F.col("tags"), F.col("is_closed")) == 1)
    return O.node_use(S.osm_way_node(spark, d), rail)


def refs(spark: SparkSession, d: str) -> DataFrame:
    return O.line_refs(S.osm_relation(spark, d), S.osm_relation_member(spark, d))


def graph(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    return N.build_graph(N.raw_vertices(mainline(spark, d), railway_uses(spark, d), refs(spark, d)))


def stations(spark: SparkSession, d: str, nodes: DataFrame) -> DataFrame:
    """Stations once by name and place in whole metres, numbered by (node id, x, y), snapped to nodes."""
    p = xy(spark, d).where("t_railway in ('station', 'halt')").select(F.col("node_id").alias("osm_id"), "x", "y", "t_railway", "t_name")
    p = first_by(p, [F.col("t_name"), F.round("x"), F.round("y")], ["osm_id"])
    p = cut(O.numbered(p, ["osm_id", "x", "y"], "station_id"))
    return N.snap(p, "station_id", nodes, 200.0)
