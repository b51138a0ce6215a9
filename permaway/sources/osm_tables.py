"""OSM-shaped tables derived from the star-schema tables, and the same in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def osm_node(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A lattice 40 wide of customers, and for every fifth a twin 0.00002 degrees east."""
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    k = F.col("c_custkey")
    lat = F.lit(52.0) + F.expr("c_custkey div 40") * F.lit(0.012)
    lon = F.lit(19.0) + (k % 40) * F.lit(0.012)
    railway = F.when(k % 7 == 0, F.when(k % 2 == 0, "station").otherwise("halt")).when(k % 11 == 0, "signal")
    place = F.when(k % 13 == 0, F.when(k % 3 == 0, "city").when(k % 3 == 1, "town").otherwise("village"))
    main = c.select(k.cast("bigint").alias("node_id"), lat.alias("lat"), lon.alias("lon"), railway.alias("t_railway"), place.alias("t_place"), F.col("c_name").alias("t_name"))
    none = F.lit(None).cast("string")
    twin = c.where("c_custkey % 5 = 0").select((k + 1000000000).cast("bigint").alias("node_id"), lat.alias("lat"), (lon + F.lit(0.00002)).alias("lon"), none.alias("t_railway"), none.alias("t_place"), none.alias("t_name"))
    return main.unionByName(twin)


def osm_way(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", "o_orderstatus").withColumn("k", F.col("o_orderkey") % 20)
    return o.selectExpr(
        "o_orderkey AS way_id",
        "CASE WHEN k < 6 THEN 'railway' WHEN k < 12 THEN 'highway' WHEN k < 15 THEN 'building' WHEN k = 15 THEN 'natural'"
        " WHEN k = 16 THEN 'landuse' WHEN k = 17 THEN 'waterway' WHEN k = 18 THEN 'military' ELSE 'railway' END AS tag_key",
        "CASE WHEN k < 4 THEN 'rail' WHEN k = 4 THEN 'tram' WHEN k = 5 THEN 'disused' WHEN k < 12 THEN"
        " (CASE o_orderpriority WHEN '1-URGENT' THEN 'motorway' WHEN '2-HIGH' THEN 'primary' WHEN '3-MEDIUM' THEN 'tertiary' WHEN '5-LOW' THEN 'footway' ELSE 'residential' END)"
        " WHEN k < 15 THEN 'yes' WHEN k = 15 THEN 'water' WHEN k = 16 THEN 'forest' WHEN k = 17 THEN 'river' WHEN k = 18 THEN 'base' ELSE 'platform' END AS tag_val",
        "CASE WHEN k < 4 THEN (CASE o_orderstatus WHEN 'F' THEN 'main' WHEN 'O' THEN 'branch' ELSE 'industrial' END) END AS t_usage",
        "CASE WHEN k IN (0, 1) THEN '120' WHEN k = 2 THEN '80;60 km/h' WHEN k = 3 THEN 'signals' END AS t_maxspeed",
        "(k BETWEEN 12 AND 16 OR k >= 18) AS is_closed",
    )


def osm_way_node(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(way_id, pos, node_id). The number of nodes is one figure, counted from Parquet footers."""
    n = table(spark, sf_dir, "customer").count()
    w = osm_way(spark, sf_dir).select("way_id", "is_closed")
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("way_id"), "o_custkey")
    j = w.join(o, "way_id").withColumn("pos", F.explode(F.sequence(F.lit(0), F.when(F.col("is_closed"), 4).otherwise((1 + F.col("way_id") % 4).cast("int")))))
    node = (
        F.when(F.col("is_closed"), (F.col("o_custkey") + F.when(F.col("pos") == 1, 1).when(F.col("pos") == 2, 41).when(F.col("pos") == 3, 40).otherwise(0)) % n)
        .when((F.col("pos") == 0) & (F.col("way_id") % 3 == 0) & (F.col("o_custkey") % 5 == 0), F.col("o_custkey") + 1000000000)
        .when(F.col("way_id") % 2 == 0, (F.col("o_custkey") + F.col("pos")) % n)
        .otherwise((F.col("o_custkey") + 40 * F.col("pos")) % n)
    )
    return j.select("way_id", "pos", node.alias("node_id"))


def osm_relation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").selectExpr(
        "s_suppkey AS rel_id",
        "CASE WHEN s_suppkey % 2 = 0 THEN 'railway' ELSE 'train' END AS t_route",
        "CASE WHEN s_suppkey % 3 = 0 THEN concat(CAST(s_nationkey AS STRING), ';', CAST(s_suppkey AS STRING)) ELSE CAST(s_nationkey AS STRING) END AS t_ref",
    )


def osm_relation_member(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "supplier").count()
    o = table(spark, sf_dir, "orders").select("o_orderkey", (F.col("o_orderkey") % n).alias("s_suppkey"))
    s = table(spark, sf_dir, "supplier").select("s_suppkey")
    return o.join(s, "s_suppkey").selectExpr(
        "s_suppkey AS rel_id", "o_orderkey AS member_ref", "'way' AS member_type",
        "CASE o_orderkey % 3 WHEN 0 THEN 'outer' WHEN 1 THEN 'inner' ELSE '' END AS role",
    )


#: The same tables as SQL, to be followed by further expressions and a SELECT.
PRELUDE = """
WITH osm_node AS (
SELECT CAST(c_custkey AS BIGINT) AS node_id, CAST(52 AS DOUBLE) + (c_custkey // 40) * CAST(0.012 AS DOUBLE) AS lat,
       CAST(19 AS DOUBLE) + (c_custkey % 40) * CAST(0.012 AS DOUBLE) AS lon,
       CASE WHEN c_custkey % 7 = 0 THEN (CASE WHEN c_custkey % 2 = 0 THEN 'station' ELSE 'halt' END) WHEN c_custkey % 11 = 0 THEN 'signal' END AS t_railway,
       CASE WHEN c_custkey % 13 = 0 THEN (CASE c_custkey % 3 WHEN 0 THEN 'city' WHEN 1 THEN 'town' ELSE 'village' END) END AS t_place, c_name AS t_name
FROM customer
UNION ALL
SELECT CAST(c_custkey + 1000000000 AS BIGINT), CAST(52 AS DOUBLE) + (c_custkey // 40) * CAST(0.012 AS DOUBLE),
       CAST(19 AS DOUBLE) + (c_custkey % 40) * CAST(0.012 AS DOUBLE) + CAST(0.00002 AS DOUBLE), NULL, NULL, NULL FROM customer WHERE c_custkey % 5 = 0),
osm_way AS (
SELECT o_orderkey AS way_id,
  CASE WHEN k < 6 THEN 'railway' WHEN k < 12 THEN 'highway' WHEN k < 15 THEN 'building' WHEN k = 15 THEN 'natural'
       WHEN k = 16 THEN 'landuse' WHEN k = 17 THEN 'waterway' WHEN k = 18 THEN 'military' ELSE 'railway' END AS tag_key,
  CASE WHEN k < 4 THEN 'rail' WHEN k = 4 THEN 'tram' WHEN k = 5 THEN 'disused'
       WHEN k < 12 THEN (CASE o_orderpriority WHEN '1-URGENT' THEN 'motorway' WHEN '2-HIGH' THEN 'primary' WHEN '3-MEDIUM' THEN 'tertiary' WHEN '5-LOW' THEN 'footway' ELSE 'residential' END)
       WHEN k < 15 THEN 'yes' WHEN k = 15 THEN 'water' WHEN k = 16 THEN 'forest' WHEN k = 17 THEN 'river' WHEN k = 18 THEN 'base' ELSE 'platform' END AS tag_val,
  CASE WHEN k < 4 THEN (CASE o_orderstatus WHEN 'F' THEN 'main' WHEN 'O' THEN 'branch' ELSE 'industrial' END) END AS t_usage,
  CASE WHEN k IN (0,1) THEN '120' WHEN k = 2 THEN '80;60 km/h' WHEN k = 3 THEN 'signals' END AS t_maxspeed,
  (k BETWEEN 12 AND 16 OR k >= 18) AS is_closed
FROM (SELECT *, o_orderkey % 20 AS k FROM orders) o),
osm_way_node AS (
SELECT w.way_id, p.pos,
  CASE WHEN w.is_closed THEN (o.o_custkey + CASE p.pos WHEN 1 THEN 1 WHEN 2 THEN 41 WHEN 3 THEN 40 ELSE 0 END) % n.n
       WHEN p.pos = 0 AND w.way_id % 3 = 0 AND o.o_custkey % 5 = 0 THEN o.o_custkey + 1000000000
       WHEN w.way_id % 2 = 0 THEN (o.o_custkey + p.pos) % n.n ELSE (o.o_custkey + 40 * p.pos) % n.n END AS node_id
FROM osm_way w JOIN orders o ON o.o_orderkey = w.way_id CROSS JOIN (SELECT count(*) AS n FROM customer) n
CROSS JOIN (SELECT CAST(range AS INT) AS pos FROM range(5)) p WHERE CASE WHEN w.is_closed THEN true ELSE p.pos <= 1 + w.way_id % 4 END),
osm_relation AS (
SELECT s_suppkey AS rel_id, CASE WHEN s_suppkey % 2 = 0 THEN 'railway' ELSE 'train' END AS t_route,
  CASE WHEN s_suppkey % 3 = 0 THEN concat(CAST(s_nationkey AS VARCHAR), ';', CAST(s_suppkey AS VARCHAR)) ELSE CAST(s_nationkey AS VARCHAR) END AS t_ref FROM supplier),
osm_relation_member AS (
SELECT s.s_suppkey AS rel_id, o.o_orderkey AS member_ref, 'way' AS member_type,
  CASE o.o_orderkey % 3 WHEN 0 THEN 'outer' WHEN 1 THEN 'inner' ELSE '' END AS role
FROM orders o CROSS JOIN (SELECT count(*) AS n FROM supplier) c JOIN supplier s ON s.s_suppkey = o.o_orderkey % c.n),
centre AS (SELECT avg(lat) AS clat, avg(lon) AS clon FROM osm_node),
xy AS (SELECT node_id, CAST((lon - clon) * (pi() * 6371000 / 180) * cos(radians(clat)) AS FLOAT) AS x, CAST((lat - clat) * (pi() * 6371000 / 180) AS FLOAT) AS y FROM osm_node, centre),
way_xy AS (SELECT way_id, pos, node_id, x, y, count(*) OVER (PARTITION BY way_id) AS n, row_number() OVER (PARTITION BY way_id ORDER BY pos) - 1 AS i
  FROM osm_way_node JOIN xy USING (node_id)),
cls AS (SELECT *, CASE WHEN is_closed AND tag_key = 'building' THEN 2 WHEN is_closed AND tag_key = 'natural' THEN 3 WHEN is_closed AND tag_key = 'landuse' THEN 7
  WHEN is_closed AND tag_key = 'military' THEN 5 WHEN is_closed AND tag_val = 'platform' THEN 6 WHEN tag_key = 'highway' THEN 0 WHEN tag_key = 'waterway' THEN 9
  WHEN tag_key = 'railway' AND tag_val IN ('rail', 'tram', 'disused') THEN 1 END AS layer FROM osm_way),
box AS (SELECT way_id, min(x) AS min_x, min(y) AS min_y, max(x) AS max_x, max(y) AS max_y, max(n) AS n FROM way_xy GROUP BY way_id HAVING max(n) >= 2),
feature AS (SELECT c.way_id, c.layer, c.tag_val, b.* EXCLUDE (way_id) FROM cls c JOIN box b USING (way_id) WHERE layer IS NOT NULL)
"""
