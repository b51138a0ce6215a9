"""Ways and nodes to projected, classified features."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from permaway.functions import geometry as G
from permaway.functions import tags as T
from permaway.operators.scratch import cut


def centre(nodes: DataFrame) -> DataFrame:
    """One row: the mean latitude and longitude of all nodes."""
    return nodes.agg(F.avg("lat").alias("clat"), F.avg("lon").alias("clon"))


def projected(nodes: DataFrame) -> DataFrame:
    """nodes with x and y in metres about the centre. The centre is one row and goes to every task."""
    j = nodes.crossJoin(F.broadcast(centre(nodes)))
    return j.withColumn("x", G.project_x(F.col("lon"), F.col("clon"), F.col("clat"))).withColumn("y", G.project_y(F.col("lat"), F.col("clat"))).drop("clat", "clon")


def way_points(way_nodes: DataFrame, xy: DataFrame) -> DataFrame:
    """(way_id, i, n, node_id, x, y): positions that have a node, numbered anew in order."""
    j = way_nodes.join(xy.select("node_id", "x", "y"), "node_id")
    w = Window.partitionBy("way_id")
    return j.select("way_id", "pos", "node_id", "x", "y", (F.row_number().over(w.orderBy("pos")) - 1).alias("i"), F.count("*").over(w).alias("n"))


def way_lines(way_nodes: DataFrame, xy: DataFrame) -> DataFrame:
    """(way_id, nodes, points): ordered arrays; ways of which under two nodes are there go."""
    j = way_nodes.join(xy.select("node_id", "x", "y"), "node_id")
    g = j.groupBy("way_id").agg(F.array_sort(F.collect_list(F.struct("pos", "node_id", "x", "y"))).alias("p")).where(F.size("p") >= 2)
    return g.select("way_id", F.col("p.node_id").alias("nodes"), F.transform("p", lambda p: F.struct(p["x"].alias("x"), p["y"].alias("y"))).alias("points"))


def way_tags() -> Column:
    """The tag columns of a way as a map without empty entries."""
    entries = F.array(
        F.struct(F.col("tag_key").alias("key"), F.col("tag_val").alias("value")),
        F.struct(F.lit("usage").alias("key"), F.col("t_usage").alias("value")),
        F.struct(F.lit("maxspeed").alias("key"), F.col("t_maxspeed").alias("value")),
    )
    return F.map_from_entries(F.filter(entries, lambda e: e["value"].isNotNull()))


def way_features(ways: DataFrame, way_nodes: DataFrame, xy: DataFrame) -> DataFrame:
    """(way_id, layer, tags, nodes, points, box) of the ways that belong to a layer."""
    tagged = ways.select("way_id", way_tags().alias("tags"), "is_closed")
    tagged = tagged.withColumn("layer", T.way_layer(F.col("tags"), F.col("is_closed"))).where("layer is not null")
    return tagged.join(way_lines(way_nodes, xy), "way_id").withColumn("box", G.box(F.col("points")))


def on_tiles(features: DataFrame, box: str = "box") -> DataFrame:
    """A row for each tile that a feature's box touches; nothing is clipped and no join is needed."""
    b = F.col(box)
    f = features.where(G.box_valid(b))
    f = f.withColumn("gx", F.explode(F.sequence(G.grid(b["min_x"]), G.grid(b["max_x"]))))
    f = f.withColumn("gy", F.explode(F.sequence(G.grid(b["min_y"]), G.grid(b["max_y"]))))
    return f.withColumn("tile_id", G.tile_id(F.col("gx"), F.col("gy")))


def within_grid(tile_rows: DataFrame, grid: DataFrame) -> DataFrame:
    """Only rows of tiles that the grid has."""
    return tile_rows.join(grid.select("tile_id"), "tile_id", "left_semi")


def tile_grid(bounds: DataFrame) -> DataFrame:
    """Every tile of the rectangle of one row of bounds."""
    g = bounds.select(F.explode(F.sequence(G.grid(F.col("min_x")), G.grid(F.col("max_x")))).alias("gx"), "min_y", "max_y")
    g = g.select("gx", F.explode(F.sequence(G.grid(F.col("min_y")), G.grid(F.col("max_y")))).alias("gy"))
    side = F.lit(G.TILE)
    return g.select(
        G.tile_id(F.col("gx"), F.col("gy")).alias("tile_id"), "gx", "gy",
        (F.col("gx") * side).alias("min_x"), (F.col("gy") * side).alias("min_y"),
        ((F.col("gx") + 1) * side).alias("max_x"), ((F.col("gy") + 1) * side).alias("max_y"),
    )


def bounds_of(features: DataFrame) -> DataFrame:
    """One row: the union of the boxes of all features but coastlines."""
    f = features.where("layer <> 12")
    return f.agg(F.min("box.min_x").alias("min_x"), F.min("box.min_y").alias("min_y"), F.max("box.max_x").alias("max_x"), F.max("box.max_y").alias("max_y"))


def with_lods(rows: DataFrame) -> DataFrame:
    """A row for each level of detail that shows a feature of rows(layer, tags, area)."""
    levels = F.filter(F.sequence(F.lit(0), F.lit(5)), lambda lod: T.in_lod(lod, F.col("layer"), F.col("tags"), F.col("area")))
    return rows.withColumn("lod", F.explode(levels))


def numbered(rows: DataFrame, order: list[str], name: str) -> DataFrame:
    """Consecutive numbers from 0 in an order that has no ties, without one task that sees all
    rows: range partitions are numbered each for itself and shifted by the counts before. The
    partitions are written down first, since their bounds are sampled and may come out
    otherwise when they are worked out again."""
    parts = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_p", F.spark_partition_id())
    parts = cut(parts.withColumn("_n", F.row_number().over(Window.partitionBy("_p").orderBy(*order)) - 1))
    per = parts.groupBy("_p").agg(F.count("*").alias("_c"))
    shift = per.withColumn("_s", F.coalesce(F.sum("_c").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("_c")
    return parts.join(F.broadcast(shift), "_p").withColumn(name, F.col("_n") + F.col("_s")).drop("_p", "_n", "_s")


def node_use(way_nodes: DataFrame, ways: DataFrame) -> DataFrame:
    """(node_id, uses): in how many of the ways a node is, each counted once."""
    return way_nodes.join(ways.select("way_id"), "way_id", "left_semi").groupBy("node_id").agg(F.count_distinct("way_id").alias("uses"))


def line_refs(relations: DataFrame, members: DataFrame) -> DataFrame:
    """(way_id, line_ref): the distinct refs of a way's route relations, numbers first and by value."""
    r = relations.where(F.col("t_route").isin("tracks", "railway")).select("rel_id", F.explode(F.split("t_ref", ";")).alias("ref"))
    r = r.select("rel_id", F.trim("ref").alias("ref")).where("ref <> ''")
    m = members.where("member_type = 'way'").select("rel_id", F.col("member_ref").alias("way_id"))
    number = F.expr("try_cast(ref AS bigint)")
    key = F.struct(number.isNull().alias("text"), number.alias("number"), F.col("ref").alias("ref"))
    g = m.join(r, "rel_id").groupBy("way_id").agg(F.array_sort(F.collect_set(key)).alias("refs"))
    return g.select("way_id", F.array_join("refs.ref", ";").alias("line_ref"))
