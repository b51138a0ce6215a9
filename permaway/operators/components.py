"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from permaway.operators.scratch import cut_clean as cut

#: Edges between long ids up to which the driver solves them: two megabytes. More go by rounds.
LOCAL = 1 << 17


def _star(e: DataFrame, large: bool) -> DataFrame:
    """One step: hang neighbours on the smallest node of a neighbourhood.

    Large-star looks at all neighbours and moves the larger ones; small-star looks
    at the smaller ones and moves those and the node itself. The smallest is an
    aggregate, combined before its shuffle and written down, and the edges are joined
    with that table: a join of two plain shuffles, whose hot partitions Spark splits, so
    a node with very many neighbours is never gathered in one task.
    """
    if large:
        e = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        e = e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = cut(e.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m")))
    j = e.join(low, "u")
    if large:
        out = j.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = j.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select("u", F.col("m").alias("v")))
    return out.where("u <> v").distinct()


def _are_stars(e: DataFrame) -> bool:
    """Whether every node of the distinct edges (u, v), u > v, hangs on one other or is hung on, but
    not both: then each component is its smallest node and what hangs on that."""
    n = e.select(F.col("u").alias("node"), F.lit(1).alias("up")).union(e.select("v", F.lit(0)))
    n = n.groupBy("node").agg(F.sum("up").alias("ups"), F.min("up").alias("all_up"))
    return n.where("ups > 1 or (ups = 1 and all_up = 0)").agg(F.count("*")).first()[0] == 0


def _solved(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct ends of the edges (u, v) and the smallest end that each reaches."""
    nodes, ends = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = ends[: len(u)], ends[len(u) :]
    low = np.arange(len(nodes))
    while True:
        # Roots hang on the smallest root that an edge leads to, then paths are halved to their ends.
        x, y = low[a], low[b]
        open_ = x != y
        if not open_.any():
            return nodes, nodes[low]
        a, b, x, y = a[open_], b[open_], x[open_], y[open_]
        np.minimum.at(low, np.maximum(x, y), np.minimum(x, y))
        while (low[low] != low).any():
            low = low[low]


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst", max_rounds: int = 60) -> DataFrame:
    """(node, component) of every node that has an edge to another; component is the
    smallest node reachable. Self loops, null ends, repeats and an empty table are fine.

    Rounds grow with the logarithm of the longest path; edges that hang on the smallest
    node of each component already take none. A round is two shuffles of the edges on one
    key; sizes fall as the stars form. The stop test is an aggregate computed by Spark.
    Edges are counted first: up to LOCAL of them, between longs, are solved by the driver,
    since a round of so few takes as long as its tasks take to start.
    """
    e = cut(
        edges.select(F.col(src).alias("u"), F.col(dst).alias("v"))
        .where("u is not null and v is not null and u <> v")
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .distinct()
    )
    if all(isinstance(f.dataType, LongType) for f in e.schema) and e.count() <= LOCAL:
        t = e.toArrow()
        nodes, low = _solved(t["u"].to_numpy(), t["v"].to_numpy())
        return e.sparkSession.createDataFrame(pa.table({"node": pa.array(nodes, pa.int64()), "component": pa.array(low, pa.int64())}))
    for _ in range(max_rounds):
        if _are_stars(e):
            break
        e = cut(_star(_star(e, True), False))
    else:
        raise RuntimeError("components did not settle")
    roots = e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
