"""Tiles as blocks: a table with one compressed block for each tile and level of detail."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from permaway.functions import codec
from permaway.operators import features as O

BLOCKS = "tile_id bigint, lod int, layer_mask int, features int, raw_size int, sha256 string, block binary"
DECODED = "tile_id bigint, lod int, layer int, points array<struct<x:float,y:float>>, metadata map<string,string>"


def tile_rows(features: DataFrame) -> DataFrame:
    """A row for each tile, level of detail and feature of features(way_id, layer, tags, area, points, box)."""
    return O.with_lods(O.on_tiles(features)).select("tile_id", "lod", "layer", "way_id", "points", F.col("tags").alias("metadata"))


#: Points, texts and features that are decoded at once; a worker holds no more beside one block.
DECODED_AT_ONCE = 100_000


def encode(rows: DataFrame) -> DataFrame:
    """Blocks of tile rows. A group is one tile at one level, which is what a reader loads at once; it
    stays in Arrow's arrays."""

    def build(t: pa.Table) -> pa.Table:
        t = t.combine_chunks()
        layer, points, metadata = t["layer"].to_numpy(), t["points"].combine_chunks(), t["metadata"].combine_chunks()
        order = np.lexsort((t["way_id"].to_numpy(), layer))
        at, sizes = points.offsets.to_numpy()[:-1][order], np.diff(points.offsets.to_numpy())[order]
        place = np.repeat(at - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
        x, y = (c.to_numpy()[place] for c in points.values.flatten())
        pairs, of = list(zip(metadata.keys.to_pylist(), metadata.items.to_pylist(), strict=True)), metadata.offsets.to_pylist()
        block, size, mask = codec.encode_arrays(layer[order], sizes, [tuple(sorted(pairs[of[i] : of[i + 1]])) for i in order.tolist()], x, y)
        row = [t["tile_id"][0].as_py(), t["lod"][0].as_py(), mask, len(t), size, codec.block_hash(block), block]
        kinds = (pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.string(), pa.binary())
        return pa.table({c.split()[0]: pa.array([v], k) for c, v, k in zip(BLOCKS.split(", "), row, kinds, strict=True)})

    return rows.groupBy("tile_id", "lod").applyInArrow(build, BLOCKS)


def _decoded(found: list[tuple]) -> pa.RecordBatch:
    """A batch of rows (tile_id, lod, layer, metadata, x, y)."""
    tile, lod, layer, metadata, x, y = zip(*found, strict=True)
    starts = lambda lists: pa.array(np.r_[0, np.cumsum([len(v) for v in lists])], pa.int32())
    points = pa.StructArray.from_arrays([pa.array(np.concatenate(c), pa.float32()) for c in (x, y)], ["x", "y"])
    texts = [pa.array([s for m in metadata for s in part(m)], pa.string()) for part in (dict.keys, dict.values)]
    columns = [pa.array(tile, pa.int64()), pa.array(lod, pa.int32()), pa.array(layer, pa.int32()), pa.ListArray.from_arrays(starts(x), points), pa.MapArray.from_arrays(starts(metadata), *texts)]
    return pa.RecordBatch.from_arrays(columns, ["tile_id", "lod", "layer", "points", "metadata"])


def decode(blocks: DataFrame, layers: set[int] | None = None, lods: set[int] | None = None) -> DataFrame:
    """Features of blocks. Levels and layer masks are tested before a block is opened, so the
    scan prunes by columns; within a block unwanted layers are stepped over. Features are handed on
    as soon as DECODED_AT_ONCE is reached, whatever a batch of blocks or a block holds."""
    if lods is not None:
        blocks = blocks.where(F.col("lod").isin(*lods))
    if layers is not None:
        blocks = blocks.where(F.col("layer_mask").bitwiseAND(sum(1 << x for x in layers)) != 0)

    def run(batches):
        found, load = [], 0
        for batch in batches:
            for tile, lod, block in zip(*batch.columns, strict=True):
                x, y, features = codec.read_block(block.as_py(), layers)
                for layer, f, v, n in features:
                    found.append((tile.as_py(), lod.as_py(), layer, f["metadata"], x[v : v + n], y[v : v + n]))
                    load += 1 + n + len(f["metadata"])
                    if load >= DECODED_AT_ONCE:
                        yield _decoded(found)
                        found, load = [], 0
        if found:
            yield _decoded(found)

    return blocks.select("tile_id", "lod", "block").mapInArrow(run, DECODED)


def damaged(blocks: DataFrame) -> DataFrame:
    """Blocks whose bytes do not have the hash that is kept with them."""
    return blocks.where(F.sha2("block", 256) != F.col("sha256")).select("tile_id", "lod")


def write_tiles(rows: DataFrame, path: str) -> None:
    """Tile rows as Parquet by level and layer, sorted by tile within files, so that readers of some
    levels, layers or tiles touch little else."""
    rows.repartition("lod", "layer", F.pmod(F.xxhash64("tile_id"), F.lit(16))).sortWithinPartitions("tile_id").write.partitionBy("lod", "layer").option("compression", "zstd").parquet(path)


def read_tiles(spark: SparkSession, path: str, layers: set[int] | None = None, lod: int | None = None) -> DataFrame:
    t = spark.read.parquet(path)
    t = t if layers is None else t.where(F.col("layer").isin(*layers))
    return t if lod is None else t.where(F.col("lod") == lod)
