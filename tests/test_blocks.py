"""Blocks of tiles: the same bytes from Arrow's arrays, and decoding in bounded batches."""

import numpy as np
import pyarrow as pa

from permaway.functions import codec
from permaway.sources import container

ROWS = "tile_id bigint, lod int, layer int, way_id bigint, points array<struct<x:float,y:float>>, metadata map<string,string>"


def _rows():
    return [(t, 0, w % 3 + 1, 1000 - w, [(float(w + i), float(w - i)) for i in range(w % 6)], {"railway": "rail", "n": str(w % 7)} if w % 4 else {}) for t in (7, 8) for w in range(200)]


def test_blocks_are_those_of_the_features(spark):
    rows = _rows()
    blocks = container.encode(spark.createDataFrame(rows, ROWS)).collect()
    assert sorted(b.tile_id for b in blocks) == [7, 8]
    for b in blocks:
        layers = {}
        for _, _, layer, _, points, metadata in sorted((r for r in rows if r[0] == b.tile_id), key=lambda r: (r[2], r[3])):
            layers.setdefault(layer, []).append({"points": points, "metadata": metadata})
        block, size, mask = codec.encode_block(layers)
        assert (bytes(b.block), b.raw_size, b.layer_mask, b.features, b.sha256) == (block, size, mask, 200, codec.block_hash(block))


def test_round_trip(spark):
    rows = _rows()
    out = container.decode(container.encode(spark.createDataFrame(rows, ROWS))).collect()
    plain = lambda t, lod, layer, points, metadata: (t, lod, layer, tuple(tuple(p) for p in points), tuple(sorted(metadata.items())))
    assert sorted(plain(*r) for r in out) == sorted(plain(t, lod, layer, p, m) for t, lod, layer, _, p, m in rows)
    some = container.decode(container.encode(spark.createDataFrame(rows, ROWS)), {2})
    assert {r.layer for r in some.collect()} == {2} and some.count() == sum(r[2] == 2 for r in rows)


def test_a_worker_does_not_hold_a_batch_of_blocks_decoded():
    """Forty blocks of 20,000 points come to the worker as one batch, and went on as one."""
    block, _, _ = codec.encode_block({1: [{"points": [(float(i), 0.0) for i in range(10)], "metadata": {}} for _ in range(2000)]})
    yielded = [len(b) for b in _batches(block, 40)]
    assert sum(yielded) == 80_000 and max(yielded) <= 10_000


def _batches(block, n):
    """What the worker's function of decode yields for one batch of n blocks."""
    kept = {}

    class Blocks:
        def select(self, *_):
            return self

        def mapInArrow(self, run, _):
            kept["run"] = run

        mapInPandas = mapInArrow

    container.decode(Blocks())
    batch = pa.RecordBatch.from_arrays([pa.array(np.arange(n)), pa.array([0] * n, pa.int32()), pa.array([block] * n, pa.binary())], ["tile_id", "lod", "block"])
    return list(kept["run"](iter([batch])))
