"""Suffix-array dedup: difference-cover sorting of what may repeat, then adjacent prefixes."""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from permaway.llm.batches import text_batches
from permaway.llm.shingles import BASE, BYTE, INVERSE, mix, powers
from permaway.operators.scratch import bytes_of, cut, hint_small

#: Bytes of a seed; a window of `length` bytes is filed under the smallest hash of its seeds.
SEED = 20
#: Windows in one stretch at most, and bytes of a text taken at once.
STRETCH, PIECE = 64, 1 << 22
#: Seeds that a task gathers before it sends them.
SEEDS_HELD = 2_000_000
#: Stretches sorted together; a seed with more than a quarter of that has a group of its own, and one
#: with more different stretches than HOT is compared window by window instead.
BUCKET, HOT = 2_000, 8_000
#: Bits of the filter of repeated seeds: sixteen for each, up to this bound.
FILTER_BITS = 1 << 28


def stretches(raw: bytes, length: int):
    """(start, windows, seed, content) of the stretches of a text, as arrays.

    Every run of `length` bytes has one seed, the smallest hash among its SEED-byte runs.
    A stretch is a run of neighbouring windows that have one seed; content is a hash of
    all its bytes. Equal windows have equal seeds wherever they stand, so stretches of
    different seeds have no window in common.
    """
    out = []
    for at in range(0, max(1, len(raw) - length + 1), PIECE):
        b = np.frombuffer(raw[at : at + PIECE + length - 1], np.uint8)
        if len(b) < length:
            break
        sums = np.zeros(len(b) + 1, np.uint64)
        np.cumsum(BYTE[b] * powers(BASE, len(b)), out=sums[1:])
        back = powers(INVERSE, len(b) + 1)
        low = mix((sums[SEED:] - sums[:-SEED]) * back[: len(b) - SEED + 1])
        width, done = length - SEED + 1, 1
        while done * 2 <= width:
            low = np.minimum(low[:-done], low[done:])
            done *= 2
        if width > done:
            low = np.minimum(low[: len(low) - (width - done)], low[width - done :])
        start = np.r_[0, np.flatnonzero(low[1:] != low[:-1]) + 1]
        run = np.diff(np.r_[start, len(low)])
        if (run > STRETCH).any():
            parts = -(-run // STRETCH)
            first = np.cumsum(parts) - parts
            k = np.arange(parts.sum()) - np.repeat(first, parts)
            start, run = np.repeat(start, parts) + k * STRETCH, np.minimum(np.repeat(run, parts) - k * STRETCH, STRETCH)
        stop = start + run - 1 + length
        content = mix((sums[stop] - sums[start]) * back[start] + run.astype(np.uint64))
        out.append((start + at, run, low[start].view(np.int64), content.view(np.int64)))
    if not out:
        return tuple(np.zeros(0, np.int64) for _ in range(4))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def _texts(docs: DataFrame) -> DataFrame:
    """(doc, row, text): doc_id as a number, a hash that tells rows of one id apart, and the bytes."""
    t = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    return docs.select(F.col("doc_id").cast("bigint").alias("doc"), F.xxhash64(t).alias("row"), t.alias("text"))


def pack(sorted_values: np.ndarray) -> bytes:
    """Increasing numbers as differences, the low bytes of all first; planes of zeros are left out."""
    gaps = np.diff(sorted_values, prepend=np.uint64(0))
    width = max(1, -(-int(gaps[1:].max(initial=0)).bit_length() // 8)) if len(gaps) > 1 else 1
    planes = gaps.view(np.uint8).reshape(-1, 8).T[:width].copy()
    planes[:, 0] = 0
    return int(gaps[0]).to_bytes(8, "little") + bytes([width]) + planes.tobytes()


def unpack(blob: bytes) -> np.ndarray:
    width = blob[8]
    low = np.frombuffer(blob, np.uint8, offset=9).reshape(width, -1)
    gaps = np.zeros((low.shape[1], 8), np.uint8)
    gaps[:, :width] = low.T
    gaps = gaps.view(np.uint64).ravel()
    gaps[0] = int.from_bytes(blob[:8], "little")
    return np.cumsum(gaps)


def shared_seeds(texts: DataFrame, length: int, slice_bytes: int = 1 << 21) -> DataFrame:
    """(seed): seeds of two texts at least.

    A task sends each seed once, as sorted numbers packed by slices of their range, so
    that a seed of very many texts counts once a task; a slice is what one task joins,
    and the number of slices follows the size of the input."""
    bits = max(6, (bytes_of(texts) // slice_bytes).bit_length())

    def sent(seeds: list[np.ndarray]) -> pa.RecordBatch:
        values, counts = np.unique(np.concatenate(seeds), return_counts=True)
        rows = []
        for several in (False, True):
            v = values[(counts > 1) == several]
            cut_at = np.flatnonzero(np.diff(v >> np.uint64(64 - bits))) + 1
            rows += [(int(x[0] >> np.uint64(64 - bits)), several, pack(x)) for x in np.split(v, cut_at) if len(x)]
        kinds = (pa.int64(), pa.bool_(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], ["slice", "several", "packed"])

    def run(batches):
        seeds, held = [], 0
        for batch in batches:
            for text in batch.column(0):
                s = np.unique(stretches(text.as_py(), length)[2].view(np.uint64))
                seeds.append(s)
                held += len(s)
                if held > SEEDS_HELD:
                    yield sent(seeds)
                    seeds, held = [], 0
        if held:
            yield sent(seeds)

    def joined(pdf):
        parts = [unpack(b) for b in pdf["packed"]]
        parts += [unpack(b) for b, s in zip(pdf["packed"], pdf["several"], strict=True) if s]
        values, counts = np.unique(np.concatenate(parts), return_counts=True)
        return pd.DataFrame({"seed": values[counts > 1].view(np.int64)})

    rows = texts.select("text").mapInArrow(run, "slice bigint, several boolean, packed binary")
    return rows.groupBy("slice").applyInPandas(joined, "seed bigint")


class SeedFilter:
    """Two bits for each seed in a table of fixed size: it may let a seed through that is
    not there (the more, the fuller it is), and never holds one back that is."""

    def __init__(self, bits: int, table: np.ndarray | None = None):
        self.bits = bits
        self.table = np.zeros(bits // 8, np.uint8) if table is None else table

    def places(self, seeds: np.ndarray):
        s = mix(seeds.view(np.uint64) + np.uint64(1))
        return (s & np.uint64(self.bits - 1)), (s >> np.uint64(32)) & np.uint64(self.bits - 1)

    def has(self, seeds: np.ndarray) -> np.ndarray:
        out = np.ones(len(seeds), bool)
        for p in self.places(seeds):
            out &= (self.table[p >> np.uint64(3)] >> (p & np.uint64(7)).astype(np.uint8)) & 1 == 1
        return out


def seed_filter(shared: DataFrame, most_bits: int = FILTER_BITS) -> SeedFilter:
    """The filter of a table of seeds. Tasks set bits in slices of 64 KB that are joined by
    slice; the driver gets the slices, most_bits at most."""
    n, bits = shared.count(), 1 << 20
    while bits < min(16 * n, most_bits):
        bits *= 2
    per = 1 << 19

    def run(batches):
        f = SeedFilter(bits)
        for batch in batches:
            for p in f.places(batch.column(0).to_numpy()):
                np.bitwise_or.at(f.table, p >> np.uint64(3), np.uint8(1) << (p & np.uint64(7)).astype(np.uint8))
        parts = [(i, f.table[i * per // 8 : (i + 1) * per // 8]) for i in range(bits // per)]
        parts = [(i, x.tobytes()) for i, x in parts if x.any()]
        yield pa.RecordBatch.from_arrays([pa.array([i for i, _ in parts], pa.int32()), pa.array([x for _, x in parts], pa.binary())], ["at", "bits"])

    def joined(pdf):
        x = np.bitwise_or.reduce([np.frombuffer(b, np.uint8) for b in pdf["bits"]])
        return pd.DataFrame({"at": pdf["at"][:1].to_numpy(), "bits": [x.tobytes()]})

    out = SeedFilter(bits)
    slices = shared.select("seed").coalesce(max(1, min(32, n // 200_000 + 1))).mapInArrow(run, "at int, bits binary")
    for at, held in slices.groupBy("at").applyInPandas(joined, "at int, bits binary").collect():
        out.table[at * per // 8 : (at + 1) * per // 8] = np.frombuffer(held, np.uint8)
    return out


PLACES = ("seed", "content", "doc", "row", "start", "windows")


def _candidates(texts: DataFrame, found: SeedFilter, length: int) -> DataFrame:
    """(seed, content, doc, row, start, windows) of the stretches whose seeds the filter has."""
    sent = texts.sparkSession.sparkContext.broadcast((found.bits, found.table))

    def run(batches):
        f = SeedFilter(*sent.value)
        for batch in batches:
            parts, held = [], 0
            for doc, row, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                start, run_, seed, content = stretches(text.as_py(), length)
                keep = f.has(seed)
                n = int(keep.sum())
                if n:
                    parts.append((seed[keep], content[keep], np.full(n, doc), np.full(n, row), start[keep], run_[keep]))
                held += n
                if held > 100_000:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*parts, strict=True)], PLACES)
                    parts, held = [], 0
            if held:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*parts, strict=True)], PLACES)

    return texts.where("doc is not null").mapInArrow(run, ", ".join(f"{c} bigint" for c in PLACES))


def _bytes_of(texts: DataFrame, wanted: SeedFilter, length: int) -> DataFrame:
    """(seed, content, bytes) of the stretches whose contents the filter has, each once a batch."""
    sent = texts.sparkSession.sparkContext.broadcast((wanted.bits, wanted.table))

    def run(batches):
        f = SeedFilter(*sent.value)
        kinds = [pa.int64(), pa.int64(), pa.binary()]
        for batch in batches:
            rows = {}
            for text in batch.column(0):
                raw = text.as_py()
                start, run_, seed, content = stretches(raw, length)
                keep = np.flatnonzero(f.has(content))
                for a, n, s, c in zip(start[keep].tolist(), run_[keep].tolist(), seed[keep].tolist(), content[keep].tolist(), strict=True):
                    if (s, c) not in rows:
                        rows[s, c] = raw[a : a + n - 1 + length]
            if rows:
                columns = [[s for s, _ in rows], [c for _, c in rows], list(rows.values())]
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, kinds, strict=True)], ["seed", "content", "bytes"])

    return texts.where("doc is not null").select("text").mapInArrow(run, "seed bigint, content bigint, bytes binary")


def _names(*keys: np.ndarray) -> np.ndarray:
    """Ranks from 1 of rows of keys (0 or more each), equal rows alike; keys that fit are packed into one."""
    bits = [int(k.max(initial=0)).bit_length() for k in keys]
    if sum(bits) <= 63:
        packed = np.zeros(len(keys[0]), np.int64)
        for k, b in zip(keys, bits, strict=True):
            packed = (packed << b) | k
        keys = (packed,)
        order = np.argsort(packed)
    else:
        order = np.lexsort(keys[::-1])
    new = np.zeros(len(order), bool)
    for k in keys:
        s = k[order]
        new[1:] |= s[1:] != s[:-1]
    out = np.empty(len(order), np.int64)
    out[order] = np.cumsum(new) + 1
    return out


def difference_cover_ranks(text: np.ndarray, depth: int) -> np.ndarray:
    """Ranks of all suffixes of text (integers above 0) by their first `depth` symbols at
    least; suffixes that agree for three to the number of rounds symbols may share a rank.

    The places that are not multiples of three are the cover. Their triples are sorted
    and named; the names, those of places 1 mod 3 before those of 2 mod 3, are a text of
    two thirds the length that covers three symbols with one, which is sorted the same
    way. Suffixes at multiples of three are then sorted by their first symbol and the
    rank of what follows, and merged with the cover by searching keys that both have.
    """
    n = len(text)
    t = np.concatenate((text, np.zeros(4, np.int64)))
    if n < 3 or depth <= 1:
        return _names(t[:n], t[1 : n + 1], t[2 : n + 2]) if n else np.zeros(0, np.int64)
    one, two = np.arange(1, n + (n % 3 == 1), 3), np.arange(2, n, 3)
    cover = np.concatenate((one, two))
    name = _names(t[cover], t[cover + 1], t[cover + 2])
    if depth > 3 and name.max() < len(cover):
        # A zero ends the first half, so that no name of it runs into the second.
        deeper = difference_cover_ranks(np.concatenate((name[: len(one)], [0], name[len(one) :])) + 1, -(-depth // 3))
        name = _names(np.concatenate((deeper[: len(one)], deeper[len(one) + 1 :])))
    rank = np.zeros(n + 4, np.int64)
    rank[cover] = name
    zero = np.arange(0, n, 3)
    m = int(name.max()) + 2
    own = t[zero] * m + rank[zero + 1]
    one, two = one[one < n], two
    # Places in the merged order: keys (symbol, rank after it) against 1 mod 3, and
    # (symbol, symbol, rank after them) against 2 mod 3, as ranks of the pooled keys.
    pooled = _names(np.concatenate((t[zero], t[one])), np.concatenate((rank[zero + 1], rank[one + 1])))
    zero_1, one_1 = pooled[: len(zero)], pooled[len(zero) :]
    pooled = _names(np.concatenate((t[zero], t[two])), np.concatenate((t[zero + 1], t[two + 1])), np.concatenate((rank[zero + 2], rank[two + 2])))
    zero_2, two_2 = pooled[: len(zero)], pooled[len(zero) :]
    by_zero, by_one, by_two = np.sort(own), np.sort(one_1), np.sort(two_2)
    out = np.zeros(n, np.int64)
    out[zero] = np.searchsorted(by_zero, own) + np.searchsorted(by_one, zero_1) + np.searchsorted(by_two, zero_2)
    z1, z2 = np.sort(zero_1), np.sort(zero_2)
    names = np.sort(rank[np.concatenate((one, two))])
    out[one] = np.searchsorted(names, rank[one]) + np.searchsorted(z1, one_1)
    out[two] = np.searchsorted(names, rank[two]) + np.searchsorted(z2, two_2)
    return out


def least_docs(pieces: list[bytes], docs: np.ndarray, length: int) -> list[np.ndarray]:
    """For each piece and each of its windows, the smallest doc of a piece that has the window.

    All pieces are one text with an end mark after each; its suffixes are sorted by
    difference cover to `length` symbols and those that begin a window are compared
    with the one before by their first `length` bytes."""
    sizes = np.array([len(p) for p in pieces])
    end = np.cumsum(sizes + 1)
    text = np.frombuffer(b"\0".join(pieces) + b"\0", np.uint8).astype(np.int64) + 2
    text[end - 1] = 1
    rank = difference_cover_ranks(text, length)
    windows = sizes - length + 1
    first = np.repeat(end - sizes - 1, windows)
    nth = np.arange(windows.sum()) - np.repeat(np.cumsum(windows) - windows, windows)
    at, owner = first + nth, np.repeat(docs, windows)
    order = np.argsort(rank[at], kind="stable")
    sorted_at = at[order]
    view = np.lib.stride_tricks.sliding_window_view(text, length)
    new = np.ones(len(order), bool)
    for i in range(1, len(order), 1 << 16):
        j = min(len(order), i + (1 << 16))
        new[i:j] = (view[sorted_at[i:j]] != view[sorted_at[i - 1 : j - 1]]).any(1)
    group = np.cumsum(new) - 1
    least = np.minimum.reduceat(owner[order], np.flatnonzero(new))
    out = np.empty(len(order), np.int64)
    out[order] = least[group]
    return np.split(out, np.cumsum(windows)[:-1])


def _agreement(seeds: np.ndarray, sides: np.ndarray) -> np.ndarray:
    """How many leading bytes each row of sides shares at most with another row of its seed."""
    words = np.ascontiguousarray(sides).view(">u8").astype(np.uint64)
    order = np.lexsort((*words.T[::-1], seeds))
    s, x = seeds[order], sides[order]
    differ = x[1:] != x[:-1]
    same = np.where(differ.any(1), differ.argmax(1), x.shape[1])
    same[s[1:] != s[:-1]] = 0
    out = np.zeros(len(seeds), np.int64)
    out[order[1:]] = same
    out[order[:-1]] = np.maximum(out[order[:-1]], same)
    return out


def shared_parts(pieces: list[bytes], seeds: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Half-open ranges of windows that another piece of the seed may have too.

    What pieces have in common around their seed is no longer than what each shares with
    its neighbours when the bytes after the seed, or those before it read backwards, are
    sorted. Where a piece of a seed holds it twice or is a long run, all pieces of that seed keep
    all, since what they share may lie at another place of the seed than the last."""
    sizes = np.array([len(p) for p in pieces])
    first = np.cumsum(sizes) - sizes
    text = np.frombuffer(b"".join(pieces), np.uint8)
    sums = np.zeros(len(text) + 1, np.uint64)
    np.cumsum(BYTE[text] * powers(BASE, len(text)), out=sums[1:])
    grams = mix((sums[SEED:] - sums[:-SEED]) * powers(INVERSE, len(text) + 1)[: len(text) - SEED + 1]).view(np.int64)
    owner = np.repeat(np.arange(len(pieces)), sizes)[: len(grams)]
    inside = np.arange(len(grams)) - first[owner] <= (sizes - SEED)[owner]
    hits = np.flatnonzero((grams == seeds[owner]) & inside)
    times = np.bincount(owner[hits], minlength=len(pieces))
    at = np.zeros(len(pieces), np.int64)
    at[owner[hits]] = hits - first[owner[hits]]
    width = -(-(length - SEED) // 8) * 8
    padded = np.concatenate((np.zeros(width, np.uint8), text, np.zeros(width, np.uint8)))
    steps = np.arange(width)
    left = at[:, None] - 1 - steps
    right = at[:, None] + SEED + steps
    before = np.where(left >= 0, padded[width + first[:, None] + np.maximum(left, 0)], 0)
    after = np.where(right < sizes[:, None], padded[width + first[:, None] + np.minimum(right, sizes[:, None] - 1)], 0)
    lead, follow = _agreement(seeds, before.astype(np.uint8)), _agreement(seeds, after.astype(np.uint8))
    lo, hi = np.maximum(0, at - lead), np.minimum(sizes - length, follow + at + SEED - length)
    # Sides are padded alike and cut at `width`; a side that agrees to its end says nothing of what follows.
    whole = (times != 1) | (sizes > 2 * length - SEED)
    whole = np.isin(seeds, seeds[whole])
    lo[whole], hi[whole] = 0, (sizes - length)[whole]
    return lo, np.maximum(hi + 1, lo)


RUNS = "seed bigint, content bigint, high bigint, runs array<struct<a:int,b:int,doc:bigint>>"
ONE_RUN = "array(named_struct('a', 0, 'b', int(windows), 'doc', low)) as runs"


def _sorted_runs(rows: DataFrame, length: int) -> DataFrame:
    """(seed, content, runs) of rows(bucket, seed, content, low, bytes): runs of windows [a, b)
    that have a smaller doc elsewhere, and that doc; all windows have `low` besides."""

    def run(pdf):
        pieces, low = list(map(bytes, pdf["bytes"])), pdf["low"].to_numpy(np.int64)
        lo, hi = shared_parts(pieces, pdf["seed"].to_numpy(np.int64), length)
        some = np.flatnonzero(hi > lo)
        out = [[{"a": 0, "b": len(p) - length + 1, "doc": int(d)}] for p, d in zip(pieces, low, strict=True)]
        if len(some):
            found = least_docs([pieces[i][lo[i] : hi[i] - 1 + length] for i in some], low[some], length)
            for i, least in zip(some.tolist(), found, strict=True):
                edge = np.r_[0, np.flatnonzero(least[1:] != least[:-1]) + 1, len(least)]
                out[i] += [{"a": int(a + lo[i]), "b": int(b + lo[i]), "doc": int(least[a])} for a, b in zip(edge[:-1], edge[1:], strict=True) if least[a] < low[i]]
        return pd.DataFrame({"seed": pdf["seed"], "content": pdf["content"], "high": pdf["high"], "runs": out})

    return rows.groupBy("bucket").applyInPandas(run, RUNS)


def _hot_runs(rows: DataFrame, length: int) -> DataFrame:
    """The same for seeds with very many different stretches: windows are rows and their
    smallest doc an aggregate that is combined before the shuffle, so no seed is in one task."""
    w = rows.select("seed", "content", "low", F.posexplode(F.expr(f"transform(sequence(1, int(windows)), i -> substring(bytes, i, {length}))")).alias("a", "w"))
    w = w.select("seed", "content", "low", "a", F.unhex(F.md5("w")).alias("w"))
    least = w.groupBy("w").agg(F.min("low").alias("doc"))
    j = w.join(least, "w").where("doc < low").groupBy("seed", "content").agg(F.sort_array(F.collect_list(F.expr("named_struct('a', a, 'b', a + 1, 'doc', doc)"))).alias("runs"))
    every = rows.select("seed", "content", "high", F.expr(ONE_RUN))
    return every.alias("e").join(j.alias("j"), ["seed", "content"], "left").select("seed", "content", "high", F.concat(F.col("e.runs"), F.coalesce(F.col("j.runs"), F.expr("cast(array() as array<struct<a:int,b:int,doc:bigint>>)"))).alias("runs"))


def removed_spans(texts: DataFrame, length: int = 50) -> DataFrame:
    """(doc, row, spans array<struct<a:int,b:int>>): what goes from each text, joined where it touches."""
    shared = cut(shared_seeds(texts, length))
    found = cut(_candidates(texts, seed_filter(shared), length))
    one = cut(found.groupBy("seed", "content").agg(F.min("doc").alias("low"), F.max("doc").alias("high"), F.first("windows").alias("windows")))
    # Seeds with several different stretches; all else is settled by the smallest doc of a stretch.
    kinds = one.groupBy("seed").agg(F.count("*").alias("kinds"), F.min("low").alias("lo"), F.max("high").alias("hi"))
    kinds = cut(kinds.where("kinds > 1 and lo < hi").select("seed", "kinds"))
    kinds = hint_small(kinds)
    several = cut(one.join(kinds, "seed").select("seed", "content", "low", "high", "windows", "kinds"))
    buckets = max(1, -(-several.count() // BUCKET))
    wanted = seed_filter(several.select(F.col("content").alias("seed")))
    held = _bytes_of(texts, wanted, length).groupBy("seed", "content").agg(F.first("bytes").alias("bytes"))
    several = cut(several.join(held, ["seed", "content"]))
    few = several.where(F.col("kinds") <= HOT).withColumn("bucket", F.when(F.col("kinds") > BUCKET // 4, F.col("seed")).otherwise(F.pmod(F.xxhash64("seed"), F.lit(buckets))))
    runs = _sorted_runs(few.select("bucket", "seed", "content", "low", "high", "bytes"), length)
    runs = runs.unionByName(_hot_runs(several.where(F.col("kinds") > HOT), length))
    alone = one.join(kinds, "seed", "left_anti").where("low < high").select("seed", "content", "high", F.expr(ONE_RUN))
    runs = runs.unionByName(alone)
    runs = cut(runs.where("exists(runs, r -> r.doc < high)").select("seed", "content", "runs"))
    gone = found.select("seed", "content", "doc", "row", "start").join(runs, ["seed", "content"])
    gone = gone.select("doc", "row", F.expr(f"transform(filter(runs, r -> r.doc < doc), r -> named_struct('a', int(start + r.a), 'b', int(start + r.b - 1 + {length})))").alias("s")).where("size(s) > 0")

    def joined(batches):
        for batch in batches:
            out = []
            for spans in batch.column(2).to_pylist():
                spans = sorted((s["a"], s["b"]) for s in spans)
                merged = [list(spans[0])]
                for a, b in spans[1:]:
                    if a <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], b)
                    else:
                        merged.append([a, b])
                out.append([{"a": a, "b": b} for a, b in merged])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())])))], ["doc", "row", "spans"])

    by_text = gone.groupBy("doc", "row").agg(F.flatten(F.collect_list("s")).alias("s"))
    return by_text.mapInArrow(joined, "doc bigint, row bigint, spans array<struct<a:int,b:int>>")


def later_copies(docs: DataFrame) -> DataFrame:
    """(doc, row) of texts that are, as a whole, the text of a smaller doc_id. They lose all and
    give nothing that the smaller one does not give, so that only the others are searched."""
    t = _texts(docs).where("doc is not null").select("doc", "row", F.unhex(F.md5("text")).alias("digest"))
    first = cut(t.groupBy("digest").agg(F.min("doc").alias("low"), F.max("doc").alias("high")).where("low < high"))
    return t.join(first, "digest").where("doc > low").select("doc", "row").distinct()


def dedup_substrings(docs: DataFrame, length: int = 50) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept (bytes) and spans, one row per row of docs.

    A byte goes if a run of `length` bytes that covers it also starts in a text of a
    smaller doc_id. Null texts are empty; rows without a doc_id neither lose bytes nor
    take any; rows of one id do not act on each other. Other columns are not read.
    """
    docs = text_batches(docs)
    copies = cut(later_copies(docs)).select(F.col("doc").alias("_c"), F.col("row").alias("_k"))
    copies = hint_small(copies)
    all_texts = _texts(docs)
    texts = all_texts.join(copies, (F.col("doc") == F.col("_c")) & (F.col("row") == F.col("_k")), "left_anti")
    spans = cut(removed_spans(texts, length)).select(F.col("doc").alias("_d"), F.col("row").alias("_r"), "spans")
    joined = all_texts.join(hint_small(spans), (F.col("doc") == F.col("_d")) & (F.col("row") == F.col("_r")), "left").select("doc", "row", "text", "spans")
    joined = joined.join(copies, (F.col("doc") == F.col("_c")) & (F.col("row") == F.col("_k")), "left")
    whole = F.when(F.octet_length("text") >= length, F.array(F.struct(F.lit(0).alias("a"), F.octet_length("text").alias("b"))))
    joined = joined.select("doc", "text", F.when(F.col("_c").isNotNull(), whole).otherwise(F.col("spans")).alias("spans"))

    def run(batches):
        names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept", "spans"]
        for batch in batches:
            sizes, removed, digests, kept, own = [], [], [], [], []
            for text, spans in zip(batch.column(1), batch.column(2).to_pylist(), strict=True):
                raw, spans, at, parts = text.as_py(), spans or [], 0, []
                for s in spans:
                    parts.append(raw[at : s["a"]])
                    at = s["b"]
                rest = b"".join([*parts, raw[at:]])
                sizes.append(len(raw))
                removed.append(len(raw) - len(rest))
                digests.append(hashlib.sha256(rest).hexdigest())
                kept.append(rest)
                own.append(spans)
            arrays = [batch.column(0), pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()), pa.array([len(s) for s in own], pa.int64()), pa.array(digests, pa.string()), pa.array(kept, pa.binary()), pa.array(own, pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())])))]
            yield pa.RecordBatch.from_arrays(arrays, names)

    return joined.mapInArrow(run, "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept binary, spans array<struct<a:int,b:int>>")


def op3_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    return dedup_substrings(spark.read.parquet(f"{sf_dir}/documents.parquet")).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
