"""Bytes of map features: variable-length numbers, shuffled planes, blocks."""

from __future__ import annotations

import hashlib

import numpy as np
import zstandard

#: Bits of a feature's flags: what follows its vertex count.
INDICES, WIDE, HOLES, SEGMENTS, JUNCTIONS, METADATA = 1, 2, 4, 8, 16, 32


def put_varint(n: int, out: bytearray) -> None:
    """Seven bits to a byte, low ones first."""
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    out.append(n)


def get_varint(data: bytes, at: int) -> tuple[int, int]:
    n = shift = 0
    while True:
        b = data[at]
        at += 1
        n |= (b & 0x7F) << shift
        if b < 0x80:
            return n, at
        shift += 7


def shuffle(data: bytes, stride: int) -> bytes:
    """First bytes of all items, then second ones, and so on; what is over stays at the end."""
    n = len(data) // stride * stride
    return np.frombuffer(data[:n], np.uint8).reshape(-1, stride).T.tobytes() + data[n:]


def unshuffle(data: bytes, stride: int) -> bytes:
    n = len(data) // stride * stride
    return np.frombuffer(data[:n], np.uint8).reshape(stride, -1).T.tobytes() + data[n:]


def _put_numbers(values, kind: str, out: bytearray) -> None:
    put_varint(len(values), out)
    out += np.asarray(values, kind).tobytes()


def _get_numbers(data: bytes, at: int, kind: str):
    n, at = get_varint(data, at)
    size = n * np.dtype(kind).itemsize
    return np.frombuffer(data[at : at + size], kind).astype(int).tolist(), at + size


def put_structure(f: dict, strings: dict[str, int], out: bytearray) -> None:
    """All of a feature but its coordinates. Lists that are empty cost a bit; indices take two
    bytes each up to 65536 vertices; texts are numbers in a table."""
    n = len(f["points"])
    lists = (("indices", INDICES), ("hole_starts", HOLES), ("segment_ids", SEGMENTS), ("junctions", JUNCTIONS), ("metadata", METADATA))
    flags = sum(bit for k, bit in lists if f.get(k)) | (WIDE if n > 65536 else 0)
    out.append(flags)
    put_varint(n, out)
    if flags & INDICES:
        _put_numbers(f["indices"], "<u4" if flags & WIDE else "<u2", out)
    for k, bit in lists[1:4]:
        if flags & bit:
            put_varint(len(f[k]), out)
            for v in f[k]:
                put_varint(int(v), out)
    if flags & METADATA:
        put_varint(len(f["metadata"]), out)
        for k, v in sorted(f["metadata"].items()):
            put_varint(strings.setdefault(k, len(strings)), out)
            put_varint(strings.setdefault(v, len(strings)), out)


def get_structure(data: bytes, at: int, strings: list[str], skip: bool = False) -> tuple[dict, int, int]:
    """(feature, vertices, next place); with skip only lengths are read."""
    flags = data[at]
    n, at = get_varint(data, at + 1)
    f: dict = {"indices": [], "hole_starts": [], "segment_ids": [], "junctions": [], "metadata": {}}
    if flags & INDICES:
        kind = "<u4" if flags & WIDE else "<u2"
        if skip:
            m, at = get_varint(data, at)
            at += m * np.dtype(kind).itemsize
        else:
            f["indices"], at = _get_numbers(data, at, kind)
    for k, bit in (("hole_starts", HOLES), ("segment_ids", SEGMENTS), ("junctions", JUNCTIONS)):
        if flags & bit:
            m, at = get_varint(data, at)
            for _ in range(m):
                v, at = get_varint(data, at)
                f[k].append(v)
    if flags & METADATA:
        m, at = get_varint(data, at)
        for _ in range(m):
            k, at = get_varint(data, at)
            v, at = get_varint(data, at)
            if not skip:
                f["metadata"][strings[k]] = strings[v]
    return f, n, at


def encode_block(layers: dict[int, list[dict]], level: int = 9) -> tuple[bytes, int, int]:
    """(block, raw size, layer mask) of the features of one tile and level of detail: the table of
    texts and the structures, then all x and all y as shuffled planes, compressed as a whole."""
    strings: dict[str, int] = {}
    body, xs, ys, mask = bytearray(), [], [], 0
    put_varint(len(layers), body)
    for layer, features in sorted(layers.items()):
        mask |= 1 << layer
        put_varint(layer, body)
        put_varint(len(features), body)
        for f in features:
            put_structure(f, strings, body)
            xs += [p[0] for p in f["points"]]
            ys += [p[1] for p in f["points"]]
    return *_packed(strings, body, np.asarray(xs, "<f4"), np.asarray(ys, "<f4"), level), mask


def encode_arrays(layers: np.ndarray, sizes: np.ndarray, metadata: list[tuple], x: np.ndarray, y: np.ndarray, level: int = 9) -> tuple[bytes, int, int]:
    """What encode_block gives for features of points and metadata alone, by layer: a layer, a number of
    points and sorted pairs of texts to each, and the coordinates of all. Structures that are
    the same are made once."""
    strings: dict[str, int] = {}
    kept: dict[tuple, bytes] = {}
    body, mask = bytearray(), 0
    found, first = np.unique(layers, return_index=True)
    put_varint(len(found), body)
    for layer, start, stop in zip(found.tolist(), first.tolist(), [*first[1:].tolist(), len(layers)], strict=True):
        mask |= 1 << layer
        put_varint(layer, body)
        put_varint(stop - start, body)
        for key in zip(sizes[start:stop].tolist(), metadata[start:stop], strict=True):
            if key not in kept:
                put_structure({"points": range(key[0]), "metadata": dict(key[1])}, strings, one := bytearray())
                kept[key] = bytes(one)
            body += kept[key]
    return *_packed(strings, body, x, y, level), mask


def _packed(strings: dict[str, int], body: bytearray, x: np.ndarray, y: np.ndarray, level: int) -> tuple[bytes, int]:
    """(block, raw size)."""
    head = bytearray()
    put_varint(len(strings), head)
    for s in strings:
        raw = s.encode()
        put_varint(len(raw), head)
        head += raw
    planes = b"".join(shuffle(v.astype("<f4", copy=False).tobytes(), 4) for v in (x, y))
    raw = bytearray()
    put_varint(len(head) + len(body), raw)
    raw += head + body + planes
    return zstandard.ZstdCompressor(level=level).compress(bytes(raw)), len(raw)


def read_block(block: bytes, wanted: set[int] | None = None):
    """(x, y, features): the coordinates of a block, and one by one (layer, feature without points,
    first vertex, vertices). Of layers that are not wanted only lengths are read, to find the rest."""
    raw = zstandard.ZstdDecompressor().decompress(block)
    size, at = get_varint(raw, 0)
    planes = at + size
    count, at = get_varint(raw, at)
    strings = []
    for _ in range(count):
        n, at = get_varint(raw, at)
        strings.append(raw[at : at + n].decode())
        at += n
    half = (len(raw) - planes) // 2
    x = np.frombuffer(unshuffle(raw[planes : planes + half], 4), "<f4")
    y = np.frombuffer(unshuffle(raw[planes + half :], 4), "<f4")

    def features(at=at):
        layers, at = get_varint(raw, at)
        v = 0
        for _ in range(layers):
            layer, at = get_varint(raw, at)
            count, at = get_varint(raw, at)
            keep = wanted is None or layer in wanted
            for _ in range(count):
                f, n, at = get_structure(raw, at, strings, skip=not keep)
                if keep:
                    yield layer, f, v, n
                v += n

    return x, y, features()


def decode_block(block: bytes, wanted: set[int] | None = None) -> dict[int, list[dict]]:
    """Features by layer. Of layers that are not wanted only lengths are read, to find the rest."""
    x, y, features = read_block(block, wanted)
    out: dict[int, list[dict]] = {}
    for layer, f, v, n in features:
        out.setdefault(layer, []).append(f | {"points": list(zip(x[v : v + n].tolist(), y[v : v + n].tolist(), strict=True))})
    return out


def block_hash(block: bytes) -> str:
    return hashlib.sha256(block).hexdigest() if block else "0" * 64
