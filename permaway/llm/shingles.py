"""64-bit hashes of words and of runs of words, over whole texts, with numpy."""

from __future__ import annotations

import numpy as np

_rng = np.random.default_rng(20240229)
#: Random values of bytes and an odd base, both fixed by the seed above.
BYTE = _rng.integers(1, 1 << 63, 256, np.int64).astype(np.uint64)
BASE = int(_rng.integers(1, 1 << 62)) * 2 + 1
INVERSE = pow(BASE, -1, 1 << 64)
SPACE = np.isin(np.arange(256), [32, *range(9, 14)])
#: Bytes hashed at once; longer texts are cut at white space.
PIECE = 1 << 22
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base^0 .. base^(n-1) modulo 2^64, kept and grown as needed."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = 1 << max(12, (n - 1).bit_length())
        have = np.ones(size, np.uint64)
        have[1:] = np.uint64(base)
        _powers[base] = have = np.multiply.accumulate(have)
    return have[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a bijection)."""
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def _pieces(raw: bytes):
    at = 0
    while len(raw) - at > PIECE:
        stop = at + PIECE
        while stop < len(raw) and not SPACE[raw[stop]]:
            stop += 1
        yield raw[at:stop]
        at = stop
    yield raw[at:]


def word_hashes(raw: bytes) -> np.ndarray:
    """One hash for each run of bytes other than ASCII white space, in order; A-Z count as a-z."""
    out = []
    for piece in _pieces(raw.lower()):
        b = np.frombuffer(piece, np.uint8)
        solid = np.concatenate(([False], ~SPACE[b], [False]))
        edges = np.flatnonzero(solid[1:] != solid[:-1])
        starts, stops = edges[::2], edges[1::2]
        sums = np.zeros(len(b) + 1, np.uint64)
        np.cumsum(BYTE[b] * powers(BASE, len(b)), out=sums[1:])
        out.append(mix((sums[stops] - sums[starts]) * powers(INVERSE, len(b) + 1)[starts] + (stops - starts).astype(np.uint64)))
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def shingle_set(raw: bytes | None, k: int) -> np.ndarray:
    """Sorted distinct hashes of the k-word runs; fewer words, but some, are one run; none, none."""
    w = word_hashes(raw) if raw else np.zeros(0, np.uint64)
    if len(w) == 0:
        return w
    size = min(k, len(w))
    h = np.full(len(w) - size + 1, size, np.uint64)
    for i in range(size):
        h = mix(h * np.uint64(0x94D049BB133111EB) + w[i : len(w) - size + 1 + i])
    return np.unique(h)
