"""Word hashes of many texts at once, in numpy."""

from __future__ import annotations

import numpy as np

SPACE = np.zeros(256, bool)
SPACE[[32, *range(9, 14)]] = True
LOWERED = np.arange(256, dtype=np.uint8)
LOWERED[65:91] += 32
_K1, _K2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_MASKS = np.array([(1 << (8 * n)) - 1 for n in range(9)], np.uint64)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    h = (h ^ (h >> np.uint64(33))) * _K1
    h = (h ^ (h >> np.uint64(29))) * _K2
    return h ^ (h >> np.uint64(32))


def joined(first: np.ndarray, then: np.ndarray) -> np.ndarray:
    """A hash of ordered pairs of hashes."""
    return mix(first * _K2 + mix(then) + _K1)


def word_hashes(texts: list[str | None], space: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words [^\\x20\\x09-\\x0D]+ of all texts, A-Z lower-cased, and the number in each text.

    space: by byte, what parts words; it holds the line feed.
    """
    raw = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    buffer = np.frombuffer(b"\n".join(raw) + b"\n" + bytes(8), np.uint8)
    low = LOWERED[buffer]
    gap = space[low[:-8]]
    edge = np.flatnonzero(np.diff(np.concatenate(([True], gap)).astype(np.int8)))
    starts, ends = edge[::2], edge[1::2]
    size = ends - starts
    lanes = np.lib.stride_tricks.as_strided(low[: max(1, len(low) - 7)].view(np.uint8), (max(1, len(low) - 7), 8), (1, 1))
    h = size.astype(np.uint64) * _K2
    rest, at = np.arange(len(starts)), 0
    while len(rest):
        left = size[rest] - at
        lane = np.ascontiguousarray(lanes[starts[rest] + at]).view("<u8").ravel() & _MASKS[np.minimum(left, 8)]
        h[rest] = mix(h[rest] ^ lane)
        rest, at = rest[left > 8], at + 8
    bounds = np.cumsum([0, *(len(r) + 1 for r in raw)])
    return h, np.diff(np.searchsorted(starts, bounds))


def runs(*keys: np.ndarray) -> np.ndarray:
    """Where in equally long sorted arrays another tuple of values begins."""
    out = np.zeros(len(keys[0]), bool)
    if len(out):
        out[0] = True
        for k in keys:
            out[1:] |= k[1:] != k[:-1]
    return out


def spans(keys: np.ndarray, bits: int) -> tuple[np.ndarray, list[slice]]:
    """The ranges, by their first bits, that sorted keys fall in, and the keys of each; no range without keys."""
    of = (keys >> np.uint64(64 - bits)).astype(np.int32)
    cuts = np.append(np.flatnonzero(runs(of)), len(of))
    return of[cuts[:-1]], [slice(a, b) for a, b in zip(cuts.tolist(), cuts[1:].tolist(), strict=False)]


def pack_sorted(keys: np.ndarray) -> bytes:
    return pack(np.diff(keys, prepend=np.uint64(0)))


def unpack_sorted(b: bytes) -> np.ndarray:
    return np.cumsum(unpack(b, np.uint64), dtype=np.uint64)


def pack(a: np.ndarray) -> bytes:
    """The array's bytes plane by plane, which compress well where values are small."""
    return np.ascontiguousarray(a.view(np.uint8).reshape(len(a), a.itemsize).T).tobytes()


def unpack(b: bytes, dtype: type) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    return np.ascontiguousarray(np.frombuffer(b, np.uint8).reshape(size, -1).T).view(dtype).ravel()
