"""Word shingles and MinHash values of many texts at once, on plain byte arrays."""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa

WORDS = 5
HASHES = 64
# Bytes of text worked on at once; one longer text is worked on alone.
CHUNK = 1 << 20

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_MIX = np.uint64(0xBF58476D1CE4E5B9)
# Lower case of A-Z; 0 for the ASCII characters that are no part of a word.
_FOLD = np.zeros(256, np.uint8)
_FOLD[128:] = np.arange(128, 256)
_FOLD[48:58] = np.arange(48, 58)
_FOLD[97:123] = _FOLD[65:91] = np.arange(97, 123)
_random = np.random.default_rng(20240501)
_FACTORS = _random.integers(0, 1 << 32, HASHES, dtype=np.uint32) | np.uint32(1)
_SHIFTS = _random.integers(0, 1 << 32, HASHES, dtype=np.uint32)


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _MIX
    return x ^ (x >> np.uint64(29))


def word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hash and first byte of every word in ``data``."""
    folded = _FOLD[data]
    edges = np.flatnonzero(np.diff(folded != 0, prepend=False, append=False))
    starts, ends = edges[::2], edges[1::2]
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((folded.astype(np.uint64) + np.uint64(1)) * _powers(_BASE, len(data)), out=sums[1:])
    return _mixed((sums[ends] - sums[starts]) * _powers(_INVERSE, len(data) + 1)[starts]), starts


def shingle_sets(texts: pa.Array) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text. A text of fewer words than a shingle
    has one shingle, a null or wordless one has none."""
    texts = texts.cast(pa.large_binary())
    bounds = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    buffer = texts.buffers()[2]
    data = np.frombuffer(buffer, np.uint8) if buffer is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(texts):
        last = max(first + 1, int(np.searchsorted(bounds, bounds[first] + CHUNK, "right")) - 1)
        # A blank after each text keeps words of neighbours apart.
        inside = bounds[first:last + 1]
        part = np.insert(data[inside[0]:inside[-1]], inside[1:] - inside[0], 32)
        hashes, starts = word_hashes(part)
        cuts = np.searchsorted(starts, inside - inside[0] + np.arange(len(inside)))
        joined = np.zeros(max(0, len(hashes) - WORDS + 1), np.uint64)
        for k in range(WORDS):
            joined = joined * _BASE + hashes[k:k + len(joined)]
        joined = _mixed(joined)
        for a, b in zip(cuts[:-1], cuts[1:]):
            if b - a >= WORDS:
                yield np.unique(joined[a:b - WORDS + 1])
            elif b > a:
                whole = np.uint64(b - a)
                for h in hashes[a:b]:
                    with np.errstate(over="ignore"):
                        whole = whole * _BASE + h
                yield _mixed(np.array([whole]))
            else:
                yield joined[:0]
        first = last


def set_key(shingles: np.ndarray) -> str | None:
    """A 128-bit name of the set; None for the empty one."""
    return blake2b(shingles.tobytes(), digest_size=16).hexdigest() if len(shingles) else None


def minhash(shingles: np.ndarray) -> bytes:
    """``HASHES`` MinHash values of 32 bits."""
    low = (shingles >> np.uint64(32)).astype(np.uint32)
    out = np.full(HASHES, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(low), 4096):
        part = low[at:at + 4096]
        np.minimum(out, (part * _FACTORS[:, None] + _SHIFTS[:, None]).min(axis=1), out=out)
    return out.tobytes()
