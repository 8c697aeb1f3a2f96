"""Word shingles of many texts at once, as hashes, with numpy.

Words are ``[^\\x20\\x09-\\x0D]+`` after A-Z became a-z. A text's set holds the 64-bit
hashes of its distinct runs of ``k`` words; with fewer words, the whole sequence is the
only one; without words, there is none. Equal runs have equal hashes. Words of up to ``LONG_WORD`` bytes are
hashed all at once by a fixed polynomial modulo 2**64, longer ones by xxh3, as that polynomial has known collisions
of 1,024 bytes. The hashes are not keyed: unequal runs of a text that was not made to collide meet by
chance only, of which 10,000 words against 10,000 have one below 1e-10.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash

_U = np.uint64
_BASE = 0x9E6C63D0676A9A99  # odd, so it has an inverse modulo 2**64
_STEP = _U(0xD1342543DE82EF95)
#: Bytes of text that are looked at together (a longer text is taken alone).
SLICE_BYTES = 1_000_000
LONG_WORD = 256

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[32, 9, 10, 11, 12, 13]] = True

_POWERS: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values (the splitmix64 finalizer)."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, for texts of up to n bytes."""
    if "up" not in _POWERS or len(_POWERS["up"]) < n:
        size = max(n, SLICE_BYTES)
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 2 ** 64))):
            p = np.full(size, base, _U)
            p[0] = 1
            _POWERS[name] = np.multiply.accumulate(p)
    return _POWERS["up"][:n], _POWERS["down"][:n]


def _slice_sets(data: np.ndarray, offsets: np.ndarray, k: int) -> list[np.ndarray]:
    docs = len(offsets) - 1
    n = len(data)
    none = np.empty(0, _U)
    if not n:
        return [none] * docs
    low = _LOWER[data]
    space = _IS_SPACE[low]
    full = offsets[1:] > offsets[:-1]
    edge = np.zeros(n + 1, bool)
    edge[offsets[:-1][full]] = True
    edge[n] = True
    starts = np.flatnonzero(~space & (edge[:-1] | np.r_[True, space[:-1]]))
    ends = np.flatnonzero(~space & (edge[1:] | np.r_[space[1:], True])) + 1
    if not len(starts):
        return [none] * docs
    up, down = _powers(n)
    sums = np.zeros(n + 1, _U)
    np.cumsum((low.astype(_U) + _U(1)) * up, out=sums[1:])
    w = mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(_U))
    for i in np.flatnonzero(ends - starts > LONG_WORD):
        w[i] = xxhash.xxh3_64_intdigest(low[starts[i]:ends[i]].tobytes())
    doc = np.searchsorted(offsets, starts, "right") - 1
    per = np.bincount(doc, minlength=docs)
    first = np.r_[0, np.cumsum(per)]
    runs = np.zeros(max(0, len(w) - k + 1), _U)
    for i in range(k):
        runs = mix(runs * _STEP + w[i:len(w) - k + 1 + i]) if len(runs) else runs
    out = []
    for d in range(docs):
        if per[d] >= k:
            s = np.sort(runs[first[d]:first[d] + per[d] - k + 1])
            out.append(s[np.r_[True, s[1:] != s[:-1]]] if len(s) > 1 else s)
        elif per[d]:
            h = np.zeros(1, _U)
            for x in w[first[d]:first[d] + per[d]]:
                h = mix(h * _STEP + x)
            out.append(mix(h + _U(per[d])))  # apart from runs of k words
        else:
            out.append(none)
    return out


def shingle_sets(texts: pa.Array, k: int) -> Iterator[np.ndarray]:
    """The sorted hash set of each text of a string column without nulls."""
    texts = texts.cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.empty(0, np.uint8)
    i = 0
    while i < len(texts):
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + SLICE_BYTES, "right")) - 1)
        j = min(j, len(texts))
        yield from _slice_sets(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i], k)
        i = j
