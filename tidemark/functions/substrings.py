"""Substrings that may be among many names: rolling hashes of all places of a text against a bitmap of bounded size. What is found holds
every name in a text, and a few other substrings, which an equality join must tell apart."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

#: Base of the rolling hash and its inverse, modulo 2^64; what scatters a hash over the bitmap, a bit for each.
BASE = 0xA0761D6478BD642F
INVERSE = pow(BASE, -1, 1 << 64)
SCATTER = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93, 0xA24BAED4963EE407)
#: Bytes of text looked at at once, at least; bytes of hits that are compared at once.
BLOCK, HITS = 1 << 18, 1 << 24
#: Names of this length and above are looked for only where a prefix of 4, 8, 16, ... bytes is a name's.
LEAST_PREFIX = 4


class Names(NamedTuple):
    """The bitmap as bytes, its size as a power of two, and the lengths in bytes that names have."""

    bitmap: np.ndarray
    power: int
    lengths: list[int]


def _prefix_sizes(longest: int) -> list[int]:
    return [LEAST_PREFIX << k for k in range(longest.bit_length()) if LEAST_PREFIX << k <= longest]


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of texts and where each begins, with the end of the last; a null is an empty text."""
    if not len(column):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    column = column.cast(pa.large_binary())
    ends = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    return np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8), ends


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


class _Hashes:
    """Hashes of any substring of ``data``, by prefix sums."""

    def __init__(self, data: np.ndarray):
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data + np.uint64(1)) * _powers(BASE, len(data)), out=self.sums[1:])
        self.back = _powers(INVERSE, len(data) + 1)

    def at(self, places, n, whole: bool) -> np.ndarray:
        """Of the ``n`` bytes from each of ``places``; a name's hash differs from that of a prefix of a name."""
        ends = slice(places.start + n, places.stop + n) if isinstance(places, slice) else places + n
        mark = (np.atleast_1d(n).astype(np.uint64) * np.uint64(2) + np.uint64(whole)) * np.uint64(SCATTER[2])
        return (self.sums[ends] - self.sums[places]) * self.back[places] + mark


def _places(hashes: np.ndarray, scatter: int, power: int) -> np.ndarray:
    mixed = hashes ^ (hashes >> np.uint64(31))
    return (mixed * np.uint64(scatter)) >> np.uint64(64 - power)


def bits_of(names: pa.Array, power: int) -> pa.Array:
    """The bits of the bitmap that ``names`` (not empty) set: four for each and for each of its prefixes."""
    data, begins = _flat(names)
    hashes = _Hashes(data[begins[0] : begins[-1]])
    starts, sizes = begins[:-1] - begins[0], np.diff(begins)
    found = [hashes.at(starts, sizes, True)]
    for n in _prefix_sizes(int(sizes.max(initial=0))):
        found.append(hashes.at(starts[sizes >= n], n, False))
    every = np.unique(np.concatenate(found))
    return pa.array(np.unique(np.concatenate([_places(every, s, power) for s in SCATTER])).astype(np.int64))


def _hits(data: np.ndarray, n_starts: int, names: Names) -> Iterator[tuple[np.ndarray, int]]:
    """Per length of names, those of the first ``n_starts`` places at which such a name may begin."""
    hashes = _Hashes(data)

    def among(places: np.ndarray | None, n: int, whole: bool) -> np.ndarray:
        last = len(data) - n
        if places is None:
            places = np.arange(max(0, min(n_starts, last + 1)))
            h = hashes.at(slice(0, len(places)), n, whole)
        else:
            places = places[places <= last]
            h = hashes.at(places, n, whole)
        for scatter in SCATTER:
            at = _places(h, scatter, names.power)
            on = np.flatnonzero((names.bitmap[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & np.uint8(1))
            places, h = places[on], h[on]
        return places

    sizes, alive = _prefix_sizes(names.lengths[-1]), None
    for k, least in enumerate([1, *sizes]):
        most = sizes[k] if k < len(sizes) else names.lengths[-1] + 1
        if least >= LEAST_PREFIX:
            alive = among(alive, least, False)
        for n in names.lengths:
            if least <= n < most:
                yield among(alive, n, True), n


def _distinct(data: np.ndarray, owner: np.ndarray, starts: np.ndarray, n: int) -> Iterator[pa.Table]:
    """The distinct substrings of ``n`` bytes by their owner."""
    step = max(1, HITS // n)
    for k in range(0, len(starts), step):
        some = starts[k : k + step]
        body = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(data, n)[some])
        text = pa.Array.from_buffers(pa.large_string(), len(some), [None, pa.py_buffer(np.arange(len(some) + 1) * n), pa.py_buffer(body)])
        yield pa.table({"owner": owner[k : k + step], "name": text}).group_by(["owner", "name"], use_threads=False).aggregate([])


def held(texts: pa.Array, names: Names) -> Iterator[pa.Table]:
    """owner (place in ``texts``), name: the distinct substrings that may be names, a table for some texts each."""
    data, begins = _flat(texts)
    block = max(BLOCK, names.lengths[-1])
    first = 0
    while first < len(texts):
        last = max(first + 1, int(np.searchsorted(begins, begins[first] + block, "right")) - 1)  # whole texts, or one that is longer
        a, z, found = int(begins[first]), int(begins[last]), []
        for left in range(a, z, block):
            own = data[left : min(z, left + block + names.lengths[-1])]
            for starts, n in _hits(own, min(block, z - left), names):
                owner = np.searchsorted(begins, starts + left, "right") - 1
                inside = starts + left + n <= begins[owner + 1]
                found += _distinct(own, owner[inside], starts[inside], n)
        if found:
            table = pa.concat_tables(found)
            yield table.group_by(["owner", "name"], use_threads=False).aggregate([]).combine_chunks()
        first = last
