"""Word scanning and hashing over Arrow columns of texts, vectorised with numpy.

A word is a maximal run of bytes other than space and 0x09-0x0D. Work goes through slices of
about a megabyte, so memory follows the words of one batch and not the length of a text.
"""

from __future__ import annotations

import ctypes
import gc

import numpy as np
import pyarrow as pa

SLICE = 1 << 20

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

_STEP = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_MASK = (1 << 64) - 1
_BYTES = np.random.Generator(np.random.PCG64(7)).integers(
    1, 1 << 63, 256, dtype=np.uint64, endpoint=False) * np.uint64(2) + np.uint64(1)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


_UP = _powers(_STEP, SLICE)
_DOWN = _powers(pow(_STEP, -1, 1 << 64), SLICE)


def release() -> None:
    """Give freed memory back to the system at the end of a task: Python workers outlive tasks and stages."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU C library
    if trim is not None:
        trim(0)


def mix(x: np.ndarray) -> np.ndarray:
    """A one-to-one scramble of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def column_bytes(column) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes, offsets and validity of an Arrow text column; null texts are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    n = len(column)
    valid = np.ones(n, bool) if column.null_count == 0 else np.asarray(column.is_valid())
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64), valid
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, np.int64)[column.offset:column.offset + n + 1]
    flat = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)
    return flat, ends, valid


def spans(offsets: np.ndarray):
    """Runs of whole texts of about a slice each: (first, last + 1). Longer texts come alone."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + SLICE, side="right")) - 1
        j = min(max(j, i + 1), n)
        yield i, j
        i = j


def hash_runs(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte runs [start, end) of ``data``, which holds one slice at most."""
    sums = np.empty(len(data) + 1, np.uint64)
    sums[0] = 0
    np.cumsum(_BYTES[data] * _UP[:len(data)], out=sums[1:])
    runs = (sums[ends] - sums[starts]) * _DOWN[np.minimum(starts, SLICE - 1)]
    return mix(runs + (ends - starts).astype(np.uint64))


def _hash_long(data: np.ndarray) -> np.ndarray:
    """The same hash for one run longer than a slice."""
    total, shift = 0, 1
    for at in range(0, len(data), SLICE):
        part = data[at:at + SLICE]
        total += int((_BYTES[part] * _UP[:len(part)]).sum(dtype=np.uint64)) * shift
        shift = shift * pow(_STEP, SLICE, 1 << 64) & _MASK
    return mix(np.array([(total + len(data)) & _MASK], np.uint64))


def edges(solid: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of True."""
    change = np.flatnonzero(np.diff(np.concatenate(([False], solid, [False])).view(np.int8)))
    return change[::2], change[1::2]


def _one_text(data: np.ndarray) -> np.ndarray:
    """Word hashes of a text longer than a slice, cut between words."""
    out, at = [], 0
    while at < len(data):
        part = data[at:at + SLICE]
        space = np.flatnonzero(_SPACE[part])
        if at + SLICE >= len(data):
            cut = len(part)
        elif len(space):
            cut = int(space[-1]) + 1
        else:  # one word fills the slice: look for its end
            cut = len(part)
            while at + cut < len(data):
                more = np.flatnonzero(_SPACE[data[at + cut:at + cut + SLICE]])
                cut += int(more[0]) if len(more) else len(data[at + cut:at + cut + SLICE])
                if len(more):
                    break
            out.append(_hash_long(data[at:at + cut]))
            at += cut
            continue
        starts, ends = edges(~_SPACE[part[:cut]])
        out.append(hash_runs(part[:cut], starts, ends))
        at += cut
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def word_hashes(column, lower: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all words of a text column, offsets of the texts in them, and validity.

    With ``lower``, A-Z are lower-cased first; other letters are left as they are.
    """
    data, offsets, valid = column_bytes(column)
    hashes, counts = [], np.zeros(len(offsets) - 1, np.int64)
    for i, j in spans(offsets):
        part = data[offsets[i]:offsets[j]]
        if lower:
            part = _LOWER[part]
        if j == i + 1 and len(part) > SLICE:
            own = _one_text(part)
            hashes.append(own)
            counts[i] = len(own)
            continue
        solid = ~_SPACE[part]
        starts, ends = edges(solid)
        # A word that runs over a border between texts is cut there.
        borders = offsets[i + 1:j] - offsets[i]
        borders = borders[(borders > 0) & (borders < len(part))]
        borders = np.unique(borders[solid[borders] & solid[borders - 1]]) if len(borders) else borders
        if len(borders):
            starts = np.sort(np.concatenate((starts, borders)))
            ends = np.sort(np.concatenate((ends, borders)))
        hashes.append(hash_runs(part, starts, ends))
        counts[i:j] = np.diff(np.searchsorted(starts, offsets[i:j + 1] - offsets[i]))
    flat = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
    return flat, np.concatenate(([0], np.cumsum(counts))), valid


_PLACE = [np.uint64(x) for x in (
    0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3,
    0x589965CC75374CC3, 0x1D8E4E27C47D124F, 0xEB44ACCAB455D165, 0x9E6C63D0876A9A4B)]


def windows(words: np.ndarray, width: int) -> np.ndarray:
    """Hash of each run of ``width`` words; order counts."""
    n = len(words) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for k in range(width):
        total += mix(words[k:k + n] ^ _PLACE[k % 8]) * _PLACE[(k + 3) % 8]
        total = (total << np.uint64(7)) | (total >> np.uint64(57))
    return mix(total)


def shingle_sets(words: np.ndarray, offsets: np.ndarray, width: int):
    """Sorted distinct shingles of each text; fewer words than ``width`` make one shingle."""
    all_windows = windows(words, width)
    for a, b in zip(offsets[:-1], offsets[1:]):
        if b - a >= width:
            yield np.unique(all_windows[a:b - width + 1])
        elif b > a:
            yield windows(words[a:b], int(b - a)) ^ np.uint64(b - a)
        else:
            yield np.zeros(0, np.uint64)
