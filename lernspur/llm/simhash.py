"""Near copies by 64-bit SimHash, compared bit-sliced.

A text's fingerprint has the bits that are set in over half of its shingles' XXH64 values. Fingerprints within
``RADIUS`` bits link. Cut into SEGMENTS segments, two linked fingerprints agree in all segments but RADIUS at least,
so the distinct fingerprints are dealt out once for each choice of segments to agree in, by these segments'
bits. A block too large for one go is dealt out again by the same rule on the bits that are left; after that a block
holds 2**16 distinct fingerprints at most, as no more bits are left to differ in.

Within a task all its blocks lie one after another in a sorted list, and bit b of all fingerprints is one bit plane.
The list is compared with itself shifted by 1, 2, ... places: an exclusive or of each plane with its shifted self
gives the differing bits of 64 pairs a word, a carry-save counter (two planes and one for "more than the radius")
adds them up, and words in which every pair is over the radius, or leaves its block, are abandoned.

Links found are joined to trees at once, so a block returns fewer links than it has fingerprints. Exact copies share a
fingerprint and are one row in all this.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from lernspur.runtime import join_lookup, materialize, rows_of

from .ngramjoin import components
from .text import _LOWER, _SPACE, SLICE, column_bytes, edges

WIDTH = 3
SEED = 42
RADIUS = 2
BITS = 64
SEGMENTS = 4
LARGE = 4096  # a block of more distinct fingerprints is dealt out again by bits not yet used


# ---------------------------------------------------------------- fingerprints

def _words(data: np.ndarray):
    """Words of one text, in lists that follow slices of it; a word is never cut."""
    at, rest = 0, b""
    while at < len(data):
        part = data[at:at + SLICE]
        at += len(part)
        solid = ~_SPACE[part]
        raw = _LOWER[part].tobytes()
        starts, ends = edges(solid)
        own = [raw[a:b] for a, b in zip(starts.tolist(), ends.tolist())]
        if rest and len(part):
            if solid[0]:
                own[0] = rest + own[0]
            else:
                own.insert(0, rest)
            rest = b""
        if own and solid[-1] and at < len(data):
            rest = own.pop()
        yield own
    if rest:
        yield [rest]


def _bit_counts(hashes: np.ndarray) -> np.ndarray:
    return np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)


def fingerprint(data: np.ndarray, width: int = WIDTH) -> int:
    """Unsigned fingerprint of the bytes of a text; 0 without words."""
    total, ones, held = 0, np.zeros(BITS, np.int64), []
    digest = xxhash.xxh64_intdigest
    for own in _words(data):
        held += own
        if len(held) >= width:
            shingles = zip(*[held[k:] for k in range(width)])
            hashes = np.array([digest(b" ".join(s), SEED) for s in shingles], np.uint64)
            ones += _bit_counts(hashes)
            total += len(hashes)
            held = held[len(held) - width + 1:]
    if not total:
        return digest(b" ".join(held), SEED) if held else 0
    return int(np.packbits(2 * ones > total).view(">u8")[0])


def fingerprints(documents: DataFrame, width: int = WIDTH) -> DataFrame:
    """(doc_id, fp) of every row; fp is the fingerprint as a signed long."""
    def each(batches):
        for batch in batches:
            data, ends, _ = column_bytes(batch.column("text"))
            found = [fingerprint(data[a:b], width) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(np.array(found, np.uint64).view(np.int64))], names=["doc_id", "fp"])

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(each, "doc_id long, fp long")


# ---------------------------------------------------------------- bit-sliced comparison

def _shifted(planes: np.ndarray, words: np.ndarray, by: int) -> np.ndarray:
    """The planes' words at ``words``, after moving all bits down by ``by`` places."""
    far, near = divmod(by, 64)
    low = planes[..., words + far]
    if not near:
        return low
    return (low >> np.uint64(near)) | (planes[..., words + far + 1] << np.uint64(64 - near))


def _set_bits(words: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Positions of the set bits of ``values``, which stand at word numbers ``words``."""
    bits = np.unpackbits(values.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    row, bit = np.nonzero(bits)
    return words[row] * 64 + bit


def close_pairs(values: np.ndarray, block: np.ndarray, radius: int = RADIUS):
    """Index pairs (i, j), i < j, of values in one block that differ in ``radius`` bits or fewer, shift by shift.

    ``block`` is sorted. The counter holds up to 3, so ``radius`` is 3 at most.
    """
    n = len(values)
    ends = np.searchsorted(block, block, side="right")
    reach = ends - np.arange(n) - 1  # members of the block that come after
    longest = int(reach.max(initial=0))
    width = -(-n // 64)
    pad = longest // 64 + 2
    bits = np.unpackbits(values.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
    planes = np.zeros((BITS, width + pad), np.uint64)
    packed = np.packbits(bits, axis=0, bitorder="little")  # a byte for 8 members of a plane
    flat = np.zeros((BITS, width * 8), np.uint8)
    flat[:, :packed.shape[0]] = packed.T
    planes[:, :width] = flat.view("<u8")
    planes = planes[bits.any(axis=0) & ~bits.all(axis=0)]  # a plane without differences counts nothing
    far_reach = np.zeros(width * 64, np.int64)
    far_reach[:n] = reach
    top = far_reach.reshape(width, 64).max(axis=1)
    words = np.arange(width)
    for by in range(1, longest + 1):
        words = words[top[words] >= by]
        # Pairs that leave their block count as too far from the start.
        inside = np.packbits(far_reach.reshape(width, 64)[words] >= by, axis=1, bitorder="little").view("<u8").ravel()
        live, over = words, ~inside
        one, two = np.zeros_like(over), np.zeros_like(over)
        for at, plane in enumerate(planes):
            differ = plane[live] ^ _shifted(plane, live, by)
            carry = one & differ
            one ^= differ
            over |= two & carry  # 4 or more
            two ^= carry
            if at % 8 == 7 or at == len(planes) - 1:
                over |= _beyond(one, two, radius)
                keep = over != np.uint64(0xFFFFFFFFFFFFFFFF)
                if not keep.all():
                    live, over, one, two = live[keep], over[keep], one[keep], two[keep]
                    if not len(live):
                        break
        if len(live):
            i = _set_bits(live, ~(over | _beyond(one, two, radius)))
            if len(i):
                yield i, i + by


def _beyond(one: np.ndarray, two: np.ndarray, radius: int) -> np.ndarray:
    """Lanes whose counter stands above ``radius``."""
    return (one | two, two, one & two, np.zeros_like(one))[radius]


def _trees(values: np.ndarray, block: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect what the links within blocks connect, fewer than there are values."""
    up = np.arange(len(values))

    def roots(x):
        while True:
            y = up[x]
            if (y == x).all():
                return x
            x = y

    for i, j in close_pairs(values, block, radius):
        while True:
            a, b = roots(i), roots(j)
            apart = a != b
            if not apart.any():
                break
            i, j, a, b = i[apart], j[apart], a[apart], b[apart]
            np.minimum.at(up, np.maximum(a, b), np.minimum(a, b))
    own = np.arange(len(values))
    top = roots(own)
    return values[own != top], values[top[own != top]]


# ---------------------------------------------------------------- blocks

def _key(chosen: tuple[int, ...], low: int, bits: int) -> Column:
    """The chosen segments' bits of fp as one long; segments are counted from bit ``low``, ``bits`` each."""
    parts = [F.shiftleft(F.shiftrightunsigned("fp", low + s * bits).bitwiseAND((1 << bits) - 1), k * bits)
             for k, s in enumerate(chosen)]
    out = parts[0]
    for p in parts[1:]:
        out = out.bitwiseOR(p)
    return out


def _choices(segments: int, radius: int) -> list[tuple[int, ...]]:
    return list(combinations(range(segments), segments - radius))


def _first_blocks(distinct: DataFrame, radius: int) -> DataFrame:
    """(choice, key, fp) once for each choice of segments that may agree."""
    bits = BITS // SEGMENTS
    rows = [F.struct(F.lit(n).alias("choice"), _key(c, 0, bits).alias("key"))
            for n, c in enumerate(_choices(SEGMENTS, radius))]
    return distinct.select("fp", F.inline(F.array(*rows)))


def _second_blocks(large: DataFrame, radius: int) -> DataFrame:
    """Blocks of ``large`` dealt out again, by segments of the bits that were not in their key."""
    choices, bits = _choices(SEGMENTS, radius), BITS // SEGMENTS
    out = None
    for n, chosen in enumerate(choices):
        left = [s for s in range(SEGMENTS) if s not in chosen]
        # The bits left, as one number, are cut as the whole was.
        rest = _key(tuple(left), 0, bits)
        part = large.where(F.col("choice") == n).withColumn("rest", rest)
        size = len(left) * bits // SEGMENTS
        rows = []
        for m, again in enumerate(choices):
            piece = [F.shiftleft(F.shiftrightunsigned("rest", s * size).bitwiseAND((1 << size) - 1), k * size)
                     for k, s in enumerate(again)]
            finer = piece[0]
            for p in piece[1:]:
                finer = finer.bitwiseOR(p)
            rows.append(F.struct(F.lit(n * len(choices) + m).alias("choice"), "key", finer.alias("finer")))
        part = part.select("fp", F.inline(F.array(*rows)))
        out = part if out is None else out.union(part)
    return out


def _linked(blocks: DataFrame, keys: list[str], radius: int) -> DataFrame:
    """(x, y) that connect linked fingerprints; ``blocks`` with fp and keys, dealt out by the keys."""
    dealt = blocks.repartition(*keys).sortWithinPartitions(*keys)

    def links(batches):
        def found(held):
            table = pa.Table.from_batches(held)
            values = table.column("fp").to_numpy().view(np.uint64)
            names = [table.column(k).to_numpy() for k in keys]
            new = np.zeros(len(values), bool)
            for name in names:
                new[1:] |= name[1:] != name[:-1]
            x, y = _trees(values, np.cumsum(new), radius)
            return pa.RecordBatch.from_pydict({"x": x.view(np.int64), "y": y.view(np.int64)})

        held, size = [], 0
        for batch in batches:
            if size and size + batch.num_rows > 1 << 18:
                # Whole blocks go, the last one waits for the rest of its rows.
                table = pa.Table.from_batches(held).combine_chunks()
                last = np.ones(size, bool)
                for k in keys:
                    name = table.column(k).to_numpy()
                    last &= name == name[-1]
                cut = int(np.flatnonzero(last)[0])
                if cut:
                    yield found(table.slice(0, cut).to_batches())
                held = table.slice(cut).to_batches()
                size -= cut
            held.append(batch)
            size += batch.num_rows
        if size:
            yield found(held)

    return dealt.mapInArrow(links, "x long, y long")


def close_links(distinct: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(x, y): links that connect all fp of ``distinct`` within ``radius`` bits of each other; distinct, stored."""
    blocks = _first_blocks(distinct, radius)
    sizes = blocks.groupBy("choice", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    # Nearly all blocks have one member; of the others, the few large ones are told apart.
    shared = materialize(blocks.join(sizes, ["choice", "key"]))
    small = _linked(shared.where(F.col("n") <= LARGE).select("fp", "choice", "key"), ["choice", "key"], radius)
    large = shared.where(F.col("n") > LARGE).select("fp", "choice", "key")
    finer = _linked(_second_blocks(large, radius), ["choice", "key", "finer"], radius)
    return materialize(small.union(finer).distinct())


# ---------------------------------------------------------------- documents

def near_copies(documents: DataFrame, width: int = WIDTH, radius: int = RADIUS) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every document.

    Texts are cut into words with A-Z lower-cased; fewer than ``width`` words are one shingle, a text without
    words or a null one has fingerprint zero and links like any other. component_id is the smallest doc_id among the
    rows reachable by links; null ids are never the smallest, and a component without any other id has null. One row
    per input row, repeated rows included; other columns are ignored, whatever their names.
    """
    rows = materialize(fingerprints(documents, width))
    distinct = materialize(rows.groupBy("fp").agg(F.min("doc_id").alias("least")))
    known = rows_of(distinct)
    found = close_links(distinct.select("fp"), radius)
    comps = materialize(components(found, rows_of(found))).toDF("fp", "comp")
    own = distinct.join(comps, "fp", "left").withColumn("comp", F.coalesce("comp", "fp"))
    least = own.groupBy("comp").agg(F.min("least").alias("component_id"))
    # Few rows for each component before the ids go back to its fingerprints, and from these to the documents.
    named = materialize(join_lookup(own.select("fp", "comp"), least, ["comp"], rows=known).select("fp", "component_id"))
    return join_lookup(rows, named, ["fp"], rows=known).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
