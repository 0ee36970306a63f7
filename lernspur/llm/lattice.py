"""Tries of words and the vocabulary pieces that end at each of their nodes.

Distinct words are sorted and read as a trie, level by level: the nodes of level d are the distinct
prefixes of d bytes. Every dynamic program over the segmentations of a word only looks at prefixes,
so it runs once per node, for all words that share the prefix.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from .text import SLICE, _LOWER, _SPACE, column_bytes, edges, hash_runs, spans

DEPTH = 64  # longer words are worked on one by one

_STEP = np.uint64(0x9E3779B97F4A7C15)
_SALT = np.random.Generator(np.random.PCG64(11)).integers(1, 1 << 63, 256, dtype=np.uint64)
_BITS = 18


def _fold(pieces: list[bytes]) -> np.ndarray:
    """Hashes of byte strings of one length."""
    flat = np.frombuffer(b"".join(pieces), np.uint8).reshape(len(pieces), -1)
    total = np.zeros(len(pieces), np.uint64)
    for k in range(flat.shape[1]):
        total = total * _STEP + _SALT[flat[:, k]]
    return total


class Pieces:
    """Vocabulary pieces by length, found by hash; ``number`` maps a piece to its row."""

    def __init__(self, pieces: list[bytes]):
        self.pieces = pieces
        self.number = {p: i for i, p in enumerate(pieces)}
        self.longest = max(map(len, pieces))
        self.by_length = {}
        for n in sorted({len(p) for p in pieces}):
            own = np.array([i for i, p in enumerate(pieces) if len(p) == n])
            hashes = _fold([pieces[i] for i in own])
            order = np.argsort(hashes)
            seen = np.zeros(1 << _BITS, bool)
            seen[hashes >> np.uint64(64 - _BITS)] = True
            self.by_length[n] = hashes[order], own[order], seen

    def find(self, hashes: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Positions in ``hashes`` that are pieces of ``n`` bytes, and which ones."""
        known, own, seen = self.by_length[n]
        at = np.flatnonzero(seen[hashes >> np.uint64(64 - _BITS)])
        if not len(at):
            return at, at
        k = np.minimum(np.searchsorted(known, hashes[at]), len(known) - 1)
        good = known[k] == hashes[at]
        return at[good], own[k[good]]


def sentence_pieces(path: str) -> tuple[list[bytes], list[int]]:
    """Pieces of a public sentencepiece vocabulary and their ranks; the word mark is a space."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces, ranks = [], []
    for i in range(model.get_piece_size()):
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i)):
            text = model.id_to_piece(i).replace("▁", " ")
            if " " not in text[1:]:
                pieces.append(text.encode())
                ranks.append(len(ranks))
    return pieces, ranks


def default_vocabulary(name: str = "piece_bpe_32k.model") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@dataclass
class Level:
    parent: np.ndarray  # node of the level above
    byte: np.ndarray
    hash: np.ndarray


class Trie:
    """Trie of distinct words given as (bytes, starts, ends), each with a space in front."""

    def __init__(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray):
        sizes = ends - starts + 1
        deepest = int(sizes.max(initial=1))
        flat = np.zeros((len(starts), -(-deepest // 8) * 8), np.uint8)
        flat[:, 0] = 0x20
        for d in range(1, deepest):
            has = np.flatnonzero(sizes > d)
            flat[has, d] = data[starts[has] + d - 1]
        keys = flat.view(">u8")
        order = np.lexsort((sizes, *[keys[:, k] for k in range(keys.shape[1] - 1, -1, -1)]))
        flat, sizes = flat[order], sizes[order]
        common = np.zeros(len(order), np.int64)
        if len(order) > 1:
            differ = flat[1:] != flat[:-1]
            first = np.where(differ.any(axis=1), differ.argmax(axis=1), deepest)
            common[1:] = np.minimum(first, np.minimum(sizes[1:], sizes[:-1]))
        self.levels = [Level(np.zeros(1, np.int64), np.zeros(1, np.uint8), np.zeros(1, np.uint64))]
        self.depth = np.empty(len(order), np.int64)
        self.node = np.empty(len(order), np.int64)  # of the word's last byte, at level depth
        self.depth[order] = sizes
        at = np.zeros(len(order), np.int64)
        for d in range(1, deepest + 1):
            live = np.flatnonzero(sizes >= d)
            new = common[live] < d
            new[0] = True
            new[1:] |= live[1:] != live[:-1] + 1
            above = self.levels[-1]
            heads = live[new]
            parent, byte = at[heads], flat[heads, d - 1]
            self.levels.append(Level(parent, byte, above.hash[parent] * _STEP + _SALT[byte]))
            at[live] = np.cumsum(new) - 1
            done = live[sizes[live] == d]
            self.node[order[done]] = at[done]

    def matches(self, pieces: Pieces):
        """(level, length, nodes, their ancestors ``length`` levels up, piece numbers), level by level."""
        shift = np.full(DEPTH + 2, _STEP, np.uint64)
        shift[0] = 1
        shift = np.cumprod(shift, dtype=np.uint64)
        for d in range(1, len(self.levels)):
            level = self.levels[d]
            up = np.arange(len(level.parent))
            for n in range(1, min(d, pieces.longest) + 1):
                up = self.levels[d - n + 1].parent[up]
                if n in pieces.by_length:
                    own = level.hash - self.levels[d - n].hash[up] * shift[n]
                    found, which = pieces.find(own, n)
                    if len(found):
                        yield d, n, found, up[found], which


def word_runs(column, lower: bool, size: int = 4 * SLICE):
    """Slices of about ``size`` bytes of a text column as (first text, last + 1, bytes, starts, ends, text of each word)."""
    data, offsets, _ = column_bytes(column)
    for i, j in spans_of(offsets, size):
        part = data[offsets[i]:offsets[j]]
        part = _LOWER[part] if lower else part
        solid = ~_SPACE[part]
        starts, ends = edges(solid)
        borders = offsets[i + 1:j] - offsets[i]
        borders = borders[(borders > 0) & (borders < len(part))]
        borders = np.unique(borders[solid[borders] & solid[borders - 1]]) if len(borders) else borders
        starts, ends = np.sort(np.concatenate((starts, borders))), np.sort(np.concatenate((ends, borders)))
        of = np.searchsorted(offsets[i:j + 1] - offsets[i], starts, side="right") - 1
        yield i, j, part, starts.astype(np.int64), ends.astype(np.int64), of


def spans_of(offsets: np.ndarray, size: int):
    i, n = 0, len(offsets) - 1
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + size, side="right")) - 1
        j = min(max(j, i + 1), n)
        yield i, j
        i = j


def distinct_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray):
    """(index of one word of each kind, kind of each word, kinds longer than a trie is deep)."""
    hashes = np.empty(len(starts), np.uint64)
    # Hash sums run over one slice at a time, cut between words.
    at = 0
    while at < len(starts):
        stop = max(int(np.searchsorted(ends, starts[at] + SLICE, side="right")), at + 1)
        a, b = int(starts[at]), int(ends[stop - 1])
        if b - a <= SLICE:
            hashes[at:stop] = hash_runs(data[a:b], starts[at:stop] - a, ends[at:stop] - a)
        else:
            import hashlib
            hashes[at] = np.frombuffer(hashlib.sha256(data[a:b]).digest()[:8], np.uint64)[0]
        at = stop
    _, first, kind = np.unique(hashes, return_index=True, return_inverse=True)
    long = np.flatnonzero(ends[first] - starts[first] + 1 > DEPTH)
    return first, kind, long
