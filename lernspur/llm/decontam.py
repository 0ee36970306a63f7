"""Benchmark decontamination on templates.

Words are lower-cased and stripped of ASCII punctuation; then numbers, names and units become typed
placeholders. What is left is the template, so an exercise with other numbers or names still has the same one.
Windows of template tokens of all documents are hashed and joined with those of the benchmark. A
pair of windows gives, for every placeholder, a pair of fillers (benchmark's, document's). Over all
windows at about one place a repeated name must mostly stay one name; else the match is chance. A run of
placeholders of one kind is one token, so a name may have another number of words. Windows of the
plain tokens are joined as well, so verbatim copies are found whatever they are made of.

A bitmap of the benchmark's windows, of fixed size, lets tasks drop windows that cannot match before
anything is shuffled; false positives end in the join.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from lernspur.runtime import materialize

from .lattice import spans_of
from .text import SLICE, _LOWER, _SPACE, column_bytes, edges, hash_runs, mix, release

WIDTH = 8
LEAST_COVER = 0.5
LEAST_AGREE = 0.5
BITMAP_BITS = 1 << 26
LEXICON_BITS = 1 << 24
PIECE = SLICE // 4  # text that a Python worker cuts at a time; a longer one comes alone. A byte takes some 80 bytes of arrays

# Unit words, lower case without punctuation.
UNITS = ["mm", "cm", "m", "km", "in", "ft", "mi", "mg", "g", "kg", "lb", "oz", "ml", "l", "s", "sec", "min", "h", "hr",
         "hours", "days", "kmh", "mph", "usd", "eur", "percent", "dollars", "euros", "cents", "meters", "metres",
         "kilometers", "kilometres", "grams", "kilograms", "liters", "litres", "seconds", "minutes", "miles", "feet"]

WORD, NUMBER, NAME, UNIT = range(4)
_MARK = mix(np.arange(1, 5, dtype=np.uint64) * np.uint64(0x51ED270B))

_PUNCT = np.zeros(256, bool)
_PUNCT[list(b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~")] = True
_DIGIT = np.zeros(256, np.int64)
_DIGIT[48:58] = 1
_STOP = np.zeros(256, bool)
_STOP[list(b".!?:;\n\r")] = True
_END = np.zeros(256, bool)
_END[list(b".!?:;")] = True
_BASE = 0xD6E8FEB86659FD93


def _units() -> np.ndarray:
    text = " ".join(UNITS).encode()
    data = np.frombuffer(text, np.uint8)
    return np.sort(hash_runs(data, *edges(~_SPACE[data])))


class Tokens:
    """Tokens of joined texts; ``borders`` are the byte offsets of the texts.

    value (hash), number, capital, lower (case of the first letter), begin (starts a sentence or line), stop (a sentence ends before it), of (text).
    A capital token has a capital first letter and lower case after it.
    """

    def __init__(self, data: np.ndarray, borders: np.ndarray):
        owner = np.repeat(np.arange(len(borders) - 1, dtype=np.int64), np.diff(borders))
        keep = ~_PUNCT[data]
        kept = np.flatnonzero(keep)
        text, own = data[kept], owner[kept]
        solid = ~_SPACE[text]
        cut = np.zeros(len(text), bool)
        cut[1:] = own[1:] != own[:-1]
        change = np.diff(np.concatenate(([0], solid.view(np.int8), [0])))
        starts = np.union1d(np.flatnonzero(change == 1), np.flatnonzero(cut & solid))
        ends = np.union1d(np.flatnonzero(change == -1), np.flatnonzero(cut[1:] & solid[:-1]) + 1)
        if not len(starts):
            self.value, self.of = np.zeros(0, np.uint64), np.zeros(0, np.int64)
            self.number = self.capital = self.lower = self.begin = self.stop = self.unit = np.zeros(0, bool)
            return
        low = _LOWER[text]
        value, at = np.empty(len(starts), np.uint64), 0
        while at < len(starts):
            stop = max(int(np.searchsorted(ends, starts[at] + SLICE, side="right")), at + 1)
            a = int(starts[at])
            b = min(int(ends[stop - 1]), a + SLICE)
            value[at:stop] = hash_runs(low[a:b], starts[at:stop] - a, np.minimum(ends[at:stop], b) - a)
            at = stop
        sizes = ends - starts
        digits = np.concatenate(([0], np.cumsum(_DIGIT[text])))
        number = digits[ends] - digits[starts] == sizes
        head, after = text[starts], text[np.minimum(starts + 1, len(text) - 1)]
        wide = (head == 0xC3) & (after >= 0x80) & (after <= 0x9E)  # two-byte capitals
        next_at = np.minimum(starts + 1 + wide, len(text) - 1)
        lower_next = (text[next_at] >= 97) & (text[next_at] <= 122) | (text[next_at] == 0xC3)
        self.capital = (((head >= 65) & (head <= 90)) | wide) & lower_next & (sizes > 1 + wide)
        self.lower = (head >= 97) & (head <= 122) | (head == 0xC3) & (after >= 0x9F)
        # A stop between the last word and this one, or the text's beginning, starts a sentence.
        self.begin, self.stop = (self._after(x, data, kept, starts, ends, own) for x in (_STOP, _END))
        units = _units()
        k = np.minimum(np.searchsorted(units, value), len(units) - 1)
        after_number = np.concatenate(([False], number[:-1])) & (own[starts] == np.concatenate(([-1], own[starts[:-1]])))
        self.value, self.number, self.of = value, number, own[starts]
        self.unit = (units[k] == value) & after_number

    @staticmethod
    def _after(which, data, kept, starts, ends, own):
        seen = np.concatenate(([0], np.cumsum(which[data])))
        out = np.ones(len(starts), bool)
        out[1:] = (seen[kept[starts[1:]]] > seen[kept[ends[:-1] - 1]]) | (own[starts[1:]] != own[starts[:-1]])
        return out


def _pieces(column):
    """(first row, tokens) of a text column, some rows at a time."""
    data, offsets, _ = column_bytes(column)
    for i, j in spans_of(offsets, PIECE):
        yield i, Tokens(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])


class Template:
    """Tokens with placeholders, runs of the same kind merged: the arrays have one entry per run or word.

    token (what is hashed), kind, first and last (fillers: a name's first and last word, a hash of all
    numbers or units), start and end (raw tokens), of (text). A name ends with its sentence.
    """

    def __init__(self, tokens: Tokens, name: np.ndarray):
        kind = np.zeros(len(name), np.int8)
        kind[name] = NAME
        kind[tokens.number] = NUMBER
        kind[tokens.unit & (kind == WORD)] = UNIT
        new = np.ones(len(kind), bool)
        new[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == WORD) | (tokens.of[1:] != tokens.of[:-1]) \
            | ((kind[1:] == NAME) & tokens.stop[1:])
        self.start = np.flatnonzero(new)
        self.end = np.append(self.start[1:], len(kind))[:len(self.start)]
        self.kind, self.of = kind[self.start], tokens.of[self.start]
        self.first, self.last = tokens.value[self.start], tokens.value[self.end - 1]
        size = self.end - self.start
        long = np.repeat((size > 1) & (self.kind != NAME), size)
        if long.any():
            nth = (np.arange(len(kind)) - np.repeat(self.start, size)).astype(np.uint64)
            sums = np.add.reduceat(np.where(long, mix(tokens.value + nth * np.uint64(_BASE)), 0), self.start)
            run = (size > 1) & (self.kind != NAME)
            self.first[run] = self.last[run] = sums[run]
        self.token = np.where(self.kind == WORD, self.first, _MARK[self.kind])

    def windows(self, width: int):
        """(first run, hash) of windows within one text, at least half of it words."""
        words = np.concatenate(([0], np.cumsum(self.kind == WORD)))
        own = _hashes(self.token, width)
        if not len(own):
            return np.zeros(0, np.int64), own
        at = np.flatnonzero((self.of[width - 1:] == self.of[:len(own)]) & (2 * (words[width:] - words[:-width]) >= width))
        return at, own[at]


def _hashes(token: np.ndarray, width: int) -> np.ndarray:
    """Hash of each run of ``width`` tokens; tokens are random 64-bit values, order counts."""
    n = len(token) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.full(n, width, np.uint64)
    for k in range(width):
        total *= np.uint64(_BASE)
        total += token[k:k + n]
    return mix(total)


def _readings(tokens: Tokens, lexicon: tuple[np.ndarray, np.ndarray]):
    """The two templates of the tokens, which differ in capital tokens that the lexicon does not know.

    The benchmark's names are names everywhere, in any case. Other capital tokens are names wherever they
    stand, unless the benchmark knows them as words; in the second reading they are words where they start
    a sentence or line. Either reading may hit.
    """
    names, words = lexicon
    sure = _in(names, tokens.value)
    return [Template(tokens, sure | tokens.capital & ~_in(words, tokens.value)),
            Template(tokens, sure | tokens.capital & ~tokens.begin)]


def _lexicon(benchmark: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Bitmaps of the benchmark's names (capital inside a sentence, never in lower case) and words (the opposite)."""

    def cut(batches):
        for batch in batches:
            for _, tokens in _pieces(batch.column("text")):
                yield pa.RecordBatch.from_arrays([
                    pa.array(tokens.value.astype(np.int64)), pa.array(tokens.capital & ~tokens.begin),
                    pa.array(tokens.lower)], names=["hash", "name", "word"])
        batch = tokens = None
        release()

    seen = benchmark.select("text").mapInArrow(cut, "hash long, name boolean, word boolean") \
        .groupBy("hash").agg(F.max("name").alias("name"), F.max("word").alias("word"))
    return (_bitmap(seen.where("name AND NOT word"), LEXICON_BITS), _bitmap(seen.where("word AND NOT name"), LEXICON_BITS))


_ITEM = ("iid long, item_id long, hash long, at int, width int, exact boolean, kinds array<tinyint>, firsts array<bigint>, "
         "lasts array<bigint>, pos array<int>, n int, t int, tokens int")


def benchmark_windows(benchmark: DataFrame, lexicon, width: int = WIDTH) -> DataFrame:
    """Windows of every item.

    iid (row number), item_id, hash, at (first raw token), width, exact, kinds, firsts, lasts, pos (last raw token
    of each run), n (all windows), t (those with a template), tokens. An item shorter than ``width`` is one window.
    Null and empty items have none.
    """
    known = benchmark.sparkSession.sparkContext.broadcast(lexicon)

    def cut(batches):
        for batch in batches:
            rows = {f.name: [] for f in _item_schema()}
            for iid, item, text in zip(*(batch.column(c).to_pylist() for c in ("iid", "item_id", "text"))):
                data = np.frombuffer((text or "").encode(), np.uint8)
                tokens = Tokens(data, np.array([0, len(data)]))
                size = len(tokens.value)
                found = {}
                for t in _readings(tokens, known.value) if size else []:
                    w = min(width, len(t.token))
                    for a, h in zip(*t.windows(w)):
                        s = slice(a, a + w)
                        if 2 * (t.kind[s] == WORD).sum() < t.end[a + w - 1] - t.start[a]:
                            continue  # too few words when runs are not merged
                        found[int(t.start[a]), int(h.astype(np.int64)), False] = (
                            w, t.kind[s].tolist(), *(x[s].astype(np.int64).tolist() for x in (t.first, t.last, t.end - 1)))
                good = len({a for a, _, _ in found})
                w = min(width, size)
                for a, h in enumerate(_hashes(tokens.value, w).astype(np.int64).tolist() if size else []):
                    found[a, h, True] = (w, [], [], [], [])
                for (a, h, exact), (w, *lists) in found.items():
                    for key, x in zip(rows, (iid, item, h, a, w, exact, *lists, max(size - width, 0) + 1, good, size)):
                        rows[key].append(x)
            yield pa.RecordBatch.from_pydict(rows, _item_schema())

    numbered = benchmark.select(F.monotonically_increasing_id().alias("iid"), F.col("item_id").cast("long").alias("item_id"), "text")
    return numbered.mapInArrow(cut, _ITEM)


def _item_schema():
    return pa.schema([("iid", pa.int64()), ("item_id", pa.int64()), ("hash", pa.int64()), ("at", pa.int32()), ("width", pa.int32()),
                      ("exact", pa.bool_()), ("kinds", pa.list_(pa.int8())), ("firsts", pa.list_(pa.int64())),
                      ("lasts", pa.list_(pa.int64())), ("pos", pa.list_(pa.int32())), ("n", pa.int32()), ("t", pa.int32()),
                      ("tokens", pa.int32())])


def _bitmap(hashes: DataFrame, bits: int) -> np.ndarray:
    """A bitmap of the column ``hash``: of fixed size, whatever the benchmark."""
    word = F.shiftrightunsigned(F.col("slot"), 6)
    slots = hashes.select(F.pmod("hash", F.lit(bits)).alias("slot")).distinct()
    words = slots.groupBy(word.alias("w")).agg(
        F.expr("bit_or(shiftleft(1L, cast(slot & 63 AS INT)))").alias("v")).collect()
    map_ = np.zeros(bits // 64, np.int64)
    for r in words:
        map_[r.w] = r.v
    return map_


def _in(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    slot = np.mod(hashes.astype(np.int64), len(bitmap) * 64)
    return ((bitmap[slot >> 6] >> (slot & 63)) & 1).astype(bool)


_HIT = "rid long, doc_id long, hash long, start int, firsts array<bigint>, lasts array<bigint>"


def document_windows(documents: DataFrame, lexicon, bitmap: np.ndarray, widths: list[tuple[int, bool]]) -> DataFrame:
    """Windows of all documents whose hash is in the bitmap: rid (row number), doc_id, hash, start, firsts, lasts."""
    shared = documents.sparkSession.sparkContext.broadcast((bitmap, *lexicon))

    def found(tokens, seen, lexicon):
        """(hash, first raw token, fillers) of windows in the bitmap, each hash and place once."""
        known = set()
        for n in [n for n, exact in widths if exact]:
            own = _hashes(tokens.value, n)
            hit = np.flatnonzero((tokens.of[n - 1:] == tokens.of[:len(own)]) & _in(seen, own)) if len(own) else []
            for k in range(0, len(hit), 50_000):
                h = hit[k:k + 50_000]
                yield own[h], h, *[np.zeros((len(h), 0), np.uint64)] * 2
        for t in _readings(tokens, lexicon):
            for n in [n for n, exact in widths if not exact]:
                at, own = t.windows(n)
                hit = np.flatnonzero(_in(seen, own))
                fresh = np.array([x not in known for x in zip(t.start[at[hit]].tolist(), own[hit].tolist())], bool)
                hit = hit[fresh] if len(hit) else hit
                known.update(zip(t.start[at[hit]].tolist(), own[hit].tolist()))
                for k in range(0, len(hit), 50_000):
                    h = hit[k:k + 50_000]
                    place = at[h][:, None] + np.arange(n)
                    yield own[h], t.start[at[h]], t.first[place], t.last[place]

    def cut(batches):
        seen, *lexicon = shared.value
        for batch in batches:
            for i, tokens in _pieces(batch.column("text")):
                for own, start, first, last in found(tokens, seen, lexicon):
                    row = pa.array(tokens.of[start] + i)
                    head = np.searchsorted(tokens.of, tokens.of[start], side="left")
                    lists = np.arange(0, first.size + 1, first.shape[1], dtype=np.int32) if first.size else np.zeros(len(own) + 1, np.int32)
                    yield pa.RecordBatch.from_arrays([
                        batch.column("rid").take(row), batch.column("doc_id").take(row), pa.array(own.astype(np.int64)),
                        pa.array((start - head).astype(np.int32)),
                        *(pa.ListArray.from_arrays(lists, x.astype(np.int64).ravel()) for x in (first, last))],
                        names=["rid", "doc_id", "hash", "start", "firsts", "lasts"])
        batch = tokens = None
        release()

    rows = documents.select(F.monotonically_increasing_id().alias("rid"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(cut, _HIT)


def leaks(documents: DataFrame, benchmark: DataFrame, width: int = WIDTH, cover: float = LEAST_COVER,
          bits: int = BITMAP_BITS) -> DataFrame:
    """Benchmark items found in documents: doc_id, item_id, windows, item_windows, coverage, changed.

    ``windows`` counts the item's windows found, ``coverage`` is their share (at least ``cover``) and
    ``changed`` the number of fillers that differ from the item's. One row per document id and item;
    rows with equal ids, nulls included, are judged apart, and the best of them is returned.
    """
    lexicon = _lexicon(benchmark)
    items = benchmark_windows(benchmark, lexicon, width)
    bitmap = _bitmap(items, bits)
    widths = sorted((r.width, r.exact) for r in items.select("width", "exact").distinct().collect())
    found = document_windows(documents, lexicon, bitmap, widths).alias("d").join(
        items.alias("b"), F.col("d.hash") == F.col("b.hash"))
    hits = materialize(found.select(
        "rid", "doc_id", "iid", "item_id", (F.col("start") - F.col("at")).alias("origin"), "at", "exact", "n", "t", "tokens",
        F.expr("""filter(transform(kinds, (k, i) -> if(k > 0, named_struct('kind', k, 'pos', pos[i], 'item', b.lasts[i],
                    'doc', d.lasts[i], 'item_first', b.firsts[i], 'doc_first', d.firsts[i]), null)),
                  x -> x IS NOT NULL)""").alias("slots")))
    # Copies at several places are judged apart: by where the item would begin. Inserted or dropped
    # tokens move that, so beginnings that lie close together are judged together as well.
    own = ["rid", "iid"]
    near = F.greatest(F.lit(width), F.expr("tokens DIV 2"))
    order = Window.partitionBy(*own).orderBy("origin")
    hits = hits.withColumn("_new", F.coalesce(F.col("origin") - F.lag("origin").over(order) > near, F.lit(False)).cast("long")) \
        .withColumn("_chain", F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    # Level 2 is the whole document, where only equal windows count.
    levels = F.array(*[F.struct(F.lit(i).alias("level"), g.cast("long").alias("g")) for i, g in enumerate(
        (F.col("origin"), F.col("_chain"), F.lit(2)))])
    hits = hits.withColumn("_l", F.explode(levels)).select("*", "_l.level", "_l.g")
    key = [*own, "level", "g"]
    each = hits.groupBy(*key, "doc_id", "item_id", "n", "t", "at").agg(F.max((~F.col("exact")).cast("long")).alias("by_t"),
                                                                    F.max(F.col("exact").cast("long")).alias("by_x"))
    sums = each.groupBy(*key, "doc_id", "item_id", "n", "t").agg(
        F.expr("if(level = 2, sum(by_x), count(*))").alias("all"), F.expr("if(level = 2, 0L, sum(by_t))").alias("by_t"))
    # Low-word windows are only found where they are equal, so windows with a template are also judged alone.
    share = F.expr("""if(t > 0 AND by_t * n > all * t, struct(by_t AS windows, CAST(t AS LONG) AS item_windows),
                          struct(all AS windows, CAST(n AS LONG) AS item_windows))""")
    sums = sums.withColumn("_s", share).select(*key, "doc_id", "item_id", "_s.*") \
        .where(F.col("windows") >= F.lit(cover) * F.col("item_windows"))
    slots = hits.select(*key, F.explode("slots").alias("s")).join(sums.select(*key), key, "left_semi").select(*key, "s.*").distinct()
    bad = _clashes(slots, key)
    changed = slots.where("item <> doc").groupBy(*key).agg(F.countDistinct("kind", "item", "doc").alias("changed"))
    sums = sums.join(bad, key, "left_anti").join(changed, key, "left").withColumn("changed", F.coalesce("changed", F.lit(0)))
    best = sums.groupBy("doc_id", "item_id").agg(F.max(F.struct(
        (F.col("windows") / F.col("item_windows")).alias("coverage"), (-F.col("changed")).alias("fewer"),
        "windows", "item_windows", "changed")).alias("m"))
    return best.select("doc_id", "item_id", "m.windows", "m.item_windows", "m.coverage", "m.changed")


def _clashes(slots: DataFrame, key: list[str]) -> DataFrame:
    """Groups where names that the item repeats mostly do not stay the same name.

    A name at k places of the item of which m have one common word in the document agrees m - 1 times
    of k - 1; the sums over all names are compared. Numbers and units are free, as re-drawn ones may
    coincide or part, and two names may become one.
    """
    pairs = slots.where(F.col("kind") == NAME).select(
        *key, "pos", F.explode(F.array_distinct(F.array("item", "item_first"))).alias("v"), "doc", "doc_first")
    pairs = pairs.select(*key, "pos", "v", F.explode(F.array_distinct(F.array("doc", "doc_first"))).alias("u")).distinct()
    most = pairs.groupBy(*key, "v", "u").agg(F.count(F.lit(1)).alias("m")).groupBy(*key, "v").agg(F.max("m").alias("m"))
    places = pairs.select(*key, "v", "pos").distinct().groupBy(*key, "v").agg(F.count(F.lit(1)).alias("k"))
    return most.join(places, [*key, "v"]).groupBy(*key).agg(
        F.sum(F.col("m") - 1).alias("agree"), F.sum(F.col("k") - 1).alias("of")) \
        .where(F.col("agree") < LEAST_AGREE * F.col("of")).select(*key)


def without_leaks(documents: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``documents`` without those that hold an item. Rows with null ids go if any of them does."""
    found = leaks(documents, benchmark, **options).select(F.col("doc_id").alias("_leak")).distinct()
    return documents.join(found, F.col("doc_id").eqNullSafe(F.col("_leak")), "left_anti")
