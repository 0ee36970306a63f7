"""Phrases whose words occur together more often than apart, by frequent n-grams of Misra-Gries summaries.

Every n-gram of a language, single words included, has a 64-bit hash; its leading bits name a hash partition. Tasks count
what they read and send each partition a summary of (hash, count). Summaries of a partition are merged into one of
bounded capacity: where there are more counters, the largest one that does not fit is taken from all, and those that
fall to zero go. A counter loses at most mass / (capacity + 1) that way over all merges, so with a capacity of mass / threshold,
rounded down, no n-gram that occurs ``threshold`` times can be lost. Those whose counter and this loss may add up to the
threshold fill a bitmap of fixed size, by which the second pass picks n-grams to be counted by their full text; that count is exact and
decides. A hash that several n-grams share, or a bit, only brings more of them to the second pass.

Parts of a frequent phrase are frequent themselves, so the counted n-grams hold all that a score needs.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from lernspur.runtime import join_lookup, materialize

from .text import _LOWER, SLICE, column_bytes, edges, mix, spans

MAX_WORDS = 3
THRESHOLD = 10
INSIDE = (50, 100)  # a phrase goes where a longer one has this share of its occurrences
TOP = 2000
SCALE = 1_000_000
NO_LANGUAGE = "und"
BLOCK_BYTES = 16 << 20  # text for each hash partition, about; its summary then has under a million counters
MOST_BITS = 24  # 2**24 hash partitions at most, which 256 TB of text fill
LOW_BITS = 24  # of a hash within its partition; the few n-grams that share them are counted as one at first
MAP_BITS = 27
CHUNK_WORDS = 1 << 18  # words that a task has in hand, about; a text may be cut between words
HELD = 2_000_000  # counters that a task holds, about, before it sends them
ID_BITS = 21  # of a word's number within a task; three make a phrase of the longest kind
SPREAD = 32  # parts of a language that are ranked by themselves first

_SPACES, _BREAKS = b" \t", b".,;:!?\n\x0b\x0c\r"
_KIND = np.zeros(256, np.uint8)
_KIND[list(_SPACES)] = 1
_KIND[list(_BREAKS)] = 2


# ---------------------------------------------------------------- words in pieces

class _Words:
    """Words of some texts: their bytes one after another, lengths, piece numbers and language numbers."""

    def __init__(self):
        self.letters, self.lengths, self.pieces, self.langs, self.count = [], [], [], [], 0
        self.context = 0  # leading words that were counted before

    def add(self, letters, lengths, pieces, langs):
        self.letters.append(letters)
        self.lengths.append(lengths)
        self.pieces.append(pieces)
        self.langs.append(langs)
        self.count += len(lengths)

    def joined(self):
        return [np.concatenate(x) for x in (self.letters, self.lengths, self.pieces, self.langs)]


def _cut(data: np.ndarray, at: int) -> int:
    """End of a slice of a long text that starts at ``at``: after a byte that is in no word, or the text's end."""
    end = at + SLICE
    if end >= len(data):
        return len(data)
    loose = np.flatnonzero(_KIND[data[at:end]])
    if len(loose):
        return at + int(loose[-1]) + 1
    while end < len(data):
        loose = np.flatnonzero(_KIND[data[end:end + SLICE]])
        if len(loose):
            return end + int(loose[0]) + 1
        end += SLICE
    return len(data)


def _slices(batches, names: dict[str, int]):
    """(letters, lengths, pieces, langs) of slices of about a megabyte; pieces are numbered through."""
    piece = 0
    for batch in batches:
        data, offsets, _ = column_bytes(batch.column("text"))
        own = np.array([names.setdefault(NO_LANGUAGE if x is None else x, len(names))
                        for x in batch.column("lang").to_pylist()], np.int64)
        for i, j in spans(offsets):
            whole = data[offsets[i]:offsets[j]]
            at = 0
            while at < len(whole):
                end = len(whole) if j > i + 1 else _cut(whole, at)
                part = _LOWER[whole[at:end]]
                kind = _KIND[part]
                solid = kind == 0
                starts, ends = edges(solid)
                borders = offsets[i + 1:j] - offsets[i]
                borders = borders[(borders > 0) & (borders < len(part))]
                inner = np.unique(borders[solid[borders] & solid[borders - 1]]) if len(borders) else borders
                if len(inner):
                    starts, ends = np.sort(np.concatenate((starts, inner))), np.sort(np.concatenate((ends, inner)))
                marks = (kind == 2).astype(np.int64)
                np.add.at(marks, borders, 1)
                marks = np.cumsum(marks)
                text = np.searchsorted(offsets[i:j + 1] - offsets[i], starts, side="right") - 1 if j > i + 1 \
                    else np.zeros(len(starts), np.int64)
                if len(starts):
                    yield part[solid], ends - starts, piece + marks[starts], own[i + text]
                piece += int(marks[-1]) if len(marks) else 0
                at = end
            piece += 1


def _chunks(batches, names: dict[str, int], most_words: int):
    """Groups of about CHUNK_WORDS words. The last words of each come again as context of the next, for phrases over the cut."""
    now = _Words()
    for part in _slices(batches, names):
        now.add(*part)
        if now.count >= CHUNK_WORDS:
            yield now
            letters, lengths, pieces, langs = now.joined()
            keep = min(most_words - 1, len(lengths))
            now = _Words()
            if keep:
                now.add(letters[len(letters) - int(lengths[-keep:].sum()):], lengths[-keep:], pieces[-keep:], langs[-keep:])
            now.context = keep
    if now.count > now.context:
        yield now


class _Coded:
    """Words of a chunk as numbers of the distinct (language, word) pairs in it, with a hash for each pair."""

    def __init__(self, now: _Words, names: dict[str, int]):
        letters, lengths, self.pieces, langs = now.joined()
        self.context = now.context
        ends = np.concatenate(([0], np.cumsum(lengths)))
        words = pa.LargeStringArray.from_buffers(len(lengths), pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(letters))
        coded = words.dictionary_encode()
        size = len(coded.dictionary)
        pairs, self.ids = np.unique(langs * size + coded.indices.to_numpy(), return_inverse=True)
        self.langs = pairs // size
        self.words = coded.dictionary.take(pa.array(pairs % size)).to_pylist()
        by_lang = np.array([xxhash.xxh64_intdigest(x) for x in names], np.uint64)
        hashed = np.array([xxhash.xxh64_intdigest(w) for w in self.words], np.uint64)
        self.hashes = mix(by_lang[self.langs] + hashed * _STEP)

    def grams(self, most_words: int):
        """(words, starts, hashes) of the n-grams of 1 to ``most_words`` words that were not counted before."""
        starts, own = np.arange(len(self.ids), dtype=np.int32), self.hashes[self.ids]
        value = own
        for m in range(1, most_words + 1):
            if m > 1:
                whole = np.flatnonzero(starts < len(self.ids) - m + 1)
                whole = whole[self.pieces[starts[whole]] == self.pieces[starts[whole] + m - 1]]
                starts = starts[whole]
                value = mix(value[whole] * _STEP + own[starts + m - 1])
            fresh = starts + m > self.context
            yield m, starts[fresh], value[fresh]


_STEP = np.uint64(0x9E3779B97F4A7C15)


# ---------------------------------------------------------------- first pass: summaries

def merged(keys: np.ndarray, counts: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, int]:
    """A Misra-Gries summary of at most ``capacity`` counters from counters of which some may have equal keys.

    Third comes what was taken from every counter: no key occurs more often than its counter and all that was
    taken in the merges, and one without a counter no more often than the latter.
    """
    keys, at = np.unique(keys, return_inverse=True)
    counts = np.bincount(at, weights=counts, minlength=len(keys)).astype(np.int64)
    if len(keys) <= capacity:
        return keys, counts, 0
    cut = int(np.partition(counts, len(counts) - capacity - 1)[len(counts) - capacity - 1])
    counts = counts - cut
    return keys[counts > 0], counts[counts > 0], cut


def _packed(low: np.ndarray) -> bytes:
    """Ascending numbers as their gaps, in two bytes each where these are enough, else in four."""
    gaps = np.diff(low, prepend=low.dtype.type(0))
    kind = "<u2" if gaps.max(initial=0) < 1 << 16 else "<u4"
    return kind[-1].encode() + gaps.astype(kind).tobytes()


def _unpacked(raw: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(raw, f"<u{raw[:1].decode()}", offset=1), dtype=np.uint32)


_SUMMARY = "block long, once binary, more binary, n binary"


def _summary_rows(hashes: np.ndarray, counts: np.ndarray, bits: int) -> pa.RecordBatch:
    """Sorted counters as a row for each hash partition; counters of one stand without their count."""
    block = (hashes >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(hashes), np.int64)
    low = (hashes >> np.uint64(64 - LOW_BITS - bits) & np.uint64((1 << LOW_BITS) - 1)).astype(np.uint32)
    starts = np.concatenate(([0], np.flatnonzero(np.diff(block)) + 1))
    out = {"block": block[starts], "once": [], "more": [], "n": []}
    for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(block)]):
        several = counts[a:b] > 1
        out["once"].append(_packed(low[a:b][~several]))
        out["more"].append(_packed(low[a:b][several]))
        out["n"].append(counts[a:b][several].astype("<u4").tobytes())
    return pa.RecordBatch.from_pydict(out, pa.schema(
        [("block", pa.int64()), ("once", pa.binary()), ("more", pa.binary()), ("n", pa.binary())]))


def _summaries(rows: DataFrame, bits: int, most_words: int) -> DataFrame:
    def count(batches):
        names: dict[str, int] = {}
        held, size = [], 0

        def joined():
            keys, at = np.unique(np.concatenate([h for h, _ in held]), return_inverse=True)
            return keys, np.bincount(at, weights=np.concatenate([n for _, n in held])).astype(np.int64)

        for now in _chunks(batches, names, most_words):
            values = np.concatenate([value for _, _, value in _Coded(now, names).grams(most_words)])
            held.append(np.unique(values, return_counts=True))
            size += len(held[-1][0])
            if size > HELD:
                yield _summary_rows(*joined(), bits)
                held, size = [], 0
        if size:
            yield _summary_rows(*joined(), bits)

    return rows.mapInArrow(count, _SUMMARY)


def _survivors(summaries: DataFrame, bits: int, size: int, threshold: int) -> np.ndarray:
    """Bitmap of ``size`` leading hash bits with all n-grams that occur ``threshold`` times."""
    stretch = 1 << (size - bits)

    def merge(table):
        once = [_unpacked(x) for x in table.column("once").to_pylist()]
        more = [_unpacked(x) for x in table.column("more").to_pylist()]
        n = [np.frombuffer(x, "<u4") for x in table.column("n").to_pylist()]
        capacity = (sum(map(len, once)) + sum(int(x.sum(dtype=np.int64)) for x in n)) // threshold
        keys, counts, held, taken = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)], 0, 0
        for own, several, times in zip(once, more, n):
            keys += [own, several]
            counts += [np.ones(len(own), np.int64), times]
            held += len(own) + len(several)
            if held > 2 * capacity + 1_000_000:
                own, n_own, cut = merged(np.concatenate(keys), np.concatenate(counts), capacity)
                keys, counts, held, taken = [own], [n_own], len(own), taken + cut
        found, n_found, cut = merged(np.concatenate(keys), np.concatenate(counts), capacity)
        found = found[n_found + taken + cut >= threshold]
        bitmap = np.zeros(stretch, bool)
        bitmap[found >> np.uint32(LOW_BITS - (size - bits))] = True
        return pa.Table.from_pydict(
            {"block": table.column("block").slice(0, 1), "map": [np.packbits(bitmap).tobytes()]})

    out = np.zeros(1 << (size - 3), np.uint8)
    for r in summaries.groupBy("block").applyInArrow(merge, "block long, map binary").collect():  # as many bytes as the bitmap
        part = np.frombuffer(r.map, np.uint8)
        out[r.block * len(part):(r.block + 1) * len(part)] = part
    return out


# ---------------------------------------------------------------- second pass: exact counts

class _Counter:
    """Exact counts of a task's n-grams, whose words have numbers of ``bits`` bits."""

    def __init__(self, most_words: int, bits: int):
        self.bits = bits
        self.numbers, self.words, self.langs = {}, [], []
        self.held = {m: [] for m in range(1, most_words + 1)}

    def numbered(self, coded: _Coded) -> np.ndarray:
        """The task's number for each pair of a chunk."""
        out = np.empty(len(coded.words), np.int64)
        for i, pair in enumerate(zip(coded.langs.tolist(), coded.words)):
            found = self.numbers.get(pair)
            if found is None:
                found = self.numbers[pair] = len(self.words)
                self.langs.append(pair[0])
                self.words.append(pair[1])
            out[i] = found
        return out

    def add(self, m: int, keys: np.ndarray):
        self.held[m].append(np.unique(keys, return_counts=True))

    def size(self) -> int:
        return sum(len(k) for own in self.held.values() for k, _ in own)

    def combine(self):
        for m, own in self.held.items():
            if len(own) > 1:
                keys, at = np.unique(np.concatenate([k for k, _ in own]), return_inverse=True)
                n = np.bincount(at, weights=np.concatenate([n for _, n in own])).astype(np.int64)
                self.held[m] = [(keys, n)]

    def rows(self, names: list[str]):
        """All counts as (gram, f), and empties the counter."""
        self.combine()
        words, langs = pa.array(self.words, pa.string()), np.array(self.langs, np.int64)
        for m, own in self.held.items():
            for keys, n in own:
                for a in range(0, len(keys), 100_000):
                    key = keys[a:a + 100_000]
                    parts = [key >> ((m - 1 - k) * self.bits) & ((1 << self.bits) - 1) for k in range(m)]
                    columns = [words.take(pa.array(p)) for p in parts]
                    phrase = columns[0] if m == 1 else pc.binary_join_element_wise(*columns, " ")
                    lang = pa.array(names).take(pa.array(langs[parts[0]]))
                    yield pa.RecordBatch.from_arrays(
                        [pc.binary_join_element_wise(phrase, lang, "\t"), pa.array(n[a:a + 100_000])], names=["gram", "f"])
        self.__init__(len(self.held), self.bits)


def _exact(rows: DataFrame, bitmap, size: int, most_words: int) -> DataFrame:
    """(gram, f) of a task's n-grams in the bitmap of ``size`` hash bits; the empty one has the number of all words.

    ``gram`` is the phrase, which has no tab, a tab, and the language.
    """
    def count(batches):
        names: dict[str, int] = {}
        counter = _Counter(most_words, ID_BITS)
        for now in _chunks(batches, names, most_words):
            total = np.bincount(now.joined()[3][now.context:], minlength=len(names))
            yield pa.RecordBatch.from_pydict({"gram": [f"\t{x}" for x in names], "f": total})
            coded = _Coded(now, names)
            if len(counter.words) + len(coded.words) > 1 << ID_BITS:
                yield from counter.rows(list(names))
            number = counter.numbered(coded)[coded.ids]
            for m, starts, value in coded.grams(most_words):
                slot = value >> np.uint64(64 - size)
                hit = starts[(bitmap.value[(slot >> np.uint64(3)).astype(np.int64)]
                              >> (7 - (slot & np.uint64(7))).astype(np.uint8)) & 1 == 1]
                key = number[hit]
                for k in range(1, m):
                    key = key << ID_BITS | number[hit + k]
                counter.add(m, key)
            if counter.size() > HELD:
                counter.combine()
                if counter.size() > HELD:
                    yield from counter.rows(list(names))
        yield from counter.rows(list(names))

    return rows.mapInArrow(count, "gram string, f long")


def frequent_ngrams(documents: DataFrame, most_words: int = MAX_WORDS, threshold: int = THRESHOLD) -> DataFrame:
    """(lang, words, phrase, f): all n-grams that occur ``threshold`` times, counted exactly; stored.

    The rows with words = 0 hold the number of all word occurrences of a language.
    """
    rows = documents.select(F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    if not 2 <= most_words <= MAX_WORDS:
        raise ValueError(f"phrases have 2 to {MAX_WORDS} words, not {most_words}")
    bytes_ = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = min(MOST_BITS, int(bytes_ // BLOCK_BYTES).bit_length())
    size = min(MAP_BITS, bits + LOW_BITS)
    found = rows.sparkSession.sparkContext.broadcast(
        _survivors(_summaries(rows, bits, most_words), bits, size, threshold))
    # Counted by task already, so rows are dealt out as they are and summed up there.
    counted = _exact(rows, found, size, most_words).repartition("gram").groupBy("gram").agg(F.sum("f").alias("f"))
    phrase = F.substring_index("gram", "\t", 1)
    counted = counted.select(
        F.expr("substring(gram, length(substring_index(gram, '\t', 1)) + 2)").alias("lang"),
        F.when(phrase == "", 0).otherwise(F.size(F.split(phrase, " "))).cast("int").alias("words"), phrase.alias("phrase"), "f")
    out = materialize(counted.where((F.col("words") == 0) | (F.col("f") >= threshold)))
    found.destroy()
    return out


# ---------------------------------------------------------------- scores

def _part(first: int, count: int) -> Column:
    return F.array_join(F.slice(F.split("phrase", " "), first, count), " ")


def _scored(counted: DataFrame, words: int, parts: dict[int, DataFrame]) -> DataFrame:
    """(lang, phrase, a, l, r, score) of the phrases of so many words, by their lowest-scoring cut.

    ``parts`` has the stored n-grams (lang, _p, f) of each number of words below.
    """
    now = counted.where(F.col("words") == words).select(
        "lang", "phrase", F.col("f").alias("a"))
    for count in range(1, words):
        for side, first in (("l", 1), ("r", words - count + 1)):
            k = count if side == "l" else words - count
            now = join_lookup(now.withColumn("_p", _part(first, count)), parts[count], ["lang", "_p"]).withColumnRenamed(
                "f", f"_{side}{k}").drop("_p")
    a = F.col("a").cast("decimal(38,0)")
    cuts = [F.struct(F.expr(f"cast({SCALE} * cast(a as decimal(16,0)) * cast(a as decimal(14,0)) div"
                            f" (cast(_l{k} as decimal(18,0)) * cast(_r{k} as decimal(18,0))) as bigint)").alias("score"),
                     F.lit(k).alias("k"), F.col(f"_l{k}").alias("l"), F.col(f"_r{k}").alias("r")) for k in range(1, words)]
    best = cuts[0] if len(cuts) == 1 else F.least(*cuts)
    return now.select("lang", "phrase", "a", best.alias("b")).select("lang", "phrase", "a", "b.l", "b.r", "b.score")


def _held(counted: DataFrame, words: int, most_words: int) -> DataFrame | None:
    """(lang, phrase, longest): for phrases of so many words, the most occurrences of a longer one around it."""
    longer = counted.where(F.col("words") > words)
    if words >= most_words:
        return None
    inner = longer.withColumn("_w", F.split("phrase", " ")).select("lang", "f", F.explode(F.transform(
        F.sequence(F.lit(1), F.size("_w") - words + 1), lambda i: F.array_join(F.slice("_w", i, words), " "))).alias("phrase"))
    return inner.groupBy("lang", "phrase").agg(F.max("f").alias("_most"))


def collocations(documents: DataFrame, most_words: int = MAX_WORDS, threshold: int = THRESHOLD, top: int = TOP,
                 inside: tuple[int, int] = INSIDE) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``top`` phrases of 2 to ``most_words`` words of each language.

    Texts are cut at punctuation and line breaks into pieces, these at spaces and tabs into words, with A-Z lower-cased. Null
    and empty texts have no words, a null language is ``und``. Repeated rows count as often as they come; other columns are
    ignored. A phrase inside a longer one that has at least ``inside`` of its occurrences is left out. Ties in score
    go by a, then by the phrase's bytes. Empty tables give an empty result.
    """
    p, q = inside
    counted = frequent_ngrams(documents, most_words, threshold)
    parts = {m: materialize(counted.where(F.col("words") == m).select("lang", F.col("phrase").alias("_p"), "f"))
             for m in range(1, most_words)}
    out = None
    for words in range(2, most_words + 1):
        own = _scored(counted, words, parts)
        held = _held(counted, words, most_words)
        if held is not None:
            own = own.join(held, ["lang", "phrase"], "left").where(
                F.col("_most").isNull() | (q * F.col("_most") < p * F.col("a"))).drop("_most")
        out = own if out is None else out.union(own)
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    # The best of each part of a language first, so that no task ranks all of a language.
    part = F.pmod(F.xxhash64("phrase"), F.lit(SPREAD)).alias("_part")
    near = out.select("*", part).withColumn("_at", F.row_number().over(Window.partitionBy("lang", "_part").orderBy(*order)))
    ranked = near.where(F.col("_at") <= top).withColumn(
        "rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    total = counted.where("words = 0").select("lang", F.col("f").alias("n"))
    # One row for each language on the right.
    return ranked.join(total, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


SQL = r"""
        WITH piece AS (
          SELECT row_number() OVER () AS id, lang, piece
          FROM (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''),
                       'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
                FROM documents)),
        word AS (
          SELECT id, lang, unnest(w) AS w, unnest(range(len(w))) AS i
          FROM (SELECT id, lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM piece)),
        n AS (SELECT lang, count(*) AS n FROM word GROUP BY lang),
        run AS (
          SELECT lang, w AS w1, lead(w, 1) OVER o AS w2, lead(w, 2) OVER o AS w3
          FROM word WINDOW o AS (PARTITION BY id ORDER BY i)),
        f AS MATERIALIZED (
          SELECT lang, len(p) AS m, p, count(*) AS f
          FROM (SELECT lang, [w1] AS p FROM run
                UNION ALL SELECT lang, [w1, w2] FROM run WHERE w2 IS NOT NULL
                UNION ALL SELECT lang, [w1, w2, w3] FROM run WHERE w3 IS NOT NULL)
          GROUP BY ALL HAVING count(*) >= 10),
        part AS (
          SELECT lang, p, f AS a, k, p[:k] AS head, p[k + 1:] AS tail
          FROM (SELECT *, unnest(range(1, m)) AS k FROM f)),
        cut AS (
          SELECT c.lang, c.p, c.a, c.k, x.f AS l, y.f AS r,
                 CAST(1000000 * CAST(c.a AS HUGEINT) * c.a // (CAST(x.f AS HUGEINT) * y.f) AS BIGINT) AS score
          FROM part AS c
          JOIN f AS x ON x.lang = c.lang AND x.p = c.head
          JOIN f AS y ON y.lang = c.lang AND y.p = c.tail),
        best AS (SELECT lang, p, a, unnest(min(struct_pack(score := score, k := k, l := l, r := r))) FROM cut GROUP BY lang, p, a),
        held AS (
          SELECT lang, p, max(f) AS most
          FROM (SELECT lang, f, unnest([p[1:2], p[2:3]]) AS p FROM f WHERE m = 3) GROUP BY lang, p),
        kept AS (
          SELECT b.*, array_to_string(b.p, ' ') AS phrase
          FROM best AS b LEFT JOIN held AS h ON h.lang = b.lang AND h.p = b.p
          WHERE most IS NULL OR 100 * most < 50 * a)
        SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank,
               phrase, a, l, r, n, score
        FROM kept JOIN n USING (lang) QUALIFY rank <= 2000"""
