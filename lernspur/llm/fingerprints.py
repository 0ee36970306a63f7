"""Homomorphic multiset fingerprints of documents.

A document is the multiset of its paragraphs, the texts between line feeds. Each paragraph is
hashed to a wide vector, and a fingerprint is the sum of those vectors, lane by lane, modulo a
power of two. Order has no effect, and a paragraph is added or removed by adding or subtracting
its vector. The lanes are

* 8 dense lanes of 32 bits that every paragraph enters: these decide equality;
* 144 sparse lanes of 12 bits on 24 scales: a paragraph enters a lane of scale s with
  probability 2**-(s+1). Lanes that differ tell how many paragraphs two documents do not share,
  up to about 10**8;
* the number of paragraphs.

Paragraphs become rows and vectors are summed by ordinary aggregates; there is no Python on the
executors.
"""

from __future__ import annotations

from bisect import bisect_left

from pyspark.sql import Column, DataFrame, Window, functions as F

from .ordering import LAST, default_parts, order_key, range_bounds, range_number

DENSE, SCALES, PER_SCALE = 8, 24, 6
DENSE_MOD, SPARSE_MOD = 1 << 32, 1 << 12
SPARSE = SCALES * PER_SCALE
_PER_HASH, _SHARED = 3, 48  # of the first sparse lanes, three are served by one 64-bit hash: 8 bits to choose, 12 to add
_GUARD = _SHARED // PER_SCALE  # bits that must be zero before a rarer lane is looked at: those of the scale before

OWN, EDITED, HEAD = range(3)  # pieces of a document: the rest of its text, of its edited text, and the lines before both


def lane_names() -> list[str]:
    return [f"d{i}" for i in range(DENSE)] + [f"s{i}" for i in range(SPARSE)] + ["paragraphs"]


def paragraph_vector(text: Column) -> list[Column]:
    """The vector of one paragraph, in the order of :func:`lane_names`.

    The rarer lanes have a hash of their own, which few paragraphs ask for: those whose guard is zero. The lanes of a
    scale have a guard each, so they are as independent of each other as without it.
    """
    ids = [F.xxhash64(F.lit("paragraph"), text), F.xxhash64(text, F.lit("text"))]
    dense = [F.shiftrightunsigned(F.xxhash64(F.lit(i // 2), *ids), 32 * (i % 2)).bitwiseAND(F.lit(DENSE_MOD - 1))
             for i in range(DENSE)]
    guards = F.xxhash64(F.lit(-1), *ids)
    sparse = []
    for i in range(SPARSE):
        scale, shared = i // PER_SCALE + 1, i < _SHARED
        seed, shift = (i // _PER_HASH, 20 * (i % _PER_HASH)) if shared else (i, 0)
        bits, wide = F.xxhash64(F.lit(DENSE + seed), *ids), _GUARD if shared else SCALES - _GUARD
        choose = (1 << (scale if shared else scale - _GUARD)) - 1
        chosen = F.shiftrightunsigned(bits, shift).bitwiseAND(F.lit(choose)) == 0
        value = F.shiftrightunsigned(bits, shift + wide).bitwiseAND(F.lit(SPARSE_MOD - 1))
        lane = F.when(chosen, value).otherwise(F.lit(0))
        if not shared:
            guard = F.shiftrightunsigned(guards, _GUARD * (i % PER_SCALE)).bitwiseAND(F.lit((1 << _GUARD) - 1))
            lane = F.when(guard == 0, lane).otherwise(F.lit(0))
        sparse.append(lane)
    return [*dense, *sparse, F.lit(1)]


def fingerprints(df: DataFrame, text: str, by: list[str]) -> DataFrame:
    """One row per distinct ``by`` with ``lanes`` (array of long), over the paragraphs of ``text``.

    Rows with equal ``by`` count as one document with the paragraphs of all of them. A null text
    is an empty one, which has one empty paragraph. Sums combine before the shuffle, so a key
    with many rows is no hot spot; where ``df`` is already hashed by some of ``by``, nothing moves.
    """
    names = lane_names()
    rows = df.select(*by, F.explode(F.split(F.coalesce(F.col(text), F.lit("")), "\n")).alias("_p"))
    ids = rows.select(*by, *[c.alias(n) for c, n in zip(paragraph_vector(F.col("_p")), names)])
    sums = ids.groupBy(*by).agg(*[F.sum(n).alias(n) for n in names])
    return sums.select(*by, F.array(*[_reduced(i, F.col(n)) for i, n in enumerate(names)]).alias("lanes"))


def _reduced(i: int, lane: Column) -> Column:
    if i < DENSE:
        return lane.bitwiseAND(F.lit(DENSE_MOD - 1))
    return lane.bitwiseAND(F.lit(SPARSE_MOD - 1)) if i < DENSE + SPARSE else lane


def combined(a: Column, b: Column, sign: int = 1) -> Column:
    """Lanes of ``a`` with the paragraphs of ``b`` added (sign 1) or removed (sign -1)."""
    total = F.zip_with(a, b, lambda x, y: x + sign * y)
    return F.transform(total, lambda x, i: (
        F.when(i < DENSE, F.pmod(x, F.lit(DENSE_MOD)))
        .when(i < DENSE + SPARSE, F.pmod(x, F.lit(SPARSE_MOD))).otherwise(x)))


def as_text(lanes: Column) -> Column:
    """The fingerprint as 504 hex digits: dense lanes, sparse lanes, number of paragraphs."""
    parts = F.transform(lanes, lambda x, i: F.lpad(
        F.lower(F.hex(x)), F.when((i < DENSE) | (i == DENSE + SPARSE), 8).otherwise(3), F.lit("0")))
    return F.array_join(parts, "")


def _expected(d: int) -> float:
    """Sparse lanes that differ, on average, between documents with ``d`` paragraphs not shared."""
    return PER_SCALE * sum(1 - (1 - 2.0 ** -(s + 1)) ** d for s in range(SCALES))


def _grid() -> list[tuple[float, float]]:
    """(differing lanes, paragraphs) pairs: single steps at first, then steps of an eighth."""
    out, d = [], 1
    while d < 1 << (SCALES + 3):
        out.append((_expected(d), float(d)))
        d += max(1, d // 8)
    return out


def _guesses() -> list[float]:
    """Paragraphs not shared, by the number of sparse lanes that differ: the nearest step of the grid."""
    grid = _grid()
    marks = [(x + y) / 2 for (x, _), (y, _) in zip(grid, grid[1:])]
    return [grid[bisect_left(marks, n)][1] for n in range(SPARSE + 1)]


def likeness(a: Column, b: Column) -> Column:
    """Estimated share of common paragraphs, 2 |A n B| / (|A| + |B|), from two lane arrays.

    1 for equal fingerprints and only for these; 0 for documents with nothing in common, give
    or take the estimate's spread.
    """
    pairs = F.zip_with(a, b, lambda x, y: (x != y).cast("int"))
    differ = F.aggregate(F.slice(pairs, DENSE + 1, SPARSE), F.lit(0), lambda s, x: s + x)
    # One entry for each number of lanes that may differ: no lambda, in which the count would be made for every mark.
    guess = F.element_at(F.array(*[F.lit(d) for d in _guesses()]), differ + 1)
    na, nb = F.element_at(a, -1), F.element_at(b, -1)
    apart = F.greatest(guess, F.abs(na - nb).cast("double"), F.lit(1.0))
    return F.when(a == b, F.lit(1.0)).otherwise(F.greatest(F.lit(0.0), 1 - apart / (na + nb)))


def with_next(documents: DataFrame, parts: int | None = None) -> DataFrame:
    """Deal documents into ranges of ascending doc_id; each range also gets a copy of the next one's first.

    Columns: _part, _at (sort key), doc_id, text, _guest (true for those copies). Within a range a
    window then finds every document's successor; the last document's is the first of all.
    Null texts are empty, null doc_ids come last, equal doc_ids are ordered by text.
    Texts move once; what the driver sees is bounded by the number of ranges.
    """
    docs = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    docs = docs.withColumn("_at", order_key())
    bounds = range_bounds(docs, F.col("_at"), parts or default_parts(docs))
    docs = docs.withColumn("_part", range_number(F.col("_at"), bounds))
    firsts = sorted(
        (r["_part"], r["first"]) for r in docs.groupBy("_part").agg(F.min("_at").alias("first")).collect())
    own = docs.select("_part", "_at", "doc_id", "text", F.lit(False).alias("_guest"))
    if not firsts:
        return own
    follows = [(p, firsts[(i + 1) % len(firsts)][1]) for i, (p, _) in enumerate(firsts)]
    heads = (
        docs.where(F.col("_at").isin([first for _, first in firsts]))
        .groupBy("_at").agg(F.min("text").alias("text"))
        .withColumn("doc_id", F.when(F.col("_at") != LAST, F.col("_at")))
    )
    follows = documents.sparkSession.range(1).select(F.inline(F.array(*[
        F.struct(F.lit(p).alias("_to"), F.lit(head).cast("long").alias("_head")) for p, head in follows])))
    guests = heads.join(F.broadcast(follows), F.col("_at") == F.col("_head"))
    return own.unionByName(guests.select(F.col("_to").alias("_part"), "_at", "doc_id", "text", F.lit(True).alias("_guest")))


def edited_fingerprints(documents: DataFrame, parts: int | None = None) -> DataFrame:
    """Fingerprint of each document, of its edited text, and how alike they and the next one are.

    The edited text has the last half of the code points, rounded down, replaced by as many of
    the first of the next document (ascending doc_id; after the last comes the first).
    One row per input row, repeated rows and null ids included; an empty table gives no rows.
    """
    order = Window.partitionBy("_part").orderBy("_guest", "_at", "text")
    w = with_next(documents, parts)
    half = F.expr("CAST(floor(n_chars / 2) AS INT)")
    rows = (
        w.withColumn("_row", F.row_number().over(order))
        .withColumn("_next", F.lead("text").over(order))
        .withColumn("n_chars", F.length("text").cast("long"))
        .withColumn("_edited", F.when(~F.col("_guest"), F.concat(
            F.expr("substring(text, 1, CAST(n_chars AS INT) - CAST(floor(n_chars / 2) AS INT))"),
            F.substring(F.coalesce("_next", F.lit("")), F.lit(1), half))))
        .withColumn("edited_sha256", F.sha2(F.col("_edited").cast("binary"), 256))
    )
    # The whole lines at the head of both texts are hashed once, and their vector is added to those of the two rests.
    kept = F.expr("substring(text, 1, CAST(n_chars AS INT) - CAST(floor(n_chars / 2) AS INT))")
    head = F.when(F.col("_guest"), F.lit(0)).otherwise(F.length(kept) - F.length(F.substring_index(kept, "\n", -1)))
    rows = rows.withColumn("_head", head)

    def body(which, text):
        return F.struct(F.lit(which).alias("which"), text.alias("body"))

    def rest(name):
        return F.substring(F.col(name), F.col("_head") + 1, F.length(name))

    bodies = F.array(body(OWN, rest("text")), F.when(~F.col("_guest"), body(EDITED, rest("_edited"))),
                     F.when(F.col("_head") > 0, body(HEAD, F.substring("text", F.lit(1), F.col("_head") - 1))))
    by = ["_part", "_row", "_guest", "doc_id", "n_chars", "edited_sha256", "_which"]
    parts_of = rows.select(*by[:-1], F.explode(F.array_compact(bodies)).alias("_v"))
    marks = fingerprints(parts_of.select(*by[:-1], F.col("_v.which").alias("_which"), F.col("_v.body").alias("_body")),
                         "_body", by)
    pairs = marks.groupBy(*by[:-1]).agg(*[
        F.max(F.when(F.col("_which") == which, F.col("lanes"))).alias(name)
        for which, name in ((OWN, "own"), (EDITED, "edited"), (HEAD, "_both"))])
    pairs = pairs.withColumns({
        name: F.when(F.col("_both").isNull(), F.col(name)).otherwise(combined(F.col(name), F.col("_both")))
        for name in ("own", "edited")})
    following = pairs.withColumn("next", F.lead("own").over(Window.partitionBy("_part").orderBy("_row")))
    return following.where(~F.col("_guest")).select(
        "doc_id", "n_chars", "edited_sha256",
        as_text(F.col("own")).alias("fingerprint"), as_text(F.col("edited")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("edited")).alias("near_edited"),
        likeness(F.col("own"), F.col("next")).alias("near_next"))
