"""Documents that share most of their word n-grams, by a blocked sparse matrix product.

The incidence matrix has a row for each distinct shingle set and a column for each shingle. Two
sets of sizes a and b with Jaccard similarity s or more share at least s (a + b) / (1 + s) columns, so

* with any fixed order of columns, they share one of the first n - ceil(s n) + 1 columns of each: only this
  prefix of each row enters the product;
* columns that no other row has cannot be shared: an overlap is at most the smaller of the two sizes without them;
* with A shared columns counted up to places i and j of the two prefixes, the whole overlap is at most
  A + min(a - i - 1, b - j - 1): pairs below the bound are discarded;
* for pairs that are left, the remaining columns are multiplied as well, which gives the exact overlap.

Frequent columns come last in the order, so a passage that many documents share stays out of their prefixes
unless a document consists of little else. Which columns are frequent, and which occur twice at all, is
counted over all documents in blocks of columns, and sent to the tasks as bitmaps of fixed size; a false bit
only costs time.

Products of long columns are not expanded. Each round multiplies every column with one leading row only;
verified links are contracted to components, and only columns that still hold several components go on.
After the first round, every column has leading rows of its own, the rows of the leading row's component meet the
first row of another one, and each row is checked with several: so a large component and the rows that face it are tried
from both sides. When a round finds few links and the pairs that are left between components are not too many, when
it finds none, or after ROUNDS rounds, all of these are checked. So no
link between different components is lost, and groups of copies cost one pair for each member.

A set is known by a 64-bit number drawn from its shingles' hashes; overlaps are counted on 48 bits of each.
"""

from __future__ import annotations

import hashlib
import zlib
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from lernspur.runtime import forget, materialize, rows_of

from .text import column_bytes, release, shingle_sets, word_hashes

WIDTH = 5
SHARE = (80, 100)
HOT = 48  # a column in more prefixes than this is frequent
HOT_BITS, SEEN_BITS, NODE_BITS = 24, 27, 24
BLOCK_BYTES = 4 << 20  # text per block of columns, about
PIECE_BYTES = 2 << 20  # text, or sets, that a Python worker has in hand at a time, about; a longer one comes alone
LONG = 1000  # a column with more entries than this is never gathered in one task
HARVEST = 8  # rounds go on while one in so many of their pairs links
CROWD = 8  # and while there are more pairs left between components than so many for each entry,
ROUNDS = 6  # but no more than so many, and only while they link
TRIES = 4  # leading rows that a row is checked with in a round after the first
FEW_EDGES = 1_000_000  # so many edges, of two numbers each, are contracted in one task, without shuffles


def least_overlap(a, b, share=SHARE):
    """Shared columns that two sets of these sizes need."""
    p, q = share
    return -(-p * (a + b) // (p + q))


def prefix_size(n: int, share=SHARE) -> int:
    p, q = share
    return n - -(-p * n // q) + 1 if n else 0


def set_number(shingles: np.ndarray) -> int:
    """Signed 64-bit number of a set; 0 is left to the empty set."""
    if not len(shingles):
        return 0
    digest = hashlib.blake2b(shingles.tobytes(), digest_size=8).digest()
    return int.from_bytes(digest, "little", signed=True) or 1


def _sets(batch, width):
    text = batch.column("text")
    for at, n in _pieces(column_bytes(text)[1]):
        words, offsets, _ = word_hashes(text.slice(at, n))
        yield from shingle_sets(words, offsets, width)


def _pieces(ends: np.ndarray):
    """(first row, rows) of the pieces of a batch whose rows' bytes end at ``ends[1:]``."""
    at = 0
    while at < len(ends) - 1:
        n = int(np.searchsorted(ends, ends[at] + PIECE_BYTES, side="right")) - 1 - at
        n = min(max(n, 1), len(ends) - 1 - at)
        yield at, n
        at += n


# ---------------------------------------------------------------- column counts

def _block_rows(columns: list[np.ndarray], bits: int):
    """Counted columns of a task as (block, their next 32 bits, counts); equal ones are combined."""
    own, n = np.unique(np.concatenate(columns), return_counts=True)
    block = (own >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(own), np.int64)
    low = (own >> np.uint64(32 - bits)).astype(np.uint32)
    cuts = np.flatnonzero(np.diff(block)) + 1
    starts = np.concatenate(([0], cuts))
    ends = np.concatenate((cuts, [len(own)]))
    once = [bool((n[a:b] == 1).all()) for a, b in zip(starts, ends)]
    return pa.RecordBatch.from_pydict({
        "block": block[starts], "low": [low[a:b].tobytes() for a, b in zip(starts, ends)],
        "n": [None if o else n[a:b].astype("<u4").tobytes() for o, a, b in zip(once, starts, ends)],
    }, pa.schema([("block", pa.int64()), ("low", pa.binary()), ("n", pa.binary())]))


_BLOCK = "block long, low binary, n binary"


def _bitmaps(rows: DataFrame, bits: int, wanted: list[tuple[int, int]]) -> list[np.ndarray]:
    """For each (least count, bitmap bits), a bitmap of the columns that occur so often.

    Slots are the leading bits of a column's hash, so each block of columns fills its own stretch.
    """
    def merge(table):
        block = table.column("block")[0].as_py()
        lows = [np.frombuffer(x, np.uint32) for x in table.column("low").to_pylist()]
        counts = [np.ones(len(low), np.int64) if n is None else np.frombuffer(n, "<u4").astype(np.int64)
                  for low, n in zip(lows, table.column("n").to_pylist())]
        own, at = np.unique(np.concatenate(lows), return_inverse=True)
        total = np.bincount(at, weights=np.concatenate(counts))
        out = {"block": [block]}
        for k, (least, size) in enumerate(wanted):
            stretch = np.zeros(1 << (size - bits), bool)
            stretch[own[total >= least] >> np.uint32(32 - (size - bits))] = True
            out[f"m{k}"] = [zlib.compress(np.packbits(stretch).tobytes(), 1)]  # most are nearly empty
        return pa.Table.from_pydict(out)

    kinds = ", ".join(f"m{k} binary" for k in range(len(wanted)))
    maps = [np.zeros(1 << (size - 3), np.uint8) for _, size in wanted]
    for r in rows.groupBy("block").applyInArrow(merge, f"block long, {kinds}").collect():
        for k, m in enumerate(maps):
            part = np.frombuffer(zlib.decompress(r[f"m{k}"]), np.uint8)
            m[r.block * len(part):(r.block + 1) * len(part)] = part
    return maps


def has(bitmap: np.ndarray, hashes: np.ndarray, bits: int) -> np.ndarray:
    slot = hashes >> np.uint64(64 - bits)
    return (bitmap[(slot >> np.uint64(3)).astype(np.int64)] >> (7 - (slot & np.uint64(7))).astype(np.uint8)) & 1 == 1


def _counted(batches, columns_of, bits, flush=4_000_000):
    held, size = [], 0
    for batch in batches:
        for columns in columns_of(batch):
            held.append(columns)
            size += len(columns)
            if size > flush:
                yield _block_rows(held, bits)
                held, size = [], 0
    if size:
        yield _block_rows(held, bits)
    held = None
    release()


# ---------------------------------------------------------------- rows of the matrix

def incidence(documents: DataFrame, width: int = WIDTH, share=SHARE) -> tuple[DataFrame, DataFrame]:
    """(members, entries), both stored.

    members: doc_id, node, n - the set number and size of every document.
    entries: col, node, n, pos, most, long - the columns of each set's prefix that occur in two sets or
    more; ``most`` is the set's size without the columns of its prefix that no other set has. Columns
    with more than LONG entries are ``long``, and no others have so many.
    """
    spark = documents.sparkSession
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = min(20, max(0, int(size // BLOCK_BYTES).bit_length()))

    def first_columns(batch):
        for own in _sets(batch, width):
            yield own[:2 * prefix_size(len(own), share) + 16]

    counted = rows.mapInArrow(lambda b: _counted(b, first_columns, bits), _BLOCK)
    hot = spark.sparkContext.broadcast(_bitmaps(counted, bits, [(HOT + 1, HOT_BITS)])[0])

    def prefixes(batches):
        for batch in batches:
            nodes, sizes, heads = [], [], []
            for own in _sets(batch, width):
                nodes.append(set_number(own))
                sizes.append(len(own))
                late = has(hot.value, own, HOT_BITS)
                heads.append(np.concatenate((own[~late], own[late]))[:prefix_size(len(own), share)].tobytes())
            yield pa.RecordBatch.from_pydict(
                {"doc_id": batch.column("doc_id"), "node": nodes, "n": sizes, "prefix": heads},
                pa.schema([("doc_id", pa.int64()), ("node", pa.int64()), ("n", pa.int64()), ("prefix", pa.binary())]))
        batch = heads = None
        release()

    stored = materialize(rows.mapInArrow(prefixes, "doc_id long, node long, n long, prefix binary"))
    hot.destroy()

    def prefix_columns(batch):
        # Copies within a batch are one set.
        seen = dict(zip(batch.column("node").to_pylist(), batch.column("prefix").to_pylist()))
        for prefix in seen.values():
            yield np.frombuffer(prefix, np.uint64)

    kept = stored.where("n > 0").select("node", "n", "prefix")
    counted = kept.mapInArrow(lambda b: _counted(b, prefix_columns, bits), _BLOCK)
    seen, crowded = map(spark.sparkContext.broadcast, _bitmaps(counted, bits, [(2, SEEN_BITS), (LONG + 1, HOT_BITS)]))

    def explode(batches):
        done = set()
        for batch in batches:
            for node, n, prefix in zip(*(batch.column(c).to_pylist() for c in ("node", "n", "prefix"))):
                if node in done:
                    continue
                done.add(node)
                columns = np.frombuffer(prefix, np.uint64)
                pos = np.flatnonzero(has(seen.value, columns, SEEN_BITS))
                if len(pos):
                    yield pa.RecordBatch.from_pydict({
                        "col": columns[pos].astype(np.int64), "node": np.full(len(pos), node, np.int64),
                        "n": np.full(len(pos), n, np.int64), "pos": pos.astype(np.int32),
                        "most": np.full(len(pos), n - len(columns) + len(pos), np.int64),
                        "long": has(crowded.value, columns[pos], HOT_BITS)})
            if len(done) > 1_000_000:
                done = set()

    def packed(batches):
        held, rows_held = [], 0
        for batch in explode(batches):
            held.append(batch)
            rows_held += batch.num_rows
            if rows_held > 100_000:
                yield from pa.Table.from_batches(held).combine_chunks().to_batches()
                held, rows_held = [], 0
        if held:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
        held = batch = None
        release()

    entries = materialize(kept.mapInArrow(packed, "col long, node long, n long, pos int, most long, long boolean"))
    seen.destroy()
    crowded.destroy()
    return stored.select("doc_id", "node", "n"), entries


# ---------------------------------------------------------------- products

def _bounded(pairs: DataFrame, share) -> DataFrame:
    """Accumulate the shared columns of pairs (x, y, nx, ny, px, py); keep those the bound allows."""
    p, q = share
    sums = pairs.groupBy("x", "y").agg(
        F.count(F.lit(1)).alias("shared"), F.max("nx").alias("nx"), F.max("ny").alias("ny"),
        F.max("px").alias("px"), F.max("py").alias("py"))
    most = F.col("shared") + F.least(F.col("nx") - F.col("px") - 1, F.col("ny") - F.col("py") - 1)
    return sums.where((p + q) * most >= p * (F.col("nx") + F.col("ny"))).select("x", "y", "nx", "ny")


def verified(documents: DataFrame, pairs: DataFrame, width: int, share) -> DataFrame:
    """The pairs (x, y) with ``shared``, ``nx``, ``ny`` over whole sets, and ``own``; stored.

    ``own`` holds the columns of x outside y where half of their union is shared, else it is null.
    ``pairs`` is stored.
    """
    spark = documents.sparkSession
    p, q = share
    slots = pairs.select(F.explode(F.array("x", "y")).alias("node")).select(
        F.shiftrightunsigned("node", 64 - NODE_BITS).alias("slot"))
    words = slots.groupBy(F.shiftrightunsigned("slot", 6).alias("w")).agg(
        F.expr("bit_or(shiftleft(1L, cast(slot & 63 AS INT)))").alias("v")).toArrow()
    bitmap = np.zeros(1 << (NODE_BITS - 6), np.int64)
    bitmap[np.asarray(words.column("w"))] = np.asarray(words.column("v"))
    if not bitmap.any():
        return materialize(spark.createDataFrame([], _TESTED))
    wanted = spark.sparkContext.broadcast(bitmap)

    def sets(batches):
        done = set()

        def out(nodes, packed):
            return pa.RecordBatch.from_pydict(
                {"node": nodes, "set": packed}, pa.schema([("node", pa.int64()), ("set", pa.binary())]))

        for batch in batches:
            nodes, packed, held = [], [], 0
            for own in _sets(batch, width):
                node = set_number(own)
                slot = (node & ((1 << 64) - 1)) >> (64 - NODE_BITS)
                if not (int(wanted.value[slot >> 6]) >> (slot & 63)) & 1 or node in done:
                    continue
                done.add(node)
                nodes.append(node)
                # The leading 48 bits of each column, still in order.
                packed.append(np.ascontiguousarray(own.astype(">u8").view(np.uint8).reshape(-1, 8)[:, :6]).tobytes())
                held += len(packed[-1])
                if held > PIECE_BYTES:
                    yield out(nodes, packed)
                    nodes, packed, held = [], [], 0
            yield out(nodes, packed)
            if len(done) > 1_000_000:
                done = set()
        done = None
        release()

    found = documents.select("text").mapInArrow(sets, "node long, set binary")
    found = found.join(pairs.select(F.explode(F.array("x", "y")).alias("node")).distinct(), "node", "left_semi")
    found = found.dropDuplicates(["node"])
    both = pairs.join(found.withColumnsRenamed({"node": "x", "set": "sx"}), "x") \
        .join(found.withColumnsRenamed({"node": "y", "set": "sy"}), "y").select("x", "y", "sx", "sy")

    def wide(packed: bytes) -> np.ndarray:
        out = np.zeros((len(packed) // 6, 8), np.uint8)
        out[:, :6] = np.frombuffer(packed, np.uint8).reshape(-1, 6)
        return out.view(">u8").ravel().astype(np.uint64)

    def overlaps(batches):
        for whole in batches:
            bytes_to = np.cumsum([0, *np.add(*(pc.binary_length(whole.column(c)).to_numpy() for c in ("sx", "sy")))])
            for at, n in _pieces(bytes_to):
                yield overlap(whole.slice(at, n))
        whole = None
        release()

    def overlap(batch):
        counts, own, last, ys = {"shared": [], "nx": [], "ny": []}, [], None, None
        for y, a, b in zip(*(batch.column(c).to_pylist() for c in ("y", "sx", "sy"))):
            if y != last:
                last, ys = y, wide(b)
            xs = wide(a)
            at = np.searchsorted(ys, xs)
            at[at == len(ys)] = 0
            hit = ys[at] == xs
            shared = int(hit.sum())
            near = 3 * shared >= len(xs) + len(ys)
            for key, v in zip(counts, (shared, len(xs), len(ys))):
                counts[key].append(v)
            own.append(xs[~hit].astype(np.int64) if near else None)
        return pa.RecordBatch.from_arrays(
            [batch.column("x"), batch.column("y"), *(pa.array(v, pa.int64()) for v in counts.values()),
             pa.array(own, pa.list_(pa.int64()))], names=["x", "y", "shared", "nx", "ny", "own"])

    out = materialize(both.mapInArrow(overlaps, _TESTED))
    wanted.destroy()
    return out


_TESTED = "x long, y long, shared long, nx long, ny long, own array<bigint>"


def _is_link(share) -> Column:
    p, q = share
    return (p + q) * F.col("shared") >= p * (F.col("nx") + F.col("ny"))


def _linked(tested: DataFrame, share) -> DataFrame:
    return tested.where(_is_link(share)).select("x", "y")


def _contract(batches):
    """(node, comp) of the edges of one task: labels go down to the least along edges, and then along labels."""
    ends = np.array([[], []], np.int64)
    for held in batches:
        ends = np.append(ends, [held.column("x").to_numpy(), held.column("y").to_numpy()], axis=1)
    if ends.size:
        nodes, at = np.unique(ends.ravel(), return_inverse=True)
        a, b = at.reshape(2, -1)
        label, before = np.arange(len(nodes)), None
        while before is None or (label != before).any():
            before = label.copy()
            least = np.minimum(label[a], label[b])
            np.minimum.at(label, before[a], least)
            np.minimum.at(label, before[b], least)
            while (label != label[label]).any():
                label = label[label]
        for i in range(0, len(nodes), 100_000):
            yield pa.RecordBatch.from_pydict({"node": nodes[i:i + 100_000], "comp": nodes[label[i:i + 100_000]]})


def components(edges: DataFrame, rows: int | None = None, few: int = FEW_EDGES) -> DataFrame:
    """(node, comp) for all ends of ``edges`` (x, y): comp is the least node reachable.

    ``rows`` is an upper bound for the edges: up to ``few`` are contracted in one task. For more, or an unknown
    number, two star operations alternate, each a minimum per node and a join, on stored tables, until only stars
    are left; the rounds grow with the logarithm of the longest path.
    """
    if rows is not None and rows <= few:
        return edges.where("x <> y").coalesce(1).mapInArrow(_contract, "node long, comp long")
    now = materialize(edges.where("x <> y").select(
        F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b")).distinct())
    while True:
        both = now.union(now.select("b", "a").toDF("a", "b"))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = materialize(large.where("a <> b"))
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a")
        small = small.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).union(
            least.select("a", F.col("m").alias("b"))).distinct()
        now = materialize(small)
        # Stars: every node names one centre, and a centre names itself.
        names = now.union(now.select("b", "b")).groupBy("a").agg(F.min("b").alias("low"), F.max("b").alias("high"))
        if names.where("low <> high").isEmpty():
            break
    return now.select(F.col("a").alias("node"), F.col("b").alias("comp")).union(
        now.select(F.col("b").alias("node"), F.col("b").alias("comp")).distinct())


def _with_comp(entries: DataFrame, comps: DataFrame | None) -> DataFrame:
    if comps is None:
        return entries.withColumn("comp", F.col("node"))
    return entries.join(comps, "node", "left").withColumn("comp", F.coalesce("comp", "node"))


def _can_link(n, most, other_n, other_most, share):
    """Whether the columns that two sets may share are enough."""
    p, q = share
    return (p + q) * F.least(most, other_most) >= p * (n + other_n)


def _untested(pairs: DataFrame, tested: DataFrame | None) -> DataFrame:
    return pairs if tested is None else pairs.join(tested, ["x", "y"], "left_anti")


def _with_pivot(rows: DataFrame, pivots: DataFrame) -> DataFrame:
    return rows.join(pivots.select("node", "pivot", "held"), "node", "left")


def _needs_more(share):
    """Whether rows a and b, known by the same pivot, share too little of it to link by that alone.

    The overlap is at most the smaller part held of the pivot, plus what they share outside it. So
    such a pair must share a column outside, and is found by those.
    """
    p, q = share
    return F.coalesce(
        (F.col("a.pivot") == F.col("b.pivot"))
        & ((p + q) * F.least("a.held", "b.held") < p * (F.col("a.n") + F.col("b.n"))), F.lit(False))


def _beside_pivots(pivots: DataFrame, comps: DataFrame | None, share) -> DataFrame:
    """Pairs that :func:`_needs_more` left out and that share enough columns outside their pivot."""
    p, q = share
    own = _with_comp(pivots, comps)
    # What all of a pivot's rows have beside it is in no more than these entries; single ones go first.
    rows = materialize(own.select("node", "n", "pivot", "held", "comp", F.explode("own").alias("col")))
    twice = rows.groupBy("pivot", "col").agg(
        F.min("comp").alias("_low"), F.max("comp").alias("_high"), F.count(F.lit(1)).alias("often")).where(
        "_low <> _high").select("pivot", "col", "often")
    # ``rest`` counts a row's columns from this one on, frequent ones last. A pair's first shared column must leave room
    # for all that it needs, so a column that many rows share makes no pairs of rows that need more than that.
    rows = rows.join(twice, ["pivot", "col"]).withColumn("rest", F.row_number().over(
        Window.partitionBy("node").orderBy(F.desc("often"), F.desc("col"))))
    held, bound = F.least("a.held", "b.held"), p * (F.col("a.n") + F.col("b.n"))
    pairs = rows.alias("a").join(rows.alias("b"), ["pivot", "col"]).where(
        (F.col("a.node") < F.col("b.node")) & (F.col("a.comp") != F.col("b.comp"))
        & (q * F.least("a.n", "b.n") >= p * F.greatest("a.n", "b.n"))
        & ((p + q) * (held + F.least("a.rest", "b.rest")) >= bound)).select(
        F.col("a.node").alias("x"), F.col("b.node").alias("y"), held.alias("held"), bound.alias("bound"),
        F.col("a.rest").alias("rx"), F.col("b.rest").alias("ry"))
    sums = pairs.groupBy("x", "y").agg(
        F.count(F.lit(1)).alias("beside"), F.max("held").alias("held"), F.max("bound").alias("bound"),
        F.least(F.min("rx"), F.min("ry")).alias("rest"))
    return sums.where((p + q) * (F.col("held") + F.col("beside") + F.col("rest") - 1) >= F.col("bound")).select("x", "y")


_ENTRY = ["col", "node", "n", "pos", "most", "long"]


def _size_classes(share) -> list[Column]:
    """Classes of sizes in two grids, half a class apart, so that rows of like size share one."""
    scale = F.log(F.col("n").cast("double")) / float(np.log(share[1] / share[0]))
    return [2 * F.floor(scale), 2 * F.floor(scale + 0.5) + 1]


def _leads(lead: Column, share) -> Column:
    return (F.col("comp") != lead["comp"]) & _can_link(
        F.col("n"), F.col("most"), lead["n"], lead["most"], share)


def _pairs_left(live: DataFrame) -> tuple[int, int]:
    """Entries, and pairs of entries of one column and different components; no pair is made to count them."""
    k = F.col("k")
    pairs, entries = live.groupBy("col", "comp").agg(F.count(F.lit(1)).alias("k")).groupBy("col").agg(
        ((F.sum(k) * F.sum(k) - F.sum(k * k)) / 2).alias("pairs"), F.sum(k).alias("entries")).agg(
        F.sum("pairs"), F.sum("entries")).first()
    return entries or 0, pairs or 0


def _led_short(own: DataFrame, first: Column, share, others: bool) -> DataFrame:
    """Live entries of short columns with the leading rows they meet, ``with``.

    With ``others``, rows of the leading row's component meet the first one of another component.
    Rows move once, by column; a column has no more than LONG of them.
    """
    column = Window.partitionBy("col")
    live = own.select(
        "*", F.min("comp").over(column).alias("_low"), F.max("comp").over(column).alias("_high"),
        F.min("n").over(column).alias("_least")).where("_low <> _high").where(
        _can_link(F.col("n"), F.col("most"), F.col("_least"), F.col("most"), share))
    row = F.struct(first.alias("o"), "node", "comp", "n", "most")
    for i, size in enumerate(_size_classes(share)):
        alike, lead = Window.partitionBy("col", f"_size{i}"), F.col(f"_lead{i}")
        live = live.withColumn(f"_size{i}", size).withColumn(f"_lead{i}", F.min(row).over(alike))
        if others:
            foreign = F.col("comp") != lead["comp"]
            live = live.withColumn(f"_other{i}", F.min(F.when(foreign, row)).over(alike)).withColumn(
                f"_lead{i}", F.when(foreign, lead).otherwise(F.col(f"_other{i}")))
    leads = [F.when(_leads(F.col(f"_lead{i}"), share), F.col(f"_lead{i}.node")) for i in range(2)]
    return live.select(*_ENTRY, "comp", F.array_compact(F.array(*leads)).alias("with"))


def _led_long(own: DataFrame, first: Column, share, others: bool) -> DataFrame:
    """As :func:`_led_short` for long columns, by aggregates that combine before rows move."""
    ends = own.groupBy("col").agg(
        F.min("comp").alias("_low"), F.max("comp").alias("_high"), F.min("n").alias("_least")).where("_low <> _high")
    live = own.join(ends, "col").where(
        _can_link(F.col("n"), F.col("most"), F.col("_least"), F.col("most"), share))
    classed = live.select(*own.columns, F.explode(F.array(*_size_classes(share))).alias("size"))
    row = F.struct(first.alias("o"), "node", "comp", "n", "most")
    met = classed.join(classed.groupBy("col", "size").agg(F.min(row).alias("lead")), ["col", "size"])
    if others:
        foreign = F.col("comp") != F.col("lead.comp")
        other = met.where(foreign).groupBy("col", "size").agg(F.min(row).alias("other"))
        met = met.join(other, ["col", "size"], "left").withColumn("lead", F.when(foreign, F.col("lead")).otherwise(F.col("other")))
    # An entry has two rows here, one for each grid; the second, without a column, only brings its leading row.
    with_ = F.when(_leads(F.col("lead"), share), F.array("lead.node")).otherwise(F.array().cast("array<bigint>"))
    return met.withColumn("col", F.when(F.col("size") % 2 == 0, F.col("col"))).select(
        *_ENTRY, "comp", with_.alias("with"))


def links(documents: DataFrame, entries: DataFrame, width: int = WIDTH, share=SHARE) -> DataFrame | None:
    """(node, comp) of all rows with verified links, stored; None if there are none."""
    tested = None  # one table of the pairs so far, in both directions
    pivots = None
    comps, turn = None, 0
    live = entries
    p, q = share
    while True:
        own = _with_comp(live, comps)
        # A leading row for each class of sizes. It is the row with fewest columns of its own, as the
        # original of many copies has; in later rounds one of these by hash, and one of all in turns.
        alone, by_hash = F.col("n") - F.col("most"), F.xxhash64("node", "col", F.lit(turn))
        first = alone if turn == 0 else F.struct(alone, by_hash) if turn % 2 else by_hash
        # Entries of columns that still hold several components, without those that can link with no
        # row of the column.
        led = materialize(_led_short(own.where("NOT long"), first, share, turn > 0).union(
            _led_long(own.where("long"), first, share, turn > 0)))
        live = led.where("col IS NOT NULL").drop("with")
        star = led.select("node", F.explode("with").alias("with"))
        if turn:
            last = HARVEST * fresh_links <= fresh_pairs
            if last and fresh_links and turn < ROUNDS:
                entries_left, pairs_left = _pairs_left(live)
                last = pairs_left <= CROWD * entries_left
            if last:
                slim = _with_pivot(live.select("col", "node", "n", "pos", "most", "comp"), pivots)
                star = slim.alias("a").join(slim.alias("b"), "col").where(
                    (F.col("a.node") < F.col("b.node")) & (F.col("a.comp") != F.col("b.comp"))
                    & _can_link(F.col("a.n"), F.col("a.most"), F.col("b.n"), F.col("b.most"), share)
                    & ~_needs_more(share)).select(
                    F.col("a.node").alias("x"), F.col("b.node").alias("y"), F.col("a.n").alias("nx"),
                    F.col("b.n").alias("ny"), F.col("a.pos").alias("px"), F.col("b.pos").alias("py"))
        else:
            last = False
        if last:
            fresh = _untested(_bounded(star, share).select("x", "y").union(_beside_pivots(pivots, comps, share)), tested)
        else:
            # Rounds need not be complete: each row is checked with the leading rows it shares most with.
            x, y = F.col("node"), F.col("with")
            x, y = (x, y) if turn == 0 else (F.least(x, y), F.greatest(x, y))
            sums = star.groupBy("node", "with").agg(F.count(F.lit(1)).alias("shared")).select(
                "node", "shared", x.alias("x"), y.alias("y"))
            best = F.sort_array(F.collect_list(F.struct("shared", "x", "y")), False)
            fresh = _untested(sums, tested).groupBy("node").agg(
                F.slice(best, 1, TRIES if turn else 1).alias("b")).select(F.inline("b"))
        fresh = materialize(fresh.select("x", "y").distinct())
        done = verified(documents, fresh, width, share)
        new = _linked(done, share)
        if turn == 0:
            # What is known of each row by its first leading row, where they are alike.
            pivots = done.where("own IS NOT NULL").select(
                F.col("x").alias("node"), F.col("nx").alias("n"), F.col("y").alias("pivot"),
                F.col("shared").alias("held"), "own")
        fresh_pairs, fresh_links = done.agg(F.count(F.lit(1)), F.count_if(_is_link(share))).first()
        if not last:
            both = [fresh, fresh.select("y", "x").toDF("x", "y"), *([] if tested is None else [tested])]
            before, tested = tested, materialize(reduce(DataFrame.union, both).distinct())
            if before is not None:
                forget(before)
        if fresh_links:
            # The components so far are stars; with the new links they are contracted again.
            stars = [] if comps is None else [comps.where("node <> comp").toDF("x", "y")]
            nodes = fresh_links + (rows_of(comps) if stars else 0)
            comps = materialize(components(reduce(DataFrame.union, stars, new), nodes))
        if last:
            return comps
        live = live.select(_ENTRY)
        turn += 1


def ngram_components(documents: DataFrame, width: int = WIDTH, share=SHARE) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every document.

    Texts are cut into words and A-Z lower-cased; the set of a text with fewer than ``width`` words is
    its whole sequence, that of a null or wordless one is empty and links with nothing. component_id is the
    smallest doc_id among the documents reachable by links of ``share`` (numerator, denominator) or more;
    null ids are never the smallest, and a component without any other id has null. One row per input row.
    """
    members, entries = incidence(documents, width, share)
    own = _with_comp(members, links(documents, entries, width, share))
    own = own.select("doc_id", F.col("n").alias("n_shingles"), "comp")
    least = own.where("n_shingles > 0").groupBy("comp").agg(F.min("doc_id").alias("least"))
    return own.join(least, "comp", "left").select(
        "doc_id", "n_shingles",
        F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("least")).alias("component_id"))


def one_of_each(documents: DataFrame, **options) -> DataFrame:
    """``documents`` with one row of each component: that with the smallest doc_id.

    Repeated rows of that id are cut to one. Documents without words, and those with null ids, stay.
    """
    found = ngram_components(documents, **options)
    gone = found.where((F.col("n_shingles") > 0) & (F.col("doc_id") != F.col("component_id"))).select(
        F.col("doc_id").alias("_gone")).distinct()
    rest = documents.join(gone, F.col("doc_id") == F.col("_gone"), "left_anti")
    again = found.where("n_shingles > 0 AND doc_id IS NOT NULL").groupBy("doc_id").count().where("count > 1") \
        .select(F.col("doc_id").alias("_again"))
    columns = [F.col(f"`{c}`") for c in documents.columns]
    repeated = rest.join(again, F.col("doc_id") == F.col("_again"), "left_semi").select(columns)
    return rest.join(again, F.col("doc_id") == F.col("_again"), "left_anti").select(columns).union(
        repeated.dropDuplicates(["doc_id"]))
