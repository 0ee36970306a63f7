"""Mixing of sources to target weights with a low-discrepancy schedule.

Each source's documents are shuffled by a hash of their id and laid out as one line of words,
which is cut into blocks of equal length. The schedule is a row of slots: slot i has the point
frac(i * golden ratio), which falls into one source's share of the cumulative weights. The r-th
slot of a source takes the r-th block of its line, starting over at the end of the line, until
its target is reached. Every stretch of the schedule so has all sources in nearly their weights.

Sources are the configured parts of a mixture, thus few; one row for each passes through the
driver. Documents, blocks and slots stay distributed, and no window holds a whole source.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

WORDS = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
EPOCH_SHARE = 1.5
MOST_REPEATS = 2
BLOCK = 256
SLACK = 8  # slots beyond a source's need, besides the logarithm of all slots: what a golden-ratio row can fall behind
GROUP_ROWS = 2_000

# Points are i * _STEP mod _MOD; _STEP / _MOD is the golden ratio's fraction, and odd.
_MOD = 1 << 40
_STEP = int(_MOD * 0.6180339887498949) | 1


def targets(sizes: list[tuple[str | None, int]], weights=WEIGHTS, share=EPOCH_SHARE,
            repeats=MOST_REPEATS) -> list[tuple[str | None, int, float]]:
    """(source, size, target) by source in code point order, null last.

    Targets share ``share`` times all sizes by weight, and stop at ``repeats`` times the source's
    size; what is over goes to the others by weight, until none is above.
    """
    rows = sorted(sizes, key=lambda r: (r[0] is None, (r[0] or "").encode()))
    weigh = [weights[i % len(weights)] for i in range(len(rows))]
    caps = [repeats * n for _, n in rows]
    rest, left, out = share * sum(n for _, n in rows), sum(weigh), [0.0] * len(rows)
    for i in sorted(range(len(rows)), key=lambda i: (caps[i] / weigh[i], i)):
        out[i] = min(float(caps[i]), rest / left * weigh[i])
        if out[i] == caps[i]:
            rest, left = rest - caps[i], left - weigh[i]
    return [(s, n, t) for (s, n), t in zip(rows, out)]


def _groups(rows: int) -> int:
    """How many hash ranges the documents of a source are cut into: a power of 16."""
    digits = 0
    while GROUP_ROWS * 16 ** digits < rows:
        digits += 1
    return digits


def schedule(spark, needs: list[int]) -> DataFrame:
    """Slots (slot, source number ``src``, ``rank``) with rank < needs[src] for each source.

    Raises an error if a source has fewer slots than it needs.
    """
    slack = SLACK + sum(needs).bit_length()
    shares = [n + slack for n in needs]
    slots = sum(shares)
    ends, total = [], 0
    for n in shares:
        total += n
        ends.append(total * _MOD // slots)
    edges = F.array(*[F.lit(e).cast("long") for e in ends[:-1]]) if len(ends) > 1 else None
    lines = spark.range(slots).select(F.col("id").alias("slot"))
    # i * _STEP modulo _MOD in two parts, so that no product leaves 63 bits.
    high, low = F.shiftright("slot", 20), F.col("slot").bitwiseAND(F.lit((1 << 20) - 1))
    point = (high * ((_STEP << 20) % _MOD) + low * _STEP) % _MOD
    src = F.lit(0) if edges is None else F.size(F.filter(edges, lambda e: e <= F.col("point")))
    lines = lines.withColumn("point", point).withColumn("src", src.cast("int")) \
        .withColumn("chunk", F.shiftright("slot", 16))
    counts = lines.groupBy("chunk", "src").count()
    have = {r.src: r.n for r in counts.groupBy("src").agg(F.sum("count").alias("n")).collect()}
    short = [i for i, n in enumerate(needs) if have.get(i, 0) < n]
    if short:
        raise ValueError(f"sources {short} have fewer slots than they need")
    before = counts.withColumn("before", F.sum("count").over(
        Window.partitionBy("src").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)))
    inner = Window.partitionBy("chunk", "src").orderBy("slot")
    ranked = lines.withColumn("_n", F.row_number().over(inner) - 1).join(
        before.select("chunk", "src", F.coalesce("before", F.lit(0)).alias("before")), ["chunk", "src"])
    need = F.array(*[F.lit(n).cast("long") for n in needs])
    return ranked.select("slot", "src", (F.col("before") + F.col("_n")).alias("rank")).where(
        F.col("rank") < F.element_at(need, F.col("src") + 1))


def mix(documents: DataFrame, weights=WEIGHTS, share=EPOCH_SHARE, repeats=MOST_REPEATS,
        block: int = BLOCK) -> DataFrame:
    """What the mix takes from each document.

    Returns doc_id, source, text, size, source_size, target, taken, passes: ``size`` is the number of
    words (0 for null or empty texts), ``taken`` the words the mix takes, repeats counted, and
    ``passes`` how many of them come from the first, second ... pass over the source's line (array
    of long). One row per input row. Documents with equal ids and equal sizes are ordered by
    chance of the read, which changes no row; an empty table gives no rows.
    """
    spark = documents.sparkSession
    docs = documents.select(
        "doc_id", "source", "text",
        F.coalesce(F.regexp_count("text", F.lit(WORDS)), F.lit(0)).cast("long").alias("size"),
        F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")).alias("_key"))
    sizes = docs.groupBy("source").agg(F.sum("size").alias("n"), F.count(F.lit(1)).alias("rows")).collect()
    plan = targets([(r.source, r.n) for r in sizes], weights, share, repeats)
    digits = _groups(sum(r.rows for r in sizes))
    numbered = [(i, s, n, t, int(t), -(-n // block)) for i, (s, n, t) in enumerate(plan)]
    kind = "src int, _source string, source_size long, target double, _goal long, _blocks long"
    wanted = F.broadcast(spark.createDataFrame(numbered, kind))

    # A place on the source's line: words of earlier hash ranges, then of earlier rows in the range.
    docs = docs.join(wanted, F.col("source").eqNullSafe(F.col("_source")), "left").drop("_source") \
        .withColumn("_range", F.substring("_key", 1, digits))
    ranges = docs.groupBy("src", "_range").agg(F.sum("size").alias("n"))
    ranges = ranges.select("src", "_range", F.coalesce(F.sum("n").over(
        Window.partitionBy("src").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)),
        F.lit(0)).alias("_before"))
    order = Window.partitionBy("src", "_range").orderBy("_key", "size")
    inner = F.coalesce(F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = docs.drop("text").withColumn("_inner", inner).withColumn("_nth", F.row_number().over(order)) \
        .join(ranges, ["src", "_range"]).withColumn("_from", F.col("_before") + F.col("_inner"))

    pieces = placed.withColumn("block", F.expr(
        f"""explode_outer(if(size = 0, null,
            sequence(_from DIV {block}L, (_from + size - 1) DIV {block}L)))""")) \
        .withColumn("_a", F.greatest(F.col("_from") - F.col("block") * block, F.lit(0))) \
        .withColumn("_b", F.least(F.col("_from") + F.col("size") - F.col("block") * block, F.lit(block)))
    needs = [_slots(goal, n, blocks, block, repeats) for _, _, n, _, goal, blocks in numbered]
    info = F.broadcast(spark.createDataFrame(
        [(i, n, goal, blocks) for i, _, n, _, goal, blocks in numbered] or [(-1, 0, 0, 0)],
        "src int, _n long, _goal long, _blocks long"))
    uses = schedule(spark, needs or [0]).join(info, "src").where("_blocks > 0") \
        .withColumn("block", F.col("rank") % F.col("_blocks")) \
        .withColumn("pass", F.expr("CAST(rank DIV _blocks AS INT)")) \
        .withColumn("_words", F.expr(
            f"least({block}L, _n - block * {block}L, _goal - pass * _n - block * {block}L)"))
    uses = uses.groupBy("src", "block").agg(*[
        F.coalesce(F.sum(F.when(F.col("pass") == k, F.col("_words"))), F.lit(0)).alias(f"_w{k}")
        for k in range(repeats)])
    taken = pieces.join(uses, ["src", "block"], "left")
    key = ["src", "_range", "_key", "_nth"]
    got = taken.groupBy(*key, "doc_id", "source", "size", "source_size", "target").agg(*[
        F.sum(F.greatest(F.lit(0), F.least("_b", F.coalesce(f"_w{k}", F.lit(0))) - F.col("_a"))).alias(f"_p{k}")
        for k in range(repeats)])
    passes = F.array(*[F.coalesce(f"_p{k}", F.lit(0)).cast("long") for k in range(repeats)])
    return got.select(
        "doc_id", "source", "size", "source_size", "target",
        F.aggregate(passes, F.lit(0).cast("long"), lambda s, x: s + x).alias("taken"), passes.alias("passes"))


def _slots(goal: int, size: int, blocks: int, block: int, repeats: int) -> int:
    """Slots until ``goal`` words are taken: whole passes, then blocks of the last pass."""
    if size == 0:
        return 0
    whole, rest = divmod(goal, size)
    return min(whole * blocks + -(-rest // block), repeats * blocks)


def mixed_documents(documents: DataFrame, **options) -> DataFrame:
    """The mix itself: ``documents`` with each text as often, and with as many words, as it is taken.

    Columns as in ``documents`` (doc_id, text, lang, source, n_chars). Documents the mix does not
    take are left out; the one at the end of a source's target is cut after its last word taken.
    Rows with the same doc_id and the same source must have equal texts, or are told apart by size.
    """
    taken = mix(documents, **options).select(
        "doc_id", "source", "size", F.posexplode("passes").alias("_pass", "_words")).where("_words > 0")
    size = F.coalesce(F.regexp_count("text", F.lit(WORDS)), F.lit(0)).cast("long")
    once = documents.select("doc_id", "text", "lang", "source", "n_chars").withColumn("size", size)
    same = ["doc_id", "source", "size"]
    # Repeated rows are matched one to one by their number, not all with all.
    number = Window.partitionBy(*same)
    once = once.withColumn("_nth", F.row_number().over(number.orderBy("text", "lang", "n_chars")))
    taken = taken.withColumn("_nth", F.row_number().over(
        Window.partitionBy(*same, "_pass").orderBy(F.desc("_words"))))
    left, right = once.alias("l"), taken.alias("r")
    match = F.expr(" AND ".join(f"l.{c} <=> r.{c}" for c in [*same, "_nth"]))
    whole = F.col("r._words") >= F.col("l.size")
    head = F.expr(r"array_join(slice(regexp_extract_all(l.text, '([^\\x20\\x09-\\x0D]+)', 1), 1, CAST(r._words AS INT)), ' ')")
    text = F.when(whole, F.col("l.text")).otherwise(head)
    return left.join(right, match).select(
        "l.doc_id", text.alias("text"), "l.lang", "l.source", F.length(text).cast("long").alias("n_chars"))
