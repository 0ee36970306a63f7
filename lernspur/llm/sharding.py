"""Placement of rows on shards through a permutation-filled lookup table.

The table has a prime number of slots. Every shard has its own order of preference over all
slots, an offset and a step derived from its name. Shards take turns, each claiming the first
slot of its order that is still free, until the table is full. So each shard owns the same
number of slots, give or take one, and adding or losing a shard moves few of the others'.

The table depends on the shard names alone and is bounded by its size, so it is broadcast; a row
is placed by one lookup. Everything runs as Spark SQL expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

TABLE_SIZE = 2039
MOST_SLOTS = 65_537


def _is_prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n ** 0.5) + 1))


def _number(text: Column, digits: int = 12) -> Column:
    """The first hex digits of the text's MD5 as a number."""
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, digits), 16, 10).cast("long")


def shard_table(spark: SparkSession, shards: list[str], size: int = TABLE_SIZE) -> DataFrame:
    """Lookup table (slot int, shard string), one row per slot.

    ``shards`` are distinct non-empty names, at most ``size`` of them; their order in the list
    has no effect. ``size`` is a prime of at most 65 537, and should be 100 times the number of
    shards or more for even shares. Building it copies the table
    once per slot, so it takes time proportional to ``size`` squared.
    """
    names = sorted(shards)
    if not names or len(set(names)) != len(names) or not all(names):
        raise ValueError("shards must be distinct non-empty names")
    if not _is_prime(size) or size > MOST_SLOTS or len(names) > size:
        raise ValueError("size must be a prime, at least the number of shards, at most 65 537")
    n = len(names)
    orders = (
        spark.range(1).select(F.explode(F.array(*[F.lit(x) for x in names])).alias("name"))
        .select(F.struct(
            "name",
            (_number(F.concat(F.lit("offset:"), "name")) % size).cast("int").alias("start"),
            (_number(F.concat(F.lit("step:"), "name")) % (size - 1) + 1).cast("int").alias("step"),
        ).alias("o"))
        .agg(F.array_sort(F.collect_list("o")).alias("o"))
    )
    # State: the owner of each slot (-1: free) and how far each shard got in its order. The first
    # choices are tried before the rest, as most turns end there.
    mine = f"o[turn % {n}]"
    slot = f"cast(({mine}.start + bigint(j) * {mine}.step) % {size} as int)"
    free = f"j -> s.owner[{slot}] = -1"
    at = f"s.next[turn % {n}]"
    turn = f"""
        aggregate(
          sequence(0, {size - 1}),
          named_struct('owner', array_repeat(-1, {size}), 'next', array_repeat(0, {n})),
          (s, turn) -> aggregate(
            array(coalesce(
              try_element_at(filter(sequence({at}, least({at} + 63, {size - 1})), {free}), 1),
              try_element_at(filter(sequence({at}, {size - 1}), {free}), 1))),
            s,
            (t, j) -> named_struct(
              'owner', concat(slice(t.owner, 1, {slot}), array(turn % {n}),
                              slice(t.owner, {slot} + 2, {size})),
              'next', transform(t.next, (x, i) -> if(i = turn % {n}, j + 1, x)))))"""
    filled = orders.select("o", F.expr(turn).alias("s"))
    return filled.select("o", F.posexplode("s.owner").alias("slot", "i")).select(
        "slot", F.expr("o[i].name").alias("shard"))


def place(df: DataFrame, key: Column, table: DataFrame, size: int = TABLE_SIZE) -> DataFrame:
    """Add ``slot`` and ``shard`` to ``df``: one broadcast lookup, no shuffle of rows.

    Equal keys always go to the same shard, and a null key is placed like an empty text.
    ``df`` must not have columns of these two names. No row is dropped or repeated.
    """
    slot = (_number(F.coalesce(key.cast("string"), F.lit("")), 8) % size).cast("int")
    return df.withColumn("slot", slot).join(F.broadcast(table), "slot", "left")
