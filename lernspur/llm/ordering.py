"""Splitting a table into ranges of a long column without moving its other columns first."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

LAST = (1 << 63) - 1


def order_key(name: str = "doc_id") -> Column:
    """The column as a number that sorts nulls last."""
    return F.coalesce(F.col(name).cast("long"), F.lit(LAST))


def range_bounds(df: DataFrame, key: Column, parts: int) -> list[int]:
    """Upper bounds that deal the rows of ``df`` evenly over at most ``parts`` ranges of ``key``.

    Only the key column is read; the result is bounded by ``parts``, not by the data.
    """
    if parts < 2:
        return []
    shares = [i / parts for i in range(1, parts)]
    found = df.agg(F.percentile_approx(key, shares, max(10_000, 10 * parts)).alias("b")).first()
    return sorted(set(found.b or []))


def range_number(key: Column, bounds: list[int]) -> Column:
    """The range that a key falls in, counted from 0."""
    if not bounds:
        return F.lit(0)
    edges = F.array(*[F.lit(b).cast("long") for b in bounds])
    return F.size(F.filter(edges, lambda b: b < key)).cast("int")


def default_parts(df: DataFrame) -> int:
    """Ranges to use: four for each shuffle partition, so that none weighs much."""
    return 4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
