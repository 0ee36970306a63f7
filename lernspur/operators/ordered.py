"""Ordered windows that hold when one group owns a large share of all rows.

A Spark window sends every row of a partition key to one task. ``Lanes`` keeps that plan
for ordinary groups and takes hot groups apart: their rows are range-partitioned by
(key, order), so a group spans many tasks as consecutive segments. A window over a hot
group is then computed per segment, and one summary row per (group, segment) carries the
missing context (previous row, running total, ...) across segment borders. The result is
exact in both lanes.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..runtime import bucketed, forget, group_sizes, materialize, same_hot_key, small_broadcast

SEGMENT = "_segment"


def at(order: list[str]) -> Column:
    return F.struct(*order)


@dataclass(frozen=True)
class Previous:
    """Value on the preceding row (``Following``: on the next row), null if there is none."""

    name: str
    value: Column

    def plain(self, rows):
        return F.lag(self.value).over(rows)

    def local(self, rows):
        return F.lag(F.struct(self.value.alias("v"))).over(rows)

    def summary(self, order):
        return F.max_by(F.struct(self.value.alias("v")), at(order))

    def carry(self, summary, segments):
        return F.lag(summary).over(segments)

    def combine(self, local, carry):
        return F.coalesce(local, carry)["v"]


@dataclass(frozen=True)
class Following(Previous):
    def plain(self, rows):
        return F.lead(self.value).over(rows)

    def local(self, rows):
        return F.lead(F.struct(self.value.alias("v"))).over(rows)

    def summary(self, order):
        return F.min_by(F.struct(self.value.alias("v")), at(order))

    def carry(self, summary, segments):
        return F.lead(summary).over(segments)


def _so_far(rows):
    return rows.rowsBetween(Window.unboundedPreceding, Window.currentRow)


def _earlier(segments):
    return segments.rowsBetween(Window.unboundedPreceding, -1)


def _all(rows):
    return rows.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)


@dataclass(frozen=True)
class RunningSum:
    """Sum of ``value`` up to and including the row; ``value`` must not be null."""

    name: str
    value: Column

    def plain(self, rows):
        return F.sum(self.value).over(_so_far(rows))

    local = plain

    def summary(self, order):
        return F.sum(self.value)

    def carry(self, summary, segments):
        return F.sum(summary).over(_earlier(segments))

    def combine(self, local, carry):
        return local + F.coalesce(carry, F.lit(0))


@dataclass(frozen=True)
class RunningMin:
    name: str
    value: Column

    def plain(self, rows):
        return F.min(self.value).over(_so_far(rows))

    local = plain

    def summary(self, order):
        return F.min(self.value)

    def carry(self, summary, segments):
        return F.min(summary).over(_earlier(segments))

    def combine(self, local, carry):
        return F.least(local, carry)


@dataclass(frozen=True)
class LastSeen:
    """Latest non-null ``value`` up to and including the row."""

    name: str
    value: Column

    def plain(self, rows):
        return F.last(self.value, ignorenulls=True).over(_so_far(rows))

    local = plain

    def summary(self, order):
        return F.max_by(self.value, F.when(self.value.isNotNull(), at(order)))

    def carry(self, summary, segments):
        return F.last(summary, ignorenulls=True).over(_earlier(segments))

    def combine(self, local, carry):
        return F.coalesce(local, carry)


@dataclass(frozen=True)
class Whole:
    """An aggregate of the whole group (``F.min``, ``F.max`` or ``F.sum``) on each row."""

    name: str
    value: Column
    how: Callable = F.max

    def plain(self, rows):
        return self.how(self.value).over(_all(rows))

    def local(self, rows):
        return None

    def summary(self, order):
        return self.how(self.value)

    def carry(self, summary, segments):
        return self.how(summary).over(_all(segments))

    def combine(self, local, carry):
        return carry


@dataclass(frozen=True)
class First(Whole):
    """Value on the first row of the group, null or not."""

    def plain(self, rows):
        return F.first(self.value).over(_all(rows))

    def summary(self, order):
        return F.min_by(F.struct(self.value.alias("v")), at(order))

    def carry(self, summary, segments):
        return F.first(summary).over(_all(segments))

    def combine(self, local, carry):
        return carry["v"]


def _plain_windows(df: DataFrame, keys, order, specs) -> DataFrame:
    rows = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumns({s.name: s.plain(rows) for s in specs})


def _segmented_windows(df: DataFrame, keys, order, specs) -> DataFrame:
    rows = Window.partitionBy(*keys, SEGMENT).orderBy(*order)
    local = {f"_l_{s.name}": s.local(rows) for s in specs}
    out = df.withColumns({n: c for n, c in local.items() if c is not None})
    segments = Window.partitionBy(*keys).orderBy(SEGMENT)
    carries = (
        df.groupBy(*keys, SEGMENT)
        .agg(*[s.summary(order).alias(f"_s_{s.name}") for s in specs])
        .withColumns({f"_c_{s.name}": s.carry(F.col(f"_s_{s.name}"), segments) for s in specs})
        .drop(*[f"_s_{s.name}" for s in specs])
    )
    group = [*keys, SEGMENT]
    carries = carries.withColumnsRenamed({k: f"_k_{k}" for k in group})
    same_segment = reduce(
        lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in group]
    )
    joined = out.join(carries, same_segment, "left").drop(*[f"_k_{k}" for k in group])
    return joined.withColumns({
        s.name: s.combine(
            F.col(f"_l_{s.name}") if local[f"_l_{s.name}"] is not None else None,
            F.col(f"_c_{s.name}"),
        )
        for s in specs
    }).drop(*[f"_l_{s.name}" for s in specs], *[f"_c_{s.name}" for s in specs])


def _segment(df: DataFrame, sort: list[str], rows_per_segment: int) -> DataFrame:
    """Cut ``df`` into ranges of ``sort`` and store the range number with each row."""
    stored = materialize(df)
    parts = max(2, -(-stored.count() // rows_per_segment))
    # The range number depends on sampled cut points, so it is stored before it is used.
    return materialize(
        stored.repartitionByRange(parts, *sort).withColumn(SEGMENT, F.spark_partition_id())
    )


@dataclass(frozen=True)
class Lanes:
    """Rows of ordinary groups (``plain``) and of hot groups (``hot``, usually absent)."""

    plain: DataFrame
    hot: DataFrame | None
    rows_per_segment: int
    largest: int

    @classmethod
    def split(cls, df: DataFrame, key: str, sort: list[str]) -> Lanes:
        """Hash the rows by ``key``, setting apart the keys with too many rows.

        Every later window key must contain ``key``; ``sort`` is ``key`` followed by the
        window order, so a segment is a stretch of that order for any finer key too.
        """
        sizes = group_sizes(df, [key])
        if sizes.hot is None:
            return cls(df.repartition(key), None, sizes.limit, sizes.largest)
        hot_keys = small_broadcast(sizes.hot).drop("n")
        plain = df.join(hot_keys, same_hot_key([key]), "left_anti").repartition(key)
        hot = df.join(hot_keys, same_hot_key([key]), "left_semi")
        per_segment = max(1, sizes.limit // 2)
        return cls(plain, _segment(hot, sort, per_segment), per_segment, sizes.largest)

    def map(self, fn: Callable[[DataFrame], DataFrame]) -> Lanes:
        """Apply a row-wise step (select, filter) to both lanes."""
        return Lanes(
            fn(self.plain), None if self.hot is None else fn(self.hot),
            self.rows_per_segment, self.largest,
        )

    def ordered(self, keys: list[str], order: list[str], *specs) -> Lanes:
        """Add one column per spec, computed over ``keys`` in ``order``."""
        return Lanes(
            _plain_windows(self.plain, keys, order, specs),
            None if self.hot is None else _segmented_windows(self.hot, keys, order, specs),
            self.rows_per_segment, self.largest,
        )

    def store(self) -> Lanes:
        """Materialise the hot lane, so that long chains of joins are not planned again."""
        return Lanes(
            self.plain, None if self.hot is None else materialize(self.hot),
            self.rows_per_segment, self.largest,
        )

    def store_all(self) -> Lanes:
        """Materialise both lanes."""
        return Lanes(
            materialize(self.plain), None if self.hot is None else materialize(self.hot),
            self.rows_per_segment, self.largest,
        )

    def share(self, key: str) -> Lanes:
        """Store both lanes for several uses; the plain one keeps its hashing by ``key``.

        It is written in as many buckets as there are shuffle partitions, by the same hash, so what is computed per
        ``key`` from it shuffles no rows again. :meth:`discard` deletes the tables.
        """
        return Lanes(
            bucketed(self.plain, key), None if self.hot is None else materialize(self.hot),
            self.rows_per_segment, self.largest,
        )

    def discard(self) -> None:
        """Delete what :meth:`share` stored, when no plan reads it any more."""
        forget(*[df for df in (self.plain, self.hot) if df is not None])

    def is_empty(self) -> bool:
        return self.plain.isEmpty() and (self.hot is None or self.hot.isEmpty())

    def union(self, other: Lanes) -> Lanes:
        return Lanes(
            self.plain.unionByName(other.plain),
            None if self.hot is None else self.hot.unionByName(other.hot),
            self.rows_per_segment, self.largest,
        )

    def aggregate(self, keys: list[str], *aggs: Column) -> Lanes:
        """Group both lanes; hot groups are pre-aggregated per segment by the map side."""
        return Lanes(
            self.plain.groupBy(*keys).agg(*aggs),
            None if self.hot is None else self.hot.groupBy(*keys).agg(*aggs),
            self.rows_per_segment, self.largest,
        )

    def resegment(self, sort: list[str]) -> Lanes:
        """Cut the hot lane again for a new order, after ``aggregate``."""
        return Lanes(
            self.plain,
            None if self.hot is None else _segment(self.hot, sort, self.rows_per_segment),
            self.rows_per_segment, self.largest,
        )

    def merge(self) -> DataFrame:
        if self.hot is None:
            return self.plain
        return self.plain.unionByName(self.hot.drop(SEGMENT))
