"""Event-level repair: visit ids, resets, empty visits, time deltas."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..schemas import ACTION_EVENTS, EVENT_ORDER, K2, K3, K4, STUDENT
from .ordered import First, Following, Lanes, Previous, Whole


_ACTIONS = ", ".join(f"'{e}'" for e in ACTION_EVENTS)


def is_action() -> Column:
    return F.expr(f"coalesce(eventType IN ({_ACTIONS}), false)")


def keys_present(keys: list[str]) -> str:
    return " AND ".join(f"{k} IS NOT NULL" for k in keys)


def event_lanes(events: DataFrame) -> Lanes:
    """Partition the log by student once; every later step reuses that exchange."""
    return Lanes.split(
        events.where("taskNumber IS NOT NULL"), STUDENT, [STUDENT, *EVENT_ORDER]
    )


def normalize_visits(lanes: Lanes) -> Lanes:
    """Give all events of an attempt its first visit id, unless visits interleave.

    A page refresh opens a new visit that continues the old one, so ``a,a,b,b`` becomes
    ``a,a,a,a``. Two open tabs go back and forth (``a,b,a``) and stay as they are.
    The ids found in the log are kept in ``rawVisitId``. Events outside any attempt
    belong to no visit and get none.
    """
    lanes = lanes.map(lambda df: df.withColumn("rawVisitId", F.col("visitId")))
    lanes = lanes.ordered(K4, EVENT_ORDER, Previous("_seen", F.lit(True)))
    lanes = lanes.ordered(
        K3, EVENT_ORDER,
        Previous("_before", F.struct("rawVisitId")),
        First("_first", F.col("rawVisitId")),
    )
    returns = F.expr(
        "_before IS NOT NULL AND NOT _before.rawVisitId <=> rawVisitId AND _seen IS NOT NULL"
    )
    lanes = lanes.ordered(K3, EVENT_ORDER, Whole("_interleaved", returns, F.max))
    visit = F.expr(f"""CASE WHEN NOT ({keys_present(K3)}) THEN NULL
        WHEN _first IS NULL OR _interleaved THEN rawVisitId ELSE _first END""")
    return lanes.map(
        lambda df: df.withColumn("visitId", visit)
        .drop("_seen", "_before", "_first", "_interleaved")
    ).store()


def reassign_resets(lanes: Lanes) -> Lanes:
    """Move each reset to the attempt that follows it.

    Game-screen visits are dropped first, so they never count as the next event.
    ``next_reset_reason`` is the reason of the next event of the same student and task.
    """
    lanes = lanes.map(lambda df: df.where("NOT eventType <=> 'visitGameScreen'")).ordered(
        K2, EVENT_ORDER,
        Following("_next_attempt", F.col("attemptHlc")),
        Following("next_reset_reason", F.col("reason")),
    )
    moved = F.expr("if(eventType = 'resetTask', _next_attempt, attemptHlc)")
    return lanes.map(
        lambda df: df.withColumns({"rawAttemptHlc": F.col("attemptHlc"), "attemptHlc": moved})
        .drop("_next_attempt")
    )


def drop_empty_visits(lanes: Lanes, *specs) -> Lanes:
    """Keep events of attempt-visits that hold an action; ``specs`` share the same window.

    Rows without a complete attempt-visit key can no longer be grouped and go as well.
    Whole groups are kept or dropped, so windows over the same key are not disturbed.
    """
    lanes = lanes.map(lambda df: df.where(keys_present(K4))).ordered(
        K4, EVENT_ORDER, Whole("_active", is_action(), F.max), *specs
    )
    return lanes.map(lambda df: df.where("_active").drop("_active"))


def attempt_events(normalized: Lanes) -> Lanes:
    """Events entering the attempt table, with ``delta_us`` since the previous event."""
    lanes = drop_empty_visits(
        reassign_resets(normalized), Previous("_before", F.col("timestamp"))
    )
    delta = F.expr("unix_micros(timestamp) - unix_micros(_before)")
    return lanes.map(lambda df: df.withColumn("delta_us", delta).drop("_before")).store()


def visit_activity(normalized: Lanes) -> DataFrame:
    """Per attempt-visit (after resets moved): number of events and whether it is kept."""
    return (
        reassign_resets(normalized)
        .map(lambda df: df.where(keys_present(K4)))
        .aggregate(
            K4,
            F.count(F.lit(1)).alias("num_events"),
            F.bool_or(is_action()).alias("kept"),
        )
        .merge()
    )
