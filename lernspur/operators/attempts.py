"""Attempt-visit table: one row per (student, task, attempt, visit)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..schemas import ACTION_EVENTS, EVENT_ORDER, K2, K3, K4, LONGEST_GAP_SECONDS
from .ordered import Lanes, Previous, RunningSum, Whole

GAP_US = LONGEST_GAP_SECONDS * 1_000_000
ATTEMPT_ORDER = ["attemptHlc", "start_time", "seq0"]

ATTEMPT_COLUMNS = [
    *K4, "studentRef", "start_time", "end_time", "total_time", "pause_time", "num_steps",
    "num_errors", "completed_dur_attempt", "num_visits", "validity_first_step", "num_hints",
    "num_keypad_errors", "num_shaking_errors", "num_snapping_errors", "stars",
    "clicked_reset_button", "clicked_retry_button", "attempt_number", "attempt_visit_number",
    "pause_time_ratio", "replay_attempt", "stars_1", "stars_2", "stars_3", "stars_NA",
]


_WHEN = f"struct({', '.join(EVENT_ORDER)})"
_ACTION = f"eventType IN ({', '.join(repr(e) for e in ACTION_EVENTS)})"
_FIRST_STEP = f"min({_WHEN}) FILTER (WHERE eventType = 'mathStep')"
_FIRST_MISTAKE = f"min({_WHEN}) FILTER (WHERE eventType = 'mathMistake')"

ATTEMPT_AGGREGATES = {
    "studentRef": f"min_by(studentRef, {_WHEN}) FILTER (WHERE studentRef IS NOT NULL)",
    "start_time": "min(timestamp)",
    "end_time": "max(timestamp)",
    "seq0": f"min({_WHEN}).seq",
    "total_time": f"sum(delta_us) FILTER (WHERE delta_us < {GAP_US}) / 1e6D",
    # The struct keeps a null delta: the first action alone decides the pause.
    "_pause_us": f"min_by(struct(delta_us), {_WHEN}) FILTER (WHERE {_ACTION}).delta_us",
    "num_steps": "count_if(eventType = 'mathStep')",
    "num_errors": "count_if(eventType = 'mathMistake')",
    "completed_dur_attempt": "count_if(eventType = 'solvedTask') > 0",
    "num_visits": "count_if(eventType = 'visitTask')",
    "validity_first_step": f"""CASE WHEN {_FIRST_STEP} IS NULL THEN NULL
        WHEN {_FIRST_MISTAKE} IS NULL THEN true ELSE {_FIRST_STEP} < {_FIRST_MISTAKE} END""",
    "num_hints": "count_if(eventType = 'showHint')",
    "num_keypad_errors": "count_if(mistake = 'keypad')",
    "num_shaking_errors": "count_if(mistake = 'tap')",
    "num_snapping_errors": "count_if(mistake = 'drag')",
    "stars": "max(stars)",
    "clicked_reset_button": "count_if(next_reset_reason = 'resetButton') > 0",
    "clicked_retry_button": "count_if(next_reset_reason = 'retryButton') > 0",
}


def summarize_attempts(events: Lanes) -> Lanes:
    """Aggregate attempt events; gaps of five minutes and more are not working time."""
    lanes = events.aggregate(
        K4, *[F.expr(e).alias(name) for name, e in ATTEMPT_AGGREGATES.items()]
    )
    pause = F.expr(f"if(_pause_us < {GAP_US}, _pause_us / 1e6D, NULL)")
    return lanes.map(
        lambda df: df.withColumn("pause_time", pause).drop("_pause_us")
        .withColumn("pause_time_ratio", F.try_divide("pause_time", "total_time"))
    ).resegment([*K2, *ATTEMPT_ORDER])


def number_attempts(attempts: Lanes) -> Lanes:
    """``attempt_number`` ranks attempts by id; ``attempt_visit_number`` counts visits in time."""
    lanes = attempts.ordered(
        K2, ATTEMPT_ORDER, Previous("_before", F.struct("attemptHlc"))
    ).map(
        lambda df: df.withColumn(
            "_starts", F.expr("if(_before.attemptHlc <=> attemptHlc, 0L, 1L)")
        ).drop("_before")
    )
    lanes = lanes.ordered(K2, ATTEMPT_ORDER, RunningSum("attempt_number", F.col("_starts")))
    return lanes.ordered(
        K3, ["start_time", "seq0"], RunningSum("attempt_visit_number", F.lit(1).cast("long"))
    ).map(lambda df: df.drop("_starts"))


def flag_replays(attempts: Lanes) -> Lanes:
    """An attempt-visit is a replay if it began after the first completed one.

    "First completed" goes by attempt id, "after" goes by time; the two orders differ when
    clocks disagree. Without a completed attempt there is no replay.
    """
    done = F.expr(f"if(completed_dur_attempt, struct({', '.join(ATTEMPT_ORDER)}), NULL)")
    lanes = attempts.ordered(K2, ATTEMPT_ORDER, Whole("_done", done, F.min))
    later = F.expr("""coalesce(struct(start_time, seq0) > struct(_done.start_time, _done.seq0)
        AND _done IS NOT NULL, false)""")
    return lanes.map(lambda df: df.withColumn("replay_attempt", later).drop("_done"))


def star_flags(df: DataFrame) -> DataFrame:
    return df.selectExpr(
        "*", *[f"coalesce(stars = {k}, false) AS stars_{k}" for k in (1, 2, 3)],
        "stars IS NULL AS stars_NA",
    )


def attempt_lanes(attempt_events: Lanes) -> Lanes:
    """The whole attempt table, still in lanes so that the next grouping needs no shuffle."""
    return flag_replays(number_attempts(summarize_attempts(attempt_events))).map(star_flags)


def attempt_level(attempt_events: Lanes) -> DataFrame:
    return attempt_lanes(attempt_events).merge().select(*ATTEMPT_COLUMNS)
