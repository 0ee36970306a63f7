"""Reads a generic click-stream table as a learning-app event log.

``events(event_id, ts, user_id, event_type, value, props)`` has users, times and a handful
of event types, but no tasks, attempts or states. Those are derived by position: each
user's events are cut into attempts of 8 and tasks of 24 events, and the number in
``props`` picks the details. Time is compressed 120 times.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..functions.times import utc_micros
from ..operators.ordered import Lanes, LastSeen, Previous, RunningSum, SEGMENT
from ..schemas import EVENT_ORDER, K4, STUDENT

EPOCH_US = 1_704_067_200_000_000  # 2024-01-01 00:00:00 UTC
TIME_DIVISOR = 120
TASKS = 6
EVENTS_PER_ATTEMPT = 8
EVENTS_PER_TASK = 24

LOG_COLUMNS = [
    "seq", STUDENT, "studentRef", "taskNumber", "attemptHlc", "visitId", "timestamp",
    "eventType", "mistake", "reason", "stars", "oldState", "newState", "actionName",
]


def clickstream_lanes(events: DataFrame) -> Lanes:
    # Times without a zone are UTC.
    zoned = isinstance(events.schema["ts"].dataType, T.TimestampType)
    events = events.withColumn("_us", F.unix_micros("ts") if zoned else utc_micros(F.col("ts")))
    base = events.selectExpr(
        "event_id AS seq", "user_id", "event_type",
        f"concat('u', lpad(cast(user_id AS string), 6, '0')) AS {STUDENT}",
        "cast(get_json_object(props, '$.k') AS int) AS k",
        f"timestamp_micros({EPOCH_US} + (_us - {EPOCH_US}) div {TIME_DIVISOR}) AS timestamp",
    )
    lanes = Lanes.split(base, STUDENT, [STUDENT, *EVENT_ORDER])
    lanes = lanes.ordered([STUDENT], EVENT_ORDER, RunningSum("_row", F.lit(1).cast("long")))
    lanes = lanes.map(_positions).ordered(
        K4, EVENT_ORDER,
        RunningSum("_steps", F.expr("if(_e0 = 'mathStep', 1L, 0L)")),
        LastSeen("_state", F.col("newState")),
    )
    # ``_state`` includes the row's own state; the one before it is a row back.
    lanes = lanes.ordered(K4, EVENT_ORDER, Previous("_prior", F.col("_state"))).map(_details)
    return lanes.map(
        lambda df: df.select(*LOG_COLUMNS, *[c for c in df.columns if c == SEGMENT])
    ).store()


def _positions(df: DataFrame) -> DataFrame:
    return df.selectExpr(
        *[c for c in df.columns if c not in ("event_type", "_row")],
        f"(_row - 1) % {EVENTS_PER_ATTEMPT} AS _place",
        f"(_row - 1) div {EVENTS_PER_ATTEMPT} AS _attempt",
        f"cast(1 + (user_id + (_row - 1) div {EVENTS_PER_TASK}) % {TASKS} AS int) AS taskNumber",
        f"""CASE WHEN (_row - 1) % {EVENTS_PER_TASK} = 0 THEN 'visitTask'
            WHEN event_type IN ('click', 'purchase') THEN 'mathStep'
            WHEN event_type = 'error' AND k < 60 THEN 'mathMistake'
            WHEN event_type = 'error' AND k < 85 THEN 'undo'
            WHEN event_type = 'error' THEN 'redo'
            WHEN event_type = 'view' AND k < 50 THEN 'showHint'
            WHEN event_type = 'view' AND k < 80 THEN 'hideHint'
            WHEN event_type = 'view' THEN 'visitGameScreen'
            WHEN k < 20 THEN 'visitTask' WHEN k < 60 THEN 'resetTask'
            ELSE 'solvedTask' END AS _e0""",
    ).selectExpr(
        "*",
        "if(k % 7 != 0, concat('ref', user_id), NULL) AS studentRef",
        """if(k != 97, concat('a', lpad(cast(if(user_id % 5 = 0, 9999 - _attempt, _attempt)
            AS string), 4, '0')), NULL) AS attemptHlc""",
        """concat('v', lpad(cast(_attempt AS string), 4, '0'), CASE WHEN k % 10 = 0 THEN 'b'
            WHEN _place >= 5 AND _attempt % 3 = 1 THEN 'c' ELSE '' END) AS visitId""",
        "if(_e0 = 'mathStep', concat('n', k % 20, '_', user_id % 7), NULL) AS newState",
    )


def _details(df: DataFrame) -> DataFrame:
    """A solution before the task's minimum number of steps is read as a hint."""
    return df.selectExpr(
        "*",
        """if(_e0 = 'solvedTask' AND _steps < 1 + taskNumber % 3, 'showHint', _e0)
            AS eventType""",
        """if(_e0 = 'mathStep', if(k % 25 = 24, concat('m', k % 3), coalesce(_prior, 'S')), NULL)
            AS oldState""",
        """if(_e0 = 'mathMistake', CASE k % 3 WHEN 0 THEN 'keypad' WHEN 1 THEN 'tap'
            ELSE 'drag' END, NULL) AS mistake""",
        """CASE WHEN _e0 != 'resetTask' THEN NULL WHEN k < 35 THEN 'resetButton'
            WHEN k < 45 THEN 'retryButton' WHEN k < 55 THEN 'autoReset' END AS reason""",
        "if(_e0 = 'mathStep', concat('op', k % 4), NULL) AS actionName",
    ).selectExpr("*", "if(eventType = 'solvedTask', cast(1 + k % 3 AS int), NULL) AS stars")


def clickstream_tasks(spark: SparkSession) -> DataFrame:
    return spark.range(1, TASKS + 1).select(
        F.col("id").cast("int").alias("taskNumber"),
        F.lit("S").alias("startState"),
        F.lit("G").alias("goalState"),
    )
