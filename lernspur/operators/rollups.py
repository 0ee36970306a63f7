"""Roll-ups: student x task, student, task and assignment tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..schemas import K2, STUDENT
from .attempts import ATTEMPT_ORDER
from .ordered import Lanes, RunningSum, Whole


def _aggregates(expressions: dict[str, str]) -> list[Column]:
    return [F.expr(e).alias(name) for name, e in expressions.items()]


def _total(column: str) -> str:
    """Sum that is zero, not null, when every value is null."""
    return f"coalesce(sum({column}), 0)"


STUDENT_PROBLEM_AGGREGATES = {
    "studentRef": f"""min_by(studentRef, struct({', '.join(ATTEMPT_ORDER)}))
        FILTER (WHERE studentRef IS NOT NULL)""",
    "num_attempts": "max(attempt_number)",
    "num_replays": "count_if(replay_attempt)",
    "num_clicked_retry_button": "count_if(clicked_retry_button)",
    "num_clicked_reset_button": "count_if(clicked_reset_button)",
    "problem_completed": "count_if(completed_dur_attempt) > 0",
    "num_completed_attempts": "count_if(completed_dur_attempt)",
    "num_errors": _total("num_errors"),
    "num_keypad_errors": _total("num_keypad_errors"),
    "num_shaking_errors": _total("num_shaking_errors"),
    "num_snapping_errors": _total("num_snapping_errors"),
    "num_hints": _total("num_hints"),
    "total_time_spent": "coalesce(sum(total_time), 0D)",
    "avg_time_spent": "avg(total_time)",
    "avg_pause_time": "avg(pause_time)",
    "avg_pause_time_ratio": "avg(pause_time_ratio)",
    "num_three_star": "count_if(stars_3)",
    "num_two_star": "count_if(stars_2)",
    "num_one_star": "count_if(stars_1)",
    "num_incomplete": "count_if(stars_NA)",
    "avg_stars": "avg(stars)",
}


def student_problem_lanes(attempts: Lanes) -> Lanes:
    """Per student and task. The plain lane is still hashed by student: no shuffle."""
    return attempts.aggregate(K2, *_aggregates(STUDENT_PROBLEM_AGGREGATES))


def student_problem(attempts: Lanes) -> DataFrame:
    return student_problem_lanes(attempts).merge()


def student_level(student_problem: DataFrame) -> DataFrame:
    """Per student. Input rows are unique per (student, task), so tasks are just counted."""
    totals = {
        "total_attempts": "num_attempts",
        "total_replays": "num_replays",
        "total_completed_attempts": "num_completed_attempts",
        "total_errors": "num_errors",
        "total_keypad_errors": "num_keypad_errors",
        "total_shaking_errors": "num_shaking_errors",
        "total_snapping_errors": "num_snapping_errors",
        "total_hints": "num_hints",
        "total_time_spent": "total_time_spent",
        "total_one_star": "num_one_star",
        "total_two_star": "num_two_star",
        "total_three_star": "num_three_star",
        "total_incomplete": "num_incomplete",
        "total_click_reset": "num_clicked_reset_button",
        "total_click_retry": "num_clicked_retry_button",
    }
    return (
        student_problem.groupBy(STUDENT)
        .agg(*_aggregates({
            "studentRef": "min_by(studentRef, taskNumber) FILTER (WHERE studentRef IS NOT NULL)",
            "total_problems": "count(taskNumber)",
            "total_completed_problems": "count_if(problem_completed)",
            **{name: _total(c) for name, c in totals.items()},
            "avg_click_reset": "avg(num_clicked_reset_button)",
            "avg_click_retry": "avg(num_clicked_retry_button)",
            "avg_stars": "avg(avg_stars)",
        }))
        .withColumn("total_time_spent_mins", F.col("total_time_spent") / 60)
    )


def problem_level(student_problem: DataFrame) -> DataFrame:
    """Per task, averaging over students; partial sums leave each map task as one row per task."""
    means = {
        "avg_time_spent": "total_time_spent",
        "avg_attempts": "num_attempts",
        "avg_replays": "num_replays",
        "avg_completed_attempts": "num_completed_attempts",
        "avg_errors": "num_errors",
        "avg_keypad_errors": "num_keypad_errors",
        "avg_shaking_errors": "num_shaking_errors",
        "avg_snapping_errors": "num_snapping_errors",
        "avg_hints": "num_hints",
        "avg_one_star": "num_one_star",
        "avg_two_star": "num_two_star",
        "avg_three_star": "num_three_star",
        "avg_incomplete": "num_incomplete",
        "avg_stars": "avg_stars",
        "avg_click_reset": "num_clicked_reset_button",
        "avg_click_retry": "num_clicked_retry_button",
    }
    return (
        student_problem.groupBy("taskNumber")
        .agg(*_aggregates({
            "total_students": f"count({STUDENT})",
            "total_completed": "count_if(problem_completed)",
            **{name: f"avg({c})" for name, c in means.items()},
        }))
        .withColumn("avg_time_spent_mins", F.col("avg_time_spent") / 60)
    )


ASSIGNMENT_METRICS = [
    "total_problems", "total_completed_problems", "total_attempts", "total_replays",
    "total_completed_attempts", "total_errors", "total_keypad_errors", "total_shaking_errors",
    "total_snapping_errors", "total_hints", "total_time_spent", "total_one_star",
    "total_two_star", "total_three_star", "total_incomplete", "total_click_reset",
    "total_click_retry", "avg_click_reset", "avg_click_retry", "avg_stars",
    "total_time_spent_mins",
]


def assignment_level(students: DataFrame) -> DataFrame:
    """Mean, deviation and exact quartiles of every numeric student column.

    Spark's exact ``percentile`` keeps all distinct values of a column in one buffer. Here
    equal values are counted first, a running count gives each value the ranks it covers,
    and the two ranks around each quartile are interpolated linearly.
    """
    values = (
        students.select(*[F.col(c).cast("double").alias(c) for c in ASSIGNMENT_METRICS])
        .unpivot([], ASSIGNMENT_METRICS, "metric", "value")
        .where(F.col("value").isNotNull())
    )
    moments = values.groupBy("metric").agg(
        F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"), F.max("value").alias("max"),
    )
    counts = values.groupBy("metric", "value").agg(F.count(F.lit(1)).alias("n"))
    ranked = (
        Lanes.split(counts, "metric", ["metric", "value"])
        .ordered(["metric"], ["value"], RunningSum("upto", F.col("n")), Whole("size", F.col("n"), F.sum))
        .merge()
    )
    quartiles = []
    for name, q in (("p25", 0.25), ("p50", 0.5), ("p75", 0.75)):
        rank = (F.col("size") - 1) * F.lit(q)

        def at_rank(r):
            covers = (F.col("upto") - F.col("n") <= r) & (r < F.col("upto"))
            return F.max(F.when(covers, F.col("value")))

        low, high = at_rank(F.floor(rank)), at_rank(F.ceil(rank))
        part = F.max(rank - F.floor(rank))
        quartiles.append((low + (high - low) * part).alias(name))
    return (
        moments.join(ranked.groupBy("metric").agg(*quartiles), "metric")
        .select("metric", "mean", "std", "min", "p25", "p50", "p75", "max")
    )
