"""Task lookups and the checks they rest on."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..runtime import join_lookup


def task_numbers(events: DataFrame) -> DataFrame:
    return events.select("taskNumber").where(F.col("taskNumber").isNotNull()).distinct()


def task_slice(events: DataFrame, number: int) -> DataFrame:
    """Events of one task; on a log stored by task only that folder is read."""
    return events.where(F.col("taskNumber") == number)


def task_violations(used: DataFrame, tasks: DataFrame) -> DataFrame:
    """Task numbers used by events without exactly one metadata row."""
    rows = tasks.groupBy("taskNumber").agg(F.count(F.lit(1)).alias("rows"))
    return (
        used.join(rows, "taskNumber", "left")
        .select("taskNumber", F.coalesce("rows", F.lit(0)).alias("rows"))
        .where(F.col("rows") != 1)
        .withColumn("problem", F.when(F.col("rows") == 0, "missing").otherwise("multiple"))
    )


def check_tasks(events: DataFrame, tasks: DataFrame) -> None:
    bad = task_violations(task_numbers(events), tasks).first()
    if bad is not None:
        raise ValueError(f"{bad.problem} metadata for task number {bad.taskNumber}")


def task_bounds(events: DataFrame, tasks: DataFrame) -> DataFrame:
    """Start and goal state of every task in use; null where ``tasks`` has no row for it."""
    return join_lookup(task_numbers(events), tasks, ["taskNumber"], "left").select(
        "taskNumber", "startState", "goalState")
