"""Attempt classes: optimal, sub-optimal, dead end or incomplete."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..runtime import join_lookup
from ..schemas import K4, MISSING_NODE, STUDENT
from .graph import ALL_STUDENTS, NODE, ProblemGraphs
from .paths import path_nodes, path_outcomes, undecided


def classify_attempts(graphs: ProblemGraphs) -> DataFrame:
    """One class against the whole task's graph and one against the student's own.

    Solved attempts are optimal or not by length. Others are dead ends if they touch a
    dead-end state, else incomplete. Attempts with missing states get no class.
    """
    graphs.prepare()
    outcomes = join_lookup(
        join_lookup(path_outcomes(graphs.paths), graphs.tasks, ["taskNumber"]),
        graphs.lengths, ["taskNumber"],
    ).withColumn("_reached", F.coalesce(F.col("last_state") == F.col("goalState"), F.lit(False)))

    # Only attempts whose class depends on it are compared with the dead ends; the others' states are not even unpacked.
    nodes = path_nodes(undecided(graphs.paths))
    nodes = join_lookup(nodes, graphs.tasks, ["taskNumber"]).where(
        ~F.col("node").eqNullSafe(F.col("startState")) & (F.col("node") != MISSING_NODE)
    ).select(*K4, "node", F.explode(F.array(F.lit(ALL_STUDENTS), F.col(STUDENT))).alias("scope"))
    touched = join_lookup(nodes, graphs.dead, NODE, "left_semi").groupBy(*K4).agg(
        F.bool_or(F.col("scope") == ALL_STUDENTS).alias("_dead_all"),
        F.bool_or(F.col("scope") != ALL_STUDENTS).alias("_dead_own"),
    )

    def outcome(dead):
        return (
            F.when(F.col("has_missing"), F.lit(None))
            .when(F.col("_reached") & (F.col("num_states") - 1 == F.col("optimal_length")), "optimal")
            .when(F.col("_reached"), "sub_optimal")
            .when(F.coalesce(F.col(dead), F.lit(False)), "dead_end")
            .otherwise("incomplete")
        )

    return outcomes.join(touched, K4, "left").select(
        *K4,
        outcome("_dead_all").alias("MFL_global_class"),
        outcome("_dead_own").alias("MFL_individual_class"),
        F.col("has_missing").alias("missing_steps_in_logs"),
    )


def attempt_with_class(attempts: DataFrame, classes: DataFrame) -> DataFrame:
    """Attempt table with its classes; attempts that left no path have none."""
    return attempts.join(classes, K4, "left")
