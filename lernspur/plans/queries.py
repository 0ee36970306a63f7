"""Every operator as a query over the given tables: ``(spark, folder) -> DataFrame``."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import states as st
from ..functions import times as tm
from ..operators import attempts as att
from ..operators import graph as gr
from ..operators import paths as pt
from ..operators import quality, rollups, visits
from ..operators.classify import classify_attempts
from ..runtime import materialize
from ..schemas import K4, STUDENT
from ..sources import files
from ..sources.clickstream import LOG_COLUMNS, clickstream_tasks
from . import intake
from .base import lanes as _lanes, log as _log, published, table as _table
from .study import aggregate_events

def _normalized(spark, folder):
    return visits.normalize_visits(_lanes(spark, folder))


def _attempts(spark, folder):
    return att.attempt_lanes(visits.attempt_events(_normalized(spark, folder)))


def _student_problem(spark, folder):
    return rollups.student_problem(_attempts(spark, folder))


def _paths(spark, folder):
    return pt.attempt_paths(pt.path_events(_normalized(spark, folder)), clickstream_tasks(spark))


def _graphs(spark, folder):
    return gr.ProblemGraphs(_paths(spark, folder).store())


# --- events ---

def event_log(spark, folder):
    return published(_log(spark, folder).select(*LOG_COLUMNS))


def task_numbers(spark, folder):
    return quality.task_numbers(_log(spark, folder))


def task_slice(spark, folder):
    return published(quality.task_slice(_log(spark, folder), 1))


def fill_optional(spark, folder):
    return published(files.fill_optional(_log(spark, folder)))


def key_inventory(spark, folder):
    text = [tm.utc_text(F.col(c)).alias(c) if c == "timestamp" else F.col(c) for c in LOG_COLUMNS]
    log = _log(spark, folder).select("seq", F.to_json(F.struct(*text)).alias("value"))
    return files.key_inventory(log, "seq")


def parse_timestamp(spark, folder):
    clock = F.date_trunc("second", "ts").cast("timestamp_ntz").cast("string")
    day = F.col("ts").cast("date")
    month = F.element_at(F.array(*[F.lit(m) for m in intake.MONTHS]), F.month(day))
    form = F.col("event_id") % 4
    text = (
        F.when(form == 0, F.replace(clock, F.lit(" "), F.lit("T")))
        .when(form == 1, F.regexp_replace(clock, r"^(\d+)-(\d+)-(\d+)", "$2/$3/$1"))
        .when(form == 2, F.floor(tm.utc_micros(F.col("ts")) / 1000).cast("string"))
        .otherwise(F.concat(month, F.lit(" "), F.day(day), F.lit(", "), F.year(day), F.substring(clock, 11, 9)))
    )
    log = _table(spark, folder, "events").select("event_id", text.alias("text"))
    return published(log.withColumn("parsed", tm.parse_timestamp(F.col("text"))))


def visit_collapse(spark, folder):
    return _normalized(spark, folder).merge().select("seq", "rawVisitId", "visitId")


def reset_reassign(spark, folder):
    return visits.reassign_resets(_normalized(spark, folder)).merge().select(
        "seq", "rawAttemptHlc", "attemptHlc", "visitId", "next_reset_reason")


def nonempty_visits(spark, folder):
    return visits.visit_activity(_normalized(spark, folder))


def event_deltas(spark, folder):
    return published(visits.attempt_events(_normalized(spark, folder)).merge().select(
        "seq", *K4, (F.col("delta_us") / 1e6).alias("delta_seconds"),
        visits.is_action().alias("is_action")))


def converted_states(spark, folder):
    log = _log(spark, folder)
    mapping = _translations(log)
    return st.convert_event_states(log, mapping).select(
        "seq", "eventType", "oldState", "newState", "oldState_latex", "newState_latex")


def _translations(log):
    """A mapping as a caller would bring it: here, underscores become colons."""
    raw = log.select(F.explode(F.array("oldState", "newState")).alias("raw")).where("raw IS NOT NULL")
    return raw.distinct().withColumn("canonical", F.replace("raw", F.lit("_"), F.lit(":")))


def state_dictionary(spark, folder):
    log = _log(spark, folder)
    return st.state_dictionary(log, mapping=_translations(log)).select("raw", "uses", "canonical")


def canonical_states(spark, folder):
    times = F.lit("\\cdot ")
    raw = F.concat(
        F.lit("$"), (F.col("o_custkey") % 50).cast("string"), times, F.substring("o_orderstatus", 1, 1),
        times, F.lower(F.substring("o_orderpriority", 3, 1)), times, F.lit("x + "),
        (F.col("o_custkey") % 9).cast("string"), times, (F.col("o_orderkey") % 4).cast("string"),
        times, F.lower("o_orderstatus"), F.lit("$"),
    )
    return _table(spark, folder, "orders").select("o_orderkey", raw.alias("raw")).select(
        "o_orderkey", "raw", st.canonical_latex(F.col("raw")).alias("latex"),
        st.without_spaces(F.col("raw")).alias("ascii"))


def union_studies(spark, folder):
    log = _log(spark, folder).select(*LOG_COLUMNS)
    return published(files.union_studies({"first": log, "second": log}))


# --- attempts and roll-ups ---

def attempt_level(spark, folder):
    return published(_attempts(spark, folder).merge().select(*att.ATTEMPT_COLUMNS))


def attempt_numbers(spark, folder):
    return _attempts(spark, folder).merge().select(*K4, "attempt_number", "attempt_visit_number")


def replay_flag(spark, folder):
    return _attempts(spark, folder).merge().select(*K4, "replay_attempt")


def student_problem(spark, folder):
    return published(_student_problem(spark, folder))


def student_level(spark, folder):
    return published(rollups.student_level(_student_problem(spark, folder)))


def problem_level(spark, folder):
    return published(rollups.problem_level(_student_problem(spark, folder)))


def assignment_level(spark, folder):
    students = materialize(rollups.student_level(_student_problem(spark, folder)))
    return published(rollups.assignment_level(students))


# --- paths and graphs ---

def path_events(spark, folder):
    return pt.path_events(_normalized(spark, folder)).merge().select(
        "seq", *K4, "eventType", "oldState", "newState", "actionName")


def attempt_paths(spark, folder):
    return pt.path_rows(_paths(spark, folder))


EDGE = ["prev", "new", "attempt_count", "math_trans_type", "weight"]


def transition_edges(spark, folder):
    return gr.transition_edges(pt.path_edges(_paths(spark, folder).store())).select("taskNumber", *EDGE)


def student_edges(spark, folder):
    edges = gr.student_edges(pt.path_edges(_paths(spark, folder).store()))
    return edges.select("taskNumber", F.col("scope").alias(STUDENT), *EDGE)


def retract_edges(spark, folder):
    """Withdraw the attempts whose undo and redo events do not add up."""
    paths = _paths(spark, folder).store()
    steps = materialize(pt.path_edges(paths))
    odd = pt.path_outcomes(paths).where("path_anomaly").select(*K4)
    removed = steps.join(odd, K4, "left_semi").select("taskNumber", "prev", "new")
    return gr.retract_edges(gr.transition_edges(steps), removed).select("taskNumber", *EDGE)


def optimal_length(spark, folder):
    return _graphs(spark, folder).lengths


def optimal_paths(spark, folder):
    g = _graphs(spark, folder)
    return gr.optimal_paths(g.best_edges, g.tasks).select(
        "taskNumber", F.concat_ws(" > ", "path").alias("path"))


def optimal_path_counts(spark, folder):
    g = _graphs(spark, folder)
    return gr.optimal_path_counts(g.best_edges, g.tasks)


def best_path_edges(spark, folder):
    return _graphs(spark, folder).best_edges.select("taskNumber", *EDGE)


def best_path_nodes(spark, folder):
    return _graphs(spark, folder).best_nodes


def dead_end_nodes(spark, folder):
    return _graphs(spark, folder).dead.where(F.col("scope") == gr.ALL_STUDENTS).drop("scope")


def student_dead_ends(spark, folder):
    dead = _graphs(spark, folder).dead.where(F.col("scope") != gr.ALL_STUDENTS)
    return dead.withColumnRenamed("scope", STUDENT)


def graph_links(spark, folder):
    g = _graphs(spark, folder)
    return gr.graph_links(g.edges, g.best_edges)


def graph_nodes(spark, folder):
    g = _graphs(spark, folder)
    g.prepare()
    return gr.graph_node_flags(g.scoped, g.best_nodes, g.dead)


def graph_export(spark, folder):
    g = _graphs(spark, folder)
    g.prepare()
    return gr.graph_json(gr.graph_links(g.edges, g.best_edges),
                         gr.graph_node_flags(g.scoped, g.best_nodes, g.dead))


def classified_attempts(spark, folder):
    return classify_attempts(_graphs(spark, folder))


def attempts_and_classes(spark, folder):
    attempts, _ = aggregate_events(_lanes(spark, folder), clickstream_tasks(spark))
    return published(attempts)


# --- tasks ---

def task_bounds(spark, folder):
    return quality.task_bounds(_log(spark, folder), clickstream_tasks(spark))


def _part_tasks(spark, folder):
    """Part rows read as task descriptions from several sessions."""
    times = F.lit("\\cdot ")
    name, size = F.substring("p_name", 1, 1), F.col("p_size").cast("string")
    return _table(spark, folder, "part").select(
        F.col("p_partkey").alias("seq"),
        (1 + F.col("p_partkey") * 6 % 3000).cast("int").alias("taskNumber"),
        F.col("p_brand").alias("sessionId"),
        F.lpad(size, 3, "0").alias("sessionCreatedAt"),
        F.concat(F.lit("$"), size, times, name, F.lit(" + "), (F.col("p_partkey") % 7).cast("string"),
                 F.lit("$")).alias("startState"),
        F.concat(name, times, F.substring("p_type", 1, 1), F.lit(" = "), size).alias("goalState"),
    )


def task_metadata(spark, folder):
    return files.task_metadata(_part_tasks(spark, folder))


def task_meta_violations(spark, folder):
    used = _table(spark, folder, "lineitem").select(
        (1 + F.col("l_partkey") % 2500).cast("int").alias("taskNumber"))
    return quality.task_violations(quality.task_numbers(used), _part_tasks(spark, folder))


QUERIES = {
    f.__name__: f for f in (
        event_log, task_numbers, task_slice, fill_optional, key_inventory, parse_timestamp,
        visit_collapse, reset_reassign, nonempty_visits, event_deltas, converted_states,
        state_dictionary, canonical_states, union_studies, attempt_level, attempt_numbers,
        replay_flag, student_problem, student_level, problem_level, assignment_level, path_events,
        attempt_paths, transition_edges, student_edges, retract_edges, optimal_length,
        optimal_paths, optimal_path_counts, best_path_edges, best_path_nodes, dead_end_nodes, student_dead_ends,
        graph_links, graph_nodes, graph_export, task_bounds, task_metadata, task_meta_violations,
    )
}
QUERIES["classify_attempts"] = classified_attempts
QUERIES["attempt_with_class"] = attempts_and_classes
QUERIES |= intake.QUERIES
