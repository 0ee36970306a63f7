"""Hand-written logs, one student (and mostly one task) per rule."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tests.helpers import rows
from lernspur.operators import attempts as att
from lernspur.operators import graph as gr
from lernspur.operators import paths as pt
from lernspur.operators import rollups, visits
from lernspur.operators.classify import attempt_with_class, classify_attempts
from lernspur.sources.files import event_types

START = dt.datetime(2024, 1, 1)


class Log:
    def __init__(self):
        self.rows = []

    def add(self, student, at, kind, attempt="a1", visit="v1", task=1, old=None, new=None, **more):
        self.rows.append(dict(
            studentSessionId=student, timestamp=START + dt.timedelta(seconds=at), eventType=kind,
            attemptHlc=attempt, visitId=visit, taskNumber=task, oldState=old, newState=new,
            actionName=new and f"to_{new}", reason=more.get("reason"), stars=more.get("stars"),
            mistake=more.get("mistake"), studentRef=more.get("ref"), seq=len(self.rows)))
        return self

    def step(self, student, at, old, new, **more):
        return self.add(student, at, "mathStep", old=old, new=new, **more)


SCHEMA = """studentSessionId string, timestamp timestamp, eventType string, attemptHlc string,
 visitId string, taskNumber int, oldState string, newState string, actionName string,
 reason string, stars int, mistake string, studentRef string, seq long"""


def _log():
    log = Log()
    # visits
    for i, v in enumerate("aaabb"):
        log.step("one_way", i, "S", "x", visit=v, task=9)
    for i, v in enumerate("aaba"):
        log.step("back", i, "S", "x", visit=v, task=9)
    for i, v in enumerate(("a", None, "a")):
        log.step("null_between", i, "S", "x", visit=v, task=9)
    for i, v in enumerate((None, "b")):
        log.step("null_first", i, "S", "x", visit=v, task=9)
    # times
    for t in (0, 10, 309.999, 609.999):
        log.step("gaps", t, "S", "x", task=9)
    log.add("long_pause", 0, "visitTask", task=9).step("long_pause", 300, "S", "x", task=9)
    log.step("action_first", 0, "S", "x", task=9).step("action_first", 5, "x", "y", task=9)
    log.add("no_time", 0, "visitTask", task=9).step("no_time", 0, "S", "x", task=9)
    log.add("pause", 0, "visitTask", task=9).step("pause", 4, "S", "x", task=9)
    log.step("pause", 12, "x", "y", task=9)
    log.add("ties", 0, "mathMistake", task=9).step("ties", 0, "S", "x", task=9)
    # resets
    for s, visit in (("reset_same", "v1"), ("reset_other", "v2")):
        log.step(s, 0, "S", "x", task=9).add(s, 5, "resetTask", task=9, reason="resetButton")
        log.step(s, 9, "S", "y", attempt="a2", visit=visit, task=9)
    log.step("reset_last", 0, "S", "x", task=9)
    log.add("reset_last", 5, "resetTask", task=9, reason="retryButton")
    log.step("reset_screen", 0, "S", "x", task=9).add("reset_screen", 1, "visitGameScreen", task=9)
    log.add("reset_screen", 2, "resetTask", task=9, reason="resetButton")
    log.add("reset_null", 0, "resetTask", attempt=None, task=9).step("reset_null", 3, "S", "x", task=9)
    # first step
    log.add("mistake_step", 0, "mathMistake", task=9, mistake="tap").step("mistake_step", 1, "S", "x", task=9)
    log.step("step_mistake", 0, "S", "x", task=9).add("step_mistake", 1, "mathMistake", task=9, mistake="drag")
    log.add("hint_only", 0, "showHint", task=9)
    log.add("empty_visit", 0, "visitTask", task=9)
    # replay: attempt ids run against time
    for t, attempt, kind in ((0, "a3", "mathStep"), (1, "a3", "solvedTask"), (10, "a2", "mathStep"),
                             (20, "a1", "mathStep"), (21, "a1", "solvedTask"), (30, "a4", "mathStep")):
        log.add("replay", t, kind, attempt=attempt, old="S", new="x" if kind == "mathStep" else None,
                task=9, stars=3 if kind == "solvedTask" else None)
    # names
    log.add("names", 0, "visitTask", task=9).step("names", 1, "S", "x", task=9, ref="r1")
    log.step("names", 2, "x", "y", task=9, ref="r2")
    # paths (task 1: solved by "solver" in one transition)
    log.step("solver", 0, "S", "G").add("solver", 1, "solvedTask")
    def moves(student, *events, task=1):
        for i, e in enumerate(events):
            if isinstance(e, tuple):
                log.step(student, i, *e, task=task)
            else:
                log.add(student, i, e, task=task)
    moves("undo_redo", ("S", "a"), ("a", "b"), "undo", "redo")
    moves("step_clears", ("S", "a"), ("a", "b"), "undo", ("a", "c"), "redo")
    moves("missing", ("S", "a"), ("x", "b"))
    moves("undo_missing", ("S", "a"), ("x", "b"), "undo", "undo", ("q", "c"))
    moves("solved_empty", "showHint", "solvedTask")
    moves("commuted", ("S", "a"), ("a", "g2"), "solvedTask", ("G", "z"))
    moves("no_event", ("S", "a"), ("a", "G"))
    moves("underflow", "undo", "redo", ("S", "a"), "redo", "undo", "undo", "undo", "redo", ("a", "b"))
    moves("after_reset", ("S", "a"), "resetTask", ("a", "b"))
    log.step("ignored_reset", 0, "S", "a").add("ignored_reset", 1, "resetTask", reason="autoReset")
    log.step("ignored_reset", 2, "a", "b")
    # classes (task 2)
    moves("c1", ("S", "a"), ("a", "G"), "solvedTask", task=2)
    log.step("c2", 0, "S", "a", task=2)
    log.step("c2", 10, "S", "b", task=2, attempt="a2").step("c2", 11, "b", "G", task=2, attempt="a2")
    log.add("c2", 12, "solvedTask", task=2, attempt="a2")
    moves("c3", ("S", "d"), task=2)
    moves("c4", ("S", "a"), ("a", "b"), ("b", "G"), "solvedTask", task=2)
    # task 3 is never solved
    moves("u", ("S", "a"), task=3)
    return log


@pytest.fixture(scope="module", params=["fold", "walk"])
def world(request, spark):
    log = spark.createDataFrame(_log().rows, SCHEMA).coalesce(3)
    tasks = spark.createDataFrame([(t, "S", "G") for t in (1, 2, 3, 9)],
                                  "taskNumber int, startState string, goalState string")
    if request.param == "walk":
        spark.conf.set("spark.lernspur.foldEvents", "0")
    try:
        normalized = visits.normalize_visits(visits.event_lanes(event_types(log)))
        attempts = att.attempt_lanes(visits.attempt_events(normalized)).store_all()
        paths = pt.attempt_paths(pt.path_events(normalized), tasks).store()
        graphs = gr.ProblemGraphs(paths)
        table = attempt_with_class(attempts.merge().select(*att.ATTEMPT_COLUMNS), classify_attempts(graphs))
        return {
            "visits": {(r.studentSessionId, r.seq): r.visitId for r in normalized.merge().collect()},
            "attempts": {(r.studentSessionId, r.attemptHlc): r for r in table.collect()},
            "problems": {r.studentSessionId: r for r in rollups.student_problem(attempts).collect()},
            "paths": {(r.studentSessionId, r.attemptHlc): r for r in pt.path_rows(paths).collect()},
            "lengths": {r.taskNumber: r for r in graphs.lengths.collect()},
            "dead": {(r.taskNumber, r.scope, r.node) for r in graphs.dead.collect()},
            "edges": {(r.taskNumber, r.prev, r.new): r for r in graphs.edges.collect()},
        }
    finally:
        spark.conf.unset("spark.lernspur.foldEvents")


def _visits(world, student):
    return [v for (s, _), v in sorted(world["visits"].items()) if s == student]


def test_visits(world):
    assert _visits(world, "one_way") == list("aaaaa")
    assert _visits(world, "back") == list("aaba")
    assert _visits(world, "null_between") == ["a", None, "a"]
    assert _visits(world, "null_first") == [None, "b"]
    assert _visits(world, "reset_null") == [None, "v1"]


def test_times(world):
    def times(s, a="a1"):
        r = world["attempts"][s, a]
        return r.total_time, r.pause_time, r.pause_time_ratio
    assert times("gaps") == (pytest.approx(309.999), None, None)
    assert times("long_pause") == (None, None, None)
    assert times("action_first") == (5.0, None, None)
    assert times("no_time") == (0.0, 0.0, None)
    assert times("pause") == (12.0, 4.0, pytest.approx(1 / 3))


def test_resets(world):
    seconds = lambda t: (t - START).total_seconds()
    a1, a2 = (world["attempts"]["reset_same", a] for a in ("a1", "a2"))
    assert (a1.clicked_reset_button, seconds(a1.end_time)) == (True, 0)
    assert (seconds(a2.start_time), a2.pause_time, a2.attempt_number) == (5, 4.0, 2)
    a1, a2 = (world["attempts"]["reset_other", a] for a in ("a1", "a2"))
    assert a1.clicked_reset_button
    assert (seconds(a2.start_time), a2.pause_time) == (9, None)
    last = world["attempts"]["reset_last", "a1"]
    assert (seconds(last.end_time), last.clicked_retry_button) == (0, True)
    assert world["attempts"]["reset_screen", "a1"].clicked_reset_button
    assert seconds(world["attempts"]["reset_null", "a1"].start_time) == 3
    assert ("empty_visit", "a1") not in world["attempts"]


def test_first_step(world):
    valid = {s: world["attempts"][s, "a1"].validity_first_step
             for s in ("mistake_step", "step_mistake", "gaps", "hint_only", "ties")}
    assert valid == {"mistake_step": False, "step_mistake": True, "gaps": True, "hint_only": None,
                     "ties": False}
    assert world["attempts"]["mistake_step", "a1"].num_shaking_errors == 1
    assert world["attempts"]["step_mistake", "a1"].num_snapping_errors == 1


def test_replays(world):
    # a1 is the first completed attempt by id; only a4 began after it.
    assert {a: world["attempts"]["replay", a].replay_attempt for a in ("a1", "a2", "a3", "a4")} == {
        "a1": False, "a2": False, "a3": False, "a4": True}
    p = world["problems"]["replay"]
    assert (p.num_attempts, p.num_replays, p.num_completed_attempts, p.num_incomplete) == (4, 1, 2, 2)
    assert (p.avg_stars, p.num_three_star, p.problem_completed) == (3.0, 2, True)


def test_null_totals_and_names(world):
    p = world["problems"]["long_pause"]
    assert (p.total_time_spent, p.avg_time_spent, p.avg_stars) == (0.0, None, None)
    assert world["attempts"]["names", "a1"].studentRef == "r1"


@pytest.mark.parametrize("student, states, actions, goal, odd", [
    ("undo_redo", "S > a > b", "to_a > to_b", False, False),
    ("step_clears", "S > a > c", "to_a > to_c", False, True),
    ("missing", "S > a > missing_node > x > b", "to_a > missing_action > missing_action > to_b", False, False),
    ("undo_missing", "S > a > missing_node > c", "to_a > missing_action > to_c", False, False),
    ("solved_empty", "G", "", True, False),
    ("commuted", "S > a > G", "to_a > to_g2", True, False),
    ("no_event", "S > a > G", "to_a > to_G", False, False),
    ("underflow", "S > a > b", "to_a > to_b", False, True),
    ("after_reset", "S > a", "to_a", False, False),
    ("ignored_reset", "S > a > b", "to_a > to_b", False, False),
])
def test_paths(world, student, states, actions, goal, odd):
    r = world["paths"][student, "a1"]
    assert (r.states, r.actions, r.reached_goal, r.path_anomaly) == (states, actions, goal, odd)


def test_lengths_and_dead_ends(world):
    assert [(t, r.optimal_length, r.problem_solved) for t, r in sorted(world["lengths"].items())] == [
        (1, 1, True), (2, 2, True), (3, None, False), (9, 1, True)]
    assert {n for t, s, n in world["dead"] if t == 2 and s == ""} == {"d"}
    assert {(s, n) for t, s, n in world["dead"] if t == 2 and s} == {("c2", "a")}
    assert not any(t == 3 for t, _, _ in world["dead"])
    e = world["edges"][2, "S", "a"]
    assert (e.attempt_count, e.math_trans_type, e.weight) == (3, "to_a", 1)
    assert world["edges"][1, "a", "missing_node"].weight == 10000


@pytest.mark.parametrize("student, attempt, expected", [
    ("c1", "a1", ("optimal", "optimal", False)),
    ("c2", "a1", ("incomplete", "dead_end", False)),
    ("c2", "a2", ("optimal", "optimal", False)),
    ("c3", "a1", ("dead_end", "incomplete", False)),
    ("c4", "a1", ("sub_optimal", "sub_optimal", False)),
    ("u", "a1", ("incomplete", "incomplete", False)),
    ("no_event", "a1", ("sub_optimal", "sub_optimal", False)),
    ("solved_empty", "a1", ("sub_optimal", "sub_optimal", False)),
    ("missing", "a1", (None, None, True)),
    ("hint_only", "a1", (None, None, None)),
])
def test_classes(world, student, attempt, expected):
    r = world["attempts"][student, attempt]
    assert (r.MFL_global_class, r.MFL_individual_class, r.missing_steps_in_logs) == expected


def test_attempt_table_has_all_columns(world):
    r = world["attempts"]["c1", "a1"]
    assert len(r.__fields__) == 32


def test_totals_agree(spark, data):
    from lernspur.plans.queries import QUERIES
    sp, sl = QUERIES["student_problem"](spark, data), QUERIES["student_level"](spark, data)
    assert sp.agg(F.sum("num_attempts")).first() == sl.agg(F.sum("total_attempts")).first()
    att_ = QUERIES["attempt_level"](spark, data)
    assert att_.where("pause_time > total_time").isEmpty()
    shuffled = rows(att_)
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        assert rows(QUERIES["attempt_level"](spark, data)) == shuffled
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
