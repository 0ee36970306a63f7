"""Hot groups and long attempts take other ways to the same rows."""

import os

import pytest
from pyspark.sql import functions as F

from tests.helpers import rows
from lernspur.operators import attempts as att
from lernspur.operators import graph as gr
from lernspur.operators import paths as pt
from lernspur.operators import visits
from lernspur.operators.ordered import (
    SEGMENT, First, Following, Lanes, LastSeen, Previous, RunningMin, RunningSum, Whole,
)
from lernspur.plans.queries import QUERIES
from lernspur.runtime import join_lookup, materialize
from lernspur.sources.clickstream import clickstream_lanes, clickstream_tasks


def _skewed(spark):
    """One key owns most rows; ties in time, nulls, and a null key."""
    return spark.range(400).selectExpr(
        "if(id % 10 = 0, NULL, if(id % 4 = 0, 'b', 'a')) AS k",
        "if(id % 7 = 0, NULL, cast(id % 3 AS string)) AS sub",
        "cast(id div 3 AS long) AS timestamp", "id AS seq",
        "if(id % 5 = 0, NULL, (id * 7919) % 101) AS v", "(id * 31) % 17 - 8 AS w",
    )


def _specs():
    return (
        Previous("prev", F.col("v")), Following("next", F.struct("v", "seq")),
        RunningSum("sum", F.col("w")), RunningMin("low", F.col("v")), LastSeen("seen", F.col("v")),
        Whole("max", F.col("v")), Whole("total", F.col("w"), F.sum), First("first", F.col("v")),
    )


@pytest.mark.parametrize("keys", [["k"], ["k", "sub"]])
def test_segmented_windows_equal_plain_windows(spark, settings, keys):
    order = ["timestamp", "seq"]
    df = _skewed(spark)
    plain = Lanes.split(df, "k", ["k", *order])
    assert plain.hot is None
    settings(hotGroupRows=50)
    hot = Lanes.split(df, "k", ["k", *order])
    assert hot.hot.select(SEGMENT).distinct().count() > 5
    assert rows(plain.ordered(keys, order, *_specs()).merge()) == rows(
        hot.ordered(keys, order, *_specs()).merge())


def test_hot_rows_leave_the_plain_lane(spark, settings):
    settings(hotGroupRows=50)
    lanes = Lanes.split(_skewed(spark), "k", ["k", "timestamp", "seq"])
    assert lanes.plain.groupBy("k").count().where("count > 50").isEmpty()
    largest = lanes.hot.groupBy(SEGMENT).count().agg(F.max("count")).first()[0]
    assert largest <= 50


QUERIES_WITH_GROUPS = [
    "event_log", "reset_reassign", "attempt_level", "assignment_level", "attempt_paths",
    "classify_attempts",
]


@pytest.fixture(scope="module")
def usual(spark, data):
    return {n: rows(QUERIES[n](spark, data)) for n in QUERIES_WITH_GROUPS}


@pytest.mark.parametrize("name", QUERIES_WITH_GROUPS)
def test_hot_students(spark, data, settings, usual, name):
    settings(hotGroupRows=65, broadcastRows=20)
    assert rows(QUERIES[name](spark, data)) == usual[name]


@pytest.mark.parametrize("limit, hot", [(0, 10_000), (3, 65)])
def test_long_attempts(spark, data, settings, usual, limit, hot):
    """Paths found with windows equal folded paths, in hot groups too."""
    settings(foldEvents=limit, hotGroupRows=hot)
    for name in ("attempt_paths", "classify_attempts"):
        assert rows(QUERIES[name](spark, data)) == usual[name]


def test_long_paths_are_cut_into_pieces(spark, data, settings, usual, monkeypatch):
    settings(foldEvents=0)
    monkeypatch.setattr(pt, "STATES_PER_ROW", 2)
    cut = rows(QUERIES["attempt_paths"](spark, data))
    settings(foldEvents=10_000)
    folded = QUERIES["attempt_paths"](spark, data)
    assert folded.where("piece > 0").count() > 0
    assert rows(folded) == cut
    whole = (
        folded.groupBy("studentSessionId", "taskNumber", "attemptHlc", "visitId", "num_states")
        .agg(F.array_sort(F.collect_list(F.struct("piece", "states", "actions"))).alias("p"))
        .select("studentSessionId", "taskNumber", "attemptHlc", "visitId", "num_states",
                F.concat_ws(" > ", "p.states").alias("states"),
                F.concat_ws(" > ", F.filter(F.col("p.actions"), lambda a: a != "")).alias("actions"))
    )
    monkeypatch.undo()
    assert rows(whole) == rows(QUERIES["attempt_paths"](spark, data).select(*whole.columns))


def test_useless_redos_take_no_rounds(spark, settings, monkeypatch):
    """An attempt with hundreds of redos that have nothing to redo is settled by the first guess."""
    settings(foldEvents=0)
    kinds = ["mathStep", "mathStep", *["redo"] * 120, "undo", "redo", "redo", "redo", "mathStep", "undo", "undo", "redo", "solvedTask"]
    events = [("s", 1, "a", "v", i, k, f"n{i - 1}" if i in (1,) else "S" if i == 0 else "n1", f"n{i}" if k == "mathStep" else None, "op")
              for i, k in enumerate(kinds)]
    df = spark.createDataFrame(
        events, "studentSessionId string, taskNumber int, attemptHlc string, visitId string, seq long, eventType string,"
        " oldState string, newState string, actionName string").withColumn("timestamp", F.timestamp_seconds("seq"))
    tasks = spark.createDataFrame([(1, "S", "G")], "taskNumber int, startState string, goalState string")
    rounds = []
    depths = pt._stack_depths
    monkeypatch.setattr(pt, "_stack_depths", lambda moves: rounds.append(1) or depths(moves))
    lanes = Lanes.split(df, "studentSessionId", ["studentSessionId", "timestamp", "seq"])
    walked = rows(pt.path_rows(pt.attempt_paths(lanes, tasks)))
    assert len(rounds) == 1
    settings(foldEvents=1_000)
    assert walked == rows(pt.path_rows(pt.attempt_paths(lanes, tasks)))


def test_shared_log_is_not_shuffled_again(spark, data):
    """Both branches of the attempt table reuse the buckets of the stored log."""
    lanes = visits.normalize_visits(clickstream_lanes(spark.read.parquet(f"{data}/events.parquet")))
    shared = lanes.share("studentSessionId")
    tables = [att.attempt_lanes(visits.attempt_events(shared)).plain, pt.path_events(shared).plain,
              pt.attempt_paths(pt.path_events(shared), clickstream_tasks(spark)).short]
    for df in tables:
        assert _exchanges(df) == 0
    assert rows(tables[0]) == rows(att.attempt_lanes(visits.attempt_events(lanes)).plain)
    path = shared.plain.__dict__["_lernspur_path"]
    assert os.path.isdir(path.removeprefix("file:"))
    shared.discard()
    assert not os.path.isdir(path.removeprefix("file:"))


def _paths(spark, data, settings, limit):
    settings(foldEvents=limit)
    lanes = clickstream_lanes(spark.read.parquet(f"{data}/events.parquet"))
    return pt.attempt_paths(pt.path_events(visits.normalize_visits(lanes)), clickstream_tasks(spark))


@pytest.mark.parametrize("rounds", [0, 1])
def test_deep_graphs(spark, data, settings, rounds):
    """Walking whole attempts finds the same states as going edge by edge."""
    graphs = gr.ProblemGraphs(_paths(spark, data, settings, 1000).store())
    expected = rows(graphs.leading)
    settings(hopRounds=rounds)
    assert rows(gr.leads_to_goal(graphs.scoped, graphs.steps, graphs.tasks)) == expected


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_lookup_beyond_the_broadcast_bound(spark, settings, how):
    big = _skewed(spark)
    small = materialize(spark.createDataFrame([("a", 1), ("c", 2)], "k string, x int"))
    expected = rows(big.join(small, "k", how))
    settings(broadcastRows=1, hotGroupRows=50)
    joined = join_lookup(big, small, ["k"], how)
    assert rows(joined.select(*big.columns, *(["x"] if "x" in joined.columns else []))) == expected


def _exchanges(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.count("Exchange hashpartitioning")


@pytest.mark.parametrize("name", ["attempt_level", "student_problem", "student_level"])
def test_one_shuffle_from_events_to_students(spark, data, name):
    df = QUERIES[name](spark, data)
    assert _exchanges(df) == 1
    assert "Python" not in df._jdf.queryExecution().executedPlan().toString()


def test_scan_reads_only_needed_columns(spark, data):
    plan = QUERIES["student_level"](spark, data)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,event_type:string,props:string>" in plan
