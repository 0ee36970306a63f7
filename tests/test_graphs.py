"""Graphs built from given paths: shortest solutions and dead ends against plain search."""

import heapq
import random

import pytest

from lernspur.operators import graph as gr
from lernspur.operators import paths as pt
from lernspur.runtime import materialize

PATHS = ("studentSessionId string, taskNumber int, attemptHlc string, visitId string, started struct<timestamp:timestamp,seq:long>,"
         " states array<string>, actions array<string>, reached_goal boolean, path_anomaly boolean")


def graphs(spark, walks, ends=("S", "G")):
    """``walks``: (task, states) of one student each."""
    rows = [(f"s{i}", task, "a", "v", (None, i), states, ["op"] * (len(states) - 1), states[-1] == ends[1], False)
            for i, (task, states) in enumerate(walks)]
    tasks = spark.createDataFrame([(t, *ends) for t in sorted({t for t, _ in walks})],
                                  "taskNumber int, startState string, goalState string")
    short = spark.createDataFrame(rows, PATHS)
    return gr.ProblemGraphs(pt.Paths(short, None, materialize(tasks)).store())


def brute(walks, ends=("S", "G")):
    """(task -> (weight, hops) or None, edges on cheapest solutions, dead ends of whole tasks)."""
    best, edges, dead = {}, set(), set()
    for task in {t for t, _ in walks}:
        arcs = {(a, b) for t, w in walks if t == task for a, b in zip(w, w[1:])}
        nodes = {n for e in arcs for n in e}

        def costs(source, arcs):
            found, queue = {}, [((0, 0), source)]
            while queue:
                cost, node = heapq.heappop(queue)
                if node in found:
                    continue
                found[node] = cost
                for a, b in arcs:
                    if a == node:
                        weight = 10_000 if "missing_node" in (a, b) else 1
                        heapq.heappush(queue, ((cost[0] + weight, cost[1] + 1), b))
            return found

        there = costs(ends[0], arcs)
        back = costs(ends[1], {(b, a) for a, b in arcs})
        solved = ends[1] in nodes
        best[task] = there[ends[1]] if solved else None
        if solved:
            whole = there[ends[1]][0]
            edges |= {(task, a, b) for a, b in arcs if a in there and b in back
                      and there[a][0] + (10_000 if "missing_node" in (a, b) else 1) + back[b][0] == whole}
            dead |= {(task, n) for n in nodes if n != "missing_node" and n not in back}
    return best, edges, dead


def check(spark, walks, ends=("S", "G")):
    g = graphs(spark, walks, ends)
    best, edges, dead = brute(walks, ends)
    assert {r.taskNumber: (r.optimal_weight, r.optimal_length) if r.problem_solved else None for r in g.lengths.collect()} == best
    assert {(r.taskNumber, r.prev, r.new) for r in g.best_edges.collect()} == edges
    assert {(r.taskNumber, r.node) for r in g.dead.where("scope = ''").collect()} == dead
    return g


def test_random_walks(spark):
    rng = random.Random(4)
    walks = []
    for task in range(1, 7):
        for _ in range(12):
            states = ["S"]
            for _ in range(rng.randrange(1, 12)):
                state = f"n{rng.randrange(9)}"
                if rng.random() < 0.15 and states[-1] != "missing_node":
                    states.append("missing_node")
                states.append(state)
            if task != 6 and rng.random() < 0.4:
                states.append("G")
            walks.append((task, states))
    check(spark, walks)


def test_long_chains_take_few_rounds(spark, monkeypatch):
    """A solution of 800 steps, whose end is met sooner on another student's way."""
    chain = ["S", *[f"n{i}" for i in range(800)], "G"]
    walks = [(1, chain), (1, ["S", "n0", "n1", "lost"]), (1, ["S", "x1", "x2", "x3", "n790", "y"])]
    rounds = []
    stored = gr.materialize
    monkeypatch.setattr(gr, "materialize", lambda df: rounds.append(1) or stored(df))
    g = graphs(spark, walks)
    assert g.lengths.first().optimal_length == 4 + 9 + 1
    assert g.best_edges.count() == 14
    # Ten rounds go along what is left of the first way after it is met, none along the way to there.
    assert len(rounds) < 40


def test_paths_are_counted_where_they_meet(spark):
    """Each of eight forks doubles the number of solutions."""
    walks = []
    for side in "xy":
        walks.append((1, ["S", *[n for i in range(8) for n in (f"{side}{i}", f"m{i}")], "G"]))
    walks += [(2, ["S", "a"]), (3, ["S", "G"])]
    g = graphs(spark, walks)
    assert {r.taskNumber: int(r.num_paths) for r in gr.optimal_path_counts(g.best_edges, g.tasks).collect()} == {1: 256, 3: 1}
    assert gr.optimal_paths(g.best_edges, g.tasks).count() == 257


def test_start_is_goal(spark):
    check(spark, [(1, ["S", "a", "S"]), (1, ["S", "b"]), (1, ["S", "b", "c"])], ends=("S", "S"))


def test_errors_of_either_side_are_raised(spark, monkeypatch):
    g = graphs(spark, [(1, ["S", "G"])])
    g.edges

    def broken(*_):
        raise ValueError("broken")

    monkeypatch.setattr(gr, "dead_ends", broken)
    with pytest.raises(ValueError, match="broken"):
        g.prepare()
