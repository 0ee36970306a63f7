"""Transition graphs as edge tables, and what can be read off them.

A graph is a table of edges keyed by ``taskNumber`` and ``scope``: the scope is a student
for that student's own graph and ``ALL_STUDENTS`` for the graph of a whole task. Loops run
until nothing changes and store each round's new rows, never the whole graph again.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import cached_property, reduce

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, functions as F

from ..runtime import HOP_ROUNDS, join_lookup, materialize, rows_of, setting
from ..schemas import K4, MISSING_NODE, MISSING_WEIGHT, STEP_WEIGHT, STUDENT
from .paths import Paths, path_edges

ALL_STUDENTS = ""
SCOPE = ["taskNumber", "scope"]
NODE = [*SCOPE, "node"]


def _weight() -> Column:
    missing = F.col("prev").eqNullSafe(F.lit(MISSING_NODE)) | F.col("new").eqNullSafe(
        F.lit(MISSING_NODE)
    )
    return F.when(missing, MISSING_WEIGHT).otherwise(STEP_WEIGHT).cast("long")


# What only the search for shortest solutions and dead ends needs: see ``path_edges``.
SEEN = ["to_goal", "reach", "left"]
EDGE_COLUMNS = ["prev", "new", "attempt_count", "math_trans_type", "weight", *SEEN]
# "First" goes through students in id order, then through their attempts in time order.
FIRST_SEEN = f"struct({STUDENT}, started, attemptHlc, visitId, pos)"


def _edges(steps: DataFrame, *keys: str) -> DataFrame:
    return (
        steps.groupBy(*keys, "prev", "new")
        .agg(
            F.count(F.lit(1)).alias("attempt_count"),
            F.expr(f"min(struct({FIRST_SEEN} AS at, action))").alias("first_seen"),
            F.max("to_goal").alias("to_goal"), F.min("reach").alias("reach"), F.min("left").alias("left"),
        )
        .withColumns({"weight": _weight(), "math_trans_type": F.col("first_seen.action")})
    )


def transition_edges(steps: DataFrame) -> DataFrame:
    """Traversals per transition of a task and the action that was first seen on it.

    Counts are combined on the map side, so a popular transition travels as one row per
    map task.
    """
    return _edges(steps, "taskNumber").select("taskNumber", *EDGE_COLUMNS)


def student_edges(steps: DataFrame) -> DataFrame:
    """The same per student, in the student's own graph."""
    return _edges(steps, "taskNumber", STUDENT).select(
        "taskNumber", F.col(STUDENT).alias("scope"), *EDGE_COLUMNS, "first_seen")


def merge_student_edges(own: DataFrame) -> DataFrame:
    """Task edges from student edges, without going over the steps again."""
    return own.groupBy("taskNumber", "prev", "new").agg(
        F.sum("attempt_count").alias("attempt_count"),
        F.min("first_seen")["action"].alias("math_trans_type"),
        F.first("weight").alias("weight"),
        F.max("to_goal").alias("to_goal"), F.min("reach").alias("reach"), F.min("left").alias("left"),
    ).select("taskNumber", *EDGE_COLUMNS)


def retract_edges(edges: DataFrame, removed: DataFrame) -> DataFrame:
    """Take traversals back: ``removed`` holds transitions (taskNumber, prev, new), one row each.

    An edge whose count falls to zero goes, and so does the state it led to, with every
    other edge at that state.
    """
    keys = ["taskNumber", "prev", "new"]
    taken = removed.groupBy(*keys).agg(F.count(F.lit(1)).alias("_taken"))
    left = edges.join(taken, keys, "left").withColumn(
        "attempt_count", F.col("attempt_count") - F.coalesce("_taken", F.lit(0))
    )
    left = materialize(left.drop("_taken"))
    gone = materialize(
        left.where("attempt_count <= 0").select("taskNumber", F.col("new").alias("_gone")).distinct()
    )
    kept = left.where("attempt_count > 0")
    for end in ("prev", "new"):
        kept = join_lookup(kept, gone.withColumnRenamed("_gone", end), ["taskNumber", end],
                           "left_anti", rows_of(gone))
    return kept


# --- states that lead to the goal ---------------------------------------------------


def leads_to_goal(edges: DataFrame, steps: DataFrame, tasks: DataFrame) -> DataFrame:
    """All (scope, node) from which the goal can be reached within the scope's graph.

    ``edges`` is the stored edge table of all scopes. Paths that visit the goal settle most
    states without a join. The rest is found backwards, one transition per round; in a graph
    so deep that this takes long, whole attempts are walked instead. The goal leads to itself, also where it
    is the start.
    """
    ends = F.array("prev", "new")
    seeds = join_lookup(edges, tasks.select("taskNumber", "goalState"), ["taskNumber"], rows=rows_of(tasks)).select(
        *SCOPE, F.explode(F.when(F.col("to_goal"), ends).otherwise(
            F.filter(ends, lambda n: n == F.col("goalState")))).alias("node")
    ).distinct()
    frontier = materialize(seeds)
    found, open_edges = [frontier], edges.where("NOT to_goal").select(*SCOPE, "prev", "new")
    for round_ in range(setting(edges.sparkSession, HOP_ROUNDS)):
        # An edge whose tail leads to the goal has nothing more to say.
        size = rows_of(frontier)
        open_edges = join_lookup(
            open_edges, frontier.withColumnRenamed("node", "prev"), [*SCOPE, "prev"],
            "left_anti", size)
        if round_ % 8 == 0:
            open_edges = materialize(open_edges)
        hits = join_lookup(
            open_edges, frontier.withColumnRenamed("node", "new"), [*SCOPE, "new"],
            "left_semi", size)
        frontier = materialize(hits.select(*SCOPE, F.col("prev").alias("node")).distinct())
        if rows_of(frontier) == 0:
            return _union(found)
        found.append(frontier)
    return _lead_by_attempts(materialize(_union(found)), steps)


def _lead_by_attempts(found: DataFrame, steps: DataFrame) -> DataFrame:
    """As ``leads_to_goal``, a round going along whole attempts: if a state leads to the
    goal, so does every state before it in the same attempt, however far back."""
    walks = materialize(steps.select(*K4, "pos", "prev", "new").withColumn(
        "scope", F.explode(F.array(F.lit(ALL_STUDENTS), F.col(STUDENT)))
    ))
    while True:
        touched = join_lookup(
            walks, found.withColumnRenamed("node", "new"), [*SCOPE, "new"], "left_semi",
            rows_of(found))
        last = materialize(touched.groupBy(*K4, "scope").agg(F.max("pos").alias("_last")))
        before = join_lookup(walks, last, [*K4, "scope"]).where(F.col("pos") <= F.col("_last"))
        more = materialize(
            before.select(*SCOPE, F.col("prev").alias("node")).distinct()
            .join(found, NODE, "left_anti")
        )
        if rows_of(more) == 0:
            return found
        found = materialize(found.unionByName(more))


def _union(tables: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, tables)


def graph_nodes(edges: DataFrame) -> DataFrame:
    return edges.select(*SCOPE, F.explode(F.array("prev", "new")).alias("node")).distinct()


def dead_ends(edges: DataFrame, tasks: DataFrame, leading: DataFrame) -> DataFrame:
    """States with no way to the goal. A scope in which nobody met the goal has none.

    ``leading`` is ``leads_to_goal``. A missing state is never a dead end, but ways may
    pass through it. In a student's own graph start and goal are never dead ends either.
    """
    at_goal = join_lookup(leading, tasks, ["taskNumber"]).where("node = goalState")
    solved = materialize(at_goal.select(*SCOPE).distinct())
    nodes = join_lookup(
        graph_nodes(edges).where(F.col("node") != MISSING_NODE), solved, SCOPE, "left_semi"
    ).join(leading, NODE, "left_anti")
    own_end = f"scope != '{ALL_STUDENTS}' AND node IN (startState, goalState)"
    return join_lookup(nodes, tasks, ["taskNumber"]).where(f"NOT ({own_end})").select(*NODE)


# --- shortest solutions -------------------------------------------------------------


def _cheapest(costs: DataFrame) -> DataFrame:
    return costs.groupBy("taskNumber", "node").agg(F.min("cost").alias("cost"))


def _nothing() -> Column:
    return F.struct(F.lit(0).cast("long").alias("weight"), F.lit(0).cast("long").alias("hops"))


def _distances(arcs: DataFrame, seen: DataFrame, ends: DataFrame, bounds: DataFrame) -> DataFrame:
    """(taskNumber, node) -> ``cost(weight, hops)`` from any of ``ends`` along ``arcs`` (node, new); stored.

    What attempts were seen to need (``seen``) is where the search starts, so rounds are needed only where the cheapest
    way is put together from several attempts, however long it is. A round goes on from the nodes that became cheaper
    in the one before, in tasks of ``bounds``; no way longer than its task's ``_bound`` is followed, and costs beyond
    that are upper bounds.
    """
    size = rows_of(bounds)
    seen = join_lookup(seen.where("cost IS NOT NULL"), bounds.select("taskNumber"), ["taskNumber"], "left_semi", size)
    known = frontier = materialize(_cheapest(seen.unionByName(ends)))
    while True:
        near = join_lookup(frontier, bounds, ["taskNumber"], rows=size).where(
            "_bound IS NULL OR cost.weight <= _bound").drop("_bound")
        reached = _cheapest(join_lookup(arcs, near, ["taskNumber", "node"], rows=rows_of(frontier)).selectExpr(
            "taskNumber", "new AS node",
            "named_struct('weight', cost.weight + weight, 'hops', cost.hops + 1) AS cost"))
        better = materialize(
            reached.join(known.withColumnRenamed("cost", "_known"), ["taskNumber", "node"], "left")
            .where("_known IS NULL OR cost < _known").drop("_known"))
        if rows_of(better) == 0:
            return known
        frontier = better
        known = materialize(_cheapest(known.unionByName(better)))


def start_distances(edges: DataFrame, tasks: DataFrame) -> DataFrame:
    """Cheapest way from the start: (taskNumber, node) -> ``cost(weight, hops)``, in tasks that were solved.

    ``edges`` is the stored edge table of whole tasks. Costs are exact up to the goal's, and upper bounds beyond.
    """
    known = join_lookup(edges, tasks, ["taskNumber"], rows=rows_of(tasks))
    starts = known.where("prev = startState").select("taskNumber", F.col("prev").alias("node")).distinct()
    at_goal = F.when(F.col("new") == F.col("goalState"), F.col("reach.weight"))
    bounds = materialize(
        known.groupBy("taskNumber").agg(
            F.bool_or((F.col("new") == F.col("goalState")) | (F.col("startState") == F.col("goalState"))).alias("_solved"),
            F.min(at_goal).alias("_bound")).where("_solved").drop("_solved"))
    arcs = edges.select("taskNumber", F.col("prev").alias("node"), "new", "weight")
    seen = edges.select("taskNumber", F.col("new").alias("node"), F.col("reach").alias("cost"))
    ends = join_lookup(starts, bounds.select("taskNumber"), ["taskNumber"], "left_semi", rows_of(bounds))
    return _distances(arcs, seen, ends.withColumn("cost", _nothing()), bounds)


def goal_distances(edges: DataFrame, lengths: DataFrame, tasks: DataFrame) -> DataFrame:
    """Cheapest way on to the goal, as :func:`start_distances`; ``lengths`` is ``optimal_lengths``, stored."""
    bounds = materialize(lengths.where("problem_solved").select("taskNumber", F.col("optimal_weight").alias("_bound")))
    arcs = edges.select("taskNumber", F.col("new").alias("node"), F.col("prev").alias("new"), "weight")
    seen = edges.select("taskNumber", F.col("prev").alias("node"), F.col("left").alias("cost"))
    ends = join_lookup(tasks.select("taskNumber", F.col("goalState").alias("node")), bounds.select("taskNumber"),
                       ["taskNumber"], "left_semi", rows_of(bounds))
    return _distances(arcs, seen, ends.withColumn("cost", _nothing()), bounds)


def optimal_lengths(distances: DataFrame, tasks: DataFrame) -> DataFrame:
    """Per task: weight and number of transitions of a cheapest solution, null if unsolved."""
    goals = tasks.select("taskNumber", F.col("goalState").alias("node"))
    return goals.join(distances, ["taskNumber", "node"], "left").selectExpr(
        "taskNumber", "cost.weight AS optimal_weight", "cost.hops AS optimal_length",
        "cost IS NOT NULL AS problem_solved",
    )


def best_path_edges(edges: DataFrame, distances: DataFrame, back: DataFrame, lengths: DataFrame) -> DataFrame:
    """Edges lying on any cheapest solution: the ways to and from them add up to its weight."""
    def cost(costs, name, end):
        return costs.selectExpr("taskNumber", f"node AS {end}", f"cost.weight AS {name}")

    solved = lengths.where("problem_solved").select("taskNumber", "optimal_weight")
    on_way = join_lookup(edges.drop(*SEEN), solved, ["taskNumber"], rows=rows_of(lengths))
    on_way = join_lookup(on_way, cost(distances, "_from", "prev"), ["taskNumber", "prev"], rows=rows_of(distances))
    on_way = join_lookup(on_way.where("_from + weight <= optimal_weight"), cost(back, "_to", "new"),
                         ["taskNumber", "new"], rows=rows_of(back))
    return materialize(on_way.where("_from + weight + _to = optimal_weight").drop("_from", "_to", "optimal_weight"))


def best_path_nodes(best_edges: DataFrame, tasks: DataFrame) -> DataFrame:
    """States strictly inside a cheapest solution, the missing state left out."""
    nodes = best_edges.select("taskNumber", F.explode(F.array("prev", "new")).alias("node")).distinct()
    ends = F.col("node").isin(F.col("startState"), F.col("goalState"), F.lit(MISSING_NODE))
    return join_lookup(nodes, tasks, ["taskNumber"]).where(~ends).select("taskNumber", "node")


def optimal_path_counts(best_edges: DataFrame, tasks: DataFrame) -> DataFrame:
    """(taskNumber, num_paths): how many cheapest solutions each solved task has, without writing any down.

    Ways that meet at a state are added up, so a round has a row for each state at most, while the paths themselves
    can double with every step. null beyond 38 digits.
    """
    arcs = best_edges.select("taskNumber", F.col("prev").alias("node"), "new")
    n_tasks, goals = rows_of(tasks), tasks.select("taskNumber", F.col("goalState").alias("node"))
    starts = tasks.select("taskNumber", F.col("startState").alias("node")).join(
        arcs.select("taskNumber", "node").distinct(), ["taskNumber", "node"], "left_semi")
    now = materialize(starts.withColumn("ways", F.lit(1).cast("decimal(38,0)")))
    done = []
    while rows_of(now) > 0:
        grown = materialize(
            join_lookup(arcs, now, ["taskNumber", "node"]).groupBy("taskNumber", F.col("new").alias("node"))
            .agg(F.try_sum("ways").cast("decimal(38,0)").alias("ways")))
        done.append(join_lookup(grown, goals, ["taskNumber", "node"], "left_semi", n_tasks))
        now = materialize(join_lookup(grown, goals, ["taskNumber", "node"], "left_anti", n_tasks))
    if not done:
        return now.select("taskNumber", F.col("ways").alias("num_paths"))
    return _union(done).groupBy("taskNumber").agg(F.try_sum("ways").cast("decimal(38,0)").alias("num_paths"))


def optimal_paths(best_edges: DataFrame, tasks: DataFrame) -> DataFrame:
    """Every cheapest solution of every task, as an array of states.

    There can be very many: ask :func:`optimal_path_counts` first. The edges alone (``best_edges``) lose nothing.
    """
    arcs = best_edges.select("taskNumber", F.col("prev").alias("_last"), "new")
    goals, n_tasks = tasks.select("taskNumber", "goalState"), rows_of(tasks)
    starts = tasks.select("taskNumber", F.col("startState").alias("_last")).join(
        arcs.select("taskNumber", "_last").distinct(), ["taskNumber", "_last"], "left_semi")
    walks = materialize(starts.withColumn("path", F.array("_last")))
    done = []
    while rows_of(walks) > 0:
        grown = walks.join(arcs, ["taskNumber", "_last"]).select(
            "taskNumber", F.col("new").alias("_last"), F.concat("path", F.array("new")).alias("path"))
        grown = materialize(join_lookup(grown, goals, ["taskNumber"], rows=n_tasks))
        done.append(grown.where(F.col("_last") == F.col("goalState")).select("taskNumber", "path"))
        walks = materialize(grown.where(F.col("_last") != F.col("goalState")).drop("goalState"))
    if not done:
        return walks.select("taskNumber", "path")
    return _union(done)


# --- export -------------------------------------------------------------------------


def graph_links(edges: DataFrame, best_edges: DataFrame) -> DataFrame:
    """Edge rows of a node-link export, with ``is_best_path``."""
    marks = best_edges.select("taskNumber", "prev", "new", F.lit(True).alias("is_best_path"))
    return edges.join(marks, ["taskNumber", "prev", "new"], "left").select(
        "taskNumber", F.col("prev").alias("source"), F.col("new").alias("target"),
        "attempt_count", "math_trans_type", "weight",
        F.coalesce("is_best_path", F.lit(False)).alias("is_best_path"),
    )


def graph_node_flags(edges: DataFrame, best_nodes: DataFrame, dead: DataFrame) -> DataFrame:
    """Node rows of a node-link export; ``edges`` and ``dead`` are scoped."""
    whole = F.col("scope") == ALL_STUDENTS
    key = ["taskNumber", "node"]
    return (
        graph_nodes(edges.where(whole)).drop("scope")
        .join(best_nodes.select(*key, F.lit(True).alias("in_best_path")), key, "left")
        .join(dead.where(whole).select(*key, F.lit(True).alias("is_dead_end")), key, "left")
        .select(*key, *[F.coalesce(c, F.lit(False)).alias(c) for c in ("in_best_path", "is_dead_end")])
    )


def graph_json(links: DataFrame, nodes: DataFrame) -> DataFrame:
    """Node-link JSON, one element per row: ``part`` is ``nodes`` or ``links``.

    A task's graph can be larger than one row may be, so a document is the concatenation
    of its rows and is assembled by whoever reads it.
    """
    node = F.struct(F.col("node").alias("id"), "in_best_path", "is_dead_end")
    link = F.struct("attempt_count", "math_trans_type", "weight", "is_best_path", "source", "target")
    return nodes.select(
        "taskNumber", F.lit("nodes").alias("part"), F.to_json(node).alias("element")
    ).unionByName(links.select(
        "taskNumber", F.lit("links").alias("part"), F.to_json(link).alias("element")))


class ProblemGraphs:
    """The graphs of a log with everything derived from them, each computed once on demand."""

    def __init__(self, paths: Paths):
        self.paths = paths
        self.tasks = paths.tasks

    def prepare(self) -> None:
        """Work out dead ends and shortest lengths side by side; neither needs the other."""
        self.edges  # both start from here
        spark = self.edges.sparkSession
        with ThreadPoolExecutor(2) as pool:
            both = [pool.submit(inheritable_thread_target(spark)(lambda name=name: getattr(self, name)))
                    for name in ("dead", "lengths")]
        for one in both:
            one.result()  # raises what was raised there

    @cached_property
    def steps(self) -> DataFrame:
        return path_edges(self.paths)

    @cached_property
    def own_edges(self) -> DataFrame:
        return materialize(student_edges(self.steps))

    @cached_property
    def edges(self) -> DataFrame:
        return materialize(merge_student_edges(self.own_edges))

    @cached_property
    def scoped(self) -> DataFrame:
        whole = self.edges.withColumn("scope", F.lit(ALL_STUDENTS))
        return self.own_edges.drop("first_seen").unionByName(whole)

    @cached_property
    def leading(self) -> DataFrame:
        return leads_to_goal(self.scoped, self.steps, self.tasks)

    @cached_property
    def dead(self) -> DataFrame:
        return materialize(dead_ends(self.scoped, self.tasks, self.leading))

    @cached_property
    def distances(self) -> DataFrame:
        return start_distances(self.edges, self.tasks)

    @cached_property
    def lengths(self) -> DataFrame:
        return materialize(optimal_lengths(self.distances, self.tasks))

    @cached_property
    def back(self) -> DataFrame:
        return goal_distances(self.edges, self.lengths, self.tasks)

    @cached_property
    def best_edges(self) -> DataFrame:
        return best_path_edges(self.edges, self.distances, self.back, self.lengths)

    @cached_property
    def best_nodes(self) -> DataFrame:
        return best_path_nodes(self.best_edges, self.tasks)
