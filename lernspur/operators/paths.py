"""Solution paths: the states an attempt-visit ends up having walked through.

Steps push states, undo takes the last one back, redo restores it. Ordinary attempts are
folded with one higher-order ``aggregate`` over their sorted events. That array grows with
the attempt, so attempts beyond ``spark.lernspur.foldEvents`` events are solved with
windows instead: depth on the stack is a running sum, and the state on top at some depth is
the latest one pushed there. Both ways give the same rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from ..runtime import FOLD_EVENTS, join_lookup, materialize, rows_of, setting
from ..schemas import (
    EVENT_ORDER, K4, MISSING_ACTION, MISSING_NODE, MISSING_WEIGHT, NO_PATH_EVENTS, NO_PATH_RESET_REASONS, STEP_WEIGHT,
)
from .ordered import Lanes, LastSeen, Previous, RunningMin, RunningSum, Whole, at
from .visits import drop_empty_visits

# A path is one row; a longer one is exported in pieces of this many states.
STATES_PER_ROW = 5_000

MOVES = ("mathStep", "undo", "redo")
ENDINGS = ("solvedTask", "resetTask")


def path_events(normalized: Lanes) -> Lanes:
    """Events that shape the path. Attempt ids are the logged ones: resets stay in place."""
    lanes = drop_empty_visits(normalized)
    ignored_reset = (F.col("eventType") == "resetTask") & F.coalesce(
        F.col("reason").isin(*NO_PATH_RESET_REASONS), F.lit(False)
    )
    return lanes.map(
        lambda df: df.where(~F.col("eventType").isin(*NO_PATH_EVENTS) & ~ignored_reset)
    ).store()


@dataclass(frozen=True)
class Paths:
    """``short``: one row per attempt-visit with arrays ``states`` and ``actions``.

    ``long``: the rest, one row per state (``pos``, ``state``, ``action`` leading to it).
    Both carry the keys, ``started`` (first event), ``reached_goal`` and ``path_anomaly``.
    """

    short: DataFrame
    long: DataFrame | None
    tasks: DataFrame

    def store(self) -> Paths:
        return Paths(
            materialize(self.short),
            None if self.long is None else materialize(self.long),
            self.tasks,
        )


def _texts(*values) -> Column:
    return F.array(*values).cast("array<string>")


def _empty() -> Column:
    return F.array().cast("array<string>")


def _fold(events: Column, start: Column, goal: Column) -> Column:
    """Walk the sorted events; the accumulator is the state, action and undo stacks."""
    initial = F.struct(
        _texts(start).alias("states"),
        _empty().alias("actions"),
        _empty().alias("undone_states"),
        _empty().alias("undone_actions"),
        F.lit(False).alias("finished"),
        F.lit(False).alias("reached"),
        F.lit(False).alias("anomaly"),
    )

    def changed(acc, **fields):
        names = ("states", "actions", "undone_states", "undone_actions", "finished", "reached",
                 "anomaly")
        return F.struct(*[fields.get(n, acc[n]).alias(n) for n in names])

    def without_last(a):
        return F.slice(a, F.lit(1), F.size(a) - 1)

    def merge(acc, e):
        kind = e["eventType"]
        last = F.element_at(acc["states"], -1)
        unseen = ~last.eqNullSafe(F.lit(MISSING_NODE)) & ~last.eqNullSafe(e["oldState"])
        step = changed(
            acc,
            states=F.concat(acc["states"], F.when(
                unseen, _texts(F.lit(MISSING_NODE), e["oldState"], e["newState"])
            ).otherwise(_texts(e["newState"]))),
            actions=F.concat(acc["actions"], F.when(
                unseen, _texts(F.lit(MISSING_ACTION), F.lit(MISSING_ACTION), e["actionName"])
            ).otherwise(_texts(e["actionName"]))),
            undone_states=_empty(),
            undone_actions=_empty(),
        )
        undo = changed(
            acc,
            states=without_last(acc["states"]),
            actions=without_last(acc["actions"]),
            undone_states=F.concat(acc["undone_states"], _texts(last)),
            undone_actions=F.concat(
                acc["undone_actions"], _texts(F.element_at(acc["actions"], -1))),
        )
        redo = changed(
            acc,
            states=F.concat(acc["states"], _texts(F.element_at(acc["undone_states"], -1))),
            actions=F.concat(acc["actions"], _texts(F.element_at(acc["undone_actions"], -1))),
            undone_states=without_last(acc["undone_states"]),
            undone_actions=without_last(acc["undone_actions"]),
        )
        solved = changed(
            acc,
            states=F.concat(without_last(acc["states"]), _texts(goal)),
            finished=F.lit(True),
            reached=F.lit(True),
        )
        can_undo = F.size(acc["states"]) > 1
        can_redo = F.size(acc["undone_states"]) > 0
        return (
            F.when(acc["finished"], acc)
            .when(kind == "mathStep", step)
            .when(kind == "solvedTask", solved)
            .when(kind == "resetTask", changed(acc, finished=F.lit(True)))
            .when((kind == "undo") & can_undo, undo)
            .when((kind == "redo") & can_redo, redo)
            .when(kind.isin("undo", "redo"), changed(acc, anomaly=F.lit(True)))
            .otherwise(acc)
        )

    return F.aggregate(events, initial, merge)


def _fold_attempts(events: DataFrame, tasks: DataFrame) -> DataFrame:
    event = F.struct(*EVENT_ORDER, "eventType", "oldState", "newState", "actionName")
    grouped = events.groupBy(*K4).agg(F.array_sort(F.collect_list(event)).alias("events"))
    folded = join_lookup(grouped, tasks, ["taskNumber"]).withColumn(
        "f", _fold(F.col("events"), F.col("startState"), F.col("goalState"))
    )
    return folded.select(
        *K4,
        F.struct(*[F.col("events")[0][c].alias(c) for c in EVENT_ORDER]).alias("started"),
        F.col("f.states").alias("states"),
        F.col("f.actions").alias("actions"),
        F.col("f.reached").alias("reached_goal"),
        F.col("f.anomaly").alias("path_anomaly"),
    )


def _stack_depths(moves: Lanes) -> Lanes:
    """Depth after each move for the sizes in ``_inc``; undo at the bottom does nothing."""
    lanes = moves.ordered(K4, EVENT_ORDER, RunningSum("_sum", F.col("_inc")))
    lanes = lanes.ordered(K4, EVENT_ORDER, RunningMin("_low", F.col("_sum")))
    lanes = lanes.map(
        lambda df: df.withColumn("_depth", F.col("_sum") - F.least(F.col("_low"), F.lit(0)))
    )
    is_step = F.col("eventType") == "mathStep"
    lanes = lanes.ordered(
        K4, EVENT_ORDER,
        LastSeen("_top_now", F.when(is_step, F.col("_depth"))),
        Previous("_depth_before", F.col("_depth")),
    )
    # Depth of the latest step before this move: as far as redo can go.
    return lanes.ordered(K4, EVENT_ORDER, Previous("_reach", F.col("_top_now"))).map(
        lambda df: df.withColumns({
            "_depth_before": F.coalesce("_depth_before", F.lit(0)),
            "_reach": F.coalesce("_reach", F.lit(0)),
        }).drop("_sum", "_low", "_top_now")
    )


def _pushes(df: DataFrame) -> DataFrame:
    """One row per state pushed by a step: ``_at`` its depth, ``_kind`` 1 after all reads."""
    def push(back, state, action):
        return F.struct(
            (F.col("_depth") - back).alias("_at"), state.alias("state"), action.alias("action"))

    own = push(0, F.col("newState"), F.col("actionName"))
    missing = F.lit(MISSING_ACTION)
    pushed = F.when(F.col("_inc") == 1, F.array(own)).otherwise(F.array(
        push(2, F.lit(MISSING_NODE), missing), push(1, F.col("oldState"), missing), own))
    return df.where(F.col("eventType") == "mathStep").withColumn("_p", F.explode(pushed)).select(
        "*", F.col("_p._at").alias("_at"), F.struct("_p.state", "_p.action").alias("_pushed"),
        F.lit(1).alias("_kind"),
    ).drop("_p")


def _with_top(moves: Lanes) -> Lanes:
    """``_top``: the state each step found on the stack, the latest push at that depth."""
    def reads(df):
        return df.where(F.col("eventType") == "mathStep").withColumns({
            "_at": F.col("_depth_before"), "_kind": F.lit(0),
            "_pushed": F.lit(None).cast("struct<state:string,action:string>"),
        })

    order = [*EVENT_ORDER, "_kind"]
    lanes = moves.map(lambda df: reads(df).unionByName(_pushes(df))).ordered(
        [*K4, "_at"], order, LastSeen("_top", F.col("_pushed"))
    )
    return lanes.map(lambda df: df.where(F.col("_kind") == 0).drop("_at", "_kind", "_pushed"))


def _settle(moves: Lanes) -> Lanes:
    """Find, for each move, how much it really adds to the stack.

    A step adds three states instead of one when its old state is not on top, and a redo
    adds nothing when nothing was undone; both depend on the moves before. Starting from
    a local guess, all moves are re-judged against the stack that the current guess
    implies, until nothing changes. The first wrong move of an attempt is always judged
    correctly, so the loop ends with the only consistent answer.
    """
    kind = F.col("eventType")
    moves = moves.ordered(
        K4, EVENT_ORDER, Previous("_prior", F.struct("eventType", "newState")),
        RunningSum("_turn", F.when(kind == "mathStep", 1).otherwise(0).cast("long")),
    )
    # What is undone since the last step: undo adds one, redo takes one away down to none. Right for all attempts
    # that never undo at the bottom of the stack, however many redos are useless.
    turn, undone = [*K4, "_turn"], F.when(kind == "undo", 1).when(kind == "redo", -1).otherwise(0).cast("long")
    moves = moves.ordered(turn, EVENT_ORDER, RunningSum("_undone", undone))
    moves = moves.ordered(turn, EVENT_ORDER, RunningMin("_least", F.col("_undone")))
    moves = moves.ordered(turn, EVENT_ORDER, Previous(
        "_open", F.col("_undone") - F.least(F.col("_least"), F.lit(0))))
    found = F.when(F.col("_prior").isNull(), F.col("startState")).when(
        F.col("_prior.eventType") == "mathStep", F.col("_prior.newState")
    ).otherwise(F.col("oldState"))
    guess = (
        F.when(kind == "undo", -1).when(kind == "redo", F.when(F.col("_open") > 0, 1).otherwise(0))
        .when(found.eqNullSafe(F.col("oldState")), 1).otherwise(3)
    )
    moves = moves.map(lambda df: df.withColumn("_inc", guess.cast("long")).drop(
        "_prior", "_turn", "_undone", "_least", "_open")).store_all()
    while True:
        placed = _stack_depths(moves).store()
        step = (
            F.when(F.col("_depth_before") == 0, F.col("startState")).otherwise(F.col("_top.state"))
        )
        unseen = ~step.eqNullSafe(F.lit(MISSING_NODE)) & ~step.eqNullSafe(F.col("oldState"))
        steps = _with_top(placed).map(
            lambda df: df.withColumn("_new", F.when(unseen, 3).otherwise(1).cast("long")).drop("_top")
        )
        can_redo = F.col("_depth_before") < F.col("_reach")
        others = placed.map(lambda df: df.where(kind != "mathStep").withColumn(
            "_new",
            F.when(kind == "undo", -1).when(can_redo, 1).otherwise(0).cast("long"),
        ))
        judged = steps.union(others).store_all()
        if judged.map(lambda df: df.where("_inc != _new")).is_empty():
            return judged.map(lambda df: df.drop("_new"))
        moves = judged.map(
            lambda df: df.withColumn("_inc", F.col("_new"))
            .drop("_new", "_depth", "_depth_before", "_reach")
        )


def _walk_attempts(events: Lanes, tasks: DataFrame) -> DataFrame:
    """Long attempts, one row per state, without holding an attempt in one row or task."""
    ending = F.when(F.col("eventType").isin(*ENDINGS), F.struct(*EVENT_ORDER, "eventType"))
    lanes = events.ordered(
        K4, EVENT_ORDER, Whole("_end", ending, F.min), Whole("started", at(EVENT_ORDER), F.min)
    ).map(lambda df: join_lookup(df, tasks, ["taskNumber"])).store_all()
    before_end = F.col("_end").isNull() | (
        at(EVENT_ORDER) < F.struct(*[F.col("_end")[c] for c in EVENT_ORDER])
    )
    moves = _settle(lanes.map(
        lambda df: df.where(F.col("eventType").isin(*MOVES) & before_end).drop("_end")))

    no_effect = (
        (F.col("eventType") == "undo") & (F.col("_depth_before") == 0)
    ) | ((F.col("eventType") == "redo") & (F.col("_inc") == 0))
    totals = moves.aggregate(
        K4,
        F.max_by("_depth", at(EVENT_ORDER)).alias("_final"),
        F.bool_or(no_effect).alias("path_anomaly"),
    ).merge()
    attempts = (
        lanes.aggregate(
            K4,
            F.first("started").alias("started"),
            F.first("startState").alias("_start"),
            F.first("goalState").alias("_goal"),
            (F.first("_end.eventType") == "solvedTask").alias("_solved"),
        )
        .merge()
        .join(totals, K4, "left")
        .select(
            *K4, "started", "_start", "_goal",
            F.coalesce("_solved", F.lit(False)).alias("reached_goal"),
            F.coalesce("path_anomaly", F.lit(False)).alias("path_anomaly"),
            F.coalesce("_final", F.lit(0)).alias("_final"),
        )
    )
    attempts = materialize(attempts)
    stack = (
        moves.map(_pushes)
        .aggregate([*K4, "_at"], F.max_by("_pushed", at(EVENT_ORDER)).alias("_pushed"))
        .merge()
    )
    stack = join_lookup(stack, attempts, K4).where(F.col("_at") <= F.col("_final")).withColumns(
        {"pos": F.col("_at"), "state": F.col("_pushed.state"), "action": F.col("_pushed.action")})
    bottom = attempts.withColumns(
        {"pos": F.lit(0).cast("long"), "state": F.col("_start"), "action": F.lit(None).cast("string")})
    columns = [*K4, "started", "reached_goal", "path_anomaly", "pos", "action",
               (F.col("_final") + 1).alias("num_states"),
               F.when(F.col("reached_goal") & (F.col("pos") == F.col("_final")), F.col("_goal"))
               .otherwise(F.col("state")).alias("state")]
    return bottom.select(*columns).unionByName(stack.select(*columns))


def attempt_paths(events: Lanes, tasks: DataFrame) -> Paths:
    """Rebuild the path of every attempt-visit from its ``path_events``."""
    spark = events.plain.sparkSession
    limit = setting(spark, FOLD_EVENTS)
    tasks = materialize(tasks.select("taskNumber", "startState", "goalState"))
    if events.largest <= limit:  # no student has that many events, so no attempt has
        return Paths(_fold_attempts(events.merge(), tasks), None, tasks)
    sized = events.ordered(K4, EVENT_ORDER, Whole("_n", F.lit(1), F.sum))
    short = sized.map(lambda df: df.where(F.col("_n") <= limit).drop("_n")).merge()
    long = sized.map(lambda df: df.where(F.col("_n") > limit).drop("_n")).store_all()
    walked = None if long.is_empty() else _walk_attempts(long, tasks)
    return Paths(_fold_attempts(short, tasks), walked, tasks)


def path_rows(paths: Paths) -> DataFrame:
    """Paths as text, at most ``STATES_PER_ROW`` states per row; ``piece`` numbers the rows.

    The rows do not depend on how a path was found.
    """
    def text(array):
        return F.concat_ws(" > ", F.transform(array, lambda s: F.coalesce(s, F.lit("null"))))

    size, place = STATES_PER_ROW, F.col("piece").cast("int") * STATES_PER_ROW
    rows = paths.short.withColumn(
        "piece", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.size("states") - 1) / size))),
    ).select(
        *K4, "piece", F.size("states").cast("long").alias("num_states"),
        text(F.slice("states", place + 1, F.lit(size))).alias("states"),
        text(F.slice("actions", F.greatest(place, F.lit(1)), F.when(place == 0, size - 1).otherwise(size))).alias("actions"),
        "reached_goal", "path_anomaly",
    )
    if paths.long is None:
        return rows
    entry = F.struct("pos", "state", "action")
    pieces = (
        paths.long.withColumn("piece", F.expr(f"pos div {STATES_PER_ROW}"))
        .groupBy(*K4, "piece", "num_states", "reached_goal", "path_anomaly")
        .agg(F.array_sort(F.collect_list(entry)).alias("_s"))
        .select(
            *K4, "piece", "num_states",
            text(F.col("_s.state")).alias("states"),
            text(F.filter(F.col("_s"), lambda s: s["pos"] > 0)["action"]).alias("actions"),
            "reached_goal", "path_anomaly",
        )
    )
    return rows.unionByName(pieces)


def path_edges(paths: Paths) -> DataFrame:
    """One row per transition of a path.

    ``to_goal`` marks transitions at or before the last visit of the goal in that path;
    both of their states are then known to lead to the goal. ``reach`` is what the path cost (weight, hops) up to
    the transition's end, and ``left`` what it cost from its beginning on to that visit of the goal; either is null
    where it is not known. ``paths`` should be stored: filters on the exploded arrays would otherwise run the
    fold a second time.
    """
    tasks, n_tasks = paths.tasks.select("taskNumber", "goalState"), rows_of(paths.tasks)
    short = join_lookup(paths.short, tasks, ["taskNumber"], rows=n_tasks)
    last_goal = F.size("states") - F.array_position(F.reverse("states"), F.col("goalState"))
    last_goal = F.when(F.array_contains("states", F.col("goalState")), last_goal).otherwise(-1)
    places = F.sequence(F.lit(0), F.size("states") - 1)
    missing = F.filter(places, lambda i: F.get("states", i).eqNullSafe(F.lit(MISSING_NODE)))

    def cost(upto):
        """Weight of the first ``upto`` transitions: those to and from a missing state weigh more."""
        touched = F.size(F.filter("_missing", lambda i: i <= upto)) + F.size(F.filter("_missing", lambda i: i < upto))
        return upto * STEP_WEIGHT + touched * (MISSING_WEIGHT - STEP_WEIGHT)

    def both(weight, hops):
        return F.struct(weight.cast("long").alias("weight"), hops.cast("long").alias("hops"))

    pos, last = F.col("_i") + 1, F.col("_last_goal")
    edges = (
        short.withColumns({"_last_goal": F.coalesce(last_goal, F.lit(-1)), "_missing": missing})
        .select(
            *K4, "started", "_last_goal", "_missing",
            F.posexplode(F.arrays_zip(
                F.slice("states", F.lit(1), F.size("states") - 1).alias("prev"),
                F.slice("states", F.lit(2), F.size("states") - 1).alias("new"),
                F.col("actions").alias("action"),
            )).alias("_i", "_e"),
        )
        .select(
            *K4, "started", pos.cast("long").alias("pos"),
            F.col("_e.prev").alias("prev"), F.col("_e.new").alias("new"),
            F.col("_e.action").alias("action"), (pos <= last).alias("to_goal"), both(cost(pos), pos).alias("reach"),
            F.when(pos <= last, both(cost(last) - cost(F.col("_i")), last - F.col("_i"))).alias("left"),
        )
    )
    if paths.long is None:
        return edges
    long = join_lookup(paths.long, tasks, ["taskNumber"], rows=n_tasks)
    about = materialize(long.groupBy(*K4).agg(
        F.max(F.when(F.col("state") == F.col("goalState"), F.col("pos"))).alias("_last_goal"),
        F.bool_or(F.col("state").eqNullSafe(F.lit(MISSING_NODE))).alias("_gap")))
    heads = join_lookup(paths.long.where(F.col("pos") > 0), about, K4, "left")
    # (key, position) is unique on both sides, so no join key is hot.
    tails = paths.long.select(*K4, (F.col("pos") + 1).alias("pos"), F.col("state").alias("prev"))
    pos, to_goal = F.col("pos"), F.coalesce(F.col("pos") <= last, F.lit(False))
    ahead = last - pos + 1
    return edges.unionByName(
        heads.join(tails, [*K4, "pos"]).select(
            *K4, "started", "pos", "prev", F.col("state").alias("new"), "action", to_goal.alias("to_goal"),
            F.when(~F.col("_gap"), both(pos * STEP_WEIGHT, pos)).alias("reach"),
            F.when(~F.col("_gap") & to_goal, both(ahead * STEP_WEIGHT, ahead)).alias("left"),
        )
    )


def undecided(paths: Paths) -> Paths:
    """The attempts that neither end at the goal nor have missing states."""
    rows = rows_of(paths.tasks)
    goals = paths.tasks.select("taskNumber", "goalState")
    short = join_lookup(paths.short, goals, ["taskNumber"], rows=rows).where(
        ~F.coalesce(F.array_contains("states", MISSING_NODE), F.lit(False))
        & ~F.coalesce(F.element_at("states", -1) == F.col("goalState"), F.lit(False))).drop("goalState")
    if paths.long is None:
        return Paths(short, None, paths.tasks)
    last = F.col("pos") == F.col("num_states") - 1
    decided = materialize(
        join_lookup(paths.long, goals, ["taskNumber"], rows=rows)
        .where((F.col("state") == MISSING_NODE) | (last & (F.col("state") == F.col("goalState"))))
        .select(*K4).distinct())
    return Paths(short, join_lookup(paths.long, decided, K4, "left_anti"), paths.tasks)


def path_nodes(paths: Paths) -> DataFrame:
    """Distinct states per attempt-visit (long paths: one row per state)."""
    nodes = paths.short.select(*K4, F.explode(F.array_distinct("states")).alias("node"))
    if paths.long is None:
        return nodes
    return nodes.unionByName(paths.long.select(*K4, F.col("state").alias("node")))


def path_outcomes(paths: Paths) -> DataFrame:
    """Per attempt-visit: number of states, last state and whether a state is missing."""
    short = paths.short.select(
        *K4, F.size("states").cast("long").alias("num_states"),
        F.element_at("states", -1).alias("last_state"),
        F.coalesce(F.array_contains("states", MISSING_NODE), F.lit(False)).alias("has_missing"),
        "reached_goal", "path_anomaly",
    )
    if paths.long is None:
        return short
    long = paths.long.groupBy(*K4).agg(
        F.first("num_states").alias("num_states"),
        F.max_by("state", "pos").alias("last_state"),
        F.coalesce(F.bool_or(F.col("state") == MISSING_NODE), F.lit(False)).alias("has_missing"),
        F.first("reached_goal").alias("reached_goal"),
        F.first("path_anomaly").alias("path_anomaly"),
    )
    return short.unionByName(long)
