"""DuckDB SQL for every registered query, over the same parquet tables.

Each text is a chain of CTEs that starts at the given tables and restates the operator's
meaning on its own terms (for example, visit collapse counts runs and distinct ids here).
"""

K4 = "studentSessionId, taskNumber, attemptHlc, visitId"
W2 = "PARTITION BY studentSessionId, taskNumber ORDER BY ts_us, seq"
W3 = "PARTITION BY studentSessionId, taskNumber, attemptHlc ORDER BY ts_us, seq"
W4 = f"PARTITION BY {K4} ORDER BY ts_us, seq"
WHOLE = "ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING"
ACTIONS = "('mathStep', 'mathMistake', 'hideHint', 'showHint')"


def same(a, b, keys=K4):
    return " AND ".join(f"{a}.{k} = {b}.{k}" for k in keys.split(", "))


CTE = {}
NEEDS = {}


def cte(name, body, *needs):
    CTE[name], NEEDS[name] = body, needs


def query(select, *needs):
    order = []

    def visit(name):
        for n in NEEDS[name]:
            visit(n)
        if name not in order and name in CTE:
            order.append(name)

    for n in needs:
        visit(n)
    if not order:
        return select
    return "WITH RECURSIVE " + ",\n".join(f"{n} AS ({CTE[n]})" for n in order) + "\n" + select


cte("base", """
SELECT event_id AS seq, user_id AS u, event_type AS et,
  'u' || lpad(CAST(user_id AS VARCHAR), 6, '0') AS studentSessionId,
  CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
  (epoch_us(ts) - 1704067200000000) // 120 AS ts_us,
  row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS rn
FROM events""")

cte("placed", """
SELECT *, rn // 8 AS a, CAST(1 + (u + rn // 24) % 6 AS INTEGER) AS taskNumber,
  CASE WHEN k % 7 <> 0 THEN 'ref' || CAST(u AS VARCHAR) END AS studentRef,
  CASE WHEN k <> 97 THEN 'a' || lpad(CAST(CASE WHEN u % 5 = 0 THEN 9999 - rn // 8 ELSE rn // 8 END AS VARCHAR), 4, '0') END AS attemptHlc,
  'v' || lpad(CAST(rn // 8 AS VARCHAR), 4, '0') ||
    CASE WHEN k % 10 = 0 THEN 'b' WHEN rn % 8 >= 5 AND (rn // 8) % 3 = 1 THEN 'c' ELSE '' END AS visitId,
  CASE WHEN rn % 24 = 0 THEN 'visitTask'
    WHEN et IN ('click', 'purchase') THEN 'mathStep'
    WHEN et = 'error' THEN CASE WHEN k < 60 THEN 'mathMistake' WHEN k < 85 THEN 'undo' ELSE 'redo' END
    WHEN et = 'view' THEN CASE WHEN k < 50 THEN 'showHint' WHEN k < 80 THEN 'hideHint' ELSE 'visitGameScreen' END
    ELSE CASE WHEN k < 20 THEN 'visitTask' WHEN k < 60 THEN 'resetTask' ELSE 'solvedTask' END END AS e0
FROM base""", "base")

cte("stated", f"""
SELECT *, CASE WHEN e0 = 'mathStep' THEN 'n' || (k % 20) || '_' || (u % 7) END AS newState,
  sum(CASE WHEN e0 = 'mathStep' THEN 1 ELSE 0 END) OVER ({W4} ROWS UNBOUNDED PRECEDING) AS steps0
FROM placed""", "placed")

cte("ev", f"""
SELECT seq, studentSessionId, studentRef, taskNumber, attemptHlc, visitId, ts_us,
  make_timestamp(1704067200000000 + ts_us) AS "timestamp", eventType,
  CASE WHEN eventType = 'mathMistake' THEN CASE k % 3 WHEN 0 THEN 'keypad' WHEN 1 THEN 'tap' ELSE 'drag' END END AS mistake,
  CASE WHEN eventType = 'resetTask' THEN CASE WHEN k < 35 THEN 'resetButton' WHEN k < 45 THEN 'retryButton' WHEN k < 55 THEN 'autoReset' END END AS reason,
  CASE WHEN eventType = 'solvedTask' THEN CAST(1 + k % 3 AS INTEGER) END AS stars,
  CASE WHEN e0 = 'mathStep' THEN CASE WHEN k % 25 = 24 THEN 'm' || (k % 3) ELSE coalesce(prior_state, 'S') END END AS oldState,
  newState, CASE WHEN eventType = 'mathStep' THEN 'op' || (k % 4) END AS actionName
FROM (SELECT *, CASE WHEN e0 = 'solvedTask' AND steps0 < 1 + taskNumber % 3 THEN 'showHint' ELSE e0 END AS eventType,
  last_value(newState IGNORE NULLS) OVER ({W4} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prior_state
  FROM stated)""", "stated")

cte("runs", f"""
SELECT *, CASE WHEN lag(visitId) OVER ({W3}) IS DISTINCT FROM visitId THEN 1 ELSE 0 END AS starts_run,
  first_value(visitId) OVER ({W3} {WHOLE}) AS first_visit
FROM ev""", "ev")

cte("attempt_visits", """
SELECT studentSessionId, taskNumber, attemptHlc, sum(starts_run) = count(DISTINCT visitId) AS one_way
FROM runs WHERE attemptHlc IS NOT NULL GROUP BY ALL""", "runs")

cte("nv", """
SELECT r.* EXCLUDE (visitId, starts_run, first_visit), visitId AS rawVisitId,
  CASE WHEN one_way IS NULL THEN NULL WHEN one_way THEN first_visit ELSE visitId END AS visitId
FROM runs r LEFT JOIN attempt_visits USING (studentSessionId, taskNumber, attemptHlc)""",
    "runs", "attempt_visits")

cte("shifted", f"""
SELECT * EXCLUDE (attemptHlc), attemptHlc AS rawAttemptHlc,
  CASE WHEN eventType = 'resetTask' THEN lead(attemptHlc) OVER ({W2}) ELSE attemptHlc END AS attemptHlc,
  lead(reason) OVER ({W2}) AS next_reset_reason
FROM nv WHERE eventType <> 'visitGameScreen'""", "nv")

cte("visit_groups", f"""
SELECT {K4}, count(*) AS num_events, bool_or(eventType IN {ACTIONS}) AS kept
FROM shifted WHERE attemptHlc IS NOT NULL AND visitId IS NOT NULL GROUP BY ALL""", "shifted")

cte("deltas", f"""
SELECT s.*, ts_us - lag(ts_us) OVER ({W4}) AS delta_us, eventType IN {ACTIONS} AS is_action,
  row_number() OVER ({W4}) AS n
FROM shifted s WHERE EXISTS (SELECT 1 FROM visit_groups g WHERE kept AND {same('g', 's')})""",
    "shifted", "visit_groups")

cte("att0", f"""
SELECT {K4},
  arg_min(studentRef, n) FILTER (WHERE studentRef IS NOT NULL) AS studentRef,
  min("timestamp") AS start_time, max("timestamp") AS end_time, arg_min(seq, n) AS seq0,
  sum(delta_us) FILTER (WHERE delta_us < 300000000) / 1e6 AS total_time,
  min(n) FILTER (WHERE is_action) AS first_action,
  count(*) FILTER (WHERE eventType = 'mathStep') AS num_steps,
  count(*) FILTER (WHERE eventType = 'mathMistake') AS num_errors,
  bool_or(eventType = 'solvedTask') AS completed_dur_attempt,
  count(*) FILTER (WHERE eventType = 'visitTask') AS num_visits,
  min(n) FILTER (WHERE eventType = 'mathStep') AS first_step,
  min(n) FILTER (WHERE eventType = 'mathMistake') AS first_mistake,
  count(*) FILTER (WHERE eventType = 'showHint') AS num_hints,
  count(*) FILTER (WHERE mistake = 'keypad') AS num_keypad_errors,
  count(*) FILTER (WHERE mistake = 'tap') AS num_shaking_errors,
  count(*) FILTER (WHERE mistake = 'drag') AS num_snapping_errors,
  max(stars) AS stars,
  count(*) FILTER (WHERE next_reset_reason = 'resetButton') > 0 AS clicked_reset_button,
  count(*) FILTER (WHERE next_reset_reason = 'retryButton') > 0 AS clicked_retry_button
FROM deltas GROUP BY ALL""", "deltas")

cte("att1", f"""
SELECT a.* EXCLUDE (first_action, first_step, first_mistake),
  CASE WHEN d.delta_us < 300000000 THEN d.delta_us / 1e6 END AS pause_time,
  CASE WHEN first_step IS NULL THEN NULL WHEN first_mistake IS NULL THEN true ELSE first_step < first_mistake END AS validity_first_step,
  dense_rank() OVER (PARTITION BY a.studentSessionId, a.taskNumber ORDER BY a.attemptHlc) AS attempt_number,
  row_number() OVER (PARTITION BY a.studentSessionId, a.taskNumber, a.attemptHlc ORDER BY start_time, seq0) AS attempt_visit_number,
  row_number() OVER (PARTITION BY a.studentSessionId, a.taskNumber ORDER BY start_time, seq0) AS appearance,
  row_number() OVER (PARTITION BY a.studentSessionId, a.taskNumber ORDER BY a.attemptHlc, start_time, seq0) AS by_id
FROM att0 a LEFT JOIN deltas d ON {same('a', 'd')} AND a.first_action = d.n""", "att0", "deltas")

cte("att", """
SELECT a.* EXCLUDE (appearance, by_id),
  CASE WHEN total_time = 0 THEN NULL ELSE pause_time / total_time END AS pause_time_ratio,
  coalesce(appearance > f.done, false) AS replay_attempt,
  coalesce(stars = 1, false) AS stars_1, coalesce(stars = 2, false) AS stars_2,
  coalesce(stars = 3, false) AS stars_3, stars IS NULL AS "stars_NA"
FROM att1 a LEFT JOIN (
  SELECT studentSessionId, taskNumber, arg_min(appearance, by_id) AS done
  FROM att1 WHERE completed_dur_attempt GROUP BY ALL) f USING (studentSessionId, taskNumber)""", "att1")

cte("sp", """
SELECT studentSessionId, taskNumber,
  arg_min(studentRef, (attempt_number, attempt_visit_number)) FILTER (WHERE studentRef IS NOT NULL) AS studentRef,
  max(attempt_number) AS num_attempts,
  count(*) FILTER (WHERE replay_attempt) AS num_replays,
  count(*) FILTER (WHERE clicked_retry_button) AS num_clicked_retry_button,
  count(*) FILTER (WHERE clicked_reset_button) AS num_clicked_reset_button,
  bool_or(completed_dur_attempt) AS problem_completed,
  count(*) FILTER (WHERE completed_dur_attempt) AS num_completed_attempts,
  CAST(sum(num_errors) AS BIGINT) AS num_errors, CAST(sum(num_keypad_errors) AS BIGINT) AS num_keypad_errors,
  CAST(sum(num_shaking_errors) AS BIGINT) AS num_shaking_errors,
  CAST(sum(num_snapping_errors) AS BIGINT) AS num_snapping_errors, CAST(sum(num_hints) AS BIGINT) AS num_hints,
  coalesce(sum(total_time), 0) AS total_time_spent, avg(total_time) AS avg_time_spent,
  avg(pause_time) AS avg_pause_time, avg(pause_time_ratio) AS avg_pause_time_ratio,
  count(*) FILTER (WHERE stars = 3) AS num_three_star, count(*) FILTER (WHERE stars = 2) AS num_two_star,
  count(*) FILTER (WHERE stars = 1) AS num_one_star, count(*) FILTER (WHERE stars IS NULL) AS num_incomplete,
  avg(stars) AS avg_stars
FROM att GROUP BY ALL""", "att")

TOTALS = {
    "total_attempts": "num_attempts", "total_replays": "num_replays",
    "total_completed_attempts": "num_completed_attempts", "total_errors": "num_errors",
    "total_keypad_errors": "num_keypad_errors", "total_shaking_errors": "num_shaking_errors",
    "total_snapping_errors": "num_snapping_errors", "total_hints": "num_hints",
    "total_one_star": "num_one_star", "total_two_star": "num_two_star",
    "total_three_star": "num_three_star", "total_incomplete": "num_incomplete",
    "total_click_reset": "num_clicked_reset_button", "total_click_retry": "num_clicked_retry_button",
}
cte("sl", f"""
SELECT studentSessionId, arg_min(studentRef, taskNumber) FILTER (WHERE studentRef IS NOT NULL) AS studentRef,
  count(DISTINCT taskNumber) AS total_problems,
  count(*) FILTER (WHERE problem_completed) AS total_completed_problems,
  {', '.join(f'CAST(sum({c}) AS BIGINT) AS {n}' for n, c in TOTALS.items())},
  sum(total_time_spent) AS total_time_spent, avg(num_clicked_reset_button) AS avg_click_reset,
  avg(num_clicked_retry_button) AS avg_click_retry, avg(avg_stars) AS avg_stars,
  sum(total_time_spent) / 60 AS total_time_spent_mins
FROM sp GROUP BY ALL""", "sp")

MEANS = {
    "avg_time_spent": "total_time_spent", "avg_attempts": "num_attempts", "avg_replays": "num_replays",
    "avg_completed_attempts": "num_completed_attempts", "avg_errors": "num_errors",
    "avg_keypad_errors": "num_keypad_errors", "avg_shaking_errors": "num_shaking_errors",
    "avg_snapping_errors": "num_snapping_errors", "avg_hints": "num_hints",
    "avg_one_star": "num_one_star", "avg_two_star": "num_two_star", "avg_three_star": "num_three_star",
    "avg_incomplete": "num_incomplete", "avg_stars": "avg_stars",
    "avg_click_reset": "num_clicked_reset_button", "avg_click_retry": "num_clicked_retry_button",
}
cte("pl", f"""
SELECT taskNumber, count(DISTINCT studentSessionId) AS total_students,
  count(*) FILTER (WHERE problem_completed) AS total_completed,
  {', '.join(f'avg({c}) AS {n}' for n, c in MEANS.items())},
  avg(total_time_spent) / 60 AS avg_time_spent_mins
FROM sp GROUP BY ALL""", "sp")

# --- paths ---

cte("pe", f"""
SELECT *, row_number() OVER ({W4}) AS n FROM nv v
WHERE EXISTS (SELECT 1 FROM nv x WHERE x.eventType IN {ACTIONS} AND {same('x', 'v')})
  AND eventType NOT IN ('visitTask', 'visitGameScreen', 'showHint', 'hideHint', 'mathMistake')
  AND NOT (eventType = 'resetTask' AND coalesce(reason IN ('retryButton', 'autoReset'), false))""", "nv")

CAN_UNDO = "(p.eventType = 'undo' AND len(f.states) > 1)"
CAN_REDO = "(p.eventType = 'redo' AND len(f.us) > 0)"
UNSEEN = "(f.states[-1] NOT IN ('missing_node', p.oldState))"
cte("fold", f"""
SELECT {K4}, ts_us AS t0, seq AS q0, CAST(0 AS BIGINT) AS n, ['S'] AS states, CAST([] AS VARCHAR[]) AS actions,
  CAST([] AS VARCHAR[]) AS us, CAST([] AS VARCHAR[]) AS ua, false AS fin, false AS reached, false AS anomaly
FROM pe WHERE n = 1
UNION ALL
SELECT {', '.join('f.' + k for k in K4.split(', '))}, f.t0, f.q0, p.n,
  CASE WHEN f.fin THEN f.states
    WHEN p.eventType = 'mathStep' AND {UNSEEN} THEN f.states || ['missing_node', p.oldState, p.newState]
    WHEN p.eventType = 'mathStep' THEN f.states || [p.newState]
    WHEN p.eventType = 'solvedTask' THEN f.states[:-2] || ['G']
    WHEN {CAN_UNDO} THEN f.states[:-2]
    WHEN {CAN_REDO} THEN f.states || [f.us[-1]] ELSE f.states END,
  CASE WHEN f.fin THEN f.actions
    WHEN p.eventType = 'mathStep' AND {UNSEEN} THEN f.actions || ['missing_action', 'missing_action', p.actionName]
    WHEN p.eventType = 'mathStep' THEN f.actions || [p.actionName]
    WHEN {CAN_UNDO} THEN f.actions[:-2]
    WHEN {CAN_REDO} THEN f.actions || [f.ua[-1]] ELSE f.actions END,
  CASE WHEN f.fin THEN f.us WHEN p.eventType = 'mathStep' THEN []
    WHEN {CAN_UNDO} THEN f.us || [f.states[-1]] WHEN {CAN_REDO} THEN f.us[:-2] ELSE f.us END,
  CASE WHEN f.fin THEN f.ua WHEN p.eventType = 'mathStep' THEN []
    WHEN {CAN_UNDO} THEN f.ua || [f.actions[-1]] WHEN {CAN_REDO} THEN f.ua[:-2] ELSE f.ua END,
  f.fin OR p.eventType IN ('solvedTask', 'resetTask'),
  f.reached OR (NOT f.fin AND p.eventType = 'solvedTask'),
  f.anomaly OR (NOT f.fin AND p.eventType IN ('undo', 'redo') AND NOT {CAN_UNDO} AND NOT {CAN_REDO})
FROM fold f JOIN pe p ON {same('f', 'p')} AND p.n = f.n + 1""", "pe")

cte("paths", f"SELECT * FROM fold QUALIFY row_number() OVER (PARTITION BY {K4} ORDER BY n DESC) = 1", "fold")

cte("hops", f"""
SELECT {K4}, t0, q0, i AS pos, states[i] AS prev, states[i + 1] AS new, actions[i] AS action, anomaly
FROM (SELECT *, unnest(generate_series(1, len(states) - 1)) AS i FROM paths)""", "paths")

WEIGHT = "CASE WHEN prev = 'missing_node' OR new = 'missing_node' THEN 10000 ELSE 1 END"
ORDER_SEEN = "(studentSessionId, t0, q0, attemptHlc, visitId, pos)"
cte("edges", f"""
SELECT taskNumber, prev, new, count(*) AS attempt_count,
  arg_min(action, {ORDER_SEEN}) AS math_trans_type, CAST({WEIGHT} AS BIGINT) AS weight
FROM hops GROUP BY taskNumber, prev, new""", "hops")
cte("own_edges", f"""
SELECT taskNumber, studentSessionId, prev, new, count(*) AS attempt_count,
  arg_min(action, {ORDER_SEEN}) AS math_trans_type, CAST({WEIGHT} AS BIGINT) AS weight
FROM hops GROUP BY taskNumber, studentSessionId, prev, new""", "hops")
cte("arcs", """
SELECT taskNumber, '' AS scope, prev, new FROM edges
UNION ALL SELECT taskNumber, studentSessionId, prev, new FROM own_edges""", "edges", "own_edges")
cte("nodes", "SELECT taskNumber, scope, prev AS node FROM arcs UNION SELECT taskNumber, scope, new FROM arcs", "arcs")
cte("leads", """
SELECT taskNumber, scope, node FROM nodes WHERE node = 'G'
UNION
SELECT a.taskNumber, a.scope, a.prev FROM leads l JOIN arcs a
  ON a.taskNumber = l.taskNumber AND a.scope = l.scope AND a.new = l.node""", "nodes", "arcs")
cte("dead", """
SELECT n.* FROM nodes n
WHERE node <> 'missing_node' AND NOT (scope <> '' AND node IN ('S', 'G'))
  AND EXISTS (SELECT 1 FROM leads l WHERE l.taskNumber = n.taskNumber AND l.scope = n.scope)
  AND NOT EXISTS (SELECT 1 FROM leads l WHERE l.taskNumber = n.taskNumber AND l.scope = n.scope AND l.node = n.node)""",
    "nodes", "leads")

# The cheapest way from the start to each node, and from each node to the goal: in rounds, each going on from what became
# cheaper in the one before, until nothing does.
def cheapest_ways(name, source, end, other):
    cte(f"{name}(taskNumber, node, w, h) USING KEY (taskNumber, node)", f"""
SELECT DISTINCT taskNumber, '{source}' AS node, CAST(0 AS BIGINT) AS w, CAST(0 AS BIGINT) AS h FROM edges WHERE {end} = '{source}'
UNION
SELECT n.taskNumber, n.node, n.c.w, n.c.h
FROM (SELECT e.taskNumber, e.{other} AS node, min(struct_pack(w := y.w + e.weight, h := y.h + 1)) AS c
  FROM {name} y JOIN edges e ON e.taskNumber = y.taskNumber AND e.{end} = y.node GROUP BY ALL) n
LEFT JOIN recurring.{name} r ON r.taskNumber = n.taskNumber AND r.node = n.node
WHERE r.w IS NULL OR n.c < struct_pack(w := r.w, h := r.h)""", "edges")
    NEEDS[name] = [f"{name}(taskNumber, node, w, h) USING KEY (taskNumber, node)"]


cheapest_ways("ways", "S", "prev", "new")
cheapest_ways("back", "G", "new", "prev")
cte("best", "SELECT taskNumber, w, h FROM ways WHERE node = 'G'", "ways")
cte("best_edges", """
SELECT e.* FROM edges e JOIN ways d ON d.taskNumber = e.taskNumber AND d.node = e.prev
  JOIN back b ON b.taskNumber = e.taskNumber AND b.node = e.new
  JOIN best x ON x.taskNumber = e.taskNumber
WHERE d.w + e.weight + b.w = x.w""", "edges", "ways", "back", "best")
cte("best_nodes", """
SELECT taskNumber, node FROM (
  SELECT taskNumber, prev AS node FROM best_edges UNION SELECT taskNumber, new FROM best_edges)
WHERE node NOT IN ('S', 'G', 'missing_node')""", "best_edges")
cte("best_walks", """
SELECT DISTINCT taskNumber, ['S'] AS path FROM best_edges WHERE prev = 'S'
UNION ALL
SELECT e.taskNumber, p.path || [e.new] FROM best_walks p JOIN best_edges e
  ON e.taskNumber = p.taskNumber AND e.prev = p.path[-1] WHERE p.path[-1] <> 'G'""", "best_edges")

cte("tasks6", "SELECT unnest(generate_series(1, 6)) AS taskNumber")
cte("touched", f"""
SELECT {K4}, bool_or(d.scope = '') AS dead_all, bool_or(d.scope <> '') AS dead_own
FROM (SELECT {K4}, unnest(states) AS node FROM paths) p
JOIN dead d USING (taskNumber, node)
WHERE node <> 'S' AND d.scope IN ('', p.studentSessionId) GROUP BY ALL""", "paths", "dead")
_CLASS = """CASE WHEN list_contains(states, 'missing_node') THEN NULL
  WHEN states[-1] = 'G' AND len(states) - 1 = h THEN 'optimal'
  WHEN states[-1] = 'G' THEN 'sub_optimal'
  WHEN coalesce({}, false) THEN 'dead_end' ELSE 'incomplete' END"""
cte("classes", f"""
SELECT {K4}, {_CLASS.format('dead_all')} AS "MFL_global_class",
  {_CLASS.format('dead_own')} AS "MFL_individual_class",
  list_contains(states, 'missing_node') AS missing_steps_in_logs
FROM paths LEFT JOIN best USING (taskNumber)
LEFT JOIN touched USING ({K4})""", "paths", "best", "touched")

# --- columns as the queries emit them ---

EVENT = """seq, studentSessionId, studentRef, taskNumber, attemptHlc, visitId, "timestamp",
 eventType, mistake, reason, stars, oldState, newState, actionName"""


def singles(*names):
    return ", ".join(f"CAST({n} AS FLOAT) AS {n}" for n in names)


ATTEMPT = f"""{K4}, studentRef, start_time, end_time, {singles('total_time', 'pause_time')},
  num_steps, num_errors, completed_dur_attempt, num_visits, validity_first_step, num_hints,
  num_keypad_errors, num_shaking_errors, num_snapping_errors, stars, clicked_reset_button,
  clicked_retry_button, attempt_number, attempt_visit_number, {singles('pause_time_ratio')},
  replay_attempt, stars_1, stars_2, stars_3, "stars_NA" """
METRICS = ["total_problems", "total_completed_problems", *TOTALS, "total_time_spent",
           "avg_click_reset", "avg_click_retry", "avg_stars", "total_time_spent_mins"]

# A part row read as the description of a task in some session.
cte("part_tasks", r"""
SELECT p_partkey AS seq, CAST(1 + p_partkey * 6 % 3000 AS INTEGER) AS taskNumber, p_brand AS sessionId,
  lpad(CAST(p_size AS VARCHAR), 3, '0') AS sessionCreatedAt,
  '$' || p_size || '\cdot ' || substr(p_name, 1, 1) || ' + ' || (p_partkey % 7) || '$' AS startState,
  substr(p_name, 1, 1) || '\cdot ' || substr(p_type, 1, 1) || ' = ' || p_size AS goalState
FROM part""")

# An order read as a state: a product of numbers and letters.
cte("order_states", r"""
SELECT o_orderkey, '$' || (o_custkey % 50) || '\cdot ' || substr(o_orderstatus, 1, 1) || '\cdot '
  || lower(substr(o_orderpriority, 3, 1)) || '\cdot x + ' || (o_custkey % 9) || '\cdot '
  || (o_orderkey % 4) || '\cdot ' || lower(o_orderstatus) || '$' AS raw
FROM orders""")


def canonical(raw):
    text = f"replace(trim({raw}, '$'), ' ', '')"
    text = rf"regexp_replace({text}, '([0-9]+)\\cdot([A-Za-z])', '\1\2', 'g')"
    for _ in range(2):  # neighbouring products share a letter
        text = rf"regexp_replace({text}, '([A-Za-z])\\cdot([A-Za-z])', '\1\2', 'g')"
    return rf"replace({text}, '\cdot', '\cdot ')"


LOG_KEYS = ["seq", "studentSessionId", "studentRef", "taskNumber", "attemptHlc", "visitId", "timestamp",
            "eventType", "mistake", "reason", "stars", "oldState", "newState", "actionName"]
cte("records", f"""
SELECT seq, unnest(json_keys(rec)) AS key, unnest(generate_series(0, len(json_keys(rec)) - 1)) AS position
FROM (SELECT seq, json_merge_patch('{{}}', to_json({{{', '.join(f"'{c}': \"{c}\"" for c in LOG_KEYS)}}})) AS rec FROM ev)""", "ev")

TEXT_FORMS = """CASE event_id % 4 WHEN 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S')
  WHEN 1 THEN strftime(ts, '%m/%d/%Y %H:%M:%S') WHEN 2 THEN CAST(epoch_us(ts) // 1000 AS VARCHAR)
  ELSE strftime(ts, '%b %-d, %Y %H:%M:%S') END"""

BUNDLE = ["roster-metadata.json", "study-metadata.json", "task-metadata.ndjson", "event-logs.ndjson", "attempt-data.ndjson"]


def oracle_sql() -> dict[str, str]:
    return {
        "event_log": query(f"SELECT {EVENT} FROM ev", "ev"),
        "task_numbers": query("SELECT DISTINCT taskNumber FROM ev", "ev"),
        "task_slice": query(f"SELECT {EVENT} FROM ev WHERE taskNumber = 1", "ev"),
        "fill_optional": query(
            f"SELECT {EVENT}, NULL::VARCHAR AS sessionId, NULL::INTEGER AS attemptNumber, "
            "NULL::VARCHAR AS actionId, NULL::INTEGER AS steps, NULL::BOOLEAN AS wasSolved, "
            "NULL::DOUBLE AS dx, NULL::DOUBLE AS dy, NULL::BOOLEAN AS dropClosestToSelf FROM ev", "ev"),
        "key_inventory": query(
            "SELECT key, min(seq) AS first_record, arg_min(position, seq) AS first_position, "
            "count(*) AS records FROM records GROUP BY key", "records"),
        "parse_timestamp": (
            f"SELECT event_id, {TEXT_FORMS} AS text, CASE WHEN event_id % 4 = 2 THEN date_trunc('millisecond', ts) "
            "ELSE date_trunc('second', ts) END AS parsed FROM events"),
        "event_log_json": query(
            f"SELECT {EVENT}, lag(seq) OVER (PARTITION BY studentSessionId ORDER BY seq) AS follows FROM ev", "ev"),
        "bad_records": query("""
            SELECT seq, c AS "column", t AS "text", r AS reason FROM ev JOIN (VALUES
              (0, NULL, NULL, 'not a JSON object'), (1, NULL, NULL, 'not a JSON object'), (2, 'taskNumber', '1.5', 'not whole'),
              (3, 'timestamp', 'soon', 'not a time'), (3, 'wasSolved', 'maybe', 'not a boolean'),
              (4, 'wasSolved', 'maybe', 'not a boolean'), (5, 'stars', '99999999999', 'out of range'),
              (6, 'dx', 'wide', 'not a number'), (10, NULL, NULL, 'not a JSON object'), (11, NULL, NULL, 'not a JSON object')
            ) AS v(k, c, t, r) ON seq % 40 = k""", "ev"),
        "bundle_manifest": (
            f"SELECT 'study-' || n_nationkey AS study, ({BUNDLE})[k + 1] AS missing "
            "FROM nation, range(5) AS r(k) WHERE (n_nationkey + k * k) % 4 = 0"),
        "task_store": query(f"SELECT {EVENT} FROM ev WHERE taskNumber = 2", "ev"),
        "appended_chunks": query(f"SELECT {EVENT}, 'chunk-' || (seq % 3) AS chunk FROM ev", "ev"),
        "visit_collapse": query("SELECT seq, rawVisitId, visitId FROM nv", "nv"),
        "reset_reassign": query(
            "SELECT seq, rawAttemptHlc, attemptHlc, visitId, next_reset_reason FROM shifted", "shifted"),
        "nonempty_visits": query(f"SELECT {K4}, num_events, kept FROM visit_groups", "visit_groups"),
        "event_deltas": query(
            f"SELECT seq, {K4}, CAST(delta_us / 1e6 AS FLOAT) AS delta_seconds, is_action FROM deltas", "deltas"),
        "attempt_level": query(f"SELECT {ATTEMPT} FROM att", "att"),
        "attempt_numbers": query(f"SELECT {K4}, attempt_number, attempt_visit_number FROM att", "att"),
        "replay_flag": query(f"SELECT {K4}, replay_attempt FROM att", "att"),
        "student_problem": query(
            "SELECT * REPLACE (" + singles("total_time_spent", "avg_time_spent", "avg_pause_time",
                                           "avg_pause_time_ratio", "avg_stars") + ") FROM sp", "sp"),
        "student_level": query(
            "SELECT * REPLACE (" + singles("total_time_spent", "avg_click_reset", "avg_click_retry",
                                           "avg_stars", "total_time_spent_mins") + ") FROM sl", "sl"),
        "problem_level": query(
            f"SELECT * REPLACE ({singles(*MEANS, 'avg_time_spent_mins')}) FROM pl", "pl"),
        "assignment_level": query(" UNION ALL ".join(
            f"SELECT '{m}' AS metric, CAST(avg({m}) AS FLOAT) AS mean, CAST(stddev_samp({m}) AS FLOAT) AS std, "
            f"CAST(min({m}) AS FLOAT) AS min, CAST(quantile_cont({m}::DOUBLE, 0.25) AS FLOAT) AS p25, "
            f"CAST(quantile_cont({m}::DOUBLE, 0.5) AS FLOAT) AS p50, CAST(quantile_cont({m}::DOUBLE, 0.75) AS FLOAT) AS p75, "
            f"CAST(max({m}) AS FLOAT) AS max FROM sl" for m in METRICS), "sl"),
        "path_events": query(
            f"SELECT seq, {K4}, eventType, oldState, newState, actionName FROM pe", "pe"),
        "attempt_paths": query(
            f"SELECT {K4}, CAST(0 AS BIGINT) AS piece, len(states) AS num_states, "
            "array_to_string(states, ' > ') AS states, array_to_string(actions, ' > ') AS actions, "
            "reached AS reached_goal, anomaly AS path_anomaly FROM paths", "paths"),
        "transition_edges": query("SELECT * FROM edges", "edges"),
        "student_edges": query("SELECT * FROM own_edges", "own_edges"),
        "retract_edges": query(
            """SELECT l.* EXCLUDE (n) REPLACE (attempt_count - n AS attempt_count) FROM lowered l
WHERE attempt_count > n AND NOT EXISTS (SELECT 1 FROM lowered g WHERE g.attempt_count = g.n
  AND g.taskNumber = l.taskNumber AND g.new IN (l.prev, l.new))""", "lowered"),
        "optimal_length": query(
            "SELECT CAST(taskNumber AS INTEGER) AS taskNumber, w AS optimal_weight, h AS optimal_length, w IS NOT NULL AS problem_solved "
            "FROM tasks6 LEFT JOIN best USING (taskNumber)", "tasks6", "best"),
        "optimal_path_counts": query(
            "SELECT taskNumber, CAST(count(*) AS DECIMAL(38, 0)) AS num_paths FROM best_walks WHERE path[-1] = 'G' GROUP BY ALL",
            "best_walks"),
        "optimal_paths": query(
            "SELECT taskNumber, array_to_string(path, ' > ') AS path FROM best_walks WHERE path[-1] = 'G'",
            "best_walks"),
        "best_path_edges": query("SELECT * FROM best_edges", "best_edges"),
        "best_path_nodes": query("SELECT * FROM best_nodes", "best_nodes"),
        "dead_end_nodes": query("SELECT taskNumber, node FROM dead WHERE scope = ''", "dead"),
        "student_dead_ends": query(
            "SELECT taskNumber, scope AS studentSessionId, node FROM dead WHERE scope <> ''", "dead"),
        "graph_links": query(
            """SELECT e.taskNumber, e.prev AS source, e.new AS target, e.attempt_count, e.math_trans_type, e.weight,
  b.prev IS NOT NULL AS is_best_path
FROM edges e LEFT JOIN best_edges b ON b.taskNumber = e.taskNumber AND b.prev = e.prev AND b.new = e.new""",
            "edges", "best_edges"),
        "graph_nodes": query(
            """SELECT n.taskNumber, n.node, b.node IS NOT NULL AS in_best_path, d.node IS NOT NULL AS is_dead_end
FROM nodes n LEFT JOIN best_nodes b ON b.taskNumber = n.taskNumber AND b.node = n.node
LEFT JOIN dead d ON d.taskNumber = n.taskNumber AND d.node = n.node AND d.scope = ''
WHERE n.scope = ''""", "nodes", "best_nodes", "dead"),
        "graph_export": query(
            """SELECT n.taskNumber, 'nodes' AS part, CAST(to_json({'id': n.node, 'in_best_path': b.node IS NOT NULL,
  'is_dead_end': d.node IS NOT NULL}) AS VARCHAR) AS element
FROM nodes n LEFT JOIN best_nodes b ON b.taskNumber = n.taskNumber AND b.node = n.node
LEFT JOIN dead d ON d.taskNumber = n.taskNumber AND d.node = n.node AND d.scope = ''
WHERE n.scope = ''
UNION ALL
SELECT e.taskNumber, 'links', CAST(to_json({'attempt_count': e.attempt_count, 'math_trans_type': e.math_trans_type,
  'weight': e.weight, 'is_best_path': b.prev IS NOT NULL, 'source': e.prev, 'target': e.new}) AS VARCHAR)
FROM edges e LEFT JOIN best_edges b ON b.taskNumber = e.taskNumber AND b.prev = e.prev AND b.new = e.new""",
            "nodes", "best_nodes", "dead", "edges", "best_edges"),
        "classify_attempts": query("SELECT * FROM classes", "classes"),
        "attempt_with_class": query(
            f"""SELECT {ATTEMPT}, "MFL_global_class", "MFL_individual_class", missing_steps_in_logs
FROM att LEFT JOIN classes USING ({K4})""", "att", "classes"),
        "task_bounds": query(
            "SELECT DISTINCT taskNumber, 'S' AS startState, 'G' AS goalState FROM ev", "ev"),
        "task_metadata": query(
            f"""SELECT taskNumber, {canonical('startState')} AS startState, {canonical('goalState')} AS goalState,
  startState AS startState_asciimath, goalState AS goalState_asciimath
FROM part_tasks WHERE sessionId = (SELECT arg_min(sessionId, seq) FROM part_tasks
  WHERE sessionCreatedAt = (SELECT max(sessionCreatedAt) FROM part_tasks))""", "part_tasks"),
        "task_meta_violations": query(
            """SELECT taskNumber, coalesce(n, 0) AS rows, CASE WHEN n IS NULL THEN 'missing' ELSE 'multiple' END AS problem
FROM (SELECT DISTINCT CAST(1 + l_partkey % 2500 AS INTEGER) AS taskNumber FROM lineitem)
LEFT JOIN (SELECT taskNumber, count(*) AS n FROM part_tasks GROUP BY ALL) USING (taskNumber)
WHERE n IS NULL OR n > 1""", "part_tasks"),
        "canonical_states": query(
            f"SELECT o_orderkey, raw, {canonical('raw')} AS latex, replace(raw, ' ', '') AS ascii FROM order_states",
            "order_states"),
        "state_dictionary": query(
            """SELECT raw, count(*) AS uses, replace(raw, '_', ':') AS canonical FROM (
  SELECT oldState AS raw, eventType FROM ev UNION ALL SELECT newState, eventType FROM ev)
WHERE raw IS NOT NULL AND eventType IN ('mathStep', 'undo', 'redo', 'mathMistake') GROUP BY raw""", "ev"),
        "converted_states": query(
            "SELECT seq, eventType, replace(oldState, '_', ':') AS oldState, replace(newState, '_', ':') AS newState, "
            "oldState AS oldState_latex, newState AS newState_latex FROM ev", "ev"),
        "union_studies": query(
            f"SELECT {EVENT}, 'first' AS studyId FROM ev UNION ALL SELECT {EVENT}, 'second' FROM ev", "ev"),
    }


cte("lowered", """
SELECT e.*, coalesce(n, 0) AS n FROM edges e LEFT JOIN (
  SELECT taskNumber, prev, new, count(*) AS n FROM hops WHERE anomaly GROUP BY ALL) USING (taskNumber, prev, new)""",
    "edges", "hops")
