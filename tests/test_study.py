"""Files in, result tables out."""

import json

import pytest
from pyspark.sql import functions as F

from tests.helpers import rows
from lernspur import (
    aggregate_events, event_lanes, problem_graphs,
    bundle_manifest, key_inventory, read_by_task, read_events, read_roster, read_study, read_tasks,
    run_study, task_metadata, union_studies, write_by_task,
)
from lernspur.functions import states as st
from lernspur.functions import times as tm
from lernspur.operators import quality
from lernspur.plans.outputs import SORTED_BY, check_formats, study_info_lines
from lernspur.plans.queries import QUERIES
from lernspur.runtime import table_root
from lernspur.schemas import BUNDLE_FILES
from lernspur.sources.clickstream import LOG_COLUMNS, clickstream_lanes
from lernspur.sources.files import bundle_path, clean_attempt_export, event_types, fill_optional


@pytest.fixture(scope="module")
def bundle(spark, data, tmp_path_factory):
    """The click stream written as an export; records lack the keys they have no value for."""
    root = tmp_path_factory.mktemp("studies")
    folder = root / "study_a"
    folder.mkdir()
    log = clickstream_lanes(spark.read.parquet(f"{data}/events.parquet")).merge().orderBy("seq")
    with open(folder / BUNDLE_FILES["event_logs"], "w") as f:
        for i, r in enumerate(log.select(*LOG_COLUMNS).toLocalIterator()):
            record = {k: v for k, v in r.asDict().items() if v is not None and k != "seq"}
            record["timestamp"] = r.timestamp.isoformat() + "Z"
            record |= {"_id": f"id{i}", "uid": "x"}
            if i % 50 == 3:
                record["zoom"] = i  # a key outside the schema
            if i % 2:
                record = dict(reversed(record.items()))
            f.write(json.dumps(record) + "\n")
    with open(folder / BUNDLE_FILES["task"], "w") as f:
        for session, created, goal in (("s1", "2024-01-01", "OLD"), ("s2", "2024-02-01", "G")):
            for t in range(1, 7):
                f.write(json.dumps({
                    "taskNumber": t, "startState": "S", "goalState": goal, "sessionId": session,
                    "sessionCreatedAt": created, "sessionCode": "c", "taskId": f"t{t}",
                    "chapterId": "ch", "hintDelta": 1}) + "\n")
    (folder / BUNDLE_FILES["roster"]).write_text(json.dumps([{"name": "p", "ref": "ref1"}, {"name": "q", "ref": None}]))
    (folder / BUNDLE_FILES["study"]).write_text(json.dumps({"title": "A study", "studyId": "study-7", "n": 3}))
    (folder / BUNDLE_FILES["attempt_data"]).write_text("{}")
    other = root / "study_b"
    other.mkdir()
    (other / BUNDLE_FILES["study"]).write_text("{}")
    return root


@pytest.fixture(scope="module")
def result(spark, bundle, tmp_path_factory):
    out = tmp_path_factory.mktemp("out")
    spark.sql("CREATE DATABASE IF NOT EXISTS results")
    return run_study(spark, str(bundle / "study_a"), str(out), ("csv", "parquet", "table"),
                     database="results"), out


def test_events_round_trip(spark, bundle, data):
    log = read_events(spark, bundle_path(str(bundle / "study_a"), "event_logs"))
    expected = QUERIES["event_log"](spark, data).withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    columns = [c for c in LOG_COLUMNS if c != "seq"]
    assert rows(log.select(*columns)) == rows(expected.select(*columns))
    assert "_id" not in log.columns and "zoom" not in log.columns
    assert dict(log.dtypes)["wasSolved"] == "boolean"
    # file order is kept for ties
    assert [r.visitId for r in log.orderBy("seq").limit(20).collect()] == [
        r.visitId for r in expected.orderBy("seq").limit(20).collect()]


def test_extra_columns(spark, bundle):
    log = read_events(spark, bundle_path(str(bundle / "study_a"), "event_logs"), extra_columns=True)
    assert log.columns[-2:] == ["zoom", "seq"] and "uid" not in log.columns
    assert log.where("zoom IS NOT NULL").count() == 20


def test_study_results(spark, result, data):
    (name, folder), out = result
    assert name == "study-7" and folder == f"{out}/study-7"
    for table in ("attempt_level", "student_problem", "student_level", "problem_level"):
        query = "attempt_with_class" if table == "attempt_level" else table
        expected = QUERIES[query](spark, data)
        stored = spark.read.parquet(f"{folder}/{table}.parquet")
        assert stored.columns == expected.columns
        got = stored.select(*[F.col(c).cast(t) for c, t in expected.dtypes])
        assert rows(got) == rows(expected)
        assert spark.table(f"results.{table}").count() == stored.count()
    csv = spark.read.option("header", True).csv(f"{folder}/attempt_level.csv")
    assert csv.count() == spark.table("results.attempt_level").count()
    keys = [tuple(r) for r in csv.select("studentSessionId", "taskNumber", "attemptHlc", "visitId").collect()]
    assert keys == sorted(keys)
    assert spark.table("results.roster_metadata").count() == 2
    assert spark.table("results.task_metadata").count() == 6
    assert spark.table("results.event_logs").count() == 1000


def test_written_order(spark, result):
    """Rows of each table stand in its order, in the files as they are read one after another."""
    (_, folder), _ = result
    for table, keys in SORTED_BY.items():
        lines = spark.read.option("header", True).csv(f"{folder}/{table}.csv").select(*keys).collect()
        got = [tuple(int(x) if k == "taskNumber" else x for k, x in zip(keys, r)) for r in lines]
        assert got and got == sorted(got), table


def test_events_without_a_task_are_left_out(spark):
    events = event_types(spark.createDataFrame(
        [(1, "s", 1), (None, "s", 2), (None, None, 3), (2, None, 4)], "taskNumber int, studentSessionId string, seq long"))
    assert sorted(r.seq for r in event_lanes(events).merge().collect()) == [1, 4]


def test_study_info(spark, result):
    (_, folder), _ = result
    lines = [r.value for r in spark.read.text(f"{folder}/study_info.txt").collect()]
    assert lines[:4] == ["-" * 60, "title: A study", "studyId: study-7", "n: 3"]
    assert len(lines) == 4 + 1 + 21


def test_output_is_guarded(spark, bundle, result):
    with pytest.raises(FileExistsError):
        run_study(spark, str(bundle / "study_a"), str(result[1]))
    with pytest.raises(ValueError):
        check_formats(("csv", "xlsx"))
    with pytest.raises(ValueError):
        bundle_path("x", "nothing")


def test_by_task_storage(spark, bundle, tmp_path):
    log = read_events(spark, bundle_path(str(bundle / "study_a"), "event_logs"))
    write_by_task(log, str(tmp_path / "tasks"), rows_per_file=50)
    one = read_by_task(spark, str(tmp_path / "tasks"), 2)
    assert rows(one.select(*log.columns)) == rows(quality.task_slice(log, 2))
    assert "PartitionFilters: [isnotnull(taskNumber" in one._jdf.queryExecution().executedPlan().toString()


def test_bundle_manifest(spark, bundle):
    missing = {(r.study, r.missing) for r in bundle_manifest(spark, str(bundle)).collect()}
    assert missing == {("study_b", BUNDLE_FILES[k]) for k in ("roster", "task", "event_logs", "attempt_data")}


def test_roster_and_study(spark, bundle, tmp_path):
    (tmp_path / "empty.json").write_text("[]")
    assert read_roster(spark, str(tmp_path / "empty.json")) is None
    study = read_study(spark, bundle_path(str(bundle / "study_a"), "study"))
    assert [(r.key, r.value) for r in study.orderBy("position").collect()] == [
        ("title", "A study"), ("studyId", "study-7"), ("n", "3")]
    assert study_info_lines(study).count() == 4


def test_tasks(spark, bundle):
    tasks = read_tasks(spark, bundle_path(str(bundle / "study_a"), "task"))
    current = task_metadata(tasks)
    assert {r.goalState for r in current.collect()} == {"G"}
    assert current.columns == ["taskNumber", "startState", "goalState", "startState_asciimath", "goalState_asciimath"]
    assert task_metadata(tasks, states_converted=True).columns == ["taskNumber", "startState", "goalState"]


def test_latest_session_is_the_first_listed(spark):
    tasks = spark.createDataFrame(
        [(1, "old", "2024"), (2, "first", "2025"), (3, "second", "2025"), (4, "first", "2023")],
        "taskNumber int, sessionId string, sessionCreatedAt string",
    ).coalesce(1).selectExpr("*", "monotonically_increasing_id() AS seq", "'a' AS startState", "'b' AS goalState",
                             "'' AS sessionCode", "'' AS taskId", "'' AS chapterId", "'' AS hintDelta")
    assert {r.taskNumber for r in task_metadata(tasks).collect()} == {2, 4}


def test_task_checks(spark):
    used = spark.createDataFrame([(1,), (2,), (3,), (None,)], "taskNumber int")
    tasks = spark.createDataFrame([(1, "S", "G"), (2, "S", "G"), (2, "S", "H")],
                                  "taskNumber int, startState string, goalState string")
    found = quality.task_violations(quality.task_numbers(used), tasks)
    assert {tuple(r) for r in found.collect()} == {(2, 2, "multiple"), (3, 0, "missing")}
    with pytest.raises(ValueError):
        quality.check_tasks(used, tasks)


def test_entry_points_check_tasks(spark):
    events = event_types(spark.createDataFrame([(1, "s"), (2, "s")], "taskNumber int, studentSessionId string"))
    one = "taskNumber int, startState string, goalState string"
    for rows in ([(1, "S", "G")], [(1, "S", "G"), (2, "S", "G"), (2, "S", "H")]):
        tasks = spark.createDataFrame(rows, one)
        for entry in (aggregate_events, problem_graphs):
            with pytest.raises(ValueError, match="task number 2"):
                entry(events, tasks)


def test_mapping_names_a_state_once(spark):
    events = spark.createDataFrame([("mathEvent", "a", "b")], "eventType string, oldState string, newState string")
    mapping = spark.createDataFrame([("a", "x"), ("a", "y"), ("b", "z")], "raw string, canonical string")
    with pytest.raises(ValueError, match="'a'"):
        st.state_dictionary(events, mapping=mapping)


@pytest.mark.parametrize("raw, latex", [
    (r"$15 \cdot c+10$", "15c+10"),
    (r"3\cdot 5\cdot c", r"3\cdot 5c"),
    (r"a \cdot b \cdot c", "abc"),
    (r"2 \cdot 3", r"2\cdot 3"),
    (r"x\cdot 2", r"x\cdot 2"),
    ("$$x$$", "x"),
    (None, None),
])
def test_canonical_latex(spark, raw, latex):
    df = spark.createDataFrame([(raw,)], "raw string").select(st.canonical_latex(F.col("raw")))
    assert df.first()[0] == latex


def test_state_conversion(spark):
    log = spark.createDataFrame(
        [("mathStep", "a + b", "c d"), ("undo", "known", None), ("showHint", "e f", "g h")],
        "eventType string, oldState string, newState string")
    plain = st.convert_event_states(log)
    assert [tuple(r) for r in plain.collect()] == [
        ("mathStep", "a+b", "cd", "a + b", "c d"), ("undo", "known", None, "known", None),
        ("showHint", "e f", "g h", "e f", "g h")]
    mapping = spark.createDataFrame([("known", "K"), ("e f", "never")], "raw string, canonical string")
    mapped = st.convert_event_states(log, mapping)
    assert rows(mapped) == rows(plain.withColumn("oldState", F.expr("if(oldState = 'known', 'K', oldState)")))


@pytest.mark.parametrize("text, micros", [
    ("2024-01-01T00:00:01Z", 1704067201000000),
    ("2024-01-01T02:00:01.123456+02:00", 1704067201123456),
    ("2024-01-01 00:00:01.5", 1704067201500000),
    ("2024-01-01", 1704067200000000),
    ("01/02/2024 03:04:05", 1704164645000000),
    ("Jan 2, 2024 03:04:05", 1704164645000000),
    ("1704067201", 1704067201000000),
    ("1704067201123", 1704067201123000),
    ("1704067201123456", 1704067201123456),
    ("1704067201123456789", 1704067201123456),
    ("soon", None), (None, None),
])
def test_timestamps(spark, text, micros):
    df = spark.createDataFrame([(text,)], "t string").select(F.unix_micros(tm.parse_timestamp(F.col("t"))))
    assert df.first()[0] == micros


def test_optional_columns_and_unions(spark):
    df = spark.createDataFrame([("u", 1)], "studentSessionId string, seq long")
    full = fill_optional(df)
    assert dict(full.dtypes)["stars"] == "int" and full.first().reason is None
    both = union_studies({"a": df, "b": df.withColumn("more", F.lit(1))})
    assert {(r.studyId, r.more) for r in both.collect()} == {("a", None), ("b", 1)}
    export = spark.createDataFrame([("i", 1, "c")], "_id string, n int, classlessCanvas string")
    assert clean_attempt_export(export).columns == ["n"]


def test_keys_in_first_seen_order(spark):
    lines = spark.createDataFrame(
        [(0, '{"b":1,"a":2}'), (1, '{"a":1,"c":null}'), (2, "")], "seq long, value string")
    found = key_inventory(lines, "seq").orderBy("first_record", "first_position").collect()
    assert [tuple(r) for r in found] == [("b", 0, 0, 1), ("a", 0, 1, 2), ("c", 1, 1, 1)]


def test_tables_go_to_the_shared_folder(spark):
    assert table_root(spark) == spark.conf.get("spark.checkpoint.dir")


def test_converted_study(spark, bundle, tmp_path, caplog):
    """With converted event states the task states stay as they are in the metadata; totals are logged."""
    caplog.set_level("INFO", "lernspur")
    (tmp_path / "study-7").mkdir()
    _, folder = run_study(spark, str(bundle / "study_a"), str(tmp_path), "parquet", convert_states=True,
                          extra_columns=False, overwrite=True)
    assert [r.getMessage() for r in caplog.records if r.name.startswith("lernspur")][:2] == ["students in roster: 2", "tasks: 6"]
    events = spark.read.parquet(f"{folder}/event_logs.parquet")
    assert {"oldState_latex", "newState_latex"} <= set(events.columns) and "zoom" not in events.columns
    assert spark.read.parquet(f"{folder}/task_metadata.parquet").columns == ["taskNumber", "startState", "goalState"]
