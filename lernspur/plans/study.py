"""From a study export to all result tables."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession

from ..functions.states import convert_event_states
from ..operators import attempts as att
from ..operators import rollups
from ..operators.classify import attempt_with_class, classify_attempts
from ..operators.graph import ProblemGraphs
from ..operators.ordered import Lanes
from ..operators.paths import attempt_paths, path_events
from ..operators.quality import check_tasks
from ..operators.visits import attempt_events, event_lanes, normalize_visits
from ..runtime import materialize, rows_of
from ..schemas import STUDENT
from ..sources import files, records
from .outputs import check_formats, study_info_lines, write_study_info, write_table

log = logging.getLogger(__name__)


def _checked(events: DataFrame, tasks: DataFrame) -> DataFrame:
    check_tasks(events, tasks)
    return events


def problem_graphs(events: DataFrame | Lanes, tasks: DataFrame) -> ProblemGraphs:
    """Transition graphs of a log whose visits are not yet normalised.

    Tasks are checked as in :func:`aggregate_events`.
    """
    lanes = events if isinstance(events, Lanes) else event_lanes(_checked(events, tasks))
    return ProblemGraphs(attempt_paths(path_events(normalize_visits(lanes)), tasks).store())


def aggregate_events(events: DataFrame | Lanes, tasks: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Event log -> (attempt table with classes, student x task table).

    Both branches, attempts and paths, start from the normalised log. It is stored once, in buckets by
    student, so the log's rows are shuffled once and neither branch moves them again. The
    attempt rows are stored, as both results are made from them; then the shared log is deleted. Every task
    number of the events needs exactly one row in ``tasks``, else this is a ValueError; lanes come checked.
    """
    lanes = events if isinstance(events, Lanes) else event_lanes(_checked(events, tasks))
    normalized = normalize_visits(lanes).share(STUDENT)
    paths = attempt_paths(path_events(normalized), tasks).store()
    attempts = att.attempt_lanes(attempt_events(normalized)).store_all()
    normalized.discard()
    table = attempts.merge().select(*att.ATTEMPT_COLUMNS)
    return (
        attempt_with_class(table, classify_attempts(ProblemGraphs(paths))),
        rollups.student_problem(attempts),
    )


def roll_up(student_problem: DataFrame) -> dict[str, DataFrame]:
    """Student, task and assignment tables; ``student_problem`` should be materialised."""
    students = materialize(rollups.student_level(student_problem))
    return {
        "problem_level": rollups.problem_level(student_problem),
        "student_level": students,
        "assignment_level": rollups.assignment_level(students),
    }


def run_study(
    spark: SparkSession,
    input_dir: str,
    output_dir: str,
    formats="csv",
    convert_states: bool = False,
    state_mapping: DataFrame | None = None,
    overwrite: bool = False,
    extra_columns: bool = True,
    database: str | None = None,
) -> tuple[str, str]:
    """Process one unpacked export and return ``(study id, output folder)``."""
    formats = check_formats(formats)
    study = files.read_study(spark, files.bundle_path(input_dir, "study"))
    name = files.study_id(study)
    folder = f"{output_dir.rstrip('/')}/{name}"
    target = spark._jvm.org.apache.hadoop.fs.Path(folder)
    if target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target) and not overwrite:
        raise FileExistsError(f"{folder} exists; pass overwrite=True or choose another folder")

    def save(df, table):
        write_table(df, table, folder, formats, database)

    roster = files.read_roster(spark, files.bundle_path(input_dir, "roster"))
    if roster is None:
        log.warning("the roster is empty; the data may be from a public session")
    else:
        log.info("students in roster: %d", roster.count())
        save(roster, "roster_metadata")
    tasks = materialize(files.task_metadata(
        files.read_tasks(spark, files.bundle_path(input_dir, "task")), convert_states))
    log.info("tasks: %d", rows_of(tasks))
    save(tasks, "task_metadata")

    events = records.read_events(
        spark, files.bundle_path(input_dir, "event_logs"), extra_columns)
    if convert_states:
        events = convert_event_states(events, state_mapping)
    events = materialize(events)  # the text is parsed once
    save(events.drop("seq"), "event_logs")
    check_tasks(events, tasks)

    attempts, student_problem = aggregate_events(event_lanes(events), tasks.select("taskNumber", "startState", "goalState"))
    save(attempts, "attempt_level")
    student_problem = materialize(student_problem)
    save(student_problem, "student_problem")
    levels = roll_up(student_problem)
    levels["assignment_level"] = materialize(levels["assignment_level"])
    for table, df in levels.items():
        save(df, table)
    write_study_info(study_info_lines(study, levels["assignment_level"]), folder)
    return name, folder
