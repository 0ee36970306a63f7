"""Readers for an unpacked study export: one folder with five JSON files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..functions.states import canonical_latex
from ..schemas import BUNDLE_FILES, EVENT_TYPES_BY_COLUMN, TASK_SCHEMA, TASK_SESSION_COLUMNS
from .records import DROPPED_KEYS


def bundle_path(folder: str, key: str) -> str:
    if key not in BUNDLE_FILES:
        raise ValueError(f"unknown bundle file {key!r}; known: {', '.join(BUNDLE_FILES)}")
    return f"{folder.rstrip('/')}/{BUNDLE_FILES[key]}"


def key_inventory(lines: DataFrame, order: str, text: str = "value") -> DataFrame:
    """All JSON keys of a record column, where each was first seen, and how often."""
    keys = lines.select(F.col(order).alias("_o"), F.posexplode(F.json_object_keys(text)))
    first = F.min(F.struct(F.col("_o").alias("record"), F.col("pos").alias("position")))
    return keys.groupBy(F.col("col").alias("key")).agg(
        first.alias("_first"), F.count(F.lit(1)).alias("records")
    ).select("key", F.col("_first.record").alias("first_record"),
             F.col("_first.position").alias("first_position"), "records")


def fill_optional(df: DataFrame) -> DataFrame:
    """Add the event columns that ``df`` lacks, as typed nulls."""
    absent = {c: F.lit(None).cast(t) for c, t in EVENT_TYPES_BY_COLUMN.items() if c not in df.columns}
    return df.withColumns(absent) if absent else df


def event_types(df: DataFrame) -> DataFrame:
    """Drop document ids, complete and cast the event columns; other columns stay as they are."""
    df = fill_optional(df.drop(*DROPPED_KEYS))
    return df.withColumns({c: F.col(c).cast(t) for c, t in EVENT_TYPES_BY_COLUMN.items()})


def read_tasks(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(TASK_SCHEMA).json(path).withColumn(
        "seq", F.monotonically_increasing_id())


def latest_session_tasks(tasks: DataFrame) -> DataFrame:
    """Tasks of the session created last; among equals, the one listed first."""
    latest = tasks.agg(
        F.max_by("sessionId", F.struct("sessionCreatedAt", (-F.col("seq")).alias("o")))
        .alias("sessionId")
    )
    # A single row.
    return tasks.join(F.broadcast(latest), "sessionId", "left_semi")


def task_metadata(tasks: DataFrame, states_converted: bool = False) -> DataFrame:
    """Current tasks without session columns.

    Task states are compared with event states as text. Unless the event states were
    converted, the task states are brought to the event spelling and kept as logged in
    ``startState_asciimath`` and ``goalState_asciimath``.
    """
    current = latest_session_tasks(tasks).drop(*TASK_SESSION_COLUMNS, "seq")
    if states_converted:
        return current
    for c in ("startState", "goalState"):
        current = current.withColumn(f"{c}_asciimath", F.col(c)).withColumn(
            c, F.coalesce(canonical_latex(F.col(c)), F.col(c)))
    return current


def read_roster(spark: SparkSession, path: str) -> DataFrame | None:
    """Roster, or None for a public session, whose roster is empty."""
    roster = spark.read.option("multiLine", True).json(path)
    return None if not roster.columns or roster.isEmpty() else roster


def read_study(spark: SparkSession, path: str) -> DataFrame:
    """Study description as ``(position, key, value)``, in the order of the file."""
    document = spark.read.option("wholetext", True).text(path)
    return document.select(
        F.posexplode(F.from_json("value", T.MapType(T.StringType(), T.StringType())))
    ).withColumnRenamed("pos", "position")


def study_id(study: DataFrame) -> str:
    row = study.where(F.col("key") == "studyId").select("value").first()
    if row is None:
        raise ValueError("study description has no studyId")
    return row.value


def clean_attempt_export(df: DataFrame) -> DataFrame:
    """Attempt summaries shipped with an export, without ids and canvas settings."""
    return df.drop("_id", "classlessCanvas")


def bundle_manifest(spark: SparkSession, root: str) -> DataFrame:
    """Files missing from the study folders under ``root``: ``(study, missing)``.

    A study's file may be one file or a folder of part files of that name; folders may also be named as partitions,
    ``study=a/file=event-logs.ndjson``. Only names are listed, no file is opened. Empty files are not listed and so
    count as missing.
    """
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root).select("path")
    # The part of a path below the root: study, file, and part files if it is a folder.
    base = root.rstrip("/").rsplit("/", 1)[-1]
    below = F.split(F.substring_index("path", f"/{base}/", -1), "/")
    plain = F.transform(below, lambda p: F.regexp_replace(F.url_decode(p), r"^\w+=", ""))
    files = listed.select(plain[0].alias("study"), plain[1].alias("missing")).distinct()
    expected = files.select("study").distinct().withColumn(
        "missing", F.explode(F.array(*[F.lit(n) for n in BUNDLE_FILES.values()])))
    return expected.join(files, ["study", "missing"], "left_anti")


def union_studies(logs: dict[str, DataFrame]) -> DataFrame:
    """Logs of several studies in one table with ``studyId``."""
    out = None
    for name, log in logs.items():
        log = log.withColumn("studyId", F.lit(name))
        out = log if out is None else out.unionByName(log, allowMissingColumns=True)
    return out
