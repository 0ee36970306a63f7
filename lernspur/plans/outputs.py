"""Sinks for the result tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..runtime import join_lookup, materialize
from ..schemas import K2, K4, STUDENT, STUDY_INFO_FILE

FORMATS = ("csv", "parquet", "table")
# Order of the rows in each written table.
SORTED_BY = {
    "attempt_level": K4,
    "student_problem": K2,
    "student_level": [STUDENT],
    "problem_level": ["taskNumber"],
    "task_metadata": ["taskNumber"],
    "assignment_level": ["metric"],
}
SEPARATOR = "-" * 60


def check_formats(formats) -> tuple[str, ...]:
    formats = (formats,) if isinstance(formats, str) else tuple(formats)
    unknown = [f for f in formats if f not in FORMATS]
    if unknown or not formats:
        raise ValueError(f"unsupported output format {unknown or formats}; use {', '.join(FORMATS)}")
    return formats


def write_table(df: DataFrame, name: str, folder: str, formats, database: str | None = None,
                mode: str = "overwrite") -> None:
    """Write one result in each format: ``<folder>/<name>`` files, or a catalog table.

    For several formats the result is worked out once, stored in its order and written from there.
    """
    formats = check_formats(formats)
    order = SORTED_BY.get(name)
    if order:
        df = df.orderBy(*order)
    if len(formats) > 1:
        df = materialize(df)
        # Reading packs files as it likes; few rows are put in order again, from what is stored.
        df = df.orderBy(*order) if order else df
    for fmt in formats:
        if fmt == "csv":
            maps = {c: F.to_json(c) for c, kind in df.dtypes if kind.startswith("map")}
            df.withColumns(maps).write.mode(mode).option("header", True).csv(f"{folder}/{name}.csv")
        elif fmt == "parquet":
            df.write.mode(mode).parquet(f"{folder}/{name}.parquet")
        else:
            df.write.mode(mode).saveAsTable(f"{database}.{name}" if database else name)


def write_by_task(events: DataFrame, folder: str, rows_per_file: int = 5_000_000) -> None:
    """Store the log with one folder per task, so that a task can be read alone.

    Rows are counted by task first: a task has a writer for each ``rows_per_file`` rows, events without a task like
    any other, so no task of the job has many more rows than that.
    """
    key = F.coalesce(F.col("taskNumber").cast("string"), F.lit("none"))
    sizes = materialize(events.groupBy(key.alias("_key")).agg(
        F.ceil(F.count(F.lit(1)) / rows_per_file).cast("int").alias("_writers")))
    # A few numbers for each task; each writer sorts its own rows.
    spread = join_lookup(events.withColumn("_key", key), sizes, ["_key"]).withColumn(
        "_writer", F.pmod(F.xxhash64("studentSessionId", "seq"), F.col("_writers")))
    (spread.repartition("_key", "_writer")
     .sortWithinPartitions("taskNumber", "studentSessionId", "timestamp", "seq").drop("_key", "_writers", "_writer")
     .write.mode("overwrite").option("maxRecordsPerFile", rows_per_file).partitionBy("taskNumber").parquet(folder))


def read_by_task(spark: SparkSession, folder: str, number: int) -> DataFrame:
    return spark.read.parquet(folder).where(F.col("taskNumber") == number)


def append_chunk(df: DataFrame, name: str, chunk: str, path: str | None = None) -> None:
    """Add a chunk of rows to the catalog table ``name``, once.

    The table is partitioned by ``chunk``; a chunk that is there already is replaced as a whole, so a job that died
    may append all its chunks again. ``path`` is where the table lies if it does not exist yet.
    """
    rows = df.withColumn("chunk", F.lit(chunk))
    spark = df.sparkSession
    if not spark.catalog.tableExists(name):
        empty = rows.limit(0).write.partitionBy("chunk")
        (empty.option("path", path) if path else empty).format("parquet").saveAsTable(name)
    own = df.select(*[c for c in spark.table(name).columns if c != "chunk"])
    literal = chunk.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"INSERT OVERWRITE TABLE {name} PARTITION (chunk = '{literal}') SELECT * FROM {{rows}}", rows=own)


def study_info_lines(study: DataFrame, assignment: DataFrame | None = None) -> DataFrame:
    """Lines of the readable study summary: description first, then the student statistics."""
    bar = study.sparkSession.range(1).select(
        F.lit(0).alias("part"), F.lit(-1).alias("position"), F.lit(SEPARATOR).alias("line"))
    lines = bar.unionByName(study.select(
        F.lit(0).alias("part"), "position", F.concat_ws(": ", "key", F.coalesce("value", F.lit("None"))).alias("line")))
    if assignment is None:
        return lines
    numbers = [c for c in assignment.columns if c != "metric"]
    text = F.concat_ws("  ", F.col("metric"), *[
        F.concat(F.lit(f"{c}="), F.coalesce(F.format_number(c, 6), F.lit("NaN"))) for c in numbers])
    return lines.unionByName(bar.withColumn("part", F.lit(1))).unionByName(
        assignment.select(F.lit(1).alias("part"), F.lit(0).alias("position"), text.alias("line")))


def write_study_info(lines: DataFrame, folder: str) -> None:
    """A few dozen lines, so one file."""
    (lines.orderBy("part", "position", "line").select("line").coalesce(1)
     .write.mode("overwrite").text(f"{folder}/{STUDY_INFO_FILE}"))
