"""Reading and storing as queries: the log goes out as text or tables and comes back through the library's own readers."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, functions as F

from ..functions import times as tm
from ..operators.ordered import Lanes, Previous
from ..runtime import materialize, table_root
from ..schemas import BUNDLE_FILES, STUDENT
from ..sources import files, records
from ..sources.clickstream import LOG_COLUMNS
from . import outputs
from .base import log, published, table

MONTHS = ("Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec")
_LIST = [c for c in LOG_COLUMNS if c != "seq"]


def _scratch(spark) -> str:
    return f"{table_root(spark)}/lernspur-intake/{uuid.uuid4().hex}"


def _as_json(events: DataFrame) -> DataFrame:
    """(seq, value): records as an export may have them, with keys in several orders and numbers and times in several forms."""
    clock = F.replace(tm.zone_free(F.col("timestamp")).cast("string"), F.lit("T"), F.lit(" "))
    micros = F.unix_micros("timestamp").cast("string")
    form = F.col("seq") % 4
    time = (F.when(form == 0, tm.utc_text(F.col("timestamp")))
            .when(form == 1, clock)
            .when(form == 2, micros)
            .otherwise(F.regexp_replace(clock, r"^(\d+)-(\d+)-(\d+) (\d+:\d+:\d+)(\.\d+)?$", "$2/$3/$1 $4")))
    # The form without a fraction is used where there is none.
    time = F.when((form == 3) & (F.unix_micros("timestamp") % 1_000_000 != 0), clock).otherwise(time)
    events = events.withColumns({"timestamp": time, "record": F.col("seq"), "_id": F.concat(F.lit("id"), "seq"), "uid": F.lit("x")})
    names = ["_id", *_LIST, "uid", "record"]

    def json(kind, order):
        return F.to_json(F.struct(*[F.col(n).cast(kind).alias(n) if n in ("taskNumber", "stars") else F.col(n) for n in order]))

    text = (F.when(F.col("seq") % 3 == 0, json("int", names))
            .when(F.col("seq") % 3 == 1, json("double", names[::-1]))
            .otherwise(json("string", sorted(names))))
    return events.select("seq", text.alias("value"))


def event_log_json(spark, folder):
    """The log through newline JSON in several files, and for each record the student's record before it in file order."""
    path = _scratch(spark)
    # Part files are named in the order of seq.
    _as_json(log(spark, folder)).repartitionByRange("seq").sortWithinPartitions("seq").select("value").write.text(path)
    read = records.read_events(spark, path, extra_columns="map")
    read = read.withColumn("record", F.col("more")["record"].cast("long"))
    read = materialize(read.select("seq", "record", *_LIST))  # the text is parsed once
    lanes = Lanes.split(read, STUDENT, [STUDENT, "seq"])
    lanes = lanes.ordered([STUDENT], ["seq"], Previous("follows", F.col("record")))
    return published(lanes.merge().select(F.col("record").alias("seq"), *_LIST, "follows"))


def bad_records(spark, folder):
    """What the reader reports of a log in which some records are spoiled."""
    kind = F.col("seq") % 40
    events = log(spark, folder).select(
        "seq", STUDENT, "eventType",
        F.when(kind == 2, "1.5").when(kind == 7, "3.0").otherwise(F.col("taskNumber").cast("string")).alias("taskNumber"),
        F.when(kind == 3, "soon").otherwise(F.unix_millis("timestamp").cast("string")).alias("timestamp"),
        F.when(kind.isin(3, 4), "maybe").when(kind == 8, "true").alias("wasSolved"),
        F.when(kind == 5, "99999999999").when(kind == 9, "NaN").alias("stars"), F.when(kind == 6, "wide").alias("dx"))
    value = F.to_json(F.struct(*[c for c in events.columns if c != "seq"]))
    value = (F.when(kind == 0, F.substring(value, 1, 25)).when(kind == 1, F.concat(value, value))
             .when(kind == 10, F.concat(F.lit("["), value, F.lit("]"))).when(kind == 11, "null").otherwise(value))
    found = records.problem_rows(records.parse_records(events.select("seq", value.alias("value"))))
    return found.select("seq", "column", F.when(F.col("column").isNotNull(), F.col("text")).alias("text"), "reason")


def bundle_manifest(spark, folder):
    """Files missing from study folders: a study for each nation, of which some files were written."""
    names = F.array(*[F.lit(n) for n in BUNDLE_FILES.values()])
    written = table(spark, folder, "nation").select(
        F.concat(F.lit("study-"), F.col("n_nationkey")).alias("study"), "n_nationkey", F.posexplode(names).alias("k", "file"))
    path = _scratch(spark)
    written.where("(n_nationkey + k * k) % 4 != 0").select("study", "file", F.lit("{}").alias("value")).coalesce(1) \
        .write.partitionBy("study", "file").text(path)
    return files.bundle_manifest(spark, path)


def task_store(spark, folder):
    """The log stored by task, with as many writers for each task as its rows ask for; one task read back."""
    path = _scratch(spark)
    outputs.write_by_task(log(spark, folder).select(*LOG_COLUMNS), path, rows_per_file=500)
    return published(outputs.read_by_task(spark, path, 2).select(*LOG_COLUMNS))


def appended_chunks(spark, folder):
    """The log appended to a table in chunks, two of them twice as after a rerun."""
    name, path = f"lernspur_chunks_{uuid.uuid4().hex}", _scratch(spark)
    events = log(spark, folder).select(*LOG_COLUMNS)
    for chunk in (0, 1, 0, 2, 2):
        outputs.append_chunk(events.where(F.pmod("seq", F.lit(3)) == chunk), name, f"chunk-{chunk}", path=path)
    stored = spark.table(name)
    return published(stored.select(*LOG_COLUMNS, "chunk"))


QUERIES = {f.__name__: f for f in (event_log_json, bad_records, bundle_manifest, task_store, appended_chunks)}
