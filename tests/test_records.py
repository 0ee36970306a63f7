"""The reader of event records: order over files, values, problems, and times."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from lernspur import bad_records, bundle_manifest, read_events
from lernspur.functions import times as tm
from lernspur.plans import outputs
from lernspur.schemas import BUNDLE_FILES
from lernspur.sources import records
from tests.helpers import rows


def write(path, lines):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join(x if isinstance(x, str) else json.dumps(x) for x in lines) + "\n")
    return str(path)


@pytest.fixture
def small_splits(spark):
    """Files are read in pieces of a few hundred bytes, many to a task."""
    names = {"spark.sql.files.maxPartitionBytes": "400", "spark.sql.files.openCostInBytes": "10", "spark.sql.files.minPartitionNum": "1"}
    for k, v in names.items():
        spark.conf.set(k, v)
    yield
    for k in names:
        spark.conf.unset(k)


def test_order_over_files_and_pieces(spark, tmp_path, small_splits):
    """A small file before a large one, blank lines between, and files whose sizes are not in the order of their names."""
    number, sizes = 0, [1, 90, 3, 40, 1, 7]
    for k, size in enumerate(sizes):
        lines = []
        for _ in range(size):
            lines += [{"studentSessionId": "s", "attemptNumber": number, "oldState": "x" * (number % 50)}] + [""] * (number % 3)
            number += 1
        write(tmp_path / "log" / f"part-{k}.json", lines)
    log = read_events(spark, str(tmp_path / "log"))
    assert log.rdd.getNumPartitions() > 8
    got = [r.attemptNumber for r in log.orderBy("seq").collect()]
    assert got == list(range(number))
    assert log.select("seq").distinct().count() == number


VALUES = [
    ({"taskNumber": 3}, "taskNumber", 3, None), ({"taskNumber": 3.0}, "taskNumber", 3, None),
    ({"taskNumber": "3"}, "taskNumber", 3, None), ({"taskNumber": 1.5}, "taskNumber", None, "not whole"),
    ({"taskNumber": "x"}, "taskNumber", None, "not a number"), ({"stars": 3e9}, "stars", None, "out of range"),
    ({"stars": None}, "stars", None, None), ('{"stars": NaN}', "stars", None, None), ({"dx": "-1.25"}, "dx", -1.25, None),
    ({"dy": "left"}, "dy", None, "not a number"), ({"wasSolved": True}, "wasSolved", True, None),
    ({"wasSolved": 0}, "wasSolved", False, None), ({"wasSolved": "perhaps"}, "wasSolved", None, "not a boolean"),
    ({"timestamp": "soon"}, "timestamp", None, "not a time"), ({"oldState": {"a": [1]}}, "oldState", '{"a":[1]}', None),
    ('{"reason": "a", "reason": "b"}', "reason", "b", None),
]


@pytest.mark.parametrize("on_error", ["raise", "null"])
def test_values(spark, tmp_path, on_error):
    lines = [v[0] for v in VALUES if on_error == "null" or v[3] is None]
    wanted = [v for v in VALUES if on_error == "null" or v[3] is None]
    path = write(tmp_path / "log.json", lines)
    got = read_events(spark, path, on_error=on_error).orderBy("seq").collect()
    assert [r[v[1]] for r, v in zip(got, wanted)] == [v[2] for v in wanted]


BROKEN = ['{"taskNumber": 1', '{"taskNumber": 1} x', '{"taskNumber": 1}{"taskNumber": 2}', '[{"taskNumber": 1}]', "3", "null",
          "{'taskNumber': 1}", '{"taskNumber": 1},{"taskNumber": 2}']


def test_problems_are_reported(spark, tmp_path):
    path = write(tmp_path / "log.json", [*BROKEN, *[v[0] for v in VALUES], {"taskNumber": 7}])
    found = bad_records(spark, path).orderBy("seq").collect()
    assert [(r.column, r.reason) for r in found] == [
        *[(None, "not a JSON object")] * len(BROKEN), *[(v[1], v[3]) for v in VALUES if v[3]]]
    assert [r.text for r in found][:len(BROKEN)] == BROKEN
    assert read_events(spark, path, on_error="null").count() == len(VALUES) + 1
    with pytest.raises(Exception, match="not a JSON object"):
        read_events(spark, path).count()
    with pytest.raises(ValueError, match="on_error"):
        read_events(spark, path, on_error="skip")
    one = write(tmp_path / "one.json", [{"timestamp": "soon"}])
    with pytest.raises(Exception, match="not a time: timestamp = soon"):
        read_events(spark, one).select("stars").collect()


def test_keys_outside_the_schema(spark, tmp_path, monkeypatch):
    path = write(tmp_path / "log.json", [{"zoom": 1, "_id": "i", "b": {"c": 2}}, {"taskNumber": 1}, {"pan": None, "zoom": "x"}])
    assert [r.more for r in read_events(spark, path, "map").orderBy("seq").collect()] == [
        {"zoom": "1", "b": '{"c":2}'}, {}, {"pan": None, "zoom": "x"}]
    log = read_events(spark, path, True)
    assert log.columns[-4:] == ["zoom", "b", "pan", "seq"]
    assert [r.zoom for r in log.orderBy("seq").collect()] == ["1", None, "x"]
    monkeypatch.setattr(records, "MOST_EXTRA_COLUMNS", 2)
    with pytest.raises(ValueError, match="map"):
        read_events(spark, path, True)


TIMES = [
    ("2024-01-02 03:04:05", 1704164645), ("2024-01-02T03:04", 1704164640), ("2024-01-02T05:04:05+02:00", 1704164645),
    ("2024-01-02", 1704153600), ("1/2/2024 03:04:05", 1704164645), ("01/02/2024 3:04:05 AM", 1704164645),
    ("January 2, 2024 03:04:05", 1704164645), ("2 Jan 2024 03:04:05", 1704164645), ("2024/01/02 03:04:05", 1704164645),
    ("Tue, 02 Jan 2024 03:04:05 GMT", 1704164645), ("Tue, 02 Jan 2024 05:04:05 +0200", 1704164645), ("20240102030405", 1704164645),
    ("12:00", None), ("2024-13-01", None),
]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kathmandu"])
def test_times_in_any_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(TIMES)], "i int, t string")
        time = tm.parse_timestamp(F.col("t"))
        got = df.select("i", F.unix_micros(time).alias("u"), tm.zone_free(time).cast("string").alias("z"),
                        tm.utc_micros(tm.zone_free(time)).alias("back")).orderBy("i").collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    for r, (_, seconds) in zip(got, TIMES):
        assert r.u == r.back == (None if seconds is None else seconds * 1_000_000)
        assert r.z == (None if seconds is None else str(dt.datetime.fromtimestamp(seconds, dt.UTC).replace(tzinfo=None)))


def test_manifest_of_files_and_folders(spark, tmp_path):
    names = list(BUNDLE_FILES.values())
    for n in names[:4]:
        write(tmp_path / "all" / "one" / n, ["{}"])
    write(tmp_path / "all" / "two" / names[4] / "part-0", ["{}"])
    write(tmp_path / "all" / "study=three" / f"file={names[0]}" / "part-0", ["{}"])
    missing = {(r.study, r.missing) for r in bundle_manifest(spark, str(tmp_path / "all")).collect()}
    assert missing == {("one", names[4]), *[("two", n) for n in names[:4]], *[("three", n) for n in names[1:]]}


def test_writers_of_a_task_follow_its_rows(spark, tmp_path):
    events = spark.range(1000).selectExpr(
        "if(id < 20, NULL, if(id < 900, 1, cast(id % 3 + 2 AS int))) AS taskNumber", "'s' AS studentSessionId",
        "timestamp_seconds(id) AS timestamp", "id AS seq")
    outputs.write_by_task(events, str(tmp_path / "log"), rows_per_file=100)
    stored = spark.read.parquet(str(tmp_path / "log"))
    files = {r.taskNumber: r.n for r in stored.groupBy("taskNumber").agg(F.countDistinct("_metadata.file_path").alias("n")).collect()}
    assert files[None] == 1 and files[2] == 1 and 8 < files[1] < 20
    assert rows(stored.select(*events.columns)) == rows(events)


def test_appending_a_chunk_again_changes_nothing(spark, tmp_path):
    first, second = (spark.range(a, b).selectExpr("id", "cast(id AS string) AS t") for a, b in ((0, 5), (5, 9)))
    for chunk, df in (("a'1", first), ("b", second), ("a'1", first)):
        outputs.append_chunk(df, "chunks_of_a_test", chunk, path=str(tmp_path / "t"))
    got = spark.table("chunks_of_a_test")
    assert sorted((r.id, r.chunk) for r in got.collect()) == [(i, "a'1" if i < 5 else "b") for i in range(9)]
    outputs.append_chunk(first.limit(2), "chunks_of_a_test", "a'1")
    assert spark.table("chunks_of_a_test").count() == 6
    spark.sql("DROP TABLE chunks_of_a_test")


def test_reading_is_planned_once(spark):
    """What reads a record stands in the plan once, also below a filter on the problems it found."""
    lines = spark.createDataFrame([(k, f'{{"timestamp": "{k}", "stars": {k}}}') for k in range(3)], "seq long, value string")
    spoiled = lines.select("seq", F.when(F.col("seq") == 1, F.concat("value", "value")).otherwise(F.col("value")).alias("value"))
    found = records.problem_rows(records.parse_records(spoiled))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("yyyyMMddHHmmss") == 1
    assert plan.count("from_json") <= 2
    assert [r.seq for r in found.collect()] == [1]


def test_numbers_skip_formats_of_other_lengths(spark):
    """Microseconds are no text of any format, so none is tried; fourteen digits are."""
    texts = ["1704067200123456", "20240102030405", "1704067200123456789", "1704067200"]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select(F.unix_micros(tm.parse_timestamp(F.col("t")))).collect()
    assert [r[0] for r in got] == [1704067200123456, 1704164645000000, 1704067200123456, 1704067200000000]
    plain = spark.createDataFrame([("12345678",)], "t string").select(
        F.unix_micros(tm.parse_timestamp(F.col("t"), ("yyyyMMdd",))).alias("us"))
    assert plain.first().us == 12345678 * 1_000_000  # December of month 56: no date, so a number
