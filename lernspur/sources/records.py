"""Event records of newline JSON: read in order, typed, and with a report of all that could not be read."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from ..functions.times import bound, parse_timestamp
from ..runtime import join_lookup
from ..schemas import EVENT_SCHEMA, EVENT_TYPES_BY_COLUMN

DROPPED_KEYS = ("_id", "uid")
FILE_BITS = 22  # of a record's number; the other 41 hold its place in the file
MOST_EXTRA_COLUMNS = 1000
_STRICT = {"mode": "PERMISSIVE", "allowSingleQuotes": "false"}
_PROBLEM = "array<struct<column:string,text:string,reason:string>>"


def record_lines(spark: SparkSession, path: str) -> DataFrame:
    """(seq, value): the lines of one file or of all files of a folder, without blank ones.

    ``seq`` follows the files in the order of their names and the lines in each file. It is made of the file's
    rank, where the piece of the file that a task reads begins, and the line's number in that piece, which is below its
    number of bytes. So it is the same however files are cut, packed into tasks or read again.
    """
    lines = spark.read.text(path).where("btrim(value) <> ''").select(
        "value", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_start"),
        F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1).alias("_line"))
    place = F.col("_start") + F.col("_line")
    # Only the listing is read here.
    names = spark.read.format("binaryFile").load(path).select(F.col("_metadata.file_path").alias("_file")).distinct()
    count = names.count()
    if count > 1 << FILE_BITS:
        raise ValueError(f"{count} files under {path}; records of {1 << FILE_BITS} can be numbered")
    if count < 2:
        return lines.select(place.alias("seq"), "value")
    ranked = names.withColumn("_rank", (F.row_number().over(Window.orderBy("_file")) - 1).cast("long"))
    return join_lookup(lines, ranked, ["_file"], rows=count).select(
        (F.shiftleft("_rank", 63 - FILE_BITS) + place).alias("seq"), "value")


def _number(text: Column, kind: T.DataType) -> Column:
    """(value, reason): numbers are read wide; those of whole columns may be written ``3``, ``3.0`` or ``"3"``."""
    def read(wide: Column) -> Column:
        missing = text.isNull() | F.isnan(wide)
        if isinstance(kind, T.DoubleType):
            return _read(F.when(~missing, wide), F.when(~missing & wide.isNull(), "not a number"))
        whole = wide == F.floor(wide)
        fits = F.abs(wide) < float(1 << 31)
        reason = (F.when(missing, None).when(wide.isNull(), "not a number")
                  .when(~fits, "out of range").when(~whole, "not whole"))
        return _read(F.when(~missing & whole & fits, wide).try_cast(kind), reason)

    return bound(F.btrim(text, F.lit('"')).try_cast("double"), read)  # NaN comes in quotes


def _read(value: Column, reason: Column) -> Column:
    return F.struct(value.alias("value"), reason.cast("string").alias("reason"))


def _typed(text: Column, kind: T.DataType) -> Column:
    """(value, reason) of a text: what it says, or why that cannot be told."""
    if isinstance(kind, (T.IntegerType, T.DoubleType)):
        return _number(text, kind)
    if isinstance(kind, T.BooleanType):
        value = F.when(F.lower(text).isin("true", "1", "1.0"), True).when(F.lower(text).isin("false", "0", "0.0"), False)
        return bound(value, lambda v: _read(v, F.when(text.isNotNull() & v.isNull(), "not a boolean")))
    if isinstance(kind, T.TimestampType):
        return bound(parse_timestamp(text), lambda v: _read(v, F.when(text.isNotNull() & v.isNull(), "not a time")))
    return _read(text, F.lit(None))


def parse_records(lines: DataFrame, more: bool = False) -> DataFrame:
    """(seq, event columns, problems) of JSON lines; with ``more``, keys outside the schema in a map ``more``.

    Keys may come in any order; of a repeated key the last value counts. A line that is not one JSON object has all
    columns null. ``problems`` has a row for each value that could not be read, which is null in its column, or for the
    line; it is empty otherwise.
    """
    as_text = T.StructType([*[T.StructField(f.name, T.StringType()) for f in EVENT_SCHEMA],
                            T.StructField("_corrupt", T.StringType())])
    value = F.btrim("value")
    one = F.size(F.from_json(F.concat(F.lit("["), value, F.lit("]")), "array<string>", _STRICT)) == 1
    read = lines.select(
        "seq", "value", F.from_json(value, as_text, _STRICT | {"columnNameOfCorruptRecord": "_corrupt"}).alias("_r"),
        (F.startswith(value, F.lit("{")) & F.coalesce(one, F.lit(False))).alias("_one"))
    # As rows of a generator, so that what is filtered or selected later does not copy the reading into its own plan.
    read = read.select("seq", "value", F.inline(F.array(F.struct(
        (F.col("_one") & F.col("_r._corrupt").isNull()).alias("_good"), F.col("_r").alias("_text")))))
    read = read.select("seq", "value", "_good", "_text", F.inline(F.array(F.struct(*[
        _typed(F.when(F.col("_good"), F.col(f"_text.{n}")), k).alias(n) for n, k in EVENT_TYPES_BY_COLUMN.items()]))))
    columns = {name: F.col(f"{name}.value") for name in EVENT_TYPES_BY_COLUMN}
    problems = [
        F.when(F.col(f"{name}.reason").isNotNull(), F.struct(
            F.lit(name).alias("column"), F.col(f"_text.{name}").alias("text"), F.col(f"{name}.reason").alias("reason")))
        for name, kind in EVENT_TYPES_BY_COLUMN.items() if not isinstance(kind, T.StringType)]
    line = F.when(~F.col("_good"), F.struct(
        F.lit(None).cast("string").alias("column"), F.col("value").alias("text"), F.lit("not a JSON object").alias("reason")))
    out = {"problems": F.array_compact(F.array(line, *problems)).cast(_PROBLEM)}
    if more:
        known = [*columns, *DROPPED_KEYS]
        keys = F.from_json(F.btrim("value"), "map<string,string>", _STRICT)
        out["more"] = F.when(F.col("_good"), F.map_filter(keys, lambda k, _: ~k.isin(*known)))
    return read.select("seq", *[c.alias(n) for n, c in columns.items()], *[c.alias(n) for n, c in out.items()])


def problem_rows(parsed: DataFrame) -> DataFrame:
    """(seq, column, text, reason) of all that could not be read; ``column`` is null for whole lines."""
    return parsed.where(F.size("problems") > 0).select("seq", F.inline("problems"))


def bad_records(spark: SparkSession, path: str) -> DataFrame:
    """What :func:`read_events` cannot read at ``path``: (seq, column, text, reason)."""
    return problem_rows(parse_records(record_lines(spark, path)))


def without_problems(parsed: DataFrame, on_error: str) -> DataFrame:
    """The records, with ``problems`` settled: ``raise`` ends the job at one, ``null`` keeps what could be read.

    With ``null``, lines that are no JSON objects have no row, other values that could not be read are null;
    :func:`problem_rows` has them all.
    """
    if on_error == "raise":
        first = F.col("problems")[0]
        text = F.concat(F.lit("record "), F.col("seq"), F.lit(": "), first["reason"], F.lit(": "),
                        F.coalesce(F.concat(first["column"], F.lit(" = ")), F.lit("")), F.substring(first["text"], 1, 200))
        kept = F.when(F.size("problems") == 0, True).otherwise(F.raise_error(text).cast("boolean"))
    elif on_error == "null":
        kept = ~F.exists("problems", lambda p: p["column"].isNull())
    else:
        raise ValueError(f"on_error is 'raise' or 'null', not {on_error!r}")
    return parsed.where(kept).drop("problems")


def read_events(spark: SparkSession, path: str, extra_columns: bool | str = False, on_error: str = "raise") -> DataFrame:
    """Typed event log from newline JSON, with ``seq`` numbering the records in the order of files and lines.

    Records are read by key, so their key order does not matter and absent keys are null. ``extra_columns`` keeps keys
    outside the known schema: with ``"map"`` in one map column ``more``; with True as a text column each, in the order of
    their first use, at the price of one more pass to find them. More than MOST_EXTRA_COLUMNS such keys are an error, as
    they come to the driver. For ``on_error`` see :func:`without_problems`.
    """
    parsed = parse_records(record_lines(spark, path), more=bool(extra_columns))
    log = without_problems(parsed, on_error)
    if extra_columns is True:
        keys = parsed.select("seq", F.posexplode(F.map_keys("more"))).groupBy("col").agg(
            F.min(F.struct("seq", "pos")).alias("first"))
        names = [r.col for r in keys.orderBy("first").limit(MOST_EXTRA_COLUMNS + 1).collect()]
        if len(names) > MOST_EXTRA_COLUMNS:
            raise ValueError(f"over {MOST_EXTRA_COLUMNS} keys outside the schema; use extra_columns='map'")
        log = log.select("*", *[F.col("more")[n].alias(n) for n in names]).drop("more")
    return log.select(*[c for c in log.columns if c != "seq"], "seq")
