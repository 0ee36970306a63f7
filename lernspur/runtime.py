"""Shared Spark plumbing: materialised tables, checked broadcasts, salted joins."""

from __future__ import annotations

import tempfile
import uuid
from dataclasses import dataclass
from functools import cache

from pyspark.sql import DataFrame, SparkSession, functions as F

# Settings read from the session, with their defaults.
HOT_ROWS = ("spark.lernspur.hotGroupRows", 2_000_000)
BROADCAST_ROWS = ("spark.lernspur.broadcastRows", 500_000)
BROADCAST_BYTES = ("spark.lernspur.broadcastBytes", 128 << 20)
FOLD_EVENTS = ("spark.lernspur.foldEvents", 1_000)
HOP_ROUNDS = ("spark.lernspur.hopRounds", 24)


def setting(spark: SparkSession, key: tuple[str, int]) -> int:
    return int(spark.conf.get(key[0], str(key[1])))


def table_root(spark: SparkSession) -> str:
    """Shared folder for intermediate tables: ``spark.checkpoint.dir`` of the session.

    Only a local session may fall back to a temporary folder; on a cluster the
    executors would not see each other's disks.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = _local_root()
    return root.rstrip("/")


@cache
def _local_root() -> str:
    return tempfile.mkdtemp(prefix="lernspur-")


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage with a durable copy, so a lost executor costs a re-read and not
    the whole loop so far. Parquet keeps column pruning and gives later joins a real size.
    """
    spark = df.sparkSession
    path = f"{table_root(spark)}/lernspur-tables/{uuid.uuid4().hex}"
    df.write.parquet(path)
    stored = spark.read.schema(df.schema).parquet(path)
    stored.__dict__["_lernspur_path"] = path
    return stored


def bucketed(df: DataFrame, key: str) -> DataFrame:
    """As :func:`materialize`, in buckets of ``key`` that later steps on it need not shuffle again."""
    spark = df.sparkSession
    name = f"lernspur_{uuid.uuid4().hex}"
    path = f"{table_root(spark)}/lernspur-tables/{name}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.write.format("parquet").bucketBy(buckets, key).option("path", path).saveAsTable(name)
    stored = spark.table(name)
    stored.__dict__.update(_lernspur_path=path, _lernspur_table=name)
    return stored


def forget(*tables: DataFrame) -> None:
    """Delete tables made by :func:`materialize` or :func:`bucketed` that no plan reads any more."""
    for stored in tables:
        spark = stored.sparkSession
        if "_lernspur_table" in stored.__dict__:
            spark.sql(f"DROP TABLE IF EXISTS {stored.__dict__['_lernspur_table']}")
        path = spark._jvm.org.apache.hadoop.fs.Path(stored.__dict__["_lernspur_path"])
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def rows_of(stored: DataFrame) -> int:
    """Row count of a materialised table; read from the file footers, once per table."""
    known = stored.__dict__.get("_lernspur_rows")
    if known is None:
        known = stored.count()
        stored.__dict__["_lernspur_rows"] = known
    return known


def stored_bytes(stored: DataFrame) -> int:
    """Size of a table made by :func:`materialize`, as its files say."""
    spark = stored.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(stored.__dict__["_lernspur_path"])
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(path).getLength()


def may_broadcast(df: DataFrame, rows: int) -> bool:
    """Whether ``rows`` rows of ``df`` may be sent to all executors: few enough, and where they are stored, small enough."""
    spark = df.sparkSession
    if rows > setting(spark, BROADCAST_ROWS):
        return False
    return "_lernspur_path" not in df.__dict__ or stored_bytes(df) <= setting(spark, BROADCAST_BYTES)


@dataclass(frozen=True)
class GroupSizes:
    """``limit`` rows make a group hot; ``hot`` holds the hot keys and their row counts ``n``."""

    limit: int
    largest: int
    hot: DataFrame | None


def group_sizes(df: DataFrame, keys: list[str]) -> GroupSizes:
    """Find the groups with too many rows for one task; only the key columns are read."""
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    largest = sizes.agg(F.max("n")).first()[0]
    limit = setting(df.sparkSession, HOT_ROWS)
    if (largest or 0) <= limit:
        return GroupSizes(limit, largest or 0, None)
    hot = sizes.where(F.col("n") > limit).withColumnsRenamed({k: f"_hot_{k}" for k in keys})
    return GroupSizes(limit, largest, materialize(hot))


def small_broadcast(stored: DataFrame) -> DataFrame:
    """``stored`` with a broadcast hint where its counted rows allow it, else as it is, for a shuffle join."""
    return F.broadcast(stored) if may_broadcast(stored, rows_of(stored)) else stored


def same_hot_key(keys: list[str]):
    return F.expr(" AND ".join(f"{k} <=> _hot_{k}" for k in keys))


def join_lookup(
    big: DataFrame, small: DataFrame, keys: list[str], how: str = "inner", rows: int | None = None
) -> DataFrame:
    """Join a fact table to a lookup table whose keys may be very unevenly used.

    ``rows`` is an upper bound for the rows of ``small``; without it ``small`` is counted,
    and should then be materialised. Up to the broadcast bound it is broadcast. Beyond it
    both sides are shuffled; fact rows of a hot key are spread over as many salts as the key
    has times the allowed rows, and only the lookup rows of hot keys are copied per salt.
    ``how`` may be inner, left, left_semi or left_anti.
    """
    if rows is None:
        rows = rows_of(small)
    if may_broadcast(small, rows):
        return big.join(F.broadcast(small), keys, how)
    sizes = group_sizes(big, keys)
    if sizes.hot is None:
        return big.join(small, keys, how)
    marks = sizes.hot.select(*[f"_hot_{k}" for k in keys], F.ceil(F.col("n") / sizes.limit).alias("_salts"))
    if may_broadcast(sizes.hot, rows_of(sizes.hot)):
        marks = F.broadcast(marks)

    def marked(df):
        return df.join(marks, same_hot_key(keys), "left").drop(*[f"_hot_{k}" for k in keys])

    salt = F.when(F.col("_salts").isNotNull(), F.pmod(F.xxhash64(*big.columns), F.col("_salts")))
    salted = marked(big).withColumn("_salt", F.coalesce(salt, F.lit(0).cast("long")))
    copies = marked(small).withColumn(
        "_salt", F.explode(F.expr("sequence(0L, coalesce(_salts, 1L) - 1)")))
    return salted.drop("_salts").join(copies.drop("_salts"), [*keys, "_salt"], how).drop("_salt")
