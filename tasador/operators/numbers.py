"""Dense numbers for keys, the same on every run.

A hash into a fixed range gives two keys one number as soon as there are enough of
them.  Here every key gets the next free number once and keeps it: a registry is a
folder of versions, each holding the keys that were new in one run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tasador.operators.keyed import BROADCAST_ROWS, lookup
from tasador.session import discard, store
from tasador.sources import sinks

SCHEMA = "key binary, number bigint"
_ROW = (1 << 33) - 1
"""The lower bits of `monotonically_increasing_id`: the row in its partition."""


def known(spark: SparkSession, folder: str) -> DataFrame:
    """(key, number) of all whole versions of the registry."""
    found = [f"{folder}/v{n}" for n in sinks.versions(spark, folder)]
    return spark.read.schema(SCHEMA).parquet(*found) if found else spark.createDataFrame([], SCHEMA)


def numbered(keys: DataFrame, first: int) -> DataFrame:
    """(key, number) for the distinct keys of (key), from `first` on in the order of the keys.

    Keys are range-partitioned and counted per partition; a key's number is the count
    of the partitions before plus its row, so no task sees them all and the result
    does not depend on the partitioning.  What reaches the driver is a count per
    partition.
    """
    ordered = keys.repartitionByRange("key").sortWithinPartitions("key")
    placed = store(ordered.select("key", F.monotonically_increasing_id().alias("_id")))
    part = F.shiftright("_id", 33)
    counts = {r["part"]: r["n"] for r in placed.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).collect()}
    offsets, before = [], first
    for p in sorted(counts):
        offsets.append((p, before))
        before += counts[p]
    starts = keys.sparkSession.createDataFrame(offsets, "part bigint, start bigint")
    joined = placed.withColumn("part", part).join(F.broadcast(starts), "part")  # as many rows as partitions
    numbers = joined.select("key", (F.col("start") + F.col("_id").bitwiseAND(F.lit(_ROW))).alias("number"))
    numbers._folder = getattr(placed, "_folder", None)  # `discard` of the numbers deletes what they are made of
    return numbers


def register(keys: DataFrame, folder: str) -> DataFrame:
    """Give the keys of (key) that the registry does not hold their numbers; returns the whole registry.

    Null keys get none.  A run that fails before its version is whole leaves nothing behind.
    """
    spark = keys.sparkSession
    old = known(spark, folder)
    first = old.agg(F.max("number")).first()[0]
    new = keys.select(F.col("key").cast("binary").alias("key")).dropna().distinct().join(old, "key", "left_anti")
    numbers = numbered(new, 0 if first is None else first + 1)
    sinks.overwrite(numbers, folder)
    discard(numbers)
    return known(spark, folder)


def with_number(df: DataFrame, key: Column, folder: str, name: str) -> DataFrame:
    """`df` plus the number of its key as `name`; keys the registry lacks are entered first.  A null key has no number."""
    keyed = store(df.withColumn("key", key))
    registry = register(keyed.select("key"), folder)
    # Few rows: their part of a grown registry may be broadcast.  Else both are shuffled, and finding that part would only shuffle them once more.
    few = bool(sinks.versions(df.sparkSession, folder)[1:]) and keyed.count() <= BROADCAST_ROWS
    wanted = registry.join(keyed.select("key").distinct(), "key", "left_semi") if few else registry
    return lookup(keyed, wanted.withColumnRenamed("number", name), ["key"]).drop("key")
