"""A listing table that grows by batches without being rewritten.

Rows lie in buckets by the digest of their business key.  A version of the table is a
small list of which folder holds each bucket, written as a versioned table
(`sinks`), so readers see the old version until the new one is whole.  A batch
rewrites only the buckets in which it changes a row; the others keep their files.
"""

from __future__ import annotations

import json
import math
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tasador import schemas
from tasador.functions.rules import exact_key
from tasador.operators import keyed
from tasador.operators.bronze import key_distinct, union_batches
from tasador.session import cut_lineage, shared_dir
from tasador.sources import sinks

BUCKETS = 256
PARTS = 16
"""Folders of a stored batch: a bucket lies in one of them."""
ROWS_PER_ROUND = 2_000_000
"""Rows, of the batch and of the buckets it meets, that are compared and exchanged at a time."""
ROWS_PER_FILE = 250_000
ORDER = "ExtractedDate"
_OWN = ["_key", "_row"]
_LIST = "bucket int, path string, buckets int, columns string, width int"
_WIDTH, _FIRST_WIDTH = 16, 32
"""Bytes of a key's digest that are stored, and those of tables whose list does not say it."""


def _listed(spark: SparkSession, table: str) -> DataFrame:
    """(bucket, path, buckets, columns, width) of the current version."""
    folder = f"{table}/versions"
    if not sinks.versions(spark, folder):
        return spark.createDataFrame([], _LIST)
    found = sinks.read_current(spark, folder)
    return found if "width" in found.columns else found.withColumn("width", F.lit(_FIRST_WIDTH))


def _read(spark: SparkSession, paths: Sequence[str], columns: str | None) -> DataFrame:
    schema = StructType.fromJson(json.loads(columns)) if columns else schemas.BRONZE
    if not paths:
        return spark.createDataFrame([], schema).withColumns({"_key": F.lit(None).cast("binary"), "_row": F.lit(None).cast("bigint")})
    return spark.read.schema(StructType([*schema.fields]).add("_key", "binary").add("_row", "long")).parquet(*paths)


def read(spark: SparkSession, table: str) -> DataFrame:
    """All rows of the current version; an empty listing table if there is none.

    Columns that came with a later batch are null in the buckets it left alone.
    """
    entries = _listed(spark, table).select("path", "columns").collect()
    return _read(spark, [e["path"] for e in entries], entries[0]["columns"] if entries else None).drop(*_OWN)


def paths(spark: SparkSession, table: str) -> dict[int, str]:
    """The folder of every bucket of the current version."""
    return {e["bucket"]: e["path"] for e in _listed(spark, table).collect()}


def _digests(df: DataFrame, keys: Sequence[str], columns: Sequence[str], width: int) -> DataFrame:
    key = F.substring(exact_key([F.col(k) for k in keys]), 1, width)
    return df.withColumns({"_key": key, "_row": F.xxhash64(*[F.coalesce(F.col(c).cast("string"), F.lit("\x00")) for c in columns])})


def _bucket(buckets: int) -> Column:
    return F.pmod(F.xxhash64("_key"), F.lit(buckets)).cast("int")


def append(batch: DataFrame, table: str, keys: Sequence[str] = schemas.LISTING_KEY, buckets: int = BUCKETS) -> list[int]:
    """Add a batch, one row per key, the first sighting; returns the buckets that were rewritten.

    A batch row changes the table if its key is new, or if it was seen no later than
    the row that is there and differs from it.  Which do is settled on digests and
    dates of the buckets the batch could touch; a batch that is replayed changes
    nothing and writes nothing to the table.  The batch's rows are stored in the shared
    folder meanwhile, by parts of the buckets.  Buckets are compared and written a round of
    some `ROWS_PER_ROUND` rows at a time and the stored rows of a round go with it, so what is
    exchanged at once does not grow with the batch; the version is entered when all
    rounds are done.  `buckets` counts for a new table only.
    """
    spark = batch.sparkSession
    entries = _listed(spark, table).collect()
    buckets, width = (entries[0]["buckets"], entries[0]["width"]) if entries else (buckets, _WIDTH)
    listed = entries[0]["columns"] if entries else None
    known = _read(spark, [], listed).drop(*_OWN)
    columns = known.unionByName(batch.limit(0), allowMissingColumns=True).schema
    first = key_distinct(known.unionByName(batch, allowMissingColumns=True), keys)
    # Wide rows take a fraction of a checkpoint's room as columns.  Digests do not shrink, and are made anew.
    stage = f"{shared_dir(spark).rstrip('/')}/batch-{uuid.uuid4().hex}"
    placed = _digests(first, keys, columns.names, width).withColumn("_part", F.pmod(_bucket(buckets), F.lit(PARTS))).drop(*_OWN)
    placed.write.option("compression", "zstd").partitionBy("_part").parquet(stage)

    def stored(parts: Sequence[int]) -> DataFrame:
        plain = spark.read.schema(columns).parquet(*[f"{stage}/_part={p}" for p in parts])
        return _digests(plain, keys, columns.names, width).withColumn("_bucket", _bucket(buckets))

    folders = {e["bucket"]: e["path"] for e in entries}
    whole = spark.read.schema(StructType([*columns.fields]).add("_part", "integer")).parquet(stage)
    # At most PARTS numbers.
    sizes = {r["_part"]: r["count"] for r in whole.groupBy("_part").count().collect()}
    held = [path for b, path in folders.items() if b % PARTS in sizes]
    rows = sum(sizes.values()) + _read(spark, held, listed).count()
    each = math.ceil(len(sizes) / max(1, math.ceil(rows / ROWS_PER_ROUND)))
    parts, target, touched = sorted(sizes), f"{table}/data/{uuid.uuid4().hex}", []
    for at in range(0, len(parts), max(1, each)):
        own = parts[at : at + each]
        fresh = stored(own)
        near = {b: path for b, path in folders.items() if b % PARTS in own}
        touched += _merge(fresh, near, known, listed, columns, keys, buckets, width, target)
        for p in own:
            sinks.delete(spark, f"{stage}/_part={p}")
    sinks.delete(spark, stage)
    touched.sort()
    if not touched and entries:
        return []
    folders |= {b: f"{target}/_bucket={b}" for b in touched}
    listing = [(b, path, buckets, columns.json(), width) for b, path in sorted(folders.items())]
    sinks.overwrite(spark.createDataFrame(listing, _LIST), f"{table}/versions", 1)
    return touched


def _merge(
    fresh: DataFrame, folders: dict[int, str], known: DataFrame, listed: str | None, columns: StructType, keys: Sequence[str], buckets: int, width: int, target: str
) -> list[int]:
    """Write the buckets of `folders` and the new ones that rows of `fresh` change to `target`; returns their numbers."""
    spark = fresh.sparkSession
    # At most `buckets` numbers.
    sizes = {r["_bucket"]: r["count"] for r in fresh.groupBy("_bucket").count().collect()}
    old = _read(spark, [path for b, path in folders.items() if b in sizes], listed)
    there = old.select("_key", F.col(ORDER).alias("_seen"), F.col("_row").alias("_old"))
    earlier = F.col(ORDER).isNull() | (F.col("_seen").isNotNull() & (F.col(ORDER) <= F.col("_seen")))
    met = fresh.select(*_OWN, ORDER).join(there, "_key").select("_key", (earlier & (F.col("_old") != F.col("_row"))).alias("_wins"))
    matched = cut_lineage(met)
    # Null: a new key; false: the row that is there stays.
    marked = keyed.lookup(fresh.drop("_row"), matched, ["_key"])
    touched = sorted(r[0] for r in marked.filter("_wins is null or _wins").select("_bucket").distinct().collect())
    if not touched:
        return []
    kept = _read(spark, [folders[b] for b in touched if b in folders], listed).drop("_row")
    parts = marked.drop("_key", "_bucket")
    merged = known.unionByName(parts.filter("_wins is null").drop("_wins"), allowMissingColumns=True)
    if folders:
        # Only rows that a batch row may replace are compared with it; the others are as they were.
        held = keyed.lookup(kept, matched.filter("_wins"), ["_key"]).drop("_key")
        merged = merged.unionByName(held.filter("_wins is null").drop("_wins"), allowMissingColumns=True)
        # Every key of these comes twice.
        replaced = union_batches(held.filter("_wins").drop("_wins"), parts.filter("_wins").drop("_wins"))
        merged = merged.unionByName(keyed.keep_first(replaced, list(keys), [ORDER]), allowMissingColumns=True)
    placed = _digests(merged.select(*columns.names), keys, columns.names, width).withColumn("_bucket", _bucket(buckets))
    # One file a bucket, or several of bounded size: buckets are what is read and rewritten as a whole.
    rows = sum(sizes[b] for b in touched) + (kept.count() if folders else 0)
    files = max(1, math.ceil(rows / len(touched) / ROWS_PER_FILE))
    dealt = placed.repartition(len(touched) * files, "_bucket", F.pmod(F.xxhash64(F.lit(1), "_key"), F.lit(files)))
    dealt.write.mode("append").option("compression", "zstd").partitionBy("_bucket").parquet(target)
    return touched


def forget(spark: SparkSession, table: str, keep: int = 2) -> None:
    """Delete all versions but the last `keep`, and the bucket folders only they use."""
    folder = f"{table}/versions"
    numbers = sinks.versions(spark, folder)

    def used(number: int) -> set[str]:
        return {r["path"] for r in spark.read.parquet(f"{folder}/v{number}").select("path").collect()}

    held = set().union(*(used(n) for n in numbers[-keep:]))
    for number in numbers[:-keep]:
        for path in sorted(used(number) - held):
            sinks.delete(spark, path)
        sinks.delete(spark, f"{folder}/v{number}")
