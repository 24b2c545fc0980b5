"""Shards of documents in random order: an external shuffle in two passes.

The first pass scatters the rows by a seeded hash into buckets that fit in memory
(one exchange), the second shuffles each bucket by Fisher-Yates and writes it.  The
buckets one after the other are the shuffled order of all rows; a shard is an
equal share of it, a list of row ranges in the bucket files.
"""

from __future__ import annotations

import math
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tasador.llm.common import scratch, stored
from tasador.llm.tokenfile import place

SHARDS = 24
SEED = 42
ROW_BYTES = 8
"""What a row takes besides its text."""
BUCKET_BYTES = 16 << 20
BATCH_BYTES = 1 << 20
LAW = "rows"

FILE = pa.schema([("doc_id", pa.int64()), ("text", pa.string()), ("size", pa.int64())])


def scatter(docs: DataFrame, seed: int = SEED, bucket_bytes: int = BUCKET_BYTES, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, text, size, bucket, row): the first pass, every bucket whole in one partition.

    There are as many buckets as the rows' sizes ask for, so a bucket holds about
    `bucket_bytes` whatever the size of the table; a text larger than that fills
    one by itself.  Rows are told apart by their place in their partition once that
    is sorted by content: a task that runs again numbers its rows as before, and
    copies of one row, also a third of all, go to buckets of their own each.
    """
    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))
    rows = rows.withColumn("size", F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint") + ROW_BYTES)
    total = rows.agg(F.sum("size")).first()[0] or 0
    buckets = max(1, math.ceil(total / bucket_bytes))
    ordered = rows.withColumn("_hash", F.xxhash64("text")).sortWithinPartitions("doc_id", "_hash", "text").drop("_hash")
    numbered = ordered.withColumn("row", F.monotonically_increasing_id())
    dealt = numbered.withColumn("bucket", F.pmod(F.xxhash64(F.lit(seed), F.col("row")), F.lit(buckets)).cast("int"))
    return dealt.repartitionById(buckets, F.col("bucket"))


def write(docs: DataFrame, folder: str, seed: int = SEED, bucket_bytes: int = BUCKET_BYTES, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Scatter, shuffle and write; returns (bucket, path, n, first), one row per bucket that holds rows.

    A bucket is an Arrow file of (doc_id, text, size).  `first`: rows in the buckets
    before.  The order within a bucket is a Fisher-Yates shuffle seeded by `seed`
    and the bucket's number, of its rows in the order of their numbers.  A task
    that runs again writes other files; only those that a finished task reports
    are in the result.
    """
    system, root = place(folder)
    system.create_dir(root, recursive=True)
    scattered = scatter(docs, seed, bucket_bytes, doc_id, text).sortWithinPartitions("bucket", "row").select("bucket", "doc_id", "text", "size")

    def shuffled(bucket: int, held: list[pa.RecordBatch]) -> tuple:
        rows = pa.Table.from_batches(held)
        order = np.arange(rows.num_rows)
        np.random.default_rng([seed, bucket]).shuffle(order)  # Fisher-Yates
        path = f"bucket-{bucket:06d}-{uuid.uuid4().hex}.arrow"
        each = max(1, rows.num_rows * BATCH_BYTES // max(BATCH_BYTES, rows.nbytes))
        with system.open_output_stream(f"{root}/{path}") as file, pa.ipc.new_file(file, FILE, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
            for i in range(0, len(order), each):
                # A batch at a time, so that the bucket is held once.
                writer.write_table(rows.take(pa.array(order[i : i + each])).cast(FILE).combine_chunks())
        return bucket, f"{folder}/{path}", rows.num_rows, each

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, held, done = None, [], []
        for batch in batches:
            numbers = batch.column(0).to_numpy()
            edges = [0, *(np.flatnonzero(np.diff(numbers)) + 1).tolist(), batch.num_rows]
            for a, b in zip(edges, edges[1:]):
                if a == b:
                    continue
                if current is not None and numbers[a] != current:
                    done.append(shuffled(current, held))
                    held = []
                current = int(numbers[a])
                held.append(batch.slice(a, b - a).drop_columns(["bucket"]))
        if held:
            done.append(shuffled(current, held))
        kinds = [pa.int32(), pa.string(), pa.int64(), pa.int64()]
        names = ["bucket", "path", "n", "per_batch"]
        yield pa.RecordBatch.from_arrays([pa.array([d[k] for d in done], kind) for k, kind in enumerate(kinds)], names=names)

    files = stored(scattered.mapInArrow(run, "bucket int, path string, n bigint, per_batch bigint"), "buckets")
    # One row per bucket goes through this window: numbers and names.
    before = F.sum("n").over(Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1))
    return files.withColumn("first", F.coalesce(before, F.lit(0)))


def slices(files: DataFrame, shards: int = SHARDS) -> DataFrame:
    """(shard, slot, path, row, n, per_batch): the row ranges that make up each shard, `slot` of their first row.

    Shard after shard takes its share of the order, so that the numbers of rows
    differ by one at most; with fewer rows than shards the last ones stay empty.
    """
    total = F.lit(files.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]).cast("bigint")
    short, longer = F.expr(f"_total div {shards}"), F.col("_total") % shards

    def shard_of(at):
        early = longer * (short + 1)
        later = longer + F.floor((at - early) / F.greatest(short, F.lit(1)))
        return F.when(at < early, F.floor(at / (short + 1))).otherwise(later).cast("int")

    spread = files.withColumn("_total", total).withColumn("shard", F.explode(F.sequence(shard_of(F.col("first")), shard_of(F.col("first") + F.col("n") - 1))))
    opens = F.col("shard") * short + F.least(F.col("shard"), longer)
    closes = opens + short + (F.col("shard") < longer).cast("int")
    a, b = F.greatest("first", opens), F.least(F.col("first") + F.col("n"), closes)
    return spread.select("shard", (a - opens).alias("slot"), "path", (a - F.col("first")).alias("row"), (b - a).alias("n"), "per_batch")


def read(ranges: DataFrame) -> DataFrame:
    """(doc_id, text, size, text_crc32, shard, slot) of every row in the ranges of `slices`, from the files.

    `text_crc32` is that of the text's UTF-8 bytes, of no bytes for a null text.
    """
    kinds = {"doc_id": pa.int64(), "text": pa.string(), "size": pa.int64(), "text_crc32": pa.int64(), "shard": pa.int32(), "slot": pa.int64()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in batch.to_pylist():
                system, path = place(part["path"])
                with system.open_input_file(path) as file:
                    source, first, last = pa.ipc.open_file(file), part["row"], part["row"] + part["n"]
                    for k in range(first // part["per_batch"], (last - 1) // part["per_batch"] + 1):
                        start = k * part["per_batch"]
                        a, b = max(first, start), min(last, start + part["per_batch"])
                        rows = source.get_batch(k).slice(a - start, b - a)
                        crc = [zlib.crc32(t.as_buffer() if t.is_valid else b"") for t in rows.column("text")]
                        slot = np.arange(a, b) - first + part["slot"]
                        columns = [*rows.columns, crc, np.full(b - a, part["shard"]), slot]
                        yield pa.RecordBatch.from_arrays([pa.array(c, kind) if not isinstance(c, pa.Array) else c for c, kind in zip(columns, kinds.values())], names=list(kinds))

    # A file's worth for each task: the rows are names, the work is in the files.
    ranges = ranges.repartition(max(1, ranges.select("path").distinct().count()))
    return ranges.mapInArrow(run, "doc_id bigint, text string, size bigint, text_crc32 bigint, shard int, slot bigint")


def sharded(docs: DataFrame, shards: int = SHARDS, seed: int = SEED, bucket_bytes: int = BUCKET_BYTES, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard), one row per row of `docs`, read back from the files.

    `size`: bytes of the text (null: none) plus 8.  The law is `rows`: the shards'
    row counts are at most one apart, slots run from 0 without a gap.
    `grown_shard` is null, as this law says nothing of another number of shards.
    The result repeats on the same partitions of `docs`.  Null ids and texts, empty
    and repeated rows stay, each with a slot of its own; an empty table gives no
    row; other columns are not read.
    """
    files = write(docs, scratch(docs.sparkSession, "shards"), seed, bucket_bytes, doc_id, text)
    found = read(slices(files, shards))
    return found.select("doc_id", "size", "text_crc32", F.lit(LAW).alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
