"""The batch append of `operators.bronze`, run once per micro-batch.

The table is bucketed by key (`sources.bucketed`): a micro-batch rewrites only the
buckets in which it changes a row.  A batch that is replayed after a failure meets
either the old or the new version; both give the same rows, because appending a
batch twice changes nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tasador import schemas
from tasador.sources import bucketed


def append_files(
    spark: SparkSession,
    source: str,
    table: str,
    checkpoint: str,
    keys: Sequence[str] = schemas.LISTING_KEY,
    buckets: int = bucketed.BUCKETS,
) -> StreamingQuery:
    """Append Parquet files of raw listings that appear in `source` to the bucketed `table`.

    Takes all files that are there and ends; call it again for the next ones.
    """

    def add(batch: DataFrame, _: int) -> None:
        bucketed.append(batch, table, keys, buckets)

    stream = spark.readStream.schema(schemas.BRONZE).parquet(source)
    return (
        stream.writeStream.foreachBatch(add)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
