"""What several operators of this subpackage need: tables, scratch tables, Arrow batches."""

from __future__ import annotations

import itertools
import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tasador.session import configure, shared_dir

# A Python worker holds one batch at a time; long texts fill it before many rows do.
ARROW_SETTINGS = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1024",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(8 << 20),
}
WORD_BYTES = " \t\n\x0b\x0c\r"
"""The bytes that end a word: the space and 09 to 0D."""

_number = itertools.count()


def prepared(spark: SparkSession) -> SparkSession:
    """The session with the settings these operators expect; none changes a result."""
    configure(spark)
    for key, value in ARROW_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A folder name nobody has used, in the folder driver and executors share."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """`df` written to the shared folder and read again: lost executors cost no recomputation."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def barrier(df: DataFrame) -> DataFrame:
    """Keep the optimizer from merging the projections below and above.

    A text split into words is used many times above; merged projections would
    split it again for every use.  Costs a row counter and no exchange.
    """
    return df.observe(f"llm {next(_number)}", F.count(F.lit(1)).alias("rows"))


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept from learning: crc32 of its id as text leaves 2 on division by 4."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def map_arrow(df: DataFrame, rows: Callable[[pa.RecordBatch], dict[str, Iterable]], schema: str) -> DataFrame:
    """`rows` of every Arrow batch, as columns of `schema`; columns may be longer or shorter than the batch."""
    spark = df.sparkSession
    fields = spark.createDataFrame([], schema).schema.fields
    kinds = {f.name: _ARROW[f.dataType.simpleString()] for f in fields}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                found = rows(batch)
                yield pa.RecordBatch.from_arrays([pa.array(found[n], kinds[n]) for n in kinds], names=list(kinds))

    return df.mapInArrow(run, schema)


_ARROW = {
    "bigint": pa.int64(),
    "int": pa.int32(),
    "double": pa.float64(),
    "float": pa.float32(),
    "boolean": pa.bool_(),
    "string": pa.string(),
    "binary": pa.binary(),
    "array<bigint>": pa.list_(pa.int64()),
    "array<float>": pa.list_(pa.float32()),
    "array<string>": pa.list_(pa.string()),
}


def masked(values: np.ndarray, null: np.ndarray) -> pa.Array:
    return pa.array(values, mask=null)
