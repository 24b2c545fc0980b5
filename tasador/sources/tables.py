"""Reading catalog tables, dictionary files and settings."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tasador import schemas
from tasador.plans.silver import recent

LISTING_TABLES = r"^tb_.*task$"


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """A catalog table by name, or a Parquet folder by path."""
    return spark.read.parquet(name) if "/" in name else spark.read.table(name)


def read_or_empty(spark: SparkSession, name: str, schema: T.StructType) -> DataFrame:
    """The table if it exists, else no rows of its declared schema."""
    if spark.catalog.tableExists(name):
        return spark.read.table(name)
    return spark.createDataFrame([], schema)


def discover(spark: SparkSession, pattern: str = LISTING_TABLES, database: str | None = None) -> list[str]:
    """Names of the tables that match, in name order."""
    return sorted(t.name for t in spark.catalog.listTables(database) if re.search(pattern, t.name))


def read_recent(spark: SparkSession, names: Sequence[str], since: str) -> DataFrame:
    """Recent rows of all tables, stacked by name; a column one of them lacks is null there."""
    parts = [recent(spark.read.table(n), since) for n in names]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def read_dictionary(spark: SparkSession, path: str, schema: T.StructType = schemas.SEGMENT_CSV) -> DataFrame:
    return spark.read.csv(path, header=True, schema=schema)


def read_settings(spark: SparkSession, path: str) -> dict:
    """The one record of a JSON settings file."""
    return spark.read.json(path, multiLine=True).first().asDict(recursive=True)


def typed_rows(spark: SparkSession, rows: DataFrame | Iterable, schema: T.StructType) -> DataFrame:
    """Rows under a declared schema: a frame's columns by name, cast where they are, or rows of the program.

    Values that do not fit their type, and columns a frame lacks, are null; further columns go.
    """
    if not isinstance(rows, DataFrame):
        return spark.createDataFrame(rows, schema)
    have = set(rows.columns)
    return rows.select(*[(F.col(f"`{f.name}`").try_cast(f.dataType) if f.name in have else F.lit(None).cast(f.dataType)).alias(f.name) for f in schema])
