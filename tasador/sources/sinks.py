"""Writing tables.

A Parquet table cannot be overwritten by a plan that reads it.  A table is a
folder of numbered versions: a write goes to a new version, and a version counts
once its success marker is there, so readers see the old one until the new one
is whole, and a job lost half-way leaves nothing behind that is read.
"""

from __future__ import annotations

import os
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

DONE = "_SUCCESS"


def _fs(spark: SparkSession, folder: str):
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jvm.org.apache.hadoop.fs.Path


def versions(spark: SparkSession, folder: str) -> list[int]:
    """Numbers of the whole versions, oldest first."""
    fs, path = _fs(spark, folder)
    if not fs.exists(path(folder)):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(path(folder)) if s.isDirectory()]
    return sorted(int(n[1:]) for n in names if n.startswith("v") and fs.exists(path(f"{folder}/{n}/{DONE}")))


def _used(spark: SparkSession, folder: str) -> list[int]:
    fs, path = _fs(spark, folder)
    if not fs.exists(path(folder)):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(path(folder))]
    return [int(n[1:]) for n in names if n.startswith("v")]


def read_current(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/v{versions(spark, folder)[-1]}")


def overwrite(df: DataFrame, folder: str, partitions: int | None = None) -> str:
    """Replace table and schema; returns the version's path.  `partitions` bounds the number of files."""
    spark = df.sparkSession
    target = f"{folder}/v{max(_used(spark, folder), default=0) + 1}"
    (df.coalesce(partitions) if partitions else df).write.mode("errorifexists").parquet(target)
    return target


def overwrite_growing(df: DataFrame, folder: str) -> str:
    """Replace the rows and let the columns grow: columns only the old version has stay, as nulls."""
    spark = df.sparkSession
    if versions(spark, folder):
        old = read_current(spark, folder)
        df = old.limit(0).unionByName(df, allowMissingColumns=True)
    return overwrite(df, folder)


def delete(spark: SparkSession, path: str) -> None:
    """Remove one version of a table."""
    fs, make = _fs(spark, path)
    fs.delete(make(path), True)


def append_rows(df: DataFrame, folder: str) -> None:
    """Add rows to a plain Parquet folder (result tables stamped with a date)."""
    df.write.mode("append").parquet(folder)


def jdbc_options(settings: Mapping[str, str], environment: Mapping[str, str] = os.environ) -> tuple[str, dict[str, str]]:
    """URL and properties for a PostgreSQL write; the password comes from the environment unless given."""
    url = f"jdbc:postgresql://{settings['host']}:{settings['port']}/{settings['database']}"
    properties = {
        "user": settings.get("user") or environment["TASADOR_JDBC_USER"],
        "password": settings.get("password") or environment["TASADOR_JDBC_PASSWORD"],
        "driver": settings.get("driver", "org.postgresql.Driver"),
        "batchsize": str(settings.get("batchsize", 10_000)),
        "numPartitions": str(settings.get("partitions", 8)),
        "truncate": "true",
    }
    return url, properties


def write_jdbc(df: DataFrame, table: str, settings: Mapping[str, str], mode: str = "overwrite") -> None:
    """Needs a driver jar and a server; at most `partitions` connections are open at once."""
    url, properties = jdbc_options(settings)
    df.write.jdbc(url=url, table=table, mode=mode, properties=properties)
