"""Appending a batch to a bronze table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tasador import schemas
from tasador.operators import latefetch
from tasador.operators.keyed import keep_first
from tasador.plans.silver import stamp

STALE_DAYS = 7


class EmptyBatch(ValueError):
    """Too few rows to go on."""


class StaleTable(ValueError):
    """The newest row is older than allowed."""


def union_batches(old: DataFrame, new: DataFrame) -> DataFrame:
    return old.unionByName(new, allowMissingColumns=True)


def exact_distinct(df: DataFrame) -> DataFrame:
    """Equal rows once; a row that comes once is not moved."""
    return latefetch.fold_repeated(df, df.columns, lambda rows: rows.distinct())


def key_distinct(df: DataFrame, keys: Sequence[str] = schemas.LISTING_KEY, late: bool = False) -> DataFrame:
    """One row per business key: the first sighting; a row whose key comes once is not moved.

    `late` chooses on narrow rows and fetches the wide ones afterwards: for large
    stored tables in which most keys come once.
    """
    if late:
        return latefetch.keep_first(df, list(keys), ["ExtractedDate"])
    return latefetch.fold_repeated(df, list(keys), lambda rows: keep_first(rows, list(keys), ["ExtractedDate"]))


def project(df: DataFrame) -> DataFrame:
    return df.select(*schemas.BRONZE.names)


def require_rows(df: DataFrame, more_than: int = 2) -> DataFrame:
    """`df` itself, or EmptyBatch when it has at most `more_than` rows."""
    if df.limit(more_than + 1).count() <= more_than:
        raise EmptyBatch(f"at most {more_than} rows")
    return df


def with_fallback(old: DataFrame, new: DataFrame) -> DataFrame:
    """Old and new rows; the old ones alone when the batch is empty, if they are more than two."""
    return require_rows(old) if new.isEmpty() else union_batches(old, new)


def append_batch(old: DataFrame, new: DataFrame, keys: Sequence[str] = schemas.LISTING_KEY, late: bool = False) -> DataFrame:
    return key_distinct(union_batches(old, new), keys, late)


def freshness(old: DataFrame, new: DataFrame, as_of, days: int = STALE_DAYS) -> DataFrame:
    """One row: rows before and after, rows gained, newest sighting, whether that is too old."""
    sides = old.select(F.lit(0).alias("side"), "ExtractedDate").unionByName(
        new.select(F.lit(1).alias("side"), "ExtractedDate")
    )
    after = F.col("side") == 1
    report = sides.agg(
        F.count_if(~after).alias("rows_before"),
        F.count_if(after).alias("rows_after"),
        F.max(F.when(after, F.col("ExtractedDate"))).cast("date").alias("last_extracted"),
    )
    return report.select(
        "rows_before",
        "rows_after",
        (F.col("rows_after") - F.col("rows_before")).alias("new_rows"),
        "last_extracted",
        (F.datediff(stamp(as_of), F.col("last_extracted")) > days).alias("stale"),
    )


def require_fresh(report: DataFrame) -> None:
    """StaleTable if the one-row report says so."""
    row = report.first()
    if row["stale"]:
        raise StaleTable(f"last extracted date {row['last_extracted']}")
