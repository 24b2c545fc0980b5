"""The jobs as they are run: build, check, and only then replace the table.

A table that would be empty, or whose newest sighting is too old, is not written:
readers keep the version they have.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from tasador.operators.bronze import freshness, require_fresh, require_rows
from tasador.plans import pricelist, silver
from tasador.session import cut_lineage
from tasador.sources import sinks


def refresh_silver(bronze: DataFrame, segment_book: DataFrame, prices: DataFrame, folder: str, as_of, order: Mapping[str, list[str]], **options) -> str:
    """The next version of the silver table in `folder`; returns its path.

    `segment_book` is the workbook with its own headers, `order` names the
    columns that number the rows of the `book` and the `prices`.
    """
    spark = bronze.sparkSession
    history = sinks.read_current(spark, folder) if sinks.versions(spark, folder) else None
    segments = silver.segment_dimension(silver.segment_book(segment_book, order["book"]), order["book"])
    fallback = silver.fallback_dimension(prices, order["prices"])
    table = cut_lineage(silver.build_silver(bronze, segments, fallback, as_of, history=history, **options))
    require_rows(table, more_than=0)
    require_fresh(freshness(table.limit(0) if history is None else history, table, as_of))
    return sinks.overwrite(table, folder)


def refresh_price_list(raw: DataFrame, segments: DataFrame, folder: str, as_of) -> str:
    """The next version of the price list in `folder`; returns its path."""
    full, _ = pricelist.build_price_list(raw, segments, as_of)
    return sinks.overwrite(require_rows(cut_lineage(full), more_than=0), folder)


def forget(spark: SparkSession, folder: str, keep: int = 2) -> list[int]:
    """Delete all but the newest versions of a table; returns the numbers deleted."""
    old = sinks.versions(spark, folder)[: -max(1, keep)]
    for number in old:
        sinks.delete(spark, f"{folder}/v{number}")
    return old
