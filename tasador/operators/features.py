"""Training features: scarcity, filters, rare categories."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tasador import schemas
from tasador.operators.keyed import lookup
from tasador.session import cut_lineage

# Fixed values.
EXCLUDED_SITES = ["COMPRAMOSTUCOCHE.ES", "CICAR"]
KEPT_FUELS = ["GASOLINA", "DIESEL"]
OTHER_FUEL = "OtroFuel"
OTHER_SEGMENT = "OtroSegmento"
OTHER_BRAND = "OTROS"
RARE_PERCENT = 0.1
RECENT_DAYS = 365


def scarcity(listings: DataFrame) -> DataFrame:
    """`Shortage`: one over the share of listings with the same brand and model.

    Rows without brand or model are not counted and get none.
    """
    keyed = listings.withColumn("_bm", F.concat("Brand", F.lit("_"), "Model"))
    counts = cut_lineage(keyed.dropna(subset=["_bm"]).groupBy("_bm").agg(F.count(F.lit(1)).alias("_n")))
    total = counts.agg(F.sum("_n")).first()[0] or 0
    shares = counts.select("_bm", (1.0 / (F.col("_n") / F.lit(total))).alias("Shortage"))
    return lookup(keyed, shares, ["_bm"]).drop("_bm")


def described(df: DataFrame) -> DataFrame:
    return df.filter(F.length("Features") > 0)


def valid(df: DataFrame) -> DataFrame:
    """Power and segment known, two sites left out (an unknown site stays)."""
    excluded = F.coalesce(F.col("Web").isin(EXCLUDED_SITES), F.lit(False))
    return df.filter(F.col("CV").isNotNull() & F.col("Segment").isNotNull() & ~excluded)


def recent(df: DataFrame, as_of: Column, days: int = RECENT_DAYS) -> DataFrame:
    """Published at most `days` whole days before `as_of`; later dates pass, missing ones do not."""
    seconds = F.unix_timestamp(as_of) - F.unix_timestamp("Publication")
    return df.filter(F.floor(seconds / 86_400) <= days)


def other_fuel(fuel: Column) -> Column:
    return F.when(fuel.isin(KEPT_FUELS), fuel).otherwise(F.lit(OTHER_FUEL))


def dense(text: Column) -> Column:
    return F.regexp_replace(text, "[- ]", "")


BROADCAST_PERCENT = 0.001
"""Shares from here on leave at most 100,000 values."""


def category_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(category, value, n) for several columns in one pass; a missing value is a value here."""
    pairs = F.array(*[F.struct(F.lit(n).alias("category"), F.col(n).alias("value")) for n in columns])
    return df.select(F.explode(pairs).alias("p")).groupBy("p.category", "p.value").agg(F.count(F.lit(1)).alias("n"))


def _frequent(counts: DataFrame, column: str, percent: float, strictly: bool) -> DataFrame:
    """Values of one column above a share.

    At most 100/percent values can be, so they are broadcast down to `BROADCAST_PERCENT`; below, the join is shuffled.
    """
    own = counts.filter(F.col("category") == column)
    total = own.agg(F.sum("n")).first()[0] or 0
    share = 100 * F.col("n") / F.lit(total)
    known = own.filter(F.col("value").isNotNull() & ((share > percent) if strictly else (share >= percent)))
    named = known.select(F.col("value").alias(column), F.lit(True).alias("_frequent"))
    return F.broadcast(named) if percent >= BROADCAST_PERCENT else named


def group_rare(df: DataFrame, labels: dict[str, str], percent: float = RARE_PERCENT) -> DataFrame:
    """Values whose share of all rows is below `percent` become the column's label."""
    counts = cut_lineage(category_counts(df, list(labels)))
    for column, label in labels.items():
        marked = df.join(_frequent(counts, column, percent, strictly=False), column, "left")
        keep = F.col(column).isNull() | F.col("_frequent").isNotNull()
        df = marked.withColumn(column, F.when(keep, F.col(column)).otherwise(F.lit(label))).drop("_frequent")
    return df


def drop_rare(df: DataFrame, column: str, percent: float = RARE_PERCENT) -> DataFrame:
    """Only rows whose value's share is above `percent`."""
    counts = cut_lineage(category_counts(df, [column]))
    return df.join(_frequent(counts, column, percent, strictly=True).drop("_frequent"), column, "left_semi")


def distinct_features(df: DataFrame) -> DataFrame:
    return df.select(*schemas.GOLDEN_FEATURES).distinct()


def in_bounds(df: DataFrame) -> DataFrame:
    return df.filter((F.col("Age") < 20) & (F.col("Kms") < 300_000) & (F.col("CV") <= 650))
