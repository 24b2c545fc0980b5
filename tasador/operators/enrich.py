"""Client requests with the features the model needs, in batch."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tasador.operators.keyed import lookup
from tasador.session import cut_lineage

# The client is compared within these distances.
CV_REACH, AGE_REACH = 5, 1
FALLBACK_QUANTILE = 0.9


def add_shortage(clients: DataFrame, golden: DataFrame) -> DataFrame:
    """Scarcity of the client's brand and model, else the 90th percentile of all patterns."""
    known = golden.groupBy("Brand", "Model").agg(F.min("Shortage").alias("Shortage"))
    fallback = golden.agg(F.percentile_approx("Shortage", FALLBACK_QUANTILE, 10_000)).first()[0]
    found = lookup(clients, known.dropna(subset=["Brand", "Model"]), ["Brand", "Model"])
    return found.withColumn("Shortage", F.coalesce("Shortage", F.lit(fallback).cast("double")))


def add_price_med(clients: DataFrame, golden: DataFrame) -> DataFrame:
    """Median new price of the patterns of equal brand, model and fuel with power and age close by.

    Patterns are folded to counted cells and clients to distinct requests; the
    two bands become equi-join keys (three ages, at most three power bins), so
    no request meets more than its own neighbourhood.
    """
    equal = ["Brand", "Model", "Fuel"]
    width = float(CV_REACH)
    cells = golden.groupBy(*equal, "CV", "Age", "PriceMed").agg(F.count(F.lit(1)).alias("n"))
    cells = cells.dropna(subset=["PriceMed"]).select(
        *equal, F.col("CV").cast("double").alias("cell_cv"), F.col("Age").cast("bigint").alias("age"), "PriceMed", "n"
    ).withColumn("bin", F.floor(F.col("cell_cv") / width))
    asked = clients.select(*equal, F.col("CV").cast("double").alias("CV"), F.col("Age").cast("bigint").alias("Age")).distinct()
    bins = F.sequence(F.floor((F.col("CV") - width) / width), F.floor((F.col("CV") + width) / width))
    ages = F.sequence(F.col("Age") - AGE_REACH, F.col("Age") + AGE_REACH)
    near = (
        asked.select("*", F.explode(bins).alias("bin"))
        .select("*", F.explode(ages).alias("age_key"))
        .join(cells.withColumnRenamed("age", "age_key"), [*equal, "bin", "age_key"])
        .filter(F.abs(F.col("cell_cv") - F.col("CV")) <= CV_REACH)
    )
    medians = near.groupBy(*equal, "CV", "Age").agg(F.expr("percentile(PriceMed, 0.5, n)").alias("PriceMed"))
    typed = clients.withColumns({"CV": F.col("CV").cast("double"), "Age": F.col("Age").cast("bigint")})
    return lookup(typed, cut_lineage(medians), [*equal, "CV", "Age"])


def enrich(clients: DataFrame, golden: DataFrame) -> DataFrame:
    """Brand, Shortage, the client's other columns in their order, PriceMed."""
    rest = [n for n in clients.columns if n != "Brand"]
    full = add_price_med(add_shortage(clients, golden), golden)
    return full.select("Brand", "Shortage", *rest, "PriceMed")
