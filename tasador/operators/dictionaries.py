"""Key words and power values per brand and model, and the segment map."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tasador.functions.text import alphanumeric, bag, strip, token, tokens
from tasador.operators.keyed import keep_first, semi_lookup
from tasador.sources.sinks import overwrite


def key_word(t: Column) -> Column:
    """The part after "/" if any, alphanumerics only; null unless three or more characters and no digit."""
    word = alphanumeric(F.coalesce(token(F.upper(t), 1, "/"), F.upper(t)))
    return F.when((F.length(word) >= 3) & ~word.rlike("[0-9]"), word)


def keywords(prices: DataFrame) -> DataFrame:
    """(Brand, Model, Words): sorted distinct key words of the descriptions."""

    def telling(t: Column) -> Column:
        bare = strip(F.replace(t, F.lit("("), F.lit("")))
        return (t != "") & ((bare == "") | ((F.length(bare) > 3) & ~bare.rlike("^[0-9]")))

    found = prices.select(
        "Brand", "Model", F.explode_outer(F.filter(tokens(F.coalesce("Features", F.lit("-"))), telling)).alias("t")
    )
    # Distinct before collecting, so one model's rows are folded where they are read.
    words = found.select("Brand", "Model", key_word(F.col("t")).alias("word")).distinct()
    return words.groupBy("Brand", "Model").agg(F.sort_array(F.collect_set("word")).alias("Words"))


def powers(listings: DataFrame, prices: DataFrame, province: str = "LAS PALMAS") -> DataFrame:
    """(Brand, Model, Powers): sorted distinct powers offered in one province for models on the list."""
    plain = {n: alphanumeric(F.col(n)) for n in ("Brand", "Model")}
    known = prices.select(alphanumeric(F.col("Model")).alias("Model")).distinct()
    local = listings.filter((F.col("Province") == province) & F.col("CV").isNotNull())
    offered = local.select(*[v.alias(k) for k, v in plain.items()], "CV").distinct()
    return (
        semi_lookup(offered, known, ["Model"])
        .groupBy("Brand", "Model")
        .agg(F.sort_array(F.collect_set("CV")).alias("Powers"))
    )


def bags(prices: DataFrame) -> DataFrame:
    """The price list with its bags of words."""
    filled = prices.withColumn("Features", F.coalesce("Features", F.lit("-")))
    return filled.withColumn("Bags", bag(F.col("Features")))


def model_segments(listings: DataFrame, order: list[str]) -> DataFrame:
    """(Brand, Model, Segment): first known segment of each model."""
    known = listings.dropna(subset=["Brand", "Model", "Segment"]).select("Brand", "Model", *order, "Segment")
    return keep_first(known, ["Brand", "Model"], order).drop(*order)


def save(prices: DataFrame, listings: DataFrame, folder: str) -> dict[str, str]:
    """Write bags, key words and powers as versioned tables; returns the path of each."""
    return {
        "bags": overwrite(bags(prices), f"{folder}/bags"),
        "keywords": overwrite(keywords(prices), f"{folder}/keywords"),
        "powers": overwrite(powers(listings, prices), f"{folder}/powers"),
    }
