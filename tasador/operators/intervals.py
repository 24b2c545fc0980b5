"""Per-brand prediction intervals.

A band of +-z mean errors is tried for 450 values of z.  No row is tried 450
times: each row is given the first z whose band covers it, rows are counted per
(brand, z), and coverage is a running sum over at most 451 counts per brand.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tasador import schemas
from tasador.operators.keyed import lookup

# The grid and the two coverage targets.
Z_FIRST, Z_STEP, Z_COUNT = 0.5, 0.01, 450
SAFE, TIGHT = 0.95, 0.85


def scored(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """(Brand, y_real, y_pred, error)."""
    return df.select(
        "Brand",
        F.col(actual).cast("double").alias("y_real"),
        F.col(predicted).cast("double").alias("y_pred"),
        F.abs(F.col(actual) - F.col(predicted)).cast("double").alias("error"),
    )


def brand_stats(scores: DataFrame) -> DataFrame:
    return scores.dropna(subset=["Brand"]).groupBy("Brand").agg(
        F.count(F.lit(1)).alias("rows"), F.avg("error").alias("Mean_error"), F.avg("y_pred").alias("mean_pred")
    )


def _z(k: Column) -> Column:
    return F.lit(Z_FIRST) + k * F.lit(Z_STEP)


def _first_covering(mean_error: Column) -> Column:
    """Index of the first band that covers the row; Z_COUNT when none does.

    The quotient gives the index up to rounding; its neighbours are tested with
    the band itself.
    """
    guess = F.ceil((F.col("error") / F.when(mean_error > 0, mean_error) - Z_FIRST) / Z_STEP)
    guess = F.least(F.greatest(F.coalesce(guess, F.lit(0)), F.lit(0)), F.lit(Z_COUNT)).cast("int")

    def covers(k: Column) -> Column:
        reach = _z(k) * mean_error
        return (F.col("y_real") >= F.col("y_pred") - reach) & (F.col("y_real") <= F.col("y_pred") + reach)

    below = F.greatest(guess - 1, F.lit(0))
    return F.when(covers(below), below).when(covers(guess), guess).when(covers(guess + 1), guess + 1).otherwise(F.lit(Z_COUNT))


def grid(scores: DataFrame, use_cost: bool = True) -> DataFrame:
    """(Brand, Z, Coverage, Width, Mean_error, Cost, mean_pred): one row per brand and z."""
    stats = brand_stats(scores)
    placed = lookup(scores.dropna(subset=["Brand"]), stats.select("Brand", "Mean_error"), ["Brand"], "inner")
    counts = placed.groupBy("Brand", _first_covering(F.col("Mean_error")).alias("k")).agg(F.count(F.lit(1)).alias("n"))
    axis = stats.select("*", F.explode(F.sequence(F.lit(0), F.lit(Z_COUNT - 1))).alias("k"))
    running = Window.partitionBy("Brand").orderBy("k").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    z = _z(F.col("k"))
    rows = axis.join(counts, ["Brand", "k"], "left").select(
        "Brand",
        z.alias("Z"),
        (F.sum(F.coalesce("n", F.lit(0))).over(running) / F.col("rows")).alias("Coverage"),
        (2 * z * F.col("Mean_error")).alias("Width"),
        "Mean_error",
        "mean_pred",
    )
    gap, relative = 1 - F.col("Coverage"), F.col("Width") / F.col("mean_pred")
    return rows.withColumn("Cost", gap * gap + relative * relative if use_cost else F.col("Width"))


def best(table: DataFrame, coverage: float) -> DataFrame:
    """Cheapest band of each brand that reaches the coverage, the smallest z on a tie; none, no row."""
    packed = F.struct("Cost", "Z", "Coverage", "Width", "Mean_error", "mean_pred")
    chosen = table.filter(F.col("Coverage") >= coverage).groupBy("Brand").agg(F.min(packed).alias("b"))
    return chosen.select("Brand", "b.*").withColumn("Error_pct", error_percent(F.col("Mean_error"), F.col("mean_pred")))


def error_percent(mean_error: Column, mean_pred: Column) -> Column:
    return F.format_string("%.2f%%", mean_error / mean_pred * 100)


def compare(safe: DataFrame, tight: DataFrame) -> DataFrame:
    """Brands with both bands; the tight one unless the safe one costs less."""
    names = [n for n in schemas.INTERVALS.names if n != "Brand"]
    s = safe.select("Brand", F.struct(*names).alias("s"))
    t = tight.select("Brand", F.struct(*names).alias("t"))
    picked = s.join(t, "Brand").select("Brand", F.when(F.col("s.Cost") < F.col("t.Cost"), F.col("s")).otherwise(F.col("t")).alias("p"))
    return picked.select("Brand", "p.*")


def intervals(scores: DataFrame, safe: float = SAFE, tight: float = TIGHT) -> DataFrame:
    """`compare` of both `best` tables, from one aggregate over one grid."""
    packed = F.struct("Cost", "Z", "Coverage", "Width", "Mean_error", "mean_pred")

    def reaching(coverage: float) -> Column:
        return F.min(F.when(F.col("Coverage") >= coverage, packed))

    both = grid(scores).groupBy("Brand").agg(reaching(safe).alias("s"), reaching(tight).alias("t")).dropna(subset=["s", "t"])
    picked = both.select("Brand", F.when(F.col("s.Cost") < F.col("t.Cost"), F.col("s")).otherwise(F.col("t")).alias("p")).select("Brand", "p.*")
    return picked.withColumn("Error_pct", error_percent(F.col("Mean_error"), F.col("mean_pred"))).select(*schemas.INTERVALS.names)
