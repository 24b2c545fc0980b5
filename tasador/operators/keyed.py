"""One row per key, and joins of a fact table to a keyed dimension.

Both are written for keys that may hold a third of all rows.  Survivors are
chosen by an aggregate, which shrinks every input partition to one row per key
before the exchange; a window would send a hot key to one task and sort it
there.  A dimension is broadcast only after its size was measured; past the
bound the join shuffles, with the hot keys salted.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

BROADCAST_ROWS = 2_000_000
BROADCAST_BYTES = 64 * 1024 * 1024
# A key is hot when it holds at least one row in HOT_SHARE, so there are at most HOT_SHARE of them.
HOT_SHARE = 1_000
SALTS = 64


def _survivor(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], pick) -> DataFrame:
    rest = [c for c in df.columns if c not in set(keys)]
    ranks = [F.col(o) if isinstance(o, str) else o for o in order]
    # The remaining columns close the order, so ties cannot depend on arrival.
    packed = F.struct(
        *[r.alias(f"o{i}") for i, r in enumerate(ranks)],
        *[F.col(c).alias(f"r{i}") for i, c in enumerate(rest)],
    )
    best = df.groupBy(*keys).agg(pick(packed).alias("best"))
    back = {c: F.col(f"best.r{i}").alias(c) for i, c in enumerate(rest)}
    return best.select(*[back.get(c, F.col(c)) for c in df.columns])


def keep_last(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """One row per key, the greatest by `order` (null keys form a group, as in the source)."""
    return _survivor(df, keys, order, F.max)


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """One row per key, the smallest by `order`."""
    return _survivor(df, keys, order, F.min)


def fits_broadcast(dim: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Measure a dimension: rows, and bytes of their texts.  Counted where the rows are, nothing is gathered."""
    if max_rows <= 0:
        return False
    width = reduce(
        lambda a, b: a + b,
        [F.coalesce(F.octet_length(F.col(f"`{c}`").cast("string")), F.lit(0)) + F.lit(16) for c in dim.columns],
    )
    seen = dim.agg(F.count(F.lit(1)).alias("n"), F.sum(width).alias("b")).first()
    return seen["n"] <= max_rows and (seen["b"] or 0) <= max_bytes


def lookup(
    fact: DataFrame,
    dim: DataFrame,
    on: Sequence[str],
    how: str = "left",
    max_rows: int = BROADCAST_ROWS,
    max_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Join each fact row to its single `dim` row (`dim` holds one row per key).

    A measured small `dim` is broadcast.  Otherwise both sides are shuffled by key
    and salt.  Keys that hold a large share of the fact rows, found by one
    pre-aggregated count, are dealt to `SALTS` salts, and only their dimension
    rows, at most HOT_SHARE, are repeated for each salt.  A null key matches nothing
    and is dealt to salts too.  The fact is read twice in all: for the count and for
    the join.
    """
    on = list(on)
    if fits_broadcast(dim, max_rows, max_bytes):
        return fact.join(F.broadcast(dim), on, how)

    keyless = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in on])
    # At most HOT_SHARE keys can hold that share: the most frequent ones and the number of rows are all that is kept of the counts.
    seen = Observation()
    counts = fact.groupBy(*on).agg(F.count(F.lit(1)).alias("_n")).observe(seen, F.sum("_n").alias("total"))
    most = counts.orderBy(F.desc("_n")).limit(HOT_SHARE)
    rows = most.collect()
    total = seen.get["total"] or 0
    often = fact.sparkSession.createDataFrame([r for r in rows if r["_n"] * HOT_SHARE >= total], most.schema)
    hot = F.broadcast(often.filter(~keyless).select(*on, F.lit(True).alias("_hot")))
    # By the row's content: a task that runs again deals its rows as before.
    deal = F.when(F.col("_hot") | keyless, F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in fact.columns]), F.lit(SALTS)).cast("int")).otherwise(F.lit(0))
    salted = fact.join(hot, on, "left").withColumn("_salt", deal).drop("_hot")
    salts = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    repeated = dim.join(hot, on, "left").withColumn("_salt", F.explode(salts)).drop("_hot")
    return salted.join(repeated.hint("merge"), [*on, "_salt"], how).drop("_salt")


def semi_lookup(
    fact: DataFrame,
    dim: DataFrame,
    on: Sequence[str],
    max_rows: int = BROADCAST_ROWS,
    max_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Fact rows whose key is in `dim` (one row per key)."""
    return lookup(fact, dim.select(*on), on, "inner", max_rows, max_bytes).select(*fact.columns)
