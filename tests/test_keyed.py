"""Survivors and joins, with one key holding most rows."""

import random

import pytest
from pyspark.sql import functions as F

from tasador.operators import keyed


@pytest.fixture(scope="module")
def skewed(spark):
    rng = random.Random(1)
    rows = [("hot" if i % 3 else f"k{rng.randrange(40)}", i % 7, i) for i in range(3000)] + [(None, 0, -1), (None, 9, -2)]
    return spark.createDataFrame(rows, "k string, o int, v int").repartition(6)


def test_survivors_ignore_arrival_order(skewed):
    first = {tuple(r) for r in keyed.keep_last(skewed, ["k"], ["o"]).collect()}
    again = {tuple(r) for r in keyed.keep_last(skewed.repartition(3, "v"), ["k"], ["o"]).collect()}
    assert first == again
    best = {}
    for r in skewed.collect():
        best[r.k] = max(best.get(r.k, (-1, -9)), (r.o, r.v))
    assert first == {(k, *v) for k, v in best.items()}


def test_keep_first_is_the_smallest(skewed):
    got = {r.k: (r.o, r.v) for r in keyed.keep_first(skewed, ["k"], ["o"]).collect()}
    assert got["hot"] == min((r.o, r.v) for r in skewed.collect() if r.k == "hot")


def test_survivors_aggregate_before_the_exchange(skewed):
    plan = keyed.keep_last(skewed, ["k"], ["o"])._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in plan and "Window" not in plan


@pytest.mark.parametrize("how", ["left", "inner"])
def test_lookup_is_the_same_on_every_path(skewed, how):
    dim = skewed.select("k").distinct().dropna().filter("k <> 'k3'").withColumn("d", F.upper("k"))
    order = ["k", "o", "v", "d"]
    plain = sorted(map(str, skewed.join(dim, "k", how).select(*order).collect()))
    small = sorted(map(str, keyed.lookup(skewed, dim, ["k"], how).select(*order).collect()))
    large = sorted(map(str, keyed.lookup(skewed, dim, ["k"], how, max_rows=0).select(*order).collect()))
    assert plain == small == large


def test_lookup_past_the_bound_reads_the_fact_once_more(spark):
    """One pass counts the keys, one joins; hot keys are salted, not joined apart."""
    fact = spark.range(1000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"), F.col("id").alias("v"))
    dim = fact.filter("k <> '7'").select("k").distinct().withColumn("d", F.upper("k"))
    dim = spark.createDataFrame(dim.collect(), dim.schema)
    out = keyed.lookup(fact, dim, ["k"], max_rows=0)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Range (0, 1000") == 1 and plan.count("SortMergeJoin") == 1
    assert out.count() == 1000 and out.filter("d is null").count() == 1


def test_broadcast_needs_a_measured_size(skewed, spark):
    dim = spark.range(100).select(F.col("id").cast("string").alias("k"), F.repeat(F.lit("x"), 1000).alias("wide"))
    assert keyed.fits_broadcast(dim)
    assert not keyed.fits_broadcast(dim, max_rows=99)
    assert not keyed.fits_broadcast(dim, max_bytes=50_000)


def test_counts_of_the_keys_are_not_stored(skewed):
    """A fact of many keys leaves no table of them; at most HOT_SHARE rows reach the driver."""
    from pathlib import Path

    from tasador.session import shared_dir

    top = Path(shared_dir(skewed.sparkSession).removeprefix("file:"))
    dim, before = skewed.select("k").distinct().dropna().withColumn("d", F.upper("k")), {*top.glob("*/rdd-*")}
    out = keyed.lookup(skewed, dim, ["k"], max_rows=0)
    assert {*top.glob("*/rdd-*")} <= before
    assert out.count() == skewed.count()
