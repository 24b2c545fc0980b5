"""Poisson mixing against a plain computation."""

import hashlib
import itertools
import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tasador.llm import mixing as M

SCHEMA = "doc_id bigint, text string, source string, copy string"


def draw(rate, doc_id, text, part=1):
    key = f"{M.SEED}|{'null' if doc_id is None else doc_id}|{hashlib.md5((text or '').encode()).hexdigest()}|{part}"
    u = int(hashlib.md5(key.encode()).hexdigest()[:13], 16) / 2**52
    k, p = 0, math.exp(-rate)
    upto = p
    while upto <= u:
        k += 1
        p *= rate / k
        upto += p
    return k


def test_draws_by_source(spark):
    rows = [(i, f"text {i}", "big", None) for i in range(300)] + [(1000 + i, f"t{i}", "small", "x") for i in range(20)] + [(2000 + i, "n", None, "") for i in range(30)]
    docs = spark.createDataFrame(rows, SCHEMA)
    weights = spark.createDataFrame([("big", 1.0), ("small", 2.0), ("small", 1.0), (None, 1.0), ("absent", 5.0)], "source string, weight double")
    rates = {r["source"]: r["rate"] for r in M.source_rates(docs, weights, total=500).collect()}
    assert rates == pytest.approx({"big": 100 / 300, "small": 300 / 20, None: 100 / 30})
    out = M.mix(docs, weights, total=500)
    assert out.columns == ["doc_id", "text", "source", "part", "copy", "order_key"]
    got = Counter(r["doc_id"] for r in out.collect())
    want = Counter({r[0]: n for r in rows if (n := draw(rates[r[2]], r[0], r[1]))})
    assert got == want
    assert 400 < got.total() < 600


def test_high_rates_are_split(spark):
    rate = 150.0
    docs = spark.createDataFrame([(i, "t", "s", "") for i in range(40)], SCHEMA)
    out = M.replicate(docs, spark.createDataFrame([("s", 40, rate)], "source string, n bigint, rate double")).collect()
    want = {(i, part): draw(rate / 3, i, "t", part) for i in range(40) for part in (1, 2, 3)}
    assert Counter((r["doc_id"], r["part"]) for r in out) == Counter(want)
    assert abs(len(out) / 40 - rate) < 10
    assert len({(r["doc_id"], r["part"], r["copy"]) for r in out}) == len(out)


def test_distribution(spark):
    """Shares of the counts are those of the Poisson distribution."""
    docs = spark.createDataFrame([(i, "t", "s", "") for i in range(4000)], SCHEMA)
    out = M.replicate(docs, spark.createDataFrame([("s", 4000, 1.5)], "source string, n bigint, rate double"))
    counts = Counter(Counter(r["doc_id"] for r in out.select("doc_id").collect()).values())
    counts[0] = 4000 - sum(counts.values())
    for k in range(5):
        assert abs(counts[k] / 4000 - math.exp(-1.5) * 1.5**k / math.factorial(k)) < 0.03


def test_nulls_repeats_and_empty(spark, monkeypatch):
    rows = [(None, None, None, None), (None, None, None, None), (1, None, "a", ""), (1, None, "a", ""), (2, "", "b", "c"), (3, "long " * 20_000, "a", "")]
    docs = spark.createDataFrame(rows, SCHEMA)
    rates = {r["source"]: r["rate"] for r in M.source_rates(docs, total=60).collect()}
    want = Counter()
    for r in rows:
        want[r[0]] += draw(rates[r[2]], r[0], r[1])
    got = M.mix(docs, total=60).collect()
    assert Counter(r["doc_id"] for r in got) == want
    monkeypatch.setattr(M, "BROADCAST_SOURCES", 0)
    assert Counter(M.mix(docs, total=60).collect()) == Counter(got)
    empty = spark.createDataFrame([], SCHEMA)
    assert M.mix(empty).collect() == []
    none = spark.createDataFrame([], "source string, weight double")
    assert M.mix(docs, none).collect() == []


def test_order_is_random_and_repeats(spark):
    docs = spark.createDataFrame([(i, "t", "s", "") for i in range(1000)], SCHEMA)
    first, again = ([r["doc_id"] for r in M.mix(docs).collect()] for _ in range(2))
    assert first == again
    rises = sum(a < b for a, b in zip(first, first[1:])) / len(first)
    assert 0.4 < rises < 0.6


def test_equal_rows_are_mixed_and_spread(spark):
    """A third of all rows equal: they lie in all partitions and between the others."""
    docs = spark.createDataFrame([(None, None, "a")] * 1000 + [(i, f"text {i}", "a") for i in range(2000)], "doc_id bigint, text string, source string")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        for seed in range(20):  # equal rows have one draw, which may be 0
            rows = M.mix(docs, seed=seed).select("doc_id", F.spark_partition_id().alias("part")).collect()
            share = sum(r["doc_id"] is None for r in rows) / len(rows)
            if share:
                break
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    parts = [[r["doc_id"] is None for r in rows if r["part"] == p] for p in range(4)]
    assert share > 0.2 and all(abs(sum(p) / len(p) - share) < 0.1 for p in parts)
    assert max(len(list(run)) for p in parts for same, run in itertools.groupby(p) if same) < 30
