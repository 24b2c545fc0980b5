"""Survivors by late fetch are those of the plain aggregate."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tasador.operators import bronze, keyed, latefetch

SCHEMA = "k string, d double, day date, n int, b boolean, big bigint, at timestamp, note string"


@pytest.fixture(scope="module")
def rows(spark):
    """A hot key, null keys, equal rows, ties in the order, keys that come once."""
    draw = random.Random(4)
    none = lambda v: None if draw.random() < 0.1 else v
    made = []
    for i in range(2000):
        key = "hot" if i % 3 == 0 else none(f"k{draw.randrange(300)}") if i % 3 == 1 else f"u{i}"
        day, at = dt.date(2024, 1, 1 + draw.randrange(4)), dt.datetime(1969, 12, 31, draw.randrange(24))
        big = draw.choice([-(1 << 63), 0, (1 << 63) - 1])
        made.append((key, draw.choice([0.0, -0.0, 1.5]) if i % 3 < 2 else 1.0, none(day), none(draw.randrange(-3, 3)), none(draw.random() < 0.5), none(big), none(at), none(f"t{draw.randrange(3)}")))
    made += made[:700] + [("", None, None, None, None, None, None, None), (None, 1.0, None, None, None, None, None, "x")]
    # Both zeros are one key; the plain aggregate gives back the positive one.
    return spark.createDataFrame(made, SCHEMA).withColumn("d", F.col("d") + F.lit(0.0)).repartition(5)


def listed(df):
    return sorted(map(str, df.collect()))


@pytest.mark.parametrize("bound", [keyed.BROADCAST_ROWS, 0])
@pytest.mark.parametrize("order", [["n", "day"], ["big", "n"], ["at", "n", "b"]])
def test_same_rows_as_the_aggregate(rows, order, bound):
    keys = ["k", "d"]
    assert listed(latefetch.keep_last(rows, keys, order, max_rows=bound)) == listed(keyed.keep_last(rows, keys, order))
    assert listed(latefetch.keep_first(rows, keys, order, max_rows=bound)) == listed(keyed.keep_first(rows, keys, order))


def test_neighbouring_texts_stay_apart(spark):
    texts = [("a", "bc"), ("ab", "c"), ("a\x1fb", "c"), ("a", "b\x1fc"), (None, "a"), ("", "a"), ("-", "a"), ("1:a", ""), ("a", None), ("a", "")]
    df = spark.createDataFrame([(*t, 1) for t in texts], "x string, y string, n int")
    assert latefetch.keep_last(df.union(df), ["x", "y"], ["n"]).count() == len(texts)


def test_columns_and_empty_tables(rows, spark):
    got = latefetch.keep_first(rows, ["k"], ["day"])
    assert got.columns == rows.columns and [f.dataType for f in got.schema] == [f.dataType for f in rows.schema]
    assert latefetch.keep_first(rows.limit(0), ["k"], ["day"]).count() == 0
    once = spark.createDataFrame([("a", 1), ("c", 2)], "k string, n int")
    assert listed(latefetch.keep_last(once, ["k"], ["n"])) == listed(once)


def test_orders_that_do_not_fit_are_refused(rows):
    for order in (["note"], ["big", "at"], ["d"]):
        with pytest.raises(ValueError):
            latefetch.keep_last(rows, ["k"], order)


def test_no_wide_row_is_sorted_or_moved(rows, spark, tmp_path):
    """Without ties: hash aggregates over hashes only, and no exchange of whole rows."""
    path = str(tmp_path / "t")
    rows.withColumn("n", F.monotonically_increasing_id()).write.parquet(path)
    df = spark.read.parquet(path)
    narrow = latefetch.contested(df.select(*[c.alias(n) for n, c in latefetch.key_hashes(["k"]).items()], latefetch.packed_rank(df, ["n"]).alias("_rank")), True)
    plan = narrow._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan and "note" not in plan
    plan = latefetch.keep_last(df, ["k"], ["n"])._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "hashpartitioning" not in plan and "SortMergeJoin" not in plan


def test_rows_of_single_keys_stay_past_the_broadcast_bound(spark):
    """Too many contested keys to broadcast: only rows that the filter lets pass are moved, no join shuffles the others."""
    rows = [(i, i % 5, f"text {i}") for i in range(2000)] + [(i, 9, f"more {i}") for i in range(0, 300, 3)] + [(None, 1, "x"), (None, 1, "w"), (7, 2, "text 0")]
    df = spark.createDataFrame(rows, "k int, n int, note string")
    for pick, plain in ((latefetch.keep_first, keyed.keep_first), (latefetch.keep_last, keyed.keep_last)):
        got = pick(df, ["k"], ["n"], max_rows=0)
        assert "SortMergeJoin" not in got._jdf.queryExecution().executedPlan().toString()
        assert sorted(map(str, got.collect())) == sorted(map(str, plain(df, ["k"], ["n"]).collect()))


@pytest.mark.parametrize("keys", [["k"], ["k", "day"], ["note", "k", "b"], ["k", "d"]])
def test_folding_repeated_keys_only_gives_the_same_rows(rows, keys):
    fold = lambda df: keyed.keep_first(df, keys, ["n"])
    assert listed(latefetch.fold_repeated(rows, keys, fold)) == listed(fold(rows))
    assert latefetch.fold_repeated(rows.limit(0), keys, fold).count() == 0


def test_rows_that_come_once_are_not_folded(spark, monkeypatch):
    texts = [(f"a{i}", None if i % 2 else "x", dt.date(2024, 1, 1)) for i in range(3000)]
    df = spark.createDataFrame(texts + texts[:40] + [(None, "a0", None), ("a0", None, None)], "k string, v string, ExtractedDate date")
    moved, first = [], keyed.keep_first
    want, kept = listed(df.distinct()), listed(first(df, ["k", "v"], ["ExtractedDate"]))

    def counting(fold):
        return lambda rows, *rest: moved.append(rows.count()) or fold(rows, *rest)

    monkeypatch.setattr(bronze, "keep_first", counting(first))
    assert listed(bronze.key_distinct(df, ["k", "v"])) == kept
    monkeypatch.setattr(type(df), "distinct", counting(type(df).distinct))
    assert listed(bronze.exact_distinct(df)) == want
    assert len(moved) == 2 and all(80 <= n < 200 for n in moved)


@pytest.mark.parametrize("pick", ["keep_first", "keep_last"])
def test_contested_rows_are_folded_a_part_at_a_time(rows, monkeypatch, pick):
    """Past the bound rows of contested keys are stored and exchanged by parts of the keys, and the rows are the same."""
    folds, plain = [], getattr(keyed, pick)
    want = listed(plain(rows, ["k", "d"], ["n", "day"]))
    monkeypatch.setattr(latefetch, "ROWS_PER_ROUND", 900)
    monkeypatch.setattr(keyed, pick, lambda df, *a: folds.append(df) or plain(df, *a))
    assert listed(getattr(latefetch, pick)(rows, ["k", "d"], ["n", "day"], max_rows=0)) == want
    assert len(folds) >= 2
