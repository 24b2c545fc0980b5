"""Features, intervals, enrichment, valuation and the model."""

import datetime as dt
import itertools
import math
import random
import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

from tasador import schemas
from tasador.operators import attribution as A
from tasador.operators import boosting
from tasador.operators import enrich as E
from tasador.operators import features as X
from tasador.operators import intervals as I
from tasador.operators import model as M
from tasador.operators.boosting import best_prefix, staged
from tasador.operators.resample import resamples
from tasador.operators.valuation import residual_value

DAY = dt.date(2024, 6, 1)


def test_scarcity_counts_known_keys_only(spark):
    df = spark.createDataFrame([("A", "x"), ("A", "x"), ("A", "y"), (None, "y")], "Brand string, Model string")
    got = sorted((r.Brand or "", r.Model, r.Shortage) for r in X.scarcity(df).collect())
    assert got == [("", "y", None), ("A", "x", 1.5), ("A", "x", 1.5), ("A", "y", 3.0)]


def test_rare_share_is_strict(spark):
    df = spark.createDataFrame([("a",)] * 8 + [("b",), ("c",)], "Segment string")
    assert {r.Segment for r in X.group_rare(df, {"Segment": "rare"}, 10.0).collect()} == {"a", "b", "c"}
    assert {r.Segment for r in X.group_rare(df, {"Segment": "rare"}, 10.1).collect()} == {"a", "rare"}
    assert {r.Segment for r in X.drop_rare(df, "Segment", 10.0).collect()} == {"a"}


def test_recent_counts_whole_days(spark):
    now = dt.datetime(2024, 6, 1, 12)
    rows = [(1, now - dt.timedelta(days=365, hours=23)), (2, now - dt.timedelta(days=366)), (3, now + dt.timedelta(days=5)), (4, None)]
    df = spark.createDataFrame(rows, "i int, Publication timestamp")
    assert sorted(r.i for r in X.recent(df, F.lit(str(now)).cast("timestamp")).collect()) == [1, 3]


def literal_best(rows, target):
    """Every z tried on every row."""
    mean_pred = statistics.fmean(p for _, p in rows)
    error = statistics.fmean(abs(y - p) for y, p in rows)
    best = None
    for k in range(450):
        z = 0.5 + k * 0.01
        cover = statistics.fmean(p - z * error <= y <= p + z * error for y, p in rows)
        if cover >= target:
            cost = (1 - cover) ** 2 + (2 * z * error / mean_pred) ** 2
            if best is None or cost < best[0] - 1e-15:
                best = (cost, z, cover)
    return best


def test_intervals_against_every_z(spark):
    rng = random.Random(3)
    groups = {
        "many": [(y := rng.uniform(5e3, 3e4), y * rng.gauss(1, 0.1)) for _ in range(400)],
        "one": [(100.0, 90.0)],
        "exact": [(10.0 * i, 10.0 * i) for i in range(1, 9)],
        "wild": [(1000.0, 1000.0)] * 93 + [(1000.0, 9000.0)] * 7,
    }
    rows = [(b, y, p) for b, pairs in groups.items() for y, p in pairs]
    scores = I.scored(spark.createDataFrame(rows, "Brand string, y double, p double"), "y", "p")
    table = I.grid(scores)
    assert table.count() == 450 * len(groups)
    for target in (I.SAFE, I.TIGHT):
        got = {r.Brand: (r.Cost, r.Z, r.Coverage) for r in I.best(table, target).collect()}
        want = {b: literal_best(pairs, target) for b, pairs in groups.items()}
        assert set(got) == {b for b, w in want.items() if w}
        for brand, values in got.items():
            assert values == pytest.approx(want[brand], rel=1e-9, abs=1e-12)
    safe = {r.Brand: r.Cost for r in I.best(table, I.SAFE).collect()}
    for r in I.intervals(scores).collect():
        assert r.Cost <= safe[r.Brand]


def test_client_features(spark):
    base = ("B", "m", 10.0, "D", "G", 100.0, "s", 5, 1.0, 3, "S")
    golden = spark.createDataFrame(
        [(*base, 50.0), (*base, 70.0), ("B", "m", 10.0, "D", "G", 105.0, "s", 5, 1.0, 4, "S", 90.0), ("B", "n", 99.0, "D", "G", 1.0, "s", 5, 1.0, 3, "S", 1.0)], schemas.GOLDEN
    )
    clients = spark.createDataFrame(
        [(1, "B", "m", 100, "D", 3), (2, "B", "m", 110, "D", 3), (3, "B", "m", 111, "D", 3), (4, "B", "m", 100, "D", 6), (5, "Q", "m", 100, "D", 3)],
        "id int, Brand string, Model string, CV int, Fuel string, Age int",
    )
    got = {r.id: (r.Shortage, r.PriceMed) for r in E.enrich(clients, golden).collect()}
    assert got == {1: (10.0, 70.0), 2: (10.0, 90.0), 3: (10.0, None), 4: (10.0, None), 5: (99.0, None)}


def test_residual_value(apply_rule):
    rows = [(100.0, 0, "Impecable"), (100.0, 2, "Regular"), (100.0, 40, "Buena"), (100.0, 1, "?"), (100.0, -1, "Buena")]
    got = apply_rule(residual_value, rows, "p double, a bigint, s string")
    assert [None if v is None else round(v, 6) for v in got] == [105.0, 61.908, 10.0, None, None]


def test_exact_median_narrows(spark):
    rng = random.Random(5)
    values = [rng.gauss(0, 100) for _ in range(5001)] + [1.0] * 2500
    df = spark.createDataFrame([(v,) for v in values], "v double")
    assert M.exact_median(df, F.col("v"), enough=50) == statistics.median(values)
    even = spark.createDataFrame([(float(i),) for i in range(1000)], "v double")
    assert M.exact_median(even, F.col("v"), enough=20) == 499.5
    assert M.exact_median(even.limit(0), F.col("v")) is None


def test_exact_median_with_two_common_values_at_the_middle(spark):
    """The ranks around the middle hold two values with many others between them."""
    values = [1.0] * 3000 + [9.0] * 3000 + [1 + i / 1000 for i in range(1, 2001)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    assert M.exact_median(df, F.col("v"), enough=5) == statistics.median(values)
    plan = df.agg(F.percentile_approx("v", 0.5))  # the plain way agrees within its error
    assert abs(plan.first()[0] - statistics.median(values)) < 0.01


def test_best_prefix():
    errors = [9, 8, 7, 7.5, 7.4, 7.2, 6, 5]
    assert best_prefix(errors, patience=3) == 3 and best_prefix(errors, patience=4) == 8 and best_prefix([1.0], patience=1) == 1


@pytest.fixture(scope="module")
def patterns(spark):
    rng = random.Random(7)
    rows = []
    for i in range(600):
        age, brand = rng.randrange(0, 19), rng.choice("ABC")
        rows.append((brand, f"m{i % 9}", 3.0, rng.choice(["D", "G"]), "M", 100.0 + i % 50, "s", 1000 * age, 30000.0 - 1200 * age + (2000 if brand == "A" else 0) + rng.gauss(0, 50), age, "P", 20000.0 + i))
    return M.prepare(spark.createDataFrame(rows, schemas.GOLDEN))


SMALL = {"iterations": 10, "depth": 3, "learning_rate": 0.3}


def test_holdout_metrics(patterns):
    model, report = M.holdout(patterns, DAY, SMALL)
    row = report.first()
    assert [(f.name) for f in report.schema] == schemas.HOLDOUT.names
    assert row.NormalizedMeanSquareError < 0.1 and row.MeanAbsoluteError <= row.RootMeanSquareError
    scored = M.score(model, M.split(patterns).filter("held")).toPandas()
    error = scored.prediction - scored.Price
    assert row.NormalizedMeanSquareError == pytest.approx((error**2).sum() / ((scored.Price - scored.Price.mean()) ** 2).sum())
    assert row.MedianAbsoluteError == pytest.approx(error.abs().median(), abs=0.006)


def test_kfold_and_importance(patterns):
    row = M.kfold(patterns, DAY, SMALL, folds=3).first()
    assert list(row.asDict()) == schemas.KFOLD.names and row["test-MAE-mean"] >= row["train-MAE-mean"] > 0
    model = M.train(patterns, SMALL)
    ranked = M.importance(model, patterns, DAY).collect()
    assert ranked[0].FeatureName in ("Age", "Kms") and math.isclose(sum(r.Importances for r in ranked), 100, rel_tol=1e-6)
    assert M.permutation_importance(model, patterns, DAY).first().FeatureName in ("Age", "Kms")


def test_staged_fit_is_a_prefix_of_the_whole_fit(patterns):
    """Allowed 7,531 trees, the fit ends `patience` past its best; the trees are those of the library's own fit."""
    parts = M.split(patterns).withColumn("Price", F.when(F.col("held"), F.col("Price") + 4000 * F.rand(3)).otherwise(F.col("Price")))
    table = M.assembled(parts)
    params, fitted = {**M.PARAMS, "depth": 3, "learning_rate": 0.4}, []
    plain = boosting.DecisionTreeRegressor.fit
    boosting.DecisionTreeRegressor.fit = lambda self, *args: fitted.append(1) or plain(self, *args)
    try:
        model = staged(table.rows, table.trainer(params, 1), "held", len(M.FEATURES), patience=6, block=4)
    finally:
        boosting.DecisionTreeRegressor.fit = plain
    best = model.getNumTrees
    assert len(fitted) == best + 6 < 100
    whole = table.trainer({**params, "iterations": len(fitted)}, 1).fit(table.rows.filter("not held"))
    assert [t.toDebugString.split("\n")[1:] for t in model.trees] == [t.toDebugString.split("\n")[1:] for t in whole.trees[:best]]
    assert model.treeWeights == whole.treeWeights[:best]
    errors = whole.evaluateEachIteration(table.rows.filter("held"), "squared")
    assert min(range(len(errors)), key=errors.__getitem__) + 1 == best
    assert model.evaluateEachIteration(table.rows.filter("held"), "squared") == pytest.approx(errors[:best])
    assert sum(model.featureImportances.toArray()) == pytest.approx(1)


def test_fit_that_cannot_stop_early_is_made_at_once(patterns, monkeypatch):
    """The same trees and the same prefix as tree by tree, without a fit of its own for every tree."""
    parts = M.split(patterns).withColumn("Price", F.when(F.col("held"), F.col("Price") + 4000 * F.rand(3)).otherwise(F.col("Price")))
    table = M.assembled(parts)
    params = {"iterations": 9, "depth": 3, "learning_rate": 0.4}
    single, plain = [], boosting.DecisionTreeRegressor.fit
    monkeypatch.setattr(boosting.DecisionTreeRegressor, "fit", lambda self, *args: single.append(1) or plain(self, *args))
    slow = staged(table.rows, table.trainer(params, 1), "held", len(M.FEATURES), patience=8)
    assert single
    single.clear()
    model = staged(table.rows, table.trainer(params, 1), "held", len(M.FEATURES), patience=9)
    assert not single and model.treeWeights == slow.treeWeights and model.getNumTrees == slow.getNumTrees
    assert [t.toDebugString.split("\n")[1:] for t in model.trees] == [t.toDebugString.split("\n")[1:] for t in slow.trees]
    held = table.rows.filter("held")
    assert sorted(r.prediction for r in model.transform(held).collect()) == pytest.approx(sorted(r.prediction for r in slow.transform(held).collect()))


def test_fits_at_once_shrink_with_the_rows():
    assert [M.at_once(n, 12) for n in (0, 600_000, 7_000_000, 36_000_000, 10**9)] == [4, 4, 3, 1, 1] and M.at_once(5, 1, 2) == 2


def test_contributions_add_up_and_equal_brute_force(patterns):
    model = M.train(patterns, {"iterations": 3, "depth": 3, "learning_rate": 0.4})
    rows = M.explained(model, patterns).collect()
    assert all(r.prediction == pytest.approx(r.base + sum(r.contributions)) for r in rows) and len(rows) == 600
    trees = A.trees_of(patterns.sparkSession, model.stages[-1])
    used = sorted({int(f) for t in trees for f in t.feature if f >= 0})
    vectors = [r.features.toArray() for r in model.transform(patterns).limit(5).collect()]

    def value(x, known):
        """Prediction with only some features known: both sides of other splits, by their shares."""

        def below(t, node):
            if t.left[node] < 0:
                return t.value[node]
            f, sides = t.feature[node], (t.left[node], t.right[node])
            if f in known:
                own = x[f] <= t.threshold[node] if t.categories[node] is None else x[f] in t.categories[node]
                return below(t, sides[0] if own else sides[1])
            return sum(t.cover[s] / t.cover[node] * below(t, s) for s in sides)

        return sum(t.weight * below(t, 0) for t in trees)

    for x in vectors:
        want = [0.0] * len(M.FEATURES)
        for f in used:
            others = [g for g in used if g != f]
            for size in range(len(others) + 1):
                for known in itertools.combinations(others, size):
                    share = math.factorial(size) * math.factorial(len(used) - size - 1) / math.factorial(len(used))
                    want[f] += share * (value(x, {*known, f}) - value(x, set(known)))
        got = np.zeros((1, len(x)))
        for t in trees:
            A.add_contributions(t, A.leaves(t)[0], x[None, :], got)
        assert got[0].tolist() == pytest.approx(want)
    ranked = M.attribution(model, patterns, DAY).collect()
    assert ranked[0].FeatureName in ("Age", "Kms") and len(ranked) == len(M.FEATURES)
    held = M.held_importance(model, M.split(patterns).filter("held").drop("held"), DAY)
    assert held.agg(F.sum("Importances")).first()[0] == pytest.approx(100) and held.first().FeatureName in ("Age", "Kms")


def test_rows_that_go_the_same_way_are_explained_once(patterns):
    """Their contributions are those of every row alone."""
    table = M.assembled(patterns)
    tree = A.trees_of(patterns.sparkSession, M.fitted(table, SMALL))[0]
    parts, _ = A.leaves(tree)
    rows = np.array([r.features.toArray() for r in table.rows.limit(50).collect()])
    seen = []
    leaf = A.Leaf(parts[0].features, parts[0].splits, type("Seen", (), {"__getitem__": lambda self, p: seen.append(len(p)) or parts[0].table[p]})())
    many, alone = np.zeros((200, len(M.FEATURES))), np.zeros((50, len(M.FEATURES)))
    A.add_contributions(tree, [leaf, *parts[1:]], np.tile(rows, (4, 1)), many)
    assert len(seen) == 1 and seen[0] <= 50
    for i in range(50):
        A.add_contributions(tree, parts, rows[i : i + 1], alone[i : i + 1])
    assert np.array_equal(many, np.tile(alone, (4, 1))) and alone.any()
    narrow = M.explained(M.train(patterns, SMALL), patterns, ["Brand"])
    assert narrow.columns == ["Brand", "prediction", "base", "contributions"]


def test_resamples_are_exact_and_do_not_depend_on_partitions(patterns):
    many = patterns.unionByName(patterns.limit(200)).unionByName(patterns.filter("Brand = 'A'"))
    total = many.count()
    one = resamples(many.repartition(7), 20, rows_per_bucket=50)
    two = resamples(many.repartition(2, "Kms").orderBy("Price"), 20, rows_per_bucket=50)
    assert {(tuple(r.draws), *r[1:]) for r in one.select("draws", *patterns.columns).collect()} == {(tuple(r.draws), *r[1:]) for r in two.select("draws", *patterns.columns).collect()}
    drawn = [r.draws for r in one.collect()]
    assert [sum(d[i] for d in drawn) for i in range(20)] == [total] * 20
    assert len(drawn) == patterns.distinct().count()
    # A row that comes k times is drawn k times on average.
    often = many.groupBy(*patterns.columns).agg(F.count(F.lit(1)).alias("k"))
    means = one.join(often, patterns.columns).groupBy("k").agg(F.avg(F.aggregate("draws", F.lit(0), lambda a, d: a + d) / 20).alias("mean")).collect()
    assert len(means) > 1 and all(abs(r["mean"] - r["k"]) < 0.15 * r["k"] for r in means)
    assert resamples(many.limit(0), 3).collect() == []


def test_patience_drops_the_trees_that_do_not_help(patterns):
    """Held rows of a shuffled target are not helped by any tree, so few stay."""
    parts = M.split(patterns).withColumn("Price", F.when(F.col("held"), F.rand(3) * 30000).otherwise(F.col("Price")))
    model = M.train(M.cut_lineage(parts), {"iterations": 12, "depth": 5, "learning_rate": 0.5}, validation="held", patience=2)
    assert model.stages[-1].getNumTrees < 12


def test_permutation_importance_keeps_equal_rows(patterns):
    """Rows that are equal once the model name is gone all count."""
    few = patterns.limit(40)
    many = M.cut_lineage(few.unionByName(few).unionByName(few.filter("Brand = 'A'")))
    model = M.train(many, SMALL)
    seen = []
    plain = M.score
    M.score = lambda m, df: seen.append(df.count()) or plain(m, df)
    try:
        M.permutation_importance(model, many, DAY)
    finally:
        M.score = plain
    assert set(seen) == {many.count()}


def test_shuffle_is_a_permutation(patterns):
    mixed = M.shuffled(M.numbered(patterns), "Price", 1, rows_per_bucket=100).drop("_row")
    assert sorted(r.Price for r in mixed.collect()) == sorted(r.Price for r in patterns.collect())
    assert mixed.drop("Price").exceptAll(patterns.drop("Price")).count() == 0
    assert mixed.exceptAll(patterns).count() > 500


def test_columns_are_exchanged_together_in_one_shuffle(patterns):
    data, names = M.numbered(patterns), ["Price", "Kms", "Age"]
    for columns in ("Price", names):
        out = M.shuffled(data, columns, 1, rows_per_bucket=100)
        assert out._jdf.queryExecution().sparkPlan().toString().count("Window ") <= 1
        assert out._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    triples = lambda df: sorted(map(tuple, df.select(*names).collect()))
    assert triples(out) == triples(patterns) and out.columns == data.columns
    assert out.drop(*names).exceptAll(data.drop(*names)).count() == 0 and out.exceptAll(data).count() > 500


def test_bootstrap_ensemble(patterns, tmp_path):
    paths = M.bootstrap(patterns, str(tmp_path), SMALL, models=2)
    out = M.ensemble(paths, patterns)
    assert out.count() == patterns.count() and out.filter("deviation < 0 or deviation is null").count() == 0
    assert out.columns == [*patterns.columns, "prediction", "deviation"]


def test_ensemble_indexes_and_assembles_once(patterns, tmp_path):
    """Models of one table share their indexers; the predictions are those of the models one by one, also of two tables."""
    paths = M.bootstrap(patterns, str(tmp_path / "a"), SMALL, models=3)
    other = M.bootstrap(patterns.filter("Brand = 'A'"), str(tmp_path / "b"), SMALL, models=1)
    for some, heads in ((paths, 1), ([*paths, *other], 2)):
        out = M.ensemble(some, patterns)
        assert out._jdf.queryExecution().analyzed().toString().count(" AS features#") == heads
        single = [M.score(M.PipelineModel.load(p), patterns).groupBy().agg(F.sum("prediction")).first()[0] for p in some]
        assert out.groupBy().agg(F.sum("prediction")).first()[0] == pytest.approx(statistics.fmean(single))


def test_rare_values_of_a_share_too_small_to_broadcast(spark):
    df = spark.createDataFrame([("a",)] * 8 + [("b",), (None,)], "Segment string")
    assert sorted(str(r.Segment) for r in X.group_rare(df, {"Segment": "rare"}, 0.0001).collect()) == ["None", *["a"] * 8, "b"]
    plans = [X._frequent(X.category_counts(df, ["Segment"]), "Segment", p, False)._jdf.queryExecution().analyzed().toString() for p in (0.1, 0.0001)]
    assert ["broadcast" in p.lower() for p in plans] == [True, False]


def test_fits_read_partitions_of_bounded_size(patterns):
    """However few files the rows come in."""
    rows = patterns.coalesce(1)
    table = M.spread(rows, rows.count(), 50)
    sizes = table.rdd.glom().map(len).collect()
    assert sum(sizes) == rows.count() and max(sizes) <= 100 and M.spread(table, rows.count(), 50) is table


def test_kinds_of_rows_are_explained_once_over_all_batches(patterns):
    """Rows of a kind met in an earlier batch do not go through the leaves again, and get the same numbers as alone."""
    table = M.assembled(patterns)
    rows = np.array([r.features.toArray() for r in table.rows.limit(60).collect()])
    rows[:3, -2:] = np.nan
    for tree in A.trees_of(patterns.sparkSession, M.fitted(table, SMALL)):
        kinds, made = A.Kinds(tree, A.leaves(tree)[0]), []
        kinds.of = lambda new, width, whole=kinds.of: made.append(len(new)) or whole(new, width)
        got, alone = np.zeros((120, rows.shape[1])), np.zeros((60, rows.shape[1]))
        for at in (0, 60):
            kinds.add(rows, got[at : at + 60])
        assert len(made) == 1 and made[0] <= 60
        for i in range(60):
            A.add_contributions(tree, A.leaves(tree)[0], rows[i : i + 1], alone[i : i + 1])
        kinds.size = 1 << 63
        by_splits = np.zeros((60, rows.shape[1]))
        kinds.add(rows, by_splits)
        assert np.array_equal(got, np.tile(alone, (2, 1))) and np.array_equal(by_splits, alone)


def test_a_report_of_contributions_does_not_make_them_anew(patterns):
    model = M.train(patterns, SMALL)
    for report in (M.attribution(model, patterns, DAY), M.held_importance(model, patterns, DAY)):
        plan = report._jdf.queryExecution().executedPlan().toString()
        assert "MapInArrow" not in plan and report.count() == len(M.FEATURES)
