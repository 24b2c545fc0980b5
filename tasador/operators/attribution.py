"""How much each feature adds to each prediction of an ensemble of trees.

The contributions are Shapley values along the tree paths: a feature left out
sends a row down both sides of a split, by the shares of training rows that went
there.  A row's contributions add up to its prediction minus the base value, the
prediction with every feature left out.

For one leaf the value of a set of features is a product: of one factor per feature
on the path, 1 or 0 for a known one (does the row pass all of its splits?), the
share of training rows that pass for one left out.  So the contributions of a
leaf depend on the row only by which of its at most `depth` features pass, and
are read from a table of those patterns; rows are handled many at a time.
"""

from __future__ import annotations

import datetime as dt
import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

from tasador import schemas
from tasador.session import cut_lineage, shared_dir


@dataclass
class Tree:
    """Nodes of one tree by number; `left` is -1 at leaves, `categories` None at splits by threshold."""

    weight: float
    value: np.ndarray
    cover: np.ndarray
    left: np.ndarray
    right: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    categories: list[np.ndarray | None]

    def goes_left(self, rows: np.ndarray) -> np.ndarray:
        """(row, node): whether the row would go left there."""
        out, numbers, kinds = np.zeros((len(rows), len(self.value)), bool, order="F"), np.asfortranarray(rows), {}
        for node in np.flatnonzero(self.left >= 0):
            f, among = self.feature[node], self.categories[node]
            if among is None:
                out[:, node] = numbers[:, f] <= self.threshold[node]
                continue
            if f not in kinds:
                kinds[f] = np.unique(numbers[:, f], return_inverse=True)
            values, place = kinds[f]
            out[:, node] = np.isin(values, among)[place]
        return out


@dataclass
class Leaf:
    """The features on the way to a leaf, the splits of each (node, to the left), and the contributions by pattern."""

    features: list[int]
    splits: list[list[tuple[int, bool]]]
    table: np.ndarray  # (pattern, feature); bit i of a pattern: the row passes all splits of features[i]


def leaf_table(value: float, shares: Sequence[float]) -> np.ndarray:
    """Shapley values of a leaf for every pattern of passed features, given the share of rows that pass each."""
    k = len(shares)
    passed = (np.arange(1 << k)[:, None] >> np.arange(k) & 1).astype(float)
    order = np.array([math.factorial(s) * math.factorial(k - s - 1) / math.factorial(k) for s in range(k)])
    table = np.zeros((1 << k, k))
    for j in range(k):
        # Coefficients, by the number of known ones, of the product over the other features.
        terms = np.zeros((1 << k, k))
        terms[:, 0] = 1.0
        for f in (f for f in range(k) if f != j):
            grown = terms * shares[f]
            grown[:, 1:] += terms[:, :-1] * passed[:, f : f + 1]
            terms = grown
        table[:, j] = value * (passed[:, j] - shares[j]) * (terms @ order)
    return table


def leaves(tree: Tree) -> tuple[list[Leaf], float]:
    """All leaves of a tree, and its base value."""
    found, base = [], 0.0
    todo: list[tuple[int, dict[int, list], dict[int, float]]] = [(0, {}, {})]
    while todo:
        node, splits, shares = todo.pop()
        if tree.left[node] < 0:
            value = float(tree.weight * tree.value[node])
            base += value * math.prod(shares.values())
            if splits:
                features = list(splits)
                found.append(Leaf(features, [splits[f] for f in features], leaf_table(value, [shares[f] for f in features])))
            continue
        f = int(tree.feature[node])
        for child, left in ((tree.left[node], True), (tree.right[node], False)):
            share = float(tree.cover[child] / tree.cover[node])
            todo.append((int(child), {**splits, f: [*splits.get(f, []), (node, left)]}, {**shares, f: shares.get(f, 1.0) * share}))
    return found, base


def add_contributions(tree: Tree, parts: list[Leaf], rows: np.ndarray, out: np.ndarray) -> None:
    """Add a tree's contributions of (row, feature) values to `out`; rows that go the same way at every split are handled as one."""
    Kinds(tree, parts).add(rows, out)


class Kinds:
    """The contributions of one tree for every kind of row met so far.

    A feature's splits cut its values into ranges, or sets of categories, that go the same way
    at each of them; the numbers of these, put together, are a row's kind.  Only kinds that
    were not met before go through the leaves.
    """

    MOST = 100_000
    """Kinds that are kept; past that the table begins anew."""

    def __init__(self, tree: Tree, parts: list[Leaf]) -> None:
        self.tree, self.parts = tree, parts
        self.codes, self.found = np.zeros(0, np.int64), np.zeros((0, 0))
        split = np.flatnonzero(tree.left >= 0)
        self.cuts, self.size = [], 1
        for f in sorted({int(tree.feature[n]) for n in split}):
            own = [n for n in split if tree.feature[n] == f]
            cuts = np.unique([tree.threshold[n] for n in own if tree.categories[n] is None])
            among = [tree.categories[n] for n in own if tree.categories[n] is not None]
            values = np.unique(np.concatenate(among)) if among else np.zeros(0)
            # Class 0: in none of the sets.
            sets, place = np.unique(np.stack([np.isin(values, s) for s in among], axis=1), axis=0, return_inverse=True) if len(values) else (values, values)
            self.cuts.append((f, cuts, values, place.ravel() + 1, len(sets) + 1))
            self.size *= (len(cuts) + 1) * (len(sets) + 1)

    def kinds(self, rows: np.ndarray) -> np.ndarray:
        """A number for each row; rows of one number go the same way at every split."""
        code = np.zeros(len(rows), np.int64)
        for f, cuts, values, place, classes in self.cuts:
            own = np.ascontiguousarray(rows[:, f])
            # The cuts that the value is above; a missing value is above all of them.
            code = code * (len(cuts) + 1) + np.searchsorted(cuts, own)
            if len(values):
                at = np.minimum(np.searchsorted(values, own), len(values) - 1)
                code = code * classes + np.where(values[at] == own, place[at], 0)
        return code

    def add(self, rows: np.ndarray, out: np.ndarray) -> None:
        if self.size > 1 << 62:
            # The numbers would not fit: rows are told apart by the splits themselves.
            goes = self.tree.goes_left(rows)
            packed = np.ascontiguousarray(np.packbits(goes, axis=1))
            _, first, kind = np.unique(packed.view(f"V{packed.shape[1]}").ravel(), return_index=True, return_inverse=True)
            out += self.of(rows[first], out.shape[1])[kind]
            return
        codes = self.kinds(rows)
        if self.found.shape[1] != out.shape[1] or len(self.codes) > self.MOST:
            self.codes, self.found = np.zeros(0, np.int64), np.zeros((0, out.shape[1]))
        met, first, kind = np.unique(codes, return_index=True, return_inverse=True)
        new = ~np.isin(met, self.codes, assume_unique=True)
        if new.any():
            order = np.argsort(codes_now := np.concatenate([self.codes, met[new]]))
            self.codes, self.found = codes_now[order], np.concatenate([self.found, self.of(rows[first[new]], out.shape[1])])[order]
        out += self.found[np.searchsorted(self.codes, met)][kind]

    def of(self, rows: np.ndarray, width: int) -> np.ndarray:
        """The contributions of every row, leaf by leaf."""
        goes, own = self.tree.goes_left(rows), np.zeros((len(rows), width))
        for leaf in self.parts:
            pattern = np.zeros(len(goes), np.int64)
            for bit, splits in enumerate(leaf.splits):
                passes = np.ones(len(goes), bool)
                for node, left in splits:
                    passes &= goes[:, node] == left
                pattern |= passes.astype(np.int64) << bit
            own[:, leaf.features] += leaf.table[pattern]
        return own


def trees_of(spark: SparkSession, model) -> list[Tree]:
    """The nodes of a fitted ensemble, read from its saved form (at most 2 ** (depth + 1) a tree reach the driver)."""
    path = f"{shared_dir(spark).rstrip('/')}/attribution-{uuid4().hex}"
    model.write().save(path)
    rows = spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*").orderBy("treeID", "id").collect()
    by_tree: dict[int, list] = {}
    for r in rows:
        by_tree.setdefault(r["treeID"], []).append(r)
    return [_tree(float(w), by_tree[i]) for i, w in enumerate(model.treeWeights)]


def _tree(weight: float, nodes: list) -> Tree:
    at = {n["id"]: i for i, n in enumerate(nodes)}
    split = [n["split"] for n in nodes]
    is_set = [s["numCategories"] > -1 for s in split]
    return Tree(
        weight,
        np.array([n["prediction"] for n in nodes]),
        np.array([n["impurityStats"][0] for n in nodes]),
        np.array([at.get(n["leftChild"], -1) for n in nodes]),
        np.array([at.get(n["rightChild"], -1) for n in nodes]),
        np.array([s["featureIndex"] for s in split]),
        np.array([s["leftCategoriesOrThreshold"][0] if s["leftCategoriesOrThreshold"] and not c else 0.0 for s, c in zip(split, is_set)]),
        [np.array(s["leftCategoriesOrThreshold"]) if c else None for s, c in zip(split, is_set)],
    )


def contributions(model, df: DataFrame, features: str = "features") -> DataFrame:
    """`df` plus `base` and `contributions`, one number per place of the vector column `features`, which goes.

    The nodes are broadcast: at most 2 ** (depth + 1) of some 60 bytes a tree.
    """
    spark = df.sparkSession
    trees = spark.sparkContext.broadcast(trees_of(spark, model))
    rest = [c for c in df.columns if c != features]
    wide = df.select(*[F.col(f"`{c}`") for c in rest], vector_to_array(features).alias("_x"))
    schema = StructType([*wide.schema.fields[:-1], StructField("base", DoubleType()), StructField("contributions", ArrayType(DoubleType(), False))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, base = None, 0.0
        for batch in batches:
            if not batch.num_rows:
                continue
            if known is None:
                found = [(tree, *leaves(tree)) for tree in trees.value]
                known, base = [Kinds(tree, parts) for tree, parts, _ in found], sum(b for _, _, b in found)
            rows = batch.column(len(rest)).flatten().to_numpy().reshape(batch.num_rows, -1)
            out = np.zeros(rows.shape)
            for kinds in known:
                kinds.add(rows, out)
            each = pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1) * rows.shape[1], pa.int32()), pa.array(out.reshape(-1)))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(np.full(len(rows), base)), each], names=[*rest, "base", "contributions"])

    return wide.mapInArrow(run, schema)


def attribution(contributed: DataFrame, names: Sequence[str], as_of: dt.date) -> DataFrame:
    """Features by the mean size of their contributions, the highest first, from the result of `contributions`.

    The means, one row, are stored: whoever uses the report more than once would make the contributions anew each time.
    """
    means = cut_lineage(contributed.agg(*[F.avg(F.abs(F.col("contributions")[i])).alias(f"m{i}") for i in range(len(names))]))
    pairs = F.explode(F.array(*[F.struct(F.lit(n).alias("FeatureName"), F.col(f"m{i}").alias("Importances")) for i, n in enumerate(names)])).alias("p")
    table = means.select(pairs).select("p.*", F.lit(as_of).alias("InventoryDate"))
    return table.select(*schemas.FEATURE_IMPORTANCE.names).orderBy(F.desc("Importances"), "FeatureName")
