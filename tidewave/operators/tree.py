"""Classification trees: fitted level by level from counts that Spark makes, held as a table, evaluated as one expression."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Node:
    """An inner node sends rows whose ``feature`` is at most ``threshold`` to ``left``; a leaf (feature -1) has a class."""

    node: int
    feature: int
    threshold: float
    left: int
    right: int
    value: int


#: Columns of a tree's table, in the order of a Node's fields.
SHAPE = "node int, feature int, threshold double, left int, right int, value int"


def known(feature: str) -> Column:
    """A feature as the tree sees it: missing and undefined values are 0."""
    x = F.col(feature).cast("double")
    return F.when(x.isNull() | F.isnan(x), 0.0).otherwise(x)


def candidates(rows: DataFrame, features: Sequence[str], bins: int) -> list[list[float]]:
    """Up to ``bins`` - 1 thresholds of each feature, at about equal counts: one row of aggregates."""
    at = [i / bins for i in range(1, bins)]
    found = rows.agg(*(F.percentile_approx(known(f), at, 10000).alias(f"q{i}") for i, f in enumerate(features))).first()
    return [sorted(set(q or [])) for q in found]


def split_counts(rows: DataFrame, features: Sequence[str], cuts: Sequence[Sequence[float]], label: str, node: Column) -> DataFrame:
    """(node, feature, bin, label, n): rows of each node by the number of a feature's thresholds that lie below its value.

    Rows are counted where they are read; what is shuffled is bounded by nodes, thresholds and classes.
    """
    def bin_of(feature: str, thresholds: Sequence[float]) -> Column:
        return F.size(F.filter(F.array(*map(F.lit, thresholds)), lambda t: t < known(feature)))

    bins = [F.struct(F.lit(i).alias("feature"), bin_of(f, c).alias("bin")) for i, (f, c) in enumerate(zip(features, cuts)) if c]
    by = rows.select(node.alias("node"), F.col(label).cast("int").alias("label"), F.explode(F.array(*bins)).alias("at"))
    return by.where("node is not null").groupBy("node", "at.feature", "at.bin", "label").agg(F.count("*").alias("n"))


def fit(rows: DataFrame, features: Sequence[str], label: str, classes: int, bins: int = 32, depth: int = 6, least: int = 20) -> list[Node]:
    """A tree by Gini impurity: each level is one pass that counts every split candidate of every open node.

    ``label`` is 0 to ``classes`` - 1; rows without one are left out. A node becomes a leaf at ``depth``, if it is pure, or if no split leaves
    ``least`` rows on both sides and lowers the impurity. Ties go to the first feature and threshold, leaves to the
    smaller class. The driver gets counts only: at most 2^depth * features * bins * classes of them a level. Without rows
    the tree is one leaf of class 0.
    """
    learnt = rows.where(F.col(label).isNotNull())
    cuts = candidates(learnt, features, bins)
    tree, open_ = {0: Node(0, -1, 0.0, -1, -1, 0)}, [0]
    for level in range(depth + 1):
        if not open_ or not any(cuts):
            break
        counts: dict[int, np.ndarray] = {n: np.zeros((len(features), bins, classes)) for n in open_}
        for r in split_counts(learnt, features, cuts, label, reached([tree[i] for i in sorted(tree)], features, set(open_))).collect():
            counts[r["node"]][r["feature"], r["bin"], r["label"]] += r["n"]
        fresh = []
        for node in open_:
            value, split = best_split(counts[node], cuts, least)
            tree[node] = Node(node, -1, 0.0, -1, -1, value)
            if split and level < depth:
                left = len(tree)
                tree[node] = Node(node, split[0], split[1], left, left + 1, value)
                for child in (left, left + 1):
                    tree[child] = Node(child, -1, 0.0, -1, -1, value)
                    fresh.append(child)
        open_ = fresh
    return [tree[i] for i in sorted(tree)]


def best_split(counts: np.ndarray, cuts: Sequence[Sequence[float]], least: int) -> tuple[int, tuple[int, float] | None]:
    """The class of most rows, and the feature and threshold that lower the Gini impurity most, of ``counts`` (feature, bin, class)."""
    used = next((i for i, c in enumerate(cuts) if c), 0)
    whole = counts[used].sum(axis=0)
    n = whole.sum()
    best, split = round(n - (whole**2).sum() / max(n, 1), 9), None
    for f, c in enumerate(cuts):
        left = np.cumsum(counts[f], axis=0)[: len(c)]
        right = whole - left
        a, b = left.sum(axis=1), right.sum(axis=1)
        impure = a - (left**2).sum(axis=1) / np.maximum(a, 1) + b - (right**2).sum(axis=1) / np.maximum(b, 1)
        impure = np.where((a < least) | (b < least), np.inf, impure.round(9))  # so that ties are ties
        if len(c) and impure.min() < best:
            best, split = impure.min(), (f, float(c[int(impure.argmin())]))
    return int(whole.argmax()), split


def _walk(tree: Sequence[Node], features: Sequence[str], leaf, at: int = 0) -> Column:
    n = tree[at]
    if n.feature < 0:
        return leaf(n)
    return F.when(known(features[n.feature]) <= n.threshold, _walk(tree, features, leaf, n.left)).otherwise(_walk(tree, features, leaf, n.right))


def evaluated(tree: Sequence[Node], features: Sequence[str]) -> Column:
    """The class of a row, as one expression over the feature columns."""
    return _walk(tree, features, lambda n: F.lit(n.value))


def reached(tree: Sequence[Node], features: Sequence[str], wanted: set[int]) -> Column:
    """The leaf that a row comes to if it is ``wanted``, else null."""
    return _walk(tree, features, lambda n: F.lit(n.node if n.node in wanted else None).cast("int"))


def as_table(spark, tree: Sequence[Node]) -> DataFrame:
    return spark.createDataFrame([(n.node, n.feature, n.threshold, n.left, n.right, n.value) for n in tree], SHAPE)


def from_table(df: DataFrame) -> list[Node]:
    """A tree from its table, by node; a table that is no tree raises ValueError."""
    tree = [Node(*r) for r in df.select("node", "feature", "threshold", "left", "right", "value").orderBy("node").collect()]  # the nodes of one tree
    children = sorted(c for n in tree if n.feature >= 0 for c in (n.left, n.right))
    if [n.node for n in tree] != list(range(len(tree))) or children != list(range(1, len(tree))) or any(n.feature >= 0 and min(n.left, n.right) <= n.node for n in tree):
        raise ValueError("every node but the first must be the child of one node before it")
    return tree
