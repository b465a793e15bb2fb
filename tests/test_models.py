"""Fitted trees and mixtures against plain loops."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewave.operators import mixtures as M
from tidewave.operators import tree as T
from tidewave.plans import activity, estimation

SF = "/root/testdata/sf0.01"


def walk(tree, row):
    at = 0
    while tree[at].feature >= 0:
        x = row[tree[at].feature]
        x = 0.0 if x is None or math.isnan(x) else x
        at = tree[at].left if x <= tree[at].threshold else tree[at].right
    return tree[at].value


def plain_fit(rows, labels, cuts, classes, depth, least):
    """The same tree by recursion over whole rows, as a nested tuple."""

    def impurity(y):
        return len(y) - sum(int((y == c).sum()) ** 2 for c in range(classes)) / len(y) if len(y) else 0.0

    def grow(at, level):
        y = labels[at]
        value, best, split = int(np.bincount(y, minlength=classes).argmax()) if len(y) else 0, round(impurity(y), 9), None
        for f, c in enumerate(cuts):
            for t in c:
                left = rows[at, f] <= t
                own = round(impurity(y[left]) + impurity(y[~left]), 9)
                if min(left.sum(), (~left).sum()) >= least and own < best:
                    best, split = own, (f, t)
        if split is None or level == depth:
            return value
        left = rows[at, split[0]] <= split[1]
        return split[0], split[1], grow(at[left], level + 1), grow(at[~left], level + 1)

    return grow(np.arange(len(rows)), 0)


def nested(tree, at=0):
    n = tree[at]
    return n.value if n.feature < 0 else (n.feature, n.threshold, nested(tree, n.left), nested(tree, n.right))


def made(spark, n=600):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(n, 3)).round(2)
    y = (x[:, 0] > 0.3).astype(int) + ((x[:, 1] < -0.2) & (x[:, 0] <= 0.3)).astype(int) * 2
    y[rng.random(n) < 0.1] = 0
    rows = [(float(a) if i % 17 else None, float(b) if i % 23 else float("nan"), float(c), int(k) if i % 31 else None) for i, ((a, b, c), k) in enumerate(zip(x, y))]
    return rows, spark.createDataFrame(rows, "a double, b double, c double, y int")


@pytest.mark.parametrize("depth, least, bins", [(3, 10, 8), (6, 1, 16), (0, 1, 8)])
def test_tree_equals_plain_fit_and_walk(spark, depth, least, bins):
    rows, df = made(spark)
    tree = T.fit(df, ["a", "b", "c"], "y", 3, bins, depth, least)
    cuts = T.candidates(df.where("y is not null"), ["a", "b", "c"], bins)
    learnt = [r for r in rows if r[3] is not None]
    x = np.array([[0.0 if v is None or math.isnan(v) else v for v in r[:3]] for r in learnt])
    assert nested(tree) == plain_fit(x, np.array([r[3] for r in learnt]), cuts, 3, depth, least)
    got = [tuple(r) for r in df.select("a", "b", "c", T.evaluated(tree, ["a", "b", "c"])).collect()]
    assert [g[3] for g in got] == [walk(tree, r) for r in rows]
    assert T.from_table(T.as_table(spark, tree)) == tree
    if depth == 3:
        assert np.mean([g[3] == r[3] for g, r in zip(got, rows) if r[3] is not None]) > 0.85


def test_tree_odd_inputs(spark):
    rows, df = made(spark, 40)
    assert T.fit(df.where("a > 99"), ["a", "b"], "y", 3) == [T.Node(0, -1, 0.0, -1, -1, 0)]
    same = df.withColumn("a", F.lit(1.0)).withColumn("b", F.lit(None).cast("double"))
    assert len(T.fit(same, ["a", "b"], "y", 3)) == 1
    loop = spark.createDataFrame([(0, 0, 1.0, 0, 1, 0), (1, -1, 0.0, -1, -1, 1)], T.SHAPE)
    with pytest.raises(ValueError):
        T.from_table(loop)


def test_activity_tree_feeds_the_machine(spark):
    found = activity.activity_tree(spark, SF)
    held = found.where("held_out").agg(F.avg((F.col("activity") == F.col("counted")).cast("double")), F.count("*")).first()
    usual = found.where("held_out").groupBy("counted").count().agg(F.max("count")).first()[0] / held[1]
    assert held[0] > usual + 0.02  # better than calling all what most are
    tree = T.from_table(activity.activity_tree_nodes(spark, SF))
    rows = activity.labelled_blocks(spark, SF).collect()
    want = {(r["zmw"], r["mb"]): activity.CLASSES[walk(tree, [r[f] for f in activity.FEATURES])] for r in rows}
    assert {(r["zmw"], r["mb"]): r["activity"] for r in found.collect()} == want
    regions = activity.tree_regions(spark, SF).collect()
    assert regions and all(any(want.get((r["zmw"], m)) == "MULTI" for m in range(r["begin_mb"], r["end_mb"])) for r in regions)


def plain_em(n, law, start, limit, tolerance):
    """The fit of one key's counts by a loop over its bins."""
    w = np.array([start["background"]] + [(1 - start["background"]) / len(law.amplitudes)] * len(law.amplitudes))
    mean, variance, scale, like = start["mean"], start["variance"], start["scale"], None
    a = np.array(law.amplitudes)
    edge = law.low + law.width * np.arange(law.bins + 1)
    for turn in range(1, limit + 1):
        mu = np.concatenate(([mean], scale * a))
        var = np.concatenate(([variance], variance + law.shot * scale * a + (law.excess * scale * a) ** 2))
        d = np.array([[w[k] * math.exp(-((x - mu[k]) ** 2) / (2 * var[k])) / math.sqrt(2 * math.pi * var[k]) for k in range(law.modes)] for x in edge])
        p = np.maximum(1e-280, law.width / 2 * (d[:-1].sum(axis=1) + d[1:].sum(axis=1)))
        post = float((n * np.log(p)).sum() - n.sum() * math.log(p.sum()) - 0.5 * (scale - start["scale"]) ** 2 * start["weight"])
        if n.sum() == 0 or (like is not None and 0 <= post - like < tolerance * abs(post)):
            return w, mean, variance, scale, post, turn, True
        like, f = post, n / p * law.width / 2
        c, m, q = (np.array([(f * (d[:-1, k] * edge[:-1] ** i + d[1:, k] * edge[1:] ** i)).sum() for k in range(law.modes)]) for i in range(3))
        held = np.maximum(c, 0.1)
        least = max(0.5 * math.sqrt(variance), law.least_mean) / a.min()
        mean = m[0] / held[0]
        scale = max(least, ((a * m[1:] / var[1:]).sum() + start["scale"] * start["weight"]) / ((a * a * held[1:] / var[1:]).sum() + start["weight"]))
        variance = min(law.most_variance, max(law.least_variance, (q[0] - 2 * mean * m[0] + mean**2 * c[0]) / held[0] + law.width**2 / 12))
        w = held / held.sum()
    return w, mean, variance, scale, like, limit, False


@pytest.mark.parametrize("limit", [3, 40])
def test_em_equals_plain_loop(spark, limit):
    bins = estimation.height_bins(spark, SF).where("zmw < 12")
    none = spark.range(1).select(F.lit(-1).cast("long").alias("zmw"), F.explode(F.sequence(F.lit(0), F.lit(estimation.LAW.bins - 1))).alias("bin"), F.lit(0).cast("long").alias("n"))
    bins = bins.unionByName(none)  # a key without counts
    found = {r["zmw"]: r for r in M.fit(bins, estimation.first_model(bins), estimation.LAW, limit, 1e-4, at_once=3).collect()}
    counts = {}
    for r in bins.collect():
        counts.setdefault(r["zmw"], np.zeros(estimation.LAW.bins))[r["bin"]] = r["n"]
    assert found.keys() == counts.keys() and len(found) > 8
    for key, n in counts.items():
        w, mean, variance, scale, like, rounds, converged = plain_em(n, estimation.LAW, estimation.START, limit, 1e-4)
        r = found[key]
        assert (r["rounds"], r["converged"]) == (rounds, converged)
        assert np.allclose([r[f"w{k}"] for k in range(5)], w, atol=1e-9) and np.allclose([r["mean"], r["variance"], r["scale"], r["like"]], [mean, variance, scale, like], rtol=1e-7)


def test_em_finds_the_mixture_that_made_the_values(spark):
    """Two keys of known mixtures: parameters come back, the G-test accepts the converged one and refuses values of another law."""
    law, rng = estimation.LAW, np.random.default_rng(3)
    a, rows = np.array(law.amplitudes), []
    truth = {1: (np.array([0.5, 0.125, 0.125, 0.125, 0.125]), 12.0, 40.0, 110.0), 2: (np.array([0.3, 0.3, 0.1, 0.2, 0.1]), 8.0, 80.0, 90.0)}
    for key, (w, mean, variance, scale) in truth.items():
        mode = rng.choice(5, 6000, p=w)
        mu = np.concatenate(([mean], scale * a))
        var = np.concatenate(([variance], variance + law.shot * scale * a + (law.excess * scale * a) ** 2))
        rows += [(key, float(v)) for v in rng.normal(mu[mode], np.sqrt(var[mode]))]
    rows += [(3, float(v)) for v in rng.uniform(0, 300, 6000)] + [(4, None), (4, float("nan")), (4, 1e9)]
    bins = M.histogram(spark.createDataFrame(rows, "zmw long, x double"), law)
    found = {r["zmw"]: r for r in M.judged(bins, M.fit(bins, estimation.first_model(bins), law, 22, 1e-5), law).collect()}
    for key, (w, mean, variance, scale) in truth.items():
        r = found[key]
        assert abs(r["scale"] / scale - 1) < 0.06 and abs(r["mean"] - mean) < 1.5 and abs(r["variance"] / variance - 1) < 0.25
        assert np.abs(np.array([r[f"w{k}"] for k in range(5)]) - w).max() < 0.1 and r["chance"] > 100 * found[3]["chance"]
    # The second key's modes overlap more: its fit is still on its way after so few rounds, so only the first is accepted.
    assert found[1]["converged"] and found[1]["confidence"] > 0.3 and found[1]["chance"] > 1e-4
    assert found[3]["chance"] < 1e-6 and found[3]["confidence"] < found[1]["confidence"]
    assert found[4]["rounds"] == 1 and found[4]["g"] == 0


def test_histograms_have_as_many_tasks_as_bins_need(spark, monkeypatch):
    """Every bin of every key, counts inside only, by tasks that grow in number with the keys."""
    from tidewave.operators import mixtures as M

    law = M.Law(low=0.0, width=2.0, bins=4, amplitudes=(1.0,))
    rows = [(k, x) for k in range(50) for x in (0.0, 1.9, 2.0, 7.9, 8.0, -0.1, float("nan"), None)] + [(50, None), (None, 1.0)]
    monkeypatch.setattr(M, "PART", 20)
    bins = M.histogram(spark.createDataFrame(rows, "zmw long, x double"), law)
    want = {(k, b, n) for k in range(50) for b, n in enumerate((2, 1, 0, 1))} | {(50, b, 0) for b in range(4)} | {(None, b, int(b == 0)) for b in range(4)}
    got = [tuple(r) for r in bins.collect()]
    assert set(got) == want and len(got) == len(want)
    assert bins.rdd.getNumPartitions() >= 8
