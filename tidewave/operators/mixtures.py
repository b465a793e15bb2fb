"""Grouped-data EM: mixtures of one background and pulses of shared scale, fitted to all keys' histograms at once.

The E-step is a set of columns over bins, the M-step a grouped sum by key; no key's values are gathered in one row.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewave.functions import columns as C
from tidewave.session import written


#: Bins of a task.
PART = 200_000


@dataclass(frozen=True)
class Law:
    """What is fixed in a fit: the bins, the pulses' amplitudes relative to the scale, and how variance grows with the mean."""

    low: float
    width: float
    bins: int
    amplitudes: Sequence[float]
    shot: float = 1.0  # variance a unit of mean
    excess: float = 0.15  # spread of pulses as a share of their mean
    least_variance: float = 1.0
    most_variance: float = 1e4
    least_mean: float = 1.0  # of the smallest pulse

    @property
    def modes(self) -> int:
        return 1 + len(self.amplitudes)


def histogram(values: DataFrame, law: Law) -> DataFrame:
    """(zmw, bin, n) with every bin of each key of ``values`` (zmw, x); half-open bins. Values outside, nulls and NaN are not counted."""
    keys = values.agg(F.approx_count_distinct("zmw")).first()[0]  # one row
    at = F.floor((F.col("x") - law.low) / law.width).cast("int")
    inside = F.col("x").isNotNull() & ~F.isnan("x") & at.between(0, law.bins - 1)
    counts = in_parts(values.select("zmw", F.when(inside, at).alias("bin")), keys * law.bins).groupBy("zmw", "bin").agg(F.count("*").alias("n"))
    # A key's counts in one row: no more than the bins, which are a parameter.
    held = counts.groupBy("zmw").agg(F.map_from_entries(F.collect_list(F.when(F.col("bin").isNotNull(), F.struct("bin", "n")))).alias("held"))
    bins = held.select("zmw", "held", F.explode(F.sequence(F.lit(0), F.lit(law.bins - 1))).alias("bin"))
    return bins.select("zmw", "bin", F.coalesce(F.try_element_at("held", F.col("bin")), F.lit(0).cast("long")).alias("n"))


def in_parts(rows: DataFrame, count: int) -> DataFrame:
    """``rows`` dealt by key to as many tasks as ``count`` bins need: bins shrink so much in a shuffle that its bytes don't tell their number."""
    return rows.repartition(max(1, -(-count // PART)), "zmw")


def started(keys: DataFrame, law: Law, mean: Column, variance: Column, scale: Column, weight: Column, background: Column) -> DataFrame:
    """The model that a fit starts from, one row a key: (zmw, w0.., mean, variance, scale, expected, trust, ...).

    ``weight`` is how firmly the prior holds the scale at ``scale`` (1 over its variance); ``background`` is the first weight.
    """
    rest = (1 - background) / (law.modes - 1)
    return keys.select(
        "zmw", background.alias("w0"), *(rest.alias(f"w{k}") for k in range(1, law.modes)), mean.alias("mean"), variance.alias("variance"), scale.alias("scale"),
        scale.alias("expected"), weight.alias("trust"), F.lit(None).cast("double").alias("like"), F.lit(0).alias("rounds"), F.lit(False).alias("converged"),
    )


def _laws(law: Law) -> tuple[list[str], list[str]]:
    """Means and variances of the modes, as SQL over a model's columns."""
    means = ["mean", *(f"scale * {a!r}D" for a in law.amplitudes)]
    return means, ["variance", *(f"(variance + {law.shot!r}D * {m} + {law.excess**2!r}D * {m} * {m})" for m in means[1:])]


def with_densities(rows: DataFrame, law: Law) -> DataFrame:
    """``rows`` (bins with their key's model) with each mode's density at a bin's edges x0 and x1, and the bin's probability p by the trapezoid over both."""
    means, variances = _laws(law)
    placed = rows.selectExpr("*", f"bin * {law.width!r}D + {law.low!r}D as x0", f"(bin + 1) * {law.width!r}D + {law.low!r}D as x1")
    density = lambda k, x: f"w{k} * exp(-({x} - {means[k]}) * ({x} - {means[k]}) / (2 * {variances[k]})) / sqrt({2 * math.pi!r}D * {variances[k]})"
    dense = placed.selectExpr("*", *(f"{density(k, x)} as {x}_{k}" for k in range(law.modes) for x in ("x0", "x1")))
    every = " + ".join(f"x0_{k} + x1_{k}" for k in range(law.modes))
    return dense.selectExpr("*", f"greatest(1e-280D, {law.width / 2!r}D * ({every})) as p")


def step(bins: DataFrame, model: DataFrame, law: Law, tolerance: float) -> DataFrame:
    """One round of EM for each key that hasn't converged; those that have keep their row.

    A key has converged when its log posterior rises by less than ``tolerance`` of its size; it then keeps the parameters
    with which that was found. Scale and variance stay within the law's bounds; a mode keeps a tenth of a count.
    """
    modes, a = range(law.modes), law.amplitudes
    named = with_densities(bins.join(model.where("not converged"), "zmw"), law).selectExpr("*", f"n / p * {law.width / 2!r}D as share")
    moment = lambda k, i: f"sum(share * (x0_{k} * pow(x0, {i}) + x1_{k} * pow(x1, {i})))"
    carried = [c for c in model.columns if c not in ("zmw", "rounds", "converged")]
    wanted = {
        **{c: f"any_value({c})" for c in (*carried, "rounds")}, "total": "sum(n)", "fit": "sum(n * ln(p))", "mass": "sum(p)", "q0": moment(0, 2),
        **{f"c{k}": moment(k, 0) for k in modes}, **{f"m{k}": moment(k, 1) for k in modes},
    }
    sums = named.groupBy("zmw").agg(*(F.expr(f"{e} as `{c}`") for c, e in wanted.items()))
    sums = sums.selectExpr("*", "fit - total * ln(mass) - 0.5D * (scale - expected) * (scale - expected) * trust as post", *(f"greatest(c{k}, 0.1D) as h{k}" for k in modes))
    sums = sums.selectExpr("*", f"total = 0 or coalesce(post - `like` >= 0 and post - `like` < {tolerance!r}D * abs(post), false) as done")
    variances = _laws(law)[1]
    pull = " + ".join([f"{x!r}D * m{k} / {variances[k]}" for k, x in enumerate(a, 1)] + ["expected * trust"])
    hold = " + ".join([f"{x * x!r}D * h{k} / {variances[k]}" for k, x in enumerate(a, 1)] + ["trust"])
    fresh = {
        "mean": "m0 / h0", "scale": f"greatest(greatest(0.5D * sqrt(variance), {law.least_mean!r}D) / {min(a)!r}D, ({pull}) / ({hold}))",
        "variance": f"least({law.most_variance!r}D, greatest({law.least_variance!r}D, (q0 - 2 * (m0 / h0) * m0 + (m0 / h0) * (m0 / h0) * c0) / h0 + {law.width**2 / 12!r}D))",
        **{f"w{k}": f"h{k} / ({' + '.join(f'h{j}' for j in modes)})" for k in modes}, "like": "post",
    }
    as_found = lambda c: "post" if c == "like" else c
    moved = sums.selectExpr("zmw", *(f"if(done, {as_found(c)}, {fresh.get(c, c)}) as `{c}`" if c in fresh else c for c in carried), "rounds + 1 as rounds", "done as converged")
    return moved.unionByName(model.where("converged"))


def fit(bins: DataFrame, model: DataFrame, law: Law, limit: int = 40, tolerance: float = 1e-4, at_once: int = 4) -> DataFrame:
    """EM until every key has converged, at most ``limit`` rounds. Bins are written once; of a round only the model is.

    ``at_once`` rounds make one plan, in which the bins are dealt by key once. A key without counts converges at once.
    """
    held, model, done = written(bins, "bins"), written(model, "model"), 0
    held = in_parts(held, held.count())
    while done < limit and not model.where("not converged").isEmpty():
        for _ in range(min(at_once, limit - done)):
            model, done = step(held, model, law, tolerance), done + 1
        model = written(model, "model")
    return model


def judged(bins: DataFrame, model: DataFrame, law: Law) -> DataFrame:
    """The fit's G statistic over each key's bins, its chance, and the confidence in the model.

    The chance is the chi-squared law's upper tail by the cube-root normal approximation, with as many degrees as
    bins that hold a count, less one and the parameters (weights, mean, variance, scale); 1 where none is left. Confidence
    is the product of: converged; background neither too rare nor all there is; signal over noise of the smallest pulse;
    a chance that isn't tiny.
    """
    b = with_densities(in_parts(bins, bins.count()).join(model, "zmw"), law)
    g = b.groupBy("zmw").agg(F.expr("sum(n) as total"), F.expr("sum(p) as mass"), F.expr("sum(if(n > 0, n * (ln(n) - ln(p)), 0D)) as raw"), F.expr("count_if(n > 0) as used"))
    g = g.selectExpr("zmw", "greatest(0D, 2 * (raw - total * ln(total / mass))) as g", f"used - {law.modes + 3} as free")
    k = F.greatest(F.lit(1), F.col("free"))
    z = (F.pow(F.col("g") / k, F.lit(1 / 3)) - (1 - 2 / (9 * k))) / F.sqrt(2 / (9 * k))
    found = model.join(g, "zmw", "left").withColumn("g", F.coalesce("g", F.lit(0.0))).withColumn("chance", F.when(F.col("free") > 0, C.normal_cdf(-z)).otherwise(1.0))
    unit = lambda x: F.greatest(F.lit(0.0), F.least(F.lit(1.0), x))
    snr = F.col("scale") * min(law.amplitudes) / F.sqrt("variance")
    trust = F.col("converged").cast("double") * unit(F.col("w0") / 0.05) * unit((1 - F.col("w0")) / 0.02) * unit((snr - 0.25) / 0.5) * unit(F.pow(F.col("chance"), F.lit(0.1)))
    return found.withColumn("confidence", trust).drop("free")
