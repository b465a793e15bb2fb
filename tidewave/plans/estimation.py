"""Detection models of keys: histograms of pulse heights and the mixtures fitted to them."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewave.operators import mixtures as M
from tidewave.plans.metrics import AMPLITUDES
from tidewave.plans.signals import PULSE
from tidewave.sources.readers import pulses

QUERIES, SQL = {}, {}

LAW = M.Law(low=-20.0, width=5.0, bins=80, amplitudes=tuple(AMPLITUDES.values()))
#: Where fits start: background mean and variance, the scale and how firmly it is held, and the background's share.
START = {"mean": 10.0, "variance": 60.0, "scale": 100.0, "weight": 0.002, "background": 0.4}
LIMIT, TOLERANCE = 40, 1e-4


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def height_bins(spark: SparkSession, sf: str) -> DataFrame:
    return M.histogram(pulses(spark, sf).select("zmw", F.col("height").alias("x")), LAW)


def first_model(bins: DataFrame) -> DataFrame:
    return M.started(bins.select("zmw").distinct(), LAW, *(F.lit(START[c]) for c in ("mean", "variance", "scale", "weight", "background")))


def _step_sql() -> str:
    a, s = LAW.amplitudes, START
    means = [s["mean"], *(s["scale"] * x for x in a)]
    variances = [s["variance"], *(s["variance"] + LAW.shot * m + LAW.excess**2 * m * m for m in means[1:])]
    weights = [s["background"], *[(1 - s["background"]) / len(a)] * len(a)]
    density = lambda k, x: f"{weights[k]!r} * exp(-pow({x} - {means[k]!r}, 2) / {2 * variances[k]!r}) / {math.sqrt(2 * math.pi * variances[k])!r}"
    edges = ", ".join(f"{density(k, 'x0')} as l{k}, {density(k, 'x1')} as h{k}" for k in range(LAW.modes))
    every = " + ".join(f"l{k} + h{k}" for k in range(LAW.modes))
    moment = lambda k, i: f"sum(share * (l{k} * pow(x0, {i}) + h{k} * pow(x1, {i})))"
    sums = ", ".join(f"greatest(0.1, {moment(k, 0)}) as c{k}, {moment(k, 1)} as m{k}" for k in range(LAW.modes))
    pull = " + ".join(f"{x!r} * m{k} / {variances[k]!r}" for k, x in enumerate(a, 1))
    hold = " + ".join(f"{x * x!r} * c{k} / {variances[k]!r}" for k, x in enumerate(a, 1))
    all_c = " + ".join(f"c{k}" for k in range(LAW.modes))
    least = max(0.5 * math.sqrt(s["variance"]), LAW.least_mean) / min(a)
    return PULSE + f""", counts as (select zmw, cast(floor((height - {LAW.low}) / {LAW.width}) as bigint) as bin, count(*) as n from pulse group by all),
 bins as (select zmw, bin, coalesce(n, 0) as n from (select distinct zmw from pulse) cross join (select unnest(range(0, {LAW.bins})) as bin) left join counts using (zmw, bin)),
 e as (select *, {edges} from (select *, bin * {LAW.width} + {LAW.low} as x0, bin * {LAW.width} + {LAW.low} + {LAW.width} as x1 from bins)),
 p as (select *, greatest(1e-280, {LAW.width / 2} * ({every})) as p, n / greatest(1e-280, {LAW.width / 2} * ({every})) * {LAW.width / 2} as share from e),
 s as (select zmw, sum(n) as total, sum(n * ln(p)) as fit, sum(p) as mass, {moment(0, 0)} as raw0, {moment(0, 2)} as q0, {sums} from p group by zmw)
 select zmw, round(fit - total * ln(mass), 5) as "like", round(c0 / ({all_c}), 7) as w0, round(m0 / c0, 6) as mean,
  round(least({LAW.most_variance}, greatest({LAW.least_variance}, (q0 - 2 * (m0 / c0) * m0 + pow(m0 / c0, 2) * raw0) / c0 + {LAW.width**2 / 12!r})), 5) as variance,
  round(greatest({least!r}, ({pull} + {s['scale'] * s['weight']!r}) / ({hold} + {s['weight']!r})), 6) as scale from s"""


@query(_step_sql())
def em_step(spark: SparkSession, sf: str) -> DataFrame:
    """Every key's model after one round of EM from the same start, and its log posterior before."""
    bins = height_bins(spark, sf)
    m = M.step(bins, first_model(bins), LAW, TOLERANCE)
    return m.select("zmw", F.round("like", 5).alias("like"), F.round("w0", 7).alias("w0"), F.round("mean", 6).alias("mean"), F.round("variance", 5).alias("variance"), F.round("scale", 6).alias("scale"))


@query()
def em_bins(spark: SparkSession, sf: str) -> DataFrame:
    """The converged model of every key, with its G-test and confidence."""
    bins = M.written(height_bins(spark, sf), "bins")
    return M.judged(bins, M.fit(bins, first_model(bins), LAW, LIMIT, TOLERANCE), LAW).drop("expected", "trust")
