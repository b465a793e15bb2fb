"""Plans over metrics: baselines, detection models, block metrics and what is concluded from them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewave.functions import columns as C
from tidewave.plans.signals import _BLOCKS, PULSE, TRACE, blocks, ordered
from tidewave.session import table
from tidewave.sources.readers import pulses, traces

QUERIES, SQL = {}, {}

#: Relative amplitudes of the analogs; fixed values.
AMPLITUDES = {"A": 1.0, "C": 0.75, "G": 0.5, "T": 0.3}
_AMPLITUDES = "(values ('A', 1.0::double), ('C', 0.75::double), ('G', 0.5::double), ('T', 0.3::double)) r(analog, amplitude)"


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def by_block():
    return Window.partitionBy("zmw").orderBy("mb")


def analogs() -> F.Column:
    return F.array(*(F.struct(F.lit(k).alias("analog"), F.lit(v).alias("amplitude")) for k, v in AMPLITUDES.items()))


@query(TRACE + """, b as (select zmw, frame, signal, case when frame % 4 = 0 then min(signal) over (partition by zmw order by frame rows between 8 preceding and current row) end as known from trace)
 select zmw, frame, round((signal - last_value(known ignore nulls) over (partition by zmw order by frame)) * 2.5, 9) as above from b""")
def baseline_subtract(spark: SparkSession, sf: str) -> DataFrame:
    """The trace above its baseline, which is known at every fourth frame and held between, in photoelectrons."""
    low = F.min("signal").over(ordered().rowsBetween(-8, 0))
    b = traces(spark, sf).withColumn("known", F.when(F.col("frame") % 4 == 0, low))
    return b.select("zmw", "frame", F.round((F.col("signal") - F.last("known", ignorenulls=True).over(ordered())) * 2.5, 9).alias("above"))


_BASE = TRACE + ", base as (select zmw, count(*) as total, count(*) filter (where signal < 0.1) as n, avg(signal) filter (where signal < 0.1) as mean, var_samp(signal) filter (where signal < 0.1) as variance from trace group by zmw)\n"


def baselines(spark: SparkSession, sf: str) -> DataFrame:
    """Frames in all, and count, mean and variance of those that are baseline."""
    own = F.when(F.col("signal") < 0.1, F.col("signal"))
    return traces(spark, sf).groupBy("zmw").agg(F.count("*").alias("total"), F.count(own).alias("n"), F.avg(own).alias("mean"), F.var_samp(own).alias("variance"))


@query(_BASE + "select zmw, round(case when n < 50 then 0.02 else greatest(0.25 * sqrt(variance), 0.001) end, 9) as bin, round(case when n < 50 then -0.5 else mean - 4 * sqrt(variance) end, 9) as low from base")
def hist_bounds(spark: SparkSession, sf: str) -> DataFrame:
    """Bin size and lower end of a histogram from baseline statistics; with few frames, the fall-back."""
    few, sd = F.col("n") < 50, F.sqrt("variance")
    return baselines(spark, sf).select("zmw", F.round(F.when(few, 0.02).otherwise(F.greatest(0.25 * sd, F.lit(0.001))), 9).alias("bin"), F.round(F.when(few, -0.5).otherwise(F.col("mean") - 4 * sd), 9).alias("low"))


@query(TRACE + "select zmw, count(*) as n, round(avg(signal), 9) as mean, round(var_samp(signal), 9) as variance from trace where signal < 0.1 group by zmw")
def baseline_merge(spark: SparkSession, sf: str) -> DataFrame:
    """Statistics of chunks of 16 frames, merged: counts add, means weigh by them, and squares add what means differ by."""
    c = traces(spark, sf).where("signal < 0.1").groupBy("zmw", F.floor(F.col("frame") / 16).alias("chunk")).agg(F.count("*").alias("n"), F.avg("signal").alias("m"), F.coalesce(F.var_samp("signal"), F.lit(0.0)).alias("v"))
    n, m = F.sum("n"), C.weighted_mean(F.col("m"), F.col("n"))
    squares = F.sum((F.col("n") - 1) * F.col("v")) + F.sum(F.col("n") * F.col("m") * F.col("m")) - n * m * m
    return c.groupBy("zmw").agg(n.alias("n"), F.round(m, 9).alias("mean"), F.when(n > 1, F.round(squares / (n - 1), 9)).alias("variance"))


@query(_BASE + f"""select zmw, analog, round(amplitude * sqrt(greatest(0.0001, least(1.0, variance)) / 0.01), 9) as mean, round(0.1 * greatest(0.0, least(1.0, n / 50.0)), 9) as confidence
 from base cross join {_AMPLITUDES} where n >= 3""")
def prelim_model(spark: SparkSession, sf: str) -> DataFrame:
    """A first model of each analog: its reference mean scaled by the root of the baseline variances' ratio."""
    variance = F.greatest(F.lit(0.0001), F.least(F.lit(1.0), F.col("variance")))
    b = baselines(spark, sf).where("n >= 3").select("zmw", "n", variance.alias("variance"), F.inline(analogs()))
    return b.select("zmw", "analog", F.round(F.col("amplitude") * F.sqrt(F.col("variance") / 0.01), 9).alias("mean"), F.round(0.1 * C.saturating_linear(F.col("n"), 0.0, 50.0), 9).alias("confidence"))


@query(_BASE + f"""select zmw, analog, round(n / total, 9) as baseline_weight, round((1 - n / total) / 4, 9) as analog_weight,
 round(greatest(0.0, coalesce(mean, 0.0) + amplitude * 3 * sqrt(greatest(0.0001, coalesce(variance, 0.01)))), 9) as mean from base cross join {_AMPLITUDES}""")
def initial_model(spark: SparkSession, sf: str) -> DataFrame:
    """Weights and means before anything is estimated; fall-backs where the baseline tells nothing."""
    b = baselines(spark, sf).select("zmw", (F.col("n") / F.col("total")).alias("w"), F.coalesce("mean", F.lit(0.0)).alias("m"), F.greatest(F.lit(0.0001), F.coalesce("variance", F.lit(0.01))).alias("v"), F.inline(analogs()))
    mean = F.greatest(F.lit(0.0), F.col("m") + F.col("amplitude") * 3 * F.sqrt("v"))
    return b.select("zmw", "analog", F.round("w", 9).alias("baseline_weight"), F.round((1 - F.col("w")) / 4, 9).alias("analog_weight"), F.round(mean, 9).alias("mean"))


@query(_BLOCKS + """, p as (select zmw, mb, mean as b, pulses / 8.0 as cb, lag(mean) over w as a, lag(pulses) over w / 8.0 as ca from blocks window w as (partition by zmw order by mb))
 select zmw, mb, round(a * (1 - cb / (ca + cb)) + b * (cb / (ca + cb)), 6) as arithmetic, case when a > 0 and b > 0 then round(pow(a, 1 - cb / (ca + cb)) * pow(b, cb / (ca + cb)), 6) end as geometric from p where a is not null""")
def model_blend(spark: SparkSession, sf: str) -> DataFrame:
    """A model with the one before it, each weighing by its confidence: arithmetic and geometric."""
    p = blocks(spark, sf).select("zmw", "mb", F.col("mean").alias("b"), (F.col("pulses") / 8).alias("cb"), F.lag("mean").over(by_block()).alias("a"), (F.lag("pulses").over(by_block()) / 8).alias("ca")).where("a is not null")
    f = F.col("cb") / (F.col("ca") + F.col("cb"))
    both = (F.col("a") > 0) & (F.col("b") > 0)
    return p.select("zmw", "mb", F.round(F.col("a") * (1 - f) + F.col("b") * f, 6).alias("arithmetic"), F.when(both, F.round(F.pow("a", 1 - f) * F.pow("b", f), 6)).alias("geometric"))


@query(_BASE + """, f as (select zmw, greatest(0.0, least(1.0, (n - 10) / 40.0)) * greatest(0.0, least(1.0, 1.5 - n / total)) * greatest(0.0, least(1.0, (0.02 - variance) / 0.015)) as c from base where n > 1)
 select zmw, round(case when c < 0.05 then 0 else c end, 9) as confidence from f""")
def confidence_product(spark: SparkSession, sf: str) -> DataFrame:
    """Confidence in a model as the product of what speaks for it, and 0 where little is left."""
    unit = lambda x: F.greatest(F.lit(0.0), F.least(F.lit(1.0), x))
    c = unit((F.col("n") - 10) / 40.0) * unit(1.5 - F.col("n") / F.col("total")) * unit((0.02 - F.col("variance")) / 0.015)
    return baselines(spark, sf).where("n > 1").select("zmw", c.alias("c")).select("zmw", F.round(F.when(F.col("c") < 0.05, 0.0).otherwise(F.col("c")), 9).alias("confidence"))


@query(PULSE + """, o as (select label, cast(least(9, floor(height / 20)) as bigint) as bin, count(*) as n from pulse group by all), t as (select label, sum(n) as total from o group by label),
 e as (select label, bin, n, total * (exp(-bin * 0.4) * (case when bin < 9 then 1 - exp(-0.4) else 1 end)) as e from o join t using (label)),
 g as (select label, 2 * sum(n * ln(n / e)) as g from e group by label)
 select label, round(g, 5) as g, round(exp(-g / 2) * (1 + g / 2 + pow(g / 2, 2) / 2 + pow(g / 2, 3) / 6), 9) as p from g""")
def g_test(spark: SparkSession, sf: str) -> DataFrame:
    """Fit of each label's heights to an exponential law over ten bins: G, and the chance of one as large (8 degrees: bins less one, less the rate)."""
    o = pulses(spark, sf).groupBy("label", F.least(F.lit(9), F.floor(F.col("height") / 20)).alias("bin")).agg(F.count("*").alias("n"))
    share = F.exp(F.col("bin") * -0.4) * F.when(F.col("bin") < 9, 1 - F.exp(F.lit(-0.4))).otherwise(1.0)
    e = o.withColumn("e", F.sum("n").over(Window.partitionBy("label")) * share)  # ten rows a label
    return e.groupBy("label").agg((2 * F.sum(F.col("n") * F.log(F.col("n") / F.col("e")))).alias("g")).select("label", F.round("g", 5).alias("g"), F.round(C.chi2_tail(F.col("g"), 8), 9).alias("p"))


_PHI = "exp(-z * z / 2) * 0.3989422804014327 * t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))"


@query(f"with x as (select event_id, (value - 60) / 25 as x from events), a as (select event_id, x, abs(x) as z, 1 / (1 + 0.2316419 * abs(x)) as t from x), p as (select event_id, x, {_PHI} as q from a) select event_id, round(case when x > 0 then 1 - q else q end, 7) as below, round(case when x > 0 then q else 1 - q end, 7) as above from p")
def normal_tails(spark: SparkSession, sf: str) -> DataFrame:
    """Both tails of the normal law."""
    x = (F.col("value") - 60) / 25
    return table(spark, sf, "events").select("event_id", F.round(C.normal_cdf(x), 7).alias("below"), F.round(C.normal_cdf(-x), 7).alias("above"))


@query(_BLOCKS + """select zmw, mb, 12.5 as fixed, first_value(mean) over w as initial,
 last_value(case when mb % 4 = zmw % 4 then mean end ignore nulls) over w as staggered from blocks window w as (partition by zmw order by mb)""")
def model_modes(spark: SparkSession, sf: str) -> DataFrame:
    """The model in use at each block: a fixed one, the first estimate, or the newest of estimates that keys make in turn."""
    own = F.when(F.col("mb") % 4 == F.pmod("zmw", F.lit(4)), F.col("mean"))
    return blocks(spark, sf).select("zmw", "mb", F.lit(12.5).alias("fixed"), F.first("mean").over(by_block()).alias("initial"), F.last(own, ignorenulls=True).over(by_block()).alias("staggered"))


@query(_BLOCKS + """, c as (select zmw, mb, case when mb < 3 then 'STARTUP_HIST_INIT' when mb < 6 then 'STARTUP_DME_INIT' else 'SEQUENCING' end as state,
  mb % 3 = 2 and sum(pulses) over w >= 20 as whole, sum(pulses * mean) over w / sum(pulses) over w as running from blocks window w as (partition by zmw, mb // 3 order by mb))
 select zmw, mb, state, whole and mb >= 3 as estimated, round(last_value(case when state <> 'SEQUENCING' or whole then running end ignore nulls) over (partition by zmw order by mb), 6) as model from c""")
def estimation_states(spark: SparkSession, sf: str) -> DataFrame:
    """The state in which each block finds its key's estimation, whether it completes one, and the model after it.

    Statistics begin anew once 20 frames are there, which full blocks reach in three; only a key's last block may be
    short. The first such stretch only gathers statistics; from the second on each ends with an estimate. Until the
    first estimate the model follows the statistics, and then it changes with estimates only.
    """
    cycle = Window.partitionBy("zmw", F.expr("mb div 3")).orderBy("mb")
    state = F.when(F.col("mb") < 3, "STARTUP_HIST_INIT").when(F.col("mb") < 6, "STARTUP_DME_INIT").otherwise("SEQUENCING")
    whole = (F.col("mb") % 3 == 2) & (F.sum("pulses").over(cycle) >= 20)
    running = F.sum(F.col("pulses") * F.col("mean")).over(cycle) / F.sum("pulses").over(cycle)
    c = blocks(spark, sf).select("zmw", "mb", state.alias("state"), whole.alias("whole"), running.alias("running"))
    model = F.last(F.when((F.col("state") != "SEQUENCING") | F.col("whole"), F.col("running")), ignorenulls=True).over(by_block())
    return c.select("zmw", "mb", "state", (F.col("whole") & (F.col("mb") >= 3)).alias("estimated"), F.round(model, 6).alias("model"))


_SEGMENTS = PULSE + """, fresh as (select *, case when label = lag(label) over w then 0 else 1 end as fresh from pulse window w as (partition by zmw order by frame)),
 seg as (select zmw, segment, max(label) as label, count(*) as w, sum(height) as s, sum(height * height) as m2 from (select *, sum(fresh) over (partition by zmw order by frame) as segment from fresh) group by zmw, segment)
"""


def segments(spark: SparkSession, sf: str) -> DataFrame:
    """Stretches of one label: width, sum and sum of squares."""
    m = pulses(spark, sf).withColumn("segment", F.sum(F.when(F.col("label") == F.lag("label").over(ordered()), 0).otherwise(1)).over(ordered()))
    return m.groupBy("zmw", "segment").agg(F.max("label").alias("label"), F.count("*").alias("w"), F.sum("height").alias("s"), F.sum(F.col("height") * F.col("height")).alias("m2"))


@query(_SEGMENTS + """, v as (select zmw, label, count(*) as n, avg(w) as width, (sum(m2) - sum(s * s / w)) / nullif(sum(w) - count(*), 0) as pk, var_samp(s / w) as raw from seg group by zmw, label)
 select zmw, label, round(sqrt(pk), 6) as pkz, case when n < 2 or pk is null then null else round(sqrt(greatest(0, raw - pk / width)), 6) end as bpz from v""")
def bpzvar_pkzvar(spark: SparkSession, sf: str) -> DataFrame:
    """Deviation within pulses, and between them less what the former explains; null where too few tell."""
    mean = F.col("s") / F.col("w")
    free = F.sum("w") - F.count("*")
    v = segments(spark, sf).groupBy("zmw", "label").agg(F.count("*").alias("n"), F.avg("w").alias("width"), F.when(free > 0, (F.sum("m2") - F.sum(F.col("s") * mean)) / free).alias("pk"), F.var_samp(mean).alias("raw"))
    return v.select("zmw", "label", F.round(F.sqrt("pk"), 6).alias("pkz"), F.when((F.col("n") >= 2) & F.col("pk").isNotNull(), F.round(F.sqrt(F.greatest(F.lit(0.0), F.col("raw") - F.col("pk") / F.col("width"))), 6)).alias("bpz"))


@query(PULSE + """, l as (select *, lag(label) over (partition by zmw, mb order by frame) as one from pulse)
 select zmw, mb, round(count(*) / greatest(1, max(start) - min(start)) * 3600, 6) as per_hour, round(count(*) filter (where label <> one) / nullif(count(one), 0), 9) as half_sandwiches,
 round(max(height) / nullif(avg(height), 0), 6) as max_norm, avg(height) < 40 as low_snr from l group by zmw, mb""")
def activity_features(spark: SparkSession, sf: str) -> DataFrame:
    """Features of a block from its sums: rate, share of changes of label, peak over mean, low signal."""
    l = pulses(spark, sf).withColumn("one", F.lag("label").over(Window.partitionBy("zmw", "mb").orderBy("frame")))  # noqa: E741
    mean, links = F.avg("height"), F.count("one")
    return l.groupBy("zmw", "mb").agg(
        F.round(F.count("*") / F.greatest(F.lit(1), F.max("start") - F.min("start")) * 3600, 6).alias("per_hour"),
        F.round(F.when(links > 0, F.count_if(F.col("label") != F.col("one")) / links), 9).alias("half_sandwiches"),
        F.round(F.when(mean != 0, F.max("height") / mean), 6).alias("max_norm"), (mean < 40).alias("low_snr"))


@query(_BLOCKS + """, r as (select *, mb // 3 as merged, row_number() over (partition by zmw, mb // 3 order by mean, mb) as r, count(*) over (partition by zmw, mb // 3) as k from blocks)
 select zmw, merged, cast(sum(pulses) as bigint) as pulses, cast(sum(bases) as bigint) as bases, round(sum(pulses * mean) / sum(pulses), 6) as mean, max(activity) as activity,
 max(mean) filter (where r = k // 2 + 1) as median, cast(least(20, sum(pulses)) as bigint) as width from r group by zmw, merged""")
def metric_merge(spark: SparkSession, sf: str) -> DataFrame:
    """Three blocks in one: sums, means that weigh by frames, the greatest label, the upper median, a width that saturates."""
    by = Window.partitionBy("zmw", "merged")
    r = blocks(spark, sf).withColumn("merged", F.floor(F.col("mb") / 3)).withColumn("r", F.row_number().over(by.orderBy("mean", "mb"))).withColumn("k", F.count("*").over(by))
    return r.groupBy("zmw", "merged").agg(
        F.sum("pulses").alias("pulses"), F.sum("bases").alias("bases"), F.round(C.weighted_mean(F.col("mean"), F.col("pulses")), 6).alias("mean"), F.max("activity").alias("activity"),
        F.max(F.when(F.col("r") == F.floor(F.col("k") / 2) + 1, F.col("mean"))).alias("median"), F.least(F.lit(20), F.sum("pulses")).alias("width"))


@query(_BLOCKS + "select zmw, count(*) as mbs, round(avg(bases / pulses), 9) as base_share, round(avg(mean / pulses), 6) as height_a_pulse from blocks where activity = 'MULTI' group by zmw")
def hq_rates(spark: SparkSession, sf: str) -> DataFrame:
    """Means of the ratios of high-quality blocks."""
    return blocks(spark, sf).where("activity = 'MULTI'").groupBy("zmw").agg(F.count("*").alias("mbs"), F.round(F.avg(F.col("bases") / F.col("pulses")), 9).alias("base_share"), F.round(F.avg(F.col("mean") / F.col("pulses")), 6).alias("height_a_pulse"))


_CHANNELS = "count(*) filter (where label = 'A') as a, count(*) filter (where label = 'C') as c, count(*) filter (where label = 'G') as g, count(*) filter (where label = 'T') as t"


def channels() -> list:
    return [F.count_if(F.col("label") == x).alias(x.lower()) for x in "ACGT"]


@query(PULSE + f", n as (select zmw, count(*) as pulses, {_CHANNELS} from pulse group by zmw) select *, a + c + g + t >= 20 and least(a, c, g, t) >= 1 as is_read from n")
def bases_per_channel(spark: SparkSession, sf: str) -> DataFrame:
    """Bases of each channel, and whether they make a read: enough, and some of each."""
    n = pulses(spark, sf).groupBy("zmw").agg(F.count("*").alias("pulses"), *channels())
    return n.withColumn("is_read", (F.expr("a + c + g + t") >= 20) & (F.least("a", "c", "g", "t") >= 1))


@query(PULSE + """, p as (select zmw, frame, label, row_number() over (partition by zmw order by frame) as i, row_number() over (partition by zmw, label = 'N' order by frame) as k from pulse where height >= 10),
 r as (select zmw, i - k as run, count(*) as length from p where label = 'N' group by zmw, i - k) select zmw, count(*) as runs, max(length) as longest, round(avg(length), 6) as mean from r group by zmw""")
def excluded_runs(spark: SparkSession, sf: str) -> DataFrame:
    """Runs of excluded pulses; faint pulses between them don't break a run."""
    p = pulses(spark, sf).where("height >= 10").withColumn("out", F.col("label") == "N").withColumn("run", F.row_number().over(ordered()) - F.row_number().over(Window.partitionBy("zmw", "out").orderBy("frame")))
    r = p.where("out").groupBy("zmw", "run").agg(F.count("*").alias("length"))
    return r.groupBy("zmw").agg(F.count("*").alias("runs"), F.max("length").alias("longest"), F.round(F.avg("length"), 6).alias("mean"))


@query(PULSE + f""", c as (select zmw, mb, {_CHANNELS} from pulse group by zmw, mb), l as (select zmw, mb, least(a, c, g, t) as least_channel, a + c + g + t as bases from c),
 k as (select *, row_number() over (partition by zmw order by least_channel desc, mb) as r from l),
 s as (select zmw, count(*) as mbs, max(least_channel) filter (where r = 3) as third, avg(case when bases >= 7 then 1.0 else 0.0 end) as busy, sum(bases) as bases from k group by zmw)
 select zmw, case when bases = 0 then 'EMPTY' when coalesce(third, 0) >= 1 and busy >= 0.5 then 'FULL' when coalesce(third, 0) >= 1 then 'PARTIAL' when busy >= 0.5 then 'MULTI' else 'INDETERMINATE' end as read_type,
  coalesce(third, 0) >= 1 as sequencing, case when bases = 0 then 0 when coalesce(third, 0) >= 1 then 1 else 2 end as loading from s""")
def read_type(spark: SparkSession, sf: str) -> DataFrame:
    """Kind of read and loading: a key sequences where all channels are seen in a block, even without its two best blocks."""
    c = pulses(spark, sf).groupBy("zmw", "mb").agg(*channels()).select("zmw", "mb", F.least("a", "c", "g", "t").alias("low"), F.expr("a + c + g + t").alias("bases"))
    k = c.withColumn("r", F.row_number().over(Window.partitionBy("zmw").orderBy(F.desc("low"), "mb")))
    s = k.groupBy("zmw").agg(F.coalesce(F.max(F.when(F.col("r") == 3, F.col("low"))), F.lit(0)).alias("third"), F.avg((F.col("bases") >= 7).cast("double")).alias("busy"), F.sum("bases").alias("bases"))
    none, seq, busy = F.col("bases") == 0, F.col("third") >= 1, F.col("busy") >= 0.5
    return s.select("zmw", F.when(none, "EMPTY").when(seq & busy, "FULL").when(seq, "PARTIAL").when(busy, "MULTI").otherwise("INDETERMINATE").alias("read_type"), seq.alias("sequencing"), F.when(none, 0).when(seq, 1).otherwise(2).alias("loading"))


@query(PULSE + """, s as (select zmw, mb, label, avg(height) as m, max(height) as top, count(*) as n from pulse where label <> 'N' group by zmw, mb, label), t as (select zmw, mb, greatest(1, max(start) - min(start)) as seconds from pulse group by zmw, mb)
 select zmw, mb, round(sum(n) * 60.0 / max(seconds), 6) as per_minute, round(min(m / 25), 6) as min_snr, min(m / 25) < 1 as low_snr, round(max(top / nullif(m, 0)), 6) as max_norm from s join t using (zmw, mb) group by zmw, mb""")
def block_derived(spark: SparkSession, sf: str) -> DataFrame:
    """Metrics that follow from a block's: bases a minute, least signal to noise, the highest peak over its mean."""
    p = pulses(spark, sf)
    s = p.where("label != 'N'").groupBy("zmw", "mb", "label").agg(F.avg("height").alias("m"), F.max("height").alias("top"), F.count("*").alias("n"))
    t = p.groupBy("zmw", "mb").agg(F.greatest(F.lit(1), F.max("start") - F.min("start")).alias("seconds"))
    snr = F.min(F.col("m") / 25)
    return s.join(t, ["zmw", "mb"]).groupBy("zmw", "mb").agg(F.round(F.sum("n") * 60.0 / F.max("seconds"), 6).alias("per_minute"), F.round(snr, 6).alias("min_snr"), (snr < 1).alias("low_snr"), F.round(F.max(F.when(F.col("m") != 0, F.col("top") / F.col("m"))), 6).alias("max_norm"))


_FSM = _BLOCKS + """, rate as (select zmw, mb, activity = 'MULTI' as hq, avg(case when activity = 'MULTI' then 1.0 else 0.0 end) over (partition by zmw order by mb rows between current row and 9 following) as ahead,
  avg(case when activity = 'MULTI' then 1.0 else 0.0 end) over (partition by zmw order by mb rows between 9 preceding and current row) as behind from blocks),
 st as (select zmw, mb, hq, last_value(case when hq and ahead >= 0.3 then 1 when ahead < 0.1 and behind < 0.3 then 0 end ignore nulls) over (partition by zmw order by mb) as s from rate),
 fr as (select *, mb - row_number() over (partition by zmw, s order by mb) as run from st), spans as (select zmw, min(mb) as begin_mb, max(mb) + 1 as end_mb, count(*) filter (where hq) as hits from fr where s = 1 group by zmw, run)
"""


def machine_spans(activities: DataFrame) -> DataFrame:
    """Stretches in the high state of a machine that rises where many good blocks are ahead, and falls where few are on either side."""
    hit = (F.col("activity") == "MULTI").cast("double")
    r = activities.select("zmw", "mb", (F.col("activity") == "MULTI").alias("hq"), F.avg(hit).over(by_block().rowsBetween(0, 9)).alias("ahead"), F.avg(hit).over(by_block().rowsBetween(-9, 0)).alias("behind"))
    turn = F.when(F.col("hq") & (F.col("ahead") >= 0.3), 1).when((F.col("ahead") < 0.1) & (F.col("behind") < 0.3), 0)
    s = r.withColumn("s", F.last(turn, ignorenulls=True).over(by_block()))
    s = s.where("s = 1").withColumn("run", F.col("mb") - F.row_number().over(by_block()))
    return s.groupBy("zmw", "run").agg(F.min("mb").alias("begin_mb"), (F.max("mb") + 1).alias("end_mb"), F.count_if("hq").alias("hits")).drop("run")


@query(_FSM + "select zmw, begin_mb, end_mb, hits from (select *, row_number() over (partition by zmw order by hits desc, begin_mb) as r from spans) where r = 1")
def hq_machine(spark: SparkSession, sf: str) -> DataFrame:
    """The stretch with the most good blocks of a two-state machine with a window of ten blocks."""
    return machine_regions(blocks(spark, sf))


def machine_regions(activities: DataFrame) -> DataFrame:
    """The same over blocks (zmw, mb, activity) from any source."""
    best = F.row_number().over(Window.partitionBy("zmw").orderBy(F.desc("hits"), "begin_mb"))
    return machine_spans(activities).withColumn("r", best).where("r = 1").drop("r")


@query(_FSM + """select zmw, 'machine' as method, min(begin_mb) as begin_mb, max(end_mb) as end_mb from (select *, row_number() over (partition by zmw order by hits desc, begin_mb) as r from spans) where r = 1 group by zmw
 union all select zmw, 'hull', min(mb), max(mb) + 1 from blocks where activity = 'MULTI' group by zmw union all select zmw, 'whole', min(mb), max(mb) + 1 from blocks group by zmw""")
def hq_methods(spark: SparkSession, sf: str) -> DataFrame:
    """Regions by each method that can be chosen: the machine, the hull of good blocks, everything."""
    hull = lambda name, df: df.groupBy("zmw").agg(F.lit(name).alias("method"), F.min("mb").alias("begin_mb"), (F.max("mb") + 1).alias("end_mb"))
    machine = hq_machine(spark, sf).select("zmw", F.lit("machine").alias("method"), "begin_mb", "end_mb")
    return machine.unionByName(hull("hull", blocks(spark, sf).where("activity = 'MULTI'"))).unionByName(hull("whole", blocks(spark, sf)))


@query(_BLOCKS + """, z as (select zmw, sum(bases) as bases, avg(case when activity = 'MULTI' then 1.0 else 0.0 end) as many from blocks group by zmw)
 select zmw, true as every, bases = 0 as p0, bases > 0 and many <= 0.5 as p1, bases > 0 and many > 0.5 as p2, many > 0 as sequencing, zmw % 17 = 0 as control from z""")
def reducer_filters(spark: SparkSession, sf: str) -> DataFrame:
    """Which keys each filter of the reducer takes."""
    many, some = F.avg((F.col("activity") == "MULTI").cast("double")), F.sum("bases") > 0
    return blocks(spark, sf).groupBy("zmw").agg(F.lit(True).alias("every"), (~some).alias("p0"), (some & (many <= 0.5)).alias("p1"), (some & (many > 0.5)).alias("p2"), (many > 0).alias("sequencing")).withColumn("control", F.col("zmw") % 17 == 0)


@query(_BLOCKS + "select zmw % 4 as region, mb, concat_ws(',', zmw % 4, mb, count(*), cast(sum(pulses) as bigint), cast(sum(bases) as bigint)) as csv, '{\"mb\":' || mb || ',\"pulses\":' || cast(sum(pulses) as bigint) || '}' as json from blocks group by zmw % 4, mb")
def report_rows(spark: SparkSession, sf: str) -> DataFrame:
    """A report as lines of CSV and JSON."""
    r = blocks(spark, sf).groupBy(F.pmod("zmw", F.lit(4)).alias("region"), "mb").agg(F.count("*").alias("zmws"), F.sum("pulses").alias("pulses"), F.sum("bases").alias("bases"))
    return r.select("region", "mb", F.concat_ws(",", *(F.col(c).cast("string") for c in r.columns)).alias("csv"), F.to_json(F.struct("mb", "pulses")).alias("json"))


@query(_BLOCKS + """, r as (select zmw, mb, row_number() over (partition by mb order by zmw) as place from blocks where mb >= 2) select zmw, mb from r where place % 5 = 1""")
def throttled_admission(spark: SparkSession, sf: str) -> DataFrame:
    """Every fifth key of each block is let in, once the first two blocks, in which nothing has settled, are over."""
    r = blocks(spark, sf).where("mb >= 2").withColumn("place", F.row_number().over(Window.partitionBy("mb").orderBy("zmw")))
    return r.where("place % 5 = 1").select("zmw", "mb")


@query("select o_orderkey, coalesce(r.n > 2, false) as rejected, coalesce(r.q < 20, false) as truncated from orders left join (select l_orderkey, count(*) as n, min(l_quantity) as q from lineitem where l_returnflag = 'R' group by l_orderkey) r on o_orderkey = l_orderkey")
def reject_flags(spark: SparkSession, sf: str) -> DataFrame:
    """Flags of keys, false for those that no list names."""
    r = table(spark, sf, "lineitem").where("l_returnflag = 'R'").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count("*").alias("n"), F.min("l_quantity").alias("q"))
    flag = lambda c: F.coalesce(c, F.lit(False))
    return table(spark, sf, "orders").select("o_orderkey").join(r, "o_orderkey", "left").select("o_orderkey", flag(F.col("n") > 2).alias("rejected"), flag(F.col("q") < 20).alias("truncated"))


@query(PULSE + "select zmw, frame, label from pulse where frame <= 20 and zmw < 100")
def limit_frames(spark: SparkSession, sf: str) -> DataFrame:
    """The first frames of the first keys: a limit that the caller asks for."""
    return pulses(spark, sf).where("frame <= 20 and zmw < 100").select("zmw", F.col("frame").cast("long"), "label")


@query("select event_id, md5('7:' || event_id) as place from events")
def shuffled(spark: SparkSession, sf: str) -> DataFrame:
    """Rows in an order that a seed fixes, however they are parted."""
    return table(spark, sf, "events").select("event_id", F.md5(F.concat(F.lit("7:"), F.col("event_id").cast("string"))).alias("place")).orderBy("place")
