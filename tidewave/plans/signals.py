"""Plans over ordered signals: windows, islands, histograms, moments, as-of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewave.functions import columns as C
from tidewave.session import table
from tidewave.sources.readers import pulses, traces

PULSE = """with pulse as (select user_id as zmw,
  row_number() over (partition by user_id order by ts, event_id) as frame,
  case event_type when 'click' then 'A' when 'view' then 'C' when 'purchase' then 'G' when 'error' then 'T' when 'signup' then 'N' end as label,
  value as height, epoch_us(ts) // 1000000 as start, event_id,
  (row_number() over (partition by user_id order by ts, event_id) - 1) // 8 as mb from events)
"""
TRACE = """with trace as (select vec_id as zmw, generate_subscripts(embedding, 1) - 1 as frame, cast(unnest(embedding) as double) as signal from embeddings)
"""
QUERIES, SQL = {}, {}


def ordered():
    return Window.partitionBy("zmw").orderBy("frame")


def query(sql: str | None = None):
    """Register a plan under its own name, with the SQL that it is held against."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


@query("select event_id, user_id, value * 2 as scaled from events where value > 100 and event_type = 'click'")
def scan_filter_project(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").where("value > 100 and event_type = 'click'").select("event_id", "user_id", (F.col("value") * 2).alias("scaled"))


@query("select event_id, cast(json_extract_string(props, '$.k') as bigint) as k from events")
def scan_json_props(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select("event_id", F.from_json("props", "k BIGINT")["k"].alias("k"))


@query(PULSE + "select zmw, count(*) as n, round(avg(height), 6) as mean, round(var_samp(height), 4) as variance from pulse group by zmw")
def moments(spark: SparkSession, sf: str) -> DataFrame:
    return pulses(spark, sf).groupBy("zmw").agg(F.count("*").alias("n"), F.round(F.avg("height"), 6).alias("mean"), F.round(F.var_samp("height"), 4).alias("variance"))


@query(PULSE + "select zmw, round(sum(height * frame) / sum(frame), 6) as mean from pulse group by zmw")
def weighted_moments(spark: SparkSession, sf: str) -> DataFrame:
    return pulses(spark, sf).groupBy("zmw").agg(F.round(C.weighted_mean(F.col("height"), F.col("frame")), 6).alias("mean"))


@query(PULSE + "select zmw, label, cast(floor(height / 20) as bigint) as bin, count(*) as n from pulse group by all")
def hist_uniform(spark: SparkSession, sf: str) -> DataFrame:
    return pulses(spark, sf).groupBy("zmw", "label", F.floor(F.col("height") / 20).alias("bin")).agg(F.count("*").alias("n"))


_BINS = PULSE + """, bins as (select label, cast(floor(height / 20) as bigint) as bin, count(*) as n from pulse group by all),
 sums as (select *, sum(n) over (partition by label order by bin) as upto, sum(n) over (partition by label) as total from bins)
"""


def _bins(spark: SparkSession, sf: str) -> DataFrame:
    b = pulses(spark, sf).groupBy("label", F.floor(F.col("height") / 20).alias("bin")).agg(F.count("*").alias("n"))
    by = Window.partitionBy("label")  # bins of a histogram, not rows
    return b.withColumn("upto", F.sum("n").over(by.orderBy("bin"))).withColumn("total", F.sum("n").over(by))


@query(_BINS + """select label, round(min(bin * 20 + 20 * (total * 0.75 - (upto - n)) / (n + 1)), 6) as fractile from sums
 where upto >= total * 0.75 and upto - n < total * 0.75 group by label""")
def hist_fractile(spark: SparkSession, sf: str) -> DataFrame:
    """The value below which three quarters lie, interpolated within its bin."""
    goal = F.col("total") * 0.75
    at = F.col("bin") * 20 + 20 * (goal - (F.col("upto") - F.col("n"))) / (F.col("n") + 1)
    return _bins(spark, sf).where((F.col("upto") >= goal) & (F.col("upto") - F.col("n") < goal)).groupBy("label").agg(F.round(F.min(at), 6).alias("fractile"))


@query(_BINS + "select label, bin, cast(upto as bigint) as upto, round(upto / total, 9) as share from sums")
def hist_cumcount(spark: SparkSession, sf: str) -> DataFrame:
    return _bins(spark, sf).select("label", "bin", "upto", F.round(F.col("upto") / F.col("total"), 9).alias("share"))


@query(PULSE + """, ranked as (select zmw, height, row_number() over (partition by zmw order by height, event_id) as r,
   count(*) over (partition by zmw) as n, sum(height) over (partition by zmw order by height, event_id) as upto, sum(height) over (partition by zmw) as total from pulse)
 select zmw, max(n) as n, round(avg(height), 6) as mean, round(stddev_pop(height), 6) as std,
  max(height) filter (where r = n // 2 + 1) as median, max(height) filter (where r = cast(floor(n * 0.95) as bigint) + 1) as p95,
  min(height) filter (where upto >= total / 2) as n50 from ranked group by zmw""")
def hist_stats_n50_p95(spark: SparkSession, sf: str) -> DataFrame:
    by = Window.partitionBy("zmw")
    r = (
        pulses(spark, sf).withColumn("r", F.row_number().over(by.orderBy("height", "event_id"))).withColumn("n", F.count("*").over(by))
        .withColumn("upto", F.sum("height").over(by.orderBy("height", "event_id"))).withColumn("total", F.sum("height").over(by))
    )
    at = lambda c: F.max(F.when(F.col("r") == c + 1, F.col("height")))
    return r.groupBy("zmw").agg(
        F.max("n").alias("n"), F.round(F.avg("height"), 6).alias("mean"), F.round(F.stddev_pop("height"), 6).alias("std"),
        at(F.floor(F.col("n") / 2)).alias("median"), at(F.floor(F.col("n") * 0.95)).alias("p95"),
        F.min(F.when(F.col("upto") >= F.col("total") / 2, F.col("height"))).alias("n50"),
    )


@query("select b.bin, count(p.p_partkey) as n from range(0, 40) b(bin) left join part p on least(p.p_size, 39) = b.bin group by b.bin")
def hist_discrete(spark: SparkSession, sf: str) -> DataFrame:
    """A count for every value, the last of which takes all larger ones."""
    counts = table(spark, sf, "part").groupBy(F.least("p_size", F.lit(39)).cast("long").alias("bin")).agg(F.count("*").alias("n"))
    return spark.range(40).toDF("bin").join(counts, "bin", "left").select("bin", F.coalesce("n", F.lit(0)).alias("n"))


@query(TRACE + "select frame, round(avg(signal) - 0.01, 6) as mean, round(var_samp(signal), 6) as variance from trace group by frame")
def pixel_mean_var(spark: SparkSession, sf: str) -> DataFrame:
    return traces(spark, sf).groupBy("frame").agg(F.round(F.avg("signal") - 0.01, 6).alias("mean"), F.round(F.var_samp("signal"), 6).alias("variance"))


@query(TRACE + """select * from (select zmw, frame, min(signal) over w as low, max(signal) over w as high from trace
 window w as (partition by zmw order by frame rows between 8 preceding and current row)) where frame % 4 = 0""")
def sliding_min_max(spark: SparkSession, sf: str) -> DataFrame:
    w = ordered().rowsBetween(-8, 0)
    return traces(spark, sf).select("zmw", "frame", F.min("signal").over(w).alias("low"), F.max("signal").over(w).alias("high")).where("frame % 4 = 0")


@query(TRACE + """, a as (select zmw, frame, min(signal) over w as ero, max(signal) over w as dil from trace window w as (partition by zmw order by frame rows between 4 preceding and current row))
 select zmw, frame, max(ero) over w as opened, min(dil) over w as closed from a window w as (partition by zmw order by frame rows between 4 preceding and current row)""")
def opening_closing(spark: SparkSession, sf: str) -> DataFrame:
    """Lower and upper envelopes: opening and closing by sliding extrema."""
    w = ordered().rowsBetween(-4, 0)
    a = traces(spark, sf).select("zmw", "frame", F.min("signal").over(w).alias("ero"), F.max("signal").over(w).alias("dil"))
    return a.select("zmw", "frame", F.max("ero").over(w).alias("opened"), F.min("dil").over(w).alias("closed"))


@query(TRACE + """, m as (select *, avg(signal) over (partition by zmw) as mean, lead(signal, 2) over (partition by zmw order by frame) as later from trace)
 select zmw, round(greatest(-1.0, least(1.0, (sum((signal - mean) * (later - mean)) / (count(later))) / (sum((signal - mean) * (signal - mean)) / count(*)))), 5) as autocorr from m group by zmw""")
def autocorr_lag(spark: SparkSession, sf: str) -> DataFrame:
    """Autocorrelation at lag 2, between -1 and 1."""
    d = F.col("signal") - F.col("mean")
    m = traces(spark, sf).withColumn("mean", F.avg("signal").over(Window.partitionBy("zmw"))).withColumn("later", F.lead("signal", 2).over(ordered()))
    r = (F.sum(d * (F.col("later") - F.col("mean"))) / F.count("later")) / (F.sum(d * d) / F.count("*"))
    return m.groupBy("zmw").agg(F.round(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), r)), 5).alias("autocorr"))


@query(PULSE + """, l as (select zmw, mb, label, lag(label) over w as one, lag(label, 2) over w as two from pulse window w as (partition by zmw order by frame))
 select zmw, mb, count(*) filter (where label = one) as stutters, count(*) filter (where label <> one) as half_sandwiches, count(*) filter (where label = two and label <> one) as sandwiches from l group by zmw, mb""")
def sandwich_stutter(spark: SparkSession, sf: str) -> DataFrame:
    p = pulses(spark, sf).withColumn("one", F.lag("label").over(ordered())).withColumn("two", F.lag("label", 2).over(ordered()))
    return p.groupBy("zmw", "mb").agg(
        F.count_if(F.col("label") == F.col("one")).alias("stutters"), F.count_if(F.col("label") != F.col("one")).alias("half_sandwiches"),
        F.count_if((F.col("label") == F.col("two")) & (F.col("label") != F.col("one"))).alias("sandwiches"),
    )


_BLOCKS = PULSE + """, blocks as (select zmw, mb, count(*) as pulses, count(*) filter (where label <> 'N') as bases, round(avg(height), 6) as mean,
   case when count(*) filter (where label <> 'N') <= 4 then 'LOW' when count(*) filter (where label <> 'N') <= 7 then 'SINGLE' else 'MULTI' end as activity from pulse group by zmw, mb)
"""


def blocks(spark: SparkSession, sf: str) -> DataFrame:
    """Metric blocks: pulses, bases, mean height and an activity by the number of bases."""
    b = pulses(spark, sf).groupBy("zmw", "mb").agg(F.count("*").alias("pulses"), F.count_if(F.col("label") != "N").alias("bases"), F.round(F.avg("height"), 6).alias("mean"))
    return b.withColumn("activity", F.when(F.col("bases") <= 4, "LOW").when(F.col("bases") <= 7, "SINGLE").otherwise("MULTI"))


@query(_BLOCKS + """, marked as (select *, case when activity = lag(activity) over (partition by zmw order by mb) then 0 else 1 end as fresh from blocks),
 runs as (select *, sum(fresh) over (partition by zmw order by mb) as run from marked)
 select zmw, cast(run as bigint) as run, min(mb) as first_mb, count(*) as mbs, max(activity) as activity, cast(sum(pulses) as bigint) as pulses, round(sum(pulses * mean) / sum(pulses), 7) as mean from runs group by zmw, run""")
def run_collapse(spark: SparkSession, sf: str) -> DataFrame:
    """Consecutive blocks of equal activity become one."""
    by = Window.partitionBy("zmw").orderBy("mb")
    m = blocks(spark, sf).withColumn("fresh", F.when(F.col("activity") == F.lag("activity").over(by), 0).otherwise(1))
    return m.withColumn("run", F.sum("fresh").over(by)).groupBy("zmw", "run").agg(
        F.min("mb").alias("first_mb"), F.count("*").alias("mbs"), F.max("activity").alias("activity"), F.sum("pulses").alias("pulses"),
        F.round(C.weighted_mean(F.col("mean"), F.col("pulses")), 7).alias("mean"),
    )


@query(TRACE + "select zmw, frame, coalesce((lag(signal) over w < 0.1) <> (lead(signal) over w < 0.1), true) as edge from trace window w as (partition by zmw order by frame)")
def edge_frames(spark: SparkSession, sf: str) -> DataFrame:
    """A frame is an edge if just one neighbour is baseline; so are the first and the last."""
    near = lambda f: f("signal").over(ordered()) < 0.1
    return traces(spark, sf).select("zmw", "frame", F.coalesce(near(F.lag) != near(F.lead), F.lit(True)).alias("edge"))


@query(TRACE + """, m as (select zmw, signal, lag(signal) over w < 0.15 and signal < 0.1 and lead(signal) over w < 0.15 as base from trace window w as (partition by zmw order by frame))
 select zmw, count(*) filter (where base) as frames, round(avg(signal) filter (where base), 6) as mean, round(var_samp(signal) filter (where base), 6) as variance, round(sum(signal), 5) as raw_sum from m group by zmw""")
def baseline_mask(spark: SparkSession, sf: str) -> DataFrame:
    base = (F.lag("signal").over(ordered()) < 0.15) & (F.col("signal") < 0.1) & (F.lead("signal").over(ordered()) < 0.15)
    m, own = traces(spark, sf).withColumn("base", base), F.when(F.col("base"), F.col("signal"))
    return m.groupBy("zmw").agg(F.count_if("base").alias("frames"), F.round(F.avg(own), 6).alias("mean"), F.round(F.var_samp(own), 6).alias("variance"), F.round(F.sum("signal"), 5).alias("raw_sum"))


@query(TRACE + """, s as (select *, signal >= 0.02 as low, case when (signal >= 0.02) = lag(signal >= 0.02) over w then 0 else 1 end as fresh from trace window w as (partition by zmw order by frame)),
 r as (select *, sum(fresh) over (partition by zmw order by frame) as island from s)
 select zmw, min(frame) as begin_frame, max(frame) + 1 as end_frame from r where low group by zmw, island having max(signal) >= 0.2""")
def roi_hysteresis(spark: SparkSession, sf: str) -> DataFrame:
    """Stretches over the low threshold that somewhere reach the high one."""
    s = traces(spark, sf).withColumn("low", F.col("signal") >= 0.02)
    s = s.withColumn("island", F.sum(F.when(F.col("low") == F.lag("low").over(ordered()), 0).otherwise(1)).over(ordered()))
    return s.where("low").groupBy("zmw", "island").agg(F.min("frame").alias("begin_frame"), (F.max("frame") + 1).alias("end_frame"), F.max("signal").alias("top")).where("top >= 0.2").select("zmw", F.col("begin_frame").cast("long"), F.col("end_frame").cast("long"))


@query(PULSE + """, m as (select *, case when label = lag(label) over w then 0 else 1 end as fresh from pulse window w as (partition by zmw order by frame)),
 r as (select *, sum(fresh) over (partition by zmw order by frame) as segment from m)
 select zmw, min(frame) as begin_frame, max(label) as label, count(*) as width, round(avg(height), 6) as mean, max(height) as top,
  round(sum(height * height), 6) as m2, count(*) >= 2 or avg(height) >= 70 as kept from r group by zmw, segment""")
def pulse_islands(spark: SparkSession, sf: str) -> DataFrame:
    """Stretches of one label, as pulses; thin and faint ones are not kept."""
    m = pulses(spark, sf).withColumn("segment", F.sum(F.when(F.col("label") == F.lag("label").over(ordered()), 0).otherwise(1)).over(ordered()))
    return m.groupBy("zmw", "segment").agg(
        F.min("frame").cast("long").alias("begin_frame"), F.max("label").alias("label"), F.count("*").alias("width"), F.round(F.avg("height"), 6).alias("mean"),
        F.max("height").alias("top"), F.round(F.sum(F.col("height") * F.col("height")), 6).alias("m2"), ((F.count("*") >= 2) | (F.avg("height") >= 70)).alias("kept"),
    ).drop("segment")


@query(PULSE + """select event_id, start - lag(start) over w as gap,
  start - max(start) filter (where label <> 'N') over (partition by zmw order by frame rows between unbounded preceding and 1 preceding) as base_gap from pulse window w as (partition by zmw order by frame)""")
def ipd_gap(spark: SparkSession, sf: str) -> DataFrame:
    """Time since the pulse before, and since the base before."""
    before = ordered().rowsBetween(Window.unboundedPreceding, -1)
    return pulses(spark, sf).select(
        "event_id", (F.col("start") - F.lag("start").over(ordered())).alias("gap"),
        (F.col("start") - F.max(F.when(F.col("label") != "N", F.col("start"))).over(before)).alias("base_gap"),
    )


@query(PULSE + """, d as (select event_id, zmw, frame, start - coalesce(lag(start) over (partition by zmw order by frame), 0) as delta, start from pulse)
 select event_id, delta, cast(sum(delta) over (partition by zmw order by frame) as bigint) as restored from d""")
def delta_codec(spark: SparkSession, sf: str) -> DataFrame:
    d = pulses(spark, sf).withColumn("delta", F.col("start") - F.lag("start", 1, 0).over(ordered()))
    return d.select("event_id", "delta", F.sum("delta").over(ordered()).alias("restored"))


@query("""with o as (select o_custkey, o_orderkey, o_orderkey - row_number() over (partition by o_custkey order by o_orderkey) as run from orders)
 select o_custkey, min(o_orderkey) as first_key, count(*) as size from o group by o_custkey, run""")
def rle_runs(spark: SparkSession, sf: str) -> DataFrame:
    """Runs of keys one apart, as first key and size."""
    o = table(spark, sf, "orders").select("o_custkey", "o_orderkey")
    run = F.col("o_orderkey") - F.row_number().over(Window.partitionBy("o_custkey").orderBy("o_orderkey"))
    return o.withColumn("run", run).groupBy("o_custkey", "run").agg(F.min("o_orderkey").alias("first_key"), F.count("*").alias("size")).drop("run")


@query(PULSE + "select zmw, height as third from (select zmw, height, row_number() over (partition by zmw order by height desc, event_id) as r from pulse) where r = 3")
def nth_largest(spark: SparkSession, sf: str) -> DataFrame:
    r = F.row_number().over(Window.partitionBy("zmw").orderBy(F.desc("height"), "event_id"))
    return pulses(spark, sf).withColumn("r", r).where("r = 3").select("zmw", F.col("height").alias("third"))


@query(PULSE + """select event_id, last_value(case when label = 'G' then height end ignore nulls) over (partition by zmw order by frame) as model,
 round(height - coalesce(last_value(case when label = 'G' then height end ignore nulls) over (partition by zmw order by frame), 0), 6) as corrected from pulse""")
def asof_model(spark: SparkSession, sf: str) -> DataFrame:
    """Each pulse with the newest model so far, which a G brings."""
    model = F.last(F.when(F.col("label") == "G", F.col("height")), ignorenulls=True).over(ordered())
    return pulses(spark, sf).select("event_id", "height", model.alias("model")).select("event_id", "model", F.round(F.col("height") - F.coalesce("model", F.lit(0.0)), 6).alias("corrected"))


@query(_BLOCKS + """, c as (select zmw, mb, pulses, sum(pulses) over (partition by zmw order by mb) as upto from blocks),
 k as (select distinct user_id as zmw, unnest([0, 5, 17, 40]) as idx from events)
 select k.zmw, k.idx, c.mb from k join c on k.zmw = c.zmw and k.idx >= c.upto - c.pulses and k.idx < c.upto""")
def range_join_block(spark: SparkSession, sf: str) -> DataFrame:
    """The block that holds the pulse of each wanted number: a range join on running counts within a key."""
    c = blocks(spark, sf).withColumn("upto", F.sum("pulses").over(Window.partitionBy("zmw").orderBy("mb"))).withColumnRenamed("zmw", "key")
    wanted = table(spark, sf, "events").select(F.col("user_id").alias("zmw")).distinct().select("zmw", F.explode(F.array(*map(F.lit, (0, 5, 17, 40)))).alias("idx"))
    on = (F.col("zmw") == F.col("key")) & (F.col("idx") >= F.col("upto") - F.col("pulses")) & (F.col("idx") < F.col("upto"))
    return wanted.join(c, on).select("zmw", "idx", "mb")


@query(PULSE + """, n as (select zmw, frame, label, count(*) filter (where label <> 'N') over (partition by zmw order by frame) - case when label <> 'N' then 1 else 0 end as base_index from pulse)
 select zmw, frame, cast(base_index as bigint) as base_index from n where label <> 'N'""")
def base_coordinates(spark: SparkSession, sf: str) -> DataFrame:
    """Each base's number among the bases, beside its number among the pulses."""
    is_base = (F.col("label") != "N").cast("long")
    return pulses(spark, sf).withColumn("base_index", F.sum(is_base).over(ordered()) - is_base).where("label != 'N'").select("zmw", F.col("frame").cast("long"), "base_index")


@query(_BLOCKS + """select zmw, mb, round(avg(case when activity = 'MULTI' then 1.0 else 0.0 end) over (partition by zmw order by mb rows between 1 following and 3 following), 6) as ahead,
 round(avg(case when activity = 'MULTI' then 1.0 else 0.0 end) over (partition by zmw order by mb rows between 3 preceding and 1 preceding), 6) as behind from blocks""")
def lookahead_rates(spark: SparkSession, sf: str) -> DataFrame:
    by, hit = Window.partitionBy("zmw").orderBy("mb"), (F.col("activity") == "MULTI").cast("double")
    return blocks(spark, sf).select("zmw", "mb", F.round(F.avg(hit).over(by.rowsBetween(1, 3)), 6).alias("ahead"), F.round(F.avg(hit).over(by.rowsBetween(-3, -1)), 6).alias("behind"))


@query(PULSE + "select * from (select event_id, count(*) over (partition by zmw order by start range between 86400 preceding and 86400 following) as near from pulse) where near >= 3")
def hit_density(spark: SparkSession, sf: str) -> DataFrame:
    """Pulses with at least three within a day, themselves counted."""
    by = Window.partitionBy("zmw").orderBy("start").rangeBetween(-86400, 86400)
    return pulses(spark, sf).select("event_id", F.count("*").over(by).alias("near")).where("near >= 3")


@query(PULSE + """, ends as (select zmw, start as moment, 1 as step from pulse union all select zmw, start + 43200, -1 from pulse),
 s as (select zmw, moment, sum(step) as step from ends group by zmw, moment)
 select zmw, moment, cast(sum(step) over (partition by zmw order by moment) as bigint) as opened from s""")
def sweep_line(spark: SparkSession, sf: str) -> DataFrame:
    """How many half-day stretches are open from each point on."""
    p = pulses(spark, sf)
    ends = p.select("zmw", F.col("start").alias("moment"), F.lit(1).alias("step")).unionByName(p.select("zmw", (F.col("start") + 43200).alias("moment"), F.lit(-1).alias("step")))
    s = ends.groupBy("zmw", "moment").agg(F.sum("step").alias("step"))
    return s.select("zmw", "moment", F.sum("step").over(Window.partitionBy("zmw").orderBy("moment")).alias("opened"))


@query(_BLOCKS + "select zmw, max(case when activity = 'MULTI' then mb end) as last_hq, min(case when activity = 'MULTI' then mb end) as first_hq from blocks group by zmw")
def hq_edges(spark: SparkSession, sf: str) -> DataFrame:
    hq = F.when(F.col("activity") == "MULTI", F.col("mb"))
    return blocks(spark, sf).groupBy("zmw").agg(F.max(hq).alias("last_hq"), F.min(hq).alias("first_hq"))


@query(_BLOCKS + "select zmw, mb from blocks where pulses = 8")
def full_blocks(spark: SparkSession, sf: str) -> DataFrame:
    return blocks(spark, sf).where("pulses = 8").select("zmw", "mb")


@query(_BLOCKS + """select zmw, mb, pulses, bases, mean, activity from blocks""")
def mb_counts(spark: SparkSession, sf: str) -> DataFrame:
    return blocks(spark, sf).select("zmw", "mb", "pulses", "bases", "mean", "activity")


@query(PULSE + """, b as (select zmw, mb, count(*) as n, avg(height) as m, var_samp(height) as v from pulse group by zmw, mb having count(*) > 1)
 select zmw, round(sum(n * m) / sum(n), 5) as mean, round(sum((n - 1) * v) / sum(n - 1), 3) as pooled from b group by zmw""")
def pooled_variance(spark: SparkSession, sf: str) -> DataFrame:
    b = pulses(spark, sf).groupBy("zmw", "mb").agg(F.count("*").alias("n"), F.avg("height").alias("m"), F.var_samp("height").alias("v")).where("n > 1")
    return b.groupBy("zmw").agg(F.round(C.weighted_mean(F.col("m"), F.col("n")), 5).alias("mean"), F.round(C.weighted_mean(F.col("v"), F.col("n") - 1), 3).alias("pooled"))


@query(_BLOCKS + """select zmw % 4 as region, mb, count(*) as zmws, case when count(*) > 3 then round(avg(mean), 9) else -1 end as mean,
 case when count(*) > 3 then round(stddev_samp(mean) / avg(mean), 5) else -1 end as cv, case when count(*) > 3 then round(median(mean), 9) else -1 end as median from blocks group by all""")
def region_report(spark: SparkSession, sf: str) -> DataFrame:
    """Metrics of regions block by block; -1 where too few keys report."""
    enough = lambda x: F.when(F.count("*") > 3, x).otherwise(-1.0)
    return blocks(spark, sf).groupBy(F.pmod("zmw", F.lit(4)).alias("region"), "mb").agg(
        F.count("*").alias("zmws"), enough(F.round(F.avg("mean"), 9)).alias("mean"),
        enough(F.round(F.stddev_samp("mean") / F.avg("mean"), 5)).alias("cv"), enough(F.round(F.median("mean"), 9)).alias("median"),
    )


@query(PULSE + """, g as (select zmw, start - lag(start) over (partition by zmw order by frame) as gap from pulse),
 s as (select zmw, list_sort(list(gap)) as held from g where gap is not null group by zmw)
 select zmw, round(held[len(held) // 2 + 1] / ln(2), 5) as ipd, held[cast(floor(len(held) * 0.75) as bigint) + 1] as upper from s""")
def robust_ipd(spark: SparkSession, sf: str) -> DataFrame:
    """Upper median of gaps over ln 2, and their upper quarter."""
    g = pulses(spark, sf).select("zmw", (F.col("start") - F.lag("start").over(ordered())).alias("gap")).where("gap is not null")
    by = Window.partitionBy("zmw")
    g = g.withColumn("r", F.row_number().over(by.orderBy("gap"))).withColumn("n", F.count("*").over(by))
    at = lambda place: F.max(F.when(F.col("r") == place + 1, F.col("gap")))
    return g.groupBy("zmw").agg(F.round(at(F.floor(F.col("n") / 2)) / F.log(F.lit(2.0)), 5).alias("ipd"), at(F.floor(F.col("n") * 0.75)).alias("upper"))


@query(PULSE + """, s as (select zmw, label, avg(height) as m, count(*) as n, stddev_samp(height) as sd from pulse where label <> 'N' group by zmw, label)
 select zmw, round(min(m / sd), 5) as min_snr, cast(case when min(m / sd) >= 0.5 then 0.8 else 0.0 end as double) as rq from s where n > 2 and sd > 0 group by zmw""")
def snr_weighted(spark: SparkSession, sf: str) -> DataFrame:
    s = pulses(spark, sf).where("label != 'N'").groupBy("zmw", "label").agg(F.avg("height").alias("m"), F.count("*").alias("n"), F.stddev_samp("height").alias("sd")).where("n > 2 and sd > 0")
    low = F.min(F.col("m") / F.col("sd"))
    return s.groupBy("zmw").agg(F.round(low, 5).alias("min_snr"), F.when(low >= 0.5, 0.8).otherwise(0.0).alias("rq"))


@query(PULSE + """, a as (select zmw, frame, lead(frame) over (partition by zmw order by frame) as later from pulse where label = 'N')
 select zmw, frame as begin_frame, later as end_frame, later - frame as length, row_number() over (partition by zmw order by frame) % 2 = 1 as forward from a where later is not null""")
def subreads_by_adapters(spark: SparkSession, sf: str) -> DataFrame:
    """Stretches between adapters (label N), which alternate in direction."""
    a = pulses(spark, sf).where("label = 'N'").withColumn("later", F.lead("frame").over(ordered())).withColumn("r", F.row_number().over(ordered()))
    long = lambda c: F.col(c).cast("long")
    return a.where("later is not null").select("zmw", long("frame").alias("begin_frame"), long("later").alias("end_frame"), (long("later") - long("frame")).alias("length"), (F.col("r") % 2 == 1).alias("forward"))


@query(PULSE + """, a as (select zmw, frame, lead(frame) over (partition by zmw order by frame) - frame as length from pulse where label = 'N'),
 t as (select zmw, count(*) as adapters, max(length) as longest, avg(length) as mean from a group by zmw), n as (select zmw, count(*) as frames from pulse group by zmw)
 select n.zmw, coalesce(adapters, 0) as adapters, case when coalesce(adapters, 0) < 2 then n.frames else longest end as longest, round(case when coalesce(adapters, 0) < 2 then n.frames else mean end, 6) as mean from n left join t on n.zmw = t.zmw""")
def insert_lengths(spark: SparkSession, sf: str) -> DataFrame:
    """Insert lengths: between adapters where there are two, else the whole read."""
    p = pulses(spark, sf)
    a = p.where("label = 'N'").withColumn("length", (F.lead("frame").over(ordered()) - F.col("frame")).cast("long"))
    t = a.groupBy("zmw").agg(F.count("*").alias("adapters"), F.max("length").alias("longest"), F.avg("length").alias("mean"))
    n, few = p.groupBy("zmw").agg(F.count("*").alias("frames")), F.coalesce("adapters", F.lit(0)) < 2
    return n.join(t, "zmw", "left").select("zmw", F.coalesce("adapters", F.lit(0)).alias("adapters"), F.when(few, F.col("frames")).otherwise(F.col("longest")).alias("longest"), F.round(F.when(few, F.col("frames")).otherwise(F.col("mean")), 6).alias("mean"))


@query(_BLOCKS + """select zmw, case when sum(bases) = 0 then 'P0' when avg(case when activity = 'MULTI' then 1.0 else 0.0 end) > 0.5 then 'P2' else 'P1' end as productivity from blocks group by zmw""")
def productivity(spark: SparkSession, sf: str) -> DataFrame:
    many = F.avg((F.col("activity") == "MULTI").cast("double"))
    return blocks(spark, sf).groupBy("zmw").agg(F.when(F.sum("bases") == 0, "P0").when(many > 0.5, "P2").otherwise("P1").alias("productivity"))


@query(_BLOCKS + """select count(distinct zmw) as zmws, cast(sum(pulses) as bigint) as pulses, cast(sum(bases) filter (where activity = 'MULTI') as bigint) as multi_bases,
 round(avg(mean) filter (where activity = 'SINGLE'), 4) as single_mean from blocks""")
def chip_stats(spark: SparkSession, sf: str) -> DataFrame:
    own = lambda a, c: F.when(F.col("activity") == a, F.col(c))
    return blocks(spark, sf).agg(F.countDistinct("zmw").alias("zmws"), F.sum("pulses").alias("pulses"), F.sum(own("MULTI", "bases")).alias("multi_bases"), F.round(F.avg(own("SINGLE", "mean")), 4).alias("single_mean"))
