"""Plans over reads: stitching, regions, subreads and their flags, inserts, controls, coordinates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewave.plans.relations import _LETTERS, sequences
from tidewave.plans.signals import PULSE, ordered
from tidewave.session import table
from tidewave.sources.readers import pulses

QUERIES, SQL = {}, {}

#: Bits of a subread's context; fixed values.
ADAPTER_BEFORE, ADAPTER_AFTER, FORWARD_PASS, REVERSE_PASS = 1, 2, 16, 32


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


#: A read's parts between its adapters (label N), with those before the first and after the last.
_PARTS = PULSE + """, cut as (select *, sum(case when label = 'N' then 1 else 0 end) over (partition by zmw order by frame) as part from pulse), most as (select zmw, max(part) as adapters from cut group by zmw),
 parts as (select zmw, part, min(frame) as begin_frame, max(frame) + 1 as end_frame, count(*) as length, string_agg(label, '' order by frame) as bases from cut where label <> 'N' group by zmw, part)
"""


def parts(spark: SparkSession, sf: str) -> DataFrame:
    cut = pulses(spark, sf).withColumn("frame", F.col("frame").cast("long")).withColumn("part", F.sum((F.col("label") == "N").cast("long")).over(ordered()))
    cut = cut.withColumn("adapters", F.max("part").over(Window.partitionBy("zmw")))
    letters = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("frame", "label"))), lambda s: s["label"]), "")  # one subread
    return cut.where("label != 'N'").groupBy("zmw", "part").agg(F.min("frame").alias("begin_frame"), (F.max("frame") + 1).alias("end_frame"), F.count("*").alias("length"), letters.alias("bases"), F.first("adapters").alias("adapters"))


@query(_PARTS + """select zmw, cast(part as bigint) as part, begin_frame, end_frame, length, bases,
 (case when part > 0 then 1 else 0 end) + (case when part < adapters then 2 else 0 end) + (case when part > 0 and part < adapters then case when part % 2 = 1 then 16 else 32 end else 0 end) as cx from parts join most using (zmw)""")
def subread_context(spark: SparkSession, sf: str) -> DataFrame:
    """Subreads with their letters and context bits: adapters on either side, and the pass of whole ones."""
    before, after = F.col("part") > 0, F.col("part") < F.col("adapters")
    way = F.when(before & after, F.when(F.col("part") % 2 == 1, FORWARD_PASS).otherwise(REVERSE_PASS)).otherwise(0)
    cx = F.when(before, ADAPTER_BEFORE).otherwise(0) + F.when(after, ADAPTER_AFTER).otherwise(0) + way
    return parts(spark, sf).select("zmw", "part", "begin_frame", "end_frame", "length", "bases", cx.alias("cx"))


@query(_PARTS + """, r as (select zmw, part, length, row_number() over (partition by zmw order by length, part) as r, count(*) over (partition by zmw) as k from parts),
 q as (select zmw, max(length) filter (where r = least(k, cast(floor(k * 0.75) as bigint) + 1)) as upper from r group by zmw) select zmw, cast(part as bigint) as part, length, length * 2 >= upper as passes from r join q using (zmw)""")
def insert_gate(spark: SparkSession, sf: str) -> DataFrame:
    """Subreads that are at least half as long as the upper quarter of their read's."""
    by = Window.partitionBy("zmw")
    r = parts(spark, sf).select("zmw", "part", "length").withColumn("r", F.row_number().over(by.orderBy("length", "part"))).withColumn("k", F.count("*").over(by))
    upper = F.max(F.when(F.col("r") == F.least(F.col("k"), F.floor(F.col("k") * 0.75) + 1), F.col("length"))).over(by)
    return r.select("zmw", "part", "length", (F.col("length") * 2 >= upper).alias("passes"))


@query(_PARTS + """, r as (select zmw, part, length, row_number() over (partition by zmw order by length, part) as r, count(*) over (partition by zmw) as k from parts),
 m as (select zmw, max(length) filter (where r = k // 2 + 1) as median from r group by zmw) select zmw, cast(part as bigint) as part, length, length > 1.8 * median as missed, length < 0.5 * median as false_hit from r join m using (zmw)""")
def length_outliers(spark: SparkSession, sf: str) -> DataFrame:
    """Subreads so long that an adapter may be missed in them, or so short that one may be false."""
    by = Window.partitionBy("zmw")
    r = parts(spark, sf).select("zmw", "part", "length").withColumn("r", F.row_number().over(by.orderBy("length", "part"))).withColumn("k", F.count("*").over(by))
    median = F.max(F.when(F.col("r") == F.floor(F.col("k") / 2) + 1, F.col("length"))).over(by)
    return r.select("zmw", "part", "length", (F.col("length") > 1.8 * median).alias("missed"), (F.col("length") < 0.5 * median).alias("false_hit"))


@query(_PARTS + "select zmw, string_agg(bases, '' order by part) as sequence, count(*) as subreads, list(part order by part) filter (where length >= 3) as inserts from parts group by zmw")
def stitched_reads(spark: SparkSession, sf: str) -> DataFrame:
    """All subreads of a read in one, and the numbers of those that are inserts. A read's length bounds a row."""
    held = F.array_sort(F.collect_list(F.struct("part", "bases", "length")))
    s = parts(spark, sf).groupBy("zmw").agg(held.alias("held"))
    inserts = F.transform(F.filter("held", lambda x: x["length"] >= 3), lambda x: x["part"])
    return s.select("zmw", F.array_join(F.transform("held", lambda x: x["bases"]), "").alias("sequence"), F.size("held").cast("long").alias("subreads"), F.when(F.size(inserts) > 0, inserts).alias("inserts"))


@query(PULSE + """, a as (select zmw, frame, row_number() over (partition by zmw order by frame) as r, case when height >= 90 then true when height < 30 then false end as known from pulse where label = 'N'),
 k as (select *, max(case when known is not null then r end) over (partition by zmw order by frame) as spot, last_value(known ignore nulls) over (partition by zmw order by frame) as way from a)
 select zmw, frame as begin_frame, case when spot is null then r % 2 = 1 when (r - spot) % 2 = 0 then way else not way end as forward from k""")
def orientation(spark: SparkSession, sf: str) -> DataFrame:
    """Direction of what follows each adapter: by the adapter where it tells, and else turning at each since the last that told."""
    known = F.when(F.col("height") >= 90, True).when(F.col("height") < 30, False)
    a = pulses(spark, sf).where("label = 'N'").withColumn("r", F.row_number().over(ordered())).withColumn("known", known)
    k = a.withColumn("at", F.max(F.when(F.col("known").isNotNull(), F.col("r"))).over(ordered())).withColumn("way", F.last("known", ignorenulls=True).over(ordered()))
    same = (F.col("r") - F.col("at")) % 2 == 0
    return k.select("zmw", F.col("frame").cast("long").alias("begin_frame"), F.when(F.col("at").isNull(), F.col("r") % 2 == 1).when(same, F.col("way")).otherwise(~F.col("way")).alias("forward"))


@query(_PARTS + """, tags as (select zmw, begin_frame, end_frame + (zmw + part) % 2 as end_frame, part from parts where part % 3 = 0), lq as (select zmw, frame as b, frame + 2 as e from pulse where height < 5)
 select p.zmw, cast(p.part as bigint) as part, case when t.part is not null and t.end_frame = p.end_frame then 'exact' when t.part is not null then 'begin'
  when exists (select 1 from lq where lq.zmw = p.zmw and lq.b < p.end_frame and p.begin_frame < lq.e) then 'filtered' else 'none' end as tag
 from parts p left join tags t on t.zmw = p.zmw and t.begin_frame = p.begin_frame""")
def tag_join(spark: SparkSession, sf: str) -> DataFrame:
    """Inserts with the tags that there are: the same span, a shared begin, else an overlap with a stretch of low quality."""
    p = parts(spark, sf).select("zmw", "part", "begin_frame", "end_frame")
    t = p.where("part % 3 = 0").select("zmw", "begin_frame", (F.col("end_frame") + F.pmod(F.col("zmw") + F.col("part"), F.lit(2))).alias("tag_end"))
    lq = pulses(spark, sf).where("height < 5").select(F.col("zmw").alias("z"), F.col("frame").alias("b"), (F.col("frame") + 2).alias("e"))
    hit = p.join(lq, (F.col("zmw") == F.col("z")) & (F.col("b") < F.col("end_frame")) & (F.col("begin_frame") < F.col("e")), "left_semi").select("zmw", "part", F.lit(True).alias("low"))
    kind = F.when(F.col("tag_end") == F.col("end_frame"), "exact").when(F.col("tag_end").isNotNull(), "begin").when(F.col("low"), "filtered").otherwise("none")
    return p.join(t, ["zmw", "begin_frame"], "left").join(hit, ["zmw", "part"], "left").select("zmw", "part", kind.alias("tag"))


@query(PULSE + """, g as (select *, coalesce(start - lag(start) over (partition by zmw order by frame), 0) // 3600 as ipd, 1 + cast(floor(height / 50) as bigint) as pw from pulse)
 select zmw, frame, cast(sum(ipd + pw) over w - pw as bigint) as start_frame, cast(least(greatest(sum(ipd + pw) over w - pw, mb * 512), mb * 512 + 511) as bigint) as clamped from g window w as (partition by zmw order by frame)""")
def base_frames(spark: SparkSession, sf: str) -> DataFrame:
    """First frames of bases from running sums of gaps and widths, and the same kept within the bounds of their block."""
    g = pulses(spark, sf).withColumn("ipd", F.floor(F.coalesce(F.col("start") - F.lag("start").over(ordered()), F.lit(0)) / 3600)).withColumn("pw", 1 + F.floor(F.col("height") / 50))
    g = g.withColumn("at", F.sum(F.col("ipd") + F.col("pw")).over(ordered()) - F.col("pw"))
    return g.select("zmw", F.col("frame").cast("long"), F.col("at").alias("start_frame"), F.least(F.greatest("at", F.col("mb") * 512), F.col("mb") * 512 + 511).alias("clamped"))


@query(PULSE + """, h as (select 'm/' || c_custkey || '/' || (c_custkey % 7) || '_' || (c_custkey % 7 + 12) as header from customer),
 f as (select cast(regexp_extract(header, '^m/(\\d+)/(\\d+)_(\\d+)$', 1) as bigint) as zmw, cast(regexp_extract(header, '^m/(\\d+)/(\\d+)_(\\d+)$', 2) as bigint) as b, cast(regexp_extract(header, '^m/(\\d+)/(\\d+)_(\\d+)$', 3) as bigint) as e from h),
 n as (select zmw, frame, count(*) filter (where label <> 'N') over (partition by zmw order by frame) - 1 as base from pulse)
 select f.zmw, min(n.frame) as begin_pulse, max(n.frame) + 1 as end_pulse from f join n on f.zmw = n.zmw and n.base >= f.b and n.base < f.e group by f.zmw""")
def listed_regions(spark: SparkSession, sf: str) -> DataFrame:
    """Regions given in bases by the headers of a list, in pulses; excluded pulses don't count as bases."""
    header = F.concat(F.lit("m/"), F.col("c_custkey"), F.lit("/"), F.col("c_custkey") % 7, F.lit("_"), F.col("c_custkey") % 7 + 12)
    field = lambda k: F.regexp_extract("header", r"^m/(\d+)/(\d+)_(\d+)$", k).cast("long")
    f = table(spark, sf, "customer").select(header.alias("header")).select(field(1).alias("zmw"), field(2).alias("b"), field(3).alias("e"))
    n = pulses(spark, sf).select("zmw", F.col("frame").cast("long").alias("frame"), (F.sum((F.col("label") != "N").cast("long")).over(ordered()) - 1).alias("base"))
    return n.join(f, "zmw").where("base >= b and base < e").groupBy("zmw").agg(F.min("frame").alias("begin_pulse"), (F.max("frame") + 1).alias("end_pulse"))


@query(_PARTS + """, d as (select zmw, length, count(*) over (partition by zmw order by cast(round(ln(length) * 100) as bigint) range between 5 preceding and 5 following) as near from parts)
 select zmw, length as mode, near, length // 2 as insert_size from (select *, row_number() over (partition by zmw order by near desc, length) as r from d) where r = 1""")
def insert_size(spark: SparkSession, sf: str) -> DataFrame:
    """The length with the most others within about 5 % of it, halved for a palindrome."""
    near = F.count("*").over(Window.partitionBy("zmw").orderBy(F.round(F.log("length") * 100).cast("long")).rangeBetween(-5, 5))
    d = parts(spark, sf).select("zmw", "length", near.alias("near")).withColumn("r", F.row_number().over(Window.partitionBy("zmw").orderBy(F.desc("near"), "length")))
    return d.where("r = 1").select("zmw", F.col("length").alias("mode"), "near", F.expr("length div 2").alias("insert_size"))


@query(PULSE + """, g as (select zmw, frame - lag(frame) over (partition by zmw order by frame) as gap from pulse where label = 'G'), e as (select zmw, 0.82 + 0.06 * greatest(0, 1 - avg(gap) / 20) as accuracy from g where gap is not null group by zmw), n as (select zmw, count(*) as n from pulse group by zmw)
 select zmw, round(accuracy, 9) as accuracy, round(pow(accuracy, 30) * n / 3, 6) as expected from e join n using (zmw)""")
def accuracy_estimate(spark: SparkSession, sf: str) -> DataFrame:
    """Accuracy from the mean distance of seeds, and the seeds that are then to be expected."""
    p = pulses(spark, sf)
    g = p.where("label = 'G'").select("zmw", (F.col("frame") - F.lag("frame").over(ordered())).alias("gap")).where("gap is not null")
    e = g.groupBy("zmw").agg((0.82 + 0.06 * F.greatest(F.lit(0.0), 1 - F.avg("gap") / 20)).alias("accuracy"))
    n = p.groupBy("zmw").agg(F.count("*").alias("n"))
    return e.join(n, "zmw").select("zmw", F.round("accuracy", 9).alias("accuracy"), F.round(F.pow("accuracy", F.lit(30)) * F.col("n") / 3, 6).alias("expected"))


@query(_LETTERS + """, k as (select doc_id, s, length(s) as n, greatest(1, length(s) // 1000 + case when length(s) % 1000 >= 200 then 1 else 0 end) as pieces from seq where length(s) > 0),
 e as (select *, unnest(range(0, pieces)) as piece from k) select doc_id, piece, substring(s, piece * 1000 + 1, case when piece = pieces - 1 then n else 1000 end) as bases from e""")
def split_segments(spark: SparkSession, sf: str) -> DataFrame:
    """Sequences cut into segments of 1000; a rest below 200 stays with the one before."""
    n = F.length("s")
    pieces = F.greatest(F.lit(1), F.expr("length(s) div 1000") + (n % 1000 >= 200).cast("int"))
    k = sequences(spark, sf).where("s != ''").select("doc_id", "s", n.alias("n"), pieces.alias("pieces"))
    e = k.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("pieces") - 1)).alias("piece"))
    return e.select("doc_id", "piece", F.expr("substring(s, cast(piece * 1000 + 1 as int), cast(if(piece = pieces - 1, n, 1000) as int))").alias("bases"))


@query(PULSE + "select event_id, case when start - lag(start) over w < 7200 and height < 15 then 'insert' when label = 'N' then 'excluded' else 'base' end as kind from pulse window w as (partition by zmw order by frame)")
def simple_inserts(spark: SparkSession, sf: str) -> DataFrame:
    """Faint pulses soon after another are inserts."""
    soon = F.col("start") - F.lag("start").over(ordered()) < 7200
    return pulses(spark, sf).select("event_id", F.when(soon & (F.col("height") < 15), "insert").when(F.col("label") == "N", "excluded").otherwise("base").alias("kind"))


@query(_PARTS + "select count(*) as records, cast(sum(length) as bigint) as bases, count(*) filter (where part > 0 and part < adapters) as full_length, count(*) filter (where length < 3) as short from parts join most using (zmw)")
def result_counters(spark: SparkSession, sf: str) -> DataFrame:
    """What a run has written: records, bases, whole subreads, short ones."""
    return parts(spark, sf).agg(F.count("*").alias("records"), F.sum("length").alias("bases"), F.count_if((F.col("part") > 0) & (F.col("part") < F.col("adapters"))).alias("full_length"), F.count_if(F.col("length") < 3).alias("short"))


@query(_PARTS + "select zmw, cast(part as bigint) as part, case when zmw % 17 = 0 then 'control' when length < 3 then 'scraps' else 'subreads' end as route, '>m/' || zmw || '/' || begin_frame || '_' || end_frame || chr(10) || bases as fasta, '@m/' || zmw || '/' || begin_frame || '_' || end_frame || chr(10) || bases || chr(10) || '+' || chr(10) || repeat('!', length::int) as fastq from parts")
def routed_records(spark: SparkSession, sf: str) -> DataFrame:
    """Subreads with the file that they go to, as FASTA and FASTQ."""
    name = F.concat_ws("", F.lit("m/"), F.col("zmw"), F.lit("/"), F.col("begin_frame"), F.lit("_"), F.col("end_frame"), F.lit("\n"), F.col("bases"))
    route = F.when(F.col("zmw") % 17 == 0, "control").when(F.col("length") < 3, "scraps").otherwise("subreads")
    return parts(spark, sf).select("zmw", "part", route.alias("route"), F.concat(F.lit(">"), name).alias("fasta"), F.concat(F.lit("@"), name, F.lit("\n+\n"), F.expr("repeat('!', cast(length as int))")).alias("fastq"))


@query("select event_id, coalesce(case event_type when 'click' then 1 when 'view' then 2 end, 0) as code, case event_type when 'click' then 'c' || user_id when 'error' then 'e' end as tag from events")
def tag_map(spark: SparkSession, sf: str) -> DataFrame:
    """Look-ups in maps: fixed codes, and a row's own tags put together from two maps."""
    codes = F.create_map(F.lit("click"), F.lit(1), F.lit("view"), F.lit(2))
    tags = F.map_concat(F.create_map(F.lit("click"), F.concat(F.lit("c"), F.col("user_id").cast("string"))), F.create_map(F.lit("error"), F.lit("e")))
    return table(spark, sf, "events").select("event_id", F.coalesce(F.try_element_at(codes, F.col("event_type")), F.lit(0)).alias("code"), F.try_element_at(tags, F.col("event_type")).alias("tag"))


@query(PULSE + """, s as (select zmw, mb, start, start < max(start) over (partition by zmw order by event_id rows between unbounded preceding and 1 preceding) as late from pulse)
 select zmw, count(*) filter (where coalesce(late, false)) as late, count(*) as n from s group by zmw""")
def late_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Rows that come, in order of their ids, after a later one of their key: these a stream in order must refuse."""
    before = Window.partitionBy("zmw").orderBy("event_id").rowsBetween(Window.unboundedPreceding, -1)
    return pulses(spark, sf).select("zmw", F.coalesce(F.col("start") < F.max("start").over(before), F.lit(False)).alias("late")).groupBy("zmw").agg(F.count_if("late").alias("late"), F.count("*").alias("n"))
