"""Plans over relations: spatial reduction, intervals, joins, strings, codecs, checks."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewave.functions import columns as C
from tidewave.operators import kernels as K
from tidewave.plans.signals import PULSE, blocks
from tidewave.session import ship_package, table, written
from tidewave.sources.readers import pulses

QUERIES, SQL = {}, {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


_CELL = "with cell as (select p_partkey % 50 as x, p_partkey // 50 as y, p_retailprice as v, (p_size & 1) = 1 as chosen, p_partkey from part)\n"


def cells(spark: SparkSession, sf: str) -> DataFrame:
    key = F.col("p_partkey")
    return table(spark, sf, "part").select(F.pmod(key, F.lit(50)).alias("x"), F.expr("p_partkey div 50").alias("y"), F.col("p_retailprice").alias("v"),
                                           (F.col("p_size").bitwiseAND(1) == 1).alias("chosen"), key)


def binned(df: DataFrame, *aggregates, size: int = 10) -> DataFrame:
    """Aggregates of square bins of a plane; partial bins at the edges stay."""
    return df.groupBy(F.floor(F.col("x") / size).alias("bx"), F.floor(F.col("y") / size).alias("by")).agg(*aggregates)


_BIN = _CELL + "select x // 10 as bx, y // 10 as by, {} from cell where chosen group by all"


@query(_BIN.format("round(sum(v), 4) as total"))
def reduce_sum(spark: SparkSession, sf: str) -> DataFrame:
    return binned(cells(spark, sf).where("chosen"), F.round(F.sum("v"), 4).alias("total"))


@query(_BIN.format("round(avg(v), 6) as mean"))
def reduce_mean(spark: SparkSession, sf: str) -> DataFrame:
    return binned(cells(spark, sf).where("chosen"), F.round(F.avg("v"), 6).alias("mean"))


@query(_BIN.format("round(median(v), 6) as median"))
def reduce_median(spark: SparkSession, sf: str) -> DataFrame:
    return binned(cells(spark, sf).where("chosen"), F.round(F.median("v"), 6).alias("median"))


@query(_BIN.format("min(v) as low, max(v) as high"))
def reduce_minmax(spark: SparkSession, sf: str) -> DataFrame:
    return binned(cells(spark, sf).where("chosen"), F.min("v").alias("low"), F.max("v").alias("high"))


@query(_BIN.format("count(*) filter (where x % 3 = 1) as n"))
def reduce_count_eq(spark: SparkSession, sf: str) -> DataFrame:
    return binned(cells(spark, sf).where("chosen"), F.count_if(F.col("x") % 3 == 1).alias("n"))


@query(_CELL + "select x // 10 as bx, y // 10 as by, v from cell where x % 10 = 0 and y % 10 = 0")
def reduce_subsample(spark: SparkSession, sf: str) -> DataFrame:
    """The first corner of each bin; the filter has no part in it."""
    return cells(spark, sf).where("x % 10 = 0 and y % 10 = 0").select(F.floor(F.col("x") / 10).alias("bx"), F.floor(F.col("y") / 10).alias("by"), "v")


@query(_CELL + """, height as (select max(y) as top from cell) select g.gx, g.gy, c.v from (select a.gx, unnest(range(0, top + 1)) as gy from (select unnest(range(0, 50)) as gx) a, height) g left join cell c on c.x = g.gx and c.y = g.gy""")
def grid_left_join_whole(spark: SparkSession, sf: str) -> DataFrame:
    """The dense grid as high as the cells reach, so that every cell is in it."""
    c = cells(spark, sf)
    top = c.agg(F.max("y")).first()[0]  # one row
    grid = spark.range(0 if top is None else 50 * (top + 1)).select((F.col("id") % 50).alias("gx"), F.expr("id div 50").alias("gy"))
    return grid.join(c.select(F.col("x").alias("gx"), F.col("y").alias("gy"), "v"), ["gx", "gy"], "left")


@query(_CELL + "select distinct x // 4 as lane, y from cell where (x between 3 and 12 and y between 0 and 2) or (x between 40 and 44 and y = 3)")
def roi_rect(spark: SparkSession, sf: str) -> DataFrame:
    """Lanes that a rectangle touches, each once."""
    inside = (F.col("x").between(3, 12) & F.col("y").between(0, 2)) | (F.col("x").between(40, 44) & (F.col("y") == 3))
    return cells(spark, sf).where(inside).select(F.floor(F.col("x") / 4).alias("lane"), "y").distinct()


@query("select p_partkey, p_size from part where (p_size & 6) = 6")
def bitmask_flags(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").where(F.col("p_size").bitwiseAND(6) == 6).select("p_partkey", "p_size")


@query("select p_partkey from part where p_partkey % 7 = 0")
def stride_rows(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").where("p_partkey % 7 = 0").select("p_partkey")


_SPAN = """with span as (select l_orderkey as id, min(datediff('day', date '1970-01-01', cast(l_shipdate as date))) as b, max(datediff('day', date '1970-01-01', cast(l_shipdate as date))) + 1 as e,
  min(l_suppkey) as s, round(sum(l_quantity), 2) as score from lineitem group by l_orderkey)
"""


def spans(spark: SparkSession, sf: str) -> DataFrame:
    """Each order as an interval of days, with a key and a score."""
    day = F.date_diff(F.to_date("l_shipdate"), F.lit("1970-01-01").cast("date"))
    return table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("id")).agg(
        F.min(day).cast("long").alias("b"), (F.max(day) + 1).cast("long").alias("e"), F.min("l_suppkey").alias("s"), F.round(F.sum("l_quantity"), 2).alias("score"))


def overlapping(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Pairs of intervals (b, e) of one key that overlap: an equi-join on key and bin, each pair where it begins.

    A bin is as wide as the intervals of ``a`` are long in the mean, so that these are in about two each, whatever their unit.
    """
    mean = a.agg(F.avg(F.col("e") - F.col("b"))).first()[0]  # one row
    width = max(1, int(mean or 1))
    bins = F.explode(F.sequence(F.floor(F.col("b") / width), F.floor((F.col("e") - 1) / width)))
    x = a.select(*[F.col(c).alias(f"a_{c}") for c in a.columns], bins.alias("bin"))
    y = b.select(*[F.col(c).alias(f"b_{c}") for c in b.columns], bins.alias("bin"))
    on = (x["bin"] == y["bin"]) & (F.col(f"a_{key}") == F.col(f"b_{key}")) & C.overlap(F.col("a_b"), F.col("a_e"), F.col("b_b"), F.col("b_e"))
    return x.join(y, on).where(F.floor(F.greatest("a_b", "b_b") / width) == x["bin"]).drop("bin")


#: Levels of the tree of days: 2^LEVELS of them, from 1970 to 2149, and as many before.
LEVELS = 16


def tree_nodes() -> F.Column:
    """Nodes (k: level, i: place) of the binary tree over days that the interval [b, e) touches.

    ``own`` ones are the fewest that make it up; the others hold one of its ends and days outside it.
    """
    first, last = "-shiftright(-b, k)", "shiftright(e, k)"
    node = lambda own, i, when: f"if({when}, named_struct('own', {own}, 'k', k, 'i', {i}), null)"
    inside = lambda i: f"(shiftleft({i}, k) >= b and shiftleft({i} + 1, k) <= e)"
    low, high = "shiftright(b, k)", "shiftright(e - 1, k)"
    every = [
        node("true", first, f"{first} < {last} and ({first}) & 1 = 1"), node("true", f"{last} - 1", f"{first} < {last} and {last} & 1 = 1"),
        node("false", low, f"not {inside(low)}"), node("false", high, f"{high} <> {low} and not {inside(high)}"),
    ]
    return F.expr(f"filter(flatten(transform(sequence(0, {LEVELS}), k -> array({', '.join(every)}))), x -> x is not null)")


@query(_SPAN + """select x.id as left_id, y.id as right_id, greatest(x.b, y.b) as clip_begin, least(x.e, y.e) as clip_end from span x join span y
 on x.s = y.s and x.b < y.e and y.b < x.e and x.id < y.id""")
def interval_overlap_clip(spark: SparkSession, sf: str) -> DataFrame:
    s = spans(spark, sf)
    return overlapping(s, s, "s").where("a_id < b_id").select(F.col("a_id").alias("left_id"), F.col("b_id").alias("right_id"), F.greatest("a_b", "b_b").alias("clip_begin"), F.least("a_e", "b_e").alias("clip_end"))


@query(_SPAN + """, m as (select s, b, e, max(e) over (partition by s order by b, e, id rows between unbounded preceding and 1 preceding) as reach from span)
 select s, reach as gap_begin, b as gap_end from m where b > reach""")
def interval_complement(spark: SparkSession, sf: str) -> DataFrame:
    """What the intervals of a key leave open between its first and last day."""
    w = Window.partitionBy("s").orderBy("b", "e", "id").rowsBetween(Window.unboundedPreceding, -1)
    return spans(spark, sf).withColumn("reach", F.max("e").over(w)).where("b > reach").select("s", F.col("reach").alias("gap_begin"), F.col("b").alias("gap_end"))


@query(_SPAN + """select id, score from span x where not exists (select 1 from span y where x.s = y.s and x.b < y.e and y.b < x.e and (y.score > x.score or (y.score = x.score and y.id < x.id)))""")
def conflict_resolution(spark: SparkSession, sf: str) -> DataFrame:
    """Intervals that no overlapping one of a better score beats, without pairs.

    An interval within a better one is beaten, and beats nothing that the better one doesn't; few are left without those. Every
    interval is made of some nodes of a binary tree over days, and two overlap just where a node of one is a node
    of the other, or above or below it. So an interval is beaten by the best that touches a node of its own, or that
    owns a node which it touches; both are maxima of groups, which are combined before they are shuffled.
    """
    ship_package(spark)
    return unbeaten(uncovered(spans(spark, sf)))


def unbeaten(spans: DataFrame) -> DataFrame:
    """(id, score) of the intervals that no overlapping one of their key beats, by the tree."""
    s = spans.withColumn("rank", F.struct("score", (-F.col("id")).alias("low")))
    rows = s.select("id", "s", "rank", F.inline(tree_nodes()))
    best = rows.groupBy("s", "k", "i").agg(F.max("rank").alias("touching"), F.max(F.when(F.col("own"), F.col("rank"))).alias("owning"))
    met = rows.join(best, ["s", "k", "i"]).groupBy("id").agg(F.first("rank").alias("rank"), F.max(F.when(F.col("own"), F.col("touching")).otherwise(F.col("owning"))).alias("best"))
    return met.where("best = rank").select("id", F.col("rank.score").alias("score"))


#: Intervals of a part of a key's, which are held against each other at once.
PART = 1000


def uncovered(spans: DataFrame, part: int = PART) -> DataFrame:
    """``spans`` (id, b, e, s, score) without those that lie within a better one (score, then smaller id) of their key and part.

    A key has as many parts as its rows need, so that no task holds a large key. What lies within a better one of another part stays.
    """
    spans = written(spans, "spans")
    sizes = written(spans.groupBy("s").agg(F.ceil(F.count("*") / part).cast("int").alias("parts")).where("parts > 1"), "parts")
    dealt = spans.join(sizes, "s", "left").withColumn("part", F.pmod(F.xxhash64("id"), F.coalesce("parts", F.lit(1))))

    columns = spans.columns

    def alone(rows: pa.Table) -> pa.Table:
        b, e, score, key = (rows[c].to_numpy() for c in ("b", "e", "score", "id"))
        return rows.select(columns).filter(pa.array(~K.covered(b, e, score, key)))

    return dealt.groupBy("s", "part").applyInArrow(alone, spans.schema)


@query("select o_orderkey, o_totalprice from orders where o_custkey in (select c_custkey from customer where c_mktsegment = 'BUILDING')")
def whitelist_semi(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "customer").where("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("o_custkey"))
    return table(spark, sf, "orders").join(c, "o_custkey", "left_semi").select("o_orderkey", "o_totalprice")


@query("select c_custkey from customer where c_custkey not in (select o_custkey from orders)")
def anti_reject(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "customer").select("c_custkey").join(table(spark, sf, "orders").select(F.col("o_custkey").alias("c_custkey")), "c_custkey", "left_anti")


@query("select c_custkey, n_name, r_name from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey")
def zmw_dim_join(spark: SparkSession, sf: str) -> DataFrame:
    """Keys with their dimensions; these are small, and Spark broadcasts them by their size."""
    c, n, r = (table(spark, sf, t) for t in ("customer", "nation", "region"))
    return c.join(n, c["c_nationkey"] == n["n_nationkey"]).join(r, n["n_regionkey"] == r["r_regionkey"]).select("c_custkey", "n_name", "r_name")


@query("""with a as (select l_suppkey, count(*) as n from lineitem group by 1), b as (select s_suppkey, s_acctbal from supplier)
 select s_suppkey, s_acctbal, n from b join a on l_suppkey = s_suppkey""")
def positional_zip(spark: SparkSession, sf: str) -> DataFrame:
    n = table(spark, sf, "lineitem").groupBy(F.col("l_suppkey").alias("s_suppkey")).agg(F.count("*").alias("n"))
    return table(spark, sf, "supplier").select("s_suppkey", "s_acctbal").join(n, "s_suppkey")


_LETTERS = "with seq as (select doc_id, regexp_replace(upper(text), '[^ACGT]', '', 'g') as s from documents)\n"


def sequences(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as sequences: their letters A, C, G and T."""
    return table(spark, sf, "documents").select("doc_id", C.letters_of(F.col("text")).alias("s"))


@query(_LETTERS + "select doc_id, length(s) as n, reverse(translate(s, 'ACGT', 'TGCA')) as rc from seq")
def revcomp(spark: SparkSession, sf: str) -> DataFrame:
    return sequences(spark, sf).select("doc_id", F.length("s").cast("long").alias("n"), C.reverse_complement(F.col("s")).alias("rc"))


@query(_LETTERS + "select doc_id, regexp_replace(regexp_replace(regexp_replace(regexp_replace(s, 'A+', 'A', 'g'), 'C+', 'C', 'g'), 'G+', 'G', 'g'), 'T+', 'T', 'g') as compressed from seq")
def homopolymer_compress(spark: SparkSession, sf: str) -> DataFrame:
    return sequences(spark, sf).select("doc_id", C.compress_runs(F.col("s")).alias("compressed"))


def by_sequence(rows: DataFrame, found: Callable[[str], Iterable[tuple[np.ndarray, ...]]], shape: str, most: int = 100_000) -> DataFrame:
    """(doc_id, then ``shape``): what ``found`` gives, in arrays, for each sequence (doc_id, s), where it is read. Null counts as empty."""
    names = ["doc_id", *(x.split()[0] for x in shape.split(", "))]

    def told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, waiting = [], 0

        def taken() -> pa.RecordBatch:
            keys = pa.concat_arrays([pa.repeat(key, len(x[0])) for key, x in held])
            return pa.record_batch([keys, *(pa.array(np.concatenate(x)) for x in zip(*(x for _, x in held)))], names)

        for b in batches:
            for key, s in zip(b.column("doc_id"), b.column("s").to_pylist()):
                for x in found(s or ""):
                    held.append((key, x))
                    waiting += len(x[0])
                    if waiting >= most:
                        yield taken()
                        held, waiting = [], 0
        if held:
            yield taken()

    return rows.select("doc_id", "s").mapInArrow(told, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, {shape}")


def by_block(rows: DataFrame, found: Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, ...]], shape: str, most: int = 1 << 16) -> DataFrame:
    """As ``by_sequence``, for many short sequences (doc_id, s): ``found`` gets those of about ``most`` letters at once.

    It is given their letters one after another and where each begins, and their end; it gives each result's sequence, counted from 0,
    and then its arrays. A sequence is never cut.
    """
    names = ["doc_id", *(x.split()[0] for x in shape.split(", "))]

    def told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [(s or "").encode() for s in b.column("s").to_pylist()]
            ends, a = np.concatenate([[0], np.cumsum([len(s) for s in texts], dtype=np.int64)]), 0
            while a < len(texts):
                z = max(a + 1, int(np.searchsorted(ends, ends[a] + most, side="right")) - 1)
                which, *out = found(np.frombuffer(b"".join(texts[a:z]), dtype=np.uint8), ends[a : z + 1] - ends[a])
                if len(which):
                    yield pa.record_batch([b.column("doc_id").take(pa.array(a + which)), *map(pa.array, out)], names)
                a = z

    return rows.select("doc_id", "s").mapInArrow(told, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, {shape}")


def kmers(df: DataFrame, k: int) -> DataFrame:
    """Every run of k letters with its place, from 0. A long sequence is cut into pieces first, as a place is found by counting letters."""
    pieces = F.explode(F.sequence(F.lit(0), F.expr(f"(length(s) - {k}) div 256"))).alias("c")
    cut = df.where(F.length("s") >= k).select("doc_id", "s", pieces).select("doc_id", (F.col("c") * 256).cast("long").alias("at"), F.expr(f"substring(s, c * 256 + 1, 255 + {k})").alias("piece"))
    each = cut.select("doc_id", "at", "piece", F.explode(F.sequence(F.lit(1), F.length("piece") - k + 1)).alias("p"))
    return each.select("doc_id", (F.col("at") + F.col("p") - 1).alias("place"), F.expr(f"substring(piece, p, {k})").alias("kmer"))


@query("""with seq as (select doc_id, regexp_replace(upper(text), '[^ACGT]', '', 'g') as s from documents), bench as (select item_id, regexp_replace(upper(text), '[^ACGT]', '', 'g') as s from benchmark),
 k as (select doc_id, substring(s, p, 16) as kmer from (select doc_id, s, unnest(range(1, length(s) - 14)) as p from seq)), q as (select item_id, substring(s, p, 16) as kmer from (select item_id, s, unnest(range(1, length(s) - 14)) as p from bench))
 select item_id, doc_id, count(*) as seeds from q join k using (kmer) group by all having count(*) >= 3""")
def kmer_join(spark: SparkSession, sf: str) -> DataFrame:
    """Seeds that benchmark items share with documents, as sequences."""
    k = kmers(sequences(spark, sf), 16).select("doc_id", "kmer")
    q = kmers(table(spark, sf, "benchmark").select(F.col("item_id").alias("doc_id"), C.letters_of(F.col("text")).alias("s")), 16)
    q = q.groupBy(F.col("doc_id").alias("item_id"), "kmer").agg(F.count("*").alias("times"))  # repeats don't multiply rows
    return k.join(q, "kmer").groupBy("item_id", "doc_id").agg(F.sum("times").alias("seeds")).where("seeds >= 3")


@query(_LETTERS + """, k as (select doc_id, p - 1 as place, substring(s, p, 12) as kmer from (select doc_id, s, unnest(range(1, length(s) - 10)) as p from seq))
 select a.doc_id, a.place as fwd, b.place as rev from k a join k b on a.doc_id = b.doc_id and b.kmer = reverse(translate(a.kmer, 'ACGT', 'TGCA')) and b.place >= a.place + 12""")
def palindrome_kmers(spark: SparkSession, sf: str) -> DataFrame:
    """Places whose reverse complement follows in the same sequence."""
    ship_package(spark)
    return turned_pairs(sequences(spark, sf).where("doc_id is not null"), 12)


def turned_pairs(rows: DataFrame, k: int) -> DataFrame:
    """(doc_id, fwd, rev) of all runs of ``k`` letters of a sequence (doc_id, s) and their reverse complements at ``k`` letters or more.

    A sequence in one row meets itself where it is read; only sequences whose id has several rows are joined.
    """
    alone = lambda r: by_sequence(r, lambda s: K.turned_places(s, k), "fwd long, rev long")
    several = rows.groupBy("doc_id").agg(F.count("*").alias("times")).where("times > 1").select("doc_id")  # reads ids only
    if several.isEmpty():
        return alone(rows)
    each = kmers(rows.join(several, "doc_id", "left_semi"), k)
    turned = each.select("doc_id", F.col("place").alias("fwd"), C.reverse_complement(F.col("kmer")).alias("kmer"))
    joined = turned.join(each, ["doc_id", "kmer"]).where(f"place >= fwd + {k}").select("doc_id", "fwd", F.col("place").alias("rev"))
    return alone(rows.join(several, "doc_id", "left_anti")).unionByName(joined)


@query("select event_id, cast(1 + (event_id >= 128)::int + (event_id >= 16384)::int + (event_id >= 2097152)::int as integer) as bytes from events")
def varint_size(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select("event_id", C.varint_bytes(F.col("event_id")).alias("bytes"))


@query("select event_id, cast(round(value * 16) as bigint) as code, round(value * 16) / 16.0 as restored from events")
def fixedpoint_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    code = F.round(F.col("value") * 16)
    return table(spark, sf, "events").select("event_id", code.cast("long").alias("code"), (code / 16.0).alias("restored"))


@query("""with c as (select event_id, cast(floor(value) as bigint) as v from events), l as (select event_id, v, case when v < 16 then 0 else cast(floor(log2(v + 0.5)) as bigint) - 3 end as level from c)
 select event_id, level, (v >> level) << level as restored from l""")
def lossy_codec(spark: SparkSession, sf: str) -> DataFrame:
    """Whole numbers kept to four leading bits: a level and what is left of the value."""
    v = F.floor("value")
    level = F.when(v < 16, F.lit(0).cast("long")).otherwise(F.floor(F.log2(v + 0.5)) - 3)
    return table(spark, sf, "events").select("event_id", v.alias("v"), level.alias("level")).selectExpr("event_id", "level", "shiftleft(shiftright(v, cast(level as int)), cast(level as int)) as restored")


@query("select event_id, round(3 * value * value - 2 * value + 0.5, 4) as y from events")
def polynomial(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select("event_id", F.round(C.horner(F.col("value"), [3.0, -2.0, 0.5]), 4).alias("y"))


@query("select event_id, round(pow(0.5, value / 100), 9) as confidence, round(greatest(0.0, least(1.0, (value - 20) / 80)), 9) as saturated, round(4 + 1.5 * value + 0.01 * value * value, 6) as variance from events")
def model_laws(spark: SparkSession, sf: str) -> DataFrame:
    """Decay of a model's confidence, its saturation, and the variance law of a level."""
    v = F.col("value")
    return table(spark, sf, "events").select("event_id", F.round(F.pow(F.lit(0.5), v / 100), 9).alias("confidence"), F.round(C.saturating_linear(v, 20.0, 100.0), 9).alias("saturated"), F.round(4 + 1.5 * v + 0.01 * v * v, 6).alias("variance"))


@query(PULSE + """, a as (select zmw, avg(height) as x from pulse group by zmw), b as (select zmw, avg(height) as y from pulse where label <> 'N' group by zmw)
 select zmw, abs(x - y) <= 0.001 or abs(x - y) <= 0.05 * abs(x) as equal from a join b using (zmw)""")
def compare_sets(spark: SparkSession, sf: str) -> DataFrame:
    """Two sets of metrics beside each other, within tolerances."""
    p = pulses(spark, sf)
    a, b = p.groupBy("zmw").agg(F.avg("height").alias("x")), p.where("label != 'N'").groupBy("zmw").agg(F.avg("height").alias("y"))
    d = F.abs(F.col("x") - F.col("y"))
    return a.join(b, "zmw").select("zmw", ((d <= 0.001) | (d <= 0.05 * F.abs("x"))).alias("equal"))


@query("select count(*) filter (where o.o_orderkey is not null) as matched, count(*) filter (where o.o_orderkey is null) as unmatched from (select distinct l_orderkey from lineitem) l left join orders o on l_orderkey = o_orderkey and o_orderstatus = 'F'")
def verify_ids(spark: SparkSession, sf: str) -> DataFrame:
    l = table(spark, sf, "lineitem").select("l_orderkey").distinct()
    o = table(spark, sf, "orders").where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("l_orderkey"), F.lit(1).alias("hit"))
    return l.join(o, "l_orderkey", "left").agg(F.count_if(F.col("hit").isNotNull()).alias("matched"), F.count_if(F.col("hit").isNull()).alias("unmatched"))


@query(PULSE + "select zmw, list_sort(list(distinct label)) as labels, count(distinct label) as kinds from pulse group by zmw")
def distinct_labels(spark: SparkSession, sf: str) -> DataFrame:
    return pulses(spark, sf).groupBy("zmw").agg(F.array_sort(F.collect_set("label")).alias("labels"), F.countDistinct("label").alias("kinds"))


@query("""with b as (select user_id as zmw, (row_number() over (partition by user_id order by ts, event_id) - 1) // 8 as mb from events), m as (select mb, count(distinct zmw) as n, count(distinct zmw) filter (where full_block) as whole
 from (select zmw, mb, count(*) = 8 as full_block from b group by zmw, mb) group by mb) select mb, n from m where n = whole""")
def chip_barrier(spark: SparkSession, sf: str) -> DataFrame:
    """Blocks that every key which reports has filled."""
    b = blocks(spark, sf).groupBy("mb").agg(F.countDistinct("zmw").alias("n"), F.countDistinct(F.when(F.col("pulses") == 8, F.col("zmw"))).alias("whole"))
    return b.where("n = whole").select("mb", "n")


@query("select o_orderkey, case when o_totalprice >= 100000 then 'pass' else 'short' end as verdict, cast(o_totalprice as integer) as whole from orders")
def length_filter(spark: SparkSession, sf: str) -> DataFrame:
    """Rows by a threshold, and the value rounded as DuckDB casts it (half to even)."""
    return table(spark, sf, "orders").select("o_orderkey", F.when(F.col("o_totalprice") >= 100000, "pass").otherwise("short").alias("verdict"), F.rint("o_totalprice").cast("int").alias("whole"))
