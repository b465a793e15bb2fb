"""Frame labels of traces that come in blocks, and the kinetics that they rest on."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewave.operators import subframe as S
from tidewave.plans.signals import PULSE, ordered
from tidewave.session import ship_package, table
from tidewave.sources.readers import pulses

QUERIES, SQL = {}, {}

#: Frames of a block, and of a pulse of the event table.
FRAMES, PULSE_FRAMES = 24, 4
#: Blocks that go through the labeller at once.
AT_ONCE = 512
#: The kinds from the brightest to the dimmest.
KINDS = ["A", "C", "G", "T"]
RATIOS = {"width_ratio": 0.3, "gap_ratio": 0.1}
#: Strengths, in units of the background's noise, that a stretch of interest keeps and somewhere reaches.
LOW, HIGH = 1.0, 3.0
#: A trace's levels above its mean, in its standard deviations, and the background's share of the variance.
LEVELS, SHARE = [2.6, 2.0, 1.5, 1.0], 0.4
OUT = "zmw long, frame long, state int"


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def kinetics(p: DataFrame) -> DataFrame:
    """Mean width of each kind's stretches and of what lies between two of its stretches, in frames. Kinds that a table lacks have none."""
    s = p.withColumn("segment", F.sum(F.when(F.col("label") == F.lag("label").over(ordered()), 0).otherwise(1)).over(ordered()))
    runs = s.groupBy("zmw", "segment", "label").agg(F.min("frame").alias("frame"), F.count("*").alias("width"))
    by = ordered().partitionBy("zmw", "label")
    gap = F.lead("frame").over(by) - F.col("frame") - F.col("width")
    return runs.where(F.col("label").isin(KINDS)).select("label", "width", gap.alias("gap")).groupBy("label").agg(
        F.round(F.avg("width") * PULSE_FRAMES, 6).alias("width"), F.round(F.avg("gap") * PULSE_FRAMES, 6).alias("gap"))


_KINETICS = PULSE + f""", m as (select *, case when label = lag(label) over w then 0 else 1 end as fresh from pulse window w as (partition by zmw order by frame)),
 r as (select *, sum(fresh) over (partition by zmw order by frame) as segment from m),
 runs as (select zmw, label, min(frame) as frame, count(*) as width from r group by zmw, segment, label),
 k as (select label, round(avg(width) * {PULSE_FRAMES}, 6) as width, round(avg(gap) * {PULSE_FRAMES}, 6) as gap
  from (select label, width, lead(frame) over (partition by zmw, label order by frame) - frame - width as gap from runs where label in ('A', 'C', 'G', 'T')) group by label)"""


@query(_KINETICS + " select * from k")
def pulse_kinetics(spark: SparkSession, sf: str) -> DataFrame:
    return kinetics(pulses(spark, sf))


def step_matrix(found: DataFrame) -> np.ndarray:
    """The log transitions by measured kinetics (four rows at most). A kind that wasn't seen, or never twice, counts as others do on average."""
    rows = {r["label"]: r for r in found.collect()}
    mean = lambda c: float(np.mean([r[c] for r in rows.values() if r[c]] or [4 * PULSE_FRAMES]))
    held = lambda k, c: (rows[k][c] if k in rows else None) or mean(c)
    return S.transitions([S.Kinetics(held(k, "width"), held(k, "gap"), **RATIOS) for k in KINDS])


def _steps_sql() -> str:
    """The 169 chances, each from the lengths' chances of its kind."""
    beyond = lambda m, mean, r: (
        f"((({1 + 1 / r!r} / {mean}) * (exp(-({1 + r!r} / {mean}) * {m - 1}) - exp(-({1 + r!r} / {mean}) * {m})) / ({1 + r!r} / {mean})"
        f" - ({1 + r!r} / {mean}) * (exp(-({1 + 1 / r!r} / {mean}) * {m - 1}) - exp(-({1 + 1 / r!r} / {mean}) * {m})) / ({1 + 1 / r!r} / {mean})) / ({1 + 1 / r!r} / {mean} - {1 + r!r} / {mean}))")
    w, g = RATIOS["width_ratio"], RATIOS["gap_ratio"]
    return _KINETICS + f""", c as (select position(label in 'ACGT') as i, 0.25 * (1 - {beyond(2, 'gap', g)}) as short, {beyond(1, 'width', w)} as w1, {beyond(2, 'width', w)} as w2, {beyond(3, 'width', w)} as w3 from k),
 t as (select sum(short) as s, (select 1 - {beyond(3, 'mean', 1e-6)} / {beyond(2, 'mean', 1e-6)} from (select avg(gap) as mean from k)) as start from c),
 q as (select *, (1 - w1) / (1 + s) as one, w1 - w2 as two from c, t),
 p as (select 0 as source, 0 as target, 1 - start as p from t
  union all select 0, i + 4, start / 4 from q union all select i + 4, 0, one from q union all select i + 4, i + 8, two from q union all select i + 4, i, 1 - one * (1 + s) - two from q
  union all select i, i + 8, 1 - w3 / w2 from q union all select i, i, w3 / w2 from q union all select i + 8, 0, 1 - s from q
  union all select q.i + 8, c.i + 4, c.short from q, c union all select q.i + 4, c.i + 4, q.one * c.short from q, c)
 select source, target, round(p, 9) as p from p"""


@query(_steps_sql())
def subframe_steps(spark: SparkSession, sf: str) -> DataFrame:
    """The possible steps between the thirteen states and their chances, by the kinetics of the event table."""
    p = np.exp(step_matrix(kinetics(pulses(spark, sf))))
    return spark.createDataFrame([(i, j, float(p[i, j])) for i in range(S.STATES) for j in range(S.STATES) if p[i, j] > 0], "source int, target int, p double").withColumn("p", F.round("p", 9))


def trace_stream(spark: SparkSession, sf: str) -> DataFrame:
    return spark.readStream.schema(table(spark, sf, "embeddings").schema).option("pathGlobFilter", "embeddings.parquet").parquet(sf)


def with_models(vectors: DataFrame) -> DataFrame:
    """Vectors (vec_id, embedding) as traces with their models: background's mean and variance, levels and spreads of the kinds.

    A trace without spread, or without an id, has no model and is left out; samples that are null or not a number don't count.
    """
    e = vectors.where("vec_id is not null").select(F.col("vec_id").alias("zmw"), F.transform("embedding", lambda x: x.cast("double")).alias("x"))

    def more(a, x):
        """Count, mean and sum of squares with one more sample."""
        n, mean = a["n"] + 1, a["mean"] + (x - a["mean"]) / (a["n"] + 1)
        return F.when(x.isNull() | F.isnan(x), a).otherwise(F.struct(n.alias("n"), mean.alias("mean"), (a["rest"] + (x - a["mean"]) * (x - mean)).alias("rest")))

    none = F.struct(F.lit(0.0).alias("n"), F.lit(0.0).alias("mean"), F.lit(0.0).alias("rest"))
    m = e.withColumn("m", F.aggregate("x", none, more)).select("zmw", "x", F.col("m.mean").alias("mean"), (F.col("m.rest") / F.col("m.n")).alias("square"))
    m = m.where("square > 0").withColumn("variance", F.col("square") * SHARE)
    return m.select(
        "zmw", "x", "mean", "variance", F.array(*[F.col("mean") + k * F.sqrt("square") for k in LEVELS]).alias("levels"),
        F.array(*[F.col("variance") * (1 + 0.2 * k) for k in LEVELS]).alias("spreads"))


def in_blocks(traces: DataFrame, frames: int = FRAMES) -> DataFrame:
    """Rows of traces (zmw, x and what else there is) cut into blocks (block, last, x); every row stays small, however long a trace is."""
    blocks = F.sequence(F.lit(0), F.greatest(F.lit(0), F.ceil(F.size("x") / F.lit(frames)).cast("int") - 1))
    cut = traces.withColumn("block", F.explode(blocks)).withColumn("last", (F.col("block") + 1) * frames >= F.size("x"))
    return cut.withColumn("x", F.slice("x", F.col("block") * frames + 1, frames))


def labelled(rows: list[dict], carries: list[S.Carry], step: np.ndarray) -> tuple[list[np.ndarray], list[S.Carry]]:
    """One block of each of several keys: those of like lengths go through the labeller at once."""
    alike: dict = {}
    for i, (r, c) in enumerate(zip(rows, carries)):
        alike.setdefault((len(r["x"]), len(c.held), bool(r["last"])), []).append(i)
    paths, rest = [None] * len(rows), [None] * len(rows)
    for (n, _, last), at in alike.items():
        own = lambda c: np.array([rows[i][c] for i in at], dtype=float)
        x = own("x").reshape(len(at), n)
        found, on = S.label([carries[i] for i in at], x, tuple(own(c) for c in ("mean", "variance", "levels", "spreads")), step, LOW, HIGH, last)
        for i, p, c in zip(at, found, on):
            paths[i], rest[i] = p, c
    return paths, rest


def as_batch(keys: list[int], firsts: list[int], paths: list[np.ndarray]) -> pa.RecordBatch:
    sizes = [len(p) for p in paths]
    frames = np.concatenate([np.arange(a, a + n) for a, n in zip(firsts, sizes)]) if sizes else np.zeros(0)
    states = np.concatenate(paths) if sizes else np.zeros(0)
    return pa.record_batch([pa.array(np.repeat(keys, sizes).astype(np.int64)), pa.array(frames.astype(np.int64)), pa.array(states.astype(np.int32))], ["zmw", "frame", "state"])


def label_batches(batches: Iterator[pa.RecordBatch], step: np.ndarray) -> Iterator[pa.RecordBatch]:
    """``frame_states`` of a task's batches, whose rows are sorted by key and block."""
    open_: dict[int, tuple[int, S.Carry]] = {}
    following = None
    for b in batches:
        rows = b.to_pylist()
        if not rows:
            continue
        again = rows[0]["zmw"] == following and following not in open_
        if again or len({(r["zmw"], r["block"]) for r in rows}) < len(rows):
            raise ValueError("a key's blocks must be 0, 1, 2 and so on, each once")
        following = rows[-1]["zmw"]  # only a batch's last key can go on in the next
        rows.sort(key=lambda r: r["block"])
        a = 0
        while a < len(rows):
            z = a
            while z < min(len(rows), a + AT_ONCE) and rows[z]["block"] == rows[a]["block"]:
                z += 1
            part = rows[a:z]
            if any(open_.get(r["zmw"], (0,))[0] != r["block"] for r in part):
                raise ValueError("a key's blocks must be 0, 1, 2 and so on, each once")
            old = [open_.pop(r["zmw"], (0, S.Carry()))[1] for r in part]
            paths, rest = labelled(part, old, step)
            open_ |= {r["zmw"]: (r["block"] + 1, c) for r, c in zip(part, rest) if not r["last"]}
            yield as_batch([r["zmw"] for r in part], [c.first for c in old], paths)
            a = z
        open_ = {k: v for k, v in open_.items() if k == following}


def frame_states(blocks: DataFrame, step: np.ndarray) -> DataFrame:
    """(zmw, frame, state) of blocks (zmw, block, last, x, mean, variance, levels, spreads); each key's blocks are 0, 1, 2 and so on.

    One exchange by key; within a task a key's blocks come together and in order, and blocks of one number of a batch's keys go through the
    labeller at once, AT_ONCE at most. A task holds LAG frames of one key, and one batch. Frames that wait take the model of the block that releases them. Null
    samples tell nothing. A key whose last block isn't there keeps its last LAG frames unlabelled; one with a gap or a repeated block is an error.
    """
    return blocks.repartition("zmw").sortWithinPartitions("zmw", "block").mapInArrow(lambda batches: label_batches(batches, step), OUT)


@query()
def subframe_labels(spark: SparkSession, sf: str) -> DataFrame:
    """The state of every frame of every trace."""
    ship_package(spark)
    return frame_states(in_blocks(with_models(table(spark, sf, "embeddings"))), step_matrix(kinetics(pulses(spark, sf))))


@query()
def subframe_pulses(spark: SparkSession, sf: str) -> DataFrame:
    """Pulses of the labelled frames: a new one begins at each first frame and at each return to the background."""
    s = subframe_labels(spark, sf).withColumn("kind", F.when(F.col("state") > 0, F.pmod(F.col("state") - 1, F.lit(4)) + 1).otherwise(0))
    fresh = (F.col("state").between(S.FIRST, S.LAST - 1)) | (F.col("kind") != F.coalesce(F.lag("kind").over(ordered()), F.lit(-1)))
    s = s.withColumn("pulse", F.sum(fresh.cast("int")).over(ordered())).where("kind > 0")
    return s.groupBy("zmw", "pulse").agg(F.min("frame").alias("begin_frame"), (F.max("frame") + 1).alias("end_frame"), F.max("kind").alias("kind"), F.count_if(F.col("state") < S.FIRST).alias("full")).drop("pulse")
