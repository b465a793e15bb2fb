"""Activity of blocks by a linear chain over binned features, fitted from counts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewave.operators import tree as T
from tidewave.plans.activity import CLASSES, FEATURES, labelled_blocks
from tidewave.plans.metrics import machine_regions
from tidewave.plans.signals import PULSE
from tidewave.session import ship_package, written

QUERIES, SQL = {}, {}

#: Bins of a feature, and the weight of a feature's log chance: features tell partly the same.
BINS, WEIGHT = 8, 0.5


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def binned(feature: str, cuts: list[float]) -> Column:
    """How many cuts lie below the feature; a missing one counts as 0, as in trees."""
    x = F.when(F.isnan(feature), 0.0).otherwise(F.coalesce(feature, F.lit(0.0)))
    return sum(((x > c).cast("int") for c in cuts), F.lit(0))


def steps(rows: DataFrame) -> DataFrame:
    """How often each activity follows each in the blocks of a key; ``source`` is -1 before the first."""
    before = F.lag("activity").over(Window.partitionBy("zmw").orderBy("mb"))
    return rows.select(F.coalesce(before, F.lit(-1)).cast("int").alias("source"), F.col("activity").cast("int").alias("target")).groupBy("source", "target").agg(F.count("*").alias("n"))


def fitted(rows: DataFrame) -> tuple[list[list[float]], np.ndarray, np.ndarray, np.ndarray]:
    """Cuts, log chances of bins (features, classes, bins), of starts and of steps; every count has one added.

    ``rows`` (zmw, mb, activity, features) is read where it lies: only tables of counts, whose sizes the numbers of features, classes and bins
    fix, come to the driver.
    """
    k, cuts = len(CLASSES), T.candidates(rows, FEATURES, BINS)
    own = rows.select("activity", F.explode(F.array(*[F.struct(F.lit(i).alias("feature"), binned(f, c).alias("bin")) for i, (f, c) in enumerate(zip(FEATURES, cuts))])).alias("b"))
    told, moved = np.ones((len(FEATURES), k, BINS + 1)), np.ones((k + 1, k))
    for r in own.groupBy("activity", "b.feature", "b.bin").count().collect():
        told[r["feature"], r["activity"], r["bin"]] += r["count"]
    for i, c in enumerate(cuts):
        told[i, :, len(c) + 1 :] = 0  # bins that the feature lacks
    for r in steps(rows).collect():
        moved[r["source"], r["target"]] += r["n"]
    with np.errstate(divide="ignore"):
        return cuts, np.log(told / told.sum(axis=2, keepdims=True)), np.log(moved[-1] / moved[-1].sum()), np.log(moved[:-1] / moved[:-1].sum(axis=1, keepdims=True))


def class_scores(cuts: list[list[float]], told: np.ndarray) -> list[Column]:
    return [WEIGHT * sum((F.get(F.array(*[F.lit(float(v)) for v in told[i, k, : len(c) + 1]]), binned(f, c)) for i, (f, c) in enumerate(zip(FEATURES, cuts))), F.lit(0.0)) for k in range(len(CLASSES))]


def forward(start: np.ndarray, scores: np.ndarray, sizes: np.ndarray, step: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Best log chances at the ends (sequences, classes) of padded sequences (sequences, time, classes), and the ways back (time, sequences, classes).

    ``start`` holds for each sequence what its classes had before their first score.
    """
    like, back = start, np.zeros((scores.shape[1], *start.shape), dtype=np.int8)
    for t in range(scores.shape[1]):
        every = like[:, :, None] + step
        back[t] = every.argmax(axis=1)
        now = every.max(axis=1) + scores[:, t]
        like = np.where((t < sizes)[:, None], now, like)
    return like, back


def traced(back: np.ndarray, state: int) -> list[int]:
    """The states of a path that ends in ``state``; ``back`` (time, classes) leads from each to the one before."""
    path = []
    for ways in back[::-1]:
        path.append(int(state))
        state = ways[state]
    return path[::-1]


def settled(back: np.ndarray) -> int:
    """How many of the first states are the same on all paths, whatever follows."""
    states = set(range(back.shape[1]))
    for t in range(len(back) - 1, -1, -1):
        if len(states) == 1:
            return t + 1
        states = {int(back[t, s]) for s in states}
    return 0


def decoded(rows: DataFrame, scores: list[Column], start: np.ndarray, step: np.ndarray, *carry: str) -> DataFrame:
    """The likeliest classes of all blocks of each key: (zmw, mb, the columns ``carry``, found).

    One exchange by key; a task reads its keys one after the other, those that end in a batch at once, padded to the longest of their lengths. Of a
    key that goes on, what all paths agree on leaves at once, so that a long key isn't held. Keys or blocks that are null are one
    key, and come first. Of blocks that share a number, any may be first.
    """
    k, names = len(CLASSES), ["zmw", "mb", *carry]
    # A row that begins at the start: its only way is from class 0, and the score of the first block has the start's chance in it.
    first_step = start - step[0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left, like, back = None, None, None

        def out(t: pa.Table, found: list[int]) -> list[pa.RecordBatch]:
            return t.select(names).append_column("found", pa.array(found, pa.int32())).combine_chunks().to_batches() if found else []

        fresh = np.full(k, -np.inf)
        fresh[0] = 0.0
        for b in batches:
            t = pa.Table.from_batches([b])
            keys, values = b.column("zmw").to_pylist(), np.stack([b.column(f"_{i}").to_numpy() for i in range(k)], axis=1)
            cuts = [0, *[i for i in range(1, len(keys)) if keys[i] != keys[i - 1]], len(keys)]
            if not keys:
                continue
            if left is not None and left[0] != keys[0]:
                yield from out(left[1], traced(back, like.argmax()))
                left = None
            sizes = np.diff(cuts)
            padded, begin = np.zeros((len(sizes), sizes.max(), k)), np.tile(fresh, (len(sizes), 1))
            for i, (a, z) in enumerate(zip(cuts, cuts[1:])):
                padded[i, : z - a] = values[a:z]
                if i or left is None:
                    padded[i, 0] += first_step
            if left is not None:
                begin[0] = like
            likes, backs = forward(begin, padded, sizes, step)
            for i, (a, z) in enumerate(zip(cuts, cuts[1:])):
                own, ways = t.slice(a, z - a), backs[: z - a, i]
                if i == 0 and left is not None:
                    own, ways = pa.concat_tables([left[1], own]), np.concatenate([back, ways])
                if i < len(sizes) - 1:
                    yield from out(own, traced(ways, likes[i].argmax()))
                else:
                    n = settled(ways)
                    path = traced(ways, likes[i].argmax())
                    yield from out(own.slice(0, n), path[:n])
                    left, like, back = (keys[a], own.slice(n)), likes[i] - likes[i].max(), ways[n:]
        if left is not None:
            yield from out(left[1], traced(back, like.argmax()))

    told = rows.select(*names, *[s.alias(f"_{i}") for i, s in enumerate(scores)]).repartition("zmw").sortWithinPartitions("zmw", "mb")
    shape = rows.select(*names).withColumn("found", F.lit(0)).schema
    return told.mapInArrow(run, shape)


def labelled(spark: SparkSession, sf: str) -> DataFrame:
    """All blocks with the chain's class (``found``), learnt from three quarters of the keys, and the one counted from their bases."""
    ship_package(spark)
    rows = written(labelled_blocks(spark, sf), "blocks")
    cuts, told, start, step = fitted(rows.where("pmod(xxhash64(zmw), 4) != 0"))
    return decoded(rows, class_scores(cuts, told), start, step, "activity")


@query()
def activity_chain(spark: SparkSession, sf: str) -> DataFrame:
    name = F.array(*map(F.lit, CLASSES))
    return labelled(spark, sf).select("zmw", "mb", F.get(name, "found").alias("activity"), F.get(name, "activity").alias("counted"), (F.pmod(F.xxhash64("zmw"), F.lit(4)) == 0).alias("held_out"))


@query()
def chain_regions(spark: SparkSession, sf: str) -> DataFrame:
    """High-quality regions by the machine over blocks, from the chain's activities."""
    return machine_regions(labelled(spark, sf).select("zmw", "mb", F.get(F.array(*map(F.lit, CLASSES)), "found").alias("activity")))


@query(PULSE + """, told as (select zmw, mb, case when sum(height) filter (where label <> 'N') >= 400 then 2 when sum(height) filter (where label <> 'N') >= 200 then 1 else 0 end as activity from pulse group by all)
 select source, target, count(*) as n from (select coalesce(lag(activity) over (partition by zmw order by mb), -1) as source, activity as target from told) group by all""")
def chain_steps(spark: SparkSession, sf: str) -> DataFrame:
    """How often each activity follows each."""
    return steps(labelled_blocks(spark, sf))
