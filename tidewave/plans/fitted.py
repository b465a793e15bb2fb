"""Plans whose kernels are dynamic programming or iterative fits: Spark groups by key, NumPy works on one key's rows.

A key's rows are a read or a trace, whose length a run's duration bounds; keys spread over tasks.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewave.functions import columns as C
from tidewave.operators import kernels as K
from tidewave.plans.relations import kmers, sequences
from tidewave.plans.signals import blocks
from tidewave.session import ship_package, table
from tidewave.sources.readers import pulses, traces

QUERIES = {}


def query(f):
    QUERIES[f.__name__] = f
    return f


def _arrays(df: DataFrame, value: str) -> DataFrame:
    """A key's values as one array, in the order of their frames."""
    held = F.array_sort(F.collect_list(F.struct("frame", value)))
    return df.groupBy("zmw").agg(F.transform(held, lambda s: s[value]).alias("held"))


@query
def ema_baseline(spark: SparkSession, sf: str) -> DataFrame:
    """Each trace's running baseline at its end, and the mean of what lies above it."""
    ship_package(spark)

    def own(parts):
        for d in parts:
            fits = [K.ema(x, 0.1, 0.05)[0] for x in d["held"]]
            yield pd.DataFrame({"zmw": d["zmw"], "baseline": [float(f[-1]) for f in fits], "above": [float((x - f).mean()) for x, f in zip(d["held"], fits)]})

    return _arrays(traces(spark, sf), "signal").mapInPandas(own, "zmw long, baseline double, above double")


@query
def em_mixture(spark: SparkSession, sf: str) -> DataFrame:
    """A mixture with one shared scale, fitted to each key's heights."""
    ship_package(spark)
    means, variances = np.array([10.0, 40.0, 90.0, 180.0]), np.array([40.0, 200.0, 600.0, 2000.0])

    def own(parts):
        for d in parts:
            fits = [K.mixture(np.asarray(x, dtype=float), means, variances) for x in d["held"]]
            yield pd.DataFrame({"zmw": d["zmw"], "scale": [f[0] for f in fits], "background": [float(f[1][0]) for f in fits], "like": [f[3] for f in fits]})

    return _arrays(pulses(spark, sf), "height").mapInPandas(own, "zmw long, scale double, background double, like double")


@query
def viterbi_frames(spark: SparkSession, sf: str) -> DataFrame:
    """The state of every frame by a hidden Markov model over Gaussian levels."""
    ship_package(spark)
    means, variances = np.array([-0.12, 0.0, 0.12]), np.array([0.006, 0.004, 0.006])
    step = np.log(np.full((3, 3), 0.05) + np.eye(3) * 0.85)

    def own(parts):
        for d in parts:
            paths = [K.viterbi(K.gaussian_scores(np.asarray(x, dtype=float), means, variances), step, np.log(np.full(3, 1 / 3))) for x in d["held"]]
            yield pd.DataFrame({"zmw": np.repeat(d["zmw"].to_numpy(), [len(p) for p in paths]), "frame": np.concatenate([np.arange(len(p)) for p in paths]), "state": np.concatenate(paths)})

    return _arrays(traces(spark, sf), "signal").mapInPandas(own, "zmw long, frame long, state long")


@query
def burst_hmm(spark: SparkSession, sf: str) -> DataFrame:
    """Pulses in bursts of short gaps, by a two-state model over clipped gaps; short bursts count as none."""
    ship_package(spark)
    step, hit = np.log(np.array([[0.97, 0.03], [0.1, 0.9]])), np.log(np.array([0.02] * 2 + [0.12] * 8 + [0.3] * 2 + [0.05] * 8).reshape(2, 10))

    def own(parts):
        for d in parts:
            out = []
            for zmw, x in zip(d["zmw"], d["held"]):
                gaps = np.clip(np.diff(np.asarray(x, dtype=np.int64), prepend=x[0]) // 14400, 0, 9)
                path = K.viterbi(hit[:, gaps].T, step, np.log(np.array([0.9, 0.1])))
                cuts = np.flatnonzero(np.diff(path, prepend=-1))
                for a, b in zip(cuts, np.append(cuts[1:], len(path))):
                    if path[a] == 1 and b - a >= 5:
                        out.append((zmw, int(a) + 1, int(b) + 1))
            yield pd.DataFrame(out, columns=["zmw", "begin_frame", "end_frame"])

    return _arrays(pulses(spark, sf), "start").mapInPandas(own, "zmw long, begin_frame long, end_frame long")


@query
def hq_hmm(spark: SparkSession, sf: str) -> DataFrame:
    """The last high-quality stretch of each key's blocks."""
    ship_package(spark)
    activity = F.when(F.col("activity") == "LOW", 0).when(F.col("activity") == "SINGLE", 1).otherwise(2)

    def own(parts):
        for d in parts:
            spans = [K.quality_region(np.asarray(x, dtype=np.int64), 0.9) for x in d["held"]]
            yield pd.DataFrame({"zmw": d["zmw"], "begin_mb": [s[0] for s in spans], "end_mb": [s[1] for s in spans]})

    return _arrays(blocks(spark, sf).select("zmw", F.col("mb").alias("frame"), activity.alias("code")), "code").mapInPandas(own, "zmw long, begin_mb long, end_mb long")


ADAPTER = b"ATCTCTCTCTTTTCCTCC"


@query
def adapter_labels(spark: SparkSession, sf: str) -> DataFrame:
    """Adapters in sequences with their alignments and flanks, and which of them count.

    A hit counts that is accurate, or fairly so between flanks that mirror each other. Accuracy is 1 less the share of
    errors in the letters that the alignment spans.
    """
    ship_package(spark)
    adapter = np.frombuffer(ADAPTER, dtype=np.uint8)

    def own(parts):
        for d in parts:
            out = []
            for doc, s in zip(d["doc_id"], d["s"]):
                letters = np.frombuffer(s.encode(), dtype=np.uint8)
                row = K.semi_global(adapter, letters)
                at = np.flatnonzero(row >= 8)
                for k in K.spaced(row[at], at, 30):
                    begin, equal, *errors = K.trace_back(adapter, letters, int(at[k]), float(row[at[k]]))
                    accuracy = 1 - sum(errors) / (at[k] - begin)
                    flank = K.flank_score(letters, begin, int(at[k]), 30)
                    out.append((doc, begin, int(at[k]), equal, *errors, float(accuracy), flank, bool(accuracy >= 0.85 or (accuracy >= 0.7 and flank >= 20))))
            yield pd.DataFrame(out, columns=["doc_id", "begin", "end", "matches", "mismatches", "insertions", "deletions", "accuracy", "flank", "kept"])

    return sequences(spark, sf).where("s != ''").mapInPandas(
        own, "doc_id long, begin long, end long, matches long, mismatches long, insertions long, deletions long, accuracy double, flank double, kept boolean"
    )


@query
def adapter_align(spark: SparkSession, sf: str) -> DataFrame:
    """Adapters in sequences: ends of good semi-global alignments, chosen apart from each other for the best total."""
    ship_package(spark)
    adapter = np.frombuffer(ADAPTER, dtype=np.uint8)

    def own(parts):
        for d in parts:
            out = []
            for doc, s in zip(d["doc_id"], d["s"]):
                row = K.semi_global(adapter, np.frombuffer(s.encode(), dtype=np.uint8))
                at = np.flatnonzero(row >= 8)
                out += [(doc, int(at[k]), float(row[at[k]])) for k in K.spaced(row[at], at, 30)]
            yield pd.DataFrame(out, columns=["doc_id", "end", "score"])

    return sequences(spark, sf).mapInPandas(own, "doc_id long, end long, score double")


@query
def control_hits(spark: SparkSession, sf: str) -> DataFrame:
    """Benchmark items whose seeds form a chain in a document, as sequences."""
    ship_package(spark)
    k = kmers(sequences(spark, sf), 16)
    q = kmers(table(spark, sf, "benchmark").select(F.col("item_id").alias("doc_id"), C.letters_of(F.col("text")).alias("s")), 16)
    pairs = k.join(q.select(F.col("doc_id").alias("item_id"), "kmer", F.col("place").alias("at")), "kmer")
    held = pairs.groupBy("doc_id", "item_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("place", "at"))), lambda s: s["at"]).alias("held"))

    def own(parts):
        for d in parts:
            chains = [K.longest_increasing(np.asarray(x)) for x in d["held"]]
            yield pd.DataFrame({"doc_id": d["doc_id"], "item_id": d["item_id"], "chain": chains})

    return held.mapInPandas(own, "doc_id long, item_id long, chain long").where("chain >= 8")
