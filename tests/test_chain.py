"""The chain's decoding against enumeration, its fit against loops."""

import itertools
import math

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewave.operators import tree as T
from tidewave.plans import activity, chain

SF = "/root/testdata/sf0.001"


def made():
    rng = np.random.default_rng(6)
    step = np.log(rng.dirichlet(np.ones(3), 3))
    start = np.log(np.array([0.2, 0.5, 0.3]))
    rows = [(key, mb, *map(float, rng.normal(size=3) * 2)) for key in range(40) for mb in range(1 + key % 8)]
    return start, step, rows


@pytest.mark.parametrize("size", [1, 3, 10000])
def test_decoding_equals_enumeration(spark, size):
    """However the rows are cut into batches, every key's path is the best of all."""
    start, step, rows = made()
    df = spark.createDataFrame(rows, "zmw long, mb long, a double, b double, c double")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
    try:
        found = {(r["zmw"], r["mb"]): r["found"] for r in chain.decoded(df, [F.col(c) for c in "abc"], start, step).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert len(found) == len(rows)
    for key in range(40):
        own = [r[2:] for r in rows if r[0] == key]
        worth = lambda p: start[p[0]] + sum(own[i][s] for i, s in enumerate(p)) + sum(step[a, b] for a, b in zip(p, p[1:]))
        best = max(itertools.product(range(3), repeat=len(own)), key=worth)
        assert tuple(found[key, mb] for mb in range(len(own))) == best
    empty = chain.decoded(df.where("zmw > 99"), [F.col(c) for c in "abc"], start, step)
    assert empty.count() == 0 and empty.columns == ["zmw", "mb", "found"]


def test_what_is_settled_stays():
    """States that leave early are those of the whole path, and few wait."""
    rng, (start, step, _) = np.random.default_rng(7), made()
    x = rng.normal(size=(1, 400, 3)) * 2
    like, back = chain.forward(start[None], x, np.array([400]), step)
    whole = chain.traced(back[:, 0], int(like[0].argmax()))
    for n in (1, 50, 200, 399):
        done = chain.settled(back[:n, 0])
        assert n - done < 40
        for end in range(3):
            assert chain.traced(back[:n, 0], end)[:done] == whole[:done]


def test_fit_equals_loops(spark):
    rows = activity.labelled_blocks(spark, SF)
    cuts, told, start, step = chain.fitted(rows)
    held = rows.orderBy("zmw", "mb").collect()
    value = lambda r, f: 0.0 if r[f] is None or math.isnan(r[f]) else r[f]
    for i, f in enumerate(activity.FEATURES):
        for k in range(3):
            own = [sum(value(r, f) > c for c in cuts[i]) for r in held if r["activity"] == k]
            n = np.bincount(own, minlength=len(cuts[i]) + 1) + 1
            assert np.allclose(told[i, k, : len(n)], np.log(n / n.sum()))
    moved, begun = np.ones((3, 3)), np.ones(3)
    for a, b in zip([None, *held], held):
        if a is not None and a["zmw"] == b["zmw"]:
            moved[a["activity"], b["activity"]] += 1
        else:
            begun[b["activity"]] += 1
    assert np.allclose(step, np.log(moved / moved.sum(axis=1, keepdims=True))) and np.allclose(start, np.log(begun / begun.sum()))
    assert T.candidates(rows, activity.FEATURES, chain.BINS) == cuts


def test_chain_tells_held_out_keys(spark):
    sf = "/root/testdata/sf0.01"
    found = chain.activity_chain(spark, sf).where("held_out")
    right, n = found.agg(F.avg((F.col("activity") == F.col("counted")).cast("double")), F.count("*")).first()
    usual = found.groupBy("counted").count().agg(F.max("count")).first()[0] / n
    assert right > usual + 0.02
    assert chain.chain_regions(spark, sf).count() > 0
    db = duckdb.connect()
    db.execute(f"create view events as select * from '{sf}/events.parquet'")
    assert sorted(tuple(r) for r in chain.chain_steps(spark, sf).collect()) == sorted(db.execute(chain.SQL["chain_steps"]).fetchall())
