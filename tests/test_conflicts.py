"""Intervals without those that a better one covers: against all pairs, and few are left for the tree."""

import random

import pytest

from tidewave.plans.relations import unbeaten, uncovered


@pytest.mark.parametrize("part", [7, 1000])
def test_unbeaten_equal_all_pairs(spark, part):
    rng, rows = random.Random(part), []
    for i in range(400):
        b = rng.randint(-50, 900)
        rows.append((i, b, b + rng.choice([1, 3, 40, 300, 900]), rng.choice([1, 1, 1, 2, 3]), float(rng.randint(0, 60))))
    df = spark.createDataFrame(rows, "id long, b long, e long, s long, score double")
    left = uncovered(df, part)
    better = lambda y, x: (y[4], -y[0]) > (x[4], -x[0])
    want = {(x[0], x[4]) for x in rows if not any(y[3] == x[3] and y[1] < x[2] and x[1] < y[2] and better(y, x) for y in rows)}
    assert {tuple(r) for r in unbeaten(left).collect()} == {tuple(r) for r in unbeaten(df).collect()} == want and want
    assert left.count() < (200 if part == 1000 else 400)
