"""Kernels against plain versions, and plans that SQL can't express."""

import itertools

import numpy as np
import pytest

from tidewave.operators import kernels as K
from tidewave.plans import fitted
from tidewave.sources import readers
from tidewave.streaming import blocks as streaming

SF = "/root/testdata/sf0.001"


def test_viterbi_is_the_best_path():
    rng = np.random.default_rng(0)
    s, t, b = rng.normal(size=(6, 3)), rng.normal(size=(3, 3)), rng.normal(size=3)
    score = lambda p: b[p[0]] + sum(s[i, x] for i, x in enumerate(p)) + sum(t[x, y] for x, y in zip(p, p[1:]))
    assert tuple(K.viterbi(s, t, b)) == max(itertools.product(range(3), repeat=6), key=score)


def test_ema_does_not_depend_on_chunks():
    x = np.random.default_rng(1).normal(size=50)
    whole, _ = K.ema(x, 0.1, 0.5)
    first, state = K.ema(x[:17], 0.1, 0.5)
    second, _ = K.ema(x[17:], 0.1, 0.5, state)
    assert np.allclose(np.concatenate([first, second]), whole)


def test_spaced_selection_is_best():
    rng = np.random.default_rng(2)
    places, scores = np.sort(rng.choice(60, 9, False)), rng.random(9)
    fit = [c for n in range(10) for c in itertools.combinations(range(9), n) if all(places[b] - places[a] >= 10 for a, b in zip(c, c[1:]))]
    assert tuple(K.spaced(scores, places, 10)) == max(fit, key=lambda c: sum(scores[list(c)]))


def test_mixture_finds_the_scale():
    rng = np.random.default_rng(3)
    means = np.array([10.0, 40.0, 90.0])
    x = np.concatenate([rng.normal(1.3 * m, 2, 400) for m in means])
    scale, weights, _, _ = K.mixture(x, means, np.full(3, 30.0))
    assert abs(scale - 1.3) < 0.02 and np.allclose(weights, 1 / 3, atol=0.03)


def test_semi_global_finds_the_query():
    q, t = np.frombuffer(b"GATTACA", dtype=np.uint8), np.frombuffer(b"CCCGATTACACCC", dtype=np.uint8)
    row = K.semi_global(q, t)
    assert row.max() == 14 and row.argmax() == 10


def _table(a, b, match, other, gap, free, floor):
    """Plain alignment scores of all prefixes; ``free`` begins in b, ``floor`` begins anywhere."""
    t = [[0 if free else j * gap for j in range(len(b) + 1)]]
    for i in range(1, len(a) + 1):
        t.append([0 if floor else i * gap])
        for j in range(1, len(b) + 1):
            best = max(t[i - 1][j - 1] + (match if a[i - 1] == b[j - 1] else other), t[i - 1][j] + gap, t[i][j - 1] + gap)
            t[i].append(max(best, 0) if floor else best)
    return t


def test_trace_back_accounts_for_its_score():
    rng = np.random.default_rng(5)
    for _ in range(60):
        q = rng.choice(list(b"ACGT"), 12).astype(np.uint8)
        copy = [c for c in q.tolist() if rng.random() > 0.1]
        copy = [int(rng.choice(list(b"ACGT"))) if rng.random() < 0.1 else c for c in copy]
        copy = [x for c in copy for x in ([c, 65] if rng.random() < 0.1 else [c])]
        t = np.array([*rng.choice(list(b"ACGT"), 9), *copy, *rng.choice(list(b"ACGT"), 7)], dtype=np.uint8)
        row = K.semi_global(q, t)
        assert row.tolist() == _table(q, t, 2, -3, -3, True, False)[-1]
        for end in (int(row.argmax()), int(rng.integers(len(t) + 1)), 0, len(t)):
            begin, equal, changed, alone, skipped = K.trace_back(q, t, end, float(row[end]))
            assert 2 * equal - 3 * (changed + alone + skipped) == row[end] == _table(q, t[begin:end], 2, -3, -3, False, False)[-1][-1]
            assert equal + changed + alone == len(q) and equal + changed + skipped == end - begin


def test_flanks_meet_their_mirror():
    rng = np.random.default_rng(6)
    a, b = rng.choice(list(b"ACGT"), (2, 30)).astype(np.uint8)
    assert K.local_score(a, b) == max(map(max, _table(a, b, 2, -3, -3, True, True)))
    mirror = np.frombuffer(bytes(a[::-1]).translate(bytes.maketrans(b"ACGT", b"TGCA")), dtype=np.uint8)
    t = np.concatenate([a, np.full(18, 65, dtype=np.uint8), mirror])
    assert K.flank_score(t, 30, 48, 30) == 60 and K.flank_score(t, 9, 48, 30) == 1000


def test_adapter_labels_extend_the_alignments(spark):
    """The hits are those of adapter_align; counts, accuracy and the rule follow from one another."""
    found = fitted.adapter_labels(spark, SF).collect()
    assert sorted((r["doc_id"], r["end"]) for r in found) == sorted((r["doc_id"], r["end"]) for r in fitted.adapter_align(spark, SF).collect())
    assert found
    for r in found:
        errors = r["mismatches"] + r["insertions"] + r["deletions"]
        assert r["matches"] + r["mismatches"] + r["insertions"] == len(fitted.ADAPTER)
        assert abs(r["accuracy"] - (1 - errors / (r["end"] - r["begin"]))) < 1e-12
        assert r["kept"] == (r["accuracy"] >= 0.85 or (r["accuracy"] >= 0.7 and r["flank"] >= 20))


def test_quality_region_drops_single_blocks():
    assert K.quality_region(np.array([0, 0, 1, 1, 1, 1, 0, 0]), 0.9) == (2, 6)
    assert K.quality_region(np.zeros(0, dtype=int), 0.9) == (0, 0)


def groups(df, order, value):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r["zmw"], r[order])):
        out.setdefault(r["zmw"], []).append(r[value])
    return out


def test_fitted_plans_equal_plain_loops(spark):
    """Whole queries against loops over one key's rows; every key is there."""
    held = groups(readers.traces(spark, SF), "frame", "signal")
    base = {r["zmw"]: r for r in fitted.ema_baseline(spark, SF).collect()}
    assert base.keys() == held.keys()
    for zmw, x in held.items():
        total = weight = 0.0
        above = []
        for v in x:
            if weight == 0 or v - total / weight <= 0.05:
                total, weight = 0.9 * total + 0.1 * v, 0.9 * weight + 0.1
            above.append(v - total / weight)
        assert abs(base[zmw]["baseline"] - total / weight) < 1e-9 and abs(base[zmw]["above"] - sum(above) / len(above)) < 1e-9
    paths = groups(fitted.viterbi_frames(spark, SF), "frame", "state")
    assert {k: len(v) for k, v in paths.items()} == {k: len(v) for k, v in held.items()}
    means, spread, move = [-0.12, 0.0, 0.12], [0.006, 0.004, 0.006], np.log([[0.9 if a == b else 0.05 for b in range(3)] for a in range(3)])
    cost = lambda x, p: sum(-0.5 * ((v - means[s]) ** 2 / spread[s] + np.log(2 * np.pi * spread[s])) for v, s in zip(x, p)) + sum(move[a, b] for a, b in zip(p, p[1:]))
    rng = np.random.default_rng(4)
    for zmw in list(held)[:20]:  # no change of one frame makes a path better
        best = cost(held[zmw], paths[zmw])
        for at in rng.integers(0, len(held[zmw]), 12):
            for s in range(3):
                other = [*paths[zmw]]
                other[at] = s
                assert cost(held[zmw], other) <= best + 1e-9
    pulses = groups(readers.pulses(spark, SF), "frame", "height")
    fits = {r["zmw"]: r for r in fitted.em_mixture(spark, SF).collect()}
    assert fits.keys() == pulses.keys() and all(0.1 <= r["scale"] <= 10 and 0 <= r["background"] <= 1 for r in fits.values())
    assert {r["zmw"] for r in fitted.hq_hmm(spark, SF).collect()} == pulses.keys()


@pytest.mark.parametrize("name", ["adapter_align", "burst_hmm", "control_hits"])
def test_fitted_spans_are_within_their_keys(spark, name):
    rows = fitted.QUERIES[name](spark, SF).collect()
    assert all(r["end_frame"] - r["begin_frame"] >= 5 for r in rows) if name == "burst_hmm" else rows
    if name == "adapter_align":
        ends = {}
        for r in rows:
            ends.setdefault(r["doc_id"], []).append(r["end"])
        assert all(b - a >= 30 for v in ends.values() for a, b in zip(sorted(v), sorted(v)[1:]))


def test_stream_equals_batch(spark):
    assert streaming.stream_equals_batch(spark, SF).count() == 0


def test_stream_windows(spark):
    for name in ("stream_mb_tumbling", "stream_lookback"):  # whole results: tests/test_whole.py
        assert streaming.QUERIES[name](spark, SF).agg({"n": "sum"}).first()[0] == 1000


def test_fasta_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("a", "ACGT"), ("b", "GG")], "name string, sequence string").coalesce(1)
    readers.write_fasta(df, str(tmp_path / "x"))
    assert sorted(map(tuple, readers.read_fasta(spark, str(tmp_path / "x")).collect())) == [("a", "ACGT"), ("b", "GG")]


def test_replicated_traces_wrap(spark):
    t = readers.simulate(spark, 2, 8, "sawtooth")
    r = readers.replicate(t, 5, 20, 2, 8)
    assert r.count() == 100 and r.where("signal != at % 8").count() == 0
    assert readers.square_layout(10) == (3, 4)


def test_tails_of_laws(spark):
    from statistics import NormalDist

    from pyspark.sql import functions as F

    from tidewave.functions import columns as C

    xs = [-4.0, -1.3, 0.0, 0.7, 3.2]
    got = [r[0] for r in spark.createDataFrame([(x,) for x in xs], "x double").select(C.normal_cdf(F.col("x"))).collect()]
    assert np.allclose(got, [NormalDist().cdf(x) for x in xs], atol=2e-7)
    grid = np.linspace(0, 200, 400_001)
    for k in (2, 4, 8):
        density = grid ** (k / 2 - 1) * np.exp(-grid / 2)
        tail = density[grid >= 5].sum() / density.sum()
        assert abs(spark.range(1).select(C.chi2_tail(F.lit(5.0), k)).first()[0] - tail) < 1e-3
