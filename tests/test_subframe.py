"""Labels of frames against loops, closed forms and planted pulses."""

import math

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidewave.operators import subframe as S
from tidewave.plans import labels as L
from tidewave.streaming import labels as stream_labels

KINDS = [S.Kinetics(8, 20, 0.3, 0.1), S.Kinetics(6, 15, 0.2), S.Kinetics(10, 25), S.Kinetics(7, 18)]
LEVELS = np.array([12.0, 9.0, 6.5, 4.5])


def model(keys):
    return np.zeros(keys), np.ones(keys), np.tile(LEVELS, (keys, 1)), np.tile(1 + 0.02 * LEVELS, (keys, 1))


def planted(rng, keys, frames):
    """Signals of pulses that begin and end within frames, and the kind that covers most of each frame (0: none)."""
    x, kind = rng.normal(size=(keys, frames)), np.zeros((keys, frames), dtype=int)
    for i in range(keys):
        at = rng.exponential(20) + 3
        while at < frames - 12:
            k, end = rng.integers(4), at + 3 + rng.exponential(5)
            cover = np.clip(np.minimum(end, np.arange(frames) + 1) - np.maximum(at, np.arange(frames)), 0, 1)
            x[i] += cover * LEVELS[k]
            kind[i][cover > 0.5] = k + 1
            at = end + 6 + rng.exponential(15)
    return x, kind


@pytest.mark.parametrize("mean, ratio", [(5.0, 0.3), (2.0, 0.0), (9.0, 1.0), (1.2, 3.0)])
def test_lengths_equal_draws(mean, ratio):
    rng = np.random.default_rng(1)
    long = rng.exponential(mean / (1 + ratio), 400_000) + (rng.exponential(mean * ratio / (1 + ratio), 400_000) if ratio else 0)
    touched = np.ceil(rng.random(400_000) + long)
    for m in range(4):
        assert abs((touched > m).mean() - S.beyond(mean, ratio, m)) < 0.006


def test_transitions_sum_to_one():
    p = np.exp(S.transitions(KINDS))
    assert np.allclose(p.sum(axis=1), 1) and (p >= 0).all()
    assert p[1, 0] == 0 and p[0, 1] == 0 and p[5, 2] == 0 and p[5, 6] > 0 and p[9, 6] > 0


def plain_path(x, m, step, low, high):
    """One key's whole path by loops."""
    n = len(x)
    norm = [(v - m[0]) / math.sqrt(m[1]) for v in x]
    v = []
    for t in range(n):
        own = [norm[t]]
        own += [(norm[t - 1] + norm[t]) / math.sqrt(2)] if t else []
        own += [(norm[t] + norm[t + 1]) / math.sqrt(2)] if t + 1 < n else []
        own += [sum(norm[t - 1 : t + 3]) / 2] if 0 < t < n - 2 else []
        v.append(max(own))
    roi = [False] * n
    for t in range(n):
        if v[t] >= high:
            for way in (1, -1):
                u = t
                while 0 <= u < n and v[u] >= low:
                    roi[u] = True
                    u += way
    best, backs = {0: 0.0}, []
    for t in range(n):
        own = S.scores(np.array([[x[t]]]), *(np.array([a]) for a in m))[0, 0]
        now, back = {}, {}
        for s in range(S.STATES):
            if s and not roi[t]:
                continue
            ways = [(best[p] + step[p, s], -p) for p in best if step[p, s] > -np.inf]
            if ways:
                now[s], back[s] = max(ways)[0] + own[s], -max(ways)[1]
        if not now:
            p = max(best, key=best.get)
            now, back = {0: best[p] + own[0]}, {0: p}
        best = now
        backs.append(back)
    path = [max(best, key=best.get)]
    for back in backs[:0:-1]:
        path.append(back[path[-1]])
    return path[::-1]


def test_whole_path_equals_loops_and_finds_pulses():
    rng, step = np.random.default_rng(2), S.transitions(KINDS)
    x, kind = planted(rng, 12, 150)
    path, rest = S.label([S.Carry() for _ in x], x, model(12), step, 2.0, 5.0, True)
    for i in range(12):
        assert path[i].tolist() == plain_path(x[i], [m[i] for m in model(12)], step, 2.0, 5.0)
    found = np.where(path == 0, 0, (path.astype(int) - 1) % 4 + 1)
    full = (path > 0) & (path < 5)
    assert (found[full] == kind[full]).mean() > 0.97
    assert ((path > 0) == (kind > 0)).mean() > 0.95
    assert all(c.held == [] and c.first == 150 for c in rest)


@pytest.mark.parametrize("size", [1, 7, 20, 64])
def test_blocks_equal_the_whole(size):
    """Any cut into blocks labels every frame once; almost all as the whole trace, though each cut decides without what lies further ahead."""
    rng, step = np.random.default_rng(3), S.transitions(KINDS)
    x, _ = planted(rng, 40, 200)
    whole, _ = S.label([S.Carry() for _ in x], x, model(40), step, 2.0, 5.0, True)
    carries, parts = [S.Carry() for _ in x], []
    for a in range(0, 200, size):
        path, carries = S.label(carries, x[:, a : a + size], model(40), step, 2.0, 5.0, a + size >= 200)
        parts.append(path)
        assert all(len(c.held) <= S.LAG for c in carries)
    got = np.concatenate(parts, axis=1)
    assert got.shape == whole.shape and (got == whole).mean() > 0.995


def test_odd_samples():
    step = S.transitions(KINDS)
    x = np.array([[np.nan] * 20, [1e9] * 20, [-1e9] * 20, [0.0, np.inf] * 10])
    path, _ = S.label([S.Carry() for _ in x], x, model(4), step, 2.0, 5.0, True)
    assert (path[0] == 0).all() and (path[2] == 0).all() and path.shape == (4, 20)
    none, rest = S.label([S.Carry()], np.zeros((1, 0)), model(1), step, 2.0, 5.0, True)
    assert none.shape == (1, 0) and rest[0].first == 0
    # A full frame can't be followed by background; where the stretch of interest has ended, the path falls to it nevertheless.
    path, _ = S.label([S.Carry(state=1)], np.zeros((1, 5)), model(1), step, 2.0, 5.0, True)
    assert path[0].tolist() == [0] * 5
    # While the sample before still lifts the first frame, the pulse ends in a frame of its own.
    path, _ = S.label([S.Carry(state=1, inside=True, before=12.0)], np.zeros((1, 5)), model(1), step, 2.0, 5.0, True)
    assert path[0].tolist() == [9, 0, 0, 0, 0]


SHAPE = "zmw long, x array<double>, mean double, variance double, levels array<double>, spreads array<double>"


def made(spark):
    """Traces of several lengths, with null samples, an empty one, and one shorter than what waits."""
    x, _ = planted(np.random.default_rng(4), 30, 130)
    rows = [(i, [None if (i, t) == (3, 50) else float(v) for t, v in enumerate(r[: 130 - 4 * i])], 0.0, 1.0, LEVELS.tolist(), (1 + 0.02 * LEVELS).tolist()) for i, r in enumerate(x)]
    rows += [(98, [], *rows[0][2:]), (99, [20.0] * 5, *rows[0][2:])]
    return rows, L.in_blocks(spark.createDataFrame(rows, SHAPE))


def states_of(df):
    out = {}
    for r in df.orderBy("zmw", "frame").collect():
        out.setdefault(r["zmw"], []).append((r["frame"], r["state"]))
    return out


def test_blocks_in_spark_equal_blocks_in_a_loop(spark):
    step = S.transitions(KINDS)
    rows, blocks = made(spark)
    want = {}
    for zmw, x, *m in rows:
        carry, path = S.Carry(), []
        for a in range(0, len(x), L.FRAMES):
            part = np.array([[np.nan if v is None else v for v in x[a : a + L.FRAMES]]])
            found, (carry,) = S.label([carry], part, tuple(np.array([v]) for v in m), step, L.LOW, L.HIGH, a + L.FRAMES >= len(x))
            path += found[0].tolist()
        if path:
            want[zmw] = list(enumerate(path))
    assert states_of(L.frame_states(blocks, step)) == want and 98 not in want and len(want) == 31
    # Without its last block a key keeps what waits.
    cut = states_of(L.frame_states(blocks.where("not (zmw = 0 and last)"), step))
    assert len(cut[0]) == 120 - S.LAG and cut[0] == want[0][: 120 - S.LAG]
    for wrong in (blocks.where("not (zmw = 0 and block = 1)"), blocks.unionByName(blocks.where("zmw = 0 and block = 1"))):
        with pytest.raises(Exception, match="each once"):
            L.frame_states(wrong, step).collect()


def test_a_task_holds_a_batch_whatever_the_keys(monkeypatch):
    """Keys in order of key: each is finished before the next batch, few go through the labeller at once, and repeats are told."""
    rng, at_once = np.random.default_rng(5), []
    rows = [{"zmw": z, "block": b, "last": b == 2, "x": rng.normal(size=24).tolist(), "mean": 0.0, "variance": 1.0, "levels": [9.0, 7.0, 5.0, 3.0], "spreads": [1.0] * 4} for z in range(60) for b in range(3)]
    batches = lambda r, n: [pa.RecordBatch.from_pylist(r[i : i + n]) for i in range(0, len(r), n)]
    step = S.transitions([S.Kinetics(8, 8, 0.3, 0.1)] * 4)
    plain = L.labelled
    monkeypatch.setattr(L, "AT_ONCE", 10)
    monkeypatch.setattr(L, "labelled", lambda part, *a: at_once.append(len(part)) or plain(part, *a))
    want = None
    for n in (180, 50, 1):
        got = []
        for out in L.label_batches(iter(batches(rows, n)), step):
            got += out.to_pylist()
        got.sort(key=lambda r: (r["zmw"], r["frame"]))
        assert len(got) == 60 * 72 and (want is None or got == want)
        want = got
    assert max(at_once) == 10
    for odd in (rows[:3] + rows[2:], rows[:1] + rows[2:]):
        for n in (180, 3, 1):
            with pytest.raises(ValueError, match="each once"):
                list(L.label_batches(iter(batches(odd, n)), step))


def test_stream_equals_batch_whatever_the_order(spark, tmp_path):
    """Blocks come in four micro-batches, some before their turn and some twice."""
    step = S.transitions(KINDS)
    _, blocks = made(spark)
    want = states_of(L.frame_states(blocks, step))
    at = F.pmod(F.hash("zmw", "block"), F.lit(4))
    for k in range(4):
        again = blocks.where((at == (k + 1) % 4) & (F.col("zmw") % 3 == 0))
        blocks.where(at == k).unionByName(again).coalesce(1).write.parquet(f"{tmp_path}/{k}")
    stream = spark.readStream.schema(blocks.schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(str(tmp_path))
    assert states_of(stream_labels.drained(spark, stream, step)) == want


def test_registered_labels(spark):
    sf = "/root/testdata/sf0.001"
    assert stream_labels.stream_subframe_differences(spark, sf).count() == 0
    n = spark.read.parquet(f"{sf}/embeddings.parquet").where("size(embedding) > 0").select(F.sum(F.size("embedding"))).first()[0]
    assert L.subframe_labels(spark, sf).count() == n
    pulses = L.subframe_pulses(spark, sf)
    assert pulses.where("end_frame <= begin_frame or kind not between 1 and 4").count() == 0 < pulses.count()
