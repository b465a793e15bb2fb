"""Palindromes against plain loops: seeds by a walk with a table, the chain by all pairs, centres by lists."""

import math
import random
from collections import Counter

import numpy as np
import pytest

from tidewave.plans import palindromes as P
from tidewave.plans.relations import by_block, turned_pairs

SWAP = str.maketrans("ACGT", "TGCA")


def walk(s, k):
    """The rule as it reads: the last place of each seed, forgotten once a reverse complement uses it."""
    last, out = {}, []
    for i in range(len(s) - k + 1):
        own = s[i : i + k]
        other = own.translate(SWAP)[::-1]
        if own in last and i - last[own] > P.REPEAT:
            out.append((False, last[own], i))
        last[own] = i
        if other in last and i - last[other] >= k:
            out.append((True, last[other], i + k - 1))
            del last[other]
    return out


def plain_chain(cands, n, insert, unit, support):
    """Scores of all pairs, one by one; ``cands`` is (place, density) in order."""
    usual, reach = support(insert) / unit, max(n // 2, 2 * insert)
    score, back = [], []
    for i, (place, density) in enumerate([*cands, (n, 0)]):
        end = i == len(cands)
        best, move = (usual * place / insert if place < insert else support(place) / unit), -1
        for j in range(i):
            far = place - cands[j][0]
            if far > reach or (not end and far < insert / 2.2):
                continue
            gain = usual * (1 - min(1.0, abs(far - insert) / insert)) / (10 if far > insert else 1) if end else support(far) / unit
            if score[j] + gain > best:
                best, move = score[j] + gain, j
        score.append(best + density)
        back.append(move)
    i, chain = score.index(max(score)), []
    while i >= 0:
        if i < len(cands):
            chain.append(cands[i][0])
        i = back[i]
    return chain[::-1]


def plain_centres(s, k=P.K):
    spans = walk(s, k)
    hits, repeats = [(f, r) for t, f, r in spans if t], [r - f for t, f, r in spans if not t]
    if not hits:
        return []
    if repeats:
        scaled = [round(math.log(x) * 100) for x in repeats]
        near = lambda x: sum(abs(y - round(math.log(x) * 100)) <= 5 for y in scaled)
        insert = max(1, min(repeats, key=lambda x: (-near(x), x)) // 2)
    else:
        insert = max(1, math.floor(np.percentile([r - f for f, r in hits], 90) / 1.8))
    n, unit = len(s), max(1, len(repeats) // 60)
    hits = [(f, r) for f, r in hits if r - f < 3 * insert]
    here = Counter((f + r) // 2 for f, r in hits)
    density = {x: sum(c for y, c in here.items() if abs(y - x) <= P.FLANK) for x in here}
    peak = max(density.values(), default=0)
    cands = []
    for x in sorted(here):
        around = {y: d for y, d in density.items() if abs(y - x) <= P.FLANK}
        if density[x] == max(around.values()) and all(d < density[x] for y, d in around.items() if y < x) and density[x] >= P.SHARE * peak * min(1.0, min(x, n - x) / insert):
            cands.append((x, density[x]))
    halves = [(x // 2, 1) for x in repeats] or [(insert, 100 * unit)]
    support = lambda d: sum(by for h, by in halves if h - h // 20 <= d <= h + h // 20)
    chain = plain_chain(cands, n, insert, unit, support) if cands else []
    groups = {m: [] for m in chain}
    for f, r in hits:
        at = (f + r) // 2
        mode = min(chain, key=lambda m: (abs(m - at), m)) if chain else None
        far = abs(r - mode) + abs(f - mode)
        if abs(at - mode) <= insert / 3 and far <= insert * 2.2:
            groups[mode].append((far, f, r, at))
    found = []
    for mode, own in groups.items():
        own.sort()
        choices = []
        if len(own) >= P.NEAREST:
            choices.append(sorted(x[3] for x in own[: P.NEAREST])[P.NEAREST // 2])
        choices.append(mode)
        if own:
            choices.append(sorted(x[3] for x in own)[len(own) // 2])
        told = [(sum(f < c < r for _, f, r, _ in own), c) for c in choices]
        most = max(t[0] for t in told)
        if most > 1:
            found.append((next(c for t, c in told if t == most), most))
    found.sort(key=lambda x: (x[0], -x[1]))
    kept, island = [], []
    for x in found:
        if island and x[0] - island[-1][0] > insert / 8:
            kept.append(min(island, key=lambda y: (-y[1], y[0])))
            island = []
        island.append(x)
    return kept + ([min(island, key=lambda y: (-y[1], y[0]))] if island else [])


def reads_of(seed):
    """Reads of one to six passes with letters lost, repeats, runs of one letter, stray palindromes, and none at all."""
    rng, reads = random.Random(seed), {}
    letters = lambda n: "".join(rng.choice("ACGT") for _ in range(n))
    for key in range(30):
        s, out = letters(rng.randint(30, 500)), ""
        if key % 7 == 3:
            s += s[:60] + "A" * 40 + "T" * 40
        for i in range(rng.randint(1, 6)):
            one = s if i % 2 == 0 else s.translate(SWAP)[::-1]
            out += "".join(c for c in one if rng.random() > 0.04)
        reads[key] = out
    return reads | {100: "", 101: "ACGT", 102: "A" * 300, 103: "A" * 200 + "T" * 200, 104: "AC" * 90, 105: None}


@pytest.fixture(scope="module")
def made(spark):
    return {seed: (r, spark.createDataFrame(list(r.items()), "doc_id long, s string")) for seed in (1, 2) for r in [reads_of(seed)]}


@pytest.mark.parametrize("k", [5, 15])
def test_seeds_equal_a_walk(made, k):
    reads, df = made[1]
    got = sorted((r["doc_id"], r["turned"], r["fwd"], r["rev"]) for r in P.found(df, k).collect())
    assert got == sorted((key, *x) for key, s in reads.items() if s for x in walk(s, k)) and len(got) > 1000


@pytest.mark.parametrize("seed", [1, 2])
def test_centres_equal_plain_loops(made, seed):
    reads, df = made[seed]
    got = sorted((r["doc_id"], r["centre"], r["support"]) for r in P.centres(df).collect())
    assert got == sorted((key, *x) for key, s in reads.items() if s for x in plain_centres(s)) and len(got) > 40


def test_chain_equals_all_pairs():
    rng = np.random.default_rng(4)
    for _ in range(200):
        at = np.unique(rng.integers(0, 3000, rng.integers(1, 40)))
        density, insert, unit = rng.integers(1, 60, len(at)), int(rng.integers(40, 700)), int(rng.integers(1, 5))
        halves = rng.integers(20, 1500, 30)
        steps = np.concatenate([halves - halves // 20, halves + halves // 20 + 1])
        changes, order = np.repeat([1, -1], 30), np.argsort(steps, kind="stable")
        support = lambda d: int(((halves - halves // 20 <= d) & (d <= halves + halves // 20)).sum())  # noqa: B023, E731
        got = P.best_chain(at, density, 3000, insert, unit, steps[order], changes[order])
        assert got == plain_chain(list(zip(at.tolist(), density.tolist())), 3000, insert, unit, support)


def test_pairs_of_a_sequence_need_no_shuffle(spark):
    """Sequences in one row meet themselves where they are read; an id with two rows, and null ids, as the join has it."""
    rows = [(i, s) for i, s in reads_of(1).items()]
    df = spark.createDataFrame([*rows, (None, "AC" * 20 + "GT" * 20)], "doc_id long, s string").where("doc_id is not null")
    for data in (df, df.unionByName(spark.createDataFrame([(0, "ACGTTGCA" * 9), (101, None)], df.schema))):
        each = {}
        for key, s in ((r["doc_id"], r["s"]) for r in data.collect()):
            each.setdefault(key, []).extend((i, s[i : i + 12]) for i in range(len(s or "") - 11))
        want = sorted((key, i, j) for key, x in each.items() for i, a in x for j, b in x if j >= i + 12 and b == a.translate(SWAP)[::-1])
        assert sorted(map(tuple, turned_pairs(data, 12).collect())) == want and len(want) > 1000
    for plan in (turned_pairs(df, 12), P.found(df)):
        assert "Exchange" not in plan._jdf.queryExecution().toString().split("Physical Plan")[1]


def test_planted_turns_are_found(spark):
    """Reads derived from the tables turn after the first and the second pass; hardly another place is called where letters are many."""
    reads = P.molecules(spark, "/root/testdata/sf0.001")
    got = {}
    for r in P.centres(reads).collect():
        got.setdefault(r["doc_id"], []).append(r["centre"])
    planted = hit = other = 0
    for key, n in ((r["doc_id"], len(r["s"])) for r in P.sequences(spark, "/root/testdata/sf0.001").where("length(s) >= 100").collect()):
        turns, near = [n, 2 * n - n // 19], max(8, n / 8)
        planted += 2
        hit += sum(any(abs(x - t) <= near for x in got.get(key, [])) for t in turns)
        other += sum(all(abs(x - t) > near for t in turns) for x in got.get(key, []))
    assert hit >= 0.97 * planted and other <= 0.03 * planted


@pytest.mark.parametrize("most", [1, 700, 1 << 18])
def test_blocks_of_reads(spark, most):
    """Reads told many at once are told as alone: no seed, place or support reaches over to the next read, and a read longer than a block stays whole."""
    reads = [s or "" for s in reads_of(3).values()] + ["ACGTTGCATCAGGAC", "GTCCTGATGCAACGT", "", ""]
    rows = spark.createDataFrame(list(enumerate(reads)), "doc_id long, s string").coalesce(1)
    for found, plain, shape in (
        (lambda x, starts: P.kernels.seeds_met(x, starts, 7, P.REPEAT), lambda s: walk(s, 7), "turned boolean, fwd long, rev long"),
        (P.turns, plain_centres, "centre long, support long"),
    ):
        got = sorted(map(tuple, by_block(rows, found, shape, most).collect()))
        assert got == sorted((i, *x) for i, s in enumerate(reads) for x in plain(s)) and len(got) > 30


def test_centres_need_no_shuffle(spark):
    """Each row is a read of its own, told where it is read; the letters are derived once."""
    rows = [(1, s) for s in reads_of(2).values()]
    df = spark.createDataFrame(rows, "doc_id long, s string")
    got = P.centres(df)
    assert sorted(tuple(r)[1:] for r in got.collect()) == sorted(tuple(x) for _, s in rows if s for x in plain_centres(s))
    plan = P.centres(P.molecules(spark, "/root/testdata/sf0.001"))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Window" not in plan and plan.count("upper(") == 1
