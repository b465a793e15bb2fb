"""Dynamic programming and fitting over the ordered values of one key."""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np

#: Complements of the letters by their codes; other codes stay.
COMPLEMENT = np.arange(256, dtype=np.uint8)
COMPLEMENT[np.frombuffer(b"ACGT", dtype=np.uint8)] = np.frombuffer(b"TGCA", dtype=np.uint8)

#: The letters as digits of base four.
DIGITS = np.zeros(256, dtype=np.int64)
DIGITS[list(b"ACGT")] = range(4)


def ema(x: np.ndarray, rate: float, jump: float, state: tuple[float, float] | None = None) -> tuple[np.ndarray, tuple[float, float]]:
    """Unbiased exponential mean that ignores upward jumps; ``state`` (sum, weight) carries over between chunks."""
    total, weight = state or (0.0, 0.0)
    out = np.empty(len(x))
    for i, v in enumerate(x):
        if weight == 0 or v - total / weight <= jump:
            total = (1 - rate) * total + rate * v
            weight = (1 - rate) * weight + rate
        out[i] = total / weight
    return out, (total, weight)


def viterbi(scores: np.ndarray, step: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Best state path for log scores (time, states), log transitions and log start."""
    n, k = scores.shape
    back = np.zeros((n, k), dtype=np.int64)
    best = start + scores[0] if n else start
    for t in range(1, n):
        every = best[:, None] + step
        back[t] = every.argmax(axis=0)
        best = every.max(axis=0) + scores[t]
    path = np.zeros(n, dtype=np.int64)
    if n:
        path[-1] = best.argmax()
        for t in range(n - 1, 0, -1):
            path[t - 1] = back[t, path[t]]
    return path


def gaussian_scores(x: np.ndarray, means: np.ndarray, variances: np.ndarray) -> np.ndarray:
    return -0.5 * ((x[:, None] - means) ** 2 / variances + np.log(2 * np.pi * variances))


def mixture(x: np.ndarray, means: np.ndarray, variances: np.ndarray, rounds: int = 20, tolerance: float = 1e-4) -> tuple[float, np.ndarray, np.ndarray, float]:
    """EM for a mixture whose means share one scale: scale, weights, variances and mean log-likelihood."""
    scale, weights, last = 1.0, np.full(len(means), 1 / len(means)), -np.inf
    variances = variances.copy()
    for _ in range(rounds):
        s = gaussian_scores(x, means * scale, variances) + np.log(weights)
        top = s.max(axis=1, keepdims=True)
        like = top[:, 0] + np.log(np.exp(s - top).sum(axis=1))
        p = np.exp(s - like[:, None])
        n = p.sum(axis=0) + 1e-9
        weights = n / n.sum()
        use = p / variances
        scale = float(np.clip((use * x[:, None] * means).sum() / max((use * means**2).sum(), 1e-9), 0.1, 10))
        variances = np.maximum((p * (x[:, None] - means * scale) ** 2).sum(axis=0) / n, 1e-4)
        if abs(like.mean() - last) <= tolerance * abs(like.mean()):
            break
        last = like.mean()
    return scale, weights, variances, float(like.mean())


def semi_global(query: np.ndarray, target: np.ndarray, match: int = 2, other: int = -3, gap: int = -3) -> np.ndarray:
    """Last row of the alignment of the whole query with any part of the target."""
    row = np.zeros(len(target) + 1)
    steps = np.arange(len(target) + 1) * gap
    for i, c in enumerate(query, 1):
        new = np.concatenate([[i * gap], np.maximum(row[:-1] + np.where(target == c, match, other), row[1:] + gap)])
        row = np.maximum.accumulate(new - steps) + steps
    return row


def trace_back(query: np.ndarray, target: np.ndarray, end: int, score: float, match: int = 2, other: int = -3, gap: int = -3) -> tuple[int, int, int, int, int]:
    """The alignment of the whole query that ends before ``end`` with the ``score`` that ``semi_global`` gives there.

    Returns its begin, equal and different pairs, query letters without a partner, and target letters without one. Of
    alignments with the same score a pair goes before a query letter alone, and that before a target letter alone.
    """
    # Each target letter alone costs a gap, and no more than the query's matches can earn beyond the score.
    width = min(end, len(query) + int((match * len(query) - score) // -gap))
    part = target[end - width : end]
    rows, steps = [np.zeros(width + 1)], np.arange(width + 1) * gap
    for i, c in enumerate(query, 1):
        new = np.concatenate([[i * gap], np.maximum(rows[-1][:-1] + np.where(part == c, match, other), rows[-1][1:] + gap)])
        rows.append(np.maximum.accumulate(new - steps) + steps)
    i, j, equal, changed, alone, skipped = len(query), width, 0, 0, 0, 0
    while i:
        same = j > 0 and query[i - 1] == part[j - 1]
        if j and rows[i][j] == rows[i - 1][j - 1] + (match if same else other):
            equal, changed, i, j = equal + same, changed + (not same), i - 1, j - 1
        elif rows[i][j] == rows[i - 1][j] + gap:
            alone, i = alone + 1, i - 1
        else:
            skipped, j = skipped + 1, j - 1
    return end - width + j, int(equal), int(changed), alone, skipped


def local_score(a: np.ndarray, b: np.ndarray, match: int = 2, other: int = -3, gap: int = -3) -> float:
    """The best score of an alignment of any part of ``a`` with any part of ``b``."""
    row, best, steps = np.zeros(len(b) + 1), 0.0, np.arange(len(b) + 1) * gap
    for c in a:
        new = np.concatenate([[0.0], np.maximum(np.maximum(row[:-1] + np.where(b == c, match, other), row[1:] + gap), 0.0)])
        row = np.maximum.accumulate(new - steps) + steps
        best = max(best, float(row.max()))
    return best


def flank_score(target: np.ndarray, begin: int, end: int, reach: int) -> float:
    """How well what precedes a span meets the reverse complement of what follows it; 1000 where either is below ten letters."""
    before, after = target[max(0, begin - reach) : begin], target[end : end + reach]
    if min(len(before), len(after)) < 10:
        return 1000.0
    return local_score(before, COMPLEMENT[after[::-1]])


def spaced(scores: np.ndarray, places: np.ndarray, apart: int) -> list[int]:
    """Candidates of the largest total score, at least ``apart`` from each other; places are sorted."""
    before = np.searchsorted(places, places - apart, side="right")
    best, take = np.zeros(len(places) + 1), np.zeros(len(places), dtype=bool)
    for i in range(len(places)):
        with_it = best[before[i]] + scores[i]
        take[i] = with_it > best[i]
        best[i + 1] = max(with_it, best[i])
    out, i = [], len(places)
    while i > 0:
        if take[i - 1]:
            out.append(i - 1)
            i = before[i - 1]
        else:
            i -= 1
    return out[::-1]


def longest_increasing(a: np.ndarray) -> int:
    """Seeds of the longest chain that ascends in both sequences, given the second's places in order of the first's."""
    tails: list[int] = []
    for v in a.tolist():
        k = bisect_left(tails, v)
        if k == len(tails):
            tails.append(v)
        else:
            tails[k] = v
    return len(tails)


def quality_region(active: np.ndarray, stay: float) -> tuple[int, int]:
    """Begin and end of the last high-quality stretch by a four-state model: before, high, quiet after, active after.

    A stretch of a single block is dropped.
    """
    if not len(active):
        return 0, 0
    leave = np.log(1 / max(2, len(active)))
    low = -1e9
    step = np.full((4, 4), low)
    for a, b in ((0, 0), (0, 1), (1, 1), (1, 2), (1, 3), (2, 2), (3, 3), (2, 1), (3, 1)):
        step[a, b] = 0.0 if a == b else leave
    hit = np.log(np.array([[0.8, 0.15, 0.05], [0.05, 0.9, 0.05], [0.9, 0.05, 0.05], [0.05, 0.15, 0.8]]))
    path = viterbi(hit[:, active].T, step, np.log(np.array([0.5, 0.49, 0.005, 0.005])))
    on = np.flatnonzero(path == 1)
    if not len(on):
        return 0, 0
    cut = np.flatnonzero(np.diff(on) > 1)
    begin = int(on[cut[-1] + 1]) if len(cut) else int(on[0])
    end = int(on[-1]) + 1
    return (begin, end) if end - begin > 1 else (0, 0)


def codes(letters: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Each run of ``k`` letters A, C, G, T (as bytes) as a number of base four, and its reverse complement's."""
    own, other, have = np.zeros(len(letters), dtype=np.int64), np.zeros(len(letters), dtype=np.int64), 0
    if len(letters) < k:
        return own[:0], other[:0]
    run, turned, wide = DIGITS[letters], 3 - DIGITS[letters], 1  # runs of 1, 2, 4, ... letters
    while wide <= k:
        if k & wide:
            n = len(run) - have
            own, other, have = own[:n] << 2 * wide | run[have:], other[:n] | turned[have:] << 2 * have, have + wide
        run, turned, wide = run[:-wide] << 2 * wide | run[wide:], turned[:-wide] | turned[wide:] << 2 * wide, 2 * wide
    return own, other


def turned_places(s: str, k: int, rows: int = 100_000) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All places (fwd, rev) of a run of ``k`` letters (at most 15) and its reverse complement at ``k`` letters or more, about ``rows`` at once."""
    own, other = codes(np.frombuffer(s.encode(), dtype=np.uint8), k)
    n = np.arange(len(own))
    held = np.sort(own << 32 | n)
    first, last = np.searchsorted(held, other << 32 | n + k), np.searchsorted(held, other + 1 << 32)
    total, a = np.concatenate([[0], np.cumsum(last - first)]), 0
    while a < len(n):
        z = max(a + 1, int(np.searchsorted(total, total[a] + rows, side="right")) - 1)
        count = last[a:z] - first[a:z]
        if total[z] > total[a]:
            yield np.repeat(n[a:z], count), held[np.repeat(first[a:z] - total[a:z], count) + np.arange(total[a], total[z])] & 0xFFFFFFFF
        a = z


def seeds_met(letters: np.ndarray, starts: np.ndarray, k: int, repeat: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Seeds met by their reverse complement (turned), and those that come again beyond ``repeat`` letters: arrays read, turned, fwd and rev.

    The reads lie one after another in ``letters``; ``starts`` has where each begins, and their end. The last place of either strand
    before each tells both.
    """
    own, other = codes(letters, k)
    whose = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    inside = np.flatnonzero(whose[: len(own)] == whose[len(letters) - len(own) :])  # no seed of two reads
    own, other = own[inside], other[inside]
    seed = np.sort(np.minimum(own, other) << 32 | inside)  # by seed, then by place, so by read too
    place = seed & 0xFFFFFFFF
    plus = np.zeros(len(letters), dtype=bool)
    plus[inside] = own <= other
    plus, read, at = plus[place], whose[place], np.arange(len(place))
    start = np.maximum.accumulate(np.where((np.diff(seed >> 32, prepend=-1) != 0) | (np.diff(read, prepend=-1) != 0), at, 0))
    before = []
    for strand in (True, False):
        row = np.concatenate([[-1], np.maximum.accumulate(np.where(plus == strand, at, -1))])[:-1]
        before.append(np.where(row >= start, place[row], -1) if len(at) else at)
    same, across = np.where(plus, *before), np.where(plus, *before[::-1])
    hit = np.flatnonzero((across >= 0) & (place - across >= k) & ((same < 0) | (same < across + k)))
    again = np.flatnonzero((same >= 0) & (place - same > repeat) & ((across < 0) | (across < same + k)))
    read = np.concatenate([read[hit], read[again]])
    fwd, rev = np.concatenate([across[hit], same[again]]), np.concatenate([place[hit] + k - 1, place[again]])
    return read, np.repeat([True, False], [len(hit), len(again)]), fwd - starts[read], rev - starts[read]


def covered(b: np.ndarray, e: np.ndarray, score: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Which intervals [b, e) lie within one of a better score, or of the same score and a smaller key: from best to worst, against what is left so far."""
    order = np.lexsort((key, -score))
    out, held = np.zeros(len(b), dtype=bool), np.zeros((2, len(b)), dtype=b.dtype)
    n = 0
    for i in order:
        out[i] = ((held[0, :n] <= b[i]) & (held[1, :n] >= e[i])).any()
        if not out[i]:
            held[:, n] = b[i], e[i]
            n += 1
    return out
