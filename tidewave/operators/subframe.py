"""Labels of frames by a hidden Markov model whose pulses may cover their first and last frame in part.

Thirteen states: the background (0), and for each of four kinds a full frame (1 to 4), a first frame that the pulse
covers in part (5 to 8) and a last one (9 to 12). Traces come in blocks; the last LAG frames of what is known are held back, because
what follows can still change them.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np

KINDS, STATES = 4, 13
FULL, FIRST, LAST = 1, 5, 9
#: Frames that wait for what follows.
LAG = 16


@dataclass(frozen=True)
class Kinetics:
    """Mean length of a kind's pulses and of the gaps after them in frames, and the ratio of the two steps that each consists of."""

    width: float
    gap: float
    width_ratio: float = 0.3
    gap_ratio: float = 0.0


def beyond(mean: float, ratio: float, m: int) -> float:
    """Chance that a stretch touches more than ``m`` frames.

    Its length is the sum of two exponential waits whose means add up to ``mean`` and stand in ``ratio``; its start lies anywhere in a
    frame. So this is the integral, over the m-th frame, of the chance that the stretch is longer. Ratios within 0.01 of one move away from it.
    """
    if m == 0:
        return 1.0
    ratio = max(ratio, 1e-6)
    if abs(ratio - 1) < 0.01:
        ratio = 0.99 if ratio < 1 else 1.01
    slow, fast = (1 + ratio) / mean, (1 + 1 / ratio) / mean
    over = lambda k: (math.exp(-k * (m - 1)) - math.exp(-k * m)) / k
    return (fast * over(slow) - slow * over(fast)) / (fast - slow)


def transitions(kinds: list[Kinetics], gaps: float = 1.0, twos: float = 1.0, ones: float = 1.0) -> np.ndarray:
    """Log chances from each state (row) to each; impossible steps are -inf.

    The factors weigh gaps of at most two frames, pulses of two and pulses of one. A gap that short has no frame of its own: its
    pulse's last state, or its only one, goes straight to the next pulse's first.
    """
    n, p = len(kinds), np.zeros((STATES, STATES))
    mean_gap = sum(k.gap for k in kinds) / n
    start = 1 - beyond(mean_gap, 0, 3) / beyond(mean_gap, 0, 2)
    short = [gaps / n * (1 - beyond(k.gap, k.gap_ratio, 2)) for k in kinds]
    p[0, 0] = 1 - start
    for i, k in enumerate(kinds):
        more = [beyond(k.width, k.width_ratio, m) for m in range(4)]
        one, two = ones * (1 - more[1]) / (1 + sum(short)), twos * (more[1] - more[2])
        p[0, FIRST + i] = start / n
        p[FIRST + i, 0], p[FIRST + i, LAST + i] = one, two
        p[FIRST + i, FULL + i] = 1 - one * (1 + sum(short)) - two
        p[FULL + i, LAST + i] = 1 - more[3] / more[2]
        p[FULL + i, FULL + i] = more[3] / more[2]
        p[LAST + i, 0] = 1 - sum(short)
        for j in range(n):
            p[LAST + i, FIRST + j], p[FIRST + i, FIRST + j] = short[j], one * short[j]
    with np.errstate(divide="ignore"):
        return np.log(np.maximum(p, 0))


def scores(x: np.ndarray, mean: np.ndarray, variance: np.ndarray, levels: np.ndarray, spreads: np.ndarray) -> np.ndarray:
    """Log densities (keys, frames, states) of signals (keys, frames) under models (keys), levels and spreads (keys, kinds).

    A frame in part is as likely anywhere between background and level, with tails of theirs on both sides; over the level it stays a
    unit below a full frame. Where the two tails of the dimmest kind meet, a normal curve halfway takes its place.
    A sample that is not a number tells nothing: it scores 0 in all states.
    """
    normal = lambda x, m, v: -0.5 * ((x - m) ** 2 / v + np.log(2 * np.pi * v))
    y, m, v = x[..., None], mean[:, None, None], variance[:, None, None]
    level, spread = levels[:, None, :], spreads[:, None, :]
    out = np.empty((*x.shape, STATES))
    out[..., 0] = normal(x, mean[:, None], variance[:, None])
    full = out[..., FULL:FIRST] = normal(y, level, spread)
    joint = math.sqrt(math.pi / 2)
    low, high = m + joint * np.sqrt(v), level - joint * np.sqrt(spread)
    tail = np.where(y < low, (y - low) ** 2 / v, np.where(y > high, (y - high) ** 2 / spread, 0.0))
    part = -0.5 * tail - np.log(level - m)
    # Only the last kind, the dimmest, can have joints that cross.
    half = normal(y[..., 0], (mean[:, None] + levels[:, -1:]) / 2, (variance[:, None] + spreads[:, -1:] + (levels[:, -1:] - mean[:, None]) / 6) / 2)
    part[..., -1] = np.where((low <= high[..., -1:])[..., 0], part[..., -1], half)
    part = np.where(y > level, np.minimum(np.minimum(part, full - 1), 0.0), part)
    out[..., FIRST:LAST] = out[..., LAST:] = part
    out[~np.isfinite(x)] = 0.0
    return out


def strength(x: np.ndarray) -> np.ndarray:
    """The greatest of four sums around each frame, each scaled to the noise of one frame: itself, with either neighbour, and one before to two after."""
    x = np.where(np.isfinite(x), x, -np.inf)
    pad = np.pad(x, ((0, 0), (1, 2)), constant_values=-np.inf)
    before, after, later = pad[:, :-3], pad[:, 2:-1], pad[:, 3:]
    return np.maximum.reduce([x, (before + x) / math.sqrt(2), (x + after) / math.sqrt(2), (before + x + after + later) / 2])


def interest(v: np.ndarray, inside: np.ndarray, low: float, high: float) -> tuple[np.ndarray, np.ndarray]:
    """Frames of stretches over ``low`` that somewhere reach ``high``; and the same without what only follows from later frames.

    ``inside`` tells for each key whether the frame before was in such a stretch.
    """
    forward, over = np.zeros(v.shape, dtype=bool), v >= low
    for t in range(v.shape[1]):
        inside = (v[:, t] >= high) | (inside & over[:, t])
        forward[:, t] = inside
    whole, held = forward.copy(), np.zeros(len(v), dtype=bool)
    for t in range(v.shape[1] - 1, -1, -1):
        held = forward[:, t] | (held & over[:, t])
        whole[:, t] = held
    return whole, forward


@dataclass
class Carry:
    """What a key brings from one block to the next: the state and the sample of its last labelled frame, and the frames that wait."""

    state: int = 0
    inside: bool = False
    before: float = math.nan
    first: int = 0
    held: list[float] = field(default_factory=list)


def label(carries: list[Carry], blocks: np.ndarray, models: tuple, step: np.ndarray, low: float, high: float, last: bool) -> tuple[np.ndarray, list[Carry]]:
    """States of all frames that are ready, and what each key carries on.

    ``blocks`` (keys, frames) holds the next frames of keys of which as many wait. Unless these are the ``last``, LAG frames go on waiting. The state
    at the cut is the likeliest over all ends, each end's probability being led back along its path.
    Outside the stretches of interest only the background is possible; where it can't be reached, the likeliest path falls to it.
    """
    x = np.concatenate([np.array([c.held for c in carries]).reshape(len(carries), -1), blocks], axis=1)
    keys, n = x.shape
    ready = n if last else max(0, n - LAG)
    if ready == 0:
        return np.zeros((keys, 0), dtype=np.uint8), [Carry(c.state, c.inside, c.before, c.first, row.tolist()) for c, row in zip(carries, x)]
    mean, variance = models[0], models[1]
    noise = (np.concatenate([np.array([[c.before] for c in carries]), x], axis=1) - mean[:, None]) / np.sqrt(variance)[:, None]
    whole, forward = interest(strength(noise)[:, 1:], np.array([c.inside for c in carries]), low, high)
    own = scores(x, *models)
    own[..., 1:] = np.where(whole[..., None], own[..., 1:], -np.inf)
    like = np.full((keys, STATES), -np.inf)
    like[np.arange(keys), [c.state for c in carries]] = 0.0
    back = np.zeros((n, keys, STATES), dtype=np.uint8)
    for t in range(n):
        every = like[:, :, None] + step
        back[t] = every.argmax(axis=1)
        now = every.max(axis=1) + own[:, t]
        lost = ~np.isfinite(now).any(axis=1)
        now[lost, 0] = like[lost].max(axis=1) + own[lost, t, 0]
        back[t, lost, 0] = like[lost].argmax(axis=1)
        like = now - now.max(axis=1, keepdims=True)
    chance = np.exp(like)
    for t in range(n - 1, ready - 1, -1):
        led = np.zeros_like(chance)
        np.add.at(led, (np.arange(keys)[:, None], back[t]), chance)
        chance = led
    path, state = np.zeros((keys, ready), dtype=np.uint8), chance.argmax(axis=1)
    for t in range(ready - 1, -1, -1):
        path[:, t] = state
        state = back[t, np.arange(keys), state]
    rest = [Carry(int(path[i, -1]), bool(forward[i, ready - 1]), float(x[i, ready - 1]), c.first + ready, x[i, ready:].tolist()) for i, c in enumerate(carries)]
    return path, rest
