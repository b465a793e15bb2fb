"""Centres of palindromes in reads of several passes: seeds used once, the best chain of candidates, refined places.

A read passes over the same insert to and fro; where it turns, what follows is the reverse complement of what came before.
Reads here are derived from documents: the letters, their reverse complement, the letters again, with letters lost in each
later pass. All steps need one read only and are taken where it is read, for many reads at once, so that nothing is shuffled; each row
is a read. A read without hits (empty, null, shorter than two seeds) has no row.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewave.functions import columns as C
from tidewave.operators import kernels
from tidewave.plans.relations import by_block, sequences
from tidewave.session import ship_package

QUERIES, SQL = {}, {}

#: Letters of a seed: odd, so that none is its own reverse complement. Repeats of a seed count beyond REPEAT letters only.
K, REPEAT = 15, 100
#: Half width of the density's window, and the least share of a read's densest place that a candidate has.
FLANK, SHARE = 40, 0.25
#: The nearest hits whose median is one of the choices of a centre.
NEAREST = 10


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def molecules(spark: SparkSession, sf: str) -> DataFrame:
    """Three passes over each document's letters; the second loses every 19th letter, the third every 23rd."""
    s = sequences(spark, sf)  # null letters make a null read; to filter by them would derive them twice
    lost = lambda x, n: F.regexp_replace(x, f"(.{{{n - 1}}}).", "$1")
    return s.select("doc_id", F.concat("s", lost(C.reverse_complement(F.col("s")), 19), lost(F.col("s"), 23)).alias("s"))


def found(reads: DataFrame, k: int = K) -> DataFrame:
    """Hits (``turned``: a seed and its reverse complement) and repeats of seeds, as (doc_id, turned, fwd, rev).

    A place is remembered until its seed comes again, or until a reverse complement at ``k`` letters or more uses it; used places
    are forgotten. So a hit needs that no seed of its own strand came since the other's last place could be used, and a repeat
    that no hit used the place before: both can be told from the last place of either strand. Each row is a read, told where it is read.
    """

    return by_block(reads, lambda letters, starts: kernels.seeds_met(letters, starts, k, REPEAT), "turned boolean, fwd long, rev long")


_MOLECULES = """with seq as (select doc_id, regexp_replace(upper(text), '[^ACGT]', '', 'g') as s from documents where text is not null),
 turn as (select doc_id, s, reverse(translate(s, 'ACGT', 'TGCA')) as rc from seq),
 reads as (select doc_id, s || regexp_replace(rc, '(.{18}).', '\\1', 'g') || regexp_replace(s, '(.{22}).', '\\1', 'g') as s from turn)
"""


@query(_MOLECULES + """, k as (select doc_id, p - 1 as place, substring(s, p, 15) as kmer from (select doc_id, s, unnest(range(1, length(s) - 13)) as p from reads)),
 c as (select doc_id, place, least(kmer, reverse(translate(kmer, 'ACGT', 'TGCA'))) as seed, kmer <= reverse(translate(kmer, 'ACGT', 'TGCA')) as plus from k),
 l as (select *, last_value(case when plus then place end ignore nulls) over w as p, last_value(case when not plus then place end ignore nulls) over w as m from c
  window w as (partition by doc_id, seed order by place rows between unbounded preceding and 1 preceding)),
 b as (select doc_id, place, case when plus then p else m end as same, case when plus then m else p end as across from l)
 select doc_id, true as turned, across as fwd, place + 14 as rev from b where place - across >= 15 and (same is null or same < across + 15)
 union all select doc_id, false as turned, same as fwd, place as rev from b where place - same > 100 and (across is null or across < same + 15)""")
def palindrome_hits(spark: SparkSession, sf: str) -> DataFrame:
    """Seeds met by their reverse complement, each place used once, and seeds that come again."""
    ship_package(spark)
    return found(molecules(spark, sf))


def runs(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The values of a sorted array and where each begins, and its end."""
    first = np.flatnonzero(np.diff(key, prepend=-1))
    return key[first], np.append(first, len(key))


def inserts(n: np.ndarray, read: np.ndarray, turned: np.ndarray, span: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each read with hits (rows sorted by read): the insert's length, how many repeats make one unit of support, and how many there are.

    The insert is half of the span that most repeats share within about 5 %; without repeats (one turn only) hits span evenly up to
    twice the insert, and it is their 90th percentile by 1.8.
    """
    insert, repeats = np.ones(len(n), dtype=np.int64), np.bincount(read[~turned], minlength=len(n))
    at, long = read[~turned], span[~turned]
    if len(at):
        scaled = np.floor(np.log(long) * 100 + 0.5).astype(np.int64)
        which, first = runs(at)
        wide = scaled.max() - scaled.min() + 12
        slot = np.repeat(np.arange(len(which)) * wide, np.diff(first)) + scaled - scaled.min() + 5
        below = np.concatenate([[0], np.cumsum(np.bincount(slot, minlength=len(which) * wide))])
        near = below[slot + 6] - below[slot - 5]
        most = np.repeat(np.maximum.reduceat(near, first[:-1]), np.diff(first))
        insert[which] = np.minimum.reduceat(np.where(near == most, long, np.iinfo(np.int64).max), first[:-1]) // 2
    alone = turned & (repeats[read] == 0)
    order = np.lexsort((span[alone], read[alone]))
    at, long = read[alone][order], span[alone][order]
    which, first = runs(at)
    place = (np.diff(first) - 1) * 0.9
    lo, hi = np.floor(place), np.ceil(place)
    below, above = long[first[:-1] + lo.astype(np.int64)], long[first[:-1] + hi.astype(np.int64)]
    insert[which] = np.floor(np.where(below == above, below, (hi - place) * below + (place - lo) * above) / 1.8)
    return np.maximum(1, insert), np.maximum(1, repeats // 60), repeats


def highest(x: np.ndarray, wide: int) -> np.ndarray:
    """The greatest of ``wide`` values from each on; shorter by ``wide`` - 1."""
    have = 1
    while 2 * have <= wide:
        x, have = np.maximum(x[:-have], x[have:]), 2 * have
    return np.maximum(x[: len(x) - wide + have], x[wide - have :]) if wide > have else x


def candidates(n: np.ndarray, insert: np.ndarray, read: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places (read, at, density) where the hits' centres are densest within FLANK letters, first of equals, in order.

    The least density is SHARE of the read's greatest, and less near the ends, where fewer hits can be.
    """
    base = FLANK + np.concatenate([[0], np.cumsum(n + FLANK)])  # reads lie FLANK apart
    here = np.bincount(base[read] + at, minlength=base[-1] + 1)
    below = np.concatenate([[0], np.cumsum(here)])
    place = np.flatnonzero(here)
    density = np.zeros(len(here), dtype=np.int64)
    density[place] = below[place + FLANK + 1] - below[place - FLANK]
    side = highest(density, FLANK)
    owner = np.searchsorted(base, place, side="right") - 1
    own, (which, first) = density[place], runs(owner)
    peak = np.zeros(len(n), dtype=np.int64)
    peak[which] = np.maximum.reduceat(own, first[:-1])
    where = place - base[owner]
    least = SHARE * peak[owner] * np.minimum(1.0, np.minimum(where, n[owner] - where) / insert[owner])
    take = (side[place - FLANK] < own) & (side[place + 1] <= own) & (own >= least)
    return owner[take], where[take], own[take]


def best_chain(at: np.ndarray, density: np.ndarray, n: int, insert: int, unit: int, steps: np.ndarray, changes: np.ndarray) -> list[int]:
    """The chain of candidates with the most density and the best supported distances, as places in order.

    ``steps`` (sorted) and ``changes`` hold the support of a distance as a running sum. Distances below insert / 2.2 don't follow each other,
    nor those beyond n / 2 and two inserts; the end of the read closes a chain but bears no centre. The first of equal chains counts.
    """
    total = np.concatenate([[0], np.cumsum(changes)]) / unit
    told = lambda d: total[np.searchsorted(steps, d, side="right")]
    usual, reach = float(told(insert)), max(n // 2, 2 * insert)
    place = np.append(at, n)
    alone = np.where(place < insert, usual * place / insert, told(place))
    lo = np.searchsorted(at, place - reach)
    hi = np.minimum(np.searchsorted(at, place - insert / 2.2, side="right"), np.arange(len(place)))
    hi[-1] = len(at)
    score, back = np.zeros(len(place)), np.full(len(place), -1)
    bonus = np.append(density, 0)
    for i in range(len(place)):
        a, z, best = lo[i], hi[i], alone[i]
        if z > a:
            far = place[i] - at[a:z]
            if i == len(at):
                gain = usual * (1 - np.minimum(1.0, np.abs(far - insert) / insert)) / np.where(far > insert, 10, 1)
            else:
                gain = told(far)
            sums = score[a:z] + gain
            j = sums.argmax()
            if sums[j] > best:
                best, back[i] = sums[j], a + j
        score[i] = best + bonus[i]
    chain, i = [], int(score.argmax())
    while i >= 0:
        if i < len(at):
            chain.append(int(at[i]))
        i = int(back[i])
    return chain[::-1]


def chains(n: np.ndarray, insert: np.ndarray, unit: np.ndarray, repeats: np.ndarray, places: tuple[np.ndarray, ...], read: np.ndarray, span: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The best chain of each read's candidates: (read, mode), in order. ``read`` and ``span`` are the repeats, sorted by read.

    Each repeat lifts the support of distances within about 5 % of half its span. Reads without repeats get a hundred units around
    the estimated insert.
    """
    owner, at, density = places
    which, first = runs(owner)
    none = which[repeats[which] == 0]
    of, half, by = np.concatenate([read, none]), np.concatenate([span // 2, insert[none]]), np.concatenate([np.ones(len(read), dtype=np.int64), unit[none] * 100])
    base = np.concatenate([[0], np.cumsum(n + 2)])
    side = half // 20
    change = np.bincount(base[of] + half - side, by, base[-1]) - np.bincount(base[of] + half + side + 1, by, base[-1])
    steps = np.flatnonzero(change)
    a, z = np.searchsorted(steps, base[which]), np.searchsorted(steps, base[which + 1])
    out = [best_chain(at[first[i] : first[i + 1]], density[first[i] : first[i + 1]], int(n[r]), int(insert[r]), int(unit[r]), steps[a[i] : z[i]] - base[r], change[steps[a[i] : z[i]]]) for i, r in enumerate(which)]
    return np.repeat(which, [len(x) for x in out]), np.array([m for x in out for m in x], dtype=np.int64)


def refined(n: np.ndarray, insert: np.ndarray, chain: tuple[np.ndarray, np.ndarray], read: np.ndarray, fwd: np.ndarray, rev: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Centres (read, centre, support) from the hits (sorted by read, fwd, rev) whose middle lies nearest to a chain's place, within a third of the insert.

    The choices are the median middle of the NEAREST hits, the place itself and the median of all, the first with the most hits that
    span it (two at least). Of centres no further than an eighth of the insert from the one before, the best supported stays.
    """
    owner, mode = chain
    starts, at = np.concatenate([[0], np.cumsum(n)]), (fwd + rev) // 2
    line = starts[owner] + mode
    ahead, behind = np.searchsorted(line, starts[read] + at, side="right") - 1, np.searchsorted(line, starts[read] + at)
    left, right = (ahead >= 0) & (owner[ahead] == read), (behind < len(line)) & (owner[np.minimum(behind, len(line) - 1)] == read)
    group = np.where(~left | (right & (mode[np.minimum(behind, len(line) - 1)] - at < at - mode[ahead])), behind, ahead)
    near = np.flatnonzero(left | right)
    group, fwd, rev, at = group[near], fwd[near], rev[near], at[near]
    far = np.abs(rev - mode[group]) + np.abs(fwd - mode[group])
    size = insert[owner[group]]
    near = np.flatnonzero((3 * np.abs(at - mode[group]) <= size) & (5 * far <= 11 * size))
    group, fwd, rev, at, far = group[near], fwd[near], rev[near], at[near], far[near]
    count = np.bincount(group, minlength=len(mode))
    first = np.concatenate([[0], np.cumsum(count)])[:-1]
    full, some = np.flatnonzero(count >= NEAREST), np.flatnonzero(count)
    nearest = at[np.argsort(group << 40 | far, kind="stable")]
    middle = at[np.lexsort((at, group))]
    choices = np.stack([mode, mode, mode])
    choices[0, full] = np.sort(nearest[first[full][:, None] + np.arange(NEAREST)], axis=1)[:, NEAREST // 2]
    choices[2, some] = middle[first[some] + count[some] // 2]
    told = np.stack([np.bincount(group[(fwd < c[group]) & (rev > c[group])], minlength=len(mode)) for c in choices])
    told[0, count < NEAREST] = -1
    best = told.argmax(axis=0)
    support, centre = told[best, np.arange(len(mode))], choices[best, np.arange(len(mode))]
    keep = np.flatnonzero(support > 1)
    keep = keep[np.lexsort((centre[keep], owner[keep]))]
    owner, centre, support = owner[keep], centre[keep], support[keep]
    apart = (np.diff(owner, prepend=-1) != 0) | (8 * np.diff(centre, prepend=0) > insert[owner])
    order = np.lexsort((centre, -support, np.cumsum(apart)))
    order = order[np.flatnonzero(apart)]
    return owner[order], centre[order], support[order]


def turns(letters: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where each read of a block turns: arrays read, centre and support."""
    n = np.diff(starts)
    read, turned, fwd, rev = kernels.seeds_met(letters, starts, K, REPEAT)
    met = np.bincount(read[turned], minlength=len(n)) > 0
    order = np.argsort((starts[read] + fwd) << 32 | rev)
    order = order[met[read[order]]]
    read, turned, fwd, rev = read[order], turned[order], fwd[order], rev[order]
    insert, unit, repeats = inserts(n, read, turned, rev - fwd)
    hit = turned & (rev - fwd < 3 * insert[read])
    if not hit.any():
        return (np.zeros(0, dtype=np.int64),) * 3
    places = candidates(n, insert, read[hit], (fwd[hit] + rev[hit]) // 2)
    chain = chains(n, insert, unit, repeats, places, read[~turned], (rev - fwd)[~turned])
    if not len(chain[0]):
        return (np.zeros(0, dtype=np.int64),) * 3
    return refined(n, insert, chain, read[hit], fwd[hit], rev[hit])


def centres(reads: DataFrame) -> DataFrame:
    """Where each read (doc_id, s) turns: (doc_id, centre, support), ``centre`` the letters before it. Each row is a read, told where it is read."""
    ship_package(reads.sparkSession)
    return by_block(reads, turns, "centre long, support long")


@query()
def palindrome_centres(spark: SparkSession, sf: str) -> DataFrame:
    """Where reads of three passes turn; no SQL, since a chain is chosen step by step. Tests hold it against plain loops."""
    return centres(molecules(spark, sf))
