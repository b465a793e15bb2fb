"""Exact Jaccard join on word shingles that uses relations between sets to skip work."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewave.llm.common import BITS, batches_of, bit_of, bitmap, stored, words_of
from tidewave.llm.graph import connected_components

WORDS = 5
#: Links need 100 * intersection >= PERCENT * union.
PERCENT = 75
#: Documents that make a shingle frequent, and the share of a document's hashes in which these are sought.
HOT, BAND = 24, 0.36
#: Second hubs of lists that have the same members.
HUBS = 8
#: Shingles of a matrix product of a block.
GRID = 4096
#: Pairs of strays and members of a hub from which these are compared in blocks, and rows of a block.
CROWD, CHUNK = 4_000, 1024
#: Shingles of a block's side, about: 16 MB.
CELLS = 1 << 21

_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA24BAED4963EE407], dtype=np.uint64)


def shingles(text: str | None, words: int = WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's word shingles; fewer words form one; no words, none."""
    held = words_of(text)
    if not held:
        return np.zeros(0, dtype=np.uint64)
    if len(held) < words:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(held), seed=len(held))], dtype=np.uint64)
    codes = np.fromiter(map(xxhash.xxh3_64_intdigest, held), dtype=np.uint64, count=len(held))
    n = len(codes) - words + 1
    total = np.zeros(n, dtype=np.uint64)
    for k in range(words):
        total += (codes[k : k + n] ^ (codes[k : k + n] >> np.uint64(29))) * _MIX[k % 5]
        total ^= total >> np.uint64(31)
    return np.unique(total * _MIX[0])


def prefix_size(n: np.ndarray | int) -> np.ndarray | int:
    """Two sets that link share a member of their prefixes of this size, in any common order: n - ceil(t n) + 1."""
    return n - -(-n * PERCENT // 100) + 1


def _sum_slots(rows: pd.DataFrame) -> pd.DataFrame:
    slots = np.concatenate([np.frombuffer(x, dtype=np.uint32) for x in rows["slots"]])
    counts = np.concatenate([np.frombuffer(x, dtype=np.uint8) for x in rows["counts"]])
    held, back = np.unique(slots, return_inverse=True)
    return pd.DataFrame({"slot": held[np.bincount(back, counts) >= HOT].astype(np.int64) % BITS})


def _frequent(docs: DataFrame) -> np.ndarray:
    """Bits of the shingles that HOT or more documents hold, among those that can be in a prefix.

    Prefixes go by hash, so that only the lowest share of a document's hashes is counted, each as 32 bits. A task
    sums its own; the sums meet in groups that grow in number with the documents. Any function of a shingle gives
    a valid order of shingles: what the bits merge or leave out costs time, never a link.
    """
    parts = 1 << max(4, int(np.ceil(np.log2(max(1, docs.count()) / 4000))))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, waiting = [], 0
        for b in batches_of(batches, 256):
            for text in b.column("text").to_pylist():
                held = shingles(text)
                seen.append(held[: int(BAND * len(held)) + 2].astype(np.uint32))
                waiting += len(seen[-1])
            if waiting > 8_000_000:
                yield _parted(seen, parts)
                seen, waiting = [], 0
        if seen:
            yield _parted(seen, parts)

    sums = docs.select("text").mapInArrow(count, "part long, slots binary, counts binary")
    return bitmap(sums.groupBy("part").applyInPandas(_sum_slots, "slot long"))


def _parted(seen: list[np.ndarray], parts: int) -> pa.RecordBatch:
    held, counts = np.unique(np.concatenate(seen), return_counts=True)
    cuts = np.searchsorted(held, (np.arange(parts, dtype=np.uint64) * (1 << 32) // parts).astype(np.uint32))[1:]
    columns = [pa.array(np.arange(parts))] + [pa.array([x.tobytes() for x in np.split(y, cuts)], pa.binary()) for y in (held, np.minimum(counts, HOT).astype(np.uint8))]
    return pa.record_batch(columns, ["part", "slots", "counts"])


def _veiled(rep: str) -> Column:
    """``rep`` with some of its bits turned, by its list; the same again gives ``rep``.

    The second hub of a list is the member that comes first so. Lists of the same members thus have HUBS different hubs, and
    one of them suffices to link a member with the rest.
    """
    turned = [int(x) for x in np.random.default_rng(1).integers(0, 1 << 62, HUBS)]
    return F.col(rep).bitwiseXOR(F.element_at(F.array(*map(F.lit, turned)), (F.pmod("token", F.lit(HUBS)) + 1).cast("int")))


def _sort_keys(held: np.ndarray, rank: np.ndarray) -> np.ndarray:
    return bit_of(rank, held.astype(np.uint32) % np.uint32(BITS))


def may_link(x: np.ndarray, nx: int, y: np.ndarray, ny: int, rank: np.ndarray) -> bool:
    """Whether two sets may link, by their prefixes: up to the lesser end all common members are known."""
    rx, ry = _sort_keys(x, rank), _sort_keys(y, rank)
    ends = [(r[-1], h[-1]) for h, r, n in ((x, rx, nx), (y, ry, ny)) if len(h) < n]
    if ends:
        at, to = min(ends)
        x = x[(rx < at) | ((rx == at) & (x <= to))]
        y = y[(ry < at) | ((ry == at) & (y <= to))]
    bound = len(np.intersect1d(x, y, assume_unique=True)) + min(nx - len(x), ny - len(y))
    return 100 * bound >= PERCENT * (nx + ny - bound)


def _marked(rows: DataFrame, key: str, values: DataFrame):
    """``rows`` whose ``key`` has a bit set (1), or not (0), by a map of the bits of ``values`` (id): told where they are read."""
    slot = lambda c: F.pmod(F.xxhash64(c), F.lit(BITS))
    marks = rows.sparkSession.sparkContext.broadcast(bitmap(values.select(slot("id").alias("slot"))))
    columns, schema = rows.columns, rows.schema

    def told(bit: int) -> DataFrame:
        def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches_of(batches, 1024):
                yield b.select(columns).filter(pa.array(bit_of(marks.value, b.column("_slot").to_numpy()) == bit))

        return rows.withColumn("_slot", slot(key)).mapInArrow(keep, schema)

    return told


def _starts(reps: DataFrame, pairs: DataFrame) -> DataFrame:
    """(rep, n, start) of the ends of ``pairs`` (a, b), and of few others: prefixes are long, and most sets are in no pair."""
    return _marked(reps.select("rep", "n", "start"), "rep", pairs.select(F.explode(F.array("a", "b")).alias("id")))(1)


def _possible(pairs: DataFrame, reps: DataFrame, order) -> DataFrame:
    """The distinct ``pairs`` (a, b) that sizes and prefixes let link."""
    size = lambda k: reps.select(F.col("rep").alias(k), F.col("n").alias(f"n{k}"))
    fits = (F.col("na") * 100 >= F.col("nb") * PERCENT) & (F.col("nb") * 100 >= F.col("na") * PERCENT)
    sized = stored(pairs.join(size("a"), "a").join(size("b"), "b").where(fits).select("a", "b").distinct(), "sized")
    starts = _starts(reps, sized)
    start = lambda k: starts.select(F.col("rep").alias(k), F.col("n").alias(f"n{k}"), F.col("start").alias(f"s{k}"))
    both = sized.join(start("a"), "a").join(start("b"), "b").where(fits)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rank = order.value
        for b in batches_of(batches, 512):
            na, nb = b.column("na").to_pylist(), b.column("nb").to_pylist()
            sa, sb = ([np.asarray(v, dtype=np.int64).view(np.uint64) for v in b.column(k).to_pylist()] for k in ("sa", "sb"))
            good = pa.array([may_link(sa[i], na[i], sb[i], nb[i], rank) for i in range(b.num_rows)], pa.bool_())
            yield b.select(["a", "b"]).filter(good)

    return both.select("a", "b", "na", "nb", "sa", "sb").mapInArrow(keep, "a long, b long").distinct()


def _sets(base: DataFrame, pairs: DataFrame) -> DataFrame:
    """(rep, held): the whole sets of the documents in ``pairs``, from their texts.

    A bit for each such document tells every task which texts to read; others that share its bit are read in
    vain and find no pair.
    """
    slot = lambda c: F.pmod(F.xxhash64(c), F.lit(BITS))
    marks = bitmap(pairs.select(F.explode(F.array("a", "b")).alias("id")).select(slot("id").alias("slot")))
    wanted = base.sparkSession.sparkContext.broadcast(marks)

    def load(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches_of(batches, 256):
            part = b.take(pa.array(np.flatnonzero(bit_of(wanted.value, b.column("slot").to_numpy()))))
            held = [shingles(t) for t in part.column("text").to_pylist()]
            keep = [i for i, h in enumerate(held) if len(h)]
            yield pa.record_batch([part.column("doc_id").take(pa.array(keep, pa.int64())), pa.array([held[i].tobytes() for i in keep], pa.binary())], ["rep", "held"])

    read = base.where("doc_id is not null").select("doc_id", "text", slot("doc_id").alias("slot")).mapInArrow(load, "rep long, held binary")
    return read.groupBy("rep").agg(F.first("held").alias("held"))  # rows of one id have one text; dealt as the joins need it


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """``pairs`` (a, b) with the sizes of intersection and union of their sets."""

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches_of(batches, 256):
            both, union = [], []
            for x, y in zip(b.column("sa").to_pylist(), b.column("sb").to_pylist()):
                x, y = np.frombuffer(x, dtype=np.uint64), np.frombuffer(y, dtype=np.uint64)
                if len(x) > len(y):
                    x, y = y, x
                at = np.searchsorted(y, x)
                n = int((y[np.minimum(at, len(y) - 1)] == x).sum()) if len(x) else 0
                both.append(n)
                union.append(len(x) + len(y) - n)
            yield pa.record_batch([b.column("a"), b.column("b"), pa.array(both, pa.int64()), pa.array(union, pa.int64())], ["a", "b", "both", "whole"])

    joined = (
        pairs.join(sets.select(F.col("rep").alias("a"), F.col("held").alias("sa")), "a")
        .join(sets.select(F.col("rep").alias("b"), F.col("held").alias("sb")), "b")
    )
    return joined.select("a", "b", "sa", "sb").mapInArrow(meet, "a long, b long, both long, whole long")


def _common(held: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """How many shingles each set of ``left`` shares with each of ``right`` (numbers of ``held``), by matrix products over parts of the shingles."""
    names = np.intersect1d(np.concatenate([held[i] for i in left]), np.concatenate([held[i] for i in right]))
    both = np.zeros((len(left), len(right)), dtype=np.float32)
    sides = []
    for side in (left, right):  # the common shingles of each side, by row
        row, every = np.repeat(np.arange(len(side)), [len(held[i]) for i in side]), np.concatenate([held[i] for i in side])
        at = np.searchsorted(names, every)
        hit = (at < len(names)) & (names[np.minimum(at, len(names) - 1)] == every) if len(names) else np.zeros(len(every), dtype=bool)
        order = np.argsort(at[hit], kind="stable")
        sides.append((row[hit][order], at[hit][order]))
    for k in range(0, len(names), GRID):
        grids = []
        for side, (row, at) in zip((left, right), sides):
            cut = slice(*np.searchsorted(at, [k, k + GRID]))
            grid = np.zeros((len(side), min(GRID, len(names) - k)), dtype=np.float32)
            grid[row[cut], at[cut] - k] = 1
            grids.append(grid)
        both += grids[0] @ grids[1].T
    return both


def _cross(rows: pd.DataFrame, rank: np.ndarray) -> pd.DataFrame:
    """Pairs of a block of strays and a block of members, of different components, that sizes and prefixes let link."""
    held = [np.asarray(x, dtype=np.int64).view(np.uint64) for x in rows["start"]]
    left, right = np.flatnonzero(rows["role"] == 0), np.flatnonzero(rows["role"] == 1)
    ids, parts, size = (rows[c].to_numpy() for c in ("rep", "part", "n"))
    if not len(left) or not len(right):
        return pd.DataFrame({"a": ids[:0], "b": ids[:0]})
    both = _common(held, left, right)
    # As in may_link: up to the lesser end of two prefixes all common members are known. An end is its place in the common order.
    known = np.array([len(h) for h in held], dtype=np.int64)
    last = np.array([h[np.lexsort((h, k))[-1]] for h, k in ((h, _sort_keys(h, rank)) for h in held)], dtype=np.uint64)
    later = _sort_keys(last, rank).astype(bool)
    open_ = known < size
    place = np.empty(len(held), dtype=np.int64)
    place[np.lexsort((last, later))] = np.arange(len(held))
    place[~open_] = len(held)  # a whole set is known up to any end

    def upto(ends: np.ndarray, of: np.ndarray) -> np.ndarray:
        """Members of the prefixes ``of`` up to each of ``ends``."""
        found = np.empty((len(ends), len(of)), dtype=np.int64)
        for j, i in enumerate(of):
            keys = _sort_keys(held[i], rank).astype(bool)
            early, late = np.sort(held[i][~keys]), np.sort(held[i][keys])
            found[:, j] = np.where(later[ends], len(early) + np.searchsorted(late, last[ends], "right"), np.searchsorted(early, last[ends], "right"))
        found[~open_[ends]] = known[of]
        return found

    rest, total = size - known, size[left][:, None] + size[right][None, :]
    lesser = place[left][:, None] <= place[right][None, :]
    own, other = np.where(lesser, rest[left][:, None], rest[right][None, :]), np.where(lesser, size[right][None, :] - upto(left, right), size[left][:, None] - upto(right, left).T)
    bound = np.minimum(both + np.minimum(own, other), np.minimum(size[left][:, None], size[right][None, :]))
    x, y = np.nonzero((100 * bound >= PERCENT * (total - bound)) & (parts[left][:, None] != parts[right][None, :]))
    x, y = left[x], right[y]
    return pd.DataFrame({"a": np.minimum(ids[x], ids[y]), "b": np.maximum(ids[x], ids[y])})


def _open_rows(rows: pd.DataFrame, rank: np.ndarray) -> pd.DataFrame:
    """The rows of a block that may link with another of it: its rows, not its pairs, whose number is the product of theirs."""
    pairs = _cross(rows, rank)
    return rows[rows["rep"].isin(np.union1d(pairs["a"], pairs["b"]))].drop(columns="start")


def _forest(rows: pd.DataFrame) -> pd.DataFrame:
    """Links (a, b) that join the components of a block's rows as all links of their whole sets do: fewer than there are components."""
    held = [np.frombuffer(x, dtype=np.uint64) for x in rows["held"]]
    left, right = np.flatnonzero(rows["role"] == 0), np.flatnonzero(rows["role"] == 1)
    ids, part = rows["rep"].to_numpy(), np.unique(rows["part"], return_inverse=True)[1]
    found = []
    if len(left) and len(right):
        both, size = _common(held, left, right).astype(np.int64), np.array([len(h) for h in held])
        linked = 100 * both >= PERCENT * (size[left][:, None] + size[right][None, :] - both)
        label = np.arange(part.max() + 1)
        for i, row in zip(left, linked):
            near = right[row]
            others, first = np.unique(label[part[near]], return_index=True)
            new = others != label[part[i]]
            found += [(min(ids[i], ids[j]), max(ids[i], ids[j])) for j in near[first[new]]]
            label[np.isin(label, others[new])] = label[part[i]]
    return pd.DataFrame(found, columns=["a", "b"]).astype("int64")


def _blocks(crowd: DataFrame, starts: DataFrame, base: DataFrame, order) -> DataFrame:
    """Links (a, b) that join what links among the strays and members of each hub's ``crowd`` (hub, rep, part, stray, block).

    Strays of a size class meet members of the same and the neighbouring classes only, in blocks of at most about CHUNK
    strays and as many members, fewer where sets are large, each in a task of its own. Prefixes are dealt to the blocks; then whole sets of
    what may link there. A block returns rows and links that join components, never its pairs.
    """
    sets_of = F.greatest(F.lit(1.0), F.least(F.lit(float(CHUNK)), CELLS / F.pow(F.lit(100 / PERCENT), F.col("block") + 1.0)))
    sizes = (
        crowd.groupBy("hub", "block").agg(F.sum("stray").alias("strays"), F.count("*").alias("members"))
        .select("hub", "block", F.ceil(F.col("strays") / sets_of).cast("int").alias("across"), F.ceil(F.col("members") / sets_of).cast("int").alias("down"))
    )
    meet = (
        sizes.where("across > 0").select("hub", "block", "across", F.explode(F.array(*(F.col("block") + k for k in (-1, 0, 1)))).alias("other"))
        .join(sizes.select("hub", F.col("block").alias("other"), "down"), ["hub", "other"])
    )
    own = lambda n: F.pmod(F.xxhash64("rep"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    key = ["hub", "block", "other", "x", "y"]
    roles = [
        crowd.where("stray = 1").join(meet, ["hub", "block"]).select("rep", "part", "hub", "block", "other", own("across").alias("x"), every("down").alias("y"), F.lit(0).alias("role")),
        crowd.select("hub", "rep", "part", F.col("block").alias("other")).join(meet, ["hub", "other"])
        .select("rep", "part", "hub", "block", "other", every("across").alias("x"), own("down").alias("y"), F.lit(1).alias("role")),
    ]
    dealt = roles[0].unionByName(roles[1]).join(starts, "rep")
    shape = dealt.drop("start").schema
    met = stored(dealt.groupBy(*key).applyInPandas(lambda rows: _open_rows(rows, order.value)[shape.names], shape), "near")
    wanted = met.select("rep").distinct()
    whole = met.select("rep", "part", "role", *key).join(_sets(base, wanted.select(F.col("rep").alias("a"), F.col("rep").alias("b"))), "rep")
    return whole.groupBy(*key).applyInPandas(_forest, "a long, b long").distinct()


def shingle_classes(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row: classes linked by Jaccard similarity, found exactly.

    Equal sets become one at once. Sets are ordered from rare to frequent shingles and indexed by their prefixes;
    every member of an index list is compared with the list's hub, its most central member, which joins groups of near copies in about as many
    comparisons as they have members; members of lists still apart meet a second hub. What is left are members that don't link with their
    hub: they probe the list's blocks, keyed by size class; blocks of sizes that can't link are never met, and
    the position of the shared shingle bounds the overlap. Answers known for the hub carry over to its similar
    sets: a member in the same component needs no comparison, and one whose distance from the hub differs by more
    than the threshold can't link. Pairs are first bounded by their sizes and prefixes, then compared in full.

    Null, empty and blank texts have no shingles and form their own classes. Rows without a doc_id link with nothing, and
    their component_id is null. Rows that repeat a doc_id are one document that links wherever one of its texts does; each
    gives a row. Shingles are held as 64-bit hashes. Other columns are ignored; an empty table gives an empty result.
    """
    base = docs.select("doc_id", "text")
    described, order = _described(base)
    texts = described.where("doc_id is not null").groupBy("doc_id").agg(*(f(F.coalesce("key", F.lit(b""))).alias(k) for f, k in ((F.min, "low"), (F.max, "high"))))
    several = texts.where("low != high").select("doc_id")
    return _classes(base, described, order) if several.isEmpty() else _renamed(base, several)


def _renamed(base: DataFrame, several: DataFrame) -> DataFrame:
    """``shingle_classes`` where ids have several texts: each text of these gets an id of its own, and what shares an id is joined afterwards."""
    slot = F.pmod(F.xxhash64("doc_id"), F.lit(BITS))
    marks = base.sparkSession.sparkContext.broadcast(bitmap(several.select(slot.alias("slot"))))

    def rename(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches_of(batches, 256):
            own = b.column("doc_id").to_pylist()
            new = bit_of(marks.value, b.column("slot").to_numpy()).tolist()
            ids = [xxhash.xxh3_64_intdigest(f"{i} {t}".encode("utf-8", "surrogatepass")) >> 1 if n and i is not None else i for i, t, n in zip(own, b.column("text").to_pylist(), new)]
            yield pa.record_batch([pa.array(ids, pa.int64()), b.column("text"), b.column("doc_id")], ["doc_id", "text", "own"])

    named = base.withColumn("slot", slot).mapInArrow(rename, "doc_id long, text string, own long")
    part = named.select("doc_id", "text")
    found = stored(_classes(part, *_described(part)).distinct().join(named.select("doc_id", "own"), "doc_id"), "renamed")
    low = found.groupBy("own").agg(F.min("component_id").alias("low"))
    roots = connected_components(found.join(low, "own").select(F.col("component_id").alias("a"), F.col("low").alias("b")))
    rooted = found.join(roots.withColumnRenamed("node", "component_id"), "component_id", "left").withColumn("root", F.coalesce("component", "component_id"))
    least = rooted.groupBy("root").agg(F.min("own").alias("component_id"))
    told = rooted.select("own", "n_shingles", "root").join(least, "root").select(F.col("own").alias("doc_id"), "n_shingles", "component_id")
    nameless = base.where("doc_id is null")
    return told.unionByName(_classes(nameless, *_described(nameless)))


def _described(base: DataFrame) -> tuple[DataFrame, object]:
    """(doc_id, n, key, start) of every row: size, digest and prefix of its set; and the order of the shingles."""
    order = base.sparkSession.sparkContext.broadcast(_frequent(base))  # BITS / 8 bytes

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rank = order.value
        for b in batches_of(batches, 256):
            sizes, keys, starts = [], [], []
            for doc, text in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist()):
                held = shingles(text)
                sizes.append(len(held))
                if doc is None or not len(held):
                    keys.append(None)
                    starts.append(None)
                    continue
                keys.append(hashlib.blake2b(held.tobytes(), digest_size=16).digest())
                first = held[np.lexsort((held, _sort_keys(held, rank)))][: prefix_size(len(held))]
                starts.append(first.view(np.int64))
            lists = pa.array(starts, pa.list_(pa.int64()))
            yield pa.record_batch([b.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()), lists], ["doc_id", "n", "key", "start"])

    return stored(base.mapInArrow(describe, "doc_id long, n long, key binary, start array<long>"), "shingles"), order


def _classes(base: DataFrame, described: DataFrame, order) -> DataFrame:
    # Most sets occur once; only those of the others are dealt by their digest, with what shares a bit with them.
    keyed = described.where("key is not null")
    several = keyed.groupBy("key").agg(F.count("*").alias("times")).where("times > 1").select(F.col("key").alias("id"))
    told = _marked(keyed, "key", several)
    reps = stored(
        told(0).select("key", F.col("doc_id").alias("rep"), "n", "start").unionByName(
            told(1).groupBy("key").agg(F.min("doc_id").alias("rep"), F.first("n").alias("n"), F.first("start").alias("start"))),
        "classes",
    )
    index = reps.select("rep", "n", F.posexplode("start").alias("pos", "token"))
    shared = stored(index.withColumn("members", F.count("*").over(Window.partitionBy("token"))).where("members > 1"), "shared")
    # The hub of a list is its most central member: the one whose prefix the most sets share.
    central = shared.groupBy("rep").agg((F.sum("members") / F.max(F.col("n") - F.ceil(F.col("n") * PERCENT / 100) + 1)).alias("fame"))
    hubs = shared.select("token", "rep").join(central, "rep").groupBy("token").agg(F.max(F.struct("fame", "rep"))["rep"].alias("hub"))
    lists = stored(shared.join(hubs, "token"), "lists")

    pairs = lists.where("rep != hub").select(F.least("rep", "hub").alias("a"), F.greatest("rep", "hub").alias("b")).distinct()
    pairs = stored(_possible(pairs, reps, order), "pairs")
    first = stored(_verified(pairs, _sets(base, pairs)), "compared")
    linked = F.col("both") * 100 >= F.col("whole") * PERCENT
    links = first.where(linked).select("a", "b")
    groups = connected_components(links)

    # Once more with other hubs, for lists whose members are still apart: groups of near copies that don't all
    # link with one hub grow together here, before anything meets more than a hub.
    large = lists.where("members > 2").select("token", "rep").join(groups.withColumnRenamed("node", "rep"), "rep", "left").select("token", "rep", F.coalesce("component", "rep").alias("part"))
    others = (
        large.groupBy("token").agg(F.min(_veiled("rep")).alias("hub"), F.min("part").alias("low"), F.max("part").alias("high"))
        .where("low != high").select("token", _veiled("hub").alias("hub"))
        .join(groups.select(F.col("node").alias("hub"), F.col("component").alias("at")), "hub", "left")
    )
    again = (
        large.join(others, "token").where(F.col("part") != F.coalesce("at", "hub"))
        .select(F.least("rep", "hub").alias("a"), F.greatest("rep", "hub").alias("b")).distinct()
        .join(pairs, ["a", "b"], "left_anti")
    )
    again = stored(_possible(again, reps, order), "again")
    if not again.isEmpty():
        second = stored(_verified(again, _sets(base, again)), "compared")
        links = links.unionByName(second.where(linked).select("a", "b"))
        groups = connected_components(links)

    # Members of lists with their component, the hub's, and their similarity to the hub where it is known.
    ends = [first.select(F.col(x).alias("rep"), F.col(y).alias("hub"), (F.col("both") / F.col("whole")).alias("near")) for x, y in ("ab", "ba")]
    known = ends[0].unionByName(ends[1]).groupBy("rep", "hub").agg(F.max("near").alias("near"))
    open_lists = (
        lists.where("members > 2 and rep != hub")
        .join(groups.select(F.col("node").alias("rep"), "component"), "rep", "left")
        .join(groups.select(F.col("node").alias("hub"), F.col("component").alias("at")), "hub", "left")
        .join(known, ["rep", "hub"], "left")
        .select("hub", "token", "rep", "n", "pos", F.coalesce("component", "rep").alias("part"), F.coalesce("at", "hub").alias("main"),
                F.coalesce("near", F.lit(0.0)).alias("near"), F.col("near").isNotNull().alias("sure"))
    )
    # A linking partner is at most 1 / t times as large: the same size class or the next.
    ratio = float(np.log(100 / PERCENT))
    open_lists = stored(open_lists.withColumn("block", F.floor(F.log(F.col("n").cast("double")) / ratio + 1e-9).cast("int")), "members")
    # What gathers around one hub, and is much, is compared in blocks of prefixes; the rest by shared members.
    around = stored(open_lists.groupBy("hub", "rep", "block").agg(F.first("part").alias("part"), F.max((F.col("part") != F.col("main")).cast("int")).alias("stray")), "around")
    crowds = (
        around.groupBy("hub").agg(F.count("*").alias("members"), F.sum("stray").alias("strays"))
        .where(F.col("members") * F.col("strays") >= CROWD).select("hub")
    )
    crowd = stored(around.join(crowds, "hub"), "crowd")
    if not crowd.isEmpty():
        starts = _starts(reps, crowd.select(F.col("rep").alias("a"), F.col("rep").alias("b")))
        links = stored(links.unionByName(_blocks(crowd, starts, base, order)), "links")
        groups = connected_components(links)
    sparse = open_lists.join(crowds, "hub", "left_anti")
    strays = sparse.where("part != main").withColumn("block", F.explode(F.array(F.col("block") - 1, F.col("block"), F.col("block") + 1)))
    s, o = strays.alias("s"), sparse.alias("o")
    need = F.ceil((F.col("s.n") + F.col("o.n")) * (PERCENT / (100.0 + PERCENT)) - 1e-6)
    bound = 1 + F.least(F.col("s.n") - F.col("s.pos"), F.col("o.n") - F.col("o.pos")) - 1
    apart = F.abs(F.col("s.near") - F.col("o.near")) > 1 - PERCENT / 100 + 1e-9
    rest = (
        s.join(o, (F.col("s.token") == F.col("o.token")) & (F.col("s.block") == F.col("o.block"))
               & (F.col("s.part") != F.col("o.part"))
               & ((F.col("o.part") == F.col("o.main")) | (F.col("s.rep") < F.col("o.rep")))
               & (F.col("s.n") * 100 >= F.col("o.n") * PERCENT) & (F.col("o.n") * 100 >= F.col("s.n") * PERCENT)
               & (bound + F.least("s.pos", "o.pos") >= need)
               & ~(F.col("s.sure") & F.col("o.sure") & apart))
        .select(F.least("s.rep", "o.rep").alias("a"), F.greatest("s.rep", "o.rep").alias("b"),
                *(F.when(F.col("s.rep") < F.col("o.rep"), F.col(f"{x}.{c}")).otherwise(F.col(f"{y}.{c}")).alias(f"{c}{k}")
                  for c in ("n", "pos") for k, x, y in (("a", "s", "o"), ("b", "o", "s"))))
    )
    # A pair that no hub has decided meets in every list that holds both, so that the rows count the common
    # members of the prefixes. Beyond its prefix, or its last common member, a set may share all the rest.
    shared = rest.groupBy("a", "b").agg(
        F.count("*").alias("c"), F.min("na").alias("la"), F.min("nb").alias("lb"), F.max("na").alias("na"), F.max("nb").alias("nb"),
        F.max("posa").alias("pa"), F.max("posb").alias("pb"),
    )
    beyond = lambda n: F.ceil(F.col(n) * PERCENT / 100) - 1
    bound = F.col("c") + F.greatest(
        F.least(beyond("na"), F.col("nb") - F.col("pb") - 1), F.least(F.col("na") - F.col("pa") - 1, beyond("nb"))
    )
    rest = shared.where(bound * (100 + PERCENT) >= (F.col("la") + F.col("lb")) * PERCENT).select("a", "b")
    rest = stored(_possible(rest, reps, order), "rest")
    if not rest.isEmpty():
        more = stored(_verified(rest, _sets(base, rest)).where(linked).select("a", "b"), "more")
        groups = connected_components(links.unionByName(more))

    classes = reps.select("key", "rep").join(groups.withColumnRenamed("node", "rep"), "rep", "left").select("key", F.coalesce("component", "rep").alias("class"))
    told = described.where("key is not null").join(classes, "key").select("doc_id", F.col("n").alias("n_shingles"), F.col("class").alias("component_id"))
    return told.unionByName(described.where("key is null").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id")))
