"""Near-duplicate vectors by a forest of random-projection trees."""

from __future__ import annotations

import hashlib
import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewave.llm.common import drawn, stored
from tidewave.llm.graph import connected_components

TREES = 12
#: Vectors nearer than this to a split (unit vectors) go to both sides.
SPILL = 0.015
#: Rows that a leaf should hold; leaves that can't be parted are compared in pairs of chunks of CHUNK rows.
LEAF = 384
CHUNK = 768
#: Vectors from which the splits of one forest are drawn. Every vector is indexed.
FIT_ROWS = 20_000
#: A leaf with more than LARGE times LEAF rows gets splits of its own, drawn from PART_ROWS of its vectors, in rounds.
LARGE, PART_ROWS = 4, 2_000


class Tree:
    """Splits by heap position: an inner node has a direction and a cut; others are leaves."""

    def __init__(self, sample: np.ndarray, least: int, rng: np.random.Generator, deepest: int = 24):
        self.dirs, self.cuts, self.leaf, self.kids = [], [], [], []
        self._grow(sample, least, rng, deepest)

    def _grow(self, rows: np.ndarray, least: int, rng: np.random.Generator, deepest: int) -> int:
        at = len(self.kids)
        for held, empty in ((self.dirs, None), (self.cuts, 0.0), (self.kids, None)):
            held.append(empty)
        if len(rows) <= least or deepest == 0:
            return at
        best = None
        for _ in range(6):  # of a few random splits, take the one that the fewest vectors lie near
            way = rng.standard_normal(rows.shape[1])
            way /= np.linalg.norm(way)
            along = rows @ way
            cut = float(np.quantile(along, rng.uniform(0.35, 0.65)))
            near = float(np.mean(np.abs(along - cut) <= 2 * SPILL))
            if along.min() < cut < along.max() and (best is None or near < best[0]):
                best = near, way, cut, along
        if best is None or best[0] > 0.6:  # one tight cluster: a split would only part neighbours
            return at
        _, way, cut, along = best
        self.dirs[at], self.cuts[at] = way, cut
        left = self._grow(rows[along <= cut + SPILL], least, rng, deepest - 1) if (along <= cut + SPILL).sum() < len(rows) else None
        right = self._grow(rows[along > cut - SPILL], least, rng, deepest - 1) if (along > cut - SPILL).sum() < len(rows) else None
        if left is None or right is None:
            self.dirs[at] = None
        else:
            self.kids[at] = (left, right)
        return at

    def leaves(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, leaf) of every leaf that each row falls into."""
        out, todo = [], [(0, np.arange(len(rows)))]
        while todo:
            node, idx = todo.pop()
            if self.kids[node] is None or not len(idx):
                out.append((idx, np.full(len(idx), node)))
                continue
            along = rows[idx] @ self.dirs[node]
            todo.append((self.kids[node][0], idx[along <= self.cuts[node] + SPILL]))
            todo.append((self.kids[node][1], idx[along > self.cuts[node] - SPILL]))
        return np.concatenate([x for x, _ in out]), np.concatenate([y for _, y in out])


def _unit(vector: list | None) -> np.ndarray | None:
    """The unit vector in double precision, or None where it can't be compared. Scaling first keeps squares in range."""
    if not vector or any(x is None for x in vector):
        return None
    x = np.asarray(vector, dtype=np.float64)
    most = np.abs(x).max()
    if not np.isfinite(most) or most == 0:
        return None
    x = x / most
    return x / np.sqrt(x @ x)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        units = [None if (x := _unit(v)) is None else x.tobytes() for v in b.column("embedding").to_pylist()]
        keys = [None if u is None else hashlib.blake2b(u, digest_size=16).digest() for u in units]
        width = [0 if u is None else len(u) // 8 for u in units]
        yield pa.record_batch([b.column("vec_id"), pa.array(keys, pa.binary()), pa.array(units, pa.binary()), pa.array(width, pa.int32())], ["vec_id", "key", "unit", "width"])


def _compare(least: float):
    def compare(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        leaf, first, second = key
        left = np.frombuffer(b"".join(rows["unit"]), dtype=np.float64).reshape(len(rows), -1)
        ids, copies, chunk = rows["node"].to_numpy(), rows["copies"].to_numpy(), rows["chunk"].to_numpy()
        # What a pair shares before this leaf has counted it already.
        names = {}
        spots = [(i, names.setdefault(x, len(names))) for i, held in enumerate(rows["leaves"]) for x in held if x < leaf]
        earlier = np.zeros((len(rows), max(1, len(names))), dtype=np.float32)
        if spots:
            i, j = np.array(spots).T
            earlier[i, j] = 1
        a = np.flatnonzero(chunk == first)
        b = a if first == second else np.flatnonzero(chunk == second)
        near = left[a] @ left[b].T >= least
        near &= earlier[a] @ earlier[b].T < 0.5
        if first == second:
            np.fill_diagonal(near, False)
        links = np.zeros(len(rows), dtype=np.int64)
        links[a] += near @ copies[b]
        if first != second:
            links[b] += near.T @ copies[a]
        low = np.arange(len(rows))
        while True:  # smallest position reachable within this group
            at_a = np.where(near, low[b][None, :], len(rows)).min(axis=1, initial=len(rows))
            at_b = np.where(near, low[a][:, None], len(rows)).min(axis=0, initial=len(rows))
            new = low.copy()
            new[a] = np.minimum(new[a], at_a)
            new[b] = np.minimum(new[b], at_b)
            new = new[new]
            if (new == low).all():
                break
            low = new
        keep = links > 0
        return pd.DataFrame({"node": ids[keep], "links": links[keep], "root": ids[low][keep]})

    return compare


def near_vectors(embeddings: DataFrame, least: float = 0.9) -> DataFrame:
    """Near-duplicate classes of all vectors by cosine >= ``least`` in double precision.

    Equal unit vectors form one class first. A bounded sample of FIT_ROWS vectors places the splits of TREES
    random-projection trees; every vector then falls down every tree, into both children near a split. Leaves that
    come out large, as they do where there are many more vectors than the sample, are split again, round by round, each
    from a sample of its own that Spark gathers by leaf, so that leaves don't grow with the table. What can't be parted
    is compared as pairs of chunks, so a hot leaf spreads over tasks, and no pair leaves its task: a pair counts in
    the first leaf that it shares, and only links to local roots go on to connected components.

    Columns: vec_id, n_links, component_id, kept. A vector that is null, empty, zero, or holds null or non-finite
    components links with nothing. Vectors of different widths have no cosine; each width has a forest of its own, so
    widths must be few. Rows that repeat a vec_id each give a row; rows without a vec_id link with nothing. Empty input
    gives an empty result; other columns are ignored.
    """
    spark = embeddings.sparkSession
    rows = stored(embeddings.select("vec_id", "embedding").mapInArrow(_digests, "vec_id long, key binary, unit binary, width int"), "units")
    reps = (
        rows.where("key is not null and vec_id is not null").groupBy("key")
        .agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies"), F.first("unit").alias("unit"), F.first("width").alias("width"))
    )
    # Ids that several different vectors bear stand for one row each; a digest tells these apart.
    reps = stored(reps.withColumn("node", F.xxhash64("key")), "reps")
    forests = {r["width"]: _forest(reps.where(F.col("width") == r["width"]), r["width"], r["n"]) for r in reps.groupBy("width").agg(F.count("*").alias("n")).collect()}
    held = spark.sparkContext.broadcast(forests)  # for each width, TREES * FIT_ROWS / 8 nodes at most

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            width = b.column("width").to_numpy()
            for w in np.unique(width).tolist():
                part = b.take(pa.array(np.flatnonzero(width == w)))
                x = np.frombuffer(b"".join(part.column("unit").to_pylist()), dtype=np.float64).reshape(part.num_rows, w)
                who, leaf = [], []
                for t, tree in enumerate(held.value[w]):
                    i, k = tree.leaves(x)
                    who.append(i)
                    leaf.append(k + (t + TREES * w) * (1 << 32))
                yield _listed(part, np.concatenate(who), np.concatenate(leaf))

    shape = "node long, copies long, unit binary, leaves array<long>"
    placed = stored(reps.select("node", "copies", "unit", "width").mapInArrow(assign, shape), "placed")
    sizes = placed.select(F.explode("leaves").alias("leaf")).groupBy("leaf").count()
    fresh = sizes.where(F.col("count") > LARGE * LEAF)
    while not fresh.isEmpty():
        placed, fresh, sizes = _split(placed, fresh, sizes, shape)
    chunks = sizes.select("leaf", F.ceil(F.col("count") / CHUNK).cast("int").alias("chunks"))
    each = (
        placed.select("*", F.explode("leaves").alias("leaf")).join(chunks, "leaf")
        .withColumn("chunk", F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
        .select("leaf", F.least("chunk", "other").alias("one"), F.greatest("chunk", "other").alias("two"), "chunk", "node", "copies", "unit", "leaves")
    )
    parts = each.groupBy("leaf", "one", "two").applyInPandas(_compare(least), "node long, links long, root long")
    found = stored(parts.groupBy("node", "root").agg(F.sum("links").alias("links")), "found")
    # Vectors that share an id are one vector in the classes, and so in what is reachable.
    shared = rows.where("key is not null and vec_id is not null").groupBy("vec_id").agg(F.min("key").alias("low"), F.max("key").alias("high")).where("low != high").select("vec_id")
    again = rows.join(shared, "vec_id", "left_semi").select("vec_id", F.xxhash64("key").alias("node"))
    own = again.join(again.groupBy("vec_id").agg(F.min("node").alias("first")), "vec_id").select(F.col("node").alias("a"), F.col("first").alias("b"))
    classes = connected_components(found.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(own))
    degree = found.groupBy("node").agg(F.sum("links").alias("links"))
    summary = stored(
        reps.select("key", "node", "rep", "copies").join(degree, "node", "left").join(classes, "node", "left")
        .select("key", "rep", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "node").alias("class")), "summary",
    )
    low = summary.groupBy("class").agg(F.min("rep").alias("component_id"))
    told = summary.join(low, "class").select("key", "n_links", "component_id")
    linked = F.col("key").isNotNull() & F.col("vec_id").isNotNull()
    return (
        rows.where(linked).join(told, "key").select("vec_id", "n_links", "component_id")
        .unionByName(rows.where(~linked).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")))
        .withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
    )


def _forest(reps: DataFrame, width: int, total: int) -> list[Tree]:
    """Trees whose splits come from at most FIT_ROWS of the vectors."""
    units = sorted(bytes(r["unit"]) for r in drawn(reps.select("key", "unit"), "key", FIT_ROWS).select("unit").collect())
    sample = np.frombuffer(b"".join(units), dtype=np.float64).reshape(len(units), width)
    rng = np.random.default_rng(7)
    return [Tree(sample, max(8, int(LEAF * len(sample) / max(1, total))), rng) for _ in range(TREES)]


def _listed(part: pa.RecordBatch, who: np.ndarray, leaf: np.ndarray) -> pa.RecordBatch:
    """Rows with the sorted list of their leaves, from (row, leaf)."""
    order = np.lexsort((leaf, who))
    offsets = np.searchsorted(who[order], np.arange(part.num_rows + 1)).astype(np.int32)
    lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(leaf[order], pa.int64()))
    return pa.record_batch([part.column("node"), part.column("copies"), part.column("unit"), lists], ["node", "copies", "unit", "leaves"])


def _grow(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    """A tree for one large leaf from its sample, pickled; none where its vectors can't be parted."""
    units = sorted(rows["unit"])
    x = np.frombuffer(b"".join(units), dtype=np.float64).reshape(len(units), -1)
    tree = Tree(x, max(8, int(LEAF * len(x) / int(rows["count"].iloc[0]))), np.random.default_rng(abs(int(key[0])) % (1 << 32)))
    return pd.DataFrame({"leaf": [key[0]], "tree": [pickle.dumps(tree)]}) if tree.kids[0] is not None else pd.DataFrame({"leaf": pd.Series([], dtype="int64"), "tree": []})


def _split(placed: DataFrame, fresh: DataFrame, sizes: DataFrame, shape: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Every leaf in ``fresh`` (leaf, count) split by a tree of its own: rows with their new leaves, those to split again, all sizes.

    A leaf's tree comes from about PART_ROWS of its vectors and meets them in a join on the leaf, in as many parts as it has
    rows for, so that no task gets a whole leaf. New leaves are numbered by a hash of the old one and the place in its tree.
    """
    listed = placed.select("*", F.explode("leaves").alias("leaf")).join(fresh, "leaf")
    sample = listed.where(F.pmod(F.xxhash64("node", "leaf"), F.col("count")) < PART_ROWS).select("leaf", "count", "unit")
    trees = stored(sample.groupBy("leaf").applyInPandas(_grow, "leaf long, tree binary"), "trees")
    spread = F.greatest(F.lit(1), F.ceil(F.col("count") / (8 * LARGE * LEAF))).cast("int")
    parted = fresh.join(trees.select("leaf"), "leaf").select("leaf", spread.alias("parts"))
    mine = listed.join(parted, "leaf").select("node", "unit", "leaf", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int").alias("part"))
    each = mine.groupBy("leaf", "part").cogroup(
        trees.join(parted, "leaf").select("leaf", "tree", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")).groupBy("leaf", "part")
    )
    moved = stored(each.applyInPandas(_move, "node long, leaf long, new long"), "moved")
    changed = moved.groupBy("node").agg(F.collect_set("leaf").alias("gone"), F.collect_set("new").alias("come"))  # TREES leaves and their parts
    after = placed.join(changed, "node", "left").select(
        "node", "copies", "unit",
        F.when(F.col("gone").isNull(), F.col("leaves")).otherwise(F.array_sort(F.array_distinct(F.concat(F.array_except("leaves", "gone"), "come")))).alias("leaves"),
    )
    after = stored(after, "placed")
    counts = moved.groupBy(F.col("new").alias("leaf")).count()
    whole = stored(sizes.join(parted, "leaf", "left_anti").unionByName(counts), "sizes")
    again = whole.join(counts.select("leaf"), "leaf", "left_semi").where(F.col("count") > LARGE * LEAF)
    return after, again, whole


def _move(rows: pd.DataFrame, trees: pd.DataFrame) -> pd.DataFrame:
    if not len(rows) or not len(trees):
        return pd.DataFrame({"node": pd.Series([], dtype="int64"), "leaf": pd.Series([], dtype="int64"), "new": pd.Series([], dtype="int64")})
    x = np.frombuffer(b"".join(rows["unit"]), dtype=np.float64).reshape(len(rows), -1)
    who, place = pickle.loads(trees["tree"].iloc[0]).leaves(x)
    old = int(rows["leaf"].iloc[0])
    names = {k: int.from_bytes(hashlib.blake2b(f"{old} {k}".encode(), digest_size=8).digest(), "little", signed=True) for k in np.unique(place).tolist()}
    return pd.DataFrame({"node": rows["node"].to_numpy()[who], "leaf": old, "new": [names[k] for k in place.tolist()]})
