"""How filters of documents act together, in every order: what each removes, removes alone, or finds gone already.

Exact duplicates are found by refining a partition: texts of equal length, then of equal hashes of one block after the
other, without those that stand alone; the texts that are left are compared in full.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import permutations
from math import factorial

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewave.llm.common import BITS, bit_of, bitmap, stored

FILTERS = "ABCDE"
#: Code points of the blocks that are hashed one after the other; the last block is all that follows.
BLOCKS = (64, 512, 4096)
#: A class of equal texts is dealt over so many keys when its documents are marked.
SALTS = 16

#: What makes a class: the length and the hash of each block.
KEYS = ["length", *(f"h{i}" for i in range(len(BLOCKS) + 1))]

SPACES = "[\\x20\\x09-\\x0D]+"


def failures(text: Column) -> Column:
    """Bits of the filters A to D that a text fails: short, repetitive, capitals, marks."""
    words = F.array_remove(F.split(text, SPACES), "")
    capitals = F.regexp_count(text, F.lit("[A-Z]"))
    tests = [
        F.size(words) < 200,
        100 * F.size(F.array_distinct(words)) < 50 * F.size(words),
        100 * capitals > 2 * F.length(text),
        text.rlike("[#$%&*|]"),
    ]
    return sum((F.when(test, 1 << i).otherwise(0) for i, test in enumerate(tests)), F.lit(0))


def _hashes(text: Column, hash_of: Callable[[Column], Column]) -> list[Column]:
    starts = [1]
    for size in BLOCKS:
        starts.append(starts[-1] + size)
    sizes = [*BLOCKS, (1 << 31) - 1 - starts[-1]]
    return [hash_of(F.substring(text, start, size)).alias(f"h{i}") for i, (start, size) in enumerate(zip(starts, sizes))]


def duplicates(docs: DataFrame, hash_of: Callable[[Column], Column] = F.xxhash64) -> tuple[DataFrame, DataFrame | None]:
    """Classes of equal texts, as rows (KEYS, first) with the smallest doc_id, of texts that several rows hold.

    Classes whose texts differ in spite of equal hashes come second, as rows (KEYS, text, first) for each text that is
    repeated (text null where none is); None if there are none.
    """
    text, keys = F.coalesce("text", F.lit("")), KEYS
    keyed = docs.select("doc_id", F.length(text).alias("length"), *_hashes(text, hash_of), text.alias("text"))
    # Copies are counted where they are read, so that a group of any size is one row from here on.
    cells = stored(keyed.groupBy(*keys).agg(F.count("*").alias("n")), "cells")
    for depth in range(1, len(keys) + 1):
        shared = keys[:depth]
        groups = cells.groupBy(*shared).agg(F.sum("n").alias("held")).where("held > 1").select(*shared)
        cells = stored(cells.join(groups, shared, "left_semi"), "cells")

    slot = F.pmod(F.xxhash64(*keys), F.lit(BITS))
    marks = docs.sparkSession.sparkContext.broadcast(bitmap(cells.select(slot.alias("slot"))))
    may = keyed.withColumn("slot", slot)

    def left(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.filter(pa.array(bit_of(marks.value, b.column("slot").to_numpy()) == 1))

    # A bit may stand for other classes too; grouping by the whole text is exact all the same.
    texts = may.mapInArrow(left, may.schema).groupBy(*keys, "text").agg(F.min("doc_id").alias("first"), F.count("*").alias("n"))
    one = F.count("*").alias("n_texts"), F.sum("n").alias("held"), F.min("first").alias("first")
    classes = stored(texts.groupBy(*keys).agg(*one).where("held > 1").drop("held"), "classes")
    mixed = classes.where("n_texts > 1").select(*keys)
    if mixed.isEmpty():
        return classes.drop("n_texts"), None
    firsts = texts.where("n > 1").join(mixed, keys, "left_semi").drop("n")
    return classes.where("n_texts = 1").drop("n_texts"), stored(mixed.join(firsts, keys, "left"), "mixed")


def masks(docs: DataFrame, hash_of: Callable[[Column], Column] = F.xxhash64) -> DataFrame:
    """(doc_id, part, mask) of every row: bit i of the mask tells that filter i of ABCDE fails.

    E fails where a smaller doc_id holds the same text; a row without doc_id neither fails E nor makes others fail it,
    and rows that repeat a doc_id don't fail it by each other. Null texts are empty, a null source is the part ''.
    """
    classes, mixed = duplicates(docs, hash_of)
    text = F.coalesce("text", F.lit(""))
    slim = docs.select(
        "doc_id", F.coalesce("source", F.lit("")).alias("part"), failures(text).alias("mask"), F.length(text).alias("length"), *_hashes(text, hash_of),
        *([text.alias("text")] if mixed is not None else []),
    )
    # Documents of a class go over SALTS keys, each of which has the class's row.
    plain = classes.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salted = slim.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int"))
    if mixed is None:
        joined = salted.join(plain, [*KEYS, "salt"], "left")
    else:
        unlike = mixed.select(*KEYS).distinct()
        alike = salted.join(unlike, KEYS, "left_anti").drop("text").join(plain, [*KEYS, "salt"], "left")
        joined = alike.unionByName(salted.join(unlike, KEYS, "left_semi").join(mixed, [*KEYS, "text"], "left").drop("text"))
    repeated = F.coalesce(F.col("doc_id") > F.col("first"), F.lit(False))
    return joined.select("doc_id", "part", (F.col("mask") + F.when(repeated, 16).otherwise(0)).alias("mask"))


def audit(docs: DataFrame, labels: DataFrame, hash_of: Callable[[Column], Column] = F.xxhash64) -> DataFrame:
    """Counts of each filter at each step of all 120 orders, by part (the source).

    ``docs`` (doc_id, text, source), ``labels`` (doc_id, quality, toxic; a document counts as good or toxic if any of its rows
    says so, one without doc_id never does); further columns are ignored. Returns part, filter_order, step (1 to 5; the filter is that letter of the
    order), kept, removed, redundant (fails, but is gone), unique_fails (fails this filter only), good_lost, toxic_lost and
    shapley (removed by this filter, summed over all orders). Every part has all 600 rows; an empty table gives none.

    Documents are counted by part and mask first, at most 32 rows a part. A filter removes the same documents in every
    order that puts the same filters before it, so 80 sums a part hold what all 600 rows need.
    """
    marked = masks(docs, hash_of)
    told = labels.where("doc_id is not null").groupBy("doc_id").agg(
        F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("good"), F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic")
    )
    counts = marked.join(told, "doc_id", "left").groupBy("part", "mask").agg(
        F.count("*").alias("n"), F.sum(F.coalesce("good", F.lit(0))).alias("good"), F.sum(F.coalesce("toxic", F.lit(0))).alias("toxic")
    )

    # (bit, filters before it, number of orders with just these before it)
    states = [(i, before, factorial(before.bit_count()) * factorial(4 - before.bit_count())) for i in range(5) for before in range(32) if not before >> i & 1]
    state = F.explode(F.array(*(F.struct(F.lit(i).alias("i"), F.lit(b).alias("before"), F.lit(w).alias("orders")) for i, b, w in states))).alias("state")
    sums = counts.select("*", state).select("part", "mask", "n", "good", "toxic", "state.*").withColumn("bit", F.expr("shiftleft(1, i)"))
    sums = sums.withColumn("fails", F.expr("(mask & bit) != 0")).withColumn("here", F.expr("fails and (mask & before) = 0"))

    def of(test: str, column: str) -> Column:
        return F.sum(F.when(F.expr(test), F.col(column)).otherwise(0))

    sums = sums.groupBy("part", "i", "before", "orders").agg(
        of("(mask & (before | bit)) = 0", "n").alias("kept"), of("here", "n").alias("removed"), of("fails and not here", "n").alias("redundant"),
        of("mask = bit", "n").alias("unique_fails"), of("here", "good").alias("good_lost"), of("here", "toxic").alias("toxic_lost"),
    )
    by_filter = sums.groupBy("part", "i").agg(F.sum(F.col("removed") * F.col("orders")).alias("shapley"))

    steps = []
    for order in map("".join, permutations(FILTERS)):
        for step, letter in enumerate(order, 1):
            steps.append((FILTERS.index(letter), sum(1 << FILTERS.index(x) for x in order[: step - 1]), order, step))
    places = docs.sparkSession.createDataFrame(steps, "i int, before int, filter_order string, step int")  # 600 rows
    found = sums.join(by_filter, ["part", "i"]).join(F.broadcast(places), ["i", "before"])
    return found.select("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
