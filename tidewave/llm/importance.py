"""Resampling of documents towards a target text: hashed word and word-pair counts weigh them, Gumbel noise draws them.

Features are hashed by a byte automaton over Arrow's UTF-8 buffers: a lookup table gives the class of every byte,
differences of the classes give the borders of words, and one step of a table-driven CRC is taken for all words of a block
at the same time, byte after byte. No text becomes a Python string.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewave.llm.common import stored

BUCKETS = 10_000
#: Bytes of text that are classified and hashed at a time, and the number of words from which on a step for all pays.
BLOCK, FEW = 1 << 21, 24

LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32
#: Bytes of words after lowering: digits, a-z and all bytes of characters beyond ASCII.
WORD = np.zeros(256, dtype=bool)
WORD[ord("0") : ord("9") + 1] = WORD[ord("a") : ord("z") + 1] = WORD[128:] = True


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1)
    return table


CRC = _crc_table()
FRESH = np.uint32(0xFFFFFFFF)  # the state before any byte; a CRC is the state's complement


def _step(state: np.ndarray, byte: np.ndarray | np.uint8) -> np.ndarray:
    return CRC[(state ^ byte) & 255] ^ (state >> np.uint32(8))


def _advance(state: np.ndarray, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """States after the ``sizes`` bytes at ``starts``. Words go by falling size, so that those still running come first."""
    key = np.minimum(sizes, 65535).astype(np.uint16)
    order = np.argsort(key, kind="stable")[::-1]
    place, size, running = starts[order], sizes[order], state[order]
    longer = len(key) - np.cumsum(np.bincount(key, minlength=1))  # words of more bytes than the index
    at = 0
    while at < len(longer) and at < 65535 and longer[at] > FEW:
        live = longer[at]
        running[:live] = _step(running[:live], data[place[:live] + at])
        at += 1
    for i in range(int(longer[at]) if at < len(longer) else int((size > at).sum())):  # the few words that are longer
        rest = zlib.crc32(data[place[i] + at : place[i] + size[i]].tobytes(), int(running[i] ^ FRESH))
        running[i] = np.uint32(rest) ^ FRESH
    out = np.empty_like(running)
    out[order] = running
    return out


def _blocks(data: np.ndarray, begin: int, end: int) -> Iterator[tuple[int, int]]:
    """Blocks of about BLOCK bytes that end before a byte that is in no word."""
    while begin < end:
        stop, reach = min(begin + BLOCK, end), 256
        while stop < end:
            gap = np.flatnonzero(~WORD[LOWER[data[stop : stop + reach]]])
            if len(gap):
                stop += int(gap[0])
                break
            stop, reach = min(stop + reach, end), reach * 2
        yield begin, stop
        begin = stop


def hashed(texts: pa.Array, buckets: int = BUCKETS) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Features of an Arrow array of strings, in blocks: (text and bucket of each word, text and bucket of each pair)."""
    wide = pa.types.is_large_string(texts.type)
    _, places, bytes_ = texts.buffers()
    offsets = np.frombuffer(places, dtype=np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    if not len(texts) or bytes_ is None:
        return
    raw = np.frombuffer(bytes_, dtype=np.uint8)
    old_text, old_state = np.array([-1]), np.array([FRESH])  # the last word of the block before
    for begin, end in _blocks(raw, int(offsets[0]), int(offsets[-1])):
        data = LOWER[raw[begin:end]]
        word = np.zeros(end - begin + 2, dtype=np.int8)
        word[1:-1] = WORD[data]
        turns = np.diff(word)  # 1 where a word begins, -1 behind its end
        starts, ends = turns[:-1] == 1, turns[1:] == -1
        borders = offsets[np.searchsorted(offsets, begin, "right") : np.searchsorted(offsets, end, "left")] - begin
        starts[borders] = word[1:-1][borders] == 1  # texts follow each other without a gap
        ends[borders - 1] = word[1:-1][borders - 1] == 1
        start = np.flatnonzero(starts)
        if not len(start):
            continue
        size = np.flatnonzero(ends) + 1 - start
        text = np.searchsorted(offsets, start + begin, "right") - 1
        state = _advance(np.full(len(start), FRESH), data, start, size)
        before_text, before = np.concatenate((old_text, text[:-1])), np.concatenate((old_state, state[:-1]))
        pair = np.flatnonzero(before_text == text)
        joined = _advance(_step(before[pair], np.uint8(32)), data, start[pair], size[pair])
        yield text, (state ^ FRESH) % np.uint32(buckets), text[pair], (joined ^ FRESH) % np.uint32(buckets)
        old_text, old_state = text[-1:], state[-1:]


def bucket_counts(texts: DataFrame, column: str = "text", buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n): how many features of all texts fall into each bucket. A task sends at most one row a bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for _, words, _, pairs in hashed(batch.column(0), buckets):
                counts += np.bincount(words, minlength=buckets) + np.bincount(pairs, minlength=buckets)
        held = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(held.astype(np.int32)), pa.array(counts[held])], names=["bucket", "n"])

    return texts.select(column).mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(docs: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Each bucket's gain: 1000 times the logarithm of its share in the target over that in the documents, rounded down."""
    seen = {r["bucket"]: r["n"] for r in bucket_counts(docs, buckets=buckets).collect()}  # `buckets` rows at most
    wanted = {r["bucket"]: r["n"] for r in bucket_counts(target, buckets=buckets).collect()}
    s, t = float(sum(seen.values()) + buckets), float(sum(wanted.values()) + buckets)
    share = (((wanted.get(b, 0) + 1.0) * s) / ((seen.get(b, 0) + 1.0) * t) for b in range(buckets))
    return np.array([math.floor(1000 * math.log(x)) for x in share], dtype=np.int64)


def weighed(docs: DataFrame, gain: np.ndarray) -> DataFrame:
    """(doc_id, n_words, n_features, weight): the floored mean gain of each document's features, 0 where it has none."""
    shared = docs.sparkSession.sparkContext.broadcast(gain)  # one number a bucket

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for batch in batches:
            n = batch.num_rows
            words, pairs, total = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64)
            for of_word, word, of_pair, pair in hashed(batch.column("text"), len(table)):
                words += np.bincount(of_word, minlength=n)
                pairs += np.bincount(of_pair, minlength=n)
                np.add.at(total, of_word, table[word])
                np.add.at(total, of_pair, table[pair])
            features = words + pairs
            mean = np.where(features > 0, total // np.maximum(features, 1), 0)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *map(pa.array, (words, features, mean))], names=["doc_id", "n_words", "n_features", "weight"])

    columns = [T.StructField("doc_id", docs.schema["doc_id"].dataType), *(T.StructField(c, T.LongType()) for c in ("n_words", "n_features", "weight"))]
    return docs.select("doc_id", "text").mapInArrow(run, T.StructType(columns))


def noise(seed: int) -> Column:
    """Gumbel noise in thousandths, drawn by the hash of ``seed`` and doc_id; null without a doc_id."""
    drawn = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.col("doc_id").cast("string")), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((drawn + 0.5) / 4294967296.0)))


def resampled(docs: DataFrame, target: DataFrame, percent: int = 25, least_words: int = 20, seed: int = 7, buckets: int = BUCKETS) -> DataFrame:
    """Draw ``percent`` of the documents of at least ``least_words`` words, by weight plus noise.

    ``docs`` (doc_id, text) and ``target`` (text) may have further columns, which are ignored. Words are runs of digits, letters
    a-z after lower-casing A-Z, and characters beyond ASCII. Returns doc_id, n_features, weight, score and rank (1 for the
    highest score, ties to the smaller doc_id; null where not drawn) of every row. A null text has no features. A row
    without doc_id has a weight, but neither score nor rank, and isn't counted among those to draw from. Rows that repeat
    a doc_id count as rows of their own. Without documents there is no row; an empty target counts 0 in each bucket.

    Ranks need no order over all rows: scores are integers in a narrow range, whatever the number of rows, so counts
    of higher scores (one row a value) give every rank but for the order of the rows of one score. The noise spreads
    equal weights over thousands of values, so that no score holds more than about one row in 2700.
    """
    # Stored since three steps read it.
    scored = stored(weighed(docs, gains(docs, target, buckets)).withColumn("score", F.col("weight") + noise(seed)), "scores")
    may = scored.where((F.col("n_words") >= least_words) & F.col("score").isNotNull())
    counts = may.groupBy("score").agg(F.count("*").alias("n"))
    draw = percent * (counts.agg(F.sum("n")).first()[0] or 0) // 100
    higher = counts.withColumn("above", F.sum("n").over(Window.orderBy(F.desc("score"))) - F.col("n")).drop("n")
    # Bounded: weights lie within +-1000 * ln(2^63), the noise within -3100 and 22900, hence at most 115000 rows of two numbers.
    joined = scored.join(F.broadcast(higher), "score", "left")
    near = (F.col("n_words") >= least_words) & F.coalesce(F.col("above") < draw, F.lit(False))
    place = F.col("above") + F.row_number().over(Window.partitionBy("score").orderBy("doc_id"))
    ranked = joined.where(near).withColumn("place", place).withColumn("rank", F.when(F.col("place") <= draw, F.col("place")))
    rest = joined.where(~near).withColumn("rank", F.lit(None).cast("long"))
    columns = ["doc_id", "n_features", "weight", "score", "rank"]
    return ranked.select(*columns).unionByName(rest.select(*columns))
