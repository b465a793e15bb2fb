"""Benchmark decontamination: rare pairs of words as seeds, then Smith-Waterman alignment of words."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewave.llm.common import batches_of

#: Alignment scores of words, and the share of an item's perfect score that makes a copy.
MATCH, MISMATCH, GAP, COPY = 2.0, -1.0, -1.0, 0.5
#: Items sent to the executors at once, and their words; a larger benchmark is scanned in blocks of this size.
BLOCK_ITEMS, BLOCK_WORDS = 20_000, 2_000_000

_MARKS = bytes.maketrans(bytes(i for i in range(33, 127) if not chr(i).isalnum()), b" " * sum(not chr(i).isalnum() for i in range(33, 127)))
_K = np.uint64(0x9E3779B97F4A7C15)


def plain_words(text: str | None) -> list[bytes]:
    """Lower-cased words; ASCII marks part them."""
    return text.lower().encode("utf-8", "surrogatepass").translate(_MARKS).split() if text else []


def align(item: np.ndarray, window: np.ndarray) -> tuple[float, int, int]:
    """Smith-Waterman with linear gaps: best local score, and where in ``window`` it begins and ends."""
    width = len(window)
    steps = np.arange(width + 1) * GAP
    row, begin = np.zeros(width + 1), np.arange(width + 1)
    best = (0.0, 0, 0)
    for word in item:
        gain = np.where((window == word) & (word >= 0), MATCH, MISMATCH)
        cross, up = row[:-1] + gain, row[1:] + GAP
        take = cross >= up
        new = np.concatenate([[0.0], np.maximum(np.where(take, cross, up), 0)])
        start = np.concatenate([[0], np.where(take, begin[:-1], begin[1:])])
        start = np.where(new > 0, start, np.arange(width + 1))
        run = np.maximum.accumulate(new - steps)
        side = run + steps
        if (side > new).any():  # gaps along the window: carry the start of the cell that they come from
            source = np.maximum.accumulate(np.where(new - steps >= run, np.arange(width + 1), 0))
            start = np.where(side > new, start[source], start)
            new = side
        row, begin = new, start
        top = int(row.argmax())
        if row[top] > best[0]:
            best = (float(row[top]), int(begin[top]), top)
    return best


def least_seeds(words: int, least: float) -> int:
    """Places of an item of so many words that every alignment of ``least`` of its perfect score shares with the text.

    A place is shared if its word and one of the next two of the item are a word and one of its next two of the text.
    With m matches and e errors the score is at least 2m - e >= S = 2 * least * words; of the m - 1 steps from match to
    match, those with one error at most share a place, and the others, with two errors or more, are m - S / 2 at most.
    """
    return max(1, int(np.ceil(least * words - 1 - 1e-9)))


class Index:
    """Seeds of a block of items: sorted codes of word pairs, and the items that each belongs to.

    Of the places of an item the commonest are left out, as many as leave every copy ``least_hits`` others.
    """

    def __init__(self, items: list[tuple[int, list[bytes]]], vocabulary: dict[bytes, int], seen: np.ndarray, total: int, least: float):
        self.vocabulary, self.least = vocabulary, least
        self.ids = [i for i, _ in items]
        self.words = [np.array([vocabulary[w] for w in words], dtype=np.int64) for _, words in items]
        self.pairs = [self.codes(ids)[1] for ids in self.words]
        lengths = np.array([len(ids) for ids in self.words])
        self.need = np.array([least_seeds(n, least) for n in lengths])
        self.least_hits = -(-self.need // 2)
        #: Words of a text that an alignment reaches over at most: m + e <= 3 * words - S.
        self.span = np.ceil(lengths * max(1.0, 3 - 2 * least)).astype(np.int64)
        self.single = bool((lengths == 1).any())
        share = (seen + 1.0) / (total + len(seen) + 1.0)
        code, item = [], []
        for k, ids in enumerate(self.words):
            s = np.concatenate([share[ids], [0.0, 0.0]])
            chance = s[:-2] * (s[1:-1] + s[2:])
            places = max(1, len(ids) - 1)
            rarest = np.argsort(chance[:places], kind="stable")[: places - (self.need[k] - self.least_hits[k])]
            at, own = self.codes(ids)
            own = np.unique(own[np.isin(at, rarest)])
            code.append(own)
            item.append(np.full(len(own), k))
        code, item = np.concatenate(code), np.concatenate(item)
        order = np.argsort(code, kind="stable")
        self.code, self.item = code[order], item[order]
        self.bits = min(28, 5 + max(11, len(code).bit_length()))
        self.sieve = np.zeros(1 << self.bits, dtype=bool)
        self.sieve[self.slots(self.code)] = True

    def slots(self, code: np.ndarray) -> np.ndarray:
        return (code.astype(np.uint64) * _K) >> np.uint64(64 - self.bits)

    def codes(self, ids: np.ndarray, single: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """Places, and the codes of their word with each of the next two; unknown words (-1) have none. An item of one word is that word."""
        width, found = len(self.vocabulary), []
        for d in (1, 2):
            at = np.flatnonzero((ids[:-d] >= 0) & (ids[d:] >= 0))
            found.append((at, ids[at] * width + ids[at + d]))
        if single or len(ids) == 1:
            at = np.flatnonzero(ids >= 0)
            found.append((at, ids[at] + width * width))
        return tuple(np.concatenate(x) for x in zip(*found))

    def windows(self, ids: np.ndarray, starts: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
        """(text, item, begin, end) of every part of a text that shares enough places with an item.

        ``ids`` are the words of texts with two -1 behind each, and ``starts`` where each begins, and the end.
        """
        at, code = self.codes(ids, self.single)
        some = np.flatnonzero(self.sieve[self.slots(code)])
        at, code = at[some], code[some]
        low = np.searchsorted(self.code, code)
        count = np.searchsorted(self.code, code, side="right") - low
        own = np.repeat(low, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        seeds = np.unique(self.item[own] * len(ids) + np.repeat(at, count))
        item, at = seeds // max(1, len(ids)), seeds % max(1, len(ids))
        text = np.searchsorted(starts, at, side="right") - 1
        last = np.arange(len(at)) + self.least_hits[item] - 1
        first = np.flatnonzero(last < len(at))
        last = last[first]
        close = (item[first] == item[last]) & (text[first] == text[last]) & (at[last] - at[first] < self.span[item[first]])
        first, last = first[close], last[close]
        item, text = item[first], text[first]
        begin = np.maximum(starts[text], at[last] - self.span[item])
        end = np.minimum(starts[text + 1] - 2, at[first] + self.span[item] + 2)
        if len(first):  # windows of one item in one text that meet become one
            new = np.flatnonzero(np.concatenate([[True], (item[1:] != item[:-1]) | (text[1:] != text[:-1]) | (begin[1:] > end[:-1])]))
            yield from zip(text[new].tolist(), item[new].tolist(), begin[new].tolist(), np.append(end[new[1:] - 1], end[-1]).tolist())

    def matches(self, texts: list[np.ndarray]) -> Iterator[tuple[int, int, float, int, int, int]]:
        """(text, item, share of its perfect score, begin, end, seeds) of the best alignment with each item that is copied."""
        gap = np.full(2, -1, dtype=np.int64)
        ids = np.concatenate([x for t in texts for x in (t, gap)])
        starts = np.concatenate([[0], np.cumsum([len(t) + 2 for t in texts])])
        found: dict[tuple[int, int], tuple[float, int, int, int]] = {}
        for text, k, begin, end in self.windows(ids, starts):
            window, words = ids[begin:end], self.words[k]
            at, code = self.codes(window, len(words) == 1)
            seeds = len(np.unique(at[np.isin(code, self.pairs[k])]))
            if seeds < self.need[k]:
                continue
            score, x, y = align(words, window)
            if score >= self.least * MATCH * len(words) and score > found.get((text, k), (0.0,))[0]:
                found[text, k] = (score, begin + x - starts[text], begin + y - starts[text], seeds)
        for (text, k), (score, x, y, seeds) in found.items():
            yield text, k, score / (MATCH * len(self.words[k])), int(x), int(y), seeds


def contaminated(docs: DataFrame, benchmark: DataFrame, least: float = COPY) -> DataFrame:
    """(doc_id, item_id, score, begin_word, end_word, seeds) for every text that holds a copy of a benchmark item.

    Seeds are pairs of words of an item that stand beside each other or one apart, in the item and in the text; every
    alignment of ``least`` shares ``least_seeds`` of them, so that no copy of an item of three words or more is lost. The
    rarest are looked for first: frequencies of words, not of the pairs, rank them, so that a passage that has been copied
    a thousand times still has its seeds. Where a text holds enough, Smith-Waterman aligns the words around them with the
    whole item, and ``score`` is the share of the item's perfect score, 1 for a verbatim copy; rows with ``least`` or more
    are returned, with the seeds in the part that was aligned. Words of copies may differ in case and marks. An item of two
    words must share both, with one word between them at most.

    The benchmark goes to the executors in blocks of BLOCK_ITEMS items and BLOCK_WORDS words, and all texts are
    scanned once for each block; nothing is shuffled but counts. Null or wordless texts and items match nothing;
    repeated rows each give their rows; an empty benchmark gives an empty result. Other columns are ignored.
    """
    spark = docs.sparkSession
    shape = "doc_id long, item_id long, score double, begin_word long, end_word long, seeds long"
    items = benchmark.where("item_id is not null and text is not null").select("item_id", "text")
    size = items.agg(F.count("*").alias("n"), F.sum(F.length("text")).alias("chars")).first()
    blocks = max(1, -(-size["n"] // BLOCK_ITEMS), -(-(size["chars"] or 0) // (2 * BLOCK_WORDS)))
    found = None
    for k in range(blocks):
        part = [(r["item_id"], words) for r in items.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == k).orderBy("item_id", "text").collect() if (words := plain_words(r["text"]))]
        own = _scan(docs, part, least, shape) if part else spark.createDataFrame([], shape)
        found = own if found is None else found.unionByName(own)
    return found


def _scan(docs: DataFrame, part: list[tuple[int, list[bytes]]], least: float, shape: str) -> DataFrame:
    spark = docs.sparkSession
    vocabulary: dict[bytes, int] = {}
    for _, words in part:
        for w in words:
            vocabulary.setdefault(w, len(vocabulary))
    names = spark.sparkContext.broadcast(vocabulary)  # BLOCK_WORDS at most

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get, known = names.value.get, len(names.value)
        seen = np.zeros(known + 1, dtype=np.int64)
        for b in batches_of(batches, 64):
            for text in b.column("text").to_pylist():
                ids = np.array([get(w, known) for w in plain_words(text)], dtype=np.int64)
                seen += np.bincount(ids, minlength=known + 1) if len(ids) * 8 > known else 0
                if 0 < len(ids) * 8 <= known:
                    np.add.at(seen, ids, 1)
        at = np.flatnonzero(seen)
        yield pa.record_batch([pa.array(at), pa.array(seen[at])], ["word", "n"])

    rows = docs.select("text").mapInArrow(count, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")).collect()
    seen = np.zeros(len(vocabulary) + 1, dtype=np.int64)
    for r in rows:
        seen[r["word"]] = r["n"]
    index = spark.sparkContext.broadcast(Index(part, vocabulary, seen[:-1], int(seen.sum()), least))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = index.value
        get = held.vocabulary.get
        for b in batches_of(batches, 256):
            docs_of = b.column("doc_id").to_pylist()
            texts = [np.array([get(w, -1) for w in plain_words(text)], dtype=np.int64) for text in b.column("text").to_pylist()]
            out = [(docs_of[i], held.ids[k], *rest) for i, k, *rest in held.matches(texts)] if texts else []
            columns = list(zip(*out)) if out else [()] * 6
            kinds = [pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, kinds)], ["doc_id", "item_id", "score", "begin_word", "end_word", "seeds"])

    return docs.select("doc_id", "text").mapInArrow(scan, shape)
