"""Best-fit packing of token sequences, improved by swaps."""

from __future__ import annotations

import struct
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewave.llm.common import batches_of, give_back, stored

CAPACITY = 2048
#: Pieces packed together in one task.
SHARD = 6144
#: Words whose ids a task remembers.
REMEMBERED = 800_000
#: Rounds of the local search over a shard.
ROUNDS = 4000

_WORKER: dict = {}
_MARKS = bytes(i for i in range(33, 127) if not chr(i).isalnum())


def _byte_letters() -> dict[int, str]:
    """The letter by which byte-level vocabularies write each byte: itself where printable, else one from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(hidden)}


class WordCoder:
    """Ids of words by the model of a tokenizer that parts words at white space and at marks.

    A word is remembered once encoded. One of plain Latin letters, perhaps followed by ASCII marks, goes straight
    to the model, its marks apart; any other goes through the whole tokenizer.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.model = self.whole.model
        self.letters = str.maketrans(_byte_letters())
        self.known: dict[bytes, bytes] = {}

    def encode(self, text: str) -> bytes:
        return np.array(self.whole.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def word(self, word: bytes) -> bytes:
        held = self.known.get(word)
        if held is not None:
            return held
        core = word.rstrip(_MARKS)
        text = core.decode("utf-8", "surrogatepass")
        if text.isalpha() and (text.isascii() or ("\u0130" not in text and max(text) < "\u0180")):
            if len(core) < len(word):
                held = self.word(core) + self.word(word[len(core) :])
            else:
                plain = core if text.isascii() else unicodedata.normalize("NFC", text).lower().encode()
                tokens = self.model.tokenize(plain.decode("latin-1").translate(self.letters))
                held = struct.pack(f"<{len(tokens)}I", *[t.id for t in tokens])
        else:
            held = self.encode(word.decode("utf-8", "surrogatepass"))
        if len(self.known) < REMEMBERED:
            self.known[word] = held
        return held

    def __call__(self, text: str | None) -> bytes:
        """The ids of a whole text, as little-endian 32-bit numbers."""
        if not text:
            return b""
        if "<|" in text:  # may hold special tokens, which are told by their case
            return self.encode(text)
        words = text.encode("utf-8", "surrogatepass").lower().split()
        get, word = self.known.get, self.word
        return b"".join([get(w) or word(w) for w in words])


def token_bytes(text: str | None, path: str) -> bytes:
    if path not in _WORKER:
        _WORKER[path] = WordCoder(path)
    return _WORKER[path](text)


def forget_words(path: str) -> None:
    """A worker keeps the model, but not a task's words: they'd take 150 MB of it for as long as the session lasts."""
    if path in _WORKER:
        _WORKER[path].known.clear()
    give_back()


def pieces(docs: DataFrame, path: str) -> DataFrame:
    """Each document's ids and a closing 0, cut into pieces of CAPACITY where longer."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = 4 * CAPACITY
        for b in batches_of(batches, 512):
            ids, piece, start, length, crc = [], [], [], [], []
            for doc, text in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist()):
                held = token_bytes(text, path) + b"\0\0\0\0"
                for k, at in enumerate(range(0, len(held), step)):
                    part = held[at : at + step]
                    ids.append(doc)
                    piece.append(k)
                    start.append(at // 4)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
            columns = [pa.array(ids, pa.int64()), pa.array(piece, pa.int32())] + [pa.array(x, pa.int64()) for x in (start, length, crc)]
            yield pa.record_batch(columns, ["doc_id", "piece", "start", "length", "ids_crc32"])
        forget_words(path)

    return docs.select("doc_id", "text").mapInArrow(cut, "doc_id long, piece int, start long, length long, ids_crc32 long")


def best_fit(lengths: np.ndarray, capacity: int = CAPACITY) -> list[list[int]]:
    """Best fit, longest first: each item goes to the fullest bin that holds it. Bins hold positions."""
    bins: list[list[int]] = []
    room: dict[int, list[int]] = {}
    open_rooms = 0  # bit r is set where a bin has r places left
    for i in np.argsort(-lengths, kind="stable").tolist():
        size = int(lengths[i])
        fit = open_rooms >> size
        if fit:
            left = size + (fit & -fit).bit_length() - 1
            held = room[left]
            b = held.pop()
            if not held:
                open_rooms &= ~(1 << left)
            bins[b].append(i)
        else:
            b, left = len(bins), capacity
            bins.append([i])
        left -= size
        if left:
            room.setdefault(left, []).append(b)
            open_rooms |= 1 << left
    return bins


def improve(lengths: np.ndarray, bins: list[list[int]], capacity: int = CAPACITY, rounds: int = ROUNDS) -> list[list[int]]:
    """Local search: empty the least full bin by moves and exchanges that increase the sum of squared fills.

    A document moves to a bin with room; or trades places with a shorter one of another bin; or two of them do.
    Each step makes a fuller bin fuller, and takes what the least full bin loses most by. A bin that nothing can
    leave any more is left alone. It ends when bins can't become fewer, or after ``rounds`` steps.
    """
    least = -(-int(lengths.sum()) // capacity)
    where = np.empty(len(lengths), dtype=np.int64)
    for b, items in enumerate(bins):
        where[items] = b
    fill = np.bincount(where, lengths, len(bins)).astype(np.int64)
    alive, stuck = len(bins), np.zeros(len(bins), dtype=bool)
    loose = np.flatnonzero(fill[where] < capacity)  # items of bins with room
    for step in range(rounds):
        if alive <= least:
            break
        if step % 64 == 0:
            loose = np.flatnonzero(fill[where] < capacity)
        able = np.where((fill > 0) & (fill < capacity) & ~stuck, fill, capacity + 1)
        b = int(able.argmin())
        if able[b] > capacity:
            break
        own = np.flatnonzero(where == b)
        other = loose[(where[loose] != b)]
        other = other[fill[where[other]] >= fill[b]]
        room = capacity - fill
        best = (0, None, None)
        for i in own[np.argsort(-lengths[own])][:24].tolist():  # move
            fits = (room >= lengths[i]) & (fill >= fill[b])
            fits[b] = False
            if fits.any():
                to = int(np.where(fits, room, capacity + 1).argmin())
                best = (int(lengths[i]), [i], (to, None))
                break
        if best[1] is None and len(other):
            slack = room[where[other]]
            groups = [[i] for i in own.tolist()] + [[i, j] for n, i in enumerate(own[:12].tolist()) for j in own[n + 1 : 12].tolist()]
            for g in groups:
                size = int(lengths[g].sum())
                gain = np.where((lengths[other] < size) & (size <= lengths[other] + slack), size - lengths[other], 0)
                k = int(gain.argmax())
                if gain[k] > best[0]:
                    best = (int(gain[k]), g, (int(where[other[k]]), int(other[k])))
        if best[1] is None:
            stuck[b] = True
            continue
        to, back = best[2]
        where[best[1]] = to
        if back is not None:
            where[back] = b
        fill[to] += best[0]
        fill[b] -= best[0]
        alive -= fill[b] == 0
    out: dict[int, list[int]] = {}
    for i, b in enumerate(where.tolist()):
        out.setdefault(b, []).append(i)
    return list(out.values())


def _pack(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values(["doc_id", "piece", "ids_crc32"], kind="stable").reset_index(drop=True)
    lengths = rows["length"].to_numpy()
    place, number = np.zeros(len(rows), dtype=np.int64), np.zeros(len(rows), dtype=np.int64)
    for n, items in enumerate(improve(lengths, best_fit(lengths))):
        number[items] = key[0] * (1 << 32) + n
        place[items] = np.cumsum(lengths[items]) - lengths[items]
    return rows.assign(sequence_id=number, offset=place)[["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]]


def packed(docs: DataFrame, path: str) -> DataFrame:
    """Pack all documents into as few sequences of at most CAPACITY tokens as the search finds.

    Texts are encoded with the tokenizer at ``path``, each closed by id 0; null and empty texts are the 0 alone.
    Only documents beyond CAPACITY are cut. Pieces are dealt by hash to shards of about SHARD pieces; in each,
    best fit (longest first) is followed by the swaps of ``improve``. A shard wastes at most about one sequence.
    Columns: doc_id, piece, start, length, ids_crc32, sequence_id, offset. Repeated rows are packed once each;
    other columns are ignored; an empty table gives an empty result.
    """
    cut = stored(pieces(docs, path), "pieces")
    shards = max(1, round(cut.count() / SHARD))
    # The row's own number spreads repeated ids too; it is fixed, as the stored files are.
    dealt = cut.withColumn("shard", F.pmod(F.xxhash64("doc_id", "piece", F.monotonically_increasing_id()), F.lit(shards)))
    shape = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    return dealt.groupBy("shard").applyInPandas(_pack, shape)
