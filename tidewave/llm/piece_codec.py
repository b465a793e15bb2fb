"""SentencePiece BPE encoding by a table of each prefix's last piece, and decoding.

BPE keeps a sequence of pieces if and only if it keeps every two neighbours of it, and the pieces of a prefix are the
pieces of the text up to some place. So every prefix has exactly one possible last piece. An Aho-Corasick automaton tells
which pieces end at a place; of these the last one is the piece that is compatible with the last piece of the prefix
before it. One pass fills the table, and walking it backwards gives the ids, in time that is linear in the text.
"""

from __future__ import annotations

import codecs
import re
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from sentencepiece import sentencepiece_model_pb2

SPACE = "▁"  # stands for a space in pieces

#: Longest stretch whose ids are kept for its next use, and how many of them make one of the two generations that a worker keeps.
KEPT_CHARS, KEPT = 48, 250_000
#: Ids and texts are sent on in batches of about so many bytes.
SEND_BYTES = 16 << 20

_NORMAL, _UNKNOWN, _CONTROL, _BYTE = 1, 2, 3, 6  # kinds of pieces in a model file
_BPE = 2  # kind of model
_NEVER = float("inf")


def _one_for_each_byte(error: UnicodeDecodeError) -> tuple[str, int]:
    return "�", error.start + 1


codecs.register_error("tidewave.bytes", _one_for_each_byte)


class Codec(dict):
    """Encoder and decoder of one model file; as a dictionary, the packed ids of stretches of text met so far."""

    def __init__(self, path: str):
        super().__init__()
        model = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as file:
            model.ParseFromString(file.read())
        rules = model.normalizer_spec
        kinds = {p.type for p in model.pieces}
        if (
            model.trainer_spec.model_type != _BPE or not model.trainer_spec.byte_fallback or kinds - {_NORMAL, _UNKNOWN, _CONTROL, _BYTE}
            or rules.precompiled_charsmap or rules.remove_extra_whitespaces or not rules.escape_whitespaces or model.trainer_spec.treat_whitespace_as_suffix
        ):
            raise ValueError(f"{path} is no BPE model with byte fallback that leaves texts as they are")
        self.prefix = SPACE if rules.add_dummy_prefix else ""
        controls = {p.piece: i for i, p in enumerate(model.pieces) if p.type == _CONTROL}
        self.begin, self.end = _packed([controls[model.trainer_spec.bos_piece]]), _packed([controls[model.trainer_spec.eos_piece]])
        self.bytes = {int(p.piece[3:5], 16): i for i, p in enumerate(model.pieces) if p.type == _BYTE}
        normal = {p.piece: (i, p.score) for i, p in enumerate(model.pieces) if p.type == _NORMAL}
        self.cost = {piece: -score for piece, (_, score) in normal.items()}  # the least cost merges first

        # What each id stands for in a decoded text.
        said = {_CONTROL: lambda p: b"", _UNKNOWN: lambda p: model.trainer_spec.unk_surface.encode(), _BYTE: lambda p: bytes([int(p.piece[3:5], 16)])}
        self.surface = [said[p.type](p) if p.type in said else p.piece.replace(SPACE, " ").encode() for p in model.pieces]
        self.silent = {i for i, p in enumerate(model.pieces) if p.type == _CONTROL}
        self.raw = {i for i, p in enumerate(model.pieces) if p.type in (_BYTE, _UNKNOWN)}  # their spaces are no pieces' spaces

        # Characters that pieces hold but that are no pieces themselves can still merge, so that they count as pieces here.
        letters = {c for piece in normal for c in piece}
        self.pieces = [*normal, *sorted(letters - set(normal))]
        self.ids = [_packed([normal[p][0]]) if p in normal else self._bytes_of(p) for p in self.pieces]
        self.sizes = [len(p) for p in self.pieces]
        self.automaton = ahocorasick.Automaton()
        for at, piece in enumerate(self.pieces):
            self.automaton.add_word(piece, at)
        self.automaton.make_automaton()
        self.ends: dict[int, tuple | None] = {}
        self.fits: dict[int, bool] = {}

        # No piece holds a space behind another character: no merge reaches across the start of a run of spaces. Nor does
        # any across a character that no piece holds. So stretches between these are encoded one by one.
        inner = any(SPACE in piece.lstrip(SPACE) for piece in normal)
        known = "".join(re.escape(c) for c in sorted(letters - {SPACE}))
        word = f"[{known}{SPACE}]+" if inner else f"{SPACE}*[{known}]+|{SPACE}+"
        self.stretches = re.compile(f"{word}|[^{known}{SPACE}]+").findall
        self.letters = letters
        self.older: dict[str, bytes] = {}  # the generation of stretches before

    def _bytes_of(self, text: str) -> bytes:
        return _packed([self.bytes[b] for b in text.encode("utf-8", "surrogatepass")])

    def _merges(self, at: int) -> tuple | None:
        """How a piece comes about from its characters: (first, last, [(cost, first and last part after it)]); None if it doesn't."""
        if at not in self.ends:
            parts, steps = list(self.pieces[at]), []
            while len(parts) > 1:
                costs = [self.cost.get(a + b, _NEVER) for a, b in zip(parts, parts[1:])]
                least = min(costs)
                if least == _NEVER:
                    break
                where = costs.index(least)  # of equal ones the leftmost
                parts[where : where + 2] = [parts[where] + parts[where + 1]]
                steps.append((least, parts[0], parts[-1]))
            self.ends[at] = (self.pieces[at][0], self.pieces[at][-1], steps) if len(parts) == 1 else None
        return self.ends[at]

    def fit(self, left: int, right: int) -> bool:
        """Whether BPE of both pieces' text leaves these two pieces: no merge across their border is ever next.

        Both sides merge as they do alone, the cheaper step first, of equal ones the left one, until the pair of parts
        at the border is cheaper than either side's next step.
        """
        key = left << 32 | right
        a, b = self._merges(left), self._merges(right)
        if len(self.fits) > 8 * KEPT:
            self.fits.clear()
        found = self.fits[key] = a is not None and b is not None and self._apart(a, b)
        return found

    def _apart(self, a: tuple, b: tuple) -> bool:
        last, first, i, j = a[1], b[0], 0, 0
        while True:
            left = a[2][i][0] if i < len(a[2]) else _NEVER
            right = b[2][j][0] if j < len(b[2]) else _NEVER
            across = self.cost.get(last + first, _NEVER)
            if across < left and across <= right and across < _NEVER:
                return False
            if left == right == _NEVER:
                return True
            if left <= right:
                last, i = a[2][i][2], i + 1
            else:
                first, j = b[2][j][1], j + 1

    def __missing__(self, stretch: str) -> bytes:
        found = self.older.get(stretch)
        if found is None:
            if stretch[0] in self.letters:
                ids = self.ids
                found = b"".join([ids[p] for p in self.pieces_of(stretch)])
            else:
                found = self._bytes_of(stretch)
        if len(stretch) <= KEPT_CHARS:
            if len(self) >= KEPT:
                self.older = dict(self)
                self.clear()
            self[stretch] = found
        return found

    def pieces_of(self, text: str) -> list[int]:
        """Places in ``pieces`` of a text of ``letters``."""
        last, fits, sizes = [-1] * (len(text) + 1), self.fits, self.sizes
        for at, piece in self.automaton.iter(text):
            at += 1
            if last[at] < 0:
                if start := at - sizes[piece]:
                    fit = fits.get(last[start] << 32 | piece)
                    if self.fit(last[start], piece) if fit is None else fit:
                        last[at] = piece
                elif self._merges(piece) is not None:
                    last[at] = piece
        found, at = [], len(text)
        while at:
            found.append(last[at])
            at -= sizes[last[at]]
        found.reverse()
        return found

    def encode(self, text: str) -> bytes:
        """Ids with begin and end, as little-endian unsigned 32-bit integers."""
        stretches = self.stretches(self.prefix + text.replace(" ", SPACE)) if text else ()
        return b"".join([self.begin, *map(self.__getitem__, stretches), self.end])

    def decode(self, ids: bytes) -> str:
        """Text of packed ids. Bytes that are no UTF-8 give U+FFFD each; the space that encoding puts first goes."""
        read = np.frombuffer(ids, dtype="<u4").tolist()
        text = b"".join(map(self.surface.__getitem__, read))
        first = next((i for i in read if i not in self.silent), None)
        if self.prefix and first is not None and first not in self.raw and text[:1] == b" ":
            text = text[1:]
        return text.decode("utf-8", "tidewave.bytes")


def _packed(ids: list[int]) -> bytes:
    return np.array(ids, dtype="<u4").tobytes()


_codecs: dict[str, Codec] = {}


def codec(path: str) -> Codec:
    """The worker's codec of this model file."""
    if path not in _codecs:
        _codecs[path] = Codec(path)
    return _codecs[path]


def coded(docs: DataFrame, model: str) -> DataFrame:
    """Ids and decoded text of every document of ``docs`` (doc_id, text; other columns are ignored).

    ``model`` is the path of a SentencePiece BPE model that every machine has. One row a document: doc_id, n_tokens
    (begin and end included), ids (binary, little-endian unsigned 32-bit) and decoded (the text that the ids give).
    A null text is an empty one, with begin and end only; null and repeated doc_ids keep their rows; an empty table
    gives no row. A text of any length takes time and memory in proportion to it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = codec(model)
        for batch in batches:
            held, ids, texts = 0, [], []
            start = 0
            for at, text in enumerate(batch.column("text")):
                packed = books.encode(text.as_py() or "")
                decoded = books.decode(packed)
                ids.append(packed)
                texts.append(decoded)
                held += len(packed) + len(decoded)
                if held > SEND_BYTES or at + 1 == batch.num_rows:
                    counts = pa.array([len(i) // 4 for i in ids], pa.int64())
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("doc_id").slice(start, len(ids)), counts, pa.array(ids, pa.binary()), pa.array(texts, pa.string())],
                        names=["doc_id", "n_tokens", "ids", "decoded"],
                    )
                    start, held, ids, texts = at + 1, 0, [], []

    columns = [T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.BinaryType()), T.StructField("decoded", T.StringType())]
    return docs.select("doc_id", "text").mapInArrow(run, T.StructType(columns))
