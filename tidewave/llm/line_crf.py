"""Document quality from a linear-chain conditional random field over lines."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidewave.llm.common import Adam, batches_of, class_share, labelled_sample, sigmoid, stored

#: Labelled documents in the fit, half of each class, and lines that they hold in all. Whole documents are taken by the
#: hash of their ids while they fit into the lines.
FIT_ROWS, FIT_LINES = 3000, 400_000
#: Steps of the fit, documents in a step, and lines in a row that a step reads of each, from any place in it.
STEPS, BATCH, RUN = 500, 128, 48
OWN = 15  # features of a line itself
WIDE = 2 * OWN * 3 + 3

_KINDS = np.zeros(256, dtype=np.uint8)
_KINDS[65:91] = 1  # upper
_KINDS[97:123] = 2  # lower
_KINDS[128:] = 3  # beyond ASCII
_KINDS[48:58] = 4  # digits
_KINDS[[32, 9, 10, 11, 12, 13]] = 5  # white space
_KINDS[[ord(c) for c in ".,;:'\"()?-"]] = 6  # prose marks
_KINDS[ord("|")] = 8  # cell borders; 7 is any other mark
_KINDS[[i for i in range(33, 127) if _KINDS[i] == 0]] = 7
_MIX = (np.random.default_rng(3).integers(1, 1 << 62, 64, dtype=np.uint64) << np.uint64(1)) | np.uint64(1)


def line_features(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Own features of every line that is not blank, its document, and its bytes; a text without any has one blank line."""
    raw = [((t or "").encode("utf-8", "surrogatepass") + b"\n") for t in texts]
    flat = np.frombuffer(b"".join(raw), dtype=np.uint8)
    kinds = _KINDS[flat]
    ends = np.flatnonzero(flat == 10)
    starts = np.concatenate([[0], ends[:-1] + 1])
    doc = np.searchsorted(np.cumsum([len(r) for r in raw]), ends, side="right")
    size = (ends - starts).astype(np.float64)

    def per_line(mask: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(mask, dtype=np.int64)])
        return (total[ends] - total[starts]).astype(np.float64)

    space = kinds == 5
    begins = np.flatnonzero(~space & np.concatenate([[True], space[:-1]]))
    line_of = np.searchsorted(ends, begins)
    words = np.bincount(line_of, minlength=len(ends)).astype(np.float64)
    counts = {k: per_line(kinds == k) for k in (1, 2, 3, 4, 6, 7, 8)}
    full = np.maximum(size, 1)
    n = np.maximum(words, 1)
    repeat = distinct = copied = np.zeros(len(ends))
    if len(begins):
        held = np.repeat(begins, np.diff(np.append(begins, len(flat))))
        place = np.concatenate([np.zeros(begins[0], dtype=np.int64), np.arange(begins[0], len(flat)) - held])
        codes = np.where(space, 0, flat).astype(np.uint64) * _MIX[place & 63]
        hashes = np.add.reduceat(codes, begins)
        again = (hashes[1:] == hashes[:-1]) & (line_of[1:] == line_of[:-1])
        repeat = np.bincount(line_of[1:][again], minlength=len(ends)) / n
        keyed = hashes * np.uint64(0x9E3779B97F4A7C15) + line_of.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
        _, first = np.unique(keyed, return_index=True)
        distinct = np.bincount(line_of[first], minlength=len(ends)) / n
        sums = np.zeros(len(ends), dtype=np.uint64)
        np.add.at(sums, line_of, hashes * (np.arange(len(hashes), dtype=np.uint64) - np.searchsorted(line_of, line_of).astype(np.uint64) + np.uint64(1)))
        _, first, back = np.unique(sums + doc.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93), return_index=True, return_inverse=True)
        copied = (first[back] != np.arange(len(ends))).astype(np.float64)
    last = flat[np.maximum(ends - 1, 0)]
    own = np.stack([
        np.log1p(size) / 8, counts[1] / full, counts[3] / full, counts[4] / full, counts[6] / full, counts[7] / full,
        counts[8] / full, (size - sum(counts.values())) / full, repeat, 1 - distinct, size / n / 12, np.log1p(words) / 6,
        np.isin(last, [33, 46, 63]) * (size > 0), copied, (counts[1] + counts[7] > counts[2]) * 1.0,
    ], axis=1)
    own = np.clip(own, 0, 4)
    keep = words > 0
    bare = np.setdiff1d(np.arange(len(texts)), doc[keep])
    if len(bare):  # their blank lines stand for them
        keep[np.searchsorted(doc, bare)] = True
    return own[keep].astype(np.float32), doc[keep], np.maximum(size[keep], 1)


def edges(doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether each line is the first, and the last, of its document."""
    new = np.flatnonzero(doc[1:] != doc[:-1])
    first, last = np.zeros(len(doc), dtype=bool), np.zeros(len(doc), dtype=bool)
    first[new + 1] = last[new] = True
    first[:1] = last[-1:] = True
    return first, last


def wide(own: np.ndarray, first: np.ndarray, last: np.ndarray, at: np.ndarray) -> np.ndarray:
    """All features of the lines ``at``: their own and both neighbours', with the roots of these, and where a document ends."""
    sides = [own[at], own[at - 1] * ~first[at][..., None], own[np.minimum(at + 1, len(own) - 1)] * ~last[at][..., None]]
    edge = np.stack([first[at], last[at], np.ones(at.shape)], axis=-1)
    return np.concatenate([x for side in sides for x in (side, np.sqrt(side))] + [edge], axis=-1)


def unary_scores(own: np.ndarray, doc: np.ndarray, w: np.ndarray) -> np.ndarray:
    """``wide`` of every line times ``w``, some lines at a time."""
    first, last = edges(doc)
    return np.concatenate([wide(own, first, last, np.arange(k, min(k + 8192, len(doc)))) @ w for k in range(0, len(doc), 8192)] or [np.zeros(0)])


def _tables(unary: np.ndarray, p: dict) -> tuple[np.ndarray, np.ndarray]:
    """exp of the unary scores (bad, good), scaled by line, and of the transitions."""
    two = np.stack([np.zeros_like(unary), unary], axis=-1)
    return np.exp(two - two.max(axis=-1, keepdims=True)), np.exp(p["step"] - p["step"].max())


def marginals(unary: np.ndarray, sizes: np.ndarray, p: dict) -> tuple[np.ndarray, np.ndarray]:
    """P(good) of each line by forward-backward and the summed pair marginals; rows are padded sequences."""
    n, width = unary.shape
    emit, step = _tables(unary, p)
    live = np.arange(width)[None, :] < sizes[:, None]
    forward, backward = np.zeros((n, width, 2)), np.ones((n, width, 2))
    a = emit[:, 0] * np.exp(p["start"] - p["start"].max())
    forward[:, 0] = a / a.sum(axis=1, keepdims=True)
    for t in range(1, width):
        a = (forward[:, t - 1] @ step) * emit[:, t]
        a /= a.sum(axis=1, keepdims=True)
        forward[:, t] = np.where(live[:, t, None], a, forward[:, t - 1])
    for t in range(width - 2, -1, -1):
        b = (backward[:, t + 1] * emit[:, t + 1]) @ step.T
        b /= b.sum(axis=1, keepdims=True)
        backward[:, t] = np.where(live[:, t + 1, None], b, 1.0)
    both = forward * backward
    good = both[:, :, 1] / both.sum(axis=2)
    pair = forward[:, :-1, :, None] * step * (emit * backward)[:, 1:, None, :]
    pair /= np.maximum(pair.sum(axis=(2, 3), keepdims=True), 1e-300)
    return good, (pair * live[:, 1:, None, None]).sum(axis=(0, 1))


def grouped(doc: np.ndarray, most: int = 64) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Documents of like length in groups: their first lines, their line counts, and a padded grid of line numbers."""
    first = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]])) if len(doc) else np.zeros(0, dtype=int)
    size = np.diff(np.append(first, len(doc)))
    order = np.argsort(size, kind="stable")
    at = 0
    while at < len(order):
        to = at + 1
        while to < len(order) and to - at < most and size[order[to]] <= 2 * size[order[at]] + 4:
            to += 1
        pick = order[at:to]
        grid = first[pick][:, None] + np.minimum(np.arange(size[pick].max())[None, :], size[pick][:, None] - 1)
        yield doc[first[pick]], size[pick], grid
        at = to


def document_means(own: np.ndarray, doc: np.ndarray, size: np.ndarray, p: dict, docs: int) -> np.ndarray:
    """Mean P(good) over the lines of each document, weighted by their bytes."""
    unary = unary_scores(own, doc, p["w"])
    out = np.full(docs, 0.5)
    for who, counts, grid in grouped(doc):
        good, _ = marginals(unary[grid], counts, p)
        weight = size[grid] * (np.arange(grid.shape[1])[None, :] < counts[:, None])
        out[who] = (good * weight).sum(axis=1) / weight.sum(axis=1)
    return out


def logit(m: np.ndarray) -> np.ndarray:
    m = np.clip(m, 1e-6, 1 - 1e-6)
    return np.log(m / (1 - m))


def fit(own: np.ndarray, doc: np.ndarray, size: np.ndarray, labels: np.ndarray, share: float) -> dict:
    """Train the field on lines that bear their document's label; then map means to probabilities of label 1.

    ``own``, ``doc`` and ``size`` are what ``line_features`` gives; a step works on RUN lines of BATCH documents at most.
    """
    rng = np.random.default_rng(5)
    p = {"w": np.zeros(WIDE), "step": np.zeros((2, 2)), "start": np.zeros(2), "map": np.array([1.0, 0.0])}
    docs = len(labels)
    if not docs:
        return p
    head, tail = edges(doc)
    first = np.searchsorted(doc, np.arange(docs))
    count = np.diff(np.append(first, len(doc)))
    weigh = np.where(labels == 1, share / max(labels.mean(), 1e-9), (1 - share) / max(1 - labels.mean(), 1e-9))
    adam = Adam({k: p[k] for k in ("w", "step", "start")}, 0.05)
    for turn in range(STEPS):
        pick = rng.integers(0, docs, min(BATCH, docs))
        n = np.minimum(count[pick], RUN)
        begin = first[pick] + rng.integers(0, count[pick] - n + 1)
        grid = begin[:, None] + np.minimum(np.arange(n.max())[None, :], n[:, None] - 1)
        live = np.arange(n.max())[None, :] < n[:, None]
        x = wide(own, head, tail, grid)
        good, pair = marginals(x @ p["w"], n, p)
        y = labels[pick].astype(float)
        # Long documents count by the root of their lines, so that they don't drown the others.
        w = (1 / np.sqrt(n))[:, None] * live
        error = (good - y[:, None]) * w
        seen = np.zeros((2, 2))
        seen[0, 0], seen[1, 1] = ((n - 1) * (y == 0)).sum(), ((n - 1) * (y == 1)).sum()
        scale = len(pick)
        start = np.stack([(y == 1) - good[:, 0], good[:, 0] - (y == 1)], axis=1).sum(axis=0) / scale
        adam.update({
            "w": np.tensordot(error, x, 2) / scale + 1e-4 * p["w"],
            "step": (pair - seen) / max(1, (n - 1).sum()) + 1e-3 * p["step"],
            "start": start + 1e-3 * p["start"],
        }, 0.1 ** (turn / STEPS))
    z = logit(document_means(own, doc, size, p, docs))
    a, b = 1.0, 0.0
    for _ in range(30):  # Newton steps of a logistic regression on one input, with the classes at their true share
        q = sigmoid(a * z + b)
        g = np.array([(weigh * (q - labels) * z).mean() + 1e-3 * (a - 0.5), (weigh * (q - labels)).mean()])
        r = weigh * q * (1 - q)
        h = np.array([[(r * z * z).mean() + 1e-3, (r * z).mean()], [(r * z).mean(), r.mean() + 1e-6]])
        move = np.linalg.solve(h, g)
        a, b = a - np.clip(move[0], -1, 1), b - np.clip(move[1], -1, 1)
    p["map"] = np.array([max(a, 0.05), b])
    return p


def quality(docs: DataFrame, labels: DataFrame, keep, carry: list[str] | None = None) -> DataFrame:
    """(doc_id, score) of every row: the probability that its text is of good quality; ``carry`` names the columns to return with it.

    A linear-chain conditional random field with states bad and good reads every non-blank line by its features
    and its neighbours'. It is trained in numpy on at most FIT_ROWS whole documents, of FIT_LINES lines in all, whose label
    row satisfies ``keep``: ids are drawn by hash, tasks turn the texts into features where these are read, and the driver
    gets no text, but OWN numbers a line. Forward-backward marginals, weighted by the bytes of
    their lines, give the document's mean, which a logistic map turns into a probability. Null, empty and blank
    texts count as one blank line; without labels every score is the mean itself (0.5). Repeated rows each give a
    row; other columns are ignored.
    """
    rows = _fit_rows(docs, labels, keep)
    share = class_share(labels.withColumn("quality", (F.col("quality") > 0).cast("int")), "quality", keep) if rows else 0.5
    own, size = (np.concatenate([np.frombuffer(r[k], dtype=t) for r in rows] or [np.zeros(0, dtype=t)]) for k, t in (("own", np.float32), ("size", np.float64)))
    doc = np.repeat(np.arange(len(rows)), [r["lines"] for r in rows])
    model = docs.sparkSession.sparkContext.broadcast(fit(own.reshape(-1, OWN), doc, size, np.array([r["label"] for r in rows]), share))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = model.value
        for b in batches_of(batches, 128):
            if not b.num_rows:
                continue
            means = document_means(*line_features(b.column("text").to_pylist()), p, b.num_rows)
            found = sigmoid(p["map"][0] * logit(means) + p["map"][1])
            yield pa.record_batch([*map(b.column, carry), pa.array(found)], [*carry, "score"])

    carry = carry or ["doc_id"]
    shape = StructType(docs.select(*carry).schema.fields).add("score", "double")
    return docs.select(*dict.fromkeys([*carry, "text"])).mapInArrow(score, shape)


def _fit_rows(docs: DataFrame, labels: DataFrame, keep) -> list:
    """(doc_id, label, lines, own, size) of the documents to learn from, by their ids; one row for each id."""

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches_of(batches, 64):
            own, doc, size = line_features(b.column("text").to_pylist())
            cuts = np.searchsorted(doc, np.arange(b.num_rows + 1))
            parts = [(own[i:j].tobytes(), size[i:j].tobytes()) for i, j in zip(cuts, cuts[1:])]
            yield pa.record_batch([
                b.column("doc_id"), b.column("label"), pa.array(np.diff(cuts), pa.int64()),
                pa.array([x for x, _ in parts], pa.binary()), pa.array([x for _, x in parts], pa.binary()),
            ], ["doc_id", "label", "lines", "own", "size"])

    sample = labelled_sample(docs.where("text is not null"), labels, "quality", keep, FIT_ROWS)
    told = stored(sample.mapInArrow(describe, "doc_id long, label int, lines long, own binary, size binary"), "lines")
    # One text of an id, the shortest; at most FIT_ROWS rows of three numbers.
    known = told.groupBy("doc_id").agg(F.min("lines").alias("lines"), F.xxhash64("doc_id").alias("draw")).collect()
    room, wanted = FIT_LINES, []
    for r in sorted(known, key=lambda r: (r["draw"], r["doc_id"])):
        if r["lines"] <= room:
            room -= r["lines"]
            wanted.append((r["doc_id"], r["lines"]))
    if not wanted:
        return []
    chosen = F.broadcast(docs.sparkSession.createDataFrame(wanted, "doc_id long, lines long"))
    rows = told.join(chosen, ["doc_id", "lines"]).groupBy("doc_id").agg(F.min(F.struct("own", "size", "label", "lines")).alias("r"))
    return [r["r"] for r in sorted(rows.collect(), key=lambda r: r["doc_id"])]
