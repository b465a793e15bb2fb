"""Language identification by a byte convolutional network."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewave.llm.common import Adam, batches_of, drawn, stored

#: Bytes in a window; every byte of a text is in one.
WINDOW = 256
WIDTHS, FILTERS, EMBED = (2, 3, 4), 16, 8
#: Places of a window at which the widest filter still fits; all filters use these.
PLACES = WINDOW - max(WIDTHS) + 1
#: The fit reads FIT_ROWS documents of each language at most, of FIT_WINDOWS windows in all. Whole documents are taken by
#: the hash of their ids while they fit into the windows.
FIT_ROWS, FIT_WINDOWS, STEPS, BATCH = 800, 20_000, 900, 96
#: Windows of a language drawn for training, each from a document drawn first, so that long ones don't drown the others.
DRAWS = 4800


class ByteNet:
    """Embedding, convolutions of several widths, ReLU, maximum over the window, softmax over ``langs``."""

    def __init__(self, langs: list[str], rng: np.random.Generator):
        self.langs = langs
        self.p = {"embed": rng.normal(0, 0.5, (256, EMBED)).astype(np.float32)}
        for w in WIDTHS:
            self.p[f"conv{w}"] = rng.normal(0, 1 / np.sqrt(w * EMBED), (w * EMBED, FILTERS)).astype(np.float32)
            self.p[f"shift{w}"] = np.zeros(FILTERS, dtype=np.float32)
        self.p["out"] = rng.normal(0, 0.2, (len(WIDTHS) * FILTERS, len(langs))).astype(np.float32)
        self.p["bias"] = np.zeros(len(langs), dtype=np.float32)

    def tables(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The convolutions as sums of rows of two tables, both addressed by two neighbouring bytes.

        The first holds what the bytes at places 0 and 1 add to the filters of each width, the second what those
        at 2 and 3 add to the filters of width 3 and 4; the last item shifts the pooled values.
        """
        kernels = {(w, k): self.p["embed"] @ self.p[f"conv{w}"][k * EMBED : (k + 1) * EMBED] for w in WIDTHS for k in range(w)}
        pair = lambda x, y: (x[:, None, :] + y[None, :, :]).reshape(65536, FILTERS)
        none = np.zeros((256, FILTERS), dtype=np.float32)
        first = np.concatenate([pair(kernels[w, 0], kernels[w, 1]) for w in WIDTHS], axis=1)
        second = np.concatenate([pair(kernels[3, 2], none), pair(kernels[4, 2], kernels[4, 3])], axis=1)
        return np.ascontiguousarray(first), np.ascontiguousarray(second), np.concatenate([self.p[f"shift{w}"] for w in WIDTHS])

    def log_probs(self, windows: np.ndarray, tables: tuple) -> np.ndarray:
        """Log-probabilities of the languages for each row of bytes (n, WINDOW)."""
        first, second, shift = tables
        pairs = windows[:, :-1].astype(np.intp) * 256 + windows[:, 1:]
        total = np.take(first, pairs[:, :PLACES], axis=0, mode="clip")
        total[:, :, FILTERS:] += np.take(second, pairs[:, 2 : PLACES + 2], axis=0, mode="clip")
        z = np.maximum(total.max(axis=1) + shift, 0) @ self.p["out"] + self.p["bias"]
        z -= z.max(axis=1, keepdims=True)
        return z - np.log(np.exp(z).sum(axis=1, keepdims=True))

    def fit(self, windows: np.ndarray, langs: np.ndarray, rng: np.random.Generator) -> None:
        """Adam on the cross-entropy; the gradient reaches the place where each filter was largest."""
        adam, rows = Adam(self.p, 0.004), np.arange(BATCH)[:, None]
        for step in range(STEPS):
            pick = rng.integers(0, len(windows), BATCH)
            x, y = windows[pick], langs[pick]
            pooled, best = [], []
            for w in WIDTHS:
                total = np.zeros((BATCH, PLACES, FILTERS), dtype=np.float32)
                for k in range(w):
                    total += (self.p["embed"] @ self.p[f"conv{w}"][k * EMBED : (k + 1) * EMBED])[x[:, k : PLACES + k]]
                best.append(total.argmax(axis=1))
                pooled.append(np.maximum(total.max(axis=1) + self.p[f"shift{w}"], 0))
            h = np.concatenate(pooled, axis=1)
            z = h @ self.p["out"] + self.p["bias"]
            q = np.exp(z - z.max(axis=1, keepdims=True))
            q /= q.sum(axis=1, keepdims=True)
            q[np.arange(BATCH), y] -= 1
            q /= BATCH
            grads = {"out": h.T @ q, "bias": q.sum(axis=0), "embed": np.zeros_like(self.p["embed"])}
            back = (q @ self.p["out"].T) * (h > 0)
            for i, w in enumerate(WIDTHS):
                g = back[:, i * FILTERS : (i + 1) * FILTERS]
                grads[f"shift{w}"] = g.sum(axis=0)
                kernel = np.zeros_like(self.p[f"conv{w}"])
                for k in range(w):
                    seen = x[rows, best[i] + k]
                    kernel[k * EMBED : (k + 1) * EMBED] = np.einsum("bfe,bf->ef", self.p["embed"][seen], g)
                    np.add.at(grads["embed"], seen.ravel(), (g[:, :, None] * self.p[f"conv{w}"][k * EMBED : (k + 1) * EMBED].T[None]).reshape(-1, EMBED))
                grads[f"conv{w}"] = kernel
            adam.update(grads, 0.1 ** (step / STEPS))


def cut(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All windows of all texts, the text of each, and its share of real bytes. A tail is padded with spaces."""
    raw = [t.encode("utf-8", "surrogatepass") for t in texts]
    counts = np.array([max(1, -(-len(r) // WINDOW)) for r in raw])
    flat = np.frombuffer(b"".join(r.ljust(c * WINDOW, b" ") for r, c in zip(raw, counts.tolist())), dtype=np.uint8)
    owner = np.repeat(np.arange(len(raw)), counts)
    weight = np.ones(len(owner), dtype=np.float32)
    weight[np.cumsum(counts) - 1] = [(len(r) - (c - 1) * WINDOW) / WINDOW for r, c in zip(raw, counts.tolist())]
    return flat.reshape(-1, WINDOW), owner, weight


def fit(docs: DataFrame, learn: Column) -> ByteNet | None:
    """The network fitted to a bounded sample of rows where ``learn`` holds and text and lang are not null; languages are few."""
    rows = docs.where(learn & F.col("text").isNotNull() & F.col("lang").isNotNull() & F.col("doc_id").isNotNull()).select("doc_id", "lang", "text")
    ids = drawn(rows.select("doc_id", "lang").distinct(), "doc_id", FIT_ROWS, "lang")

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches_of(batches, 200):
            grid, owner, _ = cut(b.column("text").to_pylist())
            sizes = np.bincount(owner, minlength=b.num_rows)
            parts = [x.tobytes() for x in np.split(grid, np.cumsum(sizes)[:-1])]
            yield pa.record_batch([b.column("doc_id"), b.column("lang"), pa.array(sizes, pa.int64()), pa.array(parts, pa.binary())], ["doc_id", "lang", "n", "bytes"])

    # Bound of the broadcast: FIT_ROWS ids a language.
    told = stored(rows.join(F.broadcast(ids), ["doc_id", "lang"]).select("doc_id", "lang", "text").mapInArrow(windows, "doc_id long, lang string, n long, bytes binary"), "windows")
    known = told.groupBy("doc_id", "lang").agg(F.min("n").alias("n"), F.xxhash64("doc_id").alias("draw")).collect()
    room, wanted = {}, []
    for r in sorted(known, key=lambda r: (r["draw"], r["doc_id"])):
        left = room.get(r["lang"], FIT_WINDOWS)
        if r["n"] <= left:
            room[r["lang"]] = left - r["n"]
            wanted.append((r["doc_id"], r["lang"], r["n"]))
    if not wanted:
        return None
    chosen = F.broadcast(docs.sparkSession.createDataFrame(wanted, "doc_id long, lang string, n long"))
    found = told.join(chosen, ["doc_id", "lang", "n"]).groupBy("doc_id", "lang").agg(F.min("bytes").alias("bytes")).collect()
    found.sort(key=lambda r: (r["lang"], r["doc_id"]))
    langs = sorted({r["lang"] for r in found})
    grids = [np.frombuffer(r["bytes"], dtype=np.uint8).reshape(-1, WINDOW) for r in found]
    # As many of each language, so that a large language is no prior for short texts.
    rng = np.random.default_rng(11)
    x, y = [], np.repeat(np.arange(len(langs)), DRAWS)
    for lang in langs:
        own = [g for g, r in zip(grids, found) if r["lang"] == lang]
        x += [own[k][rng.integers(len(own[k]))] for k in rng.integers(0, len(own), DRAWS)]
    x = np.array(x)
    short = rng.random(len(x)) < 0.3  # many texts are short
    for i in np.flatnonzero(short):
        x[i, rng.integers(4, WINDOW) :] = 32
    net = ByteNet(langs, rng)
    net.fit(x, y, rng)
    return net


def languages(docs: DataFrame, learn: Column, carry: list[str] | None = None) -> DataFrame:
    """(doc_id, lang_pred, score) of every row of ``docs`` (doc_id, text, lang); ``carry`` names the columns to return with them.

    The network is trained in numpy on a bounded sample (FIT_ROWS whole documents of FIT_WINDOWS windows for a
    language) of rows where ``learn`` holds. Every text is cut into windows of WINDOW bytes, all of which are scored
    in batches; a text's log-probabilities are the means over its windows, weighted by their bytes, and ``score``
    is the probability of the winner. A text that is null or has no letter is ``und`` with score 0; so is all if
    nothing could be learnt. Repeated rows each give a row; other columns are ignored.
    """
    net = fit(docs, learn)
    held = docs.sparkSession.sparkContext.broadcast(net)

    @F.arrow_udf("struct<lang_pred string, score double>")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        net = held.value
        tables = net.tables() if net else ()
        for b in batches:
            parts = [_told(net, tables, b.slice(k, 128).to_pylist()) for k in range(0, len(b), 128)]
            yield pa.StructArray.from_arrays([pa.array([x for p in parts for x in p[0]], pa.string()), pa.array([x for p in parts for x in p[1]], pa.float64())], ["lang_pred", "score"])

    carry = carry or ["doc_id"]
    # Only texts go to Python, and nothing of them comes back. Not deterministic, so that a filter on the result scores no text twice.
    told = docs.select(*carry, score.asNondeterministic()(F.col("text")).alias("_told"))
    return told.select(*carry, "_told.lang_pred", "_told.score")


def _told(net: ByteNet | None, tables: tuple, texts: list[str | None]) -> tuple[list[str], list[float]]:
    """The languages of texts and their probabilities."""
    spoken = np.array([bool(net) and bool(t) and any(map(str.isalpha, t)) for t in texts])
    langs, scores = ["und"] * len(texts), np.zeros(len(texts))
    if spoken.any():
        at = np.flatnonzero(spoken)
        grid, owner, weight = cut([texts[i] for i in at])
        logs = np.concatenate([net.log_probs(grid[k : k + 8], tables) for k in range(0, len(grid), 8)])
        sums = np.zeros((len(at), len(net.langs)))
        np.add.at(sums, owner, logs * weight[:, None])
        sums /= np.bincount(owner, weight)[:, None]
        best = sums.argmax(axis=1)
        scores[at] = np.exp(sums.max(axis=1)) / np.exp(sums).sum(axis=1)
        for i, k in zip(at, best):
            langs[i] = net.langs[k]
    return langs, scores.tolist()
