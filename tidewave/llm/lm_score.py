"""Language-model scores from a log-bilinear model trained by noise-contrastive estimation."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewave.llm.common import Adam, batches_of, give_back, sigmoid, stored

#: Output units: the most frequent words with the end, then classes of the other words by their last two bytes.
WORDS, CLASSES = 512, 128
#: Context symbols: start, the most frequent words, then endings of the other words. Two make a context.
CONTEXT_WORDS, CONTEXT_ENDS = 4000, 500
#: Frequent words whose counts go to every task; the counts of all others are joined.
BROADCAST_WORDS = 150_000
SIZE, NOISE, BATCH = 24, 96, 2048
#: Tokens a training task should see at least: fewer tasks where there are less, and then several passes over its texts.
SHARD_TOKENS = 2_000_000
#: Tokens whose contexts and units are shuffled and learnt together; tokens scored together, and words counted together.
CHUNK, SCORED, COUNTED = 1 << 19, 1 << 18, 1 << 19
#: Distinct words that a task holds before it hands over their counts.
HELD = 500_000
#: The first round of training sees one document of so many, so that all tasks of the second start from one model.
WARM = 8
UNITS, CONTEXT = WORDS + CLASSES + 1, CONTEXT_WORDS + CONTEXT_ENDS + 2
END = b""
#: Where a row's numbers lie in a flat table, which holds them by two as one complex number: half as many sums.
PLACES = np.arange(CONTEXT * SIZE // 2).reshape(CONTEXT, SIZE // 2)
#: What the first and the second moment take of a new gradient.
RATES = np.repeat(np.array([0.1, 0.001], dtype=np.float32), SIZE)


class Lexicon:
    """Numbers of frequent words, which come by falling count, and of endings. A word is never empty, so b'' stands for the end."""

    def __init__(self, frequent: list[tuple[bytes, int]], endings: list[tuple[bytes, int, int]], ends: int, rest: tuple[int, int]):
        ranked = [(END, ends), *frequent]
        unit = {w: i for i, w in enumerate([END, *(w for w, _ in frequent[: WORDS - 1])])}
        class_of = {e: WORDS + i for i, (e, _, _) in enumerate(endings[:CLASSES])}
        ends_of = {e: CONTEXT_WORDS + 1 + i for i, (e, _, _) in enumerate(endings[:CONTEXT_ENDS])}
        context = {w: 1 + i for i, (w, _) in enumerate(frequent[:CONTEXT_WORDS])}
        #: Frequent words after the end; then the endings of the others, and, last, any other ending.
        self.words, self.endings = pa.array([w for w, _ in ranked], pa.binary()), pa.array([e for e, _, _ in endings], pa.binary())
        self.count = np.array([n for _, n in ranked], dtype=np.float64)
        self.unit = np.array([unit.get(w, class_of.get(w[-2:], UNITS - 1)) for w, _ in ranked], dtype=np.int32)
        self.context = np.array([context.get(w, ends_of.get(w[-2:], CONTEXT - 1)) for w, _ in ranked], dtype=np.int32)
        self.ending_unit = np.array([*(class_of.get(e, UNITS - 1) for e, _, _ in endings), UNITS - 1])
        self.ending_context = np.array([*(ends_of.get(e, CONTEXT - 1) for e, _, _ in endings), CONTEXT - 1])
        #: log10 of what a class shares out among its words: their tokens, their number, and one for the unseen.
        self.share = np.zeros(UNITS)
        for e, n, v in endings[:CLASSES]:
            self.share[class_of[e]] = np.log10(n + v + 1)
        self.share[UNITS - 1] = np.log10(rest[0] + rest[1] + 1)
        #: Training tokens of each unit.
        self.tokens = np.zeros(UNITS)
        for w, n in ranked[:WORDS]:
            self.tokens[unit[w]] = n
        for e, n, _ in endings[:CLASSES]:
            self.tokens[class_of[e]] = n
        self.tokens[UNITS - 1] = rest[0]

    def symbols(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For the words: their number (-1: not frequent), unit and context symbol. Each call hashes the lexicon anew, so it takes many words."""
        ids = _places(words, self.words)
        unit, context = self.unit[ids], self.context[ids]
        rare = np.flatnonzero(ids < 0)
        ending = _places(pc.binary_slice(words.take(pa.array(rare)), -2), self.endings)
        unit[rare], context[rare] = self.ending_unit[ending], self.ending_context[ending]
        return ids, unit, context

    def noise(self) -> np.ndarray:
        """Share of each unit in the training tokens, a little smoothed: the distribution that noise is drawn from."""
        found = self.tokens + 0.5
        return found / found.sum()


def _places(values: pa.Array, among: pa.Array) -> np.ndarray:
    """Each value's place, -1 where it is not there."""
    return pc.fill_null(pc.index_in(values, value_set=among), -1).to_numpy()


def words_in(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of the texts, as ``words_of`` has them, and the number of words of each text."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    words = lists.flatten()
    # White space at the edges of a text leaves empty words there.
    full = pc.binary_length(words).to_numpy(zero_copy_only=False) > 0
    before = np.concatenate([[0], full.cumsum()])
    return words.filter(pa.array(full)).cast(pa.binary()), np.diff(before[lists.offsets.to_numpy()])


class Texts:
    """Words of texts that were gathered up, until there are enough for a lexicon to number."""

    def __init__(self):
        self.words: list[pa.Array] = []
        self.sizes: list[np.ndarray] = []
        #: Tokens: words and ends.
        self.tokens = 0

    def add(self, texts: pa.Array) -> None:
        words, sizes = words_in(texts)
        self.words.append(words)
        self.sizes.append(sizes)
        self.tokens += len(words) + len(sizes)

    def numbered(self, lexicon: Lexicon) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """All words, which are let go, tokens of each text, and of every token number (-1: not frequent), unit and context symbol."""
        words, tokens = pa.concat_arrays(self.words), np.concatenate(self.sizes) + 1
        self.words = []
        is_word = np.ones(self.tokens, dtype=bool)
        is_word[tokens.cumsum() - 1] = False
        found = []
        for of_words, end in zip(lexicon.symbols(words), (0, lexicon.unit[0], lexicon.context[0])):
            found.append(np.full(self.tokens, end, dtype=np.int32))
            found[-1][is_word] = of_words
        return words, tokens, *found

    def examples(self, lexicon: Lexicon) -> np.ndarray:
        """For every token: the two symbols before it (far, near), and its unit, as three rows."""
        _, tokens, _, unit, context = self.numbered(lexicon)
        return contexts(context, unit, tokens)


def gathered(batches: Iterator[pa.RecordBatch], enough: int) -> Iterator[tuple[list[pa.RecordBatch], Texts]]:
    """Batches with the words of their texts, about ``enough`` tokens at once."""
    kept, texts = [], Texts()
    for b in batches_of(batches, 64):
        kept.append(b)
        texts.add(b.column("text"))
        if texts.tokens >= enough:
            yield kept, texts
            kept, texts = [], Texts()
    if kept:
        yield kept, texts
    del kept, texts
    give_back()


def contexts(context: np.ndarray, unit: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    """The two context symbols before each token, 0 before a text's first, and its unit; texts have so many ``tokens`` each."""
    out = np.zeros((3, len(unit)), dtype=np.int32)
    out[0, 2:], out[1, 1:], out[2] = context[:-2], context[:-1], unit
    first = tokens.cumsum() - tokens
    out[:2, first] = 0
    out[0, first[tokens > 1] + 1] = 0
    return out


def start(noise: np.ndarray) -> dict[str, np.ndarray]:
    """The model before training, which gives every unit its share."""
    rng = np.random.default_rng(13)
    return {
        "far": np.zeros((CONTEXT, SIZE), dtype=np.float32), "near": np.zeros((CONTEXT, SIZE), dtype=np.float32),
        "unit": rng.normal(0, 0.3, (UNITS, SIZE)).astype(np.float32), "bias": np.log(noise).astype(np.float32),
    }


def _scatter(rows: np.ndarray, values: np.ndarray, size: int) -> np.ndarray:
    """Sums of the values' rows by number."""
    out = np.zeros(size * SIZE // 2, dtype=np.complex64)
    np.add.at(out, PLACES.take(rows, axis=0).ravel(), values.ravel().view(np.complex64))
    return out.view(np.float32).reshape(size, SIZE)


class RowAdam(Adam):
    """Adam where the tables named ``sparse`` have gradients in few rows a step.

    A row without a gradient still moves: its first moment shrinks by 0.9 a step and the root of its second by that of
    0.999, so that all its moves since it was last stepped are one multiple of the last. ``ready`` makes them up for
    the rows that are about to be read, ``settle`` for all.
    """

    #: Steps after which all rows are settled, so that the sums below keep their precision.
    SPAN = 200
    FADE = 0.9 / 0.999**0.5

    def __init__(self, params: dict[str, np.ndarray], rate: float, sparse: tuple[str, ...]):
        self.whole = Adam({k: v for k, v in params.items() if k not in sparse}, rate)
        self.params, self.rate, self.step, self.base = params, rate, 0, 0
        #: First and second moments side by side, and steps after base, when a row was last stepped.
        self.moments = {k: np.zeros((len(params[k]), 2 * SIZE), dtype=np.float32) for k in sparse}
        self.last = {k: np.zeros(len(params[k]), dtype=np.int64) for k in sparse}
        self.held: dict[str, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        #: Of so many steps after base: the sum of rates, each faded by its steps; what moments and moves shrink by.
        steps = np.arange(self.SPAN + 1)
        self.rates, self.fade = np.zeros(self.SPAN + 1), self.FADE**steps
        self.shrunk = np.repeat(np.stack([0.9**steps, 0.999**steps], axis=1), SIZE, axis=1).astype(np.float32)

    @staticmethod
    def _move(moments: np.ndarray) -> np.ndarray:
        out = np.sqrt(moments[:, SIZE:])
        out += np.float32(1e-8)
        return np.divide(moments[:, :SIZE], out, out=out)

    def ready(self, rows: dict[str, np.ndarray]) -> None:
        """Bring the rows to the present step. The next ``update`` takes their gradients, and none of other rows."""
        now = self.step - self.base
        for k, at in rows.items():
            last, moments, values = self.last[k].take(at), self.moments[k].take(at, axis=0), self.params[k].take(at, axis=0)
            move = self._move(moments)
            move *= ((self.rates[now] - self.rates[last]) / self.fade[last]).astype(np.float32)[:, None]
            values -= move
            moments *= self.shrunk.take(now - last, axis=0)
            self.params[k][at] = values
            self.held[k] = at, moments, values

    def settle(self) -> None:
        """Bring all rows to the present step."""
        self.ready({k: np.arange(len(v)) for k, v in self.moments.items()})
        for k, (_, moments, _) in self.held.items():
            self.moments[k] = moments
            self.last[k][:] = 0
        self.base, self.held = self.step, {}

    def update(self, grads: dict[str, np.ndarray], scale: float = 1.0) -> None:
        self.step += 1
        rate, now = self.rate_at(scale), self.step - self.base
        self.whole.update({k: g for k, g in grads.items() if k not in self.moments}, scale)
        self.rates[now] = self.rates[now - 1] + rate * self.fade[now]
        for k, (at, moments, values) in self.held.items():
            g = grads[k].take(at, axis=0)
            both = np.concatenate([g, g * g], axis=1)
            both -= moments
            both *= RATES
            moments += both
            move = self._move(moments)
            move *= np.float32(rate)
            values -= move
            self.params[k][at], self.moments[k][at], self.last[k][at] = values, moments, now
        self.held = {}
        if now == self.SPAN:
            self.settle()


class Trainer:
    """Noise-contrastive estimation on one task's tokens, from a given model.

    A unit's score is the product of its vector with the sum of the context's two vectors (one table for each
    place), plus its bias. A batch shares its noise units, so that all scores are one matrix product.
    """

    def __init__(self, model: dict[str, np.ndarray], noise: np.ndarray, steps: float, rate: float):
        self.p = {k: v.copy() for k, v in model.items()}
        self.edge, self.log_noise = np.cumsum(noise), np.log(NOISE * noise).astype(np.float32)
        self.adam, self.rng, self.steps = RowAdam(self.p, rate, ("far", "near")), np.random.default_rng(17), max(steps, 1.0)
        self.seen = {"far": np.zeros(CONTEXT), "near": np.zeros(CONTEXT)}
        self.tokens = 0

    def learn(self, found: np.ndarray, passes: int) -> None:
        self.tokens += found.shape[1]
        for k, row in (("far", 0), ("near", 1)):
            self.seen[k] += np.bincount(found[row], minlength=CONTEXT)
        for _ in range(passes):
            mixed = found.take(self.rng.permutation(found.shape[1]), axis=1)
            for k in range(0, mixed.shape[1], BATCH):
                self._step(*mixed[:, k : k + BATCH])

    def _step(self, far: np.ndarray, near: np.ndarray, u: np.ndarray) -> None:
        p = self.p
        self.adam.ready({k: np.flatnonzero(np.bincount(x, minlength=CONTEXT)) for k, x in (("far", far), ("near", near))})
        false = np.minimum(np.searchsorted(self.edge, self.rng.random(NOISE)), UNITS - 1)
        # Contexts with a one, noise units with their part of the score that no context changes.
        h1, false1 = np.ones((len(u), SIZE + 1), dtype=np.float32), np.empty((NOISE, SIZE + 1), dtype=np.float32)
        h, true_vectors, false_vectors = p["far"].take(far, axis=0), p["unit"].take(u, axis=0), p["unit"][false]
        h += p["near"].take(near, axis=0)
        h1[:, :SIZE] = h
        np.negative(false_vectors, out=false1[:, :SIZE])
        np.subtract(self.log_noise[false], p["bias"][false], out=false1[:, SIZE])
        true = np.einsum("ij,ij->i", h, true_vectors) + p["bias"][u] - self.log_noise[u]
        g_true = (sigmoid(true) - 1) / BATCH
        # The logistic function of the noise units' scores in place, from its definition; where exp is infinite it is 0.
        g_wrong = h1 @ false1.T
        with np.errstate(over="ignore"):
            np.exp(g_wrong, out=g_wrong)
        g_wrong += 1
        np.divide(np.float32(1 / BATCH), g_wrong, out=g_wrong)
        back = g_wrong @ false_vectors
        true_vectors *= g_true[:, None]
        back += true_vectors
        of_false = g_wrong.T @ h1
        h *= g_true[:, None]
        unit = _scatter(u, h, UNITS)
        np.add.at(unit, false, of_false[:, :SIZE])
        grads = {
            "far": _scatter(far, back, CONTEXT), "near": _scatter(near, back, CONTEXT), "unit": unit,
            "bias": (np.bincount(u, g_true, UNITS) + np.bincount(false, of_false[:, SIZE], UNITS)).astype(np.float32),
        }
        self.adam.update(grads, 0.05 ** min(self.adam.step / self.steps, 1.0))

    def rows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Slot, weight and values of each row that was trained: far, near, then units with their bias."""
        self.adam.settle()
        none = np.zeros((CONTEXT, 1), dtype=np.float32)
        values = np.concatenate([
            np.hstack([self.p["far"], none]), np.hstack([self.p["near"], none]), np.hstack([self.p["unit"], self.p["bias"][:, None]]),
        ])
        weight = np.concatenate([self.seen["far"], self.seen["near"], np.full(UNITS, float(self.tokens))])
        at = np.flatnonzero(weight)
        return at, weight[at], values[at]


def mixed(model: dict[str, np.ndarray], slots: np.ndarray, values: np.ndarray) -> dict[str, np.ndarray]:
    """The model with the rows that were trained put in."""
    rows = np.concatenate([
        np.pad(model["far"], ((0, 0), (0, 1))), np.pad(model["near"], ((0, 0), (0, 1))), np.hstack([model["unit"], model["bias"][:, None]]),
    ])
    rows[slots] = values
    far, near, unit = np.split(rows, [CONTEXT, 2 * CONTEXT])
    return {k: np.ascontiguousarray(v) for k, v in (("far", far[:, :-1]), ("near", near[:, :-1]), ("unit", unit[:, :-1]), ("bias", unit[:, -1]))}


class Factors:
    """exp of every far symbol's and every near symbol's part of the units' scores, divided by its largest, and the largests' logs.

    A context's normaliser is then the product of two rows, without an exp for each of its units.
    """

    def __init__(self, p: dict[str, np.ndarray]):
        self.p = p
        self.far, self.far_top = self._exp(p["far"] @ p["unit"].T)
        self.near, self.near_top = self._exp(p["near"] @ p["unit"].T + p["bias"])

    @staticmethod
    def _exp(z: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        top = z.max(axis=1)
        z -= top[:, None]
        return np.exp(z, out=z), top

    def log_sums(self, far: np.ndarray, near: np.ndarray) -> np.ndarray:
        """Log of the sum of exp of all units' scores after each context."""
        found = np.vecdot(self.far.take(far, axis=0), self.near.take(near, axis=0))
        # Where both parts have their largest at units that the other all but rules out, single precision may lose the sum.
        lost = np.flatnonzero(found < 1e-20)
        found[lost] = 1
        out = np.log(found) + self.far_top[far] + self.near_top[near]
        if len(lost):
            z, top = self._exp((self.p["far"][far[lost]] + self.p["near"][near[lost]]) @ self.p["unit"].T + self.p["bias"])
            out[lost] = np.log(z.sum(axis=1)) + top
        return out


def log_probabilities(p: dict[str, np.ndarray], found: np.ndarray, known: np.ndarray, factors: Factors | None = None) -> np.ndarray:
    """log10 probability of every token's unit after its context, normalised over all units by batched products.

    ``known`` (CONTEXT * CONTEXT numbers, 81 MB at most) keeps the normaliser of every context seen so far, 0 where there
    is none yet, so that a task computes each once. ``factors`` are those of ``p``, for callers with several batches.
    """
    factors = factors or Factors(p)
    at = found[0].astype(np.int64) * CONTEXT + found[1]
    codes = np.unique(at[known[at] == 0])
    for k in range(0, len(codes), 256):
        known[codes[k : k + 256]] = factors.log_sums(*np.divmod(codes[k : k + 256], CONTEXT))
    out = np.empty(found.shape[1])
    for k in range(0, len(out), 16384):
        far, near, unit = found[:, k : k + 16384]
        h = p["far"].take(far, axis=0)
        h += p["near"].take(near, axis=0)
        own = np.einsum("ij,ij->i", h, p["unit"].take(unit, axis=0)) + p["bias"][unit]
        out[k : k + 16384] = (own - known[at[k : k + 16384]]) / np.log(10)
    return out


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    words: list[pa.Array] = []
    held, n = [], 0

    def counts() -> pa.Table:
        """Counts of what is held and of the words gathered since."""
        if words:
            found = pa.chunked_array(words).value_counts()
            held.append(pa.table([found.field("values"), found.field("counts")], ["word", "n"]))
        words.clear()
        return pa.concat_tables(held).group_by("word", use_threads=False).aggregate([("n", "sum")]).rename_columns(["word", "n"])

    for b in batches_of(batches, 64):
        words.append(words_in(b.column("text"))[0])
        n += len(words[-1])
        if n >= COUNTED:
            held, n = [counts()], 0
            if held[0].num_rows > HELD:
                yield from held.pop().to_batches()
    if words or held:
        yield from counts().to_batches()


def _signed(word: bytes) -> int:
    code = xxhash.xxh3_64_intdigest(word)
    return code - (1 << 64) if code >> 63 else code


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        words = b.column("word").to_pylist()
        yield pa.record_batch(
            [pa.array([_signed(w) for w in words], pa.int64()), b.column("word"), pa.array([w[-2:] for w in words], pa.binary()), b.column("n")],
            ["code", "word", "ending", "n"],
        )


def _frequent(counts: DataFrame) -> list[tuple[bytes, int]]:
    """Words by falling count: all from the least count class on with which they are BROADCAST_WORDS at most.

    Sizes of count classes tell where to cut, so that no task sends the driver more than its part of these words;
    a sort with a limit would get that many from each.
    """
    level = F.floor(F.log2(F.col("n").cast("double")) * 16)
    least, held = None, 0
    for r in counts.groupBy(level.alias("level")).agg(F.count("*").alias("words")).orderBy(F.desc("level")).collect():  # 1024 rows at most
        held += r["words"]
        if held > BROADCAST_WORDS:
            break
        least = r["level"]
    if least is None:
        return []
    found = counts.where(level >= least).select("word", "n").collect()
    return sorted(((bytes(r["word"]), r["n"]) for r in found), key=lambda r: (-r[1], r[0]))


def _trained(texts: DataFrame, model: dict[str, np.ndarray], noise: np.ndarray, lexicon: Broadcast, tokens: float, rate: float) -> dict[str, np.ndarray]:
    """One round of training on all tokens of ``texts``: each task goes on from ``model``, and Spark averages their rows.

    A row of a context symbol weighs as often as the task saw it, a unit's as the task's tokens. About ``tokens`` tokens are
    expected; where a task would get fewer than SHARD_TOKENS there are fewer tasks, and where even one does it passes over them again.
    """
    spark = texts.sparkSession
    parts = max(1, min(texts.rdd.getNumPartitions(), int(tokens // SHARD_TOKENS)))
    passes = max(1, min(64, round(SHARD_TOKENS / max(tokens, 1.0))))
    steps = passes * tokens / parts / BATCH
    begun = spark.sparkContext.broadcast(model)

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trainer = Trainer(begun.value, noise, steps, rate)
        for _, some in gathered(batches, CHUNK):
            trainer.learn(some.examples(lexicon.value), passes)
        slots, weight, values = trainer.rows()
        yield pa.record_batch(
            [pa.array(slots, pa.int64()), pa.array(weight), pa.FixedSizeListArray.from_arrays(pa.array(values.ravel(), pa.float32()), SIZE + 1).cast(pa.list_(pa.float32()))],
            ["slot", "weight", "row"],
        )

    mean = [(F.sum(F.col("weight") * F.col("row")[i]) / F.sum("weight")).alias(f"v{i}") for i in range(SIZE + 1)]
    # 2 * CONTEXT + UNITS rows at most, whatever the input.
    found = texts.coalesce(parts).mapInArrow(learn, "slot long, weight double, row array<float>").groupBy("slot").agg(*mean).toArrow()
    if not found.num_rows:
        return model
    values = np.stack([found.column(f"v{i}").to_numpy() for i in range(SIZE + 1)], axis=1)
    return mixed(model, found.column("slot").to_numpy(), values)


def lm_scores(docs: DataFrame, learn: Column) -> DataFrame:
    """Score every text by a log-bilinear language model learnt from the rows where ``learn`` holds.

    Words of all training texts are counted. The model predicts a token's unit (a frequent word, the end, or the
    class of a rare word's ending) from the two symbols before it. It is trained in numpy by noise-contrastive
    estimation on all training tokens where they lie, in two rounds: a part of the documents first, then all; the
    tasks' models are averaged in Spark. Scoring normalises over all units by batched matrix products; a class
    shares its probability among its words in proportion to count + 1, with one share for the unseen. Counts of the BROADCAST_WORDS most frequent words go to every task,
    those of all others are joined by a 64-bit hash of the word.

    Columns: doc_id, n_tokens, n_known, train_tokens, base_score (unigrams with add-one smoothing) and score, both
    log10 of the text's probability. Null and empty texts are the end alone. Without training rows both scores are
    0. Repeated rows each give a row; other columns are ignored.
    """
    spark = docs.sparkSession
    taught = docs.where(learn).select("text")
    counts = stored(
        taught.mapInArrow(_count_words, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))
        .mapInArrow(_hashed, "code long, word binary, ending binary, n long"), "counts",
    )
    ends = taught.count()
    total, kinds = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    total, kinds = total + ends, kinds + (ends > 0)
    frequent = _frequent(counts)
    # Words that are units of their own have no part in the classes.
    lone = {w for w, _ in frequent[: WORDS - 1]}
    # An ending is two bytes or one: 65792 rows at most.
    by_end = {bytes(r["ending"]): [r["n"], r["v"]] for r in counts.groupBy("ending").agg(F.sum("n").alias("n"), F.count("*").alias("v")).collect()}
    for w, n in frequent:
        if w in lone:
            by_end[w[-2:]][0] -= n
            by_end[w[-2:]][1] -= 1
    endings = sorted(((e, n, v) for e, (n, v) in by_end.items() if v > 0), key=lambda r: (-r[1], r[0]))[:CLASSES]
    rest = (
        total - ends - sum(n for w, n in frequent if w in lone) - sum(n for _, n, _ in endings),
        kinds - (ends > 0) - len(lone) - sum(v for _, _, v in endings),
    )
    lexicon = spark.sparkContext.broadcast(Lexicon(frequent, endings, ends, rest))

    noise = lexicon.value.noise()
    model = start(noise)
    if ends:
        warm = taught.where(F.pmod(F.xxhash64("text"), F.lit(WARM)) == 0)
        model = _trained(warm, model, noise, lexicon, total / WARM, 0.02)
        model = _trained(taught, model, noise, lexicon, total, 0.01)
    model = spark.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, p = lexicon.value, model.value
        known_contexts, factors = np.zeros(CONTEXT * CONTEXT, dtype=np.float32), Factors(p)
        log_count, is_known = np.log10(held.count + 1), held.count > 0
        for kept, some in gathered(batches, SCORED):
            words, tokens, ids, unit, context = some.numbered(held)
            usual, n = ids >= 0, len(tokens)
            of_text = np.repeat(np.arange(n), tokens)
            logs = np.where(usual, log_count[ids], 0.0)
            lm = np.where(unit >= WORDS, logs - held.share[unit], 0.0) + log_probabilities(p, contexts(context, unit, tokens), known_contexts, factors)
            # Words that are not frequent: each once for a text, by hash, with the times that it stands there.
            rare = np.flatnonzero(~usual)
            coded = words.take(pa.array(rare - of_text[rare])).dictionary_encode()  # before a word stand an end for each text before, and words
            codes = np.array([_signed(w) for w in coded.dictionary.to_numpy(zero_copy_only=False).tolist()], dtype=np.int64)
            pairs, times = np.unique(of_text[rare] * len(rare) + coded.indices.to_numpy(), return_counts=True)
            text, word = np.divmod(pairs, max(len(rare), 1))
            ends = pa.array(np.concatenate([[0], np.bincount(text, minlength=n).cumsum()]), pa.int32())
            yield pa.record_batch(
                [pa.concat_arrays([b.column("doc_id") for b in kept]), pa.array(tokens, pa.int64()), pa.array(np.bincount(of_text, usual & is_known[ids], n).astype(np.int64)),
                 pa.array(np.bincount(of_text, logs, n)), pa.array(np.bincount(of_text, lm, n)),
                 pa.ListArray.from_arrays(ends, pa.array(codes[word])), pa.ListArray.from_arrays(ends, pa.array(times, pa.int32()))],
                ["doc_id", "n_tokens", "known", "logs", "lm", "codes", "times"],
            )

    scored = stored(
        docs.select("doc_id", "text").mapInArrow(score, "doc_id long, n_tokens long, known long, logs double, lm double, codes array<long>, times array<int>")
        .withColumn("row", F.monotonically_increasing_id()), "scored",
    )
    rare = scored.select("row", F.explode(F.arrays_zip("codes", "times")).alias("w")).select("row", F.col("w.codes").alias("code"), F.col("w.times").alias("times"))
    found = (
        rare.join(counts.select("code", F.log10(F.col("n") + 1).alias("log_n")), "code")
        .groupBy("row").agg(F.sum("times").alias("more"), F.sum(F.col("times") * F.col("log_n")).alias("more_logs"))
    )
    base = float(np.log10(total + kinds + 1))
    extra = F.coalesce("more_logs", F.lit(0.0))
    return scored.drop("codes", "times").join(found, "row", "left").select(
        "doc_id", "n_tokens", (F.col("known") + F.coalesce("more", F.lit(0))).alias("n_known"), F.lit(total).cast("long").alias("train_tokens"),
        (F.col("logs") + extra - F.col("n_tokens") * base).alias("base_score"),
        (F.col("lm") + extra if ends else F.lit(0.0)).alias("score"),
    )
