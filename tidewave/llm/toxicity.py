"""Toxicity by weak supervision: voters, a generative label model, a linear classifier."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewave.llm.common import batches_of, class_share, labelled_sample, sigmoid, stored, words_of

#: Labelled documents whose votes fit the label model and train the classifier, half of each class where there are so many.
FIT_ROWS = 8000
#: Lexicon voters of each kind, and words that each kind of lexicon holds at most.
VOTERS, LEXICON = 8, 4000
STEPS, RATE = 1500, 20.0
#: Least log-likelihood gain (nats) by which a term must favour one class, to be in a lexicon.
GAIN = 8.0
#: Least odds ratio of a lexicon term and of an input of the classifier.
CHOICE, ODDS = 8, 15
#: Insults that need no labels; each is a voter of its own.
SEED = tuple(b"idiot moron stupid scum trash loser pathetic worthless disgusting clown dumb imbecile".split())
ADDRESS = frozenset("you your you're u tu te toi vous ton ta du dich dir dein sie ihr usted eres ti".encode().split())
REPORT = frozenset("said says called calls word words wrote term quote quoted dit sagte dijo".encode().split())
THREAT = re.compile(rb"\b(?:kill|hurt|burn|destroy|shut)\s+(?:you|up|them)\b|\bgo\s+(?:die|away)\b|\bva-t'en\b|\bhau\s+ab\b")
MARKS = re.compile(rb"[#!*?]{2,}")
DISGUISE = bytes.maketrans(b"0134578@$!|", b"oieastbasil")
EDGE = b".,;:!?\"'()[]{}*&$%#|<>+=-_"
KINDS = ("word", "head", "tail")
PATTERNS = 15
#: Numbers of a text's lexicon terms that are voters of their own.
SEVERAL = (3, 6, 12)


def terms_of(text: str | None) -> set[bytes]:
    """The text's distinct terms: words without their marks (w), and heads (h) and tails (t) of longer words."""
    out = set()
    for w in set(words_of(text)):
        w = w.strip(EDGE)
        if w:
            out.add(b"w" + w)
            if len(w) >= 6:
                s = w.decode("utf-8", "ignore")
                out.add(b"h" + s[:5].encode())
                if len(s) >= 8:
                    out.add(b"h" + s[:7].encode())
                out.add(b"t" + s[-4:].encode())
    return out


def lexicons(sample: DataFrame, totals: tuple[int, int]) -> dict[bytes, int]:
    """Terms far more usual in labelled toxic documents than in others, each with the voter that it belongs to."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[bytes, list[int]] = {}
        for b in batches_of(batches, 256):
            for text, label in zip(b.column("text").to_pylist(), b.column("label").to_pylist()):
                for t in terms_of(text):
                    seen.setdefault(t, [0, 0])[label] += 1
            if len(seen) > 400_000:
                yield _counts(seen)
                seen = {}
        yield _counts(seen)

    rate = min(max(totals[1] / max(1, sum(totals)), 1e-3), 1 - 1e-3)
    n = F.col("n0") + F.col("n1")
    half = lambda k, p: F.col(k) * F.log(F.greatest(F.col(k), F.lit(1e-9)) / (n * p))
    gain = half("n1", rate) + half("n0", 1 - rate)
    counted = stored(
        sample.mapInArrow(count, "term binary, n0 long, n1 long").groupBy("term")
        .agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")).withColumn("gain", gain)
        .where((F.col("gain") >= GAIN) & (F.col("n1") * (1 - rate) >= CHOICE * rate * F.col("n0"))), "terms",
    )
    # Counts of gain levels tell where to cut, so that the driver gets 3 * LEXICON terms at most.
    level, least, held = F.floor(F.log2("gain") * 32), math.inf, 0
    for r in counted.groupBy(level.alias("level")).agg(F.count("*").alias("n")).orderBy(F.desc("level")).collect():  # some hundred rows
        held += r["n"]
        if held > 3 * LEXICON:
            break
        least = r["level"]
    found = counted.where(level >= least).select("term", "gain").collect() if least < math.inf else []
    return tiers([bytes(r["term"]) for r in sorted(found, key=lambda r: (-r["gain"], bytes(r["term"])))])


def tiers(terms: list[bytes]) -> dict[bytes, int]:
    """The voter of each term; ``terms`` come by falling gain. The 1st, next 2, next 4 ... of a kind vote together, the rest last."""
    voters, seen = {}, dict.fromkeys(b"wht", 0)
    for term in terms:
        kind = term[0]
        seen[kind] += 1
        voters[term] = b"wht".index(kind) * VOTERS + min(seen[kind].bit_length(), VOTERS) - 1
    return voters


def _counts(seen: dict) -> pa.RecordBatch:
    return pa.record_batch(
        [pa.array(list(seen), pa.binary()), pa.array([v[0] for v in seen.values()], pa.int64()), pa.array([v[1] for v in seen.values()], pa.int64())],
        ["term", "n0", "n1"],
    )


def votes_of(text: str | None, terms: set[bytes], lexicon: dict[bytes, int]) -> np.ndarray:
    """1 where a voter finds signs of toxicity, -1 where it finds signs of a clean text, 0 where it abstains.

    First the insults of SEED one by one, then PATTERNS about them and about the prose, none of which has seen a label;
    last the lexicon voters, whose terms were chosen by labels.
    """
    words = words_of(text)
    bare = [w.strip(EDGE) for w in words]
    at = [i for i, w in enumerate(bare) if w in _SEEDS]
    found = [b"w" + s in terms for s in SEED]
    raw = text.encode("utf-8", "surrogatepass") if text else b""
    near = lambda i, back, ahead: bare[max(0, i - back) : i + ahead + 1]
    quoted = [i for i in at if words[i][:1] in b"\"'(" and words[i][-1:] in b"\"'),."]
    hidden = any(w.translate(DISGUISE, b"*.-_") in _SEEDS for w in set(bare) if w not in _SEEDS and not w.isalpha())
    derived = any(t[:1] == b"w" and len(t) > 5 and t[1:] not in _SEEDS and t[1:].startswith(SEED) for t in terms)
    capitals = len(_CAPITALS.findall(raw))
    hits = [lexicon[t] for t in terms if t in lexicon]
    calm = not at and not hidden and not derived
    patterns = [
        sum(found) > 1,
        sum(found) > 2,
        len(at) * 100 > len(words),
        any(set(near(i, 3, 3)) & ADDRESS for i in at),
        any(MARKS.search(words[i]) for i in at),
        any(b in _SEEDS for i in at for b in near(i, 6, 0)[:-1]),
        hidden,
        derived,
        THREAT.search(raw.lower()) is not None,
        -(calm and len(words) >= 20),
        -(len(words) < 3),
        -(bool(at) and len(quoted) == len(at)),
        -any(set(near(i, 2, 2)) & REPORT for i in at),
        -(calm and not MARKS.search(raw) and capitals * 10 < len(words)),
        -(not hits and len(words) >= 20),
    ]
    out = np.zeros(len(SEED) + PATTERNS + len(KINDS) * VOTERS + len(SEVERAL), dtype=np.int8)
    out[: len(SEED)] = found
    out[len(SEED) : len(SEED) + PATTERNS] = patterns
    out[[len(SEED) + PATTERNS + h for h in hits]] = 1
    out[-len(SEVERAL) :] = [len(hits) >= n for n in SEVERAL]
    return out


_SEEDS = frozenset(SEED)
_CAPITALS = re.compile(rb"[A-Z]{3,}")
LEVELS = (-1, 0, 1)


def dependency_tree(v: np.ndarray, post: np.ndarray) -> np.ndarray:
    """The parent of each voter (-1: none) in the tree that explains most of what voters have in common beyond the classes.

    A maximum spanning tree over the mutual information of each two voters given the class; ties that are no more than
    chance in a sample of this size are left out.
    """
    n, k = v.shape
    shared = np.zeros((k, k))
    at = [(v == level).astype(np.float64) for level in LEVELS]
    for p in (post, 1 - post):
        total = p.sum() + 1e-9
        rates = [(p @ a) / total for a in at]
        for a, ra in zip(at, rates):
            for b, rb in zip(at, rates):
                both = ((p[:, None] * a).T @ b) / total
                alone = np.maximum(ra[:, None] * rb[None, :], 1e-12)
                shared += total / n * np.where(both > 1e-12, both * np.log(np.maximum(both, 1e-12) / alone), 0)
    np.fill_diagonal(shared, -1)
    shared[shared < 5 / n] = 0
    parent, inside = np.full(k, -1), np.zeros(k, dtype=bool)
    near, source = np.zeros(k), np.full(k, -1)
    for _ in range(k):
        j = int(np.where(inside, -1, near).argmax())
        parent[j] = source[j] if near[j] > 0 else -1
        inside[j] = True
        better = ~inside & (shared[j] > near)
        near[better], source[better] = shared[j][better], j
    return parent


def label_model(votes: np.ndarray, share: float, rounds: int = 60) -> np.ndarray:
    """Posterior of toxicity for each row of votes (1 toxic, -1 clean, 0 abstains), from a generative model.

    The model draws a text's class, then every voter's vote from the class and the vote of one other voter, its parent in
    ``dependency_tree``. Expectation-maximisation estimates accuracies (rates of votes in each class), correlations (how a
    parent's vote changes these rates) and the classes' sizes from the votes, the latter with ``share`` as a guess that counts as much. It starts from the majority of the
    voters, of which about a ``share`` is called toxic; no label is a vote or a start. The tree is drawn anew twice.
    """
    n, k = votes.shape
    at = [(votes == level).astype(np.float64) for level in LEVELS]
    post = balanced(3.0 * ((votes > 0).sum(axis=1) - 0.5 * (votes < 0).sum(axis=1)), share)
    for turn in range(rounds):
        if turn in (0, rounds // 3, 2 * rounds // 3):
            parent = dependency_tree(votes, post)
            above = [np.where(parent >= 0, a[:, np.maximum(parent, 0)], level == 0) for a, level in zip(at, LEVELS)]
        like = []
        for p in (1 - post, post):
            # Where a parent's vote leaves little to learn from, the voter's rate in the class is the guide.
            rate = [(p @ a + 0.5) / (p.sum() + 1.5) for a in at]
            log = np.zeros(n)
            for u in above:
                seen = p @ u
                for a, r in zip(at, rate):
                    both = u * a
                    log += (both * np.log((p @ both + 2 * r) / (seen + 2))).sum(axis=1)
            like.append(log)
        # The classes' sizes: the votes' own and the given share count alike.
        post = balanced(like[1] - like[0], (share + post.mean()) / 2)
    return post


def balanced(ratio: np.ndarray, share: float) -> np.ndarray:
    """Probabilities of log-odds, shifted so that their mean is ``share``."""
    share = min(max(share, 1e-3), 1 - 1e-3)
    low, high = -50.0 - ratio.max(initial=0), 50.0 - ratio.min(initial=0)
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if sigmoid(ratio + mid).mean() < share else (low, mid)
    return sigmoid(ratio + mid)


def train(inputs: list[np.ndarray], target: np.ndarray, terms: list[bytes]) -> tuple[np.ndarray, float]:
    """Logistic regression on the presence of ``terms``, with soft targets; ``inputs`` are their numbers in each text.

    Seed words and terms that favour the toxic class by GAIN nats and ODDS are the inputs; weights start at 0, so
    that a term which only comes along with stronger ones earns little.
    """
    rate = float(np.clip(target.mean(), 1e-3, 1 - 1e-3))
    flat = np.concatenate(inputs) if len(inputs) else np.zeros(0, dtype=np.int32)
    owner = np.repeat(np.arange(len(inputs)), [len(h) for h in inputs])
    n1, n0 = np.bincount(flat, target[owner], len(terms)), np.bincount(flat, 1 - target[owner], len(terms))
    n = np.maximum(n0 + n1, 1e-9)
    gain = n1 * np.log(np.maximum(n1, 1e-9) / (n * rate)) + n0 * np.log(np.maximum(n0, 1e-9) / (n * (1 - rate)))
    ratio = np.log((n1 + 0.5) / rate) - np.log((n0 + 0.5) / (1 - rate))
    chosen = ((gain >= GAIN) & (ratio >= math.log(ODDS))) | np.array([t[:1] == b"w" and t[1:] in _SEEDS for t in terms], dtype=bool)
    keep = chosen[flat]
    flat, owner = flat[keep], owner[keep]
    w = np.zeros(len(terms))
    bias = math.log(rate / (1 - rate)) - 1.5
    for _ in range(STEPS if len(flat) else 0):
        z = np.bincount(owner, w[flat], len(inputs)) + bias
        error = (sigmoid(z) - target) / len(inputs)
        w -= RATE * np.bincount(flat, error[owner], len(terms))
        np.maximum(w - RATE * 2e-6, 0, out=w)
        bias -= 0.1 * error.sum()
    return w, bias


def toxicity(docs: DataFrame, labels: DataFrame, keep) -> DataFrame:
    """(doc_id, score) of every row: the probability that its text is toxic.

    Voters are insults, patterns of insults, threats and disguise, patterns of calm, quoted or reporting prose, and lexicons of
    terms (words, heads and tails of words) that documents labelled toxic hold far more often than others. Labels choose the
    lexicons' terms and tell the share of toxic documents, no more: a generative model estimates the voters' accuracies and
    correlations from their votes, and its posteriors train a linear classifier on the terms, which scores every whole text.
    The sample takes more of the rarer class where labels abound, so the bias is corrected by the labels' own share.
    At most FIT_ROWS documents whose label rows satisfy ``keep`` are read for this; ids are drawn by hash, and the driver gets
    votes and numbers of terms, no text. Null and empty texts get the classifier's bias; without labels all scores are the
    insults'. Repeated rows each give a row, as does a null doc_id, which is never learnt from; of several texts of one labelled
    id, one (the least by its votes) is learnt from; other columns are ignored.
    """
    spark = docs.sparkSession
    marked = labels.withColumn("toxic", (F.col("toxic") > 0).cast("int"))
    sample = labelled_sample(docs.where("text is not null"), marked, "toxic", keep, FIT_ROWS)
    totals = {r["label"]: r["n"] for r in sample.groupBy("label").agg(F.count("*").alias("n")).collect()}
    lexicon = lexicons(sample, (totals.get(0, 0), totals.get(1, 0)))
    terms = sorted({*lexicon, *(b"w" + w for w in SEED)})
    held = spark.sparkContext.broadcast((lexicon, {t: i for i, t in enumerate(terms)}))  # 3 * LEXICON terms at most

    def prepare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        voters, number = held.value
        for b in batches_of(batches, 256):
            votes, inputs = [], []
            for text in b.column("text").to_pylist():
                own = terms_of(text)
                votes.append(votes_of(text, own, voters).tobytes())
                inputs.append(np.array(sorted(number[t] for t in own if t in number), dtype=np.int32).tobytes())
            yield pa.record_batch([b.column("doc_id"), b.column("label"), pa.array(votes, pa.binary()), pa.array(inputs, pa.binary())], ["doc_id", "label", "votes", "inputs"])

    read = sample.mapInArrow(prepare, "doc_id long, label int, votes binary, inputs binary")
    rows = read.groupBy("doc_id").agg(F.min(F.struct("votes", "inputs", "label")).alias("r")).collect()  # FIT_ROWS at most
    if rows:
        rows = [r["r"] for r in sorted(rows, key=lambda r: r["doc_id"])]
        votes = np.frombuffer(b"".join(r["votes"] for r in rows), dtype=np.int8).reshape(len(rows), -1)
        drawn = min(max(totals.get(1, 0) / max(1, sum(totals.values())), 1e-4), 1 - 1e-4)
        target = label_model(votes, min(max(drawn, 0.01), 0.99))
        weights, bias = train([np.frombuffer(r["inputs"], dtype=np.int32) for r in rows], target, terms)
        known = class_share(marked, "toxic", keep)
        bias += math.log(known / (1 - known)) - math.log(drawn / (1 - drawn))
    else:
        weights, bias = np.array([8.0 * (t[1:] in _SEEDS) for t in terms]), -3.0
    model = spark.sparkContext.broadcast(({t: float(w) for t, w in zip(terms, weights) if w}, bias))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, bias = model.value
        for b in batches_of(batches, 256):
            out = [bias + sum(table[t] for t in terms_of(text) & table.keys()) for text in b.column("text").to_pylist()]
            yield pa.record_batch([b.column("doc_id"), pa.array(sigmoid(np.array(out, dtype=np.float64)))], ["doc_id", "score"])

    return docs.select("doc_id", "text").mapInArrow(score, "doc_id long, score double")
