"""Corpus operators against plain versions on small tables, and on odd rows."""

import collections
import json
import math
import re
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
import public_tokenizers
from pyspark.sql import functions as F

from tidewave.llm import decontaminate, embed_dedup, language_id, license_scan, line_crf, lm_score, ngram_join, packing, toxicity, url_filter
from tidewave.llm.common import Adam, fold_of, without, words_of
from tidewave.llm.graph import connected_components

SF = "/root/testdata/sf0.01"
TOKENIZER = str(public_tokenizers.path("word_bpe_49k.json"))
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, rep long, slot int"


def odd_rows():
    """Nulls, empty and blank texts, a repeated row, ties, a very long text, and clashing extra columns."""
    long = " ".join(f"w{i % 977}x{i}" for i in range(30000))
    texts = [(1, None), (2, ""), (3, " \t\n"), (4, "one two"), (4, "one two"), (5, "ONE TWO"), (6, long), (7, long + " more"), (8, "a\x1cb é́ 12 <|endoftext|> don't"), (9, "... !!! 123")]
    return [(i, t, None if i == 9 else "en", "s", None, 0.5, 7, 1) for i, t in texts]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet(f"{SF}/labels.parquet")


def shingle_set(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]+", lambda m: m[0].lower(), text or ""))
    return {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()


def brute_classes(rows):
    sets = [(i, shingle_set(t)) for i, t in rows]
    up = {i: i for i, _ in sets}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for n, (i, a) in enumerate(sets):
        for j, b in sets[:n]:
            both = len(a & b)
            if both and 100 * both >= 75 * (len(a) + len(b) - both):
                x, y = find(i), find(j)
                up[max(x, y)] = min(x, y)
    return {(i, len(s), find(i)) for i, s in sets}


def test_components_of_paths_stars_and_loops(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 130)] + [(7, 7), (None, 3)]
    found = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {k: 0 for k in range(41)} | {k: 100 for k in range(100, 130)}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_without_is_an_anti_join(spark, docs):
    drop = docs.where("doc_id % 3 = 0").select("doc_id")
    assert without(docs, drop).exceptAll(docs.where("doc_id % 3 != 0")).isEmpty()
    assert without(docs, drop).count() == docs.where("doc_id % 3 != 0").count()


def near_copies(spark):
    rng = np.random.default_rng(4)
    base = [f"v{i}" for i in rng.integers(0, 400, 160)]
    rows = []
    for i in range(120):  # a group of near copies whose members link with some of the others only
        w = list(base)
        for k in rng.choice(160, rng.integers(0, 12), False):
            w[k] = f"x{rng.integers(0, 10**6)}"
        rows.append((i, " ".join(w)))
    passage = " ".join(f"p{i}" for i in range(60))
    rows += [(200 + i, passage + " " + " ".join(f"q{i}_{k}" for k in range(i % 40))) for i in range(80)]
    return spark.createDataFrame(rows, "doc_id long, text string"), rows


def test_op1_near_copies_equal_brute_force(spark):
    df, rows = near_copies(spark)
    assert {tuple(r) for r in ngram_join.shingle_classes(df).collect()} == brute_classes(rows)


def test_op1_blocks_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "CROWD", 10)
    monkeypatch.setattr(ngram_join, "CHUNK", 16)
    df, rows = near_copies(spark)
    assert {tuple(r) for r in ngram_join.shingle_classes(df).collect()} == brute_classes(rows)


def test_op1_deals_prefixes_to_blocks_and_each_set_once(spark):
    rng = np.random.default_rng(3)
    texts = [" ".join(map(str, np.where(rng.random(60) < 0.02 * (i % 5), rng.integers(0, 9, 60), np.arange(60) + 60 * (i // 20)))) for i in range(60)]
    sets, rank = [ngram_join.shingles(t) for t in texts], np.zeros(ngram_join.BITS // 8, dtype=np.uint8)
    rows = [{"rep": i, "n": len(x), "part": i % 7, "role": k, "start": x[: ngram_join.prefix_size(len(x))].view(np.int64)} for k in (0, 1) for i, x in enumerate(sets)]
    got = {tuple(r) for r in ngram_join._cross(pd.DataFrame(rows), rank).itertuples(index=False)}
    link = {(a, b) for a in range(60) for b in range(a + 1, 60) if a % 7 != b % 7 and 100 * len(np.intersect1d(sets[a], sets[b])) >= 75 * len(np.union1d(sets[a], sets[b]))}
    assert link and link <= got and len(got) < 30 * 59 / 2
    pairs, base = spark.createDataFrame([(1, 2)], "a long, b long"), spark.createDataFrame([(1, "a b"), (2, "a c")], "doc_id long, text string")
    plan = ngram_join._verified(pairs, ngram_join._sets(base, pairs))._jdf.queryExecution().toString().split("Physical Plan")[1]
    assert not re.search(r"hashpartitioning\(rep#\d+L?, held", plan)


def test_op1_blocks_return_no_pairs(spark, monkeypatch):
    """A group whose prefixes let nearly all pairs link, while few do: what is stored grows with its members."""
    monkeypatch.setattr(ngram_join, "CROWD", 10)
    counts, plain = {}, ngram_join.stored

    def stored(df, name="step"):
        found = plain(df, name)
        counts[name] = max(counts.get(name, 0), found.count())
        return found

    monkeypatch.setattr(ngram_join, "stored", stored)
    rng = np.random.default_rng(6)
    rows = []
    for i in range(160):
        w = [f"c{k}" for k in range(200)]
        for k in rng.choice(200, rng.integers(6, 8), False):
            w[k] = f"x{i}_{k}"
        rows.append((i, " ".join(w)))
    sets = [ngram_join.shingles(t) for _, t in rows]
    near = sum(100 * len(np.intersect1d(x, y)) >= 60 * len(np.union1d(x, y)) for i, x in enumerate(sets) for y in sets[:i])
    assert {tuple(r) for r in ngram_join.shingle_classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()} == brute_classes(rows)
    assert near < 160 * 159 / 2 and 0 < counts["near"] <= 6 * 160 and counts["links"] < 6 * 160, (near, counts)


def test_op1_odd_rows(odd, empty):
    found = sorted({tuple(r) for r in ngram_join.shingle_classes(odd).collect()})
    assert found == sorted(brute_classes([(r[0], r[1]) for r in odd_rows()]))
    assert ngram_join.shingle_classes(odd).count() == 10
    assert ngram_join.shingle_classes(empty).count() == 0


def test_op1_ids_with_several_texts_and_rows_without_id(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(30)) for x in "abc")
    rows = [(3, b), (5, a), (5, b), (9, a + " end"), (None, a), (None, None), (7, c), (8, None), (8, c), (2, ""), (6, "x")]
    found = sorted((tuple(r) for r in ngram_join.shingle_classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()), key=repr)
    assert found == sorted([(3, 26, 3), (5, 26, 3), (5, 26, 3), (9, 27, 3), (None, 26, None), (None, 0, None), (7, 26, 7), (8, 0, 7), (8, 26, 7), (2, 0, 2), (6, 1, 6)], key=repr)
    rng = np.random.default_rng(8)
    df, near = near_copies(spark)
    ids = {i: int(rng.integers(0, 120)) for i, _ in near}  # ids with none, one or some of the texts
    many = [(ids[i], t) for i, t in near]
    edges = collections.defaultdict(set)
    for i, _, root in brute_classes(near):
        edges["t", root].add(ids[i])
    low = {i: i for i in ids.values()}
    while True:
        new = dict(low)
        for held in edges.values():
            for i in held:
                new[i] = min(new[i], min(low[j] for j in held))
        if new == low:
            break
        low = new
    got = collections.Counter((r["doc_id"], r["component_id"]) for r in ngram_join.shingle_classes(spark.createDataFrame(many, df.schema)).collect())
    assert got == collections.Counter((i, low[i]) for i, _ in many)


@pytest.mark.parametrize("size, area, recall", [("0.01", 0.85, 0.78), ("0.1", 0.95, 0.83)])
def test_op2_tells_toxic_documents(spark, size, area, recall):
    """Held-out labels; most that are missed hold no term that the lexicons have."""
    docs, marks = (spark.read.parquet(f"{SF.replace('0.01', size)}/{name}.parquet") for name in ("documents", "labels"))
    held = marks.where(fold_of("doc_id", 3) == 1)
    found = toxicity.toxicity(docs, marks, fold_of("doc_id", 3) != 1).join(held, "doc_id").collect()
    toxic, clean = (np.array([r["score"] for r in found if bool(r["toxic"]) == k]) for k in (True, False))
    assert np.mean(clean >= 0.7) < 0.02 and np.mean(toxic >= 0.7) > recall
    assert np.mean((toxic[:, None] > clean) + 0.5 * (toxic[:, None] == clean)) > area


def test_op2_odd_rows(odd, empty, labels):
    for table in (odd, empty):
        assert toxicity.toxicity(table, labels, F.lit(True)).count() == table.count()
    assert toxicity.toxicity(odd, labels.limit(0), F.lit(True)).where("score between 0 and 1").count() == 10


def test_op2_label_model_weighs_voters():
    """Voters of both signs, abstentions, and a group that goes together and tells nothing; no label is given."""
    rng = np.random.default_rng(0)
    y = rng.random(3000) < 0.3
    good = np.stack([(rng.random(3000) < np.where(y, 0.6, 0.02)) for _ in range(7)], axis=1).astype(np.int8)
    calm = -np.stack([(rng.random(3000) < np.where(y, 0.1, 0.7)) for _ in range(3)], axis=1).astype(np.int8)
    noise = np.repeat((rng.random(3000) < 0.1)[:, None], 3, axis=1).astype(np.int8)
    post = toxicity.label_model(np.concatenate([good, calm, noise], axis=1), 0.3)
    assert np.mean((post > 0.5) == y) > 0.97


def test_op2_label_model_equals_bayes_with_true_rates():
    """Correlated voters: the posteriors come near those of the model that made the votes, and copies of a voter count once."""
    rng = np.random.default_rng(1)
    y = rng.random(20000) < 0.25
    free = np.stack([rng.random(20000) < np.where(y, 0.7, 0.05) for _ in range(5)], axis=1)
    first = rng.random(20000) < np.where(y, 0.5, 0.2)
    chain = np.stack([np.where(rng.random(20000) < 0.97, first, ~first) for _ in range(6)], axis=1)
    post = toxicity.label_model(np.concatenate([free, first[:, None], chain], axis=1).astype(np.int8), 0.25)
    odds = np.log(1 / 3) + (free * np.log(0.7 / 0.05) + ~free * np.log(0.3 / 0.95)).sum(axis=1) + np.where(first, np.log(0.5 / 0.2), np.log(0.5 / 0.8))
    assert np.mean(np.abs(post - 1 / (1 + np.exp(-odds)))) < 0.03


def test_op2_voters_abstain_fire_and_vote_clean():
    vote = lambda t: toxicity.votes_of(t, toxicity.terms_of(t), {b"wfrob": 0})
    n, names = len(toxicity.SEED), "pair three dense address marks row hidden derived threat calm short quoted report even none".split()
    of = lambda t: {name: int(v) for name, v in zip(names, vote(t)[n : n + toxicity.PATTERNS]) if v}
    calm = " ".join(["the river ran on"] * 8)
    assert of(calm) == {"calm": -1, "even": -1, "none": -1}
    assert of("") == of(None) == {"short": -1}
    assert of("you are an idiot")["address"] == 1 and of("such an id1ot !")["hidden"] == 1 and of("idiots !")["derived"] == 1
    assert of('he read "idiot" aloud')["quoted"] == -1 and of("she said moron twice")["report"] == -1 and of("trash### idiot")["marks"] == 1
    assert of("a stupid idiot moron") == {"pair": 1, "three": 1, "dense": 1, "row": 1}
    assert vote("frob it")[n + toxicity.PATTERNS] == 1 and vote(calm)[n + toxicity.PATTERNS :].any() == False  # noqa: E712
    assert vote(calm + " idiot")[: n].tolist() == [1] + [0] * (n - 1)


def test_op2_posterior_repairs_wrong_labels_and_keeps_the_share(spark, monkeypatch):
    """A tenth of the labels flipped: the posterior is nearer to the true ones than the given ones are. A small sample keeps the base rate."""
    docs, marks = (spark.read.parquet(f"{SF.replace('0.01', '0.1')}/{name}.parquet") for name in ("documents", "labels"))
    keep, held = fold_of("doc_id", 3) != 1, {}
    model = toxicity.label_model
    monkeypatch.setattr(toxicity, "label_model", lambda v, share: held.setdefault("post", model(v, share)))
    wrong = marks.withColumn("toxic", F.when(F.pmod(F.xxhash64("doc_id", F.lit(9)), F.lit(10)) == 0, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    toxicity.toxicity(docs, wrong, keep)
    learnt = wrong.where(keep).join(marks.select("doc_id", F.col("toxic").alias("true")), "doc_id").where("true is not null").orderBy("doc_id").collect()
    true, given = np.array([r["true"] for r in learnt]), np.array([r["toxic"] for r in learnt])
    assert np.mean((held["post"] > 0.5) == true) > np.mean(given == true) + 0.02
    share = marks.where(~keep).agg(F.avg("toxic")).first()[0]
    monkeypatch.setattr(toxicity, "label_model", model)
    monkeypatch.setattr(toxicity, "FIT_ROWS", 500)
    assert abs(toxicity.toxicity(docs, marks, keep).join(marks.where(~keep), "doc_id").agg(F.avg("score")).first()[0] - share) < 0.03


def test_op2_score_equals_plain_sum(odd, labels):
    """Without labels the score of a text is that of its insults, one by one."""
    table = odd.unionByName(odd.limit(0).sparkSession.createDataFrame([(None, "You MORON, you scum! scum", "en", "s", 1, 0.5, 7, 1)], SCHEMA))
    got = collections.Counter((r["doc_id"], round(r["score"], 9)) for r in toxicity.toxicity(table, labels.limit(0), F.lit(True)).collect())
    plain = lambda t: 1 / (1 + math.exp(3 - 8 * len({w.strip(".,!?") for w in (t or "").lower().split()} & {s.decode() for s in toxicity.SEED})))
    assert got == collections.Counter((r["doc_id"], round(plain(r["text"]), 9)) for r in table.collect())


def test_op3_base_score_and_probabilities(spark, odd, empty, docs):
    learn = fold_of("doc_id", 7) != 2
    found = {r["doc_id"]: r for r in lm_score.lm_scores(docs, learn).collect()}
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    taught = [t for i, t in rows if zlib.crc32(str(i).encode()) % 7 != 2]
    c = collections.Counter(w for t in taught for w in words_of(t))
    n, v = sum(c.values()) + len(taught), len(c) + 1
    for i, t in rows:
        w = words_of(t)
        base = sum(math.log10((c[x] + 1) / (n + v + 1)) for x in w) + math.log10((len(taught) + 1) / (n + v + 1))
        assert abs(found[i]["base_score"] - base) < 1e-6 * abs(base)
        assert (found[i]["n_tokens"], found[i]["n_known"], found[i]["train_tokens"]) == (len(w) + 1, sum(c[x] > 0 for x in w) + 1, n)
    held = [r for i, r in found.items() if zlib.crc32(str(i).encode()) % 7 == 2]
    assert sum(r["score"] - r["base_score"] for r in held) > 0.3 * sum(r["n_tokens"] for r in held)
    assert lm_score.lm_scores(odd, F.lit(True)).count() == 10
    assert lm_score.lm_scores(odd, F.lit(False)).where("score = 0 and base_score = 0").count() == 10
    assert lm_score.lm_scores(empty, F.lit(True)).count() == 0


def test_op3_rare_words_are_joined(spark, docs, monkeypatch):
    some, columns = docs.where("doc_id < 150"), ["doc_id", "n_tokens", "n_known", "train_tokens", "base_score"]
    run = lambda: {r[0]: tuple(r) for r in lm_score.lm_scores(some, F.lit(True)).select(*columns).collect()}
    whole = run()
    monkeypatch.setattr(lm_score, "BROADCAST_WORDS", 700)
    cut = run()
    assert all(cut[i] == pytest.approx(whole[i]) for i in whole) and len(cut) == len(whole)


def test_op3_contexts_are_normalised():
    rng = np.random.default_rng(1)
    shapes = {"far": (lm_score.CONTEXT, lm_score.SIZE), "near": (lm_score.CONTEXT, lm_score.SIZE), "unit": (lm_score.UNITS, lm_score.SIZE), "bias": (lm_score.UNITS,)}
    p = {k: rng.normal(0, 0.5, n).astype(np.float32) for k, n in shapes.items()}
    pairs = rng.integers(0, lm_score.CONTEXT, (40, 2))
    found = np.array([(far, near, u) for far, near in pairs for u in range(lm_score.UNITS)], dtype=np.int32).T
    known = np.zeros(lm_score.CONTEXT**2, dtype=np.float32)
    logs = lm_score.log_probabilities(p, found, known).reshape(len(pairs), lm_score.UNITS)
    assert (lm_score.log_probabilities(p, found, known) == logs.ravel()).all() and np.count_nonzero(known) <= len(pairs)
    assert np.allclose((10.0**logs).sum(axis=1), 1, atol=1e-4)
    z = (p["far"][pairs[0, 0]] + p["near"][pairs[0, 1]]) @ p["unit"].T + p["bias"]
    assert np.allclose(10.0 ** logs[0], np.exp(z) / np.exp(z).sum(), rtol=1e-3)


def test_op3_noise_contrast_finds_the_distribution():
    rng = np.random.default_rng(2)
    # Unit 5 follows context 3, unit 9 follows context 4, three times in four; else either comes at random.
    near = rng.integers(3, 5, 60000)
    unit = np.where(rng.random(60000) < 0.5, np.where(near == 3, 5, 9), rng.choice([5, 9], 60000))
    noise = np.bincount(unit, minlength=lm_score.UNITS) + 0.5
    noise /= noise.sum()
    begun = lm_score.start(noise)
    trainer = lm_score.Trainer(begun, noise, 240, 0.02)
    trainer.learn(np.stack([np.zeros(60000), near, unit]).astype(np.int32), 8)
    slots, weight, rows = trainer.rows()
    assert set(slots[slots < 2 * lm_score.CONTEXT]) == {0, lm_score.CONTEXT + 3, lm_score.CONTEXT + 4} and weight[0] == 60000
    model = lm_score.mixed(begun, slots, rows)
    assert all((model[k] == trainer.p[k]).all() for k in model)
    got = 10 ** lm_score.log_probabilities(model, np.array([[0, 0], [3, 4], [5, 5]], dtype=np.int32), np.zeros(lm_score.CONTEXT**2, dtype=np.float32))
    assert got == pytest.approx([0.75, 0.25], abs=0.05)


def test_op3_step_equals_plain_gradients():
    rng = np.random.default_rng(8)
    noise = rng.random(lm_score.UNITS) + 0.1
    noise /= noise.sum()
    trainer = lm_score.Trainer(lm_score.start(noise), noise, 10, 0.01)
    for k, scale in (("far", 0.5), ("near", 0.5), ("unit", 60)):  # scores from -1000 on to 1000 too
        trainer.p[k][:] = rng.normal(0, scale, trainer.p[k].shape)
    p = {k: v.astype(np.float64) for k, v in trainer.p.items()}
    found = {}
    trainer.adam.update = lambda grads, scale: found.update(grads)
    draw = np.random.default_rng(17)
    far, near, u = (rng.integers(0, n, lm_score.BATCH) for n in (50, 50, lm_score.UNITS))
    with np.errstate(over="raise", invalid="raise", divide="raise"):
        trainer._step(far, near, u)
    false = np.minimum(np.searchsorted(np.cumsum(noise), draw.random(lm_score.NOISE)), lm_score.UNITS - 1)
    h = p["far"][far] + p["near"][near]
    logistic = lambda x: 0.5 * (1 + np.tanh(x / 2))
    true = logistic((h * p["unit"][u]).sum(axis=1) + p["bias"][u] - np.log(lm_score.NOISE * noise[u])) - 1
    wrong = logistic(h @ p["unit"][false].T + p["bias"][false] - np.log(lm_score.NOISE * noise[false]))
    want = {k: np.zeros_like(v) for k, v in p.items()}
    back = (true[:, None] * p["unit"][u] + wrong @ p["unit"][false]) / lm_score.BATCH
    np.add.at(want["far"], far, back)
    np.add.at(want["near"], near, back)
    np.add.at(want["unit"], u, true[:, None] * h / lm_score.BATCH)
    np.add.at(want["unit"], false, wrong.T @ h / lm_score.BATCH)
    np.add.at(want["bias"], u, true / lm_score.BATCH)
    np.add.at(want["bias"], false, wrong.sum(axis=0) / lm_score.BATCH)
    assert all(np.allclose(found[k], want[k], rtol=1e-3, atol=1e-3 * np.abs(want[k]).max()) for k in want)


def test_op3_rows_without_gradient_wait():
    """Rows that a batch doesn't name cost nothing in its step, and yet end where plain Adam takes them."""
    rng = np.random.default_rng(9)
    noise = rng.random(lm_score.UNITS) + 0.1
    noise /= noise.sum()
    trainer = lm_score.Trainer(lm_score.start(noise), noise, 300, 0.01)
    plain = Adam({k: v.astype(np.float64) for k, v in trainer.p.items()}, 0.01)
    update = trainer.adam.update
    trainer.adam.update = lambda grads, scale: (plain.update({k: g.astype(np.float64) for k, g in grads.items()}, scale), update(grads, scale))
    for step in range(450):
        names = rng.permutation(60) + 60 * (step % 7 > 0)  # each row is left out for some steps
        before = trainer.p["near"].copy()
        trainer._step(*(names[rng.integers(0, 40, lm_score.BATCH)] for _ in range(2)), rng.integers(0, 9, lm_score.BATCH))
        moved = np.flatnonzero((trainer.p["near"] != before).any(axis=1))
        assert len(moved) <= 40 or (step + 1) % 200 == 0
    trainer.rows()
    for k, v in trainer.p.items():
        assert np.abs(v - plain.params[k]).max() < 1e-3 * np.abs(plain.params[k] - lm_score.start(noise)[k]).max()


def test_op3_words_in_bulk(odd, docs, monkeypatch):
    """Arrow's words are those of ``words_of``, their counts don't hang on how they are gathered, and contexts don't cross texts."""
    texts = [r["text"] for r in odd.select("text").union(docs.select("text").limit(300)).collect()] + ["", " ", None, "\x1c a\x85b\u00a0c\x0b\x0cD \u0130\u00c4 ", "a", "\ta b\n"]
    want = [words_of(t) for t in texts]
    flat = [w for ws in want for w in ws]
    words, sizes = lm_score.words_in(pa.array(texts))
    assert words.to_pylist() == flat and sizes.tolist() == [len(w) for w in want]
    assert lm_score.words_in(pa.array(["x", *texts]).slice(1))[0].to_pylist() == flat

    ranked = collections.Counter(flat).most_common(700)
    lexicon = lm_score.Lexicon(ranked, [(b"on", 5, 2), (b"a", 3, 1)], len(texts), (9, 4))
    batch = pa.record_batch([pa.array(texts)], ["text"])
    (_, some), = lm_score.gathered(iter([batch]), 1 << 30)
    of = {w: (i + 1, lexicon.unit[i + 1], lexicon.context[i + 1]) for i, (w, _) in enumerate(ranked)}
    ends = {b"on": (-1, lm_score.WORDS, lm_score.CONTEXT_WORDS + 1), b"a": (-1, lm_score.WORDS + 1, lm_score.CONTEXT_WORDS + 2)}
    rows = []
    for ws in want:
        tokens = [of.get(w) or ends.get(w[-2:], (-1, lm_score.UNITS - 1, lm_score.CONTEXT - 1)) for w in ws] + [(0, 0, 0)]
        before = [0, 0, *(c for _, _, c in tokens)]
        rows += [(far, near, u) for far, near, (_, u, _) in zip(before, before[1:], tokens)]
    assert some.examples(lexicon).T.tolist() == [list(r) for r in rows]

    for counted, held in ((1 << 20, 500_000), (50, 200), (1, 1)):
        monkeypatch.setattr(lm_score, "COUNTED", counted)
        monkeypatch.setattr(lm_score, "HELD", held)
        found = collections.Counter()
        for b in lm_score._count_words(iter([batch])):
            for r in b.to_pylist():
                found[r["word"]] += r["n"]
        assert found == collections.Counter(flat)
    assert sum(b.num_rows for b in lm_score._count_words(iter([]))) == 0


def test_op3_normaliser_of_opposed_contexts():
    """The product of two rows stands for the sum over units, also where each all but rules out what the other prefers."""
    rng = np.random.default_rng(3)
    p = {k: rng.normal(0, 0.3, (n, lm_score.SIZE)).astype(np.float32) for k, n in (("far", lm_score.CONTEXT), ("near", lm_score.CONTEXT), ("unit", lm_score.UNITS))}
    p["bias"] = rng.normal(0, 1, lm_score.UNITS).astype(np.float32)
    p["far"][7], p["near"][8] = 60 * p["unit"][3], 60 * p["unit"][4] - 60 * p["unit"][3]
    far, near = np.array([7, 7, 1, 2]), np.array([8, 1, 8, 2])
    z = (p["far"][far] + p["near"][near]).astype(np.float64) @ p["unit"].T + p["bias"]
    assert lm_score.Factors(p).log_sums(far, near) == pytest.approx(np.log(np.exp(z - z.max(axis=1)[:, None]).sum(axis=1)) + z.max(axis=1), abs=1e-3)


def plain_ids(text):
    from tokenizers import Tokenizer

    return [] if not text else Tokenizer.from_file(TOKENIZER).encode(text, add_special_tokens=False).ids


def test_op4_pieces_and_sequences(spark, odd, empty, docs):
    some = docs.orderBy("doc_id").limit(120)
    for table in (some, odd):
        rows = packing.packed(table, TOKENIZER).collect()
        want = collections.Counter()
        for r in table.select("doc_id", "text").collect():
            ids = plain_ids(r["text"]) + [0]
            for k in range(0, len(ids), 2048):
                part = ids[k : k + 2048]
                want[(r["doc_id"], k // 2048, k, len(part), zlib.crc32(np.array(part, dtype="<u4").tobytes()))] += 1
        assert collections.Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == want
        held = collections.defaultdict(list)
        for r in rows:
            held[r["sequence_id"]].append((r["offset"], r["length"]))
        for parts in held.values():
            at = 0
            for offset, length in sorted(parts):
                assert offset == at
                at += length
            assert at <= 2048
        assert len(held) <= math.ceil(sum(r["length"] for r in rows) / 2048) * 1.03 + 1
    assert packing.packed(empty, TOKENIZER).count() == 0


def test_op4_workers_forget_the_words_of_a_task(spark, docs):
    assert packing.pieces(docs.where("doc_id < 60"), TOKENIZER).count() >= 60
    packing.pieces(docs.where("doc_id < 60"), TOKENIZER).agg(F.sum("ids_crc32")).collect()

    def held(batches):
        for b in batches:
            coders = packing._WORKER.values()
            yield pa.record_batch([pa.array([len(coders)]), pa.array([sum(len(c.known) for c in coders)])], ["coders", "words"])

    found = spark.range(0, 64, 1, 16).mapInArrow(held, "coders long, words long").agg(F.max("coders"), F.max("words")).first()
    assert tuple(found) == (1, 0)


def test_op4_swaps_empty_bins():
    bins = improved = 0
    for seed in range(20):
        lengths = np.random.default_rng(seed).integers(500, 1100, 60)
        first = packing.best_fit(lengths)
        better = packing.improve(lengths, first)
        assert sorted(sum(better, [])) == list(range(60)) and all(lengths[b].sum() <= 2048 for b in better)
        bins, improved = bins + len(first), improved + len(better)
    assert improved < bins


def test_op5_recall_and_exact_links(spark):
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=32).tolist()) for i in range(800)]
    for g in range(30):
        base = rng.normal(size=32)
        rows += [(1000 + g * 10 + k, (base + rng.normal(size=32) * 0.15).tolist()) for k in range(8)]
    rows += [(5000 + k, rows[0][1]) for k in range(50)]
    x = np.array([v for _, v in rows])
    x /= np.linalg.norm(x, axis=1)[:, None]
    near = x @ x.T >= 0.9
    np.fill_diagonal(near, False)
    odd = [(9001, None), (9002, []), (9003, [0.0] * 32), (9004, [float("nan")] * 32), (9005, [None] * 32)]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>")
    found = {r["vec_id"]: r for r in embed_dedup.near_vectors(df).collect()}
    links = np.array([found[i]["n_links"] for i, _ in rows])
    assert (links <= near.sum(axis=1)).all() and links.sum() >= 0.9 * near.sum()
    assert all(found[i]["n_links"] == 0 and found[i]["kept"] for i, _ in odd)
    assert all(found[5000 + k]["component_id"] == 0 for k in range(50))
    assert embed_dedup.near_vectors(df.limit(0)).count() == 0


def brute_links(rows, least=0.9):
    """(vec_id, links, component, kept) of (vec_id, vector) by all pairs."""
    unit = []
    for _, v in rows:
        x = None if not v or any(c is None for c in v) else np.array(v, dtype=float)
        ok = x is not None and np.isfinite(x).all() and np.abs(x).max() > 0
        unit.append(x / np.abs(x).max() / np.linalg.norm(x / np.abs(x).max()) if ok else None)
    near = [[i != j and x is not None and y is not None and len(x) == len(y) and x @ y >= least for j, y in enumerate(unit)] for i, x in enumerate(unit)]
    low = {i: i for i, _ in rows}
    while True:
        new = dict(low)
        for i, (a, _) in enumerate(rows):
            for j, (b, _) in enumerate(rows):
                if near[i][j]:
                    new[a] = min(new[a], low[b])
        if new == low:
            break
        low = new
    return collections.Counter((i, sum(near[k]), low[i], low[i] == i) for k, (i, _) in enumerate(rows))


def test_op5_widths_repeated_ids_and_odd_vectors(spark):
    rng = np.random.default_rng(5)
    rows = [(1, [1.0, 2.0]), (2, [2.0, 4.1]), (3, [1.0, 2.0, 0.0]), (4, [2.0, 4.0, 0.1]), (5, [1e200, 2e200]), (6, [1e-200, 2e-200]), (7, [0.0, 0.0]), (8, [1.0, None]), (9, None), (10, []), (11, [float("inf"), 1.0])]
    rows += [(12, [-3.0, 1.0]), (12, [1.0, 2.0, 0.05]), (13, [-3.0, 1.01]), (14, [5.0])] + [(20 + k, rng.normal(size=4).tolist()) for k in range(40)]
    for parts in (1, 9):
        df = spark.createDataFrame([(i, v, 3, "x") for i, v in rows], "vec_id long, embedding array<double>, node long, leaf string").repartition(parts)
        assert collections.Counter(tuple(r) for r in embed_dedup.near_vectors(df).collect()) == brute_links(rows)


def test_op5_large_leaves_are_split(spark, monkeypatch):
    """Leaves as in a table far larger than the sample; near pairs without exact copies."""
    monkeypatch.setattr(embed_dedup, "FIT_ROWS", 100)
    monkeypatch.setattr(embed_dedup, "LEAF", 24)
    rng = np.random.default_rng(9)
    rows = [(i, rng.normal(size=16).tolist()) for i in range(1200)]
    rows += [(2000 + i, (np.array(v) + rng.normal(size=16) * 0.1).tolist()) for i, v in rows[:400]]
    x = np.array([v for _, v in rows])
    x /= np.linalg.norm(x, axis=1)[:, None]
    near = x @ x.T >= 0.9
    np.fill_diagonal(near, False)
    found = {r["vec_id"]: r["n_links"] for r in embed_dedup.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    links = np.array([found[i] for i, _ in rows])
    assert (links <= near.sum(axis=1)).all() and links.sum() >= 0.9 * near.sum() > 600


def test_op6_notices_and_directories(spark, empty):
    rows = [
        (1, "a/LICENSE", "Released under the MIT License."), (2, "a/b/x.py", "print(1)"), (3, "a/b/y.py", "Licensed under the Apache License, Version 2.0.\ncode code"),
        (4, "a/b/LICENSE", "This work is licensed under the GNU General Public License, version 3."), (5, "a/b/c/z.py", None), (6, "q/x.py", ""), (7, None, "x"), (8, "a/k/k.py", "x"), (8, "a/k/k.py", "x"),
    ]
    found = [tuple(r) for r in license_scan.license_scan(spark.createDataFrame(rows, "file_id long, path string, text string")).select("file_id", "license", "origin", "from_path").collect()]
    assert sorted(found) == sorted([
        (1, "MIT", "notice", "a/LICENSE"), (2, "GPL-3.0", "inherited", "a/b/LICENSE"), (3, "Apache-2.0", "notice", "a/b/y.py"), (4, "GPL-3.0", "notice", "a/b/LICENSE"),
        (5, "GPL-3.0", "inherited", "a/b/LICENSE"), (6, None, "none", None), (7, None, "none", None), (8, "MIT", "inherited", "a/LICENSE"), (8, "MIT", "inherited", "a/LICENSE"),
    ])
    none = empty.select(F.col("doc_id").alias("file_id"), F.col("source").alias("path"), "text")
    assert license_scan.license_scan(none).count() == 0


def test_op6_licence_texts_spdx_lines_and_wrapped_notices(spark):
    texts = dict(license_scan.license_texts())
    deep = "/".join("abcdefghijklmnopqrst")
    commented = "\n".join("# " + line for line in texts["BSD-3-Clause"].split("\n"))
    rows = [(k, f"{n}/LICENSE", "Copyright (c) 2020 Some One\n\n" + t) for k, (n, t) in enumerate(sorted(texts.items()))]
    rows += [(100 + k, f"{n}/{deep}/x.py", "print(1)") for k, (_, path, _) in enumerate(rows) for n in [path.split("/")[0]]]
    rows += [
        (200, "s/a.py", "# SPDX-License-Identifier: Apache-2.0\n" + "code here\n" * 50), (201, "s/b.c", "/* SPDX-License-Identifier: GPL-2.0-or-later */\nint x;"),
        (202, "s/c.py", "x = 1\n# This work is licensed under the GNU\n# General Public License,\n# version 3.\n" + "y = 2\n" * 40), (203, "s/d.py", commented + "\n" + "".join(f"v{i} = f{i}\n" for i in range(400))), (204, "s/e.py", "print(1)"),
    ]
    found = {r["file_id"]: (r["license"], r["origin"]) for r in license_scan.license_scan(spark.createDataFrame(rows, "file_id long, path string, text string")).collect()}
    names = sorted(texts)
    want = {k: (n, "notice") for k, n in enumerate(names)} | {100 + k: (n, "inherited") for k, n in enumerate(names)}
    want |= {200: ("Apache-2.0", "notice"), 201: ("GPL-2.0", "notice"), 202: ("GPL-3.0", "notice"), 203: ("BSD-3-Clause", "notice")}
    assert {k: found[k] for k in want} == want


def test_op6_scores_equal_brute_force(spark):
    """The best cosine of any line, run of lines, whole file or window with any template, without anything passed over."""
    rng = np.random.default_rng(3)
    names = [("A", "Licensed under the Alpha License, Version 2."), ("B", "Released under the Beta License."), ("B", "SPDX-License-Identifier: B-1.0"), ("C", "Given to the public domain by waiver")]
    texts = [("T", " ".join(f"term{i % 23} of{i % 5}" for i in range(60))), ("U", " ".join(f"word{i % 31} grant{i % 7} license" for i in range(40)))]
    words = [w for _, t in names + texts for w in t.split()] + [f"x{i}" for i in range(60)]
    rows = []
    for k in range(60):
        lines = [" ".join(rng.choice(words, rng.integers(0, 9))) for _ in range(rng.integers(0, 12))]
        lines.insert(int(rng.integers(0, len(lines) + 1)), [names[k % 4][1], names[k % 4][1].replace(" ", "\n", 2), texts[k % 2][1], ""][k % 4 if k % 3 else 3])
        rows.append((k, f"d{k}/f", "\n".join(lines)))
    terms = lambda t: re.findall(r"[a-z0-9]+(?:[.\-][a-z0-9]+)*", t.lower())
    every = names + texts
    known, total = {w for _, t in every for w in terms(t)}, len(rows) + len(every)
    df = collections.Counter(w for _, t in every for w in set(terms(t))) + collections.Counter(w for _, _, t in rows for w in set(terms(t)) & known)
    weight = {w: math.log((1 + total) / (1 + df[w])) + 1e-3 for w in known}

    def cosine(x, y):
        a, b = collections.Counter(x), collections.Counter(y)
        heavy = lambda c: math.sqrt(sum((n * weight.get(w, math.log(1 + total))) ** 2 for w, n in c.items()))
        return sum(a[w] * b[w] * weight[w] ** 2 for w in a if w in b and w in weight) / max(heavy(a) * heavy(b), 1e-12)

    longest = max(len(terms(t)) for _, t in names)
    want = {}
    for k, _, text in rows:
        lines, whole, found = [terms(x) for x in text.split("\n")], terms(text), []
        for a in range(len(lines)):
            for b in range(a, min(len(lines), a + longest)):
                block = [w for x in lines[a : b + 1] for w in x]
                if all(lines[a : b + 1]) and (a == b or len(block) <= 3 * longest):
                    found += [(round(cosine(block, terms(t)), 9), n) for n, t in names]
        for n, t in texts:
            size, last = len(terms(t)), len(whole) - len(terms(t))
            blocks = [whole] + ([whole[i : i + size] for i in sorted({*range(0, last, max(1, size // 4)), last})] if last > 0 else [])
            found += [(round(cosine(x, terms(t)), 9), n) for x in blocks]
        best = max(found, default=(0.0, None))
        want[k] = best if best[0] >= 0.6 else (None, None)
    got = license_scan.license_scan(spark.createDataFrame(rows, "file_id long, path string, text string"), names, 0.6, texts)
    got = {r["file_id"]: (r["score"], r["license"]) for r in got.collect()}
    assert {k: v[1] for k, v in got.items()} == {k: v[1] for k, v in want.items()} and {v[1] for v in want.values()} >= {"A", "B", "T", None}
    assert all(v[0] is None or abs(v[0] - want[k][0]) < 1e-6 for k, v in got.items())


def test_op6_registered_layout_inherits(spark):
    from tidewave.llm import queries

    rows = {r["doc_id"]: r for r in queries.op6_license_scans(spark, SF.replace("0.01", "0.1")).collect()}
    given = [r for r in rows.values() if r["origin"] == "inherited"]
    assert given
    for r in given:
        above, own = r["from_path"].rsplit("/", 1)
        assert rows[int(own)]["origin"] == "notice" and rows[int(own)]["license"] == r["license"] and str(r["doc_id"] // 1000) == above.split("/")[0]


def test_op7_held_out_accuracy(odd, empty, docs, labels):
    found = line_crf.quality(docs, labels, fold_of("doc_id", 5) != 0).join(labels, "doc_id").where(fold_of("doc_id", 5) == 0).collect()
    assert np.mean([(r["score"] >= 0.3) == (r["quality"] == 1) for r in found]) > 0.9
    for table in (odd, empty):
        assert line_crf.quality(table, labels, F.lit(True)).where("score between 0 and 1").count() == table.count()
    assert line_crf.quality(odd, labels.limit(0), F.lit(True)).count() == 10


def test_op7_marginals_equal_enumeration():
    import itertools

    rng = np.random.default_rng(3)
    u, p = rng.normal(size=5), {"step": rng.normal(size=(2, 2)), "start": rng.normal(size=2)}
    good, _ = line_crf.marginals(u[None], np.array([5]), p)
    weight = {s: math.exp(p["start"][s[0]] + sum(u[i] * x for i, x in enumerate(s)) + sum(p["step"][a, b] for a, b in zip(s, s[1:]))) for s in itertools.product((0, 1), repeat=5)}
    want = [sum(w for s, w in weight.items() if s[i]) / sum(weight.values()) for i in range(5)]
    assert np.allclose(good[0], want)


def test_op8_rules_and_aliases(spark):
    link = '<link rel="canonical" href="{}">'
    rows = [
        (1, "http://a.com/en/x", link.format("http://z.io/p")), (2, "http://z.io/p", None), (3, "http://b.net/de/1", link.format("//y.io/q")), (4, "https://y.io/q#top", ""),
        (5, None, "x"), (6, "no scheme", None), (7, "HTTP://Sub.EXAMPLE.com/en/77?q", None), (8, "http://w.io/", '<meta http-equiv="refresh" content="0;url=http://a.com/en/x">'), (9, "http://com/en/", None), (9, "http://com/en/", None),
    ]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = sorted((r["page_id"], r["host"], r["path"], r["rule"], r["verdict"]) for r in url_filter.url_verdicts(df).collect())
    assert [(f[0], f[3], f[4]) for f in found] == [(1, "com/en/", "block"), (2, None, "block"), (3, "net/de/", "allow"), (4, None, "allow"), (5, None, "allow"), (6, None, "allow"), (7, "example.com/en/7", "allow"), (8, None, "block"), (9, "com/en/", "block"), (9, "com/en/", "block")]
    assert found[6][1:3] == ("sub.example.com", "/en/77") and found[4][1:3] == ("", "")
    allow = spark.createDataFrame([("http://z.io/p", "http://b.net/de/1")], "source string, target string")
    again = {r["page_id"]: r["verdict"] for r in url_filter.url_verdicts(df, redirects=allow).collect()}
    assert again[2] == "allow" and again[1] == "block"
    assert url_filter.url_verdicts(df.limit(0)).count() == 0


def test_op8_every_link_of_a_page_is_an_edge(spark):
    both = '<link rel="canonical" href="http://plain.io/"><meta http-equiv="refresh" content="0; url={}"> <link rel=canonical href=second.html>'
    rows = [
        (1, "http://a.com/en/x/y.html", both.format("next.html")), (2, "http://a.com/en/x/next.html", None), (3, "http://plain.io/", None), (4, "http://a.com/en/x/second.html", None),
        (5, "http://q.io/d/e/f", both.format("../../g/./h?a=1&amp;b=2")), (6, "http://q.io/g/h?a=1&b=2", None), (7, "http://q.io/d/e/second.html", None),
        (8, "http://r.io/p?id=1", '<base href="/sub/"><meta http-equiv=refresh content="1;url=?id=3">'), (9, "http://r.io/sub/?id=3", None), (10, "http://s.io", '<link rel="canonical" href="mailto:x@y.z">'),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    links = {(r["source"], r["target"]) for r in url_filter._link_rows(pages).collect()}
    assert links == {
        (rows[0][1], rows[2][1]), (rows[0][1], rows[1][1]), (rows[0][1], rows[3][1]), (rows[4][1], rows[2][1]), (rows[4][1], rows[5][1]), (rows[4][1], rows[6][1]),
        (rows[7][1], rows[8][1]), (rows[9][1], None),
    }
    found = {r["page_id"]: r["verdict"] for r in url_filter.url_verdicts(pages).collect()}
    assert found == {k: "block" for k in range(1, 8)} | {8: "allow", 9: "allow", 10: "allow"}


def test_op8_random_graphs_equal_union_find(spark):
    """Chains, cycles and stars of canonical links, refreshes and given redirects, against a plain union-find over all urls."""
    rng = np.random.default_rng(12)
    hosts = ["a.com", "x.example.com", "example.com", "net", "b.example.net", "q.org", "z.io", "com.io"]
    urls = [f"http://{hosts[k % 8]}/{('en', 'de', 'es', 'fr')[k % 4]}/{k % 13}/p{k}" for k in range(150)]
    edges = [tuple(rng.choice(150, 2)) for _ in range(90)]
    html = collections.defaultdict(str)
    for a, b in edges[:60]:
        path = urls[b].split("/", 3)[3]
        same = urls[a].split("/")[2] == urls[b].split("/")[2]
        html[a] += [f'<link rel="canonical" href="{urls[b]}">', f'<meta http-equiv=refresh content="3;url={"/" + path if same else urls[b]}">'][b % 2]
    rows = [(k, u, html[k], "x", 1) for k, u in enumerate(urls)] + [(500, None, "<link rel=canonical href=/x>", "x", 1), (501, "nowhere", None, "x", 1)]
    redirects = spark.createDataFrame([(urls[a], urls[b]) for a, b in edges[60:]] + [(None, urls[0])], "source string, target string")
    up = list(range(150))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in edges:
        up[find(a)] = find(b)

    def rule(k):
        _, _, host, path = urls[k].split("/", 3)
        fits = [(len(h + p), h + p, a) for a, h, p in url_filter.RULES if (host == h or host.endswith("." + h)) and ("/" + path).startswith(p)]
        return max(fits)[1:] if fits else (None, None)

    want = {500: (None, "allow"), 501: (None, "allow")}
    for k in range(150):
        group = [rule(j)[1] for j in range(150) if find(j) == find(k)]
        want[k] = (rule(k)[0], rule(k)[1] or ("allow" if "allow" in group else "block" if "block" in group else "allow"))
    found = url_filter.url_verdicts(spark.createDataFrame(rows, "page_id long, url string, html string, host string, rule int"), redirects=redirects)
    assert {r["page_id"]: (r["rule"], r["verdict"]) for r in found.collect()} == want and found.count() == 152


def test_op9_held_out_accuracy(odd, empty, docs):
    learn = fold_of("doc_id", 4) != 2
    found = language_id.languages(docs, learn, ["doc_id", "lang"]).where(~learn).collect()
    assert np.mean([r["lang"] == r["lang_pred"] for r in found]) > 0.95
    rows = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in language_id.languages(odd, F.lit(True)).collect()}
    assert [rows[i][0] for i in (1, 2, 3, 9)] == ["und"] * 4 and rows[6][0] == "en"
    assert language_id.languages(empty, F.lit(True)).count() == 0
    assert language_id.languages(odd, F.lit(False)).where("lang_pred != 'und'").count() == 0


def test_op10_finds_edited_copies(spark, odd, empty):
    rng = np.random.default_rng(5)
    items = [(k, " ".join(f"t{x}" for x in rng.integers(0, 3000, 40))) for k in range(30)]
    rows, want = [], set()
    for i in range(90):
        filler = [f"t{x}" for x in rng.integers(0, 3000, 200)]
        if i % 3 == 0:
            words = items[i % 30][1].split()
            for k in rng.choice(40, 6, False):
                words[k] = "edit"
            filler[50:50] = [w.upper() + "," for w in words]
            want.add((i, i % 30))
        rows.append((i, " ".join(filler)))
    bench = spark.createDataFrame([*items, (99, None), (98, "...")], "item_id long, text string")
    found = decontaminate.contaminated(spark.createDataFrame(rows, "doc_id long, text string"), bench)
    assert {(r["doc_id"], r["item_id"]) for r in found.collect()} == want
    assert decontaminate.contaminated(odd, bench).count() == 0 and decontaminate.contaminated(empty, bench).count() == 0
    assert decontaminate.contaminated(odd, bench.limit(0)).count() == 0


def test_op10_short_items_equal_alignment_of_all_pairs(spark):
    """Items of 3 to 20 words, with words replaced, put in between and left out around COPY."""
    rng = np.random.default_rng(7)
    items = [(k, [f"t{x}" for x in rng.integers(0, 200, n)]) for k, n in enumerate([*range(3, 21), *range(12, 21)])]
    docs = []
    for i in range(400):
        words = list(items[i % len(items)][1])
        n, how = len(words), i % 4
        for at in sorted(rng.choice(n, min(n, n // 3 + rng.integers(0, 3)), False), reverse=True):
            if how == 0 or (how == 3 and rng.random() < 0.5):
                words[at] = f"x{rng.integers(0, 99)}"
            elif how == 1:
                words.insert(at, f"t{rng.integers(0, 200)}")
            else:
                del words[at]
        docs.append((i, [f"t{x}" for x in rng.integers(0, 200, 15)] + words + [f"t{x}" for x in rng.integers(0, 200, 15)]))
    evenly = [w if k % 3 else f"y{k}" for k, w in enumerate(items[11][1])]
    docs += [(900, evenly), (901, [x for w in items[10][1] for x in (w, "between")])]
    number = {}
    ids = lambda words: np.array([number.setdefault(w, len(number)) for w in words])
    want = {(d, k): s for d, text in docs for k, words in items if (s := decontaminate.align(ids(words), ids(text))[0] / (2 * len(words))) >= decontaminate.COPY}
    frames = [spark.createDataFrame([(k, " ".join(w)) for k, w in rows], f"{name} long, text string") for rows, name in ((docs, "doc_id"), (items, "item_id"))]
    found = {(r["doc_id"], r["item_id"]): r["score"] for r in decontaminate.contaminated(*frames).collect()}
    assert found == want and {(900, 11), (901, 10)} <= set(want)


def test_op10_alignment_equals_plain_version():
    rng = np.random.default_rng(6)
    for _ in range(50):
        a, b = rng.integers(0, 4, 9), rng.integers(0, 4, 14)
        h = np.zeros((10, 15))
        for i in range(1, 10):
            for j in range(1, 15):
                h[i, j] = max(0, h[i - 1, j - 1] + (2 if a[i - 1] == b[j - 1] else -1), h[i - 1, j] - 1, h[i, j - 1] - 1)
        assert decontaminate.align(a, b)[0] == h.max()
