"""The pipeline's stages against plain versions of what they decide, on whole small tables."""

import zlib

import corpus_pipeline as P
import numpy as np
import pytest
import public_tokenizers
from pyspark.sql import functions as F
from test_operators import brute_classes, plain_ids

from tidewave.llm import decontaminate, language_id, line_crf

SF = "/root/testdata/sf0.001"


def rows_of(df):
    return {r["doc_id"]: r for r in df.collect()}


@pytest.fixture(scope="module")
def steps(spark):
    """What each stage gets and gives, with the stages run one after the other."""
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for name, stage in P.STAGES:
        kept = stage(spark, docs, SF)
        given = kept.collect()
        out.append((name, docs, given, kept.columns))
        docs = spark.createDataFrame(given, kept.schema)
    return out


def test_language_stage(spark, steps):
    """A text goes where no letter tells a language, or where the network gives no language half of its probability."""
    _, docs, given, columns = steps[0]
    lettered = {i for i, r in rows_of(docs).items() if r["text"] and any(map(str.isalpha, r["text"]))}
    told = {r["doc_id"]: r for r in language_id.languages(docs, F.col("lang").isNotNull()).collect()}
    known = {r["lang"] for r in docs.select("lang").distinct().collect()} - {None}
    assert {i for i, r in told.items() if r["lang_pred"] != "und"} == lettered and {told[i]["lang_pred"] for i in lettered} <= known
    assert columns == P.COLUMNS and sorted(r["doc_id"] for r in given) == sorted(i for i in lettered if told[i]["score"] >= 0.5)
    # A text of two languages in equal parts is none's; a row without language gets the predicted one.
    lines = {lang: [r["text"] for r in docs.where(F.col("lang") == lang).limit(40).collect()] for lang in ("en", "fr", "de", "es")}
    mixed = ["\n".join(x[:500] for x in every) for every in zip(*lines.values())]
    rows = [(10**6 + i, t, None, "s", 1) for i, t in enumerate(mixed)] + [(2 * 10**6 + i, t, None, "s", 1) for i, t in enumerate(lines["de"])]
    more = docs.unionByName(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long"))
    kept = {r["doc_id"]: r for r in P.identify_languages(spark, more, SF).collect()}
    told = {r["doc_id"]: r for r in language_id.languages(more, F.col("lang").isNotNull()).collect()}
    assert kept.keys() == {i for i, r in told.items() if r["lang_pred"] != "und" and r["score"] >= 0.5}
    assert sum(i in kept for i in range(10**6, 10**6 + len(mixed))) < 0.5 * len(mixed)
    german = [kept[i]["lang"] for i in range(2 * 10**6, 2 * 10**6 + len(lines["de"])) if i in kept]
    assert german.count("de") > 0.9 * len(lines["de"])


def test_quality_stage(spark, steps):
    """Scores by plain sums over all label sequences' marginals: each line alone with forward and backward passes in a loop."""
    _, docs, given, columns = steps[1]
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    scores = {r["doc_id"]: r["score"] for r in line_crf.quality(docs, labels, F.lit(True)).collect()}
    assert columns == P.COLUMNS and sorted(r["doc_id"] for r in given) == sorted(i for i, s in scores.items() if s >= 0.3)
    good = {r["doc_id"] for r in labels.where("quality = 1").collect()} & scores.keys()
    assert len(good & {r["doc_id"] for r in given}) >= 0.95 * len(good)
    # The batched pass equals a loop over one document's lines.
    rng, texts = np.random.default_rng(0), [r["text"] for r in docs.limit(30).collect()]
    p = {"w": rng.normal(size=line_crf.WIDE) / 9, "step": rng.normal(size=(2, 2)), "start": rng.normal(size=2)}
    own, doc, size = line_crf.line_features(texts)
    for k, mean in enumerate(line_crf.document_means(own, doc, size, p, len(texts))):
        x = own[doc == k].astype(float)
        pad = np.zeros((1, line_crf.OWN))
        around = [x, np.concatenate([pad, x[:-1]]), np.concatenate([x[1:], pad])]
        edge = np.zeros((len(x), 3))
        edge[0, 0] = edge[-1, 1] = 1
        edge[:, 2] = 1
        u = np.concatenate([y for a in around for y in (a, np.sqrt(a))] + [edge], axis=1) @ p["w"]
        f, b = [p["start"] + [0, u[0]]], [np.zeros(2)]
        for t in range(1, len(u)):
            f.append(np.array([np.logaddexp(*(f[-1] + p["step"][:, s])) for s in (0, 1)]) + [0, u[t]])
        for t in range(len(u) - 1, 0, -1):
            b.insert(0, np.array([np.logaddexp(*(p["step"][s] + [0, u[t]] + b[0])) for s in (0, 1)]))
        z = np.array(f) + np.array(b)
        prob = 1 / (1 + np.exp(z[:, 0] - z[:, 1]))
        assert abs(mean - (prob * size[doc == k]).sum() / size[doc == k].sum()) < 1e-6


def test_near_copy_stage(steps):
    _, docs, given, columns = steps[2]
    classes = brute_classes([(r["doc_id"], r["text"]) for r in docs.collect()])
    assert columns == P.COLUMNS and sorted(r["doc_id"] for r in given) == sorted(i for i, _, low in classes if i == low)
    assert len(given) < docs.count()


def test_decontamination_stage(spark, steps):
    """Full alignment of every text with every item."""
    _, docs, given, columns = steps[3]
    items = [w for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect() if (w := decontaminate.plain_words(r["text"]))]
    number = {}
    ids = lambda words: np.array([number.setdefault(w, len(number)) for w in words], dtype=np.int64)
    items = [ids(w) for w in items]
    want = []
    for r in docs.collect():
        text = ids(decontaminate.plain_words(r["text"]))
        held = set(text.tolist())
        # An item with fewer of its words in the text than the score needs can't reach it.
        near = [w for w in items if sum(x in held for x in w.tolist()) * 2 >= decontaminate.COPY * 2 * len(w)]
        if not any(decontaminate.align(w, text)[0] >= decontaminate.COPY * 2 * len(w) for w in near):
            want.append(r["doc_id"])
    assert columns == P.COLUMNS and sorted(r["doc_id"] for r in given) == sorted(want) and len(want) < docs.count()


def test_packing_stage(steps):
    _, docs, given, _ = steps[4]
    want = set()
    for r in docs.collect():
        ids = plain_ids(r["text"]) + [0]
        want |= {(r["doc_id"], k // 2048, len(ids[k : k + 2048]), zlib.crc32(np.array(ids[k : k + 2048], dtype="<u4").tobytes())) for k in range(0, len(ids), 2048)}
    assert {(r["doc_id"], r["piece"], r["length"], r["ids_crc32"]) for r in given} == want and len(given) == len(want)
    fill = {}
    for r in given:
        fill[r["sequence_id"]] = fill.get(r["sequence_id"], 0) + r["length"]
    assert max(fill.values()) <= 2048 and len(fill) <= -(-sum(fill.values()) // 2048) + 1


def test_run_equals_its_stages(spark, steps):
    found = P.run(spark, SF)
    assert sorted(map(tuple, found.select("doc_id", "piece", "start", "length", "ids_crc32").collect())) == sorted(
        (r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in steps[-1][2])


def test_odd_documents(spark):
    """Nulls, repeated rows and ids, empty texts and columns that clash: stages end, keep the columns, and one of equal rows stays."""
    rows = [(1, "word " * 9, "en", "s", 1), (1, "word " * 9, "en", "s", 1), (2, None, None, None, None), (3, "", "en", "s", 0), (None, "some text of no id", "en", "s", 1), (4, "other words stand here in this row", "en", "s", 2), (4, "word " * 9, "en", "s", 3)]
    shape = "doc_id long, text string, lang string, source string, n_chars long"
    docs = spark.createDataFrame([(*r, 0.5, 7, 1, b"x") for r in rows], shape + ", score double, rep long, _slot int, key binary")
    for name, stage in P.STAGES[:-1]:
        assert stage(spark, docs, SF).columns == P.COLUMNS, name
    left = P.drop_near_copies(spark, docs, SF).collect()
    assert sorted(((r["doc_id"], r["text"]) for r in left), key=repr) == sorted([(1, "word " * 9), (2, None), (3, ""), (None, "some text of no id")], key=repr)
    assert P.pack(spark, docs, SF).count() == 7


def test_empty_documents(spark):
    none = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for name, stage in P.STAGES:
        assert stage(spark, none, SF).count() == 0, name
