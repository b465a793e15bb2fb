"""SentencePiece codec, filter audit and importance resampling against plain versions."""

import hashlib
import itertools
import math
import re
import struct
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import public_tokenizers
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidewave.llm import filter_audit, importance, piece_codec, queries

SF = "/root/testdata/sf0.01"
MODEL = str(public_tokenizers.path("piece_bpe_32k.model"))
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score long, rank long, mask int, first long, bucket int"
LONG = " ".join(f"w{i % 977}x{i}" for i in range(30000))


def odd_rows():
    """Nulls, empty and blank texts, repeated rows and ids, ties, very long texts, and clashing extra columns."""
    texts = [
        (1, None), (2, ""), (3, " \t\n"), (4, "one two"), (4, "one two"), (5, "ONE TWO"), (6, LONG), (7, LONG + " more"), (8, LONG), (9, "a\x1cb é́ 12 <s> don't"),
        (10, "... !!! 123"), (11, "x" * 70000), (12, "漢字" * 3000 + " ｶﾅ 😀"), (None, "one two"), (13, "a  b\r\n   c▁d "), (14, "one two"), (4, "other text"),
    ]
    return [(i, t, "en", None if i in (5, 9) else f"s{(i or 0) % 2}", None, 5, 7, 1, 2, 3) for i, t in texts]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


@pytest.fixture(scope="module")
def own():
    return piece_codec.Codec(MODEL)


def told_by(library, text):
    ids = library.encode(text or "", add_bos=True, add_eos=True)
    return len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(), hashlib.sha256(library.decode(ids).encode()).hexdigest()


def test_codec_equals_library_on_a_table(spark, library):
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in queries.op11_sentencepiece_codec(spark, SF).collect()}
    want = {r.doc_id: told_by(library, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert got == want


def test_codec_odd_rows(odd, empty, library):
    got = piece_codec.coded(odd, MODEL).select("doc_id", "n_tokens", F.sha2("ids", 256), F.sha2("decoded", 256)).collect()
    want = [(r[0], *told_by(library, r[1])) for r in odd_rows()]
    assert Counter(map(tuple, got)) == Counter(want)
    assert piece_codec.coded(empty, MODEL).count() == 0
    assert piece_codec.coded(odd, MODEL).columns == ["doc_id", "n_tokens", "ids", "decoded"]


PIECES = ["▁", " ", "  ", "a", "ab", "abc", "the", "th", "in", "ing", "e", "é", "\n", "漢", "😀", "<s>", "<0x41>", "1", "00", ".", "...", "́", "　"]


@settings(max_examples=1500, deadline=None)
@given(st.one_of(st.lists(st.sampled_from(PIECES), max_size=40).map("".join), st.text(max_size=60), st.text("aeinrst ", max_size=80)))
def test_codec_equals_library_on_any_text(own, library, text):
    ids = library.encode(text, add_bos=True, add_eos=True)
    packed = own.encode(text)
    assert np.frombuffer(packed, dtype="<u4").tolist() == ids
    assert own.decode(packed) == library.decode(ids)


@settings(max_examples=500, deadline=None)
@given(st.lists(st.integers(0, 400) | st.integers(0, 31999), max_size=20))
def test_decode_equals_library_on_any_ids(own, library, ids):
    assert own.decode(struct.pack(f"<{len(ids)}I", *ids)) == library.decode(ids)


def test_every_prefix_has_one_last_piece(own):
    """The table holds for each prefix the last piece of that prefix's own encoding, and no other piece fits there."""
    text = "▁internationalisation▁▁▁of▁misunderstandings"
    for end in range(1, len(text) + 1):
        whole = own.pieces_of(text[:end])
        before = own.pieces_of(text[: end - len(own.pieces[whole[-1]])]) if end > len(own.pieces[whole[-1]]) else []
        assert before == whole[:-1]
        fitting = []
        for piece in {p for at, p in own.automaton.iter(text[:end]) if at + 1 == end}:
            start = end - len(own.pieces[piece])
            if own.fit(own.pieces_of(text[:start])[-1], piece) if start else own._merges(piece) is not None:
                fitting.append(piece)
        assert fitting == [whole[-1]]


def brute_audit(rows, labels):
    """Filters applied one after the other, for every part and order."""
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, t in labels if t == 1 and d is not None}
    parts, fails = {}, []
    for n, (doc, text, source) in enumerate(rows):
        text, words = text or "", re.findall(r"[^\x20\x09-\x0D]+", text or "")
        fail = {
            "A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words), "C": 100 * len(re.findall("[A-Z]", text)) > 2 * len(text),
            "D": bool(re.search(r"[#$%&*|]", text)), "E": doc is not None and any(d is not None and d < doc and (t or "") == text for d, t, _ in rows),
        }
        fails.append(fail)
        parts.setdefault(source or "", []).append(n)
    out, by_filter = [], Counter()
    for part, members in parts.items():
        for order in map("".join, itertools.permutations("ABCDE")):
            left = list(members)
            for step, f in enumerate(order, 1):
                gone = [n for n in left if fails[n][f]]
                left = [n for n in left if not fails[n][f]]
                failing = sum(fails[n][f] for n in members)
                only = sum(fails[n][f] and sum(fails[n].values()) == 1 for n in members)
                ids = [rows[n][0] for n in gone]
                by_filter[part, f] += len(gone)
                out.append((part, order, step, len(left), len(gone), failing - len(gone), only, sum(d in good for d in ids), sum(d in toxic for d in ids)))
    return sorted((*r, by_filter[r[0], r[1][r[2] - 1]]) for r in out)


@pytest.mark.parametrize("hash_of", [F.xxhash64, lambda c: F.xxhash64(F.substring(c, 1, 1)) % 2, lambda c: F.length(c) * 0])
def test_audit_equals_filters_in_every_order(spark, odd, empty, hash_of):
    """With weak hashes too, where texts that differ share a class."""
    more = [(100 + i, t, "en", "s1", None, 5, 7, 1, 2, 3) for i, t in enumerate(["one two", "two one", "two one", "one oww", "A# b", "A# c", "A# b", " ".join(["q"] * 300)])]
    docs = odd.unionByName(spark.createDataFrame(more, SCHEMA))
    told = [(1, 1, 0), (4, 1, 1), (4, 0, None), (6, None, 1), (8, 1, 0), (14, 1, 0), (None, 1, 1), (104, 1, 1), (102, 1, 0), (555, 1, 1)]
    labels = spark.createDataFrame(told, "doc_id long, quality int, toxic int")
    rows = [(r[0], r[1], r[3]) for r in odd_rows() + more]
    assert sorted(map(tuple, filter_audit.audit(docs, labels, hash_of).collect())) == brute_audit(rows, told)
    if hash_of is F.xxhash64:
        assert filter_audit.audit(empty, labels).count() == 0
        assert filter_audit.audit(docs, labels.limit(0)).where("good_lost + toxic_lost > 0").count() == 0


def brute_resampling(rows, target, buckets, percent, least, seed):
    def features(text):
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        return len(words), [zlib.crc32(f.encode()) % buckets for f in words + [" ".join(p) for p in zip(words, words[1:])]]

    docs, wanted = [features(t) for _, t in rows], Counter(b for t in target for b in features(t)[1])
    seen = Counter(b for _, f in docs for b in f)
    s, t = sum(seen.values()) + buckets, sum(wanted.values()) + buckets
    gain = [math.floor(1000 * math.log((float(wanted[b] + 1) * s) / (float(seen[b] + 1) * t))) for b in range(buckets)]
    out = []
    for (doc, _), (n_words, f) in zip(rows, docs):
        weight = sum(gain[b] for b in f) // len(f) if f else 0
        score = None
        if doc is not None:
            h = int(hashlib.sha256(f"{seed}:{doc}".encode()).hexdigest()[:8], 16)
            score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([doc, len(f), weight, score, None, n_words])
    may = sorted((r for r in out if r[3] is not None and r[5] >= least), key=lambda r: (-r[3], r[0]))
    for rank, r in enumerate(may[: percent * len(may) // 100], 1):
        r[4] = rank
    return Counter(tuple(r[:5]) for r in out)


@pytest.mark.parametrize("block, buckets, percent, least", [(1 << 21, 10000, 25, 20), (7, 50, 100, 1), (64, 997, 60, 0)])
def test_resampling_equals_plain_version(spark, odd, empty, monkeypatch, block, buckets, percent, least):
    monkeypatch.setattr(importance, "BLOCK", block)
    held = odd.where("doc_id is null or doc_id not in (6, 7)") if block < 1000 else odd
    target = spark.createDataFrame([("one two three é", 1), (None, 2), ("", 3), ("Other TEXT w1x1", 4)], "text string, doc_id int")
    rows = [(r.doc_id, r.text) for r in held.collect()]
    got = importance.resampled(held, target, percent, least, 3, buckets)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert Counter(map(tuple, got.collect())) == brute_resampling(rows, [r.text for r in target.collect()], buckets, percent, least, 3)
    assert importance.resampled(empty, target).count() == 0
    assert importance.resampled(held, target.limit(0), percent, least, 3, buckets).count() == len(rows)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text("aB1é-. 漢", max_size=30), st.text(max_size=12), st.integers(1, 400).map(lambda n: "z" * n)), max_size=12), st.integers(1, 40), st.integers(0, 3))
def test_automaton_equals_zlib(texts, block, skip):
    """Over slices, blocks of any size, and texts that follow each other without a gap."""
    old, importance.BLOCK = importance.BLOCK, block
    try:
        array = pa.array(texts, pa.string()).slice(min(skip, len(texts)))
        got = Counter((int(t), int(b)) for of_word, word, of_pair, pair in importance.hashed(array, 1 << 30) for t, b in [*zip(of_word, word), *zip(of_pair, pair)])
    finally:
        importance.BLOCK = old
    want = Counter()
    for n, text in enumerate(array.to_pylist()):
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        want.update((n, zlib.crc32(f.encode()) % (1 << 30)) for f in words + [" ".join(p) for p in zip(words, words[1:])])
    assert got == want
