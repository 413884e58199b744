"""Packing, document fingerprints and the pipeline."""

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from conftest import DATA
from llm_frames import DOCS, by_id, docs
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from socialog.llm import fingerprints, packing
from socialog.llm.base import table, tokenizer_path
from socialog.llm.queries import QUERIES

VOCABULARY = tokenizer_path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(VOCABULARY)


def slow_plan(counts, capacity):
    """Best fit, longest first, piece by piece: number of sequences."""
    room = []
    for length in sorted(counts, reverse=True):
        for _ in range(counts[length]):
            fits = [(left, i) for i, left in enumerate(room) if left >= length]
            if fits:
                room[min(fits)[1]] -= length
            else:
                room.append(capacity - length)
    return len(room)


def test_plan_is_best_fit():
    random.seed(23)
    for capacity in (7, 16, 50):
        for _ in range(40):
            counts = {n: random.randint(1, 9) for n in random.sample(range(1, capacity + 1), min(capacity, 8))}
            kinds = packing.plan(counts, capacity)
            assert sum(n for n, _ in kinds) == slow_plan(counts, capacity)
            assert all(sum(a * b for a, b in holds) <= capacity for _, holds in kinds)
            held = Counter()
            for n, holds in kinds:
                for length, times in holds:
                    held[length] += n * times
            assert held == Counter(counts)


def checked(rows, texts, tokenizer, capacity):
    by = {}
    for r in rows:
        by.setdefault(r["doc_id"], []).append(r)
    for i, text in texts.items():
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        own = sorted(by[i], key=lambda r: r["piece"])
        assert [r["piece"] for r in own] == list(range(len(own)))
        assert all(r["length"] == capacity for r in own[1:])
        at = 0
        for r in own:
            assert r["start"] == at
            at += r["length"]
            assert r["ids_crc32"] == zlib.crc32(ids[r["start"] : at].tobytes())
        assert at == len(ids)
    places = {}
    for r in rows:
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for own in places.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= capacity
    return len(places)


def test_words_are_told_apart(tokenizer):
    random.seed(29)
    texts = ["", " ", " a", "  a", "\n a", "x 's y", "a\xa0b", "　 x", ". a.. b", "don't 漢 字", " \n \n a"]
    texts += ["".join(random.choice("ab cdeé\n\t\r ñ.,'s漢1\xa0 ×") for _ in range(random.randint(1, 60))) for _ in range(2000)]
    tokenizer.encode_special_tokens = True
    found = packing.encoder(tokenizer)(texts)
    for text, ids in zip(texts, found, strict=True):
        assert ids.tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_packed_documents(spark, tokenizer):
    given = {r["doc_id"]: r["text"] for r in table(spark, DATA, "documents").collect()}
    rows = QUERIES["op5_packing"](spark, DATA).collect()
    used = checked(rows, given, tokenizer, 2048)
    tokens = sum(r["length"] for r in rows)
    assert used <= 1.02 * -(-tokens // 2048)


def test_packed_awkward_documents(spark, tokenizer):
    texts = [None, "", "a", "same words here", "same words here", "word " * 3000, "x" * 5000] + ["one two"] * 50
    parts = packing.pieces(docs(spark, texts).withColumn("Piece", F.lit("old")), VOCABULARY, 64)
    checked(packing.pack(parts, 64, group_rows=7).collect(), dict(enumerate(texts)), tokenizer, 64)
    none = packing.pack(packing.pieces(spark.createDataFrame([], DOCS), VOCABULARY))
    assert none.count() == 0
    twice = spark.createDataFrame([(None, "a b"), (None, "a b"), (1, "c")], "doc_id long, text string")
    rows = packing.pack(packing.pieces(twice, VOCABULARY)).collect()
    assert len({(r["sequence_id"], r["offset"]) for r in rows}) == 3


# Fingerprints


def test_sketches_give_back_what_differs():
    random.seed(31)
    for n in (0, 1, 5, 60):
        shared = [random.getrandbits(64) for _ in range(500)]
        a = [random.getrandbits(64) for _ in range(n)]
        b = [random.getrandbits(64) for _ in range(n // 2)]
        one = fingerprints.Sketch(np.array(shared + a, np.uint64), 256)
        two = fingerprints.Sketch(np.array(shared + b, np.uint64), 256)
        here, there = one.minus(two)
        assert sorted(here) == sorted(a) and sorted(there) == sorted(b)
        again = fingerprints.Sketch.read(one.text())
        assert sorted(again.minus(fingerprints.Sketch.read(two.text()))[0]) == sorted(a)
    small = fingerprints.Sketch(np.array(a, np.uint64), 2)
    assert small.minus(fingerprints.Sketch(np.array([], np.uint64), 2)) is None


def test_a_word_is_hashed_once(monkeypatch):
    hashed, plain = [], fingerprints.xxhash.xxh32_intdigest
    monkeypatch.setattr(fingerprints.xxhash, "xxh32_intdigest", lambda word: hashed.append(word) or plain(word))
    text = "\n".join(["", " a  b c ", "b c d e" * 9, "a b c"])
    cuts = fingerprints.Cuts()
    assert fingerprints.parts(text, cuts) == fingerprints.parts(text)
    hashed.clear()
    monkeypatch.setattr(fingerprints.Cuts, "LATELY", 4)
    fingerprints.parts(text, cuts)
    assert not hashed
    few = fingerprints.Cuts()
    assert fingerprints.parts(text, few) == fingerprints.parts(text) and len(few) <= 4


def test_equal_digests_of_different_parts_end(monkeypatch):
    held = {"one": [5, 5, 9], "other": [5, 7]}
    monkeypatch.setattr(fingerprints, "digests", lambda text: np.array(held[text], np.uint64))
    one, other = fingerprints.Version("one"), fingerprints.Version("other")
    assert fingerprints.differing(one, other) == ([5, 9], [7])
    assert fingerprints.differing(one, one) == ([], [])


def slow_likeness(a, b):
    """Shared digests by plain sets."""
    x, y = set(fingerprints.digests(a).tolist()), set(fingerprints.digests(b).tolist())
    return 1 - len(x ^ y) / (len(x) + len(y)) if x or y else 1.0


def held(found, rows):
    """Rows in order against the definition."""
    for (doc_id, text), (_, after) in zip(rows, [*rows[1:], rows[0]], strict=True):
        text, after = text or "", after or ""
        n = len(text)
        edited = text[: n - n // 4] + after[: n // 4]
        r = found[doc_id]
        assert r["n_chars"] == n
        assert r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert r["fingerprint"] == fingerprints.Version(text).sketch(fingerprints.CELLS).text()
        assert r["edited_fingerprint"] == fingerprints.Version(edited).sketch(fingerprints.CELLS).text()
        assert r["near_edited"] == pytest.approx(slow_likeness(text, edited))
        assert r["near_next"] == pytest.approx(slow_likeness(text, after))


def test_fingerprints_of_documents(spark):
    given = sorted((r["doc_id"], r["text"]) for r in table(spark, DATA, "documents").collect())
    held(by_id(QUERIES["op10_fingerprints"](spark, DATA)), given)


@pytest.mark.parametrize("runs", [2, 5, 40])
def test_fingerprints_of_awkward_documents(spark, runs):
    texts = [None, "", "a", "a\na\na", "é🙂x y z", "w " * 20_000, "same\ntext here", "same\ntext here", " \n"]
    rows = docs(spark, texts).withColumn("Near_Next", F.lit("old"))
    held(by_id(fingerprints.fingerprints(rows, runs)), list(enumerate(texts)))


def test_fingerprints_of_few_and_repeated_rows(spark):
    one = spark.createDataFrame([(7, "abcd efgh")], "doc_id long, text string")
    held(by_id(fingerprints.fingerprints(one)), [(7, "abcd efgh")])
    assert fingerprints.fingerprints(one.limit(0)).count() == 0
    rows = spark.createDataFrame([(None, "x"), (1, "a b"), (1, "a b"), (1, "c")], "doc_id long, text string")
    assert fingerprints.fingerprints(rows, 3).count() == 4


# Pipeline


def test_pipeline_stages(spark):
    docs_now = table(spark, DATA, "documents")
    columns, before = docs_now.columns, docs_now.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs_now = stage(spark, docs_now, DATA).cache()
        assert docs_now.columns == columns, name
        assert 0 < docs_now.count() <= before
        before = docs_now.count()
        assert docs_now.filter("n_chars <> length(text)").count() == 0
    packed = corpus_pipeline.STAGES[-1][1](spark, docs_now, DATA)
    assert packed.select("doc_id").distinct().count() == before
    whole = corpus_pipeline.run(spark, DATA)
    assert sorted(map(tuple, whole.select("doc_id", "piece", "ids_crc32").collect())) == sorted(
        map(tuple, packed.select("doc_id", "piece", "ids_crc32").collect())
    )


def test_pipeline_decisions(spark):
    """Each stage does to awkward documents what it says, and leaves clean ones alone."""
    clean = [f"the of and to this with {i} " + " ".join(f"word{chr(97 + i)}{chr(97 + j)}" for j in range(20)) for i in range(12)]
    passage = " ".join(f"the{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(60))
    texts = [*clean, clean[0], None, "", "12 34 !", f"alpha {passage} beta", f"gamma delta {passage} epsilon of the rest"]
    given = docs(spark, texts)
    stages = dict(corpus_pipeline.STAGES)
    known = by_id(stages["language"](spark, given, DATA))
    assert set(known) == set(range(len(texts))) - {13, 14, 15}
    kept = by_id(stages["lines"](spark, given, DATA))
    assert all(kept[i]["text"] == t for i, t in enumerate(clean)) and kept[12]["text"] == ""
    single = by_id(stages["near_duplicates"](spark, given, DATA))
    assert set(range(12)) <= set(single) and 12 not in single
    cut = by_id(stages["passages"](spark, given, DATA))
    assert cut[16]["text"] == "alpha beta" and cut[17]["text"] == "gamma delta epsilon of the rest"
    assert all(cut[i]["text"] == clean[i] for i in range(1, 12))


def test_pipeline_of_nothing(spark):
    rows = spark.createDataFrame([], DOCS)
    for _, stage in corpus_pipeline.STAGES:
        rows = stage(spark, rows, DATA)
    assert rows.count() == 0
