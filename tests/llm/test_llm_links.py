"""Nearest neighbours, repeated passages, similar lines, SimHash groups, components."""

import hashlib
import random
from collections import Counter

import duckdb
import numpy as np
import pytest
import xxhash
from conftest import DATA, final_plan
from llm_frames import DOCS, by_id, docs
from pyspark.sql import functions as F

from socialog.llm import lines, neighbours, similar, simhash, substrings
from socialog.llm.base import table
from socialog.llm.components import components
from socialog.llm.queries import ORACLE, QUERIES

# Neighbours


def test_neighbours_find_nearly_all(spark):
    vectors = table(spark, DATA, "embeddings").select("vec_id", "embedding")
    near = {r["vec_id"]: np.array(r["embedding"], float) for r in vectors.collect()}
    found, hits, total = {}, 0, 0
    for r in neighbours.search(vectors, F.col("vec_id") % 20 == 0, block_rows=40).collect():
        found.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert set(found) == {i for i in near if i % 20 == 0}
    for query, rows in found.items():
        rows.sort()
        assert [r[0] for r in rows] == list(range(1, 11))
        for _, i, score in rows:
            assert i != query
            assert score == pytest.approx(float(np.sqrt(((near[i] - near[query]) ** 2).sum())), abs=1e-12)
        assert rows == sorted(rows, key=lambda r: (r[2], r[1]))
        exact = sorted((float(((v - near[query]) ** 2).sum()), i) for i, v in near.items() if i != query)
        hits += len({i for _, i in exact[:10]} & {i for _, i, _ in rows})
        total += 10
    assert hits >= 0.9 * total


def test_neighbours_of_awkward_vectors(spark):
    nan, inf = float("nan"), float("inf")
    same = [(i, [1.0, 2.0]) for i in range(30)]
    odd = [(40, None), (41, [0.0, 0.0]), (42, [nan, 1.0]), (43, [1.0, None]), (44, [inf, 1.0]), (45, [1.0])]
    rows = [*same, *odd, (None, [1.0, 1.0]), (50, [4.0, 6.0]), (50, [4.0, 6.0]), (51, [4.0, 2.0])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("score", F.lit("x"))
    found = {}
    for r in neighbours.search(vectors, F.col("vec_id") % 10 == 0, k=3).collect():
        found.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert sorted(found) == [0, 10, 20, 50]
    assert sorted(found[0]) == [(1, 1, 0.0), (2, 2, 0.0), (3, 3, 0.0)]
    assert sorted(found[20]) == [(1, 0, 0.0), (2, 1, 0.0), (3, 2, 0.0)]
    assert sorted(found[50]) == [(1, 51, 4.0), (2, 0, 5.0), (3, 1, 5.0)]
    assert neighbours.search(vectors.limit(0), F.lit(True)).count() == 0
    few = spark.createDataFrame([(1, [1.0]), (2, [3.0])], "vec_id long, embedding array<double>")
    assert [r["vec_id"] for r in neighbours.search(few, F.col("vec_id") == 1).collect()] == [2]


# Passages


def slow_passages(texts, window):
    words = [(t or "").encode().split() for t in texts]
    seen = Counter(tuple(w[p : p + window]) for w in words for p in range(len(w) - window + 1))
    out = []
    for w in words:
        gone = [False] * len(w)
        for p in range(len(w) - window + 1):
            if seen[tuple(w[p : p + window])] > 1:
                gone[p : p + window] = [True] * window
        kept = b" ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out.append((len(w), sum(gone), hashlib.sha256(kept).hexdigest()))
    return out


def passage_texts():
    random.seed(7)
    vocabulary = [f"w{i}" for i in range(400)]
    shared = [" ".join(random.choices(vocabulary, k=n)) for n in (34, 35, 36, 60, 150)]
    texts = [None, "", "  \n ", "one", "a " * 34, "a " * 36, "b c " * 40, "x y z"]
    for _ in range(40):
        parts = [" ".join(random.choices(vocabulary, k=random.randint(0, 60))) for _ in range(3)]
        texts.append(f"{parts[0]} {random.choice(shared)}\n{parts[1]}\t{random.choice(shared)} {parts[2]}")
    return [*texts, texts[-1], texts[-2]]


@pytest.mark.parametrize("window", [2, 5, 35])
def test_passages_match_brute_force(spark, window):
    texts = passage_texts()
    rows = docs(spark, texts).withColumn("N_Words", F.lit("old"))
    found = by_id(substrings.without_repeats(rows, window))
    for i, wanted in enumerate(slow_passages(texts, window)):
        r = found[i]
        assert (r["n_words"], r["n_removed"], r["kept_sha256"]) == wanted
        if not wanted[1]:
            assert r["text"] == texts[i]
        else:
            kept = " ".join(r["text"].encode().decode().split(" ")).encode().split()
            assert hashlib.sha256(b" ".join(kept)).hexdigest() == wanted[2]
        assert r["source"] == "s"


def test_passages_of_documents(spark):
    given = table(spark, DATA, "documents").orderBy("doc_id").collect()
    found = by_id(QUERIES["op6_substrings"](spark, DATA))
    wanted = slow_passages([r["text"] for r in given], 35)
    for r, w in zip(given, wanted, strict=True):
        assert tuple(found[r["doc_id"]])[1:] == w


def test_repeated_rows_and_null_ids_are_copies(spark):
    long = " ".join(f"u{i}" for i in range(50))
    rows = spark.createDataFrame([(None, long), (None, long), (3, "v " + long)], "doc_id long, text string")
    found = substrings.without_repeats(rows).collect()
    assert sorted((r["doc_id"] or 0, r["n_removed"], r["text"]) for r in found) == [(0, 50, ""), (0, 50, ""), (3, 50, "v")]
    assert substrings.without_repeats(spark.createDataFrame([], DOCS)).count() == 0


# Lines


def slow_lines(rows):
    """Places of kept lines: the first of each word set unless an earlier set matches."""
    first, sets, out = {}, [], {}
    for doc_id, text in rows:
        out.setdefault(doc_id, [])
        for at, line in enumerate((text or "").split("\n")):
            words = frozenset(w for w in line.strip(" \t\r\f\v").split(" ") if w)
            if not words or words in first:
                continue
            first[words] = (doc_id, at)
            if not any(5 * len(words & s) >= 4 * len(words | s) for s in sets):
                out[doc_id].append(at)
            sets.append(words)
    return out


def line_texts():
    random.seed(11)
    words = [f"t{i}" for i in range(60)]
    base = [random.sample(words, random.randint(1, 25)) for _ in range(25)]
    texts = [None, "", "\n\n", "a", "a\na\nb a\na b", "x\ty z\nz x\ty \r\n\t"]
    for _ in range(60):
        found = []
        for _ in range(random.randint(1, 6)):
            line = list(random.choice(base))
            for _ in range(random.randint(0, 3)):
                line[random.randrange(len(line))] = random.choice(words)
            found.append(" ".join(line))
        texts.append("\n".join(found))
    return texts


def test_lines_match_brute_force(spark):
    texts = line_texts()
    rows = docs(spark, texts)
    wanted = slow_lines(list(enumerate(texts)))
    found = by_id(lines.line_counts(rows))
    assert {i: list(r["kept_lines"]) for i, r in found.items()} == wanted
    cleaned = by_id(lines.without_similar_lines(rows.withColumn("_KEPT", F.lit("old"))))
    for i, text in enumerate(texts):
        assert cleaned[i]["_KEPT"] == "old"
        if text is None:
            assert cleaned[i]["text"] is None
            continue
        all_lines = text.split("\n")
        left = [x for at, x in enumerate(all_lines) if at in wanted[i] or not x.strip()]
        assert cleaned[i]["text"] == "\n".join(left)
        assert found[i]["n_removed"] == len(all_lines) - len(left)


def test_near_copies_of_a_line_are_not_all_paired(spark, monkeypatch):
    """Copies of one line with up to two words replaced: few candidates a line, same result."""
    random.seed(37)
    template, texts = [f"t{i}" for i in range(30)], []
    for _ in range(400):
        words = template.copy()
        for at in random.sample(range(30), random.randint(0, 2)):
            words[at] = f"x{random.randrange(3000)}"
        texts.append(" ".join(words))
    pairs, whole = [], lines.written

    def written(df, label, keep=False):
        made = whole(df, label, keep)
        if label == "line-pairs":
            pairs.append(made.count())
        return made

    monkeypatch.setattr(lines, "written", written)
    found = by_id(lines.line_counts(docs(spark, texts)))
    assert {i: list(r["kept_lines"]) for i, r in found.items()} == slow_lines(list(enumerate(texts)))
    assert sum(pairs) < 40 * len(texts)


def test_lines_far_from_their_template_are_not_all_paired(spark, monkeypatch):
    """Copies that match only the template itself and what is close to it find these first."""
    random.seed(41)
    template, texts = [f"t{i}" for i in range(60)], []
    for _ in range(800):
        words = template.copy()
        for at in random.sample(range(60), random.choice([0, 0, 0, 4, 5, 6, 6])):
            words[at] = f"x{random.randrange(10**6)}"
        texts.append(" ".join(words))
    pairs, whole = [], lines.written

    def written(df, label, keep=False):
        made = whole(df, label, keep)
        if label == "line-pairs":
            pairs.append(made.count())
        return made

    monkeypatch.setattr(lines, "written", written)
    found = by_id(lines.line_counts(docs(spark, texts)))
    assert {i: list(r["kept_lines"]) for i, r in found.items()} == slow_lines(list(enumerate(texts)))
    first, rest = pairs
    assert first < 8 * len(texts) and rest < len(texts) // 4


@pytest.mark.parametrize("size_b", [60, 63, 64, 70, 120])
def test_parities_pass_all_that_match(spark, size_b):
    """Sets around the size from which parities take 128 bits: matches pass, most others don't."""
    random.seed(size_b)
    rows = []
    for at in range(200):
        size_a = min(size_b, 64) if at % 2 else size_b
        a, b = (random.sample(range(1 << 40), n) for n in (size_a, size_b))
        if at < 100:
            least = -(-4 * (size_a + size_b) // 9)
            b[:least] = a[:least]
            if least > size_a:
                continue
        rows.append((at < 100, a, b))
    sides = spark.createDataFrame(rows, "match boolean, a array<long>, b array<long>")
    for side in "ab":
        both = F.when(F.size(side) >= lines.LONG, lines._odd(F.col(side), upper=True)).otherwise(F.lit(0).cast("long"))
        made = {f"size_{side}": F.size(side), f"odd_{side}": lines._odd(F.col(side)), f"odd2_{side}": both}
        sides = sides.withColumns(made)
    found = sides.select("match", lines._may_match("{}_a", "{}_b").alias("may")).collect()
    assert all(r["may"] for r in found if r["match"])
    assert sum(r["may"] for r in found if not r["match"]) <= 5


def test_lines_of_documents(spark):
    given = table(spark, DATA, "documents").orderBy("doc_id").collect()
    found = by_id(QUERIES["op7_lines"](spark, DATA))
    wanted = slow_lines([(r["doc_id"], r["text"]) for r in given])
    assert {i: r["kept_lines"] for i, r in found.items()} == {
        i: ",".join(map(str, at)) for i, at in wanted.items()
    }


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_sql_says_the_same(spark, name):
    duck = duckdb.connect()
    for given in ("documents", "conversations"):
        duck.execute(f"CREATE VIEW {given} AS SELECT * FROM '{DATA}/{given}.parquet'")
    found = duck.execute(ORACLE[name])
    columns = [c[0] for c in found.description]
    rows = QUERIES[name](spark, DATA).select(*columns).collect()
    assert sorted(map(tuple, rows)) == sorted(found.fetchall())


def test_lines_of_awkward_tables(spark):
    assert lines.line_counts(spark.createDataFrame([], DOCS)).count() == 0
    rows = spark.createDataFrame([(None, "a b"), (1, "a b"), (1, "a b\nc")], "doc_id long, text string")
    found = sorted((r["doc_id"] or -1, r["text"]) for r in lines.without_similar_lines(rows).collect())
    assert found[0] == (-1, "a b") and [t for _, t in found[1:]].count("c") == 1


def test_plans_of_lines_hold_no_ranks(spark, monkeypatch):
    """The driver keeps the text of each plan that ran: arrays of fixed size don't stand in it."""
    texts, whole = [], lines.written

    def written(df, label, keep=False):
        texts.append(len(df._jdf.queryExecution().toString()))
        return whole(df, label, keep)

    monkeypatch.setattr(lines, "written", written)
    assert lines.line_counts(table(spark, DATA, "documents")).count()
    assert len(texts) >= 8 and max(texts) < 100_000


def test_words_of_a_line_are_plain_numbers(spark):
    """Distinct words without null among them, so that they are sorted as an array of longs; blanks as before."""
    given = ["a", " a b  a\t", "\x0b \fb a\r", "a\tb", "b\t a", " \t", "", "\u00a0a "]
    rows = spark.createDataFrame([(x,) for x in given], "line string")
    numbers = lines._by_rarity(F.col("line"), F.array(F.lit(1).cast("tinyint")))
    found = rows.select("line", numbers.alias("numbers"), lines._words(F.col("line")).alias("words"), lines._not_blank(F.col("line")).alias("full"))
    assert not found.schema["numbers"].dataType.containsNull
    for r in found.collect():
        words = [w for w in r["line"].strip(lines.BLANKS).split(" ") if w]
        assert r["words"] == words and r["full"] == bool(words)
        assert len(r["numbers"]) == len(set(words)) and r["numbers"] == sorted(r["numbers"])


def test_shorter_lines_bring_shorter_prefixes(spark):
    texts = [" ".join(f"w{i}" for i in range(n)) for n in (45, 4, 3)]
    found = lines.classes(lines._texts(docs(spark, texts), "text"))
    long = lines._prefixes(found).groupBy("size").count().collect()
    short = lines._prefixes(found, shared=lines._needed_of_longer).groupBy("size").count().collect()
    assert {r["size"]: r["count"] for r in long} == {45: 10, 4: 1}
    assert {r["size"]: r["count"] for r in short} == {45: 6, 4: 1}


def test_lines_at_the_threshold_match_in_any_order(spark):
    rng, pairs = random.Random(7), []
    for n in [*range(1, 40), 63, 64, 70, 81, 130]:
        for most in range(n, n * 5 // 4 + 2):
            shared = -(-4 * (n + most) // 9) - rng.randrange(2)  # the least that match, or one less
            if shared <= n:
                made = [f"{'rare' * (i % 3 == 0)}{len(pairs)}_{i}" if i % 2 else f"common{i}" for i in range(shared)]
                a = made + [f"a{len(pairs)}_{i}" for i in range(n - shared)]
                b = made + [f"b{len(pairs)}_{i}" for i in range(most - shared)]
                two = [" ".join(rng.sample(x, len(x)) + x[:1]) for x in (a, b)]
                pairs.append(two if rng.random() < 0.5 else two[::-1])
    texts = ["\n".join(p) if i % 2 else p[0] for i, p in enumerate(pairs)] + [p[1] for i, p in enumerate(pairs) if i % 2 == 0]
    found = by_id(lines.line_counts(docs(spark, texts)))
    wanted = slow_lines(list(enumerate(texts)))
    assert {i: list(r["kept_lines"]) for i, r in found.items()} == wanted
    assert 0 < sum(r["n_removed"] for r in found.values()) < len(pairs)


def test_hashes_of_lines_are_compiled_and_ranks_in_no_row(spark, monkeypatch):
    plans, whole = [], lines.written

    def written(df, label, keep=False):
        if label == "line-classes":
            plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return whole(df, label, keep)

    monkeypatch.setattr(lines, "written", written)
    before = spark.conf.get(lines.FAST_KEYS)
    assert lines.classes(lines._texts(docs(spark, ["a b c", "c d"]), "text")).count() == 2
    assert spark.conf.get(lines.FAST_KEYS) == before
    steps = [x for x in plans[0].split("\n") if "_hashes" in x or "_sorted" in x]
    assert any("array_except" in x and "sort_array" not in x for x in steps)
    assert not any("AS _ranks" in x for x in steps)


def test_lines_use_no_python(spark, settings):
    settings({"spark.sql.autoBroadcastJoinThreshold": "-1"})
    plan = final_plan(lines.without_similar_lines(table(spark, DATA, "documents")))
    assert not any(p in plan for p in ("Python", "Pandas", "Arrow", "CartesianProduct", "NestedLoop"))


# SimHash


def slow_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    grams = [b" ".join(words[i : i + 3]) for i in range(max(len(words) - 2, 1))]
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_groups(prints):
    """Least member reachable over at most three differing bits."""
    group = list(range(len(prints)))
    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 3 and group[i] != group[j]:
                a, b = sorted((group[i], group[j]))
                group = [a if g == b else g for g in group]
    return group


def test_fingerprints_match_bit_by_bit():
    for text in (None, "", " \t", "One", "one two", "A b C d e f", "É é x y z", "a " * 500, *passage_texts()[8:14]):
        assert simhash.fingerprint(text) == slow_fingerprint(text)


def test_fingerprints_of_texts_longer_than_a_block(monkeypatch):
    rng = random.Random(5)
    texts = [" ".join(rng.choice("abcdefgh") * rng.randint(1, 3) for _ in range(n)) for n in (9, 10, 11, 12, 13, 64)]
    monkeypatch.setattr(simhash, "BLOCK", 5)
    assert [simhash.fingerprint(t) for t in texts] == [slow_fingerprint(t) for t in texts]


def test_decoder_is_perfect():
    decode = simhash.decoder()
    assert (np.bincount(decode, minlength=4096) == 2048).all()


def test_linked_fingerprints_share_a_key():
    random.seed(13)
    decode = simhash.decoder()
    for _ in range(300):
        a = random.getrandbits(64)
        b = a
        for bit in random.sample(range(64), random.randint(0, 3)):
            b ^= 1 << bit
        key, owner, own = simhash.keys_of(np.array([a, b], np.uint64), decode)
        of = [{(k, o) for k, p, o in zip(key.tolist(), owner.tolist(), own.tolist(), strict=True) if p == x} for x in (a, b)]
        assert a == b or any((k, True) in of[1] for k, _ in of[0])


def test_groups_match_brute_force(spark):
    random.seed(17)
    prints = []
    for _ in range(60):
        base = random.getrandbits(64)
        for _ in range(random.randint(1, 30)):
            prints.append(base)
            for bit in random.sample(range(64), random.randint(0, 3)):
                base ^= 1 << bit
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    rows = spark.createDataFrame([(p,) for p in signed], "print long").repartition(5)
    found = {r["print"]: r["root"] for r in simhash.roots_of(rows).collect()}
    wanted = slow_groups(prints)
    for i, p in enumerate(signed):
        assert (found[p] == found[signed[0]]) == (wanted[i] == wanted[0])
    assert len(set(found.values())) == len(set(wanted))


def test_groups_of_documents(spark):
    texts = passage_texts() + ["", None]
    rows = docs(spark, texts)
    found = by_id(simhash.grouped(rows))
    prints = [slow_fingerprint(t) for t in texts]
    wanted = slow_groups(prints)
    for i, p in enumerate(prints):
        assert found[i]["fingerprint"] == f"{p:016x}" and found[i]["component_id"] == wanted[i]
    one = {r["doc_id"] for r in simhash.one_of_each(rows).collect()}
    assert one == set(wanted)
    assert simhash.grouped(spark.createDataFrame([], DOCS)).count() == 0
    twice = spark.createDataFrame([(None, "a"), (None, "a"), (5, "a"), (5, "b c d")], "doc_id long, text string")
    assert sorted(r["text"] for r in simhash.one_of_each(twice).collect()) == ["a", "b c d"]


# Near copies


def slow_similar(texts):
    """Least member reachable over a Jaccard similarity of 4/5 of five-word shingles, and the pairs."""
    sets = []
    for text in texts:
        words = (text or "").encode().lower().split()
        sets.append({tuple(words[i : i + 5]) for i in range(max(len(words) - 4, 1))} if words else set())
    group, linked = list(range(len(sets))), []
    for i, s in enumerate(sets):
        for j, t in enumerate(sets[:i]):
            if 5 * len(s & t) >= 4 * len(s | t):
                linked.append((j, i))
                a, b = sorted((group[i], group[j]))
                group = [a if g == b else g for g in group]
    return group, linked


def near_copies(n_words, n_texts, changes, seed):
    """Pairs of a random text and a copy with some single words replaced."""
    random.seed(seed)
    texts = []
    for i in range(n_texts):
        words = [f"v{random.randrange(5000)}" for _ in range(n_words)]
        texts.append(" ".join(words))
        for at in random.sample(range(n_words), changes[i % len(changes)]):
            words[at] = f"x{random.randrange(5000)}"
        texts.append(" ".join(words))
    return texts


def test_stage_keeps_one_of_each_near_copy(spark):
    """Planted copies from 0.7 to 1 against brute force; SimHash links miss most of them."""
    import corpus_pipeline

    texts = near_copies(100, 60, (1, 1, 2, 3), 23) + near_copies(300, 20, (2, 4, 5, 7), 29)
    wanted, linked = slow_similar(texts)
    assert len(linked) >= 50 and len(set(wanted)) > len(texts) / 2
    rows = docs(spark, texts).cache()
    assert {r["doc_id"] for r in corpus_pipeline.near_duplicates(spark, rows, "").collect()} == set(wanted)
    prints = [simhash.fingerprint(t) for t in texts]
    assert sum((prints[a] ^ prints[b]).bit_count() <= simhash.MOST for a, b in linked) < 0.6 * len(linked)


def test_stage_links_what_simhash_links(spark, monkeypatch):
    """Fingerprints of five-word shingles within three bits are compared by their keys, once each."""
    texts = near_copies(300, 30, (0, 1, 1, 2), 41)
    sets = [similar.shingles(t) for t in texts]
    prints = {similar._set_of(s): similar._fingerprint(s) for s in sets}
    assert prints[similar._set_of(sets[0])] % 2**64 == simhash.fingerprint(texts[0], similar.WORDS)
    pairs, whole = [], similar.by_fingerprint

    def by_fingerprint(one):
        found = whole(one)
        pairs.extend((r["a"], r["b"]) for r in found.collect())
        return found

    monkeypatch.setattr(similar, "by_fingerprint", by_fingerprint)
    import corpus_pipeline

    wanted, _ = slow_similar(texts)
    assert {r["doc_id"] for r in corpus_pipeline.near_duplicates(spark, docs(spark, texts), "").collect()} == set(wanted)
    near = [(a, b) for a in prints for b in prints if a < b and ((prints[a] ^ prints[b]) % 2**64).bit_count() <= 3]
    assert len(near) >= 10 and {tuple(sorted(p)) for p in pairs} == set(near)


def test_similar_groups_match_brute_force(spark, monkeypatch):
    """Chains of copies, a template in a third of all texts, short, equal and blank texts."""
    monkeypatch.setattr(similar, "SAMPLE", 40)
    random.seed(31)
    vocabulary = [f"w{i}" for i in range(300)]
    template = random.choices(vocabulary, k=40)
    texts = [None, "", " \n", "a b", "A  b", "a b c d e", "a b c d e f"]
    for i in range(12):
        words = random.choices(vocabulary, k=random.randint(20, 90))
        if i % 3 == 0:
            words = template + words[:15]
        for _ in range(8):
            texts.append(" ".join(words))
            for _ in range(random.randint(0, 3)):
                words[random.randrange(len(words))] = random.choice(vocabulary)
    texts += texts[20:24]
    wanted, _ = slow_similar(texts)
    rows = docs(spark, texts)
    assert {r["doc_id"] for r in similar.one_of_each(rows).collect()} == set(wanted)
    assert similar.one_of_each(spark.createDataFrame([], DOCS)).count() == 0
    twice = spark.createDataFrame([(None, "a"), (None, "a"), (5, "a"), (5, "b c d")], "doc_id long, text string")
    assert sorted(r["text"] for r in similar.one_of_each(twice).collect()) == ["a", "b c d"]


@pytest.mark.parametrize("shape", ["chain", "star", "random", "none"])
def test_components(spark, shape):
    random.seed(19)
    pairs = {
        "chain": [(i, i + 1) for i in range(40)],
        "star": [(100, i) for i in range(40)],
        "random": [(random.randrange(60), random.randrange(60)) for _ in range(35)],
        "none": [],
    }[shape]
    root = {n: n for p in pairs for n in p}
    for _ in pairs:
        for a, b in pairs:
            root[a] = root[b] = min(root[a], root[b])
    found = components(spark.createDataFrame(pairs, "a long, b long").repartition(3)).collect()
    linked = {n for a, b in pairs if a != b for n in (a, b)}
    assert {r["node"]: r["root"] for r in found} == {n: root[n] for n in linked}
    assert len(found) == len(linked)


def test_buckets_bound_what_sets_share():
    rng = np.random.default_rng(9)
    for _ in range(300):
        shared = rng.integers(-(1 << 63), (1 << 63) - 1, rng.integers(0, 400))
        a, b = (np.unique(np.concatenate([shared, rng.integers(-(1 << 63), (1 << 63) - 1, rng.integers(0, 300))])) for _ in "ab")
        if len(a) and len(b):
            most = similar.most_shared(similar.buckets(a), similar.buckets(b))
            assert len(np.intersect1d(a, b)) <= most <= min(len(a), len(b))
    same = np.arange(300, dtype=np.int64)  # all in one range
    assert similar.buckets(same) == b"" and similar.buckets(same[:0]) == b""
    far = rng.integers(-(1 << 63), (1 << 63) - 1, (2, 3000))
    assert 9 * similar.most_shared(*(similar.buckets(np.unique(x)) for x in far)) < 4 * 6000
