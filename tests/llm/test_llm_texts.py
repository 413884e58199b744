"""Toxicity, language, page text and SentencePiece pieces."""

import math
import random
import time
import zlib

import numpy as np
import pytest
import sentencepiece
from conftest import DATA
from llm_frames import DOCS, by_id, docs
from pyspark.sql import Window
from pyspark.sql import functions as F

from socialog.llm import html, langid, pieces, toxicity
from socialog.llm.base import fold, table, tokenizer_path
from socialog.llm.queries import QUERIES

MODEL = tokenizer_path("piece_bpe_32k.model")


def test_fold_is_crc32_of_the_id_as_text(spark):
    rows = spark.range(50).select("id", fold(F.col("id"), 5).alias("f")).collect()
    assert all(r["f"] == zlib.crc32(str(r["id"]).encode()) % 5 for r in rows)


# Toxicity


def slow_runs(scores):
    """All maximal runs by definition: best run, then both sides of it."""

    def search(a, b):
        best, at = 0.0, None
        for i in range(a, b):
            total = 0.0
            for j in range(i, b):
                total += scores[j]
                if total > best + 1e-12:
                    best, at = total, (i, j + 1)
        if at is None:
            return []
        return search(a, at[0]) + [(*at, best)] + search(at[1], b)

    return search(0, len(scores))


def test_maximal_runs_match_the_definition():
    random.seed(3)
    for _ in range(200):
        drift = 0.25
        scores = [random.choice([0.0, 0.0, 0.0, 0.7, 1.3, 2.1]) or -drift for _ in range(25)]
        hits = [(i, s) for i, s in enumerate(scores) if s > 0]
        found = toxicity.maximal_runs(hits, drift)
        wanted = slow_runs(scores)
        assert [(a, b) for a, b, _ in found] == [(a, b) for a, b, _ in wanted]
        assert all(math.isclose(x[2], y[2]) for x, y in zip(found, wanted, strict=True))


def test_decay_solves_its_equation():
    # A word scores 1 with probability 1/5 and -1 else: lambda is log(4).
    assert math.isclose(toxicity._decay(np.array([1.0]), np.array([0.2]), 1.0), math.log(4), rel_tol=1e-9)
    scores, rates, drift = np.array([0.7, 2.5]), np.array([0.05, 0.01]), 0.3
    at = toxicity._decay(scores, rates, drift)
    mean = (1 - rates.sum()) * math.exp(-at * drift) + (rates * np.exp(at * scores)).sum()
    assert math.isclose(mean, 1, rel_tol=1e-9)


def test_runs_of_clean_texts_are_as_rare_as_expected():
    """Extreme values: scale fitted on some clean texts, held against others."""
    rng = np.random.default_rng(8)
    scores, rates, drift = {"bad": 1.0, "worse": 2.0}, np.array([0.05, 0.01]), 0.2
    decay = toxicity._decay(np.array([1.0, 2.0]), rates, drift)

    def texts(n):
        sizes = rng.integers(30, 400, n)
        return [" ".join(rng.choice(["bad", "worse", "fine"], k, p=[0.05, 0.01, 0.94])) for k in sizes]

    def model(scale):
        return toxicity.Model(scores, {}, (), drift, decay, scale, 0.05, 0.0, 1.0)

    def best(scorer, some):
        found = [scorer.runs(t) for t in some]
        return np.array([(n, max((r[2] for r in runs), default=0.0)) for n, runs in found])

    fitted = best(toxicity.Scorer(model(1.0)), texts(1500))
    scale = len(fitted) / (fitted[:, 0] * np.exp(-decay * fitted[:, 1])).sum()
    scorer = toxicity.Scorer(model(scale))
    for level in (0.02, 0.05, 0.2):
        fresh = best(scorer, texts(1500))
        rare = np.mean([scorer.excess(n, s) > -math.log(level) for n, s in fresh])
        assert level / 3 < rare < 2 * level  # an expected number of ``level``: about that share of texts


def test_logistic_fit_is_the_best_one():
    rng = np.random.default_rng(4)
    x = rng.exponential(1, 400)
    y = (rng.random(400) < 1 / (1 + np.exp(2 - 1.5 * x))).astype(float)
    weight = np.where(y == 1, 0.5, 1.3)

    def loss(a, b):
        at = a + b * x
        held = 0.5 * (1e-6 * a * a + 1e-2 * b * b)
        return (weight * (np.logaddexp(0, at) - y * at)).sum() + held

    a, b = toxicity._logistic(x, y, weight)
    assert all(loss(a, b) <= loss(a + i, b + j) for i in (-1e-3, 0, 1e-3) for j in (-1e-3, 0, 1e-3))
    assert toxicity._logistic(x, 1 - y, weight)[1] == 0.0  # never falling


@pytest.fixture(scope="module")
def toxic(spark):
    texts = []
    for i in range(120):
        words = [f"w{(i * 7 + j) % 40}x" for j in range(30)]
        words = ["".join(c for c in w if c.isalpha()) + "abcdefgh"[j % 8] for j, w in enumerate(words)]
        if i % 4 == 0:
            words[10:13] = ["vile", "rotten", "vile"]
        texts.append(" ".join(words))
    table = docs(spark, [*texts, None, "", "vile rotten vile", "x" * 200_000 + " vile rotten vile vile"])
    labels = spark.createDataFrame(
        [(i, int(i % 4 == 0)) for i in range(120)] + [(4, 0), (None, 1), (7, None)], "doc_id long, toxic int"
    )
    return table, toxicity.learn(table, labels, F.lit(True))


def test_toxic_texts_score_high(toxic):
    table, model = toxic
    found = by_id(toxicity.score(table.withColumn("SCORE", F.lit("old")), model))
    for i in range(120):
        assert (found[i]["score"] >= 0.5) == (i % 4 == 0)
    assert found[0]["passages"][0]["first_word"] == 10 and found[0]["passages"][0]["end_word"] == 13
    assert found[120]["score"] == found[121]["score"] == found[1]["score"] and not found[120]["passages"]
    assert found[122]["score"] >= 0.5 and found[123]["passages"]
    assert all(0 <= r["score"] <= 1 for r in found.values())


def test_toxicity_without_labels(spark, toxic):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    model = toxicity.learn(toxic[0], none, F.lit(True))
    assert {r["score"] for r in toxicity.score(toxic[0], model).collect()} == {chance_of_nothing()}
    empty = spark.createDataFrame([], DOCS)
    assert toxicity.score(empty, toxic[1]).count() == 0


def chance_of_nothing():
    return 1 / (1 + math.exp(30.0))


def test_toxicity_query_holds_out_a_fold(spark):
    found = QUERIES["op1_toxicity"](spark, DATA)
    assert found.columns[:4] == ["doc_id", "held_out", "score", "predicted"]
    rows = found.collect()
    assert len(rows) == table(spark, DATA, "documents").count()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)


# Language


def slow_language(model, text):
    """Costs of each word from the tables, one by one."""
    import re

    words = re.findall(r"[^\W\d_]+", (text or "").lower())
    if not words or not model.languages:
        return "und"
    total = [0.0] * len(model.languages)
    for word in words:
        costs = model.tables[0].get(word)
        for n in range(len(model.tables) - 1, 0, -1):
            if costs is not None:
                break
            known = [model.tables[n][g] for g in langid.grams(word, n) if g in model.tables[n]]
            if known:
                costs = [sum(c) / len(known) for c in zip(*known, strict=True)]
        if costs is not None:
            total = [a + b for a, b in zip(total, costs, strict=True)]
    return model.languages[min(range(len(total)), key=lambda i: (round(total[i], 9), i))]


@pytest.fixture(scope="module")
def languages(spark):
    given = table(spark, DATA, "documents")
    return given, langid.learn(given, F.col("doc_id") % 4 != 2)


def test_language_matches_the_tables_and_the_labels(spark, languages):
    given, model = languages
    rows = langid.identify(given, model).collect()
    assert all(r["lang_pred"] == slow_language(model, r["text"]) for r in rows)
    assert sum(r["lang_pred"] == r["lang"] for r in rows) >= 0.97 * len(rows)
    assert all(0 < r["score"] <= 1 for r in rows)


def test_learned_tables_are_counts(spark):
    texts = [("Aa b aa", "x"), ("b ccc!", "x"), ("AA ccc ccc", "y"), (None, "y"), ("zz", None)]
    given = spark.createDataFrame([(i, t, lang) for i, (t, lang) in enumerate(texts)], "doc_id long, text string, lang string")
    model = langid.learn(given, F.lit(True), longest=2)
    assert model.languages == ["x", "y"]
    cost = lambda n, of: pytest.approx(-math.log10(n / of))
    words = model.tables[0]
    assert set(words) == {"aa", "b", "ccc"}
    assert words["aa"] == (cost(2, 5), cost(1, 3)) and words["ccc"] == (cost(1, 5), cost(2, 3))
    assert words["b"][0] == cost(2, 5) and words["b"][1] > max(words["aa"])


def test_language_of_awkward_texts(spark, languages):
    texts = [None, "", " \n12 34 !", "漢字 仮名", "the", "THE The the", "the of and " * 100_000]
    odd = docs(spark, texts).withColumn("Score", F.lit("old"))
    found = by_id(langid.identify(odd, languages[1]))
    assert [found[i]["lang_pred"] for i in range(3)] == ["und"] * 3
    assert [found[i]["score"] for i in range(3)] == [0.0] * 3
    assert found[3]["lang_pred"] == languages[1].languages[0]
    assert [found[i]["lang_pred"] for i in (4, 5, 6)] == ["en"] * 3
    kept = by_id(langid.recognised(odd, languages[1]))
    assert {4, 5, 6} <= set(kept) and not {0, 1, 2} & set(kept)
    assert kept[4]["Score"] == "old"


def test_language_without_training(spark):
    given = docs(spark, ["a b", None], lang=None)
    model = langid.learn(given, F.lit(True))
    assert {r["lang_pred"] for r in langid.identify(given, model).collect()} == {"und"}


# Pages

PAGES = {
    None: None,
    "": "",
    "plain < text &amp; more": "plain < text & more",
    "<p>One <b>two<p>Three<br>four": "One two\n\nThree\nfour",
    "<head><title>t</title></head>body": "body",
    "<title>t</title><p>x": "x",
    "a<script>b</p></script>c<style>d</style><!-- e -->f": "acf",
    "a<!-- never closed": "a",
    "<div>a<div hidden>b</div>c</div>": "ac",
    "<span style='display: none'>a</span><i style='VISIBILITY:hidden'>b</i>c": "c",
    "<input type=hidden value=a><input value=b>": "b",
    "<ul><li>a<li>b<ol start=3><li>x<li>y</ol><li>c</ul>": "- a\n- b\n  3. x\n  4. y\n- c",
    "<table><tr><th>Name<th>N<tr><td>long name<td>1<tr><td>b<td>22</table>": (
        "Name       N\nlong name  1\nb          22"
    ),
    "<table><tr><td colspan=2>wide<td>C<tr><td>a<td>b<td>c</table>": "wide  C\na  b  c",
    "<table><tr><td colspan=2>a wide cell<td>C<tr><td>a<td>b<td>c</table>": "a wide cell  C\na  b         c",
    "<table><tr><td rowspan=2>tall<td>x<tr><td>y<tr><td>z<td>w</table>": "tall  x\n      y\nz     w",
    "<table><tr><td colspan=99999999>a<td colspan=0>b<td rowspan=x>c</table>": "a  b  c",
    "<details><summary>S</summary>no</details><dialog>no</dialog><dialog open>yes</dialog>": "S\nyes",
    "<details open><summary>S</summary>yes</details>": "S\nyes",
    "<a title='x>y'>in</a> <a title='x>y out": "in y out",
    "x <a href='q' <b>bold</b>": "x bold",
    "<table><tr><td>a<table><tr><td>b<td>c</table><td>d</table>": "a     d\n\nb  c",
    "<pre>  k\n   l</pre>": "  k\n   l",
    "<pre>\na\n\n\n  b\n</pre>c": "a\n\n\n  b\n\nc",
    "<blockquote>q</blockquote>r": "  q\n\nr",
    "x<img alt='pic'>y</p>z": "xpicy\n\nz",
    "<td>x</td>": "x",
    "a\n\n   b\t c": "a b c",
    "so <math><mi>x</mi><mo>=</mo><mfrac><mn>1</mn><mn>2</mn></mfrac></math>.": "so x=1 2 .",
    "<math><semantics><mi>y</mi><annotation>tex</annotation></semantics></math>z": "yz",
    "a<math display=block><mn>4</mn></math>b": "a\n4\nb",
    "<svg><title>t</title><desc>d</desc><metadata>m</metadata><defs><text>n</text></defs>"
    "<g> loose <rect/><text>one <tspan>two</tspan></text>\n<text x=1>three</text></g></svg>": "one two three",
    "<svg><title/><path d='M0'/><text>a</text><text display=none>b</text></svg><title/>c": "a",
    "<p>a<svg><foreignObject><p>b</p></foreignObject><text>c</text></svg>d": "a\n\nb\n\ncd",
    "<svg><path d=M0><p>after an open drawing": "after an open drawing",
    "<div style='visibility:hidden'>a<b style='visibility: visible'>b</b>c<img alt=d></div>e": "b\ne",
    "<div style='display:none'>a<b style='visibility:visible'>b</b></div>c": "c",
    "<p style='visibility:visible'><i style='visibility:hidden'>a<u style='visibility:inherit'>b</u></i>c": "c",
    "<div style='backface-visibility:hidden'>a</div>": "a",
    "a<!-->b c d": "ab c d",
    "a<!--->b<!-- x -->c": "abc",
    "a<!-- x --!>b": "ab",
    "a<!--[if !IE]><!-->b<!--<![endif]-->c": "abc",
}


@pytest.mark.parametrize("page", list(PAGES), ids=str)
def test_visible_text(page):
    assert html.visible_text(page) == PAGES[page]


def test_deep_and_long_pages():
    assert html.visible_text("<div>" * 50_000 + "x") == "x"
    assert html.visible_text("<p>" * 50_000 + "x") == "x"
    assert len(html.visible_text("word " * 200_000)) == 200_000 * 5 - 1


def test_all_visible_words_are_kept(spark):
    """Against tags and invisible elements taken out by pattern."""
    import re
    from html import unescape

    rows = QUERIES["op4_html"](spark, DATA).join(table(spark, DATA, "pages").drop("url"), "page_id").collect()
    assert len(rows) == table(spark, DATA, "pages").count()
    for r in rows:
        left = re.sub(
            r"(?s)<head>.*?</head>|<script.*?</script>|<style.*?</style>|<!--.*?-->", " ", r["html"]
        )
        wanted = unescape(re.sub(r"<[^>]*>", " ", left)).split()
        assert re.sub(r"(?m)^- ", "", r["text"]).split() == wanted


def test_page_column_replaces_its_namesake(spark):
    rows = spark.createDataFrame([("<p>a", "old")], "html string, TEXT string")
    assert html.extracted(rows).collect()[0]["text"] == "a"
    assert html.extracted(rows.limit(0)).count() == 0


# SentencePiece


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


@pytest.fixture(scope="module")
def encoder():
    return pieces.Encoder(pieces.vocabulary(MODEL))


def test_pieces_match_the_library(library, encoder):
    random.seed(5)
    texts = [
        "", " ", "a", "  hello  world\n x\ty 漢字🙂 ", "\n\n", "x" * 3000, " " * 100, " " * 37 + "漢", "▁▁a",
        "the" * 40, "\x00a\x00", "<s> </s> <unk>", "=======-----====", "don't  \n\n  indent",
    ]
    texts += [
        "".join(random.choice("ab cdeé\n▁ 漢.the") for _ in range(random.randint(1, 80)))
        for _ in range(2000)
    ]
    for text, ids in zip(texts, encoder(texts), strict=True):
        assert ids.tolist() == library.encode(text)
        assert pieces.decoded(ids.tolist(), encoder.raw) == library.decode(ids.tolist())
    assert encoder([None]) == [None]


@pytest.mark.parametrize("longest", [1, 2, 4, 8, 16])
def test_suffixes_start_with_packed_characters(encoder, monkeypatch, longest):
    monkeypatch.setattr(encoder, "longest", longest)
    for n in (1, 3, 300):
        codes = np.random.default_rng(n).integers(0, 3, n)
        order, heads = encoder.suffixes(codes)
        wide = np.concatenate([codes, np.zeros(16, np.int64)])
        assert sorted(order.tolist()) == list(range(n))
        ahead = [wide[at : at + longest].tolist() for at in order.tolist()]
        assert ahead == sorted(ahead)
        assert (np.diff(heads[order].astype(float)) >= 0).all()


def test_pieces_across_blocks(library, monkeypatch):
    monkeypatch.setattr(pieces, "BLOCK", 40)
    rng = random.Random(6)
    some = pieces.Encoder(pieces.vocabulary(MODEL))
    texts = [" ".join("".join(rng.choice("aeinrst") for _ in range(rng.randint(1, 60))) for _ in range(20)) for _ in range(30)]
    assert [ids.tolist() for ids in some(texts)] == [library.encode(t) for t in texts]


def test_pieces_of_documents(spark, library):
    rows = by_id(QUERIES["op9_pieces"](spark, DATA))
    for r in table(spark, DATA, "documents").collect():
        ids = library.encode(r["text"])
        found = rows[r["doc_id"]]
        assert found["n_ids"] == len(ids) and found["round_trip"]
        assert found["ids_crc32"] == zlib.crc32(" ".join(map(str, ids)).encode())


def test_pieces_of_awkward_rows(spark):
    rows = docs(spark, [None, "", "a"]).withColumn("IDS", F.lit("old"))
    found = by_id(pieces.decode(pieces.encode(rows, MODEL), MODEL))
    assert found[0]["ids"] is None and found[0]["decoded"] is None
    assert found[1]["ids"] == [] and found[1]["decoded"] == "" and found[2]["decoded"] == "a"
    assert pieces.encode(spark.createDataFrame([], DOCS), MODEL).count() == 0


@pytest.mark.parametrize("page, text", [
    ("x<a title=" + "\"'" * 250, "x<a title=" + "\"'" * 250), ("x<img " + "a='b' " * 300, "x<img " + "a='b' " * 300),
    ("<div>" * 100_000 + "x", "x"), ("<b>" * 100_000 + "x" + "</i>" * 100_000, "x"), ("<a " * 100_000, "<a " * 100_000),
    ("<table><tr><td>" * 3000 + "x", "x"),
])
def test_no_page_takes_long(page, text):
    started = time.process_time()
    assert html.visible_text(page).split() == text.split()
    assert time.process_time() - started < 10


def test_a_bound_on_the_hash_changes_no_sample(spark):
    rows = spark.range(4000).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") % 9 == 0, "b").otherwise("a").alias("lang"), F.lit("t").alias("text")
    )
    rows = rows.union(rows.filter("doc_id < 50"))
    for size in (10, 200, 3000):
        first = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")

        def chosen(some, first=first, size=size):
            return sorted(some.withColumn("at", F.row_number().over(first)).filter(F.col("at") <= size).collect())

        early = rows.filter(langid._early(rows, size))
        assert chosen(early) == chosen(rows)
        if size < 200:
            assert early.count() < 6 * size
