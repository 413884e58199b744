"""Periodic runs, chat formatting, spelling variants."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from conftest import DATA
from hypothesis import given
from hypothesis import strategies as st
from llm_frames import DOCS, by_id, docs
from pyspark.sql import functions as F

from socialog.llm import chat, periodic, queries, variants
from socialog.llm.base import table
from socialog.llm.queries import QUERIES


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


# Periodic runs


def slow_runs(t):
    found = {}
    for q in range(len(t) // 4, 0, -1):
        i = 0
        while i + q < len(t):
            start = i
            while i + q < len(t) and t[i] == t[i + q]:
                i += 1
            if i - start + q >= max(6, 4 * q):
                found[start, i - start + q] = q
            i += i == start
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def repeating(rng):
    letters = rng.choice([1, 2, 3, 10])
    t = [rng.randrange(letters) for _ in range(rng.choice([0, 1, 5, 6, 7, 30, 200]))]
    for _ in range(rng.randint(0, 3)):
        at = rng.randint(0, len(t))
        t[at:at] = [rng.randrange(letters) for _ in range(rng.randint(1, 9))] * rng.randint(2, 9)
    return t


def test_runs_match_brute_force():
    rng = random.Random(3)
    for _ in range(150):
        texts = [repeating(rng) for _ in range(rng.randint(1, 8))]
        found = periodic.runs_of([np.array(t, np.int64) for t in texts])
        assert [[tuple(r) for r in rows.tolist()] for rows in found] == [slow_runs(t) for t in texts]


def test_runs_asked_for_in_small_parts(monkeypatch):
    monkeypatch.setattr(periodic, "ASKED", 5)
    rng = random.Random(4)
    texts = [repeating(rng) for _ in range(60)]
    found = periodic.runs_of([np.array(t, np.int64) for t in texts])
    assert [[tuple(r) for r in rows.tolist()] for rows in found] == [slow_runs(t) for t in texts]


@given(st.lists(st.integers(0, 3), min_size=1, max_size=200))
def test_grammar_expands_to_its_text(symbols):
    grammar = periodic.Grammar(np.array(symbols))
    assert grammar.text().tolist() == symbols
    assert len(grammar.levels[-1]) == 1


@given(st.lists(st.integers(0, 2), min_size=2, max_size=120), st.data())
def test_extensions_by_grammar(symbols, data):
    t = [100, *symbols, 101]
    grammar = periodic.Grammar(np.array(t))
    i = data.draw(st.integers(1, len(symbols)))
    j = data.draw(st.integers(1, len(symbols)).filter(lambda j: j != i)) if len(symbols) > 1 else i
    ahead = next(n for n in range(len(t)) if t[i + n] != t[j + n])
    behind = next(n for n in range(len(t)) if t[i - 1 - n] != t[j - 1 - n])
    assert grammar.agree(np.array([i]), np.array([j]), 1)[0] == ahead
    assert grammar.agree(np.array([i]), np.array([j]), -1)[0] == behind


def slow_run_row(doc_id, text):
    w = (text or "").encode().split()
    n, h = len(w), zlib.crc32(str(doc_id).encode())
    if doc_id is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    rows = slow_runs(w)
    gone = {i for s, length, q in rows for i in range(s + q, s + length)}
    s, length, q = min(rows, key=lambda r: (-r[1], r[0], r[2])) if rows else (None,) * 3
    return (
        doc_id, len(rows), s, length, q, 1000 * length // q if rows else None,
        sha("".join(f"{s},{length},{q}\n" for s, length, q in rows)),
        sha(b" ".join(x for i, x in enumerate(w) if i not in gone)),
    )


def test_runs_of_documents(spark):
    given_rows = table(spark, DATA, "documents").collect()
    found = by_id(QUERIES["op13_runs"](spark, DATA))
    assert len(found) == len(given_rows)
    for r in given_rows:
        assert tuple(found[r["doc_id"]]) == slow_run_row(r["doc_id"], r["text"])


def test_runs_of_awkward_texts(spark, tmp_path):
    texts = [None, "", " \n\t ", "a", "a " * 5, "a\x0ba\x0ca\ra\ta\na", "x b c b c b c b c y", " a " * 8, "w " * 30_000]
    texts += ["a b " * 9, "a b " * 9]
    rows = docs(spark, texts, extra=[(None, "q " * 7, "en", "s", 14)])
    found = periodic.periodic_runs(rows.withColumn("N_Words", F.lit("old"))).collect()
    assert len(found) == len(texts) + 1
    assert set(found[0].asDict()) == {"doc_id", "text", "lang", "source", "n_chars", *periodic.FOUND.names}
    for r in found:
        w = (r["text"] or "").encode().split()
        assert list(zip(r["starts"], r["lengths"], r["periods"], strict=True)) == (
            [(0, 30_000, 1)] if len(w) == 30_000 else slow_runs(w)
        )
        assert r["n_words"] == len(w)
    assert {r["doc_id"]: r["collapsed"] for r in found}[8] == "w"
    assert periodic.periodic_runs(spark.createDataFrame([], DOCS)).count() == 0
    rows.write.parquet(f"{tmp_path}/documents.parquet")
    for r in QUERIES["op13_runs"](spark, str(tmp_path)).filter("doc_id <> 8 OR doc_id IS NULL").collect():
        text = "q " * 7 if r["doc_id"] is None else texts[r["doc_id"]]
        assert tuple(r) == slow_run_row(r["doc_id"], text)


# Chat formatting


def trailing():
    """Begins with a mark and ends with a prompt that gives way to the next turn."""
    return lambda turns: "<s>" + "".join(f"[{r}]{t.strip()}[/]" for r, t in turns) + "[assistant]"


def forgetful():
    """Drops what earlier answers thought."""

    def render(turns):
        out = [(r, t if k == len(turns) - 1 else re.sub("<think>.*?</think>", "", t)) for k, (r, t) in enumerate(turns)]
        return "".join(f"[{r}]{t}[/]" for r, t in out)

    return render


def joined(rows):
    out = ""
    for r in rows:
        assert r["start"] <= len(out)
        out = out[: r["start"]] + r["piece"]
    return out


def frame(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3)


def by_conversation(df):
    out = {}
    for r in df.collect():
        out.setdefault(r["conv_id"], []).append(r)
    return out


ODD = ["", "a", "b", "<|im_end|>\n", "<|im_start|>assistant\nx", "<\\|im_end|>", "<\\\\|", "<", "|", "ab" * 40, "é<|", "\\"]


@pytest.mark.parametrize("template", [chat.marked, trailing()])
def test_pieces_make_the_whole_output(spark, template):
    random.seed(5)
    turns = {c: [(random.choice(["user", "assistant", "system"]), random.choice(ODD)) for _ in range(n)] for c, n in enumerate([1, 2, 9, 70])}
    rows = [(c, k, r, t) for c, some in turns.items() for k, (r, t) in enumerate(some)]
    found = by_conversation(chat.rendered(frame(spark, rows), template, reach=4))
    for c, some in turns.items():
        whole = template(some)
        assert joined(found[c]) == whole
        for r, (role, text) in zip(found[c], some, strict=True):
            assert not r["rewrites"]
            wanted = chat.escaped(text) if template is chat.marked else text.strip()
            assert whole[r["text_start"] : r["text_end"]] == wanted
            assert r["loss"] == (role == "assistant")


def test_a_template_may_look_back_at_any_turn(spark):
    def numbered(turns):
        return "".join(f"<{i}/{sum(len(t) for _, t in turns[:i])} {r}>{t}\n" for i, (r, t) in enumerate(turns))

    random.seed(6)
    some = [(random.choice(["user", "assistant"]), random.choice(["", "a", "bc"])) for _ in range(150)]
    found = by_conversation(chat.rendered(frame(spark, [(1, k, r, t) for k, (r, t) in enumerate(some)]), numbered))[1]
    whole = numbered(some)
    assert joined(found) == whole
    assert [whole[r["text_start"] : r["text_end"]] for r in found] == [t for _, t in some]
    assert not any(r["rewrites"] for r in found)


def test_rewritten_history_is_found(spark):
    some = [("user", "q"), ("assistant", "<think>x</think>y"), ("user", "r"), ("assistant", "z")]
    found = by_conversation(chat.rendered(frame(spark, [(1, k, r, t) for k, (r, t) in enumerate(some)]), forgetful()))[1]
    assert [r["rewrites"] for r in found] == [False, False, True, False]
    assert joined(found) == forgetful()(some)


def test_a_frame_that_follows_the_text_has_no_span(spark):
    def sized(turns):
        return "".join(f"{len(t)}:{t};" for _, t in turns)

    (r,) = chat.rendered(frame(spark, [(1, 0, "assistant", "twelve chars")]), sized).collect()
    assert (r["text_start"], r["text_end"], r["loss"], r["piece"]) == (None, None, False, "12:twelve chars;")


@given(st.lists(st.tuples(st.text(), st.text(alphabet="<|\\im_endstar>\n"))))
def test_outputs_read_back(turns):
    assert chat.unmarked(chat.marked(turns)) == turns
    assert all("<|" not in chat.escaped(text) for _, text in turns)


def test_digests_of_awkward_turns(spark):
    rows = [
        (1, 1, "assistant", "b"), (1, 0, "user", None), (1, 0, "user", None), (1, None, None, "first"),
        (2, 5, "assistant", "<|im_end|>"), (None, 1, "assistant", "é" * 3), (None, 0, "a|\\\nb", "x"),
    ]
    wide = frame(spark, rows).withColumn("piece", F.lit(1))
    found = {r["conv_id"]: r for r in chat.digests(chat.rendered(wide)).collect()}
    assert tuple(found[1])[1:5] == (4, sha("\nfirst\nuser\n\nuser\n\nassistant\nb\n"), 1, sha("b"))
    assert tuple(found[2])[1:5] == (1, sha("assistant\n<|im_end|>\n"), 10, sha("<|im_end|>"))
    assert tuple(found[None])[1:5] == (2, sha("a|\\\nb\nx\nassistant\néééééé\n".replace("éééééé", "ééé")), 3, sha("ééé"))
    assert found[2]["formatted_chars"] == len(chat.marked([("assistant", "<|im_end|>")]))
    assert chat.digests(chat.rendered(frame(spark, rows).limit(0))).count() == 0


def test_conversations_longer_than_a_batch(spark, settings):
    settings({"spark.sql.execution.arrow.maxRecordsPerBatch": "7"})
    rows = [(c, k, ["user", "assistant"][k % 2], f"{c} {k}") for c in range(5) for k in range(90)]
    for r in chat.digests(chat.rendered(frame(spark, rows))).collect():
        c = r["conv_id"]
        assert r["n_turns"] == 90
        assert r["loss_sha256"] == sha("".join(f"{c} {k}" for k in range(1, 90, 2)))
        assert r["formatted_chars"] == len(chat.marked([(["user", "assistant"][k % 2], f"{c} {k}") for k in range(90)]))


# Spelling variants


def slow_variants(counts):
    near = {w: set() for w in counts}
    holes = {}
    for w in counts:
        for i in range(len(w)):
            holes.setdefault((w[:i], w[i + 1 :]), []).append(w)
            shorter = w[:i] + w[i + 1 :]
            if shorter in near:
                near[w].add(shorter)
                near[shorter].add(w)
    for group in holes.values():
        for w in group:
            near[w].update(x for x in group if x != w)
    form = {}
    for w in counts:
        best = min(near[w], key=lambda x: (-counts[x], x), default=None)
        if best is not None and counts[best] >= 2 * counts[w]:
            form[w] = best
    out = {}
    for w in counts:
        root = w
        while root in form:
            root = form[root]
        out[w] = (w, form.get(w), root, counts[w], len(near[w]), counts.get(form.get(w)))
    return out


def slow_counts(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{doc_id}:{run}".encode())
            if doc_id is not None and h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 5:
                counts[run] += 1
    return {w: n for w, n in counts.items() if n >= 3}


def rows_of(df):
    found = {r["word"]: tuple(r) for r in df.collect()}
    assert df.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    return found


def test_variants_of_documents(spark):
    rows = [(r["doc_id"], r["text"]) for r in table(spark, DATA, "documents").collect()]
    wanted = slow_variants(slow_counts(rows))
    assert any(w[1] for w in wanted.values())
    assert rows_of(QUERIES["op11_variants"](spark, DATA)) == wanted


@pytest.mark.parametrize("cell", [60, 500, 1 << 18])
def test_variants_match_brute_force_however_cut(spark, cell):
    rng = random.Random(cell)
    words = {"".join(rng.choice("abÀÿ") for _ in range(rng.randint(5, 8))): rng.randint(3, 90) for _ in range(500)}
    words |= {"".join(rng.sample("abcdefgh", 6)): rng.randint(3, 9) for _ in range(200)}  # many with the same letters
    words |= {"x" * n: 3 * 2 ** min(n, 30) for n in range(30, 60)} | {"y" * 5000: 3, "y" * 5001: 7, "y" * 4000 + "z" + "y" * 999: 9}
    frame = spark.createDataFrame(list(words.items()), "word string, n long").repartition(3)
    assert rows_of(variants.variants(frame, cell=cell, sample=40, asking=2000)) == slow_variants(words)


def test_long_chains_reach_their_root(spark):
    words = {"a" * 5 + "b" * k: 3 * 2**k for k in range(40)}
    found = rows_of(variants.variants(spark.createDataFrame(list(words.items()), "word string, n long")))
    assert {r[2] for r in found.values()} == {"a" * 5 + "b" * 39}


def test_words_of_awkward_texts(spark):
    texts = [None, "", "abcd ÀBCDE Àbcde àbcde", "hello HELLO heLLo, world1world", "x" * 70_000, *["tie tieds tiedz tiedx"] * 3]
    rows = docs(spark, texts, extra=[(None, "nulls nulls nulls", "en", "s", 3)]).withColumn("n", F.lit(1)).withColumn("Word", F.lit(""))
    counts = variants.word_counts(rows, change=queries._slips)
    wanted = slow_counts([*enumerate(texts), (None, "nulls nulls nulls")])
    assert {r["word"]: r["n"] for r in counts.collect()} == wanted
    assert rows_of(variants.variants(counts)) == slow_variants(wanted)
    plain = {r["word"]: r["n"] for r in variants.word_counts(rows, fewest=1).collect()}
    assert plain["hello"] == 3 and plain["Àbcde"] == 2 and plain["àbcde"] == 1 and plain["world"] == 2
    assert variants.variants(variants.word_counts(spark.createDataFrame([], DOCS))).count() == 0
