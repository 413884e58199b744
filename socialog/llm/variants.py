"""Spelling variants: words one edit apart, found by k-d trees over letter counts.

Words are counted over all texts first (each task adds up its own, then one shuffle).
A word is a point with one coordinate a letter. One replaced letter takes one
coordinate down and one up by one; one inserted letter takes one up. So near words
lie in the same length within one down and one up, or in the next length within one up.

Lengths with many words are cut into cells by a k-d tree over a sample of their words;
every word goes to its cell and, as a query, to each cell of its length and of the next
whose box such an edit can reach. Within a cell all words get a k-d tree with tight
boxes down to single points. Boxes and points are kept as unary bit strings, so the
distance of a query to a box, down and up, is a count of bits; all queries of a block
go down the tree together and boxes out of reach are pruned. Words of the points met
are then compared letter by letter. A task adds up what it found for each word; pairs
are never shuffled.

The form of a word is its near word of largest count (ties: smallest in code-point
order), if that count is at least ``ratio`` times its own. Roots follow forms to the end by
doubling; counts grow at each step, so there are no circles and few rounds.

The sample (``SAMPLE`` words of each length that is cut) decides the cells alone; all words
are indexed. A cell that turned out large is cut into parts by hash, each visited by
all its queries, and many queries into blocks; nothing is left out.

Defined results: NULL and empty texts have no words. Repeated rows count each. Every
word kept comes out once, also without near words (n_near 0). An empty table gives no
rows. Columns other than id and text are not read.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from socialog.llm.base import tidy, words_of
from socialog.session import written

Change = Callable[[int | None], Callable[[str], str]]

CELL = 1 << 18  # letters of the words of a cell
SAMPLE = 4096  # words of a length that its cells are fitted to
ASKING = 1 << 22  # letters of the queries of a block
TOGETHER = 4096  # queries that go down a tree together
COMPARED = 1 << 22  # letters compared at a time
HELD = 300_000  # different words a task counts before it hands them on
LETTERS = r"[A-Za-zÀ-ÿ]"
ROUTED = "size int, cell int, home boolean, word string, n long"
NEAR = "word string, n_near long, near_n long, near_word string"


# Counting


def word_counts(docs: DataFrame, shortest: int = 5, fewest: int = 3, change: Change | None = None) -> DataFrame:
    """(word, n) of words with ``shortest`` letters and ``fewest`` occurrences at least.

    Words are maximal runs of LETTERS with A-Z in lower case. ``change`` gives, for the
    id of a document, what alters its words; lengths and counts are those of the results.
    """
    run_of = re.compile(f"{LETTERS}{{{shortest},}}") if change is None else re.compile(f"{LETTERS}+")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()
        for batch in batches:
            for doc_id, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                lowered = (text or "").encode().lower().decode()  # bytes: A-Z alone
                runs = Counter(words_of(run_of, lowered))
                if change is None:
                    held.update(runs)
                    continue
                altered = change(doc_id)
                for word, n in runs.items():
                    word = altered(word)
                    if len(word) >= shortest:
                        held[word] += n
            if len(held) > HELD:
                yield counted(held)
                held.clear()
        yield counted(held)

    def counted(held: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], ["word", "n"]
        )

    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    parts = texts.mapInArrow(tidy(run), "word string, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= fewest)


# Points and trees


def _codes(words: list[str]) -> np.ndarray:
    """A row of code points for each of some words of one length."""
    return np.frombuffer("".join(words).encode("utf-32-le"), "<u4").reshape(len(words), -1)


def _counts(codes: np.ndarray, alphabet: np.ndarray) -> np.ndarray:
    """How often each letter of ``alphabet`` stands in each row; other letters are left out."""
    k = len(alphabet)
    at = np.minimum(np.searchsorted(alphabet, codes), k - 1)
    row, known = np.arange(len(codes))[:, None], alphabet[at] == codes
    flat = np.bincount((row * k + at)[known], minlength=len(codes) * k)
    return flat.reshape(len(codes), k).astype(np.int32)


class Tree:
    """K-d tree over rows of counts, split at means, down to equal rows or to ``leaves`` leaves.

    Node k has the box ``low[k]`` to ``high[k]`` and the children ``child[k]`` and the one after
    (-1: a leaf, whose rows are ``rows[begin[k]:end[k]]``). ``tight`` boxes bound the rows;
    the others hold all that the splits send there.
    """

    ANY = np.iinfo(np.int32).max

    def __init__(self, counts: np.ndarray, leaves: int | None = None, tight: bool = True):
        width = counts.shape[1]
        rows, begin = np.arange(len(counts)), np.zeros(1, np.int64)
        low, high = np.zeros((1, width), np.int32), np.full((1, width), self.ANY, np.int32)
        parts = defaultdict(list)
        nodes, leaf_rows, done = 0, 0, 1
        while len(begin):
            size = np.diff(begin, append=len(rows))
            here = counts[rows]
            least, most = np.minimum.reduceat(here, begin), np.maximum.reduceat(here, begin)
            total = np.add.reduceat(here, begin, dtype=np.int64)
            spread = np.add.reduceat(here.astype(np.int64) ** 2, begin) * size[:, None] - total**2
            letter = spread.argmax(axis=1)
            each = np.arange(len(begin))
            cut = least[each, letter] < most[each, letter]
            if leaves is not None:
                room = max(0, leaves - done)
                cut &= np.cumsum(cut) <= room
                done += int(cut.sum())
            bound = total[each, letter] // size
            child = np.where(cut, nodes + len(begin) + 2 * (np.cumsum(cut) - 1), -1)
            of = np.repeat(each, size)
            stays = ~cut[of]
            ends = leaf_rows + np.cumsum(np.where(cut, 0, size))
            for name, part in (
                ("low", least if tight else low),
                ("high", most if tight else high),
                ("letter", letter),
                ("bound", bound),
                ("child", child),
                ("begin", ends - np.where(cut, 0, size)),
                ("end", ends),
                ("rows", rows[stays]),
            ):
                parts[name].append(part)
            nodes += len(begin)
            leaf_rows = ends[-1]
            right = here[np.arange(len(rows)), letter[of]] > bound[of]
            key = (of * 2 + right)[~stays]
            rows = rows[~stays][np.argsort(key, kind="stable")]
            begin = np.searchsorted(np.sort(key), np.repeat(2 * each[cut], 2) + np.tile([0, 1], int(cut.sum())))
            low, high = np.repeat(low[cut], 2, axis=0), np.repeat(high[cut], 2, axis=0)
            k = np.arange(int(cut.sum()))
            high[2 * k, letter[cut]] = bound[cut]
            low[2 * k + 1, letter[cut]] = bound[cut] + 1
        for name, some in parts.items():
            setattr(self, name, np.concatenate(some))

    def home(self, counts: np.ndarray) -> np.ndarray:
        """The leaf that the splits send each row to."""
        node = np.zeros(len(counts), np.int64)
        while (inner := np.flatnonzero(self.child[node] >= 0)).size:
            at = node[inner]
            node[inner] = self.child[at] + (counts[inner, self.letter[at]] > self.bound[at])
        return node

    def reached(self, counts: np.ndarray, down: int, up: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """(row, leaf, down, up) for leaves whose box each row comes to by ``down`` and ``up`` at most."""
        top = np.maximum(counts.max(axis=0), np.where(self.high < self.ANY, self.high, 0).max(axis=0))
        low, high, asked = (_unary(c, top) for c in (self.low, self.high, counts))
        for first in range(0, len(counts), TOGETHER):
            row = np.arange(first, min(first + TOGETHER, len(counts)))
            node = np.zeros(len(row), np.int64)
            while len(row):
                fall = sum(np.bitwise_count(a[row] & ~h[node]).astype(np.int32) for a, h in zip(asked, high, strict=True))
                rise = sum(np.bitwise_count(b[node] & ~a[row]).astype(np.int32) for a, b in zip(asked, low, strict=True))
                near = (fall <= down) & (rise <= up)
                row, node, fall, rise = row[near], node[near], fall[near], rise[near]
                below = self.child[node]
                leaf = below < 0
                yield row[leaf], node[leaf], fall[leaf], rise[leaf]
                row, below = row[~leaf], below[~leaf]
                row, node = np.concatenate([row, row]), np.concatenate([below, below + 1])


def _unary(counts: np.ndarray, top: np.ndarray) -> list[np.ndarray]:
    """Bit strings in which letter d has ``top[d]`` bits, as many of them set as it counts; 64 bits an array."""
    bits = [counts[:, d] >= k for d in range(len(top)) for k in range(1, int(top[d]) + 1)]
    words = []
    for at in range(0, len(bits), 64):
        word = np.zeros(len(counts), np.uint64)
        for place, bit in enumerate(bits[at : at + 64]):
            word |= bit.astype(np.uint64) << np.uint64(place)
        words.append(word)
    return words or [np.zeros(len(counts), np.uint64)]


# Cells


def _cells(words: DataFrame, cell: int, sample: int) -> dict[int, tuple[np.ndarray, Tree]]:
    """Alphabet and tree of each length whose words hold more than ``cell`` letters.

    What comes to the driver is a row for each such length and at most about twice
    ``sample`` of its words; a tree has a leaf for each ``cell`` letters.
    """
    sizes = words.groupBy("size").agg(F.count(F.lit(1)).alias("words"))
    large = sizes.filter(F.col("words") * F.col("size") > cell).collect()
    if not large:
        return {}
    share = F.lit(0)
    for r in large:
        share = F.when(F.col("size") == r["size"], min(1 << 20, (sample << 20) // r["words"] + 1)).otherwise(share)
    drawn = defaultdict(list)
    for r in words.filter(F.pmod(F.xxhash64("word"), F.lit(1 << 20)) < share).select("size", "word").collect():
        drawn[r["size"]].append(r["word"])
    trees = {}
    for r in large:
        some = drawn.get(r["size"])
        if some:
            codes = _codes(sorted(some))
            alphabet = np.unique(codes)
            leaves = -(-r["words"] * r["size"] // cell)
            trees[r["size"]] = alphabet, Tree(_counts(codes, alphabet), leaves, tight=False)
    return trees


def _routed(words: DataFrame, trees: dict) -> DataFrame:
    """Each word in its cell (home) and in the cells it asks (not home)."""

    def reach(size: int, codes: np.ndarray, down: int) -> tuple[np.ndarray, np.ndarray]:
        """(row, cell) of the cells of ``size`` that an edit of each row can come to."""
        if size not in trees:
            return np.arange(len(codes)), np.zeros(len(codes), np.int64)
        alphabet, tree = trees[size]
        met = list(tree.reached(_counts(codes, alphabet), down, 1))
        return np.concatenate([m[0] for m in met]), np.concatenate([m[1] for m in met])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for size, some in batch.groupby("size"):
                codes = _codes(some["word"].tolist())
                own = np.zeros(len(some), np.int64)
                if size in trees:
                    alphabet, tree = trees[size]
                    own = tree.home(_counts(codes, alphabet))
                row, cell = reach(size, codes, 1)
                away = cell != own[row]
                longer, above = reach(size + 1, codes, 0)
                at = np.concatenate([np.arange(len(some)), row[away], longer])
                yield pd.DataFrame(
                    {
                        "size": np.repeat([size, size, size + 1], [len(some), away.sum(), len(longer)]),
                        "cell": np.concatenate([own, cell[away], above]),
                        "home": np.arange(len(at)) < len(some),
                        "word": some["word"].to_numpy()[at],
                        "n": some["n"].to_numpy()[at],
                    }
                )

    return words.mapInPandas(tidy(run), ROUTED)


def _dealt(routed: DataFrame, cell: int, asking: int) -> DataFrame:
    """Cells cut into parts and their queries into blocks, where they hold too much; each part meets each block."""
    letters = F.char_length("word").cast("long")
    loads = routed.groupBy("size", "cell").agg(
        F.ceil(F.sum(F.when(F.col("home"), letters)) / (4 * cell)).cast("int").alias("parts"),
        F.ceil(F.sum(letters) / asking).cast("int").alias("blocks"),
    )
    heavy = loads.filter("parts > 1 OR blocks > 1")
    one, h = F.lit(1), F.xxhash64("word")
    wide = routed.join(heavy, ["size", "cell"], "left").withColumns(
        {"parts": F.coalesce("parts", one), "blocks": F.coalesce("blocks", one)}
    )
    every = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    own = lambda n: F.pmod(h, F.col(n)).cast("int")
    index = wide.filter("home").select(
        "size", "cell", own("parts").alias("part"), F.explode(every("blocks")).alias("block"), "word", "n",
        F.lit(True).alias("indexed"), F.lit(False).alias("asks"),
    )
    asks = wide.select(
        "size", "cell", F.explode(every("parts")).alias("part"), own("blocks").alias("block"), "word", "n",
        F.lit(False).alias("indexed"), F.lit(True).alias("asks"),
    )
    return index.unionByName(asks)


# Search within a cell


def _one_replaced(asked: np.ndarray, found: np.ndarray) -> np.ndarray:
    return (asked != found).sum(axis=1) == 1


def _one_inserted(asked: np.ndarray, found: np.ndarray) -> np.ndarray:
    """Whether each row of ``found`` is that of ``asked`` with a letter more."""
    size = asked.shape[1]
    ahead = np.cumprod(asked == found[:, :size], axis=1, dtype=np.int8).sum(axis=1)
    behind = np.cumprod((asked == found[:, 1:])[:, ::-1], axis=1, dtype=np.int8).sum(axis=1)
    return ahead + behind >= size


def _pairs(tree: Tree, alphabet: np.ndarray, index: np.ndarray, asked: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(query, word) rows one edit apart: ``asked`` and ``index`` are code points of one length each."""
    longer = index.shape[1] - asked.shape[1]
    fits = _one_inserted if longer else _one_replaced
    for row, leaf, fall, rise in tree.reached(_counts(asked, alphabet), 1 - longer, 1):
        other = (rise == 1) & (fall == 1 - longer)
        row, leaf = row[other], leaf[other]
        n = tree.end[leaf] - tree.begin[leaf]
        row = np.repeat(row, n)
        word = tree.rows[np.repeat(tree.begin[leaf] - np.cumsum(n) + n, n) + np.arange(n.sum())]
        step = max(1, COMPARED // index.shape[1])
        for at in range(0, len(row), step):
            q, w = row[at : at + step], word[at : at + step]
            near = fits(asked[q], index[w])
            yield q[near], w[near]


def _near(cell: pd.DataFrame) -> pd.DataFrame:
    """What one group found for each word: how many near words, and the best of them."""
    size = int(cell["size"].iloc[0])
    index, asks = cell[cell["indexed"]], cell[cell["asks"]]
    words = np.concatenate([index["word"].to_numpy(), asks["word"].to_numpy()])
    n = np.concatenate([index["n"].to_numpy(), asks["n"].to_numpy()])
    width = asks["word"].str.len().to_numpy()
    groups = [at for wide in (size, size - 1) if len(at := np.flatnonzero(width == wide))]
    nothing = np.zeros(0, np.int64)
    subject, other = [nothing], [nothing]
    if len(index) and groups:
        codes = _codes(index["word"].tolist())
        asked = [_codes(asks["word"].iloc[at].tolist()) for at in groups]
        alphabet = np.unique(np.concatenate([np.unique(c) for c in (codes, *asked)]))
        tree = Tree(_counts(codes, alphabet))
        for at, some in zip(groups, asked, strict=True):
            for q, w in _pairs(tree, alphabet, codes, some):
                q = at[q] + len(index)
                subject.append(q)
                other.append(w)
                if some.shape[1] < size:  # a longer word doesn't ask for this one
                    subject.append(w)
                    other.append(q)
    subject, other = np.concatenate(subject), np.concatenate(other)
    rank = np.argsort(np.argsort(words, kind="stable"), kind="stable")
    order = np.lexsort((rank[other], -n[other], subject))
    subject, other = subject[order], other[order]
    first = np.flatnonzero(np.diff(subject, prepend=-1))
    return pd.DataFrame(
        {
            "word": words[subject[first]],
            "n_near": np.diff(first, append=len(subject)),
            "near_n": n[other[first]],
            "near_word": words[other[first]],
        }
    )


def near_words(words: DataFrame, cell: int = CELL, sample: int = SAMPLE, asking: int = ASKING) -> DataFrame:
    """``words`` (word, n; each word once) with n_near, and near_n and near_word of the near word of largest n."""
    sized = written(words.select("word", "n", F.char_length("word").alias("size")), "words")
    routed = written(_routed(sized, _cells(sized, cell, sample)), "routed")
    found = _dealt(routed, cell, asking).groupBy("size", "cell", "part", "block").applyInPandas(_near, NEAR)
    none = sized.select("word", "n", F.lit(0).cast("long").alias("n_near"), F.lit(None).cast("long").alias("near_n"),
                        F.lit(None).cast("string").alias("near_word"))
    best = F.when(F.col("near_n").isNotNull(), F.struct((-F.col("near_n")).alias("less"), "near_word"))
    return (
        none.unionByName(found.withColumn("n", F.lit(None).cast("long")))
        .groupBy("word")
        .agg(F.max("n").alias("n"), F.sum("n_near").alias("n_near"), F.min(best).alias("best"))
        .select("word", "n", "n_near", (-F.col("best.less")).alias("near_n"), F.col("best.near_word").alias("near_word"))
    )


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) for each of ``forms`` (word, form; no circles): where following forms ends.

    Each round every word jumps to where its aim points, so k rounds follow 2^k forms.
    """
    now = written(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        onward = now.select(F.col("word").alias("root"), F.col("root").alias("onward"))
        if not now.join(onward, "root", "left_semi").limit(1).count():
            return now
        now = written(now.join(onward, "root", "left").select("word", F.coalesce("onward", "root").alias("root")), "roots")


def variants(words: DataFrame, ratio: int = 2, cell: int = CELL, sample: int = SAMPLE, asking: int = ASKING) -> DataFrame:
    """``words`` (word, n; each word once) with form, root, n_near and form_n."""
    fits = F.col("near_n") >= ratio * F.col("n")
    near = written(
        near_words(words, cell, sample, asking).select(
            "word", "n", "n_near", F.when(fits, F.col("near_word")).alias("form"), F.when(fits, F.col("near_n")).alias("form_n")
        ),
        "near",
    )
    ends = roots(near.filter("form IS NOT NULL"))
    return near.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
