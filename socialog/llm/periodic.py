"""Periodic runs of words, by recompression.

The words of many texts, a mark of its own between any two, make one sequence of
numbers. Recompression turns it into a run-length grammar: block compression names
each stretch of one symbol by symbol and count, pair compression splits the symbols
in left and right ones by hash and names each pair (left, right). The two alternate
until little is left. Where a symbol of the next level starts depends on two
neighbours alone, so equal stretches are parsed alike but for their ends.

That answers how far two places agree, forwards or backwards: go up while both places
are edges of the next level (after passing one symbol or the rest of one block), and
where symbols differ go down again, passing at most one symbol or one block a level.
Many pairs of places are answered at once.

A run of period q has at least 3q places that equal the word q later (five, if q is
1), so the grid of every third multiple of q meets one. Grid places whose words are
equal are the candidates; each is extended both ways, exactly. Stretches found with a
multiple of their period have the same ends, so the least period stays. Work is
n log n places of the grid at most, a third of a strided comparison each.

A text is never cut. Texts are taken together up to BLOCK words; memory follows that
or the longest text. Nothing is shuffled.

Defined results: NULL and empty texts have no words and no runs. Words are maximal
runs of other bytes than space, tab, line feed, vertical tab, form feed and carriage
return. Repeated rows are treated each. Added columns replace columns of the same
name; all others are kept. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from socialog.llm.base import tidy, with_fields

BLOCK = 1 << 19  # words compressed together
ASKED = 1 << 18  # pairs of places extended at a time
FEW = 6  # words of the shortest run
TIMES = 4  # periods of the shortest run
ROUNDS = 400
FOUND = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        *(T.StructField(name, T.ArrayType(T.LongType())) for name in ("starts", "lengths", "periods")),
        T.StructField("collapsed", T.StringType()),
    ]
)


@dataclass
class Step:
    """How a level came from the one below."""

    blocks: bool
    first: np.ndarray  # where each symbol starts below, and the end
    cover: np.ndarray  # the symbol over each place below
    base: int  # rule k makes symbol base + k:
    left: np.ndarray  # of a pair the left symbol, of a block its symbol
    right: np.ndarray  # of a pair the right symbol, of a block the count


class Grammar:
    """Run-length grammar of a sequence of numbers; its first and last occur once."""

    def __init__(self, symbols: np.ndarray, enough: int = 1):
        """Compress until ``enough`` symbols are left."""
        self.levels = [symbols.astype(np.int64)]
        self.steps: list[Step] = []
        self.next = int(symbols.max()) + 1
        self.start = self.next
        for turn in range(ROUNDS):
            if len(self.levels[-1]) <= enough:
                break
            self._blocks()
            self._pairs(turn)

    def _add(self, blocks: bool, starts: np.ndarray, joined: np.ndarray, left, right) -> None:
        """A level whose symbols start where ``starts`` says; those ``joined`` are renamed."""
        below = self.levels[-1]
        first = np.flatnonzero(starts)
        wide = self.next
        keys, names = np.unique(left * np.int64(wide) + right, return_inverse=True)
        above = below[first]
        above[joined[first]] = wide + names
        cover = np.cumsum(starts) - 1
        first = np.append(first, len(below))
        self.steps.append(Step(blocks, first, cover, wide, keys // wide, keys % wide))
        self.levels.append(above)
        self.next = wide + len(keys)

    def _blocks(self) -> None:
        s = self.levels[-1]
        starts = np.ones(len(s), bool)
        starts[1:] = s[1:] != s[:-1]
        if starts.all():
            return
        first = np.flatnonzero(starts)
        count = np.diff(first, append=len(s))
        long = first[count > 1]
        self.next = max(self.next, len(s) + 1)  # a count is no larger than a name
        joined = np.zeros(len(s), bool)
        joined[long] = True
        self._add(True, starts, joined, s[long], count[count > 1])

    def _pairs(self, turn: int) -> None:
        s = self.levels[-1]
        mixed = s.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15 + 2 * turn * 0x632BE59BD9B4E019 & (1 << 64) - 1)
        side = (mixed >> np.uint64(40)) & np.uint64(1) > 0
        one, other = ~side[:-1] & side[1:], side[:-1] & ~side[1:]
        pair = one if one.sum() >= other.sum() else other
        at = np.flatnonzero(pair)
        if not len(at):
            return
        starts = np.ones(len(s), bool)
        starts[at + 1] = False
        joined = np.zeros(len(s), bool)
        joined[at] = True
        self._add(False, starts, joined, s[at], s[at + 1])

    def text(self) -> np.ndarray:
        """The sequence, expanded from the top by the rules alone."""
        s = self.levels[-1]
        for step in reversed(self.steps):
            rule = s - step.base
            made = (rule >= 0) & (rule < len(step.left))
            rule = np.where(made, rule, 0)
            left = np.where(made, step.left[rule], s) if len(step.left) else s
            if step.blocks:
                s = np.repeat(left, np.where(made, step.right[rule], 1))
                continue
            out = np.repeat(left, 1 + made)
            out[np.flatnonzero(made) + np.cumsum(made)[made]] = step.right[rule[made]]
            s = out
        return s

    def agree(self, i: np.ndarray, j: np.ndarray, way: int) -> np.ndarray:
        """How many symbols agree from places i and j on (way 1) or before them (way -1).

        i and j differ; marks that occur once, at both ends of the sequence at
        least, stop them.
        """
        back = int(way < 0)
        a, b = i.copy(), j.copy()
        stop = np.full(len(a), len(self.steps))
        live = np.arange(len(a))
        for h, step in enumerate(self.steps):
            if not len(live):
                break
            x, y = a[live], b[live]
            edge = (step.first[step.cover[x]] == x) & (step.first[step.cover[y]] == y)
            passed, even = self._pass(h, x, y, back)
            n = np.where(edge, 0, passed) * way
            x, y = x + n, y + n
            up = edge | even
            a[live], b[live] = np.where(up, step.cover[x], x), np.where(up, step.cover[y], y)
            stop[live[~up]] = h
            live = live[up]
        top = self.levels[-1]
        while len(live):
            live = live[top[a[live] - back] == top[b[live] - back]]
            a[live] += way
            b[live] += way
        for h in range(len(self.steps) - 1, -1, -1):
            down = np.flatnonzero(stop > h)
            if not len(down):
                continue
            step = self.steps[h]
            x, y = step.first[a[down]], step.first[b[down]]
            passed, _ = self._pass(h, x, y, back)
            a[down], b[down] = x + passed * way, y + passed * way
        return (a - i) * way

    def _pass(self, h: int, x: np.ndarray, y: np.ndarray, back: int) -> tuple[np.ndarray, np.ndarray]:
        """Symbols of level h to pass, none where they differ; whether both then stand at edges above."""
        s, step = self.levels[h], self.steps[h]
        same = s[x - back] == s[y - back]
        if not step.blocks:
            return same.astype(np.int64), same
        if back:
            left, right = x - step.first[step.cover[x - 1]], y - step.first[step.cover[y - 1]]
        else:
            left, right = step.first[step.cover[x] + 1] - x, step.first[step.cover[y] + 1] - y
        return np.where(same, np.minimum(left, right), 0), same & (left == right)


def _grid(words: np.ndarray, owner: np.ndarray, longest: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(place, period) of candidates, about ASKED at a time: a word of the grid equals that a period later."""
    places, periods, held = [], [], 0
    for p in range(1, longest // TIMES + 1):
        early = words[: -p : 3 * p]
        at = np.flatnonzero(early == words[p :: 3 * p][: len(early)]) * (3 * p)
        at = at[owner[at] == owner[at + p]]
        if len(at):
            places.append(at)
            periods.append(np.full(len(at), p))
            held += len(at)
        if held > ASKED:
            yield np.concatenate(places), np.concatenate(periods)
            places, periods, held = [], [], 0
    if held:
        yield np.concatenate(places), np.concatenate(periods)


def runs_of(texts: list[np.ndarray]) -> list[np.ndarray]:
    """Runs of each sequence of numbers: rows (start, length, period) by start, then period.

    A run has length of at least FEW and TIMES its smallest period, and no neighbour
    extends it.
    """
    sizes = np.array([len(t) for t in texts], np.int64)
    nothing = np.zeros((0, 3), np.int64)
    if not len(texts) or sizes.max() < FEW:
        return [nothing] * len(texts)
    begin = np.cumsum(sizes + 1) - sizes
    words = np.zeros(begin[-1] + sizes[-1] + 1, np.int64)
    marks = np.append(begin - 1, len(words) - 1)
    owner = np.repeat(np.arange(len(marks)), np.diff(marks, append=len(words)))
    inside = np.ones(len(words), bool)
    inside[marks] = False
    words[inside] = np.concatenate(texts)
    words[marks] = words.max() + 1 + np.arange(len(marks))
    grammar = Grammar(words, len(marks))
    found = []
    for at, period in _grid(words, owner, int(sizes.max())):
        for k in range(0, len(at), ASKED):
            i, p = at[k : k + ASKED], period[k : k + ASKED]
            before = grammar.agree(i, i + p, -1)
            length = before + grammar.agree(i, i + p, 1) + p
            fits = length >= np.maximum(FEW, TIMES * p)
            found.append(np.stack([(i - before)[fits], length[fits], p[fits]], axis=1))
    every = np.concatenate([nothing, *found])
    every = every[np.lexsort((every[:, 2], every[:, 1], every[:, 0]))]
    fresh = np.ones(len(every), bool)
    fresh[1:] = (every[1:, :2] != every[:-1, :2]).any(axis=1)  # the least period of each stretch
    every = every[fresh]
    every = every[np.lexsort((every[:, 2], every[:, 0]))]
    of = owner[every[:, 0]]
    every[:, 0] -= begin[of] if len(of) else 0
    return np.split(every, np.searchsorted(of, np.arange(1, len(texts))))


def _kept(words: list[bytes], runs: np.ndarray) -> list[bytes]:
    """Words that no run holds after its first period."""
    step = np.zeros(len(words) + 1, np.int64)
    np.add.at(step, runs[:, 0] + runs[:, 2], 1)
    np.add.at(step, runs[:, 0] + runs[:, 1], -1)
    return [words[i] for i in np.flatnonzero(np.cumsum(step[:-1]) == 0).tolist()]


class _Numbers(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


def _found(texts: pd.Series) -> Iterator[tuple]:
    """Results of some texts, block by block."""
    waiting: list[list[bytes]] = []
    held = 0

    def block() -> Iterator[tuple]:
        number = _Numbers()
        rows = [np.fromiter(map(number.__getitem__, w), np.int64, len(w)) for w in waiting]
        for words, runs in zip(waiting, runs_of(rows), strict=True):
            kept = _kept(words, runs) if len(runs) else words
            yield len(words), runs[:, 0], runs[:, 1], runs[:, 2], b" ".join(kept).decode()

    for text in texts:
        words = (text or "").encode().split()
        if waiting and held + len(words) > BLOCK:
            yield from block()
            waiting, held = [], 0
        waiting.append(words)
        held += len(words)
    yield from block()


def periodic_runs(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with n_words, starts, lengths, periods (one entry a run, by start, then period) and collapsed.

    ``collapsed`` is the text without the words that a run repeats: each run keeps its
    first period; kept words are joined by one space.
    """

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            yield pd.DataFrame(list(_found(texts)), columns=FOUND.names)

    run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.DataFrame]}
    made = F.pandas_udf(tidy(run), FOUND)(F.col(text))
    return with_fields(docs, made, {name: name for name in FOUND.names})
