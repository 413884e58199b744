"""Toxic passages by maximum-scoring segments.

Each word gets the log odds of occurring in a toxic against a clean document,
under a Dirichlet prior that follows its overall frequency; what counts is the
lower confidence bound, so a word seen once or twice says little. A word too rare
to judge takes the bound of its longest known beginning (``beginnings`` letters).
All other words cost ``drift``. One linear pass (Ruzzo and Tompa) finds every
maximal-scoring run of words. Its expected number by chance is
``K n exp(-lambda S)``: lambda solves the usual equation for the clean word
scores, K is the maximum-likelihood fit to the best runs of clean documents. A
passage is significant if fewer than ``by_chance`` such are expected; the excess
of significant passages, summed, is mapped to a probability by a logistic fit.

Learned from at most ``toxic_docs`` toxic and ``clean_docs`` clean labelled
documents (smallest hash of the id) and at most ``features`` words and beginnings.

Defined results: NULL and empty texts have no passage and get the score of a text
without one. An id labelled more than once is toxic if any label says so; NULL
labels and ids teach nothing. Without labels of both classes every score is the
share of toxic labels (0 without any). Added columns replace input columns of the
same name; all others are kept.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from socialog.llm.base import LETTERS, per_text, tidy, with_fields, words_of
from socialog.session import written

CACHED = 150_000
PRIOR = 0.1  # weight of the prior against the counts
SURE = 1.645  # standard errors below the log odds
KNOWN = 5  # documents from which a word is judged by itself
RESULT = T.StructType(
    [
        T.StructField("score", T.DoubleType()),
        T.StructField(
            "passages",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("first_word", T.LongType()),
                        T.StructField("end_word", T.LongType()),
                        T.StructField("score", T.DoubleType()),
                    ]
                )
            ),
        ),
    ]
)


@dataclass(frozen=True)
class Model:
    words: dict[str, float]  # 0 for words known not to be toxic
    beginnings: dict[str, float]
    lengths: tuple[int, ...]  # of beginnings, longest first
    drift: float
    decay: float  # lambda
    scale: float  # K
    by_chance: float
    intercept: float
    slope: float


def maximal_runs(hits: list[tuple[int, float]], drift: float) -> list[tuple[int, int, float]]:
    """All maximal-scoring runs as (first, end, score).

    ``hits`` holds place and score of the positive items, in order; every other
    item scores ``-drift``. Linear in the hits.
    """
    runs: list[list[float]] = []  # first, end, total before, total after
    back: list[int] = []  # for each run, the nearest earlier one with a lower total before it
    total, last = 0.0, -1
    for place, score in hits:
        total -= drift * (place - last - 1)
        run = [place, place + 1, total, total + score]
        total, last = total + score, place
        while True:
            j = len(runs) - 1
            while j >= 0 and runs[j][2] >= run[2]:
                j = back[j]
            if j < 0 or runs[j][3] >= run[3]:
                runs.append(run)
                back.append(j)
                break
            run = [runs[j][0], run[1], runs[j][2], run[3]]
            del runs[j:], back[j:]
    return [(int(a), int(b), after - before) for a, b, before, after in runs]


class Scorer:
    def __init__(self, model: Model):
        self.model = model
        self.known: dict[str, float] = {}

    def word(self, word: str) -> float:
        found = self.model.words.get(word)
        if found is None:
            for n in self.model.lengths:
                found = self.model.beginnings.get(word[:n]) if len(word) > n else None
                if found is not None:
                    break
        if len(self.known) >= CACHED:
            self.known.clear()
        self.known[word] = found = found or 0.0
        return found

    def runs(self, text: str | None) -> tuple[int, list[tuple[int, int, float]]]:
        """Number of words, and all maximal-scoring runs."""
        hits, n, known = [], 0, self.known
        for n, word in enumerate(words_of(LETTERS, (text or "").lower()), 1):
            score = known.get(word)
            if score is None:
                score = self.word(word)
            if score:
                hits.append((n - 1, score))
        return n, maximal_runs(hits, self.model.drift)

    def excess(self, n: int, score: float) -> float:
        """-log of the expected number of such runs in ``n`` words by chance."""
        return self.model.decay * score - math.log(max(self.model.scale * n, 1e-300))

    def __call__(self, text: str | None) -> tuple[float, list[tuple[int, int, float]]]:
        n, runs = self.runs(text)
        least = -math.log(self.model.by_chance)
        found = [(r, e) for r in runs if (e := self.excess(n, r[2])) > least]
        return chance(self.model, sum(e for _, e in found)), [r for r, _ in found]


def chance(model: Model, excess: float) -> float:
    at = model.intercept + model.slope * math.log1p(max(excess, 0.0))
    return 1 / (1 + math.exp(-min(max(at, -30.0), 30.0)))


def _counted(lengths: tuple[int, ...]):
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            seen: dict[tuple[int, str], list[int]] = {}
            for toxic, text in zip(rows["toxic"], rows["text"], strict=True):
                words = set(words_of(LETTERS, text.lower()))
                keys = {(0, w) for w in words}
                keys |= {(n, w[:n]) for w in words for n in lengths if len(w) > n}
                for key in keys:
                    seen.setdefault(key, [0, 0])[toxic] += 1
            yield pd.DataFrame(
                [(n, f, b, a) for (n, f), (a, b) in seen.items()],
                columns=["n", "feature", "toxic", "clean"],
            )

    return count


def _measured(model: Model):
    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorer = Scorer(model)
        least = -math.log(model.by_chance)
        for rows in batches:
            out = []
            for toxic, text in zip(rows["toxic"], rows["text"], strict=True):
                n, runs = scorer.runs(text)
                scores = [s for _, _, s in runs]
                sure = sum(e for s in scores if (e := scorer.excess(n, s)) > least)
                out.append((toxic, n, max(scores, default=0.0), sure))
            yield pd.DataFrame(out, columns=["toxic", "n", "best", "excess"])

    return measure


def learn(
    docs: DataFrame,
    labels: DataFrame,
    training: Column,
    toxic_docs: int = 5_000,
    clean_docs: int = 10_000,
    features: int = 50_000,
    beginnings: tuple[int, ...] = (7, 6, 5),
    drift: float = 0.15,
    by_chance: float = 0.05,
) -> Model:
    """Fit on ``docs`` (doc_id, text) labelled by ``labels`` (doc_id, toxic) where ``training`` holds."""
    marks = (
        labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
        .filter(training)
        .groupBy("doc_id")
        .agg(F.max("toxic").cast("int").alias("toxic"))
        .filter(F.col("toxic").isin(0, 1))
    )
    share = dict(marks.groupBy("toxic").count().collect())
    chosen = None
    for value, most in ((1, toxic_docs), (0, clean_docs)):
        some = (
            marks.filter(F.col("toxic") == value)
            .orderBy(F.xxhash64("doc_id"), "doc_id")
            .limit(most)
        )
        chosen = some if chosen is None else chosen.unionByName(some)
    # At most toxic_docs + clean_docs narrow rows.
    sample = written(
        docs.select("doc_id", "text")
        .filter(F.col("text").isNotNull())
        .join(F.broadcast(chosen), "doc_id")
        .select("toxic", "text"),
        "toxicity-sample",
    )
    size = dict(sample.groupBy("toxic").count().collect())
    labelled = sum(share.values())
    base = share.get(1, 0) / labelled if labelled else 0.0
    if not size.get(0) or not size.get(1):
        at = math.log(base / (1 - base)) if 0 < base < 1 else (30.0 if base else -750.0)
        return Model({}, {}, beginnings, drift, 1.0, 1.0, by_chance, at, 0.0)

    counts = (
        sample.mapInPandas(tidy(_counted(beginnings)), "n int, feature string, toxic long, clean long")
        .groupBy("n", "feature")
        .agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    )
    judged = written(counts.withColumn("bound", _bound(size[1], size[0])), "toxicity-words")
    significant = judged.filter(F.col("bound") > 0)
    top = significant.orderBy(F.desc("bound"), "n", "feature").limit(features).toPandas()
    starts = top[top["n"] > 0]
    # Words judged harmless by themselves, though a word like them is not.
    harmless = judged.filter(
        (F.col("n") == 0) & (F.col("bound") <= 0) & (F.col("toxic") + F.col("clean") >= KNOWN)
    ).withColumn("start", F.explode(F.array(*[F.substring("feature", 1, n) for n in beginnings])))
    exempt = (
        harmless.join(
            F.broadcast(judged.sparkSession.createDataFrame(starts[["feature"]], "start string")),
            "start",
            "left_semi",
        )
        .groupBy("feature")
        .agg(F.max(F.col("toxic") + F.col("clean")).alias("seen"))
        .orderBy(F.desc("seen"), "feature")
        .limit(features)
        .toPandas()
    )
    own = top[top["n"] == 0]
    words = dict.fromkeys(exempt["feature"], 0.0) | dict(zip(own["feature"], own["bound"], strict=True))
    rough = Model(
        words,
        dict(zip(starts["feature"], starts["bound"], strict=True)),
        beginnings, drift, 1.0, 1.0, by_chance, 0.0, 1.0,
    )
    seen = sample.mapInPandas(tidy(_measured(rough)), "toxic int, n long, best double, excess double").toPandas()
    clean = seen[(seen["toxic"] == 0) & (seen["n"] > 0)]
    n_words = max(int(clean["n"].sum()), 1)
    scores = top["bound"].to_numpy()
    rates = (top["clean"] + PRIOR * (top["clean"] + top["toxic"])).to_numpy() / n_words
    decay = _decay(scores, rates, drift)
    scale = len(clean) / max(float((clean["n"] * np.exp(-decay * clean["best"])).sum()), 1e-300)
    fitted = Model(**(rough.__dict__ | {"decay": decay, "scale": max(scale, 1e-12)}))
    seen = sample.mapInPandas(tidy(_measured(fitted)), "toxic int, n long, best double, excess double").toPandas()
    x, y = np.log1p(seen["excess"].to_numpy()), seen["toxic"].to_numpy(dtype=float)
    weight = np.where(y == 1, share[1] / size[1], share[0] / size[0])
    intercept, slope = _logistic(x, y, weight / weight.mean())
    return Model(**(fitted.__dict__ | {"intercept": intercept, "slope": slope}))


def _bound(toxic_docs: int, clean_docs: int) -> Column:
    """Lower confidence bound of the log odds under the Dirichlet prior."""
    prior = PRIOR * (F.col("toxic") + F.col("clean"))
    a, b = F.col("toxic") + prior, F.col("clean") + prior
    # One document more of each class, so that a word may be in all of them.
    total = PRIOR * (toxic_docs + clean_docs) + 1
    odds = F.log(a / (toxic_docs + total - a)) - F.log(b / (clean_docs + total - b))
    return odds - SURE * F.sqrt(1 / a + 1 / b)


def _decay(scores: np.ndarray, rates: np.ndarray, drift: float) -> float:
    """The positive root of E[exp(lambda s)] = 1 over clean words."""
    rest = max(1 - float(rates.sum()), 0.0)

    def over(at: float) -> bool:
        return rest * math.exp(-at * drift) + float((rates * np.exp(np.minimum(at * scores, 700))).sum()) > 1

    low, high = 0.0, 20.0
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (low, mid) if over(mid) else (mid, high)
    return max(low, 1e-3)


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Weighted logistic fit of one feature by Newton steps, slope held at 0 or more."""
    at = np.zeros(2)
    rows = np.column_stack([np.ones_like(x), x])
    hold = np.diag([1e-6, 1e-2])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(rows @ at, -30, 30)))
        slope = rows.T @ (weight * (y - p)) - hold @ at
        curve = (rows * (weight * p * (1 - p))[:, None]).T @ rows + hold
        step = np.linalg.solve(curve, slope)
        at = at + np.clip(step, -3, 3)
        if np.abs(step).max() < 1e-9:
            break
    return float(at[0]), max(float(at[1]), 0.0)


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Add ``score`` (0 to 1) and the significant ``passages`` (word ranges) to every row."""
    shared = docs.sparkSession.sparkContext.broadcast(vars(model))
    scored = per_text(lambda: Scorer(Model(**shared.value)), RESULT)
    return with_fields(docs, scored(docs[text]), {n: n for n in RESULT.names})
