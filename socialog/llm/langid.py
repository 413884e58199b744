"""Language identification, words first.

A word known from training is scored by its log frequency in each language. An
unseen word backs off to its character n-grams, longest first: the first length
of which any n-gram is known gives the word's score. A text goes to the language
with the best mean over its words.

Learned from at most ``per_language`` documents of each language (those with the
smallest hash of the id), of which at most ``words`` words and ``grams`` n-grams
of each length are kept per language.

Defined results: NULL text, empty text and text with no letter are ``und`` with
score 0. A text of which nothing is known, and a tie, go to the first language by
name. Without any training row every text is ``und``. Rows whose language or id
is NULL teach nothing. Repeated rows are learned, and answered, once each. Added
columns replace input columns of the same name; all others are kept.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from socialog.llm.base import LETTERS, per_text, tidy, with_fields, words_of

UNKNOWN = "und"
CACHED = 150_000  # words whose scores a task keeps at hand
RESULT = T.StructType(
    [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
)
COUNTS = "lang string, n int, feature string, seen long"


@dataclass(frozen=True)
class Model:
    """``tables[0]`` holds words, ``tables[n]`` n-grams: -log10 frequency per language."""

    languages: list[str]
    tables: list[dict[str, tuple[float, ...]]]


def grams(word: str, n: int) -> list[str]:
    if n == 1:
        return list(word)
    padded = f" {word} "
    return [padded[i : i + n] for i in range(len(padded) - n + 1)]


def _counted(longest: int):
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            words: dict[str, Counter] = {}
            for lang, text in zip(rows["lang"], rows["text"], strict=True):
                words.setdefault(lang, Counter()).update(words_of(LETTERS, text.lower()))
            seen: Counter = Counter()
            for lang, counts in words.items():
                for word, k in counts.items():
                    seen[lang, 0, word] = k
                    for n in range(1, longest + 1):
                        for gram in grams(word, n):
                            seen[lang, n, gram] += k
            yield pd.DataFrame(
                [(*key, k) for key, k in seen.items()], columns=["lang", "n", "feature", "seen"]
            )

    return count


def learn(
    docs: DataFrame,
    training: Column,
    per_language: int = 1500,
    words: int = 10_000,
    grams: int = 4_000,
    longest: int = 5,
) -> Model:
    """Fit on the rows of ``docs`` (doc_id, text, lang) for which ``training`` holds."""
    labelled = docs.filter(training & F.col("lang").isNotNull()).select("doc_id", "lang", "text")
    first = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    chosen = (
        labelled.select("doc_id", "lang")
        .filter(_early(labelled, per_language))
        .withColumn("_at", F.row_number().over(first))
        .filter(F.col("_at") <= per_language)
        .select("doc_id", "lang")
        .distinct()
    )
    # At most per_language narrow rows of each language.
    rows = labelled.join(F.broadcast(chosen), ["doc_id", "lang"]).filter(F.col("text").isNotNull())
    counts = (
        rows.select("lang", "text")
        .mapInPandas(tidy(_counted(longest)), COUNTS)
        .groupBy("lang", "n", "feature")
        .agg(F.sum("seen").alias("seen"))
    )
    per_table = Window.partitionBy("lang", "n")
    kept = (
        counts.withColumn("total", F.sum("seen").over(per_table))
        .withColumn("at", F.row_number().over(per_table.orderBy(F.desc("seen"), "feature")))
        .filter(F.col("at") <= F.when(F.col("n") == 0, words).otherwise(grams))
        .select("lang", "n", "feature", "seen", "total")
        .toPandas()
    )
    return _model(kept, longest)


def _early(labelled: DataFrame, per_language: int) -> Column:
    """Whether a row can be among the first ``per_language`` of its language in order of hash.

    A bound on the hash lets about twice as many through, so that ranking them takes
    no task more than that. Where it would let too few through, there is none.
    """
    hashed = F.xxhash64("doc_id")
    bounds = {}
    for lang, n in labelled.groupBy("lang").count().collect():  # a row a language
        if n > 2 * per_language:
            bounds[lang] = ((1 << 65) * per_language // n) - (1 << 63)
    if not bounds:
        return F.lit(True)

    def below(held: dict[str, int]) -> Column:
        pairs = [F.lit(x) for pair in held.items() for x in pair]
        bound = F.try_element_at(F.create_map(*pairs), F.col("lang")) if pairs else F.lit(None)
        return bound.isNull() | (hashed < bound)

    met = dict(labelled.filter(below(bounds)).groupBy("lang").count().collect())
    return below({lang: b for lang, b in bounds.items() if met.get(lang, 0) >= per_language})


def _model(kept: pd.DataFrame, longest: int) -> Model:
    languages = sorted(kept["lang"].unique())
    place = {lang: i for i, lang in enumerate(languages)}
    tables: list[dict[str, tuple[float, ...]]] = []
    for n in range(longest + 1):
        part = kept[kept["n"] == n]
        absent = math.log10(max(part["total"], default=1)) + 1  # rarer than anything seen
        table: dict[str, list[float]] = {}
        for lang, feature, seen, total in zip(
            part["lang"], part["feature"], part["seen"], part["total"], strict=True
        ):
            costs = table.setdefault(feature, [absent] * len(languages))
            costs[place[lang]] = -math.log10(seen / total)
        tables.append({f: tuple(c) for f, c in table.items()})
    return Model(languages, tables)


class Scorer:
    """Scores whole texts; keeps the costs of recent words."""

    def __init__(self, model: Model):
        self.model = model
        self.longest = len(model.tables) - 1
        self.costs = np.zeros((CACHED, len(model.languages)))
        self.at: dict[str, int] = {}

    def word(self, word: str) -> tuple[float, ...]:
        """Costs of a word; zeros if nothing of it is known."""
        found = self.model.tables[0].get(word)
        if found is not None:
            return found
        for n in range(self.longest, 0, -1):
            table = self.model.tables[n]
            known = [table[g] for g in grams(word, n) if g in table]
            if known:
                return tuple(sum(c) / len(known) for c in zip(*known, strict=True))
        return (0.0,) * len(self.model.languages)

    def place(self, word: str) -> int:
        found = self.at.get(word)
        if found is None:
            found = self.at[word] = len(self.at)
            self.costs[found] = self.word(word)
        return found

    def __call__(self, text: str | None) -> tuple[str, float]:
        counts = Counter(words_of(LETTERS, text.lower())) if text else None
        if not counts or not self.model.languages:
            return UNKNOWN, 0.0
        total = np.zeros(len(self.model.languages))
        words = list(counts)
        for start in range(0, len(words), CACHED // 2):
            part = words[start : start + CACHED // 2]
            if len(self.at) + len(part) > CACHED:
                self.at.clear()
            at = np.fromiter(map(self.place, part), np.int64, len(part))
            times = np.fromiter((counts[w] for w in part), np.float64, len(part))
            total += times @ self.costs[at]
        best = int(np.argmin(total))
        odds = np.exp(-math.log(10) * (total - total[best]))
        return self.model.languages[best], float(1 / odds.sum())


def identify(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Add ``lang_pred`` and ``score`` (share of the best language, 0 to 1) to every row."""
    shared = docs.sparkSession.sparkContext.broadcast(vars(model))
    predicted = per_text(lambda: Scorer(Model(**shared.value)), RESULT)
    return with_fields(docs, predicted(docs[text]), {n: n for n in RESULT.names})


def recognised(docs: DataFrame, model: Model, least: float = 0.5) -> DataFrame:
    """Rows whose text has a language, found with a share of ``least`` or more."""
    columns = docs.columns
    shared = docs.sparkSession.sparkContext.broadcast(vars(model))
    predicted = per_text(lambda: Scorer(Model(**shared.value)), RESULT)(docs["text"])
    kept = (predicted["lang_pred"] != UNKNOWN) & (predicted["score"] >= least)
    return docs.filter(kept).select(*[docs[c] for c in columns])
