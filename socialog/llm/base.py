"""What the operators share: scans, text columns through Arrow, fold tests."""

from __future__ import annotations

import ctypes
import gc
import re
from collections.abc import Callable, Iterator
from contextlib import suppress
from functools import wraps
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

LONG_TEXT = 1 << 20  # characters from which words are walked, not listed
LETTERS = re.compile(r"[^\W\d_]+")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def tokenizer_path(name: str) -> str:
    """Where a public vocabulary file lies, on every executor alike."""
    import public_tokenizers

    return public_tokenizers.path(name)


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; NULL for a NULL id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % folds


def is_fold(doc_id: Column, folds: int, wanted: int) -> Column:
    """Whether the id falls in fold ``wanted``; false for a NULL id."""
    return F.coalesce(fold(doc_id, folds) == wanted, F.lit(False))


def words_of(pattern: re.Pattern, text: str):
    """Matches of ``pattern`` in order; a very long text is walked lazily."""
    if len(text) < LONG_TEXT:
        return pattern.findall(text)
    return (m.group() for m in pattern.finditer(text))


def tidy(run):
    """Give the memory of a finished task back: a Python worker goes on to other tasks."""

    @wraps(run)
    def tidied(batches):
        yield from run(batches)
        gc.collect()
        pa.default_memory_pool().release_unused()
        with suppress(OSError, AttributeError):
            ctypes.CDLL(None).malloc_trim(0)

    return tidied


def per_text(make: Callable[[], Callable[[Any], tuple]], schema: T.StructType) -> Callable[..., Column]:
    """A struct column computed from one text column, batch by batch.

    ``make`` runs once in each task and gives the function of one text.
    """
    names = schema.names

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        of_text = make()
        for texts in batches:
            yield pd.DataFrame([of_text(t) for t in texts], columns=names)

    run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.DataFrame]}
    return F.pandas_udf(tidy(run), schema)


class Known(dict):
    """Ids of words met lately, each encoded once; at most about LATELY words.

    ``encode`` gives the ids of a list of words, one after the other, and how many
    each has. Words that ``refuse`` says no to have number -1.
    """

    LATELY = 250_000

    def __init__(self, encode, refuse=lambda word: False):
        self.encode, self.refuse = encode, refuse
        self.clear_all()

    def clear_all(self) -> None:
        self.clear()
        self.words: list[str] = []
        self.ids = np.zeros(0, np.int32)
        self.start = self.count = np.zeros(0, np.int64)

    def __missing__(self, word: str) -> int:
        found = -1
        if not self.refuse(word):
            found = len(self.count) + len(self.words)
            self.words.append(word)
        self[word] = found
        return found

    def numbers(self, words: list[str]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.int64, len(words))

    def learn(self) -> None:
        """Encode the words that are new."""
        ids, count = self.encode(self.words)
        self.start = np.concatenate([self.start, len(self.ids) + np.cumsum(count) - count])
        self.count = np.concatenate([self.count, count])
        self.ids = np.concatenate([self.ids, ids.astype(np.int32)])
        self.words = []

    def forget(self) -> None:
        if len(self) > self.LATELY:
            self.clear_all()

    def ids_of(self, row: np.ndarray) -> np.ndarray:
        n = self.count[row]
        return self.ids[np.repeat(self.start[row] - np.cumsum(n) + n, n) + np.arange(n.sum())]


def small_batches(spark: SparkSession, most: int = 8 << 20) -> None:
    """Let no more than ``most`` bytes go to a Python worker at a time."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", most)


def with_fields(df: DataFrame, made: Column, names: dict[str, str]) -> DataFrame:
    """Add fields of a struct column as columns; columns of the same name are replaced."""
    hidden = free_name(df, "_made")
    wide = df.withColumn(hidden, made)
    return wide.withColumns({new: F.col(f"{hidden}.{old}") for new, old in names.items()}).drop(hidden)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores before it until no column has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name
