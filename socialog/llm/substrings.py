"""Repeated passages by level-wise doubling.

A window is ``window`` consecutive words of one document. Levels are word lengths
that double: for 35 words 9, 18 and 35. Hashes of length 2n are made of two of
length n. At each level below the last, a window is stood for by its smallest hash
of that length; equal windows are stood for alike, so a window whose stand-in is
found once only cannot repeat. Only windows that are left go on to twice the
length. At the last level the windows left are compared themselves, by two
independent 64-bit hashes (the stand-in and the window).

What moves: hashes of stand-ins (about one word in 14), their places back to the
documents, every text once (compressed), texts that still have candidates twice
more, and the window hashes left, in runs with a common stand-in. Runs that are
the same in many documents are merged before they are shuffled. Places of one
document are the only thing ever gathered.

Defined results: words are runs of anything but ASCII blanks; NULL and blank texts
have none. A text shorter than a window keeps its words. Repeated rows are copies
of each other. NULL ids are kept. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from socialog.llm.base import free_name, tidy
from socialog.session import written

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
CACHED = 100_000  # words whose hashes a task keeps at hand
PLACES = T.StructType(
    [T.StructField("h", T.ArrayType(T.LongType())), T.StructField("at", T.ArrayType(T.IntegerType()))]
)
FIRST = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("kept_sha256", T.StringType()),
        *PLACES.fields,
    ]
)
LAST = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("n_removed", T.LongType()),
        T.StructField("kept_sha256", T.StringType()),
        T.StructField("kept", T.StringType()),
    ]
)
RUNS = "stand_in long, id long, mark long, at int, n long, hashes array<long>"


def levels_of(window: int) -> list[int]:
    """Quarter, half and whole window, rounded up."""
    return sorted({-(-window // 4), -(-window // 2), window})


class Hashes(dict):
    """Hash of each word seen lately."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHED:
            self.clear()
        found = self[word] = xxhash.xxh64_intdigest(word, seed=1)
        return found


def joined(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hashes of what two neighbouring (or overlapping) stretches make."""
    x = (a ^ (a >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) + b * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)
    return (x ^ (x >> np.uint64(31))) | np.uint64(1)  # never 0


def doubled(hashes: np.ndarray, length: int, wanted: int) -> np.ndarray:
    """From hashes of ``length`` words to hashes of ``wanted`` words."""
    while length < wanted:
        step = min(length, wanted - length)
        n = max(len(hashes) - step, 0)
        hashes = joined(hashes[:n], hashes[step : step + n])
        length += step
    return hashes


def slid(best, values: np.ndarray, width: int) -> np.ndarray:
    """``best`` (minimum or maximum) over each ``width`` neighbours."""
    done = 1
    while done < width:
        step = min(done, width - done)
        values = best(values[:-step], values[step:])
        done += step
    return values


class Levels:
    """Word hashes of one text at every level."""

    def __init__(self, words: list[bytes], window: int, known: Hashes):
        self.window = window
        self.n = max(len(words) - window + 1, 0)
        self.at: dict[int, np.ndarray] = {}
        if self.n:
            have, length = np.fromiter(map(known.__getitem__, words), np.uint64, len(words)), 1
            for level in levels_of(window):
                have = self.at[level] = doubled(have, length, level)
                length = level

    def stand_in(self, level: int) -> np.ndarray:
        """The hash that stands for each window."""
        return slid(np.minimum, self.at[level], self.window - level + 1)

    def places(self, level: int, left: np.ndarray | None = None) -> np.ndarray:
        """Where the stand-ins of the windows ``left`` are."""
        least = self.stand_in(level)
        if left is not None:
            least = np.where(left, least, np.uint64(0))
        around = self.window - level
        edge = np.zeros(around, np.uint64)
        return np.flatnonzero(
            slid(np.maximum, np.concatenate([edge, least, edge]), around + 1) == self.at[level]
        )

    def left(self, level: int, repeated: np.ndarray) -> np.ndarray:
        """Windows whose stand-in is at one of the places ``repeated``."""
        return np.isin(self.stand_in(level), self.at[level][repeated])


def words_in(text: bytes) -> list[bytes]:
    return text.split()  # bytes split at ASCII blanks only


def packed_text(text: Column) -> Column:
    """Texts as compressed UTF-8, so that fewer bytes move."""

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        press = zstandard.ZstdCompressor(level=3)
        for texts in batches:
            yield pd.Series([press.compress((t or "").encode("utf-8", "replace")) for t in texts])

    run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return F.pandas_udf(tidy(run), T.BinaryType())(text)


def unpacked() -> object:
    opened = zstandard.ZstdDecompressor()
    return lambda blob: opened.decompress(blob) if blob is not None else b""


def _pairs(hashes: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return hashes[at].view(np.int64), at.astype(np.int32)


def _first_places(window: int):
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        known, level = Hashes(), levels_of(window)[0]
        for texts in batches:
            out = []
            for text in texts:
                own = Levels(words_in((text or "").encode("utf-8", "replace")), window, known)
                out.append(_pairs(own.at[level], own.places(level)) if own.n else (None, None))
            yield pd.DataFrame(out, columns=PLACES.names, dtype=object)

    run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.DataFrame]}
    return F.pandas_udf(tidy(run), PLACES)


def _next_places(window: int, level: int, wider: int):
    """Stand-ins at the next level of the windows left at this one; sums for texts without any."""

    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        known, opened = Hashes(), unpacked()
        for blobs, places in batches:
            out = []
            for blob, at in zip(blobs, places, strict=True):
                words = words_in(opened(blob))
                if at is None:
                    out.append((len(words), hashlib.sha256(b" ".join(words)).hexdigest(), None, None))
                    continue
                own = Levels(words, window, known)
                left = own.left(level, np.asarray(at))
                out.append((len(words), None, *_pairs(own.at[wider], own.places(wider, left))))
            yield pd.DataFrame(out, columns=FIRST.names)

    run.__annotations__ = {
        "batches": Iterator[tuple[pd.Series, pd.Series]],
        "return": Iterator[pd.DataFrame],
    }
    return F.pandas_udf(tidy(run), FIRST)


def _runs(window: int, level: int):
    """Hashes of the windows left, in runs with one stand-in; equal runs of a batch are one."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known, opened = Hashes(), unpacked()
        for rows in batches:
            seen: dict[tuple[int, bytes], list[int]] = {}
            for doc, mark, blob, at in zip(
                rows["_id"], rows["_mark"], rows["_blob"], rows["_at"], strict=True
            ):
                own = Levels(words_in(opened(blob)), window, known)
                least, left = own.stand_in(level), own.left(level, np.asarray(at))
                place = np.flatnonzero(left)
                if not len(place):
                    continue
                breaks = (place[1:] != place[:-1] + 1) | (least[place[1:]] != least[place[:-1]])
                edges = [0, *(np.flatnonzero(breaks) + 1), len(place)]
                for a, b in zip(edges, edges[1:], strict=False):
                    start = place[a]
                    key = (int(least[start].view(np.int64)), own.at[window][start : start + b - a].tobytes())
                    seen.setdefault(key, [doc, mark, start, 0])[3] += 1
            yield pd.DataFrame(
                [(s, d, m, p, n, np.frombuffer(h, np.int64)) for (s, h), (d, m, p, n) in seen.items()],
                columns=["stand_in", "id", "mark", "at", "n", "hashes"],
            )

    return run


def _left_of(text: bytes, gone: np.ndarray) -> str:
    """Kept words, each with the blanks that followed it; a whole text as it is."""
    if not gone.any():
        return text.decode("utf-8", "replace")
    starts = [m.start() for m in WORD.finditer(text)]
    ends = [*starts[1:], len(text)]
    kept = [text[a:b] for a, b, g in zip(starts, ends, gone.tolist(), strict=True) if not g]
    return b"".join(kept).rstrip().decode("utf-8", "replace")


def _kept(window: int, level: int, with_text: bool):
    def run(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        known, opened = Hashes(), unpacked()
        for blobs, places, singles in batches:
            out = []
            for blob, at, single in zip(blobs, places, singles, strict=True):
                words = words_in(opened(blob))
                covered = np.zeros(len(words) + 1, np.int64)
                if at is not None:
                    repeats = Levels(words, window, known).left(level, np.asarray(at))
                    if single is not None:
                        repeats[np.asarray(single)] = False
                    starts = np.flatnonzero(repeats)
                    np.add.at(covered, starts, 1)
                    np.add.at(covered, starts + window, -1)
                gone = np.cumsum(covered)[: len(words)] > 0
                kept = b" ".join(w for w, g in zip(words, gone.tolist(), strict=True) if not g)
                text = _left_of(opened(blob), gone) if with_text else None
                out.append((len(words), int(gone.sum()), hashlib.sha256(kept).hexdigest(), text))
            yield pd.DataFrame(out, columns=LAST.names)

    run.__annotations__ = {
        "batches": Iterator[tuple[pd.Series, pd.Series, pd.Series]],
        "return": Iterator[pd.DataFrame],
    }
    return F.pandas_udf(tidy(run), LAST)


def _repeated_places(places: DataFrame) -> DataFrame:
    """Places (as an array per document) of hashes that occur more than once."""
    each = F.explode(F.arrays_zip("h", "at")).alias("p")
    places = written(places.select("_id", "_mark", each).select("_id", "_mark", "p.*"), "stand-ins")
    # Written, so that both sides of the join are plain shuffles and a hot hash can be split.
    repeated = written(places.groupBy("h").count().filter("count > 1").select("h"), "repeated")
    return (
        places.join(repeated, "h", "left_semi")
        .groupBy("_id", "_mark")
        .agg(F.collect_set("at").alias("_at"))
    )


def without_repeats(docs: DataFrame, window: int = 35, text: str = "text", with_text: bool = True) -> DataFrame:
    """Remove every word that a repeated window covers.

    Adds ``n_words``, ``n_removed`` and ``kept_sha256`` (of the kept words joined by
    one space). With ``with_text`` a document that lost words keeps the others with
    the blanks that followed them, other texts stay as they are; without, the text is
    dropped. Input columns named like the added ones are replaced.
    """
    *pruning, last = levels_of(window)
    names = [c for c in docs.columns if c != text]
    rest = free_name(docs, "_rest")
    others = F.struct(*[docs[c] for c in names]) if names else F.lit(None)
    base = docs.select(
        F.coalesce(docs["doc_id"].cast("long"), F.lit(0)).alias("_id"),
        F.xxhash64(docs["doc_id"], docs[text]).alias("_mark"),
        docs[text].cast("string").alias("_text"),
        others.alias(rest),
    )
    if not pruning:
        raise ValueError("a window needs two words at least")

    places = base.select("_id", "_mark", _first_places(window)(F.col("_text")).alias("p"))
    found = _repeated_places(places.select("_id", "_mark", "p.*"))
    rows = base.withColumn("_blob", packed_text(F.col("_text")))
    known_null = F.col("_text").isNull().alias("_null")
    rows = rows.select("_id", "_mark", rest, "_blob", known_null)
    # Every text moves once, to where the places of its stand-ins are.
    rows = rows.join(found, ["_id", "_mark"], "left")
    level = pruning[0]
    for wider in pruning[1:] or [level]:
        rows = rows.withColumn("_now", _next_places(window, level, wider)("_blob", "_at"))
        keep = F.col("_blob") if with_text else F.when(F.col("_at").isNotNull(), F.col("_blob"))
        rows = written(
            rows.select(
                "_id", "_mark", rest, "_null", keep.alias("_blob"), "_now.*",
                F.col("_at").isNotNull().alias("_candidate"),
            ),
            "passages",
        )
        level = wider
    candidates = rows.filter("_candidate")
    left = written(_repeated_places(candidates.select("_id", "_mark", "h", "at")), "places")

    texts = candidates.select("_id", "_mark", "_blob").join(left, ["_id", "_mark"])
    windows = (
        texts.mapInPandas(tidy(_runs(window, level)), RUNS)
        .repartition("stand_in")
        .select("stand_in", "id", "mark", "at", "n", F.posexplode("hashes").alias("i", "h"))
    )
    single = (
        windows.groupBy("stand_in", "h")
        .agg(F.sum("n").alias("n"), *[F.min(c).alias(c) for c in ("id", "mark")], F.min(F.col("at") + F.col("i")).alias("at"))
        .filter("n = 1")
        .groupBy(F.col("id").alias("_id"), F.col("mark").alias("_mark"))
        .agg(F.collect_set("at").alias("_single"))
    )
    done = (
        candidates.join(left, ["_id", "_mark"], "left")
        .join(single, ["_id", "_mark"], "left")
        .withColumn("_end", _kept(window, level, with_text)("_blob", "_at", "_single"))
    )
    untouched = rows.filter("not _candidate")
    added = {"n_words": "long", "n_removed": "long", "kept_sha256": "string"}
    carried = [F.col(f"{rest}.`{c}`").alias(c) for c in names if c.lower() not in added]
    own_text = F.when(~F.col("_null"), _text_of(F.col("_blob"))).alias(text)
    parts = [
        untouched.select(
            *carried,
            *([own_text] if with_text else []),
            "n_words", F.lit(0).cast("long").alias("n_removed"), "kept_sha256",
        ),
        done.select(
            *carried,
            *([F.when(~F.col("_null"), F.col("_end.kept")).alias(text)] if with_text else []),
            *[F.col(f"_end.{c}").alias(c) for c in added],
        ),
    ]
    return reduce(DataFrame.unionByName, parts)


def _text_of(blob: Column) -> Column:
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        opened = unpacked()
        for blobs in batches:
            yield pd.Series([opened(b).decode("utf-8", "replace") for b in blobs], dtype=object)

    run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return F.pandas_udf(tidy(run), T.StringType())(blob)
