"""Best-fit packing of token sequences, planned on lengths.

Texts are tokenised once, words that keep coming once for many texts; each
piece leaves its length and a check sum. The plan
sees nothing but how many pieces there are of each length: best fit, longest
first, runs over these counts (at most one count for each length up to the
capacity) and says how many sequences hold which lengths. Each piece then takes
the slot that has its rank among the pieces of its length.

Ranks need no window over a whole length: a length is cut by hash into groups of
about ``group_rows`` pieces, ranked each on its own and shifted by the groups
before it.

Defined results: a NULL text is empty and packs as its end mark alone. Repeated
rows are packed each. NULL ids are kept. An empty table gives no rows. Columns
other than id and text are not read.
"""

from __future__ import annotations

import bisect
import os
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from socialog.llm.base import Known, tidy
from socialog.session import written

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
TOGETHER = 512  # words a tokenizer call takes
VISIBLE = frozenset(c for c in map(chr, range(0x21, 0x1680)) if c.isprintable() and not c.isspace())
TEXTS = 1000  # texts whose ids are held at a time
LATELY = 600_000  # words, about, whose ids a task remembers


def _glued(parts: list[str], row: list[int]) -> list[str]:
    """Parts that can't stand alone go to the one before, with their space."""
    out = parts[:1]
    for part, number in zip(parts[1:], row, strict=True):
        if number < 0:
            out[-1] += f" {part}"
        else:
            out.append(part)
    return out


def encoder(tokenizer):
    """Ids of each of some texts; words that are alike are encoded once.

    Byte-level pre-tokenisation starts a new word at a space before a visible
    character, whatever stands before it. So words cut there are encoded many at a
    time, one after the other, and told apart by their bytes.
    """
    width = np.zeros(tokenizer.get_vocab_size(), np.int64)
    for token, i in tokenizer.get_vocab().items():
        width[i] = len(token)  # byte-level: a character for each byte

    def spelled(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        flat, counts = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for at in range(0, len(words), TOGETHER):
            some = words[at : at + TOGETHER]
            (found,) = tokenizer.encode_batch_fast([" " + " ".join(some)], add_special_tokens=False)
            ids = np.array(found.ids, np.int64)
            sizes = np.fromiter((len(w.encode()) + 1 for w in some), np.int64, len(some))
            ends = np.searchsorted(np.cumsum(width[ids]), np.cumsum(sizes), side="right")
            flat.append(ids)
            counts.append(np.diff(ends, prepend=0))
        return np.concatenate(flat), np.concatenate(counts)

    known = Known(spelled, lambda word: word[:1] not in VISIBLE)
    known.LATELY = LATELY

    def encoded(texts: list[str]) -> Iterator[np.ndarray]:
        known.forget()
        firsts, rows = [], []
        for text in texts:
            parts = text.split(" ")
            row = known.numbers(parts[1:])
            if (row < 0).any():
                parts = _glued(parts, row.tolist())
                row = known.numbers(parts[1:])
            firsts.append(parts[0])
            rows.append(row)
        known.learn()
        heads = tokenizer.encode_batch_fast(firsts, add_special_tokens=False)
        for head, row in zip(heads, rows, strict=True):
            yield np.concatenate([np.array(head.ids, "<u4"), known.ids_of(row).astype("<u4")])

    return encoded


def _tokenised(path: str, capacity: int, end: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        ids_of = encoder(tokenizer)
        for rows in batches:
            out = []
            for at in range(0, len(rows), TEXTS):
                some = rows.iloc[at : at + TEXTS]
                found = ids_of([t or "" for t in some["text"]])
                for doc_id, ids in zip(some["doc_id"], found, strict=True):
                    ids = np.append(ids, np.array([end], "<u4"))
                    n = len(ids)
                    first = (n - 1) % capacity + 1  # a shorter piece comes first
                    edges = [0, *range(first, n + 1, capacity)]
                    for piece, (a, b) in enumerate(zip(edges, edges[1:], strict=False)):
                        out.append((doc_id, piece, a, b - a, zlib.crc32(ids[a:b].tobytes())))
            frame = pd.DataFrame(out, columns=["doc_id", "piece", "start", "length", "ids_crc32"])
            frame["doc_id"] = frame["doc_id"].astype("Int64")
            yield frame

    return run


def pieces(docs: DataFrame, tokenizer: str, capacity: int = 2048, end: int = 0) -> DataFrame:
    """Pieces of at most ``capacity`` tokens of every document, end mark included."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInPandas(tidy(_tokenised(tokenizer, capacity, end)), PIECES)


def plan(counts: dict[int, int], capacity: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """Kinds of sequences: how many there are, and the (length, times) each holds.

    Best fit, longest first: a piece goes to the fullest sequence it fits in. As
    sequences with equal content are alike, whole counts are placed at once.
    """
    room: list[int] = []  # of the open kinds, ascending
    kinds: dict[int, list[tuple[int, tuple]]] = {}

    def put(left: int, n: int, holds: tuple) -> None:
        if n:
            if left not in kinds:
                bisect.insort(room, left)
            kinds.setdefault(left, []).append((n, holds))

    for length in sorted(counts, reverse=True):
        c = counts[length]
        while c:
            at = bisect.bisect_left(room, length)
            if at == len(room):
                left, n, holds = capacity, c, ()
            else:
                left = room[at]
                n, holds = kinds[left].pop()
                if not kinds[left]:
                    del kinds[left], room[at]
            each = left // length
            full, rest = min(n, c // each), 0
            put(left - each * length, full, (*holds, (length, each)))
            c -= full * each
            if 0 < c < each and n > full:
                rest = 1
                put(left - c * length, 1, (*holds, (length, c)))
                c = 0
            if left < capacity or holds:
                put(left, n - full - rest, holds)
    return [(n, list(holds)) for own in kinds.values() for n, holds in own]


def slots(kinds: list[tuple[int, list[tuple[int, int]]]]) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first rank, end rank, first sequence, times in each, offset)."""
    taken: dict[int, int] = {}
    out, sequence = [], 0
    for n, holds in kinds:
        offset = 0
        for length, times in holds:
            first = taken.get(length, 0)
            taken[length] = first + n * times
            out.append((length, first, first + n * times, sequence, times, offset))
            offset += length * times
        sequence += n
    return out


def pack(parts: DataFrame, capacity: int = 2048, group_rows: int = 1000) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to pieces (doc_id, piece, start, length, ids_crc32)."""
    spark = parts.sparkSession
    stored = written(parts, "pieces")
    # At most one row for each length up to the capacity.
    counts = {r["length"]: r["count"] for r in stored.groupBy("length").count().collect()}
    cuts = spark.createDataFrame(
        [(length, -(-n // group_rows)) for length, n in counts.items()], "length long, _groups long"
    )
    planned = spark.createDataFrame(
        slots(plan(counts, capacity)),
        "length long, _first long, _end long, _sequence long, _times long, _offset long",
    )
    row = ["doc_id", "piece", "start", "ids_crc32"]
    grouped = stored.join(F.broadcast(cuts), "length").withColumn(
        "_group", F.pmod(F.xxhash64(*row), F.col("_groups"))
    )
    own = Window.partitionBy("length", "_group")
    before = Window.partitionBy("length").orderBy("_group").rowsBetween(Window.unboundedPreceding, -1)
    shifts = (
        grouped.groupBy("length", "_group")
        .count()
        .select("length", "_group", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_shift"))
    )
    ranked = (
        grouped.withColumn("_rank", F.row_number().over(own.orderBy(*row)) - 1)
        .join(shifts, ["length", "_group"])
        .withColumn("_rank", F.col("_rank") + F.col("_shift"))
        .drop("_groups", "_group", "_shift")
    )
    # A few slot ranges for each length: thousands of rows, whatever the input.
    at = F.col("_rank") - F.col("_first")
    return (
        ranked.join(F.broadcast(planned), "length")
        .filter((F.col("_rank") >= F.col("_first")) & (F.col("_rank") < F.col("_end")))
        .select(
            "doc_id",
            "piece",
            "start",
            "length",
            "ids_crc32",
            (F.col("_sequence") + F.floor(at / F.col("_times"))).cast("long").alias("sequence_id"),
            (F.col("_offset") + (at % F.col("_times")) * F.col("length")).cast("long").alias("offset"),
        )
    )
