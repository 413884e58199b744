"""SimHash near-duplicates by Golay codes.

A fingerprint has 64 bits, each the majority of that bit over the hashes of the
text's shingles. Two fingerprints link at ``MOST`` (3) or fewer differing bits.

The 64 bits are cut into segments of 22, 21 and 21 bits. Of three errors, either
two segments have none and one error (in some order), or each of the three has
one. Each segment is a word of the perfect binary Golay code of length 23 (filled
up with zeros), which decodes every word to the one code word within 3 bits. Words
one bit apart share a code word once the decodings of all one-bit changes are
taken: at most 6 for a word. So linked fingerprints share a key of one of two
kinds: one segment as it is with a code word of another, or a code word of each of
the three. In every key one of the two is there with its own code words: a group
without such a row is left alone.

Keys are shuffled and sorted; each group of a key is searched breadth first over
the fingerprints not yet reached, and leaves a spanning forest of its links, not
all pairs. Links are verified on the full 64 bits. Equal fingerprints are one from
the start, so copies cost nothing.

Defined results: a NULL or blank text has fingerprint 0. A text with fewer words
than a shingle is hashed whole. Repeated rows and ids are kept; NULL ids take part
and are never the smallest id of a group unless all of its ids are NULL. An empty
table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from socialog.llm.base import tidy
from socialog.llm.components import components
from socialog.session import written

MOST = 3
SEED = 42
BLOCK = 1 << 16  # shingles counted at a time
SEGMENTS = ((42, 22), (21, 21), (0, 21))  # shift and bits
GENERATOR = 0b101011100011  # x^11 + x^9 + x^7 + x^6 + x^5 + x + 1, of the Golay code
SHARED = 6  # code words at most that a word and its one-bit changes decode to
SMALL = 24  # group size up to which all pairs are compared at once


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """64-bit fingerprint of a whole text."""
    words = (text or "").encode("utf-8", "replace").lower().split()  # bytes: A-Z only, ASCII blanks only
    if not words:
        return 0
    n = max(len(words) - shingle + 1, 1)
    ones = np.zeros(64, np.int64)
    for start in range(0, n, BLOCK):
        some = words[start : min(start + BLOCK, n) + shingle - 1]
        count = max(len(some) - shingle + 1, 1)
        grams = zip(*(some[i:] for i in range(shingle)), strict=False) if len(some) >= shingle else [some]
        ones += set_bits(np.fromiter((xxhash.xxh64_intdigest(b" ".join(g), SEED) for g in grams), "<u8", count))
    return majority(ones, n)


def set_bits(hashes: np.ndarray) -> np.ndarray:
    """In how many of ``hashes`` each of the 64 bits is set."""
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return bits.sum(axis=0, dtype=np.int64)


def majority(ones: np.ndarray, n: int) -> int:
    """The fingerprint of ``n`` hashes by how often each bit is set."""
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def with_fingerprint(docs: DataFrame, name: str, text: str = "text", shingle: int = 3) -> DataFrame:
    """Add the fingerprint as a signed long."""

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            found = np.fromiter((fingerprint(t, shingle) for t in texts), np.uint64, len(texts))
            yield pd.Series(found.astype(np.int64))

    run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return docs.withColumn(name, F.pandas_udf(tidy(run), T.LongType())(docs[text].cast("string")))


def decoder() -> np.ndarray:
    """Number of the code word within 3 bits of each 23-bit word."""
    words = np.zeros(1 << 12, np.uint32)
    for bit in range(12):
        words ^= np.where(np.arange(1 << 12) >> bit & 1, GENERATOR << bit, 0).astype(np.uint32)
    found = np.zeros(1 << 23, np.uint16)
    one = np.uint32(1) << np.arange(23, dtype=np.uint32)
    errors = [np.uint32(0), *one]
    errors += [one[i] | one[j] for i in range(23) for j in range(i)]
    errors += [one[i] | one[j] | one[k] for i in range(23) for j in range(i) for k in range(j)]
    number = np.arange(1 << 12, dtype=np.uint16)
    for error in errors:
        found[words ^ error] = number
    return found


def code_words(segment: np.ndarray, bits: int, decode: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code words of each segment and its one-bit changes, own one first: (n, 6), and which are real."""
    changes = np.array([0, *(1 << b for b in range(bits))], np.uint32)
    own = decode[segment[:, None] ^ changes].astype(np.int32)
    rest = np.sort(own[:, 1:], axis=1)
    fresh = np.ones(rest.shape, bool)
    fresh[:, 1:] = rest[:, 1:] != rest[:, :-1]
    fresh &= rest != own[:, :1]
    order = np.argsort(~fresh, axis=1, kind="stable")[:, : SHARED - 1]
    codes = np.concatenate([own[:, :1], np.take_along_axis(rest, order, 1)], axis=1)
    real = np.concatenate([np.ones((len(own), 1), bool), np.take_along_axis(fresh, order, 1)], axis=1)
    return codes.astype(np.int64), real


def keys_of(prints: np.ndarray, decode: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(key, fingerprint, whether the key is of the fingerprint's own code words)."""
    parts = [((prints >> np.uint64(s)) & np.uint64((1 << b) - 1)).astype(np.uint32) for s, b in SEGMENTS]
    codes = [code_words(p, b, decode) for p, (_, b) in zip(parts, SEGMENTS, strict=True)]
    keys, owners, own = [], [], []

    def add(key: np.ndarray, real: np.ndarray) -> None:
        at, which = np.nonzero(real)
        keys.append(key[at, which])
        owners.append(prints[at])
        own.append(which == 0)

    kind = 1
    for i in range(3):
        for j in range(3):
            if i != j:
                whole = parts[i].astype(np.int64)[:, None]
                add(kind << 40 | whole << 12 | codes[j][0], codes[j][1])
                kind += 1
    (a, ra), (b, rb), (c, rc) = codes
    triple = a[:, :, None, None] << 24 | b[:, None, :, None] << 12 | c[:, None, None, :]
    real = ra[:, :, None, None] & rb[:, None, :, None] & rc[:, None, None, :]
    add(triple.reshape(len(prints), -1), real.reshape(len(prints), -1))
    return np.concatenate(keys), np.concatenate(owners), np.concatenate(own)


def _keyed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    decode = decoder()
    for rows in batches:
        prints = rows["print"].to_numpy(np.int64).view(np.uint64)
        for at in range(0, len(prints), 2000):
            key, owner, own = keys_of(prints[at : at + 2000], decode)
            yield pd.DataFrame({"key": key * 2 + own, "print": owner.view(np.int64)})


def near(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b) <= MOST


def searched(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links within one group, breadth first."""
    left, froms, tos = np.unique(prints), [], []
    while len(left) > 1:
        wave, left = [left[0]], left[1:]
        while wave and len(left):
            at = wave.pop()
            hit = near(left, at)
            if hit.any():
                found = left[hit]
                froms.append(np.full(len(found), at))
                tos.append(found)
                wave.extend(found)
                left = left[~hit]
    none = np.array([], np.uint64)
    return np.concatenate([none, *froms]), np.concatenate([none, *tos])


def links_in(key: np.ndarray, prints: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links within the groups of equal, sorted keys."""
    starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    sizes = np.diff(np.append(starts, len(key)))
    useful = (sizes > 1) & np.logical_or.reduceat(own, starts)
    froms, tos = [], []
    for size in np.unique(sizes[useful]):
        these = starts[useful & (sizes == size)]
        if size > SMALL:
            for s in these:
                a, b = searched(prints[s : s + size])
                froms.append(a)
                tos.append(b)
            continue
        left, right = np.triu_indices(size, 1)
        a, b = prints[these[:, None] + left], prints[these[:, None] + right]
        hit = near(a, b) & (a != b)
        froms.append(a[hit])
        tos.append(b[hit])
    none = np.array([], np.uint64)
    return np.concatenate([none, *froms]), np.concatenate([none, *tos])


def _forest() -> object:
    """Keeps the links that join what was apart so far in this task."""
    root: dict[int, int] = {}

    def top(x: int) -> int:
        while (up := root.get(x, x)) != x:
            root[x] = root.get(up, up)
            x = up
        return x

    def joining(a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
        out = []
        for x, y in set(zip(a.tolist(), b.tolist(), strict=True)):
            p, q = top(x), top(y)
            if p != q:
                root[max(p, q)] = min(p, q)
                out.append((x, y))
        return out

    return joining


def _linked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Links of sorted keys; the last group of a batch waits for its end."""
    joining = _forest()
    waiting = (np.array([], np.int64), np.array([], np.uint64))

    def found(marked: np.ndarray, prints: np.ndarray) -> pd.DataFrame:
        a, b = links_in(marked >> 1, prints, (marked & 1).astype(bool))
        pairs = np.array(joining(a, b), np.uint64).reshape(-1, 2).view(np.int64)
        return pd.DataFrame({"a": pairs[:, 0], "b": pairs[:, 1]})

    for rows in batches:
        marked = np.concatenate([waiting[0], rows["key"].to_numpy(np.int64)])
        prints = np.concatenate([waiting[1], rows["print"].to_numpy(np.int64).view(np.uint64)])
        if not len(marked):
            continue
        end = int(np.searchsorted(marked >> 1, marked[-1] >> 1))
        waiting = (marked[end:], prints[end:])
        if end:
            yield found(marked[:end], prints[:end])
    if len(waiting[0]):
        yield found(*waiting)


def links(prints: DataFrame) -> DataFrame:
    """Links (a, b) that connect all distinct fingerprints of column ``print`` that belong together."""
    return (
        prints.select("print")
        .distinct()
        .mapInPandas(tidy(_keyed), "key long, print long")
        .repartition(F.shiftright("key", 1))
        .sortWithinPartitions("key")
        .mapInPandas(tidy(_linked), "a long, b long")
    )


def roots_of(prints: DataFrame) -> DataFrame:
    """(print, root): the least fingerprint reachable from each."""
    roots = components(links(prints)).select(F.col("node").alias("print"), "root")
    return (
        prints.select("print")
        .distinct()
        .join(roots, "print", "left")
        .withColumn("root", F.coalesce("root", "print"))
    )


def grouped(docs: DataFrame, shingle: int = 3, text: str = "text") -> DataFrame:
    """doc_id, fingerprint (hex) and component_id (smallest id reachable) of every row."""
    prints = written(
        with_fingerprint(docs.select("doc_id", text), "print", text, shingle).select("doc_id", "print"),
        "fingerprints",
    )
    least = prints.groupBy("print").agg(F.min("doc_id").alias("least"))
    placed = least.join(roots_of(prints), "print")
    ids = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    of_print = placed.join(ids, "root").select("print", "component_id")
    return prints.join(of_print, "print").select(
        "doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id"
    )


def placed(docs: DataFrame, text: str = "text") -> list[Column]:
    """_id, NULLs behind all others, and _mark: what tells rows apart."""
    return [
        F.coalesce(docs["doc_id"].cast("long"), F.lit((1 << 63) - 1)).alias("_id"),
        F.xxhash64(docs["doc_id"], docs[text]).alias("_mark"),
    ]


def first_of_each(docs: DataFrame, rooted: DataFrame, text: str = "text") -> DataFrame:
    """The first row of each root of ``rooted`` (_id, _mark, root), all columns as they are."""
    first = Window.partitionBy("root").orderBy("_id", "_mark")
    chosen = rooted.withColumn("_at", F.row_number().over(first)).filter("_at = 1").select("_id", "_mark")
    hold = F.struct(*[docs[c] for c in docs.columns]).alias("_row")
    kept = docs.select(*placed(docs, text), hold).join(chosen, ["_id", "_mark"], "left_semi")
    return (
        kept.groupBy("_id", "_mark")
        .agg(F.first("_row").alias("_row"))
        .select(*[F.col(f"_row.`{c}`").alias(c) for c in docs.columns])
    )


def one_of_each(docs: DataFrame, shingle: int = 3, text: str = "text") -> DataFrame:
    """The row with the smallest id (then text hash) of each group, all columns as they are.

    Rows with equal id and text are one. NULL ids stand behind all others.
    """
    texts = docs.select(*placed(docs, text), docs[text].alias("_text"))
    prints = written(
        with_fingerprint(texts, "print", "_text", shingle).select("_id", "_mark", "print"), "fingerprints"
    )
    rooted = prints.join(roots_of(prints), "print").select("_id", "_mark", "root")
    return first_of_each(docs, rooted, text)
