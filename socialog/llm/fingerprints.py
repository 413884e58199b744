"""Document fingerprints that subtract: invertible Bloom lookup sketches.

A text is cut into paragraphs at line breaks, and a paragraph further at words
whose hash says so (one in ``EVERY`` on average), so that parts of a long
paragraph stay comparable. Each part has a 64-bit digest of its words and of how
often the same part came before it, so digests of a text are distinct. The sketch
of a text has cells of (count, xor of digests, xor of check sums); each digest
goes to one cell in each of ``ROWS`` rows. Subtracting two sketches leaves the digests
that only one of them holds, and peeling cells of count +1 or -1 recovers these.
Where peeling fails, both sketches are built anew with ``GROW`` times the cells,
until it succeeds.

Likeness is 1 - (digests found to differ) / (digests of both), 1 for two texts
without any.

Defined results: NULL text is the empty text; a text of white space alone has no
parts. Equal texts have equal fingerprints. Documents are taken in order of id,
then of the text's hash, NULL ids first; a single document is followed by itself.
Repeated rows follow each other. Columns other than id and text are not read.
"""

from __future__ import annotations

import base64
import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from socialog.llm.base import tidy

ROWS = 3  # cells that a digest goes to
CELLS = 8  # cells of each row in the stored fingerprint
GROW = 8
ENOUGH = 64  # cells for each digest of which one at least surely peels
EVERY = 16  # words between cuts, on average
CHECK_SEED, ROW_SEED = 7, 11
CHECKED = np.uint64(0xFFFFFFFF)
CELL = np.dtype([("count", "<i2"), ("keys", "<u8"), ("checks", "<u4")])

RESULT = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
    "edited_fingerprint string, near_edited double, near_next double, "
    "edited_only array<long>, text_only array<long>"
)


class Cuts(dict):
    """Whether a text is cut after a word; remembers about LATELY words met lately."""

    LATELY = 250_000

    def __missing__(self, word: str) -> bool:
        if len(self) >= self.LATELY:
            self.clear()
        found = self[word] = xxhash.xxh32_intdigest(word.encode("utf-8", "replace")) % EVERY == 0
        return found


def parts(text: str, cuts: Cuts | None = None) -> list[str]:
    """Words of each part, joined by single spaces."""
    cut = (Cuts() if cuts is None else cuts).__getitem__
    found = []
    for paragraph in text.split("\n"):
        words = paragraph.split()
        if not words:
            continue
        start = 0
        for end in [at for at, last in enumerate(map(cut, words), 1) if last]:
            found.append(" ".join(words[start:end]))
            start = end
        if start < len(words):
            found.append(" ".join(words[start:]))
    return found


def digests(text: str, cuts: Cuts | None = None) -> np.ndarray:
    """Distinct 64-bit digests of the parts, repeats numbered."""
    seen: dict[str, int] = {}
    out = []
    for part in parts(text, cuts):
        seed = seen.get(part, 0)
        out.append(xxhash.xxh64_intdigest(part.encode("utf-8", "replace"), seed=seed))
        seen[part] = seed + 1
    return np.array(out, dtype=np.uint64)


def _salt(seed: int) -> np.uint64:
    return np.uint64(seed * 0xD1B54A32D192ED03 & (1 << 64) - 1)


def mixed(keys: np.ndarray, salt: np.ndarray | np.uint64) -> np.ndarray:
    x = keys ^ salt
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


CHECK_SALT, ROW_SALTS = _salt(CHECK_SEED), np.array([[_salt(ROW_SEED + r)] for r in range(ROWS)])


def places(keys: np.ndarray, cells: int) -> np.ndarray:
    """Cell of each key in each row, numbered through."""
    x = mixed(keys, ROW_SALTS)
    # a division only where cells are no power of two
    x = x % np.uint64(cells) if cells & cells - 1 else x & np.uint64(cells - 1)
    return x.astype(np.int64) + np.arange(0, ROWS * cells, cells)[:, None]


class Sketch:
    """Counts, xor of digests and xor of their check sums."""

    def __init__(self, keys: np.ndarray, cells: int):
        self.cells = cells
        self.count = np.zeros(ROWS * cells, np.int64)
        self.keys = np.zeros(ROWS * cells, np.uint64)
        self.checks = np.zeros(ROWS * cells, np.uint64)
        if len(keys):
            checks = mixed(keys, CHECK_SALT) & CHECKED
            at = places(keys, cells)
            self.count += np.bincount(at.ravel(), minlength=ROWS * cells)
            np.bitwise_xor.at(self.keys, at, keys)
            np.bitwise_xor.at(self.checks, at, checks)

    def text(self) -> str:
        """The cells themselves, 14 bytes each, in base64; ``Sketch.read`` takes them back."""
        cells = np.zeros(len(self.count), CELL)
        cells["count"], cells["keys"] = self.count.astype(np.int16), self.keys
        cells["checks"] = self.checks.astype(np.uint32)
        return base64.b64encode(cells.tobytes()).decode()

    @classmethod
    def read(cls, text: str) -> Sketch:
        cells = np.frombuffer(base64.b64decode(text), CELL)
        found = cls(np.array([], np.uint64), len(cells) // ROWS)
        found.count = cells["count"].astype(np.int64)
        found.keys = cells["keys"].astype(np.uint64)
        found.checks = cells["checks"].astype(np.uint64)
        return found

    def minus(self, other: Sketch) -> tuple[list[int], list[int]] | None:
        """Digests held only here, and only there; None if they can't be told."""
        count = (self.count - other.count).astype(np.int16).tolist()
        keys = (self.keys ^ other.keys).tolist()
        checks = (self.checks ^ other.checks).tolist()
        pure = [i for i, c in enumerate(count) if c in (1, -1)]
        here, there = [], []
        while pure:
            # One round peels all cells that hold a single digest.
            now = {}
            for i in pure:
                if count[i] in (1, -1):
                    now.setdefault(keys[i], (i, count[i]))
            if not now:
                break
            found = np.fromiter(now, np.uint64, len(now))
            sums, cells = (mixed(found, CHECK_SALT) & CHECKED).tolist(), places(found, self.cells).T.tolist()
            pure = []
            for (key, (i, sign)), check, own in zip(now.items(), sums, cells, strict=True):
                if count[i] != sign or keys[i] != key or checks[i] != check:
                    continue
                (here if sign == 1 else there).append(key)
                for j in own:
                    count[j] -= sign
                    keys[j] ^= key
                    checks[j] ^= check
                    if count[j] in (1, -1):
                        pure.append(j)
        return None if any(count) or any(keys) else (here, there)


class Version:
    """A text with its digests and the sketches built so far."""

    def __init__(self, text: str, cuts: Cuts | None = None):
        self.text = text
        self.keys = digests(text) if cuts is None else digests(text, cuts)
        self.sketches: dict[int, Sketch] = {}

    def sketch(self, cells: int) -> Sketch:
        if cells not in self.sketches:
            self.sketches[cells] = Sketch(self.keys, cells)
        return self.sketches[cells]


def differing(a: Version, b: Version) -> tuple[list[int], list[int]]:
    """Digests of only ``a`` and of only ``b``, from sketches as large as it takes.

    Equal digests of different parts never peel. Should there be some, sketches end at
    ``ENOUGH`` times the digests and the lists are subtracted.
    """
    cells = CELLS
    while cells <= ENOUGH * (len(a.keys) + len(b.keys) + 1):
        found = a.sketch(cells).minus(b.sketch(cells))
        if found is not None:
            return found
        cells *= GROW
    here, there = Counter(a.keys.tolist()), Counter(b.keys.tolist())
    return list((here - there).elements()), list((there - here).elements())


def likeness(a: Version, b: Version, differ: int) -> float:
    total = len(a.keys) + len(b.keys)
    return 1 - differ / total if total else 1.0


def compared(doc_id: int | None, here: Version, after: Version, cuts: Cuts | None = None) -> tuple:
    n = len(here.text)
    edited = Version(here.text[: n - n // 4] + after.text[: n // 4], cuts)
    text_only, edited_only = differing(here, edited)
    signed = lambda keys: np.array(keys, np.uint64).astype(np.int64)
    return (
        doc_id,
        n,
        hashlib.sha256(edited.text.encode("utf-8", "replace")).hexdigest(),
        here.sketch(CELLS).text(),
        edited.sketch(CELLS).text(),
        likeness(here, edited, len(text_only) + len(edited_only)),
        likeness(here, after, sum(map(len, differing(here, after)))),
        signed(edited_only),
        signed(text_only),
    )


def _stream(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows of whole runs, in order; the last row of a run only follows."""
    names = [c.split()[0] for c in RESULT.split(", ")]
    before, cuts = None, Cuts()
    for rows in batches:
        out = []
        for run, doc_id, text in zip(rows["_run"], rows["doc_id"], rows["text"], strict=True):
            here = Version(text, cuts)
            if before is not None and before[0] == run:
                out.append(compared(before[1], before[2], here, cuts))
            before = (run, None if pd.isna(doc_id) else int(doc_id), here)
        frame = pd.DataFrame(out, columns=names)
        frame["doc_id"] = frame["doc_id"].astype("Int64")
        yield frame


def fingerprints(docs: DataFrame, runs: int | None = None) -> DataFrame:
    """Fingerprint every text and its edited version, and compare with the next document.

    The edited version ends in the start of the document that follows in order of
    id. Documents are cut into ``runs`` runs of neighbouring ids of about equal
    size; the first row of a run also goes, as a follower, to the end of the run
    before. One shuffle moves the texts; no task holds more than a row at a time.
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")
    )
    runs = runs or max(int(spark.conf.get("spark.sql.shuffle.partitions")), 2)
    shares = [i / runs for i in range(1, runs)]
    edges = rows.agg(F.percentile_approx("doc_id", shares, 100 * runs)).first()[0] or []
    edges = sorted(set(edges))
    # A row's run: the number of edges up to its id.
    placed = rows.withColumn("_run", _run_of(F.col("doc_id"), edges)).withColumn(
        "_order", F.xxhash64("text")
    )
    # One row for each run, at most.
    heads = (
        placed.groupBy("_run")
        .agg(F.min(F.struct(F.col("doc_id").isNotNull().alias("known"), "doc_id", "_order")).alias("head"))
        .select("_run", "head.doc_id", "head._order")
        .toPandas()
        .sort_values("_run")
    )
    filled = heads["_run"].tolist()
    followers = [
        (int(run), None if pd.isna(doc_id) else int(doc_id), int(order), int(filled[i - 1]))
        for i, (run, doc_id, order) in enumerate(
            zip(heads["_run"], heads["doc_id"].astype("Int64"), heads["_order"], strict=True)
        )
    ]
    target = spark.createDataFrame(followers, "_run int, _id long, _order long, _goes int")
    ends = (
        placed.join(
            F.broadcast(target),
            (placed["_run"] == target["_run"])
            & placed["doc_id"].eqNullSafe(target["_id"])
            & (placed["_order"] == target["_order"]),
        )
        .groupBy(target["_goes"].alias("_run"))
        .agg(F.first(placed["text"]).alias("text"))
        .select("_run", F.lit(None).cast("long").alias("doc_id"), "text", F.lit(0).cast("long").alias("_order"))
        .withColumn("_end", F.lit(True))
    )
    return (
        placed.withColumn("_end", F.lit(False))
        .unionByName(ends)
        .repartition(runs, "_run")
        .sortWithinPartitions("_run", "_end", "doc_id", "_order")
        .select("_run", "doc_id", "text")
        .mapInPandas(tidy(_stream), RESULT)
    )


def _run_of(value, edges: list[int]):
    """Number of ``edges`` that are at most ``value``; 0 for NULL."""
    if not edges:
        return F.lit(0)
    places = F.array(*[F.lit(e) for e in edges])
    # Ids grow with their run, so the count is the place of the first larger edge.
    count = F.size(F.filter(places, lambda e: e <= value))
    return F.when(value.isNull(), 0).otherwise(count).cast("int")
