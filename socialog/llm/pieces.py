"""SentencePiece encoding (byte-fallback BPE) by suffix-array matching.

Texts are cut where no piece reaches across: before a space mark that follows
anything else, and around line breaks. The different words of a batch are
concatenated and suffix-sorted as far as the longest piece is long; each piece is
searched by bisection and has one range of occurrences. The resulting edges are
placed by their end, then relaxed left to right: at each place the longest edge
stands whose piece may follow the piece before it, that is, no earlier merge
crosses their border (both are undone step by step, latest merge first). For a
merge vocabulary exactly one edge can stand at each place, so the path is the
encoding that merging by rank would give. Characters without a piece become the
byte pieces of their UTF-8. Runs of two or more spaces, whose pieces share one
score, are merged directly, once for each run length.

Decoding joins the bytes of the pieces, turns space marks into spaces and drops the
first, which encoding put there.

Defined results: NULL gives NULL, the empty text no ids. A literal space mark
encodes as a space. Invalid byte sequences decode to the replacement character.
Added columns replace input columns of the same name; all others are kept.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from socialog.llm.base import Known, tidy, with_fields

MARK = "▁"
CHUNKS = re.compile(f"{MARK}+(?={MARK}[^{MARK}\n])|{MARK}?[^{MARK}\n]+|{MARK}+|\n")
BLOCK = 1 << 19  # characters that are suffix-sorted at once
MEMORY = 1 << 21  # places of the table of judged borders
NEVER = 1 << 40
HEAD = 4  # characters that fit one number
ENCODED = T.StructType([T.StructField("ids", T.ArrayType(T.IntegerType()))])


def merged(symbols: list[str], rank: dict[str, float]) -> tuple[list[str], tuple[str, str] | None]:
    """Symbols after merging by rank, leftmost first, and the last merge."""
    parts: list[str | None] = list(symbols)
    after = list(range(1, len(parts) + 1))
    before = list(range(-1, len(parts) - 1))
    heap: list[tuple[float, int, str, str]] = []

    def offer(i: int, j: int) -> None:
        if i >= 0 and j < len(parts):
            a, b = parts[i], parts[j]
            if (at := rank.get(a + b)) is not None:
                heapq.heappush(heap, (at, i, a, b))

    for i in range(len(parts) - 1):
        offer(i, i + 1)
    last = None
    while heap:
        _, i, a, b = heapq.heappop(heap)
        j = after[i]
        if parts[i] != a or j >= len(parts) or parts[j] != b:
            continue
        parts[i], parts[j], last = a + b, None, (a, b)
        after[i] = after[j]
        if after[i] < len(parts):
            before[after[i]] = i
        offer(before[i], i)
        offer(i, after[i])
    return [p for p in parts if p is not None], last


def vocabulary(model_file: str) -> dict:
    """Pieces, merge order and bytes of a model, as plain lists and arrays."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=model_file)
    size = model.get_piece_size()
    texts = [model.id_to_piece(i) for i in range(size)]
    plain = [
        i
        for i in range(size)
        if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))
    ]
    rank = {texts[i]: -model.get_score(i) for i in plain}
    order = np.full(size, -1, np.int64)
    for at, i in enumerate(sorted((i for i in plain if len(texts[i]) > 1), key=lambda i: rank[texts[i]])):
        order[i] = at
    number = {texts[i]: i for i in plain}
    left, right = np.full(size, -1, np.int64), np.full(size, -1, np.int64)
    reached = []
    for i in plain:
        text = texts[i]
        if len(text) == 1:
            reached.append(i)
        elif text.strip(MARK):  # runs of marks are merged directly
            parts, last = merged(list(text), rank)
            if len(parts) == 1:
                left[i], right[i] = number[last[0]], number[last[1]]
                reached.append(i)
    pairs, results = [], []
    for i in reached:
        for cut in range(1, len(texts[i])):
            a, b = number.get(texts[i][:cut]), number.get(texts[i][cut:])
            if a is not None and b is not None:
                pairs.append(a * size + b)
                results.append(order[i])
    sort = np.argsort(pairs)
    byte = {texts[i]: i for i in range(size) if model.is_byte(i)}
    raw = [
        bytes([int(t[3:5], 16)]) if t in byte else b"" if model.is_control(i) else t.replace(MARK, " ").encode()
        for i, t in enumerate(texts)
    ]
    return {
        "size": size,
        "texts": texts,
        "rank": {t: r for t, r in rank.items() if not t.strip(MARK)},
        "number": {t: i for t, i in number.items() if not t.strip(MARK)},
        "reached": reached,
        "order": order,
        "left": left,
        "right": right,
        "pairs": np.array(pairs, np.int64)[sort],
        "results": np.array(results, np.int64)[sort],
        "byte": np.array([byte[f"<0x{b:02X}>"] for b in range(256)]),
        "raw": raw,
    }


def _packed(columns: Sequence[np.ndarray]) -> np.ndarray:
    """Rows of codes below 2 ** 16, given by column, as one number each."""
    out = np.zeros(len(columns[0]), np.uint64)
    for column in columns:
        out = out << np.uint64(16) | column.astype(np.uint64)
    return out


class Encoder:
    def __init__(self, vocabulary: dict):
        self.__dict__.update(vocabulary)
        self.letter = {self.texts[i]: i for i in self.reached if len(self.texts[i]) == 1}
        longest = max(len(self.texts[i]) for i in self.reached)
        self.longest = 1 << (longest - 1).bit_length()
        # Codes of characters: 0 between words, 1 unknown, then the known letters.
        self.code = {c: n for n, c in enumerate(self.letter, 2)}
        self.spelled = np.zeros((len(self.reached), self.longest), np.int64)
        for row, i in zip(self.spelled, self.reached, strict=True):
            row[: len(self.texts[i])] = [self.code[c] for c in self.texts[i]]
        self.lengths = (self.spelled > 0).sum(axis=1)
        self.kind = np.int16 if self.size < 1 << 15 else np.int32
        self.asked = np.full(MEMORY, -1, np.int64)
        self.answer = np.zeros(MEMORY, bool)
        self.runs: dict[int, list[int]] = {}
        self.known = Known(self.encoded_words, lambda word: word.endswith(MARK))  # marks alone

    # Borders

    def merge(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Order of the merge of two pieces, NEVER if there is none."""
        wanted = a * self.size + b
        at = np.minimum(np.searchsorted(self.pairs, wanted), len(self.pairs) - 1)
        return np.where(self.pairs[at] == wanted, self.results[at], NEVER)

    def judged(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether no merge crosses the border of two neighbouring pieces."""
        good = np.ones(len(a), bool)
        live = np.arange(len(a))
        until_a, until_b = np.full(len(a), NEVER), np.full(len(a), NEVER)
        a, b = a.copy(), b.copy()
        while len(live):
            crossing = self.merge(a, b)
            bad = (crossing < until_a) & (crossing <= until_b)
            good[live[bad]] = False
            order_a, order_b = self.order[a], self.order[b]
            on = ~bad & ((order_a >= 0) | (order_b >= 0))
            undo_a = order_a > order_b
            until_a = np.where(undo_a, order_a, until_a)
            until_b = np.where(undo_a, until_b, order_b)
            a = np.where(undo_a, self.right[a], a)
            b = np.where(undo_a, b, self.left[b])
            live, a, b, until_a, until_b = live[on], a[on], b[on], until_a[on], until_b[on]
        return good

    def stands(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """As ``judged``, remembering answers."""
        pair = a * self.size + b
        place = (pair * 0x9E3779B1 >> 7) & (MEMORY - 1)
        missing = self.asked[place] != pair
        if missing.any():
            new, back = np.unique(pair[missing], return_inverse=True)
            found = self.judged(new // self.size, new % self.size)[back]
            self.asked[place[missing]], self.answer[place[missing]] = pair[missing], found
            out = self.answer[place]
            out[missing] = found  # two pairs may share a place
            # A pair asked together with one that took its place is judged anew.
            lost = self.asked[place] != pair
            lost &= ~missing
            if lost.any():
                out[lost] = self.judged(a[lost], b[lost])
            return out
        return self.answer[place]

    # Matching

    def suffixes(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places in the order of their next ``longest`` characters, and the first of these of every place, packed."""
        width = min(HEAD, self.longest)
        wide = np.concatenate([codes, np.zeros(width, np.int64)])
        key = heads = _packed([wide[i : i + len(codes)] for i in range(width)])
        while width < self.longest:
            kinds, ranks = np.unique(key, return_inverse=True)
            key = ranks * len(kinds)
            key[:-width] += ranks[width:]
            width *= 2
        return np.argsort(key), heads

    def ranges(self, codes: np.ndarray, order: np.ndarray, heads: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and end place in ``order`` of the occurrences of each piece; ``heads`` are in that order."""
        ahead = np.arange(self.longest)
        # The first characters, packed in one number, narrow the search.
        least = self.spelled[:, :HEAD]
        most = np.where(ahead[:HEAD] < self.lengths[:, None], least, (1 << 16) - 1)
        start = np.searchsorted(heads, _packed(least.T), "left")
        end = np.searchsorted(heads, _packed(most.T), "right")
        found = []
        for upper in (False, True):
            low, high = start.copy(), end.copy()
            short = self.lengths <= HEAD
            low[short] = high[short] = (end if upper else start)[short]
            while (open_ := np.flatnonzero(low < high)).size:
                mid = (low[open_] + high[open_]) // 2
                there = codes[order[mid][:, None] + ahead]
                piece = self.spelled[open_]
                inside = ahead < self.lengths[open_][:, None]
                differ = inside & (there != piece)
                first = np.argmax(differ, axis=1)
                row = np.arange(len(open_))
                less = there[row, first] < piece[row, first]
                same = ~differ.any(axis=1)
                right = np.where(same, upper, less)
                low[open_] = np.where(right, mid + 1, low[open_])
                high[open_] = np.where(right, high[open_], mid)
            found.append(low)
        return found[0], found[1]

    def encoded_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words, one after the other, and how many each has."""
        flat, counts = [], []
        at = 0
        while at < len(words):
            size, end = 0, at
            while end < len(words) and (end == at or size + len(words[end]) < BLOCK):
                size += len(words[end]) + 1
                end += 1
            ids, n = self._block(words[at:end])
            flat.append(ids)
            counts.append(n)
            at = end
        number = np.concatenate(counts) if counts else np.zeros(0, np.int64)
        ids = np.concatenate(flat) if flat else np.zeros(0, np.int32)
        return ids, number

    def _block(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        text = "\0".join(words) + "\0"
        points = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)
        size = np.fromiter(map(len, words), np.int64, len(words))
        start = np.cumsum(size + 1) - size - 1
        kinds, back = np.unique(points, return_inverse=True)
        codes = np.array([self.code.get(chr(p), 1) for p in kinds.tolist()], np.int64)[back]
        codes[start + size] = 0
        order, heads = self.suffixes(codes)
        first, end = self.ranges(np.concatenate([codes, np.zeros(self.longest, np.int64)]), order, heads[order])
        # Edges, placed by length and end.
        edges = np.full((self.longest + 1, len(codes) + 1), -1, self.kind)
        number = end - first
        pick = np.repeat(first - np.cumsum(number) + number, number) + np.arange(number.sum())
        length = np.repeat(self.lengths, number)
        edges[length, order[pick] + length] = np.repeat(np.array(self.reached, self.kind), number)
        unknown = np.flatnonzero(codes == 1)
        edges[1, unknown + 1] = -2

        # Relaxation: place k of every word at once, longest words first.
        last = np.full(len(codes) + 1, -1, np.int64)  # piece that ends here; -2: bytes
        back_by = np.zeros(len(codes) + 1, np.int64)
        by_size = np.argsort(-size, kind="stable")
        for k in range(1, int(size.max(initial=0)) + 1):
            by_size = by_size[size[by_size] >= k]
            here = start[by_size] + k
            for n in range(min(k, self.longest), 0, -1):
                piece = edges[n, here].astype(np.int64)
                some = np.flatnonzero(piece != -1)
                if not len(some):
                    continue
                at, piece = here[some], piece[some]
                previous = last[at - n]
                fine = np.ones(len(some), bool)
                check = np.flatnonzero((piece >= 0) & (previous >= 0) & (k > n))
                fine[check] = self.stands(previous[check], piece[check])
                last[at[fine]], back_by[at[fine]] = piece[fine], n
                stay = np.ones(len(here), bool)
                stay[some[fine]] = False
                here = here[stay]
                if not len(here):
                    break

        # Paths, walked back from the ends of all words at once.
        steps, owners = [], []
        at, own = start + size, np.arange(len(words))
        at, own = at[size > 0], own[size > 0]
        while len(at):
            steps.append(at)
            owners.append(own)
            at = at - back_by[at]
            more = at > start[own]
            at, own = at[more], own[more]
        at = np.concatenate(steps) if steps else np.zeros(0, np.int64)
        own = np.concatenate(owners) if owners else np.zeros(0, np.int64)
        sort = np.argsort(at, kind="stable")  # words follow each other, so place sorts all
        at, own = at[sort], own[sort]
        ids = last[at]
        count = np.bincount(own, minlength=len(words))
        lost = np.flatnonzero(ids == -2)
        if len(lost):
            spelled = [self.byte[list(chr(p).encode("utf-8", "replace"))] for p in points[at[lost] - 1].tolist()]
            many = np.ones(len(ids), np.int64)
            many[lost] = [len(s) for s in spelled]
            count = np.bincount(own, weights=many, minlength=len(words)).astype(np.int64)
            wide = np.repeat(ids, many)
            wide[wide == -2] = np.concatenate(spelled)
            ids = wide
        return ids.astype(np.int32), count

    # Texts

    def run(self, n: int) -> list[int]:
        """Ids of ``n`` space marks in a row."""
        if n not in self.runs:
            self.runs[n] = [self.number[p] for p in merged([MARK] * n, self.rank)[0]]
        return self.runs[n]

    def __call__(self, texts: list[str | None]) -> list[np.ndarray | None]:
        self.known.forget()
        rows = []
        for text in texts:
            parts = CHUNKS.findall(MARK + text.replace(" ", MARK)) if text else []
            row = self.known.numbers(parts)
            rows.append((row, parts if (row < 0).any() else None))
        self.known.learn()
        out: list[np.ndarray | None] = []
        for text, (row, parts) in zip(texts, rows, strict=True):
            if text is None:
                out.append(None)
            elif parts is not None:
                out.append(self._with_runs(parts, row))
            else:
                out.append(self.known.ids_of(row))
        return out

    def _with_runs(self, parts: list[str], row: np.ndarray) -> np.ndarray:
        """Ids where runs of space marks stand between the words."""
        found: list[int] = []
        before = 0
        for part, number in zip(parts, row.tolist(), strict=True):
            if number < 0:
                before += len(part)
                continue
            own = self.known.ids_of(np.array([number])).tolist()
            if before and own and own[0] == self.letter[MARK]:
                before, own = before + 1, own[1:]
            if before:
                found += self.run(before)
                before = 0
            found += own
        if before:
            found += self.run(before)
        return np.array(found, np.int32)


def decoded(ids, raw: list[bytes]) -> str:
    text = b"".join(map(raw.__getitem__, ids)).decode("utf-8", "replace")
    return text[1:] if text.startswith(" ") else text


def encode(
    docs: DataFrame, model_file: str, text: str = "text", name: str = "ids", back: str | None = None
) -> DataFrame:
    """Add the ids of every text and, if ``back`` names a column, what they decode to."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary(model_file))

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        encoder = Encoder(shared.value)
        for texts in batches:
            rows = encoder([t if isinstance(t, str) else None for t in texts])
            made = {"ids": rows}
            if back:
                made["back"] = [None if r is None else decoded(r.tolist(), encoder.raw) for r in rows]
            yield pd.DataFrame(made, dtype=object)

    run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.DataFrame]}
    kind = T.StructType([ENCODED["ids"], *([T.StructField("back", T.StringType())] if back else [])])
    made = F.pandas_udf(tidy(run), kind)(docs[text].cast("string"))
    return with_fields(docs, made, {name: "ids"} | ({back: "back"} if back else {}))


def decode(docs: DataFrame, model_file: str, ids: str = "ids", name: str = "decoded") -> DataFrame:
    """Add the text of every list of ids."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary(model_file)["raw"])

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        raw = shared.value
        for rows in batches:
            yield pd.Series([None if r is None else decoded(r.tolist(), raw) for r in rows], dtype=object)

    run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return docs.withColumn(name, F.pandas_udf(tidy(run), T.StringType())(docs[ids]))
