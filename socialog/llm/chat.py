"""Chat formatting with any template, turn spans found by incremental rendering.

A template is a function from a list of (role, text) to one string and is a black
box. Each conversation is rendered turn by turn: the output of a prefix is compared
with that of the prefix before, and what is new from the first difference on is the
piece of the new turn. Where its text lies inside is found by rendering the prefix
twice more with two one-letter texts in place of the last: what both share before the
letter stands before the text, what they share after it behind.

A template rewrites history if a new turn changes output before the end of an earlier
turn's text (say, if it drops an earlier answer's reasoning). Such a turn is marked
``rewrites``; pieces and starts still give the output, but spans of earlier turns no
longer hold and must not be trained on. Output after the last text that gives way (a
prompt for the next answer) is no history.

Prefixes are rendered whole, so a template may look back at any turn; work on a
conversation then grows with the square of its turns. A template that looks back only
so far may say so in an attribute ``reach``: prefixes longer than ``2 * reach`` turns
are rendered from their first turn and the last ``reach`` ones, and work and memory of a
conversation of any length stay bounded by its longest stretch of that many turns. The
standing template looks back at nothing and has one.

Conversations are dealt by id and sorted; a task streams them turn by turn and holds
one window at a time, however long the conversation. That one is rendered by one task
is owed to its digests, which hash it from front to back.

Defined results: a NULL text or role is empty. Turns are ordered by turn (NULL
first), ties by role, then text; repeated rows are turns of their own. Rows without
conv_id form one conversation. A text whose place can't be found (the template's
frame depends on it) has no span and no loss. Columns other than these four are not
read. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from socialog.llm.base import tidy

Template = Callable[[list[tuple[str, str]]], str]

START, END = "<|im_start|>", "<|im_end|>"
CONTROL = re.compile(r"<(\\*)\|")
ESCAPED = re.compile(r"<\\(\\*)\|")
ROLE = str.maketrans({"\\": "\\\\", "\n": "\\n", "|": "\\p"})
ROLE_BACK = {"\\\\": "\\", "\\n": "\n", "\\p": "|"}
TURN = re.compile(rf"{re.escape(START)}([^\n]*)\n(.*?){re.escape(END)}\n", re.DOTALL)
REACH = 32  # last turns that the standing template is rendered with; it needs none
TURNS = (
    "conv_id long, turn long, role string, piece string, start long, "
    "text_start long, text_end long, loss boolean, rewrites boolean"
)
DIGESTS = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
)
PLACES = {"long": pa.int64(), "string": pa.string(), "boolean": pa.bool_()}


def escaped(text: str) -> str:
    """``text`` without control strings: a backslash more after each ``<`` that a ``|`` follows."""
    return CONTROL.sub(r"<\\\1|", text) if "<" in text else text


def unescaped(text: str) -> str:
    return ESCAPED.sub(r"<\1|", text) if "<" in text else text


def marked(turns: list[tuple[str, str]]) -> str:
    """The standing template: marks around each turn, the role on a line of its own."""
    return "".join(f"{START}{role.translate(ROLE)}\n{escaped(text)}{END}\n" for role, text in turns)


marked.reach = REACH


def unmarked(output: str) -> list[tuple[str, str]]:
    """The turns of an output of ``marked``, or of a part between turns."""
    found = []
    at = 0
    for turn in TURN.finditer(output):
        if turn.start() != at:
            break
        role, text = turn.groups()
        found.append((re.sub(r"\\.", lambda m: ROLE_BACK[m.group()], role), unescaped(text)))
        at = turn.end()
    if at != len(output):
        raise ValueError(f"no turn at {at}")
    return found


def agreed(a: str, b: str) -> int:
    """How many characters a and b share at their start."""
    if b.startswith(a):
        return len(a)
    low, high = 0, min(len(a), len(b))
    while low < high:
        mid = (low + high + 1) // 2
        if a[low:mid] == b[low:mid]:
            low = mid
        else:
            high = mid - 1
    return low


class Conversation:
    """Renders the growing prefixes of one conversation."""

    def __init__(self, template: Template, reach: int | None = None):
        self.template = template
        self.reach = getattr(template, "reach", None) if reach is None else reach
        self.turns: list[tuple[str, str]] = []
        self.out = ""
        self.before = 0  # characters of the whole output that self.out doesn't hold
        self.text_ends = 0  # where the last text ends in the whole output

    def add(self, role: str, text: str) -> tuple[str, int, int | None, int | None, bool]:
        """Piece, its start, start and end of the text, whether earlier texts changed."""
        if self.reach and len(self.turns) >= 2 * self.reach:
            self.turns = self.turns[:1] + self.turns[-self.reach :]
            whole = self.before + len(self.out)
            self.out = self.template(self.turns)
            self.before = whole - len(self.out)
        self.turns.append((role, text))
        now = self.template(self.turns)
        same = agreed(self.out, now)
        start = self.before + same
        rewrites = same < len(self.out) and start < self.text_ends
        left, right = self._frame(role, now)
        if left is not None:
            left, right = left + self.before, right + self.before
            self.text_ends = right
        else:
            self.text_ends = self.before + len(now)
        self.out = now
        return now[same:], start, left, right, rewrites

    def _frame(self, role: str, now: str) -> tuple[int | None, int | None]:
        """Where the last text lies in ``now``."""
        one, other = (self.template([*self.turns[:-1], (role, probe)]) for probe in "ab")
        head = agreed(one, other)
        tail = one[head + 1 :]
        fits = one[head : head + 1] == "a" and other == f"{one[:head]}b{tail}"
        if not fits or len(now) < head + len(tail) or not now.startswith(one[:head]) or not now.endswith(tail):
            return None, None
        return head, len(now) - len(tail)


def _schema(ddl: str) -> pa.Schema:
    return pa.schema([(name, PLACES[kind]) for name, kind in (part.split() for part in ddl.split(", "))])


def _rows(batches: Iterable[pa.RecordBatch]) -> Iterator[list[tuple]]:
    for batch in batches:
        yield list(zip(*(c.to_pylist() for c in batch.columns), strict=True))


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[]] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def rendered(
    turns: DataFrame, template: Template = marked, learned: str = "assistant", reach: int | None = None
) -> DataFrame:
    """One row a turn, those of a conversation in order and in one task.

    The output of a conversation is made of the pieces: each replaces what stands from
    its ``start`` (code points) on. ``text_start`` and ``text_end`` bound the turn's text in
    the output; ``loss`` says whether that span is under the loss mask, which are the
    texts of role ``learned``. ``reach`` says how many turns the template looks back at
    most, in place of its own attribute; without either, prefixes are rendered whole.
    """
    schema = _schema(TURNS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, conversation = object(), None
        for rows in _rows(batches):
            out = []
            for conv_id, turn, role, text in rows:
                if conversation is None or conv_id != now:
                    now, conversation = conv_id, Conversation(template, reach)
                role = role or ""
                piece, start, left, right, rewrites = conversation.add(role, text or "")
                loss = role == learned and left is not None
                out.append((conv_id, turn, role, piece, start, left, right, loss, rewrites))
            yield _batch(out, schema)

    read = turns.select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.col("role").cast("string"), F.col("text").cast("string")
    )
    in_order = read.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return in_order.mapInArrow(tidy(run), TURNS)


class _Digest:
    def __init__(self, conv_id):
        self.conv_id, self.n, self.loss, self.chars = conv_id, 0, 0, 0
        self.turns, self.learned = hashlib.sha256(), hashlib.sha256()

    def add(self, piece: str, start: int, left: int, right: int, loss: bool) -> None:
        for role, text in unmarked(piece):
            self.n += 1
            self.turns.update(f"{role}\n{text}\n".encode())
        self.chars = start + len(piece)
        if loss:
            text = unescaped(piece[left - start : right - start])
            self.loss += len(text)
            self.learned.update(text.encode())

    def row(self) -> tuple:
        return self.conv_id, self.n, self.turns.hexdigest(), self.loss, self.learned.hexdigest(), self.chars


def digests(pieces: DataFrame) -> DataFrame:
    """Per conversation, read back from the output of ``rendered`` by the standing template.

    Pieces are parsed and unescaped; the loss mask is read from the spans. Works on
    ``rendered`` as it comes, whose tasks hold conversations whole and in order.
    """
    schema = _schema(DIGESTS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = None
        for rows in _rows(batches):
            out = []
            for conv_id, piece, start, left, right, loss in rows:
                if digest is None or conv_id != digest.conv_id:
                    if digest is not None:
                        out.append(digest.row())
                    digest = _Digest(conv_id)
                digest.add(piece, start, left, right, loss)
            yield _batch(out, schema)
        if digest is not None:
            yield _batch([digest.row()], schema)

    read = pieces.select("conv_id", "piece", "start", "text_start", "text_end", "loss")
    return read.mapInArrow(tidy(run), DIGESTS)
