"""Chat formatting: a finite-state machine over roles and a declarative template.

The machine says which role may follow which and where a conversation may end;
the template says what stands before and after a turn's text and whether the
text is under the loss.  The formatter emits segments in order, each with its
loss flag: only the assistant's own text has it.

Control strings inside texts are broken by a backslash after their first
character, and backslashes are doubled, so a text never holds a control string
and is read back exactly.  Roles outside the template are written with their
name, also under escapes, so that all turns can be read back.

Rows of a conversation are ordered by turn (nulls first), then role and text for
rows that repeat a turn.  They stream through one task in that order: no
conversation is held whole, whatever its length.

Defined cases: null text is empty; a null role is the empty role name; a null
conv_id is a conversation of its own; conversations that break the order are
formatted all the same, with ``valid`` false from the turn that breaks it;
empty tables give empty results; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: role -> (before the text, after it, loss on the text)
TEMPLATE = {
    "system": ("<<SYS>> ", " <</SYS>>\n", False),
    "user": ("[INST] ", " [/INST]", False),
    "assistant": ("<s> ", " </s>\n", True),
}
#: Any other role; its name stands between the first two.
OTHER = ("<<ROLE>> ", " <<TEXT>> ", " <</ROLE>>\n", False)
#: state -> roles that may follow; a conversation may end after END.
NEXT = {"": ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",)}
END = ("assistant",)

CONTROLS = sorted({x.strip() for t in TEMPLATE.values() for x in t[:2]} | {x.strip() for x in OTHER[:3]}, key=len, reverse=True)
_BREAK = re.compile("|".join([r"\\", *(f"{re.escape(c[0])}(?={re.escape(c[1:])})" for c in CONTROLS)]))
_JOIN = re.compile(r"\\(\\?)")


def escaped(text: str) -> str:
    return _BREAK.sub(lambda m: "\\\\" if m[0] == "\\" else m[0] + "\\", text)


def unescaped(text: str) -> str:
    return _JOIN.sub(lambda m: m[1], text)


def turn_segments(role: str, text: str) -> list[tuple[str, bool]]:
    """(text, loss) of one turn."""
    if role in TEMPLATE:
        before, after, loss = TEMPLATE[role]
        return [(before, False), (escaped(text), loss), (after, False)]
    a, b, after, loss = OTHER
    return [(a, False), (escaped(role), False), (b, False), (escaped(text), loss), (after, False)]


def allowed(state: str | None, role: str) -> str | None:
    """The machine's next state, None once the order is broken."""
    return role if state is not None and role in NEXT.get(state, ()) else None


_SEGMENTS = "conv_id long, segment long, text string, loss boolean, valid boolean"


def _format(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    at, state, k = object(), "", 0
    for b in batches:
        rows = []
        for conv, role, text in zip(*(b.column(c).to_pylist() for c in ("conv_id", "role", "text"))):
            if conv != at:
                at, state, k = conv, "", 0
            role = role or ""
            state = allowed(state, role)
            for part, loss in turn_segments(role, text or ""):
                rows.append((conv, k, part, loss, state is not None))
                k += 1
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.string(), pa.bool_(), pa.bool_()))],
                                         ["conv_id", "segment", "text", "loss", "valid"])


def format_conversations(conversations: DataFrame) -> DataFrame:
    """Segments (conv_id, segment, text, loss, valid), each conversation in order
    in one partition; joined, a conversation's segments are its formatted text."""
    c = F.col
    return (conversations.select(c("conv_id").cast("long").alias("conv_id"), c("turn").cast("long").alias("turn"), c("role").cast("string").alias("role"), c("text").cast("string").alias("text"))
            .repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").mapInArrow(_format, _SEGMENTS))


_ENDS = {t[1].strip(): (t[0], t[1], role) for role, t in TEMPLATE.items()} | {OTHER[2].strip(): (OTHER[0], OTHER[2], None)}
_END = re.compile("|".join(re.escape(x) for x in sorted(_ENDS, key=len, reverse=True)))


def read_turns(text: str) -> tuple[list[tuple[str, str]], str]:
    """Whole turns at the start of formatted text, and what follows them."""
    turns = []
    while m := _END.search(text):
        before, after, role = _ENDS[m[0]]
        stop = m.end() + len(after) - len(after.rstrip())
        if len(text) < stop:
            break
        body = text[len(before):m.start() - (len(after) - len(after.lstrip()))]
        if role is None:
            role, _, body = body.partition(OTHER[1])
            role = unescaped(role)
        turns.append((role, unescaped(body)))
        text = text[stop:]
    return turns, text


class _Digest:
    def __init__(self, conv):
        self.conv, self.rest, self.turns, self.chars, self.loss_chars = conv, "", 0, 0, 0
        self.all, self.loss, self.valid, self.role = hashlib.sha256(), hashlib.sha256(), True, ""

    def add(self, text: str, loss: bool, valid: bool) -> None:
        self.chars += len(text)
        self.valid &= valid
        if loss:
            own = unescaped(text)
            self.loss_chars += len(own)
            self.loss.update(own.encode())
        turns, self.rest = read_turns(self.rest + text)
        for role, body in turns:
            self.turns += 1
            self.role = role
            self.all.update(f"{role}\n{body}\n".encode())

    def row(self) -> tuple:
        return self.conv, self.turns, self.all.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars, self.valid and self.role in END


_DIGESTS = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, valid boolean"


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.bool_())
    names = [x.split()[0] for x in _DIGESTS.split(", ")]

    def batch(rows: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names)

    now, rows = None, []
    for b in batches:
        for conv, k, text, loss, valid in zip(*(b.column(c).to_pylist() for c in ("conv_id", "segment", "text", "loss", "valid"))):
            if now is None or conv != now.conv or k == 0:
                if now is not None:
                    rows.append(now.row())
                now = _Digest(conv)
            now.add(text, loss, valid)
        if len(rows) >= 5000:
            yield batch(rows)
            rows = []
    if now is not None:
        rows.append(now.row())
    yield batch(rows)


def formatted_digests(segments: DataFrame) -> DataFrame:
    """Turns and loss text read back from the formatted text of segments as
    ``format_conversations`` gives them (in order, a conversation in one partition)."""
    return segments.mapInArrow(_digest, _DIGESTS)
