r"""Chat formatting checked by a grammar round trip.

A turn is rendered as ``### <Role>: <text>\n</turn>\n``. The grammar of a rendering is

    conversation := turn*            turn := "### " role ": " body "\n</turn>\n"

with ``role`` free of the characters colon, backslash and white space, and ``body`` free of unescaped marks.
A mark (``### `` or ``</turn>``) after an odd number of backslashes is text; after an even number it is a
mark. A text is first rendered as it is and read back by the parser; only if turns or texts come back
changed, its conflicting content is escaped (backslashes before a mark doubled, one added) and it is read
again, until the turns are identical. Roles with other characters are written in percent code.

Turns of a conversation are independent pieces of the rendering: a conversation is the concatenation of its
turns in order, so a conversation of any length is rendered, read and digested as a stream in bounded
memory. Only a single turn has to fit into a task.

Defined results: null text and null role are empty; rows with a null ``conv_id`` are one conversation;
turns are ordered by ``turn`` (nulls first), ties by their rendering; repeated rows are turns of their own;
an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The template's marks, and the role whose text is learned.
OPEN, CLOSE = "### ", "</turn>"
LEARNED = "assistant"

_MARK = re.compile(r"(\\*)(### |</turn>)")
_TURN_END = "\n" + CLOSE + "\n"

RENDERED = (
    "conv_id {conv}, turn {turn}, rendered string, loss_start bigint, loss_end bigint, escaped boolean"
)
DIGEST = (
    "conv_id {conv}, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string,"
    " formatted_chars bigint"
)


def escape(text: str) -> str:
    return _MARK.sub(lambda m: m[1] * 2 + "\\" + m[2], text)


def unescape(body: str) -> str:
    """Inverse of ``escape``: every mark in ``body`` follows an odd number of backslashes."""
    return _MARK.sub(lambda m: m[1][: len(m[1]) // 2] + m[2], body)


def render(role: str, text: str) -> tuple[str, int, int]:
    """Rendered turn, and start and end of its body, in code points."""
    coded = quote(role, safe="")
    shown = coded.capitalize()
    if coded.startswith("%") or unquote(shown).lower() != role:
        shown = "%" + coded  # a role that capitals would change
    head = OPEN + shown + ": "
    return head + text + _TURN_END, len(head), len(head) + len(text)


def parse(rendered: str) -> list[tuple[str, str]]:
    """Turns of a rendering; ValueError where it isn't in the grammar."""
    turns, at = [], 0
    while at < len(rendered):
        if not rendered.startswith(OPEN, at):
            raise ValueError(f"no turn begins at {at}")
        colon = rendered.find(": ", at + len(OPEN))
        if colon < 0:
            raise ValueError(f"no role at {at}")
        role = rendered[at + len(OPEN) : colon]
        if not role.isprintable() or " " in role or ":" in role or "\\" in role:
            raise ValueError(f"no role at {at}")
        role = unquote(role[1:]) if role.startswith("%") else unquote(role).lower()
        body = colon + 2
        for mark in _MARK.finditer(rendered, body):
            if len(mark[1]) % 2 == 0:
                break
        else:
            raise ValueError(f"the turn at {at} has no end")
        end = mark.start(2)
        if mark[2] != CLOSE or rendered[end - 1] != "\n" or end - 1 < body or not rendered.startswith(
            _TURN_END, end - 1
        ):
            raise ValueError(f"the turn at {at} has a mark inside")
        turns.append((role, unescape(rendered[body : end - 1])))
        at = end - 1 + len(_TURN_END)
    return turns


def round_trip(role: str, text: str) -> tuple[str, int, int, bool]:
    """A rendering that parses to exactly this turn, its body's place, and if it had to be escaped."""
    for escaped, body in ((False, text), (True, escape(text))):
        rendered, start, end = render(role, body)
        try:
            if parse(rendered) == [(role, text)]:
                return rendered, start, end, escaped
        except ValueError:
            pass
    raise ValueError(f"no rendering of a turn of {role!r} parses back")


def formatted(conversations: DataFrame) -> DataFrame:
    """One row per turn, in no order: conv_id, turn, rendered, loss_start, loss_end, escaped.

    A conversation's text is its ``rendered`` in the order of ``turn``, then ``rendered``. The loss mask
    covers code points ``loss_start`` to ``loss_end`` (exclusive) of the turn; both are null for turns
    that are not learned. Turns are rendered where they lie, without a shuffle.
    """
    conv, turn = (conversations.schema[c].dataType.simpleString() for c in ("conv_id", "turn"))

    def turns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [
                (*round_trip(role, text), role == LEARNED)
                for role, text in zip(batch["role"].to_pylist(), batch["text"].to_pylist())
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    batch["conv_id"],
                    batch["turn"],
                    pa.array([r[0] for r in rows], pa.string()),
                    pa.array([r[1] if r[4] else None for r in rows], pa.int64()),
                    pa.array([r[2] if r[4] else None for r in rows], pa.int64()),
                    pa.array([r[3] for r in rows], pa.bool_()),
                ],
                ["conv_id", "turn", "rendered", "loss_start", "loss_end", "escaped"],
            )

    return conversations.select(
        "conv_id",
        "turn",
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    ).mapInArrow(turns, RENDERED.format(conv=conv, turn=turn))


def digests(rendered: DataFrame) -> DataFrame:
    """Per conversation, read back from ``formatted``: the columns of ``DIGEST``.

    turns_sha256 is of role, newline, text, newline per turn; loss_sha256 of all unescaped text under the
    loss mask. Rows come sorted and hashes run along, so no conversation is held in memory.
    """
    kind = rendered.schema["conv_id"].dataType

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, state, schema = None, None, None
        for batch in batches:
            schema = batch.schema.field("conv_id").type
            done = []
            for key, text, start, end in zip(
                zip(batch["known"].to_pylist(), batch["conv_id"].to_pylist()),
                *(batch[c].to_pylist() for c in ("rendered", "loss_start", "loss_end")),
            ):
                if key != last:
                    if state:
                        done.append(state.row())
                    last, state = key, _Digest(key[1] if key[0] else None)
                state.add(text, start, end)
            yield _digest_batch(done, schema)
        if state:
            yield _digest_batch([state.row()], schema)

    return (
        rendered.select(
            F.col("conv_id").isNotNull().alias("known"),
            F.coalesce("conv_id", F.lit(0).cast(kind)).alias("conv_id"),
            "turn",
            "rendered",
            "loss_start",
            "loss_end",
        )
        .repartition("known", "conv_id")
        .sortWithinPartitions("known", "conv_id", "turn", "rendered")
        .mapInArrow(read, DIGEST.format(conv=kind.simpleString()))
    )


def _digest_batch(rows: list[tuple], conv: pa.DataType) -> pa.RecordBatch:
    kinds = [conv, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    names = [part.split()[0] for part in DIGEST.split(", ")]
    return pa.RecordBatch.from_arrays(
        [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)], names
    )


class _Digest:
    def __init__(self, conv_id: object) -> None:
        self.conv_id, self.turns, self.chars, self.loss_chars = conv_id, 0, 0, 0
        self.all, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, rendered: str, start: int | None, end: int | None) -> None:
        self.chars += len(rendered)
        for role, text in parse(rendered):
            self.turns += 1
            self.all.update(f"{role}\n{text}\n".encode())
        if start is not None:
            learned = unescape(rendered[start:end])
            self.loss_chars += len(learned)
            self.loss.update(learned.encode())

    def row(self) -> tuple:
        return (self.conv_id, self.turns, self.all.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars)
