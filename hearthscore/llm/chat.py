"""Chat formatting: a role machine, a template, and loss flags per text segment.

A template is plain data: how a turn opens and closes, which roles may follow
each state, and whose text is trained on.  Texts are escaped so that no control
string can occur inside one, and the escape is undone exactly when read back.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearthscore.llm.common import batch_of, pylists


@dataclass(frozen=True)
class ChatTemplate:
    """``open_turn`` + role + ``after_role`` + text + ``close_turn`` for every turn.

    Control strings start with ``<|``; ``moves`` maps a state and a role to the
    next state, and a conversation is valid if it ends in ``accepts`` without a
    missing move.
    """

    open_turn: str = "<|im_start|>"
    after_role: str = "\n"
    close_turn: str = "<|im_end|>\n"
    trained_roles: frozenset[str] = frozenset({"assistant"})
    start: str = "start"
    moves: dict[tuple[str, str], str] = field(
        default_factory=lambda: {
            ("start", "system"): "briefed",
            ("start", "user"): "asked",
            ("briefed", "user"): "asked",
            ("asked", "assistant"): "answered",
            ("asked", "tool"): "asked",
            ("answered", "tool"): "asked",
            ("answered", "user"): "asked",
        }
    )
    accepts: frozenset[str] = frozenset({"answered"})


BROKEN = "broken"  # state after a role that has no move


def escape(text: str) -> str:
    """One backslash more between ``<`` and ``|``, wherever they meet over backslashes."""
    return re.sub(r"<(\\*)\|", r"<\1\\|", text)


def unescape(text: str) -> str:
    return re.sub(r"<(\\*)\\\|", r"<\1|", text)


def escape_role(role: str) -> str:
    """As :func:`escape`, on one line."""
    return escape(role.replace("%", "%25").replace("\n", "%0A"))


def unescape_role(role: str) -> str:
    return unescape(role).replace("%0A", "\n").replace("%25", "%")


def turn_segments(template: ChatTemplate, role: str, text: str) -> list[tuple[str, bool]]:
    """The formatted turn as (text, trained on) segments."""
    t = template
    return [
        (t.open_turn + escape_role(role) + t.after_role, False),
        (escape(text), role in t.trained_roles),
        (t.close_turn, False),
    ]


def read_turns(template: ChatTemplate, formatted: str) -> list[tuple[str, str]]:
    """Roles and texts of a formatted text."""
    t, out, at = template, [], 0
    while at < len(formatted):
        if not formatted.startswith(t.open_turn, at):
            raise ValueError("no turn opens here")
        role_end = formatted.index(t.after_role, at)
        text_end = formatted.index(t.close_turn, role_end)
        role = formatted[at + len(t.open_turn) : role_end]
        text = formatted[role_end + len(t.after_role) : text_end]
        out.append((unescape_role(role), unescape(text)))
        at = text_end + len(t.close_turn)
    return out


TURN = pa.schema(
    [
        ("conv", pa.int64()),
        ("turn", pa.int64()),
        ("state", pa.string()),
        ("segments", pa.list_(pa.struct([("text", pa.string()), ("loss", pa.bool_())]))),
    ]
)
TURN_DDL = "conv long, turn long, state string, segments array<struct<text:string,loss:boolean>>"


def _formatter(template: ChatTemplate):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, state = (), template.start
        for batch in batches:
            rows = []
            for conv, turn, role, text in pylists(batch):
                if current != (conv,):
                    current, state = (conv,), template.start
                state = template.moves.get((state, role), BROKEN)
                segments = turn_segments(template, role, text)
                rows.append((conv, turn, state, [{"text": a, "loss": b} for a, b in segments]))
            yield batch_of(TURN, rows)

    return run


def format_turns(
    df: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    template: ChatTemplate = ChatTemplate(),
) -> DataFrame:
    """One row per turn: conv, turn, state after it, segments with loss flags.

    Rows are shuffled by conversation once, sorted, and streamed through the
    role machine, so a conversation of any length needs memory for one batch.
    Null roles and texts count as empty; null conversation ids form one
    conversation, null turns come first, ties go by role, then text; repeated
    rows are turns of their own.  A role without a move puts the rest of the
    conversation in state ``broken``: it is formatted all the same and the
    caller may filter.  An empty table gives an empty result.
    """
    rows = df.select(
        F.col(conv_col).cast("long").alias("conv"),
        F.col(turn_col).cast("long").alias("turn"),
        F.coalesce(F.col(role_col), F.lit("")).alias("role"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )
    rows = rows.repartition("conv").sortWithinPartitions("conv", "turn", "role", "text")
    return rows.mapInArrow(_formatter(template), TURN_DDL)


DIGEST = pa.schema(
    [
        ("conv", pa.int64()),
        ("n_turns", pa.int64()),
        ("turns_sha256", pa.string()),
        ("loss_chars", pa.int64()),
        ("loss_sha256", pa.string()),
        ("formatted_chars", pa.int64()),
        ("valid", pa.bool_()),
    ]
)
DIGEST_DDL = (
    "conv long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string,"
    " formatted_chars long, valid boolean"
)


class _Digest:
    def __init__(self, conv: int | None):
        self.conv, self.n, self.loss_chars, self.chars = conv, 0, 0, 0
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.state, self.broken = "", False

    def add(self, template: ChatTemplate, state: str, segments: list[dict]) -> None:
        formatted = "".join(s["text"] for s in segments)
        for role, text in read_turns(template, formatted):
            self.n += 1
            self.turns.update(f"{role}\n{text}\n".encode())
        for s in segments:
            if s["loss"]:
                text = unescape(s["text"])
                self.loss_chars += len(text)
                self.loss.update(text.encode())
        self.chars += len(formatted)
        self.state, self.broken = state, self.broken or state == BROKEN

    def row(self, template: ChatTemplate) -> tuple:
        valid = not self.broken and self.state in template.accepts
        ends = (self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars, valid)
        return (self.conv, self.n, *ends)


def conversation_digests(formatted: DataFrame, template: ChatTemplate = ChatTemplate()) -> DataFrame:
    """One row per conversation of :func:`format_turns`, read back from its segments.

    Keeps the partitioning and order of its input; hashes run along, so nothing
    of a conversation is collected.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_conv: _Digest | None = None
        for batch in batches:
            rows = []
            for conv, _, state, segments in pylists(batch):
                if open_conv is None or open_conv.conv != conv:
                    if open_conv is not None:
                        rows.append(open_conv.row(template))
                    open_conv = _Digest(conv)
                open_conv.add(template, state, segments)
            yield batch_of(DIGEST, rows)
        if open_conv is not None:
            yield batch_of(DIGEST, [open_conv.row(template)])

    return formatted.mapInArrow(run, DIGEST_DDL)
