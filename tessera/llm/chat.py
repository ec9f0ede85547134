"""Chat formatting: a finite-state machine over roles and a template.

``TEMPLATE`` declares the markers of every role and whether its text counts
for the loss; ``NEXT`` declares which role may follow which. A conversation is
read turn by turn: the machine checks the order, and every turn gives three
segments (opening marker, escaped text, closing marker) with a loss flag each.
Control strings inside texts are broken up by an escape that is undone when
the output is read back.

A numbering gives every turn its place and the role before it, so turns are
formatted wherever they lie, one batch at a time. Only the digests of a
conversation are sequential by definition: they are made by the one task that
its rows stream through, in bounded memory.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.sequence import number_within
from .common import saved

#: Role -> (opening marker, closing marker, text counts for the loss).
TEMPLATE = {
    "system": ("<<SYS>>\n", "\n<</SYS>>\n\n", False),
    "user": ("[INST] ", " [/INST]", False),
    "assistant": ("<s> ", " </s>", True),
}
#: Any other role: its name stands between the first two, then the text.
OTHER = ("[ROLE] ", " [SAYS] ", " [/ROLE]")
#: Strings that a text may not hold as they are.
CONTROL = ["<<SYS>>", "<</SYS>>", "[INST]", "[/INST]", "<s>", "</s>", "[ROLE]", "[SAYS]", "[/ROLE]"]
#: State (the role before, or the start) -> roles that may follow.
NEXT = {"start": {"system", "user"}, "system": {"user"}, "user": {"assistant"}, "assistant": {"user"}}

_ESCAPE = re.compile(r"\\|" + "|".join(map(re.escape, CONTROL)))
_UNESCAPE = re.compile(r"\\(.)", re.S)

SEGMENTS = "conv_id long, seq long, role string, error string, segments array<struct<text:string,loss:boolean>>"


def escape(text: str) -> str:
    r"""``\`` doubled, and ``\.`` after the first character of a control string."""
    return _ESCAPE.sub(lambda m: "\\\\" if m[0] == "\\" else m[0][0] + "\\." + m[0][1:], text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(lambda m: "" if m[1] == "." else m[1], text)


def step(state: str, role: str) -> str | None:
    """What is wrong with ``role`` after ``state``; None: nothing."""
    return None if role in NEXT.get(state, ()) else f"{role or 'no role'} after {state}"


def segments(role: str, text: str) -> list[tuple[str, bool]]:
    if role in TEMPLATE:
        start, end, loss = TEMPLATE[role]
        return [(start, False), (escape(text), loss), (end, False)]
    return [(OTHER[0] + escape(role) + OTHER[1], False), (escape(text), False), (OTHER[2], False)]


def parse(piece: str) -> tuple[str, str]:
    """Role and text of one formatted turn."""
    for role, (start, end, _) in TEMPLATE.items():
        if piece.startswith(start) and piece.endswith(end) and len(piece) >= len(start) + len(end):
            return role, unescape(piece[len(start):len(piece) - len(end)])
    head, _, rest = piece[len(OTHER[0]):].partition(OTHER[1])
    return unescape(head), unescape(rest[:len(rest) - len(OTHER[2])])


def _format(batches):
    for batch in batches:
        out = {"conv_id": [], "seq": [], "role": [], "error": [], "segments": []}
        for c, seq, before, role, text in zip(*(batch.column(k).to_pylist() for k in ("conv_id", "seq", "before", "role", "text"))):
            role, text = role or "", text or ""
            out["conv_id"].append(c)
            out["seq"].append(seq)
            out["role"].append(role)
            out["error"].append(step(before, role))
            out["segments"].append([{"text": t, "loss": x} for t, x in segments(role, text)])
        yield pa.RecordBatch.from_pydict(out, schema=pa.schema([
            ("conv_id", pa.int64()), ("seq", pa.int64()), ("role", pa.string()), ("error", pa.string()),
            ("segments", pa.list_(pa.struct([("text", pa.string()), ("loss", pa.bool_())])))]))


def format_chat(conversations: DataFrame) -> DataFrame:
    """One row per turn: ``conv_id, seq, role, error, segments``.

    Turns are ordered by (turn, role, text), null turns first, so ties and
    repeated rows have a fixed order; null text is empty, a null role is an
    empty one, a null conv_id is a conversation of its own. error says what
    the machine found wrong with the order at this turn, else it is null; the
    turn is formatted all the same and the machine goes on from its role. An
    empty table gives no rows; other columns are not read.

    The machine's state is the role before, which a numbering hands to every
    turn; so a conversation is formatted by as many tasks as its rows lie in.
    """
    turns = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), "turn", F.col("role").cast("string").alias("role"),
                                 F.col("text").cast("string").alias("text"))
    placed = number_within(turns, ["turn", "role", "text"], ["conv_id"], pos_col="seq", lags=["role"])
    before = F.when(F.col("seq") == 0, "start").otherwise(F.coalesce("prev_role", F.lit("")))
    return placed.select("conv_id", "seq", before.alias("before"), "role", "text").mapInArrow(_format, SEGMENTS)


class _Digest:
    """What is known of the conversation that streams by."""

    def __init__(self, conv):
        self.conv, self.turns, self.loss_chars, self.chars, self.errors = conv, 0, 0, 0, 0
        self.said, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, parts: list[dict], error: str | None) -> None:
        piece = "".join(p["text"] for p in parts)
        role, text = parse(piece)
        self.turns += 1
        self.chars += len(piece)
        self.errors += error is not None
        self.said.update(f"{role}\n{text}\n".encode())
        for p in parts:
            if p["loss"]:
                plain = unescape(p["text"])
                self.loss_chars += len(plain)
                self.loss.update(plain.encode())

    def row(self):
        return (self.conv, self.turns, self.said.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars, self.errors)


_DIGEST = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
                     ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()), ("n_errors", pa.int64())])


def _digest(batches):
    now = None
    for batch in batches:
        done = []
        for c, parts, error in zip(*(batch.column(k).to_pylist() for k in ("conv_id", "segments", "error"))):
            if now is None or c != now.conv:
                if now is not None:
                    done.append(now.row())
                now = _Digest(c)
            now.add(parts, error)
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(x, type=t) for x, t in zip(zip(*done), _DIGEST.types)], schema=_DIGEST)
    if now is not None:
        yield pa.RecordBatch.from_arrays([pa.array(x, type=t) for x, t in zip(zip(now.row()), _DIGEST.types)], schema=_DIGEST)


def chat_digest(formatted: DataFrame) -> DataFrame:
    """Per conversation, read back from the formatted turns: ``conv_id,
    n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars,
    n_errors``."""
    ordered = formatted.select("conv_id", "seq", "error", "segments").repartition("conv_id").sortWithinPartitions("conv_id", "seq")
    return ordered.mapInArrow(_digest, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
                                       "formatted_chars long, n_errors long")


def formatted_and_back(conversations: DataFrame) -> DataFrame:
    """Format, write, read back, digest."""
    return chat_digest(saved(format_chat(conversations), "chat"))
