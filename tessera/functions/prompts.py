"""Prompt rendering as column expressions (constant parts fold at plan time)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..registry import END_TURN, IO_TEMPLATE_INPUT, IO_TEMPLATE_OUTPUT, START_MODEL, START_USER
from .text import null_to_empty, strip


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def render_prompt(user_text: Column, answer: Column, system: str, prefix: str) -> Column:
    """Single-turn training text: [system prompt,] "prefix: input", answer.

    Null inputs render as empty text. Without a system prompt the user turn
    starts directly with the prefix."""
    head = START_USER + (system + "\n\n" if system else "") + prefix + ": "
    return F.concat(F.lit(head), strip(null_to_empty(user_text)),
                    F.lit("\n" + END_TURN + "\n" + START_MODEL),
                    strip(null_to_empty(answer)), F.lit("\n" + END_TURN))


def render_inference(user_text: Column, system: str, prefix: str) -> Column:
    """Inference prompt: same head, no answer, ends at the open model turn.
    The input is used as given (not stripped)."""
    head = START_USER + (system + "\n\n" if system else "") + prefix + ": "
    return F.concat(F.lit(head), null_to_empty(user_text), F.lit("\n" + END_TURN + "\n" + START_MODEL))


def render_pair(user_msg: Column | str, model_msg: Column | str) -> Column:
    """Compact pair: no newline before the end marker."""
    return F.concat(F.lit(START_USER), null_to_empty(_c(user_msg)), F.lit(END_TURN + "\n" + START_MODEL),
                    null_to_empty(_c(model_msg)), F.lit(END_TURN))


def render_io(c: Column | str) -> Column:
    """Generic "Input: ... / Output: risposta" rendering."""
    return F.concat(F.lit(IO_TEMPLATE_INPUT), null_to_empty(_c(c)), F.lit(IO_TEMPLATE_OUTPUT))


def option_label(i: Column) -> Column:
    """Spreadsheet-style label of the 0-based option index: A..Z, AA..ZZ,
    AAA.. (bijective base 26). Seven letters name more options than an array
    can hold (its size is a 32-bit integer). Letter j from the right exists
    from the number 1 + 26 + .. + 26^j on and turns every 26^j numbers."""
    n = i.cast("long") + 1
    digits = []
    for j in range(7):
        least = (26 ** (j + 1) - 1) // 25
        turn = F.call_function("div", n - least, F.lit(26 ** j))
        digits.append(F.when(n >= least, F.chr(F.lit(65) + F.pmod(turn, F.lit(26)))).otherwise(F.lit("")))
    return F.concat(*reversed(digits))


def render_options(options: Column | str) -> Column:
    """Lettered option lines: "A) first", "B) second", ..., "AA) ..."."""
    return F.array_join(
        F.transform(_c(options), lambda x, i: F.concat(option_label(i), F.lit(") "), null_to_empty(x))),
        "\n")


def render_inputs(cols: Sequence[Column | str], labels: Sequence[str]) -> Column:
    """Several inputs each under its own label, one per line."""
    parts = [F.concat(F.lit(lab + ": "), strip(null_to_empty(_c(c)))) for c, lab in zip(cols, labels)]
    return F.concat_ws("\n", *parts)


def prompt_checks(text: Column | str) -> dict[str, Column]:
    """Marker presence flags of a rendered prompt."""
    t = _c(text)
    return {
        "has_user": t.contains("<start_of_turn>user"),
        "has_end": t.contains(END_TURN),
        "has_model": t.contains("<start_of_turn>model"),
    }
