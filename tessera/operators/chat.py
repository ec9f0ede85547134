"""Multi-turn and table rendering (P5, P22, task 22 history).

A conversation or a table is one prompt, so its rows are gathered per key with
``collect_list`` of (order, line) structs and sorted inside the row. Keys are
bounded by construction (turns of one conversation, line items of one order);
nothing is gathered across keys.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import null_to_empty
from ..registry import END_TURN, START_MODEL, START_TURN


def _block(role, text):
    return F.concat(F.lit(START_TURN), role, F.lit("\n"), null_to_empty(text), F.lit(END_TURN))


def _role(c, role_map: Mapping[str, str] | None):
    if not role_map:
        return null_to_empty(c)
    m = F.create_map(*[x for k, v in role_map.items() for x in (F.lit(k), F.lit(v))])
    return F.coalesce(F.try_element_at(m, c), null_to_empty(c))


def render_chat_blocks(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                       text: str = "text", role_map: Mapping[str, str] | None = None) -> DataFrame:
    """P5 in long form: one rendered block per message (conv, turn, block),
    nothing gathered. The chat text is the blocks in turn order joined by a
    newline plus the open model turn; use this form for a conversation too
    large to be one value, e.g. to write it out in order."""
    return df.select(conv, turn, _block(_role(F.col(role), role_map), F.col(text)).alias("block"))


def render_chat(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                text: str = "text", role_map: Mapping[str, str] | None = None) -> DataFrame:
    """P5: one block per message in turn order, then an open model turn.
    Roles are copied as they are unless ``role_map`` renames them."""
    blocks = df.select(conv, F.struct(F.col(turn).alias("t"),
                                      _block(_role(F.col(role), role_map), F.col(text)).alias("b")).alias("m"))
    per = blocks.groupBy(conv).agg(F.array_sort(F.collect_list("m")).alias("ms"))
    return per.select(conv, F.concat(F.array_join(F.transform("ms", lambda x: x["b"]), "\n"),
                                     F.lit("\n" + START_MODEL)).alias("text"))


def render_chat_history(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                        text: str = "text") -> DataFrame:
    """Task 22 training pair: all turns but the last rendered as history
    (P5 format), the last turn's text as the answer."""
    ms = df.select(conv, F.struct(F.col(turn).alias("t"), F.col(role).alias("r"),
                                  F.col(text).alias("x")).alias("m"))
    per = ms.groupBy(conv).agg(F.array_sort(F.collect_list("m")).alias("ms"))
    head = F.slice("ms", 1, F.size("ms") - 1)
    history = F.concat(F.array_join(F.transform(head, lambda m: _block(m["r"], m["x"])), "\n"),
                       F.lit("\n" + START_MODEL))
    return per.select(conv, history.alias("history"), F.element_at("ms", -1)["x"].alias("last_text"))


def render_table_markdown(df: DataFrame, table: str, order: str, cols: Sequence[str]) -> DataFrame:
    """Rows grouped by table id → Markdown with header and rule line.
    Lines are ordered by ``order`` and then by their own text, so tied order
    values still give one deterministic table."""
    header = "| " + " | ".join(cols) + " |\n" + "| " + " | ".join("---" for _ in cols) + " |\n"
    line = F.concat(F.lit("| "), F.concat_ws(" | ", *[null_to_empty(F.col(c).cast("string")) for c in cols]),
                    F.lit(" |"))
    rows = df.select(table, F.struct(F.col(order).alias("o"), line.alias("l")).alias("r"))
    per = rows.groupBy(table).agg(F.array_sort(F.collect_list("r")).alias("rs"))
    return per.select(F.col(table).alias("table_id"),
                      F.concat(F.lit(header), F.array_join(F.transform("rs", lambda r: r["l"]), "\n")).alias("markdown"))
