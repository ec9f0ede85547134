"""Task preparation: input/label resolution, prompt rendering, caps, ratio
mixes and split fallbacks (S3, S4, P1-P3, P8-P15, P18, L1, L2, U1-U3, A1).

Caps are explicit-order operations: the reference takes the first n rows in
source order; we take the first n in an order key. Only the order keys are
ranked, by the distributed numbering of ``operators.sequence``, so that no
single task merges them; the chosen keys select whole rows with a semi join.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.prompts import render_inference, render_inputs, render_prompt
from ..functions.text import decode_label, decode_passthrough, first_nonempty, first_present, null_to_empty
from ..registry import (FALLBACK_EVALUATION, FALLBACK_TEST, FALLBACK_VALIDATION, NEUTRAL_WORD, SENTIPOLC_LABELS, SST2_LABELS,
                        STARS_TO_SENTIMENT, Task, get_task)
from .sequence import number_within

SPLITS = ("train", "validation", "test")


def as_text(df: DataFrame, name: str, role: str = "input") -> Column:
    """A column of any reference input type rendered as text.

    string → itself; array → tokens joined by a space; struct with a ``text``
    array (answers) → first answer; translation struct → the source language
    for the input, the target language for the label; other → JSON."""
    if name not in df.columns:
        return F.lit("")
    dtype = df.schema[name].dataType
    c = F.col(name)
    if isinstance(dtype, T.StringType):
        return null_to_empty(c)
    if isinstance(dtype, T.ArrayType):
        return F.coalesce(F.array_join(c.cast("array<string>"), " "), F.lit(""))
    if isinstance(dtype, T.StructType):
        fields = dtype.fieldNames()
        if "text" in fields:
            return F.coalesce(F.element_at(c.getField("text"), 1), F.lit(""))
        if {"en", "it"} <= set(fields):
            return null_to_empty(c.getField("en" if role == "input" else "it"))
        return F.to_json(c)
    return null_to_empty(c.cast("string"))


def resolve_input(df: DataFrame, task: Task) -> Column:
    """Input column of the task; the first column when it is absent, or in
    the rows where its text is empty (P18)."""
    first = as_text(df, df.columns[0], "input")
    if task.input_col not in df.columns:
        return first
    text = as_text(df, task.input_col, "input")
    return F.when(~text.rlike(r"\S"), first).otherwise(text)  # ends at the first character that is no white space


def resolve_label(df: DataFrame, task: Task) -> Column:
    """Label as words: task 01 decodes with a neutral default (P11), tasks with
    a label map pass unknown values through (P12), others use the raw text."""
    if task.label_col not in df.columns:
        return F.lit("")
    if task.task_id == "01":
        return decode_label(F.col(task.label_col), {int(k): v for k, v in task.label_map.items()}, NEUTRAL_WORD)
    if task.label_map:
        return decode_passthrough(F.col(task.label_col), task.label_map)
    return as_text(df, task.label_col, "label")


def prepare_task(df: DataFrame, task_id: str, keep: Sequence[str] = ("id", "split"),
                 input_col: str | None = None, label_col: str | None = None,
                 inputs: Sequence[tuple[str, str]] = ()) -> DataFrame:
    """Render the training text of one task; every other source column is
    dropped (Catalyst prunes them from the scan). ``input_col``/``label_col``
    override the registry's column names (e.g. chat history and last turn);
    ``inputs`` names several input columns, each with its label (P24)."""
    task = get_task(task_id)
    if input_col or label_col:
        from dataclasses import replace
        task = replace(task, input_col=input_col or task.input_col, label_col=label_col or task.label_col)
    kept = [c for c in keep if c in df.columns]
    given = render_inputs([as_text(df, c) for c, _ in inputs], [lab for _, lab in inputs]) if inputs else resolve_input(df, task)
    text = render_prompt(given, resolve_label(df, task), task.system_prompt, task.prefix)
    return df.select(*kept, text.alias("text"))


def _sentiment_of(c: Column, source: str) -> Column:
    if source == "stars":
        return decode_label(c.try_cast("int") + 1, STARS_TO_SENTIMENT, NEUTRAL_WORD)
    return decode_label(c, SST2_LABELS if source == "sentence" else SENTIPOLC_LABELS, NEUTRAL_WORD)


#: Layouts of sentiment sources: where the text is and what a label means.
SENTIMENT_SOURCES = ("text", "sentence", "stars")


def prepare_sentiment(df: DataFrame, source: str, keep: Sequence[str] = ("id", "split")) -> DataFrame:
    """Task 01 from one of its sources.

    ``text``: column text, else (absent) sentence; column label, else (absent)
    polarity; three classes. ``sentence``: column sentence; two classes.
    ``stars``: column text, else (null or blank) title; a rating from 0, or the
    middle one where there is no column label. Unknown and null labels are
    neutral, null texts empty."""
    if source not in SENTIMENT_SOURCES:
        raise ValueError(f"source {source!r} not valid; choose from: {', '.join(SENTIMENT_SOURCES)}")
    task = get_task("01")
    if source == "text":
        text = first_present(df.columns, ["text", "sentence"], "")
        label = first_present(df.columns, ["label", "polarity"], 2)
    elif source == "sentence":
        text, label = F.col("sentence"), F.col("label")
    else:
        text = first_nonempty(*[c for c in ("text", "title") if c in df.columns])
        label = first_present(df.columns, ["label"], 3)
    rendered = render_prompt(text, _sentiment_of(label, source), task.system_prompt, task.prefix)
    return df.select(*[c for c in keep if c in df.columns], rendered.alias("text"))


def prepare_inference(df: DataFrame, task_id: str, prefix: str | None = None,
                      keep: Sequence[str] = ("id",)) -> DataFrame:
    """Inference prompts (P3): prefix defaults to the training prefix."""
    task = get_task(task_id)
    kept = [c for c in keep if c in df.columns]
    prompt = render_inference(resolve_input(df, task), task.system_prompt, prefix or task.prefix)
    return df.select(*kept, prompt.alias("prompt"))


def _keep_keys(df: DataFrame, chosen: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``df`` whose keys (nulls included) are in ``chosen``."""
    named = chosen.select(*[F.col(k).alias(f"_key_{k}") for k in keys])
    same = F.lit(True)
    for k in keys:
        same = same & df[k].eqNullSafe(named[f"_key_{k}"])
    return df.join(named, same, "left_semi")


#: Most rows that are taken as a head; every task sends its first ones to one.
HEAD_ROWS = 10_000


def head(df: DataFrame, n: int, order_by: Sequence[str]) -> DataFrame:
    """First n rows, n at most ``HEAD_ROWS``, in ``order_by`` order: one pass
    that keeps n rows a task, no job before the result is asked for."""
    if n > HEAD_ROWS:
        raise ValueError(f"a head has at most {HEAD_ROWS} rows; use cap")
    return df.orderBy(*order_by).limit(n)


def cap(df: DataFrame, n: int, order_by: Sequence[str]) -> DataFrame:
    """First n rows in ``order_by`` order, which identifies a row (no-op when
    smaller). A short cap is a head; a longer one ranks the keys, with a job
    that runs now."""
    order_by = list(order_by)
    if n <= HEAD_ROWS:
        return head(df, n, order_by)
    numbered = number_within(df.select(*order_by), order_by, pos_col="_cap_pos")
    return _keep_keys(df, numbered.where(F.col("_cap_pos") < n), order_by)


def cap_splits(df: DataFrame, caps: Mapping[str, int], order_by: Sequence[str],
               split_col: str = "split") -> DataFrame:
    """L1 per split: each named split capped at its n; splits without a cap
    pass through whole. The keys of all splits are ranked in one numbering."""
    order_by = list(order_by)
    numbered = number_within(df.select(split_col, *order_by), order_by, [split_col], pos_col="_cap_pos")
    over = F.lit(False)
    for name, n in caps.items():
        over = over | (F.coalesce(F.col(split_col) == name, F.lit(False)) & (F.col("_cap_pos") >= n))
    return _keep_keys(df, numbered.where(~over), [split_col, *order_by])


def head_by_ratio(first: DataFrame, second: DataFrame, num: int, den: int,
                  order_by: Sequence[str]) -> DataFrame:
    """L2: first floor(num·|first|/den) rows of ``second`` in order (at most
    all of it). The size of ``first`` is a scalar subquery; the rank is the
    distributed numbering, because the cap grows with the data."""
    order_by = list(order_by)
    k = first.select((F.floor(F.count(F.lit(1)) * F.lit(num) / F.lit(den))).alias("k")).scalar()
    # only the order key goes through the numbering (Arrow pass + checkpoint);
    # the chosen keys select whole rows with a semi join
    numbered = number_within(second.select(*order_by), order_by, pos_col="_ratio_pos")
    chosen = numbered.where(F.col("_ratio_pos") < k).select(*order_by)
    return second.join(chosen, order_by, "left_semi")


def with_split_fallback(df: DataFrame, split: str, n: int, order_by: Sequence[str],
                        split_col: str = "split", source_split: str = "train") -> DataFrame:
    """Rows of ``split`` when it has any, else the first n (a fixed number
    of at most ``HEAD_ROWS``) rows of ``source_split`` relabelled. Lazy: the
    emptiness test is a scalar subquery, and the head of the source split is
    taken below it."""
    present = df.where(F.col(split_col) == split)
    n_present = present.select(F.count(F.lit(1))).scalar()
    fallback = (head(df.where(F.col(split_col) == source_split), n, order_by)
                .withColumn(split_col, F.lit(split))
                .where(n_present == 0))
    return present.unionByName(fallback)


def prepare_evaluation(df: DataFrame, task_id: str, order_by: Sequence[str], split_col: str = "split") -> DataFrame:
    """Evaluation input: the test split, else the train head; capped (both at
    200 rows, the recipes' value) and rendered as inference prompts."""
    rows = head(with_split_fallback(df, "test", FALLBACK_EVALUATION, order_by, split_col), FALLBACK_EVALUATION, order_by)
    return prepare_inference(rows, task_id, keep=order_by)


def mix(frames: Sequence[DataFrame], weights: Sequence[int], order_by: Sequence[str],
        split_col: str = "split") -> DataFrame:
    """U2 generalised: the first frame's train split whole, every other frame's
    train split capped at floor(n_first · w_i / w_first) rows (first rows in
    order); validation and test come from the first frame, falling back to its
    train head (100 and 50 rows) when missing."""
    first = frames[0]
    first_train = first.where(F.col(split_col) == "train")
    out = first_train
    for other, w in zip(frames[1:], weights[1:]):
        other_train = other.where(F.col(split_col) == "train")
        out = out.unionByName(head_by_ratio(first_train, other_train, w, weights[0], order_by))
    out = out.unionByName(with_split_fallback(first, "validation", FALLBACK_VALIDATION, order_by, split_col))
    out = out.unionByName(with_split_fallback(first, "test", FALLBACK_TEST, order_by, split_col))
    return out


def choose_source(name: str, sources: Mapping[str, DataFrame]) -> DataFrame:
    """Source by name, ValueError before any job for an unknown one."""
    if name not in sources:
        raise ValueError(f"source {name!r} not valid; choose from: {', '.join(sources)}")
    return sources[name]


def split_stats(df: DataFrame, by: Sequence[str] = ("split",)) -> DataFrame:
    """A1: rows per split (and any extra grouping)."""
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("n_rows"))
