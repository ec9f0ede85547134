"""Data-quality checks over whole tables (P7, P17, K6 report rows)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.prompts import prompt_checks


def check_prompts(df: DataFrame, text: str = "text") -> DataFrame:
    """P7 over all rows: marker presence and character lengths."""
    flags = prompt_checks(text)
    valid = flags["has_user"] & flags["has_end"] & flags["has_model"]
    n = F.length(text)
    return df.agg(F.count(F.lit(1)).alias("n"), F.count_if(valid).alias("n_valid"),
                  F.min(n).cast("long").alias("min_len"), F.max(n).cast("long").alias("max_len"),
                  F.round(F.avg(n), 6).alias("avg_len"))


def check_columns(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """One row per required column: present?, null count (one pass over
    the data; an absent column reports present = false and 0 nulls)."""
    present = [c for c in required if c in df.columns]
    aggs = [F.count_if(F.col(c).isNull()).alias(f"_n_{i}") for i, c in enumerate(present)]
    counts = df.agg(*aggs) if aggs else df.limit(1).select(F.lit(0).alias("_none"))
    parts = []
    for c in required:
        if c in present:
            parts += [F.lit(c), F.lit(True), F.col(f"_n_{present.index(c)}").cast("long")]
        else:
            parts += [F.lit(c), F.lit(False), F.lit(0).cast("long")]
    return counts.select(F.inline(F.array(*[F.struct(parts[i].alias("column_name"), parts[i + 1].alias("present"),
                                                      parts[i + 2].alias("n_null"))
                                             for i in range(0, len(parts), 3)])))
