"""Table and file readers (S1, S2) and the prepared-dataset sink."""

from __future__ import annotations

import os
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..registry import get_task
from ..session import scratch_path

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table; Parquet keeps column pruning and filter pushdown."""
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def _format_of(path: str, fmt: str | None) -> str:
    fmt = fmt or os.path.splitext(path.rstrip("/"))[1].lstrip(".") or "parquet"
    return "json" if fmt == "jsonl" else fmt


def read_path(spark: SparkSession, path: str, fmt: str | None = None, schema: T.StructType | str | None = None) -> DataFrame:
    """Read a source by path; the format is taken from the extension when not
    given. JSON needs a declared schema, so that no pass over the data infers
    one; CSV without a schema has text columns named by its header. Broken
    lines of either give nulls here; ``read_checked`` sets them apart."""
    fmt = _format_of(path, fmt)
    if fmt == "json" and schema is None:
        raise ValueError("a JSON source needs a schema")
    reader = spark.read if schema is None else spark.read.schema(schema)
    if fmt == "csv":
        reader = reader.option("header", "true").option("escape", '"')
    return reader.format(fmt).load(path)


#: Name of the column that holds a line as it was read.
BROKEN = "_broken_line"


class Checked(NamedTuple):
    rows: DataFrame
    broken: DataFrame


def read_checked(spark: SparkSession, path: str, schema: T.StructType | str, fmt: str | None = None, quarantine: str | None = None,
                 multi_line: bool = False) -> Checked:
    """S1 for CSV and JSON lines: the rows under the declared schema, and the
    broken lines (``path``, ``line``), which are kept, not dropped.

    A line is broken that does not parse, lacks or exceeds columns (CSV) or
    holds a value that is not of its column's type; an absent JSON field is
    null. The source is read once, without inference, and written as Parquet in
    the folder ``quarantine`` (a scratch folder when not given), parted by
    whether a line is broken; both results read that folder. An empty source
    gives two empty tables. ``multi_line`` reads CSV values with line ends in
    quotes (such files are not split)."""
    fmt = _format_of(path, fmt)
    declared = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    full = T.StructType([*declared.fields, T.StructField(BROKEN, T.StringType())])
    reader = spark.read.schema(full).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", BROKEN)
    if fmt == "csv":
        reader = reader.option("header", "true").option("escape", '"').option("multiLine", str(multi_line).lower())
    parsed = reader.format(fmt).load(path)
    staged = parsed.withColumns({"_path": F.input_file_name(), "_is_broken": F.col(BROKEN).isNotNull()})
    out = quarantine or scratch_path(spark, "checked")
    staged.write.partitionBy("_is_broken").parquet(out)
    stored = spark.read.schema(T.StructType([*staged.schema.fields])).parquet(out)
    rows = stored.where(~F.col("_is_broken")).select(*[F.col(f"`{f.name}`") for f in declared.fields])
    return Checked(rows, stored.where("_is_broken").select(F.col("_path").alias("path"), F.col(BROKEN).alias("line")))


def read_source(spark: SparkSession, task_id: str, path: str, config: str | None = None,
                config_col: str = "lang", schema: T.StructType | str | None = None) -> DataFrame:
    """Read the source of a task from a file path (the hub id is only a
    registry label) and keep one configuration when asked. The configuration
    filter is a plain predicate, so Parquet pushes it to the scan (and prunes
    partitions when the source is partitioned by ``config_col``)."""
    get_task(task_id)  # validates the id before any job
    df = read_path(spark, path, schema=schema)
    if config is not None:
        df = df.where(F.col(config_col) == F.lit(config))
    return df


def save_prepared(df: DataFrame, path: str, split_col: str | Sequence[str] = "split") -> None:
    """Write a prepared dataset partitioned by split (and any further
    partition columns). The splits (partitions) that ``df`` holds replace those
    of their name, others stay: one split can be prepared anew. Files are
    written to a staging folder and moved when all tasks are done, so a failed
    job changes nothing. Readers prune to the partitions their filters name."""
    cols = [split_col] if isinstance(split_col, str) else list(split_col)
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*cols).parquet(path)


def load_prepared(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
