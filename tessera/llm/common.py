"""Column expressions and helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

#: White space of the word rule ``[^\x20\x09-\x0D]+`` (space, \t \n \v \f \r).
SPACE = r"[\x20\x09-\x0D]"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def text_or_empty(text: Column) -> Column:
    return F.coalesce(text.cast("string"), F.lit(""))


def words(text: Column) -> Column:
    """Array of the words of the whole text; empty for a null text."""
    return F.array_remove(F.split(text_or_empty(text), SPACE + "+"), "")


def lower_ascii(text: Column) -> Column:
    """A-Z to a-z, every other character as it is."""
    return F.translate(text_or_empty(text), UPPER, UPPER.lower())


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once per row (a column that is
    named twice in a lambda is computed anew for each use and element)."""
    return F.transform(F.array(value), body)[0]


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once under the shared checkpoint folder and read it back:
    lineage ends there, every later use reads the same bytes, and a lost
    executor repeats none of the work before it."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def few(df: DataFrame, most: int) -> DataFrame:
    """``df`` with a broadcast hint if it has at most ``most`` rows (counted),
    else as it is, to be joined by a shuffle."""
    return F.broadcast(df) if df.count() <= most else df


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
