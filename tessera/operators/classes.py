"""Class metrics and alignment.

Everything starts from the confusion table ``groupBy(system, y, p).count()``:
one row per (system, gold, predicted) cell, a few hundred rows however many
examples there are. All per-label and averaged scores are aggregates over it,
so the example-level data is shuffled once, after map-side combine.

Zero-division rule everywhere: a ratio with a zero denominator is 0.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import shorten


def safe_div(num: Column, den: Column) -> Column:
    return F.when(den == 0, F.lit(0.0)).otherwise(num.cast("double") / den.cast("double"))


def f_beta(p: Column, r: Column, beta: float = 1.0) -> Column:
    b2 = beta * beta
    return F.when((p + r) == 0, F.lit(0.0)).otherwise((1 + b2) * p * r / (b2 * p + r))


def stack_systems(df: DataFrame, systems: Sequence[str], id_col: str = "example_id",
                  gold: str = "y_true", extra: Sequence[str] = ()) -> DataFrame:
    """Wide predictions (one column per system) to long (system, y_pred)."""
    args = ", ".join(f"'{s}', `{c}`" for s, c in systems.items()) if isinstance(systems, dict) \
        else ", ".join(f"'{s}', `y_{s}`" for s in systems)
    n = len(systems)
    return df.select(id_col, gold, *extra, F.expr(f"stack({n}, {args}) as (system, y_pred)"))


def align(gold: DataFrame, predictions: DataFrame, systems: Sequence[str],
          id_col: str = "example_id") -> DataFrame:
    """Gold (id, y_true) with long predictions (system, id, y_pred).

    Predictions are pivoted on the known system names (one aggregation keyed
    by example, without a fan-out), left-joined to gold so a missing prediction
    stays null and counts as wrong, then stacked back to (system, id, y_true,
    y_pred, n_predictions). Repeated ids are an error row: n_predictions says
    how many there were, and where they disagree y_pred is null."""
    one = F.when(F.min("y_pred") == F.max("y_pred"), F.min("y_pred"))
    wide = predictions.groupBy(id_col).pivot("system", list(systems)).agg(one.alias("p"), F.count(F.lit(1)).alias("n"))
    joined = gold.join(wide, id_col, "left")
    args = ", ".join(f"'{s}', `{s}_p`, coalesce(`{s}_n`, 0L)" for s in systems)
    return joined.select(id_col, "y_true", F.expr(f"stack({len(systems)}, {args}) as (system, y_pred, n_predictions)"))


def confusion(long: DataFrame, by: Sequence[str] = ("system",), y: str = "y_true",
              p: str = "y_pred") -> DataFrame:
    """Confusion cells (by..., y, p, n)."""
    return long.groupBy(*by, y, p).agg(F.count(F.lit(1)).alias("n"))


def label_counts(conf: DataFrame, by: Sequence[str] = ("system",), y: str = "y_true",
                 p: str = "y_pred") -> DataFrame:
    """Per (by..., label): tp, gold support, predicted count."""
    by = list(by)
    both = conf.select(*by, F.explode(F.array(
        F.struct(F.col(y).alias("label"), F.col("n").alias("g"), F.lit(0).cast("long").alias("pp"),
                 F.when(F.col(y) == F.col(p), F.col("n")).otherwise(F.lit(0)).cast("long").alias("tp")),
        F.struct(F.col(p).alias("label"), F.lit(0).cast("long").alias("g"), F.col("n").alias("pp"),
                 F.lit(0).cast("long").alias("tp")),
    )).alias("c")).select(*by, "c.*").where(F.col("label").isNotNull())
    return both.groupBy(*by, "label").agg(F.sum("tp").alias("tp"), F.sum("g").alias("support"),
                                          F.sum("pp").alias("n_pred"))


def per_label_scores(counts: DataFrame, beta: float = 1.0) -> DataFrame:
    p = safe_div(F.col("tp"), F.col("n_pred"))
    r = safe_div(F.col("tp"), F.col("support"))
    return counts.withColumn("precision", p).withColumn("recall", r) \
        .withColumn("f1", f_beta(F.col("precision"), F.col("recall"), beta))


def accuracy(long: DataFrame, by: Sequence[str] = ("system",), y: str = "y_true", p: str = "y_pred") -> DataFrame:
    """A2: share of exact matches (a null prediction is wrong)."""
    hit = F.when(F.col(y) == F.col(p), F.lit(1.0)).otherwise(F.lit(0.0))
    return long.groupBy(*by).agg(F.avg(hit).alias("accuracy"), F.count(F.lit(1)).alias("n"))


def macro_f1(long: DataFrame, labels: Sequence[str] | None = None, by: Sequence[str] = ("system",),
             y: str = "y_true", p: str = "y_pred") -> DataFrame:
    """A3/A4: macro-F1 over ``labels`` (absent labels score 0), or over the
    labels found in either column when ``labels`` is None."""
    scores = per_label_scores(label_counts(confusion(long, by, y, p), by))
    if labels is None:
        return scores.groupBy(*by).agg(F.avg("f1").alias("macro_f1"))
    # labels that a system never meets score 0, also if it meets none of them
    listed = F.when(F.col("label").isin(*labels), F.col("f1")).otherwise(0.0)
    return scores.groupBy(*by).agg((F.sum(listed) / F.lit(float(len(labels)))).alias("macro_f1"))


def class_report(long: DataFrame, labels: Sequence[str] | None = None, by: Sequence[str] = ("system",),
                 y: str = "y_true", p: str = "y_pred") -> DataFrame:
    """A5: per-label precision/recall/F1/support plus 'accuracy' (micro
    average over the listed labels), 'macro avg' and 'weighted avg' rows."""
    by = list(by)
    scores = per_label_scores(label_counts(confusion(long, by, y, p), by))
    if labels is not None:
        scores = scores.where(F.col("label").isin(*labels))
    n_labels = F.lit(float(len(labels))) if labels is not None else F.count(F.lit(1)).cast("double")
    per = scores.select(*by, F.col("label").alias("row"), "precision", "recall", "f1",
                        F.col("support").cast("long").alias("support"))
    macro = scores.groupBy(*by).agg(
        F.lit("macro avg").alias("row"),
        (F.sum("precision") / n_labels).alias("precision"),
        (F.sum("recall") / n_labels).alias("recall"),
        (F.sum("f1") / n_labels).alias("f1"),
        F.sum("support").cast("long").alias("support"))
    weighted = scores.groupBy(*by).agg(
        F.lit("weighted avg").alias("row"),
        safe_div(F.sum(F.col("precision") * F.col("support")), F.sum("support")).alias("precision"),
        safe_div(F.sum(F.col("recall") * F.col("support")), F.sum("support")).alias("recall"),
        safe_div(F.sum(F.col("f1") * F.col("support")), F.sum("support")).alias("f1"),
        F.sum("support").cast("long").alias("support"))
    tot = scores.groupBy(*by).agg(F.sum("tp").alias("tp"), F.sum("n_pred").alias("np"), F.sum("support").alias("s"))
    mp = safe_div(F.col("tp"), F.col("np"))
    mr = safe_div(F.col("tp"), F.col("s"))
    micro = tot.select(*by, F.lit("accuracy").alias("row"), mp.alias("precision"), mr.alias("recall"),
                       f_beta(mp, mr).alias("f1"), F.col("s").cast("long").alias("support"))
    return per.unionByName(macro).unionByName(weighted).unionByName(micro)


def delta_report(long: DataFrame, base: str = "base", tuned: str = "ft", labels: Sequence[str] | None = None,
                 y: str = "y_true", p: str = "y_pred") -> DataFrame:
    """Metric rows (accuracy, macro_f1) with base, tuned and delta."""
    acc = accuracy(long, ["system"], y, p).select("system", F.lit("accuracy").alias("metric"),
                                                  F.col("accuracy").alias("value"))
    f1 = macro_f1(long, labels, ["system"], y, p).select("system", F.lit("macro_f1").alias("metric"),
                                                         F.col("macro_f1").alias("value"))
    both = acc.unionByName(f1)
    wide = both.groupBy("metric").pivot("system", [base, tuned]).agg(F.first("value"))
    return wide.select("metric", F.col(base).alias("base"), F.col(tuned).alias("tuned"),
                       (F.col(tuned) - F.col(base)).alias("delta"))


def distribution(df: DataFrame, col: str, id_col: str | None = None, top: int | None = None) -> DataFrame:
    """A7 (counts and share) and L4 (first ``top`` classes in order of first
    appearance by ``id_col``). The share uses a window over the already
    aggregated class table (one row per class)."""
    agg = [F.count(F.lit(1)).alias("n")]
    if id_col:
        agg.append(F.min(id_col).alias("first_id"))
    counts = df.groupBy(col).agg(*agg)
    total = df.select(F.count(F.lit(1))).scalar()
    counts = counts.withColumn("share", F.col("n") / total)
    if top is not None and id_col:
        counts = counts.orderBy("first_id").limit(top)
    return counts


def grouped_accuracy(long: DataFrame, by: str, y: str = "y_true", p: str = "y_pred") -> DataFrame:
    """Accuracy per group with a total row (``rollup`` + ``grouping``)."""
    hit = F.when(F.col(y) == F.col(p), F.lit(1.0)).otherwise(F.lit(0.0))
    return (long.rollup(by).agg(F.grouping(by).alias("is_total"), F.count(F.lit(1)).alias("n"),
                                F.avg(hit).alias("accuracy"))
            .withColumn("is_total", F.col("is_total").cast("int")))


def class_recall(long: DataFrame, label: str, by: Sequence[str] = ("system",), y: str = "y_true",
                 p: str = "y_pred") -> DataFrame:
    """Recall of one class (e.g. out-of-scope)."""
    hit = F.when(F.col(p) == F.lit(label), F.lit(1.0)).otherwise(F.lit(0.0))
    return (long.where(F.col(y) == F.lit(label)).groupBy(*by)
            .agg(F.avg(hit).alias("recall"), F.count(F.lit(1)).alias("support")))


def hamming_loss(df: DataFrame, gold: str, pred: str, n_labels: int) -> DataFrame:
    """A10: mean size of the symmetric difference of label sets / n_labels."""
    g, p = F.array_distinct(F.col(gold)), F.array_distinct(F.col(pred))
    sym = F.size(F.array_except(g, p)) + F.size(F.array_except(p, g))
    return df.agg((F.avg(sym) / F.lit(float(n_labels))).alias("hamming_loss"),
                  F.count(F.lit(1)).alias("n"))


def compare(aligned_wide: DataFrame, text_col: str, n: int = 10, width: int = 60,
            id_col: str = "example_id") -> DataFrame:
    """J2 + L3: first n examples side by side with correctness flags."""
    return (aligned_wide.orderBy(id_col).limit(n)
            .select(id_col, shorten(text_col, width).alias("input"), "y_true", "y_base", "y_ft",
                    (F.col("y_true") == F.col("y_base")).alias("base_ok"),
                    (F.col("y_true") == F.col("y_ft")).alias("ft_ok")))
