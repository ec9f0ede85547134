"""Page streams and segmentation metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import null_to_empty
from .sequence import number_within


def page_pairs(pages: DataFrame, stream: str = "stream", page: str = "page", text: str = "text",
               lang: str = "lang") -> DataFrame:
    """Each page with the page before it in its stream; label 1 (B-DOC)
    when the page opens a document (first page, or the language changes).
    The page before comes with the numbering, without a join."""
    withprev = number_within(pages.select(stream, page, lang, text), [page], [stream], lags=[text, lang])
    pair = F.concat(F.lit("Pagina corrente: "), null_to_empty(F.col(text)), F.lit("\nPagina precedente: "),
                    null_to_empty(F.col("prev_" + text)))
    label = F.when(F.col("prev_" + lang).isNull() | (F.col("prev_" + lang) != F.col(lang)), 1).otherwise(0)
    return withprev.select(stream, page, "pos", pair.alias("pair_text"), label.alias("label"))


def number_events(b: DataFrame, stream: str = "stream", order=("ts", "event_id")) -> DataFrame:
    """Positions and running boundary counts per stream (distributed; see
    ``operators.sequence``): adds pos, cum_gold_b, cum_pred_b."""
    return number_within(b, list(order), [stream], sums=["gold_b", "pred_b"])


def boundaries_to_segments(numbered: DataFrame, cum: str = "cum_gold_b", stream: str = "stream") -> DataFrame:
    """Segment id = running count of boundaries; one row per segment."""
    return numbered.groupBy(stream, F.col(cum).alias("segment")).agg(
        F.min("pos").alias("start"), F.max("pos").alias("end"), F.count(F.lit(1)).alias("n"))


def boundary_prf(b: DataFrame, gold: str = "gold_b", pred: str = "pred_b") -> DataFrame:
    """Boundary precision/recall/F1 (row-level flags, no ordering)."""
    from .classes import f_beta, safe_div
    g, p = F.col(gold), F.col(pred)
    t = b.agg(F.sum(g * p).cast("long").alias("tp"), F.sum((1 - g) * p).cast("long").alias("fp"),
              F.sum(g * (1 - p)).cast("long").alias("fn"))
    pr = safe_div(F.col("tp"), F.col("tp") + F.col("fp"))
    rc = safe_div(F.col("tp"), F.col("tp") + F.col("fn"))
    return t.select("tp", "fp", "fn", pr.alias("precision"), rc.alias("recall"), f_beta(pr, rc).alias("f1"))


def stream_k(numbered: DataFrame, stream: str = "stream") -> DataFrame:
    """Per stream: k = half the mean gold segment length, rounded, at least 2."""
    s = numbered.groupBy(stream).agg(F.count(F.lit(1)).alias("n"),
                                     (F.max("cum_gold_b") - F.min("cum_gold_b") + 1).alias("n_seg"))
    return s.select(stream, "n", F.greatest(F.lit(2), F.round(F.col("n") / F.col("n_seg") / 2.0).cast("long")).alias("k"))


def segments_to_labels(segments: DataFrame, stream: str = "stream") -> DataFrame:
    """M27 back: one row per position, B-DOC where a segment starts, else I-DOC."""
    at = segments.select(stream, "start", F.explode_outer(F.sequence("start", "end")).alias("pos")).where(F.col("pos").isNotNull())
    return at.select(stream, "pos", F.when(F.col("pos") == F.col("start"), "B-DOC").otherwise("I-DOC").alias("label"))


def windows(numbered: DataFrame, stream: str = "stream", k: int | None = None) -> DataFrame:
    """Running counts at both ends of every window (g0, p0, gk, pk).

    Window i compares position i with position i + k of the same stream (k
    given, or per stream from ``stream_k``); streams shorter than k + 1 have no windows. Both ends are
    matched by an equi-join on (stream, position) — spread over all
    positions, so a hot stream is not one task. The per-stream k table is
    joined on the stream key; AQE's skew-join split handles a hot stream."""
    x = numbered.select(stream, "pos", "cum_gold_b", "cum_pred_b")
    x = x.withColumn("k", F.lit(k)) if k else x.join(stream_k(numbered, stream).select(stream, "k"), stream)
    ahead = x.select(stream, (F.col("pos") - F.col("k")).alias("pos"),
                     F.col("cum_gold_b").alias("g_k"), F.col("cum_pred_b").alias("p_k"))
    return x.join(ahead, [stream, "pos"]).select(F.col("cum_gold_b").alias("g0"), F.col("cum_pred_b").alias("p0"),
                                                 F.col("g_k").alias("gk"), F.col("p_k").alias("pk"))


def window_diff(numbered: DataFrame, stream: str = "stream", k: int | None = None) -> DataFrame:
    """M29 WindowDiff, pooled over all windows: the numbers of boundaries differ."""
    wrong = (F.col("gk") - F.col("g0")) != (F.col("pk") - F.col("p0"))
    return windows(numbered, stream, k).agg(F.count(F.lit(1)).alias("n_windows"), F.avg(wrong.cast("double")).alias("window_diff"))


def pk_metric(numbered: DataFrame, stream: str = "stream", k: int | None = None) -> DataFrame:
    """M30 Pk, pooled over all windows: the ends lie in one segment on one side only."""
    wrong = (F.col("gk") == F.col("g0")) != (F.col("pk") == F.col("p0"))
    return windows(numbered, stream, k).agg(F.count(F.lit(1)).alias("n_windows"), F.avg(wrong.cast("double")).alias("pk"))


def panoptic_quality(numbered: DataFrame, stream: str = "stream") -> DataFrame:
    """Panoptic quality of predicted against gold segments.

    Gold and predicted segments both partition a stream, so the overlap of a
    (gold, predicted) segment pair is the number of positions carrying both
    ids: one aggregation over positions, no range join. IoU > 0.5 matches."""
    inter = numbered.groupBy(stream, "cum_gold_b", "cum_pred_b").agg(F.count(F.lit(1)).alias("inter"))
    gs = numbered.groupBy(stream, "cum_gold_b").agg(F.count(F.lit(1)).alias("ng"))
    ps = numbered.groupBy(stream, "cum_pred_b").agg(F.count(F.lit(1)).alias("np"))
    j = inter.join(gs, [stream, "cum_gold_b"]).join(ps, [stream, "cum_pred_b"])
    iou = F.col("inter") / (F.col("ng") + F.col("np") - F.col("inter"))
    m = j.select(iou.alias("iou")).where(F.col("iou") > 0.5).agg(F.count(F.lit(1)).alias("tp"),
                                                                  F.sum("iou").alias("sum_iou"))
    n_g = gs.agg(F.count(F.lit(1)).alias("n_gold"))
    n_p = ps.agg(F.count(F.lit(1)).alias("n_pred"))
    allm = m.unionByName(n_g, allowMissingColumns=True).unionByName(n_p, allowMissingColumns=True).agg(
        F.max("tp").alias("tp"), F.max("sum_iou").alias("sum_iou"), F.max("n_gold").alias("n_gold"),
        F.max("n_pred").alias("n_pred"))
    fp = F.col("n_pred") - F.col("tp")
    fn = F.col("n_gold") - F.col("tp")
    den = F.col("tp") + fp / 2.0 + fn / 2.0
    return allm.select("tp", fp.alias("fp"), fn.alias("fn"),
                       F.when(den == 0, F.lit(0.0)).otherwise(F.coalesce(F.col("sum_iou"), F.lit(0.0)) / den).alias("pq"))
