"""Registered token / vocabulary / packing queries (K1-K8) and report
sources (S6-S8)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.text import word_tokens
from ..operators import prepare as pp
from ..operators import tokens as tk
from ..registry import get_task
from ..session import scratch_path
from ..sources import fixtures as fx
from ..sources import reports as rp
from ..sources.synthetic import synthetic
from ..sources.tables import read_table
from . import sqlparts as q
from .catalog import R6, _t01_frame, _T01_LABEL_SQL, r6, register

_T01 = get_task("01")
_T01_TEXT_SQL = f"""{q.LABELLED}, t01 AS (SELECT doc_id AS id, {q.SPLIT.format(c='doc_id')} AS split,
   {q.task_prompt(_T01, 'text', _T01_LABEL_SQL)} AS text FROM labelled)"""


def _t01_prepared(spark, sf):
    return pp.prepare_task(fx.with_split(_t01_frame(spark, sf), "id"), "01", keep=("id", "split"))


@register("k1_pretokenise", f"""
SELECT doc_id, CAST(len({q.tokens('text')}) AS BIGINT) AS n_tokens,
       CAST(len(regexp_extract_all(text, '[\\p{{L}}\\p{{N}}_]+')) AS BIGINT) AS n_words FROM documents
""")
def k1_pretokenise(spark, sf):
    d = read_table(spark, sf, "documents")
    return d.select("doc_id", F.size(word_tokens("text")).cast("long").alias("n_tokens"),
                    F.size(F.regexp_extract_all("text", F.lit(r"[\p{L}\p{N}_]+"), 0)).cast("long").alias("n_words"))


@register("k2_word_counts", f"""
SELECT word, CAST(count(*) AS BIGINT) AS freq FROM (SELECT unnest({q.tokens('text')}) AS word FROM documents) GROUP BY word
""")
def k2_word_counts(spark, sf):
    return tk.word_counts(read_table(spark, sf, "documents"))


@register("k3_pair_counts", f"""
WITH w AS (SELECT word, count(*) AS freq FROM (SELECT unnest({q.tokens('text')}) AS word FROM documents) GROUP BY word),
s AS (SELECT string_split(word, '') AS sy, freq FROM w WHERE length(word) >= 2),
p AS (SELECT unnest(list_transform(generate_series(1, len(sy) - 1), lambda i: {{'left': sy[i], 'right': sy[i + 1]}})) AS pr, freq FROM s)
SELECT pr['left'] AS "left", pr['right'] AS "right", CAST(sum(freq) AS BIGINT) AS count FROM p GROUP BY ALL
""")
def k3_pair_counts(spark, sf):
    w = tk.word_counts(read_table(spark, sf, "documents"))
    return tk.pair_counts(w.select("word", "freq", tk.symbols_of(F.col("word")).alias("symbols")))


def _bpe(spark, sf):
    return tk.train_bpe(tk.word_counts(read_table(spark, sf, "documents")))


@register("k4_train_bpe")
def k4_train_bpe(spark, sf):
    """Vocabulary learned from all documents (vocabulary size and special
    tokens of the recipes), as (rank, token) rows."""
    vocab, _merges = _bpe(spark, sf)
    return spark.createDataFrame(list(enumerate(vocab)), "rank int, token string")


@register("k5_bpe_encode")
def k5_bpe_encode(spark, sf):
    """Documents encoded with the vocabulary learned from them: ids per document."""
    vocab, merges = _bpe(spark, sf)
    d = read_table(spark, sf, "documents").withColumnRenamed("doc_id", "id")
    enc = tk.bpe_encode(d, "text", vocab, merges)
    return enc.select("id", F.size("ids").cast("long").alias("n_ids"),
                      F.size(F.filter("ids", lambda x: x == 0)).cast("long").alias("n_unk"))


@register("k6_length_stats", f"""
WITH {_T01_TEXT_SQL}, n AS (SELECT split, len({q.tokens('text')}) AS n FROM t01)
SELECT split, CAST(count(*) AS BIGINT) AS n, CAST(min(n) AS BIGINT) AS min_tokens, {R6('avg(n)')} AS mean_tokens,
       CAST(max(n) AS BIGINT) AS max_tokens, {R6('quantile_cont(n, 0.5)')} AS p50, {R6('quantile_cont(n, 0.9)')} AS p90,
       {R6('quantile_cont(n, 0.99)')} AS p99, {R6('avg(CASE WHEN n > 512 THEN 1.0 ELSE 0.0 END)')} AS share_over
FROM n GROUP BY split
""")
def k6_length_stats(spark, sf):
    p = _t01_prepared(spark, sf).select("split", F.size(word_tokens("text")).alias("n_tokens"))
    s = tk.length_stats(p, "n_tokens", _T01.max_tokens)
    return s.select("split", "n", "min_tokens", *[r6(F.col(c)).alias(c) for c in
                                                   ("mean_tokens", "max_tokens", "p50", "p90", "p99", "share_over")]) \
        .withColumn("max_tokens", F.col("max_tokens").cast("long"))


@register("k7_truncate", f"""
WITH {_T01_TEXT_SQL}
SELECT id, CAST(len({q.tokens('text')}) AS BIGINT) AS n_tokens,
       CAST(least(len({q.tokens('text')}), 512) AS BIGINT) AS n_kept,
       md5(array_to_string({q.tokens('text')}[1:512], ' ')) AS kept_md5 FROM t01
""")
def k7_truncate(spark, sf):
    p = _t01_prepared(spark, sf).select("id", word_tokens("text").alias("toks"))
    kept = tk.truncate_tokens(F.col("toks"), _T01.max_tokens)
    return p.select("id", F.size("toks").cast("long").alias("n_tokens"), F.size(kept).cast("long").alias("n_kept"),
                    F.md5(F.array_join(kept, " ")).alias("kept_md5"))


@register("k8_pack", f"""
WITH {_T01_TEXT_SQL}, e AS (SELECT id, len({q.tokens('text')}) + 1 AS l FROM t01),
c AS (SELECT l, sum(l) OVER (ORDER BY id) AS e FROM e),
x AS (SELECT e - l AS s, e, unnest(generate_series(CAST(floor((e - l) / 512) AS BIGINT), CAST(floor((e - 1) / 512) AS BIGINT))) AS block_id FROM c)
SELECT block_id, CAST(sum(least(e, (block_id + 1) * 512) - greatest(s, block_id * 512)) AS BIGINT) AS n_tokens,
       CAST(count(*) AS BIGINT) AS n_examples FROM x GROUP BY block_id
""")
def k8_pack(spark, sf):
    p = _t01_prepared(spark, sf).select("id", F.size(word_tokens("text")).alias("n_tokens"))
    return tk.pack(p, "n_tokens", _T01.max_tokens, ["id"])


@register("k8_pack_blocks", f"""
WITH {_T01_TEXT_SQL}, e AS (SELECT id, list_append({q.tokens('text')}, '[EOS]') AS tk FROM t01),
c AS (SELECT id, tk, sum(len(tk)) OVER (ORDER BY id) - len(tk) AS s FROM e),
x AS (SELECT id, unnest(tk) AS t, CAST(s AS BIGINT) + unnest(generate_series(0, len(tk) - 1)) AS pos FROM c),
p AS (SELECT pos // 512 AS block_id, id, min(pos) % 512 AS a, max(pos) % 512 + 1 AS z FROM x GROUP BY ALL),
ex AS (SELECT block_id, string_agg(id || ':' || a || ':' || z, ' ' ORDER BY a) AS examples FROM p GROUP BY block_id)
SELECT x.block_id, CAST(count(*) AS BIGINT) AS n_tokens, string_agg(t, ' ' ORDER BY pos) AS block, any_value(examples) AS examples
FROM (SELECT *, pos // 512 AS block_id FROM x) x JOIN ex USING (block_id) GROUP BY x.block_id
""")
def k8_pack_blocks(spark, sf):
    """The packed blocks themselves, with the part of each example in them."""
    p = _t01_prepared(spark, sf).select("id", word_tokens("text").alias("tokens"))
    blocks = tk.pack_blocks(p, "tokens", _T01.max_tokens, ["id"], "[EOS]")
    parts = F.transform("examples", lambda x: F.concat_ws(":", x["id"].cast("string"), x["start"].cast("string"), x["stop"].cast("string")))
    return blocks.select("block_id", F.size("tokens").cast("long").alias("n_tokens"), F.array_join("tokens", " ").alias("block"),
                         F.array_join(parts, " ").alias("examples"))


# ---------------------------------------------------------------- S6-S8

@register("s6_report_rollup", """
WITH r AS (SELECT 'run_' || user_id AS task_id,
                  CASE WHEN max(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) = 1 THEN 'FAILED' ELSE 'PASSED' END AS status,
                  sum(value) / 1000.0 AS elapsed_sec FROM events GROUP BY user_id)
SELECT status, CAST(count(*) AS BIGINT) AS n_runs, round(sum(elapsed_sec), 6) AS total_elapsed,
       round(max(elapsed_sec), 6) AS max_elapsed, arg_max(task_id, (elapsed_sec, task_id)) AS slowest FROM r GROUP BY status
""")
def s6_report_rollup(spark, sf):
    path = scratch_path(spark, "run-reports")
    rp.write_reports(rp.reports_from_events(read_table(spark, sf, "events")), path)
    return rp.report_rollup(spark, path)


@register("s7_run_log_explode", """
WITH e AS (SELECT user_id || '_' || strftime(ts, '%Y%m%d') AS run_id, ts, event_id, value / 100.0 AS loss,
                  CAST(json_extract(props, '$.k') AS BIGINT) + 1 AS k FROM events),
s AS (SELECT run_id, row_number() OVER (PARTITION BY run_id ORDER BY ts, event_id) AS step, loss,
             CAST(sum(k) OVER (PARTITION BY run_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS num_tokens
      FROM e)
SELECT run_id, CAST(step AS BIGINT) AS step, round(loss, 6) AS loss, round(num_tokens, 6) AS num_tokens,
       round(num_tokens - coalesce(lag(num_tokens) OVER (PARTITION BY run_id ORDER BY step), 0.0), 6) AS interval_tokens,
       round(exp(loss), 6) AS perplexity FROM s
""")
def s7_run_log_explode(spark, sf):
    path = scratch_path(spark, "run-logs")
    rp.write_logs(rp.logs_from_events(read_table(spark, sf, "events")), path)
    x = rp.explode_run_log(spark, path)
    return x.select("run_id", "step", *[r6(F.col(c)).alias(c) for c in
                                        ("loss", "num_tokens", "interval_tokens", "perplexity")])


@register("s8_synthetic_rows", """
SELECT doc_id AS i, 'Questo prodotto è ' || CASE doc_id % 3 WHEN 0 THEN 'ottimo' WHEN 1 THEN 'pessimo' ELSE 'nella media' END
       || '.' AS text, CAST(doc_id % 3 AS INTEGER) AS label,
       'Pagina ' || doc_id || ' del documento.' AS page_text,
       CASE WHEN doc_id % 5 = 0 THEN 'B-DOC' ELSE 'I-DOC' END AS page_label
FROM labels
""")
def s8_synthetic_rows(spark, sf):
    ids = read_table(spark, sf, "labels").select(F.col("doc_id").alias("i"))
    a = synthetic(ids, "01")
    b = synthetic(ids, "26").select("i", "page_text", F.col("label").alias("page_label"))
    return a.join(b, "i")
