"""Registered queries: one per inventory item, each with its DuckDB twin.

``QUERIES[name] = (builder, sql_or_None)``; builders take (spark, sf_dir) and
return a lazy DataFrame over the driver tables. Every numeric result is
rounded to 6 places on both sides; counts are BIGINT on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import prompts as pr
from ..functions import text as tx
from ..operators import classes as cl
from ..operators import prepare as pp
from ..registry import FALLBACK_EVALUATION, FALLBACK_TEST, FALLBACK_VALIDATION, TASKS, get_task
from ..session import scratch_path
from ..sources import fixtures as fx
from ..sources.tables import load_prepared, read_table, save_prepared, read_checked
from . import sqlparts as q

Builder = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, tuple[Builder, str | None]] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Builder) -> Builder:
        QUERIES[name] = (fn, sql)
        return fn
    return deco


def r6(c):
    return F.round(c.cast("double"), 6)


def R6(x: str) -> str:
    return f"round(CAST({x} AS DOUBLE), 6)"


# ---------------------------------------------------------------- sources (S)

@register("s1_read_source", "SELECT doc_id, lang, source, n_chars, CAST(length(text) AS BIGINT) AS text_len FROM documents")
def s1_read_source(spark, sf):
    df = pp_read(spark, sf, "02")
    return df.select("doc_id", "lang", "source", "n_chars", F.length("text").cast("long").alias("text_len"))


def pp_read(spark, sf, task_id, config=None):
    from ..sources.tables import read_source
    return read_source(spark, task_id, f"{sf}/documents.parquet", config)


@register("s1_read_csv", "SELECT o_orderkey, o_custkey, o_orderstatus, CAST(o_totalprice AS DOUBLE) AS o_totalprice FROM orders")
def s1_read_csv(spark, sf):
    """The orders written as CSV and read under a declared schema."""
    columns = "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double"
    path = scratch_path(spark, "orders-csv")
    read_table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", F.col("o_totalprice").cast("double").alias("o_totalprice")) \
        .write.option("header", "true").csv(path)
    return read_checked(spark, path, columns, "csv").rows


@register("s1_read_jsonl", """
SELECT 'row' AS kind, doc_id, lang, CAST(length(text) AS BIGINT) AS text_len, false AS cut FROM documents WHERE doc_id % 50 <> 0
UNION ALL SELECT 'broken', -1, '', 0, true FROM documents WHERE doc_id % 50 = 0
""")
def s1_read_jsonl(spark, sf):
    """The documents written as JSON lines, every 50th cut short, and read
    under a declared schema: whole rows, and the broken lines that are kept."""
    docs = read_table(spark, sf, "documents").select("doc_id", "lang", "text")
    line = F.to_json(F.struct("doc_id", "lang", "text"))
    path = scratch_path(spark, "documents-jsonl")
    docs.select(F.when(F.col("doc_id") % 50 == 0, F.left(line, F.length(line) - 2)).otherwise(line).alias("value")).write.text(path)
    rows, broken = read_checked(spark, path, "doc_id long, lang string, text string", "jsonl")
    return rows.select(F.lit("row").alias("kind"), "doc_id", "lang", F.length("text").cast("long").alias("text_len"), F.lit(False).alias("cut")).unionByName(
        broken.select(F.lit("broken").alias("kind"), F.lit(-1).cast("long").alias("doc_id"), F.lit("").alias("lang"),
                      F.lit(0).cast("long").alias("text_len"), (~F.col("line").endswith("}")).alias("cut")))


@register("s2_read_config", "SELECT doc_id, lang, n_chars FROM documents WHERE lang = 'fr'")
def s2_read_config(spark, sf):
    return pp_read(spark, sf, "02", config="fr").select("doc_id", "lang", "n_chars")


@register("s3_split_container", f"SELECT doc_id, {q.SPLIT.format(c='doc_id')} AS split FROM documents")
def s3_split_container(spark, sf):
    return fx.with_split(read_table(spark, sf, "documents").select("doc_id")).select("doc_id", "split")


_S4_SQL = f"""
WITH {q.LABELLED}, src AS (SELECT doc_id, {q.SPLIT.format(c='doc_id')} AS split FROM labelled),
tr AS (SELECT doc_id, split FROM src WHERE split = 'train')
SELECT doc_id, split FROM tr
UNION ALL SELECT doc_id, 'validation' FROM (SELECT doc_id FROM tr ORDER BY doc_id LIMIT {FALLBACK_VALIDATION})
UNION ALL SELECT doc_id, 'test' FROM (SELECT doc_id FROM tr ORDER BY doc_id LIMIT {FALLBACK_TEST})
"""


@register("s4_split_fallback", _S4_SQL)
def s4_split_fallback(spark, sf):
    """A source with only a train split: validation/test fall back to its head."""
    src = fx.with_split(fx.labelled(spark, sf)).select("doc_id", "split").where(F.col("split") == "train")
    val = pp.with_split_fallback(src, "validation", FALLBACK_VALIDATION, ["doc_id"])
    test = pp.with_split_fallback(src, "test", FALLBACK_TEST, ["doc_id"])
    return src.unionByName(val).unionByName(test)


_T_EVAL = get_task("02")
_EVAL_SQL = f"""
WITH {q.LABELLED}, src AS (SELECT doc_id AS id, {q.SPLIT.format(c='doc_id')} AS split, text FROM labelled),
test AS (SELECT id, text FROM src WHERE split = 'test' ORDER BY id LIMIT {FALLBACK_EVALUATION}),
head AS (SELECT id, text FROM src WHERE split = 'train' ORDER BY id LIMIT {FALLBACK_EVALUATION})
SELECT 'test' AS source, id, {q.inference('text', _T_EVAL.system_prompt, _T_EVAL.prefix)} AS prompt FROM test
UNION ALL SELECT 'train', id, {q.inference('text', _T_EVAL.system_prompt, _T_EVAL.prefix)} FROM head
"""


@register("s4_evaluation_prompts", _EVAL_SQL)
def s4_evaluation_prompts(spark, sf):
    """Evaluation input of a source with a test split, and of one without."""
    src = fx.with_split(fx.labelled(spark, sf)).select(F.col("doc_id").alias("id"), "split", F.col("text").alias(_T_EVAL.input_col))
    whole = pp.prepare_evaluation(src, "02", ["id"])
    bare = pp.prepare_evaluation(src.where(F.col("split") == "train"), "02", ["id"])
    return whole.select(F.lit("test").alias("source"), "id", "prompt").unionByName(bare.select(F.lit("train").alias("source"), "id", "prompt"))


_T25 = get_task("25")
_S5_SQL = f"""
WITH {q.LABELLED}
SELECT doc_id AS id, {q.SPLIT.format(c='doc_id')} AS split,
       {q.task_prompt(_T25, 'text', q.decode_passthrough('toxic', _T25.label_map))} AS text
FROM labelled
"""


@register("s5_save_prepared", _S5_SQL)
def s5_save_prepared(spark, sf):
    """Prepare task 25, write it partitioned by split under the shared
    checkpoint folder, read it back."""
    lab = fx.with_split(fx.labelled(spark, sf)).select(F.col("doc_id").alias("id"), "split", "text",
                                                       F.col("toxic").alias("label"))
    path = scratch_path(spark, "prepared-task25")
    save_prepared(pp.prepare_task(lab, "25"), path)
    return load_prepared(spark, path).select("id", "split", "text")


# ------------------------------------------------------------ transforms (P)

_T02 = get_task("02")


@register("p1_render_prompt", _S5_SQL.replace(f"{q.SPLIT.format(c='doc_id')} AS split,", ""))
def p1_render_prompt(spark, sf):
    lab = fx.labelled(spark, sf).select(F.col("doc_id").alias("id"), "text", F.col("toxic").alias("label"))
    return pp.prepare_task(lab, "25", keep=("id",))


_T21 = get_task("21")


@register("p2_render_without_system", f"""
WITH {q.PAIRS}
SELECT conv_id, turn, {q.task_prompt(_T21, 'reference', 'candidate')} AS text FROM pairs
""")
def p2_render_without_system(spark, sf):
    p = fx.pairs(spark, sf).select("conv_id", "turn", F.col("reference").alias("instruction"),
                                   F.col("candidate").alias("output"))
    return pp.prepare_task(p, "21", keep=("conv_id", "turn"))


@register("p3_render_inference", f"""
SELECT doc_id AS id, {q.inference('text', _T02.system_prompt, 'utt')} AS prompt FROM documents
""")
def p3_render_inference(spark, sf):
    d = read_table(spark, sf, "documents").select(F.col("doc_id").alias("id"), F.col("text").alias("utt"))
    return pp.prepare_inference(d, "02", prefix="utt")


@register("p4_render_pair", f"""
WITH {q.PAIRS}
SELECT conv_id, turn, '<start_of_turn>user' || chr(10) || reference || '<end_of_turn>' || chr(10) ||
       '<start_of_turn>model' || chr(10) || candidate || '<end_of_turn>' AS text FROM pairs
""")
def p4_render_pair(spark, sf):
    p = fx.pairs(spark, sf)
    return p.select("conv_id", "turn", pr.render_pair("reference", "candidate").alias("text"))


@register("p5_render_chat", """
SELECT conv_id, string_agg('<start_of_turn>' || role || chr(10) || text || '<end_of_turn>', chr(10) ORDER BY turn)
       || chr(10) || '<start_of_turn>model' || chr(10) AS text
FROM conversations GROUP BY conv_id
""")
def p5_render_chat(spark, sf):
    from ..operators.chat import render_chat
    return render_chat(read_table(spark, sf, "conversations"))


@register("p6_render_io", "SELECT doc_id, 'Input: ' || text || chr(10) || 'Output: risposta' AS text FROM documents")
def p6_render_io(spark, sf):
    d = read_table(spark, sf, "documents")
    return d.select("doc_id", pr.render_io("text").alias("text"))


_T01 = get_task("01")
_T01_LABEL_SQL = q.decode_default("CASE WHEN toxic = 1 THEN 2 ELSE quality END",
                                  {int(k): v for k, v in _T01.label_map.items()}, "neutro")


@register("p7_check_prompts", f"""
WITH {q.LABELLED}, pr AS (SELECT {q.task_prompt(_T01, 'text', _T01_LABEL_SQL)} AS text FROM labelled)
SELECT CAST(count(*) AS BIGINT) AS n,
       CAST(count(*) FILTER (WHERE contains(text, '<start_of_turn>user') AND contains(text, '<end_of_turn>')
            AND contains(text, '<start_of_turn>model')) AS BIGINT) AS n_valid,
       CAST(min(length(text)) AS BIGINT) AS min_len, CAST(max(length(text)) AS BIGINT) AS max_len,
       {R6('avg(length(text))')} AS avg_len
FROM pr
""")
def p7_check_prompts(spark, sf):
    from ..operators.quality import check_prompts
    prepared = pp.prepare_task(_t01_frame(spark, sf), "01", keep=("id",))
    return check_prompts(prepared)


def _t01_frame(spark, sf):
    lab = fx.labelled(spark, sf)
    return lab.select(F.col("doc_id").alias("id"), "text", "lang",
                      F.when(F.col("toxic") == 1, F.lit(2)).otherwise(F.col("quality")).alias("label"))


@register("p8_first_present", "SELECT doc_id, quality AS label, 2 AS polarity FROM labels")
def p8_first_present(spark, sf):
    lab = read_table(spark, sf, "labels")
    return lab.select("doc_id",
                      tx.first_present(lab.columns, ["label", "polarity", "quality"], 2).alias("label"),
                      tx.first_present(lab.columns, ["polarity", "stars"], 2).alias("polarity"))


@register("p9_first_nonempty", f"""
SELECT doc_id, coalesce(nullif({q.strip("CASE WHEN doc_id % 3 = 0 THEN '  ' || chr(9) ELSE ' ' || source || chr(10) END")}, ''),
                        nullif({q.strip('text')}, ''), '') AS value FROM documents
""")
def p9_first_nonempty(spark, sf):
    d = read_table(spark, sf, "documents")
    title = F.when(F.pmod("doc_id", F.lit(3)) == 0, F.lit("  \t")).otherwise(
        F.concat(F.lit(" "), F.col("source"), F.lit("\n")))
    return d.select("doc_id", tx.first_nonempty(title, F.col("text")).alias("value"))


@register("p10_strip", f"""
SELECT doc_id, {q.strip("chr(10) || chr(9) || ' ' || lang || ' ' || chr(10)")} AS value,
       {q.strip('text')} = text AS unchanged FROM documents
""")
def p10_strip(spark, sf):
    d = read_table(spark, sf, "documents")
    padded = F.concat(F.lit("\n\t "), F.col("lang"), F.lit(" \n"))
    return d.select("doc_id", tx.strip(padded).alias("value"), (tx.strip("text") == F.col("text")).alias("unchanged"))


_P11_CODE = "quality + 2 * toxic - CASE WHEN doc_id % 5 = 0 THEN 2 ELSE 0 END"


@register("p11_decode_default", f"""
SELECT doc_id, {q.decode_default(_P11_CODE, {int(k): v for k, v in _T01.label_map.items()}, 'neutro')} AS label
FROM labels
""")
def p11_decode_default(spark, sf):
    lab = read_table(spark, sf, "labels")
    code = F.col("quality") + 2 * F.col("toxic") - F.when(F.pmod("doc_id", F.lit(5)) == 0, 2).otherwise(0)
    return lab.select("doc_id", tx.decode_label(code, {int(k): v for k, v in _T01.label_map.items()},
                                                "neutro").alias("label"))


_T03 = get_task("03")
_P12_RAW = "CASE WHEN doc_id % 7 = 0 THEN '-1' ELSE CAST(doc_id % 6 AS VARCHAR) END"


@register("p12_decode_passthrough", f"SELECT doc_id, {q.decode_passthrough(_P12_RAW, _T03.label_map)} AS label FROM documents")
def p12_decode_passthrough(spark, sf):
    d = read_table(spark, sf, "documents")
    raw = F.when(F.pmod("doc_id", F.lit(7)) == 0, F.lit("-1")).otherwise(F.pmod("doc_id", F.lit(6)).cast("string"))
    return d.select("doc_id", tx.decode_passthrough(raw, _T03.label_map).alias("label"))


@register("p13_stars_to_class", """
SELECT doc_id, CASE WHEN doc_id % 5 + 1 IN (1, 2) THEN 'negativo' WHEN doc_id % 5 + 1 = 3 THEN 'neutro'
                    WHEN doc_id % 5 + 1 IN (4, 5) THEN 'positivo' ELSE 'neutro' END AS label FROM documents
""")
def p13_stars_to_class(spark, sf):
    d = read_table(spark, sf, "documents")
    return d.select("doc_id", tx.stars_to_class(F.pmod("doc_id", F.lit(5))).alias("label"))


@register("p14_drop_columns", f"""
SELECT doc_id AS id, {q.task_prompt(_T03, 'text', q.decode_passthrough('doc_id % 4', _T03.label_map))} AS text
FROM documents
""")
def p14_drop_columns(spark, sf):
    d = read_table(spark, sf, "documents")
    src = d.select(F.col("doc_id").alias("id"), "text", F.pmod("doc_id", F.lit(4)).alias("label"), "lang", "source")
    return pp.prepare_task(src, "03", keep=("id",))


@register("p15_nested_fields", f"""
SELECT doc_id, source AS answer, array_to_string({q.tokens('text')}, ' ') AS sentence, lang AS target FROM documents
""")
def p15_nested_fields(spark, sf):
    d = read_table(spark, sf, "documents")
    nested = d.select("doc_id",
                      F.struct(F.array("source", "lang").alias("text"),
                               F.array(F.lit(0), F.lit(1)).alias("answer_start")).alias("answers"),
                      tx.word_tokens("text").alias("tokens"),
                      F.struct(F.col("text").alias("en"), F.col("lang").alias("it")).alias("translation"))
    return nested.select("doc_id", pp.as_text(nested, "answers", "label").alias("answer"),
                         pp.as_text(nested, "tokens").alias("sentence"),
                         pp.as_text(nested, "translation", "label").alias("target"))


@register("p16_shorten", """
SELECT doc_id, CASE WHEN length(text) > 80 THEN substring(text, 1, 80) || '...' ELSE text END AS s80,
       CASE WHEN length(source) > 3 THEN substring(source, 1, 3) || '...' ELSE source END AS s3 FROM documents
""")
def p16_shorten(spark, sf):
    d = read_table(spark, sf, "documents")
    return d.select("doc_id", tx.shorten("text", 80).alias("s80"), tx.shorten("source", 3).alias("s3"))


@register("p17_check_columns", f"""
WITH {q.LABELLED}
SELECT 'text' AS column_name, true AS present, CAST(count(*) FILTER (WHERE text IS NULL) AS BIGINT) AS n_null FROM labelled
UNION ALL SELECT 'quality', true, CAST(count(*) FILTER (WHERE quality IS NULL) AS BIGINT) FROM labelled
UNION ALL SELECT 'label', false, CAST(0 AS BIGINT)
UNION ALL SELECT 'polarity', false, CAST(0 AS BIGINT)
""")
def p17_check_columns(spark, sf):
    from ..operators.quality import check_columns
    return check_columns(fx.labelled(spark, sf), ["text", "quality", "label", "polarity"])


@register("p18_first_column_fallback", f"""
SELECT item_id, 'Input: ' || CASE WHEN item_id % 4 = 0 THEN CAST(item_id AS VARCHAR) ELSE text END || chr(10) || 'Output: risposta' AS text FROM benchmark
""")
def p18_first_column_fallback(spark, sf):
    # every fourth text is blank: there the first column is used
    b = read_table(spark, sf, "benchmark").select("item_id", F.when(F.pmod("item_id", F.lit(4)) == 0, "  ").otherwise(F.col("text")).alias("text"))
    inp = pp.resolve_input(b, get_task("06"))
    return b.select("item_id", pr.render_io(inp).alias("text"))


@register("p19_normalise_prediction", """
SELECT conv_id, turn, CASE WHEN contains(lower(text), 'pos') THEN 'positivo'
                           WHEN contains(lower(text), 'neg') THEN 'negativo' ELSE 'neutro' END AS label
FROM conversations
""")
def p19_normalise_prediction(spark, sf):
    c = read_table(spark, sf, "conversations")
    return c.select("conv_id", "turn", tx.normalise_prediction("text").alias("label"))


@register("p20_strip_answer", f"""
SELECT conv_id, turn, {q.strip("' ' || chr(10) || text || chr(9) || '  '")} = text AS same FROM conversations
""")
def p20_strip_answer(spark, sf):
    c = read_table(spark, sf, "conversations")
    decoded = F.concat(F.lit(" \n"), F.col("text"), F.lit("\t  "))
    return c.select("conv_id", "turn", (tx.strip(decoded) == F.col("text")).alias("same"))


@register("p21_language_filter", """
SELECT source, CAST(count(*) AS BIGINT) AS n_docs, CAST(sum(n_chars) AS BIGINT) AS n_chars
FROM documents WHERE lang = 'de' GROUP BY source
""")
def p21_language_filter(spark, sf):
    d = read_table(spark, sf, "documents").where(F.col("lang") == "de")
    return d.groupBy("source").agg(F.count(F.lit(1)).alias("n_docs"), F.sum("n_chars").cast("long").alias("n_chars"))


P22_SQL = """
SELECT l_orderkey AS table_id,
  '| l_linenumber | l_partkey | l_quantity | l_returnflag |' || chr(10) || '| --- | --- | --- | --- |' || chr(10) ||
  string_agg(line, chr(10) ORDER BY l_linenumber, line) AS markdown
FROM (SELECT l_orderkey, l_linenumber, '| ' || CAST(l_linenumber AS VARCHAR) || ' | ' || CAST(l_partkey AS VARCHAR) || ' | ' ||
             CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) || ' | ' || l_returnflag || ' |' AS line FROM lineitem)
GROUP BY l_orderkey
"""


@register("p22_table_markdown", P22_SQL)
def p22_table_markdown(spark, sf):
    from ..operators.chat import render_table_markdown
    li = read_table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", F.col("l_quantity").cast("long").alias("l_quantity"),
        "l_returnflag")
    return render_table_markdown(li, "l_orderkey", "l_linenumber",
                                 ["l_linenumber", "l_partkey", "l_quantity", "l_returnflag"])


@register("p23_render_options", f"""
SELECT doc_id, array_to_string(list_transform(string_split(text, chr(10)),
       lambda x, i: {q.option_label('(i - 1)')} || ') ' || x), chr(10)) AS options FROM documents
""")
def p23_render_options(spark, sf):
    d = read_table(spark, sf, "documents")
    return d.select("doc_id", pr.render_options(F.split("text", "\n")).alias("options"))


@register("p24_render_inputs", f"""
WITH {q.PAIRS}
SELECT conv_id, turn, 'Premessa: ' || {q.strip('reference')} || chr(10) || 'Ipotesi: ' || {q.strip('candidate')} AS text
FROM pairs
""")
def p24_render_inputs(spark, sf):
    p = fx.pairs(spark, sf)
    return p.select("conv_id", "turn",
                    pr.render_inputs(["reference", "candidate"], ["Premessa", "Ipotesi"]).alias("text"))


# --------------------------------------------------------- caps, mixes (L, U)

_L1_SQL = f"""
WITH ev AS (SELECT event_id, {q.SPLIT.format(c='event_id')} AS split FROM events),
r AS (SELECT *, row_number() OVER (PARTITION BY split ORDER BY event_id) AS rn FROM ev)
SELECT event_id, split FROM r
WHERE (split = 'train' AND rn <= {_T01.train_cap}) OR (split = 'validation' AND rn <= {_T01.val_cap})
   OR (split = 'test' AND rn <= {_T01.eval_cap})
"""


@register("l1_cap_splits", _L1_SQL)
def l1_cap_splits(spark, sf):
    ev = fx.with_split(read_table(spark, sf, "events").select("event_id"), "event_id")
    caps = {"train": _T01.train_cap, "validation": _T01.val_cap, "test": _T01.eval_cap}
    return pp.cap_splits(ev, caps, ["event_id"])


@register("l2_cap_by_ratio", """
WITH en AS (SELECT doc_id FROM documents WHERE lang = 'en'),
oth AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS rn FROM documents WHERE lang <> 'en')
SELECT doc_id FROM oth WHERE rn < (SELECT floor(count(*) * 3 / 7) FROM en)
""")
def l2_cap_by_ratio(spark, sf):
    d = read_table(spark, sf, "documents")
    return pp.head_by_ratio(d.where(F.col("lang") == "en"), d.where(F.col("lang") != "en").select("doc_id"),
                            3, 7, ["doc_id"])


@register("l3_head_sample", """
SELECT doc_id, CASE WHEN length(text) > 60 THEN substring(text, 1, 60) || '...' ELSE text END AS input
FROM documents ORDER BY doc_id LIMIT 10
""")
def l3_head_sample(spark, sf):
    d = read_table(spark, sf, "documents")
    return pp.cap(d, 10, ["doc_id"]).select("doc_id", tx.shorten("text", 60).alias("input"))


@register("l4_top_classes", f"""
SELECT source, CAST(count(*) AS BIGINT) AS n, min(doc_id) AS first_id,
       {R6('count(*) / (SELECT count(*) FROM documents)')} AS share
FROM documents GROUP BY source ORDER BY first_id LIMIT 15
""")
def l4_top_classes(spark, sf):
    d = read_table(spark, sf, "documents")
    out = cl.distribution(d, "source", id_col="doc_id", top=15)
    return out.select("source", "n", "first_id", r6(F.col("share")).alias("share"))


@register("u1_concatenate", "SELECT doc_id, lang FROM documents WHERE lang = 'en' UNION ALL SELECT doc_id, lang FROM documents WHERE lang = 'fr'")
def u1_concatenate(spark, sf):
    d = read_table(spark, sf, "documents").select("doc_id", "lang")
    return d.where(F.col("lang") == "en").unionByName(d.where(F.col("lang") == "fr"))


_U2_SQL = f"""
WITH {q.LABELLED}, lab AS (SELECT doc_id AS id, {q.SPLIT.format(c='doc_id')} AS split, lang FROM labelled),
en AS (SELECT * FROM lab WHERE lang = 'en'), oth AS (SELECT * FROM lab WHERE lang <> 'en'),
ranked AS (SELECT *, row_number() OVER (ORDER BY id) - 1 AS rn FROM oth WHERE split = 'train'),
mixed AS (
  SELECT id, split, lang FROM en WHERE split = 'train'
  UNION ALL SELECT id, split, lang FROM ranked WHERE rn < (SELECT floor(count(*) * 3 / 7) FROM en WHERE split = 'train')
  UNION ALL SELECT id, split, lang FROM en WHERE split = 'validation'
  UNION ALL SELECT id, 'validation', lang FROM (SELECT * FROM en WHERE split = 'train' ORDER BY id LIMIT {FALLBACK_VALIDATION})
            WHERE NOT EXISTS (SELECT 1 FROM en WHERE split = 'validation')
  UNION ALL SELECT id, split, lang FROM en WHERE split = 'test'
  UNION ALL SELECT id, 'test', lang FROM (SELECT * FROM en WHERE split = 'train' ORDER BY id LIMIT {FALLBACK_TEST})
            WHERE NOT EXISTS (SELECT 1 FROM en WHERE split = 'test'))
SELECT id, split, lang FROM mixed
"""


def _mixed(spark: SparkSession, sf: str) -> DataFrame:
    """documents ⋈ labels → split → strip/decode/render (task 01) → 70/30 mix
    of English and the other languages."""
    lab = fx.with_split(_t01_frame(spark, sf), "id")
    prepared = pp.prepare_task(lab, "01", keep=("id", "split", "lang"))
    # written once, partitioned by (split, lang): every branch of the mix
    # below reads only the partitions its filter names
    path = scratch_path(spark, "prepared-task01")
    save_prepared(prepared, path, ["split", "lang"])
    stored = load_prepared(spark, path)
    en = stored.where(F.col("lang") == "en")
    other = stored.where(F.col("lang") != "en")
    return pp.mix([en, other], [7, 3], ["id"])


def flagship(spark: SparkSession, sf: str) -> DataFrame:
    """Rows per split and language of the mix."""
    return pp.split_stats(_mixed(spark, sf), ["split", "lang"])


@register("u2_ratio_mix", _U2_SQL)
def u2_ratio_mix(spark, sf):
    return _mixed(spark, sf).select("id", "split", "lang")


@register("u3_choose_source", "SELECT item_id, CAST(length(text) AS BIGINT) AS text_len FROM benchmark")
def u3_choose_source(spark, sf):
    sources = {"documents": read_table(spark, sf, "documents"), "benchmark": read_table(spark, sf, "benchmark")}
    b = pp.choose_source("benchmark", sources)
    return b.select("item_id", F.length("text").cast("long").alias("text_len"))


# ------------------------------------------------------ class metrics (J, A)

def _long(spark, sf):
    return cl.stack_systems(fx.preds(spark, sf).join(read_table(spark, sf, "documents").select(
        F.col("doc_id").alias("example_id"), "lang"), "example_id"), ["base", "ft"], extra=["lang"])


@register("a1_split_counts", f"""
WITH {q.PREDS}
SELECT {q.SPLIT.format(c='example_id')} AS split, CAST(count(*) AS BIGINT) AS n_rows FROM preds GROUP BY 1
""")
def a1_split_counts(spark, sf):
    return pp.split_stats(fx.with_split(fx.preds(spark, sf), "example_id"))


@register("a2_accuracy", f"""
WITH {q.PREDS}
SELECT system, {R6("avg(CASE WHEN y_true = y_pred THEN 1.0 ELSE 0.0 END)")} AS accuracy,
       CAST(count(*) AS BIGINT) AS n FROM long GROUP BY system
""")
def a2_accuracy(spark, sf):
    a = cl.accuracy(_long(spark, sf))
    return a.select("system", r6(F.col("accuracy")).alias("accuracy"), "n")


_CONF_SQL = f"""
WITH {q.PREDS},
conf AS (SELECT system, y_true, y_pred, count(*) AS n FROM long GROUP BY ALL),
cells AS (SELECT system, y_true AS label, n AS g, 0 AS pp, CASE WHEN y_true = y_pred THEN n ELSE 0 END AS tp FROM conf
          UNION ALL SELECT system, y_pred, 0, n, 0 FROM conf),
cnt AS (SELECT system, label, sum(tp) AS tp, sum(g) AS support, sum(pp) AS n_pred FROM cells WHERE label IS NOT NULL GROUP BY ALL),
sc AS (SELECT *, CASE WHEN n_pred = 0 THEN 0.0 ELSE tp / n_pred END AS precision,
              CASE WHEN support = 0 THEN 0.0 ELSE tp / support END AS recall FROM cnt),
sc2 AS (SELECT *, CASE WHEN precision + recall = 0 THEN 0.0 ELSE 2 * precision * recall / (precision + recall) END AS f1 FROM sc)
"""


@register("a3_macro_f1_labels", _CONF_SQL + f"""
SELECT system, {R6("sum(f1) / 3.0")} AS macro_f1 FROM sc2 WHERE label IN ('0', '1', '2') GROUP BY system
""")
def a3_macro_f1_labels(spark, sf):
    m = cl.macro_f1(_long(spark, sf), labels=["0", "1", "2"])
    return m.select("system", r6(F.col("macro_f1")).alias("macro_f1"))


@register("a4_macro_f1_found", _CONF_SQL + f"""
SELECT system, {R6("avg(f1)")} AS macro_f1 FROM sc2 GROUP BY system
""")
def a4_macro_f1_found(spark, sf):
    m = cl.macro_f1(_long(spark, sf))
    return m.select("system", r6(F.col("macro_f1")).alias("macro_f1"))


@register("a5_class_report", _CONF_SQL + f"""
SELECT system, label AS row, {R6('precision')} AS precision, {R6('recall')} AS recall, {R6('f1')} AS f1,
       CAST(support AS BIGINT) AS support FROM sc2
UNION ALL SELECT system, 'macro avg', {R6('avg(precision)')}, {R6('avg(recall)')}, {R6('avg(f1)')},
       CAST(sum(support) AS BIGINT) FROM sc2 GROUP BY system
UNION ALL SELECT system, 'weighted avg', {R6('sum(precision * support) / sum(support)')},
       {R6('sum(recall * support) / sum(support)')}, {R6('sum(f1 * support) / sum(support)')},
       CAST(sum(support) AS BIGINT) FROM sc2 GROUP BY system
UNION ALL SELECT system, 'accuracy', {R6('sum(tp) / sum(n_pred)')}, {R6('sum(tp) / sum(support)')},
       {R6('2 * (sum(tp) / sum(n_pred)) * (sum(tp) / sum(support)) / ((sum(tp) / sum(n_pred)) + (sum(tp) / sum(support)))')},
       CAST(sum(support) AS BIGINT) FROM sc2 GROUP BY system
""")
def a5_class_report(spark, sf):
    rep = cl.class_report(_long(spark, sf))
    return rep.select("system", "row", *[r6(F.col(c)).alias(c) for c in ("precision", "recall", "f1")], "support")


@register("a6_delta_report", _CONF_SQL + f""",
m AS (SELECT system, 'accuracy' AS metric, avg(CASE WHEN y_true = y_pred THEN 1.0 ELSE 0.0 END) AS value FROM long GROUP BY system
      UNION ALL SELECT system, 'macro_f1', avg(f1) FROM sc2 GROUP BY system)
SELECT b.metric, {R6('b.value')} AS base, {R6('f.value')} AS tuned, {R6('f.value - b.value')} AS delta
FROM m b JOIN m f ON b.metric = f.metric AND b.system = 'base' AND f.system = 'ft'
""")
def a6_delta_report(spark, sf):
    d = cl.delta_report(_long(spark, sf))
    return d.select("metric", *[r6(F.col(c)).alias(c) for c in ("base", "tuned", "delta")])


@register("a7_distribution", f"""
WITH {q.PREDS}
SELECT y_ft AS label, CAST(count(*) AS BIGINT) AS n, {R6('count(*) / (SELECT count(*) FROM preds)')} AS share
FROM preds GROUP BY y_ft
""")
def a7_distribution(spark, sf):
    d = cl.distribution(fx.preds(spark, sf), "y_ft")
    return d.select(F.col("y_ft").alias("label"), "n", r6(F.col("share")).alias("share"))


@register("a8_grouped_accuracy", f"""
WITH {q.PREDS}
SELECT lang, CAST(grouping(lang) AS INTEGER) AS is_total, CAST(count(*) AS BIGINT) AS n,
       {R6("avg(CASE WHEN y_true = y_pred THEN 1.0 ELSE 0.0 END)")} AS accuracy
FROM long WHERE system = 'ft' GROUP BY ROLLUP (lang)
""")
def a8_grouped_accuracy(spark, sf):
    g = cl.grouped_accuracy(_long(spark, sf).where(F.col("system") == "ft"), "lang")
    return g.select("lang", "is_total", "n", r6(F.col("accuracy")).alias("accuracy"))


@register("a9_class_recall", f"""
WITH {q.PREDS}
SELECT system, {R6("avg(CASE WHEN y_pred = '0' THEN 1.0 ELSE 0.0 END)")} AS recall, CAST(count(*) AS BIGINT) AS support
FROM long WHERE y_true = '0' GROUP BY system
""")
def a9_class_recall(spark, sf):
    r = cl.class_recall(_long(spark, sf), "0")
    return r.select("system", r6(F.col("recall")).alias("recall"), "support")


_A10_GOLD = "list_filter(['quality', 'toxic'], lambda x, i: (i = 1 AND quality = 1) OR (i = 2 AND toxic = 1))"
_A10_PRED = "list_filter(['quality', 'toxic'], lambda x, i: (i = 1 AND doc_id % 2 = 1) OR (i = 2 AND n_chars >= 1400))"


@register("a10_hamming_loss", f"""
WITH {q.LABELLED}, s AS (SELECT {_A10_GOLD} AS g, {_A10_PRED} AS p FROM labelled)
SELECT {R6("avg(len(list_filter(g, lambda x: NOT list_contains(p, x))) + len(list_filter(p, lambda x: NOT list_contains(g, x)))) / 2.0")}
       AS hamming_loss, CAST(count(*) AS BIGINT) AS n FROM s
""")
def a10_hamming_loss(spark, sf):
    lab = fx.labelled(spark, sf)

    def labelset(q_flag, t_flag):
        return F.filter(F.array(F.when(q_flag, F.lit("quality")), F.when(t_flag, F.lit("toxic"))),
                        lambda x: x.isNotNull())
    s = lab.select(labelset(F.col("quality") == 1, F.col("toxic") == 1).alias("g"),
                   labelset(F.pmod("doc_id", F.lit(2)) == 1, F.col("n_chars") >= 1400).alias("p"))
    h = cl.hamming_loss(s, "g", "p", 2)
    return h.select(r6(F.col("hamming_loss")).alias("hamming_loss"), "n")


@register("j1_align", f"""
WITH {q.PREDS},
pl0 AS (SELECT 'base' AS system, example_id, y_base AS y_pred FROM preds
       UNION ALL SELECT 'base', example_id, y_base || 'x' FROM preds WHERE example_id % 11 = 0
       UNION ALL SELECT 'ft', example_id, y_ft FROM preds WHERE example_id % 13 <> 0),
pl AS (SELECT system, example_id, CASE WHEN count(DISTINCT y_pred) = 1 THEN any_value(y_pred) END AS y_pred, count(*) AS k FROM pl0 GROUP BY ALL),
g AS (SELECT example_id, y_true FROM preds),
al AS (SELECT s.system, g.example_id, g.y_true, pl.y_pred, pl.k FROM g CROSS JOIN (VALUES ('base'), ('ft')) s(system)
       LEFT JOIN pl ON pl.system = s.system AND pl.example_id = g.example_id)
SELECT system, CAST(count(*) AS BIGINT) AS n, CAST(count(y_pred) AS BIGINT) AS n_predicted,
       CAST(count(*) FILTER (WHERE k > 1) AS BIGINT) AS n_repeated,
       {R6("avg(CASE WHEN y_true = y_pred THEN 1.0 ELSE 0.0 END)")} AS accuracy FROM al GROUP BY system
""")
def j1_align(spark, sf):
    p = fx.preds(spark, sf)
    preds_long = (p.select(F.lit("base").alias("system"), "example_id", F.col("y_base").alias("y_pred"))
                  .unionByName(p.where(F.pmod("example_id", F.lit(11)) == 0).select(
                      F.lit("base").alias("system"), "example_id", F.concat("y_base", F.lit("x")).alias("y_pred")))
                  .unionByName(p.where(F.pmod("example_id", F.lit(13)) != 0)
                               .select(F.lit("ft").alias("system"), "example_id", F.col("y_ft").alias("y_pred"))))
    al = cl.align(p.select("example_id", "y_true"), preds_long, ["base", "ft"])
    hit = F.when(F.col("y_true") == F.col("y_pred"), F.lit(1.0)).otherwise(F.lit(0.0))
    return al.groupBy("system").agg(F.count(F.lit(1)).alias("n"), F.count("y_pred").alias("n_predicted"),
                                    F.count_if(F.col("n_predictions") > 1).alias("n_repeated"), r6(F.avg(hit)).alias("accuracy"))


@register("j2_compare", f"""
WITH {q.PREDS}
SELECT example_id, CASE WHEN length(text) > 60 THEN substring(text, 1, 60) || '...' ELSE text END AS input,
       y_true, y_base, y_ft, y_true = y_base AS base_ok, y_true = y_ft AS ft_ok
FROM preds ORDER BY example_id LIMIT 10
""")
def j2_compare(spark, sf):
    p = fx.preds(spark, sf).join(fx.labelled(spark, sf).select(F.col("doc_id").alias("example_id"), "text"),
                                 "example_id")
    return cl.compare(p, "text", n=10, width=60)


@register("j3_label_table_join", f"""
SELECT doc_id, coalesce(m.word, 'unknown') AS label
FROM documents d LEFT JOIN (VALUES {', '.join(f"({k}, {q.lit(v)})" for k, v in _T03.label_map.items())}) m(code, word)
  ON d.doc_id % 5 = m.code
""")
def j3_label_table_join(spark, sf):
    from ..registry import registry_label_table
    d = read_table(spark, sf, "documents").select("doc_id", F.pmod("doc_id", F.lit(5)).alias("code"))
    labels = registry_label_table(spark, "03")  # 4 rows from the registry: bounded, broadcast
    j = d.join(F.broadcast(labels), d["code"] == labels["code_int"], "left")
    return j.select("doc_id", F.coalesce(F.col("word"), F.lit("unknown")).alias("label"))


# ------------------------------------------------------- task preparation (T)

def _docs(spark, sf):
    return fx.with_split(read_table(spark, sf, "documents").withColumnRenamed("doc_id", "id"), "id")


def _pairs(spark, sf):
    p = fx.pairs(spark, sf)
    return p.select(F.concat_ws("-", "conv_id", "turn").alias("id"), "reference", "candidate", "conv_id")


_TASK_BUILDERS: dict[str, tuple[Callable, str, str, str]] = {}


def _task(tid: str, src: str, inp_sql: str, lab_sql: str):
    def deco(fn):
        _TASK_BUILDERS[tid] = (fn, src, inp_sql, lab_sql)
        return fn
    return deco


_DOCS_SQL = f"(SELECT doc_id AS id, {q.SPLIT.format(c='doc_id')} AS split, * FROM documents) s"
_LAB_SQL = f"(SELECT doc_id AS id, {q.SPLIT.format(c='doc_id')} AS split, * FROM labelled) s"
_PAIRS_SQL = "(SELECT conv_id || '-' || turn AS id, * FROM pairs) s"


def _two_inputs(tid: str, labels: tuple[str, str], answer_sql: str, answer):
    """A query of one task with both of its inputs, each under its label."""
    task = get_task(tid)
    both = f"'{labels[0]}: ' || {q.strip('reference')} || chr(10) || '{labels[1]}: ' || {q.strip('candidate')}"

    def fn(spark, sf):
        p = fx.pairs(spark, sf).select(F.concat_ws("-", "conv_id", "turn").alias("id"), F.col("reference").alias("first"),
                                       F.col("candidate").alias("second"), answer().alias(task.label_col))
        return pp.prepare_task(p, tid, keep=("id",), inputs=[("first", labels[0]), ("second", labels[1])])

    fn.__name__ = f"t{tid}_two_inputs"
    register(fn.__name__, f"WITH {q.PAIRS} SELECT conv_id || '-' || turn AS id, {q.task_prompt(task, both, answer_sql)} AS text FROM pairs")(fn)


_two_inputs("04", ("Premessa", "Ipotesi"), q.decode_passthrough("(conv_id % 4)", get_task("04").label_map), lambda: F.pmod("conv_id", F.lit(4)))
_two_inputs("07", ("Contesto", "Domanda"), "coalesce(reference2, '')", lambda: F.col("reference2"))
_two_inputs("24", ("Affermazione", "Evidenza"), q.decode_passthrough("(conv_id % 4)", get_task("24").label_map), lambda: F.pmod("conv_id", F.lit(4)))


def _with_inputs(tid: str, source: str, inputs: list[tuple[str, str, str]], answer_sql: str):
    """A query of one task with all its inputs: (label, column, SQL) each; the
    function gives the rows (id, the columns, the task's label column)."""
    def deco(fn):
        task = get_task(tid)
        text = " || chr(10) || ".join(f"'{lab}: ' || {q.strip(q.nz(sql))}" for lab, _c, sql in inputs)

        def build(spark, sf):
            return pp.prepare_task(fn(spark, sf), tid, keep=("id",), inputs=[(c, lab) for lab, c, _sql in inputs])

        build.__name__ = f"t{tid}_all_inputs"
        register(build.__name__, f"WITH {q.PAIRS} SELECT id, {q.task_prompt(task, text, answer_sql)} AS text FROM ({source}) s")(build)
        return fn
    return deco


_OPTIONS_SQL = f"array_to_string(list_transform(string_split(candidate, '. '), lambda x, i: {q.option_label('(i - 1)')} || ') ' || x), chr(10))"


@_with_inputs("05", "SELECT conv_id || '-' || turn AS id, * FROM pairs",
              [("Testo", "article", "reference"), ("Domanda", "question", "reference2"), ("Opzioni", "options", _OPTIONS_SQL)],
              "chr(CAST(65 + conv_id % 4 AS INTEGER))")
def _t05_inputs(spark, sf):
    return fx.pairs(spark, sf).select(
        F.concat_ws("-", "conv_id", "turn").alias("id"), F.col("reference").alias("article"), F.col("reference2").alias("question"),
        pr.render_options(F.split("candidate", r"\. ", -1)).alias("options"), F.chr(F.lit(65) + F.pmod("conv_id", F.lit(4))).alias("answer"))


@_with_inputs("15", "SELECT p_partkey AS id, * FROM part",
              [("Schema", "schema", "'part(p_partkey, p_name, p_brand, p_size) -- ' || p_brand"), ("Domanda", "question", "'Quali parti hanno p_size = ' || p_size || '?'")],
              "'SELECT p_name FROM part WHERE p_size = ' || p_size")
def _t15_inputs(spark, sf):
    size = F.col("p_size").cast("string")
    return read_table(spark, sf, "part").select(
        F.col("p_partkey").alias("id"), F.concat(F.lit("part(p_partkey, p_name, p_brand, p_size) -- "), "p_brand").alias("schema"),
        F.concat(F.lit("Quali parti hanno p_size = "), size, F.lit("?")).alias("question"),
        F.concat(F.lit("SELECT p_name FROM part WHERE p_size = "), size).alias("query"))


@_with_inputs("18", f"SELECT o_orderkey AS id, markdown, o_orderstatus FROM orders JOIN ({P22_SQL}) t ON table_id = o_orderkey",
              [("Tabella", "table", "markdown"), ("Domanda", "question", "'Quale stato ha la tabella ' || id || '?'")], "o_orderstatus")
def _t18_inputs(spark, sf):
    tables = p22_table_markdown(spark, sf)
    orders = read_table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    return orders.join(tables, F.col("table_id") == F.col("o_orderkey")).select(
        F.col("o_orderkey").alias("id"), F.col("markdown").alias("table"),
        F.concat(F.lit("Quale stato ha la tabella "), F.col("o_orderkey").cast("string"), F.lit("?")).alias("question"),
        F.struct(F.array("o_orderstatus").alias("text")).alias("answers"))


_EVENT_SCHEMA = '{"type": "object", "properties": {"k": {"type": "integer"}}}'


@_with_inputs("19", "SELECT event_id AS id, * FROM events",
              [("Schema JSON", "schema", q.lit(_EVENT_SCHEMA)), ("Testo", "input", "event_type")], "props")
def _t19_inputs(spark, sf):
    return read_table(spark, sf, "events").select(F.col("event_id").alias("id"), F.lit(_EVENT_SCHEMA).alias("schema"),
                                                  F.col("event_type").alias("input"), F.col("props").alias("output"))


@_with_inputs("23", "SELECT conv_id || '-' || turn AS id, * FROM pairs",
              [("Documenti", "context", "candidate"), ("Domanda", "question", "reference")], "coalesce(reference2, '')")
def _t23_inputs(spark, sf):
    return fx.pairs(spark, sf).select(
        F.concat_ws("-", "conv_id", "turn").alias("id"), F.col("candidate").alias("context"), F.col("reference").alias("question"),
        F.struct(F.array(F.coalesce("reference2", F.lit(""))).alias("text")).alias("answers"))


def _sentiment_query(source: str, text_sql: str, label_sql: str, columns):
    def build(spark, sf):
        return pp.prepare_sentiment(fx.labelled(spark, sf).select(F.col("doc_id").alias("id"), *columns()), source, keep=("id",))

    build.__name__ = f"t01_source_{source}"
    register(build.__name__, f"WITH {q.LABELLED} SELECT doc_id AS id, {q.task_prompt(get_task('01'), text_sql, label_sql)} AS text FROM labelled")(build)


_sentiment_query("sentence", "text", "CASE quality WHEN 0 THEN 'negativo' WHEN 1 THEN 'positivo' ELSE 'neutro' END",
                 lambda: [F.col("text").alias("sentence"), F.col("quality").alias("label")])
_sentiment_query("stars", "CASE WHEN doc_id % 3 = 0 THEN source ELSE text END",
                 "CASE doc_id % 6 WHEN 0 THEN 'negativo' WHEN 1 THEN 'negativo' WHEN 2 THEN 'neutro' WHEN 5 THEN 'neutro' ELSE 'positivo' END",
                 lambda: [F.when(F.col("doc_id") % 3 == 0, F.lit("  ")).otherwise(F.col("text")).alias("text"), F.col("source").alias("title"),
                          F.pmod("doc_id", F.lit(6)).alias("label")])


@_task("01", _LAB_SQL, "text", _T01_LABEL_SQL)
def _t01(spark, sf):
    return fx.with_split(_t01_frame(spark, sf), "id")


@_task("02", _DOCS_SQL, "text", "source")
def _t02(spark, sf):
    return _docs(spark, sf).select("id", "split", F.col("text").alias("utt"), F.col("source").alias("intent"))


def _mod_label(tid, k):
    t = get_task(tid)
    return q.decode_passthrough(f"id % {k}", t.label_map)


@_task("03", _DOCS_SQL, "text", _mod_label("03", 4))
def _t03(spark, sf):
    return _docs(spark, sf).select("id", "split", "text", F.pmod("id", F.lit(4)).alias("label"))


@_task("04", _DOCS_SQL, "text", _mod_label("04", 3))
def _t04(spark, sf):
    return _docs(spark, sf).select("id", "split", F.col("text").alias("premise"), F.pmod("id", F.lit(3)).alias("label"))


@_task("05", _DOCS_SQL, "text", "chr(CAST(65 + id % 4 AS INTEGER))")
def _t05(spark, sf):
    return _docs(spark, sf).select("id", "split", F.col("text").alias("article"),
                                   F.chr(F.lit(65) + F.pmod("id", F.lit(4))).alias("answer"))


def _pair_task(tid, inp_name, lab_name):
    @_task(tid, _PAIRS_SQL, "reference", "candidate")
    def build(spark, sf):
        return _pairs(spark, sf).select("id", F.col("reference").alias(inp_name), F.col("candidate").alias(lab_name))
    return build


for _tid, _i, _l in [("06", "text", "summary"), ("10", "src", "tgt"), ("11", "source", "target"),
                     ("12", "en_toxic_comment", "en_neutral_comment"), ("15", "question", "query"),
                     ("16", "text", "code"), ("21", "instruction", "output")]:
    _pair_task(_tid, _i, _l)


@_task("07", _DOCS_SQL, "text", "source")
def _t07(spark, sf):
    return _docs(spark, sf).select("id", "split", F.col("text").alias("context"),
                                   F.struct(F.array("source").alias("text"), F.array(F.lit(0)).alias("answer_start"))
                                   .alias("answers"))


@_task("08", _PAIRS_SQL, "reference", "candidate")
def _t08(spark, sf):
    return _pairs(spark, sf).select("id", F.struct(F.col("reference").alias("en"), F.col("candidate").alias("it"))
                                    .alias("translation"))


@_task("09", "(SELECT conv_id || '-' || turn AS id, * FROM pairs WHERE reference2 IS NOT NULL) s", "reference", "reference2")
def _t09(spark, sf):
    """Paraphrase: label==1 pairs only, target is sentence2 (here: the next user turn)."""
    p = fx.pairs(spark, sf)
    return p.select(F.concat_ws("-", "conv_id", "turn").alias("id"), F.col("reference").alias("sentence1"),
                    F.col("reference2").alias("sentence2"),
                    F.col("reference2").isNotNull().cast("int").alias("label")) \
        .where(F.col("label") == 1).drop("label").withColumnRenamed("sentence2", "label")


@_task("13", _DOCS_SQL, f"array_to_string({q.tokens('text')}, ' ')",
       f"array_to_string(list_transform({q.tokens('text')}, lambda x: length(x) % 3), ' ')")
def _t13(spark, sf):
    d = _docs(spark, sf).select("id", "split", tx.word_tokens("text").alias("tokens"))
    return d.select("id", "split", "tokens",
                    F.transform("tokens", lambda x: F.pmod(F.length(x), F.lit(3))).alias("ner_tags"))


@_task("14", _DOCS_SQL, f"array_to_string({q.tokens('text')}, ' ')", "source")
def _t14(spark, sf):
    return _docs(spark, sf).select("id", "split", tx.word_tokens("text").alias("tokens"),
                                   F.col("source").alias("relation"))


@_task("17", _DOCS_SQL, "text", _mod_label("17", 4))
def _t17(spark, sf):
    return _docs(spark, sf).select("id", "split", "text", F.pmod("id", F.lit(4)).alias("label"))


@_task("18", _DOCS_SQL, "text", "lang")
def _t18(spark, sf):
    return _docs(spark, sf).select("id", "split", F.col("text").alias("question"),
                                   F.struct(F.array("lang").alias("text")).alias("answers"))


@_task("19", "(SELECT event_id AS id, * FROM events) s", "event_type", "props")
def _t19(spark, sf):
    ev = read_table(spark, sf, "events")
    return ev.select(F.col("event_id").alias("id"), F.col("event_type").alias("input"), F.col("props").alias("output"))


@_task("20", _DOCS_SQL, "text", "source")
def _t20(spark, sf):
    return _docs(spark, sf).select("id", "split", F.col("text").alias("question"),
                                   F.struct(F.array("source").alias("text"), F.array(F.lit(0)).alias("answer_start"))
                                   .alias("answers"))


@_task("22", "(SELECT conv_id AS id, history, last_text FROM chat) s", "history", "last_text")
def _t22(spark, sf):
    from ..operators.chat import render_chat_history
    return render_chat_history(read_table(spark, sf, "conversations")).withColumnRenamed("conv_id", "id")


@_task("23", _DOCS_SQL, "text", "source")
def _t23(spark, sf):
    return _t07(spark, sf)


@_task("24", _DOCS_SQL, "text", _mod_label("24", 3))
def _t24(spark, sf):
    return _docs(spark, sf).select("id", "split", F.col("text").alias("claim"), F.pmod("id", F.lit(3)).alias("label"))


@_task("25", _LAB_SQL, "text", q.decode_passthrough("toxic", _T25.label_map))
def _t25(spark, sf):
    lab = fx.labelled(spark, sf)
    return fx.with_split(lab.select(F.col("doc_id").alias("id"), "text", F.col("toxic").alias("label")), "id")


@_task("26", "(SELECT page AS id, image, label FROM pagepairs) s", "image",
       q.decode_passthrough("label", get_task("26").label_map))
def _t26(spark, sf):
    from ..operators.segments import page_pairs
    pairs = page_pairs(fx.page_stream(spark, sf))
    return pairs.select(F.col("page").alias("id"), F.col("pair_text").alias("image"), "label")


_CHAT_SQL = """chat AS (
  SELECT conv_id,
         coalesce(string_agg('<start_of_turn>' || role || chr(10) || text || '<end_of_turn>', chr(10) ORDER BY turn)
                  FILTER (WHERE turn < mt), '') || chr(10) || '<start_of_turn>model' || chr(10) AS history,
         max_by(text, turn) AS last_text
  FROM (SELECT *, max(turn) OVER (PARTITION BY conv_id) AS mt FROM conversations) c
  GROUP BY conv_id)"""

_PAGEPAIRS_SQL = """pp0 AS (SELECT source AS stream, doc_id AS page, lang, text,
        lag(text) OVER (PARTITION BY source ORDER BY doc_id) AS prev_text,
        lag(lang) OVER (PARTITION BY source ORDER BY doc_id) AS prev_lang FROM documents),
pagepairs AS (SELECT page, 'Pagina corrente: ' || text || chr(10) || 'Pagina precedente: ' || coalesce(prev_text, '') AS image,
        CASE WHEN prev_lang IS NULL OR prev_lang <> lang THEN 1 ELSE 0 END AS label FROM pp0)"""


def _task_sql(tid: str) -> str:
    fn, src, inp, lab = _TASK_BUILDERS[tid]
    t = get_task(tid)
    ctes = [q.LABELLED, q.PAIRS, _CHAT_SQL, _PAGEPAIRS_SQL]
    return f"WITH {', '.join(ctes)} SELECT id, {q.task_prompt(t, inp, lab)} AS text FROM {src}"


_COLUMN_OVERRIDES = {"22": ("history", "last_text")}


def _make_task_query(tid: str):
    def build(spark, sf):
        fn = _TASK_BUILDERS[tid][0]
        inp, lab = _COLUMN_OVERRIDES.get(tid, (None, None))
        return pp.prepare_task(fn(spark, sf), tid, keep=("id",), input_col=inp, label_col=lab)
    build.__name__ = f"t{tid}_prepare"
    return build


for _t in TASKS:
    register(f"t{_t.task_id}_prepare_{_t.name}", _task_sql(_t.task_id))(_make_task_query(_t.task_id))


# metric families register themselves on import
from . import catalog_text  # noqa: E402,F401
from . import catalog_structured  # noqa: E402,F401
from . import catalog_tokens  # noqa: E402,F401
