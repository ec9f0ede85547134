"""Files under a declared schema, and the sink of prepared splits."""

import pytest
from pyspark.sql import functions as F

from conftest import SF0001
from tessera.operators import prepare as pp
from tessera.session import scratch_path
from tessera.sources import reports as rp
from tessera.sources import tables as tb

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.mark.parametrize("fmt", ["csv", "json"])
def test_copies_give_the_parquet_rows(spark, fmt):
    docs = tb.read_table(spark, SF0001, "documents").select("doc_id", "text", "lang", "source", F.col("n_chars").cast("long").alias("n_chars"))
    path = scratch_path(spark, "copy")
    writer = docs.write.option("header", "true").option("escape", '"') if fmt == "csv" else docs.write
    writer.format(fmt).save(path)
    rows, broken = tb.read_checked(spark, path, SCHEMA, fmt, multi_line=True)
    assert broken.count() == 0 and rows.count() == docs.count()
    assert rows.exceptAll(docs).count() == 0 and docs.exceptAll(rows).count() == 0


def test_broken_lines_are_counted_and_kept(spark):
    path = scratch_path(spark, "lines")
    lines = ['{"doc_id": 1, "text": "a"}', '{"doc_id": 2, "te', '{"doc_id": "x", "text": "b"}', "", '{"text": "c", "other": 5}']
    spark.createDataFrame([(x,) for x in lines], "value string").write.text(path)
    kept = scratch_path(spark, "quarantine")
    rows, broken = tb.read_checked(spark, path, "doc_id long, text string", "jsonl", quarantine=kept)
    assert sorted(map(tuple, rows.collect()), key=str) == [(1, "a"), (None, "c")]
    assert sorted(r.line for r in broken.collect()) == sorted([lines[1], lines[2]])
    assert spark.read.parquet(kept).where("_is_broken = 'true'").count() == 2
    csv = scratch_path(spark, "lines")
    spark.createDataFrame([("id,w\n1,a\nx,b\n2,c,d\n3\n4,\"q, r\"",)], "value string").write.text(csv)
    rows, broken = tb.read_checked(spark, csv, "id long, w string", "csv")
    assert sorted(map(tuple, rows.collect())) == [(1, "a"), (4, "q, r")] and sorted(r.line for r in broken.collect()) == ["2,c,d", "3", "x,b"]
    with pytest.raises(ValueError):
        tb.read_path(spark, path, "json")


def test_one_split_anew(spark):
    path = scratch_path(spark, "prepared")
    frame = lambda split, texts: spark.createDataFrame([(t, split) for t in texts], "text string, split string")
    tb.save_prepared(frame("train", ["a", "b"]).unionByName(frame("test", ["c"])), path)
    tb.save_prepared(frame("test", ["d", "e"]), path)
    read = lambda: sorted((r.split, r.text) for r in tb.load_prepared(spark, path).collect())
    assert read() == [("test", "d"), ("test", "e"), ("train", "a"), ("train", "b")]
    broken = frame("train", ["x"] * 50).repartition(4).withColumn("text", F.when(F.rand() >= 0, F.raise_error(F.lit("stop"))).otherwise(F.col("text")))
    with pytest.raises(Exception, match="stop"):
        tb.save_prepared(broken, path)
    assert read() == [("test", "d"), ("test", "e"), ("train", "a"), ("train", "b")]


def test_sentiment_sources(spark):
    words = lambda df, source: [r.text.split("<start_of_turn>model\n")[1].split("\n")[0] for r in pp.prepare_sentiment(df, source).collect()]
    three = spark.createDataFrame([("t", 0), ("t", 1), ("t", 2), ("t", -1), ("t", 7), (None, None)], "sentence string, polarity int")
    assert words(three, "text") == ["negativo", "positivo", "neutro", "neutro", "neutro", "neutro"]
    two = spark.createDataFrame([("t", 0), ("t", 1), ("t", -1)], "sentence string, label int")
    assert words(two, "sentence") == ["negativo", "positivo", "neutro"]
    stars = spark.createDataFrame([(" body ", "head", 0), ("  ", " head ", 2), (None, "head", 4), ("x", None, 9)], "text string, title string, label int")
    assert words(stars, "stars") == ["negativo", "neutro", "positivo", "neutro"]
    assert [("body" in r.text, "head" in r.text) for r in pp.prepare_sentiment(stars, "stars").collect()][:3] == [(True, False), (False, True), (False, True)]
    with pytest.raises(ValueError):
        pp.prepare_sentiment(stars, "films")


def test_heads_run_no_job(spark):
    df = spark.range(1000).withColumn("split", F.lit("train"))
    tracker, group = spark.sparkContext.statusTracker(), "lazy-heads"
    spark.sparkContext.setJobGroup(group, "heads")
    out = pp.prepare_evaluation(df.withColumn("utt", F.lit("x")), "02", ["id"])
    both = pp.with_split_fallback(df, "test", 50, ["id"])
    assert list(tracker.getJobIdsForGroup(group)) == []
    assert out.count() == 200 and both.agg(F.max("id")).first()[0] == 49 and both.count() == 50
    with pytest.raises(ValueError):
        pp.head(df, 10**6, ["id"])


@pytest.mark.parametrize("part", [rp.LOG_PART, 2])
def test_run_logs_in_parts(spark, monkeypatch, part):
    monkeypatch.setattr(rp, "LOG_PART", part)
    events = spark.createDataFrame(
        [(i, 1 if i < 7 else 2, f"2024-01-01 00:00:{i // 2:02d}", 100.0 * i, f'{{"k": {i}}}') for i in range(9)],
        "event_id long, user_id long, ts string, value double, props string").withColumn("ts", F.to_timestamp("ts"))
    path = scratch_path(spark, "test-logs")
    rp.write_logs(rp.logs_from_events(events), path)
    assert spark.read.schema(rp.LOG_SCHEMA).json(path).count() == (2 if part > 9 else 5)
    got = sorted((r.run_id, r.step, r.num_tokens, r.interval_tokens) for r in rp.explode_run_log(spark, path).collect())
    want, held = [], {}
    for i in range(9):
        run = "1_20240101" if i < 7 else "2_20240101"
        n, total = held.get(run, (0, 0.0))
        held[run] = (n + 1, total + i + 1)
        want.append((run, n + 1, total + i + 1, i + 1.0))
    assert got == sorted(want)
