"""Caps, fallbacks and ratio mixes on hand-made splits."""

from pyspark.sql import functions as F

from tessera.operators import prepare as pp


def _frame(spark, n, split="train", lang="en", start=0):
    return spark.createDataFrame([(start + i, split, lang) for i in range(n)], "id long, split string, lang string")


def test_caps_keep_the_first_rows(spark):
    df = _frame(spark, 500).unionByName(_frame(spark, 80, "validation", start=1000)).unionByName(_frame(spark, 5, None, start=2000)) \
        .unionByName(_frame(spark, 6, "test", start=3000)).repartition(7)
    big = pp.cap_splits(df, {"train": 120, "validation": 30}, ["id"])
    counts = {r.split: r.n_rows for r in pp.split_stats(big).collect()}
    assert counts == {"train": 120, "validation": 30, None: 5, "test": 6}
    assert big.where("split = 'train'").agg(F.max("id")).first()[0] == 119
    assert sorted(r.id for r in pp.cap(df, 3, ["id"]).collect()) == [0, 1, 2]
    assert pp.cap(df, 10**6, ["id"]).count() == 591


def test_blank_input_takes_the_first_column(spark):
    df = spark.createDataFrame([(7, "Bello", 1), (8, "  ", 1), (9, None, 0)], "first long, text string, label int")
    got = [r.i for r in df.select(pp.resolve_input(df, pp.get_task("06")).alias("i")).collect()]
    assert got == ["Bello", "8", "9"]


def test_split_fallback_only_when_missing(spark):
    train_only = _frame(spark, 300)
    val = pp.with_split_fallback(train_only, "validation", 100, ["id"])
    assert val.count() == 100 and val.agg(F.max("id")).first()[0] == 99
    with_val = train_only.unionByName(_frame(spark, 7, "validation", start=5000))
    assert pp.with_split_fallback(with_val, "validation", 100, ["id"]).count() == 7


def test_ratio_mix(spark):
    first = _frame(spark, 70, lang="it")
    second = _frame(spark, 100, lang="en", start=10_000)
    mixed = pp.mix([first, second], [7, 3], ["id"])
    counts = {(r.split, r.lang): r.n_rows for r in pp.split_stats(mixed, ["split", "lang"]).collect()}
    # 3/7 of 70 = 30 rows of the second source; fallbacks 100 and 50 clip to 70 and 50
    assert counts == {("train", "it"): 70, ("train", "en"): 30, ("validation", "it"): 70, ("test", "it"): 50}
    chosen = mixed.where("lang = 'en'").agg(F.min("id"), F.max("id")).first()
    assert tuple(chosen) == (10_000, 10_029)


def test_unknown_source_is_an_error(spark):
    import pytest
    with pytest.raises(ValueError):
        pp.choose_source("nope", {"a": _frame(spark, 1)})
