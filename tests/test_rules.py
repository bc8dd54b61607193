import pytest
from pyspark.sql import functions as F

from cadenza.operators import joins, metrics, rules, select

ARRAYS = "matches array<int>, errors array<boolean>, prior array<int>, second array<int>, length int, has_audio boolean"


@pytest.mark.parametrize(
    "m, e, p, want",
    [
        ([0, 0], [True, True], [1, 1], "keep"),
        ([0] * 4, [False, False, False, True], [0] * 4, "rescore"),
        ([0, 0], [False, True], [0, 0], "mark_all"),
        ([0, 0], [False, True], [1, 0], "rescore"),
        ([1, 0], [False, True], [0, 0], "keep"),
        ([1, 0], [True, True], [0, 0], "rescore"),
        (None, None, None, "keep"),
    ],
)
def test_decision(spark, m, e, p, want):
    df = spark.createDataFrame([(m, e, p)], "m array<int>, e array<boolean>, p array<int>")
    assert df.select(rules.decision(F.col("m"), F.col("e"), F.col("p"))).first()[0] == want


def test_scored(spark):
    rows = [([1, 0], [True, True], [0, 0], [1, 0], 2, True), ([0, 0], [False], [0, 0], [0, 0], 2, True), ([1, 1], [True, True], [1, 1], [1, 1], 2, False), ([1], [False, False], [1, 1], [1, 1], 2, True), ([0, 0], [True], [0, 0], [0, 0], 2, True)]
    got = [(r.strategy, r.result, r.is_valid) for r in rules.scored(spark.createDataFrame(rows, ARRAYS)).collect()]
    assert got == [("rescore", [False, True], True), ("mark_all", [True, True], True), ("rescore", [True, True], True), ("keep", [False, False], False), ("keep", [True], True)]


def test_names(spark):
    df = spark.createDataFrame([("s3://b/a/001-000011-2-v2.wav",), ("s3://b/a/x-v2.wav",), ("s3://b/a/001-000011-2.mp3",), (None,)], "u string")
    got = [r.n for r in df.select(rules.segment_name(F.col("u")).alias("n")).collect()]
    assert got[0] == (1, 11, 2) and got[1:] == [None] * 3
    bad = rules.too_many_invalid(df.withColumn("k", F.lit(1)), ["k"], "u", 0).first()
    assert (bad.n_tagged, bad.n_invalid, bad.fails) == (2, 1, True)


def test_missing_features(spark):
    p = spark.createDataFrame([("a", 0), ("a", 1), ("a", 5), ("b", 0)], "k string, i int")
    f = spark.createDataFrame([("a", 0), ("a", 3)], "k string, i int")
    assert {(r.k, r.i): r.problem for r in rules.missing_features(p, f, ["k"], "i").collect()} == {("a", 1): "error", ("a", 5): "warning", ("b", 0): "warning"}


def test_accuracy(spark):
    df = spark.createDataFrame([([True, False],), ([],), (None,)], "e array<boolean>")
    assert [tuple(r) for r in df.select(*rules.accuracy(F.col("e")).values()).collect()] == [(1, 2, 0.5), (0, 0, 0.0), (0, 0, 0.0)]


def test_select_conditions(spark):
    with pytest.raises(ValueError):
        select.activity_filter(start="2025-01-01")
    with pytest.raises(ValueError):
        select.activity_filter(start="2025-02-01", end="2025-01-01")
    with pytest.raises(ValueError):
        select.require_columns(spark.range(1), ["id", "x"])
    df = spark.createDataFrame([("a", None), (" ", ["x"]), (None, ["x"]), ("b", ["x"])], "k string, l array<string>")
    assert [r.k for r in df.where(select.valid_activity("k", "l")).collect()] == ["b"]
    keys = spark.createDataFrame([("a/complete.wav",), ("a/1.wav",), ("a/1.mp3",), (None,)], "key string")
    assert [r.key for r in keys.where(select.audio_key("key")).collect()] == ["a/1.wav"]


def test_exclusive_quantile_is_the_exclusive_rule(spark):
    from statistics import quantiles

    xs = [3.0, 1.0, 4.0, 1.0, 5.0, 9.0, 2.0, 6.0, 5.0, 3.5]
    for n in (2, 3, 5, 10):
        df = spark.createDataFrame([("k", x) for x in xs[:n]], "k string, v double")
        got = metrics.exclusive_quantile(df, ["k"], F.col("v"), 19, 20).first().q
        assert got == round(quantiles(xs[:n], n=20)[18], 10)
    assert metrics.exclusive_quantile(spark.createDataFrame([("k", 1.0)], "k string, v double"), ["k"], F.col("v"), 19, 20).first().q is None


def test_breaches_with_missing_periods(spark):
    df = spark.sql("SELECT timestamp_ntz'2025-01-01 00:00:00' + make_interval(0, 0, 0, 0, h, 0, 0) AS t, n FROM VALUES (0, 9), (1, 9), (3, 9), (4, 9) AS v(h, n)")
    run = lambda missing: [r.alarm for r in metrics.breaches(df, "t", "1 hour", F.col("n") > 5, 3, missing).orderBy("t").collect()]
    assert run(False) == [False] * 5
    assert run(True) == [False, False, True, True, True]


def test_words_in_pages_borders(spark):
    p = spark.createDataFrame([("a", 0, 1000, 2000), ("a", 1, 2000, 3000), ("a", 2, None, 5), ("b", 0, 0, 10)], "activity_id string, page_index int, start_time int, end_time int")
    w = spark.createDataFrame([("a", i, s) for i, s in enumerate([0.999, 1.0, 2.5, 3.0, 3.001, 4.0, 4.001])] + [("a", 90, None), (None, 91, 1.0)], "activity_id string, word_id int, start double")
    for bucket in (30_000, 300):
        got = sorted((r.page_index, r.word_id) for r in joins.words_in_pages(p, w, bucket_ms=bucket).collect())
        assert got == [(0, 1), (0, 2), (0, 3), (1, 2), (1, 3), (1, 4), (1, 5)]


def test_neighbours_are_by_index(spark):
    df = spark.createDataFrame([("s", 0, "a"), ("s", 1, "b"), ("s", 3, "d")], "s string, i int, v string")
    assert [(r.i, r.previous, r.following) for r in joins.neighbours(df, ["s"], "i", "v").orderBy("i").collect()] == [(0, None, "b"), (1, "a", None), (3, None, None)]
