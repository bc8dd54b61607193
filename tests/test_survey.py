"""Operators that the survey queries call: cases that a table rarely holds."""

import math
import random
import struct

import pytest
from pyspark.sql import functions as F

from cadenza.functions.text import canonical_hash, endpoint, int_or_zero
from cadenza.operators import joins, metrics, rules, select
from cadenza.operators import sequence as Q
from cadenza.plans.scan import batched
from cadenza.plans.skew import hot_keys
from cadenza.sources import readers, sinks
from cadenza.streaming import queue


def test_hot_keys_are_as_few_as_tasks(spark):
    most = int(spark.conf.get("spark.sql.shuffle.partitions"))
    df = spark.sql("SELECT concat('k', id % 40) AS k FROM range(4000)").unionByName(spark.sql("SELECT 'hot' AS k FROM range(9000)"))
    hot = hot_keys(df, ["k"], 10).collect()
    assert len(hot) <= most and {r.k for r in hot} == {"hot"}
    assert sum(r.n_parts for r in hot) <= 2 * most


def test_segment_names(spark):
    rows = ["s3://b/x/123-000011-2-v2.wav", "123-000011-2-v3.wav.bak", "s3://b/1234-000011-2-v2.wav", "s3://b/zz001-000011-2-v2.wav", "s3://b/123-000011-2-v2.mp3", "s3://b/123-000011-2-v2.wav/other.txt", None]
    df = spark.createDataFrame([(x,) for x in rows], "u string")
    got = [r.n and tuple(r.n) for r in df.select(rules.segment_name(F.col("u")).alias("n")).collect()]
    assert got == [(123, 11, 2), (123, 11, 2), None, None, None, None, None]


def test_batches(spark):
    for n, hot in ((0, 100), (1, 100), (95, 100), (1000, 7)):
        got = batched(spark.range(n).withColumn("x", F.lit("a")), ["id"], 10, hot_rows=hot).groupBy("batch").count().collect()
        sizes = sorted(r["count"] for r in got)
        assert sizes == sorted([10] * (n // 10) + [n % 10] * (n % 10 > 0))
        assert sorted(r.batch for r in got) == list(range(len(sizes)))


def test_stale_and_empty_queue(spark, tmp_path):
    df = spark.sql("SELECT concat('k', id) AS key, timestamp_ntz'2025-01-01' AS modified, 'b' AS batch FROM range(2500)")
    got = sinks.stale(df, "2025-02-01", 7).groupBy("batch").count().collect()
    assert sorted(r["count"] for r in got) == [500, 1000, 1000]
    assert sinks.stale(df, "2025-01-02", 7).count() == 0
    with pytest.raises(ValueError):
        queue.enqueue(spark.createDataFrame([(None,), (" ",)], "activity_id string"), f"{tmp_path}/q")


def test_far_pages_and_indices(spark):
    pages = spark.createDataFrame([("a", 0, 0, 10**15), ("a", 1, 5000, 9000), ("b", 0, 0, 700_000), ("b", 1, None, 5), ("b", 2, 5, None), ("b", 3, 9000, 10), (None, 4, 0, 10**6)], "activity_id string, page_index int, start_time long, end_time long")
    words = [("a", i, s) for i, s in enumerate([0.0, 5.0, 9.5, 10.0, 10.001, 900.0, float("nan"), None, 1e12])] + [("b", 20, 701.0), ("b", 21, 701.1), (None, 22, 1.0)]
    got = sorted((r.activity_id, r.page_index, r.word_id) for r in joins.words_in_pages(pages, spark.createDataFrame(words, "activity_id string, word_id int, start double")).collect())
    want = []
    for a, p, low, high in [("a", 0, 0, 10**15), ("a", 1, 5000, 9000), ("b", 0, 0, 700_000)]:
        want += [(a, p, w) for x, w, s in words if x == a and s is not None and s == s and s < 1e9 and low <= s * 1000 <= high + 1000]
    assert got == sorted(want)
    df = spark.createDataFrame([("a", 2), ("a", 2**31 - 2), ("b", 0), ("b", 3), ("c", None), ("c", -4)], "k string, i int")
    assert sorted((r.k, r.from_index, r.n) for r in Q.miss_streaks(df, ["k"], "i").collect()) == [("a", 0, 2), ("a", 3, 2**31 - 5), ("b", 1, 2)]
    some = Q.missing_indices(df.where("k <> 'a'"), ["k"], "i").collect()
    assert sorted((r.k, r.i, r.n_expected) for r in some) == [("b", 1, 4), ("b", 2, 4)]
    wide = spark.createDataFrame([("a", 200_000)], "k string, i int")
    assert Q.missing_indices(wide, ["k"], "i").agg(F.count("*"), F.sum("i")).first()[:] == (200_000, 199_999 * 100_000)


def test_dropped_segments(spark):
    rows = [("a", 0, 0), ("a", 0, 2), ("a", 0, 2), ("a", 1, 3), ("a", 1, 11), ("a", 3, 20), ("b", 1, 4), ("a", 2, None), (None, 0, 1)]
    df = spark.createDataFrame(rows, "k string, p int, s int")
    got = sorted(map(tuple, Q.dropped_segments(df.where("k IS NOT NULL"), ["k"], "p", "s").collect()))
    assert got == [("a", 0, 1, 1, False), ("a", 1, 4, 7, True)]


def test_flagged_last_file(spark):
    rows = [("a", 1, "x", 1, False), ("a", 2, "y", 2, True), ("a", 3, "z", 3, False), ("a", 3, "w", 4, None), ("b", 1, "q", 5, False)]
    df = spark.createDataFrame(rows, "k string, s int, f string, o int, last boolean")
    got = {r.k: (dict(r.files), r.last_file) for r in Q.segment_map(df, ["k"], "s", "f", "o", F.col("last")).collect()}
    assert got == {"a": ({1: "x", 2: "y", 3: "w"}, "y"), "b": ({1: "q"}, None)}
    assert {r.k: r.last_file for r in Q.segment_map(df, ["k"], "s", "f", "o").collect()} == {"a": "w", "b": "q"}


def test_values_at_ranks(spark):
    r = random.Random(3)
    special = [0.0, -0.0, 5e-324, 1e308, float("inf"), float("-inf"), float("nan"), -1.5, -1.5, 2.0, math.nextafter(2.0, 0), math.nextafter(2.0, 3)]
    rows = [(r.choice(["a", "b", None]), r.choice([*special, r.gauss(0, 1), r.lognormvariate(0, 3), None])) for _ in range(1500)] + [("empty", None)]
    df = spark.createDataFrame(rows, "k string, n double")
    want = {}
    for k, v in rows:
        if v is not None:
            want.setdefault(k, []).append(v)
    rank = {"low": F.lit(1), "mid": F.floor((F.col("n") + 1) / 2), "top": F.col("n"), "none": F.col("n") + 1}
    got = {x.k: x for x in metrics.values_at(df, ["k"], F.col("n"), rank).collect()}
    assert set(got) == set(want)
    same = lambda a, b: a == b or (a != a and b != b)
    for k, vs in want.items():
        vs = sorted(vs, key=lambda x: (x != x, x if x == x else 0))
        assert got[k].n == len(vs) and got[k]["none"] is None
        assert all(same(a, b) for a, b in ((got[k].low, vs[0]), (got[k].mid, vs[(len(vs) + 1) // 2 - 1]), (got[k].top, vs[-1]))), k
    assert metrics.values_at(df.limit(0), ["k"], F.col("n"), rank).count() == 0


def test_window_quantile_of_nothing(spark):
    df = spark.sql("SELECT * FROM VALUES (timestamp'2025-01-01 00:10:00', 1.0D), (timestamp'2025-01-01 00:20:00', 4.0D), (timestamp'2025-01-01 02:20:00', cast(null as double)) AS t(ts, v)")
    got = sorted((r.window_start.hour, r.n, r.q) for r in metrics.window_quantile(df, "ts", "1 hour", "v", 0.5).collect())
    assert got == [(0, 2, 2.5), (2, 0, None)]


def test_unknown_models_stay(spark):
    rows = spark.createDataFrame([(1, "m"), (2, "x"), (3, None)], "id int, model string")
    t = spark.createDataFrame([("m", 0.5)], "model string, threshold double")
    assert sorted((r.id, r.threshold, r.unknown) for r in joins.with_threshold(rows, t, "model").collect()) == [(1, 0.5, False), (2, None, True), (3, None, True)]


def test_preferred_pass(spark):
    rows = [("a", 0, "base"), ("a", 1, "base"), ("a", 0, "SECOND"), ("a", 1, "second-b"), ("a", 5, "Faux"), ("b", 0, "base"), ("b", 1, "base"), ("b", 1, "second"), ("c", 0, None)]
    got = select.preferred_pass(spark.createDataFrame(rows, "k string, i int, m string"), ["k"], "i", "m").collect()
    assert sorted((r.k, r.i, r.m) for r in got) == [("a", 0, "SECOND"), ("a", 1, "second-b"), ("b", 0, "base"), ("b", 1, "base")]


def test_deliveries_and_partial_failures(spark, tmp_path):
    df = spark.createDataFrame([(0,), (1,), (2,), (3,), (None,)], "f int")
    got = queue.delivered(df, lambda k: F.col("f") >= k).collect()
    assert [(r.f, r.attempt, r.failures) for r in got] == [(0, 1, 0), (1, 2, 1), (2, 3, 2), (3, None, 3), (None, 1, 0)]
    body = F.to_json(F.struct(F.concat(F.lit("a"), F.col("id").cast("string")).alias("activity_id")))
    spark.range(4).select(body.alias("value")).write.parquet(f"{tmp_path}/in")
    rows = spark.readStream.schema("value string").parquet(f"{tmp_path}/in")
    queue.consume(rows, f"{tmp_path}/good", f"{tmp_path}/bad", f"{tmp_path}/c", fails=lambda k: F.col("message.activity_id") == "a2", failures=f"{tmp_path}/f").awaitTermination()
    assert sorted(r.activity_id for r in spark.read.parquet(f"{tmp_path}/good").collect()) == ["a0", "a1", "a3"]
    assert [r.reason for r in spark.read.parquet(f"{tmp_path}/bad").collect()] == ["failed 3 times"]
    assert [(r.activity_id, r.done) for r in spark.read.parquet(f"{tmp_path}/f").collect()] == [("a2", False)]


def test_acknowledged_offsets(spark):
    chunks = spark.createDataFrame([("s", i, 10) for i in range(5)] + [("t", 0, 3)], "k string, seq long, size int")
    acks = spark.createDataFrame([("s", 1, 15), ("s", 2, 12), ("s", 2, 11), ("s", 3, 99)], "k string, seq long, acked int")
    got = sorted((r.k, r.seq, r.sent, r.acked, r.pending) for r in queue.acknowledged(chunks, acks, "k").collect())
    assert got == [("s", 0, 10, 0, 10), ("s", 1, 20, 15, 5), ("s", 2, 30, 15, 15), ("s", 3, 40, 40, 0), ("s", 4, 50, 50, 0), ("t", 0, 3, 0, 3)]


def test_cache_outlives_its_object(spark, tmp_path):
    spark.range(3).createOrReplaceTempView("t_kept")
    assert sinks.ResultCache(spark, 60, f"{tmp_path}/c").query("SELECT count(*) AS n FROM t_kept").first().n == 3
    spark.range(9).createOrReplaceTempView("t_kept")
    later = sinks.ResultCache(spark, 60, f"{tmp_path}/c")
    assert later.query("SELECT count(*) AS n FROM t_kept").first().n == 3
    assert later.query("SELECT count(*) AS n FROM t_kept", max_age_s=-1).first().n == 9


def test_redriven(spark, tmp_path):
    df = spark.createDataFrame([(i, 100 - i) for i in range(12)], "delivery_id long, timestamp long")
    sent, left = sinks.redriven(df, f"{tmp_path}/q", 5)
    assert {r.delivery_id for r in sent.collect()} == {11, 10, 9, 8, 7} and left.count() == 7
    assert spark.read.parquet(f"{tmp_path}/q").count() == 5


def test_reports(spark):
    t = spark.createDataFrame([("a", [True, False], [True, True], [True, False, False]), ("a", [True], [False], [True]), ("b", None, [True], [True]), ("c", [], [], [])], "k string, t array<boolean>, x array<boolean>, y array<boolean>")
    s = rules.two_level_accuracy(t, ["k"], F.col("t"), F.col("x"), F.col("y")).withColumnRenamed("k", "activity_id")
    assert sorted((r.activity_id, r.n_words, r.right_before, r.right_after, round(r.improvement, 6)) for r in s.collect()) == [("a", 3, 1, 3, 0.666667), ("b", 0, 0, 0, 0.0), ("c", 0, 0, 0, 0.0)]
    words = spark.createDataFrame([("a", 0, "frog", 1, 0, 0.5)], "activity_id string, place int, word string, a int, b int, confidence double")
    lines = [r.line for r in sinks.activity_report(s.where("activity_id = 'a'"), words).orderBy("line_no").collect()]
    assert lines == ["Activity a: 3 words, before 0.333, after 1.000, improvement +0.667", "frog             1    0    0.500"]


def test_formats(spark):
    df = spark.createDataFrame([("12",), (" 7 ",), ("3.9",), ("-2",), ("x",), ("",), (None,), ("1e3",)], "s string")
    assert [r.n for r in df.select(int_or_zero(F.col("s")).alias("n")).collect()] == [12, 7, 3, -2, 0, 0, 0, 1000]
    one = spark.createDataFrame([(1, "q", None)], "b int, a string, c string")
    assert one.select((canonical_hash(["b", "a", "c"]) == F.sha2(F.lit('{"a":"q","b":1}'), 256)).alias("e")).first().e
    assert one.select(endpoint(F.lit("m"), F.col("c"), {"a": F.lit("x y"), "c": F.col("c")}).alias("u")).first().u == "/m?a=x+y"
    assert one.select(endpoint(F.lit("m"), F.col("a"), {}).alias("u")).first().u == "/m/q"


def test_zipped_lists_and_sets(spark):
    df = spark.createDataFrame([(1, ["a", "b"], [5]), (2, None, [1]), (3, [], [])], "id int, x array<string>, y array<int>")
    assert [tuple(r) for r in joins.phrases_of(df, {"p": F.col("x"), "q": F.col("y")}).select("id", "place", "p", "q").collect()] == [(1, 0, "a", 5)]
    a = spark.createDataFrame([("k", ["b", "a"]), ("l", ["z"])], "k string, v array<string>")
    b = spark.createDataFrame([("k", ["a", "c"]), ("m", ["q"])], "k string, v array<string>")
    assert {r.k: r.v for r in joins.united_sets(a, b, "k", "v").collect()} == {"k": ["a", "b", "c"], "l": ["z"]}


def test_wav_chunks(spark):
    fmt = b"fmt " + struct.pack("<IHHIIHH", 16, 1, 2, 8000, 32000, 4, 16)
    data = struct.pack("<8h", *([100, 300] * 4))
    body = lambda *chunks: b"RIFF" + struct.pack("<I", 0) + b"WAVE" + b"".join(chunks)
    files = [body(b"LIST" + struct.pack("<I", 3) + b"abc\0", fmt, b"data" + struct.pack("<I", len(data)) + data), body(fmt), b"no sound", None, b""]
    df = spark.createDataFrame([(f,) for f in files], "content binary")
    got = [r.w for r in df.select(readers.wav_samples(F.col("content")).alias("w")).collect()]
    assert (got[0].channels, got[0].rate, got[0].bits, got[0].data_bytes) == (2, 8000, 16, 16)
    assert len(got[0].samples) == 8 and all(abs(x - 200 / 32768) < 1e-6 for x in got[0].samples)
    assert (got[1].rate, got[1].data_bytes, got[1].samples) == (8000, None, [])
    assert all(g.rate is None and g.samples == [] for g in got[2:])
    r = spark.createDataFrame([('{"results":{"channels":[{"alternatives":[{"transcript":"hi","confidence":0.5}]}]}}',), ("{}",), ("x",), (None,)], "j string")
    assert [x.b and x.b.transcript for x in r.select(readers.best_alternative(F.col("j")).alias("b")).collect()] == ["hi", None, None, None]


def test_send_rates_and_summary(spark):
    df = spark.createDataFrame([("s", 0.0, True), ("s", 4.0, False), ("s", 2.0, True), ("t", 1.0, True), ("u", None, None)], "k string, at double, ok boolean")
    got = {r.k: (r.n, r.n_ok, r.n_failed, r.duration_s, r.actual_rps) for r in metrics.send_rates(df, ["k"], F.col("at"), F.col("ok")).collect()}
    assert got == {"s": (3, 2, 1, 4.0, 0.5), "t": (1, 1, 0, 0.0, 0.0), "u": (1, 0, 1, 0.0, 0.0)}
    assert readers.describe_catalog(spark, {"t": df}).count() == 3
