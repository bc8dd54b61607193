import json
import struct

import pytest
from pyspark.sql import functions as F

from cadenza.sources import readers, sinks
from cadenza.streaming import queue


def test_read_file(spark, tmp_path):
    (tmp_path / "a.csv").write_text("storyId,phraseIndex,expected_text,reference_phonemes\ns,0,\"['a', 'b']\",\"['x']\"\n")
    row = readers.read_story_phrases(spark, f"{tmp_path}/a.csv").first()
    assert (row.storyId, row.phraseIndex, row.expected_text, row.reference_phonemes) == ("s", 0, ["a", "b"], ["x"])
    with pytest.raises(ValueError):
        readers.read_file(spark, "a.txt")
    with pytest.raises(ValueError):
        readers.read_file(spark, "a.csv")


def test_pages_dictionary_thresholds(spark, tmp_path):
    (tmp_path / "st_3_page.txt").write_text("One\n\n two \n")
    p = readers.read_pages(spark, f"{tmp_path}/*_page.txt").first()
    assert (p.story, p.page_index, p.words, p.text) == ("st", 3, ["One", "two"], "One two")
    (tmp_path / "d.dic").write_text("cat k æ t\nlonely\ndog d\ncat c\n")
    assert {r.word: r.phonemes for r in readers.read_dictionary(spark, f"{tmp_path}/d.dic").collect()} == {"cat": "c", "dog": "d"}
    (tmp_path / "m1" / "assets").mkdir(parents=True)
    (tmp_path / "m1" / "assets" / "metadata.json").write_text(json.dumps({"properties": {"threshold": 0.55}}))
    assert [tuple(r) for r in readers.read_thresholds(spark, f"{tmp_path}/m1/assets/metadata.json").collect()] == [("m1", 0.55)]


def test_wav_and_listing(spark, tmp_path):
    head = b"RIFF" + struct.pack("<I", 0) + b"WAVEfmt " + struct.pack("<IHHIIHH", 16, 1, 1, 16000, 32000, 2, 16) + b"data" + struct.pack("<I", 0)
    (tmp_path / "a.wav").write_bytes(head + b"\0" * 3200)
    (tmp_path / "b.wav").write_bytes(head)
    got = {r.key.rsplit("/", 1)[1]: (r.rate, r.channels, r.bits, r.duration_ms) for r in readers.read_wav(spark, str(tmp_path)).collect()}
    assert got == {"a.wav": (16000, 1, 16, 100.0), "b.wav": (16000, 1, 16, 0.0)}
    assert {r.size for r in readers.list_objects(spark, str(tmp_path), "*.wav").collect()} == {44, 3244}
    keys = spark.createDataFrame([("a",), (None,), ("",)], "Key string")
    assert [r.key for r in readers.valid_keys(keys).collect()] == ["a", ""]


def test_transcript(spark):
    body = json.dumps({"data": [{"text": [{"word": "hi", "start": 0.1, "end": 0.2, "confidence": 0.9}]}]})
    df = spark.createDataFrame([(body,), (f"x\n{body}\nend",), ("broken",), (None,)], "t string")
    got = [r.w for r in df.select(readers.transcript_words(F.col("t")).alias("w")).collect()]
    assert [x and x[0].word for x in got] == ["hi", "hi", None, None]


def test_upsert_cache_results(spark, tmp_path):
    t = spark.createDataFrame([("a", 1, "x"), ("b", 2, "y")], "k string, n int, s string")
    c = spark.createDataFrame([("b", "z"), ("c", "w")], "k string, s string")
    assert sorted((r.k, r.n, r.s) for r in sinks.upserted(t, c, "k").collect() if r.k != "c") == [("a", 1, "x"), ("b", 2, "z")]
    cache = sinks.ResultCache(spark, 60, str(tmp_path / "c"))
    t.createOrReplaceTempView("t_cache")
    assert cache.query("SELECT count(*) AS n FROM t_cache").first().n == 2
    t.limit(1).createOrReplaceTempView("t_cache")
    assert cache.query("SELECT count(*) AS n FROM t_cache").first().n == 2
    sinks.write_results(t.select(F.lit("2025-01-01").alias("dt"), F.col("k").alias("activity_id"), "n"), str(tmp_path / "r"), per_activity=True)
    assert (tmp_path / "r" / "_SUCCESS").exists() and (tmp_path / "r" / "dt=2025-01-01" / "activity_id=a").is_dir()
    sinks.write_parquet(t, str(tmp_path / "p"))
    assert spark.read.parquet(str(tmp_path / "p")).count() == 2


def test_timing_json_and_report(spark):
    t = spark.createDataFrame([("a", 1, 0, 5, 9, "x"), ("a", 0, 1, 3, 4, "y"), ("a", 0, 0, 1, 3, "z")], "activity_id string, page_index int, phrase int, start_ms int, end_ms int, parsed string")
    doc = json.loads(sinks.timing_json(t).first().timing)
    assert [(p["page_index"], p["page_start"], p["page_end"], len(p["phrases"])) for p in doc["pages"]] == [(0, 1, 4, 2), (1, 5, 9, 1)]
    w = spark.createDataFrame([("cat", 1, 0, 0.5)], "word string, a int, b int, confidence double")
    assert sinks.report_lines(w).first().line == f"{'cat':16} {'1':4} {'0':4} 0.500"


def test_queue(spark, tmp_path):
    rows = [('{"activity_id": "a", "timestamp": 1}',), ("nope",), ('{"activity_id": " "}',), ("{}",), (None,)]
    spark.createDataFrame(rows, "value string").write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema("value string").parquet(f"{tmp_path}/in")
    queue.consume(stream, f"{tmp_path}/good", f"{tmp_path}/bad", f"{tmp_path}/c").awaitTermination()
    assert [r.activity_id for r in spark.read.parquet(f"{tmp_path}/good").collect()] == ["a"]
    assert sorted(r.reason for r in spark.read.parquet(f"{tmp_path}/bad").collect()) == ["no activity", "no activity", "not json", "not json"]
    # nothing new: a second run adds nothing
    queue.consume(stream, f"{tmp_path}/good", f"{tmp_path}/bad", f"{tmp_path}/c").awaitTermination()
    assert spark.read.parquet(f"{tmp_path}/good").count() == 1
    jobs = spark.createDataFrame([("a", 1), (" ", 2)], "activity_id string, timestamp long")
    assert queue.enqueue(jobs, f"{tmp_path}/out").count() == 1


def test_stream_windows_equal_the_batch(spark, tmp_path):
    from cadenza.operators.metrics import tumbling

    df = spark.sql("SELECT timestamp_ntz'2025-01-01' + make_interval(0, 0, 0, 0, 0, cast((id * 37) % 900 as int), 0) AS ts, concat('k', id % 3) AS k, cast(id as double) AS v FROM range(500)")
    df.repartition(4).write.parquet(f"{tmp_path}/e.parquet")
    batch = tumbling(spark.read.parquet(f"{tmp_path}/e.parquet"), "ts", "1 hour", ["k"], "v")
    stream = queue.stream_tumbling(spark, f"{tmp_path}/e.parquet", "ts", "1 hour", ["k"], "v", "1 minute")
    stream = stream.withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))
    assert sorted(batch.collect()) == sorted(stream.select(batch.columns).collect())
