import random

import numpy as np

from cadenza.llm import nearest

W = "word_id long, activity_id string, page_index int, word string, start double, end double, t string, entity string"
R = "trans_id long, activity_id string, start_time double, end_time double, id string"


def brute(words, trans):
    ms = lambda x: round(x * 1000)
    out = {}
    for w in words:
        if w[1] is None or w[4] is None or w[4] != w[4]:
            continue
        best = min(((abs(ms(t[2]) - ms(w[4])), ms(t[2]), t[0]) for t in trans if t[1] == w[1] and t[2] is not None and t[2] == t[2] and t[3] is not None and ms(t[3]) > ms(t[2])), default=None)
        if best and best[0] <= 250:
            out[w[0]] = best[2]
    return out


def data(n, seed):
    r = random.Random(seed)
    ent = lambda: r.choice(["hot"] * 5 + ["a", "b", "", None])
    time = lambda: r.choice([None, float("nan")]) if r.random() < 0.04 else round(r.choice([r.uniform(-2, 30), 5.0, 1199.9, 1200.1]), 3)
    words = [(i, ent(), 0, "w", time(), None, "x", "y") for i in range(n)]
    trans = []
    for i in range(n):
        s = time()
        trans.append((5000 + i, ent(), s, None if s is None or r.random() < 0.05 else s + r.choice([0.2, 0.2, 0.0, -0.1]), "z"))
    return words, trans


def test_brute_force(spark, save):
    words, trans = data(400, 1)
    want = brute(words, trans)
    d = save(word_items=(words, W), word_transcriptions=(trans, R))
    assert {r.word_id: r.trans_id for r in nearest.found(spark, d).collect()} == want
    # every word with an activity and a start comes out once, matched or not
    every = nearest.words(spark, d).collect()
    assert sorted(r.word_id for r in every) == [w[0] for w in words if w[1] is not None and w[4] is not None and w[4] == w[4]]
    # salted hot buckets, pre-aggregated dense ones, many shards and slices
    small = nearest.words(spark, d, bucket_ms=1000, hot_rows=10, shard_rows=20, slice_rows=300).where("trans_id IS NOT NULL")
    assert {r.word_id: r.trans_id for r in small.collect()} == want


def test_empty(spark, save):
    words, trans = data(30, 2)
    assert nearest.found(spark, save(word_items=([], W), word_transcriptions=(trans, R))).count() == 0
    assert nearest.found(spark, save(word_items=(words, W), word_transcriptions=([], R))).count() == 0


def test_match_sorted_ties():
    m = lambda lt, rt, rid: nearest.match_sorted(np.zeros(len(lt), int), np.array(lt), np.zeros(len(rt), int), np.array(rt), np.array(rid), 250).tolist()
    assert m([100], [0, 200], [7, 3]) == [0]  # equal distance: the earlier
    assert m([100], [150, 150, 150], [9, 2, 5]) == [1]  # equal time: the smaller id
    assert m([100], [50, 50], [9, 2]) == [1]
    assert m([0, 251], [500], [1]) == [-1, 0]
    assert m([0], [251], [1]) == [-1]


def test_stream_emits_behind_the_watermark_and_evicts(spark, tmp_path):
    import pyspark.sql.functions as F

    ids = {}
    for n, (left, right) in enumerate([([(1, 1000), (2, 5000)], [(11, 1100)]), ([(3, 60000)], [(12, 5100), (13, 60100)]), ([(4, 120000)], [(14, 119900)])]):
        spark.createDataFrame([("a", t, i) for i, t in left], "entity string, t long, id long").coalesce(1).write.mode("append").parquet(f"{tmp_path}/l")
        spark.createDataFrame([("a", t, i) for i, t in right], "entity string, t long, id long").coalesce(1).write.mode("append").parquet(f"{tmp_path}/r")
    stream = lambda p: spark.readStream.schema("entity string, t long, id long").option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/{p}")
    out = nearest.nearest_stream(stream("l"), stream("r"), 250, 3, delay="30 seconds")

    def keep(b, n):
        for r in b.collect():
            ids[r.left_id] = (n, r.right_id)

    q = out.writeStream.foreachBatch(keep).option("checkpointLocation", f"{tmp_path}/c").trigger(availableNow=True).start()
    q.awaitTermination()
    # those within 30 s of the end are still pending
    assert {k: v[1] for k, v in ids.items()} == {1: 11, 2: 12, 3: 13}
    assert ids[1][0] < ids[3][0]
    assert F is not None


def test_replay_emits_slice_by_slice_and_keeps_little(spark, save):
    """Pairs come out before the last slice, and the words that wait stay far below the input."""
    import glob

    r = random.Random(4)
    words = [(i, f"e{i % 40}", 0, "w", round(i / 50, 2), None, "x", "y") for i in range(5000)]
    trans = [(10_000 + i, f"e{i % 40}", round(i / 50 + r.uniform(-0.2, 0.2), 3), 200.0, "z") for i in range(5000)]
    d = save(word_items=(words, W), word_transcriptions=(trans, R))
    waiting, dropped, arrived = [], 0, 0

    def watch(progress):
        nonlocal dropped, arrived
        state = progress["stateOperators"][0]
        dropped += state["numRowsDroppedByWatermark"]
        arrived += progress["numInputRows"]
        folder = max(glob.glob(spark.conf.get("spark.checkpoint.dir").removeprefix("file://") + "/nearest-*/pairs"), key=lambda f: __import__("os").path.getmtime(f))
        out = spark.read.schema(nearest.OUT).parquet(folder).count() if glob.glob(folder + "/*.parquet") else 0
        waiting.append(arrived / 2 - out)  # about half of what arrived is words

    out = nearest.words(spark, d, slice_rows=1000, watch=watch)
    assert {x.word_id: x.trans_id for x in out.where("trans_id IS NOT NULL").collect()} == {k: v for k, v in brute_sorted(words, trans).items() if v is not None}
    assert len(waiting) == 12 and dropped == 0
    assert max(waiting) < 1600 and waiting[-1] < 50


def brute_sorted(words, trans):
    """As brute, by entity and with a search in the sorted times."""
    import bisect

    by = {}
    for t in trans:
        if t[3] > t[2]:
            by.setdefault(t[1], []).append((round(t[2] * 1000), t[0]))
    out = {}
    for e in by:
        by[e].sort()
    for w in words:
        mine, at = by.get(w[1], []), round(w[4] * 1000)
        k = bisect.bisect_left(mine, (at, -1))
        near = [(abs(x - at), x, i) for x, i in mine[max(0, k - 3) : k + 3]]
        best = min(near, default=None)
        out[w[0]] = best[2] if best and best[0] <= 250 else None
    return out


def test_replay_keeps_few_state_partitions(spark, save):
    """A slice is a small part of the tables: many shuffle partitions don't each cost a task in every micro-batch (F1)."""
    words, trans = data(600, 7)
    d = save(word_items=(words, W), word_transcriptions=(trans, R))
    seen, before = [], spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "32")
    try:
        got = nearest.words(spark, d, shard_rows=10, slice_rows=80, watch=lambda p: seen.append(p["stateOperators"][0]["numShufflePartitions"])).where("trans_id IS NOT NULL").collect()
        assert spark.conf.get("spark.sql.shuffle.partitions") == "32"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert {r.word_id: r.trans_id for r in got} == brute(words, trans)
    assert seen and max(seen) <= 8


def test_shards_are_dealt_evenly(spark):
    from collections import Counter

    import pyspark.sql.functions as F

    shards = nearest._dealt(spark, 50, 7)
    homes = spark.createDataFrame([(x,) for x in shards], "shard int").repartition(7, "shard").select(F.spark_partition_id()).collect()
    assert Counter(Counter(r[0] for r in homes).values()) == {8: 7} and len(shards) == 56


def test_small_replay_has_no_task_without_a_shard(spark, save):
    """What a micro-batch holds fits one shard: it costs one task, whatever the cores and shuffle partitions (F2)."""
    words, trans = data(400, 8)
    d, seen = save(word_items=(words, W), word_transcriptions=(trans, R)), []
    got = nearest.words(spark, d, hot_rows=20, slice_rows=60, watch=lambda p: seen.append(p["stateOperators"][0]["numShufflePartitions"])).where("trans_id IS NOT NULL").collect()
    assert {r.word_id: r.trans_id for r in got} == brute(words, trans)
    assert seen and max(seen) == 1


def test_milliseconds_are_rounded_without_decimals(spark):
    """As round(), on halves, their neighbours, both signs and the ends of the clock; and not by way of it (F2)."""
    import pyspark.sql.functions as F

    r = random.Random(9)
    x = [0.0, -0.0, float("nan"), None, float("inf"), 0.0005, 0.0015, 1.0005, 8.0025, 4e9, -4e9, 3999999999.9995, 123456789.0005, 0.49999999999999994 / 1000, 0.5000000000000001 / 1000]
    x += [k / 2000 for k in range(1, 400)] + [np.nextafter(k / 2000, to).item() for k in range(1, 400) for to in (0, 9)] + [r.uniform(0, 10.0 ** r.randrange(-4, 10)) for _ in range(2000)]
    x += [-v for v in x if v is not None]
    df = spark.createDataFrame([(v,) for v in x], "x double")
    want = F.when(F.abs("x") < nearest.FAR / 1000, F.round(F.col("x") * 1000).cast("bigint"))
    assert df.where(~nearest._ms("x").eqNullSafe(want)).count() == 0
    assert "round(" not in df.select(nearest._ms("x"))._jdf.queryExecution().optimizedPlan().toString().lower()
