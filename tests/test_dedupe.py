import random
from datetime import datetime, timedelta

from cadenza.operators import dedupe

SCHEMA = "delivery_id long, batch_id long, received_at timestamp_ntz, activity_id string, source string, timestamp long, _keep string"
T0 = datetime(2025, 1, 1)


def brute(rows):
    """Deliveries to drop."""
    best, drop = {}, set()
    for d, _, at, a, s, t, _ in sorted(rows, key=lambda r: (r[2] is None, r[2] or T0, r[0])):
        if a is None or not a.strip():
            continue
        sec = None if t is None else t // 1000 if t >= 100_000_000_000 else t
        key = (a.strip().lower(), None if s is None else s.strip().lower(), sec)
        if key in best:
            drop.add(d)
        best.setdefault(key, d)
    return drop


def rows_of(n, seed):
    r = random.Random(seed)
    out = []
    for i in range(n):
        a = r.choice(["HOT", "HOT", " hot\t", "a", "A ", " b", None, "", "  ", f"x{i}"])
        t = r.choice([1736121600, 1736121600999 // 1, 1736121600000, None, 7, i])
        out.append((i, i // 10, r.choice([None, T0 + timedelta(seconds=r.randint(0, 3))]), a, r.choice([None, "", "S", " s"]), t, "mine"))
    return out


def test_found_is_brute_force(spark):
    rows = rows_of(800, 1)
    df = spark.createDataFrame(rows, SCHEMA)
    for sizes in ({}, {"part_rows": 7}, {"part_rows": 7, "hot_rows": 30}, {"hot_rows": 1}):
        got = dedupe.tag_deliveries(df.drop("_keep"), **sizes).where("NOT _keep").collect()
        assert {r.delivery_id for r in got} == brute(rows)
    assert {r[0] for r in dedupe.found(df).collect()} == brute(rows)


def test_stored_and_new(spark):
    rows = rows_of(300, 2)
    df = spark.createDataFrame(rows, SCHEMA).drop("_keep")
    kept = dedupe.keep_one(df.where("delivery_id >= 150"), df.where("delivery_id < 150"))
    # deliveries without an activity name no message: all of them stay
    assert sorted(r.delivery_id for r in kept.collect()) == sorted({r[0] for r in rows} - brute(rows))
    ids = dedupe.kept(df.where("delivery_id < 150"), df.where("delivery_id >= 150"))
    assert sorted(r[0] for r in ids.collect()) == sorted({r[0] for r in rows} - brute(rows))


def test_empty(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert dedupe.found(df).count() == 0


def test_one_keep_of_each_identifier_with_clashing_columns(spark):
    df = spark.createDataFrame([(i, 0, T0, "k", "s", 1, "c") for i in range(50)], SCHEMA).withColumnRenamed("batch_id", "a")
    got = dedupe.tag_deliveries(df.drop("_keep"), part_rows=5)
    assert [r.delivery_id for r in got.where("_keep").collect()] == [0]
    assert "a" in got.columns
