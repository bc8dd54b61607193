from datetime import datetime, timedelta

from cadenza.operators import orphans

D = lambda n: datetime(2025, 1, 1) + timedelta(days=n)
REFS = "key string, at timestamp_ntz, id int, state_of string"
PARENTS = "key string, begins timestamp_ntz, ends timestamp_ntz"


def state(refs, parents):
    out = {}
    for k, t, i, _ in refs:
        if k is None or t is None:
            continue
        mine = [(b, e) for p, b, e in parents if p == k]
        if any(b is not None and b <= t and (e is None or t < e) for b, e in mine):
            continue
        known = [b for b, _ in mine if b is not None]
        out[i] = "missing" if not mine else "deleted" if any(b <= t for b in known) else "late"
    return out


def test_states(spark):
    parents = [("a", D(0), None), ("b", D(5), None), ("b", D(9), D(10)), ("c", D(0), D(3)), ("c", D(0), D(3)), ("c", D(6), D(8)), (None, D(0), None), ("n", None, None)]
    refs = [(k, D(t), 100 * t + i, "x") for t in range(12) for i, k in enumerate(["a", "b", "c", "zz", None, "n"])] + [("a", None, 9999, "x")]
    got = orphans.orphans(spark.createDataFrame(refs, REFS), spark.createDataFrame(parents, PARENTS))
    assert {r.id: r.state for r in got.collect()} == state(refs, parents)


def test_filter_lets_every_key_through(spark):
    keys = spark.createDataFrame([(f"k{i}",) for i in range(3000)], "key string")
    f = orphans.KeyFilter.of(keys, "key")
    assert keys.where(~f.may_hold(keys, keys.key)).count() == 0
    other = spark.createDataFrame([(f"z{i}",) for i in range(3000)], "key string")
    assert other.where(f.may_hold(other, other.key)).count() < 200


def test_small_filter_gives_the_same(spark):
    parents = spark.createDataFrame([(f"k{i}", D(0), None) for i in range(500)], PARENTS)
    refs = spark.createDataFrame([(f"k{i}", D(1), i, "") for i in range(900)], REFS)
    assert orphans.orphans(refs, parents).count() == 400


def test_empty(spark):
    refs, parents = spark.createDataFrame([], REFS), spark.createDataFrame([], PARENTS)
    assert orphans.orphans(refs, parents).count() == 0
    some = spark.createDataFrame([("a", D(0), 1, "")], REFS)
    assert [r.state for r in orphans.orphans(some, parents).collect()] == ["missing"]


def test_found(spark):
    acts = spark.createDataFrame([("a1", " S1", D(5)), ("a1", "s1", D(5)), ("a2", None, D(5)), ("a3", " ", D(5)), ("a4", "s9", D(40))], "activityid string, storyid string, createdat timestamp_ntz")
    phrases = spark.createDataFrame([("s1", 0, D(0), None), ("S1 ", 1, D(6), None), ("s1", None, D(0), None)], "storyid string, phraseindex int, loaded_at timestamp_ntz, deleted_at timestamp_ntz")
    segs = spark.createDataFrame([(1, "a1", 0, D(6)), (2, "a1", 1, D(5)), (3, "a1", 7, D(6)), (4, "zz", 0, D(6)), (5, "a1", None, D(6)), (6, "a2", 0, D(6)), (7, "a4", 0, D(39)), (8, None, 0, D(6))], "segment_id long, activityid string, phraseindex int, created_at timestamp_ntz")
    got = {tuple(r) for r in orphans.found(acts, segs, phrases).collect()}
    assert got == {
        ("activity_v", "a4", "story_phrase", "missing", "2025-02"),
        ("segment_manifest", "2", "story_phrase", "late", "2025-01"),
        ("segment_manifest", "3", "story_phrase", "missing", "2025-01"),
        ("segment_manifest", "4", "activity_v", "missing", "2025-01"),
        ("segment_manifest", "7", "activity_v", "late", "2025-02"),
        ("segment_manifest", "7", "story_phrase", "missing", "2025-02"),
    }
    assert orphans.report(orphans.found(acts, segs, phrases)).agg({"n_orphans": "sum"}).first()[0] == 6
