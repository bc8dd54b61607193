import random

from cadenza.operators import orphans
from cadenza.plans.skew import hot_keys, skew_join


def test_hot_keys(spark):
    df = spark.createDataFrame([("a",)] * 10 + [("b",)] * 3 + [(None,)] * 7, "k string")
    assert {(r.k, r.n_hot) for r in hot_keys(df, ["k"], 5).collect()} == {("a", 10), (None, 7)}
    assert hot_keys(df, ["k"], 10) is None


def test_skew_join_is_the_join(spark):
    r = random.Random(1)
    left = spark.createDataFrame([(r.choice(["h", "h", "h", "a", "b", None]), i, "x") for i in range(300)], "k string, i int, _m string")
    right = spark.createDataFrame([("h", 1), ("h", 2), ("a", 3), (None, 4), ("z", 5)], "k string, v int")
    for how in ("inner", "left", "left_semi", "left_anti"):
        want = sorted(map(repr, left.join(right, ["k"], how).collect()))
        for hot in (1_000_000, 20, 1):
            got = skew_join(left, right, ["k"], how, hot)
            assert sorted(map(repr, got.select(left.join(right, ["k"], how).columns).collect())) == want, (how, hot)


def test_orphans_with_hot_references(spark):
    refs = spark.sql("SELECT CASE WHEN id % 2 = 0 THEN 'hot' ELSE concat('k', id % 50) END AS key, timestamp_ntz'2025-01-01' + make_interval(0, 0, 0, cast(id % 20 as int), 0, 0, 0) AS at, id FROM range(400)")
    parents = spark.sql("SELECT * FROM VALUES ('hot', timestamp_ntz'2025-01-05', timestamp_ntz'2025-01-09'), ('hot', timestamp_ntz'2025-01-12', null), ('k1', timestamp_ntz'2025-01-03', null) AS v(key, begins, ends)")
    plain = sorted((r.id, r.state) for r in orphans.orphans(refs, parents).collect())
    assert plain == sorted((r.id, r.state) for r in orphans.orphans(refs, parents, hot_rows=15).collect())
    assert {s for _, s in plain} == {"late", "deleted", "missing"}
