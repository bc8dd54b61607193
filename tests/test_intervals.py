import random

from hypothesis import given, settings
from hypothesis import strategies as st

from cadenza.operators import intervals

SCHEMA = "k string, start_ms long, end_ms long, kind string"


def brute(rows):
    out = []
    by = {}
    for k, a, b, _ in rows:
        if None not in (k, a, b) and b > a:
            by.setdefault(k, []).append((a, b))
    for k, xs in by.items():
        merged = []
        for a, b in sorted(xs):
            if merged and a <= merged[-1][1]:
                merged[-1][1] = max(merged[-1][1], b)
            else:
                merged.append([a, b])
        out += [(k, "period", a, b) for a, b in merged]
        out += [(k, "gap", x[1], y[0]) for x, y in zip(merged, merged[1:])]
    return sorted(out)


def run(spark, rows, **sizes):
    df = spark.createDataFrame(rows, SCHEMA)
    return sorted(tuple(r) for r in intervals.periods_and_gaps(df, ["k"], **sizes).collect())


def test_brute_force_plain_and_sliced(spark):
    r = random.Random(3)
    rows = []
    for _ in range(600):
        a = r.choice([r.randint(-500, 3000), None] if r.random() < 0.05 else [r.randint(-500, 3000)])
        b = None if a is None else a + r.choice([0, -5, 10, 25, 400, 1500])
        rows.append((r.choice(["hot", "hot", "a", "b", None]), a, b, "x"))
    rows += [("t", 0, 10, ""), ("t", 10, 20, ""), ("t", 10, 20, ""), ("t", 21, 22, ""), ("n", 0, 100, ""), ("n", 10, 20, "")]
    want = brute(rows)
    assert run(spark, rows) == want
    assert run(spark, rows, hot_rows=20, slice_ms=100) == want
    assert run(spark, rows, hot_rows=1, slice_ms=7) == want


def test_empty_and_invalid_only(spark):
    assert run(spark, []) == []
    assert run(spark, [("a", 5, 5, ""), ("a", 9, 2, ""), (None, 1, 2, ""), ("a", None, 2, "")]) == []


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["a", "b"]), st.integers(0, 60), st.integers(-2, 20)), max_size=25))
def test_property(spark, xs):
    rows = [(k, a, a + n, "") for k, a, n in xs]
    assert run(spark, rows, hot_rows=3, slice_ms=10) == brute(rows)


def test_found_takes_both_tables(spark):
    w = spark.createDataFrame([(1, "a", 0, 0.0, 0.5), (2, "a", 0, 0.4, 1.0), (3, "a", None, 0.0, 1.0), (4, "a", 0, float("nan"), 9.0), (5, "a", 0, 2.0, 3.0)], "word_id long, activity_id string, page_index int, start double, end double")
    p = spark.createDataFrame([("a", 0, 100, 200), ("a", 1, None, 300), ("a", 2, 200, 250)], "activity_id string, page_index int, start_time int, end_time int")
    got = sorted(tuple(r) for r in intervals.found(w, p).collect())
    assert got == [("page_data", "a", -1, "period", 100, 250), ("word_items", "a", 0, "gap", 1000, 2000), ("word_items", "a", 0, "period", 0, 1000), ("word_items", "a", 0, "period", 2000, 3000)]
