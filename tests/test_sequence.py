import random
from itertools import groupby

from pyspark.sql import functions as F

from cadenza.functions import sequences as S
from cadenza.operators import sequence as Q
from cadenza.plans.scan import before


def one(spark, col, **arrays):
    """The value of a column over one row of typed arrays: name=(value, type)."""
    schema = ", ".join(f"{k} {t}" for k, (_, t) in arrays.items())
    return spark.createDataFrame([tuple(v for v, _ in arrays.values())], schema).select(col.alias("x")).first().x


def test_before_plain_and_sliced(spark):
    r = random.Random(1)
    rows = [(r.choice(["hot", "hot", "a", None]), t, r.choice([None, r.randint(0, 9)])) for t in range(300)]
    df = spark.createDataFrame(rows, "k string, t int, v int")
    aggs = {"s": ("sum", F.col("v")), "n": ("count", F.col("v")), "m": ("max", F.col("v")), "l": ("last", F.col("v"))}
    want = {}
    for k in {x[0] for x in rows}:
        seen = []
        for _, t, v in [x for x in rows if x[0] == k]:
            want[t] = (sum(seen), len(seen), max(seen, default=None), seen[-1] if seen else None)
            seen += [] if v is None else [v]
    for hot in (1_000_000, 20):
        got = before(df, ["k"], ["t"], aggs, F.floor(F.col("t") / 13), hot)
        assert {x.t: (x.s, x.n, x.m, x.l) for x in got.collect()} == want


def test_runs_and_segments(spark):
    toks = ["t", "t", "<pad>", "t", "|", "|", "æ", "æ", "b", None, None]
    df = spark.createDataFrame([("k", i, t, float(i)) for i, t in enumerate(toks)], "k string, i int, t string, p double")
    segs = Q.segments(df, ["k"], ["i"], "t").collect()
    assert [(x.t, x.segment) for x in sorted(segs, key=lambda x: x.i)] == [("t", 0)] * 3 + [("æ", 2)] * 2 + [("b", 2)] + [(None, 2)] * 2
    runs = Q.runs(df.where("t IS NULL OR t NOT IN ('|', '<pad>')"), ["k"], ["i"], "t", "p").collect()
    assert [(x.t, x.n) for x in sorted(runs, key=lambda x: x.run)] == [(k, len(list(g))) for k, g in groupby([t for t in toks if t not in ("|", "<pad>")])]


def test_mean_of_means(spark):
    df = spark.createDataFrame([("k", i, t, p) for i, (t, p) in enumerate(zip("ttt|æ", [0.01, 0.99, 0.5, 0.0, 1.0]))], "k string, i int, t string, p double")
    got = {x.segment: round(x.confidence, 6) for x in Q.mean_of_means(df, ["k"], ["i"], "t", "p", "|").collect()}
    assert got == {0: 0.5, 1: 1.0}


def test_timeline_rounds_half_to_even(spark):
    df = spark.createDataFrame([("a", 0, 48), ("a", 1, 80), ("a", 2, 3200)], "a string, i int, b long")
    got = [(x.start_ms, x.end_ms) for x in Q.timeline(df, ["a"], "i", "b").orderBy("i").collect()]
    assert got == [(0, 2), (2, 4), (4, 104)]


def test_continuous(spark):
    df = spark.createDataFrame([("a", 0, 100, 500), ("a", 1, 400, 300), ("a", 2, None, None), ("a", 3, 900, 1000)], "a string, i int, s int, e int")
    got = [(x.s, x.e) for x in Q.continuous(df, ["a"], ["i"], "s", "e", F.lit(50)).orderBy("i").collect()]
    assert got == [(100, 500), (500, 500), (500, 500), (900, 1000)]


def test_missing_and_streaks(spark):
    df = spark.createDataFrame([("a", i) for i in (0, 1, 4, 7)] + [("b", 0), ("b", None)], "a string, i int")
    assert sorted(x.i for x in Q.missing_indices(df, ["a"], "i").collect()) == [2, 3, 5, 6]
    assert sorted((x.from_index, x.n) for x in Q.miss_streaks(df, ["a"], "i").collect()) == [(2, 2), (5, 2)]


def test_start_sequence_and_map(spark):
    df = spark.createDataFrame([("a", 0, 0, "x", 1), ("a", 0, 3, "y", 2), ("a", 0, 3, "z", 3), ("a", 2, 5, "w", 4), ("a", None, 9, "q", 5)], "a string, i int, s int, f string, o int")
    assert [(x.i, x.start_seq) for x in Q.start_sequence(df, ["a"], "i", "s").orderBy("i").collect()] == [(0, 0), (2, 4)]
    m = {x.i: (x.files, x.last_file) for x in Q.segment_map(df.where("i IS NOT NULL"), ["a", "i"], "s", "f", "o").collect()}
    assert m == {0: ({0: "x", 3: "z"}, "z"), 2: ({5: "w"}, "w")}


def test_positions_and_as_of(spark):
    a = spark.createDataFrame([("k", 5), ("k", 9), ("k", 12)], "k string, p int")
    b = spark.createDataFrame([("k", 1, "x"), ("k", 2, "y")], "k string, q int, v string")
    got = [(x.p, x.v) for x in Q.pair_by_position(a, b, ["k"], ["p"], ["q"]).orderBy("p").collect()]
    assert got == [(5, "x"), (9, "y"), (12, None)]
    l = spark.createDataFrame([("u", t, i) for i, t in enumerate([0, 5, 5, 20])], "u string, t int, id int")  # noqa: E741
    r = spark.createDataFrame([("u", 5, 100, 1.0), ("u", 5, 101, 2.0), ("u", 10, 102, None), ("z", 0, 1, 9.0)], "u string, t int, id int, v double")
    assert [(x.id, x.last_v) for x in Q.as_of(l, r, "u", "t", "id", "v", F.col("t")).orderBy("id").collect()] == [(0, None), (1, 2.0), (2, 2.0), (3, 2.0)]


def test_trim_trailing(spark):
    T, N = True, False  # noqa: N806
    for given, want in [
        ([[N, T, N], [T, N, T, T]], [[N, T, N], [T, N]]),
        ([[N, N], [T, N], [T, T, T]], [[N, N], [T, N]]),
        ([[T, T], [T, T]], [[T, T], [T, T]]),
        ([[T]], [[T]]),
        ([], []),
        ([[N, T], [T]], [[N, T], [T]]),
        ([[N], [T, T], [T, T]], [[N]]),
    ]:
        assert one(spark, S.trim_trailing(F.col("e")), e=(given, "array<array<boolean>>")) == want


def test_array_functions(spark):
    ints, flags, texts = "array<int>", "array<boolean>", "array<string>"
    assert one(spark, S.renest(F.col("f"), F.col("n")), f=(["a", "b", "c"], texts), n=([2, 0, 1], ints)) == [["a", "b"], [], ["c"]]
    assert one(spark, S.agree(F.col("m"), F.col("e")), m=([1, 0, 1], ints), e=([False, True], flags)) is True
    assert one(spark, S.agree(F.col("m"), F.col("e")), m=([1, 0], ints), e=([True, True], flags)) is False
    assert one(spark, S.vote(F.col("a"), F.col("b"), F.col("c")), a=([1, 1, 0, 0], ints), b=([0, 1, 0, 1], ints), c=([1, 0, 0, 0], ints)) == [False, False, True, True]
    assert one(spark, S.vote(F.col("a"), F.col("b"), F.col("c")), a=([], ints), b=([], ints), c=([], ints)) == []
    assert one(spark, S.vote(F.col("a"), F.col("b"), F.col("c")), a=([1], ints), b=([1, 0], ints), c=([1], ints)) is None
    assert one(spark, S.pad_errors(F.col("e"), F.lit(3)), e=([False], flags)) == [False, True, True]
    assert one(spark, S.pad_errors(F.col("e"), F.lit(0)), e=([False], flags)) is None
    assert one(spark, S.match_or_distance(F.col("m"), F.col("d")), m=(None, ints), d=([0, 2], ints)) == [1, 0]
    assert one(spark, S.count_ones(F.col("m")), m=(None, ints)) == 0
    assert one(spark, S.count_false(F.col("e")), e=([False, True, False], flags)) == 2
    assert one(spark, S.head_tail(F.col("p"), F.col("c"), F.col("f"), 2), p=([1.0, 2.0, 3.0], "array<double>"), c=([4.0], "array<double>"), f=(None, "array<double>")) == [2.0, 3.0, 4.0]
    assert one(spark, S.argmax(F.col("v")), v=([0.1, 0.9, 0.9], "array<double>")) == 1


def test_words_and_forms(spark):
    assert one(spark, S.longest_elements(F.col("s")), s=("thæ?q", "string")) == ["th", "æ"]
    assert one(spark, S.accepted(F.col("i"), F.col("p")), i=("a_letter", "string"), p=("ɛ", "string")) is True
    assert one(spark, S.accepted(F.col("i"), F.col("p")), i=("nothing", "string"), p=("ɛ", "string")) is False
    assert one(spark, S.phonetic_match(F.col("a"), F.col("b")), a=("ba", "string"), b=("xxva", "string")) is True
    assert one(spark, S.phonetic_match(F.col("a"), F.col("b")), a=("b.", "string"), b=("bx", "string")) is False
    assert one(spark, S.plain_phrase(F.col("t")), t=("It’s “HERE”, (Tom)!", "string")) == "its here tom"
    assert one(spark, S.words_of(F.col("t")), t=("  a \n b ", "string")) == ["a", "b"]
    assert one(spark, S.words_of(F.col("t")), t=("", "string")) == []
    for text, want in [("['a', \"it's\", 'x\\'y']", ["a", "it's", "x'y"]), ("[]", []), ("['a',]", ["a"]), ("nope", None), ("['a' 'b']", None)]:
        assert one(spark, S.parse_list(F.col("t")), t=(text, "string")) == want, text
