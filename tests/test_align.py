import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cadenza.operators import align


def test_item_vectors():
    a = align.align_items
    assert a(["d_sound", "m_letter"], ["dʌ", "ɛm"], ["d", "ɛn"], [0.6, 0.7])[1] == [False, False]
    assert a(["k_letter"], ["ka"], ["zi"], [0.3])[:2] == (["-"], [True])
    assert a(["f_sound"] * 2, ["fʌ", "fʌ"], ["fʌ", "v"], [0.55, 0.35]) == (["fʌ", "v"], [False, False], [0.55, 0.35])
    assert a([], [], [], []) == ([], [], [])
    # an insertion shifts what follows and pushes it off the end
    assert a(["k_letter"], ["ka"], ["ti", "ka"], [0.6, 0.7]) == (["ti"], [True], [0.3])
    assert a(["k_letter"], ["ka"], ["ti", "ka"], [None, 0.7])[2] == [0.0]


@given(st.lists(st.sampled_from(["a_letter", "b_sound", "zz"]), max_size=6), st.lists(st.sampled_from("abɛx"), max_size=6), st.lists(st.sampled_from("abɛx"), max_size=6))
def test_always_one_entry_an_item(expected, reference, heard):
    out = align.align_items(expected, reference, heard, [0.5] * (len(heard) // 2))
    assert all(len(x) == len(expected) for x in out)


def test_aligned_column(spark):
    rows = [(["p_letter"], ["pi"], ["pi"], [0.7]), (["p_letter", "d_sound"], ["pi"], ["pi"], []), (["p_letter"], ["pi"], [], []), ([], [], [], []), (["p_letter"], None, None, None), (["m_letter", "d_sound"], ["ɛm", "dʌ"], ["ɛn", "d"], [0.6, 0.5])]
    rows += [(["p_letter"] * 2, ["pi", None], ["pi"], [0.4]), (["p_letter"], ["pi"], [None, "pi"], [0.4])]
    df = spark.createDataFrame(rows, "e array<string>, r array<string>, h array<string>, c array<double>")
    got = [tuple(r.x) for r in df.select(align.aligned_items(F.col("e"), F.col("r"), F.col("h"), F.col("c")).alias("x")).collect()]
    want = [(["pi"], [False], [0.7]), (["pi", "-"], [False, True], [0.0, 0.0]), (["-"], [True], [0.0]), ([], [], []), (["-"], [True], [0.0]), (["ɛn", "d"], [False, False], [0.6, 0.5])]
    # a null element: the row can't be aligned
    assert got == want + [(["-", "-"], [True, True], [0.0, 0.0]), (["-"], [True], [0.0])]


def test_word_and_sound_matches(spark):
    assert align.word_matches("two small frogs jump in".split(), "two frogs then jump".split()) == [1, 0, 1, 1, 0]
    assert align.sound_matches(["sɪlvɝ", "mun"], ["sɪl", "vɝ"]) == [1, 0]
    assert align.sound_matches(["mun"], ["sɪl", "nun", "vɝ"]) == [1]
    df = spark.createDataFrame([("green field", "old barn"), ("", "x"), ("a b", ""), ("a b", None), ("a b", "a b"), (None, "a")], "a string, b string")
    assert [r.m for r in df.select(align.matched_words(F.col("a"), F.col("b")).alias("m")).collect()] == [[0, 0], [], [0, 0], [0, 0], [1, 1], []]


def test_decode():
    d = align.decode_stream
    assert d(["m", "m", "|", "o"], [0.5, 0.25, 0.0, 0.75]) == (["m", "o"], [0.375, 0.75])
    assert d(["|", "m", "|", "|", "o", "|"], [0, 0.5, 0, 0, 0.75, 0]) == (["m", "o"], [0.5, 0.75])
    assert d(["??", "o", "long token"], [0.1, 0.5, 0.2]) == (["o"], [0.5])
    assert d(["??"], [0.1]) == ([], []) and d([], []) == ([], [])
    with pytest.raises(ValueError):
        d(["o", "??"], [0.5, 0.1], strict=True)
    assert d(["o", "|"], [0.5, 0.1], strict=True) == (["o"], [0.5])
    assert d(["z", "<pad>", "z"], [0.2, 0.9, 0.4])[0] == ["z"]


def slow_common(a, b):
    """Cell by cell, from the ends."""
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a) - 1, -1, -1):
        for j in range(len(b) - 1, -1, -1):
            best[i][j] = best[i + 1][j + 1] + 1 if a[i] == b[j] else max(best[i + 1][j], best[i][j + 1])
    return best[0][0]


@given(st.lists(st.sampled_from("abcd"), max_size=9), st.lists(st.sampled_from("abcd"), max_size=9))
def test_common_subsequence(a, b):
    got = align.common_subsequence(a, b)
    assert len(got) == slow_common(a, b)
    assert all(a[i] == b[j] for i, j in got) and all(p[0] < q[0] and p[1] < q[1] for p, q in zip(got, got[1:]))


def test_long_sequences():
    a = [str(k % 97) for k in range(3000)]
    assert len(align.common_subsequence(a, a[5:] + ["x"] * 5)) == 2995


def timings(spark, phrases, tokens, start=1000):
    df = spark.createDataFrame([("a", 0, start, phrases, tokens)], "activity_id string, page_index int, page_start int, phrases array<string>, tokens array<struct<word:string,start:double,end:double>>")
    return [(r.start_ms, r.end_ms, r.parsed) for r in align.phrase_timings(df).orderBy("phrase").collect()]


def test_phrase_timings(spark):
    toks = [("two", 1.2, 1.4), ("frogs", 1.4, 1.9), ("jump", 2.2, 2.6), ("over", 2.7, 2.9), ("logs", 3.1, 3.6)]
    assert [x[:2] for x in timings(spark, ["two frogs", "jump over logs"], toks)] == [(1200, 1900), (2200, 3600)]
    toks = [("two", 1.2, 1.4), ("old", 2.1, 2.4), ("barns", 2.5, 3.3)]
    assert timings(spark, ["two frogs", "old barns"], toks) == [(1200, 1400, "two"), (2100, 3300, "old barns")]
    assert timings(spark, ["two", "frogs"], []) == [(1000, 1000, ""), (1000, 1000, "")]
    assert timings(spark, [], toks) == []
