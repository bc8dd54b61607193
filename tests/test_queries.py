"""Core queries over small tables that hold the cases which the test tables lack or hide."""

import pytest

from cadenza.plans import catalog

PAGES = "activity_id string, page_index int, phrase_indices array<int>, phrases array<string>, start_time int, end_time int"
WORDS = "word_id long, activity_id string, page_index int, word string, start double, end double"


@pytest.fixture(scope="module")
def pages(save):
    p = [
        ("a", 0, [3, 4], ["one two", "three"], 1000, 2000),
        ("a", 0, [3, 4], ["one two", "three"], 1000, 2000),  # repeated
        ("a", 1, [5], ["three four"], 2000, 4000),
        ("a", 2, [6, 7], ["five", "six"], 9000, 9500),  # no words
        ("a", 3, [8], ["one"], None, 9900),
        ("a", 4, [], [], 1000, 2000),  # no phrases
        ("b", 0, [0], ["one"], None, None),
    ]
    w = [
        (1, "a", 0, "one", 1.0, 1.2),
        (2, "a", None, "two", 1.3, 1.5),  # by time alone
        (3, "a", 1, "three", 2.5, 2.75),  # after the end of page 0, and in page 1
        (4, "a", 0, "four", 3.5, None),  # in page 1, whatever it says
        (5, "a", 2, "five", 20.0, 21.0),  # in no page
        (6, "b", 0, "one", 0.5, 0.6),
    ]
    return save(page_data=(p, PAGES), word_items=(w, WORDS))


def test_page_phrase_alignment_is_by_time_and_keeps_pages(spark, pages):
    got = catalog.queries()["page_phrase_alignment"](spark, pages).collect()
    assert sorted((r.activity_id, r.page_index, r.phrase, r.start_ms, r.end_ms, r.parsed) for r in got) == [
        ("a", 0, 0, 1000, 1500, "one two"),
        ("a", 0, 1, 2500, 2750, "three"),
        ("a", 1, 0, 2500, 2500, "three four"),
        ("a", 2, 0, 9000, 9000, ""),
        ("a", 2, 1, 9000, 9000, ""),
        ("a", 3, 0, 0, 0, ""),
        ("b", 0, 0, 0, 0, ""),
    ]


def test_timing_documents_hold_every_page(spark, pages):
    got = catalog.queries()["timing_document_rows"](spark, pages).collect()
    key = lambda r: (r.activity_id, r.page_index, r.phrase_idx or 0)
    assert [tuple(r) for r in sorted(got, key=key)] == [
        ("a", 0, 1000, 2000, 3, 1000, 1500, "one two", "one two"),
        ("a", 0, 1000, 2000, 4, 2500, 2750, "three", "three"),
        ("a", 1, 2000, 4000, 5, 2500, 2500, "three four", "three four"),
        ("a", 2, 9000, 9500, 6, 9000, 9000, "", "five"),
        ("a", 2, 9000, 9500, 7, 9000, 9000, "", "six"),
        ("a", 3, None, 9900, 8, 0, 0, "", "one"),
        ("a", 4, 1000, 2000, None, None, None, None, None),
        ("b", 0, None, None, 0, 0, 0, "", "one"),
    ]
    counts = catalog.queries()["timing_documents"](spark, pages).collect()
    assert sorted((r.activity_id, r.n_pages) for r in counts) == [("a", 5), ("b", 1)]


def test_whole_dictionary_and_unknown_words(spark, save):
    p = [("a", 0, [0], ["apple zebra", "quux none"], 0, 1)]
    s = [("s", 0, ["apple", "zebra", "none"], ["x", "y", None])]
    d = save(page_data=(p, PAGES), story_phrase=(s, "storyid string, phraseindex int, expected_text array<string>, reference_phonemes array<string>"))
    r = catalog.queries()["dictionary_join"](spark, d).first()
    assert (r.n_words, r.n_known) == (4, 2)


def test_run_stats_has_median_and_success_rate(spark, save):
    ok, nan = "processed", float("nan")
    rows = [("x", 1.0, ok), ("x", 4.0, ok), ("x", 2.0, ok), ("x", 2.5, ok), ("x", 99.0, "failed"), ("y", 3.0, "failed"), (None, 5.0, ok), (None, nan, None)]
    d = save(activity_results=(rows, "processor string, processing_time double, status string"))
    got = {r.processor: (r.n_runs, r.success_rate, r.n, r.median, r.most) for r in catalog.queries()["run_stats"](spark, d).collect()}
    assert got == {"x": (5, 0.8, 4, 2.25, 4.0), "y": (1, 0.0, 0, None, None), None: (2, 0.5, 1, 5.0, 5.0)}
