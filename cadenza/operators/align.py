"""Alignment of expected and observed sequences: the sequential steps, as Arrow-batched functions.

Rows that need no search (equal sequences, an empty side) are answered by
column functions and hand empty arrays to Python.
"""

from __future__ import annotations

import difflib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadenza.functions import sequences as S
from cadenza.functions.lookups import ACCEPTED, DASH, ELEMENTS, PAD, SEPARATOR, SUBSTITUTES
from cadenza.functions.sequences import words_of
from cadenza.operators.sequence import continuous

ALIGNED = "phonemes array<string>, errors array<boolean>, confidences array<double>"


def common_subsequence(a: list, b: list) -> list[tuple[int, int]]:
    """Places (i, j) of a longest common subsequence; of several, the one whose matches come first in a.

    A row of the table of lengths is one number whose bits say where the length
    does not grow, so a row costs a few operations on numbers of len(b) bits.
    """
    n, m = len(a), len(b)
    at: dict = {}  # element -> the bits of its places in b, the last place being bit 0
    for k, x in enumerate(reversed(b)):
        at[x] = at.get(x, 0) | 1 << k
    full = (1 << m) - 1
    rows = [full] * (n + 1)
    for i in range(n - 1, -1, -1):
        below, hit = rows[i + 1], at.get(a[i], 0)
        rows[i] = (below + (below & hit) | below & ~hit) & full
    # the length for what is left from i and j on: the bits that are not set among those of b[j:]
    length = lambda i, j: (m - j) - (rows[i] & (1 << m - j) - 1).bit_count()
    out, i, j = [], 0, 0
    while i < n and j < m:
        if a[i] == b[j]:
            out.append((i, j))
            i, j = i + 1, j + 1
        elif length(i + 1, j) >= length(i, j + 1):
            i += 1
        else:
            j += 1
    return out


def align_items(expected: list[str], reference: list[str], heard: list[str], confidence: list[float], weighted: bool = True) -> tuple[list[str], list[bool], list[float]]:
    """What was heard for each expected item, whether it is an error, and its confidence; always len(expected) entries.

    Between two common elements lie a block of reference elements and one of
    heard ones. Heard elements answer the block's reference elements in order and
    must be accepted for their item; further ones are insertions, judged against
    the item that comes next; unanswered reference elements are errors. The
    entries are cut or filled to the number of items.
    """
    sure = lambda j: confidence[j] or 0.0 if j < len(confidence) else 0.0
    item = lambda i: expected[i] if i < len(expected) else reference[i] if i < len(reference) else ""
    missing = (DASH, True, 0.0)
    out: list[tuple[str, bool, float]] = []
    i0 = j0 = 0
    for i1, j1 in [*common_subsequence(reference, heard), (len(reference), len(heard))]:
        asked, said = i1 - i0, j1 - j0
        for k in range(said):
            h, c = heard[j0 + k], sure(j0 + k)
            wrong = h not in ACCEPTED.get(item(i0 + k if k < asked else i1), ())
            if k < asked:
                out.append(missing if wrong else (h, False, c))
            else:
                out.append((h, wrong, c * 0.5 if wrong and weighted else c))
        out += [missing] * (asked - said)
        if j1 < len(heard):
            out.append((heard[j1], False, sure(j1)))
        i0, j0 = i1 + 1, j1 + 1
    out = (out + [missing] * len(expected))[: len(expected)]
    return [x[0] for x in out], [x[1] for x in out], [x[2] for x in out]


def aligned_items(expected: Column, reference: Column, heard: Column, confidence: Column, weighted: bool = True) -> Column:
    """Struct (phonemes, errors, confidences) per row; null arrays count as empty and null confidences as 0.

    A row with a null among its reference or heard elements can't be aligned:
    every item of it is an error.
    """

    @F.pandas_udf(ALIGNED)
    def search(e: pd.Series, r: pd.Series, h: pd.Series, c: pd.Series) -> pd.DataFrame:
        rows = []
        for row in zip(e, r, h, c):
            if any(x is None for k in (1, 2) for x in row[k]):
                n = len(row[0])
                rows.append(([DASH] * n, [True] * n, [0.0] * n))
            else:
                rows.append(align_items(*[list(x) for x in row], weighted))
        return pd.DataFrame(rows, columns=["phonemes", "errors", "confidences"], dtype=object)

    e, r, h = (F.coalesce(x, F.array().cast("array<string>")) for x in (expected, reference, heard))
    c = F.coalesce(confidence, F.array().cast("array<double>"))
    n = F.least(F.size(e), F.size(h))
    rest = F.size(e) - n
    easy = F.struct(
        F.concat(F.slice(h, F.lit(1), n), F.array_repeat(F.lit(DASH), rest)).alias("phonemes"),
        F.concat(F.array_repeat(F.lit(False), n), F.array_repeat(F.lit(True), rest)).alias("errors"),
        F.concat(F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), lambda k: F.coalesce(F.get(c, k - 1), F.lit(0.0))), F.array_repeat(F.lit(0.0), rest)).alias("confidences"),
    )
    easy = F.when(n > 0, easy).otherwise(F.struct(F.array_repeat(F.lit(DASH), F.size(e)).alias("phonemes"), F.array_repeat(F.lit(True), F.size(e)).alias("errors"), F.array_repeat(F.lit(0.0), F.size(e)).alias("confidences")))
    same = r == h
    # rows that are equal hand empty arrays to the search
    some = lambda x, kind: F.when(same, F.array().cast(kind)).otherwise(x)
    return F.when(same, easy).otherwise(search(some(e, "array<string>"), some(r, "array<string>"), some(h, "array<string>"), some(c, "array<double>")))


def word_matches(story: list[str], told: list[str]) -> list[int]:
    """1 for each story word that a global alignment pairs with an equal told word."""
    out = [0] * len(story)
    for i, _ in common_subsequence(story, told):
        out[i] = 1
    return out


def _pattern(word: str) -> re.Pattern:
    return re.compile("".join("[" + re.escape(c + "".join(SUBSTITUTES.get(c, ()))) + "]" for c in word))


def sound_matches(story: list[str], told: list[str]) -> list[int]:
    """1 for each phonetic story word whose aligned told word, or two told words taken together, matches it up to substitutes."""
    n, m = len(story), len(told)
    far = n + m + 1
    # each different word is searched once in each different word or pair of words
    words, pairs = sorted(set(told)), sorted({x + y for x, y in zip(told, told[1:])})
    at_word, at_pair = np.searchsorted(words, told), np.searchsorted(pairs, [x + y for x, y in zip(told, told[1:])])
    one: dict[str, np.ndarray] = {}
    two: dict[str, np.ndarray] = {}
    for w in set(story):
        fits = _pattern(w)
        one[w] = np.array([bool(fits.search(x)) for x in words], bool)[at_word]
        two[w] = np.array([bool(fits.search(x)) for x in pairs], bool)[at_pair] if pairs else np.zeros(0, bool)
    cost = np.zeros((n + 1, m + 1), np.int64)
    steps = np.arange(m + 1)
    cost[0] = steps
    for i, w in enumerate(story):
        above = cost[i]
        least = above + 1
        least[1:] = np.minimum(least[1:], above[:-1] + ~one[w])
        least[2:] = np.minimum(least[2:], np.where(two[w], above[:-2], far))
        # told words left over: the cheapest place to the left and one a word
        cost[i + 1] = np.minimum.accumulate(least - steps) + steps
    out, i, j = [0] * n, n, m
    while i:
        w, here = story[i - 1], cost[i, j]
        if j and here == cost[i - 1, j - 1] + (not one[w][j - 1]):
            out[i - 1] = int(one[w][j - 1])
            i, j = i - 1, j - 1
        elif j > 1 and two[w][j - 2] and here == cost[i - 1, j - 2]:
            out[i - 1] = 1
            i, j = i - 1, j - 2
        elif here == cost[i - 1, j] + 1:
            i -= 1
        else:
            j -= 1
    return out


def _matches(fn, story: Column, told: Column) -> Column:
    @F.pandas_udf("array<int>")
    def run(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([fn(list(x), list(y)) for x, y in zip(a, b)], dtype=object)

    none = F.transform(story, lambda w: F.lit(0))
    whole = F.transform(story, lambda w: F.lit(1))
    blank = F.array().cast("array<string>")
    trivial = (F.size(story) == 0) | (F.coalesce(F.size(told), F.lit(0)) <= 0)
    hand = lambda x: F.coalesce(F.when(~trivial & (story != told), x), blank)
    return F.when(story.isNull(), blank.cast("array<int>")).when(trivial, none).when(story == told, whole).otherwise(run(hand(story), hand(told)))


def matched_words(story: Column, told: Column) -> Column:
    """0/1 for each word of the text story, by the words of the text told."""
    return _matches(word_matches, words_of(story), words_of(told))


def matched_sounds(story: Column, told: Column) -> Column:
    """0/1 for each phonetic word of an array, by the phonetic words of another."""
    return _matches(sound_matches, story, told)


def mapped_places(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """(place in a, place in b) of equal and replaced stretches, pairwise up to the shorter."""
    out = []
    for kind, a0, a1, b0, b1 in difflib.SequenceMatcher(a=a, b=b).get_opcodes():
        if kind in ("equal", "replace"):
            out += list(zip(range(a0, a1), range(b0, b1)))
    return out


def place_map(a: Column, b: Column) -> Column:
    """Array of (i, j): which word of b stands for which word of a."""

    @F.pandas_udf("array<struct<i:int,j:int>>")
    def run(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series([[{"i": i, "j": j} for i, j in mapped_places(list(p), list(q))] for p, q in zip(x, y)], dtype=object)

    blank = F.array().cast("array<string>")
    return run(F.coalesce(a, blank), F.coalesce(b, blank))


def phrase_timings(pages: DataFrame) -> DataFrame:
    """(activity_id, page_index, phrase, start_ms, end_ms, parsed) of each phrase of a page.

    pages: activity_id, page_index, page_start, phrases (texts) and tokens
    (array of structs word, start, end in seconds, in time order) of the page.
    Phrase words are mapped onto the tokens; a phrase lasts from its first to its
    last mapped token, cut to whole ms; phrases without a token are empty
    intervals, and no phrase begins before the one before ended.
    """
    words = F.transform("phrases", lambda p: words_of(S.plain_phrase(p)))
    df = pages.withColumn("_w", words).withColumn("_map", place_map(F.flatten("_w"), F.transform("tokens", lambda t: S.plain_phrase(t["word"]))))
    sizes = F.transform("_w", lambda w: F.size(w))
    starts = F.aggregate(sizes, F.array(F.lit(0)), lambda a, n: F.concat(a, F.array(F.element_at(a, -1) + n)))
    df = df.withColumn("_at", starts).select("*", F.posexplode("_w").alias("phrase", "_words"))
    low, high = F.get("_at", F.col("phrase")), F.get("_at", F.col("phrase") + 1)
    mine = F.transform(F.filter("_map", lambda m: (m["i"] >= low) & (m["i"] < high)), lambda m: m["j"])
    df = df.withColumn("_mine", mine)
    first, last = F.array_min("_mine"), F.array_max("_mine")
    ms = lambda c: (c * 1000).cast("int")
    text = F.array_join(F.transform(F.slice("tokens", first + 1, last - first + 1), lambda t: t["word"]), " ")
    df = df.select("activity_id", "page_index", "phrase", "page_start", ms(F.get("tokens", first)["start"]).alias("start_ms"), ms(F.get("tokens", last)["end"]).alias("end_ms"), F.coalesce(F.when(first.isNotNull(), text), F.lit("")).alias("parsed"))
    return continuous(df, ["activity_id", "page_index"], ["phrase"], "start_ms", "end_ms", F.coalesce("page_start", F.lit(0))).drop("page_start")


def decode_stream(tokens: list[str], probs: list[float], strict: bool = False) -> tuple[list[str], list[float]]:
    """Phonetic elements and their confidences of a decoder's token stream.

    Pads are dropped, separators cut; equal neighbours are one token with their
    mean confidence; of a segment the longest elements are taken from the left,
    with the mean confidence of their tokens; what matches none is skipped, or,
    if strict, a ValueError.
    """
    elements, sure = [], []
    known = set(ELEMENTS)
    longest = max(map(len, known))
    segment: list[list] = []

    def close() -> None:
        # a token of several characters matches no element: it stands for one unknown character
        text = "".join(t if len(t) == 1 else "\0" for t, _, _ in segment)
        conf = [p / n for _, p, n in segment]
        i = 0
        while i < len(text):
            size = next((k for k in range(min(longest, len(text) - i), 0, -1) if text[i : i + k] in known), 0)
            if not size and strict:
                raise ValueError(f"no element at {i} of {''.join(t for t, _, _ in segment)!r}")
            if size:
                elements.append(text[i : i + size])
                sure.append(sum(conf[i : i + size]) / size)
            i += max(size, 1)
        segment.clear()

    for t, p in zip(tokens, probs):
        if t == PAD:
            continue
        if t == SEPARATOR:
            close()
        elif segment and segment[-1][0] == t:
            segment[-1][1] += p
            segment[-1][2] += 1
        else:
            segment.append([t, p, 1])
    close()
    return elements, sure


def decoded_stream(tokens: Column, probs: Column, strict: bool = False) -> Column:
    """Struct (elements, confidences) per row; null arrays count as empty. strict: a token that fits no element fails the query."""

    @F.pandas_udf("elements array<string>, confidences array<double>")
    def run(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for t, p in parts:
            rows = [decode_stream(list(a), list(b), strict) for a, b in zip(t, p)]
            yield pd.DataFrame(rows, columns=["elements", "confidences"], dtype=object)

    return run(F.coalesce(tokens, F.array().cast("array<string>")), F.coalesce(probs, F.array().cast("array<double>")))
