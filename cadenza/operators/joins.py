"""Joins of activities, phrases, pages and words."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadenza.functions.sequences import accepted, common_length, plain_phrase
from cadenza.functions.text import folded
from cadenza.plans.skew import skew_join


def with_phrases(activities: DataFrame, phrases: DataFrame) -> DataFrame:
    """Activities with the phrases of their story; activities without any are left out.

    Written as a left join with a condition on the right side, which the
    optimiser turns into an inner join. Story ids are compared without case and
    surrounding white space.
    """
    a = activities.withColumn("_story", folded(F.col("storyid")))
    p = phrases.select(folded(F.col("storyid")).alias("_story"), "phraseindex", "expected_text", "reference_phonemes")
    return skew_join(a, p, ["_story"], "left").where(F.col("expected_text").isNotNull()).drop("_story")


def without_phrases(activities: DataFrame, phrases: DataFrame) -> DataFrame:
    """Activities whose story has no phrase."""
    a = activities.withColumn("_story", folded(F.col("storyid")))
    p = phrases.where(F.col("expected_text").isNotNull()).select(folded(F.col("storyid")).alias("_story")).distinct()
    return skew_join(a, p, ["_story"], "left_anti").drop("_story")


def dropped_rows(activities: DataFrame, phrases: DataFrame) -> DataFrame:
    """n_activities and n_dropped (without a phrase), in one row."""
    a = activities.withColumn("_story", folded(F.col("storyid")))
    p = phrases.where(F.col("expected_text").isNotNull()).select(folded(F.col("storyid")).alias("_story"), F.lit(True).alias("_has")).distinct()
    return skew_join(a, p, ["_story"], "left").agg(F.count(F.lit(1)).alias("n_activities"), F.count_if(F.col("_has").isNull()).alias("n_dropped"))


#: Levels of time buckets, the width growing by WIDER from one to the next; a page interval touches at most WIDER + 1 buckets of its level.
LEVELS = 9
WIDER = 16


def words_in_pages(pages: DataFrame, words: DataFrame, right_ms: int = 1000, bucket_ms: int = 30_000, columns: tuple[str, ...] = ("word_id",)) -> DataFrame:
    """(activity_id, page_index, columns of the word): words whose start lies in the page's interval, both ends closed, and up to right_ms after it.

    A word can lie in two pages. A page is put into the time buckets it touches,
    of the least width that makes them at most WIDER + 1, so a hot activity is
    joined bucket by bucket and one page with a far end makes no more rows than
    that. Words come once for each width that pages have: one, unless pages last
    longer than WIDER times bucket_ms (eight minutes).
    """
    low, high = F.col("start_time").cast("bigint"), F.col("end_time").cast("bigint") + right_ms
    p = pages.where(F.col("start_time").isNotNull() & (high >= low)).select("activity_id", "page_index", low.alias("low"), high.alias("high"))
    long = F.lit(LEVELS)
    for k in reversed(range(LEVELS)):
        long = F.when(F.col("high") - F.col("low") < bucket_ms * WIDER ** (k + 1), k).otherwise(long)
    p = p.withColumn("level", long.cast("int"))
    width = lambda level: F.lit(bucket_ms).cast("bigint") * F.pow(F.lit(float(WIDER)), level).cast("bigint")
    at = lambda t: F.floor(F.col(t) / width(F.col("level")))
    # on the last level all pages share one bucket
    first = F.when(F.col("level") < LEVELS, at("low")).otherwise(0).cast("bigint")
    last = F.when(F.col("level") < LEVELS, at("high")).otherwise(0).cast("bigint")
    p = p.withColumn("bucket", F.explode(F.sequence(first, last)))
    # at most LEVELS + 1 numbers
    there = sorted(r.level for r in pages.where(F.col("start_time").isNotNull() & (high >= low)).select(low.alias("low"), high.alias("high")).select(long.cast("int").alias("level")).distinct().collect())
    w = words.where(F.abs("start") < 1e9).select("activity_id", *columns, (F.col("start") * 1000).alias("at"))
    if there in ([], [0]):
        w = w.withColumn("level", F.lit(0))
    else:
        w = w.withColumn("level", F.explode(F.array(*[F.lit(k) for k in there])))
    w = w.withColumn("bucket", F.when(F.col("level") < LEVELS, at("at")).otherwise(0).cast("bigint"))
    hit = p.join(w, ["activity_id", "level", "bucket"]).where((F.col("at") >= F.col("low")) & (F.col("at") <= F.col("high")))
    return hit.select("activity_id", "page_index", *columns)


def with_threshold(rows: DataFrame, thresholds: DataFrame, model: str) -> DataFrame:
    """rows with threshold by model (one row a model); an unknown or null model keeps its rows, with a null threshold and ``unknown`` true.

    The caller decides whether unknown models are an error; none is dropped.
    """
    t = thresholds.select(model, "threshold", F.lit(True).alias("_known"))
    out = skew_join(rows, t, [model], "left")
    return out.withColumn("unknown", F.col("_known").isNull()).drop("_known")


def phrases_of(responses: DataFrame, lists: dict[str, Column]) -> DataFrame:
    """One row for each place of a response's parallel lists (name -> array column), with the columns of responses; shorter lists end all.

    A null list has no places.
    """
    n = F.least(*[F.coalesce(F.size(c), F.lit(0)) for c in lists.values()], F.lit(2**31 - 1))
    zipped = F.arrays_zip(*[F.slice(c, F.lit(1), F.greatest(n, F.lit(0))).alias(k) for k, c in lists.items()])
    return responses.select("*", F.posexplode(zipped).alias("place", "_z")).select(*responses.columns, "place", *[F.col("_z")[k].alias(k) for k in lists])


def pages_with_phrases(documents: DataFrame, phrases: DataFrame) -> DataFrame:
    """(doc_id, storyid, phraseindex): phrases that occur in a text of their story, compared without case and punctuation."""
    d = documents.where(F.col("text").isNotNull()).select("doc_id", folded(F.col("story_id")).alias("storyid"), plain_phrase(F.col("text")).alias("_page"))
    p = phrases.select(folded(F.col("storyid")).alias("storyid"), "phraseindex", plain_phrase(F.array_join("expected_text", " ")).alias("_phrase")).where("_phrase <> ''").distinct()
    return skew_join(d, p, ["storyid"]).where(F.instr(F.col("_page"), F.col("_phrase")) > 0).select("doc_id", "storyid", "phraseindex")


def accepted_forms(phrases: DataFrame) -> DataFrame:
    """(storyid, phraseindex, place, item, form, is_error) of each item with the form at its place; an unknown item is an error."""
    n = common_length(F.col("expected_text"), F.col("reference_phonemes"))
    zipped = F.arrays_zip(F.slice("expected_text", F.lit(1), n).alias("item"), F.slice("reference_phonemes", F.lit(1), n).alias("form"))
    rows = phrases.select("storyid", "phraseindex", F.posexplode(zipped).alias("place", "p"))
    return rows.select("storyid", "phraseindex", "place", "p.item", "p.form", (~accepted(F.col("p.item"), F.col("p.form"))).alias("is_error"))


def neighbours(phrases: DataFrame, keys: list[str], index: str, value: str) -> DataFrame:
    """keys, index, value, previous, following: the values at index - 1 and + 1 (not of the row before and after)."""
    one = phrases.where(F.col(index).isNotNull()).groupBy(*keys, index).agg(F.max(value).alias(value))
    shift = lambda d, name: one.select(*keys, (F.col(index) + d).alias(index), F.col(value).alias(name))
    return one.join(shift(1, "previous"), [*keys, index], "left").join(shift(-1, "following"), [*keys, index], "left")


def first_page_of(pages: DataFrame) -> DataFrame:
    """(activity_id, phrase, page_index): the first page that holds each phrase index."""
    rows = pages.select("activity_id", "page_index", F.explode("phrase_indices").alias("phrase"))
    return rows.groupBy("activity_id", "phrase").agg(F.min("page_index").alias("page_index"))


def absolute_index(pages: DataFrame, relative: int) -> DataFrame:
    """(activity_id, page_index, phrase): the page's phrase index at a 0-based place, null outside."""
    return pages.select("activity_id", "page_index", F.get("phrase_indices", F.lit(relative)).alias("phrase"))


def with_fallback(rows: DataFrame, cache: DataFrame, key: str, column: str) -> DataFrame:
    """rows with column from the cache (one row a key) where it has the key and a value, else their own."""
    c = cache.select(key, F.col(column).alias("_cached"))
    return skew_join(rows, c, [key], "left").withColumn(column, F.coalesce("_cached", column)).drop("_cached")


def not_done(rows: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Rows whose key has no output yet; a null key is never done."""
    return skew_join(rows, done.select(key).distinct(), [key], "left_anti")


def with_heads(listing: DataFrame, heads: DataFrame) -> DataFrame:
    """Objects with the metadata fetched for their key, null where there is none."""
    return listing.join(heads, "key", "left")


def spoken_forms(words: DataFrame, dictionary: DataFrame) -> DataFrame:
    """words (word) with phonemes of the dictionary (word, phonemes; one row a word), null for unknown words.

    AQE broadcasts the dictionary if it turns out small; hot words are spread.
    """
    return skew_join(words, dictionary, ["word"], "left")


def united_sets(first: DataFrame, second: DataFrame, key: str, items: str) -> DataFrame:
    """key, items: for each row of first its items and those of second for the key, each once and in order. Keys of second alone add nothing."""
    b = second.select(key, F.col(items).alias("_more"))
    none = F.filter(F.col(items), lambda x: F.lit(False))
    return first.join(b, key, "left").select(key, F.array_sort(F.array_union(items, F.coalesce("_more", none))).alias(items))
