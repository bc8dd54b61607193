"""Decisions on the words of a phrase from several sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadenza.functions import sequences as S
from cadenza.functions.lookups import SEGMENT_NAME, SEGMENT_PAIR

#: With more right words than this and no match, a phrase is rescored.
CORRECT_LIMIT = 2


def decision(matches: Column, errors: Column, prior: Column) -> Column:
    """'keep', 'mark_all' or 'rescore' from 0/1 matches, error flags and prior 0/1 matches."""
    m, right, p = S.count_ones(matches), S.count_false(errors), S.count_ones(prior)
    none = F.when(right == 0, "keep").when(right > CORRECT_LIMIT, "rescore").when(p == 0, "mark_all").otherwise("rescore")
    return F.when(m == 0, none).when(S.agree(matches, errors), "keep").otherwise("rescore")


def reason(matches: Column, errors: Column, prior: Column) -> Column:
    """Why decision decides as it does, with the counts it rests on."""
    m, right, p = S.count_ones(matches), S.count_false(errors), S.count_ones(prior)
    count = lambda c: c.cast("string")
    none = F.when(right == 0, F.lit("no match, nothing right")).when(right > CORRECT_LIMIT, F.concat(F.lit("no match, "), count(right), F.lit(" right")))
    none = none.when(p == 0, F.concat(F.lit("no match, "), count(right), F.lit(" right, no prior match"))).otherwise(F.concat(F.lit("no match, "), count(right), F.lit(" right, "), count(p), F.lit(" prior matches")))
    some = F.concat(count(m), F.when(S.agree(matches, errors), F.lit(" matches agree")).otherwise(F.lit(" matches disagree")))
    return F.when(m == 0, none).otherwise(some)


def failed_keys(phrases: DataFrame, keys: list[str], actual: Column, expected: Column) -> DataFrame:
    """keys, n_phrases, n_broken, fails: a key with one phrase whose actual length is not the expected one fails whole.

    A null length is broken.
    """
    bad = ~F.coalesce(actual == expected, F.lit(False))
    out = phrases.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_phrases"), F.count_if(bad).alias("n_broken"))
    return out.withColumn("fails", F.col("n_broken") > 0)


def two_level_accuracy(phrases: DataFrame, keys: list[str], truth: Column, before: Column, after: Column) -> DataFrame:
    """keys, n_words, right_before, right_after, accuracy_before, accuracy_after, improvement.

    Per phrase the places are counted where before and after equal the truth, up
    to the shortest of the three arrays; sums of a key make its ratios (0.0
    without words).
    """
    n = F.least(*[F.greatest(F.coalesce(F.size(x), F.lit(0)), F.lit(0)) for x in (truth, before, after)])
    equal = lambda x: F.coalesce(F.size(F.filter(F.zip_with(F.slice(truth, F.lit(1), n), F.slice(x, F.lit(1), n), lambda a, b: a == b), lambda e: e)), F.lit(0))
    g = phrases.groupBy(*keys).agg(F.sum(n.cast("bigint")).alias("n_words"), F.sum(equal(before).cast("bigint")).alias("right_before"), F.sum(equal(after).cast("bigint")).alias("right_after"))
    ratio = lambda c: F.when(F.col("n_words") > 0, F.col(c) / F.col("n_words")).otherwise(F.lit(0.0))
    g = g.withColumns({"accuracy_before": ratio("right_before"), "accuracy_after": ratio("right_after")})
    return g.withColumn("improvement", F.col("accuracy_after") - F.col("accuracy_before"))


def executed(strategy: Column, errors: Column, length: Column, voted: Column, has_audio: Column) -> Column:
    """The error flags after the decision: kept as they came, all true, or voted; without audio all true."""
    every = F.array_repeat(F.lit(True), F.coalesce(length, F.lit(0)))
    return F.when(strategy == "keep", errors).when((strategy == "mark_all") | ~has_audio, every).otherwise(F.coalesce(voted, every))


def scored(phrases: DataFrame) -> DataFrame:
    """phrases (matches, errors, prior, second arrays, length, has_audio) with strategy, padded, result and is_valid.

    is_valid: all sources have the phrase's length; others go to quarantine with
    all words as errors, never raising.
    """
    padded = S.pad_errors(F.col("errors"), F.col("length"))
    df = phrases.withColumn("padded", F.coalesce(padded, F.slice("errors", F.lit(1), F.col("length"))))
    df = df.withColumn("is_valid", (F.size("matches") == F.col("length")) & (F.size("prior") == F.col("length")) & (F.size("second") == F.col("length")))
    df = df.withColumn("strategy", decision(F.col("matches"), F.col("padded"), F.col("prior")))
    voted = S.vote(F.col("matches"), F.col("second"), F.col("prior"))
    return df.withColumn("result", executed(F.col("strategy"), F.col("errors"), F.col("length"), voted, F.col("has_audio")))


def accuracy(errors: Column) -> dict[str, Column]:
    """n_errors, n_words and accuracy (0.0 without words) of an array of error flags."""
    n = F.greatest(F.coalesce(F.size(errors), F.lit(0)), F.lit(0))
    wrong = F.coalesce(F.size(F.filter(errors, lambda e: e)), F.lit(0))
    return {"n_errors": wrong, "n_words": n, "accuracy": F.when(n > 0, (n - wrong) / n).otherwise(F.lit(0.0))}


def segment_name(uri: Column) -> Column:
    """phrase, activity number and seq of a strict segment name, which begins the base name; null if it has none."""
    part = lambda i: F.regexp_extract(uri, SEGMENT_NAME, i).cast("int")
    return F.when(uri.rlike(SEGMENT_NAME), F.struct(part(1).alias("phrase"), part(2).alias("number"), part(3).alias("seq")))


def segment_pair(uri: Column) -> Column:
    """phrase and seq of a version 2 name by its first two numbers; null if it is tagged but malformed."""
    part = lambda i: F.regexp_extract(uri, SEGMENT_PAIR, i).cast("int")
    return F.when(uri.rlike(SEGMENT_PAIR), F.struct(part(1).alias("phrase"), part(2).alias("seq")))


def too_many_invalid(df: DataFrame, keys: list[str], uri: str, limit: int) -> DataFrame:
    """keys, n_tagged, n_invalid, fails: more than limit version 2 names that can't be read."""
    tagged = df.where(F.col(uri).endswith("-v2.wav"))
    out = tagged.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_tagged"), F.count_if(segment_pair(F.col(uri)).isNull()).alias("n_invalid"))
    return out.withColumn("fails", F.col("n_invalid") > limit)


def missing_features(phrases: DataFrame, features: DataFrame, keys: list[str], index: str) -> DataFrame:
    """keys, index, problem of the phrases without a feature: 'error' up to the key's largest feature index, 'warning' beyond."""
    top = features.groupBy(*keys).agg(F.max(index).alias("_top"))
    lost = phrases.select(*keys, index).distinct().join(features.select(*keys, index).distinct(), [*keys, index], "left_anti")
    return lost.join(top, keys, "left").select(*keys, index, F.when(F.col(index) <= F.col("_top"), "error").otherwise("warning").alias("problem"))
