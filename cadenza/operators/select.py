"""Projections, filters and predicates."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cadenza.functions.lookups import SEGMENT_URI

ACTIVITY_COLUMNS = ["activityid", "storyid", "studentid", "districtid", "type", "createdat", "status", "displaystatus"]
# Column names of the result (type keeps its name).
RENAMED = {"activityid": "activityId", "storyid": "storyId", "studentid": "studentId", "districtid": "districtId", "createdat": "createdAt", "displaystatus": "displayStatus"}


def require_columns(df: DataFrame, names: list[str]) -> DataFrame:
    """df, or a ValueError that names the missing columns."""
    if missing := sorted(set(names) - set(df.columns)):
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df


def time_range(column: str, start: str | None, end: str | None) -> list[Column]:
    """[start, end) as conditions; both bounds or none, start before end."""
    if (start is None) != (end is None):
        raise ValueError("give both bounds or none")
    if start is None:
        return []
    if start >= end:
        raise ValueError("start must be before end")
    c = F.col(column)
    return [c >= F.lit(start).cast("timestamp_ntz"), c < F.lit(end).cast("timestamp_ntz")]


def activity_filter(type_: str | None = None, status: str | None = None, start: str | None = None, end: str | None = None, districts: list[str] | None = None) -> Column:
    """All given conditions; an empty district list is no condition."""
    conds = time_range("createdat", start, end)
    conds += [F.col("type") == type_] if type_ is not None else []
    conds += [F.col("status") == status] if status is not None else []
    conds += [F.col("districtid").isin(*districts)] if districts else []
    return reduce(lambda a, b: a & b, conds, F.lit(True))


def select_activities(activities: DataFrame, sql: str | None = None, **conditions) -> DataFrame:
    """The eight columns of the activities that meet the conditions; sql overrides them and names the table {activities}."""
    if sql:
        return activities.sparkSession.sql(sql, activities=activities)
    return activities.where(activity_filter(**conditions)).select(*ACTIVITY_COLUMNS)


def renamed(df: DataFrame, names: dict[str, str] = RENAMED) -> DataFrame:
    return df.withColumnsRenamed(names)


def one_activity(spark: SparkSession, activities: DataFrame, activity_id: str) -> DataFrame:
    """The rows of one id, with status 'completed' as a constant."""
    return activities.where(F.col("activityid") == activity_id).withColumn("status", F.lit("completed"))


def optional(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """The named columns (name -> type); one that df lacks is null."""
    return df.select(*[F.col(n).cast(t).alias(n) if n in df.columns else F.lit(None).cast(t).alias(n) for n, t in names.items()])


def previous_day(column: str, now: str) -> Column:
    """The UTC day before now."""
    end = F.date_trunc("day", F.lit(now).cast("timestamp_ntz"))
    return (F.col(column) >= end - F.expr("INTERVAL 1 DAY")) & (F.col(column) < end)


def older_than(column: str, now: Column, days: int) -> Column:
    return F.col(column) < now - F.expr(f"INTERVAL {days} DAY")


def valid_activity(key: str, items: str) -> Column:
    """A non-blank id and at least one item."""
    return F.coalesce(F.col(key).rlike(r"(?U)\S") & (F.size(items) > 0), F.lit(False))


def is_primary_model(model: str) -> Column:
    """Models whose name does not begin with faux, in any case."""
    return ~F.lower(model).startswith("faux")


def is_second_pass(model: str) -> Column:
    """Models with second in their name, in any case; all others are of the first pass."""
    return F.lower(model).contains("second")


def preferred_pass(features: DataFrame, keys: list[str], index: str, model: str) -> DataFrame:
    """The features of the preferred pass of each key: the second where it has one for each index up to the key's largest, else the first.

    Models that aren't primary are left out. Features are counted by their
    distinct index.
    """
    rows = features.where(F.coalesce(is_primary_model(model), F.lit(False))).withColumn("_second", is_second_pass(model))
    g = rows.groupBy(*keys).agg((F.max(index) + 1).alias("_n"), F.count_distinct(F.when(F.col("_second"), F.col(index))).alias("_n2"))
    chosen = g.select(*keys, ((F.col("_n2") > 0) & (F.col("_n2") == F.col("_n"))).alias("_want"))
    return rows.join(chosen, keys).where(F.col("_second") == F.col("_want")).drop("_second", "_want")


def audio_key(key: str) -> Column:
    """A sound file that is not the complete recording (…complete.wav); false for null."""
    return F.coalesce(F.col(key).contains(".wav") & ~F.col(key).endswith("complete.wav"), F.lit(False))


def route(tags: str, first: str, second: str) -> Column:
    """'general' if the tags hold first, else 'partner' if they hold second, else 'error'; null tags are an error."""
    return F.when(F.array_contains(tags, first), "general").when(F.array_contains(tags, second), "partner").otherwise("error")


def length_guard(n: Column, least: int, most: int) -> Column:
    """'empty', 'short', 'long' or 'ok' for a number of samples; null is empty."""
    return F.when(F.coalesce(n, F.lit(0)) <= 0, "empty").when(n > most, "long").when(n < least, "short").otherwise("ok")


def sampled(df: DataFrame, key: str, per_mille: int) -> DataFrame:
    """Rows whose key falls into a fixed part: metric sampling where the part is the feature, alike in every run."""
    return df.where(F.pmod(F.xxhash64(key), F.lit(1000)) < per_mille)


def segment_violations() -> dict[str, Column]:
    """Broken rules of a segment row, by name; null values break their rule."""
    bad = lambda c: ~F.coalesce(c, F.lit(False))
    return {
        "activity": bad(F.col("activityid").rlike(r"(?U)\S")),
        "phrase": bad(F.col("phraseindex") >= 0),
        "start": bad(F.col("start_ms") >= 0),
        "end": bad(F.col("end_ms") >= 0),
        "order": bad(F.col("end_ms") >= F.col("start_ms")),
        "uri": bad(F.col("s3_uri").rlike(SEGMENT_URI)),
    }


def result_violations(version: str = "activity-results-v1") -> dict[str, Column]:
    """Broken rules of a result row, by name; correlation_id may be null."""
    bad = lambda c: ~F.coalesce(c, F.lit(False))
    return {
        "activity": bad(F.col("activity_id").rlike(r"(?U)\S")),
        "status": bad(F.col("status").isNotNull()),
        "results": bad(F.try_parse_json("pipeline_results").isNotNull()),
        "time": bad((F.col("processing_time") >= 0) & ~F.isnan("processing_time")),
        "timestamp": bad(F.col("timestamp") >= 0),
        "version": bad(F.col("schema_version") == version),
    }


def count_violations(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """rule, n of the rows that break each rule, in one pass."""
    counts = df.agg(*[F.count_if(c).alias(n) for n, c in rules.items()])
    pairs = F.array(*[F.struct(F.lit(n).alias("rule"), F.col(n).alias("n")) for n in rules])
    return counts.select(F.inline(pairs))


def quarantine(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """df with broken: the names of the rules each row breaks, for a good and a rejected branch."""
    return df.withColumn("broken", F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in rules.items()])))
