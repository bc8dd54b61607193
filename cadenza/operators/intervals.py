"""Overlapping and gapped intervals: continuous periods and the gaps between them.

Spark's session_window, with each row's own length as the session's duration,
merges overlapping intervals; touching periods are joined afterwards and the
gaps follow from the next period. A key with too many rows for one task is cut
into slices of its time axis that are merged apart; what reaches over a slice's
edge is carried by one small row a slice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cadenza.plans.skew import HOT_ROWS, hot_keys, same_keys


def periods_and_gaps(df: DataFrame, keys: list[str], hot_rows: int = HOT_ROWS, slice_ms: int = 600_000) -> DataFrame:
    """keys, kind ('period' or 'gap'), start_ms, end_ms from rows with keys, start_ms and end_ms (bigint).

    Rows with a null key, start or end and rows with end_ms <= start_ms are left
    out. Repeated rows change nothing. Other columns of df are not looked at. An
    empty table gives an empty result. Hot keys (of more than hot_rows rows, as
    hot_keys finds them) are cut into slices of slice_ms, so of a hot key no task
    sorts more than one slice's distinct starts (at most slice_ms of them).
    """
    ok = F.lit(True)
    for k in keys:
        ok = ok & F.col(k).isNotNull()
    rows = df.where(ok & (F.col("end_ms") > F.col("start_ms"))).select(*keys, "start_ms", "end_ms")
    hot = hot_keys(rows, keys, hot_rows)
    at = keys
    if hot is not None:
        at = [*keys, "_slice"]
        # at most spark.sql.shuffle.partitions keys
        cut = rows.join(F.broadcast(hot.select(*keys)), keys).withColumn("_slice", F.floor(F.col("start_ms") / slice_ms))
        cut = cut.groupBy(*keys, "_slice", "start_ms").agg(F.max("end_ms").alias("end_ms")).select(*keys, "start_ms", "end_ms", "_slice")
        rows = rows.join(F.broadcast(hot.select(*keys)), keys, "left_anti").withColumn("_slice", F.lit(0).cast("bigint")).unionByName(cut)
    gap = F.expr("make_interval(0, 0, 0, 0, 0, 0, cast((end_ms - start_ms) as decimal(18, 0)) / 1000)")
    merged = rows.groupBy(*at, F.session_window(F.timestamp_millis("start_ms"), gap).alias("_s")).agg(F.count(F.lit(1)).alias("_n"))
    merged = merged.select(*at, F.unix_millis("_s.start").alias("s"), F.unix_millis("_s.end").alias("e"))
    # the latest end of all that begins before, in this slice
    before = W.partitionBy(*at).orderBy("s", "e").rowsBetween(W.unboundedPreceding, -1)
    merged = merged.withColumn("_before", F.max("e").over(before))
    if hot is not None:
        merged = _carry(merged, keys, F.max("e"), lambda w: F.max("_edge").over(w.rowsBetween(W.unboundedPreceding, -1)))
        merged = merged.withColumn("_before", F.greatest("_before", "_carried")).drop("_carried")
    # _last: the latest end seen up to here; starts of periods are where nothing before reaches
    merged = merged.withColumn("_upto", F.greatest("e", "_before"))
    merged = merged.withColumn("_end", F.max("_upto").over(W.partitionBy(*at)))
    starts = merged.where(F.col("_before").isNull() | (F.col("s") > F.col("_before")))
    # a period ends at the latest end before the next period's start
    starts = starts.withColumn("_next", F.lead("_before").over(W.partitionBy(*at).orderBy("s")))
    if hot is None:
        starts = starts.withColumn("_stop", F.coalesce("_next", "_end"))
    else:
        last = merged.groupBy(*keys).agg(F.max("_upto").alias("_whole"))
        starts = _carry(starts, keys, F.min_by("_before", "s"), lambda w: F.first("_edge", ignorenulls=True).over(w.rowsBetween(1, W.unboundedFollowing)))
        starts = starts.join(last, same_keys(starts, last, keys)).select(starts["*"], last["_whole"])
        starts = starts.withColumn("_stop", F.coalesce("_next", "_carried", "_whole"))
    piece = lambda kind, a, b: F.struct(F.lit(kind).alias("kind"), F.col(a).alias("start_ms"), F.col(b).alias("end_ms"))
    both = F.when(F.col("_before").isNull(), F.array(piece("period", "s", "_stop"))).otherwise(F.array(piece("period", "s", "_stop"), piece("gap", "_before", "s")))
    return starts.select(*keys, F.inline(both))


def _carry(df: DataFrame, keys: list[str], edge, over) -> DataFrame:
    """df with _carried: what the other slices of the key hand to each slice. One row a slice is ordered, not the rows."""
    at = [*keys, "_slice"]
    slices = df.groupBy(*at).agg(edge.alias("_edge"))
    slices = slices.withColumn("_carried", over(W.partitionBy(*keys).orderBy("_slice"))).drop("_edge")
    return df.join(slices, same_keys(df, slices, at), "left").select(df["*"], slices["_carried"])


def found(word_items: DataFrame, page_data: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """(src, activity_id, page_index, kind, start_ms, end_ms) of both tables: words per page, pages per activity (page_index -1)."""
    ms = lambda c: F.round(F.col(c) * 1000).cast("bigint")
    finite = lambda c: F.abs(F.col(c)) < 1e12  # noqa: E731  (neither NaN nor infinite)
    words = word_items.where(finite("start") & finite("end")).select(F.lit("word_items").alias("src"), "activity_id", F.col("page_index").cast("int").alias("page_index"), ms("start").alias("start_ms"), ms("end").alias("end_ms"))
    pages = page_data.select(F.lit("page_data").alias("src"), "activity_id", F.lit(-1).alias("page_index"), F.col("start_time").cast("bigint").alias("start_ms"), F.col("end_time").cast("bigint").alias("end_ms"))
    return periods_and_gaps(words.unionByName(pages), ["src", "activity_id", "page_index"], hot_rows)


FOUND_SQL = """
WITH i AS (
  SELECT 'word_items' AS src, activity_id, page_index, CAST(round(start * 1000) AS BIGINT) AS s, CAST(round("end" * 1000) AS BIGINT) AS e FROM word_items
  UNION ALL
  SELECT 'page_data', activity_id, -1, CAST(start_time AS BIGINT), CAST(end_time AS BIGINT) FROM page_data),
v AS (SELECT DISTINCT * FROM i WHERE activity_id IS NOT NULL AND page_index IS NOT NULL AND e > s),
b AS (SELECT *, max(e) OVER (PARTITION BY src, activity_id, page_index ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS p FROM v),
g AS (SELECT *, sum(CASE WHEN p IS NULL OR s > p THEN 1 ELSE 0 END) OVER (PARTITION BY src, activity_id, page_index ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS n FROM b),
m AS (SELECT src, activity_id, page_index, n, min(s) AS s, max(e) AS e FROM g GROUP BY ALL),
x AS (SELECT *, lead(s) OVER (PARTITION BY src, activity_id, page_index ORDER BY n) AS nx FROM m)
SELECT src, activity_id, page_index, 'period' AS kind, s AS start_ms, e AS end_ms FROM x
UNION ALL
SELECT src, activity_id, page_index, 'gap', e, nx FROM x WHERE nx IS NOT NULL
"""
