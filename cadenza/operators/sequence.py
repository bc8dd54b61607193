"""Ordered-sequence operators: runs, segments, timelines, gaps, positions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadenza.functions.lookups import BYTES_PER_MS, HEADER_BYTES, PAD, SEPARATOR
from cadenza.plans.scan import before

#: Drops in a row from which a streak is remarked.
DROPS = 5
#: Missing indices that one row is expanded into at once.
BLOCK = 65_536


def hour_of(ts: str) -> Column:
    """A slice of a time column: its hour."""
    return F.floor(F.unix_seconds(F.col(ts).cast("timestamp")) / 3600)


def positions(df: DataFrame, keys: list[str], order: list[str], name: str = "pos", slice_by: Column | None = None) -> DataFrame:
    """df with the 0-based place of each row within its key."""
    return before(df, keys, order, {name: ("count", F.lit(1))}, slice_by)


def pair_by_position(left: DataFrame, right: DataFrame, keys: list[str], left_order: list[str], right_order: list[str], left_slice: Column | None = None, right_slice: Column | None = None) -> DataFrame:
    """Left rows with the right row of the same key at the same place; without one its columns are null.

    Columns of right that are not keys must not clash with those of left.
    """
    a = positions(left, keys, left_order, slice_by=left_slice)
    b = positions(right, keys, right_order, slice_by=right_slice)
    return a.join(b, [*keys, "pos"], "left")


def runs(df: DataFrame, keys: list[str], order: list[str], token: str, value: str, slice_by: Column | None = None) -> DataFrame:
    """keys, run (1-based), token, n, mean_value for each run of equal consecutive tokens. A null token is an own token."""
    t = F.coalesce(F.concat(F.lit("="), F.col(token)), F.lit("~"))
    rows = before(df.withColumn("_t", t), keys, order, {"_prev": ("last", F.col("_t"))}, slice_by)
    rows = rows.withColumn("_new", F.coalesce((F.col("_t") != F.col("_prev")).cast("int"), F.lit(1)))
    rows = before(rows, keys, order, {"_runs": ("sum", F.col("_new"))}, slice_by)
    rows = rows.withColumn("run", (F.col("_runs") + F.col("_new")).cast("bigint"))
    return rows.groupBy(*keys, "run", token).agg(F.count(F.lit(1)).alias("n"), F.avg(value).alias("mean_value"))


def segments(df: DataFrame, keys: list[str], order: list[str], token: str, separator: str = SEPARATOR, pad: str = PAD, slice_by: Column | None = None) -> DataFrame:
    """df without separators and pads, with segment: how many separators come before. Pads go first, so equal tokens around one are neighbours."""
    rows = df.where(F.coalesce(F.col(token) != pad, F.lit(True)))
    rows = before(rows, keys, order, {"segment": ("sum", (F.col(token) == separator).cast("int"))}, slice_by)
    return rows.where(F.coalesce(F.col(token) != separator, F.lit(True)))


def mean_of_means(df: DataFrame, keys: list[str], order: list[str], token: str, value: str, separator: str, slice_by: Column | None = None) -> DataFrame:
    """Per key and segment: the mean over its runs of each run's mean, as an element's confidence is made; not one flat mean."""
    rows = segments(df, keys, order, token, separator, slice_by=slice_by)
    one = runs(rows, [*keys, "segment"], order, token, value, slice_by)
    return one.groupBy(*keys, "segment").agg(F.count(F.lit(1)).alias("n_runs"), F.avg("mean_value").alias("confidence"))


def group_sizes(df: DataFrame, keys: list[str], index: str, size: str) -> DataFrame:
    """keys, index, n, bytes: the audio bytes of each index without headers; rows with a null index are skipped."""
    return df.where(F.col(index).isNotNull()).groupBy(*keys, index).agg(F.count(F.lit(1)).alias("n"), F.sum(F.col(size) - HEADER_BYTES).alias("bytes"))


def timeline(df: DataFrame, keys: list[str], index: str, size: str) -> DataFrame:
    """df with start_ms and end_ms on one running clock: each row lasts its bytes in ms, rounded half to even."""
    dur = F.bround(F.col(size) / BYTES_PER_MS).cast("bigint")
    rows = before(df.withColumn("_dur", dur), keys, [index], {"start_ms": ("sum", F.col("_dur"))}, F.floor(F.col(index) / 10_000))
    return rows.withColumn("end_ms", (F.col("start_ms") + F.col("_dur")).cast("bigint")).withColumn("start_ms", F.col("start_ms").cast("bigint")).drop("_dur")


def continuous(df: DataFrame, keys: list[str], order: list[str], start: str, end: str, page_start: Column, slice_by: Column | None = None) -> DataFrame:
    """df with start and end (null if unknown) made to follow each other: no row begins before the one before ended.

    An end is at least its start; both null: an empty interval where the row before ended.
    """
    edge = F.greatest(page_start, F.col(start), F.col(end))
    rows = before(df.withColumn("_edge", edge), keys, order, {"_reach": ("max", F.col("_edge"))}, slice_by)
    from_ = F.greatest(F.coalesce("_reach", page_start), F.coalesce(F.col(start), F.lit(0)), page_start)
    return rows.withColumn(start, from_).withColumn(end, F.greatest(F.coalesce(F.col(end), F.lit(0)), F.col(start))).drop("_edge", "_reach")


def missing_indices(df: DataFrame, keys: list[str], index: str) -> DataFrame:
    """keys, n_expected (largest index + 1) and each index from 0 to it that is not there.

    As many rows as indices are missing, whatever they are: miss_streaks has one row a streak.
    """
    seen = df.where(F.col(index) >= 0).groupBy(*keys).agg((F.max(index).cast("bigint") + 1).alias("n_expected"))
    gaps = miss_streaks(df, keys, index)
    # a wide gap is expanded block by block, so one far index is no array of its size
    at, end = F.col("from_index").cast("bigint"), F.col("from_index").cast("bigint") + F.col("n")
    blocks = gaps.select(*keys, end.alias("_end"), F.explode(F.sequence(at, end - 1, F.lit(BLOCK).cast("bigint"))).alias("_at"))
    each = blocks.select(*keys, F.explode(F.sequence(F.col("_at"), F.least(F.col("_at") + BLOCK, F.col("_end")) - 1)).alias(index))
    return each.withColumn(index, F.col(index).cast("int")).join(seen, keys)


def miss_streaks(df: DataFrame, keys: list[str], index: str) -> DataFrame:
    """keys, from_index, n: streaks of consecutive missing indices between 0 and the largest, from the indices beside them."""
    there = df.where(F.col(index) >= 0).select(*keys, index).distinct()
    rows = before(there, keys, [index], {"_prev": ("last", F.col(index))}, F.floor(F.col(index) / 10_000))
    first = F.coalesce(F.col("_prev") + 1, F.lit(0))
    return rows.where(F.col(index) > first).select(*keys, first.cast("int").alias("from_index"), (F.col(index) - first).cast("bigint").alias("n"))


def dropped_segments(df: DataFrame, keys: list[str], index: str, seq: str) -> DataFrame:
    """keys, index, from_seq, n, over: streaks of sequence numbers that a phrase lacks, and whether more than DROPS follow each other.

    A phrase begins one after the last number of the phrase before (index - 1),
    the first phrase (index 0) at 0; it ends at its own last number. Of a phrase
    whose predecessor is not there the start is unknown: it is left out.
    """
    rows = df.where(F.col(index).isNotNull() & F.col(seq).isNotNull()).select(*keys, index, seq).distinct()
    last = rows.groupBy(*keys, index).agg(F.max(seq).alias("_last"))
    start = last.select(*keys, (F.col(index) + 1).alias(index), (F.col("_last") + 1).alias("_start"))
    begun = rows.join(start, [*keys, index], "left").withColumn("_start", F.when(F.col(index) == 0, 0).otherwise(F.col("_start"))).where(F.col("_start").isNotNull() & (F.col(seq) >= F.col("_start")))
    at = before(begun, [*keys, index], [seq], {"_prev": ("last", F.col(seq))})
    first = F.coalesce(F.col("_prev") + 1, F.col("_start"))
    n = (F.col(seq) - first).cast("bigint")
    return at.where(F.col(seq) > first).select(*keys, index, first.alias("from_seq"), n.alias("n"), (n > DROPS).alias("over"))


def start_sequence(df: DataFrame, keys: list[str], index: str, seq: str) -> DataFrame:
    """Per key and index its last seq, and as start_seq one more than that of the index before in order; 0 for the first."""
    last = df.where(F.col(index).isNotNull()).groupBy(*keys, index).agg(F.max(seq).alias("last_seq"))
    rows = before(last, keys, [index], {"_prev": ("last", F.col("last_seq"))}, F.floor(F.col(index) / 10_000))
    return rows.withColumn("start_seq", F.coalesce(F.col("_prev") + 1, F.lit(0))).drop("_prev")


def segment_map(df: DataFrame, keys: list[str], seq: str, file: str, order: str, flag: Column | None = None) -> DataFrame:
    """keys, files (map seq -> file; the last duplicate by order wins) and last_file. Keys are a phrase's: few segments each.

    last_file is that of the row that flag marks as the last segment (of several
    the last by order, null without one); without flag that of the largest seq.
    """
    marked = F.max_by(F.struct(F.col(order).alias("o"), F.col(file).alias("f")), F.when(F.coalesce(flag, F.lit(False)), F.col(order))) if flag is not None else F.lit(None)
    one = df.where(F.col(seq).isNotNull()).groupBy(*keys, seq).agg(F.max_by(file, order).alias("_file"), marked.alias("_marked"))
    entry = F.struct(F.col(seq).alias("key"), F.col("_file").alias("value"))
    last = F.max_by("_file", seq) if flag is None else F.max("_marked").getField("f")
    return one.groupBy(*keys).agg(F.map_from_entries(F.array_sort(F.collect_list(entry))).alias("files"), last.alias("last_file"))


def as_of(left: DataFrame, right: DataFrame, key: str, time: str, tie: str, carry: str, slice_by: Column) -> DataFrame:
    """left with carry of the last right row of the key at or before its time (null if none).

    Both sides have key, time and tie; at one time right rows come first. One union and one scan, no pairs.
    """
    a = left.withColumn("_side", F.lit(1)).withColumn("_carry", F.lit(None).cast(dict(right.dtypes)[carry]))
    b = right.select(*[F.col(c) if c in (key, time, tie) else F.lit(None).cast(t).alias(c) for c, t in left.dtypes], F.lit(0).alias("_side"), F.col(carry).alias("_carry"))
    rows = before(a.unionByName(b), [key], [time, "_side", tie], {"last_" + carry: ("last", F.col("_carry"))}, slice_by)
    return rows.where("_side = 1").drop("_side", "_carry")
