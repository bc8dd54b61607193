"""Aggregates over results and metric samples: summaries, statistics, windows, alarms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def measured(c: str) -> Column:
    """The value, or null if it is no measurement (NaN or negative)."""
    return F.when(~F.isnan(c) & (F.col(c) >= 0), F.col(c))


def batch_summary(df: DataFrame, keys: list[str], ok: Column, seconds: Column) -> DataFrame:
    """keys, n, n_ok, n_failed, total_s and mean_s over the successes, per_minute (whole), success_rate and grade."""
    out = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.count_if(ok).alias("n_ok"), F.coalesce(F.sum(F.when(ok, seconds)), F.lit(0.0)).alias("total_s"), F.count(F.when(ok, seconds)).alias("_timed"))
    rate = F.col("n_ok") / F.col("n")
    grade = F.when(rate >= 0.95, "excellent").when(rate >= 0.9, "good").when(rate >= 0.8, "fair").otherwise("poor")
    return out.select(*keys, "n", "n_ok", (F.col("n") - F.col("n_ok")).alias("n_failed"), F.round("total_s", 6).alias("total_s"), F.round(F.try_divide("total_s", "_timed"), 10).alias("mean_s"), F.coalesce(F.floor(F.try_divide(F.col("n_ok"), F.col("total_s") / 60)), F.lit(0)).cast("int").alias("per_minute"), F.round(rate, 6).alias("success_rate"), grade.alias("grade"))


def statistics(df: DataFrame, keys: list[str], value: Column) -> DataFrame:
    """keys, n, mean, stdev (0 under two values), least, most of the non-null values."""
    v = df.select(*keys, value.alias("v")).where("v IS NOT NULL")
    return v.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("v"), 10).alias("mean"), F.round(F.coalesce(F.stddev_samp("v"), F.lit(0.0)), 6).alias("stdev"), F.min("v").alias("least"), F.max("v").alias("most"))


def speedups(stats: DataFrame, name: str, baseline: str) -> DataFrame:
    """stats with speedup over the row named baseline (null without one), by a scalar subquery."""
    base = stats.where(F.col(name) == baseline).agg(F.max("mean")).scalar()
    return stats.withColumn("speedup", F.round(F.try_divide(base, F.col("mean")), 9))


#: Buckets of an octave in which ranks are looked for first.
PER_OCTAVE = 256


def values_at(df: DataFrame, keys: list[str], value: Column, ranks: dict[str, Column]) -> DataFrame:
    """keys, n and the value at each rank (name -> expression of n, from 1) among the non-null values of the key, exactly.

    NaN ranks above all. A rank outside 1 to n has a null value. Counts of
    buckets, by the value's logarithm, are combined before the shuffle and show
    which bucket holds each rank; only the distinct values of those buckets are
    put in order, each bucket apart, so no task orders a key's values.
    """
    k = [f"_k{i}" for i in range(len(keys))]
    v = F.col("_v")
    size = F.abs(v)
    e = F.when(F.isnan(v), F.lit(2_000_000).cast("bigint")).otherwise(F.floor(F.least(F.log2(size) * PER_OCTAVE, F.lit(1e6))).cast("bigint") + 400_000)
    rows = df.select(F.struct(*[F.col(c).alias(n) for c, n in zip(keys, k)], F.lit(0).alias("_")).alias("_k"), value.cast("double").alias("_v")).where(v.isNotNull())
    rows = rows.withColumn("_b", F.when(v == 0, F.lit(0).cast("bigint")).when(v < 0, -e).otherwise(e))
    h = rows.groupBy("_k", "_b").agg(F.count(F.lit(1)).alias("_c"))
    h = h.withColumn("_to", F.sum("_c").over(W.partitionBy("_k").orderBy("_b"))).withColumn("n", F.sum("_c").over(W.partitionBy("_k")))
    asked = {f"_r{i}": r.cast("bigint") for i, r in enumerate(ranks.values())}
    inside = {c: F.when((r <= F.col("_to")) & (r > F.col("_to") - F.col("_c")), r - F.col("_to") + F.col("_c")) for c, r in asked.items()}
    h = h.select("_k", "_b", "n", *[c.alias(i) for i, c in inside.items()])
    wanted = h.where(F.coalesce(*asked).isNotNull()).select(F.col("_k").alias("_ak"), F.col("_b").alias("_ab"), *asked)
    near = rows.join(wanted, (F.col("_k") == F.col("_ak")) & (F.col("_b") == F.col("_ab")))
    near = near.groupBy("_k", "_b", "_v").agg(F.count(F.lit(1)).alias("_c"), *[F.any_value(c).alias(c) for c in asked])
    near = near.withColumn("_to", F.sum("_c").over(W.partitionBy("_k", "_b").orderBy("_v")))
    hit = lambda c: (F.col(c) <= F.col("_to")) & (F.col(c) > F.col("_to") - F.col("_c"))
    found = near.groupBy("_k").agg(*[F.max(F.when(hit(c), v)).alias(n) for c, n in zip(asked, ranks)])
    totals = h.groupBy("_k").agg(F.max("n").alias("n"))
    out = totals.join(found.withColumnRenamed("_k", "_fk"), F.col("_k") == F.col("_fk"), "left")
    return out.select(*[F.col("_k")[n].alias(c) for c, n in zip(keys, k)], "n", *ranks)


def run_statistics(df: DataFrame, keys: list[str], value: Column, ok: Column) -> DataFrame:
    """keys, n_runs, success_rate, and n, mean, median (exact), stdev, least, most of the non-null values of the successes."""
    t = df.select(*keys, F.coalesce(ok, F.lit(False)).alias("ok"), F.when(ok, value).alias("v"))
    v = F.col("v")
    out = t.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_runs"), F.round(F.count_if("ok") / F.count(F.lit(1)), 6).alias("success_rate"), F.count(v).alias("n"), F.round(F.avg(v), 10).alias("mean"), F.round(F.coalesce(F.stddev_samp(v), F.lit(0.0)), 6).alias("stdev"), F.min(v).alias("least"), F.max(v).alias("most"))
    n = F.col("n")
    mid = values_at(t, keys, v, {"_low": F.floor((n + 1) / 2), "_high": F.floor(n / 2) + 1})
    mid = mid.select(*[F.col(k).alias(f"_{k}") for k in keys], F.round((F.col("_low") + F.col("_high")) / 2, 10).alias("median"))
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
    return out.join(mid, same, "left").drop(*[f"_{k}" for k in keys])


def exclusive_quantile(df: DataFrame, keys: list[str], value: Column, k: int, of: int) -> DataFrame:
    """keys, n, q: the k-th of `of` quantiles by the rule of rank (n + 1) * k / of, interpolated; null under two values.

    This is not the inclusive rule of percentile. The value is moved by the
    outer steps beyond the ends, as the rule's interpolation does.
    """
    m = F.col("n") + 1
    j = F.greatest(F.lit(1), F.least(F.col("n") - 1, F.floor(m * k / of)))
    out = values_at(df, keys, value, {"_a": j, "_b": j + 1})
    d = m * k - j * of
    return out.select(*keys, "n", F.when(F.col("n") > 1, F.round((F.col("_a") * (of - d) + F.col("_b") * d) / of, 10)).alias("q"))


def tumbling(df: DataFrame, time: str, width: str, keys: list[str], value: str) -> DataFrame:
    """keys, window_start, n, total, mean per window of the width; used alike on batches and streams."""
    out = df.groupBy(F.window(time, width).alias("_w"), *keys).agg(F.count(F.lit(1)).alias("n"), F.sum(value).alias("total"), F.avg(value).alias("mean"))
    return out.select(F.col("_w.start").alias("window_start"), *keys, "n", F.round("total", 4).alias("total"), F.round("mean", 9).alias("mean"))


def window_quantile(df: DataFrame, time: str, width: str, value: str, q: float) -> DataFrame:
    """window_start, n, q: the inclusive percentile of a window's samples, interpolated; windows without any have n 0 and a null q."""
    rows = df.select(F.window(time, width)["start"].alias("window_start"), F.col(value).alias("_value"))
    n = F.count("_value").alias("n")
    at = q * (F.col("n") - 1)
    out = values_at(rows, ["window_start"], F.col("_value"), {"_low": F.floor(at) + 1, "_high": F.ceil(at) + 1})
    every = rows.groupBy("window_start").agg(n)
    part = at - F.floor(at)
    out = out.select(F.col("window_start").alias("_w"), F.round(F.col("_low") * (1 - part) + F.col("_high") * part, 6).alias("q"))
    return every.join(out, F.col("window_start") == F.col("_w"), "left").select("window_start", "n", "q")


def transfer_stats(df: DataFrame, keys: list[str], ms: Column, size: Column) -> DataFrame:
    """keys, n, mean_ms and mb_per_s, guarded against no operations and no time."""
    out = df.groupBy(*keys).agg(F.count(ms).alias("n"), F.sum(ms).alias("_ms"), F.sum(size).alias("_b"))
    return out.select(*keys, "n", F.round(F.col("_ms") / F.greatest(F.lit(1.0), F.col("n").cast("double")), 6).alias("mean_ms"), F.round(F.col("_b") / 1e6 / F.greatest(F.lit(0.001), F.col("_ms") / 1000), 9).alias("mb_per_s"))


def to_target(value: Column, target: float, now: int, least: int, most: int) -> Column:
    """The number of workers that would bring value to its target, within bounds."""
    return F.least(F.greatest(F.ceil(value * now / target), F.lit(least)), F.lit(most)).cast("int")


def spine(windows: DataFrame, time: str, step: str) -> DataFrame:
    """Every step from the first to the last window."""
    ends = windows.agg(F.min(time).alias("a"), F.max(time).alias("b"))
    return ends.select(F.explode(F.sequence("a", "b", F.expr(f"INTERVAL {step}"))).alias(time))


def breaches(windows: DataFrame, time: str, step: str, breach: Column, periods: int, missing: bool) -> DataFrame:
    """time, breach, alarm over a dense spine: alarm where the last `periods` periods all breach.

    missing: what a period without samples counts as. The spine has one row a
    period, so its window is as long as the time covered, not as the data.
    """
    all_ = spine(windows, time, step).join(windows.select(time, breach.alias("breach")), time, "left").withColumn("breach", F.coalesce("breach", F.lit(missing)))
    w = W.orderBy(time).rowsBetween(-(periods - 1), 0)
    return all_.withColumn("alarm", (F.min("breach").over(w)) & (F.count(F.lit(1)).over(w) == periods))


def idle(depth: Column, running: Column) -> Column:
    """1 where both are under 1, else 0."""
    return F.when((depth < 1) & (running < 1), 1).otherwise(0)


def healthy(depth: Column, age_s: Column) -> Column:
    """1 where a queue is short (under 10 messages) and young (under 120 s), else 0."""
    return F.when((depth < 10) & (age_s < 120), 1).otherwise(0)


def send_rates(df: DataFrame, keys: list[str], at: Column, ok: Column) -> DataFrame:
    """keys, n, n_ok, n_failed, duration_s from the first to the last attempt and actual_rps: successes a second, 0 without a duration."""
    s = at.cast("double")
    out = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.count_if(ok).alias("n_ok"), F.coalesce(F.max(s) - F.min(s), F.lit(0.0)).alias("duration_s"))
    rate = F.when(F.col("duration_s") > 0, F.col("n_ok") / F.col("duration_s")).otherwise(F.lit(0.0))
    return out.select(*keys, "n", "n_ok", (F.col("n") - F.col("n_ok")).alias("n_failed"), "duration_s", F.round(rate, 9).alias("actual_rps"))


def job_summary(outcomes: DataFrame, rejected: DataFrame, time: str, width: str) -> DataFrame:
    """window_start, n_enqueued, n_completed, n_failed, n_rejected and mean_s a window.

    outcomes: time, ok, seconds. rejected: time, a row for each message that was
    given up. What was enqueued is what completed, failed or was rejected.
    """
    a = outcomes.select(F.col(time).alias("_t"), F.coalesce("ok", F.lit(False)).alias("_ok"), F.col("seconds").alias("_s"), F.lit(False).alias("_r"))
    b = rejected.select(F.col(time).alias("_t"), F.lit(None).cast("boolean").alias("_ok"), F.lit(None).cast("double").alias("_s"), F.lit(True).alias("_r"))
    g = a.unionByName(b).groupBy(F.window("_t", width).alias("_w"))
    out = g.agg(F.count(F.lit(1)).alias("n_enqueued"), F.count_if("_ok").alias("n_completed"), F.count_if(~F.col("_ok")).alias("n_failed"), F.count_if("_r").alias("n_rejected"), F.round(F.avg("_s"), 10).alias("mean_s"))
    return out.select(F.col("_w.start").alias("window_start"), "n_enqueued", "n_completed", "n_failed", "n_rejected", "mean_s")


def scale_step(value: Column, bands: list[tuple[float, int]]) -> Column:
    """The step of the highest band (from, step) that value reaches, else 0; null counts as 0."""
    out = F.lit(0)
    for low, step in sorted(bands):
        out = F.when(value >= low, step).otherwise(out)
    return out


def two_of(*alarms: Column) -> Column:
    """Are at least two alarms on?"""
    return sum((F.coalesce(a, F.lit(False)).cast("int") for a in alarms), F.lit(0)) >= 2


def pairs(names: DataFrame, name: str, cap: int = 10) -> DataFrame:
    """(a, b) with a < b, at most cap in order: a report over a few alarms, not an operator on rows."""
    few = names.select(name).distinct().orderBy(name).limit(cap + 1)
    return few.select(F.col(name).alias("a")).join(few.select(F.col(name).alias("b")), F.col("a") < F.col("b")).orderBy("a", "b").limit(cap)
