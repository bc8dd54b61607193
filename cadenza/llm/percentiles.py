"""Percentiles of very large numeric columns by radix selection.

Doubles are mapped to integers of the same order. A histogram of their first
16-bit digit, combined where the rows are, shows which digit holds each target
rank; only the values with that digit are looked at again. If they are few they
are counted by their remaining digits at once, otherwise digit by digit, each
time following only the digit that holds the rank. The value at the rank is
known exactly, so the error in rank is 0. Partitions or days can be summarised
apart, as counts of codes that are stored and later added up; the same
selection over the combined counts gives the same result.
"""

from __future__ import annotations

import pyspark.sql.types as T
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cadenza.operators.dedupe import epoch_seconds
from cadenza.plans.skew import HOT_ROWS
from cadenza.session import written
from cadenza.sources.tables import table

PERCENTS = (50, 90, 95, 99)
DIGIT_BITS = 16
#: Bits of a code that a stored summary keeps: 12 of sign and exponent, 20 of the mantissa.
SUMMARY_BITS = 32


def coded(df: DataFrame, value: str, name: str = "u") -> DataFrame:
    """df with an integer for each double of value, in the doubles' order: the IEEE bit pattern, negated for negative values.

    Inside generated code, without Python: the exponent comes from a logarithm
    and is corrected, the mantissa from an exact division; each step is a column
    of its own, so that it is made once a row. -0.0 equals 0.0, NaN is above all,
    null stays null.
    """
    v, a, p = F.col(value), F.col("_a"), F.col("_p")
    low, high = p > a, (p + p) <= a
    e = F.col("_e") - low.cast("bigint") + high.cast("bigint")
    exact = F.when(low, p / 2).when(high, p + p).otherwise(p)
    normal = (F.col("_e2") + 1023) * F.lit(1 << 52) + ((a / F.col("_p2") - 1) * F.lit(float(1 << 52))).cast("bigint")
    tiny = (a * F.lit(2.0**537) * F.lit(2.0**537)).cast("bigint")  # below the least normal double
    bits = F.when(F.isnan(v), F.lit(0x7FF8 << 48)).when(a == 0, F.lit(0)).when(a == F.lit(float("inf")), F.lit(0x7FF0 << 48)).when(a < F.lit(2.0**-1022), tiny).otherwise(normal).cast("bigint")
    out = df.withColumn("_a", F.abs(v)).withColumn("_e", F.floor(F.least(F.log2("_a"), F.lit(1023.0)))).withColumn("_p", F.pow(F.lit(2.0), "_e"))
    out = out.withColumns({"_e2": e, "_p2": exact}).withColumn(name, F.when(v < 0, -bits).otherwise(bits))
    return out.drop("_a", "_e", "_p", "_e2", "_p2")


def double_of(u: Column) -> Column:
    """The double that ordered_long maps to u."""
    bits = F.abs(u)
    e, m = F.shiftright(bits, 52), bits.bitwiseAND(F.lit((1 << 52) - 1)).cast("double")
    normal = (1 + m / F.lit(float(1 << 52))) * F.pow(F.lit(2.0), e - 1023)
    v = F.when(e == 0, m * F.lit(5e-324)).when(e == 2047, F.lit(float("inf"))).otherwise(normal)
    return F.when(u < 0, -v).otherwise(v)


def _targets(counts: DataFrame, at: list[str], ranks: dict[str, Column], n: Column, step: Column) -> DataFrame:
    """_k, prefix, n, c and ranks among the c values with the prefix: the digits that hold a rank (the ranks of others are null).

    counts: at, digit, c and what ranks (from 1, among all rows of at) and n need.
    """
    w = W.partitionBy(*at)
    h = counts.withColumns({"_to": F.sum("c").over(w.orderBy("digit")), "_all": F.sum("c").over(w)})
    h = h.withColumn("n", n)
    hit = lambda r: (r <= F.col("_to")) & (r > F.col("_to") - F.col("c"))
    h = h.select("_k", step.alias("_next"), "n", "c", *[F.when(hit(r), r - F.col("_to") + F.col("c")).alias(x) for x, r in ranks.items()])
    return h.withColumnRenamed("_next", "prefix").where(F.coalesce(*ranks).isNotNull())


def _select(rows: DataFrame, percents: tuple[int, ...], hot_rows: int, count: Column) -> DataFrame:
    """_k, n and the code at each percent (pNN): rows hold _k (a struct), u and what count needs."""
    spark = rows.sparkSession
    most = int(spark.conf.get("spark.sql.shuffle.partitions"))
    names = [f"r{p}" for p in percents]
    prefix_of = lambda k: F.shiftright("u", 64 - DIGIT_BITS * k)
    first = rows.groupBy("_k", prefix_of(1).alias("digit")).agg(count.alias("c"))
    ranks = {x: F.floor((F.col("n") * p + 99) / 100).cast("bigint") for x, p in zip(names, percents)}
    # written: it is read by the search for large digits and by the selection
    wanted = written(_targets(first, ["_k"], ranks, F.col("_all"), F.col("digit")), "ranks")
    done = []
    for k in range(1, 64 // DIGIT_BITS + 1):
        if k == 64 // DIGIT_BITS:  # all digits are known
            done.append(wanted.select("_k", "n", *[F.when(F.col(x).isNotNull(), F.col("prefix")).alias(f"p{p}") for x, p in zip(names, percents)]))
            break
        # at most as many as there are tasks come to the driver; any other digit holds no more rows than one task's share
        large = wanted.where(F.col("c") > hot_rows).orderBy(F.desc("c")).limit(most).collect()
        share = max(hot_rows, -(-sum(r.c for r in large) // most))
        large = [r for r in large if r.c > share]
        few = wanted.where(F.col("c") <= share).drop("c")
        near = rows.withColumn("prefix", prefix_of(k)).join(few, ["_k", "prefix"])
        near = near.groupBy("_k", "prefix", F.col("u").alias("digit")).agg(count.alias("c"), *[F.any_value(x).alias(x) for x in ("n", *names)])
        near = near.withColumn("_to", F.sum("c").over(W.partitionBy("_k", "prefix").orderBy("digit")))
        hit = lambda x: (F.col(x) <= F.col("_to")) & (F.col(x) > F.col("_to") - F.col("c"))
        done.append(near.groupBy("_k").agg(F.max("n").alias("n"), *[F.max(F.when(hit(x), F.col("digit"))).alias(f"p{p}") for x, p in zip(names, percents)]))
        if not large:
            break
        # the next digit of large ones is counted where the rows are: at most 2**16 counts a task and digit are moved
        some = F.broadcast(spark.createDataFrame(large, wanted.schema).drop("c"))
        deep = rows.withColumn("prefix", prefix_of(k)).join(some, ["_k", "prefix"])
        deep = deep.groupBy("_k", "prefix", prefix_of(k + 1).alias("digit")).agg(count.alias("c"), *[F.any_value(x).alias(x) for x in ("n", *names)])
        wanted = written(_targets(deep, ["_k", "prefix"], {x: F.col(x) for x in names}, F.col("n"), F.col("digit")), "ranks")
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out if len(done) == 1 else out.groupBy("_k").agg(F.max("n").alias("n"), *[F.max(f"p{p}").alias(f"p{p}") for p in percents])


def _values(selected: DataFrame, groups: list[str], percents: tuple[int, ...]) -> DataFrame:
    return selected.select(*[F.col("_k")[f"k{i}"].alias(g) for i, g in enumerate(groups)], "n", *[double_of(F.col(f"p{p}")).alias(f"p{p}") for p in percents])


def _codes(values: DataFrame, groups: list[str], value: str, extra: list[Column]) -> DataFrame:
    """The numbers among the values, as _k (a struct of the groups, whose nulls are equal) and the code u."""
    # of the type that it has when it is read back, so that a join on it keeps the rows where they are
    kind = T.StructType([T.StructField(f"k{i}", values.schema[g].dataType) for i, g in enumerate(groups)])
    rows = values.select(F.struct(*[F.col(g).alias(f"k{i}") for i, g in enumerate(groups)]).cast(kind).alias("_k"), F.col(value).cast("double").alias("_v"), *extra)
    # never null: a test for null, pushed below the steps of the code, would make them all over again
    return coded(rows.where(F.col("_v").isNotNull() & ~F.isnan("_v")), "_v").withColumn("u", F.coalesce("u", F.lit(0).cast("bigint"))).drop("_v")


def percentiles(values: DataFrame, groups: list[str], value: str, percents: tuple[int, ...] = PERCENTS, hot_rows: int = HOT_ROWS) -> DataFrame:
    """groups, n and a column pNN for each percent: the smallest value with at least n * percent / 100 values up to it.

    Null and NaN are no values and are left out, all others count, negative ones
    too; a group without any does not come out. Null group values form groups of
    their own. Ties count each. groups: at least one column.

    The rows are read twice: for the histogram of first digits, whose counts are
    combined before they are moved, and for the values that share the digit of a
    rank. Digits of more than hot_rows values are never gathered: their next
    digits are counted where the rows are.
    """
    return _values(_select(_codes(values, groups, value, []), percents, hot_rows, F.count(F.lit(1))), groups, percents)


def summaries(values: DataFrame, groups: list[str], value: str, part: str, bits: int = SUMMARY_BITS) -> DataFrame:
    """Counts of codes (_k, part, u, c) of each group and part, to be stored and combined later.

    The low bits of a code are dropped, so a summary has at most one row for each
    of the remaining codes, however many values it stands for. With 12 + b bits a
    combined percentile is the right one with its mantissa cut to b bits: too
    small by a part of 2**-b of it at most, and wrong in rank by fewer than the
    values that share the code. With 64 bits nothing is lost, and continuous
    values have a row each.
    """
    mask = -(1 << (64 - bits))
    rows = _codes(values, groups, value, [F.col(part).alias("part")])
    return rows.withColumn("u", F.col("u").bitwiseAND(F.lit(mask))).groupBy("_k", "part", "u").agg(F.count(F.lit(1)).alias("c"))


def combined(parts: DataFrame, groups: list[str], percents: tuple[int, ...] = PERCENTS, hot_rows: int = HOT_ROWS) -> DataFrame:
    """percentiles of all parts together, from the union of their summaries; with 64 bits the same as from the values."""
    return _values(_select(parts.select("_k", "u", "c"), percents, hot_rows, F.sum("c")), groups, percents)


def measured(c: str) -> Column:
    """The measurement, or null: in these tables negative values and NaN are none."""
    return F.when(~F.isnan(c) & (F.col(c) >= 0), F.col(c))


def _measurements(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(scope, grp, day, value, part) per processor, per processor and day, and per activity; parts are days, and of the words 16 partitions."""
    times = table(spark, sf_dir, "activity_results")
    # the date of the epoch second, whatever the session's time zone
    day = F.date_add(F.lit("1970-01-01").cast("date"), F.floor(epoch_seconds(F.col("timestamp")) / 86400).cast("int")).cast("string")
    times = times.select(F.col("processor").alias("grp"), day.alias("part"), measured("processing_time").alias("value"))
    whole = times.select(F.lit("processor").alias("scope"), "grp", F.lit(None).cast("string").alias("day"), "value", "part")
    daily = times.select(F.lit("processor_day").alias("scope"), "grp", F.col("part").alias("day"), "value", "part")
    part = F.pmod(F.xxhash64("word_id"), F.lit(16)).cast("string")
    words = table(spark, sf_dir, "word_items").select(F.lit("activity").alias("scope"), F.col("activity_id").alias("grp"), F.lit(None).cast("string").alias("day"), measured("confidence").alias("value"), part.alias("part"))
    return whole, daily, words


GROUPS = ["scope", "grp", "day"]


def all_percentiles(spark: SparkSession, sf_dir: str, hot_rows: int = HOT_ROWS) -> DataFrame:
    """processing_time per processor and per processor and day, confidence per activity."""
    whole, daily, words = _measurements(spark, sf_dir)
    return percentiles(whole.unionByName(daily).unionByName(words), GROUPS, "value", hot_rows=hot_rows)


def combined_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """processing_time per processor from stored summaries of single days that keep every bit: the same as from the values."""
    whole, _, _ = _measurements(spark, sf_dir)
    return combined(written(summaries(whole, GROUPS, "value", "part", bits=64), "summaries"), GROUPS)


def combined_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All of all_percentiles from stored short summaries: of days for times, of partitions of the words for confidences."""
    whole, daily, words = _measurements(spark, sf_dir)
    return combined(written(summaries(whole.unionByName(daily).unionByName(words), GROUPS, "value", "part"), "summaries"), GROUPS)


_VALUES_SQL = """
WITH t AS (SELECT processor AS grp, strftime(make_timestamp("timestamp" * 1000000), '%Y-%m-%d') AS day, processing_time AS value FROM activity_results),
v AS ({sources}),
r AS (SELECT *, row_number() OVER (PARTITION BY scope, grp, day ORDER BY value) AS k, count(*) OVER (PARTITION BY scope, grp, day) AS n
      FROM v WHERE value IS NOT NULL AND NOT isnan(value) AND value >= 0)
SELECT scope, grp, day, n, max(value) FILTER (WHERE k = (n * 50 + 99) // 100) AS p50, max(value) FILTER (WHERE k = (n * 90 + 99) // 100) AS p90,
       max(value) FILTER (WHERE k = (n * 95 + 99) // 100) AS p95, max(value) FILTER (WHERE k = (n * 99 + 99) // 100) AS p99
FROM r GROUP BY scope, grp, day, n
"""
_WHOLE = "SELECT 'processor' AS scope, grp, CAST(NULL AS VARCHAR) AS day, value FROM t"
ALL_SQL = _VALUES_SQL.format(sources=f"{_WHOLE} UNION ALL SELECT 'processor_day', grp, day, value FROM t UNION ALL SELECT 'activity', activity_id, NULL, confidence FROM word_items")
COMBINED_SQL = _VALUES_SQL.format(sources=_WHOLE)
_CUT = "CASE WHEN {p} > 0 THEN floor({p} / pow(2, floor(log2({p})) - 20)) * pow(2, floor(log2({p})) - 20) ELSE {p} END AS {p}"
PARTS_SQL = "SELECT scope, grp, day, n, " + ", ".join(_CUT.format(p=f"p{p}") for p in PERCENTS) + f" FROM ({ALL_SQL})"
