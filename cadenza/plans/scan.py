"""Running aggregates over ordered rows of a key, without gathering a hot key in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cadenza.plans.skew import HOT_ROWS, hot_keys, same_keys


def before(df: DataFrame, keys: list[str], order: list[str], aggs: dict[str, tuple[str, Column]], slice_by: Column | None = None, hot_rows: int = HOT_ROWS) -> DataFrame:
    """df with, for each name, the aggregate of the rows of the same key that come before: 'sum', 'count', 'max' or 'last' (non-null).

    order must be a total order within a key. slice_by: a bigint that does not
    decrease in that order (such as the hour). Hot keys (as hot_keys finds them)
    are cut by it: slices are scanned apart, and one row a slice hands on what
    came before. Without slice_by a key is scanned whole. 'sum' and 'count'
    start at 0, 'max' and 'last' at null.
    """
    hot = hot_keys(df, keys, hot_rows) if slice_by is not None else None
    if hot is None:
        rows, at = df, keys
    else:
        flag = hot.select(*[F.col(k).alias(f"_h_{k}") for k in keys], F.lit(True).alias("_hot"))
        on = F.lit(True)
        for k in keys:
            on = on & df[k].eqNullSafe(flag[f"_h_{k}"])
        # at most spark.sql.shuffle.partitions keys
        rows = df.join(F.broadcast(flag), on, "left").withColumn("_slice", F.when(F.col("_hot"), slice_by.cast("bigint")).otherwise(F.lit(0)))
        rows = rows.drop("_hot", *[f"_h_{k}" for k in keys])
        at = [*keys, "_slice"]
    kinds = {"sum": F.sum, "count": F.count, "max": F.max, "last": lambda c: F.last(c, ignorenulls=True)}
    w = W.partitionBy(*at).orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    out = rows.withColumns({n: kinds[k](c).over(w) for n, (k, c) in aggs.items()})
    zero = {n for n, (k, _) in aggs.items() if k in ("sum", "count")}
    if hot is None:
        return out.withColumns({n: F.coalesce(n, F.lit(0)) for n in zero})
    whole = []
    for n, (k, c) in aggs.items():
        total = F.max_by(c, F.when(c.isNotNull(), F.struct(*order))) if k == "last" else kinds[k](c)
        whole.append(total.alias(f"_t_{n}"))
    slices = rows.groupBy(*at).agg(*whole)
    ws = W.partitionBy(*keys).orderBy("_slice").rowsBetween(W.unboundedPreceding, -1)
    carry = {"sum": F.sum, "count": F.sum, "max": F.max, "last": lambda c: F.last(c, ignorenulls=True)}
    slices = slices.select(*at, *[carry[k](F.col(f"_t_{n}")).over(ws).alias(f"_c_{n}") for n, (k, _) in aggs.items()])
    out = out.join(slices, same_keys(out, slices, at), "left").select(out["*"], *[slices[f"_c_{n}"] for n in aggs])
    for n, (k, _) in aggs.items():
        c = F.col(f"_c_{n}")
        if n in zero:
            out = out.withColumn(n, F.coalesce(n, F.lit(0)) + F.coalesce(c, F.lit(0)))
        else:
            out = out.withColumn(n, F.greatest(n, c) if k == "max" else F.coalesce(n, c))
    return out.drop("_slice", *[f"_c_{n}" for n in aggs])


def batched(df: DataFrame, key: list[str], size: int, name: str = "batch", hot_rows: int = HOT_ROWS) -> DataFrame:
    """df with the number of the batch each row is in: batches of size rows, only the last may be smaller.

    Rows are numbered in the order of a hash of key, in slices of it, so no task
    holds them all. Equal keys may be cut by a batch's end; whole copies of a row
    are numbered in any order.
    """
    rows = df.withColumns({"_all": F.lit(0), "_hash": F.xxhash64(*key)})
    rows = before(rows, ["_all"], ["_hash", *key], {"_pos": ("count", F.lit(1))}, F.shiftright("_hash", 44), hot_rows)
    return rows.withColumn(name, F.floor(F.col("_pos") / size).cast("bigint")).drop("_all", "_hash", "_pos")
