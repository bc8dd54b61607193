"""Finding keys that hold too many rows for one task."""

from __future__ import annotations

import pyspark.sql.types as T
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Parts that rows with a null key, which meet nothing in a join, are spread over.
NULL_PARTS = 256
#: Rows under which a key is never hot.
HOT_ROWS = 100_000


def hot_keys(df: DataFrame, keys: list[str], hot_rows: int = HOT_ROWS) -> DataFrame | None:
    """The keys too large for one task, their count ``n_hot`` and the parts ``n_parts`` they make, or None if there are none.

    Counts are combined before the shuffle, so a hot key costs one row a task.
    With P = spark.sql.shuffle.partitions the P largest keys of more than
    hot_rows rows are looked at; hot are those with more than a P-th of their
    rows together. So at most P keys come to the driver and P + P parts come
    out, however large the data: that is the bound under which the caller may
    broadcast them. Any other key has at most hot_rows rows or a P-th of all
    rows, the share of one task.
    """
    spark = df.sparkSession
    most = int(spark.conf.get("spark.sql.shuffle.partitions"))
    found = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_hot")).where(F.col("n_hot") > hot_rows)
    rows = found.orderBy(F.desc("n_hot")).limit(most).collect()
    share = max(hot_rows, -(-sum(r.n_hot for r in rows) // most))
    hot = [(*r, -(-r.n_hot // share)) for r in rows if r.n_hot > share]
    schema = T.StructType([*found.schema.fields, T.StructField("n_parts", T.LongType())])
    return spark.createDataFrame(hot, schema) if hot else None


def same_keys(a: DataFrame, b: DataFrame, keys: list[str]) -> Column:
    """Null-safe equality on all keys."""
    out = F.lit(True)
    for k in keys:
        out = out & a[k].eqNullSafe(b[k])
    return out


def spread(left: DataFrame, rights: list[DataFrame], keys: list[str], hot_rows: int = HOT_ROWS) -> tuple[DataFrame, list[DataFrame], list[str]]:
    """All sides ready to be joined on the returned columns: keys, and a salt where left has hot keys.

    The skew join of adaptive execution needs both sides to come straight from
    a shuffle; after an aggregation or before another operator on the same key
    it does nothing. Here the rows of a hot left key are spread over its parts,
    and the right rows of that key are repeated once a part. Meant for right
    sides with few rows a key.
    """
    hot = hot_keys(left.select(*keys), keys, hot_rows)
    if hot is None:
        return left, rights, keys
    # at most spark.sql.shuffle.partitions keys
    parts = F.broadcast(hot.select(*keys, F.col("n_parts").alias("_parts")))
    lost = F.lit(False)
    for k in keys:
        lost = lost | F.col(k).isNull()
    # the partition number keeps whole copies of a row from meeting in one part
    hashed = F.xxhash64(F.spark_partition_id(), *[f.name for f in left.schema if not isinstance(f.dataType, (T.MapType, T.VariantType))])
    big = left.withColumn("_hash", hashed).join(parts, keys, "left").withColumn("_salt", F.pmod("_hash", F.when(lost, F.lit(NULL_PARTS)).otherwise(F.coalesce("_parts", F.lit(1))).cast("bigint")))
    each = F.explode(F.sequence(F.lit(0).cast("bigint"), F.coalesce("_parts", F.lit(1).cast("bigint")) - 1))
    small = [r.join(parts, keys, "left").withColumn("_salt", each).drop("_parts") for r in rights]
    return big.drop("_parts", "_hash"), small, [*keys, "_salt"]


def skew_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner", hot_rows: int = HOT_ROWS) -> DataFrame:
    """left.join(right, keys, how) for inner, left, left_semi and left_anti, with hot left keys spread."""
    a, (b,), on = spread(left, [right], keys, hot_rows)
    return a.join(b, on, how).drop("_salt")
