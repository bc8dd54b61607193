"""Messages delivered more than once: keep exactly one copy of each.

Identifiers are split by their aggregated frequency. An identifier seen once
passes without being ranked; only repeated groups are ranked, and the two
results are united. A group too large for one task is ranked in salted parts
whose winners meet in a second, small rank.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cadenza.functions.text import folded
from cadenza.plans.skew import HOT_ROWS, hot_keys

#: Epoch values from here up are milliseconds.
MILLIS_FROM = 100_000_000_000


def epoch_seconds(c: Column) -> Column:
    """Epoch seconds of a value in seconds or milliseconds, cut to whole seconds; null stays null."""
    return F.when(c >= MILLIS_FROM, F.floor(c / 1000)).otherwise(c).cast("bigint")


def tag_duplicates(
    new: DataFrame,
    identifier: dict[str, Column],
    order: list[Column],
    row_id: str,
    stored: DataFrame | None = None,
    part_rows: int = 100_000,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """All stored and new rows with ``_keep``: true for exactly one row of each identifier.

    identifier: name -> expression of the parts of a message's identity; nulls
    are equal to nulls. order: the row that comes first stays; row_id (unique)
    breaks ties and spreads a group. stored: rows of earlier runs, with the same
    columns, or with fewer (missing ones are null). part_rows: rows of one group
    that one task may rank.

    An empty table gives an empty result. Columns of the input called like an
    identifier part are not touched: the parts live in the struct ``_id``, which
    is dropped again. A hot identifier (of more than hot_rows rows, as hot_keys
    finds it) is never shuffled by itself: its rows are marked where they are and
    go to their parts.
    """
    rows = new if stored is None else stored.unionByName(new, allowMissingColumns=True)
    key = F.struct(*[c.alias(k) for k, c in identifier.items()])
    rows = rows.withColumn("_id", key)
    # combined before the shuffle: a hot identifier is one row a task
    freq = rows.groupBy("_id").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    hot = hot_keys(rows.select("_id"), ["_id"], hot_rows)
    on = F.col("_id") == F.col("_rid")  # structs: null fields compare as equal
    some = rows
    if hot is not None:  # at most spark.sql.shuffle.partitions identifiers
        often = F.broadcast(hot.select(F.col("_id").alias("_rid"), F.col("n_hot").alias("_n")))
        some = rows.join(often, on, "left_anti")
    # AQE broadcasts the repeated identifiers if they turn out small
    repeated = freq.select(F.col("_id").alias("_rid"), "_n")
    singles = some.join(repeated, on, "left_anti").withColumn("_keep", F.lit(True))
    many = some.join(repeated, on)
    if hot is not None:
        many = many.unionByName(rows.join(often, on))
    many = many.withColumn("_part", F.pmod(F.xxhash64(row_id), F.ceil(F.col("_n") / part_rows)))
    first = many.withColumn("_r1", F.row_number().over(W.partitionBy("_id", "_part").orderBy(*order, row_id)))
    # winners of the parts meet in part -1; the others have lost and stay where they are
    final = first.withColumn("_part", F.when(F.col("_r1") == 1, F.lit(-1)).otherwise(F.col("_part")))
    final = final.withColumn("_r2", F.row_number().over(W.partitionBy("_id", "_part").orderBy(*order, row_id)))
    final = final.withColumn("_keep", (F.col("_r1") == 1) & (F.col("_r2") == 1))
    return singles.drop("_id").unionByName(final.drop("_id", "_rid", "_n", "_part", "_r1", "_r2"))


def tag_deliveries(new: DataFrame, stored: DataFrame | None = None, part_rows: int = 100_000, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Deliveries of job messages with ``_keep``.

    Two deliveries are of one message if activity_id and source are equal apart
    from case and surrounding white space and timestamp is the same second; null
    equals only null. The earliest received_at stays (null counts as latest),
    then the smallest delivery_id. Rows with a null or blank activity_id name no
    message, so they repeat none: all of them are kept.
    """
    named = F.col("activity_id").rlike(r"(?U)\S")
    every = new if stored is None else stored.unionByName(new, allowMissingColumns=True)
    unnamed = every.where(~F.coalesce(named, F.lit(False))).withColumn("_keep", F.lit(True))
    tagged = tag_duplicates(
        new.where(named),
        {"a": folded(F.col("activity_id")), "s": folded(F.col("source")), "t": epoch_seconds(F.col("timestamp"))},
        [F.col("received_at").asc_nulls_last()],
        "delivery_id",
        None if stored is None else stored.where(named),
        part_rows,
        hot_rows,
    )
    return tagged.unionByName(unnamed)


def keep_one(new: DataFrame, stored: DataFrame | None = None, part_rows: int = 100_000) -> DataFrame:
    """One delivery of each message over all stored and new ones, and every delivery without an activity_id."""
    return tag_deliveries(new, stored, part_rows).where("_keep").drop("_keep")


def kept(stored: DataFrame, new: DataFrame) -> DataFrame:
    """(delivery_id) of the deliveries that stay, over those stored before and new ones."""
    few = ["delivery_id", "activity_id", "source", "timestamp", "received_at"]
    return keep_one(new.select(*few), stored.select(*few)).select("delivery_id")


def found(new: DataFrame, part_rows: int = 100_000, hot_rows: int = HOT_ROWS) -> DataFrame:
    """(delivery_id) of the deliveries to drop."""
    return tag_deliveries(new.select("delivery_id", "activity_id", "source", "timestamp", "received_at"), None, part_rows, hot_rows).where("NOT _keep").select("delivery_id")


FOUND_SQL = r"""
WITH k AS (
  SELECT delivery_id, received_at,
         lower(regexp_replace(activity_id, '^[\s\p{Z}]+|[\s\p{Z}]+$', '', 'g')) AS a,
         lower(regexp_replace(source, '^[\s\p{Z}]+|[\s\p{Z}]+$', '', 'g')) AS s,
         CASE WHEN "timestamp" >= 100000000000 THEN "timestamp" // 1000 ELSE "timestamp" END AS t
  FROM job_messages),
r AS (
  SELECT delivery_id, row_number() OVER (PARTITION BY a, s, t ORDER BY received_at NULLS LAST, delivery_id) AS n
  FROM k WHERE a <> '')
SELECT delivery_id FROM r WHERE n > 1
"""

KEPT_SQL = f"SELECT delivery_id FROM job_messages WHERE delivery_id NOT IN ({FOUND_SQL})"
