"""Matching records by nearest time: a stateful streaming join.

Both sides are buffered per entity. A left row is emitted, with its nearest
right row or none, once the watermark has passed its tolerance horizon; right
rows that no pending or future left row can reach are evicted.

State is kept per shard: a hash of (entity, time bucket), so one entity with a
third of all rows is spread over its buckets. A right row within the tolerance
of a bucket's edge goes to both buckets. A bucket with too many left rows is
salted, and one with too many right rows is pre-aggregated to one row a
millisecond before it is shuffled.

Stored tables are replayed in the order of their event time, a slice of it in
each micro-batch. The clock of a replay is the start of the slice that arrives:
when it moves on, the left rows of the slices before leave and their right rows
are evicted. So what the state holds at once is two to three slices, not the
tables.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupStateTimeout

from cadenza.plans.skew import HOT_ROWS, hot_keys
from cadenza.session import discard, shared_dir

#: Added to all times (ms), so that the clock starts far above Spark's initial watermark of 0
#: and stays within the range of nanosecond timestamps.
BASE = 4_100_000_000_000
#: Times beyond this many ms are held at it on the watermark's clock only; matching uses the true time.
FAR = 4_000_000_000_000
OUT = "left_id bigint, right_id bigint"
#: Rows of a slice of event time, while there are no more than MOST_SLICES; beyond that slices grow, and the state with them.
SLICE_ROWS = 400_000
MOST_SLICES = 64
#: Slices whose rows the state of a replay holds at once.
HELD_SLICES = 3
#: Shards up to this number are dealt evenly to the state partitions; more of them even out by themselves.
DEALT_SHARDS = 4096
#: Rows of an Arrow batch of the replay: a few MB, so that a shard comes to Python in few pieces.
BATCH_ROWS = 50_000
#: Keeps state outside the executors' heap and on their disks, with what changed in the shared checkpoint folder.
PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def match_sorted(le: np.ndarray, lt: np.ndarray, re_: np.ndarray, rt: np.ndarray, rid: np.ndarray, tolerance: int) -> np.ndarray:
    """For each left (entity code, time) the index of its right partner, or -1. One sort, no pairs.

    Nearest time within tolerance; at equal distance the earlier time, at equal time the smaller id.
    """
    nl, nr = len(le), len(re_)
    out = np.full(nl, -1, np.int64)
    if not nl or not nr:
        return out
    e, t = np.concatenate([re_, le]), np.concatenate([rt, lt])
    tie = np.concatenate([-rid, np.zeros(nl, np.int64)])  # at one time the smallest id comes last of the rights
    left = np.concatenate([np.zeros(nr, np.int8), np.ones(nl, np.int8)])
    order = np.lexsort((tie, left, t, e))
    pos = np.arange(nl + nr)
    is_right = order < nr
    prev = np.maximum.accumulate(np.where(is_right, pos, -1))
    # of the rights at one later time the smallest id is the last of its run: find the run's end
    se, st = e[order], t[order]
    last = np.full(nl + nr, -1, np.int64)
    rp = pos[is_right]
    run_end = np.r_[(se[rp][1:] != se[rp][:-1]) | (st[rp][1:] != st[rp][:-1]), True]
    ends = rp[run_end][np.cumsum(np.r_[False, run_end[:-1]])]
    last[rp] = ends
    nxt = np.minimum.accumulate(np.where(is_right, pos, nl + nr)[::-1])[::-1]
    q = pos[~is_right]
    p, n = prev[q], nxt[q]
    far = np.int64(tolerance) + 1
    ok_p = (p >= 0) & (se[np.maximum(p, 0)] == se[q])
    dp = np.where(ok_p, st[q] - st[np.maximum(p, 0)], far)
    nn = np.minimum(n, nl + nr - 1)
    ok_n = (n < nl + nr) & (se[nn] == se[q])
    dn = np.where(ok_n, st[nn] - st[q], far)
    pick = np.where(dp <= dn, np.maximum(p, 0), last[nn])
    good = np.minimum(dp, dn) <= tolerance
    out[order[q] - nr] = np.where(good, order[pick], -1)
    return out


def _load(blob: bytes | None) -> list[pa.Table]:
    return [pa.ipc.open_stream(blob).read_all()] if blob else []


def _save(t: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, t.schema, options=pa.ipc.IpcWriteOptions(compression="lz4")) as w:
        w.write_table(t)
    return sink.getvalue().to_pybytes()


def _stepper(tolerance: int):
    """The state function: (shard, rows, state) -> emitted pairs."""

    def step(key, frames: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        held = _load(bytes(state.get[0])) if state.exists else []
        n_held = sum(h.num_rows for h in held)
        if not state.hasTimedOut:
            for f in frames:
                held.append(pa.table({"side": pa.array(f["side"], pa.int8()), "entity": pa.array(f["entity"], pa.string()).dictionary_encode(), "t": pa.array(f["t"], pa.int64()), "id": pa.array(f["id"], pa.int64())}))
        if not held:
            return
        rows = pa.concat_tables(held).unify_dictionaries().combine_chunks()
        side, t, ids = (rows[c].to_numpy() for c in ("side", "t", "id"))
        entity = rows["entity"].combine_chunks()
        code = (entity.chunk(0) if isinstance(entity, pa.ChunkedArray) else entity).indices.to_numpy(zero_copy_only=False).astype(np.int64)
        now = state.getCurrentWatermarkMs() - BASE
        clock = np.clip(t, -FAR, FAR)
        due = (side == 0) & (clock + tolerance < now)
        if due.any():
            at = np.flatnonzero(due)
            # a right row from now on is farther than the tolerance from all that are due
            near = np.flatnonzero((side == 1) & (clock < now))
            hit = match_sorted(code[at], t[at], code[near], t[near], ids[near], tolerance)
            partner = pd.array(np.where(hit >= 0, ids[near][hit] if len(near) else 0, 0), "Int64")
            partner[hit < 0] = pd.NA
            yield pd.DataFrame({"left_id": ids[at], "right_id": partner})
        keep = np.where(side == 0, ~due, (side == 1) & (clock >= now - 2 * tolerance - 2))
        # of the rights of one entity and time that come together only the smallest id can be a partner
        right = np.flatnonzero(keep[n_held:] & (side[n_held:] == 1)) + n_held
        order = right[np.lexsort((ids[right], t[right], code[right]))]
        again = np.zeros(len(order), bool)
        again[1:] = (code[order][1:] == code[order][:-1]) & (t[order][1:] == t[order][:-1])
        keep[order[again]] = False
        if not keep.any():
            if state.exists:
                state.remove()
            return
        rest = rows.filter(pa.array(keep))
        state.update((_save(rest),))
        waits, stays = clock[keep & (side == 0)], clock[keep & (side == 1)]
        wake = waits.min() + tolerance + 1 if len(waits) else stays.max() + 2 * tolerance + 3
        state.setTimeoutTimestamp(int(wake) + BASE)

    return step


def _placed(rows: DataFrame, side: int, tolerance: int, bucket_ms: int, salts: DataFrame | None) -> DataFrame:
    """Rows (entity, t, id) with their side, bucket and salt: a left row once, a right row where any left row could ask for it."""
    low, high = (F.floor((F.col("t") + d) / F.lit(bucket_ms)).cast("bigint") for d in ((0, 0) if side == 0 else (-tolerance, tolerance)))
    rows = rows.select(F.lit(side).cast("byte").alias("side"), "entity", "t", "id", F.explode(F.sequence(low, high)).alias("bucket") if side else low.alias("bucket"))
    if salts is None:
        return rows.withColumn("salt", F.lit(0).cast("bigint"))
    rows = rows.join(F.broadcast(salts), ["entity", "bucket"], "left").withColumn("n_salts", F.coalesce("n_salts", F.lit(1).cast("bigint")))
    if side == 0:
        return rows.withColumn("salt", F.pmod(F.xxhash64("id"), F.col("n_salts"))).drop("n_salts")
    return rows.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("n_salts") - 1))).drop("n_salts")


def _clock() -> Column:
    return F.least(F.greatest(F.col("t"), F.lit(-FAR)), F.lit(FAR))


def _sharded(left: DataFrame, right: DataFrame, tolerance_ms: int, shards: int | list[int], bucket_ms: int, salts: DataFrame | None) -> DataFrame:
    """(side, entity, t, id, shard): the rows of both sides where they are buffered. shards: how many, or their numbers."""
    rows = _placed(left, 0, tolerance_ms, bucket_ms, salts).unionByName(_placed(right, 1, tolerance_ms, bucket_ms, salts))
    shard = F.pmod(F.xxhash64("entity", "bucket", "salt"), F.lit(shards if isinstance(shards, int) else len(shards))).cast("int")
    if not isinstance(shards, int):
        shard = F.element_at(F.array(*[F.lit(x) for x in shards]), shard + 1)
    return rows.select("side", "entity", "t", "id", shard.alias("shard"))


def _dealt(spark: SparkSession, shards: int, partitions: int) -> int | list[int]:
    """At least so many shards: numbers of which the hash partitioning of a stream gives each state partition equally many."""
    if shards > DEALT_SHARDS:
        return shards
    each = -(-shards // partitions)
    number = F.col("id").cast("int")
    home = F.pmod(F.hash(number), F.lit(partitions))
    rank = F.row_number().over(Window.partitionBy(home).orderBy("id"))
    few = spark.range(0, 8 * each * partitions + 200, 1, 1).select(number.alias("id"), rank.alias("rank")).where(F.col("rank") <= each)
    return sorted(r.id for r in few.collect())


def _state_partitions(spark: SparkSession, slices: int, shards: int) -> int:
    """Partitions of a replay's state, which holds few of the slices at once: as many as are of a shuffle partition's size,
    or one a core if that is more, but none without a shard: each costs a task of Python and a state store in every micro-batch."""
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return min(partitions, shards, max(spark.sparkContext.defaultParallelism, -(-HELD_SLICES * partitions // slices)))


def _joined(rows: DataFrame, at: Column, tolerance_ms: int, delay: str) -> DataFrame:
    """The pairs of a stream of sharded rows, with the event time at (ms)."""
    rows = rows.withColumn("horizon", F.timestamp_millis(at + F.lit(BASE))).withWatermark("horizon", delay)
    rows = rows.select("side", "entity", "t", "id", "shard", "horizon")
    return rows.groupBy("shard").applyInPandasWithState(_stepper(tolerance_ms), OUT, "rows binary", "append", GroupStateTimeout.EventTimeTimeout)


def nearest_stream(left: DataFrame, right: DataFrame, tolerance_ms: int, shards: int, bucket_ms: int = 600_000, delay: str = "0 seconds", salts: DataFrame | None = None) -> DataFrame:
    """(left_id, right_id) of two streams of (entity string, t bigint in ms, id bigint), none of them null.

    A row's event time is its horizon, t + tolerance; delay is how far a row of
    either stream may come behind the latest one, and later ones are dropped by
    the watermark. salts (entity, bucket, n_salts): buckets whose left rows are
    spread. Each left row comes out once, with a null right_id if it has no
    partner. Needs output mode append.
    """
    return _joined(_sharded(left, right, tolerance_ms, shards, bucket_ms, salts), _clock() + F.lit(tolerance_ms + 2), tolerance_ms, delay)


def _slice_bounds(times: DataFrame, slices: int) -> list[int]:
    """At most slices - 1 times that cut the rows into parts of about equal size."""
    if slices < 2:
        return []
    at = times.agg(F.percentile_approx("t", [k / slices for k in range(1, slices)], 10_000)).first()[0]
    return sorted(set(at or []))


def _slice_of(t: Column, bounds: list[int], first: int = 0) -> Column:
    """How many of the sorted bounds are no later than t, by bisection."""
    if not bounds:
        return F.lit(first)
    k = len(bounds) // 2
    return F.when(t < bounds[k], _slice_of(t, bounds[:k], first)).otherwise(_slice_of(t, bounds[k + 1 :], first + k + 1))


def replay_nearest(
    spark: SparkSession,
    left_path: str,
    right_path: str,
    left: dict[str, Column],
    right: dict[str, Column],
    left_ok: Column,
    right_ok: Column,
    tolerance_ms: int,
    bucket_ms: int = 600_000,
    hot_rows: int = HOT_ROWS,
    shard_rows: int = 100_000,
    slice_rows: int = SLICE_ROWS,
    watch=None,
) -> DataFrame:
    """Two stored tables replayed through the stateful join, whole and in event-time order: none of their rows is late.

    left, right: expressions of entity, t and id; the *_ok conditions say which
    rows take part (nulls must be excluded there). The rows are put in place once
    and written by slices of event time, both sides together; slice after slice
    is added to the folder of one running stream. All rows of a slice have the
    slice's start as their event time, so the watermark stays behind it until
    the next slice comes, whether its files arrive at once or not. watch(progress)
    is called for each micro-batch, for tests and logs. Writes to the shared
    folder and returns (left_id, right_id) read from there.
    """
    l_stored, r_stored = spark.read.parquet(left_path), spark.read.parquet(right_path)
    take = lambda df, cols, ok: df.where(ok).select(*[c.alias(k) for k, c in cols.items()]).where("t IS NOT NULL")
    l_rows, r_rows = take(l_stored, left, left_ok), take(r_stored, right, right_ok)
    total = l_stored.count() + r_stored.count()  # from the files' footers
    slices = min(MOST_SLICES, max(1, -(-total // slice_rows)))
    bounds = _slice_bounds(l_rows.select(_clock().alias("t")).unionByName(r_rows.select(_clock().alias("t"))), slices)
    bucket = F.floor(F.col("t") / F.lit(bucket_ms)).cast("bigint").alias("bucket")
    sided = l_rows.select(F.lit(0).alias("side"), "entity", bucket).unionByName(r_rows.select(F.lit(1).alias("side"), "entity", bucket))
    # at most spark.sql.shuffle.partitions buckets
    hot = hot_keys(sided, ["side", "entity", "bucket"], hot_rows)
    salts = None
    if hot is not None:
        salts = hot.where("side = 0").select("entity", "bucket", F.col("n_parts").alias("n_salts"))
        dense = F.broadcast(hot.where("side = 1").select("entity", "bucket"))
        r_rows = r_rows.withColumn("bucket", bucket)
        few = r_rows.join(dense, ["entity", "bucket"], "left_semi").groupBy("entity", "t").agg(F.min("id").alias("id"))
        r_rows = r_rows.join(dense, ["entity", "bucket"], "left_anti").drop("bucket").unionByName(few)
    shards = max(1, -(-HELD_SLICES * total // (max(slices, HELD_SLICES) * shard_rows)))
    partitions = _state_partitions(spark, slices, shards)
    rows = _sharded(l_rows, r_rows, tolerance_ms, _dealt(spark, shards, partitions), bucket_ms, salts)
    cut = _slice_of(_clock(), bounds)
    starts = [-FAR - 1, *bounds]
    mark = F.element_at(F.array(*[F.lit(x).cast("bigint") for x in starts]), F.col("slice") + 1)
    base = shared_dir(spark, "nearest")
    rows = rows.withColumn("slice", cut).withColumn("mark", mark)
    rows.hint("rebalance", "slice").write.partitionBy("slice").parquet(f"{base}/slices")
    rows = rows.drop("slice")
    # two last slices without rows of either side: the first moves the clock past all rows, the second lets them leave
    for k in (0, 1):
        end = spark.range(1).select(F.lit(2).cast("byte").alias("side"), F.lit("").alias("entity"), F.lit(FAR).alias("t"), F.lit(0).cast("bigint").alias("id"), F.lit(0).alias("shard"), F.lit(FAR + 4 * tolerance_ms + 10 + k).alias("mark"))
        end.select(*[F.col(f.name).cast(f.dataType) for f in rows.schema]).write.parquet(f"{base}/slices/slice={len(starts) + k}")
    return _replay(spark, base, rows, tolerance_ms, range(len(starts) + 2), partitions, watch)


def _replay(spark: SparkSession, base: str, rows: DataFrame, tolerance_ms: int, slices: range, partitions: int, watch) -> DataFrame:
    """The pairs of the slices written under base, a micro-batch each."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(base).getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(path(f"{base}/in/{slices[-1] + 1:04d}"))  # an empty one, so that there is a folder from the start
    settings = {
        "spark.sql.streaming.stateStore.providerClass": PROVIDER,
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
        "spark.sql.streaming.noDataMicroBatches.enabled": "false",
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.execution.arrow.maxRecordsPerBatch": str(BATCH_ROWS),
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        arriving = spark.readStream.schema(rows.schema).parquet(f"{base}/in/*")
        out = _joined(arriving, F.col("mark"), tolerance_ms, "1 millisecond").writeStream.format("parquet").option("checkpointLocation", f"{base}/state").option("path", f"{base}/pairs")
        query = out.outputMode("append").start()
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
    try:
        seen = -1
        for k in slices:
            if not fs.rename(path(f"{base}/slices/slice={k}"), path(f"{base}/in/{k:04d}")):
                continue  # no row has such a time
            query.processAllAvailable()
            for progress in query.recentProgress if watch is not None else ():
                if progress["batchId"] > seen and progress["numInputRows"]:
                    seen = progress["batchId"]
                    watch(progress)
    finally:
        query.stop()
    for done in ("state", "in", "slices"):  # the replay is over: its state, log and input aren't needed again
        discard(spark, f"{base}/{done}")
    return spark.read.schema(OUT).parquet(f"{base}/pairs")


def _ms(c: str) -> Column:
    """Whole milliseconds of seconds, halves away from zero; null for NaN and times beyond the clock.

    The same as round(), which takes each number through its decimal text.
    """
    size = F.abs(F.col(c)) * 1000
    whole = F.floor(size)
    near = whole + (size - whole >= 0.5).cast("bigint")
    return F.when(F.abs(F.col(c)) < FAR / 1000, F.when(F.col(c) < 0, -near).otherwise(near))


def words(spark: SparkSession, sf_dir: str, **sizes: int) -> DataFrame:
    """(word_id, trans_id bigint or null) of each word with an activity and a start.

    Only transcriptions with activity, start and end, and with end after start,
    are partners; within 250 ms, at equal distance the earlier start, then the
    smaller trans_id. Repeated words have ids of their own and are matched each.
    Empty tables give an empty result.
    """
    pairs = replay_nearest(
        spark,
        f"{sf_dir}/word_items.parquet",
        f"{sf_dir}/word_transcriptions.parquet",
        {"entity": F.col("activity_id"), "t": _ms("start"), "id": F.col("word_id")},
        {"entity": F.col("activity_id"), "t": _ms("start_time"), "id": F.col("trans_id")},
        F.col("activity_id").isNotNull() & F.col("word_id").isNotNull(),
        F.col("activity_id").isNotNull() & F.col("trans_id").isNotNull() & (_ms("end_time") > _ms("start_time")),
        250,
        **sizes,
    )
    return pairs.select(F.col("left_id").alias("word_id"), F.col("right_id").alias("trans_id"))


def found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(word_id, trans_id) of the words that have a partner."""
    return words(spark, sf_dir).where("trans_id IS NOT NULL")


FOUND_SQL = """
WITH w AS (SELECT word_id, activity_id, CAST(round(start * 1000) AS BIGINT) AS t FROM word_items WHERE activity_id IS NOT NULL AND start IS NOT NULL),
r AS (SELECT activity_id, CAST(round(start_time * 1000) AS BIGINT) AS t, min(trans_id) AS trans_id FROM word_transcriptions
      WHERE activity_id IS NOT NULL AND round(end_time * 1000) > round(start_time * 1000) GROUP BY 1, 2),
a AS (SELECT w.word_id, w.t, r.t AS rt, r.trans_id FROM w ASOF JOIN r ON w.activity_id = r.activity_id AND w.t >= r.t),
b AS (SELECT w.word_id, w.t, r.t AS rt, r.trans_id FROM w ASOF JOIN r ON w.activity_id = r.activity_id AND w.t <= r.t),
c AS (SELECT * FROM a UNION ALL SELECT * FROM b)
SELECT word_id, arg_min(trans_id, abs(rt - t) * 2 + CASE WHEN rt > t THEN 1 ELSE 0 END) AS trans_id
FROM c WHERE abs(rt - t) <= 250 GROUP BY word_id
"""
