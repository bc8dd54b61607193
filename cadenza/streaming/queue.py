"""Structured Streaming over a message queue: at-least-once input, bad rows to a reject table, windowed metrics."""

from __future__ import annotations

from collections.abc import Callable

import pyspark.sql.types as T
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cadenza.operators.metrics import tumbling
from cadenza.plans.scan import batched, before
from cadenza.session import discard, shared_dir
from cadenza.sources.readers import JOB

#: Deliveries of a message before it is rejected.
ATTEMPTS = 3


def split_messages(raw: DataFrame, body: str = "value") -> DataFrame:
    """raw with the parsed message and reason: null for a good one, else why it is rejected. Works on batches and streams alike."""
    m = F.from_json(body, JOB)
    df = raw.withColumn("message", m)
    bad = F.when(F.try_parse_json(body).isNull(), "not json").when(~F.coalesce(F.col("message.activity_id").rlike(r"(?U)\S"), F.lit(False)), "no activity")
    return df.withColumn("reason", bad)


def delivered(rows: DataFrame, fails: Callable[[int], Column], most: int = ATTEMPTS) -> DataFrame:
    """rows with attempt: the first delivery from 1 to most at which fails(k) is not true, or null if all fail; and failures, how many did."""
    ok = [~F.coalesce(fails(k), F.lit(False)) for k in range(1, most + 1)]
    attempt = F.coalesce(*[F.when(c, k) for k, c in enumerate(ok, 1)])
    return rows.withColumn("attempt", attempt.cast("int")).withColumn("failures", F.coalesce(F.col("attempt") - 1, F.lit(most)))


def consume(messages: DataFrame, good: str, rejected: str, checkpoint: str, handle: Callable[[DataFrame], DataFrame] = lambda df: df, fails: Callable[[int], Column] | None = None, failures: str | None = None) -> StreamingQuery:
    """Runs what is there: each micro-batch goes to good or rejected, under its batch number.

    A batch that is delivered again overwrites its own folder, so a restart adds
    nothing twice. fails(k), over the columns of ``message``: does the k-th
    delivery of a message fail? One that fails ATTEMPTS times is rejected; the
    others of its batch go on. With failures, the messages of a batch that had
    to be delivered again are listed there.
    """

    def each(batch: DataFrame, n: int) -> None:
        rows = split_messages(batch)
        if fails is not None:
            rows = delivered(rows, lambda k: F.col("reason").isNull() & fails(k))
            rows = rows.withColumn("reason", F.when(F.col("attempt").isNull(), F.lit(f"failed {ATTEMPTS} times")).otherwise(F.col("reason")))
            if failures is not None:
                rows.where("failures > 0").select("message.activity_id", "failures", F.col("attempt").isNotNull().alias("done")).write.mode("overwrite").parquet(f"{failures}/batch={n}")
        handle(rows.where("reason IS NULL").select("message.*")).write.mode("overwrite").parquet(f"{good}/batch={n}")
        rows.where("reason IS NOT NULL").drop("message", "attempt", "failures").write.mode("overwrite").parquet(f"{rejected}/batch={n}")

    return messages.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def enqueue(jobs: DataFrame, path: str, size: int = 10) -> DataFrame:
    """Messages as JSON with the send batch of at most size messages they belong to, appended to the folder; blank ids are left out.

    No messages at all are a ValueError.
    """
    out = send_batches(jobs, size)
    if out.isEmpty():
        raise ValueError("no messages to send")
    out.write.mode("append").parquet(path)
    return out


def send_batches(jobs: DataFrame, size: int = 10) -> DataFrame:
    """batch, value: the messages as JSON, in batches of size."""
    ok = jobs.where(F.col("activity_id").rlike(r"(?U)\S"))
    return batched(ok.select(F.to_json(F.struct(*[c for c in JOB.names if c in jobs.columns])).alias("value")), ["value"], size)


def acknowledged(chunks: DataFrame, acks: DataFrame, key: str) -> DataFrame:
    """key, seq, size, sent, acked, pending: of a stream sent in chunks (key, seq, size) the bytes sent with each chunk, the
    latest offset acknowledged by then and what is still under way.

    acks: key, seq (the chunk after which the ack came), acked (an offset). Acks
    may come out of order or repeat; the largest offset so far counts, and none
    is beyond what was sent. Works for any number of chunks: slices of seq.
    """
    a = acks.groupBy(key, "seq").agg(F.max("acked").alias("_ack"))
    rows = chunks.join(a, [key, "seq"], "left")
    part = F.floor(F.col("seq") / 10_000)
    rows = before(rows, [key], ["seq"], {"_sent": ("sum", F.col("size")), "_told": ("max", F.col("_ack"))}, part)
    sent = (F.col("_sent") + F.col("size")).cast("bigint")
    acked = F.least(F.coalesce(F.greatest("_told", "_ack"), F.lit(0)).cast("bigint"), sent)
    return rows.select(key, "seq", "size", sent.alias("sent"), acked.alias("acked"), (sent - acked).alias("pending"))


def file_stream(spark: SparkSession, path: str) -> DataFrame:
    """A stored table as a stream; a pattern also takes a single file."""
    schema = spark.read.parquet(path).schema
    return spark.readStream.schema(schema).parquet(path[:-1] + f"[{path[-1]}]")


def stream_tumbling(spark: SparkSession, path: str, time: str, width: str, keys: list[str], value: str, delay: str) -> DataFrame:
    """The windows of a stored table replayed as a stream; the same rows as tumbling over the batch.

    delay: how late a row may come; the replay is one batch, so none is dropped.
    Update mode: each micro-batch writes the windows it changed under its own
    number (written again if it is repeated), the watermark drops finished
    windows from the state, and the last version of a window counts.
    """
    rows = file_stream(spark, path).withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, delay)
    out = shared_dir(spark, "windows")
    changed = tumbling(rows, time, width, keys, value)

    def keep(batch: DataFrame, n: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/rows/batch={n}")

    changed.writeStream.outputMode("update").foreachBatch(keep).option("checkpointLocation", f"{out}/state").trigger(availableNow=True).start().awaitTermination()
    discard(spark, f"{out}/state")
    versions = spark.read.schema(T.StructType([*changed.schema.fields, T.StructField("batch", T.IntegerType())])).parquet(f"{out}/rows")
    at = ["window_start", *keys]
    last = F.max_by(F.struct(*[c for c in changed.columns if c not in at]), "batch").alias("last")
    return versions.groupBy(*at).agg(last).select(*at, "last.*")
