"""Sinks, caches and the plans of clean-up and export."""

from __future__ import annotations

import hashlib
import json
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadenza.plans.scan import batched
from cadenza.session import shared_dir, written


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def write_results(df: DataFrame, path: str, day: str = "dt", per_activity: bool = False) -> None:
    """JSON under <day>=…/, or with per_activity under <day>=…/activity_id=…/, with a _SUCCESS mark.

    Rows are gathered by folder in partitions of even size, so files stay few and
    a day with most of the rows is several tasks' work. A folder for each
    activity suits a few results; a day's file holds them as well.
    """
    folders = [day, "activity_id"] if per_activity else [day]
    df.hint("rebalance", *folders).write.mode("overwrite").partitionBy(*folders).json(path)


def upserted(table: DataFrame, changes: DataFrame, key: str) -> DataFrame:
    """table with the columns of changes set where the key is equal; new keys are added. The last change of a key must be chosen before."""
    both = table.alias("t").join(changes.alias("c"), key, "full_outer")
    cols = [F.coalesce(F.col(f"c.{n}"), F.col(f"t.{n}")).alias(n) if n in changes.columns else F.col(f"t.{n}") for n in table.columns if n != key]
    return both.select(key, *cols)


def write_manifest(df: DataFrame, path: str) -> None:
    """Segment rows as JSON lines, read back by read_manifest."""
    df.select("activityId", "phraseIndex", "start_ms", "end_ms", "s3_uri").write.mode("overwrite").json(path)


def write_ids(df: DataFrame, column: str, path: str) -> None:
    """Distinct ids in order, as CSV files with a header whose names are in that order; as many files as the ids need."""
    df.select(column).where(F.col(column).isNotNull()).distinct().orderBy(column).write.mode("overwrite").option("header", True).option("quoteAll", True).option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)


def timing_json(timings: DataFrame) -> DataFrame:
    """(activity_id, timing): a JSON document of the pages and phrases of each activity, in order.

    timings: activity_id, page_index, phrase, start_ms, end_ms, parsed. Pages
    are put together first, so one document gathers pages and not phrases.
    """
    phrase = F.struct("phrase", "start_ms", "end_ms", "parsed")
    pages = timings.groupBy("activity_id", "page_index").agg(F.array_sort(F.collect_list(phrase)).alias("phrases"), F.min("start_ms").alias("page_start"), F.max("end_ms").alias("page_end"))
    page = F.struct("page_index", "page_start", "page_end", "phrases")
    return pages.groupBy("activity_id").agg(F.to_json(F.struct(F.array_sort(F.collect_list(page)).alias("pages"))).alias("timing"))


def timing_documents(pages: DataFrame, timings: DataFrame) -> DataFrame:
    """(activity_id, timing): a JSON document of all pages of each activity, in order, with absolute phrase indices.

    pages: activity_id, page_index, phrase_indices, phrases (texts), page_start,
    page_end; one row a page. timings: those of phrase_timings, for all phrases
    of a page or none. A page without timings has default rows: an empty
    interval at its start (0 if unknown) with parsed ''. Unknown times of pages
    are written as null.
    """
    phrase = F.struct("phrase", "start_ms", "end_ms", "parsed")
    t = timings.groupBy("activity_id", "page_index").agg(F.array_sort(F.collect_list(phrase)).alias("_timed"))
    start = F.coalesce("page_start", F.lit(0))
    row = lambda i, a, b, parsed: F.struct(F.get("phrase_indices", i).alias("phrase_idx"), a.alias("start"), b.alias("end"), parsed.alias("parsed"), F.coalesce(F.get("phrases", i), F.lit("")).alias("phrase_text"))
    timed = F.transform("_timed", lambda x: row(x["phrase"], x["start_ms"], x["end_ms"], x["parsed"]))
    default = F.transform("phrases", lambda _, i: row(i, start, start, F.lit("")))
    page = F.struct("page_index", "page_start", "page_end", F.coalesce(timed, default, F.array().cast("array<struct<phrase_idx:int,start:int,end:int,parsed:string,phrase_text:string>>")).alias("phrases"))
    rows = pages.join(t, ["activity_id", "page_index"], "left").select("activity_id", page.alias("page"))
    doc = F.struct(F.array_sort(F.collect_list("page")).alias("pages"))
    return rows.groupBy("activity_id").agg(F.to_json(doc, {"ignoreNullFields": "false"}).alias("timing"))


def activity_report(summary: DataFrame, words: DataFrame) -> DataFrame:
    """activity_id, line_no, line: of each activity a header with its accuracies, then one line a word.

    summary: activity_id, n_words, accuracy_before, accuracy_after, improvement
    (as two_level_accuracy gives them). words: activity_id, place (order within
    the activity), word, a, b, confidence. Improvements carry their sign.
    """
    head = F.format_string("Activity %s: %d words, before %.3f, after %.3f, improvement %+.3f", "activity_id", "n_words", "accuracy_before", "accuracy_after", "improvement")
    heads = summary.select("activity_id", F.lit(-1).cast("bigint").alias("line_no"), head.alias("line"))
    lines = report_lines(words.select("activity_id", F.col("place").cast("bigint").alias("line_no"), "word", "a", "b", "confidence"))
    return heads.unionByName(lines)


def report_lines(words: DataFrame) -> DataFrame:
    """line: one padded line a word (word, a, b, confidence), beside the columns it does not hold."""
    rest = [c for c in words.columns if c not in ("word", "a", "b", "confidence")]
    return words.select(*rest, F.format_string("%s %s %s %.3f", F.rpad("word", 16, " "), F.rpad(F.col("a").cast("string"), 4, " "), F.rpad(F.col("b").cast("string"), 4, " "), F.col("confidence").cast("double")).alias("line"))


def summary_text(summary: DataFrame, name: str) -> DataFrame:
    """name, text: one message a summary row (n, n_ok, success_rate, grade), ready for a notifier."""
    rate = F.format_number(F.col("success_rate") * 100, 1)
    return summary.select(name, F.concat_ws(" ", F.col(name), F.concat(F.col("n_ok").cast("string"), F.lit("/"), F.col("n").cast("string")), F.concat(rate, F.lit("%")), F.col("grade")).alias("text"))


def append_metrics(df: DataFrame, path: str) -> None:
    """Metric samples (ts, namespace, metric, value, dims) to a table by day."""
    df.withColumn("dt", F.date_format("ts", "yyyy-MM-dd")).write.mode("append").partitionBy("dt").parquet(path)


class ResultCache:
    """Results of SQL texts, kept as Parquet by a hash of text and options, for a time to live.

    A result's age is that of the mark its write left, so a folder that is given
    again serves another session, or one after a restart. max_age_s: accept a
    result of this age at most, whatever the time to live.
    """

    def __init__(self, spark: SparkSession, ttl_s: float, folder: str | None = None):
        self.spark, self.ttl_s, self.folder = spark, ttl_s, folder or shared_dir(spark, "cache")

    def _age(self, path: str) -> float:
        mark = self.spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
        fs = mark.getFileSystem(self.spark._jsc.hadoopConfiguration())
        return time.time() - fs.getFileStatus(mark).getModificationTime() / 1000 if fs.exists(mark) else float("inf")

    def query(self, sql: str, max_age_s: float | None = None, **options: str) -> DataFrame:
        key = hashlib.sha256(json.dumps([sql, options], sort_keys=True).encode()).hexdigest()
        path = f"{self.folder}/{key}"
        if self._age(path) > (self.ttl_s if max_age_s is None else max_age_s):
            self.spark.sql(sql).write.mode("overwrite").parquet(path)
        return self.spark.read.parquet(path)


def stale(objects: DataFrame, now, days: int, batch: int = 1000) -> DataFrame:
    """Objects (key, modified) older than days, numbered in batches of at most `batch` deletions; nothing is deleted."""
    old = objects.where(F.col("modified") < F.lit(now).cast("timestamp") - F.expr(f"INTERVAL {days} DAY"))
    return batched(old, ["key"], batch)


def export_plan(slices: DataFrame) -> DataFrame:
    """Slices worth exporting: end after start."""
    return slices.where(F.col("end_ms") > F.col("start_ms"))


def redrive(rejected: DataFrame, most: int) -> DataFrame:
    """The oldest rejected messages, at most `most`, to be sent again. The number is the operator's own: a run is asked for that many."""
    return rejected.orderBy("timestamp", "delivery_id").limit(most)


def redriven(rejected: DataFrame, queue: str, most: int, batch: int = 10) -> tuple[DataFrame, DataFrame]:
    """Send the oldest rejected messages again and give (sent, left): the messages of the run and those still rejected.

    Sent messages are appended to the queue's folder with their send batch;
    only then does left, without them, take the place of rejected.
    """
    sent = written(batched(redrive(rejected, most), ["delivery_id"], batch), "redrive")
    sent.write.mode("append").parquet(queue)
    return sent, rejected.join(sent.select("delivery_id"), "delivery_id", "left_anti")
