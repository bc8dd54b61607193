"""Further queries of the core operators: queues, deliveries, reports, formats; each calls the operator itself."""

from __future__ import annotations

from pyspark.sql import functions as F

from cadenza.functions import sequences as S
from cadenza.functions.text import canonical_hash, endpoint, int_or_zero
from cadenza.operators import dedupe, joins, metrics, rules, select
from cadenza.operators import sequence as Q
from cadenza.plans.queries import _NAMED, _VOTES, _models, _sources, query
from cadenza.plans.scan import batched
from cadenza.session import shared_dir
from cadenza.sources import readers, sinks
from cadenza.sources.tables import table
from cadenza.streaming import queue

# ---- duplicates over stored and new messages


@query(dedupe.KEPT_SQL)
def p2_kept(spark, d):
    """The messages that stay, over stored ones (of even batches) and new ones; those without an activity all stay."""
    t = table(spark, d, "job_messages")
    even = F.coalesce(F.col("batch_id") % 2 == 0, F.lit(False))
    return dedupe.kept(t.where(even), t.where(~even))


# ---- sources


@query("SELECT activityid, storyid, studentid, districtid, type, createdat, 'completed' AS status, displaystatus FROM activity_v WHERE activityid = (SELECT min(activityid) FROM activity_v)")
def one_activity(spark, d):
    """The rows of one id, with a constant status."""
    t = table(spark, d, "activity_v").select(*select.ACTIVITY_COLUMNS)
    return select.one_activity(spark, t, t.agg(F.min("activityid")).first()[0]).select(*select.ACTIVITY_COLUMNS)


@query("SELECT count(*) AS n, bool_and(status = 'failed') AS fits FROM (SELECT status FROM activity_v WHERE status = 'failed' LIMIT 10)")
def filtered_source(spark, d):
    """At most ten rows that meet a condition: the limit is the source's own."""
    return readers.filtered(table(spark, d, "activity_v"), F.col("status") == "failed").agg(F.count(F.lit(1)).alias("n"), F.bool_and(F.col("status") == "failed").alias("fits"))


@query("SELECT 'region' AS \"table\", column_name AS name, CAST(row_number() OVER () - 1 AS INT) AS place FROM (DESCRIBE region) UNION ALL SELECT 'nation', column_name, CAST(row_number() OVER () - 1 AS INT) FROM (DESCRIBE nation)")
def schema_introspection(spark, d):
    """The columns of tables, from their schemas."""
    return readers.describe_catalog(spark, {n: table(spark, d, n) for n in ("region", "nation")}).select("table", "name", "place")


@query("SELECT word_id, word AS transcript, confidence FROM word_items")
def transcript_alternatives(spark, d):
    """The first alternative of a recogniser's JSON."""
    t = table(spark, d, "word_items")
    other = F.struct(F.lit("other").alias("transcript"), F.lit(0.0).alias("confidence"))
    first = F.struct(F.col("word").alias("transcript"), "confidence")
    body = F.to_json(F.struct(F.struct(F.array(F.struct(F.array(first, other).alias("alternatives"))).alias("channels")).alias("results")))
    return t.select("word_id", readers.best_alternative(body).alias("b")).select("word_id", "b.transcript", "b.confidence")


@query("SELECT activity_id, page_index, CAST(i - 1 AS INT) AS place, phrase_indices[i] AS phrase, phrases[i] AS text FROM (SELECT activity_id, page_index, phrase_indices, phrases, unnest(generate_series(1, least(len(phrase_indices), len(phrases)))) AS i FROM page_data)")
def zipped_lists(spark, d):
    """Parallel lists of a response as rows."""
    t = table(spark, d, "page_data").select("activity_id", "page_index", "phrase_indices", "phrases")
    return joins.phrases_of(t, {"phrase": F.col("phrase_indices"), "text": F.col("phrases")}).select("activity_id", "page_index", "place", "phrase", "text")


# ---- queues


@query("SELECT size, count(*) AS n_batches FROM (SELECT batch, count(*) AS size FROM (SELECT (row_number() OVER () - 1) // 10 AS batch FROM job_messages WHERE regexp_matches(activity_id, '[^\\s\\p{Z}]')) GROUP BY batch) GROUP BY size")
def queue_batches(spark, d):
    """Messages in send batches of ten: how many batches of each size there are."""
    b = queue.send_batches(table(spark, d, "job_messages").withColumn("created_at", F.col("created_at").cast("string")))
    return b.groupBy("batch").agg(F.count(F.lit(1)).alias("size")).groupBy("size").agg(F.count(F.lit(1)).alias("n_batches"))


@query("SELECT size, count(*) AS n_batches FROM (SELECT batch, count(*) AS size FROM (SELECT (row_number() OVER () - 1) // 1000 AS batch FROM segment_manifest WHERE created_at < TIMESTAMP '2025-03-01' - INTERVAL 7 DAY) GROUP BY batch) GROUP BY size")
def stale_batches(spark, d):
    """Old objects in deletions of a thousand: how many batches of each size there are."""
    t = table(spark, d, "segment_manifest").select(F.col("segment_id").cast("string").alias("key"), F.col("created_at").cast("timestamp_ntz").alias("modified"))
    now = F.lit("2025-03-01").cast("timestamp_ntz")
    old = batched(t.where(select.older_than("modified", now, 7)), ["key"], 1000)
    return old.groupBy("batch").agg(F.count(F.lit(1)).alias("size")).groupBy("size").agg(F.count(F.lit(1)).alias("n_batches"))


@query("""WITH m AS (SELECT CASE WHEN student_id IS NULL THEN 3 WHEN "timestamp" IS NULL THEN 2 WHEN story_id IS NULL THEN 1 ELSE 0 END AS f FROM job_messages)
SELECT CAST(f AS INT) AS failures, CAST(CASE WHEN f < 3 THEN f + 1 END AS INT) AS attempt, count(*) AS n FROM m GROUP BY 1, 2""")
def redelivery(spark, d):
    """Messages delivered again until they are handled, three times at most: those without a student never are."""
    fails = lambda k: F.col("student_id").isNull() | (F.col("timestamp").isNull() & F.lit(k <= 2)) | (F.col("story_id").isNull() & F.lit(k <= 1))
    return queue.delivered(table(spark, d, "job_messages"), fails).groupBy("failures", "attempt").agg(F.count(F.lit(1)).alias("n"))


@query("""WITH m AS (SELECT activity_id, CASE WHEN activity_id IS NULL OR trim(regexp_replace(activity_id, '\\s', '', 'g')) = '' THEN 'no activity' WHEN student_id IS NULL THEN 'failed 3 times' ELSE 'good' END AS kind, story_id IS NULL AS once FROM job_messages)
SELECT kind, count(*) AS n FROM m GROUP BY 1 UNION ALL SELECT 'retried', count(*) FILTER (WHERE kind = 'failed 3 times' OR (kind = 'good' AND once)) FROM m""")
def dlq_after_attempts(spark, d):
    """Messages as a stream: those that fail three times go to the reject table, the others of their batch go on."""
    base = shared_dir(spark, "queue")
    body = F.to_json(F.struct("activity_id", "story_id", "student_id", F.col("created_at").cast("string").alias("created_at"), "source", "timestamp"))
    raw = queue.file_stream(spark, f"{d}/job_messages.parquet").select(body.alias("value"))
    fails = lambda k: F.col("message.student_id").isNull() | (F.col("message.story_id").isNull() & F.lit(k <= 1))
    queue.consume(raw, f"{base}/good", f"{base}/bad", f"{base}/state", fails=fails, failures=f"{base}/failures").awaitTermination()
    good = spark.read.schema(readers.JOB).parquet(f"{base}/good").select(F.lit("good").alias("kind"))
    bad = spark.read.schema("value string, reason string").parquet(f"{base}/bad").select(F.col("reason").alias("kind"))
    again = spark.read.schema("activity_id string, failures int, done boolean").parquet(f"{base}/failures").agg(F.count(F.lit(1)).alias("n"))
    return good.unionByName(bad).groupBy("kind").agg(F.count(F.lit(1)).alias("n")).unionByName(again.select(F.lit("retried").alias("kind"), "n"))


@query("""SELECT 'sent' AS part, least(25, n) AS n FROM (SELECT count(*) AS n FROM job_messages WHERE "timestamp" IS NOT NULL) UNION ALL SELECT 'left', count(*) - least(25, count(*) ) FROM job_messages WHERE "timestamp" IS NOT NULL""")
def redrive_run(spark, d):
    """The oldest rejected messages are sent again and are no longer rejected."""
    path = shared_dir(spark, "again")
    t = table(spark, d, "job_messages").where("timestamp IS NOT NULL").select("delivery_id", "activity_id", "timestamp")
    sent, left = sinks.redriven(t, path, 25)
    queued = spark.read.schema(sent.schema).parquet(path)
    count = lambda df, part: df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(part).alias("part"), "n")
    return count(queued, "sent").unionByName(count(left, "left"))


@query("""WITH c AS (SELECT user_id, event_id, ts, event_type, CAST(round(value) AS BIGINT) AS size, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS seq FROM events),
s AS (SELECT user_id, seq, coalesce(size, 0) AS size, CAST(sum(coalesce(size, 0)) OVER (PARTITION BY user_id ORDER BY seq ROWS UNBOUNDED PRECEDING) AS BIGINT) AS sent, CASE WHEN event_type = 'view' THEN seq * 40 END AS ack FROM c)
SELECT user_id, seq, size, sent, CAST(least(coalesce(max(ack) OVER w, 0), sent) AS BIGINT) AS acked, CAST(sent - least(coalesce(max(ack) OVER w, 0), sent) AS BIGINT) AS pending FROM s WINDOW w AS (PARTITION BY user_id ORDER BY seq ROWS UNBOUNDED PRECEDING)""")
def chunk_acks(spark, d):
    """A stream sent in chunks, with the offset acknowledged by each and what is under way (views acknowledge)."""
    e = table(spark, d, "events").select("user_id", "event_id", "ts", "event_type", F.coalesce(F.round("value").cast("bigint"), F.lit(0)).alias("size"))
    c = Q.positions(e, ["user_id"], ["ts", "event_id"], "seq", Q.hour_of("ts"))
    acks = c.where("event_type = 'view'").select("user_id", "seq", (F.col("seq") * 40).alias("acked"))
    return queue.acknowledged(c.select("user_id", "seq", "size"), acks, "user_id")


@query("""WITH r AS (SELECT source, epoch(received_at) AS t, student_id IS NOT NULL AS ok FROM job_messages), s AS (SELECT source, count(*) AS n, count(*) FILTER (WHERE ok) AS n_ok, coalesce(max(t) - min(t), 0) AS dur FROM r GROUP BY 1)
SELECT source, n, n_ok, n - n_ok AS n_failed, round(dur, 3) AS duration_s, round(CASE WHEN dur > 0 THEN n_ok / dur ELSE 0 END, 9) AS actual_rps FROM s""")
def send_rates(spark, d):
    """Messages of a source, how many were sent, and how many a second."""
    at = F.unix_micros(F.convert_timezone(F.lit("UTC"), F.current_timezone(), F.col("received_at").cast("timestamp_ntz")).cast("timestamp")) / 1e6
    out = metrics.send_rates(table(spark, d, "job_messages"), ["source"], at, F.col("student_id").isNotNull())
    return out.withColumn("duration_s", F.round("duration_s", 3))


# ---- segments


@query(f"""WITH r AS (SELECT DISTINCT activityid AS a, phraseindex AS p, CAST(part[3] AS INT) AS s FROM {_NAMED} WHERE phraseindex IS NOT NULL AND part IS NOT NULL),
l AS (SELECT a, p, max(s) AS last FROM r GROUP BY 1, 2), b AS (SELECT l.a, l.p, l.last, CASE WHEN l.p = 0 THEN 0 ELSE k.last + 1 END AS start FROM l LEFT JOIN l k ON k.a IS NOT DISTINCT FROM l.a AND k.p = l.p - 1),
w AS (SELECT a, p, unnest(generate_series(start, last)) AS s FROM b WHERE start <= last), g AS (SELECT w.* FROM w WHERE NOT EXISTS (SELECT 1 FROM r WHERE r.a IS NOT DISTINCT FROM w.a AND r.p = w.p AND r.s = w.s)),
k AS (SELECT *, s - row_number() OVER (PARTITION BY a, p ORDER BY s) AS run FROM g)
SELECT a AS activityid, p AS phraseindex, CAST(min(s) AS INT) AS from_seq, count(*) AS n, count(*) > 5 AS over FROM k WHERE a IS NOT NULL GROUP BY a, p, run""")
def dropped_segments(spark, d):
    """Streaks of segments that a phrase lacks from its start sequence on, and which are longer than five."""
    t = table(spark, d, "segment_manifest").where("activityid IS NOT NULL").select("activityid", "phraseindex", rules.segment_name(F.col("s3_uri"))["seq"].alias("seq"))
    return Q.dropped_segments(t, ["activityid"], "phraseindex", "seq")


@query(f"""WITH r AS (SELECT activityid AS activity_id, phraseindex AS phrase, CAST(part[3] AS INT) AS k, s3_uri AS f, segment_id, end_ms IS NOT NULL AS flag FROM {_NAMED} WHERE phraseindex IS NOT NULL AND part IS NOT NULL)
SELECT activity_id, phrase, count(DISTINCT k) AS n_files, arg_max(f, segment_id) FILTER (WHERE flag) AS last_file FROM r GROUP BY 1, 2""")
def flagged_last_segment(spark, d):
    """The segments of a phrase and the file of the row flagged as its last (here: one with an end)."""
    t = table(spark, d, "segment_manifest").where("phraseindex IS NOT NULL")
    t = t.select(F.col("activityid").alias("activity_id"), F.col("phraseindex").alias("phrase"), rules.segment_name(F.col("s3_uri"))["seq"].alias("seq"), "s3_uri", "segment_id", "end_ms")
    m = Q.segment_map(t, ["activity_id", "phrase"], "seq", "s3_uri", "segment_id", F.col("end_ms").isNotNull())
    return m.select("activity_id", "phrase", F.size("files").cast("bigint").alias("n_files"), "last_file")


# ---- rules


@query(_VOTES + """ SELECT activity_id, page_index, CASE WHEN nm > 0 THEN nm || CASE WHEN n_dis = 0 THEN ' matches agree' ELSE ' matches disagree' END WHEN ne = 0 THEN 'no match, nothing right' WHEN ne > 2 THEN 'no match, ' || ne || ' right'
 WHEN np = 0 THEN 'no match, ' || ne || ' right, no prior match' ELSE 'no match, ' || ne || ' right, ' || np || ' prior matches' END AS reason FROM d""")
def decision_reason(spark, d):
    """Why a page's words are kept, marked or scored again."""
    t = _sources(spark, d)
    return t.select("activity_id", "page_index", rules.reason(F.col("matches"), F.col("errors"), F.col("prior")).alias("reason"))


@query(_VOTES + """ SELECT activity_id, page_index, CASE WHEN strategy = 'keep' THEN list_aggregate(list_transform(e, lambda x: CASE WHEN x THEN '1' ELSE '0' END), 'string_agg', '')
 WHEN strategy = 'mark_all' OR len(m) % 2 = 1 THEN repeat('1', len(m)) ELSE list_aggregate(list_transform(generate_series(1, len(m)), lambda i: CASE WHEN p[i] = 1 OR m[i] + s[i] + p[i] > 1 THEN '0' ELSE '1' END), 'string_agg', '') END AS errors FROM d""")
def decision_without_audio(spark, d):
    """Error flags after the decision; pages with an odd number of words have no audio here: scoring again marks all of theirs."""
    t = rules.scored(_sources(spark, d).withColumn("has_audio", F.col("length") % 2 == 0))
    return t.select("activity_id", "page_index", F.array_join(F.transform("result", lambda x: x.cast("int").cast("string")), "").alias("errors"))


@query(_VOTES + """, x AS (SELECT activity_id, len(m) AS w, list_sum(list_transform(generate_series(1, len(m)), lambda i: (e[i] = (p[i] = 0))::INT)) AS b,
 list_sum(list_transform(generate_series(1, len(m)), lambda i: ((NOT (p[i] = 1 OR m[i] + s[i] + p[i] > 1)) = (p[i] = 0))::INT)) AS a FROM d), g AS (SELECT activity_id, CAST(sum(w) AS BIGINT) AS n_words, CAST(sum(b) AS BIGINT) AS right_before, CAST(sum(a) AS BIGINT) AS right_after FROM x GROUP BY 1)
SELECT activity_id, n_words, right_before, right_after, round(right_before / n_words, 9) AS accuracy_before, round(right_after / n_words, 9) AS accuracy_after, round(right_after / n_words - right_before / n_words, 9) AS improvement FROM g""")
def two_level_accuracy(spark, d):
    """Accuracy of an activity before and after the vote, from sums over its pages, against the prior source."""
    t = _sources(spark, d)
    truth = F.transform("prior", lambda x: x == 0)
    out = rules.two_level_accuracy(t, ["activity_id"], truth, F.col("errors"), S.vote(F.col("matches"), F.col("second"), F.col("prior")))
    return out.select("activity_id", "n_words", "right_before", "right_after", *[F.round(c, 9).alias(c) for c in ("accuracy_before", "accuracy_after", "improvement")])


@query("SELECT activity_id, count(*) AS n_phrases, count(*) FILTER (WHERE NOT coalesce(len(phrases) = len(phrase_indices), false)) AS n_broken, count(*) FILTER (WHERE NOT coalesce(len(phrases) = len(phrase_indices), false)) > 0 AS fails FROM page_data GROUP BY 1")
def length_invariants(spark, d):
    """An activity fails if one of its pages has not as many phrases as indices."""
    return rules.failed_keys(table(spark, d, "page_data"), ["activity_id"], F.size("phrases"), F.size("phrase_indices"))


@query("""WITH w AS (SELECT storyid, phraseindex, unnest(expected_text) AS word FROM story_phrase), a AS (SELECT word, list_distinct(list(phraseindex)) AS x FROM w WHERE phraseindex % 2 = 0 GROUP BY 1), b AS (SELECT word, list_distinct(list(phraseindex)) AS x FROM w WHERE phraseindex % 2 = 1 GROUP BY 1)
SELECT a.word, array_to_string(list_sort(list_distinct(list_concat(a.x, coalesce(b.x, [])))), ',') AS places FROM a LEFT JOIN b USING (word)""")
def united_sets(spark, d):
    """Two maps of sets as one: the keys of the first, with what the second adds to them."""
    w = table(spark, d, "story_phrase").select("phraseindex", F.explode("expected_text").alias("word"))
    half = lambda k: w.where(F.col("phraseindex") % 2 == k).groupBy("word").agg(F.collect_set("phraseindex").alias("places"))
    out = joins.united_sets(half(0), half(1), "word", "places")
    return out.select("word", F.array_join(F.transform("places", lambda x: x.cast("string")), ",").alias("places"))


# ---- formats


@query("""SELECT event_id, sha256('{"event_id":' || event_id || ',"user_id":' || user_id || '}') AS digest FROM events WHERE event_id IS NOT NULL AND user_id IS NOT NULL""")
def canonical_digest(spark, d):
    """A digest of columns as canonical JSON."""
    return table(spark, d, "events").where("event_id IS NOT NULL AND user_id IS NOT NULL").select("event_id", canonical_hash(["user_id", "event_id"]).alias("digest"))


@query("SELECT segment_id, coalesce(TRY_CAST(TRY_CAST(string_split(string_split(s3_uri, '/')[-1], '-')[2] AS DOUBLE) AS INT), 0) AS number, coalesce(TRY_CAST(TRY_CAST(activityid AS DOUBLE) AS INT), 0) AS id FROM segment_manifest")
def whole_numbers(spark, d):
    """Numbers in strings as integers, 0 for what is none."""
    part = F.get(F.split(F.element_at(F.split("s3_uri", "/"), -1), "-"), F.lit(1))
    return table(spark, d, "segment_manifest").select("segment_id", int_or_zero(part).alias("number"), int_or_zero(F.col("activityid")).alias("id"))


@query("SELECT segment_id, '/' || regexp_extract(s3_uri, '^s3://[^/]+/(.*)$', 1) AS path, '/score' || coalesce('/' || activityid, '') || coalesce('?phrase=' || phraseindex, '') AS endpoint FROM segment_manifest WHERE activityid IS NULL OR regexp_full_match(activityid, '[0-9a-f-]*')")
def url_parts(spark, d):
    """The path of an address, and an address built from a mode, a model and parameters."""
    t = table(spark, d, "segment_manifest").where(F.col("activityid").isNull() | F.col("activityid").rlike("^[0-9a-f-]*$"))
    return t.select("segment_id", F.parse_url("s3_uri", F.lit("PATH")).alias("path"), endpoint(F.lit("score"), F.col("activityid"), {"phrase": F.col("phraseindex").cast("string")}).alias("endpoint"))


@query("SELECT word_id, printf('%-16s%-5s %.3f %+d', word, CAST(page_index AS VARCHAR), round(confidence * 8) / 8, page_index) AS line FROM word_items WHERE len(word) < 16 AND confidence IS NOT NULL AND page_index IS NOT NULL AND page_index < 10000")
def signed_lines(spark, d):
    """Padded fields, fixed decimals and signed numbers in a line."""
    t = table(spark, d, "word_items").where("length(word) < 16 AND confidence IS NOT NULL AND page_index IS NOT NULL AND page_index < 10000")
    return t.select("word_id", F.format_string("%-16s%-5s %.3f %+d", "word", F.col("page_index").cast("string"), (F.round(F.col("confidence") * 8) / 8).cast("double"), "page_index").alias("line"))


# ---- files written and read again


@query("SELECT storyid AS \"storyId\", phraseindex AS \"phraseIndex\", array_to_string(expected_text, '|') AS words FROM story_phrase WHERE storyid IS NOT NULL AND NOT regexp_matches(storyid, '^\\s|\\s$|^$')")
def csv_phrases(spark, d):
    """Phrases as a CSV file whose lists are literals, read back."""
    path = shared_dir(spark, "phrases") + ".csv"
    quoted = F.transform("expected_text", lambda w: F.concat(F.lit('"'), w, F.lit('"')))
    t = table(spark, d, "story_phrase").where("storyid IS NOT NULL AND NOT storyid RLIKE '^\\\\s|\\\\s$|^$'")
    t = t.select(F.col("storyid").alias("storyId"), F.col("phraseindex").alias("phraseIndex"), F.concat(F.lit("["), F.array_join(quoted, ", "), F.lit("]")).alias("expected_text"), F.lit("[]").alias("reference_phonemes"))
    t.write.option("header", True).option("quote", '"').option("escape", '"').csv(path)
    return readers.read_story_phrases(spark, path).select("storyId", "phraseIndex", F.array_join("expected_text", "|").alias("words"))


@query("SELECT activityid, status, createdat FROM activity_v")
def parquet_roundtrip(spark, d):
    path = shared_dir(spark, "activities") + ".parquet"
    sinks.write_parquet(table(spark, d, "activity_v").select("activityid", "status", "createdat"), path)
    return readers.read_file(spark, path)


@query("""SELECT DISTINCT strftime(make_timestamp("timestamp" * 1000000), '%Y-%m-%d') AS dt FROM activity_results""")
def object_listing(spark, d):
    """The days of a result folder, from the names of its files alone."""
    path = shared_dir(spark, "listed")
    day = F.date_add(F.lit("1970-01-01").cast("date"), F.floor(F.col("timestamp") / 86400).cast("int")).cast("string")
    sinks.write_results(table(spark, d, "activity_results").select(day.alias("dt"), "status"), path)
    return readers.list_objects(spark, path, "*.json").where("size > 0").select(F.regexp_extract("key", r"/dt=([^/]+)/", 1).alias("dt")).distinct()


@query("SELECT s3_uri AS key FROM segment_manifest WHERE s3_uri IS NOT NULL")
def valid_keys(spark, d):
    return readers.valid_keys(table(spark, d, "segment_manifest").select(F.col("s3_uri").alias("Key")))


@query("""WITH z AS (SELECT expected_text, reference_phonemes, unnest(generate_series(1, least(len(expected_text), len(reference_phonemes)))) AS i FROM story_phrase WHERE expected_text IS NOT NULL AND reference_phonemes IS NOT NULL)
SELECT expected_text[i] AS word, min(reference_phonemes[i]) AS phonemes FROM z WHERE reference_phonemes[i] IS NOT NULL AND regexp_full_match(expected_text[i], '\\S+') AND regexp_full_match(reference_phonemes[i], '\\S+') GROUP BY 1""")
def dictionary_file(spark, d):
    """A dictionary written as lines and read again."""
    from cadenza.plans.queries import _dictionary

    path = shared_dir(spark, "dictionary")
    t = _dictionary(spark, d).where("word RLIKE '^\\\\S+$' AND phonemes RLIKE '^\\\\S+$'")
    t.select(F.concat_ws(" ", "word", "phonemes").alias("value")).write.text(path)
    return readers.read_dictionary(spark, path)


@query("""SELECT word_id, word, start, "end", confidence FROM word_items WHERE start IS NOT NULL AND "end" IS NOT NULL AND confidence IS NOT NULL AND NOT isnan(start) AND NOT isnan("end") AND NOT isnan(confidence)""")
def transcript_words(spark, d):
    """Words out of a recogniser's response of several lines."""
    t = table(spark, d, "word_items").where("start IS NOT NULL AND end IS NOT NULL AND confidence IS NOT NULL AND NOT isnan(start) AND NOT isnan(end) AND NOT isnan(confidence)")
    body = F.to_json(F.struct(F.array(F.struct(F.array(F.struct("word", "start", "end", "confidence")).alias("text"))).alias("data")))
    return t.select("word_id", F.explode(readers.transcript_words(F.concat_ws("\n", F.lit("begin"), body, F.lit("end")))).alias("w")).select("word_id", "w.word", "w.start", "w.end", "w.confidence")


@query("""WITH h AS (SELECT segment_id, sha256(s3_uri) AS h FROM segment_manifest WHERE s3_uri IS NOT NULL), v AS (SELECT segment_id, CAST('0x' || h[3:4] || h[1:2] AS INT) AS a, CAST('0x' || h[63:64] || h[61:62] AS INT) AS z FROM h)
SELECT segment_id, 1 AS channels, 16000 AS rate, 32 AS data_bytes, 16 AS n_samples, round((CASE WHEN a > 32767 THEN a - 65536 ELSE a END) / 32768, 6) + 0 AS first, round((CASE WHEN z > 32767 THEN z - 65536 ELSE z END) / 32768, 6) + 0 AS last FROM v""")
def wav_chunks(spark, d):
    """The samples of sound files, by a walk over their chunks; each file holds the digest of a segment's address."""
    head = "524946460000000057415645" + "4C495354" + "03000000" + "61626300" + "666D7420" + "10000000" + "0100" + "0100" + "803E0000" + "007D0000" + "0200" + "1000" + "64617461" + "20000000"
    t = table(spark, d, "segment_manifest").where("s3_uri IS NOT NULL").select("segment_id", F.unhex(F.concat(F.lit(head), F.sha2("s3_uri", 256))).alias("content"))
    t = t.select("segment_id", readers.wav_samples(F.col("content")).alias("w"))
    x = lambda c: (F.round(c.cast("double"), 6) + 0)
    return t.select("segment_id", "w.channels", "w.rate", F.col("w.data_bytes").cast("int").alias("data_bytes"), F.size("w.samples").alias("n_samples"), x(F.get("w.samples", F.lit(0))).alias("first"), x(F.get("w.samples", F.lit(15))).alias("last"))


@query("SELECT event_type AS metric, strftime(ts, '%Y-%m-%d') AS dt, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2")
def metric_sink(spark, d):
    """Metric samples appended to a table by day, in two goes, and read back."""
    path = shared_dir(spark, "metrics")
    t = table(spark, d, "events").select("ts", F.lit("app").alias("namespace"), F.col("event_type").alias("metric"), "value", F.create_map(F.lit("user"), F.col("user_id").cast("string")).alias("dims"), "event_id")
    for odd in (0, 1):
        sinks.append_metrics(t.where(F.col("event_id") % 2 == odd).drop("event_id"), path)
    back = spark.read.schema("ts timestamp_ntz, metric string, value double, dt string").parquet(path)
    return back.groupBy("metric", "dt").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 4).alias("total"))


@query("SELECT segment_id, start_ms, end_ms FROM segment_manifest WHERE end_ms > start_ms")
def slice_export(spark, d):
    """Slices worth exporting, written and read back."""
    path = shared_dir(spark, "slices")
    sinks.write_parquet(sinks.export_plan(table(spark, d, "segment_manifest")).select("segment_id", "start_ms", "end_ms"), path)
    return spark.read.schema("segment_id bigint, start_ms double, end_ms double").parquet(path)


@query(_VOTES + """, x AS (SELECT activity_id, page_index, len(m) AS w, list_sum(list_transform(generate_series(1, len(m)), lambda i: (e[i] = (p[i] = 0))::INT)) AS b,
 list_sum(list_transform(generate_series(1, len(m)), lambda i: ((NOT (p[i] = 1 OR m[i] + s[i] + p[i] > 1)) = (p[i] = 0))::INT)) AS a FROM d), g AS (SELECT activity_id, CAST(sum(w) AS BIGINT) AS n, sum(b) AS b, sum(a) AS a FROM x GROUP BY 1)
SELECT activity_id, 'Activity ' || activity_id || ': ' || n || ' words' AS line FROM g""")
def activity_report(spark, d):
    """The header lines of a readable report, up to the number of words."""
    t = _sources(spark, d)
    truth = F.transform("prior", lambda x: x == 0)
    s = rules.two_level_accuracy(t, ["activity_id"], truth, F.col("errors"), S.vote(F.col("matches"), F.col("second"), F.col("prior")))
    words = table(spark, d, "word_items").select("activity_id", F.col("word_id").alias("place"), "word", F.col("page_index").alias("a"), F.lit(0).alias("b"), "confidence")
    r = sinks.activity_report(s, words).where("line_no = -1")
    return r.select("activity_id", F.regexp_extract("line", r"^(.*? words),", 1).alias("line"))


@query("SELECT activityid, createdat FROM activity_v WHERE createdat >= TIMESTAMP '2025-02-10' AND createdat < TIMESTAMP '2025-02-20'")
def time_range(spark, d):
    """Required columns and a half-open range of time."""
    t = select.require_columns(table(spark, d, "activity_v"), ["activityid", "createdat"])
    for condition in select.time_range("createdat", "2025-02-10", "2025-02-20"):
        t = t.where(condition)
    return t.select("activityid", "createdat")


@query("SELECT status, count(*) AS n, CAST(2 AS INT) AS asked FROM activity_v GROUP BY status")
def cached_query(spark, d):
    """The result of a SQL text, asked for twice and made once."""
    table(spark, d, "activity_v").createOrReplaceTempView("cadenza_cached_query")
    folder = shared_dir(spark, "cache")
    text = "SELECT status, count(*) AS n FROM cadenza_cached_query GROUP BY status"
    first = sinks.ResultCache(spark, 3600, folder).query(text)
    table(spark, d, "activity_v").limit(0).createOrReplaceTempView("cadenza_cached_query")
    again = sinks.ResultCache(spark, 3600, folder).query(text)
    spark.catalog.dropTempView("cadenza_cached_query")
    both = first.unionByName(again).groupBy("status").agg(F.max("n").alias("n"), F.count(F.lit(1)).cast("int").alias("asked"))
    return both.select("status", "n", "asked")


@query("""SELECT DISTINCT strftime(make_timestamp("timestamp" * 1000000), '%Y-%m-%d') AS key, CASE WHEN ("timestamp" // 86400) % 2 = 0 THEN true END AS has_bytes FROM activity_results""")
def object_metadata(spark, d):
    """The days of the results with the metadata of their stored objects; those of odd days were never stored."""
    path = shared_dir(spark, "heads")
    number = F.floor(F.col("timestamp") / 86400).cast("int")
    t = table(spark, d, "activity_results").select(number.alias("number"), F.date_add(F.lit("1970-01-01").cast("date"), number).cast("string").alias("dt"), "status")
    sinks.write_results(t.where("number % 2 = 0").drop("number"), path)
    found = readers.list_objects(spark, path, "*.json").select(F.regexp_extract("key", r"/dt=([^/]+)/", 1).alias("key"), "size")
    heads = found.groupBy("key").agg((F.sum("size") > 0).alias("has_bytes"))
    return joins.with_heads(t.select(F.col("dt").alias("key")).distinct(), heads)
