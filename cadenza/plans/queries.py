"""Queries of the core operators over whole tables, each with the same query in SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadenza.functions import sequences as S
from cadenza.functions.lookups import ACCEPTED, ELEMENTS, SUBSTITUTES
from cadenza.functions.text import folded
from cadenza.operators import align, joins, metrics, rules, select
from cadenza.operators import sequence as Q
from cadenza.plans import align_sql
from cadenza.plans.skew import skew_join
from cadenza.session import shared_dir
from cadenza.sources import readers, sinks
from cadenza.sources.tables import table
from cadenza.streaming import queue

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql:
            SQL[fn.__name__] = sql
        return fn

    return add


FOLD = r"lower(regexp_replace({c}, '^[\s\p{{Z}}]+|[\s\p{{Z}}]+$', '', 'g'))"
STORY = FOLD.format(c="storyid")


# ---- projections and filters


@query("""SELECT activityid, storyid, studentid, districtid, type, createdat, status, displaystatus FROM activity_v
WHERE type = 'letterNamingAndSounds' AND status = 'completed' AND createdat >= TIMESTAMP '2025-02-01' AND createdat < TIMESTAMP '2025-04-01' AND districtid LIKE '700%'
AND districtid IN (SELECT DISTINCT districtid FROM activity_v WHERE districtid LIKE '700%')""")
def activity_select(spark, d):
    """Typed conditions and a half-open time range."""
    acts = select.select_activities(table(spark, d, "activity_v"), type_="letterNamingAndSounds", status="completed", start="2025-02-01", end="2025-04-01")
    return acts.where(F.col("districtid").startswith("700"))


@query("SELECT activityid, districtid FROM activity_v WHERE type = 'oralReading' AND districtid IN ('700211', '700359', '700877', '701580')")
def activity_select_districts(spark, d):
    """A list of districts as a condition."""
    return select.select_activities(table(spark, d, "activity_v"), type_="oralReading", districts=["700211", "700359", "700877", "701580"]).select("activityid", "districtid")


@query("SELECT activityid, storyid, studentid, districtid, type, createdat, status, displaystatus FROM activity_v WHERE status = 'completed'")
def select_without_in_list(spark, d):
    """An empty list is no condition."""
    return select.select_activities(table(spark, d, "activity_v"), status="completed", districts=[])


@query("SELECT count(*) AS n, min(createdat) AS first FROM activity_v WHERE status = 'failed'")
def sql_override(spark, d):
    """A SQL text in place of the conditions."""
    return select.select_activities(table(spark, d, "activity_v"), sql="SELECT count(*) AS n, min(createdat) AS first FROM {activities} WHERE status = 'failed'")


@query("""SELECT activityid AS "activityId", storyid AS "storyId", studentid AS "studentId", districtid AS "districtId", type, createdat AS "createdAt", status, displaystatus AS "displayStatus" FROM activity_v""")
def rename_project(spark, d):
    return select.renamed(table(spark, d, "activity_v").select(*select.ACTIVITY_COLUMNS))


@query("SELECT activity_id, student_id, CAST(NULL AS VARCHAR) AS session_id FROM job_messages")
def optional_columns(spark, d):
    """A column that the table lacks is null."""
    return select.optional(table(spark, d, "job_messages"), {"activity_id": "string", "student_id": "string", "session_id": "string"})


@query("SELECT activityid, createdat FROM activity_v WHERE createdat >= TIMESTAMP '2025-03-14' AND createdat < TIMESTAMP '2025-03-15'")
def previous_day_window(spark, d):
    return table(spark, d, "activity_v").where(select.previous_day("createdat", "2025-03-15 02:00:00")).select("activityid", "createdat")


@query("SELECT segment_id, s3_uri FROM segment_manifest WHERE contains(s3_uri, '.wav') AND NOT ends_with(s3_uri, 'complete.wav')")
def audio_keys(spark, d):
    return table(spark, d, "segment_manifest").where(select.audio_key("s3_uri")).select("segment_id", "s3_uri")


@query("SELECT segment_id FROM segment_manifest WHERE created_at < (SELECT max(created_at) FROM segment_manifest) - INTERVAL 90 DAY")
def age_filter(spark, d):
    """Objects older than 90 days before the newest."""
    t = table(spark, d, "segment_manifest")
    return t.where(select.older_than("created_at", t.agg(F.max("created_at")).scalar(), 90)).select("segment_id")


@query("SELECT page_index, activity_id FROM page_data WHERE trim(activity_id) <> '' AND len(phrases) > 0")
def valid_pages(spark, d):
    return table(spark, d, "page_data").where(select.valid_activity("activity_id", "phrases")).select("activity_id", "page_index")


@query("""SELECT rule, n FROM (SELECT
 count(*) FILTER (WHERE activityid IS NULL OR trim(activityid) = '') AS activity, count(*) FILTER (WHERE NOT coalesce(phraseindex >= 0, false)) AS phrase,
 count(*) FILTER (WHERE NOT coalesce(start_ms >= 0, false)) AS start, count(*) FILTER (WHERE NOT coalesce(end_ms >= 0, false)) AS "end",
 count(*) FILTER (WHERE NOT coalesce(end_ms >= start_ms, false)) AS "order", count(*) FILTER (WHERE NOT coalesce(regexp_matches(s3_uri, '^s3://[^/]+/.+\\.wav$'), false)) AS uri
 FROM segment_manifest) UNPIVOT (n FOR rule IN (activity, phrase, start, "end", "order", uri))""")
def contract_segments(spark, d):
    return select.count_violations(table(spark, d, "segment_manifest"), select.segment_violations())


@query("""SELECT activity_id, timestamp, array_to_string(list_filter([CASE WHEN NOT coalesce(json_valid(pipeline_results), false) THEN 'results' END, CASE WHEN NOT coalesce(processing_time >= 0 AND NOT isnan(processing_time), false) THEN 'time' END,
 CASE WHEN schema_version IS DISTINCT FROM 'activity-results-v1' THEN 'version' END], lambda x: x IS NOT NULL), ',') AS broken
FROM activity_results WHERE NOT coalesce(json_valid(pipeline_results), false) OR NOT coalesce(processing_time >= 0 AND NOT isnan(processing_time), false) OR schema_version IS DISTINCT FROM 'activity-results-v1'""")
def contract_results(spark, d):
    """Rejected result rows with the rules they break."""
    t = select.quarantine(table(spark, d, "activity_results"), select.result_violations())
    return t.where(F.size("broken") > 0).select("activity_id", "timestamp", F.array_join("broken", ",").alias("broken"))


@query("""SELECT word_id, w.page_index % 4 AS model, confidence < thr AS is_low, thr IS NULL AS unknown FROM word_items w LEFT JOIN (VALUES (0, 0.55), (1, 0.7), (2, 0.85)) t(m, thr) ON w.page_index % 4 = m""")
def threshold_flags(spark, d):
    """A threshold by model, from a small table; words of an unknown or null model stay and are marked."""
    thr = spark.createDataFrame([(0, 0.55), (1, 0.7), (2, 0.85)], "model int, threshold double")
    w = table(spark, d, "word_items").withColumn("model", F.col("page_index") % 4)
    return joins.with_threshold(w, thr, "model").select("word_id", "model", (F.col("confidence") < F.col("threshold")).alias("is_low"), "unknown")


_MODEL = "CASE WHEN contains(processor, 'gpu') THEN 'Second-' || processor WHEN starts_with(processor, 'local') THEN 'Faux-' || processor ELSE processor END"


def _models(spark, d):
    """Results with a model made from the processor: second-pass ones, faux ones, others."""
    p = F.col("processor")
    return table(spark, d, "activity_results").withColumn("model", F.when(p.contains("gpu"), F.concat(F.lit("Second-"), p)).when(p.startswith("local"), F.concat(F.lit("Faux-"), p)).otherwise(p))


@query(f"SELECT model, count(*) AS n, bool_or(contains(lower(model), 'second')) AS second_pass FROM (SELECT {_MODEL} AS model FROM activity_results) WHERE NOT starts_with(lower(model), 'faux') GROUP BY model")
def model_classes(spark, d):
    """Prefix exclusion and substring classes of names."""
    t = _models(spark, d).where(select.is_primary_model("model"))
    return t.groupBy("model").agg(F.count(F.lit(1)).alias("n"), F.bool_or(select.is_second_pass("model")).alias("second_pass"))


@query("SELECT storyid, phraseindex, array_to_string(expected_text, '|') AS words FROM story_phrase")
def literal_list_parse(spark, d):
    """Lists written as literals are read back."""
    quote = F.transform("expected_text", lambda w: F.when(F.instr(w, F.lit("'")) > 0, F.concat(F.lit('"'), w, F.lit('"'))).otherwise(F.concat(F.lit("'"), w, F.lit("'"))))
    t = table(spark, d, "story_phrase").select("storyid", "phraseindex", F.concat(F.lit("["), F.array_join(quote, ", "), F.lit("]")).alias("text"))
    return t.select("storyid", "phraseindex", F.array_join(S.parse_list(F.col("text")), "|").alias("words"))


# ---- joins


@query(f"""SELECT a.activityid, a.status, p.phraseindex, len(p.expected_text) AS n_words FROM activity_v a JOIN story_phrase p
ON {FOLD.format(c='a.storyid')} = {FOLD.format(c='p.storyid')} WHERE p.expected_text IS NOT NULL""")
def left_join_notnull(spark, d):
    """Activities with the phrases of their story."""
    return joins.with_phrases(table(spark, d, "activity_v"), table(spark, d, "story_phrase")).select("activityid", "status", "phraseindex", F.size("expected_text").cast("bigint").alias("n_words"))


@query(f"""SELECT count(*) AS n_activities, count(*) FILTER (WHERE NOT coalesce({STORY} IN (SELECT {STORY} FROM story_phrase WHERE storyid IS NOT NULL), false)) AS n_dropped FROM activity_v""")
def dropped_row_count(spark, d):
    return joins.dropped_rows(table(spark, d, "activity_v"), table(spark, d, "story_phrase"))


@query(f"""SELECT activityid, status FROM activity_v WHERE NOT coalesce({STORY} IN (SELECT {STORY} FROM story_phrase WHERE storyid IS NOT NULL), false)""")
def missing_children(spark, d):
    return joins.without_phrases(table(spark, d, "activity_v"), table(spark, d, "story_phrase")).select("activityid", "status")


@query(f"""WITH s AS (SELECT {STORY} AS story, phraseindex AS i FROM story_phrase WHERE phraseindex >= 0),
m AS (SELECT story, max(i) AS top FROM s GROUP BY story), w AS (SELECT story, top + 1 AS n_expected, unnest(generate_series(0, top)) AS phraseindex FROM m)
SELECT story, n_expected, CAST(phraseindex AS INT) AS phraseindex FROM w WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.story = w.story AND s.i = w.phraseindex)""")
def dense_index_check(spark, d):
    """Indices that a story lacks between 0 and its largest."""
    t = table(spark, d, "story_phrase").select(folded(F.col("storyid")).alias("story"), "phraseindex")
    return Q.missing_indices(t, ["story"], "phraseindex")


@query("""SELECT p.activity_id, p.page_index, w.word_id FROM page_data p JOIN word_items w ON p.activity_id = w.activity_id
AND w.start * 1000 >= p.start_time AND w.start * 1000 <= p.end_time + 1000 WHERE p.end_time + 1000 >= p.start_time""")
def interval_token_join(spark, d):
    """Words in page intervals, with a margin at the end."""
    return joins.words_in_pages(table(spark, d, "page_data"), table(spark, d, "word_items"))


@query(f"""WITH p AS (SELECT DISTINCT {STORY} AS storyid, phraseindex, regexp_replace(lower(array_to_string(expected_text, ' ')), '[.,?!:;()\\[\\]"''’“”]', '', 'g') AS phrase FROM story_phrase),
t AS (SELECT doc_id, {FOLD.format(c='story_id')} AS storyid, regexp_replace(lower(text), '[.,?!:;()\\[\\]"''’“”]', '', 'g') AS page FROM documents WHERE text IS NOT NULL)
SELECT doc_id, storyid, phraseindex FROM t JOIN p USING (storyid) WHERE phrase <> '' AND contains(page, phrase)""")
def page_contains_phrase(spark, d):
    return joins.pages_with_phrases(table(spark, d, "documents"), table(spark, d, "story_phrase"))


@query("""WITH p AS (SELECT activity_id, page_index, row_number() OVER (PARTITION BY activity_id ORDER BY page_index) - 1 AS pos FROM (SELECT DISTINCT activity_id, page_index FROM page_data WHERE activity_id IS NOT NULL AND page_index IS NOT NULL)),
s AS (SELECT activityid AS activity_id, phraseindex, row_number() OVER (PARTITION BY activityid ORDER BY phraseindex) - 1 AS pos FROM (SELECT DISTINCT activityid, phraseindex FROM segment_manifest WHERE activityid IS NOT NULL AND phraseindex IS NOT NULL))
SELECT p.activity_id, p.pos, page_index, phraseindex FROM p LEFT JOIN s ON p.activity_id = s.activity_id AND p.pos = s.pos""")
def positional_pairing(spark, d):
    """The n-th page of an activity with its n-th segment."""
    p = table(spark, d, "page_data").where("activity_id IS NOT NULL AND page_index IS NOT NULL").select("activity_id", "page_index").distinct()
    s = table(spark, d, "segment_manifest").where("activityid IS NOT NULL AND phraseindex IS NOT NULL").select(F.col("activityid").alias("activity_id"), "phraseindex").distinct()
    return Q.pair_by_position(p, s, ["activity_id"], ["page_index"], ["phraseindex"], F.floor(F.col("page_index") / 10_000), F.floor(F.col("phraseindex") / 10_000))


_ACCEPTED_VALUES = ", ".join(f"('{k}', '{v}')" for k, vs in ACCEPTED.items() for v in vs)


@query(f"""WITH z AS (SELECT storyid, phraseindex, expected_text, reference_phonemes, unnest(generate_series(1, least(len(expected_text), len(reference_phonemes)))) AS i FROM story_phrase WHERE expected_text IS NOT NULL AND reference_phonemes IS NOT NULL)
SELECT storyid, phraseindex, CAST(i - 1 AS INT) AS place, expected_text[i] AS item, reference_phonemes[i] AS form,
 NOT coalesce((expected_text[i], reference_phonemes[i]) IN (VALUES {_ACCEPTED_VALUES}), false) AS is_error FROM z""")
def lookup_default_error(spark, d):
    """Accepted forms of items; an unknown item is an error."""
    return joins.accepted_forms(table(spark, d, "story_phrase"))


@query(f"""WITH o AS (SELECT {STORY} AS story, phraseindex, max(array_to_string(expected_text, ' ')) AS text FROM story_phrase WHERE phraseindex IS NOT NULL GROUP BY 1, 2)
SELECT o.story, o.phraseindex, o.text, a.text AS previous, b.text AS following FROM o LEFT JOIN o a ON a.story = o.story AND a.phraseindex = o.phraseindex - 1
LEFT JOIN o b ON b.story = o.story AND b.phraseindex = o.phraseindex + 1""")
def neighbour_phrases(spark, d):
    """The phrases at the index before and after, not in the row before and after."""
    t = table(spark, d, "story_phrase").select(folded(F.col("storyid")).alias("story"), "phraseindex", F.array_join("expected_text", " ").alias("text"))
    return joins.neighbours(t, ["story"], "phraseindex", "text")


@query("SELECT activity_id, phrase, min(page_index) AS page_index FROM (SELECT activity_id, page_index, unnest(phrase_indices) AS phrase FROM page_data) GROUP BY 1, 2")
def first_page_of_phrase(spark, d):
    return joins.first_page_of(table(spark, d, "page_data"))


@query("SELECT activity_id, page_index, phrase_indices[2] AS phrase FROM page_data")
def array_index_lookup(spark, d):
    return joins.absolute_index(table(spark, d, "page_data"), 1)


@query("""WITH e AS (SELECT event_id, user_id, ts, event_type, value FROM events), l AS (SELECT * FROM e WHERE event_type = 'purchase'), r AS (SELECT user_id, ts, max_by(value, event_id) AS value FROM e WHERE event_type = 'view' GROUP BY 1, 2)
SELECT l.event_id, l.user_id, r.value AS last_value FROM l ASOF LEFT JOIN r ON l.user_id = r.user_id AND l.ts >= r.ts""")
def as_of_ack(spark, d):
    """The last view of the user at or before each purchase."""
    e = table(spark, d, "events").select("event_id", "user_id", "ts", "event_type", "value")
    left = e.where("event_type = 'purchase'").select("event_id", "user_id", "ts")
    return Q.as_of(left, e.where("event_type = 'view'"), "user_id", "ts", "event_id", "value", Q.hour_of("ts")).select("event_id", "user_id", "last_value")


# ---- aggregations


@query(f"SELECT {STORY} AS story, string_agg(array_to_string(expected_text, ' '), ' / ' ORDER BY phraseindex, array_to_string(expected_text, ' ')) AS text, count(*) AS n FROM story_phrase GROUP BY 1")
def group_ordered_list(spark, d):
    """The phrases of a story in order."""
    item = F.struct("phraseindex", F.array_join("expected_text", " ").alias("text"))
    t = table(spark, d, "story_phrase").groupBy(folded(F.col("storyid")).alias("story")).agg(F.array_sort(F.collect_list(item)).alias("l"), F.count(F.lit(1)).alias("n"))
    return t.select("story", F.array_join(F.transform("l", lambda x: x["text"]), " / ").alias("text"), "n")


_SEGMENT_BYTES = "SELECT activityid, phraseindex, CAST(round((end_ms - start_ms) * 32) AS BIGINT) + 44 AS bytes FROM segment_manifest"


def _segment_bytes(spark, d):
    size = (F.round((F.col("end_ms") - F.col("start_ms")) * 32) + 44).cast("bigint")
    return table(spark, d, "segment_manifest").select("segment_id", "activityid", "phraseindex", size.alias("size"), "s3_uri", "created_at")


@query(f"SELECT activityid, phraseindex, count(*) AS n, CAST(sum(bytes - 44) AS BIGINT) AS bytes FROM ({_SEGMENT_BYTES}) WHERE phraseindex IS NOT NULL GROUP BY 1, 2")
def segment_group_sum(spark, d):
    return Q.group_sizes(_segment_bytes(spark, d), ["activityid"], "phraseindex", "size")


@query(f"""WITH g AS (SELECT activityid, phraseindex, sum(bytes - 44) AS bytes FROM ({_SEGMENT_BYTES}) WHERE phraseindex IS NOT NULL GROUP BY 1, 2),
t AS (SELECT activityid, phraseindex, CAST(round_even(bytes / 32, 0) AS BIGINT) AS dur FROM g)
SELECT activityid, phraseindex, CAST(coalesce(sum(dur) OVER (PARTITION BY activityid ORDER BY phraseindex ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start_ms,
CAST(sum(dur) OVER (PARTITION BY activityid ORDER BY phraseindex ROWS UNBOUNDED PRECEDING) AS BIGINT) AS end_ms FROM t WHERE dur IS NOT NULL""")
def page_timing_running_sum(spark, d):
    """Phrases of an activity on one running clock."""
    g = Q.group_sizes(_segment_bytes(spark, d), ["activityid"], "phraseindex", "size").where("bytes IS NOT NULL")
    return Q.timeline(g, ["activityid"], "phraseindex", "bytes").select("activityid", "phraseindex", "start_ms", "end_ms")


@query("""WITH p AS (SELECT activity_id, page_index, start_time, end_time, max(greatest(0, coalesce(start_time, 0), coalesce(end_time, 0))) OVER (PARTITION BY activity_id ORDER BY page_index ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach
 FROM (SELECT activity_id, page_index, max(start_time) AS start_time, max(end_time) AS end_time FROM page_data WHERE activity_id IS NOT NULL AND page_index IS NOT NULL GROUP BY 1, 2)),
s AS (SELECT *, greatest(coalesce(reach, 0), coalesce(start_time, 0), 0) AS s FROM p)
SELECT activity_id, page_index, s AS start_time, greatest(coalesce(end_time, 0), s) AS end_time FROM s""")
def timing_continuity(spark, d):
    """Pages that follow each other without overlap."""
    t = table(spark, d, "page_data").where("activity_id IS NOT NULL AND page_index IS NOT NULL").groupBy("activity_id", "page_index").agg(F.max("start_time").alias("start_time"), F.max("end_time").alias("end_time"))
    return Q.continuous(t, ["activity_id"], ["page_index"], "start_time", "end_time", F.lit(0), F.floor(F.col("page_index") / 10_000))


# The parts of a segment's base name, cut at its hyphens: three digits, six digits, a number, and a version with the ending.
_NAMED = """(SELECT *, CASE WHEN len(q) >= 4 AND len(q[1]) = 3 AND len(q[2]) = 6 AND len(q[3]) > 0 AND translate(q[1] || q[2] || q[3], '0123456789', '') = '' AND q[4][1] = 'v' AND translate(q[4][2], '0123456789', '') = '' AND substr(q[4], 3, 4) = '.wav' THEN q END AS part
 FROM (SELECT *, string_split(string_split(s3_uri, '/')[-1], '-') AS q FROM segment_manifest))"""


@query(f"""SELECT activity_id, phrase, string_agg(CAST(k AS VARCHAR) || '=' || f, ',' ORDER BY k) AS files, max_by(f, k) AS last_file FROM (
 SELECT activityid AS activity_id, phraseindex AS phrase, CAST(part[3] AS INT) AS k, max_by(s3_uri, segment_id) AS f FROM {_NAMED} WHERE phraseindex IS NOT NULL AND part IS NOT NULL GROUP BY 1, 2, 3) GROUP BY 1, 2""")
def segments_map(spark, d):
    """Segment files of a phrase by sequence number; of repeated numbers the last wins."""
    t = table(spark, d, "segment_manifest").where("phraseindex IS NOT NULL").select(F.col("activityid").alias("activity_id"), F.col("phraseindex").alias("phrase"), rules.segment_name(F.col("s3_uri"))["seq"].alias("seq"), "s3_uri", "segment_id")
    m = Q.segment_map(t, ["activity_id", "phrase"], "seq", "s3_uri", "segment_id")
    entries = F.array_join(F.transform(F.map_entries("files"), lambda e: F.concat(e["key"].cast("string"), F.lit("="), e["value"])), ",")
    return m.select("activity_id", "phrase", entries.alias("files"), "last_file")


@query("""WITH r AS (SELECT processor, CAST(pipeline_results->>'$.error_count' AS BIGINT) AS e, CAST(pipeline_results->>'$.total_alignments' AS BIGINT) AS n FROM activity_results)
SELECT processor, count(*) AS n_results, CAST(sum(e) AS BIGINT) AS n_errors, CAST(sum(n) AS BIGINT) AS n_words, round(CASE WHEN sum(n) > 0 THEN (sum(n) - sum(e)) / sum(n) ELSE 0.0 END, 6) AS accuracy FROM r GROUP BY processor""")
def accuracy_stats(spark, d):
    """Accuracy from sums, not from a mean of ratios."""
    r = F.from_json("pipeline_results", "error_count bigint, total_alignments bigint")
    t = table(spark, d, "activity_results").select("processor", r["error_count"].alias("e"), r["total_alignments"].alias("n"))
    out = t.groupBy("processor").agg(F.count(F.lit(1)).alias("n_results"), F.sum("e").alias("n_errors"), F.sum("n").alias("n_words"))
    return out.withColumn("accuracy", F.round(F.when(F.col("n_words") > 0, (F.col("n_words") - F.col("n_errors")) / F.col("n_words")).otherwise(0.0), 6))


@query("""WITH r AS (SELECT strftime(make_timestamp("timestamp" * 1000000), '%Y-%m-%d') AS day, status = 'processed' AS ok, CASE WHEN NOT isnan(processing_time) AND processing_time >= 0 THEN processing_time END AS t FROM activity_results),
s AS (SELECT day, count(*) AS n, count(*) FILTER (WHERE ok) AS n_ok, coalesce(sum(t) FILTER (WHERE ok), 0) AS total_s, count(t) FILTER (WHERE ok) AS k FROM r GROUP BY day)
SELECT day, n, n_ok, n - n_ok AS n_failed, round(total_s, 6) AS total_s, round(total_s / nullif(k, 0), 10) AS mean_s, CAST(coalesce(floor(n_ok / nullif(total_s / 60, 0)), 0) AS INT) AS per_minute, round(n_ok / n, 6) AS success_rate,
CASE WHEN n_ok / n >= 0.95 THEN 'excellent' WHEN n_ok / n >= 0.9 THEN 'good' WHEN n_ok / n >= 0.8 THEN 'fair' ELSE 'poor' END AS grade FROM s""")
def batch_summary(spark, d):
    day = F.date_add(F.lit("1970-01-01").cast("date"), F.floor(F.col("timestamp") / 86400).cast("int")).cast("string")
    t = table(spark, d, "activity_results").select(day.alias("day"), (F.col("status") == "processed").alias("ok"), metrics.measured("processing_time").alias("t"))
    return metrics.batch_summary(t, ["day"], F.col("ok"), F.col("t"))


@query("""WITH v AS (SELECT processor, processing_time AS v FROM activity_results WHERE NOT isnan(processing_time) AND processing_time >= 0),
s AS (SELECT processor, count(*) AS n, avg(v) AS mean, coalesce(stddev_samp(v), 0) AS stdev, min(v) AS least, max(v) AS most FROM v GROUP BY processor)
SELECT processor, n, round(mean, 10) AS mean, round(stdev, 6) AS stdev, least, most, round((SELECT round(mean, 10) FROM s WHERE processor = 'cpu-lambda-x86') / round(mean, 10), 9) AS speedup FROM s""")
def bench_stats(spark, d):
    """Statistics of a processor and its speedup over a baseline."""
    t = table(spark, d, "activity_results")
    return metrics.speedups(metrics.statistics(t, ["processor"], metrics.measured("processing_time")), "processor", "cpu-lambda-x86")


@query("""WITH r AS (SELECT processor, coalesce(status = 'processed', false) AS ok, CASE WHEN status = 'processed' AND NOT isnan(processing_time) AND processing_time >= 0 THEN processing_time END AS v FROM activity_results)
SELECT processor, count(*) AS n_runs, round(count(*) FILTER (WHERE ok) / count(*), 6) AS success_rate, count(v) AS n, round(avg(v), 10) AS mean, round(median(v), 10) AS median, round(coalesce(stddev_samp(v), 0), 6) AS stdev, min(v) AS least, max(v) AS most FROM r GROUP BY processor""")
def run_stats(spark, d):
    """Statistics of a processor over its successes, with the median and the success rate."""
    return metrics.run_statistics(table(spark, d, "activity_results"), ["processor"], metrics.measured("processing_time"), F.col("status") == "processed")


@query("""SELECT processor FROM activity_results WHERE NOT isnan(processing_time) AND processing_time >= 0 AND processor IS NOT NULL GROUP BY processor ORDER BY round(avg(processing_time), 10), processor LIMIT 1""")
def fastest_processor(spark, d):
    s = metrics.statistics(table(spark, d, "activity_results").where("processor IS NOT NULL"), ["processor"], metrics.measured("processing_time"))
    return s.orderBy("mean", "processor").limit(1).select("processor")


@query("""WITH v AS (SELECT processor, processing_time AS v, row_number() OVER (PARTITION BY processor ORDER BY processing_time) AS k, count(*) OVER (PARTITION BY processor) AS n FROM activity_results WHERE NOT isnan(processing_time) AND processing_time >= 0),
j AS (SELECT processor, n, greatest(1, least(n - 1, (n + 1) * 19 // 20)) AS j FROM v GROUP BY ALL)
SELECT j.processor, j.n, CASE WHEN j.n > 1 THEN round((max(v) FILTER (WHERE k = j) * (20 - ((j.n + 1) * 19 - j * 20)) + max(v) FILTER (WHERE k = j + 1) * ((j.n + 1) * 19 - j * 20)) / 20, 10) END AS q
FROM j JOIN v ON v.processor IS NOT DISTINCT FROM j.processor GROUP BY j.processor, j.n, j""")
def p95_exclusive(spark, d):
    """The 95th percentile by the (n + 1) rule."""
    return metrics.exclusive_quantile(table(spark, d, "activity_results"), ["processor"], metrics.measured("processing_time"), 19, 20)


@query("SELECT status, count(*) AS n, round(count(*) / sum(count(*)) OVER (), 6) AS part FROM activity_results GROUP BY status")
def status_counts(spark, d):
    t = table(spark, d, "activity_results").groupBy("status").agg(F.count(F.lit(1)).alias("n"))
    return t.select("status", "n", F.round(F.col("n") / t.agg(F.sum("n")).scalar(), 6).alias("part"))


@query("""SELECT activity_id, processor, status, "timestamp" FROM (SELECT *, row_number() OVER (PARTITION BY activity_id, processor ORDER BY "timestamp", status, correlation_id NULLS LAST) AS k FROM activity_results WHERE processing_time IS NOT NULL) WHERE k = 1""")
def first_wins_dedupe(spark, d):
    """The first measured result of an activity and processor; rows without a time never claim the key."""
    t = table(spark, d, "activity_results").where("processing_time IS NOT NULL")
    first = F.min(F.struct("timestamp", "status", F.col("correlation_id").isNull(), "correlation_id")).alias("f")
    return t.groupBy("activity_id", "processor").agg(first).select("activity_id", "processor", "f.status", "f.timestamp")


@query("""WITH f AS (SELECT word_id, activity_id, page_index, CASE WHEN confidence >= 0.9 THEN 'Second pass' WHEN confidence < 0.1 THEN 'faux' ELSE 'base' END AS model FROM word_items WHERE activity_id IS NOT NULL AND page_index IS NOT NULL),
p AS (SELECT *, model = 'Second pass' AS s FROM f WHERE model <> 'faux'),
g AS (SELECT activity_id, max(page_index) + 1 AS n, count(DISTINCT page_index) FILTER (WHERE s) AS n2 FROM p GROUP BY 1)
SELECT word_id, activity_id, model FROM p JOIN g USING (activity_id) WHERE s = (n2 > 0 AND n2 = n)""")
def preferred_pass(spark, d):
    """Words of the second pass (here: sure words) where it covers every page, else of the first."""
    model = F.when(F.col("confidence") >= 0.9, "Second pass").when(F.col("confidence") < 0.1, "faux").otherwise("base")
    t = table(spark, d, "word_items").where("activity_id IS NOT NULL AND page_index IS NOT NULL").select("word_id", "activity_id", "page_index", model.alias("model"))
    return select.preferred_pass(t, ["activity_id"], "page_index", "model").select("word_id", "activity_id", "model")


@query("""WITH m AS (SELECT activity_id, max(list_max(phrase_indices)) AS top FROM page_data GROUP BY 1)
SELECT s.segment_id, s.phraseindex FROM segment_manifest s JOIN m ON m.activity_id = s.activityid WHERE s.phraseindex <= m.top""")
def page_limit_truncate(spark, d):
    """Segments up to the last phrase of the pages."""
    top = table(spark, d, "page_data").groupBy(F.col("activity_id").alias("activityid")).agg(F.max(F.array_max("phrase_indices")).alias("top"))
    return skew_join(table(spark, d, "segment_manifest").select("segment_id", "activityid", "phraseindex"), top, ["activityid"]).where("phraseindex <= top").select("segment_id", "phraseindex")


@query("""WITH x AS (SELECT vec_id, embedding AS e, list_max(embedding) AS m FROM embeddings)
SELECT vec_id, CAST(list_position(e, m) - 1 AS INT) AS best, round(1 / list_sum(list_transform(e, lambda v: exp(CAST(v AS DOUBLE) - CAST(m AS DOUBLE)))), 6) AS prob FROM x""")
def argmax_softmax(spark, d):
    e = F.col("embedding")
    return table(spark, d, "embeddings").select("vec_id", S.argmax(e).alias("best"), F.round(S.softmax_max(e), 6).alias("prob"))


# ---- ordered sequences

_RUNS = """WITH c AS (SELECT user_id, event_id, ts, event_type, value, CASE WHEN event_type IS DISTINCT FROM lag(event_type) OVER w OR row_number() OVER w = 1 THEN 1 ELSE 0 END AS c FROM {src} WINDOW w AS (PARTITION BY {keys} ORDER BY ts, event_id)),
r AS (SELECT *, sum(c) OVER (PARTITION BY {keys} ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS run FROM c)"""


@query(_RUNS.format(src="events", keys="user_id") + " SELECT user_id, CAST(run AS BIGINT) AS run, event_type, count(*) AS n, round(avg(value), 9) AS mean_value FROM r GROUP BY 1, 2, 3")
def run_length_groups(spark, d):
    """Runs of equal consecutive tokens."""
    r = Q.runs(table(spark, d, "events").select("user_id", "ts", "event_id", "event_type", "value"), ["user_id"], ["ts", "event_id"], "event_type", "value", Q.hour_of("ts"))
    return r.withColumn("mean_value", F.round("mean_value", 9))


_SEGMENTS = "(SELECT user_id, event_id, ts, event_type, value, sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS segment FROM events WHERE event_type <> 'signup')"


@query(f"SELECT event_id, user_id, CAST(segment AS BIGINT) AS segment, event_type FROM {_SEGMENTS} WHERE event_type <> 'error'")
def segment_by_separator(spark, d):
    """Segments between separators; pads (signup) go first."""
    t = Q.segments(table(spark, d, "events").select("user_id", "ts", "event_id", "event_type"), ["user_id"], ["ts", "event_id"], "event_type", "error", "signup", Q.hour_of("ts"))
    return t.select("event_id", "user_id", F.col("segment").cast("bigint").alias("segment"), "event_type")


@query(f"""WITH s AS (SELECT * FROM {_SEGMENTS} WHERE event_type <> 'error'),
c AS (SELECT *, CASE WHEN event_type IS DISTINCT FROM lag(event_type) OVER (PARTITION BY user_id, segment ORDER BY ts, event_id) THEN 1 ELSE 0 END AS c FROM s),
r AS (SELECT *, sum(c) OVER (PARTITION BY user_id, segment ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS run FROM c),
m AS (SELECT user_id, segment, run, avg(value) AS v FROM r GROUP BY 1, 2, 3)
SELECT user_id, CAST(segment AS BIGINT) AS segment, count(*) AS n_runs, round(avg(v), 9) AS confidence FROM m GROUP BY 1, 2""")
def mean_of_means_conf(spark, d):
    e = table(spark, d, "events").where("event_type <> 'signup'").select("user_id", "ts", "event_id", "event_type", "value")
    t = Q.mean_of_means(e, ["user_id"], ["ts", "event_id"], "event_type", "value", "error", Q.hour_of("ts"))
    return t.select("user_id", F.col("segment").cast("bigint").alias("segment"), "n_runs", F.round("confidence", 9).alias("confidence"))


_ELEMENTS = "|".join(ELEMENTS)


@query(f"SELECT storyid, phraseindex, array_to_string(regexp_extract_all(array_to_string(reference_phonemes, ''), '{_ELEMENTS}'), ' ') AS elements FROM story_phrase")
def longest_match_tokens(spark, d):
    """Phonetic elements, the longest first."""
    return table(spark, d, "story_phrase").select("storyid", "phraseindex", F.array_join(S.longest_elements(F.array_join("reference_phonemes", "")), " ").alias("elements"))


@query(align_sql.DECODE)
def decode_tokens(spark, d):
    """Elements and confidences of token streams: the characters of a phrase's phonemes, cut at words."""
    t = table(spark, d, "story_phrase").where(F.col("reference_phonemes").isNotNull())
    chars = F.filter(F.split(F.array_join("reference_phonemes", "|"), ""), lambda c: c != "")
    t = t.select("storyid", "phraseindex", chars.alias("tokens"))
    probs = F.transform("tokens", lambda c: ((F.ascii(c) % 100) / 100).cast("double"))
    t = t.select("storyid", "phraseindex", align.decoded_stream(F.col("tokens"), probs).alias("x"))
    return t.select("storyid", "phraseindex", F.array_join("x.elements", " ").alias("elements"), F.size("x.elements").cast("bigint").alias("n"), _total("x.confidences").alias("sure"))


@query(f"""WITH l AS (SELECT activityid, phraseindex, max(CAST(part[3] AS INT)) AS last_seq FROM {_NAMED} WHERE phraseindex IS NOT NULL GROUP BY 1, 2)
SELECT activityid, phraseindex, last_seq, coalesce(lag(last_seq) OVER (PARTITION BY activityid ORDER BY phraseindex) + 1, 0) AS start_seq FROM l""")
def start_sequences(spark, d):
    """Where a phrase's sequence begins: one after the last of the phrase before."""
    t = table(spark, d, "segment_manifest").select("activityid", "phraseindex", rules.segment_name(F.col("s3_uri"))["seq"].alias("seq"))
    return Q.start_sequence(t, ["activityid"], "phraseindex", "seq")


@query(f"""WITH s AS (SELECT DISTINCT activityid AS a, phraseindex AS i FROM segment_manifest WHERE phraseindex >= 0), m AS (SELECT a, max(i) AS top FROM s GROUP BY a),
w AS (SELECT a, unnest(generate_series(0, top)) AS i FROM m), g AS (SELECT w.a, w.i FROM w LEFT JOIN s ON s.a = w.a AND s.i = w.i WHERE s.a IS NULL),
k AS (SELECT a, i, i - row_number() OVER (PARTITION BY a ORDER BY i) AS r FROM g)
SELECT a AS activityid, CAST(min(i) AS INT) AS from_index, count(*) AS n FROM k GROUP BY a, r""")
def gap_fill_drops(spark, d):
    """Streaks of missing segments."""
    return Q.miss_streaks(table(spark, d, "segment_manifest").select("activityid", "phraseindex"), ["activityid"], "phraseindex")


_NESTED = "SELECT activity_id, page_index, list(confidence < 0.6 ORDER BY word_id) AS e FROM word_items WHERE activity_id IS NOT NULL AND page_index IS NOT NULL AND confidence IS NOT NULL GROUP BY 1, 2"


def _flags(spark, d):
    """Error flags of the words of a page; a page's words are bounded by what one page holds."""
    w = table(spark, d, "word_items").where("activity_id IS NOT NULL AND page_index IS NOT NULL AND confidence IS NOT NULL")
    g = w.groupBy("activity_id", "page_index").agg(F.array_sort(F.collect_list(F.struct("word_id", (F.col("confidence") < 0.6).alias("e")))).alias("l"))
    return g.select("activity_id", "page_index", F.transform("l", lambda x: x["e"]).alias("e"))


@query("""WITH w AS (SELECT activity_id, page_index, word_id, confidence < 0.6 AS e FROM word_items WHERE activity_id IS NOT NULL AND page_index IS NOT NULL AND confidence IS NOT NULL),
g AS (SELECT activity_id, max((page_index, word_id)) FILTER (WHERE NOT e) AS last_ok, max(page_index) AS top FROM w GROUP BY 1),
k AS (SELECT w.activity_id, count(*) FILTER (WHERE page_index = top) AS n_top FROM w JOIN g USING (activity_id) GROUP BY 1)
SELECT activity_id, page_index, count(*) AS n_words, count(*) FILTER (WHERE e) AS n_errors FROM w JOIN g USING (activity_id) JOIN k USING (activity_id)
WHERE last_ok IS NULL OR n_top = 1 OR (page_index, word_id) <= last_ok GROUP BY 1, 2""")
def trailing_trim(spark, d):
    """Words after the last right one of an activity are cut, unless none is right or the last page has one word.

    Aggregates decide per activity; no activity's words are put into one row.
    """
    w = table(spark, d, "word_items").where("activity_id IS NOT NULL AND page_index IS NOT NULL AND confidence IS NOT NULL")
    w = w.select("activity_id", "page_index", "word_id", (F.col("confidence") < 0.6).alias("e"))
    place = F.struct("page_index", "word_id")
    per_page = w.groupBy("activity_id", "page_index").agg(F.count(F.lit(1)).alias("n"), F.max(F.when(~F.col("e"), place)).alias("ok"))
    g = per_page.groupBy("activity_id").agg(F.max("ok").alias("last_ok"), F.max_by("n", "page_index").alias("n_top"))
    kept = skew_join(w, g, ["activity_id"]).where(F.col("last_ok").isNull() | (F.col("n_top") == 1) | (place <= F.col("last_ok")))
    return kept.groupBy("activity_id", "page_index").agg(F.count(F.lit(1)).alias("n_words"), F.count_if("e").alias("n_errors"))


@query("""SELECT activity_id, page_index, array_to_string(phrases, ' ') AS flat, array_to_string(list_transform(phrases, lambda p: CAST(len(list_filter(string_split(p, ' '), lambda w: w <> '')) AS VARCHAR)), ',') AS sizes FROM page_data WHERE len(phrases) > 0""")
def renest_flat(spark, d):
    """Words of a page flattened and nested again by phrase lengths."""
    t = table(spark, d, "page_data").where(F.size("phrases") > 0)
    words = F.transform("phrases", lambda p: S.words_of(p))
    t = t.select("activity_id", "page_index", F.flatten(words).alias("f"), F.transform(words, lambda w: F.size(w)).alias("n"))
    nested = S.renest(F.col("f"), F.col("n"))
    return t.select("activity_id", "page_index", F.array_join(F.transform(nested, lambda w: F.array_join(w, " ")), " ").alias("flat"), F.array_join(F.transform(nested, lambda w: F.size(w).cast("string")), ",").alias("sizes"))


# ---- rules

_VOTES = """WITH v AS (SELECT activity_id, page_index, list(CASE WHEN confidence >= 0.9 THEN 1 ELSE 0 END ORDER BY word_id) AS m, list(confidence < 0.6 ORDER BY word_id) AS e,
 list(CASE WHEN confidence >= 0.75 THEN 1 ELSE 0 END ORDER BY word_id) AS s, list(CASE WHEN len(word) > 4 THEN 1 ELSE 0 END ORDER BY word_id) AS p FROM word_items
 WHERE activity_id IS NOT NULL AND page_index IS NOT NULL AND confidence IS NOT NULL GROUP BY 1, 2),
c AS (SELECT *, list_sum(m) AS nm, len(list_filter(e, lambda x: NOT x)) AS ne, list_sum(p) AS np, len(list_filter(generate_series(1, len(m)), lambda i: (m[i] = 1) = e[i])) AS n_dis FROM v),
d AS (SELECT *, CASE WHEN nm = 0 AND ne = 0 THEN 'keep' WHEN nm = 0 AND ne > 2 THEN 'rescore' WHEN nm = 0 AND np = 0 THEN 'mark_all' WHEN nm = 0 THEN 'rescore' WHEN n_dis = 0 THEN 'keep' ELSE 'rescore' END AS strategy FROM c)"""


def _sources(spark, d):
    """Four sources of a page's words, made from its words' confidences."""
    w = table(spark, d, "word_items").where("activity_id IS NOT NULL AND page_index IS NOT NULL AND confidence IS NOT NULL")
    one = lambda c: F.when(c, 1).otherwise(0)
    item = F.struct("word_id", one(F.col("confidence") >= 0.9).alias("m"), (F.col("confidence") < 0.6).alias("e"), one(F.col("confidence") >= 0.75).alias("s"), one(F.length("word") > 4).alias("p"))
    g = w.groupBy("activity_id", "page_index").agg(F.array_sort(F.collect_list(item)).alias("l"))
    pick = lambda k: F.transform("l", lambda x: x[k])
    return g.select("activity_id", "page_index", pick("m").alias("matches"), pick("e").alias("errors"), pick("s").alias("second"), pick("p").alias("prior"), F.size("l").alias("length"), F.lit(True).alias("has_audio"))


@query(_VOTES + " SELECT activity_id, page_index, strategy FROM d")
def flag_decision(spark, d):
    return rules.scored(_sources(spark, d)).select("activity_id", "page_index", "strategy")


@query(_VOTES + " SELECT activity_id, page_index, array_to_string(list_transform(generate_series(1, len(m)), lambda i: CASE WHEN p[i] = 1 OR m[i] + s[i] + p[i] > 1 THEN '0' ELSE '1' END), '') AS errors FROM v")
def consensus_vote(spark, d):
    t = _sources(spark, d)
    e = S.vote(F.col("matches"), F.col("second"), F.col("prior"))
    return t.select("activity_id", "page_index", F.array_join(F.transform(e, lambda x: x.cast("int").cast("string")), "").alias("errors"))


@query(_VOTES + """ SELECT activity_id, page_index, strategy, CASE strategy WHEN 'keep' THEN len(e) - ne WHEN 'mark_all' THEN len(m) ELSE len(list_filter(generate_series(1, len(m)), lambda i: NOT (p[i] = 1 OR m[i] + s[i] + p[i] > 1))) END AS n_errors, len(m) AS n_words FROM d""")
def execute_decision(spark, d):
    t = rules.scored(_sources(spark, d))
    a = rules.accuracy(F.col("result"))
    return t.select("activity_id", "page_index", "strategy", a["n_errors"].cast("bigint").alias("n_errors"), a["n_words"].cast("bigint").alias("n_words"))


@query("""SELECT word_id, CASE WHEN confidence IS NOT NULL THEN CASE WHEN confidence >= 0.9 THEN 1 ELSE 0 END ELSE CASE WHEN page_index = 0 THEN 1 ELSE 0 END END AS match FROM word_items""")
def match_fallback(spark, d):
    """A match, or where it is null whether the distance is 0."""
    m = F.when(F.col("confidence").isNotNull(), F.array(F.when(F.col("confidence") >= 0.9, 1).otherwise(0)))
    t = table(spark, d, "word_items")
    return t.select("word_id", F.coalesce(F.get(S.match_or_distance(m, F.array(F.coalesce("page_index", F.lit(1)))), F.lit(0)), F.lit(0)).alias("match"))


@query(f"SELECT segment_id, CAST(part[1] AS INT) AS phrase, CAST(part[2] AS INT) AS number, CAST(part[3] AS INT) AS seq FROM {_NAMED}")
def filename_parse(spark, d):
    return table(spark, d, "segment_manifest").select("segment_id", rules.segment_name(F.col("s3_uri")).alias("n")).select("segment_id", "n.phrase", "n.number", "n.seq")


@query(r"""SELECT activityid, count(*) AS n_tagged, count(*) FILTER (WHERE NOT regexp_matches(s3_uri, '/(\d+)-(\d+)[^/]*-v2\.wav$')) AS n_invalid, count(*) FILTER (WHERE NOT regexp_matches(s3_uri, '/(\d+)-(\d+)[^/]*-v2\.wav$')) > 2 AS fails FROM segment_manifest WHERE ends_with(s3_uri, '-v2.wav') GROUP BY 1""")
def invalid_names(spark, d):
    return rules.too_many_invalid(table(spark, d, "segment_manifest"), ["activityid"], "s3_uri", 2)


@query("""WITH f AS (SELECT DISTINCT activityid AS activity_id, phraseindex AS phrase FROM segment_manifest WHERE phraseindex IS NOT NULL), p AS (SELECT DISTINCT activity_id, unnest(phrase_indices) AS phrase FROM page_data WHERE activity_id IS NOT NULL),
t AS (SELECT activity_id, max(phrase) AS top FROM f GROUP BY 1)
SELECT p.activity_id, p.phrase, CASE WHEN p.phrase <= t.top THEN 'error' ELSE 'warning' END AS problem FROM p LEFT JOIN t USING (activity_id) WHERE NOT EXISTS (SELECT 1 FROM f WHERE f.activity_id = p.activity_id AND f.phrase = p.phrase)""")
def missing_features(spark, d):
    f = table(spark, d, "segment_manifest").where("phraseindex IS NOT NULL").select(F.col("activityid").alias("activity_id"), F.col("phraseindex").alias("phrase"))
    p = table(spark, d, "page_data").where("activity_id IS NOT NULL").select("activity_id", F.explode("phrase_indices").alias("phrase"))
    return rules.missing_features(p, f, ["activity_id"], "phrase")


# ---- alignment


def _heard(spark, d):
    """Phrases with a second, altered reading: each third form is dropped, each fifth replaced."""
    t = table(spark, d, "story_phrase").where(F.col("expected_text").isNotNull())
    ref = F.transform(F.col("reference_phonemes"), lambda x: F.coalesce(x, F.lit("")))
    heard = F.filter(F.transform(ref, lambda x, i: F.when((i + F.col("phraseindex")) % 5 == 4, F.lit("ɛ")).otherwise(x)), lambda x, i: (i + F.col("phraseindex")) % 7 != 3)
    conf = F.transform(heard, lambda x, i: (F.lit(0.5) + (i % 10) / 20).cast("double"))
    return t.select("storyid", "phraseindex", F.col("expected_text").alias("e"), ref.alias("r"), heard.alias("h"), conf.alias("c"))


def _total(confidences):
    return F.round(F.aggregate(confidences, F.lit(0.0), lambda a, x: a + x), 6)


@query(align_sql.DIFF)
def diff_alignment(spark, d):
    """What was heard for each expected item."""
    t = _heard(spark, d).withColumn("x", align.aligned_items(F.col("e"), F.col("r"), F.col("h"), F.col("c")))
    flags = F.transform("x.errors", lambda b: b.cast("int").cast("string"))
    return t.select("storyid", "phraseindex", F.array_join("x.phonemes", " ").alias("phonemes"), F.array_join(flags, "").alias("errors"), _total("x.confidences").alias("sure"))


def _told(spark, d):
    """Words of a page's phrases against those the recogniser put on the page."""
    w = table(spark, d, "word_items").where("activity_id IS NOT NULL AND page_index IS NOT NULL AND start IS NOT NULL AND end IS NOT NULL")
    w = w.groupBy("activity_id", "page_index").agg(F.array_sort(F.collect_list(F.struct("start", "end", "word_id", "word"))).alias("tokens"))
    p = table(spark, d, "page_data").where("activity_id IS NOT NULL AND page_index IS NOT NULL").groupBy("activity_id", "page_index").agg(F.max("phrases").alias("phrases"), F.max("start_time").alias("page_start"))
    return p.join(w, ["activity_id", "page_index"])


def _digits(m):
    return F.array_join(F.transform(m, lambda x: x.cast("string")), "").alias("matches")


@query(align_sql.WORD_MATCH)
def word_match(spark, d):
    """0/1 for each word of a page's text."""
    t = _told(spark, d)
    m = align.matched_words(F.array_join("phrases", " "), F.array_join(F.transform("tokens", lambda x: x["word"]), " "))
    return t.select("activity_id", "page_index", m.alias("m")).select("activity_id", "page_index", _digits("m"))


@query(align_sql.SOUND)
def sound_match(spark, d):
    """0/1 for each phonetic word of a phrase, with substitutes."""
    t = _heard(spark, d)
    m = align.matched_sounds(F.filter("r", lambda x: x != ""), F.filter("h", lambda x: x != ""))
    return t.select("storyid", "phraseindex", m.alias("m")).select("storyid", "phraseindex", _digits("m"))


@query(align_sql.MAPPING)
def sequence_mapping(spark, d):
    """Which recognised word each word of a page is mapped onto."""
    t = _told(spark, d)
    m = align.place_map(S.words_of(F.array_join("phrases", " ")), F.transform("tokens", lambda x: x["word"]))
    return t.select("activity_id", "page_index", F.array_join(F.transform(m, lambda x: F.concat_ws("-", x["i"].cast("string"), x["j"].cast("string"))), " ").alias("places"))


def _timed(spark, d):
    """Every page with its phrases and the words that lie in it by time, whatever page the recogniser put them on; none where a page has no times."""
    p = table(spark, d, "page_data").where("activity_id IS NOT NULL AND page_index IS NOT NULL").groupBy("activity_id", "page_index")
    p = p.agg(*[F.max(c).alias(c) for c in ("phrases", "phrase_indices", "start_time", "end_time")])
    w = joins.words_in_pages(p, table(spark, d, "word_items"), columns=("start", "end", "word_id", "word"))
    w = w.groupBy("activity_id", "page_index").agg(F.array_sort(F.collect_list(F.struct("start", "end", "word_id", "word"))).alias("tokens"))
    none = F.array().cast(w.schema["tokens"].dataType)
    return p.join(w, ["activity_id", "page_index"], "left").withColumn("tokens", F.coalesce("tokens", none)).withColumnRenamed("start_time", "page_start")


@query(align_sql.TIMES)
def page_phrase_alignment(spark, d):
    """Times of the phrases of every page; those of a page without words are empty intervals at its start."""
    return align.phrase_timings(_timed(spark, d))


_SUB_PATTERN = {k: "[" + k + "".join(v) + "]" for k, v in SUBSTITUTES.items()}


@query(f"""WITH z AS (SELECT storyid, phraseindex, reference_phonemes AS r, unnest(generate_series(1, len(reference_phonemes) - 1)) AS i FROM story_phrase),
m AS (SELECT map_from_entries([{', '.join(f"('{k}', '{v}')" for k, v in _SUB_PATTERN.items())}]) AS t)
SELECT storyid, phraseindex, CAST(i - 1 AS INT) AS place, coalesce(regexp_matches(r[i + 1], array_to_string(list_transform(string_split(r[i], ''), lambda c: coalesce(t[c], c)), '')), false) AS matches FROM z, m WHERE r[i] IS NOT NULL AND r[i + 1] IS NOT NULL""")
def phoneme_sub_regex(spark, d):
    """Does the next phonetic word contain this one, up to substitutes?"""
    r = F.col("reference_phonemes")
    n = F.size(r) - 1
    pairs = F.arrays_zip(F.slice(r, F.lit(1), n).alias("a"), F.slice(r, F.lit(2), n).alias("b"))
    t = table(spark, d, "story_phrase").where(n > 0).select("storyid", "phraseindex", F.posexplode(pairs).alias("place", "p")).where("p.a IS NOT NULL AND p.b IS NOT NULL")
    return t.select("storyid", "phraseindex", "place", F.coalesce(S.phonetic_match(F.col("p.a"), F.col("p.b")), F.lit(False)).alias("matches"))


# ---- metrics, windows, alarms


@query("""SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, event_type, count(*) AS n, round(sum(value), 4) AS total, round(avg(value), 9) AS mean FROM events GROUP BY 1, 2""")
def tumbling_metrics(spark, d):
    return metrics.tumbling(table(spark, d, "events"), "ts", "1 hour", ["event_type"], "value")


@query("""WITH w AS (SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, count(*) FILTER (WHERE event_type = 'view') AS depth, count(*) FILTER (WHERE event_type = 'purchase') AS running, max(value) AS age FROM events GROUP BY 1)
SELECT window_start, CASE WHEN depth < 1 AND running < 1 THEN 1 ELSE 0 END AS idle, CASE WHEN depth < 10 AND age < 120 THEN 1 ELSE 0 END AS healthy FROM w""")
def metric_math(spark, d):
    t = table(spark, d, "events").groupBy(F.window("ts", "1 hour").alias("w")).agg(F.count_if(F.col("event_type") == "view").alias("depth"), F.count_if(F.col("event_type") == "purchase").alias("running"), F.max("value").alias("age"))
    return t.select(F.col("w.start").alias("window_start"), metrics.idle(F.col("depth"), F.col("running")).alias("idle"), metrics.healthy(F.col("depth"), F.col("age")).alias("healthy"))


_HOURS = """w AS (SELECT time_bucket(INTERVAL 1 HOUR, ts) AS h, count(*) FILTER (WHERE event_type = 'error') AS n FROM events GROUP BY 1),
sp AS (SELECT unnest(generate_series((SELECT min(h) FROM w), (SELECT max(h) FROM w), INTERVAL 1 HOUR)) AS h)"""


def _hours(spark, d):
    t = table(spark, d, "events").groupBy(F.window("ts", "1 hour").alias("w")).agg(F.count_if(F.col("event_type") == "error").alias("n"))
    return t.select(F.col("w.start").alias("window_start"), "n")


@query(f"""WITH {_HOURS}, b AS (SELECT sp.h, coalesce(n >= 2, false) AS breach FROM sp LEFT JOIN w USING (h))
SELECT h AS window_start, breach, bool_and(breach) OVER x AND count(*) OVER x = 3 AS alarm FROM b WINDOW x AS (ORDER BY h ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)""")
def consecutive_breach(spark, d):
    """An alarm after three breaching hours; an hour without samples does not breach."""
    return metrics.breaches(_hours(spark, d), "window_start", "1 hour", F.col("n") >= 2, 3, False)


@query(f"""WITH {_HOURS} SELECT h AS window_start, CASE WHEN n >= 8 THEN 2 WHEN n >= 3 THEN 1 ELSE 0 END AS step FROM w""")
def scaling_bands(spark, d):
    return _hours(spark, d).select("window_start", metrics.scale_step(F.col("n"), [(3, 1), (8, 2)]).alias("step"))


@query("""WITH w AS (SELECT time_bucket(INTERVAL 1 HOUR, ts) AS h, count(*) FILTER (WHERE event_type = 'error') >= 3 AS a, count(*) FILTER (WHERE event_type = 'view') >= 3 AS b, avg(value) > 60 AS c FROM events GROUP BY 1)
SELECT h AS window_start, a OR b OR c AS any_on, a::INT + b::INT + c::INT >= 2 AS two_on FROM w""")
def composite_alarm(spark, d):
    t = table(spark, d, "events").groupBy(F.window("ts", "1 hour").alias("w")).agg((F.count_if(F.col("event_type") == "error") >= 3).alias("a"), (F.count_if(F.col("event_type") == "view") >= 3).alias("b"), (F.avg("value") > 60).alias("c"))
    return t.select(F.col("w.start").alias("window_start"), (F.col("a") | F.col("b") | F.col("c")).alias("any_on"), metrics.two_of(F.col("a"), F.col("b"), F.col("c")).alias("two_on"))


@query("SELECT a.e AS a, b.e AS b FROM (SELECT DISTINCT event_type AS e FROM events) a JOIN (SELECT DISTINCT event_type AS e FROM events) b ON a.e < b.e ORDER BY 1, 2 LIMIT 10")
def alarm_pairs(spark, d):
    return metrics.pairs(table(spark, d, "events"), "event_type")


# ---- text, JSON, sets, limits


@query("""SELECT doc_id, regexp_replace(lower(text), '[.,?!:;()\\[\\]"''’“”]', '', 'g') AS plain FROM documents""")
def normalise_text(spark, d):
    return table(spark, d, "documents").select("doc_id", S.plain_phrase(F.col("text")).alias("plain"))


@query("SELECT segment_id, s3_uri[:-5] || '-pcm.raw' AS renamed, string_split(s3_uri, '/')[-1] AS base, string_split(s3_uri, '/')[3] AS bucket FROM segment_manifest")
def id_suffix_rewrite(spark, d):
    u = F.col("s3_uri")
    return table(spark, d, "segment_manifest").select("segment_id", F.concat(F.substring(u, F.lit(1), F.length(u) - 4), F.lit("-pcm.raw")).alias("renamed"), F.element_at(F.split(u, "/"), -1).alias("base"), F.parse_url(u, F.lit("HOST")).alias("bucket"))


@query("SELECT event_id, CAST(props->>'$.k' AS INT) AS k FROM events")
def json_extract(spark, d):
    return table(spark, d, "events").select("event_id", F.get_json_object("props", "$.k").cast("int").alias("k"))


@query("SELECT s_nationkey AS nationkey, 'both' AS side FROM (SELECT s_nationkey FROM supplier INTERSECT SELECT c_nationkey FROM customer) UNION ALL SELECT c_nationkey, 'customer' FROM (SELECT c_nationkey FROM customer EXCEPT SELECT s_nationkey FROM supplier)")
def set_ops(spark, d):
    s = table(spark, d, "supplier").select(F.col("s_nationkey").alias("nationkey"))
    c = table(spark, d, "customer").select(F.col("c_nationkey").alias("nationkey"))
    return s.intersect(c).withColumn("side", F.lit("both")).unionByName(c.exceptAll(s).distinct().subtract(s).withColumn("side", F.lit("customer")))


@query("SELECT storyid, phraseindex, len(list_distinct(list_concat(expected_text, list_filter(reference_phonemes, lambda x: x IS NOT NULL)))) AS n_union FROM story_phrase")
def array_union_size(spark, d):
    forms = F.coalesce(F.filter("reference_phonemes", lambda x: x.isNotNull()), F.array().cast("array<string>"))
    return table(spark, d, "story_phrase").select("storyid", "phraseindex", F.size(F.array_union("expected_text", forms)).cast("bigint").alias("n_union"))


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20")
def topk_limit(spark, d):
    """The 20 largest orders: a top-k, each task keeps its own 20."""
    return table(spark, d, "orders").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(20).select("o_orderkey", "o_totalprice")


@query("""SELECT delivery_id, "timestamp" FROM job_messages WHERE "timestamp" IS NOT NULL ORDER BY "timestamp", delivery_id LIMIT 25""")
def redrive_oldest(spark, d):
    return sinks.redrive(table(spark, d, "job_messages").where("timestamp IS NOT NULL"), 25).select("delivery_id", "timestamp")


# ---- sinks and streams


@query("""SELECT strftime(make_timestamp("timestamp" * 1000000), '%Y-%m-%d') AS dt, count(*) AS n, round(sum(CASE WHEN NOT isnan(processing_time) THEN processing_time ELSE 0 END), 6) AS total FROM activity_results GROUP BY 1""")
def partitioned_sink_roundtrip(spark, d):
    """Results written by day and read back with the day from the folder."""
    day = F.date_add(F.lit("1970-01-01").cast("date"), F.floor(F.col("timestamp") / 86400).cast("int"))
    path = shared_dir(spark, "results")
    t = table(spark, d, "activity_results").withColumn("dt", day.cast("string"))
    sinks.write_results(t.select("dt", F.coalesce(F.nanvl("processing_time", F.lit(0.0)), F.lit(0.0)).alias("processing_time"), "status"), path)
    back = spark.read.schema("processing_time double, status string, dt string").json(path)
    return back.groupBy("dt").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("processing_time"), 6).alias("total"))


@query("""WITH c AS (SELECT activity_id AS activityid, max_by(status, ("timestamp", status)) AS status FROM activity_results GROUP BY 1), t AS (SELECT activityid, max(studentid) AS studentid, max(status) AS status FROM activity_v GROUP BY 1)
SELECT coalesce(t.activityid, c.activityid) AS activityid, t.studentid, coalesce(c.status, t.status) AS status FROM t FULL JOIN c USING (activityid)""")
def upsert_status(spark, d):
    """The status of activities set by their latest result."""
    t = table(spark, d, "activity_v").groupBy("activityid").agg(F.max("studentid").alias("studentid"), F.max("status").alias("status"))
    c = table(spark, d, "activity_results").groupBy(F.col("activity_id").alias("activityid")).agg(F.max_by("status", F.struct("timestamp", "status")).alias("status"))
    return sinks.upserted(t, c, "activityid")


def _documents(spark, d):
    t = _timed(spark, d).withColumnRenamed("end_time", "page_end")
    return sinks.timing_documents(t.drop("tokens"), align.phrase_timings(t.where(F.size("tokens") > 0)))


@query("SELECT activity_id, CAST(count(*) AS BIGINT) AS n_pages FROM (SELECT DISTINCT activity_id, page_index FROM page_data WHERE activity_id IS NOT NULL AND page_index IS NOT NULL) GROUP BY 1")
def timing_documents(spark, d):
    """The pages in the JSON document of each activity, counted after parsing it again; timing_document_rows gives them whole."""
    pages = F.from_json("timing", "pages array<struct<page_start:int>>")["pages"]
    return _documents(spark, d).select("activity_id", F.size(pages).cast("bigint").alias("n_pages"))


@query(align_sql.DOCUMENT_ROWS)
def timing_document_rows(spark, d):
    """The documents parsed again: a row for each phrase of every page, and one for a page without phrases."""
    pages = F.from_json("timing", "pages array<struct<page_index:int,page_start:int,page_end:int,phrases:array<struct<phrase_idx:int,start:int,end:int,parsed:string,phrase_text:string>>>>")["pages"]
    t = _documents(spark, d).select("activity_id", F.inline(pages))
    return t.select("activity_id", "page_index", "page_start", "page_end", F.inline_outer("phrases"))


@query("SELECT DISTINCT activity_id FROM job_messages WHERE activity_id IS NOT NULL")
def id_export(spark, d):
    path = shared_dir(spark, "ids")
    sinks.write_ids(table(spark, d, "job_messages"), "activity_id", path)
    return spark.read.schema("activity_id string").option("header", True).option("multiLine", True).option("nullValue", "\\N").csv(path)


@query("SELECT segment_id, start_ms, end_ms FROM segment_manifest WHERE end_ms > start_ms")
def slice_export_plan(spark, d):
    return sinks.export_plan(table(spark, d, "segment_manifest")).select("segment_id", "start_ms", "end_ms")


@query("""SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, event_type, count(*) AS n, round(sum(value), 4) AS total, round(avg(value), 9) AS mean FROM events GROUP BY 1, 2""")
def stream_tumbling_equals_batch(spark, d):
    """The same windows from a stream."""
    t = queue.stream_tumbling(spark, f"{d}/events.parquet", "ts", "1 hour", ["event_type"], "value", "40 days")
    return t.withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


@query("""SELECT CASE WHEN activity_id IS NULL OR trim(regexp_replace(activity_id, '\\s', '', 'g')) = '' THEN 'no activity' ELSE 'good' END AS kind, count(*) AS n FROM job_messages GROUP BY 1""")
def dlq_split(spark, d):
    """Messages as a stream of JSON; bad ones go to the reject table."""
    base = shared_dir(spark, "queue")
    body = F.to_json(F.struct("activity_id", "story_id", "student_id", F.col("created_at").cast("string").alias("created_at"), "source", "timestamp"))
    raw = queue.file_stream(spark, f"{d}/job_messages.parquet").select(body.alias("value"))
    queue.consume(raw, f"{base}/good", f"{base}/bad", f"{base}/state").awaitTermination()
    good = spark.read.schema(readers.JOB).parquet(f"{base}/good").select(F.lit("good").alias("kind"))
    bad = spark.read.schema("value string, reason string").parquet(f"{base}/bad").select(F.col("reason").alias("kind"))
    return good.unionByName(bad).groupBy("kind").agg(F.count(F.lit(1)).alias("n"))


# ---- further operators of the survey


@query(f"""SELECT {STORY} AS story, phraseindex, len(expected_text) AS n_words, CAST(row_number() OVER (PARTITION BY {STORY} ORDER BY phraseindex, len(expected_text)) - 1 AS INT) AS place FROM story_phrase""")
def columnar_pivot(spark, d):
    """Grouped lists turned back into rows."""
    item = F.struct("phraseindex", F.size("expected_text").alias("n"))
    g = table(spark, d, "story_phrase").groupBy(folded(F.col("storyid")).alias("story")).agg(F.array_sort(F.collect_list(item)).alias("l"))
    g = g.select("story", F.transform("l", lambda x: x["phraseindex"]).alias("i"), F.transform("l", lambda x: x["n"]).alias("n"))
    return g.select("story", F.posexplode(F.arrays_zip("i", "n")).alias("place", "x")).select("story", F.col("x.i").alias("phraseindex"), F.col("x.n").cast("bigint").alias("n_words"), "place")


@query("""SELECT delivery_id, coalesce(a.studentid, j.student_id) AS student_id FROM job_messages j LEFT JOIN (SELECT activityid, max(studentid) AS studentid FROM activity_v GROUP BY 1) a ON a.activityid = j.activity_id""")
def lookup_fallback(spark, d):
    """A value from a table of known activities, else from the message."""
    known = table(spark, d, "activity_v").groupBy(F.col("activityid").alias("activity_id")).agg(F.max("studentid").alias("student_id"))
    return joins.with_fallback(table(spark, d, "job_messages").select("delivery_id", "activity_id", "student_id"), known, "activity_id", "student_id").select("delivery_id", "student_id")


@query("""SELECT activityid AS activity_id, status FROM activity_v WHERE activityid NOT IN (SELECT activity_id FROM activity_results WHERE activity_id IS NOT NULL)""")
def skip_existing(spark, d):
    rows = table(spark, d, "activity_v").select(F.col("activityid").alias("activity_id"), "status")
    return joins.not_done(rows, table(spark, d, "activity_results"), "activity_id")


def _dictionary(spark, d):
    """word, phonemes: the words of the stories with a phonetic form, the least of several."""
    n = F.least(F.size("expected_text"), F.size("reference_phonemes"))
    z = table(spark, d, "story_phrase").where(n >= 0).select(F.explode(F.arrays_zip(F.slice("expected_text", F.lit(1), n).alias("word"), F.slice("reference_phonemes", F.lit(1), n).alias("p"))).alias("x"))
    return z.groupBy("x.word").agg(F.min("x.p").alias("phonemes")).where("phonemes IS NOT NULL")


def _known(spark, d, dictionary):
    w = table(spark, d, "page_data").where(F.size("phrases") > 0).select("activity_id", "page_index", F.explode(F.split(F.array_join("phrases", " "), " ")).alias("word"))
    return joins.spoken_forms(w, dictionary).groupBy("activity_id", "page_index").agg(F.count(F.lit(1)).alias("n_words"), F.count("phonemes").alias("n_known"))


@query("""WITH z AS (SELECT expected_text, reference_phonemes, unnest(generate_series(1, least(len(expected_text), len(reference_phonemes)))) AS i FROM story_phrase WHERE expected_text IS NOT NULL AND reference_phonemes IS NOT NULL),
dict AS (SELECT expected_text[i] AS word, min(reference_phonemes[i]) AS phonemes FROM z GROUP BY 1 HAVING min(reference_phonemes[i]) IS NOT NULL),
w AS (SELECT activity_id, page_index, unnest(string_split(array_to_string(phrases, ' '), ' ')) AS word FROM page_data WHERE len(phrases) > 0)
SELECT activity_id, page_index, count(*) AS n_words, count(phonemes) AS n_known FROM w LEFT JOIN dict USING (word) GROUP BY 1, 2""")
def dictionary_join(spark, d):
    """Words of pages with their phonetic forms; unknown words count as words only."""
    return _known(spark, d, _dictionary(spark, d))


@query(f"""SELECT activityid, count(ms) AS n, round(sum(ms) / greatest(1, count(ms)), 6) AS mean_ms, round(sum(b) / 1e6 / greatest(0.001, sum(ms) / 1000), 9) AS mb_per_s
FROM (SELECT activityid, end_ms - start_ms AS ms, (end_ms - start_ms) * 32 AS b FROM segment_manifest) GROUP BY 1""")
def transfer_stats(spark, d):
    ms = F.col("end_ms") - F.col("start_ms")
    return metrics.transfer_stats(table(spark, d, "segment_manifest"), ["activityid"], ms, ms * 32)


@query("SELECT activity_id, CAST(sum(coalesce(len(phrases), 0)) AS BIGINT) AS n_aligned FROM page_data GROUP BY 1")
def total_aligned(spark, d):
    return table(spark, d, "page_data").groupBy("activity_id").agg(F.sum(F.coalesce(F.size("phrases"), F.lit(0))).alias("n_aligned"))


@query("SELECT segment_id, CASE WHEN coalesce((end_ms - start_ms) * 16, 0) <= 0 THEN 'empty' WHEN (end_ms - start_ms) * 16 > 100000 THEN 'long' WHEN (end_ms - start_ms) * 16 < 32000 THEN 'short' ELSE 'ok' END AS guard FROM segment_manifest")
def length_guards(spark, d):
    """Samples of a segment at 16 kHz within bounds."""
    n = (F.col("end_ms") - F.col("start_ms")) * 16
    return table(spark, d, "segment_manifest").select("segment_id", select.length_guard(n, 32_000, 100_000).alias("guard"))


@query("""SELECT storyid, phraseindex, CASE WHEN list_contains(expected_text, 'the') THEN 'general' WHEN list_contains(expected_text, 'because') THEN 'partner' ELSE 'error' END AS route FROM story_phrase""")
def tag_routes(spark, d):
    """Routing by tags, in order of precedence."""
    return table(spark, d, "story_phrase").select("storyid", "phraseindex", select.route("expected_text", "the", "because").alias("route"))


@query("""WITH r AS (SELECT time_bucket(INTERVAL 1 HOUR, make_timestamp("timestamp" * 1000000)) AS window_start, status = 'processed' AS ok, CASE WHEN NOT isnan(processing_time) AND processing_time >= 0 THEN processing_time END AS t, 0 AS rej FROM activity_results
 UNION ALL SELECT time_bucket(INTERVAL 1 HOUR, received_at), NULL, NULL, 1 FROM job_messages WHERE received_at IS NOT NULL AND (activity_id IS NULL OR trim(regexp_replace(activity_id, '\\s', '', 'g')) = ''))
SELECT window_start, count(*) AS n_enqueued, count(*) FILTER (WHERE ok) AS n_completed, count(*) FILTER (WHERE NOT ok OR (ok IS NULL AND rej = 0)) AS n_failed, CAST(sum(rej) AS BIGINT) AS n_rejected, round(avg(t), 10) AS mean_s FROM r GROUP BY 1""")
def hourly_summary(spark, d):
    """Job summaries per hour, with the messages that were rejected (without an activity)."""
    t = table(spark, d, "activity_results").select(F.timestamp_seconds("timestamp").alias("ts"), (F.col("status") == "processed").alias("ok"), metrics.measured("processing_time").alias("seconds"))
    m = table(spark, d, "job_messages").where(~F.coalesce(F.col("activity_id").rlike(r"(?U)\S"), F.lit(False)) & F.col("received_at").isNotNull())
    at = F.convert_timezone(F.lit("UTC"), F.current_timezone(), F.col("received_at").cast("timestamp_ntz")).cast("timestamp")
    # the hour in UTC, whatever the session's time zone
    start = F.convert_timezone(F.current_timezone(), F.lit("UTC"), F.col("window_start").cast("timestamp_ntz"))
    return metrics.job_summary(t, m.select(at.alias("ts")), "ts", "1 hour").withColumn("window_start", start)


@query("SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, count(*) AS n, round(quantile_cont(value, 0.95), 6) AS q FROM events GROUP BY 1")
def window_p95(spark, d):
    return metrics.window_quantile(table(spark, d, "events"), "ts", "1 hour", "value", 0.95)


@query(f"WITH {_HOURS} SELECT h AS window_start, CAST(least(greatest(ceil(n * 4 / 3.0), 1), 10) AS INT) AS workers FROM w")
def target_tracking(spark, d):
    return _hours(spark, d).select("window_start", metrics.to_target(F.col("n"), 3.0, 4, 1, 10).alias("workers"))


@query("""WITH r AS (SELECT strftime(make_timestamp("timestamp" * 1000000), '%Y-%m-%d') AS day, status = 'processed' AS ok FROM activity_results), s AS (SELECT day, count(*) AS n, count(*) FILTER (WHERE ok) AS k FROM r GROUP BY 1)
SELECT day, day || ' ' || k || '/' || n || ' ' || format('{:.1f}', round(k / n, 6) * 100) || '% ' || CASE WHEN k / n >= 0.95 THEN 'excellent' WHEN k / n >= 0.9 THEN 'good' WHEN k / n >= 0.8 THEN 'fair' ELSE 'poor' END AS text FROM s""")
def notification_text(spark, d):
    return sinks.summary_text(batch_summary(spark, d), "day")


@query("""SELECT j.delivery_id, r.n AS n_results FROM job_messages j JOIN (SELECT correlation_id, activity_id, count(*) AS n FROM activity_results WHERE correlation_id IS NOT NULL GROUP BY 1, 2) r ON r.activity_id = j.activity_id""")
def correlated_results(spark, d):
    """Messages with the results that carry a correlation id of their activity."""
    r = table(spark, d, "activity_results").where("correlation_id IS NOT NULL").groupBy("correlation_id", "activity_id").agg(F.count(F.lit(1)).alias("n_results"))
    return skew_join(table(spark, d, "job_messages").select("delivery_id", "activity_id"), r, ["activity_id"]).select("delivery_id", "n_results")


@query()
def sampled_metrics(spark, d):
    """A fixed tenth of the metric samples: sampling is the feature."""
    return select.sampled(table(spark, d, "events"), "event_id", 100)


@query("""WITH v AS (SELECT vec_id, embedding AS e, len(embedding) AS n FROM embeddings), p AS (SELECT vec_id, e, n, k, k * (n - 1) / 23.0 AS pt FROM v, generate_series(0, 23) g(k))
SELECT vec_id, CAST(k AS INT) AS place, round(CAST(e[CAST(floor(pt) AS INT) + 1] AS DOUBLE) + (pt - floor(pt)) * (CAST(e[CAST(least(floor(pt) + 1, n - 1) AS INT) + 1] AS DOUBLE) - CAST(e[CAST(floor(pt) AS INT) + 1] AS DOUBLE)), 5) + 0 AS x FROM p WHERE n > 0""")
def resampled_vectors(spark, d):
    """Vectors interpolated to another length, all places."""
    t = table(spark, d, "embeddings").select("vec_id", F.posexplode(S.resample(F.col("embedding"), 24)).alias("place", "x"))
    return t.select("vec_id", "place", (F.round("x", 5) + 0).alias("x"))


@query(f"""WITH o AS (SELECT {STORY} AS story, phraseindex, max(expected_text) AS w FROM story_phrase WHERE phraseindex IS NOT NULL AND expected_text IS NOT NULL GROUP BY 1, 2)
SELECT o.story, o.phraseindex, array_to_string(list_concat(list_concat(coalesce(a.w[-2:], []), o.w), coalesce(b.w[1:2], [])), ' ') AS text FROM o LEFT JOIN o a ON a.story = o.story AND a.phraseindex = o.phraseindex - 1 LEFT JOIN o b ON b.story = o.story AND b.phraseindex = o.phraseindex + 1""")
def padded_phrases(spark, d):
    """A phrase with the end of the one before and the head of the one after."""
    t = table(spark, d, "story_phrase").where(F.col("expected_text").isNotNull()).select(folded(F.col("storyid")).alias("story"), "phraseindex", F.col("expected_text").alias("w"))
    n = joins.neighbours(t, ["story"], "phraseindex", "w")
    return n.select("story", "phraseindex", F.array_join(S.head_tail(F.col("previous"), F.col("w"), F.col("following"), 2), " ").alias("text"))


@query("SELECT phraseindex AS \"phraseIndex\", activityid AS \"activityId\", start_ms, end_ms, s3_uri FROM segment_manifest")
def manifest_roundtrip(spark, d):
    """Segment rows written as a JSON manifest and read back."""
    path = shared_dir(spark, "manifest")
    t = table(spark, d, "segment_manifest").withColumnsRenamed({"activityid": "activityId", "phraseindex": "phraseIndex"})
    sinks.write_manifest(t, path)
    return readers.read_manifest(spark, path).select("activityId", "phraseIndex", "start_ms", "end_ms", "s3_uri")


@query("SELECT s3_uri AS key, CASE WHEN end_ms IS NOT NULL THEN 'wav' END AS kind FROM segment_manifest")
def object_heads(spark, d):
    """Objects with the metadata that was fetched for some of them."""
    t = table(spark, d, "segment_manifest")
    listing = t.select(F.col("segment_id").alias("key"), F.col("s3_uri").alias("uri"))
    heads = t.where("end_ms IS NOT NULL").select(F.col("segment_id").alias("key"), F.lit("wav").alias("kind"))
    return joins.with_heads(listing, heads).select(F.col("uri").alias("key"), "kind")
