"""References to records that are not there: orphans per table and month.

A broadcast Bloom filter of the parent keys proves most orphans without a join;
only references that pass the filter are verified by an exact join, and the
report aggregates the outcome. References of several kinds are answered together:
one filter, one spread and one exact join serve all of them.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadenza.functions.text import folded, nonblank
from cadenza.plans.skew import HOT_ROWS, skew_join, spread
from cadenza.session import written

#: Bits of a filter at most (32 MB): what is broadcast is bounded whatever the number of keys. With more keys the
#: filter lets more references through to the exact join; the result stays the same.
MAX_BITS = 1 << 28


@dataclass
class KeyFilter:
    """A Bloom filter of keys, tested inside generated code."""

    data: bytes | None

    @classmethod
    def of(cls, keys: DataFrame, key: str, fpp: float = 0.01, max_bits: int = MAX_BITS) -> KeyFilter:
        """keys: distinct or nearly, since their number sizes the filter; each task fills its own and the filters are merged in a tree."""
        spark = keys.sparkSession
        hashed = keys.select(F.xxhash64(key).alias("h"))
        n = keys.count()
        if not n:
            return cls(None)
        bits = min(max_bits, max(1024, int(n * 9.6 * 1.1)))
        bloom = hashed._jdf.stat().bloomFilter("h", n, bits)
        out = spark._jvm.java.io.ByteArrayOutputStream()
        bloom.writeTo(out)
        return cls(bytes(out.toByteArray()))

    def may_hold(self, df: DataFrame, key: Column) -> Column:
        """False only where no parent has this key."""
        if self.data is None:
            return F.lit(False)
        spark = df.sparkSession
        jvm = spark._jvm
        utils = jvm.org.apache.spark.sql.classic.ExpressionUtils
        test = jvm.org.apache.spark.sql.catalyst.expressions.BloomFilterMightContain
        return Column(utils.column(test(utils.expression(F.lit(self.data)._jc), utils.expression(F.xxhash64(key)._jc))))


def orphans(refs: DataFrame, parents: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """The rows of refs (any columns, with ``key`` string and ``at`` timestamp) whose target is not there, with ``state``.

    parents: ``key``, ``begins``, ``ends`` (null: for ever), repeated rows allowed;
    a row is there from begins on and until just before ends. A null begins is
    never there, but its key exists. state is 'missing' if no row has the key,
    'late' if all rows with it begin after ``at``, otherwise 'deleted'. References
    with a null key or a null time refer to nothing.
    Empty refs give an empty result; without parents all refs are missing. A
    column of refs called state is replaced. Hot keys are spread over tasks.

    The lives of the parents and the filtered references are written to the
    shared folder once: the filter, the search for hot keys and the exact join
    read them from there.
    """
    life = written(parents.where(F.col("key").isNotNull()).select("key", F.col("begins").alias("_begins"), F.col("ends").alias("_ends")).distinct(), "lives")
    asked = refs.where(F.col("key").isNotNull() & F.col("at").isNotNull())
    bloom = KeyFilter.of(life, "key")
    # one pass decides; the two branches are columns of the same rows
    asked = written(asked.withColumn("_may", bloom.may_hold(asked, F.col("key"))), "references")
    definite = asked.where("NOT _may").withColumn("state", F.lit("missing"))
    first = life.groupBy("key").agg(F.min("_begins").alias("_first"), F.lit(True).alias("_known"))
    left, (first, lives), on = spread(asked.where("_may"), [first, life], ["key"], hot_rows)
    # both joins are on the same columns: the references are shuffled once
    told = left.join(first, on, "left")
    same = F.lit(True)
    for k in on:
        same = same & (told[k] == lives[k])
    there = (F.col("_begins") <= F.col("at")) & (F.col("_ends").isNull() | (F.col("at") < F.col("_ends")))
    state = F.when(F.col("_known").isNull(), "missing").when(F.col("_first") <= F.col("at"), "deleted").otherwise("late")
    checked = told.join(lives, same & there, "left_anti").withColumn("state", state).drop("_salt", "_known", "_first")
    return definite.drop("_may").unionByName(checked.drop("_may"))


def _pair(story: Column, phrase: Column) -> Column:
    """One key string of a story and a phrase index; null if either is null."""
    return F.concat(phrase.cast("bigint").cast("string"), F.lit("/"), story)


def found(activity_v: DataFrame, segment_manifest: DataFrame, story_phrase: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """(ref_table, ref_id, target, state, period) for each reference whose target is not there at its time.

    An activity's time is its earliest createdat and its story the one of its
    first row that names one. Repeated activities count once; repeated segments
    have ids of their own and count each.

    The three kinds of reference are rows of one table, told apart by the first
    letter of their key: s of an activity to its story, a of a segment to its
    activity, p of a segment to its phrase.
    """
    story = nonblank(folded(F.col("storyid")))
    rows = activity_v.where(F.col("activityid").isNotNull()).select(F.col("activityid").alias("act"), "createdat", story.alias("story"))
    first = F.min(F.when(F.col("story").isNotNull(), F.struct("createdat", "story"))).getField("story")
    # read by the references, the parents and the join: written once
    acts = written(rows.groupBy("act").agg(F.min("createdat").alias("createdat"), first.alias("story")), "activities")
    at = dict(acts.dtypes)["createdat"]
    ref = lambda kind, key, ref_id, when: F.struct(F.lit(kind).alias("kind"), F.concat(F.lit(kind), key).alias("key"), ref_id.cast("string").alias("ref_id"), when.cast(at).alias("at"))
    of_acts = acts.select(ref("s", F.col("story"), F.col("act"), F.col("createdat")).alias("r")).select("r.*")
    segs = segment_manifest.select("segment_id", F.col("activityid").alias("act"), "phraseindex", "created_at")
    told = skew_join(segs, acts.select("act", "story"), ["act"], "left", hot_rows)
    # an unknown activity or story has no phrases to refer to: its key is null
    both = F.array(ref("a", F.col("act"), F.col("segment_id"), F.col("created_at")), ref("p", _pair(F.col("story"), F.col("phraseindex")), F.col("segment_id"), F.col("created_at")))
    refs = of_acts.unionByName(told.select(F.inline(both)))
    until = F.lit(None).cast(at)
    life = lambda kind, key, begins, ends: F.struct(F.concat(F.lit(kind), key).alias("key"), begins.cast(at).alias("begins"), ends.cast(at).alias("ends"))
    phrases = F.array(life("s", story, F.col("loaded_at"), F.col("deleted_at")), life("p", _pair(story, F.col("phraseindex")), F.col("loaded_at"), F.col("deleted_at")))
    parents = acts.select(life("a", F.col("act"), F.col("createdat"), until).alias("r")).select("r.*").unionByName(story_phrase.select(F.inline(phrases)))
    lost = orphans(refs, parents, hot_rows)
    table = F.when(F.col("kind") == "s", "activity_v").otherwise("segment_manifest")
    target = F.when(F.col("kind") == "a", "activity_v").otherwise("story_phrase")
    return lost.select(table.alias("ref_table"), "ref_id", target.alias("target"), "state", F.substring(F.col("at").cast("string"), 1, 7).alias("period"))


def report(found_rows: DataFrame) -> DataFrame:
    """Orphans per table, target, state and month."""
    return found_rows.groupBy("ref_table", "target", "state", "period").agg(F.count(F.lit(1)).alias("n_orphans"))


FOUND_SQL = r"""
WITH p AS (
  SELECT lower(regexp_replace(storyid, '^[\s\p{Z}]+|[\s\p{Z}]+$', '', 'g')) AS sid, phraseindex, loaded_at, deleted_at FROM story_phrase),
a AS (
  SELECT activityid, min(createdat) AS t,
         min_by(sid, createdat) FILTER (WHERE sid <> '') AS sid
  FROM (SELECT activityid, createdat, lower(regexp_replace(storyid, '^[\s\p{Z}]+|[\s\p{Z}]+$', '', 'g')) AS sid FROM activity_v)
  GROUP BY activityid),
s1 AS (
  SELECT a.activityid, a.t, count(p.sid) AS n, min(p.loaded_at) AS f,
         count(*) FILTER (WHERE p.loaded_at <= a.t AND (p.deleted_at IS NULL OR a.t < p.deleted_at)) AS ok
  FROM a LEFT JOIN p ON p.sid = a.sid WHERE a.sid IS NOT NULL GROUP BY a.activityid, a.t),
s3 AS (
  SELECT s.segment_id, s.created_at AS t, count(p.sid) AS n, min(p.loaded_at) AS f,
         count(*) FILTER (WHERE p.loaded_at <= s.created_at AND (p.deleted_at IS NULL OR s.created_at < p.deleted_at)) AS ok
  FROM segment_manifest s JOIN a ON a.activityid = s.activityid
  LEFT JOIN p ON p.sid = a.sid AND p.phraseindex = s.phraseindex
  WHERE a.sid IS NOT NULL AND s.phraseindex IS NOT NULL GROUP BY s.segment_id, s.created_at)
SELECT 'activity_v' AS ref_table, activityid AS ref_id, 'story_phrase' AS target,
       CASE WHEN n = 0 THEN 'missing' WHEN f > t THEN 'late' ELSE 'deleted' END AS state, strftime(t, '%Y-%m') AS period FROM s1 WHERE ok = 0
UNION ALL
SELECT 'segment_manifest', CAST(segment_id AS VARCHAR), 'activity_v', CASE WHEN a.activityid IS NULL THEN 'missing' ELSE 'late' END, strftime(s.created_at, '%Y-%m')
FROM segment_manifest s LEFT JOIN a ON a.activityid = s.activityid WHERE s.activityid IS NOT NULL AND (a.activityid IS NULL OR a.t > s.created_at)
UNION ALL
SELECT 'segment_manifest', CAST(segment_id AS VARCHAR), 'story_phrase',
       CASE WHEN n = 0 THEN 'missing' WHEN f > t THEN 'late' ELSE 'deleted' END, strftime(t, '%Y-%m') FROM s3 WHERE ok = 0
"""

REPORT_SQL = f"SELECT ref_table, target, state, period, count(*) AS n_orphans FROM ({FOUND_SQL}) GROUP BY ALL"
