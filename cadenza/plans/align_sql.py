"""SQL of the alignment operators, for checking them: dynamic programs as recursive queries, one step a row."""

from __future__ import annotations

from cadenza.functions.lookups import ACCEPTED, ELEMENTS, SUBSTITUTES


def common_places(source: str) -> str:
    """CTEs src (id, a, b and what source has besides) and hits (id, i, j): the places, from 0, of a longest common subsequence.

    best[i][j] is the length for what is left from i and j on; the rows of the
    table come from the last to the first, each from maxima of the one below.
    """
    return f"""WITH RECURSIVE src AS (SELECT row_number() OVER () AS id, * FROM ({source})),
dp AS (SELECT id, CAST(len(a) AS INT) AS i, list_transform(range(len(b) + 1), lambda x: 0) AS line FROM src
 UNION ALL SELECT id, i - 1, list_transform(range(len(c)), lambda j: list_max(c[j + 1:])) FROM (
  SELECT dp.id, dp.i, list_append(list_transform(range(len(b)), lambda k: CASE WHEN b[k + 1] = a[dp.i] THEN line[k + 2] + 1 ELSE line[k + 1] END), 0) AS c FROM dp JOIN src ON src.id = dp.id WHERE dp.i > 0)),
mat AS (SELECT id, list(line ORDER BY i) AS best FROM dp GROUP BY id),
walk AS (SELECT id, 0 AS i, 0 AS j, -1 AS hi, -1 AS hj FROM src
 UNION ALL SELECT id, CASE WHEN eq OR down THEN i + 1 ELSE i END, CASE WHEN eq OR NOT down THEN j + 1 ELSE j END, CASE WHEN eq THEN i ELSE -1 END, CASE WHEN eq THEN j ELSE -1 END FROM (
  SELECT w.id, w.i, w.j, a[w.i + 1] = b[w.j + 1] AS eq, best[w.i + 2][w.j + 1] >= best[w.i + 1][w.j + 2] AS down
  FROM walk w JOIN src ON src.id = w.id JOIN mat ON mat.id = w.id WHERE w.i < len(a) AND w.j < len(b))),
hits AS (SELECT id, hi AS i, hj AS j FROM walk WHERE hi >= 0)"""


#: The words of a page's phrases (a) and those the recogniser put on the page, in time order (b).
PAGE_WORDS = r"""WITH w AS (SELECT activity_id, page_index, list(word ORDER BY start, "end", word_id) AS t FROM word_items WHERE activity_id IS NOT NULL AND page_index IS NOT NULL AND start IS NOT NULL AND "end" IS NOT NULL GROUP BY 1, 2),
p AS (SELECT activity_id, page_index, max(phrases) AS phrases FROM page_data WHERE activity_id IS NOT NULL AND page_index IS NOT NULL GROUP BY 1, 2)
SELECT activity_id, page_index, list_filter(string_split_regex(coalesce(array_to_string(phrases, ' '), ''), '\s+'), lambda x: x <> '') AS a, list_filter(string_split_regex(array_to_string(t, ' '), '\s+'), lambda x: x <> '') AS b FROM p JOIN w USING (activity_id, page_index)"""

WORD_MATCH = (
    common_places(PAGE_WORDS)
    + """ SELECT activity_id, page_index, coalesce(list_aggregate(list_transform(generate_series(1, len(a)), lambda k: CASE WHEN list_contains(h, k - 1) THEN '1' ELSE '0' END), 'string_agg', ''), '') AS matches
FROM src LEFT JOIN (SELECT id, list(i) AS h FROM hits GROUP BY id) USING (id)"""
)

#: Phrases with a second, altered reading; what is heard is made as in the query.
HEARD = """SELECT storyid, phraseindex, e, r AS a, list_transform(list_filter(list_zip(list_transform(generate_series(1, len(r)), lambda k: CASE WHEN (k - 1 + phraseindex) % 5 = 4 THEN 'ɛ' ELSE r[k] END), generate_series(1, len(r))), lambda x: (x[2] - 1 + phraseindex) % 7 <> 3), lambda x: x[1]) AS b
FROM (SELECT storyid, phraseindex, expected_text AS e, coalesce(list_transform(reference_phonemes, lambda x: coalesce(x, '')), []) AS r FROM story_phrase WHERE expected_text IS NOT NULL)"""

_ACCEPTED = ", ".join(f"('{k}', '{v}')" for k, vs in ACCEPTED.items() for v in vs)
DIFF = (
    common_places(HEARD)
    + f""", ends AS (SELECT id, i, j FROM hits UNION ALL SELECT id, len(a), len(b) FROM src),
cuts AS (SELECT id, i AS i1, j AS j1, coalesce(lag(i) OVER w + 1, 0) AS i0, coalesce(lag(j) OVER w + 1, 0) AS j0 FROM ends WINDOW w AS (PARTITION BY id ORDER BY i, j)),
entry AS (SELECT src.id, i0, i1, j0, j1, e, a, b, unnest(generate_series(0, greatest(i1 - i0, j1 - j0) - CASE WHEN j1 < len(b) THEN 0 ELSE 1 END)) AS k FROM cuts JOIN src USING (id)),
told AS (SELECT id, i0, j0, k, len(e) AS n, k = greatest(i1 - i0, j1 - j0) AS anchor, k < i1 - i0 AS asked, CASE WHEN k = greatest(i1 - i0, j1 - j0) THEN j1 WHEN k < j1 - j0 THEN j0 + k END AS at_h, CASE WHEN k < i1 - i0 THEN i0 + k ELSE i1 END AS at_i, e, a, b FROM entry),
judged AS (SELECT *, b[at_h + 1] AS h, 0.5 + (at_h % 10) / 20.0 AS c, NOT coalesce((CASE WHEN at_i < len(e) THEN e[at_i + 1] WHEN at_i < len(a) THEN a[at_i + 1] ELSE '' END, b[at_h + 1]) IN (VALUES {_ACCEPTED}), false) AS wrong FROM told),
rows_ AS (SELECT id, n, row_number() OVER (PARTITION BY id ORDER BY i0, j0, k) AS place, CASE WHEN at_h IS NULL OR (asked AND NOT anchor AND wrong) THEN '-' ELSE h END AS ph,
 CASE WHEN anchor THEN false WHEN at_h IS NULL THEN true ELSE wrong END AS er, CASE WHEN anchor THEN c WHEN at_h IS NULL OR (asked AND wrong) THEN 0 WHEN wrong THEN c * 0.5 ELSE c END AS c FROM judged),
got AS (SELECT id, list(ph ORDER BY place) AS p, list(er ORDER BY place) AS r, list(c ORDER BY place) AS c FROM rows_ WHERE place <= n GROUP BY id),
easy AS (SELECT id, a = b AS same, least(len(e), len(b)) AS m FROM src)
SELECT storyid, phraseindex,
 coalesce(list_aggregate(list_transform(generate_series(1, len(e)), lambda k: CASE WHEN same THEN CASE WHEN k <= m THEN b[k] ELSE '-' END ELSE coalesce(p[k], '-') END), 'string_agg', ' '), '') AS phonemes,
 coalesce(list_aggregate(list_transform(generate_series(1, len(e)), lambda k: CASE WHEN CASE WHEN same THEN k > m ELSE coalesce(r[k], true) END THEN '1' ELSE '0' END), 'string_agg', ''), '') AS errors,
 round(coalesce(list_sum(list_transform(generate_series(1, len(e)), lambda k: CASE WHEN same THEN CASE WHEN k <= m THEN 0.5 + ((k - 1) % 10) / 20.0 ELSE 0 END ELSE coalesce(got.c[k], 0) END)), 0), 6) AS sure
FROM src JOIN easy USING (id) LEFT JOIN got USING (id)"""
)

_SUBS = ", ".join(f"('{k}', '[{k}{''.join(v)}]')" for k, v in SUBSTITUTES.items())
SOUND = f"""WITH RECURSIVE src AS (SELECT row_number() OVER () AS id, storyid, phraseindex, list_filter(a, lambda x: x <> '') AS a, list_filter(b, lambda x: x <> '') AS b FROM ({HEARD})),
forms AS (SELECT map_from_entries([{_SUBS}]) AS t),
fit AS (SELECT id, list_transform(a, lambda w: list_transform(b, lambda h: regexp_matches(h, list_aggregate(list_transform(string_split(w, ''), lambda c: coalesce(t[c], c)), 'string_agg', '')))) AS one,
 list_transform(a, lambda w: list_transform(range(1, len(b)), lambda j: regexp_matches(b[j] || b[j + 1], list_aggregate(list_transform(string_split(w, ''), lambda c: coalesce(t[c], c)), 'string_agg', '')))) AS two FROM src, forms),
dp AS (SELECT id, 0 AS i, range(len(b) + 1) AS line FROM src
 UNION ALL SELECT id, i + 1, list_transform(range(len(c)), lambda j: list_min(list_transform(range(j + 1), lambda k: c[k + 1] + j - k))) FROM (
  SELECT dp.id, dp.i, list_transform(range(len(b) + 1), lambda j: least(line[j + 1] + 1, CASE WHEN j >= 1 THEN line[j] + CASE WHEN one[dp.i + 1][j] THEN 0 ELSE 1 END END, CASE WHEN j >= 2 AND two[dp.i + 1][j - 1] THEN line[j - 1] END)) AS c
  FROM dp JOIN src ON src.id = dp.id JOIN fit ON fit.id = dp.id WHERE dp.i < len(a))),
mat AS (SELECT id, list(line ORDER BY i) AS cost FROM dp GROUP BY id),
walk AS (SELECT id, CAST(len(a) AS INT) AS i, CAST(len(b) AS INT) AS j, -1 AS hit FROM src
 UNION ALL SELECT id, CASE WHEN way < 3 THEN i - 1 ELSE i END, CASE way WHEN 0 THEN j - 1 WHEN 1 THEN j - 2 WHEN 2 THEN j ELSE j - 1 END, CASE WHEN way = 1 OR (way = 0 AND same) THEN i - 1 ELSE -1 END FROM (
  SELECT w.id, w.i, w.j, coalesce(one[w.i][w.j], false) AS same, CASE WHEN w.i > 0 AND w.j > 0 AND cost[w.i + 1][w.j + 1] = cost[w.i][w.j] + CASE WHEN one[w.i][w.j] THEN 0 ELSE 1 END THEN 0
   WHEN w.i > 0 AND w.j > 1 AND two[w.i][w.j - 1] AND cost[w.i + 1][w.j + 1] = cost[w.i][w.j - 1] THEN 1 WHEN w.i > 0 AND cost[w.i + 1][w.j + 1] = cost[w.i][w.j + 1] + 1 THEN 2 ELSE 3 END AS way
  FROM walk w JOIN mat ON mat.id = w.id JOIN fit ON fit.id = w.id WHERE w.i > 0 OR w.j > 0)),
h AS (SELECT id, list(hit) AS hits FROM walk WHERE hit >= 0 GROUP BY id)
SELECT storyid, phraseindex, coalesce(list_aggregate(list_transform(generate_series(1, len(a)), lambda k: CASE WHEN len(b) > 0 AND (a = b OR list_contains(hits, k - 1)) THEN '1' ELSE '0' END), 'string_agg', ''), '') AS matches FROM src LEFT JOIN h USING (id)"""

DECODE = f"""WITH s AS (SELECT storyid, phraseindex, list_transform(string_split(array_to_string(reference_phonemes, '|'), '|'), lambda x: string_split(x, '')) AS segs FROM story_phrase WHERE reference_phonemes IS NOT NULL),
c AS (SELECT storyid, phraseindex, flatten(list_transform(segs, lambda x: regexp_extract_all(coalesce(list_aggregate(list_transform(list_filter(range(1, len(x) + 1), lambda i: i = 1 OR x[i] <> x[i - 1]), lambda i: x[i]), 'string_agg', ''), ''), '{"|".join(ELEMENTS)}'))) AS e FROM s)
SELECT storyid, phraseindex, array_to_string(e, ' ') AS elements, len(e) AS n, round(coalesce(list_sum(list_transform(e, lambda x: list_avg(list_transform(string_split(x, ''), lambda ch: (unicode(ch) % 100) / 100.0)))), 0), 6) AS sure FROM c"""


def mapped_places(source: str) -> str:
    """CTEs src (id, a, b and what source has besides) and pairs (id, i, j): equal and replaced stretches, place by place.

    Of a stretch of both sides the longest common run is taken, the first in a
    and then in b; what lies before and after it are stretches again.
    """
    best = "coalesce(list_max(flatten(list_transform(range(alo, ahi), lambda i: list_transform(range(blo, bhi), lambda j: least(run[i + 1][j + 1], ahi - i, bhi - j) * 100000000 - i * 10000 - j)))), 0)"
    size = "CAST((code + 99999999) // 100000000 AS INT)"
    return f"""WITH RECURSIVE src AS (SELECT row_number() OVER () AS id, * FROM ({source})),
dp AS (SELECT id, CAST(len(a) AS INT) AS i, list_transform(range(len(b) + 1), lambda x: 0) AS line FROM src
 UNION ALL SELECT dp.id, dp.i - 1, list_append(list_transform(range(len(b)), lambda j: CASE WHEN b[j + 1] = a[dp.i] THEN line[j + 2] + 1 ELSE 0 END), 0) FROM dp JOIN src ON src.id = dp.id WHERE dp.i > 0),
mat AS (SELECT id, list(line ORDER BY i) AS run FROM dp GROUP BY id),
part AS (SELECT id, alo, ahi, blo, bhi, CAST({best} AS BIGINT) AS code FROM (SELECT src.id, run, 0 AS alo, CAST(len(a) AS INT) AS ahi, 0 AS blo, CAST(len(b) AS INT) AS bhi FROM src JOIN mat ON mat.id = src.id)
 UNION ALL SELECT id, alo, ahi, blo, bhi, CAST({best} AS BIGINT) FROM (
  SELECT q.id, run, CASE side WHEN 0 THEN alo ELSE i + k END AS alo, CASE side WHEN 0 THEN i ELSE ahi END AS ahi, CASE side WHEN 0 THEN blo ELSE j + k END AS blo, CASE side WHEN 0 THEN j ELSE bhi END AS bhi
  FROM (SELECT *, {size} AS k, CAST(({size} * 100000000 - code) // 10000 AS INT) AS i, CAST(({size} * 100000000 - code) % 10000 AS INT) AS j FROM part WHERE code > 0) q JOIN mat ON mat.id = q.id JOIN (VALUES (0), (1)) s(side) ON true)
 WHERE alo < ahi AND blo < bhi),
blocks AS (SELECT id, CAST(({size} * 100000000 - code) // 10000 AS INT) AS i, CAST(({size} * 100000000 - code) % 10000 AS INT) AS j, {size} AS k FROM part WHERE code > 0 UNION ALL SELECT id, CAST(len(a) AS INT), CAST(len(b) AS INT), 0 FROM src),
cuts AS (SELECT *, coalesce(lag(i + k) OVER w, 0) AS pi, coalesce(lag(j + k) OVER w, 0) AS pj FROM blocks WINDOW w AS (PARTITION BY id ORDER BY i, j, k DESC)),
pairs AS (SELECT id, i + x AS i, j + x AS j FROM (SELECT *, unnest(range(k)) AS x FROM cuts) UNION ALL SELECT id, pi + x, pj + x FROM (SELECT *, unnest(range(least(i - pi, j - pj))) AS x FROM cuts))"""


MAPPING = (
    mapped_places(PAGE_WORDS.replace("list_filter(string_split_regex(array_to_string(t, ' '), '\\s+'), lambda x: x <> '') AS b", "t AS b"))
    + " SELECT activity_id, page_index, coalesce(m, '') AS places FROM src LEFT JOIN (SELECT id, string_agg(i || '-' || j, ' ' ORDER BY i) AS m FROM pairs GROUP BY id) USING (id)"
)

_PLAIN = r"""regexp_replace(lower({c}), '[.,?!:;()\[\]"''’“”]', '', 'g')"""
#: Every page with its phrases' words (a) and the plain words that lie in it by time (b), with the tokens they are of.
PAGE_TOKENS = rf"""WITH p AS (SELECT activity_id, page_index, max(phrases) AS phrases, max(start_time) AS s, max(end_time) AS e FROM page_data WHERE activity_id IS NOT NULL AND page_index IS NOT NULL GROUP BY 1, 2),
w AS (SELECT p.activity_id, p.page_index, list({{'start': w.start, 'end': w."end", 'word': w.word}} ORDER BY w.start, w."end" NULLS FIRST, w.word_id) AS tokens FROM p JOIN word_items w ON w.activity_id = p.activity_id AND w.start * 1000 >= p.s AND w.start * 1000 <= p.e + 1000 AND abs(w.start) < 1e9 WHERE p.e + 1000 >= p.s GROUP BY 1, 2),
f AS (SELECT activity_id, page_index, coalesce(s, 0) AS page_start, list_transform(phrases, lambda x: list_filter(string_split_regex({_PLAIN.format(c="x")}, '\s+'), lambda y: y <> '')) AS parts, coalesce(tokens, []) AS tokens FROM p LEFT JOIN w USING (activity_id, page_index))
SELECT activity_id, page_index, page_start, parts, tokens, flatten(parts) AS a, list_transform(tokens, lambda x: {_PLAIN.format(c="x.word")}) AS b FROM f WHERE len(parts) > 0"""
TIMES = (
    mapped_places(PAGE_TOKENS)
    + """, ph AS (SELECT id, CAST(x AS INT) AS phrase, coalesce(list_sum(list_transform(parts[1:x], lambda y: len(y))), 0) AS low, coalesce(list_sum(list_transform(parts[1:x + 1], lambda y: len(y))), 0) AS high FROM (SELECT id, parts, unnest(range(len(parts))) AS x FROM src)),
mine AS (SELECT ph.id, phrase, min(j) AS first, max(j) AS last FROM ph LEFT JOIN pairs ON pairs.id = ph.id AND pairs.i >= low AND pairs.i < high GROUP BY 1, 2),
t AS (SELECT activity_id, page_index, phrase, page_start, CAST(trunc(tokens[first + 1].start * 1000) AS INT) AS s, CAST(trunc(tokens[last + 1]."end" * 1000) AS INT) AS e, CASE WHEN first IS NULL THEN '' ELSE array_to_string(list_transform(tokens[first + 1:last + 1], lambda x: x.word), ' ') END AS parsed FROM mine JOIN src USING (id)),
r AS (SELECT *, max(greatest(page_start, s, e)) OVER (PARTITION BY activity_id, page_index ORDER BY phrase ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM t),
g AS (SELECT *, greatest(coalesce(reach, page_start), coalesce(s, 0), page_start) AS b FROM r)
SELECT activity_id, page_index, phrase, b AS start_ms, greatest(coalesce(e, 0), b) AS end_ms, parsed FROM g"""
)

#: The phrases of every page with their times, and a row for a page without phrases.
DOCUMENT_ROWS = f"""WITH p AS (SELECT activity_id, page_index, max(phrases) AS phrases, max(phrase_indices) AS idx, max(start_time) AS s, max(end_time) AS e FROM page_data WHERE activity_id IS NOT NULL AND page_index IS NOT NULL GROUP BY 1, 2)
SELECT p.activity_id, p.page_index, p.s AS page_start, p.e AS page_end, CASE WHEN t.phrase IS NOT NULL THEN idx[t.phrase + 1] END AS phrase_idx, t.start_ms AS start, t.end_ms AS "end", t.parsed, CASE WHEN t.phrase IS NOT NULL THEN coalesce(phrases[t.phrase + 1], '') END AS phrase_text
FROM p LEFT JOIN ({TIMES}) t ON t.activity_id = p.activity_id AND t.page_index = p.page_index"""
