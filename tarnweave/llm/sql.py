"""DuckDB SQL for the corpus queries that SQL can express."""

from __future__ import annotations

import string

_WORDS = r"regexp_extract_all({text}, '[^\x20\x09-\x0D]+')"
_REACH = """
links AS (SELECT a, b FROM pairs UNION SELECT b, a FROM pairs),
reach(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
least AS (SELECT a, min(b) AS m FROM reach GROUP BY 1)"""

NEAR_VECTORS = f"""
WITH RECURSIVE v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings),
pairs AS (SELECT x.vec_id AS a, y.vec_id AS b FROM v x JOIN v y ON x.vec_id < y.vec_id
 WHERE list_inner_product(x.e, y.e) / sqrt(list_inner_product(x.e, x.e)) / sqrt(list_inner_product(y.e, y.e)) >= 0.9),{_REACH},
n AS (SELECT a, count(*) AS n FROM links GROUP BY 1)
SELECT vec_id, coalesce(n, 0) AS n_links, least(vec_id, coalesce(m, vec_id)) AS component_id, coalesce(m, vec_id) >= vec_id AS kept
FROM v LEFT JOIN n ON n.a = vec_id LEFT JOIN least ON least.a = vec_id
"""

_LOWER = f"translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}')"
NEAR_DUPLICATES = f"""
WITH RECURSIVE w AS (SELECT doc_id, {_WORDS.format(text=_LOWER)} AS w FROM documents),
s AS (SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
 ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS s FROM w),
u AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM s),
c AS (SELECT x.doc_id AS a, y.doc_id AS b, x.n + y.n AS n, count(*) AS k FROM u x JOIN u y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY 1, 2, 3),
pairs AS (SELECT a, b FROM c WHERE 100 * k >= 85 * (n - k)),{_REACH}
SELECT doc_id, len(s)::BIGINT AS n_shingles, least(doc_id, coalesce(m, doc_id)) AS component_id, coalesce(m, doc_id) >= doc_id AS kept
FROM s LEFT JOIN least ON least.a = doc_id
"""

MIX = f"""
WITH d AS (SELECT doc_id, source, text, coalesce(len({_WORDS.format(text='text')}), 0)::BIGINT AS size FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY 1),
w AS (SELECT *, 1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS weight, 3 * source_size AS bound FROM s),
f AS (SELECT *, (sum(source_size) OVER () - coalesce(sum(bound) OVER before, 0))::DOUBLE AS free, (sum(weight) OVER rest)::DOUBLE AS heavy FROM w
 WINDOW before AS (ORDER BY bound / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
 rest AS (ORDER BY bound / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
l AS (SELECT *, bound * heavy < free * weight AS filled FROM f),
t AS (SELECT source, source_size, CASE WHEN filled THEN bound::DOUBLE ELSE weight * (SELECT free / heavy FROM l WHERE NOT filled ORDER BY bound / weight, source NULLS LAST LIMIT 1) END AS target FROM l),
g AS (SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS ratio FROM t),
q AS (SELECT *, floor(ratio) AS whole, target - floor(ratio) * source_size AS quota FROM g),
o AS (SELECT source, sqrt(size::DOUBLE) AS odds, sum(size)::BIGINT AS words FROM d WHERE size > 0 GROUP BY 1, 2),
lv AS (SELECT o.source, odds, sum(odds * words) OVER w AS rest, quota - (sum(words) OVER (PARTITION BY o.source) - sum(words) OVER w)::DOUBLE AS free
 FROM o JOIN q ON o.source IS NOT DISTINCT FROM q.source WINDOW w AS (PARTITION BY o.source ORDER BY odds)),
c AS (SELECT source, arg_max(free / rest, odds) FILTER (free * odds < rest) AS level FROM lv GROUP BY 1),
u AS (SELECT d.*, q.* EXCLUDE (source), least(1, coalesce(level * sqrt(size::DOUBLE), 1)) AS chance, (('0x' || substr(md5('mix:' || doc_id), 1, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496 AS u
 FROM d JOIN q ON d.source IS NOT DISTINCT FROM q.source LEFT JOIN c ON d.source IS NOT DISTINCT FROM c.source),
r AS (SELECT *, CASE WHEN size > 0 AND chance > 0 THEN u * (1 - chance) / ((1 - u) * chance) ELSE 1e300 END AS rank FROM u),
h AS (SELECT *, sum(size) OVER (PARTITION BY source ORDER BY rank, doc_id) <= quota AND quota > 0 AS head FROM r),
e AS (SELECT *, quota - coalesce(sum(CASE WHEN head THEN size END) OVER (PARTITION BY source), 0) AS gap FROM h),
m AS (SELECT *, NOT head AND size > 0 AND abs(size - gap) < gap AS may FROM e),
z AS (SELECT *, may AND row_number() OVER (PARTITION BY source ORDER BY may DESC, greatest(abs(size - gap), target * 0.001::DOUBLE), rank, doc_id) = 1 AS closes FROM m)
SELECT doc_id, size, source_size, target, CASE WHEN size > 0 THEN (whole + (head OR closes)::INT)::BIGINT * size ELSE 0 END AS taken FROM z
"""

_ESCAPED = r"replace(replace({c}, '\', '\\'), '|', '\|')"
FORMATTED = f"""
WITH r AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
 UNION ALL SELECT -7, 0, 'user', '\\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\\### Assistant: </turn> ok')
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
 coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
 sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
 sum(length('<|turn:' || {_ESCAPED.format(c='role')} || '|>' || {_ESCAPED.format(c='text')} || '<|end|>' || chr(10)))::BIGINT AS formatted_chars
FROM r GROUP BY 1
"""

HARD_NEGATIVES = """
with usable as (
  select vec_id as id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
         list_transform(embedding, lambda x: floor(256 * x::double)) as v
  from embeddings where label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), pairs as (
  select a.id as anchor_id, a.label = b.label as same, b.id as other, list_dot_product(a.v, b.v)::bigint as score
  from usable a join usable b on a.id % 50 = 0 and a.id <> b.id
), positives as (
  select anchor_id, other as positive_id, score as positive_score from pairs where same
  qualify row_number() over (partition by anchor_id order by score desc, other) <= 5
), negatives as (
  select p.*, n.other as negative_id, n.score as negative_score,
         row_number() over (partition by p.anchor_id, p.positive_id order by n.score desc, n.other) as rank
  from positives p join pairs n on n.anchor_id = p.anchor_id and not n.same
    and 50 * p.positive_score <= 100 * n.score and 100 * n.score <= 95 * p.positive_score
)
select anchor_id, positive_id, rank::integer as rank, negative_id, positive_score, negative_score from negatives where rank <= 3
"""

COLLOCATIONS = r"""
with plain as (
  select coalesce(lang, 'und') as lang,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as text
  from documents
), pieces as (
  select lang, unnest(regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]')) as piece from plain
), worded as (
  select lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]'), lambda w: w <> '') as words from pieces
), totals as (
  select lang, sum(len(words)) as n from worded group by lang
), runs as (
  select lang, k, unnest(list_transform(range(1, len(words) - k + 2), lambda i: array_to_string(words[i:i + k - 1], ' '))) as phrase
  from worded, range(1, 6) as t(k) where len(words) >= k
), counted as (
  select lang, k, phrase, count(*) as f from runs group by lang, k, phrase
), candidates as (
  select lang, k, phrase, f as a, string_split(phrase, ' ') as parts from counted where k > 1 and f >= 100
), inner_runs as (
  select lang, a, unnest(flatten(list_transform(range(2, k), lambda w: list_transform(range(1, k - w + 2), lambda i: array_to_string(parts[i:i + w - 1], ' '))))) as phrase
  from candidates where k > 2
), around as (
  select lang, phrase, max(a) as most from inner_runs group by lang, phrase
), cuts as (
  select c.lang, c.phrase, c.a, t.j, x.f as l, y.f as r, n.n, (1000::hugeint * c.a * n.n) // (x.f::hugeint * y.f) as score
  from candidates c join range(1, 5) as t(j) on t.j < c.k
  join counted x on x.lang = c.lang and x.phrase = array_to_string(c.parts[1:t.j], ' ')
  join counted y on y.lang = c.lang and y.phrase = array_to_string(c.parts[t.j + 1:c.k], ' ')
  join totals n on n.lang = c.lang
), lowest as (
  select * from cuts qualify row_number() over (partition by lang, phrase order by score, j) = 1
), kept as (
  select l.* from lowest l left join around o on o.lang = l.lang and o.phrase = l.phrase
  where o.most is null or 100 * o.most < 100 * l.a
)
select lang, row_number() over (partition by lang order by score desc, a desc, phrase) as rank, phrase, a, l, r,
       n::bigint as n, score::bigint as score
from kept qualify rank <= 2000
"""
