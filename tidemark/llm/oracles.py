"""DuckDB SQL of the queries that SQL can express. Fits, language models, filters and approximate
substring matching have no such form and are tested by brute force or held-out accuracy."""

from tidemark.llm.licences import LEAST_DICE, TEMPLATES, key_rows
from tidemark.llm.secrets import BASE, RULES

_WORD = r"[^\x20\x09-\x0D]+"


def _quoted(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


_BASE32 = " || ".join(
    f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (((('0x' || substr(h, {5 * k + 1}, 5))::INTEGER) >> {shift}) & 31) + 1, 1)"
    for k in range(8)
    for shift in (15, 10, 5, 0)
)

_WARC = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, octet_length(encode(html))::BIGINT AS payload_bytes, sha1(html) AS h FROM p),
f AS (SELECT *, min(page_id) OVER (PARTITION BY h) AS first FROM d)
SELECT page_id, payload_bytes, {_BASE32} AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to
FROM f
"""

_NEAR = rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '{_WORD}') AS words FROM documents),
g AS (SELECT doc_id, list_distinct(CASE WHEN len(words) = 0 THEN [] WHEN len(words) = 1 THEN [words[1]]
        ELSE [words[i] || ' ' || words[i + 1] for i in range(1, len(words))] END) AS grams FROM w),
s AS (SELECT doc_id, unnest(grams) AS gram FROM g),
n AS (SELECT doc_id, len(grams)::BIGINT AS n_shingles FROM g),
pairs AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS shared FROM s a JOIN s b ON a.gram = b.gram
          AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (SELECT x, y FROM pairs JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y
          WHERE 100 * shared >= 80 * (p.n_shingles + q.n_shingles - shared)),
both_ways AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach(x, y) AS (SELECT doc_id, doc_id FROM n UNION SELECT r.x, b.y FROM reach r JOIN both_ways b ON r.y = b.x)
SELECT n.doc_id, n_shingles, min(reach.y) AS component_id, n.doc_id = min(reach.y) AS kept
FROM n JOIN reach ON reach.x = n.doc_id GROUP BY n.doc_id, n_shingles
"""


def _licence_keys() -> str:
    return ", ".join(f"({_quoted(r[0])}, {_quoted(r[1])}, {r[2]}, {r[3]})" for r in key_rows(TEMPLATES, LEAST_DICE))


_NORMAL = r"regexp_replace(lower({0}), '[^\p{{L}}\p{{N}}\n]+', ' ', 'g')"
_LICENCES = rf"""
WITH tw AS (SELECT * FROM (VALUES {", ".join(f"({_quoted(k)}, {_quoted(v)})" for k, v in sorted(TEMPLATES.items()))})
            v(licence, text)),
tg AS (SELECT licence, regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}]+') AS w FROM tw),
t AS (SELECT licence, list_distinct([w[i] || ' ' || w[i + 1] for i in range(1, len(w))]) AS tgrams FROM tg),
d AS (SELECT doc_id, {_NORMAL.format("text")} AS lines,
      {_NORMAL.format(r"regexp_replace(text, '([.!?])[ \t]+', '\1' || chr(10), 'g')")} AS sentences
      FROM documents WHERE text IS NOT NULL),
l AS (SELECT doc_id, string_split(lines, chr(10)) AS ll, string_split(sentences, chr(10)) AS ss, lines FROM d),
u AS (SELECT doc_id, 'text' AS unit, 0 AS place, replace(lines, chr(10), ' ') AS words FROM l
      UNION ALL SELECT doc_id, 'line', unnest(range(1, len(ll) + 1)), unnest(ll) FROM l WHERE len(ll) > 1
      UNION ALL SELECT doc_id, 'sentence', unnest(range(1, len(ss) + 1)), unnest(ss) FROM l WHERE len(ss) > len(ll)),
uw AS (SELECT doc_id, unit, place::INTEGER AS place, [x for x in string_split(words, ' ') if x <> ''] AS w FROM u),
ug AS (SELECT doc_id, unit, place, list_distinct([w[i] || ' ' || w[i + 1] for i in range(1, len(w))]) AS grams
       FROM uw WHERE len(w) >= 2),
c AS (SELECT doc_id, unit, place, licence, len(grams)::INTEGER AS n_bigrams, len(tgrams) AS size,
      len(list_intersect(grams, tgrams))::INTEGER AS n_shared
      FROM ug, t WHERE len(grams) BETWEEN len(tgrams) / 2 AND len(tgrams) * 2),
k AS (SELECT * FROM (VALUES {_licence_keys()}) v(gram, licence, shift, words)),
tx AS (SELECT doc_id, row_number() OVER () AS copy,
       [x for x in string_split(replace(lines, chr(10), ' '), ' ') if x <> ''] AS w FROM d),
ti AS (SELECT copy, unnest(range(1, len(w))) AS i FROM tx),
tp AS (SELECT ti.copy, ti.i - 1 AS pos, tx.w[ti.i] || ' ' || tx.w[ti.i + 1] AS gram FROM ti JOIN tx USING (copy)),
th AS (SELECT DISTINCT copy, licence, greatest(pos - shift, 0) AS start, pos - shift + words AS stop, words
       FROM tp JOIN k USING (gram)),
tv AS (SELECT doc_id, copy, licence, start, words, w[start + 1 : stop] AS v FROM th JOIN tx USING (copy)),
tz AS (SELECT doc_id, copy, licence, start, words, list_distinct([v[i] || ' ' || v[i + 1] for i in range(1, len(v))]) AS grams
       FROM tv WHERE len(v) > 1),
ts AS (SELECT doc_id, copy, licence, start, words, len(grams)::INTEGER AS n_bigrams, len(tgrams) AS size,
       len(list_intersect(grams, tgrams))::INTEGER AS n_shared FROM tz JOIN t USING (licence)),
tm AS (SELECT *, 2 * n_shared / (n_bigrams + size)::DOUBLE AS dice FROM ts
       WHERE n_bigrams BETWEEN size / 2 AND size * 2 AND 2 * n_shared / (n_bigrams + size)::DOUBLE >= {LEAST_DICE}),
tr AS (SELECT *, coalesce(2 * (start - lag(start) OVER o) > words, true)::INTEGER AS fresh FROM tm
       WINDOW o AS (PARTITION BY copy, licence ORDER BY start, n_bigrams, n_shared)),
tn AS (SELECT *, sum(fresh) OVER (PARTITION BY copy, licence ORDER BY start, n_bigrams, n_shared
       ROWS UNBOUNDED PRECEDING) AS run FROM tr),
tb AS (SELECT * FROM tn QUALIFY row_number() OVER (PARTITION BY copy, licence, run
       ORDER BY dice DESC, start, n_bigrams DESC, n_shared DESC) = 1)
SELECT doc_id, unit, place, licence, n_bigrams, n_shared, 2 * n_shared / (n_bigrams + size)::DOUBLE AS dice
FROM c WHERE 2 * n_shared / (n_bigrams + size)::DOUBLE >= {LEAST_DICE}
UNION ALL SELECT doc_id, 'window', (start + 1)::INTEGER, licence, n_bigrams, n_shared, dice FROM tb
"""

_LINES = r"""
WITH RECURSIVE d AS (SELECT doc_id, text, string_split(text, chr(10)) AS ll FROM documents),
o AS (SELECT doc_id, unnest(range(0, len(ll))) AS place, unnest(ll) AS line FROM d),
e AS (SELECT * FROM o WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
l AS (SELECT line, length(line) AS n, min(doc_id * 10000000 + place) AS first FROM e GROUP BY line),
links AS (SELECT a.first AS x, b.first AS y FROM l a JOIN l b ON b.n BETWEEN a.n AND a.n + 2 AND a.first <> b.first
          WHERE a.n >= 40 AND levenshtein(a.line, b.line) <= 2),
both_ways AS (SELECT x, y FROM links UNION SELECT y, x FROM links),
reach(x, y) AS (SELECT x, x FROM both_ways UNION SELECT r.x, b.y FROM reach r JOIN both_ways b ON r.y = b.x),
stay AS (SELECT x, min(y) AS y FROM reach GROUP BY x),
gone AS (SELECT e.doc_id, e.place FROM e JOIN l ON l.line = e.line LEFT JOIN stay ON stay.x = l.first
         WHERE e.doc_id * 10000000 + e.place <> coalesce(stay.y, l.first)),
kept AS (SELECT o.doc_id, string_agg(o.line, chr(10) ORDER BY o.place) AS text FROM o
         ANTI JOIN gone ON gone.doc_id = o.doc_id AND gone.place = o.place GROUP BY o.doc_id),
n AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
SELECT d.doc_id, coalesce(len(ll), 0)::BIGINT AS n_lines, coalesce(n.n, 0)::BIGINT AS n_removed,
       CASE WHEN d.text IS NOT NULL THEN sha256(coalesce(kept.text, '')) END AS kept_sha256
FROM d LEFT JOIN kept ON kept.doc_id = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id
"""

_MIXING = rf"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{_WORD}'))::BIGINT AS size FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
r AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place FROM s),
w AS (SELECT source, source_size, CASE place % 3 WHEN 0 THEN 3.0::DOUBLE WHEN 1 THEN 1.0::DOUBLE ELSE 2.0::DOUBLE END AS weight,
      2.0::DOUBLE * source_size AS most FROM r),
c AS (SELECT *, row_number() OVER o AS k, sum(most) OVER o AS cm, sum(weight) OVER o AS cw,
      lead(most / weight) OVER (ORDER BY most / weight, source NULLS LAST) AS next FROM w
      WINDOW o AS (ORDER BY most / weight, source NULLS LAST ROWS UNBOUNDED PRECEDING)),
a AS (SELECT 1.5::DOUBLE * sum(source_size) AS words, sum(weight) AS weights, min(most / weight) AS lowest FROM w),
levels AS (SELECT 0 AS k, words / weights AS level, lowest AS next FROM a
           UNION ALL SELECT k, (words - cm) / (weights - cw), next FROM c, a WHERE next IS NOT NULL),
chosen AS (SELECT level FROM levels WHERE next > level ORDER BY k LIMIT 1),
t AS (SELECT source, source_size, least(most, level * weight) AS target FROM w, chosen),
p AS (SELECT d.doc_id, size, source_size, target,
      CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0::DOUBLE END AS rate,
      ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || ':mix-1'), 1, 8))::BIGINT / 4294967296.0::DOUBLE AS draw
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       ((floor(rate) + CASE WHEN draw < rate - floor(rate) THEN 1 ELSE 0 END) * size)::BIGINT AS taken FROM p
"""


def _secret_spans() -> str:
    parts = []
    for place, rule in enumerate(RULES):
        pattern = _quoted(rule.pattern)
        parts.append(
            f"SELECT doc_id, {place} AS place, '{rule.name}' AS name, {rule.least} AS least, "
            f"[length(x) for x in string_split_regex(t, {pattern})] AS gaps, "
            f"[length(x) for x in regexp_extract_all(t, {pattern}, 0)] AS sizes, "
            f"[length(x) for x in regexp_extract_all(t, {pattern}, {rule.group})] AS vals FROM d"
        )
    return " UNION ALL ".join(parts)


_SECRETS = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
m AS ({_secret_spans()}),
i AS (SELECT *, unnest(range(1, len(sizes) + 1)) AS k FROM m WHERE len(sizes) > 0),
s AS (SELECT doc_id, place, name, (list_sum(gaps[1:k]) + list_sum(sizes[1:k]))::BIGINT AS stop, sizes[k] AS size
      FROM i WHERE vals[k] >= least),
x AS (SELECT doc_id, place, name, (stop - size)::BIGINT AS start, stop FROM s),
a AS (SELECT doc_id, count(*) FILTER (place = 0) AS n_assign, count(*) FILTER (place = 1) AS n_access,
      count(*) FILTER (place = 2) AS n_hex,
      string_agg(name || ':' || start || ':' || stop, ',' ORDER BY start, place) FILTER (place < {len(BASE)}) AS base,
      string_agg(name || ':' || start || ':' || stop, ',' ORDER BY start, place) AS spans FROM x GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_assign, 0)::BIGINT AS n_assign, coalesce(n_access, 0)::BIGINT AS n_access,
       coalesce(n_hex, 0)::BIGINT AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN a ON a.doc_id = d.doc_id
"""

_COPIES = r"""
WITH d AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents)
SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size, doc_id = min(doc_id) OVER same AS kept,
       text_sha256
FROM d WINDOW same AS (PARTITION BY text_sha256)
"""

_LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_TERMS = rf"regexp_extract_all({_LOWER.format('text')}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
_SEARCH = f"""
WITH d AS (SELECT doc_id, unnest({_TERMS}) AS term FROM documents),
n AS (SELECT doc_id, count(*) AS n FROM d GROUP BY doc_id),
a AS (SELECT count(*) AS docs, sum(n)::BIGINT AS total FROM n),
m AS (SELECT doc_id, 75 + (25 * n * docs) // total AS m FROM n, a),
tf AS (SELECT doc_id, term, count(*) AS tf FROM d GROUP BY doc_id, term),
w AS (SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
      FROM tf, a GROUP BY term, docs),
q AS (SELECT item_id, unnest({_TERMS}) AS term FROM benchmark),
s AS (SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 12 * m)))::BIGINT AS score
      FROM q JOIN w USING (term) JOIN tf USING (term) JOIN m USING (doc_id) GROUP BY item_id, doc_id),
r AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
      FROM s WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 20
"""

_PIECES = rf"regexp_split_to_array({_LOWER.format('text')}, '[.,;:!?\x0A-\x0D]')"
_PHRASES = rf"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest({_PIECES}) AS piece FROM documents WHERE text IS NOT NULL),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
g AS (SELECT lang, size, array_to_string(w[i:i + size - 1], ' ') AS phrase
      FROM (SELECT lang, w, size, unnest(range(1, len(w) - size + 2)) AS i
            FROM w, (SELECT unnest([1, 2, 3, 4]) AS size) WHERE len(w) >= size)),
f AS (SELECT lang, size, phrase, count(*) AS f FROM g GROUP BY lang, size, phrase),
n AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE size = 1 GROUP BY lang),
c AS (SELECT lang, size, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE size > 1 AND f >= 30),
k AS (SELECT lang, phrase, size, a, w, unnest(range(1, size)) AS k FROM c),
cut AS (SELECT k.lang, k.phrase, k.size, k.a, k.k, x.f AS l, y.f AS r,
        ((2000000::HUGEINT * k.a) // (x.f + y.f))::BIGINT AS score
        FROM k JOIN f x ON x.lang = k.lang AND x.phrase = array_to_string(k.w[1:k.k], ' ')
        JOIN f y ON y.lang = k.lang AND y.phrase = array_to_string(k.w[k.k + 1:], ' ')),
b AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS place FROM cut),
inside AS (SELECT DISTINCT c.lang, array_to_string(c.w[i:i + s - 1], ' ') AS phrase, c.a
           FROM (SELECT lang, w, a, size, s, unnest(range(1, size - s + 2)) AS i
                 FROM c, (SELECT unnest([2, 3]) AS s) WHERE s < size) c),
longer AS (SELECT lang, phrase, max(a) AS most FROM inside GROUP BY lang, phrase),
alive AS (SELECT b.* FROM b LEFT JOIN longer o ON o.lang = b.lang AND o.phrase = b.phrase
          WHERE place = 1 AND (o.most IS NULL OR 100 * o.most < 80 * b.a)),
r AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM alive)
SELECT r.lang, rank, phrase, a, l, r.r, n, score FROM r JOIN n ON n.lang = r.lang WHERE rank <= 2000
"""

ORACLES: dict[str, str] = {
    "op1_warc": _WARC,
    "op2_near_duplicates": _NEAR,
    "op3_licences": _LICENCES,
    "op4_line_dedup": _LINES,
    "op6_mixing": _MIXING,
    "op8_secrets": _SECRETS,
    "op11_exact_dedup": _COPIES,
    "op12_ranked_search": _SEARCH,
    "op13_phrases": _PHRASES,
}
