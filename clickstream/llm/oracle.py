"""DuckDB SQL of the queries that SQL can express."""

from clickstream.llm.quality_rules import COMMON_WORDS
from clickstream.llm.queries import URL_RULES
from clickstream.llm.url_filter import UNIT

#: Characters of the key's ends: space and 0x09-0x0D.
_WS = "chr(32)||chr(9)||chr(10)||chr(11)||chr(12)||chr(13)"
_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

op5_line_dedup = f"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents),
keyed AS (SELECT doc_id, pos, line, trim({_LOWER.format('line')}, {_WS}) AS key FROM lines),
counted AS (
  SELECT key, count(DISTINCT doc_id) AS refs, max(doc_id) AS last FROM keyed WHERE length(key) >= 40 GROUP BY key),
marked AS (
  SELECT k.doc_id, k.pos, k.line, (c.refs >= 5 AND k.doc_id < c.last) IS TRUE AS gone
  FROM keyed k LEFT JOIN counted c ON k.key = c.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

_WORDS = "regexp_extract_all(" + _LOWER.format("coalesce(text, '')") + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

op3_benchmark_decontamination = f"""
WITH items AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS n, array_to_string(w[k:k + 9], ' ') AS s
  FROM (SELECT item_id, w, unnest(range(1, greatest(1, len(w) - 9) + 1)) AS k FROM items WHERE len(w) > 0)),
docs AS (SELECT doc_id, {_WORDS} AS w FROM documents),
places AS (
  SELECT doc_id, n, k, array_to_string(w[k:k + n - 1], ' ') AS s
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS k
        FROM docs, (SELECT DISTINCT n FROM windows) WHERE len(w) >= n)),
hits AS (SELECT DISTINCT doc_id, item_id, k, p.n FROM places p JOIN windows i ON p.s = i.s AND p.n = i.n),
covered AS (
  SELECT doc_id, count(DISTINCT pos) AS n_hit FROM (SELECT doc_id, unnest(range(k, k + n)) AS pos FROM hits) GROUP BY doc_id),
found AS (
  SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS id FROM hits) GROUP BY doc_id)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs d LEFT JOIN covered USING (doc_id) LEFT JOIN found USING (doc_id)
"""

# Fixed values, as in the operator: common words and character classes.
_COMMON = ", ".join(f"('{lang}', '{w}')" for lang, ws in COMMON_WORDS.items() for w in ws)
_CLASS_SQL = ["[\\x20\\x09-\\x0D]", "[A-Z]", "[0-9]", "[.,;:!?''\"()\\-]", "[#*$%&|<>@^~_=+/{}\\[\\]\\\\`]", "[^\\x00-\\x7F]"]
_COUNTS = ", ".join(f"length(t) - length(regexp_replace(t, '{c}', '', 'g'))" for c in _CLASS_SQL)


def _half(p: str, q: str) -> str:
    part = lambda x: f"CASE WHEN {x} > 0 THEN {x} * log2({x} / (({p} + {q}) / 2)) ELSE 0 END"
    return f"(({part(p)} + {part(q)}) / 2)"


op8_quality_rules = f"""
WITH base AS (SELECT row_number() OVER () AS rid, doc_id, lang, coalesce(text, '') AS t FROM documents),
split AS (SELECT *, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS w,
                 list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines FROM base),
windows AS (SELECT rid, k, array_to_string(w[k:k + 4], ' ') AS s
            FROM (SELECT rid, w, unnest(range(1, len(w) - 3)) AS k FROM split WHERE len(w) >= 5)),
repeats AS (SELECT rid, count(DISTINCT pos) AS n
            FROM (SELECT rid, unnest(range(k, k + 5)) AS pos
                  FROM (SELECT *, count(*) OVER (PARTITION BY rid, s) AS c FROM windows) WHERE c > 1) GROUP BY rid),
counts AS (SELECT rid, doc_id, lang, len(w)::BIGINT AS n_words, length(t)::BIGINT AS n_chars,
                  coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
                  length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
                  (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, [{_COUNTS}] AS c6 FROM split),
classes AS (SELECT rid, lang, i, c::DOUBLE AS c, n_chars FROM (
              SELECT rid, lang, n_chars, unnest(list_append(c6, n_chars - list_sum(c6))) AS c, unnest(range(1, 8)) AS i FROM counts)),
common(lang, word) AS (VALUES {_COMMON}),
found AS (SELECT rid, word, count(*)::DOUBLE AS n FROM (SELECT rid, lower(unnest(w)) AS word FROM split)
          WHERE word IN (SELECT word FROM common) GROUP BY rid, word),
langs AS (SELECT lang, sum(n_words) AS words, sum(n_chars) AS chars FROM counts
          WHERE lang IS NOT NULL GROUP BY lang HAVING sum(n_words) > 0),
large AS (SELECT * FROM langs WHERE chars >= (SELECT sum(n_chars) FROM counts WHERE lang IS NOT NULL) * 0.001::DOUBLE),
ref_class AS (SELECT lang, i, sum(c) / any_value(chars) AS q FROM classes JOIN large USING (lang) GROUP BY lang, i),
ref_word AS (SELECT l.lang, f.word, sum(f.n) / any_value(l.words) AS q
             FROM found f JOIN counts USING (rid) JOIN langs l USING (lang) JOIN common m ON m.lang = l.lang AND m.word = f.word
             GROUP BY l.lang, f.word),
by_class AS (SELECT rid, lang, sqrt(greatest(0, sum({_half('p', 'q')}))) AS d
             FROM (SELECT c.rid, r.lang, c.c / greatest(c.n_chars, 1) AS p, r.q FROM classes c JOIN ref_class r USING (i)) GROUP BY rid, lang),
by_word AS (SELECT rid, lang, sqrt(greatest(0, any_value(parts) + {_half('any_value(1 - ps)', 'any_value(1 - qs)')})) AS d
            FROM (SELECT c.rid, r.lang, sum({_half('coalesce(f.n, 0) / greatest(c.n_words, 1)', 'r.q')}) AS parts,
                         sum(coalesce(f.n, 0) / greatest(c.n_words, 1)) AS ps, sum(r.q) AS qs
                  FROM counts c CROSS JOIN ref_word r LEFT JOIN found f ON f.rid = c.rid AND f.word = r.word GROUP BY c.rid, r.lang)
            GROUP BY rid, lang),
nearest AS (SELECT rid, min(a.d) AS class_d, min(b.d) AS word_d FROM by_class a LEFT JOIN by_word b USING (rid) GROUP BY rid)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, coalesce(r.n, 0) AS n_repeat_words,
       n_words < 10 OR 100 * coalesce(r.n, 0) > 20 * n_words AS base_failed,
       NOT (n_words < 10 OR 100 * coalesce(r.n, 0) > 20 * n_words)
         AND NOT coalesce((n_chars >= 200 AND class_d > 0.25)
                          OR ((lang IS NULL OR lang IN (SELECT lang FROM ref_word))
                              AND n_words >= 50 AND word_d > 0.22::DOUBLE + 1 / sqrt(n_words)), false) AS kept
FROM counts LEFT JOIN repeats r USING (rid) LEFT JOIN nearest USING (rid)
"""

_URL = "'(?s)^.*?://([^/?#]*)([^?#]*)'"
_LINK = """'(?i)\\b(?:href|src)\\s*=\\s*["'']?\\s*(?:https?:)?//([^/?#"''<>\\s]+)'"""
_RULES = ", ".join(f"('{r}', '{r.split('/', 1)[0]}', '/{r.split('/', 1)[1]}', '{v}')" for r, v in URL_RULES)
_ROUNDS = 10


def _round(k: int) -> str:
    return f"""s{k} AS MATERIALIZED (
  SELECT z.kind, z.host, z.seed, ((z.seed * 15 + coalesce(g.got, 0) * 85) // 100)::BIGINT AS score FROM s{k - 1} z LEFT JOIN (
    SELECT f.kind, f.dst, sum(p.score // f.degree)::BIGINT AS got FROM s{k - 1} p JOIN flow f ON f.kind = p.kind AND f.src = p.host
    GROUP BY f.kind, f.dst) g ON g.kind = z.kind AND g.dst = z.host)"""


op13_url_filter = f"""
WITH base AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, page_id, html,
         {_LOWER.format(f"regexp_extract(coalesce(url, ''), {_URL}, 1)")} AS host, regexp_extract(coalesce(url, ''), {_URL}, 2) AS path FROM pages),
rules(rule, rhost, rpath, verdict) AS (VALUES {_RULES}),
hit AS MATERIALIZED (
  SELECT b.rid, b.host, arg_max(r.rule, length(r.rule)) AS rule, arg_max(r.verdict, length(r.rule)) AS verdict
  FROM base b LEFT JOIN rules r ON b.host <> '' AND (b.host = r.rhost OR ends_with(b.host, '.' || r.rhost)) AND starts_with(b.path, r.rpath)
  GROUP BY b.rid, b.host),
hosts AS MATERIALIZED (
  SELECT host, CASE WHEN 2 * count(*) FILTER (WHERE verdict = 'allow') > count(*) THEN count(*) ELSE 0 END AS good,
         CASE WHEN 2 * count(*) FILTER (WHERE verdict = 'block') > count(*) THEN count(*) ELSE 0 END AS bad
  FROM hit WHERE host <> '' GROUP BY host),
named AS (SELECT DISTINCT host AS src, unnest(regexp_extract_all(html, {_LINK}, 1)) AS link FROM base WHERE host <> ''),
links AS (SELECT src, {_LOWER.format("regexp_replace(string_split(link, '@')[-1], ':[0-9]*$', '')")} AS dst FROM named),
above AS (SELECT a.host AS src, arg_max(b.host, length(b.host)) AS dst FROM hosts a JOIN hosts b ON ends_with(a.host, '.' || b.host) GROUP BY a.host),
edges AS MATERIALIZED (
  SELECT src, dst FROM links WHERE src <> dst AND dst IN (SELECT host FROM hosts)
  UNION SELECT src, dst FROM above UNION SELECT dst, src FROM above),
pairs AS (SELECT 0 AS kind, src, dst FROM edges UNION ALL SELECT 1, dst, src FROM edges),
flow AS MATERIALIZED (SELECT *, count(*) OVER (PARTITION BY kind, src) AS degree FROM pairs),
s0 AS MATERIALIZED (
  SELECT kind, host, seed, seed AS score FROM (
    SELECT 0 AS kind, host, (good * ({UNIT} // greatest(1, (SELECT sum(good) FROM hosts))))::BIGINT AS seed FROM hosts
    UNION ALL SELECT 1, host, (bad * ({UNIT} // greatest(1, (SELECT sum(bad) FROM hosts))))::BIGINT FROM hosts)),
{", ".join(_round(k) for k in range(1, _ROUNDS + 1))},
final AS (SELECT host, sum(score) FILTER (WHERE kind = 0) AS t, sum(score) FILTER (WHERE kind = 1) AS d FROM s{_ROUNDS} GROUP BY host)
SELECT b.page_id, b.host, b.path, h.rule,
       coalesce(h.verdict, CASE WHEN f.d * 100 > (f.t + f.d) * 50 THEN 'block' ELSE 'allow' END) AS verdict
FROM base b JOIN hit h USING (rid) LEFT JOIN final f ON f.host = b.host
"""

_TERMS = f"regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

op12_lexical_search = f"""
WITH docs AS MATERIALIZED (SELECT row_number() OVER () AS rid, doc_id, {_TERMS} AS w FROM documents),
total AS MATERIALIZED (SELECT count(*) FILTER (WHERE len(w) > 0)::BIGINT AS n_docs, sum(len(w))::BIGINT AS n_terms FROM docs),
tf AS MATERIALIZED (SELECT rid, doc_id, term, count(*)::BIGINT AS tf, any_value(n)::BIGINT AS n
                    FROM (SELECT rid, doc_id, len(w) AS n, unnest(w) AS term FROM docs) GROUP BY rid, doc_id, term),
item AS (SELECT iid, item_id, term, count(*)::BIGINT AS times
         FROM (SELECT row_number() OVER () AS iid, item_id, unnest({_TERMS}) AS term FROM benchmark) GROUP BY iid, item_id, term),
weight AS (SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
           FROM tf, total WHERE term IN (SELECT term FROM item) GROUP BY term, n_docs),
part AS (SELECT rid, doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * n * n_docs) // n_terms))) AS part
         FROM tf JOIN weight USING (term), total),
scored AS (SELECT iid, item_id, rid, doc_id, sum(times * part)::BIGINT AS score FROM item JOIN part USING (term) GROUP BY iid, item_id, rid, doc_id)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY iid ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0) WHERE rank <= 20
"""

op11_hard_negatives = """
WITH v AS MATERIALIZED (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS MATERIALIZED (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, list_dot_product(a.q, b.q)::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
pos AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
        QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, p.positive_id, (row_number() OVER w)::INTEGER AS rank, n.vec_id AS negative_id, p.positive_score, n.score AS negative_score
FROM pos p JOIN s n ON n.anchor_id = p.anchor_id AND NOT n.same
  AND 50 * p.positive_score <= 100 * n.score AND 100 * n.score <= 95 * p.positive_score
WINDOW w AS (PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.vec_id)
QUALIFY row_number() OVER w <= 3
"""

ORACLE_SQL = {
    "op3_benchmark_decontamination": op3_benchmark_decontamination,
    "op5_line_dedup": op5_line_dedup,
    "op8_quality_rules": op8_quality_rules,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_lexical_search": op12_lexical_search,
    "op13_url_filter": op13_url_filter,
}
