"""DuckDB SQL for the queries that SQL can express over whole tables in reasonable time."""

from __future__ import annotations

from . import licenses

ORACLES: dict[str, str] = {}

_WHITE = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

ORACLES["op1_line_dedup"] = f"""
WITH lines AS (
  SELECT doc_id, pos, line,
         translate(trim(line, {_WHITE}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM (SELECT doc_id, unnest(parts) AS line, generate_subscripts(parts, 1) AS pos
        FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents))),
often AS (
  SELECT k, max(doc_id) AS keep FROM lines WHERE length(k) >= 20 GROUP BY k HAVING count(DISTINCT doc_id) >= 3),
marked AS (
  SELECT doc_id, pos, line, o.k IS NOT NULL AND doc_id <> o.keep AS gone FROM lines l LEFT JOIN often o ON l.k = o.k)
SELECT doc_id, count(*)::BIGINT AS n_lines, (count(*) FILTER (WHERE gone))::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

ORACLES["op8_quality_rules"] = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
m AS (SELECT rid, doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM d),
g AS (SELECT rid, unnest(range(0, len(w) - 4)) AS i, w FROM m WHERE len(w) >= 5),
h AS (SELECT rid, i, count(*) OVER (PARTITION BY rid, array_to_string(w[i + 1:i + 5], chr(31))) AS n FROM g),
c AS (SELECT rid, count(DISTINCT i + k) AS n_repeat FROM h, (SELECT unnest([0, 1, 2, 3, 4]) AS k) WHERE n > 1 GROUP BY rid),
b AS (SELECT doc_id, t, w, len(l)::BIGINT AS n_lines, len(w)::BIGINT AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
        (length(t) - length(regexp_replace(t, '[#*$%&|<>]+', '', 'g')))::BIGINT AS n_symbols, (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(n_repeat, 0)::BIGINT AS n_repeat_words
      FROM m LEFT JOIN c USING (rid)),
f AS (SELECT *, n_words < 10 OR n_repeat_words * 100 > n_words * 20 AS base_failed FROM b)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed OR n_symbols * 100 > n_words * 10 OR n_dup_lines * 100 > n_lines * 30 OR word_chars < n_words * 2 OR word_chars > n_words * 15
    OR length(regexp_replace(t, '[^\p{Lu}]+', '', 'g')) * 100 > length(regexp_replace(t, '[^\p{L}]+', '', 'g')) * 50
    OR len(list_filter(w, lambda x: NOT regexp_matches(x, '\p{L}'))) * 100 > n_words * 40 OR len(list_filter(w, lambda x: ends_with(x, '!!'))) * 100 > n_words * 30) AS kept
FROM f
"""

_LOWERED = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _license_sql(templates: list[licenses.Template], threshold: int = licenses.THRESHOLD) -> str:
    """Windows by arithmetic on the places of the templates' words: nothing of prefixes, lengths or positions."""
    rows = ", ".join(f"({i}, '{t.label}', {t.phrase}, {t.step}, {t.least(threshold)}, {list(t.words)})" for i, t in enumerate(templates))
    return rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all({_LOWERED.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents),
w AS (SELECT rid, unnest(words) AS w, generate_subscripts(words, 1) - 1 AS pos, words FROM d),
t AS (SELECT * FROM (VALUES {rows}) AS t(id, label, phrase, step, least, tw)),
places AS (
  SELECT rid, label, pos AS first FROM w, t WHERE phrase AND w.w = tw[1] AND list_slice(words, pos + 1, pos + len(tw)) = tw),
tokens AS (SELECT id, label, step, least, len(list_distinct(tw)) AS size, unnest(list_distinct(tw)) AS w FROM t WHERE NOT phrase),
held AS (
  SELECT rid, id, label, least, size, block, count(DISTINCT w) AS n
  FROM (SELECT rid, id, label, least, size, w, unnest([pos // step, pos // step - 1]) AS block FROM w JOIN tokens USING (w))
  WHERE block >= 0 GROUP BY ALL),
all_found AS (
  SELECT rid, label, first, 1.0::DOUBLE AS score FROM places
  UNION ALL SELECT rid, label, NULL, n::DOUBLE / size FROM held WHERE n >= least),
found AS (
  SELECT rid, count(first) AS n_base, min(first) AS first_word, max(first) AS last_word, string_agg(DISTINCT label, ',' ORDER BY label) FILTER (WHERE first IS NOT NULL) AS base_labels,
         string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(score) AS score
  FROM all_found GROUP BY rid)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word, last_word::BIGINT AS last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0) AS score
FROM d LEFT JOIN found USING (rid)
"""


ORACLES["op11_license_scan"] = _license_sql(licenses.default_templates())

ORACLES["op12_source_divergence"] = rf"""
WITH d AS (SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, regexp_extract_all({_LOWERED.format("coalesce(text, '')")}, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents),
vocabulary AS (
  SELECT lang, term FROM (SELECT lang, unnest(list_distinct(terms)) AS term FROM d) GROUP BY ALL HAVING count(*) >= 10),
counts AS (
  SELECT lang, source, term, count(*)::HUGEINT AS n FROM (SELECT lang, source, unnest(terms) AS term FROM d) SEMI JOIN vocabulary USING (lang, term) GROUP BY ALL),
groups AS (SELECT DISTINCT lang, source FROM d),
dense AS (
  SELECT lang, source, term, coalesce(n, 0) AS n, sum(coalesce(n, 0)) OVER (PARTITION BY lang, source) AS total, count(*) OVER (PARTITION BY lang, source) AS v,
         sum(coalesce(n, 0)) OVER (PARTITION BY lang, term) AS lang_n, sum(coalesce(n, 0)) OVER (PARTITION BY lang) AS lang_total
  FROM groups JOIN vocabulary USING (lang) LEFT JOIN counts USING (lang, source, term)),
shares AS (
  SELECT lang, source, term, n, 1 + (1000000000::HUGEINT * (n::HUGEINT + 2)) // (total::HUGEINT + 2 * v) AS p, 1 + (1000000000::HUGEINT * (lang_n::HUGEINT + 2)) // (lang_total::HUGEINT + 2 * v) AS q
  FROM dense),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
parts AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN pairs p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
  UNION ALL SELECT lang, source, 'term', term, ((p - q) * (p - q)) // (p + q) FROM shares WHERE n > 0 AND p > q)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM parts)
WHERE part = 'pair' OR rank <= 10
"""

ORACLES["op13_collocations"] = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, coalesce(lang, 'und') AS lang, string_split_regex({_LOWERED.format("coalesce(text, '')")}, '[.,;:!?\x0A-\x0D]') AS pieces FROM documents),
p AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM (SELECT lang, unnest(pieces) AS piece FROM d)),
f AS (
  SELECT lang, k, phrase, count(*)::HUGEINT AS f
  FROM (SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase FROM p, (VALUES (1), (2), (3)) AS n(k))
  GROUP BY ALL),
c AS (SELECT lang, k AS size, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1 AND f >= 10),
cuts AS (
  SELECT c.lang, size, phrase, a, w, k, array_to_string(w[1:k], ' ') AS x, array_to_string(w[k + 1:], ' ') AS y FROM c, (VALUES (1), (2)) AS n(k) WHERE k < size),
scored AS (
  SELECT cuts.lang, size, cuts.phrase, a, l.f AS l, r.f AS r, (1000000::HUGEINT * a * a) // (l.f * r.f) AS score, cuts.k
  FROM cuts JOIN f l ON l.lang = cuts.lang AND l.phrase = x JOIN f r ON r.lang = cuts.lang AND r.phrase = y),
worst AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
absorbed AS (
  SELECT DISTINCT s.lang, s.phrase FROM c s JOIN (SELECT lang, a, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) AS phrase FROM c WHERE size = 3) t
  ON s.lang = t.lang AND s.phrase = t.phrase AND 100 * t.a >= 50 * s.a),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM worst ANTI JOIN absorbed USING (lang, phrase)),
n AS (SELECT lang, sum(f) AS n FROM f WHERE k = 1 GROUP BY lang)
SELECT lang, rank::BIGINT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score FROM ranked JOIN n USING (lang) WHERE rank <= 2000
"""
