"""J, K and X: queries of joins and of correction rules."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import joins as J
from ..operators import rules as R
from ..registry import query
from ..sources.tables import BLOCKS, blocks, table

_NOTES = """marks AS (SELECT conv_id, turn AS id, length(text) % 5 AS href, (turn % 4)::VARCHAR AS label FROM conversations WHERE role = 'user'),
notes AS (SELECT conv_id, length(text) % 6 AS anchor, CASE WHEN turn % 2 = 0 THEN turn END AS back, (turn % 4)::VARCHAR AS label FROM conversations WHERE role <> 'user')"""


@query("j1_note_integrity", f"""
WITH {_NOTES}, b AS (SELECT coalesce(m.conv_id, n.conv_id) AS conv_id, coalesce(m.href, n.anchor) AS anchor, id, m.label AS ml, n.label AS nl, n.conv_id IS NOT NULL AS here, back
  FROM marks m FULL JOIN notes n ON m.conv_id = n.conv_id AND m.href = n.anchor),
f AS (SELECT conv_id, anchor, CASE WHEN id IS NOT NULL AND NOT here THEN 'missing note' WHEN id IS NOT NULL AND ml <> nl THEN 'other number' WHEN id IS NULL AND back IS NOT NULL THEN 'no mark for back link' WHEN id IS NULL THEN 'orphan' END AS fault FROM b)
SELECT conv_id, anchor::INT AS anchor, fault FROM f WHERE fault IS NOT NULL UNION ALL SELECT conv_id, anchor::INT, 'duplicate anchor' FROM notes GROUP BY conv_id, anchor HAVING count(*) > 1""")
def j1(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "conversations")
    n, label = F.length("text"), (F.col("turn") % 4).cast("string").alias("label")
    marks = c.filter("role = 'user'").select("conv_id", F.col("turn").alias("id"), (n % 5).alias("href"), label)
    notes = c.filter("role <> 'user'").select("conv_id", (n % 6).alias("anchor"), F.when(F.col("turn") % 2 == 0, F.col("turn")).alias("back"), label)
    return J.check_notes(marks, notes, ["conv_id"])


@query("j2_link_resolution", """
WITH links AS (SELECT page_id, unnest(regexp_extract_all(html, 'href="([^"]*)"', 1)) AS href FROM pages),
anchors AS (SELECT DISTINCT '/' || split_part(url, '/', 4) AS anchor FROM pages)
SELECT page_id, href, CASE WHEN regexp_matches(href, '^[a-z]+:') THEN 'external' WHEN a.anchor IS NOT NULL THEN 'exact' WHEN b.anchor IS NOT NULL THEN 'part' ELSE 'missing' END AS how, count(*) AS n
FROM links LEFT JOIN anchors a ON a.anchor = href LEFT JOIN anchors b ON b.anchor = split_part(href, '#', 1) GROUP BY ALL""")
def j2(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "pages")
    links = p.select(F.lit(0).alias("book"), "page_id", F.explode(F.regexp_extract_all("html", F.lit('href="([^"]*)"'), 1)).alias("href"))
    anchors = p.select(F.lit(0).alias("book"), F.concat(F.lit("/"), F.split_part("url", F.lit("/"), F.lit(4))).alias("anchor")).distinct().withColumn("page", F.lit(1))
    return J.resolve_links(links, anchors, ["book"]).groupBy("page_id", "href", "how").agg(F.count("*").alias("n"))


@query("j3_link_numbers", """
WITH m AS (SELECT conv_id, turn AS pos, length(text) % 5 AS n, row_number() OVER (PARTITION BY conv_id, length(text) % 5 ORDER BY turn) AS k FROM conversations WHERE role = 'user'),
t AS (SELECT conv_id, turn AS note, length(text) % 5 AS n FROM conversations WHERE role <> 'user')
SELECT conv_id, n::INT AS n, pos, note FROM m JOIN t USING (conv_id, n) WHERE k = 1""")
def j3(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "conversations")
    marks = c.filter("role = 'user'").select("conv_id", F.col("turn").alias("pos"), (F.length("text") % 5).alias("n"))
    notes = c.filter("role <> 'user'").select("conv_id", F.col("turn").alias("note"), (F.length("text") % 5).alias("n"))
    return J.link_numbers(marks, notes, ["conv_id"])


@query("j4_term_occurrences", """
WITH b AS (SELECT string_split(trim(regexp_replace(text, '[ \\t\\n]+', ' ', 'g')), ' ') AS w FROM benchmark), p AS (SELECT w, unnest(range(1, len(w))) AS i FROM b WHERE len(w) >= 2),
terms AS (SELECT DISTINCT w[i] || ' ' || w[i + 1] AS term FROM p),
w AS (SELECT doc_id, string_split(trim(regexp_replace(text, '[ \\t\\n]+', ' ', 'g')), ' ') AS w FROM documents),
g AS (SELECT doc_id, unnest(range(0, len(w) - 1)) AS pos, w FROM w WHERE len(w) >= 2),
o AS (SELECT doc_id, pos, w[pos + 1] || ' ' || w[pos + 2] AS term FROM g)
SELECT doc_id, pos::INT AS pos, term FROM o WHERE term IN (SELECT term FROM terms)""")
def j4(spark: SparkSession, d: str) -> DataFrame:
    words = F.split(F.trim(F.regexp_replace("text", "[ \\t\\n]+", " ")), " ")
    terms = table(spark, d, "benchmark").select(F.explode(J.windows(words, 2, " ")).alias("term")).distinct()
    return J.term_occurrences(table(spark, d, "documents").select("doc_id", "text"), terms)


@query("j5_benchmark_containment", """
WITH item AS (SELECT item_id, regexp_replace(text, '[ \\t\\n\\r]', '', 'g') AS t FROM benchmark),
piece AS (SELECT item_id, unnest(list_transform(range(0, (length(t) // 12)), lambda i: substr(t, i * 12 + 1, 12))) AS piece FROM item WHERE length(t) >= 12),
corpus AS (SELECT string_agg(regexp_replace(text, '[ \\t\\n\\r]', '', 'g'), '' ORDER BY doc_id) AS t FROM documents)
SELECT item_id, count(*) AS pieces, count(*) FILTER (WHERE NOT contains(t, piece)) AS absent, count(*) FILTER (WHERE NOT contains(t, piece)) > 0.6 * count(*) AS flagged FROM piece, corpus GROUP BY item_id""")
def j5(spark: SparkSession, d: str) -> DataFrame:
    return J.missing_pieces(table(spark, d, "benchmark"), table(spark, d, "documents"))


@query("j6_offset_to_block", f"""
WITH {BLOCKS}, s AS (SELECT doc_id, bi, coalesce(sum(length(line) + 1) OVER (PARTITION BY doc_id ORDER BY bi ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start FROM blocks),
q AS (SELECT doc_id, length(text) // 2 AS off FROM documents)
SELECT q.doc_id, off::BIGINT AS off, max(bi)::INT AS bi FROM q JOIN s ON s.doc_id = q.doc_id AND start <= off GROUP BY q.doc_id, off""")
def j6(spark: SparkSession, d: str) -> DataFrame:
    from ..operators.sequence import series_offsets

    starts = series_offsets(blocks(spark, d), ["doc_id"]).select("doc_id", "bi", "start_off")
    return J.locate(table(spark, d, "documents").select("doc_id", F.floor(F.length("text") / 2).cast("long").alias("off")), starts, ["doc_id"], "off")


@query("j7_nearest_candidate", """
WITH r AS (SELECT conv_id, turn AS ref, 1.0 * (length(text) % 40) AS low, 1.0 * (length(text) % 40) + 1 AS high FROM conversations),
c AS (SELECT conv_id, (turn + k) % 8 AS ref, k AS key_no, turn AS occ, (length(text) % 41) + 0.25 AS page FROM conversations, (SELECT unnest([1, 2, 3]) AS k)),
b AS (SELECT r.conv_id, r.ref, key_no, occ, greatest(0.0, low - page, page - (high + 1)) AS far FROM r JOIN c ON r.conv_id = c.conv_id AND r.ref = c.ref)
SELECT conv_id, ref::BIGINT AS ref, occ, key_no::INT AS key_no FROM (SELECT *, row_number() OVER (PARTITION BY conv_id, ref ORDER BY key_no, far, occ) AS k FROM b WHERE far <= 0.75) WHERE k = 1""")
def j7(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "conversations")
    low = (F.length("text") % 40).cast("double")
    refs = c.select("conv_id", F.col("turn").alias("ref"), low.alias("low"), (low + 1).alias("high"))
    cands = c.select("conv_id", "turn", "text", F.explode(F.array(F.lit(1), F.lit(2), F.lit(3))).alias("key_no")).select("conv_id", ((F.col("turn") + F.col("key_no")) % 8).alias("ref"), "key_no", F.col("turn").alias("occ"), (F.length("text") % 41 + F.lit(0.25)).alias("page"))
    return J.nearest_candidate(refs, cands, ["conv_id"]).select("conv_id", "ref", "occ", "key_no")


@query("j9_toc_labels", f"""
WITH {BLOCKS}, toc AS (SELECT doc_id, bi FROM blocks WHERE length(line) <= 46), pages AS (SELECT doc_id, bi, 1 + bi // 10 AS page FROM blocks WHERE bi % 2 = 0)
SELECT t.doc_id, t.bi::INT AS bi, coalesce(page, -1)::BIGINT AS page FROM toc t LEFT JOIN pages p USING (doc_id, bi)""")
def j9(spark: SparkSession, d: str) -> DataFrame:
    b = blocks(spark, d)
    pages = b.filter("bi % 2 = 0").select("doc_id", "bi", (1 + F.floor(F.col("bi") / 10)).cast("long").alias("page"))
    return b.filter(F.length("line") <= 46).select("doc_id", "bi").join(pages, ["doc_id", "bi"], "left").withColumn("page", F.coalesce("page", F.lit(-1).cast("long")))


@query("j11_glyph_coverage", """
WITH used AS (SELECT DISTINCT unicode(ch)::BIGINT AS cp FROM (SELECT unnest(string_split(text, '')) AS ch FROM documents) WHERE ch <> ''),
glyphs AS (SELECT 0 AS face, unnest(range(32, 127)) AS cp UNION ALL SELECT 1, unnest(range(192, 256)))
SELECT u.cp, coalesce(min(g.face), -1)::INT AS fallback FROM used u LEFT JOIN glyphs g ON g.cp = u.cp AND g.face > 0 WHERE u.cp NOT IN (SELECT cp FROM glyphs WHERE face = 0) GROUP BY u.cp""")
def j11(spark: SparkSession, d: str) -> DataFrame:
    from ..operators.aggregates import codepoints

    glyphs = spark.range(32, 127).select(F.lit(0).alias("face"), F.col("id").alias("cp")).union(spark.range(192, 256).select(F.lit(1).alias("face"), F.col("id").alias("cp")))
    return J.uncovered(codepoints(table(spark, d, "documents"), "text", []), glyphs).withColumn("fallback", F.coalesce("fallback", F.lit(-1)))


_SPANS = "spans AS (SELECT conv_id AS page, turn AS id, (length(text) % 9) * 0.5 AS y, 10.0 * (length(text) % 13) AS x0, 10.0 * (length(text) % 13) + 25 AS x1 FROM conversations)"


@query("j13_span_overlap", f"""
WITH {_SPANS} SELECT a.page, a.id AS a, b.id AS b, least(a.x1, b.x1) - greatest(a.x0, b.x0) AS common FROM spans a JOIN spans b ON a.page = b.page AND a.id < b.id AND abs(a.y - b.y) <= 1.0
WHERE least(a.x1, b.x1) - greatest(a.x0, b.x0) > 1.5""".replace("AS common", "AS common").replace("least(a.x1, b.x1) - greatest(a.x0, b.x0) AS common", "(least(a.x1, b.x1) - greatest(a.x0, b.x0))::DOUBLE AS common"))
def j13(spark: SparkSession, d: str) -> DataFrame:
    n = F.length("text")
    x0 = (n % 13 * 10).cast("double")
    spans = table(spark, d, "conversations").select(F.col("conv_id").alias("page"), F.col("turn").alias("id"), (n % 9 * 0.5).alias("y"), x0.alias("x0"), (x0 + 25).alias("x1"))
    return J.span_overlaps(spans)


@query("j14_reprint", """
WITH a AS (SELECT conv_id AS page, string_agg(text, chr(31) ORDER BY turn) AS t FROM conversations WHERE conv_id % 7 <> 0 GROUP BY conv_id),
b AS (SELECT conv_id AS page, string_agg(CASE WHEN conv_id % 5 = 0 AND turn = 0 THEN 'x' || text ELSE text END, chr(31) ORDER BY turn) AS t FROM conversations WHERE conv_id % 11 <> 0 GROUP BY conv_id)
SELECT coalesce(a.page, b.page) AS page, CASE WHEN a.page IS NULL THEN 'new' WHEN b.page IS NULL THEN 'gone' WHEN a.t <> b.t THEN 'changed' ELSE 'same' END AS how FROM a FULL JOIN b ON a.page = b.page""")
def j14(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "conversations").select(F.col("conv_id").alias("page"), F.col("turn").alias("line_no"), "text")
    new = c.filter("page % 11 <> 0").withColumn("text", F.when(F.expr("page % 5 = 0 AND line_no = 0"), F.concat(F.lit("x"), "text")).otherwise(F.col("text")))
    return J.compare_pages(c.filter("page % 7 <> 0"), new)


@query("j15_page_base", """
SELECT source, doc_id, (1 + n_chars // 1800)::BIGINT AS npages, coalesce(sum(1 + n_chars // 1800) OVER (PARTITION BY source ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS base FROM documents""")
def j15(spark: SparkSession, d: str) -> DataFrame:
    books = table(spark, d, "documents").select("source", "doc_id", (1 + F.floor(F.col("n_chars") / 1800)).cast("long").alias("npages"))
    return J.page_bases(books, ["source"], "doc_id")


_RULES = """rules AS (SELECT * FROM (VALUES (1, '*', 'thr', 'th-r', 'spelling: all parts'), (2, '3,7,11', 'tion', 'sion', 'spelling/part: three parts'), (3, '20-40', 'qqqq', '', 'stale'), (4, '0-99', ' ,', ',', 'space: before a comma')) AS t(rule_no, spec, old, new, note))"""


@query("x1_rule_selection", """
SELECT doc_id, CASE WHEN doc_id IN (3, 7, 11) AND doc_id BETWEEN 20 AND 40 THEN 4 WHEN doc_id IN (3, 7, 11) THEN 3 WHEN doc_id BETWEEN 20 AND 40 THEN 3 WHEN doc_id BETWEEN 0 AND 99 THEN 2 ELSE 1 END::BIGINT AS n FROM documents""")
def x1(spark: SparkSession, d: str) -> DataFrame:
    chosen = R.select_rules(table(spark, d, "documents").select(F.col("doc_id").alias("part")), R.example_rules(spark))
    return chosen.groupBy(F.col("part").alias("doc_id")).agg(F.count("*").alias("n"))


@query("x2_literal_rules", """
SELECT doc_id, md5(CASE WHEN doc_id BETWEEN 0 AND 99 THEN replace(s, ' ,', ',') ELSE s END) AS fixed FROM (
  SELECT doc_id, CASE WHEN doc_id IN (3, 7, 11) THEN replace(replace(text, 'thr', 'th-r'), 'tion', 'sion') ELSE replace(text, 'thr', 'th-r') END AS s FROM documents)""")
def x2(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select(F.col("doc_id").alias("part"), "text")
    return R.apply_literal(docs, R.example_rules(spark)).select(F.col("part").alias("doc_id"), F.md5(F.col("text").cast("binary")).alias("fixed"))


@query("x3_rule_usage", """
SELECT * FROM (SELECT 1 AS rule_no, sum((length(text) - length(replace(text, 'thr', ''))) // 3)::BIGINT AS hits FROM documents UNION ALL
  SELECT 2, sum((length(replace(text, 'thr', 'th-r')) - length(replace(replace(text, 'thr', 'th-r'), 'tion', ''))) // 4)::BIGINT FROM documents WHERE doc_id IN (3, 7, 11) UNION ALL
  SELECT 3, 0::BIGINT UNION ALL SELECT 4, sum((length(text) - length(replace(text, ' ,', ''))) // 2)::BIGINT FROM documents WHERE doc_id BETWEEN 0 AND 99)""")
def x3(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select(F.col("doc_id").alias("part"), "text")
    return R.usage(docs, R.example_rules(spark))


#: Rules of a whole book: pairs of syllables, a third of them for all parts, a third for a range and a third for two ranges.
_SYLLABLES = "ing tion er an re on at en nd ti es or te of ed is it al ar st to nt ng se ha as ou io le ve co me de hi ri ro ic ne ea ra ce li ch ll be".split()


def book_rules(spark: SparkSession) -> DataFrame:
    """2,025 rules with part ranges; what a rule puts in may hold the old text of later ones."""
    rows = []
    for i, a in enumerate(_SYLLABLES):
        for j, b in enumerate(_SYLLABLES):
            no = i * len(_SYLLABLES) + j
            spec = ["*", f"{no % 40 * 20}-{no % 40 * 20 + 300}", f"{no % 30 * 10}-{no % 30 * 10 + 100},{no % 50 * 15}"][no % 3]
            rows.append((no, spec, a + b, f"{b}-{a[0]}", "spelling"))
    return spark.createDataFrame(rows, R.RULES)


#: Each text through all rules in order; after a mark, which rules applied and how often.
_WALKED = f"""syllables AS (SELECT unnest({_SYLLABLES}) AS s, generate_subscripts({_SYLLABLES}, 1) - 1 AS i),
numbered AS (SELECT a.i * 45 + b.i AS no, a.s || b.s AS old, b.s || '-' || left(a.s, 1) AS new FROM syllables a, syllables b),
book AS (
  SELECT list(concat_ws('|', no, old, new, CASE no % 3 WHEN 0 THEN -4611686018427387904 WHEN 1 THEN no % 40 * 20 ELSE no % 30 * 10 END,
    CASE no % 3 WHEN 0 THEN 4611686018427387904 WHEN 1 THEN no % 40 * 20 + 300 ELSE no % 30 * 10 + 100 END, CASE no % 3 WHEN 2 THEN no % 50 * 15 ELSE -1 END) ORDER BY no) AS rules FROM numbered),
walked AS (
  SELECT doc_id, list_reduce(list_prepend(coalesce(text, '') || chr(1), rules), lambda x, r:
    CASE WHEN (doc_id BETWEEN split_part(r, '|', 4)::BIGINT AND split_part(r, '|', 5)::BIGINT OR doc_id = split_part(r, '|', 6)::BIGINT) AND contains(split_part(x, chr(1), 1), split_part(r, '|', 2))
      THEN replace(split_part(x, chr(1), 1), split_part(r, '|', 2), split_part(r, '|', 3)) || chr(1) || split_part(x, chr(1), 2) || split_part(r, '|', 1) || ':' ||
        ((length(split_part(x, chr(1), 1)) - length(replace(split_part(x, chr(1), 1), split_part(r, '|', 2), ''))) // length(split_part(r, '|', 2))) || ';'
      ELSE x END) AS x FROM documents, book)"""


@query("x2_rule_book", f"""
WITH {_WALKED} SELECT doc_id, md5(split_part(x, chr(1), 1)) AS fixed, (length(split_part(x, chr(1), 2)) - length(replace(split_part(x, chr(1), 2), ';', '')))::BIGINT AS n_rules FROM walked""")
def x2b(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select(F.col("doc_id").alias("part"), F.coalesce("text", F.lit("")).alias("text"))
    fixed = R.apply_literal(docs, book_rules(spark), hits="hits")
    return fixed.select(F.col("part").alias("doc_id"), F.md5(F.col("text").cast("binary")).alias("fixed"), F.size("hits").cast("long").alias("n_rules"))


@query("x3_rule_book", f"""
WITH {_WALKED}, hits AS (SELECT split_part(one, ':', 1)::INT AS rule_no, sum(split_part(one, ':', 2)::BIGINT) AS hits FROM (SELECT unnest(string_split(split_part(x, chr(1), 2), ';')) AS one FROM walked) WHERE one <> '' GROUP BY ALL)
SELECT no::INT AS rule_no, coalesce(hits, 0)::BIGINT AS hits FROM numbered LEFT JOIN hits ON no = rule_no""")
def x3b(spark: SparkSession, d: str) -> DataFrame:
    return R.usage(table(spark, d, "documents").select(F.col("doc_id").alias("part"), "text"), book_rules(spark))


@query("x7_correction_categories", """
SELECT category, count(*) AS n FROM (SELECT CASE WHEN c <> '' THEN split_part(c, '/', 1) WHEN length(source || ': ' || lang) <= 8 THEN source || ': ' || lang ELSE 'other' END AS category, source, lang
  FROM (SELECT *, regexp_extract(source || ': ' || lang, '^([^：:(]{1,8})[：:(]', 1) AS c FROM documents)) GROUP BY category""")
def x7(spark: SparkSession, d: str) -> DataFrame:
    notes = table(spark, d, "documents").select(F.concat_ws(": ", "source", "lang").alias("note"))
    return notes.groupBy(R.category(F.col("note")).alias("category")).agg(F.count("*").alias("n"))
